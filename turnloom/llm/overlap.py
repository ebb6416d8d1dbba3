"""Problem 1: records of the evaluation splits that also stand in training.

Every record becomes a parity sketch of its words, evaluation and training
sketches are compared block by chunk, and the few pairs that are near enough get
their words back and are compared exactly.

* Records with the same words form a class; only one representative a class is
  compared, so groups of exact copies cost nothing until their pairs are listed.
* No pair is lost, at any length and in families of any size.  Records of n and m
  words of which c >= 0.8 * max(n, m) agree in order differ in at most n + m - 2c
  words as bags.  Each word of a bag turns one bit of the sketch over, so sketches
  differ in no more bits than the bags in words; a sketch holds a multiple of the
  record's words in bits, lest chance pairs come near.
* Only records whose lengths can agree meet: both sides are parted by the power of
  two of the length, evaluation into blocks and training into chunks of bounded
  numbers of words and records, and in these by the length itself.  What is sent to
  every block and chunk is sketches, at a byte a word or so, never words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.llm.words import comparable_words, split_column
from turnloom.registry import Registry
from turnloom.session import cut, table

registry = Registry()

#: Share of the longer record's words that must agree in order, in fifths.
FIFTHS = 4
#: Words of evaluation records in a block, and of training records in a chunk, and records in either; they bound a task's memory and time and lose nothing.
BLOCK_WORDS, CHUNK_WORDS, CELL_RECORDS = 32_000_000, 16_000_000, 100_000
#: Pairs that one step of a scan compares.
_CELLS = 262_144
#: Bits of a sketch for each word of the shortest record of its power of two, and how often they are laid over each other for the first look.
_BITS, _FOLDS = 8, 4
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_pairs(flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(record, key) of every word pair of many records, whose words' hashes stand in ``flat`` one record after the other.

    A pair that stands in a record again has another key, so that a record's keys are a set.
    """
    if len(flat) < 2:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    record = np.repeat(np.arange(len(sizes)), sizes)
    with np.errstate(over="ignore"):
        key = (flat[:-1] * _MIX) ^ (flat[1:] + (flat[1:] << np.uint64(23)))
        key = (key ^ (key >> np.uint64(29))) * _MIX
        inside = record[1:] == record[:-1]
        record, key = record[:-1][inside], key[inside]
        order = np.lexsort((key, record))
        record, key = record[order], key[order]
        first = np.ones(len(key), dtype=bool)
        first[1:] = (record[1:] != record[:-1]) | (key[1:] != key[:-1])
        at = np.arange(len(key))
        return record, key + (at - np.maximum.accumulate(np.where(first, at, 0))).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)


def least_common(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Word pairs that records of n and m words must share if they agree."""
    c = (FIFTHS * np.maximum(n, m) + 4) // 5
    return 3 * c - n - m - 1


def apart_at_most(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Words in which the bags of records of n and m words may differ if they agree."""
    return n + m - 2 * ((FIFTHS * np.maximum(n, m) + 4) // 5)


def sketch_words(band: int) -> int:
    """64-bit words of a sketch that is compared with records of 2 ** band words or more, but not twice as many."""
    return max(_FOLDS, (_BITS << band) // 64)


def sketches(flat: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """A row of ``width`` 64-bit words for each record: the parity of its words at each bit; a word that stands again is another word.

    ``width`` is a power of two, and halves of a sketch laid over each other are the sketch of half that width.
    At most 2 ** 24 records, more than any batch holds.
    """
    out = np.zeros(len(sizes) * width, dtype=np.uint64)
    if not len(flat):
        return out.reshape(len(sizes), width)
    # record and 40 bits of the hash in one number: words that share these count as one word, the same on either side
    shift = np.uint64(40)
    key = np.sort((np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes) << shift) | (flat >> np.uint64(24)))
    record = (key >> shift).astype(np.int64)
    first = np.ones(len(key), dtype=bool)
    first[1:] = key[1:] != key[:-1]
    at = np.arange(len(key))
    again = (at - np.maximum.accumulate(np.where(first, at, 0))).astype(np.uint64)
    key &= (np.uint64(1) << shift) - np.uint64(1)
    with np.errstate(over="ignore"):
        key = key * _MIX + again * np.uint64(0xD6E8FEB86659FD93)
        key = (key ^ (key >> np.uint64(29))) * _MIX
        key ^= key >> np.uint64(32)
    np.bitwise_xor.at(out, record * width + (key // np.uint64(64) % np.uint64(width)).astype(np.int64), np.uint64(1) << (key % np.uint64(64)))
    return out.reshape(len(sizes), width)


def near(bits_e: np.ndarray, n_e: np.ndarray, bits_t: np.ndarray, n_t: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of e, places of t) of all pairs whose lengths and sketches allow that they agree."""
    by_e, by_t = np.argsort(n_e, kind="stable"), np.argsort(n_t, kind="stable")
    bits_e, n_e, bits_t, n_t = bits_e[by_e], n_e[by_e], bits_t[by_t], n_t[by_t]
    width = bits_e.shape[1] // _FOLDS
    first_e, first_t = (np.ascontiguousarray(np.bitwise_xor.reduce(x.reshape(len(x), _FOLDS, width), axis=1).T) for x in (bits_e, bits_t))
    kind = np.uint8 if width < 4 else np.uint16 if width < 1024 else np.uint32
    lengths, starts = np.unique(n_e, return_index=True)
    for n, e_low, e_high in zip(lengths.tolist(), starts.tolist(), [*starts[1:].tolist(), len(n_e)]):
        low, high = np.searchsorted(n_t, (FIFTHS * n + 4) // 5), np.searchsorted(n_t, 5 * n // FIFTHS, "right")
        for t0 in range(low, high, _CELLS):
            t1 = min(high, t0 + _CELLS)
            most = apart_at_most(n, n_t[t0:t1])
            limit = np.minimum(most, np.iinfo(kind).max).astype(kind)
            step = max(1, _CELLS // (t1 - t0))
            for e0 in range(e_low, e_high, step):
                e1 = min(e_high, e0 + step)
                differ = np.zeros((e1 - e0, t1 - t0), dtype=kind)
                for own, other in zip(first_e, first_t):
                    differ += np.bitwise_count(own[e0:e1, None] ^ other[None, t0:t1])
                e, t = np.nonzero(differ <= limit)
                if len(e):
                    fits = np.bitwise_count(bits_e[e + e0] ^ bits_t[t + t0]).sum(axis=1, dtype=np.int64) <= most[t]
                    yield by_e[e[fits] + e0], by_t[t[fits] + t0]


def contained(flat_e: np.ndarray, n_e: np.ndarray, flat_t: np.ndarray, n_t: np.ndarray, pairs: Iterator[tuple[int, int]]) -> Iterator[tuple[int, int, float]]:
    """(place of e, place of t, containment of e's word pairs in t's) of the pairs that share as many word pairs as they must."""
    (rec_e, key_e), (rec_t, key_t) = word_pairs(flat_e, n_e), word_pairs(flat_t, n_t)
    bounds_e, bounds_t = (np.searchsorted(r, np.arange(len(n) + 1)) for r, n in ((rec_e, n_e), (rec_t, n_t)))
    for i, j in pairs:
        own = key_e[bounds_e[i] : bounds_e[i + 1]]
        shared = len(np.intersect1d(own, key_t[bounds_t[j] : bounds_t[j + 1]], assume_unique=True))
        if shared >= least_common(n_e[i], n_t[j]):
            yield i, j, shared / len(own)


def candidates(flat_e: np.ndarray, n_e: np.ndarray, flat_t: np.ndarray, n_t: np.ndarray) -> Iterator[tuple[int, int, float]]:
    """(place of e, place of t, containment of e's word pairs in t's) of all pairs that may agree, of records at hand."""
    width = sketch_words(int(n_e.max()).bit_length() - 1)
    found = near(sketches(flat_e, n_e, width), n_e, sketches(flat_t, n_t, width), n_t)
    return contained(flat_e, n_e, flat_t, n_t, ((i, j) for e, t in found for i, j in zip(e.tolist(), t.tolist())))


def same_order(a: list, b: list) -> int:
    """The length of the longest common subsequence, bit-parallel."""
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = v = (1 << len(a)) - 1
    for x in b:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def _word_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, is_train, text -> id, is_train, the text's class, its word hashes."""
    known: dict[str, int] = {}
    for batch in batches:
        ids, sides, classes, hashes = [], [], [], []
        for i, side, text in zip(*(c.to_pylist() for c in batch.columns)):
            words = comparable_words(text or "")
            if not words:
                continue
            if len(known) > 500_000:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w)
            h = np.fromiter((known[w] for w in words), dtype=np.uint64, count=len(words))
            ids.append(i)
            sides.append(side)
            classes.append(xxhash.xxh3_64_intdigest(h.tobytes()) - (1 << 63))
            hashes.append(h.view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sides, pa.bool_()), pa.array(classes, pa.int64()), pa.array(hashes, pa.list_(pa.int64()))], ["id", "is_train", "class", "words"])


LINKS = "e bigint, t bigint, contained double, agreement double"


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of lists one after the other, and the lists' lengths."""
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.diff(column.offsets.to_numpy()).astype(np.int64)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """class, words, first and last band -> class, n, band, the words' sketch for each of these bands."""
    for batch in batches:
        for last in set(batch.column(3).to_pylist()):
            rows = batch.filter(pc.equal(batch.column(3), last))
            flat, sizes = _lists(rows.column(1))
            n, first, bits = pa.array(sizes.astype(np.int32)), rows.column(2).to_numpy(), sketches(flat, sizes, sketch_words(last))
            for band in range(last, int(first.min()) - 1, -1):
                # a sketch for the band below is half as wide, but for the least width
                if bits.shape[1] > sketch_words(band):
                    bits = bits[:, : bits.shape[1] // 2] ^ bits[:, bits.shape[1] // 2 :]
                mine = np.flatnonzero(first <= band)
                at = pa.array(mine)
                held = pa.array([bits[i].tobytes() for i in mine.tolist()], pa.binary())
                yield pa.RecordBatch.from_arrays([rows.column(0).take(at), n.take(at), pa.array(np.full(len(mine), band, dtype=np.int32)), held], ["class", "n", "band", "bits"])


def _cell(evaluation: pa.Table, training: pa.Table) -> pa.Table:
    """The pairs of an evaluation class in a block and a training class in a chunk that are near enough."""

    def side(rows: pa.Table):
        bits = b"".join(rows.column(2).to_pylist())
        return rows.column(0).to_numpy(), rows.column(1).to_numpy().astype(np.int64), np.frombuffer(bits, dtype=np.uint64).reshape(rows.num_rows, -1)

    e, t = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    if evaluation.num_rows and training.num_rows:
        (own_e, n_e, bits_e), (own_t, n_t, bits_t) = side(evaluation), side(training)
        for i, j in near(bits_e, n_e, bits_t, n_t):
            e.append(own_e[i])
            t.append(own_t[j])
    e, t = np.concatenate(e), np.concatenate(t)
    return pa.table({"e": e[e != t], "t": t[e != t]})


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """e, t, the words of both -> the links among them."""
    for batch in batches:
        (flat_e, n_e), (flat_t, n_t) = _lists(batch.column(2)), _lists(batch.column(3))
        ends_e, ends_t = np.cumsum(n_e), np.cumsum(n_t)
        places, shares, agreements = [], [], []
        for i, _, share in contained(flat_e, n_e, flat_t, n_t, ((i, i) for i in range(batch.num_rows))):
            longer = int(max(n_e[i], n_t[i]))
            same = same_order(flat_e[ends_e[i] - n_e[i] : ends_e[i]].tolist(), flat_t[ends_t[i] - n_t[i] : ends_t[i]].tolist())
            if 5 * same >= FIFTHS * longer:
                places.append(i)
                shares.append(share)
                agreements.append(same / longer)
        rows = batch.take(pa.array(places, pa.int64()))
        yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(shares, pa.float64()), pa.array(agreements, pa.float64())], ["e", "t", "contained", "agreement"])


def overlaps(records: DataFrame, record_id: Column, is_train: Column, text: Column) -> tuple[DataFrame, DataFrame]:
    """Links between classes of evaluation and training records, and the members of the classes.

    Returns (links, members): links has ``e``, ``t`` (classes), ``contained`` (share
    of the evaluation record's word pairs that stand in the training record) and
    ``agreement`` (words in the same order, as a share of the longer one's);
    members has ``id``, ``is_train``, ``class``.  ``is_train`` null takes a record
    out, as does a text that is null or has no words.  Repeated ids count once.  A
    class that stands in both splits links to itself.  Records of fewer than four
    words agree with their own class only.  Empty in, empty out; other columns
    don't matter.
    """
    rows = records.select(record_id.alias("id"), is_train.alias("is_train"), text.alias("text")).where("is_train IS NOT NULL AND text IS NOT NULL")
    hashed = cut(rows.mapInArrow(_word_hashes, "id bigint, is_train boolean, class bigint, words array<bigint>").dropDuplicates(["id"]))
    members = hashed.select("id", "is_train", "class")
    n = F.size("words")
    classes = hashed.groupBy("class").agg(F.max(~F.col("is_train")).alias("in_eval"), F.max("is_train").alias("in_train"), F.any_value("words").alias("words"))
    classes = cut(classes.withColumn("n", n))

    def band(x: Column) -> Column:
        return F.length(F.bin(x)) - 1

    # the bands of the lengths that can agree with n, as powers of two: one or two
    own_band, low, high = band(F.col("n")), band(F.floor((FIFTHS * F.col("n") + 4) / 5)), band(F.floor(5 * F.col("n") / FIFTHS))
    e = classes.where("in_eval AND n > 3").select("class", "words", "n", own_band.alias("low"), own_band.alias("high"))
    t = classes.where("in_train AND n > 3").select("class", "words", "n", low.alias("low"), high.alias("high"))
    # at most a row for each power of two
    size_e, size_t = ({r["band"]: (r["k"], r["rows"]) for r in x.select("n", F.explode(F.sequence("low", "high")).alias("band")).groupBy("band").agg(F.sum("n").alias("k"), F.count("*").alias("rows")).collect()} for x in (e, t))
    both = sorted(set(size_e) & set(size_t))
    own = classes.where("in_eval AND in_train").select(F.col("class").alias("e"), F.col("class").alias("t"), F.lit(1.0).alias("contained"), F.lit(1.0).alias("agreement"))
    if not both:
        return own, members

    def parts(size: dict, most: int) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for b in both for x in (b, max(-(-size[b][0] // most), -(-size[b][1] // CELL_RECORDS)))]), F.col("band"))

    blocks, chunks, first = parts(size_e, BLOCK_WORDS), parts(size_t, CHUNK_WORDS), F.lit(0).cast("bigint")
    e, t = (x.select("class", "words", "low", "high").mapInArrow(_sketched, "class bigint, n int, band int, bits binary").where(F.col("band").isin(both)) for x in (e, t))
    e = e.select("class", "n", "bits", "band", F.pmod(F.xxhash64("class"), blocks).alias("block"), F.explode(F.sequence(first, chunks - 1)).alias("chunk"))
    # named anew: both sides of a cogroup must not share columns
    t = t.select(F.col("class").alias("class_t"), F.col("n").alias("n_t"), F.col("bits").alias("bits_t"), "band", F.explode(F.sequence(first, blocks - 1)).alias("block"), F.pmod(F.xxhash64("class"), chunks).alias("chunk"))
    cell = ["band", "block", "chunk"]
    pairs = e.groupBy(*cell).cogroup(t.groupBy(*cell)).applyInArrow(_cell, "e bigint, t bigint")
    words_e, words_t = (classes.where(side).select(F.col("class").alias(x), F.col("words").alias(f"words_{x}")) for x, side in (("e", "in_eval"), ("t", "in_train")))
    links = pairs.join(words_e, "e").join(words_t, "t").select("e", "t", "words_e", "words_t").mapInArrow(_compared, LINKS)
    return links.unionByName(own), members


def _dialogues(spark, sf_dir):
    """record_id, split and the whole history of each dialogue; deliveries may repeat."""
    text = F.array_join(F.transform("history", lambda x: x["content"]), " ")
    return table(spark, sf_dir, "dialogues").select("record_id", "dataset", split_column(F.col("split")).alias("split"), text.alias("text"))


def _links(spark, sf_dir):
    return overlaps(_dialogues(spark, sf_dir), F.col("record_id"), F.col("split") == "train", F.col("text"))


@registry.query("p1_found")
def p1_found(spark, sf_dir):
    """Pairs of an evaluation and a training dialogue whose histories agree."""
    links, members = _links(spark, sf_dir)
    e = members.where("NOT is_train").select(F.col("id").alias("id_e"), F.col("class").alias("e"))
    t = members.where("is_train").select(F.col("id").alias("id_t"), F.col("class").alias("t"))
    pairs = links.select("e", "t").join(e, "e").join(t, "t")
    return pairs.select(F.least("id_e", "id_t").alias("id_a"), F.greatest("id_e", "id_t").alias("id_b"))


@registry.query("p1_report")
def p1_report(spark, sf_dir):
    """Evaluation dialogues per split and dataset, and how many of them stand in training."""
    links, members = _links(spark, sf_dir)
    hit = links.groupBy(F.col("e").alias("class")).agg(F.max("agreement").alias("best"))
    there = members.where("NOT is_train").join(hit, "class", "left").select("id", "best")
    of = _dialogues(spark, sf_dir).where("split IN ('validation', 'test')").select(F.col("record_id").alias("id"), "split", "dataset").dropDuplicates(["id"])
    rows = of.join(there, "id", "left")
    return rows.groupBy("split", "dataset").agg(
        F.count("*").alias("n_records"), F.count("best").alias("n_overlapping"), F.count_if(F.col("best") == 1.0).alias("n_exact"), (F.count("best") / F.count("*")).alias("share")
    )
