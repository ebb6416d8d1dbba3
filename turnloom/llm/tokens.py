"""Problem 8: the corpus as ids of a public byte-level BPE tokenizer.

Texts are cut into words by the tokenizer's pattern and every document is encoded
in its own row.  The ids of the corpus' most frequent words stand in a literal map;
all other words, and these once, are folded: a higher-order fold merges the pair
of least rank over the word's bytes, with the ranks as a literal map.  Only distinct words with their counts are ever shuffled.
Decoding concatenates the binary pieces of the ids.
"""

from __future__ import annotations

import base64
import json
import os
import zlib
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.registry import Registry
from turnloom.session import cut, table

registry = Registry()

#: Folder of the public tokenizers' files.
TOKENIZERS = os.environ.get("TURNLOOM_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: the tokenizer's word pattern; blanks are those of Unicode.
_WS = r"\t-\r \x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
WORD = rf"'(?:[sdmt]|ll|ve|re)| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"
#: The literal maps are cut into so many parts, as Spark searches a map entry by entry.
PARTS = 16381
#: The words whose ids stand in the plan: so many of the most frequent, each of so many bytes at most.
HOT_WORDS, HOT_BYTES = 60_000, 200
#: The rank of a pair that is no token.
_NONE = 2**31 - 1


@cache
def ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank (= id) of a tiktoken file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@cache
def merges(path: str) -> dict[tuple[int, int], int]:
    """The two ids that each token of several bytes is merged from, to its own id: ranks are in the order of the merges."""
    rank = ranks(path)
    out = {}
    for token, own in rank.items():
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            low, at = min((rank.get(parts[i] + parts[i + 1], _NONE), i) for i in range(len(parts) - 1))
            if low >= own:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2:
            out[rank[parts[0]], rank[parts[1]]] = own
    return out


@cache
def _merges_json(path: str) -> str:
    parts: list[dict[str, list[int]]] = [{"k": [], "v": []} for _ in range(PARTS)]
    for (a, b), own in merges(path).items():
        key = a << 20 | b
        parts[key % PARTS]["k"].append(key)
        parts[key % PARTS]["v"].append(own)
    return json.dumps(parts, separators=(",", ":"))


@cache
def _bytes_json(path: str) -> str:
    rank = ranks(path)
    return json.dumps([rank[bytes([b])] for b in range(256)])


def _maps(spark: SparkSession, path: str, ids_of: dict[str, list[int]]) -> Column:
    """The literal maps of a plan: ids by word in parts, merges in parts, ids of single bytes.

    They are a scalar subquery, which is a literal once it runs; a map of this size
    spelled out in the plan would stand in every description of it.
    """
    parts: list[dict[str, list[int]]] = [{} for _ in range(PARTS)]
    for word, ids in ids_of.items():
        parts[zlib.crc32(word.encode()) % PARTS][word] = ids
    one = spark.createDataFrame([(json.dumps(parts, ensure_ascii=False, separators=(",", ":")), _merges_json(path), _bytes_json(path))], "w string, m string, b string")
    read = F.struct(F.from_json("w", "array<map<string,array<int>>>").alias("words"), F.from_json("m", "array<struct<k:array<bigint>,v:array<int>>>").alias("pairs"), F.from_json("b", "array<int>").alias("single"))
    return one.select(read.alias("maps")).scalar()


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _folded(word: Column, pairs: Column, single: Column) -> Column:
    """The ids of one word, given as a string, by ranked merges; null for null.

    The fold's state is the ids so far and the rank of each merged with the next; a step merges the leftmost of least rank.
    """

    def rank(a: Column, b: Column) -> Column:
        key = F.shiftleft(a.cast("bigint"), 20) + b
        return _let(key, lambda k: _let(F.element_at(pairs, (k % PARTS).cast("int") + 1), lambda part: F.coalesce(F.get(part["v"], F.array_position(part["k"], k).cast("int") - 1), F.lit(_NONE))))

    # one character for each byte
    flat = F.decode(F.encode(word, "utf-8"), "iso-8859-1")
    ids = F.transform(F.filter(F.split(flat, ""), lambda c: c != ""), lambda c: F.element_at(single, F.ascii(c) + 1))

    def start(x: Column) -> Column:
        return F.struct(x.alias("p"), F.transform(F.slice(x, F.lit(1), F.size(x) - 1), lambda a, i: rank(a, F.get(x, i + 1))).alias("r"))

    def merged(acc: Column, m: Column, at: Column) -> Column:
        """``acc`` with the ids at and at+1 (from 1) merged into ``m``."""
        p, r = acc["p"], acc["r"]
        n = F.size(p)
        before = F.when(at > 1, F.concat(F.slice(r, F.lit(1), at - 2), F.array(rank(F.get(p, at - 2), m)))).otherwise(F.slice(r, 1, 0))
        after = F.when(at + 1 < n, F.concat(F.array(rank(m, F.get(p, at + 1))), F.slice(r, at + 2, n))).otherwise(F.slice(r, 1, 0))
        return F.struct(F.concat(F.slice(p, F.lit(1), at - 1), F.array(m), F.slice(p, at + 2, n)).alias("p"), F.concat(before, after).alias("r"))

    def step(acc: Column, _: Column) -> Column:
        low = F.coalesce(F.array_min(acc["r"]), F.lit(_NONE))
        return _let(low, lambda m: F.when(m == _NONE, acc).otherwise(_let(F.array_position(acc["r"], m).cast("int"), lambda at: merged(acc, m, at))))

    return _let(ids, lambda x: F.when(F.size(x) < 2, x).otherwise(F.aggregate(F.slice(x, F.lit(1), F.size(x) - 1), start(x), step, lambda acc: acc["p"])))


def words_of(text: Column) -> Column:
    """The tokenizer's words of a text, in order."""
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def token_ids(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, ids) of every row of ``docs``; null and empty texts have the empty list.

    Rows are neither added nor lost, so repeated ids stay, and a null id is an id;
    other columns don't matter.  The distinct words are gathered with their
    counts, which combine before the shuffle; the HOT_WORDS most frequent short
    ones (a fixed bound) are encoded once and their ids put into the plan.  All other words are folded where they stand.
    """
    path = path or os.path.join(TOKENIZERS, VOCABULARY)
    spark = docs.sparkSession
    words = docs.where(F.length(text) > 0).select(F.explode(words_of(F.col(text))).alias("_w"))
    counted = words.groupBy("_w").agg(F.count("*").alias("_n")).where(F.length(F.encode("_w", "utf-8")) <= HOT_BYTES)
    hot = cut(counted.orderBy(F.desc("_n"), "_w").limit(HOT_WORDS).select("_w"))
    # the encoding is spread evenly, whatever the sort left together
    spread = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    folded = _let(F.col("_maps"), lambda maps: _folded(F.col("_w"), maps["pairs"], maps["single"]))
    known = {r["_w"]: r["_ids"] for r in hot.repartition(spread).select("_w", _maps(spark, path, {}).alias("_maps")).select("_w", folded.alias("_ids")).collect()}

    def encoded(maps: Column) -> Column:
        return F.flatten(F.transform(words_of(F.col("_text")), lambda w: F.coalesce(_known(maps["words"], w), _folded(w, maps["pairs"], maps["single"]))))

    ids = F.when(F.length("_text") > 0, _let(F.col("_maps"), encoded)).otherwise(F.array().cast("array<int>"))
    return docs.select(doc_id, F.col(text).alias("_text"), _maps(spark, path, known).alias("_maps")).select(doc_id, ids.alias("ids"))


def _known(words: Column, word: Column) -> Column:
    """The ids of a word that stands in the map, else null."""
    return F.try_element_at(F.element_at(words, (F.crc32(word) % PARTS).cast("int") + 1), word)


def decoded(ids: Column, path: str | None = None) -> Column:
    """The text of a list of ids; bytes that are no UTF-8 become the replacement character."""
    path = path or os.path.join(TOKENIZERS, VOCABULARY)
    by_id = sorted((r, t.hex().upper()) for t, r in ranks(path).items())
    pieces = F.from_json(F.lit(json.dumps([t for _, t in by_id], separators=(",", ":"))), "array<string>")
    return F.decode(F.unhex(F.array_join(F.transform(ids, lambda i: F.element_at(pieces, i + 1)), "")), "utf-8")


def documents(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


@registry.query("p8_ids")
def p8_ids(spark, sf_dir):
    """The token ids of each document."""
    return token_ids(documents(spark, sf_dir))
