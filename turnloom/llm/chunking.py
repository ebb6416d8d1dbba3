"""Problem 3: oversized texts cut into pieces at natural boundaries.

Content-defined chunking: a rolling hash over the characters puts landmarks
into the text, and each landmark snaps to the nearest natural boundary within
the least and greatest size of a piece.  Where to cut depends on nearby content
only, so an edit alters the pieces around it and the later cuts fall into step
again.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.registry import Registry
from turnloom.session import table

registry = Registry()

#: Characters under the rolling hash, and one landmark in so many characters.
SPAN, EVERY = 24, 64
#: Natural boundaries, the strongest first; a cut falls after the match.
BOUNDARIES = [
    regex.compile(r"\n\s*\n\s*|(?<=\S)\n+"),
    regex.compile(r"[.!?…]+[\"'”’)\]]*(?:\s+|$)|[。！？]+[」』）]*\s*"),
    regex.compile(r"[;:]\s+|[；：]"),
    regex.compile(r"[,、，]\s*(?!\d)|\s[-–—]+\s"),
    regex.compile(r"\s+"),
]


def rolling(text: str) -> np.ndarray:
    """A hash of the SPAN characters before each place 0..len(text)."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    out = np.zeros(len(points) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        mixed = (points + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(31)
        for k in range(min(SPAN, len(points))):
            out[k + 1 :] += mixed[: len(points) - k] * np.uint64(pow(0x100000001B3, k, 1 << 64))
        out ^= out >> np.uint64(33)
    return out


def boundaries(text: str) -> list[np.ndarray]:
    """The places of each strength at which the text may be cut, sorted."""
    return [np.array(sorted({m.end() for m in b.finditer(text)}), dtype=np.int64) for b in BOUNDARIES]


def _whole(text: str, at: int, least: int) -> int:
    """The last place up to ``at`` that doesn't part a character from its marks."""
    k = at
    while k > least and k < len(text) and (unicodedata.combining(text[k]) or text[k] in "‍️" or text[k - 1] == "‍"):
        k -= 1
    return k if k > least else at


def pieces(text: str, limit: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of consecutive pieces of at most ``limit`` characters, each starting ``overlap`` before the last one's end.

    A text within the limit is one piece, the empty text none.  The overlap must
    be less than half the limit.
    """
    if limit < 1 or overlap < 0 or 2 * overlap >= limit:
        raise ValueError("the overlap must be less than half the limit")
    if not text:
        return []
    if len(text) <= limit:
        return [(0, len(text))]
    hashes, places = rolling(text), boundaries(text)
    out, start = [], 0
    while len(text) - start > limit:
        low, high = start + max(overlap + 1, limit // 2), start + limit
        marks = low + np.flatnonzero(hashes[low : high + 1] % np.uint64(EVERY) == 0)
        # the landmark of the least hash is the same whatever came before it
        goal = int(marks[np.argmin(hashes[marks])]) if len(marks) else high
        end = 0
        for level in places:
            i, j = np.searchsorted(level, [low, high + 1])
            if j > i:
                near = level[i:j]
                end = int(near[np.argmin(np.abs(near - goal))])
                break
        end = end or _whole(text, goal, low)
        out.append((start, end))
        start = end - overlap
    return [*out, (start, len(text))]


def split_oversized(rows: DataFrame, text: str, limit: str, overlap: str) -> DataFrame:
    """The pieces of every text longer than its limit: the rows' other columns and piece_no, start, end, piece.

    ``limit`` and ``overlap`` are integer columns.  Characters are code points.
    A null text, or one within the limit or without a limit, gives no row.  Only
    oversized texts reach Python; the whole text is cut.
    """
    keep = [c for c in rows.columns if c not in (text, limit, overlap)]
    over = rows.where(F.length(text) > F.col(limit)).select(*keep, text, limit, overlap)
    schema = over.select(*keep).schema
    for name, kind in (("piece_no", "integer"), ("start", "integer"), ("end", "integer"), ("piece", "string")):
        schema = schema.add(name, kind)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(keep)
            of, no, a, b, piece = [], [], [], [], []
            for i, (t, most, share) in enumerate(zip(*(c.to_pylist() for c in batch.columns[n:]))):
                for k, (s, e) in enumerate(pieces(t, most, share or 0)):
                    of.append(i)
                    no.append(k)
                    a.append(s)
                    b.append(e)
                    piece.append(t[s:e])
            rest = [c.take(pa.array(of, pa.int32())) for c in batch.columns[:n]]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(no, pa.int32()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(piece, pa.string())], schema.names)

    return over.mapInArrow(cut, schema)


def _oversized(spark, sf_dir: str) -> DataFrame:
    """field_name, row_id, pos, text of every text with its limit; deliveries may repeat."""
    limits = table(spark, sf_dir, "size_limits").groupBy("field_name").agg(F.min("max_chars").alias("limit"), F.min_by("overlap_chars", "max_chars").alias("overlap"))
    rows = table(spark, sf_dir, "utterances")
    whole = F.array(F.struct(F.lit("utterance.tts_text").alias("field_name"), F.lit(0).alias("pos"), F.col("tts_text").alias("text")))
    units = F.transform(F.coalesce("units", F.array()), lambda u, i: F.struct(F.lit("unit.text").alias("field_name"), i.cast("int").alias("pos"), u["text"].alias("text")))
    texts = rows.select(F.col("utterance_id").alias("row_id"), F.inline(F.concat(whole, units)))
    least = F.broadcast(limits)  # one row for each field
    return texts.join(least, "field_name").select("field_name", "row_id", "pos", "text", "limit", "overlap")


def found_column() -> list[Column]:
    return [F.col("field_name"), F.col("row_id"), F.col("pos")]


_SQL = """
WITH u AS (SELECT DISTINCT utterance_id, tts_text, units FROM utterances),
t AS (SELECT 'utterance.tts_text' AS field_name, utterance_id AS row_id, CAST(0 AS INTEGER) AS pos, tts_text AS text FROM u
      UNION ALL
      SELECT 'unit.text', utterance_id, CAST(generate_subscripts(units, 1) - 1 AS INTEGER), unnest(units).text FROM u)
SELECT DISTINCT t.field_name, row_id, pos FROM t JOIN size_limits l ON l.field_name = t.field_name WHERE length(text) > max_chars
"""


@registry.query("p3_found", _SQL)
def p3_found(spark, sf_dir):
    """The texts that had to be cut."""
    cut = split_oversized(_oversized(spark, sf_dir), "text", "limit", "overlap")
    return cut.where("piece_no = 0").select(*found_column()).distinct()


@registry.query("p3_pieces")
def p3_pieces(spark, sf_dir):
    """The pieces of every oversized text."""
    return split_oversized(_oversized(spark, sf_dir), "text", "limit", "overlap").dropDuplicates(["field_name", "row_id", "pos", "piece_no"])


_CHECKS = f"""
WITH u AS (SELECT DISTINCT utterance_id, tts_text, units FROM utterances),
t AS (SELECT 'utterance.tts_text' AS field_name, tts_text AS text FROM u UNION ALL SELECT 'unit.text', unnest(units).text FROM u)
SELECT t.field_name, count(*) AS texts, CAST(sum(length(text)) AS BIGINT) AS characters, CAST(0 AS BIGINT) AS too_long, CAST(0 AS BIGINT) AS wrong_overlap, CAST(0 AS BIGINT) AS wrong_text
FROM t JOIN size_limits l ON l.field_name = t.field_name WHERE length(text) > max_chars GROUP BY t.field_name
"""


@registry.query("p3_checks", _CHECKS)
def p3_checks(spark, sf_dir):
    """Oversized texts and their characters as the pieces have them, and how many pieces are too long, don't share the overlap, or aren't what stands in their text."""
    texts = _oversized(spark, sf_dir).where(F.length("text") > F.col("limit")).dropDuplicates(["field_name", "row_id", "pos"])
    got = split_oversized(texts.withColumn("most", F.col("limit")).withColumn("share", F.col("overlap")).withColumn("own", F.col("text")), "text", "limit", "overlap")
    w = Window.partitionBy("field_name", "row_id", "pos").orderBy("piece_no")
    got = got.withColumn("_before", F.lag("end").over(w))
    fresh = F.col("end") - F.coalesce("_before", F.lit(0))
    return got.groupBy("field_name").agg(
        F.count_if(F.col("piece_no") == 0).alias("texts"), F.sum(fresh).cast("bigint").alias("characters"), F.count_if(F.length("piece") > F.col("most")).alias("too_long"),
        F.count_if(F.col("start") != F.coalesce(F.col("_before") - F.col("share"), F.lit(0))).alias("wrong_overlap"), F.count_if(F.substring(F.col("own"), F.col("start") + 1, F.col("end") - F.col("start")) != F.col("piece")).alias("wrong_text"),
    )
