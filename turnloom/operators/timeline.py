"""Timelines and placement: cumulative starts with gaps and overlaps, backchannels put where they fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Samples a second, and the gap, pause and overlap in seconds between consecutive utterances.
RATE, GAP_SEC, PAUSE_SEC, OVERLAP_SEC = 24_000, 0.16, 0.0, 0.45


def sampled_gap(u: Column, scale: float = GAP_SEC, least: float = 0.02, most: float = 1.0) -> Column:
    """An exponential gap in seconds from a uniform number, clipped, at four places."""
    return F.round(F.least(F.greatest(-scale * F.log(1 - u), F.lit(least)), F.lit(most)), 4)


def sampled_overlap(u: Column, v: Column, mean: float = OVERLAP_SEC, deviation: float = 0.05) -> Column:
    """A normal overlap in seconds from two uniform numbers, within 0 and 1, at four places."""
    z = F.sqrt(-2 * F.log(1 - u)) * F.cos(2 * F.pi() * v)
    return F.round(F.least(F.greatest(mean + deviation * z, F.lit(0.0)), F.lit(1.0)), 4)


def in_samples(seconds: Column) -> Column:
    return F.floor(seconds * RATE + 0.5).cast("bigint")


def repeats(words: Column) -> Column:
    """The places of words that equal the one before them."""
    return F.filter(F.transform(words, lambda w, i: F.when((i > 0) & (w == F.get(words, i - 1)), i)), lambda i: i.isNotNull())


def placed(rows: DataFrame, by: list[str], order: list[str], speaker: str, kind: str, length: str, gap: str | None = None, overlap: str | None = None) -> DataFrame:
    """``rows`` with ``timing`` and ``start_sample``: where each utterance of a dialogue starts.

    An interrupt by the other speaker overlaps the end of what is there by
    OVERLAP_SEC, at most by the shorter of the two; another change of speaker
    leaves a gap, the same speaker a pause.  ``length`` is in samples, as are the
    columns ``gap`` and ``overlap`` that may give each row its own.  The
    overlap depends on what was merged before, so a dialogue's utterances are
    folded in its row.
    """
    item = F.struct(*[F.col(c) for c in order], F.col(speaker).alias("_s"), F.col(kind).alias("_k"), F.col(length).cast("bigint").alias("_n"), (F.col(gap) if gap else F.lit(int(GAP_SEC * RATE))).cast("bigint").alias("_g"), (F.col(overlap) if overlap else F.lit(int(OVERLAP_SEC * RATE))).cast("bigint").alias("_o"))
    pause = int(PAUSE_SEC * RATE)
    out_type = "array<struct<" + ", ".join(f"{c}:{rows.schema[c].dataType.simpleString()}" for c in order) + ",timing:string,start_sample:bigint>>"
    speaker_type = rows.schema[speaker].dataType.simpleString()
    start = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(None).cast(speaker_type).alias("s"), F.lit(0).alias("i"), F.array().cast(out_type).alias("out"))

    def step(a: Column, x: Column) -> Column:
        other = ~x["_s"].eqNullSafe(a["s"])
        overlap = F.least(x["_o"], a["end"], x["_n"])
        first = a["i"] == 0
        cut = other & F.coalesce(x["_k"] == "interrupt", F.lit(False))
        timing = F.when(first, "none").when(cut, "overlap").when(other, "gap").otherwise("pause")
        at = F.when(first, F.lit(0).cast("bigint")).when(cut, a["end"] - overlap).when(other, a["end"] + x["_g"]).otherwise(a["end"] + pause)
        here = F.struct(*[x[c].alias(c) for c in order], timing.alias("timing"), at.alias("start_sample"))
        return F.struct((at + x["_n"]).alias("end"), x["_s"].alias("s"), (a["i"] + 1).alias("i"), F.concat(a["out"], F.array(here)).alias("out"))

    folded = rows.groupBy(*by).agg(F.array_sort(F.collect_list(item)).alias("_u"))
    return folded.select(*by, F.inline(F.aggregate("_u", start, step, lambda a: a["out"])))


def backchannels_placed(anchors: Column, lengths: Column, host: Column, interrupted: Column) -> Column:
    """(starts, length): where a host's backchannels start, and how long the host is then.

    Each starts at its anchor, or where the one before ends.  The last one makes
    the host longer if it doesn't fit, but is dropped (a null start) if the next
    utterance interrupts.
    """
    n = F.size(anchors)
    start = F.struct(F.lit(0).cast("bigint").alias("cursor"), F.lit(0).alias("i"), F.array().cast("array<bigint>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        at = F.greatest(x["p"], a["cursor"], F.lit(0).cast("bigint"))
        gone = interrupted & (a["i"] == n - 1) & (host - at - x["n"] <= 0)
        return F.struct(F.when(gone, a["cursor"]).otherwise(at + x["n"]).alias("cursor"), (a["i"] + 1).alias("i"), F.concat(a["out"], F.array(F.when(~gone, at))).alias("out"))

    pairs = F.zip_with(anchors, lengths, lambda p, k: F.struct(p.cast("bigint").alias("p"), k.cast("bigint").alias("n")))
    return F.aggregate(pairs, start, step, lambda a: F.struct(a["out"].alias("starts"), F.greatest(host, a["cursor"]).alias("length")))


def even_words(words: Column, start: Column, end: Column) -> Column:
    """Words with even times between ``start`` and ``end``, rounded to four places."""
    each = (end - start) / F.size(words)
    return F.transform(words, lambda w, i: F.struct(w.alias("word"), F.round(start + each * i, 4).alias("start"), F.round(start + each * (i + 1), 4).alias("end")))


def cumulative(rows: DataFrame, by: list[str], order: list[str], length: Column) -> DataFrame:
    """``rows`` with ``start`` and ``end`` by adding up lengths."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(length).over(w))
    return rows.withColumn("start", F.col("end") - length)
