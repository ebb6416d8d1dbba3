"""Overlapping and gapped time intervals as run bitmaps.

An interval [s, e] in exact time units is the set of bits 2s..2e on a half-unit
axis: intervals that touch share a bit, and one unit apart leaves one bit clear.
Each entity's axis is cut into shards of ``2**shard_bits`` bits.  In every
(entity, shard) the intervals are united into maximal runs of set bits, the run
containers of a compressed bitmap; the containers of an entity are then united,
set runs are its periods and the clear runs between them its gaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits in a shard: 2**22 half milliseconds are about 35 minutes.
SHARD_BITS = 22


def to_units(seconds: Column, per_second: int = 1000) -> Column:
    """Seconds as whole units; null for null, NaN and infinite values."""
    ok = ~F.isnan(seconds) & (F.abs(seconds) < F.lit(9.0e12))
    return F.when(ok, F.round(seconds * F.lit(per_second)).cast("bigint"))


def _runs(pieces: DataFrame, by: list[str]) -> DataFrame:
    """Maximal runs of adjacent or overlapping [first, last] within ``by``, with how many ``heads`` begin in each; the head of a repeated interval counts once."""
    w = Window.partitionBy(*by).orderBy("first", "last", "whole", "heads")
    reach = F.max("last").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col("first") > reach + 1), 1).otherwise(0)
    again = F.lit(True)
    for c in ("first", "last", "whole", "heads"):
        again = again & (F.lag(c).over(w) == F.col(c))
    again = F.coalesce(again, F.lit(False))
    marked = pieces.withColumn("_opens", opens).withColumn("_heads", F.when(again, 0).otherwise(F.col("heads")))
    run = F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return (
        marked.withColumn("_run", run)
        .groupBy(*by, "_run")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("_heads").alias("heads"))
        .drop("_run")
    )


def periods(df: DataFrame, entity: list[str], start: Column, end: Column, shard_bits: int = SHARD_BITS) -> DataFrame:
    """Continuous periods per entity: ``entity``, ``start_u``, ``end_u``, ``n_intervals``.

    ``start`` and ``end`` are whole units.  Intervals with a null bound or an end
    before the start don't count; an interval of length 0 is a period of its own
    unless it touches another.  Repeated intervals count once in ``n_intervals``.
    Null entity columns form an entity like any other value.  Empty in, empty out;
    columns beyond the entity's don't matter.

    An interval reaches at most three pieces whatever its length: its head and
    tail in their shards, and the full shards between as one run.  A long timeline
    is united shard by shard; only the first and the last run of a shard can go on
    in another, and only these meet, so no task holds an entity's runs.
    """
    bits = df.select(*entity, (start * 2).alias("a"), (end * 2).alias("b")).where("b >= a")
    width = 1 << shard_bits
    sa, sb = F.shiftright("a", shard_bits), F.shiftright("b", shard_bits)

    def piece(shard: Column, first: Column, last: Column, head: int) -> Column:
        return F.struct(shard.alias("shard"), first.alias("first"), last.alias("last"), F.lit(head).alias("heads"), F.col("b").alias("whole"))

    inside = F.array(piece(sa, F.col("a"), F.col("b"), 1))
    across = F.array(
        piece(sa, F.col("a"), (sa + 1) * width - 1, 1),
        piece(sb, sb * width, F.col("b"), 0),
        piece(sa + 1, (sa + 1) * width, sb * width - 1, 0),
    )
    cut = F.when(sa == sb, inside).when(sb == sa + 1, F.slice(across, 1, 2)).otherwise(across)
    shards = _runs(bits.select(*entity, F.inline(cut)), [*entity, "shard"])
    w = Window.partitionBy(*entity, "shard").orderBy("first")
    begins, ends = F.lag("first").over(w).isNull(), F.lead("first").over(w).isNull()
    placed = shards.select(*entity, "shard", "first", "last", "heads", begins.alias("_begins"), (begins | ends).alias("_edge"), F.max("last").over(Window.partitionBy(*entity, "shard")).alias("_reach"))
    # a shard that a run from an earlier one covers is within one period and counts as one run;
    # what earlier shards reach is carried along the first runs of shards alone
    along = Window.partitionBy(*entity, "_lane").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("_lane", F.when(~F.col("_begins"), F.col("shard"))).withColumn("_earlier", F.when(F.col("_begins"), F.max("_reach").over(along)))
    covered = F.max("_earlier").over(Window.partitionBy(*entity, "shard")) >= (F.col("shard") + 1) * width - 1
    placed = placed.withColumn("_covered", F.coalesce(covered, F.lit(False)))
    alone = F.when(~F.col("_covered"), F.col("first"))
    runs = placed.groupBy(*entity, "shard", alone.alias("_alone")).agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("heads").alias("heads"), F.max(F.col("_edge") | F.col("_covered")).alias("_edge"))
    # the runs at the ends of shards, and runs over several, are united over the entity, all others stay in their shard
    runs = runs.select(*entity, F.when(~F.col("_edge"), F.col("shard")).alias("_lane"), "first", "last", "heads", F.col("shard").alias("whole"))
    whole = _runs(runs, [*entity, "_lane"])
    return whole.select(*entity, (F.col("first") / 2).cast("bigint").alias("start_u"), (F.col("last") / 2).cast("bigint").alias("end_u"), F.col("heads").cast("bigint").alias("n_intervals"))


def _followed(united: DataFrame, entity: list[str], shard_bits: int = SHARD_BITS) -> DataFrame:
    """``united`` with ``_next``, the start of the period after each: of those that begin in the same shard, else of those first in a shard."""
    rows = united.withColumn("_shard", F.shiftright("start_u", max(shard_bits - 1, 0)))
    w = Window.partitionBy(*entity, "_shard").orderBy("start_u")
    near = F.lead("start_u").over(w)
    rows = rows.withColumn("_near", near).withColumn("_lane", F.when(~(F.lag("start_u").over(w).isNull() | near.isNull()), F.col("_shard")))
    # for the last period of a shard the next one at a shard's end is the first of a later shard
    later = F.lead("start_u").over(Window.partitionBy(*entity, "_lane").orderBy("start_u"))
    return rows.withColumn("_next", F.coalesce("_near", later)).drop("_shard", "_near", "_lane")


def gaps(united: DataFrame, entity: list[str], shard_bits: int = SHARD_BITS) -> DataFrame:
    """The clear runs between consecutive periods of each entity."""
    nxt = _followed(united, entity, shard_bits).where("_next IS NOT NULL")
    return nxt.select(*entity, F.col("end_u").alias("start_u"), F.col("_next").alias("end_u"))


def periods_and_gaps(df: DataFrame, entity: list[str], start: Column, end: Column, shard_bits: int = SHARD_BITS) -> DataFrame:
    """``periods`` (kind 'period') and ``gaps`` (kind 'gap') in one pass over the runs."""
    both = _followed(periods(df, entity, start, end, shard_bits), entity, shard_bits)

    def row(kind: str, a: str, b: str, n: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(a).alias("start_u"), F.col(b).alias("end_u"), n.alias("n_intervals"))

    rows = F.array(row("period", "start_u", "end_u", F.col("n_intervals")), row("gap", "end_u", "_next", F.lit(0).cast("bigint")))
    rows = F.when(F.col("_next").isNull(), F.slice(rows, 1, 1)).otherwise(rows)
    return both.select(*entity, F.inline(rows))
