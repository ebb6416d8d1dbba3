"""Reproducible samples, quotas and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.session import cut


def numbered(rows: DataFrame, by: list[str], order: list[str], parts: int | None = None) -> DataFrame:
    """``rows`` with ``rn`` (from 0 in ``order``) and ``n``, within each group of ``by``.

    A group may hold a third of all rows, so none is sorted in one task: rows are
    parted by ranges of (by, order) and written, numbered within their part, and
    shifted by the counts of the parts before, of which a group has few.  Ties of
    ``order`` stand in one part, in no fixed order.  Null groups are groups.
    """
    spark = rows.sparkSession
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    # written, as a part's number must be the same wherever it is read
    parted = cut(rows.repartitionByRange(parts, *by, *order).withColumn("_part", F.spark_partition_id()))
    w = Window.partitionBy(*by)
    counts = parted.groupBy(*by, "_part").agg(F.count("*").alias("_k"))
    counts = counts.withColumn("n", F.sum("_k").over(w)).withColumn("_before", F.sum("_k").over(w.orderBy("_part")) - F.col("_k"))
    counts = counts.select(*[F.col(c).alias(f"_{c}_") for c in by], F.col("_part").alias("_of"), "n", "_before")
    own = parted.withColumn("_own", F.row_number().over(Window.partitionBy(*by, "_part").orderBy(*order)) - 1)
    same = F.col("_part") == F.col("_of")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}_"))
    return own.join(counts, same).withColumn("rn", F.col("_own") + F.col("_before")).drop("_part", "_of", "_own", "_before", *[f"_{c}_" for c in by])


def first(rows: DataFrame, by: list[str], order: list[str], k: int) -> DataFrame:
    """The first ``k`` rows of each group with ``rn`` from 0: every task keeps ``k`` of a group before anything is shuffled."""
    rn = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("rn", rn).where(F.col("rn") <= k).withColumn("rn", F.col("rn") - 1)


def evenly_spaced(rows: DataFrame, by: list[str], order: list[str], k: int | None) -> DataFrame:
    """``k`` rows of each group at even distances in ``order``; all of them if ``k`` is null, not positive, or no less than the group."""
    if k is None or k <= 0:
        return rows
    return numbered(rows, by, order).where(is_even(F.col("rn"), F.col("n"), k)).drop("rn", "n")


def is_even(rn: Column, n: Column, k: int) -> Column:
    """Whether row ``rn`` of ``n`` is among ``k`` at even distances."""
    # row rn is kept if some i < k has int(i * (n / k)) = rn: the least i that reaches rn decides
    step = n.cast("double") / k
    i = F.ceil(rn / step)
    return (n <= k) | F.exists(F.array(i - 1, i, i + 1), lambda j: (j >= 0) & (j < k) & (F.floor(j * step) == rn))


def halves(rows: DataFrame, by: list[str], order: list[str], train: int | None, test: int | None) -> DataFrame:
    """``train`` + ``test`` rows of each group at even distances with ``split``: the first ``train`` of them train.

    Without a limit on either side all rows stay and the first half of each group trains.
    """
    limited = bool(train and train > 0 and test and test > 0)
    rows = numbered(rows, by, order)
    if not limited:
        return rows.withColumn("split", F.when(F.col("rn") < F.floor(F.col("n") / 2), "train").otherwise("test")).drop("rn", "n")
    k = train + test
    kept = rows.where(is_even(F.col("rn"), F.col("n"), k))
    # the place among those kept: all of a small group, else the i with int(i * (n / k)) = rn
    step = F.col("n").cast("double") / k
    i = F.ceil(F.col("rn") / step)
    place = F.when(F.col("n") <= k, F.col("rn")).otherwise(F.array_min(F.filter(F.array(i - 1, i, i + 1), lambda j: (j >= 0) & (j < k) & (F.floor(j * step) == F.col("rn")))))
    return kept.withColumn("split", F.when(place < train, "train").otherwise("test")).drop("rn", "n")


def hash_split(name: Column, train: float) -> Column:
    """train or test, by the md5 of a name modulo 10,000."""
    digest = F.md5(name)
    folded = F.lit(0).cast("bigint")
    for k in range(4):
        word = F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint")
        folded = (folded * (2**32 % 10_000) + word) % 10_000
    return F.when(folded / 10_000 < train, "train").otherwise("test")


def hash_sample(rows: DataFrame, by: list[str], key: Column, rate: float) -> DataFrame:
    """max(1, round(n * rate)) rows of each group, those of least hash; half rounds to even."""
    ranked = numbered(rows.withColumn("_h", F.md5(key)), by, ["_h"])
    return ranked.where(F.col("rn") < F.greatest(F.bround(F.col("n") * rate), F.lit(1))).drop("_h", "n", "rn")


def batches(rows: DataFrame, by: list[str], order: list[str], length: Column, size: int, most: int) -> DataFrame:
    """``rows`` with ``oversize`` and ``batch``: ``size`` rows of a group each, in ``order``; rows longer than ``most`` alone.

    Batches are numbered from 0 within each group, oversized ones apart.
    """
    ranked = numbered(rows.withColumn("oversize", F.coalesce(length > most, F.lit(False))), [*by, "oversize"], order)
    return ranked.withColumn("batch", F.when(F.col("oversize"), F.col("rn")).otherwise(F.floor(F.col("rn") / size)).cast("bigint")).drop("rn", "n")
