"""Predicted against human distributions: normalisation, divergence, argmax, confusion and scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Label orders and spellings.
HEAD = ("backchannel", "interruption", "none")
CANONICAL = {"backchannel": "backchannel", "interruption": "floor_taking", "take_floor": "floor_taking", "floor_taking": "floor_taking", "none": "silence", "silent": "silence", "silence": "silence"}


def canonical_label(label: Column) -> Column:
    """The canonical spelling; an unknown label is an error, null stays null."""
    pairs = F.create_map(*[F.lit(x) for kv in CANONICAL.items() for x in kv])
    known = F.element_at(pairs, label)
    return F.when(label.isNull() | known.isNotNull(), known).otherwise(F.raise_error(F.concat(F.lit("unknown turn-taking label "), label)).cast("string"))


def renormed(a: Column, b: Column, c: Column) -> Column:
    """Three weights as a distribution; all of it on the third where they sum to nothing."""
    a, b, c = (F.coalesce(x, F.lit(0.0)) for x in (a, b, c))
    s = a + b + c
    return F.when(s <= 0, F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0))).otherwise(F.array(a / s, b / s, c / s))


def softmax(x: Column) -> Column:
    """The softmax of an array of logits."""
    top = F.array_max(x)
    e = F.transform(x, lambda v: F.exp(v - top))
    # the exponentials and their sum are bound once
    bound = F.transform(F.array(F.struct(e.alias("e"), F.aggregate(e, F.lit(0.0), lambda s, y: s + y).alias("s"))), lambda b: F.transform(b["e"], lambda v: v / b["s"]))
    return F.element_at(bound, 1)


def kl(human: Column, pred: Column, eps: float = 1e-12) -> Column:
    """KL divergence over the classes that humans use; predictions are held within [eps, 1]."""
    terms = F.zip_with(human, pred, lambda h, p: F.when(h > 0, h * F.log(h / F.least(F.greatest(p, F.lit(eps)), F.lit(1.0)))).otherwise(0.0))
    return F.aggregate(terms, F.lit(0.0), lambda s, y: s + y)


def batch_loss(rows: DataFrame, batch: str, target: Column, log_pred: Column) -> DataFrame:
    """(batch, n, loss): the mean over a batch's rows of the divergence of log-probabilities from a target distribution."""
    terms = F.zip_with(target, log_pred, lambda t, p: F.when(t > 0, t * (F.log(t) - p)).otherwise(0.0))
    loss = rows.select(batch, F.aggregate(terms, F.lit(0.0), lambda s, y: s + y).alias("_l"))
    return loss.groupBy(batch).agg(F.count("*").alias("n"), F.round(F.sum("_l") / F.count("*"), 6).alias("loss"))


def argmax(x: Column) -> Column:
    """The position from 0 of the greatest element; of ties the first."""
    return (F.array_position(x, F.array_max(x)) - 1).cast("int")


def confusion(rows: DataFrame, label: str, pred: str, labels: tuple[str, ...] = HEAD) -> DataFrame:
    """label, pred, n, share of the label's rows, for every pair of ``labels``, counted or not."""
    spark = rows.sparkSession
    grid = spark.createDataFrame([(a, b) for a in labels for b in labels], "label string, pred string")
    n = rows.groupBy(F.col(label).alias("label"), F.col(pred).alias("pred")).agg(F.count("*").alias("n"))
    full = F.broadcast(grid).join(n, ["label", "pred"], "left").select("label", "pred", F.coalesce("n", F.lit(0)).alias("n"))
    total = full.groupBy("label").agg(F.sum("n").alias("of"))
    return full.join(total, "label").select("label", "pred", "n", F.coalesce(F.try_divide(F.col("n").cast("double"), F.col("of")), F.lit(0.0)).alias("share"))


def scores(rows: DataFrame, label: str, pred: str, labels: tuple[str, ...] = HEAD) -> DataFrame:
    """One row: accuracy, precision, recall and F1 of each label (0 where undefined) and their macro F1."""
    ok = F.col(label) == F.col(pred)
    sums = [F.count("*").alias("n"), F.count_if(ok).alias("hit")]
    for i, x in enumerate(labels):
        sums += [F.count_if(ok & (F.col(label) == x)).alias(f"tp{i}"), F.count_if(F.col(pred) == x).alias(f"pp{i}"), F.count_if(F.col(label) == x).alias(f"lp{i}")]
    one = rows.agg(*sums)

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    cols, f1s = [F.round(ratio(F.col("hit"), F.col("n")), 9).alias("accuracy")], []
    for i, x in enumerate(labels):
        p, r = ratio(F.col(f"tp{i}"), F.col(f"pp{i}")), ratio(F.col(f"tp{i}"), F.col(f"lp{i}"))
        f1 = ratio(2 * p * r, p + r)
        f1s.append(f1)
        cols += [F.round(p, 9).alias(f"precision_{x}"), F.round(r, 9).alias(f"recall_{x}"), F.round(f1, 9).alias(f"f1_{x}")]
    return one.select(*cols, F.round(reduce(lambda a, b: a + b, f1s) / len(labels), 9).alias("macro_f1"))


def mean_embedding(rows: DataFrame, by: str, vector: str) -> DataFrame:
    """(by, dim, value): the mean of each group's vectors, scaled to length 1; means combine before the shuffle."""
    flat = rows.select(by, F.posexplode(vector).alias("dim", "x")).groupBy(by, "dim").agg(F.avg(F.col("x").cast("double")).alias("m"))
    norm = flat.groupBy(by).agg(F.sqrt(F.sum(F.col("m") * F.col("m"))).alias("norm"))
    return flat.join(norm, by).select(by, "dim", F.coalesce(F.try_divide(F.col("m"), F.col("norm")), F.lit(0.0)).alias("value"))


def windows(x: Column, size: int, step: int, least: float = 0.75) -> Column:
    """Overlapping windows of an array; the last one counts if it is covered by ``least``."""
    starts = F.filter(F.sequence(F.lit(0), F.greatest(F.size(x) - 1, F.lit(0)), F.lit(step)), lambda s: (s == 0) | ((F.size(x) - s) >= least * size))
    return F.transform(starts, lambda s: F.slice(x, s + 1, F.lit(size)))
