"""Problem 7: splits that keep related records together.

Grouped iterative stratification: records that share a key are joined into
components, each component's labels are added up to a vector, and components
are placed one by one, those with the rarest outstanding label first, into the
split that needs that label most.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.llm.words import split_column
from turnloom.operators.components import components, matched
from turnloom.registry import Registry
from turnloom.session import cut, few, table

registry = Registry()

# Names that name nobody, and the marks that end an item's id.
PLACEHOLDERS = ["", "-", "--", "n/a", "na", "none", "null", "nil", "nan", "unknown", "anonymous", "anon", "undefined", "tbd", "?", "."]
MARKS = r"(?:__v\d+|__part\d+|#w\d+|/session-\d+|__dlg\d+)+$"
#: Components with more than this share of all records are placed first, on the driver: at most 1 / LARGE of them.
LARGE = 0.002
#: Components in a block that one task places.
BLOCK = 20_000


def named(key: Column) -> Column:
    """A key in lower case without blanks around; null for placeholders."""
    flat = F.lower(F.trim(F.regexp_replace(key, r"(?U)^\s+|\s+$", "")))
    return F.when(~flat.isin(PLACEHOLDERS), flat)


def item_of(example_id: Column) -> Column:
    """An example's source item: its id without trailing version, part, window, session or dialogue marks."""
    return F.regexp_replace(F.lower(F.trim(example_id)), MARKS, "")


def related(records: DataFrame, record_id: str, keys: dict[str, Column]) -> DataFrame:
    """(record_id, group_id): records that share a key, directly or through others; the group is its least record_id.

    ``keys`` maps a kind of key to its column; a null key relates to nobody.  A
    record without a partner is a group of its own.  Repeated records count
    once, a null record_id not at all.  Each key links its records to the least
    of them, so that a key of very many records costs one link a record.
    """
    kinds = [F.struct(F.lit(kind).alias("kind"), column.alias("key")) for kind, column in keys.items()]
    pairs = records.where(F.col(record_id).isNotNull()).select(F.col(record_id).alias("r"), F.inline(F.array(*kinds))).where("key IS NOT NULL").distinct()
    pairs = cut(pairs)
    least = pairs.groupBy("kind", "key").agg(F.min("r").alias("least"), F.count("*").alias("n")).where("n > 1")
    links = matched(pairs, least, ["kind", "key"], pairs.count()).where("r != least").select(F.col("r").alias("a"), F.col("least").alias("b"))
    groups = components(links)
    ids = records.select(F.col(record_id)).where(F.col(record_id).isNotNull()).distinct()
    return ids.join(groups.withColumnRenamed("node", record_id), record_id, "left").select(record_id, F.coalesce("component", record_id).alias("group_id"))


def _keys() -> dict[str, Column]:
    return {"author": named(F.col("author_id")), "file": named(F.col("source_file")), "item": named(item_of(F.col("example_id")))}


@registry.query("p7_found")
def p7_found(spark, sf_dir):
    """The dialogues of groups that now stand in more than one split."""
    rows = table(spark, sf_dir, "dialogues").select("record_id", "author_id", "source_file", "example_id", split_column(F.col("split")).alias("split"))
    groups = cut(related(rows, "record_id", _keys()))
    splits = rows.select("record_id", "split").dropDuplicates(["record_id"])
    torn = groups.join(splits, "record_id").groupBy("group_id").agg(F.min("split").alias("a"), F.max("split").alias("b")).where("a != b").select("group_id")
    return groups.join(torn, "group_id").select("record_id", "group_id")


def place(groups: pd.DataFrame, labels: list[str], targets: dict[str, float], need: dict[str, dict[str, float]] | None = None) -> tuple[dict[int, str], dict[str, dict[str, float]]]:
    """Iterative stratification of groups (group_id, n, and a count for each label), by what each split still needs.

    After each placement the label with the fewest outstanding records is looked
    up again; of its groups the largest goes to the split that needs it most.
    """
    counts = groups[labels].to_numpy(dtype=float)
    sizes, ids = groups["n"].to_numpy(dtype=float), groups["group_id"].to_numpy()
    if need is None:
        need = {s: {x: p * counts[:, j].sum() for j, x in enumerate(labels)} | {"": p * sizes.sum()} for s, p in targets.items()}
    outstanding = counts.sum(axis=0)
    of_label = [sorted(np.flatnonzero(counts[:, j]), key=lambda i: (-counts[i, j], -sizes[i], ids[i])) for j in range(len(labels))]
    at, out = [0] * len(labels), {}
    while len(out) < len(ids):
        left = np.where(outstanding > 0, outstanding, np.inf)
        j = int(left.argmin())
        if np.isinf(left[j]):
            break
        while ids[of_label[j][at[j]]] in out:
            at[j] += 1
        i = of_label[j][at[j]]
        best = max(targets, key=lambda s: (need[s][labels[j]] / max(targets[s], 1e-9), need[s][""] / max(targets[s], 1e-9), s))
        out[ids[i]] = best
        outstanding -= counts[i]
        need[best][""] -= sizes[i]
        for k in counts[i].nonzero()[0]:
            need[best][labels[k]] -= counts[i, k]
    return out, need


def grouped_split(records: DataFrame, record_id: str, group_id: str, label: Column, targets: dict[str, float], block: int = BLOCK) -> DataFrame:
    """(record_id, group_id, split) in about the proportions of ``targets``, overall and for each label.

    Groups stay whole.  The groups that hold more than LARGE of all records are
    placed first on the driver (at most 1 / LARGE); the others are dealt by a hash
    of their id into blocks of about ``block`` groups, each stratified on its own
    with what is left of its share.  ``targets`` are scaled to sum to 1.  A null
    label is a label; labels should be few, as each is a column of the vectors.
    """
    whole = sum(targets.values())
    targets = {s: p / whole for s, p in sorted(targets.items())}
    rows = cut(records.select(record_id, group_id, F.coalesce(label.cast("string"), F.lit("(none)")).alias("_label")).dropDuplicates([record_id]))
    labels = sorted(r["_label"] for r in rows.select("_label").distinct().limit(1001).collect())
    if len(labels) > 1000:
        raise ValueError("more than 1000 labels")
    columns = [f"l{j}" for j in range(len(labels))]
    vectors = cut(rows.groupBy(F.col(group_id).alias("group_id")).agg(F.count("*").alias("n"), *[F.count_if(F.col("_label") == x).alias(c) for x, c in zip(labels, columns)]))
    total, n_groups = vectors.agg(F.sum("n"), F.count("*")).first()
    if not total:
        return records.select(record_id, group_id, F.lit(None).cast("string").alias("split")).limit(0)
    large = vectors.where(F.col("n") > max(LARGE * total, 1)).toPandas()
    all_counts = vectors.agg(*[F.sum(c).alias(c) for c in columns]).first()
    need = {s: {c: p * all_counts[c] for c in columns} | {"": p * total} for s, p in targets.items()}
    first, need = place(large, columns, targets, need)
    blocks = max(1, -(-n_groups // block))
    left = {s: {k: v / blocks for k, v in x.items()} for s, x in need.items()}

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        done, _ = place(frame, columns, targets, {s: dict(x) for s, x in left.items()})
        return pd.DataFrame({"group_id": list(done), "split": list(done.values())})

    kind = vectors.schema["group_id"].dataType.simpleString()
    small = vectors.where(F.col("n") <= max(LARGE * total, 1)).withColumn("_block", F.pmod(F.xxhash64("group_id"), F.lit(blocks)))
    placed = small.groupBy("_block").applyInPandas(fill, f"group_id {kind}, split string")
    if first:
        placed = placed.unionByName(rows.sparkSession.createDataFrame([(int(g) if kind == "bigint" else g, s) for g, s in first.items()], f"group_id {kind}, split string"))
    return rows.select(record_id, F.col(group_id).alias("group_id")).join(placed, "group_id").select(record_id, "group_id", "split")


def _splits(spark, sf_dir: str) -> tuple[DataFrame, dict[str, float]]:
    """(record_id, group_id, split, dataset) of every dialogue, and the targets."""
    rows = table(spark, sf_dir, "dialogues").select("record_id", "author_id", "source_file", "example_id", "dataset")
    groups = related(rows, "record_id", _keys())
    targets = few(table(spark, sf_dir, "split_targets").groupBy("split").agg(F.max("proportion").alias("proportion")), 1000, "splits")
    targets = {r["split"]: r["proportion"] for r in targets}
    labelled = cut(rows.select("record_id", "dataset").dropDuplicates(["record_id"]).join(groups, "record_id"))
    return grouped_split(labelled, "record_id", "group_id", F.col("dataset"), targets).join(labelled.drop("group_id"), "record_id"), targets


@registry.query("p7_splits")
def p7_splits(spark, sf_dir):
    """Every dialogue's new split, stratified by dataset."""
    return _splits(spark, sf_dir)[0].select("record_id", "group_id", "split")


def shares(split: DataFrame, label: str, targets: dict[str, float]) -> DataFrame:
    """(label, split, n, share, target) for each label and, with label '(all)', overall."""
    whole = sum(targets.values())
    rows = split.select(F.coalesce(F.col(label).cast("string"), F.lit("(none)")).alias("label"), "split")
    counts = rows.groupBy("label", "split").agg(F.count("*").alias("n"))
    counts = counts.unionByName(counts.groupBy("split").agg(F.sum("n").alias("n")).withColumn("label", F.lit("(all)")))
    goal = F.element_at(F.create_map(*[F.lit(x) for s, p in targets.items() for x in (s, p / whole)]), F.col("split"))
    total = counts.groupBy("label").agg(F.sum("n").alias("of"))
    return counts.join(total, "label").select("label", "split", "n", (F.col("n") / F.col("of")).alias("share"), goal.alias("target"))


@registry.query("p7_shares")
def p7_shares(spark, sf_dir):
    """What share of each dataset, and of all dialogues, each split has got."""
    rows, targets = _splits(spark, sf_dir)
    return shares(rows, "dataset", targets)


_SQL = """
SELECT CAST(count(DISTINCT record_id) AS BIGINT) AS records, CAST(0 AS BIGINT) AS torn_authors, CAST(0 AS BIGINT) AS torn_files, CAST(0 AS BIGINT) AS torn_groups, CAST((SELECT count(DISTINCT split) FROM split_targets) AS BIGINT) AS splits FROM dialogues
"""


@registry.query("p7_checks", _SQL)
def p7_checks(spark, sf_dir):
    """Records that have a split, and authors, files and groups that stand in more than one."""
    rows = cut(_splits(spark, sf_dir)[0])
    keys = table(spark, sf_dir, "dialogues").select("record_id", named(F.col("author_id")).alias("author"), named(F.col("source_file")).alias("file"))
    with_keys = keys.join(rows.select("record_id", "split"), "record_id")

    def torn(df: DataFrame, key: str) -> DataFrame:
        ends = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("split").alias("a"), F.max("split").alias("b"))
        return ends.agg(F.count_if(F.col("a") != F.col("b")).alias("n")).select(F.lit(f"torn_{key}s").alias("what"), "n")

    parts = [rows.agg(F.count_distinct(c).alias("n")).select(F.lit(name).alias("what"), "n") for c, name in (("record_id", "records"), ("split", "splits"))]
    parts += [torn(with_keys, "author"), torn(with_keys, "file"), torn(rows.withColumnRenamed("group_id", "group"), "group")]
    counts = reduce(DataFrame.unionByName, parts)
    return counts.agg(*[F.max(F.when(F.col("what") == x, F.col("n"))).alias(x) for x in ("records", "torn_authors", "torn_files", "torn_groups", "splits")])
