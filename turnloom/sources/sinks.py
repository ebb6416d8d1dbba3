"""Writers: partitioned tables, release files, one file for each dialogue, and work queues."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from turnloom.functions import text as X
from turnloom.operators.guards import require_none, require_some
from turnloom.sources.manifests import resolved


#: Rows of a file, about; a partition gets as many files as its rows need.
FILE_ROWS = 1_000_000


def write_table(rows: DataFrame, path: str, by: list[str], mode: str = "overwrite", file_rows: int = FILE_ROWS) -> None:
    """Parquet partitioned by ``by``; a partition is spread by a hash over as many files as its rows need, so that no task writes a hot one alone."""
    counts = rows.groupBy(*by).agg(F.count("*").alias("_n"))
    files = counts.select(*[F.col(c).alias(f"_{c}_") for c in by], F.ceil(F.col("_n") / file_rows).alias("_files"))
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}_"))
    # one row for each partition of the table, which is a folder each
    spread = rows.join(F.broadcast(files), same).drop(*[f"_{c}_" for c in by])
    spread = spread.repartition(*by, F.pmod(F.xxhash64(*[c for c in rows.columns if c not in by][:1]), F.col("_files")))
    spread.drop("_files").write.mode(mode).partitionBy(*by).parquet(path)


#: Default roots of what is unpacked: both kinds write the same folders below, so they must not share one.
ROOTS = {"dialogues": "data-dialogues", "annotations": "data-annotations"}


def release_path(root: str, kind: str, code: str, split: str) -> str:
    """Where the JSON lines of one kind, code and split are: ``<root>/<kind>/code=<code>/split=<split>``; codes are case-sensitive."""
    if kind not in ROOTS:
        raise ValueError(f"unknown kind {kind!r}; expected one of {sorted(ROOTS)}")
    return f"{root}/{kind}/code={code}/split={split}"


def write_release(rows: DataFrame, path: str, kind: str, mode: str = "overwrite") -> None:
    """JSON lines in a folder for each (kind, code, split); ``rows`` has code and split."""
    release_path(path, kind, "", "")
    rows.write.mode(mode).option("ignoreNullFields", False).partitionBy("code", "split").json(f"{path}/{kind}")


def read_release(spark: SparkSession, root: str, kind: str, schema: StructType, code: str | None = None, split: str | None = None) -> DataFrame:
    """The rows of a release, with code and split; folders of other codes and splits are not read."""
    rows = spark.read.schema(schema.add("code", "string").add("split", "string")).json(f"{root}/{kind}")
    if code is not None:
        rows = rows.where(F.col("code") == code)
    return rows if split is None else rows.where(F.col("split") == split)


def unpack_root(kind: str, given: str | None = None) -> str:
    """The root below which dialogues of a kind are unpacked: the one given, else the kind's own."""
    if kind not in ROOTS:
        raise ValueError(f"unknown kind {kind!r}; expected one of {sorted(ROOTS)}")
    return given or ROOTS[kind]


def output_folder(root: str, dataset: str, split: str, kind: str) -> str:
    """Where a stage writes: parsed sources and rewritten dialogues never share a folder (K4)."""
    if kind == "parsed":
        return f"{root}/parsed_source/{safe_name(dataset)}/{safe_name(split)}"
    if kind in ("text", "audio"):
        return f"{root}/{kind}_dialogue_{safe_name(dataset)}/{safe_name(split)}"
    raise ValueError(f"unknown kind of output {kind!r}")


def write_queue(rows: DataFrame, path: str, mode: str = "overwrite", violations: DataFrame | None = None) -> None:
    """A work queue as JSON lines, nulls kept; ``violations`` (rule, n) are looked at first, and any is an error (V1)."""
    if violations is not None:
        require_none(violations)
    rows.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_evaluation(samples: DataFrame, path: str, divergence: str = "kl", status: str = "status", mode: str = "overwrite") -> None:
    """An evaluation: ``<path>/samples`` with every row and ``<path>/summary`` with one; an error if every row fell back."""
    require_some(samples, F.col(status) == "ok", "usable prediction")
    samples.write.mode(mode).option("ignoreNullFields", False).json(f"{path}/samples")
    summary = samples.agg(F.count("*").alias("n"), F.count_if(F.col(status) != "ok").alias("n_fallback"), F.avg(divergence).alias(f"mean_{divergence}"))
    summary.write.mode(mode).json(f"{path}/summary")


def write_alignment(turns: DataFrame, path: str, by: list[str], order: list[str], mode: str = "overwrite") -> None:
    """A timeline for each key of ``by`` as JSON: its rows in ``order`` as an array; audio itself is written by the renderer (K7)."""
    rest = [c for c in turns.columns if c not in by]
    row = F.struct(*order, *[c for c in rest if c not in order])
    turns.groupBy(*by).agg(F.array_sort(F.collect_list(row)).alias("turns")).write.mode(mode).option("ignoreNullFields", False).json(path)


def safe_name(name: str) -> str:
    return re.sub(r"[^\w\-.]", "_", name)


def write_each(rows: DataFrame, root: str, key: str, skip_existing: bool = True) -> None:
    """A JSON file for each row at ``<root>/<dataset>/<split>/<key>.json`` of a folder that all executors share.

    Files appear whole or not at all; with ``skip_existing`` a resumed run writes
    the missing ones only.
    """

    def write(part: Iterator[Row]) -> None:
        for r in part:
            d = r.asDict(recursive=True)
            folder = os.path.join(root, safe_name(str(d.get("dataset") or "none")), safe_name(str(d.get("split") or "none")))
            os.makedirs(folder, exist_ok=True)
            path = os.path.join(folder, f"{safe_name(str(d[key]))}.json")
            if skip_existing and os.path.exists(path):
                continue
            temporary = f"{path}.{os.getpid()}.part"
            with open(temporary, "w", encoding="utf-8") as f:
                json.dump(d, f, ensure_ascii=False, indent=2, default=str)
            os.replace(temporary, path)

    rows.foreachPartition(write)


def pending(rows: DataFrame, done: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Rows whose key isn't done; the limit comes after, as it counts pending rows."""
    left = rows.join(done.select(key).distinct(), key, "left_anti")
    return left if limit is None else left.orderBy(key).limit(limit)


def pool_names(rows: DataFrame, name: str) -> DataFrame:
    """Rows with ``stem``: a file-safe stem, with _2, _3 ... where several share one, whatever the case."""
    stem = X.safe_stem(F.col(name))
    n = F.row_number().over(Window.partitionBy(F.lower("_stem")).orderBy(name))
    return rows.withColumn("_stem", stem).withColumn("_n", n).withColumn("stem", F.when(F.col("_n") == 1, F.col("_stem")).otherwise(F.concat("_stem", F.lit("_"), F.col("_n").cast("string")))).drop("_stem", "_n")


def pool_plan(entries: DataFrame, files: DataFrame, existing: DataFrame, overwrite: bool = False, limit: int | None = None) -> DataFrame:
    """(file, path, stem, action) for each entry of a manifest: missing, skip, write, or beyond the limit of those written.

    ``entries`` have file and transcript, ``files`` path, ``existing`` stem.  Nothing
    is done: the plan is the dry run, and its rows to write are the run.
    """
    found = resolved(entries.select("file"), "file", files, "path").where("path IS NOT NULL").distinct()
    named = pool_names(found, "file")
    there = existing.select(F.lower("stem").alias("_there")).distinct()
    told = named.join(there, F.lower("stem") == F.col("_there"), "left")
    told = told.select("file", "path", "stem", F.when(F.col("_there").isNotNull() & F.lit(not overwrite), "skip").otherwise("write").alias("action"))
    if limit is not None:
        first = told.where("action = 'write'").orderBy("file").limit(limit).select("file").withColumn("_in", F.lit(True))
        told = told.join(first, "file", "left").withColumn("action", F.when((F.col("action") == "write") & F.col("_in").isNull(), "beyond").otherwise(F.col("action"))).drop("_in")
    missing = entries.select("file").distinct().join(told.select("file"), "file", "left_anti")
    none = F.lit(None).cast("string")
    return told.unionByName(missing.select("file", none.alias("path"), none.alias("stem"), F.lit("missing").alias("action")))


#: The rules by which a stage takes a key as done.
RESUME = {
    "exists": lambda done: F.lit(True),
    "spoken": lambda done: done["style"] == "spoken",
    "complete": lambda done: done["artefacts"] >= done["expected"],
    "rendered": lambda done: F.coalesce(done["size"], F.lit(0)) > 0,
}


def unfinished(rows: DataFrame, done: DataFrame, key: str, rule: str = "exists", limit: int | None = None) -> DataFrame:
    """Rows whose key no row of ``done`` finishes by a rule of RESUME; the limit counts what is left."""
    return pending(rows, done.where(F.coalesce(RESUME[rule](done), F.lit(False))), key, limit)
