"""Session helpers: table access, checkpoints and the test session."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, Row, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One corpus table, a Parquet file or folder below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints.

    The cluster names it in ``spark.checkpoint.dir``.  Only where that is unset on
    a local master (tests, a laptop) a local folder is made; on a cluster a folder
    of one machine would lose rows, so an unset folder is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if named:
        if not current.isDefined():
            sc.setCheckpointDir(named)
        return named
    if not current.isDefined():
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="turnloom-"))
    return sc._jsc.sc().getCheckpointDir().get()


def few(df: DataFrame, most: int, what: str) -> list[Row]:
    """The rows of a table that is small by nature; an error, not a cut, if it holds more than ``most``."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} {what}")
    return rows


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder, without its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def local_session(cpus: str | int | None = None, shuffle: int = 8) -> SparkSession:
    """A local session for tests and the bench."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("turnloom")
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
