"""Problem 6: periods of speech and the gaps between them."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnloom.operators.intervals import periods_and_gaps, to_units
from turnloom.registry import Registry
from turnloom.session import table

registry = Registry()
ENTITY = ["dialogue_id", "variant_idx", "speaker"]

_UNITED_SQL = """
WITH i AS (
  SELECT DISTINCT dialogue_id, variant_idx, speaker,
         CAST(round(start_sec * 1000) AS BIGINT) AS s, CAST(round(end_sec * 1000) AS BIGINT) AS e
  FROM alignment_turns
  WHERE start_sec IS NOT NULL AND end_sec IS NOT NULL
    AND round(end_sec * 1000) >= round(start_sec * 1000)),
m AS (SELECT *, max(e) OVER (PARTITION BY dialogue_id, variant_idx, speaker ORDER BY s, e
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM i),
r AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END)
        OVER (PARTITION BY dialogue_id, variant_idx, speaker ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS run FROM m),
u AS (SELECT dialogue_id, variant_idx, speaker, min(s) AS start_ms, max(e) AS end_ms, count(*) AS n
        FROM r GROUP BY dialogue_id, variant_idx, speaker, run),
g AS (SELECT *, lead(start_ms) OVER (PARTITION BY dialogue_id, variant_idx, speaker ORDER BY start_ms) AS nxt FROM u)
"""


def _all(spark, sf_dir):
    rows = table(spark, sf_dir, "alignment_turns")
    return periods_and_gaps(rows, ENTITY, to_units(F.col("start_sec")), to_units(F.col("end_sec")))


@registry.query(
    "p6_found",
    _UNITED_SQL
    + """
SELECT dialogue_id, variant_idx, speaker, 'merged' AS kind, start_ms, end_ms FROM g WHERE n > 1
UNION ALL
SELECT dialogue_id, variant_idx, speaker, 'gap', end_ms, nxt FROM g WHERE nxt IS NOT NULL
""",
)
def p6_found(spark, sf_dir):
    """Periods made of two or more different intervals, and gaps between periods."""
    kind = F.when(F.col("kind") == "gap", "gap").otherwise("merged")
    return (
        _all(spark, sf_dir)
        .where("kind = 'gap' OR n_intervals > 1")
        .select(*ENTITY, kind.alias("kind"), F.col("start_u").alias("start_ms"), F.col("end_u").alias("end_ms"))
    )


@registry.query(
    "p6_timeline",
    _UNITED_SQL
    + """
SELECT dialogue_id, variant_idx, speaker, 'period' AS kind, start_ms, end_ms, CAST(n AS BIGINT) AS n_intervals FROM g
UNION ALL
SELECT dialogue_id, variant_idx, speaker, 'gap', end_ms, nxt, CAST(0 AS BIGINT) FROM g WHERE nxt IS NOT NULL
""",
)
def p6_timeline(spark, sf_dir):
    """Every continuous period and every gap of every dialogue, variant and speaker."""
    return _all(spark, sf_dir).select(*ENTITY, "kind", F.col("start_u").alias("start_ms"), F.col("end_u").alias("end_ms"), "n_intervals")
