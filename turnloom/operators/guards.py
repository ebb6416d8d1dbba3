"""Guards that end a run early, and states that tell why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Aborted(RuntimeError):
    """A run that must not go on."""


def require_rows(rows: DataFrame, what: str) -> DataFrame:
    """``rows``, or an error if there are none; at most one row is read."""
    if rows.isEmpty():
        raise Aborted(f"no {what}")
    return rows


def require_some(rows: DataFrame, good: Column, what: str) -> DataFrame:
    """``rows``, or an error if none of them is ``good``: an evaluation of fallbacks only, or a rendering of nothing."""
    if rows.where(F.coalesce(good, F.lit(False))).isEmpty():
        raise Aborted(f"no {what} in any row")
    return rows


def require_none(violations: DataFrame, rule: str = "rule", n: str = "n") -> None:
    """An error that names each rule with a count above 0."""
    broken = violations.where(F.col(n) > 0).orderBy(rule).collect()
    if broken:
        raise Aborted("manifest validation: " + ", ".join(f"{r[rule]} ({r[n]})" for r in broken))


def fingerprint_state(size: Column, mtime: Column, there: Column, size_now: Column, mtime_now: Column) -> Column:
    """missing, changed or same: a recorded file against the one that is there; without a recorded size nothing is compared."""
    changed = (F.coalesce(size, F.lit(0)) != 0) & (~size_now.eqNullSafe(size) | ~mtime_now.eqNullSafe(mtime))
    return F.when(~there, "missing").when(changed, "changed").otherwise("same")
