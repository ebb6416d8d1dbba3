"""Columns that are computed once, whatever reads them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bound(rows: DataFrame, **columns: Column) -> DataFrame:
    """``rows`` with new columns, each of which may read those before it.

    A plain projection is written out again in every filter and generator that
    reads it: an explode alone asks for the size of its array, which costs a long
    expression twice more.  A generator of one row is not.
    """
    for name, column in columns.items():
        rows = rows.select("*", F.explode_outer(F.array(column)).alias(name))
    return rows
