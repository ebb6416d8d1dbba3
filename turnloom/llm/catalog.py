"""All queries of the training-data operators."""

from __future__ import annotations

from turnloom.llm import chunking, grouped_split, langid, lookalike, overlap, packing, quality, tokens, turns
from turnloom.registry import Query

MODULES = (overlap, turns, chunking, langid, lookalike, grouped_split, tokens, packing, quality)


def queries() -> dict[str, Query]:
    return {k: v for m in MODULES for k, v in m.registry.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.registry.sql.items()}
