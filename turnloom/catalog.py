"""All queries outside the training-data subpackage."""

from __future__ import annotations

from turnloom.plans import corpus, evaluation, examples, manifest, release, rendering, services, slots, speech_intervals, text, transcripts
from turnloom.registry import Query

MODULES = (speech_intervals, text, slots, corpus, evaluation, examples, manifest, rendering, release, transcripts, services)


def queries() -> dict[str, Query]:
    return {k: v for m in MODULES for k, v in m.registry.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.registry.sql.items()}
