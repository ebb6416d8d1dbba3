"""Words of dialogues and transcripts in comparable form."""

from __future__ import annotations

import re
from functools import cache


from turnloom.llm.forms import Forms

# The blocks of Japanese characters.
_JA = "\u3005\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0002fa1f"
_WORDS = re.compile(f"[{_JA}]|[^\\W_{_JA}]+")


@cache
def any_forms() -> Forms:
    """Look-alike classes that hold for any corpus."""
    return Forms()


def comparable_words(text: str) -> list[str]:
    """Words in one form and lower case; Japanese characters stand for words."""
    return _WORDS.findall(any_forms().canonical(text).lower())


# Spellings of the splits.
SPLITS = {"train": "train", "training": "train", "trn": "train", "val": "validation", "valid": "validation", "validation": "validation", "dev": "validation", "development": "validation", "eval": "validation", "test": "test", "testing": "test", "tst": "test"}


def split_column(spelled):
    """The split that a spelling names: train, validation, test or null."""
    from pyspark.sql import functions as F

    key = F.lower(F.regexp_replace(spelled, r"(?U)[^\p{L}]", ""))
    pairs = [F.lit(x) for kv in SPLITS.items() for x in kv]
    return F.element_at(F.create_map(*pairs), key)
