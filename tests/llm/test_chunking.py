"""Problem 3: limits, overlaps, boundaries and the reach of an edit."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from turnloom.llm.chunking import pieces, split_oversized


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=400), st.integers(8, 60), st.data())
def test_pieces_rejoin(text, limit, data):
    overlap = data.draw(st.integers(0, (limit - 1) // 2))
    got = pieces(text, limit, overlap)
    assert all(b - a <= limit for a, b in got)
    assert all(d == b - overlap for (_, b), (d, _) in zip(got, got[1:]))
    assert "".join(text[a + (overlap if i else 0) : b] for i, (a, b) in enumerate(got)) == text


def prose(n, seed=0):
    rnd = random.Random(seed)
    return " ".join(" ".join(rnd.choice(["so", "then", "walked", "away", "home"]) for _ in range(rnd.randint(4, 14))).capitalize() + "." for _ in range(n))


def test_ends_at_sentences():
    text = prose(300)
    assert all(text[:b].rstrip().endswith(".") for _, b in pieces(text, 400, 40)[:-1])


def test_edits_stay_local():
    text = prose(600)
    a = {text[x:y] for x, y in pieces(text, 400, 40)}
    edited = text[:3000] + "Oh well. " + text[3000:]
    b = {edited[x:y] for x, y in pieces(edited, 400, 40)}
    assert len(b - a) <= 0.35 * len(b)


def test_no_boundaries():
    assert [b - a for a, b in pieces("x" * 950, 400, 40)][0] <= 400
    with pytest.raises(ValueError):
        pieces("abc", 10, 5)


def test_frame(spark):
    df = spark.createDataFrame([(1, "a" * 50, 20, 4), (2, None, 20, 4), (3, "", 20, 4), (4, "b" * 20, 20, 4), (5, "c" * 30, None, 4)], "k int, t string, l int, o int").withColumn("x", F.lit(1))
    rows = split_oversized(df, "t", "l", "o").collect()
    assert {r.k for r in rows} == {1} and {r.x for r in rows} == {1}
    assert split_oversized(df.limit(0), "t", "l", "o").count() == 0
