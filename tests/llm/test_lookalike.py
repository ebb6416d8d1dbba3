"""Problem 5: forms that look alike, and what must stay."""

import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from turnloom.llm.forms import Forms
from turnloom.llm.lookalike import code_points, one_form

ANY = Forms()
SAME = ["m² “q” … Δ = 9 — 🙂 ½", "Я хотел deadline а Mevgal", "straße ñ ç œ", "Poltamとの契約。", "👨‍👩‍👧 ok️", "У Mevgal есть карта", "a\tb\nc", ""]
CHANGED = {"Ηaνe yоu": "Have you", "ｑｕａ　ｃｈỗ": "qua chỗ", "ﬁne": "fine", "t​he soft­ly": "the softly", "cuối": "cuối", "cuối": "cuối", "が": "が", "a b c": "a b c", "ðã đi": "đã đi", "а table is here": "a table is here"}


@pytest.mark.parametrize("text", SAME)
def test_stays(text):
    assert ANY.canonical(text) == text


@pytest.mark.parametrize("text", CHANGED)
def test_changes(text):
    assert ANY.canonical(text) == CHANGED[text]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=30))
def test_is_stable(text):
    once = ANY.canonical(text)
    assert ANY.canonical(once) == once and unicodedata.normalize("NFC", once) == once


def test_frame(spark):
    texts = [None, "", *SAME, *CHANGED, "x" * 20_000 + "ｙ", "đ đ đ"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").withColumn("pos", F.lit("clash"))
    forms = Forms(code_points(df))
    got = {r.i: (r.canonical, r.changed) for r in one_form(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i] == ((None, False) if t is None else (forms.canonical(t), forms.canonical(t) != t))
    assert got[1] == ("", False) and one_form(df.limit(0)).count() == 0


@pytest.mark.parametrize("mixed, plain", [("г\u03bfрод", "город"), ("\u03c1аз, два", "раз, два"), ("λ\u043eγος", "λογος")])
def test_cyrillic_beside_greek_is_suspect(spark, mixed, plain):
    df = spark.createDataFrame([(mixed,)], "text string")
    row = one_form(df, forms=ANY).first()
    assert ANY.canonical(mixed) == row.canonical == plain and row.changed
