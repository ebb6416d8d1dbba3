"""Problem 4 on held-out texts and edge cases."""

import random

from pyspark.sql import functions as F

from turnloom.llm import langid as P

WORDS = {
    "en": "the house is where they would like to live with their friends".split(),
    "vi": "tôi không biết người đó có muốn được đi cùng với mình".split(),
    "es": "pero nosotros queremos vivir cerca del mercado porque hay muchos amigos".split(),
    "ru": "мы хотели бы жить рядом с рынком потому что там друзья".split(),
    "ja": ["私は東京に住んでいます", "友だちと昼ごはんを食べました", "新しい本を読みたいです"],
}


def sentence(lang, rnd, n=8):
    if lang == "ja":
        return rnd.choice(WORDS["ja"]) + "。"
    return " ".join(rnd.choice(WORDS[lang]) for _ in range(n)).capitalize() + "."


def fitted():
    rnd = random.Random(0)
    rows = [(lang, sentence(lang, rnd)) for lang in WORDS for _ in range(300)]
    # one label in twelve is wrong
    return P.fit([(rnd.choice(list(WORDS)) if rnd.random() < 1 / 12 else a, b) for a, b in rows])


def test_held_out():
    f, rnd = fitted(), random.Random(9)
    for lang in WORDS:
        for _ in range(40):
            assert [s[0] for s in f.segments([sentence(lang, rnd)])] == [lang]


def test_segments():
    f, rnd = fitted(), random.Random(4)
    got = f.segments([sentence("en", rnd) + " " + sentence("en", rnd), sentence("ru", rnd), sentence("ja", rnd)])
    assert [(a, n) for a, _, n in got] == [("en", 2), ("ru", 1), ("ja", 1)] and all(c > 0.5 for _, c, _ in got)
    assert [s[0] for s in f.segments(["Toi khong biet nguoi do co muon di cung voi minh."])] == ["vi"]


def test_nothing_to_tell():
    f = fitted()
    for text in ("", "Um, hmm. Uh.", "12 345.", "Quinbrak 12, Zarvormund 87, Tursolbel 375", "34a6c3ahahf40e05203na6d33079fc6a8 ohoha16cd3aa", "[PAUSE] [laughter]"):
        assert f.segments([text]) == []


def test_labels(spark):
    df = spark.createDataFrame([(x,) for x in ("en-US", "English", "VI", "vie", "pt_BR", "", "unknown", "und", None, "zh")], "x string")
    assert [r[0] for r in df.select(P.label_language(F.col("x"))).collect()] == ["en", "en", "vi", "vi", "pt", None, None, None, None, "zh"]


def test_frame(spark):
    df = spark.createDataFrame([(1, ["The house is where they live.", None]), (2, None), (3, [])], "row_id bigint, parts array<string>").withColumn("lang", F.lit("x"))
    got = {r.row_id: len(r.segments) for r in P.language_segments(df, fitted()).collect()}
    assert got == {1: 1, 2: 0, 3: 0}
    assert P.language_segments(df.limit(0), fitted()).count() == 0 and P.fit([]).segments(["hello there"]) == []


def test_sample_is_bounded(spark):
    df = spark.range(2000).select(F.col("id").alias("row_id"), F.lit("en").alias("label"), F.lit("a b").alias("text"))
    assert 50 < len(P.sample(df, 100)) < 200 and P.sample(df.limit(0)) == []


def test_sampled_texts_are_whole(spark):
    long = "a b " * 2000
    df = spark.createDataFrame([(1, "en", long)], "row_id bigint, label string, text string")
    assert P.sample(df, 1) == [("en", long)]
