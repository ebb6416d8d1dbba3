"""Problem 2 on small transcripts."""

from pyspark.sql import functions as F

from turnloom.llm import turns as P

SCHEMA = "line_id bigint, conversation_id string, utt int, da string, speaker string, text_raw string"


def found(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("words", F.lit("clash")).withColumn("nth", F.lit(3))
    t = P.turn_lines(df)
    g = t.groupBy("conversation_id", "turn_no").agg(F.first("speaker").alias("s"), F.min_by("line_id", "place"), F.max_by("line_id", "place"))
    return sorted(map(tuple, g.collect()), key=str)


def test_turns(spark):
    rows = [
        (1, "c", 1, "sd", "A", "00:05 - Hello, um there."), (1, "c", 1, "sd", "A", "00:05 - Hello, um there."),
        (2, "c", 2, "b", "B", "Uh-huh. /"), (3, "c", 3, "x", "@@B", "<laughter>"), (4, "c", 4, "sd", " a ", "and more -/"),
        (5, "c", 5, "sd", None, "(2:54) B: yes"), (6, "c", 6, "%", "Speaker A", "{F Um, } /"), (7, "c", 7, "sd", "caller_B", "[ I, + I ] go"),
        (8, "c", 8, None, "A:", None), (9, "c", 9, "sd", None, "who am I"), (10, "c", 10, "sd", "Ａ", "<179.23> ok"),
    ]
    assert found(spark, rows) == [("c", 0, "A", 1, 4), ("c", 1, "B", 5, 7), ("c", 2, "A", 10, 10)]


def test_order_by_time(spark):
    rows = [(1, "c", None, "sd", "B", "[0:00:29.7] b"), (2, "c", None, "sd", "A", "[0:00:04.5] a"), (3, "c", None, "sd", "A", "00:00:10,500 --> c"), (4, "d", 7, "sd", "A", "01:00 - x"), (5, "d", 9, "sd", "B", "02:00 - y"), (6, "d", None, "sd", "B", "01:30 - z")]
    assert found(spark, rows) == [("c", 0, "A", 2, 3), ("c", 1, "B", 1, 1), ("d", 0, "A", 4, 4), ("d", 1, "B", 6, 5)]


def test_empty_and_wordless(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, "c", 1, "x", "A", "[noise]"), (2, None, 1, None, None, None)]) == []


def test_cleaning(spark):
    cases = {
        "we ran (laughs) out of # time [ without, + without ] any {F um, } rush. /": "we ran out of time without any rush.",
        "UHM... yes (Δ = <<talking>> 9). -/": "yes (Δ = 9).", "(um) i *sighs* see ((cough))": "i see", "Mm-hmm.": "Mm-hmm.", "": "", "drum uhm, er": "drum",
    }
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    assert [r[0] for r in df.select(P.spoken_words(F.col("x"))).collect()] == list(cases.values())


def test_labels(spark):
    df = spark.createDataFrame([(x,) for x in ("SPEAKER A", "spk_a", "caller_A", "@@A", "A:", "Ａ", " a ", "speaker", "John Smith", "", None)], "x string")
    assert [r[0] for r in df.select(P.label_core(F.col("x"))).collect()] == ["a"] * 7 + ["speaker", "johnsmith", None, None]


def test_named_speakers_take_the_slots(spark):
    rows = [("c", "a")] * 3 + [("c", "b")] * 2 + [("d", "john")] * 4 + [("d", "b")]
    got = {tuple(r) for r in P.assigned_speakers(spark.createDataFrame(rows, "conversation_id string, core string")).collect()}
    assert got == {("c", "a", "A"), ("c", "b", "B"), ("d", "john", "A"), ("d", "b", "B")}


def test_least_total_cost(spark):
    """Both names are nearer to 'a'; the one that loses less by it goes to 'b'."""
    rows = [("x", "a"), ("x", "b"), ("y", "a"), ("y", "b"), ("c", "ana"), ("c", "ana"), ("c", "dora")]
    got = {tuple(r) for r in P.assigned_speakers(spark.createDataFrame(rows, "conversation_id string, core string")).collect()}
    assert got >= {("c", "ana", "A"), ("c", "dora", "B")}
    three = [("x", "a"), ("x", "b"), ("y", "a"), ("y", "b"), ("c", "a"), ("c", "bob"), ("c", "aa")]
    got = {tuple(r) for r in P.assigned_speakers(spark.createDataFrame(three, "conversation_id string, core string")).collect()}
    assert got >= {("c", "a", "A"), ("c", "bob", "B"), ("c", "aa", "A")}


def test_null_conversation_is_kept(spark):
    rows = [(1, None, 1, "sd", "A", "one"), (2, None, 2, "sd", "B", "two"), (3, "c", 1, "sd", "A", "x"), (4, "c", 2, "sd", "B", "y")]
    assert found(spark, rows) == [("c", 0, "A", 3, 3), ("c", 1, "B", 4, 4), (None, 0, "A", 1, 1), (None, 1, "B", 2, 2)]


def test_stretches_of_a_long_conversation(spark, monkeypatch):
    import random

    rnd = random.Random(2)
    rows = [(i, "c", i if i % 5 else None, "sd", rnd.choice("AAB"), f"{i // 3600:02d}:{i // 60 % 60:02d}:{i % 60:02d} - word") for i in range(400)]
    rows += [(1000 + i, "c", None, "sd", rnd.choice("AB"), "word") for i in range(50)]
    whole = found(spark, rows)
    monkeypatch.setattr(P, "STRETCH", 7)
    monkeypatch.setattr(P, "LINES", 3)
    assert found(spark, rows) == whole
    speakers = [r[4] for r in rows]
    assert len(whole) == 1 + sum(a != b for a, b in zip(speakers, speakers[1:]))
