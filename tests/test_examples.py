"""Ranks, samples, examples and answers on small tables."""

import random

from pyspark.sql import functions as F

from turnloom.functions import text as X
from turnloom.operators import evaluate as E
from turnloom.operators import examples as M
from turnloom.operators import sampling as O


def test_numbered(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice(["a", "a", "a", "b", None]), i, rnd.choice([None, 1, 2])) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, k int, rn int").drop("rn").withColumn("_k", F.lit(1))
    for parts in (1, 7):
        got = {(r.g, r.k): (r.rn, r.n) for r in O.numbered(df, ["g"], ["k"], parts).collect()}
        own = {g: sorted(k for h, k, _ in rows if h == g) for g in ("a", "b", None)}
        assert got == {(g, k): (i, len(ks)) for g, ks in own.items() for i, k in enumerate(ks)}
    assert O.numbered(df.limit(0), ["g"], ["k"]).count() == 0
    assert sorted((r.g or "", r.rn) for r in O.first(df, ["g"], ["k"], 2).collect()) == [("", 0), ("", 1), ("a", 0), ("a", 1), ("b", 0), ("b", 1)]


def test_halves_and_batches(spark):
    df = spark.createDataFrame([("a", i, "x" * (i % 5)) for i in range(20)] + [("b", 0, None)], "g string, k int, t string")
    halves = lambda *k: {(r.g, r.k): r.split for r in O.halves(df, ["g"], ["k"], *k).collect()}
    assert sorted(halves(3, 2).items()) == [(("a", 0), "train"), (("a", 4), "train"), (("a", 8), "train"), (("a", 12), "test"), (("a", 16), "test"), (("b", 0), "train")]
    assert sum(v == "train" for v in halves(None, 2).values()) == 10 and len(halves(0, 0)) == 21
    b = O.batches(df, ["g"], ["k"], F.length("t"), 3, 3).collect()
    alone = {(r.g, r.batch) for r in b if r.oversize}
    assert len(alone) == 4 and max(sum(1 for r in b if (r.g, r.oversize, r.batch) == x) for x in {(r.g, r.oversize, r.batch) for r in b if not r.oversize}) == 3
    assert [r.batch for r in b if r.g == "b"] == [0]


def test_places(spark):
    rows = [(x,) for x in ("0", " 3 ", "+2", "-1", "4", "three", "3.0", "", None, "99999999999")]
    got = [r[0] for r in spark.createDataFrame(rows, "x string").select(M.valid_place(F.col("x"), F.lit(4))).collect()]
    assert got == [0, 3, 2, None, None, None, None, None, None, None]


def test_examples(spark):
    b = "array<struct<word_index:string,probabilities:struct<backchannel:double,interruption:double,none:double>>>"
    rows = [
        (1, 0, "user", "a b c", [("1", (1.0, 1.0, 2.0)), ("7", (1.0, 0.0, 0.0))]), (1, 1, "assistant", "d e", [("0", (1.0, 0.0, 0.0))]), (1, 2, "user", " ", [("0", (1.0, 0.0, 0.0))]),
        (1, 3, "user", "f g", None), (1, 4, "user", "h i", []), (1, 5, "user", "j k", [("0", (0.0, None, 0.0))]), (None, 0, "user", "x y", [("0", None)]),
    ]
    df = spark.createDataFrame(rows, f"d int, t int, role string, content string, b {b}").withColumn("trps", F.lit(1))
    got = {(r.d, r.t): r for r in M.examples(df.drop("trps"), "d", "t", "b", "word_index", M.human_target).collect()}
    assert set(got) == {(1, 0), (1, 5), (None, 0)}
    assert [(x.word_idx, x.target_probs) for x in got[1, 0].trps] == [(1, [0.25, 0.25, 0.5])] and got[1, 5].trps[0].target_probs == [0.0, 0.0, 1.0]
    assert [c.content for c in got[1, 5].context] == ["d e", "f g", "h i"] and got[1, 5].context[0].role == "assistant"
    assert M.examples(df.drop("trps"), "d", "t", "b", "word_index", M.human_target, any_role=True).count() == 4


def test_typed(spark):
    cases = {
        "a b [BACKCHANNEL] c [TAKE_FLOOR] [BACKCHANNEL] d": (["a", "b", "c", "d"], [(1, "BACKCHANNEL"), (2, "BACKCHANNEL")]),
        "[BACKCHANNEL] a": (["a"], []), "a [BACKCHANNEL]": (["a"], [(0, "BACKCHANNEL")]), "plain": (["plain"], []), "": ([], []), "x[BACKCHANNEL] y": (["x[BACKCHANNEL]", "y"], []),
    }
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    got = {r[0]: (r[1].words, [(t.idx, t.type) for t in r[1].typed]) for r in df.select("x", M.typed_boundaries(F.col("x"))).collect()}
    assert got == cases
    one = spark.range(1).select(M.joined_boundaries(F.array(F.lit(0), F.lit(2)), F.array(F.struct(F.lit(2).alias("idx"), F.lit("T").alias("type")), F.struct(F.lit(1).alias("idx"), F.lit("B").alias("type"))))).first()[0]
    assert [tuple(x) for x in one] == [(0, None), (1, "B"), (2, "T")]


def test_answers(spark):
    none = F.array().cast("array<double>")
    rows = ['{"a": 1, "b": 3}', 'so {"a": 2} {"b": 9}', '{"a": 0, "b": null}', "nothing", '{"a": {"b": 1}}', None, '{"a": oops}']
    df = spark.createDataFrame([(x,) for x in rows], "x string")
    assert [r[0] for r in df.select(X.told_distribution(F.col("x"), ("a", "b"), none)).collect()] == [[0.25, 0.75], [1.0, 0.0], [], [], [0.0, 1.0], [], []]
    assert [r[0] for r in spark.createDataFrame([("```json\nx\n```",), ("x",), (None,)], "x string").select(X.without_fences(F.col("x"))).collect()] == ["x", "x", None]


def test_stage_directions_pair_from_the_left(spark):
    cases = {"*a* sigh *b*": "a sigh b", "*sighs* ok *Wink wink,*": " ok ", "2 * 3": "2 * 3", "*x": "*x"}
    df = spark.createDataFrame([(k,) for k in cases], "x string")
    assert {r[0]: r[1] for r in df.select("x", X.stage_directions(F.col("x"))).collect()} == cases


def test_names_and_roles(spark):
    df = spark.createDataFrame([("Ann met ANN. Annie, Ann's", "Ann"), ("a.b axb", "a.b"), (None, "x")], "t string, n string")
    assert [r[0] for r in df.select(X.name_to_role(F.col("t"), F.col("n"))).collect()] == ["User met User. Annie, User's", "User axb", None]
    roles = spark.createDataFrame([("soda", None, 0), ("soda", None, 1), ("persuader", "Persuader", 0), ("negotiator", "0", 5), ("multiwoz", "SYSTEM", 0), ("interviewer", None, 0)], "r string, l string, i int").collect()
    got = [spark.range(1).select(X.role_by(r.r, F.lit(r.l), F.lit(r.i))).first()[0] for r in roles]
    assert got == ["user", "assistant", "assistant", "user", "assistant", "user"]


def test_moved_decisions(spark):
    d = F.array(*[F.struct(F.lit(i).alias("word_index"), F.lit(x).alias("decision")) for i, x in ((0, "backchannel"), (1, "floor_taking"), (2, "silence"), (3, "floor_taking"))])
    moved = lambda t: [x.word_index for x in spark.range(1).select(X.moved_decisions(d, F.lit(t))).first()[0]]
    assert moved("a b c [TAKE_FLOOR] d [TAKE_FLOOR]") == [0, 2, 2, 4] and moved("[TAKE_FLOOR] a") == [0, 0, 2, 3] and moved("a") == [0, 1, 2, 3]


def test_batch_loss(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0], [0.5, 0.5]), (1, [0.5, 0.5], [0.5, 0.5]), (2, [1.0, 0.0], [0.25, 0.75])], "b int, t array<double>, q array<double>")
    got = {r.b: r.loss for r in E.batch_loss(df, "b", F.col("t"), F.transform("q", lambda x: F.log(x))).collect()}
    assert got == {1: 0.346574, 2: 1.386294}


def test_synthesizer_text(spark):
    df = spark.createDataFrame([("hi: there—you",), ("",), ("ok ...",), ("Ａé",)], "x string")
    assert [r[0] for r in df.select(X.punc_norm(F.col("x"))).collect()] == ["Hi, there-you.", X.NO_TEXT, "Ok,", "Ａé."]
    assert [r[0] for r in df.select(X.nfkd_lower(F.col("x"))).collect()] == ["hi: there—you", "", "ok ...", "aé"]
