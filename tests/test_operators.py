"""Operators on small cases: nulls, ties, empties, clashes and round trips."""

import json
import random

import pytest
from pyspark.sql import functions as F

from turnloom.config import Settings
from turnloom.functions import text as X
from turnloom.operators import evaluate as E
from turnloom.operators import models as M
from turnloom.operators import sampling as O
from turnloom.operators import slots as S
from turnloom.operators import timeline as L
from turnloom.operators import transcripts as R
from turnloom.operators.components import components
from turnloom.operators.intervals import gaps, periods, to_units
from turnloom.sources import dialogues as D
from turnloom.sources import manifests, sinks


def brute_periods(rows):
    out = []
    for k in sorted({r[0] for r in rows}, key=str):
        own = sorted({(s, e) for x, s, e in rows if x == k and s is not None and e is not None and e >= s})
        for s, e in own:
            if out and out[-1][0] == k and s <= out[-1][2]:
                out[-1] = (k, out[-1][1], max(out[-1][2], e), out[-1][3] + 1)
            else:
                out.append((k, s, e, 1))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [3, 6, 22])
def test_periods_against_brute_force(spark, bits):
    rnd = random.Random(7)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, *range(60)]), rnd.choice([None, *range(80)])) for _ in range(300)]
    rows += [("c", 0, 100_000), ("c", 5, 7), ("d", 4, 4), ("d", 4, 4), ("e", 0, 4), ("e", 4, 8), ("f", 0, 3), ("f", 4, 5)]
    # a period over several shards, in one of which stand three runs
    rows += [("g", 0, 100), ("g", 40, 40), ("g", 42, 42), ("g", 44, 44), ("g", 200, 201), ("g", 203, 204), ("g", 206, 207), ("h", 40, 40), ("h", 42, 42), ("h", 44, 44)]
    df = spark.createDataFrame(rows, "k string, s bigint, e bigint").withColumn("shard", F.lit("clash")).withColumn("first", F.lit(1))
    got = periods(df, ["k"], F.col("s"), F.col("e"), bits)
    assert sorted(map(tuple, got.collect()), key=str) == brute_periods(rows)
    holes = {tuple(r) for r in gaps(got, ["k"], bits).collect()}
    by = {}
    for k, a, b, _ in brute_periods(rows):
        by.setdefault(k, []).append((a, b))
    assert holes == {(k, x[1], y[0]) for k, own in by.items() for x, y in zip(sorted(own), sorted(own)[1:])}
    assert ("f", 3, 4) in holes and not [h for h in holes if h[0] == "e"]


def test_periods_of_nothing(spark):
    df = spark.createDataFrame([], "k string, s double, e double")
    assert periods(df, ["k"], to_units(F.col("s")), to_units(F.col("e"))).count() == 0


def test_units(spark):
    df = spark.createDataFrame([(1.0004,), (float("nan"),), (float("inf"),), (None,)], "x double")
    assert [r[0] for r in df.select(to_units(F.col("x"))).collect()] == [1000, None, None, None]


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 300), (300, 200), (7, 7), (None, 3), (400, 400)] + [(1000, x) for x in range(1001, 1100)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    assert {got[x] for x in range(1, 41)} == {1} and got[300] == 100 and got[1099] == 1000 and 400 not in got
    hubs = [(0, i) for i in range(1, 900)] + [(5000, i) for i in range(1000, 1900)] + [(i, i + 1) for i in range(2000, 2040)] + [(7, 7), (None, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(hubs, "a bigint, b bigint")).collect()))
    assert got == {i: 0 for i in range(900)} | {i: 1000 for i in [*range(1000, 1900), 5000]} | {i: 2000 for i in range(2000, 2041)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def run(spark, column, *values, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(column(F.col("x"))).collect()]


def test_text(spark):
    assert run(spark, X.sanitize_utterance, '10) user: "hi there"', None, "", "2. assistant — ok", "<think>a\nb</think> yes") == ["hi there", "", "", "ok", "yes"]
    assert run(spark, X.clean_word, "Ừm,", "don't!") == ["ừm", "dont"]
    assert run(spark, X.words, "  a  b\t", "", None) == [["a", "b"], [], None]
    assert run(spark, X.sentences, "A. B? 3.5 c", "", "x") == [["A.", "B?", "3.5 c"], [""], ["x"]]
    assert run(spark, X.cut_at_take_floor, "a b c d e f [TAKE_FLOOR] g h", "a [TAKE_FLOOR] b c d e", "a b", "a [TAKE_FLOOR]") == ["a b c d e f g", "a b c d", "a b", "a"]
    assert run(spark, X.strip_tags, "[laughter] a [sigh]b") == [" a b"]
    assert run(spark, lambda c: X.strip_tags_but(c, ("sigh",)), "[laughter]a[sigh]b[PAUSE]") == ["a[sigh]b[PAUSE]"]
    assert run(spark, X.stage_directions, "*Sighs* so *very* good") == [" so very good"]
    assert run(spark, X.safe_stem, "a/b c!.wav", "...", "x.y.wav") == ["b_c", "clip", "x.y"]
    assert run(spark, X.transcript_markup, "[ I, + I ] {F um, } go <laughter> # x -") == ["I, I um, go [laughter] x"]
    assert run(spark, lambda c: X.first_json(c, "a int")["a"], '{"a": 1}', 'so: {"a": 2} ok', "broken {", None) == [1, 2, None, None]


def brute_b(words):
    """The annotator's rule, one word at a time."""
    n = len(words)
    found = [i for i, w in enumerate(words[:-1]) if w[-1] in ".,?!;" or w in ("um", "uh")]
    kept, run_ = [], []
    for i in [*found, None]:
        if run_ and i != run_[-1] + 1:
            kept += run_ if len(run_) == 1 else run_[1::2]
            run_ = []
        if i is not None:
            run_.append(i)
    out, last = set(kept), -1
    for b in [*kept, n - 1]:
        if b - last > 8:
            out |= set(range(last + 4, b, 4))
        last = b
    return sorted(i for i in out if 0 <= i < n - 1)


def test_slots(spark):
    rnd = random.Random(3)
    texts = [[rnd.choice(["a", "b", "um", "c,", "d."]) if rnd.random() < 0.6 else "w" for _ in range(rnd.randint(0, 40))] for _ in range(200)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, w array<string>")
    got = {r[0]: (r[1], r[2]) for r in df.select("i", S.slots_a(F.col("w")), S.slots_b(F.col("w"))).collect()}
    for i, t in enumerate(texts):
        a = [j for j, w in enumerate(t) if w[-1] in ".,?!;" or w == "um"][:-1]
        assert got[i][0] == a
        assert got[i][1] == (brute_b(t) if t else [])


def test_decisions_keep_their_guards(spark):
    slots = [(0, "floor_taking"), (2, "backchannel"), (4, "backchannel"), (6, "backchannel"), (9, "floor_taking"), (12, "backchannel")]
    df = spark.createDataFrame([(slots,), ([],)], "s array<struct<word_index:int,action:string>>")
    got = [[d["decision"] for d in r[0]] for r in df.select(S.decided(F.col("s"))).collect()]
    assert got == [["silence", "backchannel", "silence", "backchannel", "floor_taking", "silence"], []]


def test_evaluation(spark):
    assert run(spark, E.softmax, [0.0, 0.0, 0.0], kind="array<double>") == [pytest.approx([1 / 3] * 3)]
    assert run(spark, E.argmax, [0.2, 0.4, 0.4], kind="array<double>") == [1]
    one = spark.range(1)
    z = lambda *v: F.array(*map(F.lit, v))
    assert one.select(E.kl(z(0.5, 0.5, 0.0), z(0.5, 0.5, 0.0))).first()[0] == 0.0
    assert one.select(E.kl(z(1.0, 0.0, 0.0), z(0.0, 1.0, 0.0))).first()[0] == pytest.approx(27.631, abs=1e-3)
    assert one.select(E.renormed(F.lit(None).cast("double"), F.lit(0.0), F.lit(0.0))).first()[0] == [0.0, 0.0, 1.0]
    with pytest.raises(Exception, match="unknown turn-taking label"):
        run(spark, E.canonical_label, "maybe")
    empty = spark.createDataFrame([], "label string, pred string")
    assert E.scores(empty, "label", "pred").first()["accuracy"] == 0.0
    assert E.confusion(empty, "label", "pred").count() == 9


def test_sampling(spark):
    df = spark.range(10).withColumn("g", F.lit("x"))
    assert sorted(r[0] for r in O.evenly_spaced(df, ["g"], ["id"], 4).select("id").collect()) == [0, 2, 5, 7]
    assert O.evenly_spaced(df, ["g"], ["id"], 0).count() == 10 and O.evenly_spaced(df, ["g"], ["id"], 20).count() == 10
    big = spark.range(1000).withColumn("g", F.lit("x"))
    assert sorted(r[0] for r in O.evenly_spaced(big, ["g"], ["id"], 10).select("id").collect()) == list(range(0, 1000, 100))
    assert run(spark, lambda c: O.hash_split(c, 0.1669), "work_0000.json") == ["test"]
    assert run(spark, lambda c: O.hash_split(c, 0.1670), "work_0000.json") == ["train"]


def test_timeline(spark):
    rows = [("d", 0, 0, None, 24000), ("d", 1, 1, None, 12000), ("d", 2, 0, "interrupt", 4800), ("d", 3, 0, None, 100)]
    df = spark.createDataFrame(rows, "d string, i int, s int, k string, n int")
    got = [(r.timing, r.start_sample) for r in L.placed(df, ["d"], ["i"], "s", "k", "n").orderBy("i").collect()]
    assert got == [("none", 0), ("gap", 27840), ("overlap", 35040), ("pause", 39840)]
    one = spark.createDataFrame([([5, 6, 100], [10, 10, 10])], "p array<bigint>, n array<bigint>")
    r = one.select(L.backchannels_placed(F.col("p"), F.col("n"), F.lit(90).cast("bigint"), F.lit(False)).alias("r")).first().r
    assert r.starts == [5, 15, 100] and r.length >= 100
    r = one.select(L.backchannels_placed(F.col("p"), F.col("n"), F.lit(90).cast("bigint"), F.lit(True)).alias("r")).first().r
    assert r.starts == [5, 15, None] and r.length == 90


def test_transcripts():
    assert R.aligned_marks("I think, so yes".split(), "I think|, SO yes|".split()) == [1, 3]
    assert R.aligned_marks([], ["a|"]) == []


def test_manifest_entries(spark):
    lines = ["lost", "a.wav", "hello", "there", "", "b.WAV", "c.mp3", "x", "A.wav", "again"]
    df = spark.createDataFrame([("m", i, x) for i, x in enumerate(lines)], "m string, i int, line string")
    assert {(r.file, r.transcript) for r in manifests.entries(df, "m", ["i"], "line").collect()} == {("a.wav", "hello there"), ("c.mp3", "x")}


def test_models(spark):
    df = spark.createDataFrame([(1, "ab"), (2, ""), (3, None)], "i int, t string").coalesce(1).withColumn("v", F.lit("x"))
    got = {r.i: (r.samples, r.status) for r in M.rendered(df, "t", "v", M.SilentSynthesizer()).collect()}
    assert got == {1: (2880, "ok"), 2: (0, "fallback"), 3: (0, "fallback")}
    talk = spark.createDataFrame([("d", [("user", "hi"), ("assistant", None)]), ("e", None)], "k string, h array<struct<role:string,content:string>>")
    rows = M.rewritten(talk, "k", "h", M.EchoGenerator(), lambda s: "user:" not in s, str.strip).collect()
    assert [(r.k, r.turn) for r in rows] == [("d", 0), ("d", 1)]


def test_long_dialogues_are_rewritten_whole(spark):
    talk = spark.createDataFrame([("d", [("user", f"t{i}") for i in range(450)])], "k string, h array<struct<role:string,content:string>>")
    turns = lambda **most: [r.turn for r in M.rewritten(talk, "k", "h", M.EchoGenerator(), lambda s: True, str.strip, **most).collect()]
    assert turns() == turns(max_turns=0) == list(range(450))
    assert turns(max_turns=3) == [0, 1, 2]


def test_readers(spark, tmp_path):
    def put(name, value):
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(value if isinstance(value, str) else json.dumps(value))
        return str(p)

    turns = lambda df: {r.example_id: [tuple(t) for t in r.turns] for r in df.collect()}
    p = put("i.json", {"transcript_id": "t1", "text": "User: hi\nAssistant: yes\nmore"})
    assert turns(D.interviewer(spark, p, "train")) == {"t1": [("user", "hi"), ("assistant", "yes\nmore")]}
    p = put("m.json", [{"dialogue_id": "MUL1.json", "turns": [{"speaker": "USER", "utterance": " a "}, {"speaker": "SYSTEM", "utterance": " "}]}])
    assert turns(D.multiwoz(spark, p, "train")) == {"MUL1": [("user", "a")]}
    p = put("n.json", [{"uuid": "u", "scenario": {"category": "bike", "kbs": []}, "events": [{"action": "message", "agent": 0, "data": "x"}, {"action": "offer", "agent": 1, "data": "9"}]}])
    assert turns(D.negotiator(spark, p, "train")) == {"u": [("user", "x")]}
    p = put("s.json", {"q_train_1": {"question": "?", "dialogues": {"b": [{"system": "s", "user": "u"}], "a": [{"system": "z"}]}}})
    assert turns(D.socratic(spark, p, 1)) == {"q_train_1__a": [("assistant", "z")]}
    p = put("p.csv", "t,u,x,s,c\n1,second,,1,c1\n0,first,,0,c1\nbad\n")
    assert turns(D.persuader_csv(spark, p, "train")) == {"c1": [("assistant", "first"), ("user", "second")]}
    p = put("q.json", [{"id": "7", "scenario": {"background": "b"}, "dialog": {"z": [{"role": "persuader", "response": "r"}], "a": []}}])
    assert turns(D.persuader_sessions(spark, p, "train", 1)) == {"7__z": [("assistant", "r")]}
    put("root/soda/train/x.json", {"history": [["user", "a "], {"role": "assistant", "content": "b"}, ["user", ""], ["user"], "bad", {}], "context": {"a": 1}})
    put("root/soda/train/y.json", "{broken")
    rows = D.parsed(spark, str(tmp_path / "root"))
    assert turns(rows) == {"x": [("user", "a"), ("assistant", "b")]} and rows.first().dataset == "soda"
    soda = spark.createDataFrame([(3, ["a", "b"], "Ann met Bo. Annie.", ["Ann", "Bo"])], "original_index bigint, dialogue array<string>, narrative string, speakers array<string>")
    soda.write.parquet(str(tmp_path / "soda_train"))
    got = D.soda(spark, str(tmp_path / "soda_train"), "train").first()
    assert got.context == "User met Assistant. Annie." and [t.role for t in got.turns] == ["user", "assistant"]
    assert D.dump(spark, str(tmp_path / "soda_train")).first().split == "train"
    with pytest.raises(ValueError):
        D.read(spark, "nope", "x")


def test_voice_pool(spark, tmp_path):
    for n in ("a.wav", "a.txt", "b.wav"):
        (tmp_path / n).write_text("x")
    assert D.voice_pool(spark, str(tmp_path), least=1).count() == 1
    with pytest.raises(ValueError):
        D.voice_pool(spark, str(tmp_path))


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a/b", "x", "train", None), ("c", "x", None, 1)], "id string, dataset string, split string, n int")
    sinks.write_each(df, str(tmp_path / "each"), "id")
    assert json.loads((tmp_path / "each/x/train/a_b.json").read_text())["id"] == "a/b"
    sinks.write_table(df, str(tmp_path / "t"), ["dataset"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    sinks.write_release(df.withColumn("code", F.lit("TEA")), str(tmp_path / "r"), "dialogues")
    assert spark.read.json(str(tmp_path / "r/dialogues")).count() == 2
    sinks.write_queue(df, str(tmp_path / "q"))
    assert spark.read.json(str(tmp_path / "q")).count() == 2
    assert [r.id for r in sinks.pending(df, df.where("n = 1"), "id", 5).collect()] == ["a/b"]
    names = spark.createDataFrame([("A b.wav",), ("a_b.wav",)], "f string")
    assert sorted(r.stem for r in sinks.pool_names(names, "f").collect()) == ["A_b", "a_b_2"]


def test_settings():
    s = Settings.load({"seed": 7}, {"TURNLOOM_SEED": "9", "TURNLOOM_TRAIN_RATIO": "0.5"})
    assert s.seed == 9 and s.train_ratio == 0.5 and Settings.load({"seed": 7}, {}).seed == 7
    with pytest.raises(ValueError):
        Settings.load({"sed": 1}, {})
