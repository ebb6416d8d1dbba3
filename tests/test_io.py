"""Readers, manifests, writers, plans and settings on small folders."""

import json

import pytest
from pyspark.sql import functions as F

from turnloom import config
from turnloom.operators import guards
from turnloom.sources import dialogues as D
from turnloom.sources import manifests, sinks


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_parsed_files(spark, tmp_path):
    for i in range(6):
        put(tmp_path / "deep" / "soda" / "train" / f"f {i}.json", json.dumps({"history": [["user", f"hi {i}"], {"role": "assistant", "content": "yo"}, ["x"]]}))
    put(tmp_path / "deep" / "soda" / "test" / "t.json", json.dumps({"example_id": "T", "history": [["user", "a"]], "context": "c"}))
    put(tmp_path / "deep" / "soda" / "test" / "bad.json", "{nothing")
    put(tmp_path / "deep" / "other" / "test" / "empty.json", json.dumps({"history": []}))
    got = {r.example_id: r for r in D.parsed(spark, str(tmp_path)).collect()}
    assert set(got) == {"T", *(f"f {i}" for i in range(6))} and got["T"].context == "c" and len(got["f 1"].turns) == 2 and got["f 1"].split == "train"
    assert D.parsed(spark, str(tmp_path), datasets=["soda"], splits=["test"]).count() == 1
    assert sorted(r.example_id for r in D.parsed(spark, str(tmp_path), splits=["train"], per_split=3).collect()) == ["f 0", "f 2", "f 4"]


def test_json_lines(spark, tmp_path):
    put(tmp_path / "a.jsonl", '{"a": 1}\n\n   \n{"a": 2, "b": "x"}\nbroken {\n')
    got = [tuple(r) for r in D.json_lines(spark, str(tmp_path / "a.jsonl"), "a int, b string").collect()]
    assert got == [(1, None, None), (2, "x", None), (None, None, "broken {")]


def test_soda_gate(spark, tmp_path):
    rows = [(i, [f"a{i}", "b"], "Ann met Bo.", ["Ann", "Bo"]) for i in range(10)]
    spark.createDataFrame(rows, "original_index bigint, dialogue array<string>, narrative string, speakers array<string>").write.parquet(str(tmp_path / "s"))
    got = D.soda(spark, str(tmp_path / "s"), "train", start_index=2, max_accepted=3, gate=lambda r: r.where(~F.contains("prompt", F.lit("a4")))).collect()
    assert sorted(r.example_id for r in got) == ["train_2", "train_3", "train_5"] and got[0].context == "User met Assistant."
    assert D.read(spark, "soda", str(tmp_path / "s"), "test", max_variants=3, max_accepted=1).collect()[0].example_id == "test_0"
    with pytest.raises(TypeError):
        D.read(spark, "soda", "x", wrong=1)
    with pytest.raises(ValueError):
        D.read(spark, "nobody", "x")


def test_dump_ids_differ(spark, tmp_path):
    spark.createDataFrame([([("user", "a")],), ([("user", "b")],)], "history array<struct<role:string,content:string>>").coalesce(1).write.parquet(str(tmp_path / "x" / "train"))
    got = D.dump(spark, str(tmp_path / "x" / "train")).collect()
    assert len({r.example_id for r in got}) == 2 and {r.split for r in got} == {"train"}


def test_paths():
    assert D.resolved_path("a", {"a": "p"}, "q", "r") == "p" and D.resolved_path("a", {}, "q", "r") == "q" and D.resolved_path("a", None, None, "r/") == "r/a"
    with pytest.raises(ValueError):
        D.resolved_path("a")


def test_joined_tables(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([(2, 3.0)], "i int, d double")
    assert sorted(map(tuple, D.joined([a, b, a.limit(0)]).collect())) == [(1, "x", None), (2, None, 3.0)]


LINES = ["lost", "a.wav", "hello", "there", "", "b.WAV", "c.mp3", "x", "A.wav", "again"]


def test_warnings(spark):
    df = spark.createDataFrame([("m", i, x) for i, x in enumerate(LINES)], "m string, i int, line string")
    assert {(r.kind, r.text) for r in manifests.warnings(df, "m", ["i"], "line").collect()} == {("orphan", "lost"), ("empty", "b.WAV"), ("repeated", "A.wav")}


def test_resolved(spark):
    names = spark.createDataFrame([("a/X.wav",), ("x.WAV",), ("b/y.wav",), ("none.wav",), (None,)], "n string")
    files = spark.createDataFrame([("a/X.wav",), ("b/x.wav",), ("B/Y.wav",), ("c/Y.wav",)], "f string")
    assert {r.n: r.path for r in manifests.resolved(names, "n", files, "f").collect()} == {"a/X.wav": "a/X.wav", "x.WAV": "a/X.wav", "b/y.wav": "B/Y.wav", "none.wav": None, None: None}


def good():
    pick = {"wav": "w", "txt": "t", "wav_size": 1, "wav_mtime_ns": 1}
    unit = [{"kind": "text", "unit_id": "u_0_0", "text": "hi"}, {"kind": "pause", "unit_id": "u_0_1", "text": ""}]
    return {
        "dialogue_id": "d", "rel_path": "r", "variant_idx": 0, "seed": 1, "schema_version": 1, "stage": "prep", "voice_picks": {"user": pick, "assistant": pick},
        "utterances": [{"turn": 0, "text_idx": 0, "speaker_idx": 0, "uttr_type": None, "next_uttr_type": "last", "is_last_text": True, "isUttered": True, "tts_text": "hi", "units": unit}],
        "backchannels": [{"bc_idx": 0, "speaker_idx": 1, "text": "yeah", "word_count": 0, "host_idx": 0, "next_uttr_type_of_host": "last", "unit_id": "bc_0"}],
    }


def test_manifests(spark, tmp_path):
    def change(name, f):
        m = good()
        f(m)
        put(tmp_path / name / "manifest.json", json.dumps(m))

    change("good", lambda m: None)
    change("version", lambda m: m.update(schema_version=2, stage="x", dialogue_id=""))
    change("picks", lambda m: m["voice_picks"].pop("user"))
    change("units", lambda m: m["utterances"][0]["units"].extend([{"kind": "text", "unit_id": "u_0_0", "text": ""}, {"kind": "odd", "unit_id": "z", "text": ""}]))
    change("bc", lambda m: m["backchannels"][0].update(host_idx=1, word_count=-1, text="", unit_id="u_0_0", speaker_idx=2, next_uttr_type_of_host="odd"))
    put(tmp_path / "none" / "manifest.json", "{")
    put(tmp_path / "good" / "other.json", "{}")
    got = {r.p.split("/")[-2]: r.broken for r in manifests.manifests(spark, str(tmp_path)).select("broken", F.input_file_name().alias("p")).collect()}
    assert got["good"] == [] and got["version"] == ["schema_version", "stage", "dialogue_id"] and got["picks"] == ["voice_picks"]
    assert got["units"] == ["unit kind", "empty text unit", "duplicate unit_id"]
    assert got["bc"] == ["speaker_idx", "empty backchannel", "word_count", "host_idx", "next_uttr_type_of_host", "unit id collision"]
    assert "schema_version" in got["none"]


def test_tables_and_releases(spark, tmp_path):
    df = spark.createDataFrame([(i, None if i % 7 == 0 else "abc"[i % 2], "train") for i in range(90)], "i int, code string, split string")
    sinks.write_table(df, str(tmp_path / "t"), ["code"], file_rows=10)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 90
    rows = spark.createDataFrame([("x", "SOC", "train"), (None, "soc", "test")], "text string, code string, split string")
    sinks.write_release(rows, str(tmp_path / "r"), "dialogues")
    schema = rows.select("text").schema
    assert sorted((r.text or "-", r.code, r.split) for r in sinks.read_release(spark, str(tmp_path / "r"), "dialogues", schema).collect()) == [("-", "soc", "test"), ("x", "SOC", "train")]
    assert sinks.read_release(spark, str(tmp_path / "r"), "dialogues", schema, code="SOC").count() == 1 == sinks.read_release(spark, str(tmp_path / "r"), "dialogues", schema, split="test").count()
    assert sinks.unpack_root("dialogues") != sinks.unpack_root("annotations") and sinks.unpack_root("dialogues", "x") == "x"
    for f in (lambda: sinks.unpack_root("other"), lambda: sinks.write_release(rows, "x", "other"), lambda: sinks.output_folder("r", "d", "s", "other")):
        with pytest.raises(ValueError):
            f()
    assert sinks.output_folder("r", "soda", "test", "parsed") == "r/parsed_source/soda/test" and sinks.output_folder("r", "so/da", "test", "text") == "r/text_dialogue_so_da/test"


def test_writers_that_look_first(spark, tmp_path):
    q = spark.createDataFrame([("a", None)], "id string, text string")
    bad = spark.createDataFrame([("rule one", 2), ("rule two", 0)], "rule string, n bigint")
    with pytest.raises(guards.Aborted, match="rule one"):
        sinks.write_queue(q, str(tmp_path / "q"), violations=bad)
    sinks.write_queue(q, str(tmp_path / "q"), violations=bad.where("n = 0"))
    assert json.loads(next((tmp_path / "q").glob("*.json")).read_text()) == {"id": "a", "text": None}
    samples = spark.createDataFrame([(1, "ok", 0.5), (2, "api_error", 1.5)], "i int, status string, kl double")
    sinks.write_evaluation(samples, str(tmp_path / "e"))
    assert tuple(spark.read.json(str(tmp_path / "e" / "summary")).select("n", "n_fallback", "mean_kl").first()) == (2, 1, 1.0)
    with pytest.raises(guards.Aborted):
        sinks.write_evaluation(samples.where("i = 2"), str(tmp_path / "f"))
    t = spark.createDataFrame([("d", 2.0, "b"), ("d", 1.0, "a"), ("e", 0.0, None)], "d string, start double, text string")
    sinks.write_alignment(t, str(tmp_path / "a"), ["d"], ["start"])
    got = {r.d: [x.text for x in r.turns] for r in spark.read.json(str(tmp_path / "a")).collect()}
    assert got == {"d": ["a", "b"], "e": [None]}


def test_guards(spark):
    none = spark.createDataFrame([], "i int")
    with pytest.raises(guards.Aborted, match="no dialogues"):
        guards.require_rows(none, "dialogues")
    assert guards.require_rows(spark.range(1), "x").count() == 1
    guards.require_none(spark.createDataFrame([], "rule string, n int"))
    rows = [(1, 5, True, 1, 5, "same"), (1, 5, True, 1, 6, "changed"), (1, 5, False, None, None, "missing"), (0, 5, True, 9, 9, "same"), (None, None, True, 9, 9, "same")]
    df = spark.createDataFrame(rows, "s bigint, m bigint, t boolean, s2 bigint, m2 bigint, want string")
    assert all(r.got == r.want for r in df.withColumn("got", guards.fingerprint_state(*[F.col(c) for c in ("s", "m", "t", "s2", "m2")])).collect())


def test_pool_plan(spark):
    entries = spark.createDataFrame([("Ä b.wav", "x"), ("c.wav", "y"), ("d.wav", "z"), ("none.wav", "z")], "file string, transcript string")
    files = spark.createDataFrame([("Ä b.wav",), ("C.WAV",), ("d.wav",)], "path string")
    done = spark.createDataFrame([("D",)], "stem string")
    plan = lambda **kw: {r.file: r.action for r in sinks.pool_plan(entries, files, done, **kw).collect()}
    assert plan() == {"Ä b.wav": "write", "c.wav": "write", "d.wav": "skip", "none.wav": "missing"}
    assert plan(overwrite=True, limit=1) == {"c.wav": "write", "d.wav": "beyond", "Ä b.wav": "beyond", "none.wav": "missing"}


def test_unfinished(spark):
    rows = spark.createDataFrame([(i,) for i in range(6)], "k int")
    done = spark.createDataFrame([(0, "spoken", 3, 3, 10), (1, "plain", 2, 3, 0), (2, None, None, 3, None)], "k int, style string, artefacts int, expected int, size int")
    left = lambda rule, limit=None: sorted(r.k for r in sinks.unfinished(rows, done, "k", rule, limit).collect())
    assert left("exists") == [3, 4, 5] and left("spoken") == [1, 2, 3, 4, 5] == left("complete") == left("rendered") and left("spoken", 2) == [1, 2]


def test_settings(tmp_path):
    put(tmp_path / "a.json", json.dumps({"turnloom": {"seed": 1, "max_gap": 9}, "other": {"x": {"y": 2}}}))
    put(tmp_path / "b.json", json.dumps({"turnloom": {"seed": 2}}))
    s = config.Settings.load({"fill_every": 5}, {"TURNLOOM_MAX_GAP": "7", "LENGTH_GUARD_GAP": "6"}, (str(tmp_path / "a.json"), str(tmp_path / "b.json")))
    assert (s.seed, s.max_gap, s.fill_every, s.length_guard_gap) == (2, 7, 5, 6)
    assert s.guards() == {"start_guard": 0, "floor_guard": 3, "gap": 6} and s.policy() == {"max_gap": 7, "fill": 5}
    assert config.dotted(config.read_tree(tmp_path / "a.json"), "other.x.y") == 2 and config.dotted({"a": 1}, "a.b", "no") == "no"
    assert config.merged({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}, "d": 4}) == {"a": {"b": 3, "c": 2}, "d": 4}
    with pytest.raises(ValueError):
        config.Settings.load({"nothing": 1}, {})


def test_settings_reach_the_operators(spark):
    from turnloom.operators import slots as S

    s = config.Settings.load({"length_guard_gap": 1, "max_gap": 3, "fill_every": 2}, {})
    df = spark.createDataFrame([("a b c d e f g h i j".split(),)], "w array<string>")
    assert df.select(S.slots_b(F.col("w"), **s.policy())).first()[0] == [1, 3, 5, 7]
    acts = F.transform(F.array(*map(F.lit, (4, 5))), lambda i: F.struct(i.alias("word_index"), F.lit("backchannel").alias("action")))
    assert [d.decision for d in df.select(S.decided(acts, **s.guards())).first()[0]] == ["backchannel"] * 2
