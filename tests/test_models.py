"""Services behind interfaces: routing, retries, pacing, gates, judges and loops."""

import pytest
from pyspark.sql import functions as F

from turnloom.operators import models as M


def test_routing():
    assert [M.backend_of(x) for x in ("gpt-5", "o3-mini", "gemini-2.5-pro", "my-claude-x", "anthropic/x", "Qwen/Qwen3", "o5")] == ["openai", "openai", "gemini", "anthropic", "anthropic", "hosted", "hosted"]
    assert M.model_for({"judge_model": None, "model": "m"}, "judge_model", "d") == "m" and M.model_for(None, "x", "d") == "d" and M.model_for({"x": "own", "model": "m"}, "x", "d") == "own"
    assert M.request_options("Qwen", False) == {"chat_template_kwargs": {"enable_thinking": False}} and M.request_options("gemini-x", False) == {"google_thinking_budget": 0}
    assert M.request_options("gpt-5", False) is None and M.request_options("Qwen", True) is None
    assert M.client_for("gpt-5", {"openai": lambda m: ("client", m)}) == ("client", "gpt-5")
    with pytest.raises(ValueError, match="hosted"):
        M.client_for("Qwen", {})


def test_backoff_and_pace():
    slept = []
    b = M.Backoff(attempts=4, first=1.0, most=50.0, sleep=slept.append)
    assert [b.wait(0, "x"), b.wait(3, "x"), b.wait(0, "429 retry in 12.5s"), b.wait(0, "429"), b.wait(9, "x")] == [1.0, 8.0, 12.5, 30.0, 50.0] == slept
    now = iter([0.0, 1.0, 3.0, 9.0, 9.0])
    p = M.Pace(2.5, clock=lambda: next(now), sleep=slept.append)
    del slept[:]
    p.hold(), p.hold(), p.hold()
    assert slept == [1.5]


class Fussy:
    """Fails on 'bad', counts its calls in a file."""

    def __init__(self, path):
        self.path = path

    def __call__(self, f):
        with open(self.path, "a") as out:
            out.write(f"{len(f)}\n")
        if (f["x"] == "bad").any():
            raise ValueError("429 bad")
        return [x.upper() for x in f["x"]]


def test_bad_rows_cost_few_calls(spark, tmp_path):
    rows = [(i, None if i == 3 else "bad" if i == 40 else f"v{i}") for i in range(64)]
    df = spark.createDataFrame(rows, "i int, x string").coalesce(1)
    calls = tmp_path / "calls"
    got = {r.i: r for r in M.in_batches(df, "x", Fussy(str(calls)), "y", "string", "-", backoff=M.Backoff(attempts=2, most=0.0)).collect()}
    assert got[3].status == "fallback" and got[3].error == "no input" and got[40].status == "fallback" and "429" in got[40].error and got[40].y == "-"
    assert all(got[i].status == "ok" and got[i].y == f"V{i}" for i in range(64) if i not in (3, 40))
    assert len(calls.read_text().split()) <= 2 * 7 + 2
    sizes = tmp_path / "sizes"
    M.in_batches(df.where("x != 'bad'"), "x", Fussy(str(sizes)), "y", "string", size=10).collect()
    assert max(map(int, sizes.read_text().split())) == 10
    assert M.in_batches(df.limit(0), "x", len, "y", "string").count() == 0


class Yes:
    def generate(self, chats, temperature):
        if any("fail" in c[0][1] for c in chats):
            raise RuntimeError("down")
        return ["Yes" if "a" in c[0][1] else "no" for c in chats]


def test_gate(spark):
    df = spark.createDataFrame([("a",), ("b",), ("",), (None,), ("fail a",)], "p string")
    assert [r.p for r in M.gated(df, "p", Yes()).collect()] == ["a"] and M.gated(df, "p", None).count() == 5


def test_answers():
    assert M.read_turns('{"turns": [{"role": "user"}]}') == [{"role": "user"}] == M.read_turns('Sure: [{"role": "user"}, 3] ok')
    assert M.read_turns(None) == M.read_turns("no") == M.read_turns('{"a": 1}') == []
    assert M.is_done('x {"done": true, "stop": false} y') and not M.is_done('{"done": "true"}') and not M.is_done('{"stop": true}') and not M.is_done("") and not M.is_done("[1]")


class Stubborn:
    """Answers with a role until it was told twice."""

    seen: list = []

    def generate(self, chats, temperature):
        self.seen.append((len(chats[0]), round(temperature, 2)))
        return ["user: hi" if len(chats[0]) < 3 or temperature < 0.89 else "hi"]


def test_clean_turn():
    ok = lambda s: not s.startswith("user:")
    g = Stubborn()
    assert M.clean_turn(g, "p", ok, lambda s: s.removeprefix("user: ")) == ("hi", 3) and g.seen == [(1, 0.7), (3, 0.8), (3, 0.9)]
    assert M.clean_turn(g, "p", ok, lambda s: s.removeprefix("user: "), attempts=2) == ("hi", 2)


class Broken:
    def generate(self, chats, temperature):
        raise RuntimeError("down")


def test_loop_ends(spark):
    df = spark.createDataFrame([(1, [("user", str(i)) for i in range(250)]), (2, None), (3, [("user", None), ("assistant", "b")])], "k int, h array<struct<role:string,content:string>>")

    def turns(**kw):
        out = M.rewritten(df, "k", "h", M.EchoGenerator(), lambda s: True, str.strip, **kw)
        return {r.k: r.n for r in out.groupBy("k").agg(F.count("*").alias("n")).collect()}

    assert turns() == {1: 250, 3: 2} == turns(judge=Broken(), stop_every=2) == turns(max_turns=0)
    assert turns(max_turns=7) == {1: 7, 3: 2} and turns(judge=M.HalfJudge(), stop_every=10, stop_from=4) == {1: 130, 3: 2}


class Talker:
    def generate(self, chats, temperature):
        return [{"a": ' "Yeah" ', "b": "<think>x</think>\nMm-hmm", "c": "The listener says yes!"}[c[0][1]] for c in chats]


def test_backchannels(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "p string").withColumn("f", F.lit("okay"))
    got = {r.p: (r.backchannel, r.status) for r in M.backchannels(df, "p", Talker(), "f").collect()}
    assert got == {"a": ("yeah", "ok"), "b": ("mm-hmm", "ok"), "c": ("okay", "fallback"), None: ("okay", "fallback")}
