"""Backchannels put into their hosts, against a plain simulation."""

import random

from turnloom.operators import transcripts as R


def plain(speakers, texts, is_bc):
    """Looks in both directions for each backchannel, line by line."""
    lines = [{"s": s, "t": t, "b": b, "gone": False, "host": None, "merged": None} for s, t, b in zip(speakers, texts, is_bc)]

    def near(i, step):
        i += step
        while 0 <= i < len(lines):
            if lines[i]["t"] and not lines[i]["b"]:
                return i
            i += step

    for i, x in enumerate(lines):
        if not x["b"]:
            continue
        a, z = near(i, -1), near(i, 1)
        if a is not None and z is not None and lines[a]["s"] == lines[z]["s"] != x["s"]:
            lines[a]["t"] += " [BACKCHANNEL] " + lines[z]["t"]
            lines[z].update(t="", gone=True)
            x.update(gone=True, host=a, merged=z)
        elif a is not None and lines[a]["s"] != x["s"]:
            lines[a]["t"] += " [BACKCHANNEL]"
            x.update(gone=True, host=a)
        elif z is not None and lines[z]["s"] != x["s"]:
            lines[z]["t"] = "[BACKCHANNEL] " + lines[z]["t"]
            x.update(gone=True, host=z)
        else:
            x["b"] = False
    return [[x[k] for x in lines] for k in ("t", "gone", "host", "merged")]


def talk(rnd, n, letters="AB"):
    speakers = [rnd.choice(letters) for _ in range(n)]
    texts = [rnd.choice(["", f"w{i}", f"w{i} x"]) for i in range(n)]
    return speakers, texts, [0 < i < n - 1 and speakers[i - 1] != speakers[i] != speakers[i + 1] and rnd.random() < 0.6 for i in range(n)]


def test_attach():
    rnd = random.Random(1)
    for _ in range(2000):
        x = talk(rnd, rnd.randint(0, 14), rnd.choice(["AB", "AB?"]))
        assert list(R.attach(*x)) == plain(*x)
    assert R.attach(["A", "B", "A"], ["a", "yeah", "b"], [False, True, False])[0] == ["a [BACKCHANNEL] b", "yeah", ""]


def test_sorted_stream_is_the_whole(spark):
    rnd = random.Random(4)
    rows, want = [], {}
    for c in (None, "c", "d", "e"):
        s, t, b = talk(rnd, 0 if c == "e" else 300)
        texts, gone, host, merged = R.attach(s, t, b)
        for i in range(len(s)):
            key = hash((c, i)) % 10**9
            rows.append((c, i, (c or "") + str(i), s[i], t[i], b[i]))
            at = lambda k: None if k is None else (c or "") + str(k)
            want[(c, i)] = (texts[i], gone[i], at(host[i]), at(merged[i]))
    df = spark.createDataFrame(rows, "c string, k int, id string, sp string, tx string, is_bc boolean")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        got = {(r["c"], r["k"]): (r["tx"], r["gone"], r["host"], r["merged"]) for r in R.attached_backchannels(df, "c", "k", "id", "sp", "tx").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want
    assert R.attached_backchannels(df.limit(0), "c", "k", "id", "sp", "tx").count() == 0


def test_aligned_marks():
    assert R.aligned_marks("a b c".split(), "a| b c|".split()) == [0, 2]
    assert R.aligned_marks("well , I mean it".split(), "well I mean| it|".split()) == [3, 4]
    assert R.aligned_marks("one two three".split(), "zero| one| two".split() + ["extra|", "three|"]) == [0, 2]
    assert R.aligned_marks("a - b".split(), "a - - b|".split()) == [2]
