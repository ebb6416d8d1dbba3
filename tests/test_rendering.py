"""Utterances, hosts and backchannels on small dialogues."""

from pyspark.sql import functions as F

from turnloom.operators import rendering as R

TURNS = "d string, turn int, role string, s string, c array<string>"


def said(spark, rows):
    df = spark.createDataFrame(rows, TURNS).withColumn("seg", F.lit(9)).withColumn("text", F.lit("clash"))
    return R.utterances(df, "d", "turn", "role", "s", F.col("c"), F.lit("okay"))


def told(spark, rows):
    return [(r.role, r.uttr_type, r.text) for r in said(spark, rows).orderBy("idx").collect()]


def test_segments_between_backchannels(spark):
    rows = [("d", 0, "user", "2) user: one two, [BACKCHANNEL] three [BACKCHANNEL]", ["yeah", None]), ("d", 1, "system", "no", []), ("d", 2, "assistant", None, None), ("d", 3, "assistant", "*sighs* fine", None)]
    assert told(spark, rows) == [("user", None, "one two"), ("user", "backchannel", "yeah"), ("user", None, "three"), ("user", "backchannel", "okay"), ("assistant", None, "fine")]


def test_interrupts(spark):
    rows = [("d", 0, "user", "a b c d e [TAKE_FLOOR] f g", []), ("d", 1, "assistant", "x", []), ("d", 2, "user", "a [TAKE_FLOOR] f g h i [BACKCHANNEL]", ["yeah"]), ("d", 3, "assistant", "y", []), ("e", 0, "user", "a [TAKE_FLOOR]", []), ("e", 1, "user", "b", [])]
    got = said(spark, rows).orderBy("d", "idx").collect()
    assert [(r.d, r.uttr_type, r.text) for r in got] == [("d", None, "a b c d e f"), ("d", "interrupt", "x"), ("d", None, "a f g h"), ("d", "interrupt", "y"), ("e", None, "a"), ("e", None, "b")]


def test_fold_gathers_across_backchannels():
    hosts, backs = R.fold([None, "backchannel", None, None], [True] * 4, [2, 1, 3, 4], 0)
    assert [(h["parts"], h["speaker_idx"], h["next_type"]) for h in hosts] == [([0, 2], 0, None), ([3], 1, "last")]
    assert backs == [{"at": 1, "speaker_idx": 1, "word_count": 2, "host_idx": 0}]


def test_fold_without_words():
    # the silent utterance takes the backchannel before it along and flushes what was gathered
    hosts, backs = R.fold([None, "backchannel", None], [True, True, False], [2, 1, 0], 1)
    assert [(h["parts"], h["at"]) for h in hosts] == [([0], 2)] and backs == []
    assert R.fold([], [], [], 0) == ([], [])
    # a backchannel after the last host is held within the hosts, and has none where there are none
    assert R.fold([None, "backchannel", "backchannel"], [True] * 3, [1, 1, 1], 0)[1][1]["host_idx"] == -1
    assert R.fold([None, None, "backchannel"], [True] * 3, [1, 1, 1], 0)[1][0]["host_idx"] == 0
    assert R.fold(["interrupt", None], [True, True], [1, 1], 0)[0][0]["uttr_type"] == "interrupt"


def test_manifests(spark):
    rows = [("d", 0, "assistant", "one [laughter] two [BACKCHANNEL] three.", ["yeah"]), ("d", 1, "user", "four", [])]
    r = R.manifests(said(spark, rows), "d", "role").collect()[0]
    assert [(h.host_idx, h.speaker_idx, h.tts_text) for h in r.hosts] == [(0, 1, "one [laughter] two three."), (1, 0, "four")]
    assert [(b.text, b.word_count, b.host_idx, b.speaker_idx, b.next_uttr_type_of_host) for b in r.backchannels] == [("yeah?", 2, 0, 0, None)]
    assert R.manifests(said(spark, []), "d", "role").count() == 0


def test_units(spark):
    df = spark.createDataFrame([("Hi there. [PAUSE] now [sigh][MASK1]? yes",), ("[PAUSE]",), ("",), (None,)], "t string")
    got = [[(u.kind, u.unit_id, u.text) for u in r[0] or []] for r in df.select(R.units(F.col("t"), F.lit(3))).collect()]
    assert got == [[("text", "u_3_0", "Hi there."), ("pause", "u_3_1", ""), ("text", "u_3_2", "now ?"), ("text", "u_3_3", "yes")], [("pause", "u_3_0", "")], [], []]
    kept = df.limit(1).select(R.units(F.col("t"), F.lit(0), ("sigh",))).collect()[0][0]
    assert kept[2].text == "now [sigh]?"
