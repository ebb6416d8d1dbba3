"""Problem 10: kinds and statistics of small texts."""

import pytest
from pyspark.sql import functions as F

from turnloom.llm.quality import Profiles, divergence, text_stats, weigh

COMMON = [("en", i, w) for i, w in enumerate("the of and to a in is that for it was on with as you not we this but they have from".split(), 1)] + [("vi", i, w) for i, w in enumerate("và là của có không được cho một những với".split(), 1)] + [("ja", i, w) for i, w in enumerate("は が を に の で と も です ます".split(), 1)]
P = Profiles(COMMON)
PROSE = "We ran out of time for the survey, and they have not seen it. This is the last of the drawings that you wanted to have from us."
CASES = {
    "prose": [PROSE, "A: " + PROSE + "\nB: " + PROSE.replace("survey", "map"), PROSE.lower().replace(".", "").replace(",", ""), PROSE + "\n- one\n- two\n" + PROSE.replace("time", "paper"), "私は東京に住んでいます。友だちと昼ごはんを食べました。", "Không, tôi có một người bạn và những cuốn sách của mình với bạn."],
    "list": ["- the map\n- the loan\n- a broken lamp\n- the tent", "1) yes\n2) the second exercise\n3) the poster\n4) no", "the map, the loan, a broken lamp, the tent, the poster, the last lens", "[x] tent\n[ ] map\n[x] a lamp"],
    "table": ["a\tb\tc\n1\tx\t3\n2\ty\t4\n3\tz\t5", "| a | b |\n| --- | --- |\n| 1 | x |\n| 2 | y |\n| 3 | z |", "0;Nim;silence;0.3\n1;Tam;pause;0.6\n2;Osk;pause;0.2", "name    size    kind\nab      12      x\ncd      13      y\nef      14      z"],
    "junk": ["wwuakw d; zzljw igrdd kh ;atogzdkf rklapzd ef;akph qokuig;u; ff dpq;uzghk eoae;aot ilojkwwwkeh", "the the " * 40, "04:44:15 INFO worker[22] unit=u_17 rc=-8 0x46f9\n12:18:19 DEBUG worker[44] unit=u_2 rc=1 0x2d42", "hÃ´m qua khÃ´ng ká»‹p lÃ m buá»•i cháº¡y tá»« thiá»‡n á»Ÿ Ä‘Ã³", '<div class="c86"><span id="2d">&nbsp;</span></div>' * 5, '[{"k24":20257,"v":[85,426]},{"k64":35739,"v":[438,374]}]', "=========\n#########\n*********", "Z1d+GqwZhDqfcM+Sm7zAIlCpP5HGdKYQbeWh8+nk30zYHIuLguyT1Aa0fpR+Upnsh3hg"],
}


@pytest.mark.parametrize("kind,text", [(k, t) for k, ts in CASES.items() for t in ts])
def test_kinds(kind, text):
    assert weigh(text, P)["kind"] == kind


def test_divergence():
    assert divergence((0.5, 0.5), (0.5, 0.5)) == 0 and divergence((1, 0), (0, 1)) == 1


def test_frame(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n"), (4, "The cat is in the hat."), (5, PROSE * 3000)], "doc_id bigint, text string").withColumn("kind", F.lit("clash"))
    got = {r.doc_id: r for r in text_stats(df, COMMON).collect()}
    assert [got[i].kind for i in (1, 2, 3, 4)] == [None, None, None, "prose"] and got[1].n_words == 0
    assert got[4].n_words == 6 and got[4].mean_word_len == pytest.approx(16 / 6) and got[4].punct_line_share == 1.0 and got[4].symbol_ratio == pytest.approx(1 / 17) and got[4].common_word_share == pytest.approx(4 / 6)
    assert text_stats(df.limit(0), COMMON).count() == 0 and text_stats(df, []).count() == 5


def test_fitted_profiles_keep_the_kinds():
    from turnloom.llm.quality import fitted

    texts = [t.replace("the", f"the {i}") for i in range(30) for ts in CASES.values() for t in ts]
    own = fitted(Profiles(COMMON), [*texts, None, "", " "])
    assert own.structures["prose"] != P.structures["prose"] and len(own.classes) >= 1
    assert all(weigh(t, own)["kind"] == k for k in ("list", "table", "junk") for t in CASES[k][:2])
    assert fitted(Profiles(COMMON), []).structures == P.structures


def test_profiles_are_fitted_on_every_text(spark):
    """40 texts in 4,000 are lists of one structure; only a fit on all of them knows their mean to the last text."""
    from turnloom.llm import quality as Q

    rows = [(i, PROSE.replace("time", f"time {i}") + "\n- one\n- two" * (i % 3), "en") for i in range(4000)]
    rows += [(4000 + i, "\n".join([PROSE] * (i % 2) + [f"- item {i}"] * 20), "en") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(7)
    seen = []
    fitted_on = Q.fitted_on

    def noted(*args):
        seen.append(fitted_on(*args))
        return seen[0]

    Q.fitted_on = noted
    try:
        got = {r.doc_id: r.kind for r in Q.text_stats(df, COMMON, fit=True).collect()}
    finally:
        Q.fitted_on = fitted_on
    own = Q.fitted(Profiles(COMMON), [t for _, t, _ in rows])
    assert seen[0].structures == own.structures and seen[0].classes == own.classes and seen[0].others == own.others
    assert len(got) == 4040 and got == {i: weigh(t, own)["kind"] for i, t, _ in rows}
