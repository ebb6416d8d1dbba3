"""Rendering manifests, alignments and timelines."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from turnloom.functions import text as X
from turnloom.operators import timeline as L
from turnloom.plans import common as C
from turnloom.plans import slots as P
from turnloom.plans.common import q, sql_strip, sql_words, sql_ws
from turnloom.registry import Registry
from turnloom.session import few, table

registry = Registry()
M = f"WITH {C.SQL_MANIFEST}"
UNIT = ["dialogue_id", "variant_idx"]
HOST = "h AS (SELECT *, row_number() OVER (PARTITION BY dialogue_id, variant_idx ORDER BY turn, text_idx, utterance_id) - 1 AS host_idx FROM u)"


def hosts(spark, sf_dir):
    """Utterances with their place among a variant's hosts, from 0."""
    w = Window.partitionBy(*UNIT).orderBy("turn", "text_idx", "utterance_id")
    return C.utterances(spark, sf_dir).withColumn("host_idx", F.row_number().over(w) - 1)


@registry.query("w2_next_type", f"{M}, {HOST} SELECT utterance_id, CASE WHEN lead(utterance_id) OVER w IS NULL THEN 'last' ELSE lead(uttr_type) OVER w END AS next_type, CASE WHEN lag(utterance_id) OVER w IS NULL THEN 'first' ELSE lag(uttr_type) OVER w END AS prev_type FROM h WINDOW w AS (PARTITION BY dialogue_id, variant_idx ORDER BY host_idx)")
def w2_next_type(spark, sf_dir):
    """The type of the utterance after and before each; null is a type, so ends are marked."""
    w = Window.partitionBy(*UNIT).orderBy("host_idx")
    nxt = F.when(F.lead("utterance_id").over(w).isNull(), "last").otherwise(F.lead("uttr_type").over(w))
    prv = F.when(F.lag("utterance_id").over(w).isNull(), "first").otherwise(F.lag("uttr_type").over(w))
    return hosts(spark, sf_dir).select("utterance_id", nxt.alias("next_type"), prv.alias("prev_type"))


@registry.query("proj16_channel_flip", f"{M} SELECT utterance_id, CAST(1 - speaker_idx AS INTEGER) AS channel, CASE speaker_idx WHEN 0 THEN 'user' WHEN 1 THEN 'assistant' END AS speaker FROM u")
def proj16_channel_flip(spark, sf_dir):
    """Speakers on flipped channels."""
    return C.utterances(spark, sf_dir).select("utterance_id", (1 - F.col("speaker_idx")).alias("channel"), F.when(F.col("speaker_idx") == 0, "user").when(F.col("speaker_idx") == 1, "assistant").alias("speaker"))


@registry.query("j8_backchannels_of_hosts", f"{M}, {HOST} SELECT h.utterance_id, count(b.backchannel_id) AS n, coalesce(string_agg(b.text, '|' ORDER BY b.bc_idx, b.backchannel_id), '') AS texts FROM h LEFT JOIN b ON b.dialogue_id = h.dialogue_id AND b.variant_idx = h.variant_idx AND b.host_idx = h.host_idx GROUP BY h.utterance_id")
def j8_backchannels_of_hosts(spark, sf_dir):
    """Backchannels joined to the utterance that hosts them."""
    b = C.backchannels(spark, sf_dir).select(*UNIT, "host_idx", "backchannel_id", "bc_idx", "text")
    joined = hosts(spark, sf_dir).select("utterance_id", *UNIT, "host_idx").join(b, [*UNIT, "host_idx"], "left")
    g = joined.groupBy("utterance_id").agg(F.count("backchannel_id").alias("n"), F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("bc_idx", "backchannel_id", "text")))).alias("t"))
    return g.select("utterance_id", "n", F.array_join("t.text", "|").alias("texts"))


@registry.query("j9_unit_audio", f"{M}, x AS (SELECT utterance_id, voice_id, unnest(units) AS x FROM u) SELECT utterance_id, x.unit_id AS unit_id, v.wav AS wav FROM x JOIN (SELECT voice_id, max(wav) AS wav FROM voices GROUP BY 1) v ON v.voice_id = x.voice_id WHERE x.kind = 'text'")
def j9_unit_audio(spark, sf_dir):
    """Units joined to the file of their voice; units without one are left out."""
    v = table(spark, sf_dir, "voices").groupBy("voice_id").agg(F.max("wav").alias("wav"))
    x = C.utterances(spark, sf_dir).select("utterance_id", "voice_id", F.explode("units").alias("x")).where("x.kind = 'text'")
    return x.join(v, "voice_id").select("utterance_id", F.col("x.unit_id").alias("unit_id"), "wav")


@registry.query("j10_span_of_position", f"""{M}, w AS (SELECT utterance_id, {sql_words('tts_text')} AS ws FROM u WHERE tts_text IS NOT NULL), k AS (SELECT utterance_id, ws, unnest(generate_series(1, len(ws))) AS i FROM w),
s AS (SELECT utterance_id, i - 1 AS word_index, coalesce(sum(length(ws[i]) + 1) OVER (PARTITION BY utterance_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a, sum(length(ws[i]) + 1) OVER (PARTITION BY utterance_id ORDER BY i) AS e FROM k), p AS (SELECT unnest([10, 25, 60]) AS pos)
SELECT utterance_id, pos, CAST(min(word_index) AS INTEGER) AS word_index FROM s JOIN p ON a < pos AND pos <= e GROUP BY utterance_id, pos""")
def j10_span_of_position(spark, sf_dir):
    """The word whose span covers a character position: a range join within the row."""
    ws = X.words(F.col("tts_text"))
    ends = F.aggregate(ws, F.array().cast("array<int>"), lambda a, w: F.concat(a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)) + F.length(w) + 1)))
    rows = C.utterances(spark, sf_dir).where("tts_text IS NOT NULL").select("utterance_id", ends.alias("ends"))
    rows = rows.select("utterance_id", "ends", F.explode(F.array(*map(F.lit, (10, 25, 60)))).alias("pos")).where(F.array_max("ends") >= F.col("pos"))
    return rows.select("utterance_id", "pos", (F.array_position(F.transform("ends", lambda e: e >= F.col("pos")), True) - 1).cast("int").alias("word_index"))


@registry.query("j11_backchannel_anchor", f"{M}, {HOST}, w AS (SELECT dialogue_id, variant_idx, host_idx, {sql_words('tts_text')} AS ws FROM h WHERE tts_text IS NOT NULL) SELECT backchannel_id, ws[greatest(0, least(word_count - 1, len(ws) - 2)) + 1] AS anchor FROM b JOIN w USING (dialogue_id, variant_idx, host_idx) WHERE len(ws) > 0 AND word_count IS NOT NULL")
def j11_backchannel_anchor(spark, sf_dir):
    """The host word that each backchannel is anchored to."""
    h = hosts(spark, sf_dir).where("tts_text IS NOT NULL").select(*UNIT, "host_idx", X.words(F.col("tts_text")).alias("ws")).where("size(ws) > 0")
    i = F.greatest(F.lit(0), F.least(F.col("word_count") - 1, F.size("ws") - 2))
    return C.backchannels(spark, sf_dir).where("word_count IS NOT NULL").join(h, [*UNIT, "host_idx"]).select("backchannel_id", F.get("ws", i).alias("anchor"))


@registry.query("j13_voice_cast", "WITH d AS (SELECT DISTINCT record_id, dataset FROM dialogues), v AS (SELECT voice_id, row_number() OVER (ORDER BY voice_id) - 1 AS k, count(*) OVER () AS n FROM (SELECT DISTINCT voice_id FROM voices)), c AS (SELECT record_id, CAST(('0x' || substr(md5('42|' || CAST(record_id AS VARCHAR)), 1, 8)) AS UBIGINT) AS h FROM d), p AS (SELECT record_id, h % n AS i, (h % n + 1 + (h // n) % (n - 1)) % n AS j FROM c, (SELECT max(n) AS n FROM v)) SELECT record_id, a.voice_id AS user_voice, b.voice_id AS assistant_voice FROM p JOIN v a ON a.k = p.i JOIN v b ON b.k = p.j")
def j13_voice_cast(spark, sf_dir):
    """Two different voices for each dialogue, by its hash."""
    # one row a voice, of which the pool has a few hundred; more than 100,000 are an error
    few(table(spark, sf_dir, "voices").select("voice_id").distinct(), 100_000, "voices")
    v = table(spark, sf_dir, "voices").select("voice_id").distinct().withColumn("k", F.row_number().over(Window.orderBy("voice_id")) - 1)
    n = v.count()
    h = F.conv(F.substring(F.md5(F.concat(F.lit("42|"), F.col("record_id").cast("string"))), 1, 8), 16, 10).cast("bigint")
    d = C.dialogues(spark, sf_dir).select("record_id", (h % n).alias("i"), ((h % n + 1 + F.floor(h / n) % max(n - 1, 1)) % n).alias("j"))
    a, b = v.select(F.col("voice_id").alias("user_voice"), F.col("k").alias("i")), v.select(F.col("voice_id").alias("assistant_voice"), F.col("k").alias("j"))
    return d.join(F.broadcast(a), "i").join(F.broadcast(b), "j").select("record_id", "user_voice", "assistant_voice")


@registry.query("j14_excluded_voices", f"{M} SELECT utterance_id FROM u WHERE voice_id IS NOT NULL AND voice_id NOT IN (SELECT voice_id FROM voices WHERE txt IS NULL)")
def j14_excluded_voices(spark, sf_dir):
    """Utterances whose voice isn't excluded."""
    out = table(spark, sf_dir, "voices").where("txt IS NULL").select("voice_id").distinct()
    return C.utterances(spark, sf_dir).where("voice_id IS NOT NULL").join(out, "voice_id", "left_anti").select("utterance_id")


_LEN = "CAST(length(tts_text) * 1440 AS BIGINT)"


@registry.query("w12_unit_spans", f"{M}, x AS (SELECT utterance_id, unnest(units) AS x, generate_subscripts(units, 1) - 1 AS pos FROM u), n AS (SELECT utterance_id, pos, CASE WHEN x.kind = 'pause' THEN 7200 ELSE length(coalesce(x.text, '')) * 1440 END AS n FROM x) SELECT utterance_id, CAST(pos AS INTEGER) AS pos, CAST(sum(n) OVER w - n AS BIGINT) AS start, CAST(sum(n) OVER w AS BIGINT) AS \"end\" FROM n WINDOW w AS (PARTITION BY utterance_id ORDER BY pos ROWS UNBOUNDED PRECEDING)")
def w12_unit_spans(spark, sf_dir):
    """The span of each unit in its utterance, by adding up lengths."""
    x = C.utterances(spark, sf_dir).select("utterance_id", F.posexplode("units").alias("pos", "x"))
    n = F.when(F.col("x.kind") == "pause", 7200).otherwise(F.length(F.coalesce("x.text", F.lit(""))) * 1440).cast("bigint")
    return L.cumulative(x.withColumn("n", n), ["utterance_id"], ["pos"], F.col("n")).select("utterance_id", "pos", "start", "end")


@registry.query("x28_even_word_times", f"WITH a AS (SELECT DISTINCT align_id, text, start_sec, end_sec FROM alignment_turns WHERE end_sec >= start_sec AND text IS NOT NULL), w AS (SELECT align_id, start_sec, end_sec, {sql_words('text')} AS ws FROM a), k AS (SELECT *, unnest(generate_series(1, len(ws))) - 1 AS i FROM w) SELECT align_id, CAST(i AS INTEGER) AS word_no, ws[i + 1] AS word, CAST(floor((start_sec + (end_sec - start_sec) / len(ws) * i) * 1000) AS BIGINT) AS start_ms FROM k")
def x28_even_word_times(spark, sf_dir):
    """Words spread evenly over their interval."""
    a = table(spark, sf_dir, "alignment_turns").where("end_sec >= start_sec AND text IS NOT NULL").dropDuplicates(["align_id"])
    times = L.even_words(X.words(F.col("text")), F.col("start_sec"), F.col("end_sec"))
    ws = X.words(F.col("text"))
    rows = a.where(F.size(ws) > 0).select("align_id", "start_sec", "end_sec", ws.alias("ws"), F.posexplode(times).alias("word_no", "t"))
    return rows.select("align_id", "word_no", F.col("t.word").alias("word"), F.floor((F.col("start_sec") + (F.col("end_sec") - F.col("start_sec")) / F.size("ws") * F.col("word_no")) * 1000).cast("bigint").alias("start_ms"))


@registry.query("m8_backchannel_cache", f"{M}, k AS (SELECT backchannel_id, speaker_idx, lower(regexp_replace(text, '^[\\s.,!?\\-]+|[\\s.,!?\\-]+$', '', 'g')) AS key FROM b WHERE text IS NOT NULL) SELECT speaker_idx, key, count(*) AS uses, min(backchannel_id) AS rendered FROM k GROUP BY speaker_idx, key")
def m8_backchannel_cache(spark, sf_dir):
    """Backchannels to render once each, and how often each is used."""
    b = C.backchannels(spark, sf_dir).where("text IS NOT NULL").select("backchannel_id", "speaker_idx", X.backchannel_key(F.col("text")).alias("key"))
    return b.groupBy("speaker_idx", "key").agg(F.count("*").alias("uses"), F.min("backchannel_id").alias("rendered"))


_SPLIT_OF = "SELECT example_id, min(dataset) AS dataset, min(lower(split)) AS split FROM dialogues WHERE example_id IS NOT NULL GROUP BY example_id"
_ID = "coalesce(dataset, 'none') || '__' || coalesce(split, 'none') || '__' || dialogue_id || '__var' || lpad(CAST(variant_idx AS VARCHAR), 2, '0') || '__'"


@registry.query("proj15_work_queue", f"""{M}, k AS ({_SPLIT_OF}), r AS (SELECT utterance_id AS row_id, dialogue_id, variant_idx, language_id, speaker_idx, unnest(units) AS x FROM u)
SELECT 'u' AS kind, row_id, {_ID} || x.unit_id AS id, x.text AS text, CASE speaker_idx WHEN 0 THEN 'user' ELSE 'assistant' END AS speaker, CASE WHEN lower(language_id) LIKE 'vi%' THEN 'vi' ELSE 'en' END AS language_id, 1.2 AS speed FROM r LEFT JOIN k ON k.example_id = r.dialogue_id WHERE x.kind = 'text'
UNION ALL SELECT 'b', backchannel_id, {_ID} || unit_id, text, CASE speaker_idx WHEN 0 THEN 'user' ELSE 'assistant' END, 'en', 1.2 FROM b LEFT JOIN k ON k.example_id = b.dialogue_id""")
def proj15_work_queue(spark, sf_dir):
    """A row for each text unit and backchannel to render, whose id tells dataset, split, dialogue, variant and unit; pauses are none (K5)."""
    of = table(spark, sf_dir, "dialogues").where("example_id IS NOT NULL").groupBy("example_id").agg(F.min("dataset").alias("dataset"), F.min(F.lower("split")).alias("split"))
    speaker = F.when(F.col("speaker_idx") == 0, "user").otherwise("assistant").alias("speaker")
    u = C.utterances(spark, sf_dir).select("utterance_id", *UNIT, "language_id", "speaker_idx", F.explode("units").alias("x")).where("x.kind = 'text'")
    lang = F.when(F.lower("language_id").like("vi%"), "vi").otherwise("en")
    u = u.select(F.lit("u").alias("kind"), F.col("utterance_id").alias("row_id"), *UNIT, F.col("x.unit_id").alias("unit"), F.col("x.text").alias("text"), speaker, lang.alias("language_id"))
    b = C.backchannels(spark, sf_dir).select(F.lit("b").alias("kind"), F.col("backchannel_id").alias("row_id"), *UNIT, F.col("unit_id").alias("unit"), "text", speaker, F.lit("en").alias("language_id"))
    rows = u.unionByName(b).join(of, F.col("dialogue_id") == F.col("example_id"), "left")
    none = F.lit("none")
    ident = F.concat(F.coalesce("dataset", none), F.lit("__"), F.coalesce("split", none), F.lit("__"), F.col("dialogue_id"), F.lit("__var"), F.lpad(F.col("variant_idx").cast("string"), 2, "0"), F.lit("__"), F.col("unit"))
    return rows.select("kind", "row_id", ident.alias("id"), "text", "speaker", "language_id", F.lit(1.2).alias("speed"))


_GAP = f"CAST(floor(round(least(greatest(-0.16 * ln(1 - {C.sql_uniform('utterance_id', chr(39) + 'gap' + chr(39))}), 0.02), 1.0), 4) * 24000 + 0.5) AS BIGINT)"
_OVER = f"CAST(floor(round(least(greatest(0.45 + 0.05 * sqrt(-2 * ln(1 - {C.sql_uniform('utterance_id', chr(39) + 'o1' + chr(39))})) * cos(2 * pi() * {C.sql_uniform('utterance_id', chr(39) + 'o2' + chr(39))}), 0.0), 1.0), 4) * 24000 + 0.5) AS BIGINT)"


@registry.query("w9_timeline", f"""WITH RECURSIVE {C.SQL_MANIFEST}, {HOST}, x AS MATERIALIZED (SELECT dialogue_id, variant_idx, speaker_idx, uttr_type, {_LEN} AS n, {_GAP} AS gap, {_OVER} AS ov, row_number() OVER (PARTITION BY dialogue_id, variant_idx ORDER BY host_idx) AS k, host_idx FROM h WHERE tts_text IS NOT NULL),
f AS (SELECT dialogue_id, variant_idx, k, host_idx, speaker_idx AS s, 'none' AS timing, CAST(0 AS BIGINT) AS start_sample, n AS fin FROM x WHERE k = 1
UNION ALL SELECT x.dialogue_id, x.variant_idx, x.k, x.host_idx, x.speaker_idx, CASE WHEN x.speaker_idx IS NOT DISTINCT FROM f.s THEN 'pause' WHEN x.uttr_type = 'interrupt' THEN 'overlap' ELSE 'gap' END,
 CASE WHEN x.speaker_idx IS NOT DISTINCT FROM f.s THEN f.fin WHEN x.uttr_type = 'interrupt' THEN f.fin - least(x.ov, f.fin, x.n) ELSE f.fin + x.gap END,
 x.n + CASE WHEN x.speaker_idx IS NOT DISTINCT FROM f.s THEN f.fin WHEN x.uttr_type = 'interrupt' THEN f.fin - least(x.ov, f.fin, x.n) ELSE f.fin + x.gap END
 FROM f JOIN x ON x.dialogue_id = f.dialogue_id AND x.variant_idx = f.variant_idx AND x.k = f.k + 1) SELECT dialogue_id, variant_idx, host_idx, timing, start_sample FROM f""")
def w9_timeline(spark, sf_dir):
    """Where each utterance starts: sampled gaps and overlaps, by the hash of its id."""
    key = F.col("utterance_id")
    u = lambda tag: X.uniform(key, F.lit(tag))
    rows = hosts(spark, sf_dir).where("tts_text IS NOT NULL").withColumn("n", (F.length("tts_text") * 1440).cast("bigint"))
    rows = rows.withColumn("gap", L.in_samples(L.sampled_gap(u("gap")))).withColumn("overlap", L.in_samples(L.sampled_overlap(u("o1"), u("o2"))))
    return L.placed(rows, UNIT, ["host_idx"], "speaker_idx", "uttr_type", "n", "gap", "overlap")


_QUEUE = f"""q AS MATERIALIZED (SELECT b.dialogue_id, b.variant_idx, b.host_idx, backchannel_id, utterance_id, next_uttr_type_of_host AS nxt, length(tts_text) * 1440 AS host_n, length(b.text) * 1440 AS n, (greatest(0, least(word_count - 1, len(ws) - 2)) + 1) * (length(tts_text) * 1440) // len(ws) AS p,
  row_number() OVER (PARTITION BY b.dialogue_id, b.variant_idx, b.host_idx ORDER BY bc_idx, backchannel_id) AS k, count(*) OVER (PARTITION BY b.dialogue_id, b.variant_idx, b.host_idx) AS total
  FROM b JOIN (SELECT *, {sql_words('tts_text')} AS ws FROM h WHERE tts_text IS NOT NULL) h ON h.dialogue_id = b.dialogue_id AND h.variant_idx = b.variant_idx AND h.host_idx = b.host_idx WHERE b.text IS NOT NULL AND word_count IS NOT NULL AND len(ws) > 0),
f AS (SELECT q.*, greatest(p, 0) AS beg, CASE WHEN greatest(p, 0) + n >= host_n AND total = 1 AND nxt = 'interrupt' THEN 0 ELSE greatest(p, 0) + n END AS cur, greatest(p, 0) + n >= host_n AND total = 1 AND coalesce(nxt = 'interrupt', false) AS gone FROM q WHERE k = 1),
g AS (SELECT * FROM f UNION ALL SELECT q.*, greatest(q.p, g.cur), CASE WHEN greatest(q.p, g.cur) + q.n >= q.host_n AND q.k = q.total AND q.nxt = 'interrupt' THEN g.cur ELSE greatest(q.p, g.cur) + q.n END, greatest(q.p, g.cur) + q.n >= q.host_n AND q.k = q.total AND coalesce(q.nxt = 'interrupt', false) FROM g JOIN q ON q.dialogue_id = g.dialogue_id AND q.variant_idx = g.variant_idx AND q.host_idx = g.host_idx AND q.k = g.k + 1)"""


def queued(spark, sf_dir):
    """The backchannels of each host in order, with their anchors: the end of a word when words are even."""
    h = hosts(spark, sf_dir).where("tts_text IS NOT NULL").select("utterance_id", *UNIT, "host_idx", X.words(F.col("tts_text")).alias("ws"), (F.length("tts_text") * 1440).cast("bigint").alias("host_n")).where("size(ws) > 0")
    b = C.backchannels(spark, sf_dir).where("text IS NOT NULL AND word_count IS NOT NULL")
    at = F.greatest(F.lit(0), F.least(F.col("word_count") - 1, F.size("ws") - 2)) + 1
    rows = b.join(h, [*UNIT, "host_idx"]).withColumn("p", F.floor(at * F.col("host_n") / F.size("ws")).cast("bigint"))
    item = F.struct("bc_idx", "backchannel_id", "p", (F.length("text") * 1440).cast("bigint").alias("n"))
    g = rows.groupBy("utterance_id").agg(F.first("host_n").alias("host_n"), F.max_by("next_uttr_type_of_host", F.struct("bc_idx", "backchannel_id")).alias("nxt"), F.array_sort(F.collect_list(item)).alias("b"))
    placed = L.backchannels_placed(F.transform("b", lambda x: x["p"]), F.transform("b", lambda x: x["n"]), F.col("host_n"), F.coalesce(F.col("nxt") == "interrupt", F.lit(False)))
    return g.withColumn("placed", placed)


@registry.query("w10_backchannel_starts", f"WITH RECURSIVE {C.SQL_MANIFEST}, {HOST}, {_QUEUE} SELECT backchannel_id, CAST(CASE WHEN NOT gone THEN beg END AS BIGINT) AS start_sample FROM g")
def w10_backchannel_starts(spark, sf_dir):
    """Where each backchannel starts: at its anchor or after the one before; null for a last one that a next interrupt leaves no room."""
    rows = queued(spark, sf_dir).select(F.explode(F.arrays_zip(F.col("b.backchannel_id").alias("backchannel_id"), F.col("placed.starts").alias("start_sample"))).alias("z"))
    return rows.select("z.backchannel_id", "z.start_sample")


@registry.query("w10_grown_hosts", f"WITH RECURSIVE {C.SQL_MANIFEST}, {HOST}, {_QUEUE} SELECT utterance_id, CAST(max(host_n) AS BIGINT) AS samples, CAST(greatest(max(host_n), max(CASE WHEN NOT gone THEN beg + n ELSE 0 END)) AS BIGINT) AS grown FROM g GROUP BY utterance_id")
def w10_grown_hosts(spark, sf_dir):
    """Hosts with backchannels, and how long they are once these fit."""
    return queued(spark, sf_dir).select("utterance_id", F.col("host_n").alias("samples"), F.col("placed.length").alias("grown"))


@registry.query("w11_word_times", f"WITH {C.SQL_MANIFEST}, x AS (SELECT utterance_id, unnest(units) AS x, generate_subscripts(units, 1) - 1 AS pos FROM u), n AS (SELECT utterance_id, pos, x, CASE WHEN x.kind = 'pause' THEN 7200 ELSE length(coalesce(x.text, '')) * 1440 END AS n FROM x), s AS (SELECT *, sum(n) OVER (PARTITION BY utterance_id ORDER BY pos ROWS UNBOUNDED PRECEDING) - n AS start FROM n), w AS (SELECT utterance_id, pos, n, start, {sql_words('x.text')} AS ws FROM s WHERE x.kind = 'text' AND x.text IS NOT NULL), k AS (SELECT *, unnest(generate_series(1, len(ws))) - 1 AS i FROM w) SELECT utterance_id, CAST(pos AS INTEGER) AS pos, CAST(i AS INTEGER) AS word_no, ws[i + 1] AS word, CAST((start + n * i // len(ws)) // 24 AS BIGINT) AS start_ms FROM k")
def w11_word_times(spark, sf_dir):
    """The words of each unit with their times in the utterance: the unit's start is added to the times in the unit."""
    x = w12_unit_spans(spark, sf_dir).join(C.utterances(spark, sf_dir).select("utterance_id", F.posexplode("units").alias("pos", "x")), ["utterance_id", "pos"]).where("x.kind = 'text' AND x.text IS NOT NULL")
    x = x.select("utterance_id", "pos", "start", (F.col("end") - F.col("start")).alias("n"), X.words(F.col("x.text")).alias("ws"))
    x = x.select("utterance_id", "pos", "start", "n", F.size("ws").alias("k"), F.posexplode("ws").alias("word_no", "word"))
    within = F.floor(F.col("n") * F.col("word_no") / F.col("k"))
    return x.select("utterance_id", "pos", "word_no", "word", F.floor((F.col("start") + within) / 24).cast("bigint").alias("start_ms"))


@registry.query("w16_repetitions", f"WITH {C.SQL_MANIFEST}, w AS (SELECT utterance_id, [lower(z) FOR z IN {sql_words('tts_text')}] AS ws FROM u WHERE tts_text IS NOT NULL), k AS (SELECT utterance_id, ws, unnest(generate_series(2, len(ws))) AS i FROM w), r AS (SELECT utterance_id, min(i - 1) AS pl, count(*) AS n FROM k WHERE ws[i] = ws[i - 1] GROUP BY utterance_id) SELECT w.utterance_id, coalesce(n, 0) AS repeats, CAST(pl AS INTEGER) AS first_at, coalesce(len(list_filter(list_zip(ws[-8:][2:], ws[-8:][:-2]), lambda p: p[1] = p[2])) > 0, false) AS stalled FROM w LEFT JOIN r USING (utterance_id)")
def w16_repetitions(spark, sf_dir):
    """Words that repeat the one before them, the first of them, and whether one stands among the last eight: a stream that stalls."""
    rows = C.utterances(spark, sf_dir).where("tts_text IS NOT NULL").select("utterance_id", F.transform(X.words(F.col("tts_text")), F.lower).alias("ws"))
    again = L.repeats(F.col("ws"))
    return rows.select("utterance_id", F.size(again).cast("bigint").alias("repeats"), F.get(again, F.lit(0)).alias("first_at"), F.exists(again, lambda i: i > F.size("ws") - 8).alias("stalled"))


# What the parts of a manifest may hold.
_KINDS, _TYPES, _NEXT = ("text", "pause"), ("backchannel", "interrupt"), ("backchannel", "interrupt", "last")


def sql_list(values) -> str:
    return ", ".join(map(q, values))


@registry.query("v1_violations", f"""{M}, {HOST}, x AS (SELECT utterance_id, dialogue_id, variant_idx, unnest(units) AS x FROM u), n AS (SELECT dialogue_id, variant_idx, count(*) AS hosts FROM h GROUP BY ALL)
SELECT 'uttr_type' AS rule, count(*) AS n FROM u WHERE uttr_type NOT IN ({sql_list(_TYPES)})
UNION ALL SELECT 'next_uttr_type', count(*) FROM u WHERE next_uttr_type NOT IN ({sql_list(_NEXT)})
UNION ALL SELECT 'speaker_idx', count(*) FROM u WHERE speaker_idx IS NULL OR speaker_idx NOT IN (0, 1)
UNION ALL SELECT 'empty dialogue_id', count(*) FROM u WHERE coalesce(dialogue_id, '') = ''
UNION ALL SELECT 'no voice', count(*) FROM u WHERE voice_id IS NULL OR voice_id NOT IN (SELECT voice_id FROM voices WHERE wav IS NOT NULL AND txt IS NOT NULL)
UNION ALL SELECT 'negative fingerprint', count(*) FROM u WHERE voice_id IN (SELECT voice_id FROM voices WHERE wav_size < 0 OR wav_mtime_ns < 0)
UNION ALL SELECT 'unit kind', count(*) FROM x WHERE x.kind IS NULL OR x.kind NOT IN ({sql_list(_KINDS)})
UNION ALL SELECT 'empty text unit', count(*) FROM x WHERE x.kind = 'text' AND coalesce(x.text, '') = ''
UNION ALL SELECT 'duplicate unit_id', count(*) FROM (SELECT dialogue_id, variant_idx, x.unit_id AS k FROM x GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'backchannel speaker_idx', count(*) FROM b WHERE speaker_idx IS NULL OR speaker_idx NOT IN (0, 1)
UNION ALL SELECT 'empty backchannel', count(*) FROM b WHERE coalesce(text, '') = ''
UNION ALL SELECT 'negative word_count', count(*) FROM b WHERE word_count < 0
UNION ALL SELECT 'next_uttr_type_of_host', count(*) FROM b WHERE next_uttr_type_of_host NOT IN ({sql_list(_NEXT)})
UNION ALL SELECT 'host_idx out of range', count(*) FROM b LEFT JOIN n ON b.dialogue_id = n.dialogue_id AND b.variant_idx = n.variant_idx WHERE b.host_idx < 0 OR b.host_idx >= coalesce(hosts, 0)
UNION ALL SELECT 'unit id collision', count(*) FROM b WHERE EXISTS (SELECT 1 FROM x WHERE b.dialogue_id = x.dialogue_id AND b.variant_idx = x.variant_idx AND b.unit_id = x.x.unit_id)""")
def v1_violations(spark, sf_dir):
    """How often the manifests break each rule of their contract: one pass over each table and a row for each variant."""
    u, b = C.utterances(spark, sf_dir), C.backchannels(spark, sf_dir)
    v = table(spark, sf_dir, "voices").groupBy("voice_id").agg(F.max(F.col("wav").isNotNull() & F.col("txt").isNotNull()).alias("usable"), F.max(F.coalesce((F.col("wav_size") < 0) | (F.col("wav_mtime_ns") < 0), F.lit(False))).alias("negative"))
    u = u.join(v.withColumnRenamed("voice_id", "_v"), F.col("voice_id") == F.col("_v"), "left")
    bad = lambda x: F.count_if(F.coalesce(x, F.lit(False)))
    units = lambda f: F.sum(F.coalesce(F.size(F.filter("units", f)), F.lit(0)))
    own = u.groupBy(*UNIT).agg(
        F.count("*").alias("hosts"), bad(~F.col("uttr_type").isin(*_TYPES)).alias("uttr_type"), bad(~F.col("next_uttr_type").isin(*_NEXT)).alias("next_uttr_type"),
        F.count_if(F.col("speaker_idx").isNull() | ~F.col("speaker_idx").isin(0, 1)).alias("speaker_idx"), F.count_if(F.coalesce("dialogue_id", F.lit("")) == "").alias("empty dialogue_id"),
        F.count_if(~F.coalesce("usable", F.lit(False))).alias("no voice"), bad(F.col("negative")).alias("negative fingerprint"),
        units(lambda x: x["kind"].isNull() | ~x["kind"].isin(*_KINDS)).alias("unit kind"), units(lambda x: (x["kind"] == "text") & (F.coalesce(x["text"], F.lit("")) == "")).alias("empty text unit"),
        F.array_sort(F.flatten(F.collect_list(F.transform("units", lambda x: x["unit_id"])))).alias("ids"),
    )
    own = own.withColumn("duplicate unit_id", F.size(F.array_distinct(F.filter("ids", lambda x, k: (k > 0) & x.eqNullSafe(F.get("ids", k - 1))))))
    told = b.groupBy(*UNIT).agg(
        F.count_if(F.col("speaker_idx").isNull() | ~F.col("speaker_idx").isin(0, 1)).alias("backchannel speaker_idx"), F.count_if(F.coalesce("text", F.lit("")) == "").alias("empty backchannel"),
        bad(F.col("word_count") < 0).alias("negative word_count"), bad(~F.col("next_uttr_type_of_host").isin(*_NEXT)).alias("next_uttr_type_of_host"), F.collect_list("host_idx").alias("places"), F.collect_list("unit_id").alias("own_ids"),
    )
    d, i = told.columns[:2]
    told = told.withColumnRenamed(d, "_d").withColumnRenamed(i, "_i")
    both = own.join(told, F.col("dialogue_id").eqNullSafe(F.col("_d")) & F.col("variant_idx").eqNullSafe(F.col("_i")), "full_outer")
    hosts_ = F.coalesce("hosts", F.lit(0))
    both = both.withColumn("host_idx out of range", F.size(F.filter(F.coalesce("places", F.array().cast("array<int>")), lambda x: (x < 0) | (x >= hosts_))))
    both = both.withColumn("unit id collision", F.size(F.filter(F.coalesce("own_ids", F.array().cast("array<string>")), lambda x: F.array_contains(F.coalesce("ids", F.array().cast("array<string>")), x))))
    rules = [c for c in both.columns if c not in ("hosts", "ids", "places", "own_ids", *UNIT, "_d", "_i")]
    one = both.agg(*[F.coalesce(F.sum(f"`{c}`"), F.lit(0)).alias(c) for c in rules])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("rule"), F.col(f"`{c}`").cast("bigint").alias("n")) for c in rules])).alias("r")).select("r.*")


@registry.query("v2_fingerprints", f"{M}, now AS (SELECT voice_id, max(wav_size) + CASE WHEN length(voice_id) % 2 = 0 AND right(voice_id, 1) = '7' THEN 1 ELSE 0 END AS size, max(wav_mtime_ns) + CASE WHEN right(voice_id, 1) = '3' THEN 5 ELSE 0 END AS mtime FROM voices WHERE right(voice_id, 1) <> '9' GROUP BY voice_id), rec AS (SELECT voice_id, max(wav_size) AS size, max(wav_mtime_ns) AS mtime FROM voices GROUP BY voice_id) SELECT utterance_id, CASE WHEN now.voice_id IS NULL THEN 'missing' WHEN coalesce(rec.size, 0) <> 0 AND (now.size <> rec.size OR now.mtime <> rec.mtime) THEN 'changed' ELSE 'same' END AS state FROM u LEFT JOIN rec ON rec.voice_id = u.voice_id LEFT JOIN now ON now.voice_id = u.voice_id WHERE u.voice_id IS NOT NULL")
def v2_fingerprints(spark, sf_dir):
    """Whether each utterance's voice file is as its manifest recorded it, in size and time; here some files were changed or are gone."""
    from turnloom.operators.guards import fingerprint_state

    recorded = table(spark, sf_dir, "voices").groupBy("voice_id").agg(F.max("wav_size").alias("wav_size"), F.max("wav_mtime_ns").alias("wav_mtime_ns"))
    end = F.right("voice_id", F.lit(1))
    size = F.col("wav_size") + F.when((F.length("voice_id") % 2 == 0) & (end == "7"), 1).otherwise(0)
    now = recorded.where(end != "9").select(F.col("voice_id").alias("v"), size.alias("size"), (F.col("wav_mtime_ns") + F.when(end == "3", 5).otherwise(0)).alias("mtime"))
    rows = C.utterances(spark, sf_dir).where("voice_id IS NOT NULL").select("utterance_id", F.col("voice_id").alias("u")).join(recorded, F.col("u") == F.col("voice_id"), "left").join(now, F.col("u") == F.col("v"), "left")
    return rows.select("utterance_id", fingerprint_state(F.col("wav_size"), F.col("wav_mtime_ns"), F.col("v").isNotNull(), F.col("size"), F.col("mtime")).alias("state"))


_NAME = "CASE k % 4 WHEN 0 THEN wav WHEN 1 THEN upper(wav) WHEN 2 THEN regexp_replace(wav, '^.*/', '') ELSE wav || '.gone' END"
_SQL_NAMES = f"w AS (SELECT DISTINCT wav FROM voices WHERE wav IS NOT NULL), n AS (SELECT wav, row_number() OVER (ORDER BY wav) AS k FROM w), m AS (SELECT DISTINCT {_NAME} AS file FROM n), l AS (SELECT key, min(wav) AS path FROM (SELECT lower(wav) AS key, wav FROM w UNION SELECT lower(regexp_replace(wav, '^.*/', '')), wav FROM w) GROUP BY key), j AS (SELECT m.file, coalesce(w.wav, l.path) AS path FROM m LEFT JOIN w ON w.wav = m.file LEFT JOIN l ON l.key = lower(m.file))"


def manifest_names(spark, sf_dir):
    """(file, wav): names as manifests have them, of another case, without a folder, or of nothing."""
    w = table(spark, sf_dir, "voices").where("wav IS NOT NULL").select("wav").distinct().withColumn("k", F.row_number().over(Window.orderBy("wav")))
    base = F.substring_index("wav", "/", -1)
    return w.select(F.when(F.col("k") % 4 == 0, F.col("wav")).when(F.col("k") % 4 == 1, F.upper("wav")).when(F.col("k") % 4 == 2, base).otherwise(F.concat("wav", F.lit(".gone"))).alias("file")).distinct()


@registry.query("j5_manifest_files", f"WITH {_SQL_NAMES} SELECT file, path FROM j")
def j5_manifest_files(spark, sf_dir):
    """The file of each name in a manifest: of just that path, else whatever the case and the folder."""
    from turnloom.sources.manifests import resolved

    return resolved(manifest_names(spark, sf_dir), "file", table(spark, sf_dir, "voices").where("wav IS NOT NULL").select("wav"), "wav").select("file", "path")


@registry.query("k8_pool_plan", f"WITH {_SQL_NAMES}, done AS (SELECT lower(regexp_replace(regexp_replace(wav, '^.*/', ''), '\\.[^.]*$', '')) AS s FROM w WHERE hash_(wav)), t AS (SELECT file, path, regexp_replace(regexp_replace(regexp_replace(regexp_replace(file, '^.*/', ''), '(.)\\.[^.]*$', '\\1'), '[^A-Za-z0-9._-]+', '_', 'g'), '^[._-]+|[._-]+$', '', 'g') AS st FROM j WHERE path IS NOT NULL), nn AS (SELECT *, row_number() OVER (PARTITION BY lower(st) ORDER BY file) AS r FROM t), s AS (SELECT file, CASE WHEN r = 1 THEN st ELSE st || '_' || r END AS stem FROM nn) SELECT file, stem, CASE WHEN lower(stem) IN (SELECT s FROM done) THEN 'skip' ELSE 'write' END AS action FROM s UNION ALL SELECT file, NULL, 'missing' FROM j WHERE path IS NULL".replace("hash_(wav)", "right(md5(wav), 1) < '8'"))
def k8_pool_plan(spark, sf_dir):
    """What building a voice pool would do with each name: write it under a stem of its own, skip it, or miss its file."""
    from turnloom.sources.sinks import pool_plan

    wav = table(spark, sf_dir, "voices").where("wav IS NOT NULL").select("wav").distinct()
    done = wav.where(F.right(F.md5("wav"), F.lit(1)) < "8").select(F.regexp_replace(F.substring_index("wav", "/", -1), r"\.[^.]*$", "").alias("stem"))
    return pool_plan(manifest_names(spark, sf_dir), wav.withColumnRenamed("wav", "path"), done).select("file", "stem", "action")


@registry.query("o13_long_prompts", "WITH a AS (SELECT DISTINCT align_id, voice_id, start_sec, end_sec FROM alignment_turns WHERE voice_id IS NOT NULL AND end_sec - start_sec > 5), h AS (SELECT voice_id, arg_min(align_id, md5('42|' || CAST(align_id AS VARCHAR))) AS align_id FROM a GROUP BY voice_id), r AS (SELECT *, row_number() OVER (ORDER BY md5('42|' || voice_id)) AS n FROM h) SELECT voice_id, align_id FROM r WHERE n <= 20")
def o13_long_prompts(spark, sf_dir):
    """Twenty voices by hash, and of each one recording of more than five seconds; voices without any are passed over."""
    a = table(spark, sf_dir, "alignment_turns").where("voice_id IS NOT NULL AND end_sec - start_sec > 5").select("align_id", "voice_id")
    key = lambda c: F.md5(F.concat(F.lit("42|"), F.col(c).cast("string")))
    best = a.groupBy("voice_id").agg(F.min_by("align_id", key("align_id")).alias("align_id"))
    return best.orderBy(key("voice_id")).limit(20)


@registry.query("m6_batched", f"{M}, x AS (SELECT utterance_id, voice_id, unnest(units) AS x FROM u), t AS (SELECT voice_id, length(x.text) AS n FROM x WHERE x.kind = 'text' AND coalesce(x.text, '') <> '') SELECT coalesce(voice_id, '') AS voice_id, count(*) AS units, CAST(sum(n * 1440) AS BIGINT) AS samples, CAST(sum(CASE WHEN n > 120 THEN 1 ELSE 0 END) + ceil(sum(CASE WHEN n <= 120 THEN 1 ELSE 0 END) / 16.0) AS BIGINT) AS batches FROM t GROUP BY ALL")
def m6_batched(spark, sf_dir):
    """Text units rendered in batches of sixteen a voice, long ones alone, each batch in one call."""
    from turnloom.operators import models, sampling

    x = C.utterances(spark, sf_dir).select("utterance_id", F.coalesce("voice_id", F.lit("")).alias("voice_id"), F.posexplode("units").alias("pos", "x")).where("x.kind = 'text' AND coalesce(x.text, '') != ''")
    x = x.select("utterance_id", "pos", "voice_id", F.col("x.text").alias("text"))
    b = sampling.batches(x, ["voice_id"], ["utterance_id", "pos"], F.length("text"), 16, 120)
    calls = b.groupBy("voice_id", "oversize", "batch").agg(F.collect_list("text").alias("texts"))
    done = models.rendered_batches(calls, "texts", "voice_id", models.SilentSynthesizer())
    return done.groupBy("voice_id").agg(F.sum(F.size("texts")).alias("units"), F.sum(F.aggregate("samples", F.lit(0).cast("bigint"), lambda a, b: a + b)).alias("samples"), F.count("*").alias("batches"))
