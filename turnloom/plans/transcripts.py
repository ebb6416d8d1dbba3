"""Transcripts: parsing, backchannel marking, floor cuts and merged turns."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnloom.functions import text as X
from turnloom.operators import transcripts as R
from turnloom.plans import common as C
from turnloom.plans.common import q, sql_ws
from turnloom.registry import Registry
from turnloom.session import table
from turnloom.sources.dialogues import split_transcript
from turnloom.sources.manifests import switchboard

registry = Registry()

#: A speaker's label at the begin of a line, after its time: [A], A:, Speaker A -.
LABEL = r"^\s*(?:[\[(<]?[0-9]+[0-9:.,]*[\])>]?\s*(?:-->\s*|-\s+)?)?(?:\[\s*([AB])\s*\]|(?:Speaker\s+)?([AB])\s*(?::|\s-)\s)"
_FULL, _PLAIN = "ＡＢａｂ", "ABab"

#: l: every line once, with its speaker (A, B or ? where nothing tells), text, end marker and order.
SQL_L = f"""l0 AS (SELECT line_id, conversation_id, coalesce(utt, 0) AS utt, coalesce(da, '') AS da, regexp_extract(translate(coalesce(speaker, ''), '{_FULL}', '{_PLAIN}'), '([ABab])[: ]*$', 1) AS told, coalesce(text_raw, '') AS raw FROM (SELECT DISTINCT line_id, conversation_id, utt, da, speaker, text_raw FROM transcript_lines)),
l AS (SELECT line_id, conversation_id, utt, da, coalesce(nullif(upper(CASE WHEN told <> '' THEN told ELSE regexp_extract(raw, {q(LABEL)}, 1) || regexp_extract(raw, {q(LABEL)}, 2) END), ''), '?') AS speaker, nullif(regexp_extract(raw, '(-?/)\\s*$', 1), '') AS mark,
  {sql_ws(f"regexp_replace(CASE WHEN told <> '' THEN raw ELSE regexp_replace(raw, {q(LABEL)}, '') END, '-?/\\s*$', '')")} AS text FROM l0),
o AS (SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY utt, line_id) AS k FROM l),
n AS (SELECT *, lag(speaker) OVER w AS before, lead(speaker) OVER w AS after, starts_with(da, 'b') OR (da = '%' AND coalesce(mark, '') <> '-/') AS act, lead(starts_with(da, 'b') OR (da = '%' AND coalesce(mark, '') <> '-/')) OVER w AS next_act FROM o WINDOW w AS (PARTITION BY conversation_id ORDER BY k)),
m AS (SELECT *, coalesce(before <> speaker AND after <> speaker AND act, false) AS is_bc, coalesce(mark = '-/' AND after IS NOT NULL AND NOT coalesce(after <> speaker AND next_act, false), false) AS floor_cut FROM n)"""

#: st: the backchannels of m put into their hosts, line by line; h is the nearest line with words before, r the last line joined to another.
SQL_ST = f"""{SQL_L}, b0 AS (SELECT *, trim(text || CASE WHEN floor_cut THEN ' [TAKE_FLOOR]' ELSE '' END, ' ') AS base FROM m),
b AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY k) AS i FROM b0),
c AS (SELECT conversation_id, i, row_number() OVER (PARTITION BY conversation_id ORDER BY i) AS c FROM b WHERE NOT is_bc AND base <> ''),
p AS (SELECT b.*, (SELECT count(*) FROM c WHERE c.conversation_id = b.conversation_id AND c.i <= b.i) AS nc FROM b),
x AS MATERIALIZED (SELECT p.*, c1.i AS n1, c2.i AS n2, c3.i AS n3, b1.speaker AS s1, b2.speaker AS s2, b3.speaker AS s3 FROM p LEFT JOIN c c1 ON c1.conversation_id = p.conversation_id AND c1.c = nc + 1 LEFT JOIN c c2 ON c2.conversation_id = p.conversation_id AND c2.c = nc + 2 LEFT JOIN c c3 ON c3.conversation_id = p.conversation_id AND c3.c = nc + 3
  LEFT JOIN b b1 ON b1.conversation_id = p.conversation_id AND b1.i = c1.i LEFT JOIN b b2 ON b2.conversation_id = p.conversation_id AND b2.i = c2.i LEFT JOIN b b3 ON b3.conversation_id = p.conversation_id AND b3.i = c3.i),
st AS (SELECT conversation_id, CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS h, NULL::VARCHAR AS hs, CAST([] AS BIGINT[]) AS r, NULL::VARCHAR AS how, CAST(NULL AS BIGINT) AS host, CAST(NULL AS BIGINT) AS merged FROM (SELECT DISTINCT conversation_id FROM b)
  UNION ALL SELECT conversation_id, i, CASE WHEN (NOT is_bc OR how = 'none') AND base <> '' AND NOT list_contains(r, i) THEN i ELSE h END, CASE WHEN (NOT is_bc OR how = 'none') AND base <> '' AND NOT list_contains(r, i) THEN speaker ELSE hs END, CASE WHEN how = 'joined' THEN list_append(list_filter(r, lambda z: z > i), nn) ELSE list_filter(r, lambda z: z > i) END, how, CASE how WHEN 'after' THEN h WHEN 'joined' THEN h WHEN 'before' THEN nn END, CASE WHEN how = 'joined' THEN nn END
  FROM (SELECT *, CASE WHEN NOT is_bc THEN NULL WHEN hs IS NOT NULL AND hs = ns AND hs <> speaker THEN 'joined' WHEN hs <> speaker THEN 'after' WHEN ns <> speaker THEN 'before' ELSE 'none' END AS how
    FROM (SELECT x.*, st.h, st.hs, st.r, CASE WHEN list_contains(st.r, n1) AND list_contains(st.r, n2) THEN n3 WHEN list_contains(st.r, n1) THEN n2 ELSE n1 END AS nn, CASE WHEN list_contains(st.r, n1) AND list_contains(st.r, n2) THEN s3 WHEN list_contains(st.r, n1) THEN s2 ELSE s1 END AS ns FROM st JOIN x ON x.conversation_id IS NOT DISTINCT FROM st.conversation_id AND x.i = st.i + 1)))"""


def lines(spark, sf_dir):
    """Every line once, in order, with its speaker.

    The speaker is the A or B that ends its label, of either width and case, or
    that stands before the text where there is no such label; '?' where nothing
    tells, which is a third speaker.
    """
    from pyspark.sql import Window

    raw = F.coalesce("text_raw", F.lit(""))
    rows = table(spark, sf_dir, "transcript_lines").drop("ingested_at").dropDuplicates(["line_id"])
    told = F.regexp_extract(F.translate(F.coalesce("speaker", F.lit("")), _FULL, _PLAIN), "([ABab])[: ]*$", 1)
    in_text = F.concat(*[F.regexp_extract(raw, LABEL, i) for i in (1, 2)])
    speaker = F.coalesce(F.nullif(F.upper(F.when(told != "", told).otherwise(in_text)), F.lit("")), F.lit("?"))
    text = F.when(told != "", raw).otherwise(F.regexp_replace(raw, LABEL, ""))
    rows = rows.select("line_id", "conversation_id", F.coalesce("utt", F.lit(0)).alias("utt"), F.coalesce("da", F.lit("")).alias("da"), speaker.alias("speaker"), X.end_marker(raw).alias("end"), X.normalize_ws(F.regexp_replace(text, r"-?/\s*$", "")).alias("text"))
    return rows.withColumn("k", F.row_number().over(Window.partitionBy("conversation_id").orderBy("utt", "line_id")))


def hosted(spark, sf_dir):
    """Lines with the backchannels put into their hosts."""
    rows = R.marked(lines(spark, sf_dir), "conversation_id", "k")
    rows = rows.withColumn("text", F.trim(F.concat("text", F.when(F.col("floor_cut"), " [TAKE_FLOOR]").otherwise(""))))
    return R.attached_backchannels(rows, "conversation_id", "k", "line_id", "speaker", "text")


@registry.query("w6_marked_backchannels", f"WITH {SQL_L} SELECT line_id, is_bc FROM m")
def w6_marked_backchannels(spark, sf_dir):
    """Lines that are backchannels by their act and their neighbours."""
    return R.marked(lines(spark, sf_dir), "conversation_id", "k").select("line_id", "is_bc")


@registry.query("w7_floor_cuts", f"WITH {SQL_L} SELECT line_id, text || CASE WHEN floor_cut THEN ' [TAKE_FLOOR]' ELSE '' END AS text FROM m")
def w7_floor_cuts(spark, sf_dir):
    """Lines with the floor token where they are cut off."""
    rows = R.marked(lines(spark, sf_dir), "conversation_id", "k")
    return rows.select("line_id", F.concat("text", F.when(F.col("floor_cut"), " [TAKE_FLOOR]").otherwise("")).alias("text"))


@registry.query("w5_merged_turns", f"""WITH RECURSIVE {SQL_ST}, ev AS (SELECT st.conversation_id, st.host, st.i, st.how, st.merged FROM st WHERE how IN ('joined', 'after', 'before')),
pre AS (SELECT b.conversation_id, b.i, repeat('[BACKCHANNEL] ', CAST((SELECT count(*) FROM ev WHERE ev.conversation_id = b.conversation_id AND ev.host = b.i AND how = 'before') AS INTEGER)) || base AS t FROM b),
app AS (SELECT ev.conversation_id, ev.host, string_agg(CASE WHEN how = 'joined' THEN ' [BACKCHANNEL] ' || pre.t ELSE ' [BACKCHANNEL]' END, '' ORDER BY ev.i) AS t FROM ev LEFT JOIN pre ON pre.conversation_id = ev.conversation_id AND pre.i = ev.merged WHERE how IN ('joined', 'after') GROUP BY ev.conversation_id, ev.host),
fin AS (SELECT b.conversation_id, b.i, b.speaker, trim(pre.t || coalesce(app.t, ''), ' ') AS t FROM b JOIN st ON st.conversation_id = b.conversation_id AND st.i = b.i JOIN pre ON pre.conversation_id = b.conversation_id AND pre.i = b.i LEFT JOIN app ON app.conversation_id = b.conversation_id AND app.host = b.i
  WHERE (st.how IS NULL OR st.how = 'none') AND pre.t <> '' AND NOT EXISTS (SELECT 1 FROM ev WHERE ev.conversation_id = b.conversation_id AND ev.merged = b.i)),
g AS (SELECT *, CASE WHEN lag(speaker) OVER w IS NOT DISTINCT FROM speaker THEN 0 ELSE 1 END AS o FROM fin WINDOW w AS (PARTITION BY conversation_id ORDER BY i)), r AS (SELECT *, sum(o) OVER (PARTITION BY conversation_id ORDER BY i) - 1 AS turn_no FROM g)
SELECT conversation_id, CAST(turn_no AS BIGINT) AS turn_no, any_value(speaker) AS speaker, count(*) AS n, string_agg(t, ' ' ORDER BY i) AS text FROM r GROUP BY conversation_id, turn_no""")
def w5_merged_turns(spark, sf_dir):
    """Turns: lines with the backchannels put into them, those of one speaker in a row merged."""
    rows = hosted(spark, sf_dir).where("NOT gone AND text != ''")
    return R.merged_turns(rows, "conversation_id", "k", F.col("text"))


@registry.query("w6_attached_backchannels", f"WITH RECURSIVE {SQL_ST} SELECT st.conversation_id, b.line_id, bh.line_id AS host, bm.line_id AS merged FROM st JOIN b ON b.conversation_id = st.conversation_id AND b.i = st.i LEFT JOIN b bh ON bh.conversation_id = st.conversation_id AND bh.i = st.host LEFT JOIN b bm ON bm.conversation_id = st.conversation_id AND bm.i = st.merged WHERE st.how IN ('joined', 'after', 'before')")
def w6_attached_backchannels(spark, sf_dir):
    """The line that hosts each backchannel, and the line that it joined to that."""
    return hosted(spark, sf_dir).where("host IS NOT NULL").select("conversation_id", "line_id", "host", "merged")


@registry.query("s12_switchboard", f"WITH {SQL_L} SELECT conversation_id, line_id, coalesce(nullif(regexp_replace(da, '\\s+', '', 'g'), ''), 'x') AS da, speaker, replace(text, chr(10), ' ') AS text FROM o")
def s12_switchboard(spark, sf_dir):
    """Files of a header and utterance lines, parsed: all lines written in that form and read back."""
    da = F.coalesce(F.nullif(F.regexp_replace("da", r"\s+", ""), F.lit("")), F.lit("x"))
    rows = lines(spark, sf_dir).withColumn("text", F.replace("text", F.lit("\n"), F.lit(" "))).withColumn("da", da)
    body = rows.select("conversation_id", F.col("k").alias("no"), F.format_string("%s   @%s.%d utt%d: %s", "da", "speaker", F.col("k"), F.col("line_id").cast("int"), "text").alias("line"))
    heads = rows.groupBy("conversation_id").agg(F.lit(0).alias("x")).select("conversation_id", F.posexplode(F.array(F.lit("FILENAME: a.utt"), F.lit("sd A.1 utt1: not yet"), F.lit("=====")))).select("conversation_id", (F.col("pos") - 10).alias("no"), F.col("col").alias("line"))
    parsed = switchboard(body.unionByName(heads), "conversation_id", "no", "line")
    return parsed.select("conversation_id", F.col("utt").cast("bigint").alias("line_id"), "da", "speaker", "text")


_LAB = "(Assistant|Claude|AI|User)"


@registry.query("x1_transcript_turns", f"""WITH {C.SQL_TURNS}, tx AS (SELECT record_id, 'Intro. ' || string_agg(CASE WHEN role = 'assistant' THEN CASE WHEN turn % 3 = 1 THEN 'claude: ' ELSE 'Assistant: ' END ELSE 'User: ' END || coalesce(content, ''), chr(10) ORDER BY turn) AS text FROM turns GROUP BY record_id),
ps AS (SELECT record_id, string_split(regexp_replace(text, '\\n{_LAB}:\\s*', chr(1) || '\\1' || chr(2), 'gi'), chr(1)) AS ps FROM tx), pc AS (SELECT record_id, unnest(ps) AS p, generate_subscripts(ps, 1) AS i FROM ps),
mk AS (SELECT record_id, i, CASE WHEN i = 1 THEN regexp_replace(p, '^.*?{_LAB}:\\s*', '\\1' || chr(2), 'is') ELSE p END AS p FROM pc), kp AS (SELECT record_id, i, lower(split_part(p, chr(2), 1)) AS label, {C.sql_strip("substr(p, strpos(p, chr(2)) + 1)")} AS content FROM mk WHERE contains(p, chr(2)))
SELECT record_id, CAST(row_number() OVER (PARTITION BY record_id ORDER BY i) - 1 AS INTEGER) AS turn, CASE label WHEN 'user' THEN 'user' ELSE 'assistant' END AS role, content FROM kp WHERE content <> ''""")
def x1_transcript_turns(spark, sf_dir):
    """All dialogues written as one text with labels, and split at these again."""
    rows = C.dialogues(spark, sf_dir).where("size(history) > 0")
    label = lambda h, i: F.when(C.role_of(h["role"]) == "assistant", F.when(i % 3 == 1, "claude: ").otherwise("Assistant: ")).otherwise("User: ")
    text = F.array_join(F.transform("history", lambda h, i: F.concat(label(h, i), F.coalesce(h["content"], F.lit("")))), "\n")
    return split_transcript(rows.select("record_id", F.concat(F.lit("Intro. "), text).alias("text")), "text").select("record_id", F.posexplode("turns").alias("turn", "t")).select("record_id", "turn", F.col("t.role").alias("role"), F.col("t.content").alias("content"))


@registry.query("x10_aligned_marks", f"WITH {C.SQL_TURNS}, w AS (SELECT record_id, turn, {C.sql_words('content')} AS ws FROM said) SELECT record_id, turn, CAST(unnest(range(3, len(ws), 5)) AS INTEGER) AS word_index FROM w")
def x10_aligned_marks(spark, sf_dir):
    """The words that a model's marked copy of each turn points at; here the copies have as many words, so no Python is called."""
    ws = X.words(F.col("content"))
    copy = F.transform(ws, lambda w, i: F.when(i % 5 == 3, F.concat(w, F.lit("|"))).otherwise(w))
    rows = C.said(spark, sf_dir).select("record_id", "turn", ws.alias("ws"), copy.alias("copy"))
    return rows.select("record_id", "turn", F.explode(R.marks(F.col("ws"), F.col("copy"))).alias("word_index"))


@registry.query("x10_greedy_marks", f"""WITH RECURSIVE {C.SQL_TURNS}, w AS (SELECT record_id, turn, {C.sql_words('content')} AS ws FROM said),
dd AS (SELECT record_id, turn, ws, [CASE WHEN (i - 1) % 5 = 3 THEN ws[i] || '|' ELSE ws[i] END FOR i IN range(1, len(ws) + 1) IF (i - 1) % 7 <> 6] AS cs FROM w WHERE len(ws) > 6),
t AS MATERIALIZED (SELECT record_id, turn, cs, ws, [{C.sql_clean("replace(c, '|', '')")} FOR c IN cs] AS cb, [{C.sql_clean('c')} FOR c IN ws] AS wb FROM dd),
s AS (SELECT record_id, turn, CAST(1 AS BIGINT) AS i, CAST(1 AS BIGINT) AS j, CAST(NULL AS BIGINT) AS hit FROM t
  UNION ALL SELECT record_id, turn, CASE WHEN same OR (NOT sign_c AND sign_w) THEN i + 1 ELSE i END, CASE WHEN same OR sign_c OR NOT sign_w THEN j + 1 ELSE j END, CASE WHEN same AND contains(c, '|') THEN i - 1 END
  FROM (SELECT s.record_id, s.turn, s.i, s.j, cs[j] AS c, cb[j] = wb[i] AND (cb[j] <> '' OR replace(cs[j], '|', '') = ws[i]) AS same, cb[j] = '' AND replace(cs[j], '|', '') <> '' AS sign_c, wb[i] = '' AS sign_w FROM s JOIN t ON t.record_id = s.record_id AND t.turn = s.turn WHERE s.i <= len(ws) AND s.j <= len(cs)))
SELECT record_id, turn, CAST(hit AS INTEGER) AS word_index FROM s WHERE hit IS NOT NULL""")
def x10_greedy_marks(spark, sf_dir):
    """The same for copies that lack every seventh word: words are matched in order."""
    ws = X.words(F.col("content"))
    copy = F.transform(ws, lambda w, i: F.when(i % 7 != 6, F.when(i % 5 == 3, F.concat(w, F.lit("|"))).otherwise(w)))
    rows = C.said(spark, sf_dir).select("record_id", "turn", ws.alias("ws"), F.filter(copy, lambda w: w.isNotNull()).alias("copy")).where("size(ws) > 6")
    return rows.select("record_id", "turn", F.explode(R.marks(F.col("ws"), F.col("copy"))).alias("word_index"))
