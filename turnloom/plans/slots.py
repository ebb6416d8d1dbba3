"""Slots, decisions, contexts and training examples over the dialogues (T, W1, W3, W4, W14, W15, P8-P13, J6, J7, U1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnloom.functions import text as X
from turnloom.operators import slots as S
from turnloom.operators.bound import bound
from turnloom.plans import common as C
from turnloom.plans.common import q, sql_strip, sql_uniform, sql_words
from turnloom.registry import Registry

registry = Registry()
KEY = ["record_id", "turn"]
HES = ", ".join(map(q, X.HESITATIONS))
#: Probabilities of the stub scorer.
P_FLOOR, P_BACK = 0.1, 0.4

SQL_W = f"""{C.SQL_TURNS},
w AS (SELECT record_id, turn, role, content, {sql_words('content')} AS ws FROM said),
x AS (SELECT record_id, turn, role, ws, CAST(i - 1 AS INTEGER) AS word_index, ws[i] AS word FROM (SELECT *, unnest(generate_series(1, len(ws))) AS i FROM w)),
cand AS (SELECT record_id, turn, role, ws, word_index, regexp_matches(word, {q(X.STOP)}) AS is_stop, {C.sql_clean('word')} IN ({HES}) AS is_hes FROM x
  WHERE regexp_matches(word, {q(X.STOP)}) OR {C.sql_clean('word')} IN ({HES})),
sa AS (SELECT record_id, turn, role, ws, word_index, is_stop, is_hes FROM (SELECT *, row_number() OVER (PARTITION BY record_id, turn ORDER BY word_index DESC) AS r FROM cand) WHERE r > 1)"""


def turns_with_words(spark, sf_dir):
    return bound(C.said(spark, sf_dir), words=X.words(F.col("content")))


@registry.query("t1_slots", f"WITH {SQL_W} SELECT record_id, turn, role, word_index, is_stop, is_hes AS is_hesitation FROM sa")
def t1_slots(spark, sf_dir):
    """Policy A: the slots of every turn and the evidence for each."""
    rows = bound(turns_with_words(spark, sf_dir), slots=S.slots_a(F.col("words"))).select(*KEY, "role", "words", F.explode("slots").alias("word_index"))
    word = F.get("words", F.col("word_index"))
    return rows.select(*KEY, "role", "word_index", word.rlike(X.STOP).alias("is_stop"), X.clean_word(word).isin(*X.HESITATIONS).alias("is_hesitation"))


@registry.query("t1_slot_summary", f"WITH {SQL_W} SELECT role, count(*) AS slots, sum(CASE WHEN is_stop THEN 1 ELSE 0 END) AS by_stop, sum(CASE WHEN is_hes THEN 1 ELSE 0 END) AS by_hesitation FROM sa GROUP BY role")
def t1_slot_summary(spark, sf_dir):
    """Slots per role, and how many rest on punctuation or hesitation."""
    return t1_slots(spark, sf_dir).groupBy("role").agg(F.count("*").alias("slots"), F.count_if("is_stop").alias("by_stop"), F.count_if("is_hesitation").alias("by_hesitation"))


SQL_B = f"""{SQL_W},
c0 AS (SELECT record_id, turn, len(ws) AS n, word_index AS i FROM cand WHERE word_index < len(ws) - 1),
c1 AS (SELECT *, i - row_number() OVER (PARTITION BY record_id, turn ORDER BY i) AS g FROM c0),
c2 AS (SELECT *, count(*) OVER (PARTITION BY record_id, turn, g) AS k, row_number() OVER (PARTITION BY record_id, turn, g ORDER BY i) AS r FROM c1),
thin AS (SELECT record_id, turn, n, i FROM c2 WHERE k = 1 OR r % 2 = 0),
ends AS (SELECT record_id, turn, n, i FROM thin UNION ALL SELECT record_id, turn, len(ws), len(ws) - 1 FROM w WHERE len(ws) > 0),
lagged AS (SELECT *, coalesce(lag(i) OVER (PARTITION BY record_id, turn ORDER BY i), -1) AS p FROM ends),
fill AS (SELECT record_id, turn, n, unnest(range(p + 4, i, 4)) AS i FROM lagged WHERE i - p > 8)"""


@registry.query("w3_thinned_runs", f"WITH {SQL_B} SELECT record_id, turn, CAST(i AS INTEGER) AS word_index FROM thin")
def w3_thinned_runs(spark, sf_dir):
    """Candidates, of which runs keep every second."""
    n = F.size("words")
    inner = F.filter(S.candidates(F.col("words")), lambda i: i < n - 1)
    return turns_with_words(spark, sf_dir).select(*KEY, F.explode(S.kept_of_runs(inner)).alias("word_index"))


@registry.query("t2_slots_annotator", f"WITH {SQL_B} SELECT DISTINCT record_id, turn, CAST(i AS INTEGER) AS word_index FROM (SELECT record_id, turn, n, i FROM thin UNION ALL SELECT record_id, turn, n, i FROM fill) WHERE i >= 0 AND i < n - 1")
def t2_slots_annotator(spark, sf_dir):
    """Policy B: candidates thinned in runs, long gaps filled."""
    return bound(turns_with_words(spark, sf_dir), slots=S.slots_b(F.col("words"))).select(*KEY, F.explode("slots").alias("word_index"))


@registry.query("w4_gap_fill", f"WITH {SQL_B} SELECT DISTINCT record_id, turn, CAST(i AS INTEGER) AS word_index FROM fill WHERE i >= 0 AND i < n - 1")
def w4_gap_fill(spark, sf_dir):
    """The places that fill long gaps."""
    n = F.size("words")
    kept = S.kept_of_runs(F.filter(S.candidates(F.col("words")), lambda i: i < n - 1))
    rows = turns_with_words(spark, sf_dir).where(n > 0).select(*KEY, kept.alias("kept"), n.alias("n"))
    return rows.select(*KEY, F.explode(F.array_except(S.filled_gaps(F.col("kept"), F.col("n")), "kept")).alias("word_index"))


@registry.query("j6_marker_join", f"WITH {SQL_W}, m AS (SELECT record_id, turn, unnest(range(5, len(ws), 7)) AS i FROM w), h AS (SELECT record_id, turn, word_index AS i FROM cand) SELECT coalesce(m.record_id, h.record_id) AS record_id, coalesce(m.turn, h.turn) AS turn, CAST(coalesce(m.i, h.i) AS INTEGER) AS word_index, m.i IS NOT NULL AS by_model, h.i IS NOT NULL AS by_rule FROM m FULL JOIN h ON m.record_id = h.record_id AND m.turn = h.turn AND m.i = h.i")
def j6_marker_join(spark, sf_dir):
    """Slots that a model marked joined with those of the rules (U1): both sets and who found each."""
    n = F.size("words")
    model = F.when(n > 5, F.sequence(F.lit(5), n - 1, F.lit(7))).otherwise(F.array().cast("array<int>"))
    rows = turns_with_words(spark, sf_dir).select(*KEY, model.alias("m"), S.candidates(F.col("words")).alias("h"))
    rows = rows.select(*KEY, "m", "h", F.explode(F.array_union("m", "h")).alias("word_index"))
    return rows.select(*KEY, "word_index", F.array_contains("m", F.col("word_index")).alias("by_model"), F.array_contains("h", F.col("word_index")).alias("by_rule"))


SQL_FOLD = f"""WITH RECURSIVE {SQL_W},
acted AS (SELECT record_id, turn, word_index, {sql_uniform('42', 'record_id', 'turn', 'word_index')} AS u FROM sa),
act AS MATERIALIZED (SELECT record_id, turn, word_index, CASE WHEN u <= {P_FLOOR} THEN 'floor_taking' WHEN u <= {P_FLOOR} + {P_BACK} THEN 'backchannel' ELSE 'silence' END AS action,
  row_number() OVER (PARTITION BY record_id, turn ORDER BY word_index) AS k FROM acted),
fold AS (
  SELECT record_id, turn, k, word_index, action,
    CASE WHEN action = 'floor_taking' AND word_index >= 3 THEN 'floor_taking' WHEN action = 'backchannel' THEN 'backchannel' ELSE 'silence' END AS decision,
    CASE WHEN action = 'backchannel' THEN word_index END AS last, action = 'floor_taking' AND word_index >= 3 AS taken
  FROM act WHERE k = 1
  UNION ALL
  SELECT a.record_id, a.turn, a.k, a.word_index, a.action,
    CASE WHEN f.taken THEN 'silence' WHEN a.action = 'floor_taking' AND a.word_index >= 3 THEN 'floor_taking'
         WHEN a.action = 'backchannel' AND (f.last IS NULL OR a.word_index - f.last >= 4) THEN 'backchannel' ELSE 'silence' END,
    CASE WHEN NOT f.taken AND a.action = 'backchannel' AND (f.last IS NULL OR a.word_index - f.last >= 4) THEN a.word_index ELSE f.last END,
    f.taken OR (a.action = 'floor_taking' AND a.word_index >= 3)
  FROM fold f JOIN act a ON a.record_id = f.record_id AND a.turn = f.turn AND a.k = f.k + 1)"""


def decided_turns(spark, sf_dir):
    """Turns with ``decisions`` of the stub scorer's probabilities."""
    rows = turns_with_words(spark, sf_dir)

    def act(i):
        u = X.uniform(F.lit(42), F.col("record_id"), F.col("turn"), i)
        return F.struct(i.alias("word_index"), S.sampled_action(u, F.lit(P_FLOOR), F.lit(P_BACK)).alias("action"))

    return bound(rows, slots=S.slots_a(F.col("words")), decisions=S.decided(F.transform("slots", act))).drop("slots")


@registry.query("t5_sampled_actions", f"WITH {SQL_W}, a AS (SELECT record_id, turn, word_index, {sql_uniform('42', 'record_id', 'turn', 'word_index')} AS u FROM sa) SELECT record_id, turn, word_index, CASE WHEN u <= {P_FLOOR} THEN 'floor_taking' WHEN u <= {P_FLOOR} + {P_BACK} THEN 'backchannel' ELSE 'silence' END AS action FROM a")
def t5_sampled_actions(spark, sf_dir):
    """An action for each slot, from a uniform number of its key."""
    return decided_turns(spark, sf_dir).select(*KEY, F.inline("decisions")).drop("decision")


@registry.query("t6_decisions", SQL_FOLD + " SELECT record_id, turn, word_index, action, decision FROM fold")
def t6_decisions(spark, sf_dir):
    """Guarded decisions: one floor-taking a turn, backchannels apart."""
    return decided_turns(spark, sf_dir).select(*KEY, F.inline("decisions"))


_FT = "ft AS (SELECT record_id, turn, min(word_index) AS cut_at FROM fold WHERE decision = 'floor_taking' GROUP BY record_id, turn)"


@registry.query("t6_spoken_text", f"{SQL_FOLD}, {_FT} SELECT w.record_id, w.turn, CASE WHEN cut_at IS NULL THEN array_to_string(ws, ' ') ELSE array_to_string(ws[1:cut_at + 1], ' ') || ' [TAKE_FLOOR]' END AS text FROM w LEFT JOIN ft ON w.record_id = ft.record_id AND w.turn = ft.turn")
def t6_spoken_text(spark, sf_dir):
    """Turns cut where the floor is taken."""
    return decided_turns(spark, sf_dir).select(*KEY, S.spoken_text(F.col("words"), F.col("decisions")).alias("text"))


@registry.query("w14_first_floor_taking", f"{SQL_FOLD}, {_FT} SELECT record_id, turn, cut_at AS word_index FROM ft")
def w14_first_floor_taking(spark, sf_dir):
    """Where each turn's floor is taken."""
    return t6_decisions(spark, sf_dir).where("decision = 'floor_taking'").groupBy(*KEY).agg(F.min("word_index").alias("word_index"))


@registry.query("proj11_reconstructed", SQL_FOLD + """, tok AS (SELECT x.record_id, x.turn, x.word_index, x.word || CASE f.decision WHEN 'floor_taking' THEN ' [TAKE_FLOOR]' WHEN 'backchannel' THEN ' [BACKCHANNEL]' ELSE '' END AS t
  FROM x LEFT JOIN fold f ON f.record_id = x.record_id AND f.turn = x.turn AND f.word_index = x.word_index)
SELECT record_id, turn, string_agg(t, ' ' ORDER BY word_index) AS text FROM tok GROUP BY record_id, turn""")
def proj11_reconstructed(spark, sf_dir):
    """Turns with the tokens of their decisions put back."""
    return decided_turns(spark, sf_dir).select(*KEY, S.reconstructed(F.col("words"), F.col("decisions")).alias("text"))


SQL_CONTEXT = f"""ctx AS (SELECT record_id, turn, role, content, list(struct_pack(role := role, content := coalesce(content, ''))) OVER (PARTITION BY record_id ORDER BY turn ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS c FROM turns),
ctx4 AS (SELECT record_id, turn, role, content, coalesce(list_filter(c, lambda t: {sql_strip('t.content')} <> ''), []) AS c FROM ctx)"""


@registry.query("w1_last4_context", f"WITH {C.SQL_TURNS}, {SQL_CONTEXT} SELECT record_id, turn, CAST(len(c) AS INTEGER) AS n_context, array_to_string(list_transform(c, lambda t: coalesce(t.role, '?') || ': ' || t.content), chr(10)) AS context FROM ctx4")
def w1_last4_context(spark, sf_dir):
    """The four turns before each turn, those without words left out."""
    rows = S.last_turns(C.turns(spark, sf_dir), "record_id", "turn")
    lines = F.transform("context", lambda t: F.concat(F.coalesce(t["role"], F.lit("?")), F.lit(": "), t["content"]))
    return rows.select(*KEY, F.size("context").alias("n_context"), F.array_join(lines, "\n").alias("context"))


@registry.query("proj8_single_slots", f"WITH {SQL_W} SELECT record_id, turn, word_index, array_to_string(ws[1:word_index + 1], ' ') AS prefix FROM sa")
def proj8_single_slots(spark, sf_dir):
    """One row for each slot, with the turn up to it."""
    rows = bound(turns_with_words(spark, sf_dir), slots=S.slots_a(F.col("words"))).select(*KEY, "words", F.explode("slots").alias("word_index"))
    return rows.select(*KEY, "word_index", F.array_join(F.slice("words", F.lit(1), F.col("word_index") + 1), " ").alias("prefix"))


@registry.query("proj12_dialogue_block", f"WITH {C.SQL_TURNS} SELECT record_id, string_agg(CAST(turn + 1 AS VARCHAR) || ') ' || coalesce(role, '?') || ': ' || coalesce(content, ''), chr(10) ORDER BY turn) AS block FROM turns GROUP BY record_id")
def proj12_dialogue_block(spark, sf_dir):
    """Each dialogue as numbered lines."""
    line = F.transform("history", lambda t, i: F.concat((i + 1).cast("string"), F.lit(") "), F.coalesce(C.role_of(t["role"]), F.lit("?")), F.lit(": "), F.coalesce(t["content"], F.lit(""))))
    return C.dialogues(spark, sf_dir).where("size(history) > 0").select("record_id", F.array_join(line, "\n").alias("block"))


SQL_SAID_WORDS = f"WITH {SQL_W}"
SQL_PROMPTS = f"WITH {SQL_W}, {SQL_CONTEXT} SELECT s.record_id, s.turn, s.word_index, 'History:' || chr(10) || array_to_string(list_transform(c, lambda t: coalesce(t.role, '?') || ': ' || t.content), chr(10)) || chr(10) || 'Now: ' || array_to_string(ws[1:word_index + 1], ' ') AS prompt FROM sa s JOIN ctx4 ON s.record_id = ctx4.record_id AND s.turn = ctx4.turn"


@registry.query("proj13_prompts", SQL_PROMPTS)
def proj13_prompts(spark, sf_dir):
    """The prompt for each slot: the context and the turn so far."""
    rows = S.last_turns(C.turns(spark, sf_dir), "record_id", "turn").where(X.strip(F.col("content")) != "").withColumn("words", X.words(F.col("content")))
    lines = F.array_join(F.transform("context", lambda t: F.concat(F.coalesce(t["role"], F.lit("?")), F.lit(": "), t["content"])), "\n")
    rows = rows.select(*KEY, "words", lines.alias("lines"), F.explode(S.slots_a(F.col("words"))).alias("word_index"))
    return rows.select(*KEY, "word_index", F.concat(F.lit("History:\n"), "lines", F.lit("\nNow: "), F.array_join(F.slice("words", F.lit(1), F.col("word_index") + 1), " ")).alias("prompt"))


@registry.query("t10_backchannel_contexts", SQL_FOLD + """, prev AS (SELECT record_id, turn, lag(content) OVER (PARTITION BY record_id ORDER BY turn) AS before FROM turns)
SELECT f.record_id, f.turn, f.word_index, coalesce(before, '') || chr(10) || array_to_string(ws[1:f.word_index + 1], ' ') || ' [INSERT] ' || array_to_string(ws[f.word_index + 2:], ' ') AS context,
  (['yeah', 'uh-huh', 'mm-hmm', 'right', 'okay'])[CAST(CAST(('0x' || substr(md5(CAST(f.record_id AS VARCHAR) || '|' || CAST(f.turn AS VARCHAR) || '|' || CAST(f.word_index AS VARCHAR)), 1, 8)) AS UBIGINT) % 5 + 1 AS BIGINT)] AS fallback
FROM fold f JOIN w ON w.record_id = f.record_id AND w.turn = f.turn JOIN prev ON prev.record_id = f.record_id AND prev.turn = f.turn WHERE f.decision = 'backchannel'""")
def t10_backchannel_contexts(spark, sf_dir):
    """What surrounds each decided backchannel, and the word it falls back on."""
    from pyspark.sql import Window

    before = C.turns(spark, sf_dir).withColumn("before", F.coalesce(F.lag("content").over(Window.partitionBy("record_id").orderBy("turn")), F.lit("")))

    def act(i):
        return F.struct(i.alias("word_index"), S.sampled_action(X.uniform(F.lit(42), F.col("record_id"), F.col("turn"), i), F.lit(P_FLOOR), F.lit(P_BACK)).alias("action"))

    rows = before.where(X.strip(F.col("content")) != "").withColumn("words", X.words(F.col("content")))
    rows = rows.withColumn("d", F.explode(F.filter(S.decided(F.transform(S.slots_a(F.col("words")), act)), lambda d: d["decision"] == "backchannel"))).withColumn("word_index", F.col("d.word_index"))
    i = F.col("word_index")
    h = F.conv(F.substring(F.md5(F.concat_ws("|", "record_id", "turn", "word_index")), 1, 8), 16, 10).cast("bigint")
    pool = F.array(*map(F.lit, ("yeah", "uh-huh", "mm-hmm", "right", "okay")))
    text = F.concat("before", F.lit("\n"), F.array_join(F.slice("words", F.lit(1), i + 1), " "), F.lit(" [INSERT] "), F.array_join(F.slice("words", i + 2, F.greatest(F.size("words") - i - 1, F.lit(0))), " "))
    return rows.select(*KEY, "word_index", text.alias("context"), F.element_at(pool, (h % 5 + 1).cast("int")).alias("fallback"))


@registry.query("x19_typed_boundaries", SQL_FOLD + ", t AS (SELECT record_id, turn, word_index AS idx, CASE decision WHEN 'backchannel' THEN 'BACKCHANNEL' WHEN 'floor_taking' THEN 'TAKE_FLOOR' END AS type FROM fold WHERE decision <> 'silence') SELECT record_id, turn, idx, type, CASE WHEN type = 'BACKCHANNEL' THEN row_number() OVER (PARTITION BY record_id, turn, type ORDER BY idx) END AS nth_backchannel FROM t")
def x19_typed_boundaries(spark, sf_dir):
    """Typed boundaries read back from the text with its tokens."""
    from pyspark.sql import Window

    toks = proj11_reconstructed(spark, sf_dir).select(*KEY, F.posexplode(F.split("text", " ")).alias("pos", "tok"))
    is_token = F.col("tok").isin(X.TAKE_FLOOR, X.BACKCHANNEL)
    w = Window.partitionBy(*KEY).orderBy("pos")
    seen = toks.withColumn("idx", (F.sum(F.when(is_token, 0).otherwise(1)).over(w) - 1).cast("int")).where(is_token & (F.col("idx") >= 0))
    seen = seen.withColumn("type", F.when(F.col("tok") == X.BACKCHANNEL, "BACKCHANNEL").otherwise("TAKE_FLOOR"))
    nth = F.row_number().over(Window.partitionBy(*KEY, "type").orderBy("idx"))
    return seen.select(*KEY, "idx", "type", F.when(F.col("type") == "BACKCHANNEL", nth).cast("bigint").alias("nth_backchannel"))


@registry.query("proj19_moved_decisions", SQL_FOLD + """, tok AS (SELECT x.record_id, x.turn, x.word_index, CASE WHEN x.word_index % 3 = 2 THEN x.word || ' ' || x.word ELSE x.word END || CASE WHEN f.decision = 'floor_taking' THEN ' [TAKE_FLOOR]' ELSE '' END AS t FROM x LEFT JOIN fold f ON f.record_id = x.record_id AND f.turn = x.turn AND f.word_index = x.word_index),
tr AS (SELECT record_id, turn, string_split(string_agg(t, ' ' ORDER BY word_index), ' ') AS ts FROM tok GROUP BY record_id, turn), ps AS (SELECT record_id, turn, list_filter(range(1, len(ts) + 1), lambda z: ts[z] = '[TAKE_FLOOR]') AS ps FROM tr),
dk AS (SELECT *, row_number() OVER (PARTITION BY record_id, turn, decision = 'floor_taking' ORDER BY word_index) AS n FROM fold)
SELECT d.record_id, d.turn, d.word_index AS old_index, CAST(CASE WHEN decision = 'floor_taking' THEN coalesce(greatest(ps[n] - 2, 0), d.word_index) ELSE d.word_index END AS INTEGER) AS word_index, decision FROM dk d JOIN ps ON ps.record_id = d.record_id AND ps.turn = d.turn""")
def proj19_moved_decisions(spark, sf_dir):
    """Decisions moved to where a translation, here one that says every third word twice, has its floor tokens."""
    rows = decided_turns(spark, sf_dir)
    floors = F.filter("decisions", lambda d: d["decision"] == "floor_taking")
    doubled = F.transform("words", lambda w, i: F.concat(F.when(i % 3 == 2, F.concat(w, F.lit(" "), w)).otherwise(w), F.when(F.exists(floors, lambda d: d["word_index"] == i), f" {X.TAKE_FLOOR}").otherwise("")))
    moved = X.moved_decisions(F.col("decisions"), F.array_join(doubled, " "))
    z = F.arrays_zip(F.col("decisions.word_index").alias("old_index"), moved.alias("m"))
    return rows.select(*KEY, F.explode(z).alias("z")).select(*KEY, "z.old_index", "z.m.word_index", "z.m.decision")
