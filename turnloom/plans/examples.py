"""Training and inference examples over annotated turns and typed transcripts."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnloom.functions import text as X
from turnloom.operators import evaluate as E
from turnloom.operators import examples as M
from turnloom.operators import sampling as O
from turnloom.operators import slots as S
from turnloom.operators.bound import bound
from turnloom.plans import common as C
from turnloom.plans import slots as P
from turnloom.plans import transcripts as T
from turnloom.plans.common import q, sql_strip, sql_uniform, sql_words, sql_ws
from turnloom.registry import Registry

registry = Registry()
KEY = ["record_id", "turn"]


def annotated(spark, sf_dir):
    """Turns with ``boundaries`` as annotators leave them: some lists are null, some word indices are no numbers or no places."""
    turns = C.turns(spark, sf_dir)
    words = X.words(F.coalesce("content", F.lit("")))
    n = F.size(words)

    def one(i):
        b, f, s = (F.round(X.uniform(F.col("record_id"), F.col("turn"), i, F.lit(x)), 6) for x in "bfs")
        off = i % 7 == 0
        p = F.struct(F.when(off, 0.0).otherwise(b).alias("backchannel"), F.when(off, 0.0).otherwise(f).alias("interruption"), F.when(off, 0.0).otherwise(s).alias("none"))
        return F.struct(i.cast("string").alias("word_index"), p.alias("probabilities"))

    odd = [F.struct(x.alias("word_index"), F.struct(F.lit(1.0).alias("backchannel"), F.lit(0.0).alias("interruption"), F.lit(0.0).alias("none")).alias("probabilities")) for x in (F.lit("three"), F.lit("-1"), n.cast("string"), F.lit(None).cast("string"))]
    found = F.concat(F.transform(S.slots_a(words), one), F.array(*odd))
    return bound(turns, boundaries=F.when((F.col("record_id") + F.col("turn")) % 3 != 0, found))


SQL_ANN = f"""{P.SQL_W}, {P.SQL_CONTEXT}, brd AS (SELECT record_id, turn, ws, word_index, CASE WHEN word_index % 7 = 0 THEN 0 ELSE round({sql_uniform('record_id', 'turn', 'word_index', "'b'")}, 6) END AS b, CASE WHEN word_index % 7 = 0 THEN 0 ELSE round({sql_uniform('record_id', 'turn', 'word_index', "'f'")}, 6) END AS f, CASE WHEN word_index % 7 = 0 THEN 0 ELSE round({sql_uniform('record_id', 'turn', 'word_index', "'s'")}, 6) END AS s FROM sa WHERE role = 'user' AND (record_id + turn) % 3 <> 0),
trp AS (SELECT record_id, turn, ws, word_index, CASE WHEN b + f + s <= 0 THEN 0.0 ELSE b / (b + f + s) END AS h1, CASE WHEN b + f + s <= 0 THEN 0.0 ELSE f / (b + f + s) END AS h2, CASE WHEN b + f + s <= 0 THEN 1.0 ELSE s / (b + f + s) END AS h3 FROM brd)"""


def found(spark, sf_dir):
    return M.examples(annotated(spark, sf_dir), "record_id", "turn", "boundaries", "word_index", M.human_target)


@registry.query("t12_training_examples", f"WITH {SQL_ANN}, g AS (SELECT record_id, turn, count(*) AS n, string_agg(CAST(word_index AS VARCHAR), ' ' ORDER BY word_index) AS places, round(sum(h1), 6) AS backchannel, round(sum(h3), 6) AS none FROM trp GROUP BY ALL) SELECT g.record_id, g.turn, CAST(len(c) AS INTEGER) AS n_context, content AS user_utterance, CAST(n AS INTEGER) AS n_trps, places, backchannel, none FROM g JOIN ctx4 ON ctx4.record_id = g.record_id AND ctx4.turn = g.turn")
def t12_training_examples(spark, sf_dir):
    """One example for each annotated user turn: context, utterance, and all its valid boundaries with their distributions."""
    total = lambda k: F.round(F.aggregate(F.transform("trps", lambda t: F.get(t["target_probs"], F.lit(k))), F.lit(0.0), lambda a, b: a + b), 6)
    places = F.array_join(F.transform("trps", lambda t: t["word_idx"].cast("string")), " ")
    return found(spark, sf_dir).select(*KEY, F.size("context").alias("n_context"), "user_utterance", F.size("trps").alias("n_trps"), places.alias("places"), total(0).alias("backchannel"), total(2).alias("none"))


@registry.query("t14_single_slots", f"WITH {SQL_ANN} SELECT trp.record_id, trp.turn, word_index AS word_idx, round(h1, 9) AS p_backchannel, round(h2, 9) AS p_interruption, round(h3, 9) AS p_none, array_to_string(ws[1:word_index + 1], ' ') AS partial FROM trp")
def t14_single_slots(spark, sf_dir):
    """Examples of one boundary each, with the turn up to it."""
    rows = M.single_slots(found(spark, sf_dir), "record_id", "turn")
    partial = F.array_join(F.slice(X.words(F.col("user_utterance")), F.lit(1), F.col("word_idx") + 1), " ")
    return rows.select(*KEY, "word_idx", *[F.round(F.get("target_probs", F.lit(i)), 9).alias(f"p_{x}") for i, x in enumerate(E.HEAD)], partial.alias("partial"))


@registry.query("f8_valid_boundaries", f"WITH {SQL_ANN} SELECT record_id, turn, CAST(4 + (SELECT count(*) FROM sa WHERE sa.record_id = w.record_id AND sa.turn = w.turn) AS INTEGER) AS boundaries, CAST((SELECT count(*) FROM sa WHERE sa.record_id = w.record_id AND sa.turn = w.turn) AS INTEGER) AS valid FROM w WHERE role = 'user' AND (record_id + turn) % 3 <> 0")
def f8_valid_boundaries(spark, sf_dir):
    """Annotated user turns, their boundaries, and how many of these are places in the turn."""
    rows = annotated(spark, sf_dir).where(M.is_annotated(F.col("boundaries"), F.col("content"), F.col("role")))
    valid = F.filter("boundaries", lambda b: M.valid_place(b["word_index"], F.size(X.words(F.col("content")))).isNotNull())
    return rows.select(*KEY, F.size("boundaries").alias("boundaries"), F.size(valid).alias("valid"))


def responses():
    """What the stand-in service answers for a slot: JSON, JSON in prose, zeros, or nothing of use."""
    a, b, c = (F.floor(100 * X.uniform(F.col("record_id"), F.col("turn"), F.col("word_idx"), F.lit(x))).cast("int").cast("string") for x in "xyz")
    body = F.concat(F.lit('{"backchannel": '), a, F.lit(', "take_floor": '), b, F.lit(', "silent": '), c, F.lit("}"))
    kind = F.col("word_idx") % 6
    return F.when(kind == 1, F.concat(F.lit("<think>{}</think> I would say "), body, F.lit(" {ok}"))).when(kind == 2, '{"backchannel": 0, "take_floor": null}').when(kind == 3, "none of them").when(kind == 4, F.concat(F.lit('{"backchannel": oops '), body)).otherwise(body)


_SQL_RESP = f"""rsp AS (SELECT trp.*, word_index % 6 AS kind, CAST(floor(100 * {sql_uniform('record_id', 'turn', 'word_index', "'x'")}) AS INTEGER) AS x, CAST(floor(100 * {sql_uniform('record_id', 'turn', 'word_index', "'y'")}) AS INTEGER) AS y, CAST(floor(100 * {sql_uniform('record_id', 'turn', 'word_index', "'z'")}) AS INTEGER) AS z FROM trp),
prd AS (SELECT *, kind IN (0, 1, 4, 5) AND x + y + z > 0 AS ok FROM rsp),
prb AS (SELECT *, CASE WHEN ok THEN x / (x + y + z) ELSE 1 / 3.0 END AS q1, CASE WHEN ok THEN y / (x + y + z) ELSE 1 / 3.0 END AS q2, CASE WHEN ok THEN z / (x + y + z) ELSE 1 / 3.0 END AS q3 FROM prd)"""


@registry.query("t15_inferred", f"WITH {SQL_ANN}, {_SQL_RESP} SELECT record_id, turn, word_index AS word_idx, CASE WHEN ok THEN 'ok' ELSE 'unparsable_response' END AS status, CASE WHEN q1 >= q2 AND q1 >= q3 THEN 'backchannel' WHEN q2 >= q3 THEN 'take_floor' ELSE 'silent' END AS pred_label, round(CASE WHEN h1 > 0 THEN h1 * ln(h1 / greatest(q1, 1e-12)) ELSE 0 END + CASE WHEN h2 > 0 THEN h2 * ln(h2 / greatest(q2, 1e-12)) ELSE 0 END + CASE WHEN h3 > 0 THEN h3 * ln(h3 / greatest(q3, 1e-12)) ELSE 0 END, 6) AS kl FROM prb")
def t15_inferred(spark, sf_dir):
    """Answers read for each slot: distribution, label and divergence; the uniform distribution, flagged, where one can't be read."""
    rows = M.single_slots(found(spark, sf_dir), "record_id", "turn")
    none = F.array().cast("array<double>")
    answer = X.after_think(responses())
    rows = rows.withColumn("told", X.told_distribution(answer, ("backchannel", "take_floor", "silent"), none))
    pred = F.when(F.size("told") > 0, F.col("told")).otherwise(F.array(*[F.lit(1 / 3)] * 3))
    rows = rows.withColumn("pred", pred)
    label = F.element_at(F.array(F.lit("backchannel"), F.lit("take_floor"), F.lit("silent")), E.argmax(F.col("pred")) + 1)
    return rows.select(*KEY, "word_idx", F.when(F.size("told") > 0, "ok").otherwise("unparsable_response").alias("status"), label.alias("pred_label"), F.round(E.kl(F.col("target_probs"), F.col("pred")), 6).alias("kl"))


@registry.query("k6_evaluation", f"WITH {SQL_ANN}, {_SQL_RESP}, k AS (SELECT *, CASE WHEN h1 > 0 THEN h1 * ln(h1 / greatest(q1, 1e-12)) ELSE 0 END + CASE WHEN h2 > 0 THEN h2 * ln(h2 / greatest(q2, 1e-12)) ELSE 0 END + CASE WHEN h3 > 0 THEN h3 * ln(h3 / greatest(q3, 1e-12)) ELSE 0 END AS kl FROM prb) SELECT count(*) AS n, sum(CASE WHEN ok THEN 0 ELSE 1 END) AS n_fallback, round(avg(kl), 6) AS mean_kl FROM k")
def k6_evaluation(spark, sf_dir):
    """The summary that an evaluation writes beside its samples."""
    return t15_inferred(spark, sf_dir).agg(F.count("*").alias("n"), F.count_if(F.col("status") != "ok").alias("n_fallback"), F.round(F.avg("kl"), 6).alias("mean_kl"))


@registry.query("proj14_human_votes", f"WITH {SQL_ANN} SELECT record_id, turn, word_index AS word_idx, round(h1, 9) AS backchannel, round(h2, 9) AS take_floor, round(h3, 9) AS silent FROM trp")
def proj14_human_votes(spark, sf_dir):
    """Training distributions under the names that annotators used."""
    rows = M.single_slots(found(spark, sf_dir), "record_id", "turn").select(*KEY, "word_idx", M.human_votes(F.col("target_probs")).alias("v"))
    return rows.select(*KEY, "word_idx", *[F.round(F.col(f"v.{x}"), 9).alias(x) for x in ("backchannel", "take_floor", "silent")])


# --- typed transcripts -------------------------------------------------------


def typed_turns(spark, sf_dir):
    """Transcript turns as (conversation_id, turn, role, content, words, typed)."""
    rows = bound(T.w5_merged_turns(spark, sf_dir), b=M.typed_boundaries(F.col("text")))
    role = F.when(F.col("speaker") == "A", "assistant").otherwise("user")
    return rows.select("conversation_id", F.col("turn_no").alias("turn"), role.alias("role"), F.array_join("b.words", " ").alias("content"), F.col("b.words").alias("words"), F.col("b.typed").alias("typed"))


_SQL_W5 = T.registry.sql["w5_merged_turns"].split("\nSELECT conversation_id, CAST(turn_no")[0]
SQL_TYP = f"""{_SQL_W5}, tn AS (SELECT conversation_id, CAST(turn_no AS BIGINT) AS turn, CASE any_value(speaker) WHEN 'A' THEN 'assistant' ELSE 'user' END AS role, string_agg(t, ' ' ORDER BY i) AS text FROM r GROUP BY conversation_id, turn_no),
tk AS (SELECT conversation_id, turn, role, unnest(ts) AS tok, generate_subscripts(ts, 1) AS p FROM (SELECT *, {sql_words('text')} AS ts FROM tn)),
tc AS (SELECT *, tok IN ('[BACKCHANNEL]', '[TAKE_FLOOR]') AS is_tok, sum(CASE WHEN tok IN ('[BACKCHANNEL]', '[TAKE_FLOOR]') THEN 0 ELSE 1 END) OVER (PARTITION BY conversation_id, turn ORDER BY p) - 1 AS idx FROM tk),
ty AS (SELECT conversation_id, turn, idx, CASE arg_max(tok, p) WHEN '[BACKCHANNEL]' THEN 'BACKCHANNEL' ELSE 'TAKE_FLOOR' END AS type FROM tc WHERE is_tok AND idx >= 0 GROUP BY ALL),
wd AS (SELECT conversation_id, turn, role, list(tok ORDER BY p) AS ws FROM tc WHERE NOT is_tok GROUP BY ALL),
cw AS (SELECT conversation_id, turn, role, ws, i - 1 AS i, ws[i] AS word FROM (SELECT *, unnest(generate_series(1, len(ws))) AS i FROM wd)),
cd AS (SELECT conversation_id, turn, i FROM cw WHERE (regexp_matches(word, {q(X.STOP)}) OR {C.sql_clean('word')} IN ({P.HES})) AND i < len(ws) - 1),
cg AS (SELECT *, i - row_number() OVER (PARTITION BY conversation_id, turn ORDER BY i) AS g FROM cd), ck AS (SELECT *, count(*) OVER (PARTITION BY conversation_id, turn, g) AS k, row_number() OVER (PARTITION BY conversation_id, turn, g ORDER BY i) AS n FROM cg),
th AS (SELECT conversation_id, turn, i FROM ck WHERE k = 1 OR n % 2 = 0), en AS (SELECT * FROM th UNION ALL SELECT conversation_id, turn, len(ws) - 1 FROM wd), lg AS (SELECT *, coalesce(lag(i) OVER (PARTITION BY conversation_id, turn ORDER BY i), -1) AS pr FROM en),
ca AS (SELECT conversation_id, turn, i FROM th UNION SELECT conversation_id, turn, unnest(range(pr + 4, i, 4)) FROM lg WHERE i - pr > 8),
jb AS (SELECT coalesce(ca.conversation_id, ty.conversation_id) AS conversation_id, coalesce(ca.turn, ty.turn) AS turn, CAST(coalesce(ca.i, ty.idx) AS INTEGER) AS idx, type FROM ca FULL JOIN ty ON ty.conversation_id = ca.conversation_id AND ty.turn = ca.turn AND ty.idx = ca.i)"""


@registry.query("j7_typed_join", f"{SQL_TYP} SELECT conversation_id, turn, idx, type FROM jb")
def j7_typed_join(spark, sf_dir):
    """Candidate places of transcript turns joined with the tokens that stand in them; the type wins."""
    rows = typed_turns(spark, sf_dir)
    rows = bound(rows, found=S.slots_b(F.col("words")), joined=M.joined_boundaries(F.col("found"), F.col("typed")))
    return rows.select("conversation_id", "turn", F.inline("joined"))


@registry.query("t13_one_hot_examples", f"{SQL_TYP}, sp AS (SELECT conversation_id, CASE WHEN {C.sql_fold("conversation_id")} / 10000 < 0.9 THEN 'train' ELSE 'test' END AS split FROM (SELECT DISTINCT conversation_id FROM wd)), wh AS (SELECT conversation_id, turn, row_number() OVER (PARTITION BY conversation_id ORDER BY turn) AS nth FROM tn), ct AS (SELECT conversation_id, turn, CAST(least(nth - 1, 4) AS INTEGER) AS most FROM wh), oh AS (SELECT jb.*, CASE type WHEN 'BACKCHANNEL' THEN 0 WHEN 'TAKE_FLOOR' THEN 1 ELSE 2 END AS hot FROM jb JOIN wd USING (conversation_id, turn) WHERE idx < len(ws)) SELECT sp.split, conversation_id, turn, count(*) AS n, sum(CASE WHEN hot = 0 THEN 1 ELSE 0 END) AS backchannel, sum(CASE WHEN hot = 1 THEN 1 ELSE 0 END) AS interruption, sum(CASE WHEN hot = 2 THEN 1 ELSE 0 END) AS none FROM oh JOIN sp USING (conversation_id) GROUP BY ALL")
def t13_one_hot_examples(spark, sf_dir):
    """Examples of typed transcript turns of either role, split by the hash of their conversation."""
    rows = bound(typed_turns(spark, sf_dir), found=S.slots_b(F.col("words")), boundaries=M.joined_boundaries(F.col("found"), F.col("typed")))
    got = M.examples(rows, "conversation_id", "turn", "boundaries", "idx", M.one_hot, any_role=True)
    share = lambda k: F.aggregate(F.transform("trps", lambda t: F.get(t["target_probs"], F.lit(k))), F.lit(0.0), lambda a, b: a + b).cast("bigint")
    return got.select(O.hash_split(F.col("conversation_id"), 0.9).alias("split"), "conversation_id", "turn", F.size("trps").cast("bigint").alias("n"), share(0).alias("backchannel"), share(1).alias("interruption"), share(2).alias("none"))


# --- prompts -----------------------------------------------------------------

_LINE = f"CAST(turn + $0 AS VARCHAR) || ') ' || coalesce(role, '?') || ': ' || {sql_ws("coalesce(content, '')")}"
_BLK = f"blk AS (SELECT record_id, string_agg({_LINE.replace('$0', '1')}, chr(10) ORDER BY turn) AS source, string_agg({_LINE.replace('$0', '0')}, chr(10) ORDER BY turn) AS source0 FROM turns GROUP BY record_id), his AS (SELECT record_id, turn, role, content, string_agg({_LINE.replace('$0', '1')}, chr(10)) OVER (PARTITION BY record_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS history, lag(content) OVER (PARTITION BY record_id ORDER BY turn) AS previous FROM turns)"


def _blocks(spark, sf_dir):
    """Each turn with its dialogue's block and the block of what was said before it."""
    rows = C.dialogues(spark, sf_dir).where("size(history) > 0")
    turns = F.transform("history", lambda t: F.struct(C.role_of(t["role"]).alias("role"), t["content"].alias("content")))
    rows = rows.select("record_id", turns.alias("turns")).select("record_id", "turns", M.block(F.col("turns")).alias("source"), F.posexplode("turns").alias("turn", "t"))
    said = F.slice("turns", F.lit(1), F.col("turn"))
    return rows.select("record_id", "turn", "source", "turns", F.col("t.role").alias("role"), F.col("t.content").alias("content"), M.block(said).alias("history"), F.get("turns", F.col("turn") - 1)["content"].alias("previous"))


@registry.query("proj12_zero_block", f"WITH {C.SQL_TURNS}, {_BLK} SELECT record_id, source0 AS block FROM blk")
def proj12_zero_block(spark, sf_dir):
    """Each dialogue as lines numbered from 0."""
    turns = F.transform("history", lambda t: F.struct(C.role_of(t["role"]).alias("role"), t["content"].alias("content")))
    return C.dialogues(spark, sf_dir).where("size(history) > 0").select("record_id", M.block(turns, 0).alias("block"))


_R = "coalesce(role, '')"


@registry.query("proj13_rewrite_prompts", f"""WITH {C.SQL_TURNS}, {_BLK} SELECT h.record_id, h.turn, CASE WHEN turn = 0 THEN 'Source:' || chr(10) || source || chr(10) || chr(10) || 'Write the first turn, by ' || {_R} || ', as speech.' || chr(10) || 'Source turn by ' || {_R} || ': ' || {sql_ws("coalesce(content, '')")}
 WHEN turn % 2 = 0 THEN 'Source:' || chr(10) || source || chr(10) || chr(10) || 'So far, still being spoken:' || chr(10) || history || chr(10) || chr(10) || 'Go on as ' || {_R} || '.'
 ELSE 'Source:' || chr(10) || source || chr(10) || chr(10) || 'So far:' || chr(10) || history || chr(10) || chr(10) || 'Write the next turn, by ' || {_R} || ', as speech.' END AS prompt FROM his h JOIN blk USING (record_id)""")
def proj13_rewrite_prompts(spark, sf_dir):
    """What a generator is asked for each turn: the first one, the next one, or one still being spoken."""
    rows = _blocks(spark, sf_dir)
    role = F.col("role")
    first = M.prompt("first_turn", source=F.col("source"), role=role, speaker=role, text=X.normalize_ws(F.col("content")))
    later = {k: M.prompt(k, source=F.col("source"), history=F.col("history"), role=role) for k in ("with_history", "streaming")}
    return rows.select(*KEY, F.when(F.col("turn") == 0, first).when(F.col("turn") % 2 == 0, later["streaming"]).otherwise(later["with_history"]).alias("prompt"))


@registry.query("proj13_judge_prompts", f"WITH {C.SQL_TURNS}, {_BLK} SELECT record_id, turn, 'Source:' || chr(10) || source || chr(10) || chr(10) || 'Spoken:' || chr(10) || history || chr(10) || chr(10) || 'Is all of the source said? Answer as JSON with done and stop.' AS prompt FROM his JOIN blk USING (record_id) WHERE turn > 0")
def proj13_judge_prompts(spark, sf_dir):
    """What a judge is asked before each turn but the first."""
    return _blocks(spark, sf_dir).where("turn > 0").select(*KEY, M.prompt("judge", source=F.col("source"), generated=F.col("history")).alias("prompt"))


@registry.query("proj13_evaluate_prompts", f"WITH {SQL_ANN} SELECT trp.record_id, trp.turn, word_index AS word_idx, coalesce(array_to_string(list_transform(c, lambda t: CASE t.role WHEN 'user' THEN 'Speaker' WHEN 'assistant' THEN 'Listener' ELSE '?' END || ': ' || t.content || chr(10)), ''), '') || 'Speaker (so far): ' || array_to_string(ws[1:word_index + 1], ' ') AS prompt FROM trp JOIN ctx4 ON ctx4.record_id = trp.record_id AND ctx4.turn = trp.turn")
def proj13_evaluate_prompts(spark, sf_dir):
    """What a model is asked for each slot: who said what before, and the turn so far."""
    rows = M.single_slots(found(spark, sf_dir), "record_id", "turn")
    partial = F.array_join(F.slice(X.words(F.col("user_utterance")), F.lit(1), F.col("word_idx") + 1), " ")
    return rows.select(*KEY, "word_idx", M.prompt("evaluate", lines=M.prompt_lines(F.col("context")), partial=partial).alias("prompt"))


@registry.query("proj13_backchannel_prompts", f"{P.SQL_FOLD}, {_BLK} SELECT f.record_id, f.turn, f.word_index, 'Conversation:' || chr(10) || '[PREVIOUS]' || chr(10) || coalesce({sql_strip('previous')}, '') || chr(10) || '[SPEAKER CURRENT]' || chr(10) || array_to_string(ws[1:f.word_index + 1], ' ') || ' [INSERT] ' || array_to_string(ws[f.word_index + 2:], ' ') AS prompt FROM fold f JOIN w ON w.record_id = f.record_id AND w.turn = f.turn JOIN his ON his.record_id = f.record_id AND his.turn = f.turn WHERE f.decision = 'backchannel'")
def proj13_backchannel_prompts(spark, sf_dir):
    """What a model is asked for each decided backchannel."""
    rows = P.decided_turns(spark, sf_dir).join(_blocks(spark, sf_dir).select(*KEY, "previous"), KEY)
    rows = rows.select(*KEY, "words", "previous", F.explode(F.filter("decisions", lambda d: d["decision"] == "backchannel")).alias("d"))
    i = F.col("d.word_index")
    prefix, rest = F.array_join(F.slice("words", F.lit(1), i + 1), " "), F.array_join(F.slice("words", i + 2, F.size("words")), " ")
    return rows.select(*KEY, i.alias("word_index"), M.prompt("backchannel", previous=X.strip(F.col("previous")), prefix=prefix, rest=rest).alias("prompt"))
