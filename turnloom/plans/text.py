"""Scalar text functions, run over the turns of the dialogues (X, F4, F5, P9-P12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnloom.functions import text as X
from turnloom.plans import common as C
from turnloom.plans.common import q, sql_strip, sql_words, sql_ws
from turnloom.registry import Registry
from turnloom.session import table

registry = Registry()
KEY = ["record_id", "turn"]
S = f"WITH {C.SQL_TURNS}"


def over_turns(name, column, sql, out):
    """A query of one function of each turn's content and its SQL."""

    @registry.query(name, f"{S} SELECT record_id, turn, {sql} AS {out} FROM said")
    def run(spark, sf_dir):
        return C.said(spark, sf_dir).select(*KEY, column(F.col("content")).alias(out))

    run.__doc__ = column.__doc__
    return run


def dirty(x):
    """Turns as a careless model returns them."""
    return F.concat(F.element_at(F.array(F.lit('10) user: "'), F.lit("<think>so</think> Assistant: - "), F.lit("2. "), F.lit("```text\n"), F.lit(" ai — human: ")), F.pmod(F.col("turn"), F.lit(5)) + 1), x, F.when(F.pmod(F.col("turn"), F.lit(5)) == 0, '"').when(F.pmod(F.col("turn"), F.lit(5)) == 3, "\n```").otherwise(""))


SQL_DIRTY = "((['10) user: \"', '<think>so</think> Assistant: - ', '2. ', '```text' || chr(10), ' ai — human: '])[turn % 5 + 1] || content || CASE turn % 5 WHEN 0 THEN '\"' WHEN 3 THEN chr(10) || '```' ELSE '' END)"


def _sql_sanitize(x: str) -> tuple[str, str]:
    """(CTE members, expression) of the cleaning, a round a member."""
    def rx(s, p, to="", o="g"):
        return f"regexp_replace({s}, {q(p)}, {q(to)}, {q(o)})"

    first = sql_strip(rx(sql_strip(x), "<think>.*?</think>", "", "gs"))
    first = sql_strip(rx(first, r"^```[a-zA-Z0-9_+-]*\s*"))
    first = sql_strip(rx(first, r"\s*```\s*$"))
    steps = [f"r0 AS (SELECT record_id, turn, {first} AS s FROM said)"]
    for k in range(4):
        s = "s"
        for p in (X.FULL_PREFIX, X.ROLE_PREFIX, rf"^\s*{X.INDEX}\s*"):
            s = rx(rx(s, p, "", "i"), r"^\s+", "", "")
        steps.append(f"p{k} AS (SELECT record_id, turn, {s} AS s FROM r{k})")
        steps.append(f"r{k + 1} AS (SELECT record_id, turn, CASE WHEN length(s) >= 2 AND regexp_matches(s, {q(X.QUOTED)}) THEN {sql_strip(f'regexp_replace(s, {q(X.QUOTED)}, {q(chr(92) + str(1))})')} ELSE s END AS s FROM p{k})")
    return ", ".join(steps), sql_ws("regexp_replace(s, '[—–]', ', ', 'g')")


_MEMBERS, _EXPR = _sql_sanitize(SQL_DIRTY)


@registry.query("x4_sanitize_utterance", f"{S}, {_MEMBERS} SELECT record_id, turn, {_EXPR} AS clean FROM r4")
def x4_sanitize_utterance(spark, sf_dir):
    """Turns with model artefacts, cleaned."""
    return C.said(spark, sf_dir).select(*KEY, X.sanitize_utterance(dirty(F.col("content"))).alias("clean"))


over_turns("x3_normalize_ws", X.normalize_ws, sql_ws("content"), "text")
over_turns("f1_stripped", X.strip, sql_strip("content"), "text")
over_turns("x8_safe_id", X.safe_id, r"regexp_replace(content, '[^\p{L}\p{N}_\-.]', '_', 'g')", "id")
over_turns("x20_backchannel_key", X.backchannel_key, r"lower(regexp_replace(content, '^[\s.,!?\-]+|[\s.,!?\-]+$', '', 'g'))", "key")
over_turns("x14_align_words", lambda x: F.size(X.align_words(x)), f"CAST(len(regexp_extract_all(content, {q(X.WORD)})) AS INTEGER)", "n_words")


@registry.query("x2_clean_word", f"{S}, w AS (SELECT record_id, turn, unnest({sql_words('content')}) AS word FROM said) SELECT word, {C.sql_clean('word')} AS clean, count(*) AS n FROM w GROUP BY word")
def x2_clean_word(spark, sf_dir):
    """Every distinct word, cleaned, and how often it stands."""
    w = C.said(spark, sf_dir).select(F.explode(X.words(F.col("content"))).alias("word"))
    return w.groupBy("word").agg(F.count("*").alias("n")).select("word", X.clean_word(F.col("word")).alias("clean"), "n")


@registry.query("x5_think", f"{S} SELECT record_id, turn, {sql_strip(chr(34) + 'a' + chr(34))} AS without_think, {sql_strip('b')} AS after_think FROM (SELECT record_id, turn, regexp_replace('<think>' || content || '</think> ok ' || content, '<think>.*?</think>', '', 'gs') AS a, ' ok ' || content AS b FROM said)")
def x5_think(spark, sf_dir):
    """Think blocks taken out, and what follows the last of them."""
    x = F.concat(F.lit("<think>"), F.col("content"), F.lit("</think> ok "), F.col("content"))
    return C.said(spark, sf_dir).select(*KEY, X.without_think(x).alias("without_think"), X.after_think(x).alias("after_think"))


_BODY = "'{\"score\": ' || CAST(turn * 3 AS VARCHAR) || ', \"note\": ' || to_json(content) || '}'"


@registry.query("x6_json_parse", f"""{S}, a AS (SELECT record_id, turn, CASE turn % 4 WHEN 0 THEN {_BODY} WHEN 1 THEN 'Sure:' || chr(10) || '```json' || chr(10) || {_BODY} || chr(10) || '``` done' WHEN 2 THEN 'so {{"score": ' || CAST(turn AS VARCHAR) || '}} or {{"score": 7}}' ELSE left({_BODY}, 9) END AS x FROM said),
p AS (SELECT *, regexp_extract(x, '\\{{.*\\}}', 0, 's') AS wide, regexp_extract(x, '\\{{[^{{}}]*\\}}', 0, 's') AS flat FROM a)
SELECT record_id, turn, CASE WHEN json_valid(x) THEN json_extract(x, '$.score')::DOUBLE WHEN json_valid(wide) THEN json_extract(wide, '$.score')::DOUBLE END AS score, CASE WHEN json_valid(flat) THEN json_extract(flat, '$.score')::DOUBLE END AS flat_score, {sql_strip("regexp_replace(regexp_replace(" + sql_strip('x') + ", '^```[a-zA-Z0-9_+-]*\\s*', ''), '\\s*```$', '')")} AS bare FROM p""")
def x6_json_parse(spark, sf_dir):
    """A number out of an answer that is JSON, holds JSON, holds two objects, or is broken; and the answer without a fence."""
    body = F.concat(F.lit('{"score": '), (F.col("turn") * 3).cast("string"), F.lit(', "note": '), F.substring(F.to_json(F.array("content")), F.lit(2), F.length(F.to_json(F.array("content"))) - 2), F.lit("}"))
    kind = F.col("turn") % 4
    fenced = F.concat(F.lit("Sure:\n```json\n"), body, F.lit("\n``` done"))
    two = F.concat(F.lit('so {"score": '), F.col("turn").cast("string"), F.lit('} or {"score": 7}'))
    x = F.when(kind == 0, body).when(kind == 1, fenced).when(kind == 2, two).otherwise(F.substring(body, 1, 9))
    rows = C.said(spark, sf_dir).select(*KEY, x.alias("x"))
    return rows.select(*KEY, X.first_json(F.col("x"), "score double, note string")["score"].alias("score"), X.flat_json(F.col("x"), "score double")["score"].alias("flat_score"), X.without_fences(F.col("x")).alias("bare"))


@registry.query("proj1_rules", f"""WITH d AS (SELECT DISTINCT record_id, dataset, history FROM dialogues), e AS (SELECT record_id, dataset, unnest(history) AS h, generate_subscripts(history, 1) - 1 AS i FROM d)
SELECT record_id, CAST(i AS INTEGER) AS turn, CASE dataset WHEN 'soda' THEN CASE WHEN i % 2 = 0 THEN 'user' ELSE 'assistant' END {' '.join(f"WHEN {q(k)} THEN CASE WHEN lower(h.role) IN ({', '.join(map(q, v))}) THEN {q(r)} ELSE {q('assistant' if r == 'user' else 'user')} END" for k, (r, v) in X.ROLE_RULES.items())} END AS role FROM e WHERE dataset IN ('soda', {', '.join(map(q, X.ROLE_RULES))})""")
def proj1_rules(spark, sf_dir):
    """Roles by the rule of each collection."""
    rows = C.dialogues(spark, sf_dir).where(F.col("dataset").isin("soda", *X.ROLE_RULES)).select("record_id", "dataset", F.posexplode("history").alias("turn", "h"))
    role = None
    for rule in ("soda", *X.ROLE_RULES):
        own = X.role_by(rule, F.col("h.role"), F.col("turn"))
        role = F.when(F.col("dataset") == rule, own) if role is None else role.when(F.col("dataset") == rule, own)
    return rows.select("record_id", "turn", role.alias("role"))


_NAME = r"^\p{Lu}\p{L}+"


@registry.query("x7_name_to_role", f"{S}, n AS (SELECT *, regexp_extract(content, {q(_NAME)}) AS name FROM said) SELECT record_id, turn, CASE WHEN name = '' THEN content ELSE regexp_replace(regexp_replace(content, '(^|[^\\p{{L}}\\p{{M}}\\p{{N}}_])' || name || '(?:$|([^\\p{{L}}\\p{{M}}\\p{{N}}_]))', '\\1User\\2', 'gi'), '(^|[^\\p{{L}}\\p{{M}}\\p{{N}}_])' || name || '(?:$|([^\\p{{L}}\\p{{M}}\\p{{N}}_]))', '\\1User\\2', 'gi') END AS text FROM n")
def x7_name_to_role(spark, sf_dir):
    """The name that opens a turn, replaced by a role wherever it stands as a whole word, in any case."""
    name = F.regexp_extract("content", f"({_NAME})", 1)
    return C.said(spark, sf_dir).select(*KEY, F.when(name == "", F.col("content")).otherwise(X.name_to_role(F.col("content"), name)).alias("text"))


@registry.query("x9_boundary_words", f"""{S}, w AS (SELECT record_id, turn, {sql_words('content')} AS ws FROM said),
x AS (SELECT record_id, turn, i - 1 AS word_index, ws[i] AS word FROM (SELECT *, unnest(generate_series(1, len(ws))) AS i FROM w))
SELECT record_id, turn, CAST(word_index AS INTEGER) AS word_index, regexp_matches(word, {q(X.STOP)}) AS is_stop, {C.sql_clean('word')} IN ({', '.join(map(q, X.HESITATIONS))}) AS is_hesitation FROM x
WHERE regexp_matches(word, {q(X.STOP)}) OR {C.sql_clean('word')} IN ({', '.join(map(q, X.HESITATIONS))})""")
def x9_boundary_words(spark, sf_dir):
    """Words that end in punctuation, and hesitations."""
    w = C.said(spark, sf_dir).select(*KEY, F.posexplode(X.words(F.col("content"))).alias("word_index", "word"))
    w = w.select(*KEY, "word_index", F.col("word").rlike(X.STOP).alias("is_stop"), X.clean_word(F.col("word")).isin(*X.HESITATIONS).alias("is_hesitation"))
    return w.where("is_stop OR is_hesitation")


def _tagged():
    """Turns with known tags, other tags and hyphens in them; whatever brackets the corpus holds stay."""
    return F.concat(F.lit("[laughter] well-known "), F.col("content"), F.lit(" [sigh][PAUSE] [noise-x] a-b [question-en]"))


_SQL_TAGGED = "('[laughter] well-known ' || content || ' [sigh][PAUSE] [noise-x] a-b [question-en]')"
_BRACKET = r"\[[A-Za-z0-9_\-]+\]"
#: Bracket tags of a text, and what stands between them.
_SQL_PIECES = f"regexp_extract_all({_SQL_TAGGED}, {q(_BRACKET)}) AS tags, string_split(regexp_replace({_SQL_TAGGED}, {q(_BRACKET)}, chr(1), 'g'), chr(1)) AS texts"


@registry.query("x11_strip_tags", f"""{S}, p AS (SELECT record_id, turn, {_SQL_TAGGED} AS t, {_SQL_PIECES} FROM said)
SELECT record_id, turn, regexp_replace(t, {q(X.TAG)}, '', 'g') AS bare, list_reduce(list_prepend('', list_transform(texts, lambda x, i: x || CASE WHEN tags[i] IN ('[sigh]', '[PAUSE]') THEN tags[i] ELSE '' END)), lambda a, b: a || b) AS kept FROM p""")
def x11_strip_tags(spark, sf_dir):
    """Paralinguistic tags off: the known ones, and all but those kept."""
    return C.said(spark, sf_dir).select(*KEY, X.strip_tags(_tagged()).alias("bare"), X.strip_tags_but(_tagged(), ("sigh",)).alias("kept"))


@registry.query("x12_dashes", f"{S}, p AS (SELECT record_id, turn, {_SQL_PIECES} FROM said) SELECT record_id, turn, list_reduce(list_prepend('', list_transform(texts, lambda x, i: replace(x, '-', ' ') || coalesce(tags[i], ''))), lambda a, b: a || b) AS text FROM p")
def x12_dashes(spark, sf_dir):
    """Hyphens as spaces outside bracket tags."""
    return C.said(spark, sf_dir).select(*KEY, X.dashes_to_spaces(_tagged()).alias("text"))


@registry.query("x13_sentences", f"""{S}, s AS (SELECT record_id, turn, list_filter(list_transform(string_split(regexp_replace(content, '([.?!])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: {sql_strip('x')}), lambda x: x <> '') AS ss FROM said)
SELECT record_id, turn, CAST(i - 1 AS INTEGER) AS sentence_no, ss[i] AS sentence FROM (SELECT *, unnest(generate_series(1, len(ss))) AS i FROM s)""")
def x13_sentences(spark, sf_dir):
    """The sentences of each turn."""
    return C.said(spark, sf_dir).select(*KEY, F.posexplode(X.sentences(F.col("content"))).alias("sentence_no", "sentence"))


def _floor():
    """Turns whose floor is taken after a third of their words."""
    ws = X.words(F.col("content"))
    at = F.floor(F.size(ws) / 3).cast("int")
    return F.concat(F.array_join(F.slice(ws, F.lit(1), at), " "), F.lit(" [TAKE_FLOOR] "), F.array_join(F.slice(ws, at + 1, F.size(ws)), " "))


@registry.query("x15_cut_at_take_floor", f"""{S}, w AS (SELECT record_id, turn, {sql_words('content')} AS ws FROM said),
p AS (SELECT record_id, turn, array_to_string(ws[1:len(ws) // 3], ' ') || ' [TAKE_FLOOR] ' || array_to_string(ws[len(ws) // 3 + 1:], ' ') AS s FROM w) SELECT record_id, turn, {C.sql_cut('s')} AS text FROM p""")
def x15_cut_at_take_floor(spark, sf_dir):
    """Turns cut shortly after the floor was taken."""
    return C.said(spark, sf_dir).select(*KEY, X.cut_at_take_floor(_floor()).alias("text"))


_STARRED = "('3) user: ' || content || '[User Turn] [taking_floor] *sighs* *happily* * wink *and* so*')"


def _starred():
    return F.concat(F.lit("3) user: "), F.col("content"), F.lit("[User Turn] [taking_floor] *sighs* *happily* * wink *and* so*"))


@registry.query("x16_sanitize_text", f"{S} SELECT record_id, turn, {C.sql_sanitize_text(_STARRED)} AS text FROM said")
def x16_sanitize_text(spark, sf_dir):
    """Roles, turn marks and stage directions taken off."""
    return C.said(spark, sf_dir).select(*KEY, X.sanitize_text(_starred()).alias("text"))


@registry.query("x17_stage_directions", f"{S} SELECT record_id, turn, {C.sql_stage(_STARRED)} AS text FROM said")
def x17_stage_directions(spark, sf_dir):
    """Starred stage directions."""
    return C.said(spark, sf_dir).select(*KEY, X.stage_directions(_starred()).alias("text"))


def _sql_markup(x):
    s = sql_ws(f"regexp_replace({x}, '[\\[\\]+]', ' ', 'g')")
    s = f"regexp_replace({s}, '\\{{[A-Z]\\s+([^}}]+)\\}}', '\\1', 'g')"
    s = f"regexp_replace(regexp_replace({s}, '<\\s*laughter\\s*>', ' [laughter] ', 'gi'), '<[^>]+>', ' ', 'g')"
    return f"regexp_replace({sql_ws(f'replace({s}, {q(chr(35))}, {q(chr(32))})')}, '^[ \\-]+|[ \\-]+$', '', 'g')"


_LINES = "l AS (SELECT DISTINCT line_id, conversation_id, utt, da, speaker, text_raw FROM transcript_lines)"


@registry.query("x18_transcript_markup", f"""WITH {_LINES} SELECT line_id, nullif(regexp_extract(text_raw, '(-?/)\\s*$', 1), '') AS end_marker, {_sql_markup("regexp_replace(text_raw, '-?/\\s*$', '')")} AS text FROM l WHERE text_raw IS NOT NULL""")
def x18_transcript_markup(spark, sf_dir):
    """Transcript lines without markup, and the marker at their end."""
    lines = table(spark, sf_dir, "transcript_lines").dropDuplicates(["line_id"]).where("text_raw IS NOT NULL")
    return lines.select("line_id", X.end_marker(F.col("text_raw")).alias("end_marker"), X.transcript_markup(F.regexp_replace("text_raw", r"-?/\s*$", "")).alias("text"))


@registry.query("x21_rising", f"WITH {C.SQL_MANIFEST} SELECT backchannel_id, CASE WHEN lower({sql_strip(f"regexp_replace(text, {q(X.TAG)}, '', 'g')")}) IN ({', '.join(map(q, X.RISING))}) THEN regexp_replace(text, {q(X.BLANK + '+$')}, '') || '?' ELSE text END AS text FROM b")
def x21_rising(spark, sf_dir):
    """Backchannels that read better as a question."""
    return C.backchannels(spark, sf_dir).select("backchannel_id", X.rising(F.col("text")).alias("text"))


def _sql_punc(kind):
    x = sql_ws("upper(substr(content, 1, 1)) || substr(content, 2)")
    for old, new in X.PUNCTUATION[kind]:
        x = f"replace({x}, {q(old)}, {q(new)})"
    x = f"rtrim({x}, ' ')"
    return f"CASE WHEN regexp_matches({x}, {q(X.ENDS[kind])}) THEN {x} ELSE {x} || '.' END AS {kind}"


@registry.query("x22_punc_norm", f"{S} SELECT record_id, turn, {', '.join(map(_sql_punc, X.ENDS))} FROM said")
def x22_punc_norm(spark, sf_dir):
    """Turns as each kind of synthesizer wants them."""
    return C.said(spark, sf_dir).select(*KEY, *[X.punc_norm(F.col("content"), kind).alias(kind) for kind in X.ENDS])


@registry.query("x22_decomposed")
def x22_decomposed(spark, sf_dir):
    """Turns decomposed and in lower case, as a tokenizer wants them."""
    return C.said(spark, sf_dir).select(*KEY, X.nfkd_lower(F.col("content")).alias("text"))


_U1, _U2 = (C.sql_uniform("record_id", "turn", f"'{t}'") for t in ("o1", "o2"))


@registry.query("x23_gap_math", f"""{S}, t AS (SELECT record_id, turn, {C.sql_uniform('record_id', 'turn')} AS u, {_U1} AS u1, {_U2} AS u2 FROM said)
SELECT record_id, turn, round(least(greatest(-0.16 * ln(1 - u), 0.02), 1.0), 4) AS gap_sec, round(least(greatest(0.45 + 0.05 * sqrt(-2 * ln(1 - u1)) * cos(2 * pi() * u2), 0), 1), 4) AS overlap_sec, round(pow(10, (-23.0 - (-30 + 10 * u)) / 20), 4) AS gain FROM t""")
def x23_gap_math(spark, sf_dir):
    """An exponential gap, a normal overlap and a loudness gain, from uniform numbers of the turn's key."""
    from turnloom.operators import timeline as L

    u, u1, u2 = (X.uniform(F.col("record_id"), F.col("turn"), *x) for x in ((), (F.lit("o1"),), (F.lit("o2"),)))
    gain = F.round(F.pow(F.lit(10.0), (F.lit(-23.0) - (-30 + 10 * u)) / 20), 4)
    return C.said(spark, sf_dir).select(*KEY, L.sampled_gap(u).alias("gap_sec"), L.sampled_overlap(u1, u2).alias("overlap_sec"), gain.alias("gain"))


def _sql_crc(x):
    """crc32 bit by bit, as SQL has no function for it."""
    step = "CASE WHEN c % 2 = 1 THEN xor(c // 2, CAST(3988292384 AS BIGINT)) ELSE c // 2 END"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ord({x}[z]) AS BIGINT) FOR z IN range(1, length({x}) + 1)]), lambda a, b: list_reduce(list_prepend(xor(a, b), [CAST(0 AS BIGINT) FOR z IN range(8)]), lambda c, d: {step})), CAST(4294967295 AS BIGINT))"


@registry.query("x26_seed", f"WITH d AS (SELECT DISTINCT record_id, example_id FROM dialogues) SELECT record_id, CASE WHEN example_id IS NOT NULL THEN {_sql_crc('example_id')} END AS seed FROM d WHERE NOT regexp_matches(coalesce(example_id, ''), '[^\\x00-\\x7F]')")
def x26_seed(spark, sf_dir):
    """A dialogue's seed: crc32 of its id."""
    return C.dialogues(spark, sf_dir).select("record_id", F.crc32(F.encode("example_id", "utf-8")).alias("seed"))


@registry.query("x29_split_of_name", "WITH d AS (SELECT DISTINCT record_id, source_file, split FROM dialogues) SELECT record_id, CASE WHEN lower(split) LIKE '%train%' THEN 'train' WHEN lower(split) LIKE '%test%' THEN 'test' WHEN regexp_matches(lower(split), 'val|dev') THEN 'validation' ELSE 'unknown' END AS split, regexp_extract(source_file, '^([^/]+)/', 1) AS dataset FROM d")
def x29_split_of_name(spark, sf_dir):
    """The split and dataset that names tell."""
    low = F.lower("split")
    split = F.when(low.like("%train%"), "train").when(low.like("%test%"), "test").when(low.rlike("val|dev"), "validation").otherwise("unknown")
    return table(spark, sf_dir, "dialogues").select("record_id", split.alias("split"), F.regexp_extract("source_file", "^([^/]+)/", 1).alias("dataset")).distinct()


@registry.query("x30_retry_delay", f"{S} SELECT record_id, turn, coalesce(try_cast(nullif(regexp_extract('429 retry in ' || content, 'retry in (?:[^0-9]*?)([0-9]+(?:\\.[0-9]+)?)', 1), '') AS DOUBLE), 30.0) AS delay_sec FROM said")
def x30_retry_delay(spark, sf_dir):
    """The delay that an error names, 30 seconds if none."""
    found = F.regexp_extract(F.concat(F.lit("429 retry in "), F.col("content")), r"retry in (?:[^0-9]*?)([0-9]+(?:\.[0-9]+)?)", 1)
    return C.said(spark, sf_dir).select(*KEY, F.coalesce(F.nullif(found, F.lit("")).try_cast("double"), F.lit(30.0)).alias("delay_sec"))


over_turns("f4_prefix", lambda x: X.has_prefix(x), f"regexp_matches({sql_strip('content')}, {q('(?i)' + X.BAD_START)})", "contaminated")


@registry.query("proj9_prefix", f"{S}, w AS (SELECT record_id, turn, {sql_words('content')} AS ws FROM said), k AS (SELECT *, unnest(generate_series(1, len(ws))) AS n FROM w) SELECT record_id, turn, CAST(n AS INTEGER) AS n, array_to_string(ws[1:n], ' ') AS prefix FROM k")
def proj9_prefix(spark, sf_dir):
    """Every prefix of every turn, by words."""
    w = C.said(spark, sf_dir).select(*KEY, X.words(F.col("content")).alias("ws")).select(*KEY, "ws", F.explode(F.sequence(F.lit(1), F.size("ws"))).alias("n"))
    return w.select(*KEY, "n", F.array_join(F.slice("ws", F.lit(1), F.col("n")), " ").alias("prefix"))


over_turns("proj10_process_history", lambda x: X.process_history(F.concat(F.lit("[BACKCHANNEL] "), x, F.lit(" [TAKE_FLOOR] over"))), f"{sql_ws(chr(39) + ' ' + chr(39) + ' || content')} || ' [TAKE_FLOOR]'", "text")


@registry.query("f5_valid_backchannel", f"""WITH {C.SQL_MANIFEST}, t AS (SELECT backchannel_id, text, len({sql_words('text')}) AS n FROM b WHERE text IS NOT NULL)
SELECT backchannel_id, n BETWEEN 1 AND 3 AND NOT regexp_matches(lower(text), '^(?:backchannel|listener|speaker|the |this )') AND NOT regexp_matches(text, '\\.\\.\\.|!|—') AS valid FROM t""")
def f5_valid_backchannel(spark, sf_dir):
    """Backchannels of one to three words without labels or exclamations."""
    t = F.col("text")
    ok = F.size(X.words(t)).between(1, 3) & ~F.lower(t).rlike("^(?:backchannel|listener|speaker|the |this )") & ~t.rlike(r"\.\.\.|!|—")
    return C.backchannels(spark, sf_dir).where("text IS NOT NULL").select("backchannel_id", ok.alias("valid"))
