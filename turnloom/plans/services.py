"""Queries over injected models and over event sessions (T3, T7-T9, M4, M6, streaming)."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from turnloom.operators import models as M
from turnloom.plans import common as C
from turnloom.plans import slots as P
from turnloom.registry import Registry
from turnloom.session import table
from turnloom.streaming import sessions

registry = Registry()
_ROLE = re.compile(r"^\s*(?:user|assistant|system)\s*:\s*", re.I)


def _sql_unit(*parts: str) -> str:
    key = " || '|' || ".join(parts)
    return f"(CAST(('0x' || substr(md5({key}), 1, 8)) AS UBIGINT) / 4294967296.0)"


@registry.query("t3_scored_slots", f"""WITH s AS ({P.SQL_PROMPTS}), u AS (SELECT record_id, turn, word_index, {_sql_unit("'42'", "'b'", 'prompt')} + 0.01 AS b, {_sql_unit("'42'", "'f'", 'prompt')} + 0.01 AS f, {_sql_unit("'42'", "'s'", 'prompt')} + 0.01 AS s FROM s)
SELECT record_id, turn, word_index, round(b / (b + f + s), 9) AS p_backchannel, round(f / (b + f + s), 9) AS p_floor_taking, 'ok' AS status FROM u""")
def t3_scored_slots(spark, sf_dir):
    """Slots with the distribution of the stand-in scorer (M2, T4)."""
    rows = P.proj13_prompts(spark, sf_dir)
    return M.scored(rows, "prompt", M.HashScorer()).select("record_id", "turn", "word_index", F.round(F.col("probs")[0], 9).alias("p_backchannel"), F.round(F.col("probs")[1], 9).alias("p_floor_taking"), "status")


_PREFIX = "^\\s*(?:user|assistant|system)\\s*:\\s*"
#: wrt: each turn's last line without a role, and what it was written from.
SQL_WRT = f"""WITH {C.SQL_TURNS}, raw AS (SELECT record_id, turn, (SELECT h.role FROM (SELECT d.history[turn + 1] AS h FROM d WHERE d.record_id = t.record_id)) AS role, coalesce(content, '') AS text FROM turns t),
lst AS (SELECT *, string_split(text, chr(10))[-1] AS line FROM raw),
cln AS (SELECT *, regexp_replace(regexp_replace(line, '{_PREFIX}', '', 'i'), '^\\s+|\\s+$', '', 'g') AS new FROM lst),
prm AS (SELECT *, array_to_string(list_append(coalesce(list(new) OVER (PARTITION BY record_id ORDER BY turn ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), []), text), chr(10)) AS prompt FROM cln),
wrt AS (SELECT record_id, turn, role, new AS content, CASE WHEN line = '' OR regexp_matches(line, '(?i){_PREFIX}') THEN 4 WHEN {_sql_unit('prompt')} < 0.3 THEN 2 ELSE 1 END AS tries FROM prm)"""


@registry.query("t9_rewritten", f"{SQL_WRT} SELECT record_id, turn, role, content, tries FROM wrt")
def t9_rewritten(spark, sf_dir):
    """Dialogues rewritten turn by turn by the stand-in generator."""
    rows = C.dialogues(spark, sf_dir).select("record_id", "history")
    return M.rewritten(rows, "record_id", "history", M.EchoGenerator(), lambda s: not _ROLE.match(s), lambda s: _ROLE.sub("", s).strip())


@registry.query("t8_stopped", f"""{SQL_WRT}, n AS (SELECT record_id, count(*) AS n FROM wrt GROUP BY record_id), s AS (SELECT record_id, n, coalesce(min(k), n) AS most FROM n LEFT JOIN (SELECT unnest(range(4, 400, 2)) AS k) ON 2 * k >= n AND k < n GROUP BY record_id, n)
SELECT record_id, CAST(n AS BIGINT) AS source_turns, CAST(most AS BIGINT) AS turns FROM s""")
def t8_stopped(spark, sf_dir):
    """How far dialogues are rewritten when a judge is asked after every second turn from the fourth on."""
    rows = C.dialogues(spark, sf_dir).select("record_id", "history")
    told = M.rewritten(rows, "record_id", "history", M.EchoGenerator(), lambda s: not _ROLE.match(s), lambda s: _ROLE.sub("", s).strip(), judge=M.HalfJudge(), stop_every=2, stop_from=4)
    turns = told.groupBy("record_id").agg(F.count("*").alias("turns"))
    return rows.select("record_id", F.size("history").cast("bigint").alias("source_turns")).join(turns, "record_id")


@registry.query("f6_gated", f"{P.SQL_SAID_WORDS} SELECT record_id, turn FROM w WHERE {_sql_unit('content')} < 0.5")
def f6_gated(spark, sf_dir):
    """Turns that a judge lets through."""
    return M.gated(C.said(spark, sf_dir).select("record_id", "turn", "content"), "content", HashGate()).select("record_id", "turn")


class HashGate:
    """A stand-in judge that says yes to about half of its prompts."""

    def generate(self, chats, temperature):
        return ["yes." if M._unit(chat[0][1]) < 0.5 else "NO" for chat in chats]


@registry.query("m6_rendered", f"WITH {C.SQL_MANIFEST}, x AS (SELECT utterance_id, voice_id, unnest(units) AS x FROM u) SELECT utterance_id, x.unit_id AS unit_id, CAST(length(coalesce(x.text, '')) * 1440 AS BIGINT) AS samples FROM x WHERE x.kind = 'text'")
def m6_rendered(spark, sf_dir):
    """Text units rendered by the stand-in synthesizer."""
    x = C.utterances(spark, sf_dir).select("utterance_id", "voice_id", F.explode("units").alias("x")).where("x.kind = 'text'")
    x = x.select("utterance_id", F.coalesce("voice_id", F.lit("")).alias("voice_id"), F.col("x.unit_id").alias("unit_id"), F.col("x.text").alias("text"))
    return M.rendered(x, "text", "voice_id", M.SilentSynthesizer()).select("utterance_id", "unit_id", "samples")


@registry.query("st_sessions", """WITH o AS (SELECT user_id, ts, value, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS opens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
g AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM o)
SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts) + INTERVAL 30 MINUTE) AS end_us, count(*) AS n, round(sum(value), 4) AS value FROM g GROUP BY user_id, s""")
def st_sessions(spark, sf_dir):
    """Event sessions of each user."""
    s = sessions(table(spark, sf_dir, "events"))
    return s.select("user_id", F.unix_micros(F.col("start_ts").cast("timestamp")).alias("start_us"), F.unix_micros(F.col("end_ts").cast("timestamp")).alias("end_us"), "n", F.round("value", 4).alias("value"))
