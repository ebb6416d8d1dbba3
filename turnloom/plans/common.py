"""Tables that several plans read, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.functions import text as X
from turnloom.session import table

# Names of the role that answers.
ASSISTANT = ("assistant", "system", "agent", "bot", "ai", "claude", "seller", "speaker_1")

B = X.BLANK


def q(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, {q(f'^{B}+|{B}+$')}, '', 'g')"


def sql_ws(x: str) -> str:
    return f"trim(regexp_replace({x}, {q(f'{B}+')}, ' ', 'g'), ' ')"


def sql_words(x: str) -> str:
    return f"list_filter(string_split({sql_ws(x)}, ' '), lambda w: w <> '')"


def sql_clean(x: str) -> str:
    return f"lower(regexp_replace({x}, '[^\\p{{L}}\\p{{M}}\\p{{N}}_\\s]', '', 'g'))"


def sql_uniform(*parts: str) -> str:
    key = " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"(CAST(('0x' || substr(md5({key}), 1, 8)) AS UBIGINT) / 4294967296.0)"


SQL_ROLE = f"CASE WHEN role IS NULL THEN NULL WHEN lower(role) IN ({', '.join(map(q, ASSISTANT))}) THEN 'assistant' ELSE 'user' END"

def sql_fold(name):
    out = "CAST(0 AS UBIGINT)"
    for k in range(4):
        out = f"(({out} * 7296 + CAST(('0x' || substr(md5({name}), {8 * k + 1}, 8)) AS UBIGINT)) % 10000)"
    return out


def sql_stage(x: str) -> str:
    marked = f"regexp_replace({x}, '\\*([^*\n]{{1,60}})\\*', chr(1) || '\\1' || chr(2), 'g')"
    return f"regexp_replace(regexp_replace({marked}, chr(1) || '[ ,]*(?:{'|'.join(X.STAGE)})[ ,]*' || chr(2), '', 'gi'), '[' || chr(1) || chr(2) || ']', '', 'g')"


def sql_sanitize_text(x: str) -> str:
    s = f"regexp_replace({x}, '\\[TAKING_FLOOR\\]', '[TAKE_FLOOR]', 'gi')"
    s = f"regexp_replace(regexp_replace({s}, '\\.\\.\\.|…', '[PAUSE]', 'g'), '\\[(?:User|Assistant) [Tt]urn\\]', '', 'g')"
    s = f"regexp_replace({s}, '^(?:\\s*(?:\\d+\\)\\s*)?{X.INLINE_ROLE}\\s*:\\s*)+', '', 'i')"
    return sql_strip(f"regexp_replace({sql_stage(s)}, '{B}{{2,}}', ' ', 'g')")


def sql_cut(x: str) -> str:
    """What stands before the floor token of column ``x`` and one or three words after it."""
    left, right = sql_strip(f"split_part({x}, '[TAKE_FLOOR]', 1)"), f"substr({x}, strpos({x}, '[TAKE_FLOOR]') + 12)"
    after = f"regexp_extract_all({right}, {q(X.WORD)})"
    keep = f"CASE WHEN len(regexp_extract_all({left}, {q(X.WORD)})) < 5 THEN 3 ELSE 1 END"
    return f"CASE WHEN NOT contains({x}, '[TAKE_FLOOR]') THEN {x} WHEN len({after}) = 0 THEN {left} ELSE trim({left} || ' ' || array_to_string({after}[1:{keep}], ' '), ' ') END"


def sql_align(x: str) -> str:
    """How many words of ``x`` count for alignment."""
    bare = f"regexp_replace(regexp_replace({x}, '\\[(?:BACKCHANNEL|TAKE_FLOOR|PAUSE|interrupted|MASK1|MASK2)\\]', '', 'g'), {q(X.TAG)}, '', 'g')"
    return f"len(regexp_extract_all({bare}, {q(X.WORD)}))"


#: WITH-clause members: d (each dialogue once), turns (each turn), said (turns with words).
SQL_TURNS = f"""
d AS (SELECT DISTINCT record_id, example_id, dataset, split, speakers, context, history FROM dialogues),
e AS (SELECT *, unnest(generate_series(1, len(history))) AS i FROM d),
turns AS (SELECT record_id, example_id, dataset, split, CAST(i - 1 AS INTEGER) AS turn, {SQL_ROLE.replace("role", "history[i].role")} AS role, history[i].content AS content FROM e),
said AS (SELECT * FROM turns WHERE {sql_strip("content")} <> '')"""


def role_of(role):
    """user, assistant or null."""
    return F.when(role.isNull(), None).when(F.lower(role).isin(*ASSISTANT), "assistant").otherwise("user")


def dialogues(spark, sf_dir: str) -> DataFrame:
    """Each dialogue once."""
    cols = ["record_id", "example_id", "dataset", "split", "speakers", "context", "history"]
    return table(spark, sf_dir, "dialogues").select(*cols).dropDuplicates(["record_id"])


def turns(spark, sf_dir: str) -> DataFrame:
    """Each turn of each dialogue."""
    rows = dialogues(spark, sf_dir).select("record_id", "example_id", "dataset", "split", F.posexplode("history").alias("turn", "h"))
    return rows.select("record_id", "example_id", "dataset", "split", "turn", role_of(F.col("h.role")).alias("role"), F.col("h.content").alias("content"))


def said(spark, sf_dir: str) -> DataFrame:
    """The turns that hold any words."""
    return turns(spark, sf_dir).where(X.strip(F.col("content")) != "")


#: u (each utterance once), b (each backchannel once).
SQL_MANIFEST = """
u AS (SELECT DISTINCT utterance_id, dialogue_id, variant_idx, turn, text_idx, speaker_idx, uttr_type, next_uttr_type, is_last_text, is_uttered, tts_text, units, language_id, voice_id FROM utterances),
b AS (SELECT DISTINCT backchannel_id, dialogue_id, variant_idx, bc_idx, speaker_idx, text, word_count, host_idx, next_uttr_type_of_host, unit_id FROM backchannels)"""


def utterances(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "utterances").drop("ingested_at", "prepared_at").dropDuplicates(["utterance_id"])


def backchannels(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "backchannels").drop("ingested_at", "prepared_at").dropDuplicates(["backchannel_id"])
