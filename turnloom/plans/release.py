"""Dialogues and annotations packed for release and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from turnloom.functions import text as X
from turnloom.operators import release as R
from turnloom.plans import common as C
from turnloom.plans import slots as P
from turnloom.plans.corpus import SQL_DIM, dim
from turnloom.plans.rendering import _picked, _sql_picked
from turnloom.registry import Registry
from turnloom.session import table

registry = Registry()


def records(spark, sf_dir):
    """Dialogues whose turns hold their decisions: first the full content, then a segment for each slot."""
    rows = P.decided_turns(spark, sf_dir)
    none = F.lit(None)
    probs = F.struct(F.lit(P.P_FLOOR).alias("floor_taking"), F.lit(P.P_BACK).alias("backchannel"), F.lit(0.5).alias("silence"))
    whole = F.struct(F.array_join("words", " ").alias("full_content"), none.cast("int").alias("word_index"), F.when(F.lit(False), probs).alias("probs"), none.cast("string").alias("decision"), none.cast("string").alias("inserted_token"), none.cast("string").alias("content"))

    def decision(d):
        token = F.when(d["decision"] == "floor_taking", X.TAKE_FLOOR).when(d["decision"] == "backchannel", X.BACKCHANNEL)
        said = F.when(d["decision"] == "backchannel", _picked(F.col("record_id"), F.col("turn"), d["word_index"]))
        return F.struct(none.cast("string").alias("full_content"), d["word_index"].alias("word_index"), F.when(F.lit(True), probs).alias("probs"), d["decision"].alias("decision"), token.alias("inserted_token"), said.alias("content"))

    segments = F.concat(F.array(whole), F.transform("decisions", decision)).cast(f"array<{R.SEGMENT}>")
    turns = rows.groupBy("record_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("content"), segments.alias("history")))).alias("history"))
    turns = turns.withColumn("history", F.transform("history", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"), t["history"].alias("history"))))
    more = table(spark, sf_dir, "dialogues").select("record_id", "example_id", "dataset", "split", "context", "style", "speakers").dropDuplicates(["record_id"])
    return more.join(turns, "record_id").withColumn("disfluency_target", F.col("record_id") % 5 / 10)


def packed(spark, sf_dir):
    """The records in release form, with their id, dataset and split beside it."""
    rows = records(spark, sf_dir).join(dim(spark), "dataset", "left")
    form = R.pack_dialogues(rows.withColumn("example_id", F.concat_ws("|", F.col("record_id").cast("string"), "dataset", F.coalesce("split", F.lit("")), "example_id")), F.coalesce("code", F.lit("OTH")), F.col("license"))
    return form


_M = "more AS (SELECT DISTINCT record_id, dataset, split, context, style FROM dialogues)"


@registry.query("proj5_packed", f"""{P.SQL_FOLD}, {SQL_DIM}, {_M}, full_ AS (SELECT record_id, turn, role, 0 AS seg, array_to_string(ws, ' ') AS full_content, CAST(NULL AS INTEGER) AS word_index, CAST(NULL AS VARCHAR) AS decision, CAST(NULL AS VARCHAR) AS token, CAST(NULL AS VARCHAR) AS said FROM w),
dec AS (SELECT f.record_id, f.turn, w.role, row_number() OVER (PARTITION BY f.record_id, f.turn ORDER BY f.word_index) AS seg, CAST(NULL AS VARCHAR) AS full_content, f.word_index, f.decision, CASE f.decision WHEN 'floor_taking' THEN '[TAKE_FLOOR]' WHEN 'backchannel' THEN '[BACKCHANNEL]' END AS token, CASE WHEN f.decision = 'backchannel' THEN {_sql_picked('f.record_id', 'f.turn', 'f.word_index')} END AS said FROM fold f JOIN w ON w.record_id = f.record_id AND w.turn = f.turn),
u AS (SELECT * FROM full_ UNION ALL SELECT * FROM dec), n AS (SELECT *, dense_rank() OVER (PARTITION BY record_id ORDER BY turn) - 1 AS pos FROM u)
SELECT n.record_id, coalesce(code, 'OTH') AS scenario, license, style, CAST(pos AS INTEGER) AS pos, role, CAST(seg AS INTEGER) AS seg, full_content, word_index, decision, token, said, CASE WHEN seg > 0 THEN 0.5 END AS p_silence FROM n JOIN more USING (record_id) LEFT JOIN dim USING (dataset)""")
def proj5_packed(spark, sf_dir):
    """Dialogues in release form: the segments of every turn, code and licence stamped, style lifted."""
    rows = packed(spark, sf_dir).withColumn("record_id", F.substring_index("example_id", "|", 1).cast("bigint"))
    rows = rows.select("record_id", "scenario", "license", "style", F.posexplode("history").alias("pos", "t"))
    rows = rows.select("record_id", "scenario", "license", "style", "pos", F.col("t.role").alias("role"), F.posexplode("t.segments").alias("seg", "s"))
    return rows.select("record_id", "scenario", "license", "style", "pos", "role", "seg", "s.full_content", "s.word_index", "s.decision", F.col("s.inserted_token").alias("token"), F.col("s.content").alias("said"), F.col("s.probs.silence").alias("p_silence"))


@registry.query("proj6_unpacked", f"{P.SQL_FOLD}, {SQL_DIM}, {_M}, c AS (SELECT record_id, count(*) AS n_decisions, max(word_index) AS last FROM fold GROUP BY record_id), t AS (SELECT record_id, count(*) AS turns, string_agg(coalesce(role, '?') || ': ' || content, chr(10) ORDER BY turn) AS text FROM w GROUP BY record_id) SELECT record_id, dataset, coalesce(split, '') AS split, license, style, CAST(record_id % 5 / 10.0 AS DOUBLE) AS target, context, CAST(turns AS INTEGER) AS turns, text, coalesce(n_decisions, 0) AS n_decisions, last FROM t JOIN more USING (record_id) LEFT JOIN dim USING (dataset) LEFT JOIN c USING (record_id)")
def proj6_unpacked(spark, sf_dir):
    """The release form written as JSON, read and unpacked: the records again, with the licence in their meta."""
    lines = packed(spark, sf_dir).select(F.to_json(F.struct("*")).alias("line"))
    form = lines.select(F.from_json("line", R.DIALOGUE).alias("r")).select("r.*")
    part = lambda k: F.element_at(F.split("example_id", r"\|"), k)
    rows = R.unpack_dialogues(form, part(2), part(3)).withColumn("record_id", part(1).cast("bigint"))
    told = F.filter(F.flatten(F.transform("history", lambda t: t["history"])), lambda x: x["word_index"].isNotNull())
    text = F.array_join(F.transform("history", lambda t: F.concat(F.coalesce(t["role"], F.lit("?")), F.lit(": "), t["content"])), "\n")
    return rows.select("record_id", "meta.dataset", "meta.split", "meta.license", "meta.style", F.col("meta.disfluency_target").alias("target"), "context", F.size("history").alias("turns"), text.alias("text"), F.size(told).cast("bigint").alias("n_decisions"), F.array_max(F.transform(told, lambda x: x["word_index"])).alias("last"))


@registry.query("proj6_annotations", f"{P.SQL_W}, n AS (SELECT record_id, turn, dense_rank() OVER (PARTITION BY record_id ORDER BY turn) - 1 AS pos, (SELECT count(*) FROM sa WHERE sa.record_id = w.record_id AND sa.turn = w.turn) AS k FROM w) SELECT record_id, CAST(pos AS INTEGER) AS pos, k > 0 AS annotated, CASE WHEN k > 0 THEN CAST(k AS INTEGER) END AS boundaries FROM n".replace(P.SQL_W, "WITH " + P.SQL_W))
def proj6_annotations(spark, sf_dir):
    """Annotations packed, written as JSON, read and unpacked: boundaries stand on annotated turns only."""
    from turnloom.operators import slots as S

    rows = P.turns_with_words(spark, sf_dir)
    one = lambda i: F.struct(i.alias("word_index"), F.lit(10).alias("total_count"), F.struct(F.lit(1).alias("backchannel"), F.lit(2).alias("interruption"), F.lit(7).alias("none")).alias("counts"), F.struct(F.lit(0.1).alias("backchannel"), F.lit(0.2).alias("interruption"), F.lit(0.7).alias("none")).alias("probabilities"))
    found = F.transform(S.slots_a(F.col("words")), one)
    found = F.when((F.size(found) > 0) | (F.col("turn") % 2 == 0), found)
    turns = rows.groupBy("record_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "content", found.cast(f"array<{R.BOUNDARY}>").alias("boundaries")))).alias("history"))
    form = R.pack_annotations(turns.withColumn("example_id", F.col("record_id").cast("string")), F.lit("OTH"), F.lit("MIT"))
    read = form.select(F.from_json(F.to_json(F.struct("*")), R.ANNOTATION).alias("r")).select("r.*")
    back = R.unpack_annotations(read, F.lit("x"), F.lit("train"))
    back = back.select(F.col("example_id").cast("bigint").alias("record_id"), F.posexplode("history").alias("pos", "t"))
    return back.select("record_id", "pos", F.col("t.boundaries").isNotNull().alias("annotated"), F.when(F.col("t.boundaries").isNotNull(), F.size("t.boundaries")).alias("boundaries"))
