"""Corpus building: roles, filters, samples, quotas, splits, packing and reports (P1-P7, P17, F, A1-A2, A6, A8, A10-A11, O, J1-J3, U2-U4, K9, S5, S14)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from turnloom.functions import text as X
from turnloom.operators import sampling as O
from turnloom.plans import common as C
from turnloom.plans.common import q, sql_strip, sql_ws
from turnloom.registry import Registry
from turnloom.session import table

registry = Registry()
T = f"WITH {C.SQL_TURNS}"
# Dataset codes and licences.
DATASETS = [("socraticlm", "TEA", "Apache-2.0"), ("multiwoz", "PLN", "MIT"), ("interviewer", "INT", "CC-BY-4.0"), ("negotiator", "NEG", "MIT"), ("persuader", "PER", "Apache-2.0"), ("soda", "SOC", "CC-BY-4.0")]
SQL_DIM = "dim(dataset, code, license) AS (VALUES " + ", ".join(f"({q(a)}, {q(b)}, {q(c)})" for a, b, c in DATASETS) + ")"


def dim(spark):
    """The datasets, their codes and licences: six rows."""
    return F.broadcast(spark.createDataFrame(DATASETS, "dataset string, code string, license string"))


@registry.query("proj1_roles", f"{T} SELECT role, count(*) AS n, count(DISTINCT record_id) AS dialogues FROM turns GROUP BY role")
def proj1_roles(spark, sf_dir):
    """Turns by mapped role."""
    return C.turns(spark, sf_dir).groupBy("role").agg(F.count("*").alias("n"), F.count_distinct("record_id").alias("dialogues"))


@registry.query("proj2_coerced_turns", f"{T} SELECT record_id, turn, role, {sql_strip('content')} AS content FROM said WHERE role IS NOT NULL")
def proj2_coerced_turns(spark, sf_dir):
    """Turns given as pairs or objects, read alike; blank and malformed ones dropped."""
    rows = C.turns(spark, sf_dir).where("role IS NOT NULL")
    as_json = F.when(F.col("turn") % 2 == 0, F.to_json(F.struct("role", "content"))).otherwise(F.to_json(F.array("role", "content")))
    raw = rows.select("record_id", "turn", as_json.alias("j"))
    pair, obj = F.from_json("j", "array<string>"), F.from_json("j", "struct<role:string,content:string>")
    is_pair = F.col("j").startswith("[")
    rows = raw.select("record_id", "turn", F.when(is_pair, pair[0]).otherwise(obj["role"]).alias("role"), F.when(is_pair, F.get(pair, F.lit(1))).otherwise(obj["content"]).alias("content"))
    return rows.withColumn("content", X.strip(F.col("content"))).where("content != ''")


@registry.query("proj3_user_assistant", f"{T} SELECT record_id, len(list_filter(history, lambda h: lower(h.role) IN ('user', 'assistant'))) AS n FROM d WHERE history IS NOT NULL")
def proj3_user_assistant(spark, sf_dir):
    """Turns whose role is user or assistant, per dialogue."""
    kept = F.filter("history", lambda h: F.lower(h["role"]).isin("user", "assistant"))
    return C.dialogues(spark, sf_dir).where("history IS NOT NULL").select("record_id", F.size(kept).cast("bigint").alias("n"))


@registry.query("proj4_scenario", f"{T} SELECT record_id, CASE WHEN context IS NULL OR {sql_strip('context')} = '' THEN 'A generic conversation.' WHEN starts_with(context, '{{') THEN json_extract_string(context, '$.item.Title') ELSE context END AS scenario FROM d")
def proj4_scenario(spark, sf_dir):
    """A dialogue's scenario: prose, the title of an object, or the default."""
    c = F.col("context")
    s = F.when(c.isNull() | (X.strip(c) == ""), "A generic conversation.").when(c.startswith("{"), F.get_json_object(c, "$.item.Title")).otherwise(c)
    return C.dialogues(spark, sf_dir).select("record_id", s.alias("scenario"))


@registry.query("proj7_adapted", "WITH d AS (SELECT DISTINCT doc_id, source, split, text FROM documents) SELECT doc_id, coalesce(source, 'doc') || '_' || CAST(doc_id AS VARCHAR) AS example_id, coalesce(lower(split), 'unknown') AS split FROM d")
def proj7_adapted(spark, sf_dir):
    """Rows of another schema in ours: ids by coalesce, the split overwritten."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.concat_ws("_", F.coalesce("source", F.lit("doc")), F.col("doc_id").cast("string")).alias("example_id"), F.coalesce(F.lower("split"), F.lit("unknown")).alias("split"))


@registry.query("proj17_concise", f"{T} SELECT record_id, CAST(len(history) // 2 AS BIGINT) AS n_turns FROM d WHERE history IS NOT NULL")
def proj17_concise(spark, sf_dir):
    """The first half of each dialogue's turns."""
    half = F.slice("history", F.lit(1), F.floor(F.size("history") / 2).cast("int"))
    return C.dialogues(spark, sf_dir).where("history IS NOT NULL").select("record_id", F.size(half).cast("bigint").alias("n_turns"))


# What a dialogue is dropped for, in the order of the rules, with the pattern of each; brackets and roles are classified below.
_DROP = [
    ("multi-turn concat", r"(?is)\d+\)\s*(?:user|assistant|system)\s*:.*\d+\)\s*(?:user|assistant|system)\s*:"),
    ("think-block leak", r"(?i)</?think\b"),
    ("very-long", None),
    ("markdown bold leak", r"\*\*[^*\n]{1,200}\*\*"),
    ("asterisk turn marker", r"(?i)\*[^*\n]*?(?:next\s+turn|user\s*:|assistant\s*:|user\s*'?s?\s+next|assistant\s*'?s?\s+next)[^*\n]*\*"),
]
# Bracketed texts that are meant, and those that are left from a template.
_BRACKET = r"\[[^\[\]\n]{1,60}\]"
_MEANT = ("[BACKCHANNEL]", "[TAKE_FLOOR]", "[PAUSE]", "[MASK1]", "[MASK2]", "[interrupted]", "[sigh]")
_TURN_MARK = r"(?i)^\[(?:taking_floor|(?:user|assistant)(?:'s)? turn)\]$"
_LEFT = r"(?i)^\[(?:email[ -]protected\]|(?:your|some|city|state|country|old|new|insert|enter|placeholder)\b)"
_TITLE = r"^\[[A-Z][a-z]+(?:\s+[A-Z][a-z]+){0,3}\]$"
_INLINE = r"(?i)^\s*(?:\d+\)\s*)?(user|assistant|system)\s*:\s*"


def is_placeholder(token):
    """Whether a bracketed text is left from a template."""
    meant = token.isin(*_MEANT) | token.rlike(_TURN_MARK)
    return ~meant & (token.rlike(_LEFT) | token.rlike(_TITLE))


def drop_reason(role, content):
    """The first rule that a turn breaks, null if it breaks none; ``role`` is the turn's own, unmapped."""
    inline = F.lower(F.regexp_extract(content, _INLINE, 1))
    hits = [(name, content.rlike(pattern) if pattern else F.length(content) > 1500) for name, pattern in _DROP]
    hits.append(("template placeholder", F.exists(F.regexp_extract_all(content, F.lit(f"({_BRACKET})"), F.lit(1)), is_placeholder)))
    hits.append(("role mismatch", (inline != "") & (F.coalesce(role, F.lit("")) != "") & (inline != F.lower(role))))
    reason = None
    for name, hit in hits:
        reason = F.when(hit, name) if reason is None else reason.when(hit, name)
    return reason


_SQL_PLACE = f"list_filter(regexp_extract_all(content, {q(_BRACKET)}), lambda t: t NOT IN ({', '.join(map(q, _MEANT))}) AND NOT regexp_matches(t, {q(_TURN_MARK)}) AND (regexp_matches(t, {q(_LEFT)}) OR regexp_matches(t, {q(_TITLE)})))"
_SQL_INLINE = f"lower(regexp_extract(content, {q(_INLINE)}, 1))"
_SQL_REASON = f"""rsn AS (SELECT record_id, turn, CASE {' '.join(f"WHEN regexp_matches(content, {q(p)}) THEN {q(n)}" if p else f"WHEN length(content) > 1500 THEN {q(n)}" for n, p in _DROP)}
  WHEN len({_SQL_PLACE}) > 0 THEN 'template placeholder' WHEN {_SQL_INLINE} <> '' AND coalesce(role, '') <> '' AND {_SQL_INLINE} <> lower(role) THEN 'role mismatch' END AS reason
  FROM (SELECT record_id, CAST(i - 1 AS INTEGER) AS turn, history[i].role AS role, history[i].content AS content FROM e))"""


def own_turns(spark, sf_dir):
    """Each turn with its own role, as it stands."""
    return C.dialogues(spark, sf_dir).select("record_id", F.posexplode("history").alias("turn", "h")).select("record_id", "turn", F.col("h.role").alias("role"), F.col("h.content").alias("content"))


@registry.query("f2_dropped", f"{T}, {_SQL_REASON} SELECT record_id, arg_min(reason, turn) AS reason, min(turn) AS turn FROM rsn WHERE reason IS NOT NULL GROUP BY record_id")
def f2_dropped(spark, sf_dir):
    """Dialogues to drop and the first reason, in turn and rule order."""
    bad = own_turns(spark, sf_dir).select("record_id", "turn", drop_reason(F.col("role"), F.col("content")).alias("reason")).where("reason IS NOT NULL")
    return bad.groupBy("record_id").agg(F.min_by("reason", "turn").alias("reason"), F.min("turn").alias("turn"))


@registry.query("f2_kept", f"{T}, {_SQL_REASON} SELECT dataset, count(*) AS n FROM d WHERE record_id NOT IN (SELECT record_id FROM rsn WHERE reason IS NOT NULL) GROUP BY dataset")
def f2_kept(spark, sf_dir):
    """Dialogues that stay, by dataset: an anti join against those dropped."""
    bad = f2_dropped(spark, sf_dir).select("record_id")
    return C.dialogues(spark, sf_dir).join(bad, "record_id", "left_anti").groupBy("dataset").agg(F.count("*").alias("n"))


_PLANTED = "content || CASE record_id % 7 WHEN 1 THEN ' [Your Name]' WHEN 2 THEN ' [User''s turn] [sigh]' WHEN 3 THEN ' [Los Angeles]' WHEN 4 THEN ' [email protected]' ELSE '' END"


@registry.query("f3_placeholders", f"{T}, p AS (SELECT record_id, turn, {_PLANTED} AS content FROM said) SELECT record_id, turn, array_to_string({_SQL_PLACE}, '|') AS found FROM p WHERE len({_SQL_PLACE}) > 0")
def f3_placeholders(spark, sf_dir):
    """The placeholders in turns, of which some were put in."""
    extra = F.col("record_id") % 7
    planted = F.when(extra == 1, " [Your Name]").when(extra == 2, " [User's turn] [sigh]").when(extra == 3, " [Los Angeles]").when(extra == 4, " [email protected]").otherwise("")
    found = F.filter(F.regexp_extract_all(F.concat("content", planted), F.lit(f"({_BRACKET})"), F.lit(1)), is_placeholder)
    return C.said(spark, sf_dir).select("record_id", "turn", F.array_join(found, "|").alias("found")).where("found != ''")


@registry.query("f10_uttered", f"WITH {C.SQL_MANIFEST} SELECT utterance_id, coalesce({sql_strip('tts_text')} NOT IN ('', '-', '...', '.', ','), false) AS uttered FROM u")
def f10_uttered(spark, sf_dir):
    """Whether an utterance has anything to utter."""
    return C.utterances(spark, sf_dir).select("utterance_id", F.coalesce(~X.strip(F.col("tts_text")).isin("", "-", "...", ".", ","), F.lit(False)).alias("uttered"))


@registry.query("f10_audio_names", "SELECT DISTINCT wav, regexp_matches(lower(wav), '\\.(wav|mp3|flac|ogg|m4a)$') AS is_audio, coalesce(regexp_matches(lower(txt), '\\.(wav|mp3|flac|ogg|m4a)$'), false) AS txt_is_audio FROM voices")
def f10_audio_names(spark, sf_dir):
    """Whether names are those of audio files."""
    from turnloom.sources.manifests import AUDIO

    return table(spark, sf_dir, "voices").select("wav", F.col("wav").rlike(AUDIO).alias("is_audio"), F.coalesce(F.col("txt").rlike(AUDIO), F.lit(False)).alias("txt_is_audio")).distinct()


@registry.query("f12_capped_shard", f"{T}, n AS (SELECT record_id, row_number() OVER (ORDER BY example_id, record_id) - 1 AS i FROM d WHERE record_id NOT IN (SELECT record_id FROM turns WHERE content IS NULL)) SELECT record_id FROM (SELECT record_id, i FROM n WHERE i % 4 = 1 ORDER BY i LIMIT 50)")
def f12_capped_shard(spark, sf_dir):
    """The first fifty dialogues of a shard, after exclusions, in the order of their names."""
    out = C.turns(spark, sf_dir).where("content IS NULL").select("record_id").distinct()
    rows = C.dialogues(spark, sf_dir).select("record_id", "example_id").join(out, "record_id", "left_anti").withColumn("all", F.lit(0))
    return O.numbered(rows, ["all"], ["example_id", "record_id"]).where("rn % 4 = 1").orderBy("rn").limit(50).select("record_id")


@registry.query("f11_scenarios", f"{T} SELECT record_id, dataset FROM d WHERE dataset IN ('multiwoz', 'soda')")
def f11_scenarios(spark, sf_dir):
    """Chosen scenarios."""
    return C.dialogues(spark, sf_dir).select("record_id", "dataset").where(F.col("dataset").isin("multiwoz", "soda"))


@registry.query("f12_shard", f"{T}, n AS (SELECT record_id, dataset, row_number() OVER (PARTITION BY dataset ORDER BY record_id) - 1 AS i FROM d WHERE record_id NOT IN (SELECT record_id FROM turns WHERE content IS NULL)) SELECT dataset, count(*) AS n, min(record_id) AS first_id FROM n WHERE i % 4 = 1 GROUP BY dataset")
def f12_shard(spark, sf_dir):
    """One shard of four of each dataset, after exclusions."""
    out = C.turns(spark, sf_dir).where("content IS NULL").select("record_id").distinct()
    rows = O.numbered(C.dialogues(spark, sf_dir).select("record_id", "dataset").join(out, "record_id", "left_anti"), ["dataset"], ["record_id"])
    return rows.where("rn % 4 = 1").groupBy("dataset").agg(F.count("*").alias("n"), F.min("record_id").alias("first_id"))


@registry.query("a1_grouped_turns", f"{T} SELECT record_id, array_to_string(list(coalesce(content, '') ORDER BY turn), '|') AS joined, count(*) AS n FROM turns GROUP BY record_id")
def a1_grouped_turns(spark, sf_dir):
    """Turns gathered into their conversation, in order."""
    g = C.turns(spark, sf_dir).groupBy("record_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.coalesce("content", F.lit("")).alias("content")))).alias("t"), F.count("*").alias("n"))
    return g.select("record_id", F.array_join("t.content", "|").alias("joined"), "n")


_SPLIT = "CASE WHEN split IS NULL THEN 'unknown' WHEN lower(split) LIKE 'tr%' THEN 'train' WHEN lower(split) LIKE 'te%' THEN 'test' ELSE 'validation' END"


def split_of(c):
    low = F.lower(c)
    return F.when(c.isNull(), "unknown").when(low.like("tr%"), "train").when(low.like("te%"), "test").otherwise("validation")


@registry.query("a2_summary", f"{T} SELECT coalesce(dataset, '(none)') AS dataset, {', '.join(f'sum(CASE WHEN {_SPLIT} = {q(s)} THEN 1 ELSE 0 END) AS {s}' for s in ('train', 'validation', 'test', 'unknown'))}, count(*) AS total FROM d GROUP BY dataset UNION ALL SELECT '(all)', {', '.join(f'sum(CASE WHEN {_SPLIT} = {q(s)} THEN 1 ELSE 0 END)' for s in ('train', 'validation', 'test', 'unknown'))}, count(*) FROM d")
def a2_summary(spark, sf_dir):
    """Dialogues per dataset and split, with totals."""
    rows = C.dialogues(spark, sf_dir).select(F.coalesce("dataset", F.lit("(none)")).alias("dataset"), split_of(F.col("split")).alias("s"))
    counts = [F.count_if(F.col("s") == s).alias(s) for s in ("train", "validation", "test", "unknown")]
    return rows.rollup("dataset").agg(*counts, F.count("*").alias("total")).withColumn("dataset", F.coalesce("dataset", F.lit("(all)")))


_REFS = f"refs AS (SELECT DISTINCT lower(example_id) AS ref FROM d WHERE {_SPLIT} = 'test')"


@registry.query("a6_quota", f"{T}, {_REFS}, o AS (SELECT record_id, dataset, CASE WHEN ref IS NOT NULL THEN 'test' ELSE {_SPLIT} END AS s FROM d LEFT JOIN refs ON lower(example_id) = ref), r AS (SELECT *, row_number() OVER (PARTITION BY dataset, s ORDER BY record_id) AS rn FROM o) SELECT record_id, dataset, CASE WHEN s = 'test' AND rn <= 5 THEN 'test' WHEN s = 'test' THEN 'train' ELSE s END AS split FROM r WHERE s IN ('train', 'test') AND (s = 'test' OR rn <= 40)")
def a6_quota(spark, sf_dir):
    """Caps per dataset: dialogues that a reference list names are tests, five of them; the rest overflow into train, with forty others."""
    d = C.dialogues(spark, sf_dir).select("record_id", "example_id", "dataset", split_of(F.col("split")).alias("s"))
    refs = d.where("s = 'test'").select(F.lower("example_id").alias("ref")).distinct()
    rows = d.join(refs, F.lower("example_id") == F.col("ref"), "left").select("record_id", "dataset", F.when(F.col("ref").isNotNull(), "test").otherwise(F.col("s")).alias("s"))
    capped = O.first(rows.where("s IN ('train', 'test')"), ["dataset", "s"], ["record_id"], 40).where("s = 'train' OR rn < 5")
    kept = capped.select("record_id", "dataset", F.col("s").alias("split"))
    rest = rows.where("s = 'test'").join(capped.select("record_id"), "record_id", "left_anti").select("record_id", "dataset", F.lit("train").alias("split"))
    return kept.unionByName(rest)


@registry.query("a8_distinct_files", "WITH r AS (SELECT DISTINCT record_id, source_file FROM dialogues WHERE source_file IS NOT NULL), k AS (SELECT *, row_number() OVER (PARTITION BY lower(source_file) ORDER BY record_id) AS rn FROM r) SELECT record_id, source_file FROM k WHERE rn = 1")
def a8_distinct_files(spark, sf_dir):
    """The first record of each source file, whatever its case."""
    rows = table(spark, sf_dir, "dialogues").where("source_file IS NOT NULL").select("record_id", "source_file").distinct()
    best = rows.groupBy(F.lower("source_file").alias("k")).agg(F.min(F.struct("record_id", "source_file")).alias("m"))
    return best.select("m.record_id", "m.source_file")


@registry.query("a10_statistics", f"{T} SELECT dataset, count(*) AS dialogues, sum(coalesce(len(history), 0)) AS turns, sum(coalesce(len(history), 0)) / count(*) AS turns_per_dialogue FROM d GROUP BY dataset")
def a10_statistics(spark, sf_dir):
    """Dialogues, turns and turns per dialogue of each dataset."""
    n = F.coalesce(F.size("history"), F.lit(0))
    n = F.when(F.col("history").isNull(), 0).otherwise(n)
    return C.dialogues(spark, sf_dir).groupBy("dataset").agg(F.count("*").alias("dialogues"), F.sum(n).alias("turns"), (F.sum(n) / F.count("*")).alias("turns_per_dialogue"))


@registry.query("a11_status", f"{T} SELECT CASE WHEN history IS NULL THEN 'fail' WHEN len(history) = 0 THEN 'skip' ELSE 'ok' END AS status, count(*) AS n FROM d GROUP BY 1")
def a11_status(spark, sf_dir):
    """How dialogues fare: ok, skip or fail, never an exception."""
    s = F.when(F.col("history").isNull(), "fail").when(F.size("history") == 0, "skip").otherwise("ok")
    return C.dialogues(spark, sf_dir).groupBy(s.alias("status")).agg(F.count("*").alias("n"))


_DOCS = "n AS (SELECT doc_id, source, lang, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS rn, count(*) OVER (PARTITION BY source) AS n FROM documents)"


@registry.query("o1_even_sample", f"WITH {_DOCS}, i AS (SELECT unnest(range(7)) AS i) SELECT DISTINCT doc_id, source FROM n, i WHERE n <= 7 OR rn = CAST(floor(i * (n / 7.0)) AS BIGINT)")
def o1_even_sample(spark, sf_dir):
    """Seven documents of each source at even distances."""
    return O.evenly_spaced(table(spark, sf_dir, "documents").select("doc_id", "source"), ["source"], ["doc_id"], 7)


_OF_PATH = "CASE WHEN regexp_matches(lower(source_file), '(^|[/_.-])train([/_.-]|$)') THEN 'train' WHEN regexp_matches(lower(source_file), '(^|[/_.-])test([/_.-]|$)') THEN 'test' WHEN regexp_matches(lower(source_file), '(^|[/_.-])(valid(ation)?|dev)([/_.-]|$)') THEN 'validation' ELSE 'unknown' END"


@registry.query("o2_split_by_file", f"WITH f AS (SELECT DISTINCT record_id, source_file FROM dialogues), s AS (SELECT record_id, {_OF_PATH} AS part FROM f), n AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY record_id) - 1 AS rn, count(*) OVER (PARTITION BY part) AS n FROM s), i AS (SELECT unnest(range(9)) AS i) SELECT DISTINCT record_id, part FROM n, i WHERE n <= 9 OR rn = CAST(floor(i * (n / 9.0)) AS BIGINT)")
def o2_split_by_file(spark, sf_dir):
    """An even sample for each split that the path of a dialogue's file tells."""
    low = F.lower("source_file")
    ends = r"(^|[/_.-])(?:%s)([/_.-]|$)"
    part = F.when(low.rlike(ends % "train"), "train").when(low.rlike(ends % "test"), "test").when(low.rlike(ends % "valid(?:ation)?|dev"), "validation").otherwise("unknown")
    rows = table(spark, sf_dir, "dialogues").select("record_id", part.alias("part")).dropDuplicates(["record_id"])
    return O.evenly_spaced(rows, ["part"], ["record_id"], 9)


@registry.query("o3_by_label", f"{T}, n AS (SELECT record_id, {_SPLIT} AS label, row_number() OVER (PARTITION BY {_SPLIT} ORDER BY record_id) - 1 AS rn, count(*) OVER (PARTITION BY {_SPLIT}) AS n FROM d), i AS (SELECT unnest(range(11)) AS i) SELECT DISTINCT record_id, label FROM n, i WHERE label <> 'unknown' AND (n <= 11 OR rn = CAST(floor(i * (n / 11.0)) AS BIGINT))")
def o3_by_label(spark, sf_dir):
    """An even sample for each split's label; dialogues without one are in no part."""
    rows = C.dialogues(spark, sf_dir).select("record_id", split_of(F.col("split")).alias("label")).where("label != 'unknown'")
    return O.evenly_spaced(rows, ["label"], ["record_id"], 11)


@registry.query("o4_halves", f"WITH {_DOCS}, i AS (SELECT unnest(range(12)) AS i), k AS (SELECT DISTINCT doc_id, source, rn FROM n, i WHERE n <= 12 OR rn = CAST(floor(i * (n / 12.0)) AS BIGINT)), m AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM k) SELECT doc_id, source, CASE WHEN r <= 8 THEN 'train' ELSE 'test' END AS split FROM m")
def o4_halves(spark, sf_dir):
    """Twelve evenly spaced documents of each source, of which the first eight train."""
    return O.halves(table(spark, sf_dir, "documents").select("doc_id", "source"), ["source"], ["doc_id"], 8, 4)


@registry.query("o4_halves_all", f"WITH {_DOCS} SELECT doc_id, source, CASE WHEN rn < n // 2 THEN 'train' ELSE 'test' END AS split FROM n")
def o4_halves_all(spark, sf_dir):
    """All documents of each source, of which the first half trains, as there is no limit."""
    return O.halves(table(spark, sf_dir, "documents").select("doc_id", "source"), ["source"], ["doc_id"], None, 4)


@registry.query("o6_ratio_resplit", f"{T}, r AS (SELECT record_id, dataset, row_number() OVER (PARTITION BY dataset ORDER BY CASE {_SPLIT} WHEN 'train' THEN 0 WHEN 'validation' THEN 1 WHEN 'test' THEN 2 ELSE 3 END, record_id) AS rn, count(*) OVER (PARTITION BY dataset) AS n FROM d) SELECT record_id, dataset, CASE WHEN rn <= CAST(floor(n * 0.9) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM r")
def o6_ratio_resplit(spark, sf_dir):
    """Splits joined in a fixed order and cut anew at nine tenths."""
    rows = C.dialogues(spark, sf_dir).select("record_id", "dataset", split_of(F.col("split")).alias("s"))
    order = F.when(F.col("s") == "train", 0).when(F.col("s") == "validation", 1).when(F.col("s") == "test", 2).otherwise(3)
    rows = O.numbered(rows.withColumn("o", order), ["dataset"], ["o", "record_id"])
    return rows.select("record_id", "dataset", F.when(F.col("rn") < F.floor(F.col("n") * 0.9), "train").otherwise("test").alias("split"))


@registry.query("o7_hash_split", f"{T} SELECT record_id, CASE WHEN {C.sql_fold('example_id')} / 10000 < 0.8 THEN 'train' ELSE 'test' END AS split FROM d")
def o7_hash_split(spark, sf_dir):
    """Train or test by the md5 of the name."""
    return C.dialogues(spark, sf_dir).select("record_id", O.hash_split(F.col("example_id"), 0.8).alias("split"))


@registry.query("o8_hash_sample", "WITH d AS (SELECT DISTINCT record_id, dataset FROM dialogues), r AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY md5('42|' || CAST(record_id AS VARCHAR))) AS rn, count(*) OVER (PARTITION BY dataset) AS n FROM d) SELECT record_id, dataset FROM r WHERE rn <= greatest(1, round_even(n * 0.1, 0))")
def o8_hash_sample(spark, sf_dir):
    """A tenth of each dataset, chosen by hash."""
    rows = table(spark, sf_dir, "dialogues").select("record_id", "dataset").distinct()
    return O.hash_sample(rows, ["dataset"], F.concat(F.lit("42|"), F.col("record_id").cast("string")), 0.1)


@registry.query("o9_variants", "WITH u AS (SELECT DISTINCT dialogue_id, variant_idx FROM utterances), r AS (SELECT *, row_number() OVER (PARTITION BY dialogue_id ORDER BY variant_idx) AS rn FROM u) SELECT dialogue_id, variant_idx FROM r WHERE rn <= 1")
def o9_variants(spark, sf_dir):
    """The first variant of each dialogue."""
    return table(spark, sf_dir, "utterances").groupBy("dialogue_id").agg(F.min("variant_idx").alias("variant_idx"))


@registry.query("o10_capped", f"{T}, p AS (SELECT record_id, dataset FROM d WHERE history IS NOT NULL AND len(history) > 0), r AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY record_id) AS rn FROM p) SELECT record_id, dataset FROM r WHERE rn <= 25")
def o10_capped(spark, sf_dir):
    """The first 25 pending dialogues of each dataset; pending is decided before the cap (K9)."""
    rows = C.dialogues(spark, sf_dir).where("size(history) > 0").select("record_id", "dataset")
    return O.first(rows, ["dataset"], ["record_id"], 25).select("record_id", "dataset")


@registry.query("o12_batches", f"WITH {C.SQL_MANIFEST}, x AS (SELECT utterance_id, length(tts_text) > 200 AS oversize, u.voice_id FROM u WHERE tts_text IS NOT NULL AND voice_id IS NOT NULL), r AS (SELECT *, row_number() OVER (PARTITION BY voice_id, oversize ORDER BY utterance_id) - 1 AS rn FROM x) SELECT utterance_id, voice_id, oversize, CAST(CASE WHEN oversize THEN rn ELSE rn // 8 END AS BIGINT) AS batch FROM r")
def o12_batches(spark, sf_dir):
    """Texts of a voice in batches of eight; oversized ones alone."""
    rows = C.utterances(spark, sf_dir).where("tts_text IS NOT NULL AND voice_id IS NOT NULL").select("utterance_id", "voice_id", F.length("tts_text").alias("length"))
    return O.batches(rows, ["voice_id"], ["utterance_id"], F.col("length"), 8, 200).select("utterance_id", "voice_id", "oversize", "batch")


@registry.query("j3_resume", f"{T} SELECT record_id FROM d WHERE record_id NOT IN (SELECT record_id FROM dialogues WHERE style = 'spoken')")
def j3_resume(spark, sf_dir):
    """Dialogues not done yet: an anti join with those whose style is spoken (K9)."""
    done = table(spark, sf_dir, "dialogues").where("style = 'spoken'").select("record_id").distinct()
    return C.dialogues(spark, sf_dir).select("record_id").join(done, "record_id", "left_anti")


@registry.query("u4_set_checks", "SELECT (SELECT count(*) FROM (SELECT DISTINCT dialogue_id FROM utterances INTERSECT SELECT DISTINCT example_id FROM dialogues)) AS shared, (SELECT count(*) FROM (SELECT dialogue_id FROM utterances EXCEPT SELECT example_id FROM dialogues)) AS only_manifest, (SELECT count(*) FROM (SELECT example_id FROM dialogues EXCEPT SELECT dialogue_id FROM utterances)) AS only_corpus")
def u4_set_checks(spark, sf_dir):
    """Dialogue ids shared between the corpus and its manifests, and on one side only."""
    u = table(spark, sf_dir, "utterances").select(F.col("dialogue_id").alias("id"), F.lit(1).alias("m"), F.lit(0).alias("c"))
    d = table(spark, sf_dir, "dialogues").select(F.col("example_id").alias("id"), F.lit(0).alias("m"), F.lit(1).alias("c"))
    ids = u.unionByName(d).groupBy("id").agg(F.max("m").alias("m"), F.max("c").alias("c"))
    return ids.agg(F.count_if((F.col("m") == 1) & (F.col("c") == 1)).alias("shared"), F.count_if((F.col("m") == 1) & (F.col("c") == 0)).alias("only_manifest"), F.count_if((F.col("m") == 0) & (F.col("c") == 1)).alias("only_corpus"))


@registry.query("s14_manifest_lines", f"""WITH l AS (SELECT DISTINCT voice_id, wav, txt FROM voices), m AS (SELECT voice_id, 0 AS k, wav AS line FROM l UNION ALL SELECT voice_id, 1, txt FROM l WHERE txt IS NOT NULL),
o AS (SELECT *, sum(CASE WHEN regexp_matches(lower(line), '\\.(wav|mp3|flac|ogg|m4a)$') THEN 1 ELSE 0 END) OVER (ORDER BY voice_id, k) AS g FROM m),
p AS (SELECT g, max(CASE WHEN k = 0 THEN line END) AS wav, {sql_ws("string_agg(CASE WHEN k = 1 THEN line END, ' ' ORDER BY k)")} AS transcript FROM o GROUP BY g) SELECT wav, transcript FROM p WHERE transcript IS NOT NULL AND transcript <> ''""")
def s14_manifest_lines(spark, sf_dir):
    """A manifest whose file lines open an entry and whose other lines are its transcript."""
    from turnloom.sources.manifests import entries

    v = table(spark, sf_dir, "voices").dropDuplicates(["voice_id"])
    lines = v.select(F.lit("voices").alias("manifest"), "voice_id", F.posexplode(F.array("wav", "txt")).alias("k", "line")).where("line IS NOT NULL")
    return entries(lines, "manifest", ["voice_id", "k"], "line").select(F.col("file").alias("wav"), "transcript")
