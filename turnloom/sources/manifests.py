"""Filename/transcript manifests and Switchboard-style transcripts as lines of text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnloom.functions import text as X

# Audio endings, and the forms of a transcript's lines.
AUDIO = r"(?i)\.(wav|mp3|flac|ogg|m4a)$"
UTTERANCE = r"^\s*(\S+)\s+(@?@?[AB])\.(\d+)\s+utt(\d+):\s*(.*)$"
HEADER = r"^\s*([A-Z0-9_#]+):\s*(.*)$"


def _opened(lines: DataFrame, manifest: str, order: list[str], line: str) -> DataFrame:
    rows = lines.withColumn("_l", X.strip(F.col(line))).where("_l != ''").withColumn("_file", F.col("_l").rlike(AUDIO))
    w = Window.partitionBy(manifest).orderBy(*order)
    return rows.withColumn("_g", F.sum(F.col("_file").cast("int")).over(w)).withColumn("_n", F.row_number().over(w))


def _entries(opened: DataFrame, manifest: str) -> DataFrame:
    rows = opened.where("_g > 0")
    parts = F.array_sort(F.collect_list(F.when(~F.col("_file"), F.struct("_n", "_l"))))
    found = rows.groupBy(manifest, "_g").agg(F.max(F.when(F.col("_file"), F.col("_l"))).alias("file"), parts.alias("_p"))
    found = found.withColumn("transcript", X.normalize_ws(F.array_join("_p._l", " ")))
    first = F.row_number().over(Window.partitionBy(manifest, F.lower("file"), F.col("transcript") != "").orderBy("_g"))
    return found.withColumn("_r", first)


def entries(lines: DataFrame, manifest: str, order: list[str], line: str) -> DataFrame:
    """(manifest, file, transcript): a line that names an audio file opens an entry, the lines after it are its transcript.

    Blank lines don't count; lines before the first file, and entries without a
    transcript, are left out; of entries with the same name, whatever its case,
    the first stays.  A manifest is a small file, numbered in one task.
    """
    return _entries(_opened(lines, manifest, order, line), manifest).where("transcript != '' AND _r = 1").select(manifest, "file", "transcript")


def warnings(lines: DataFrame, manifest: str, order: list[str], line: str) -> DataFrame:
    """(manifest, kind, text) of what ``entries`` leaves out: orphan lines before the first file, files without a transcript, repeated files."""
    opened = _opened(lines, manifest, order, line)
    orphans = opened.where("_g = 0").select(manifest, F.lit("orphan").alias("kind"), F.col("_l").alias("text"))
    told = _entries(opened, manifest)
    empty = told.where("transcript = ''").select(manifest, F.lit("empty").alias("kind"), F.col("file").alias("text"))
    again = told.where("transcript != '' AND _r > 1").select(manifest, F.lit("repeated").alias("kind"), F.col("file").alias("text"))
    return orphans.unionByName(empty).unionByName(again)


def resolved(names: DataFrame, name: str, files: DataFrame, path: str) -> DataFrame:
    """``names`` with ``path``: the file of just that path, else the first whose path or base name is the same whatever the case, else null."""
    listed = files.select(F.col(path).alias("_path")).distinct()
    exact = listed.select(F.col("_path").alias("_exact"))
    keys = listed.select(F.explode(F.array_distinct(F.array(F.lower("_path"), F.lower(F.substring_index("_path", "/", -1))))).alias("_key"), "_path")
    loose = keys.groupBy("_key").agg(F.min("_path").alias("_loose"))
    out = names.join(exact, F.col(name) == F.col("_exact"), "left").join(loose, F.lower(name) == F.col("_key"), "left")
    return out.withColumn("path", F.coalesce("_exact", "_loose")).drop("_exact", "_key", "_loose")


#: A rendering manifest as JSON has it.
MANIFEST = (
    "dialogue_id string, rel_path string, variant_idx int, seed bigint, schema_version int, stage string, voice_picks map<string,struct<wav:string,txt:string,wav_size:bigint,wav_mtime_ns:bigint>>, "
    "utterances array<struct<turn:int,text_idx:int,speaker_idx:int,uttr_type:string,next_uttr_type:string,is_last_text:boolean,isUttered:boolean,tts_text:string,units:array<struct<kind:string,unit_id:string,text:string>>>>, "
    "backchannels array<struct<bc_idx:int,speaker_idx:int,text:string,word_count:int,host_idx:int,next_uttr_type_of_host:string,unit_id:string>>"
)
# The version and stage of a manifest that may be rendered, and what its parts may hold.
VERSION, STAGE = 1, "prep"
UTTERANCE_TYPES, NEXT_TYPES, UNIT_KINDS = ("backchannel", "interrupt"), ("backchannel", "interrupt", "last"), ("text", "pause")


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """Every ``manifest.json`` below ``root`` with ``broken``: the rules it breaks, none for a good one.

    A file that is no JSON comes out with nulls and breaks the rules of its parts.
    """
    rows = spark.read.schema(MANIFEST).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "manifest.json").json(root)
    return rows.withColumn("broken", broken_rules())


def broken_rules(version: int = VERSION, stage: str = STAGE) -> Column:
    """The names of the rules that a manifest breaks, within its row."""
    units = F.flatten(F.transform(F.col("utterances"), lambda x: F.coalesce(x["units"], F.array())))
    ids = F.array_sort(F.transform(units, lambda x: x["unit_id"]))
    some = lambda rows, f: F.coalesce(F.exists(rows, f), F.lit(False))
    odd = lambda x, allowed: x.isNotNull() & ~x.isin(*allowed)
    n = F.coalesce(F.size("utterances"), F.lit(0))
    rules = [
        ("schema_version", ~F.col("schema_version").eqNullSafe(F.lit(version))), ("stage", ~F.col("stage").eqNullSafe(F.lit(stage))), ("dialogue_id", F.coalesce("dialogue_id", F.lit("")) == ""),
        ("voice_picks", F.array_sort(F.map_keys(F.col("voice_picks"))).eqNullSafe(F.array(F.lit("assistant"), F.lit("user"))) == F.lit(False)),
        ("voice files", some(F.map_values(F.col("voice_picks")), lambda v: (F.coalesce(v["wav"], F.lit("")) == "") | (F.coalesce(v["txt"], F.lit("")) == ""))),
        ("fingerprints", some(F.map_values(F.col("voice_picks")), lambda v: (F.coalesce(v["wav_size"], F.lit(0)) < 0) | (F.coalesce(v["wav_mtime_ns"], F.lit(0)) < 0))),
        ("uttr_type", some(F.col("utterances"), lambda x: odd(x["uttr_type"], UTTERANCE_TYPES))), ("next_uttr_type", some(F.col("utterances"), lambda x: odd(x["next_uttr_type"], NEXT_TYPES))),
        ("speaker_idx", some(F.col("utterances"), lambda x: x["speaker_idx"].isNull() | ~x["speaker_idx"].isin(0, 1)) | some(F.col("backchannels"), lambda x: x["speaker_idx"].isNull() | ~x["speaker_idx"].isin(0, 1))),
        ("unit kind", some(units, lambda x: x["kind"].isNull() | ~x["kind"].isin(*UNIT_KINDS))), ("empty text unit", some(units, lambda x: (x["kind"] == "text") & (F.coalesce(x["text"], F.lit("")) == ""))),
        ("duplicate unit_id", some(ids, lambda x: F.lit(False)) | (F.size(ids) != F.size(F.array_distinct(ids)))),
        ("empty backchannel", some(F.col("backchannels"), lambda x: F.coalesce(x["text"], F.lit("")) == "")), ("word_count", some(F.col("backchannels"), lambda x: F.coalesce(x["word_count"], F.lit(0)) < 0)),
        ("host_idx", some(F.col("backchannels"), lambda x: x["host_idx"].isNull() | (x["host_idx"] < 0) | (x["host_idx"] >= n))),
        ("next_uttr_type_of_host", some(F.col("backchannels"), lambda x: odd(x["next_uttr_type_of_host"], NEXT_TYPES))),
        ("unit id collision", some(F.col("backchannels"), lambda x: F.array_contains(ids, x["unit_id"]))),
    ]
    return F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules]))


def switchboard(lines: DataFrame, file: str, order: str, line: str) -> DataFrame:
    """(file, line_no, da, speaker, turn, utt, text) of the utterance lines after each file's first line of ====; others are ignored."""
    w = Window.partitionBy(file).orderBy(order)
    body = lines.withColumn("_sep", F.max(F.col(line).rlike(r"^\s*={4,}").cast("int")).over(w)).where(F.col("_sep") == 1)
    body = body.where(F.col(line).rlike(UTTERANCE))
    part = lambda k: F.regexp_extract(F.col(line), UTTERANCE, k)
    return body.select(file, F.col(order).alias("line_no"), part(1).alias("da"), F.regexp_replace(part(2), "@", "").alias("speaker"), part(3).cast("int").alias("turn"), part(4).cast("int").alias("utt"), part(5).alias("text"))
