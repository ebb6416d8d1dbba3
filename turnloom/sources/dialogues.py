"""Readers of dialogue collections, each into (example_id, dataset, split, context, turns).

``turns`` is an array of (role, content); blank turns are dropped.  Schemas are
explicit, and unreadable records come out with ``turns`` null rather than as an
error.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.functions import text as X

TURNS = "array<struct<role:string,content:string>>"
COLUMNS = ["example_id", "dataset", "split", "context", "turns"]
# Labels of transcripts that are the assistant's.
LABELS = r"(?:Assistant|Claude|AI|User)"


def spoken(turns: Column) -> Column:
    """Turns with their contents stripped, the blank ones dropped."""
    clean = F.transform(turns, lambda t: F.struct(t["role"].alias("role"), X.strip(t["content"]).alias("content")))
    return F.filter(clean, lambda t: F.coalesce(t["content"], F.lit("")) != "")


def shaped(rows: DataFrame, example_id: Column, dataset: str, split: Column, context: Column, turns: Column) -> DataFrame:
    return rows.select(example_id.cast("string").alias("example_id"), F.lit(dataset).alias("dataset"), split.alias("split"), context.alias("context"), spoken(turns).alias("turns"))


def split_transcript(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with ``turns`` from one text of labelled blocks; a text without labels has none.

    The first label may stand anywhere, what is before it is no turn; every other
    begins a line.
    """
    pieces = F.split(F.regexp_replace(F.col(text), rf"(?i)\n({LABELS}):\s*", "\x01$1\x02"), "\x01")

    def turn(p: Column, i: Column) -> Column:
        marked = F.when(i == 0, F.regexp_replace(p, rf"(?is)^.*?({LABELS}):\s*", "$1\x02")).otherwise(p)
        label = F.when(F.contains(marked, F.lit("\x02")), F.substring_index(marked, "\x02", 1))
        role = F.when(F.lower(label) == "user", "user").when(label.isNotNull(), "assistant")
        return F.struct(role.alias("role"), F.regexp_replace(marked, "^[^\x02]*\x02", "").alias("content"))

    return rows.withColumn("turns", spoken(F.filter(F.transform(pieces, turn), lambda t: t["role"].isNotNull())))


def interviewer(spark: SparkSession, path: str, split: str, context: str = "An interview.") -> DataFrame:
    """JSON of (transcript_id, text); empty texts are skipped."""
    rows = spark.read.schema("transcript_id string, text string").json(path).where(X.strip(F.col("text")) != "")
    rows = split_transcript(rows, "text")
    return shaped(rows, F.col("transcript_id"), "interviewer", F.lit(split), F.lit(context), F.col("turns"))


def multiwoz(spark: SparkSession, path: str, split: str) -> DataFrame:
    """Arrays of (dialogue_id, turns of speaker and utterance); trailing characters of '.json' leave the id."""
    rows = spark.read.option("multiLine", True).schema("dialogue_id string, turns array<struct<speaker:string,utterance:string>>").json(path)
    turns = F.transform("turns", lambda t: F.struct(F.when(F.upper(t["speaker"]) == "USER", "user").otherwise("assistant").alias("role"), t["utterance"].alias("content")))
    return shaped(rows, F.regexp_replace("dialogue_id", r"[.json]+$", ""), "multiwoz", F.lit(split), F.lit(None).cast("string"), turns)


def negotiator(spark: SparkSession, path: str, split: str) -> DataFrame:
    """Bargaining events, of which messages count; agent 0 is the user."""
    schema = "uuid string, scenario struct<category:string,kbs:array<struct<personal:struct<Role:string,Target:double>,item:struct<Title:string>>>>, events array<struct<action:string,agent:int,data:string>>"
    rows = spark.read.option("multiLine", True).schema(schema).json(path)
    said = F.filter("events", lambda e: e["action"] == "message")
    turns = F.transform(said, lambda e: F.struct(F.when(e["agent"] == 0, "user").otherwise("assistant").alias("role"), e["data"].alias("content")))
    parts = F.transform("scenario.kbs", lambda k: F.concat_ws(" ", k["personal"]["Role"], k["item"]["Title"], k["personal"]["Target"].cast("string")))
    return shaped(rows, F.col("uuid"), "negotiator", F.lit(split), F.concat_ws("; ", F.col("scenario.category"), F.array_join(parts, "; ")), turns)


def socratic(spark: SparkSession, path: str, max_variants: int | None = None) -> DataFrame:
    """An object of problems, each with variants of system and user lines; the first variants by name, the split from the key."""
    variant = "array<struct<system:string,user:string,END:string>>"
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", f"map<string,struct<question:string,dialogues:map<string,{variant}>>>")).alias("key", "p"))
    names = F.array_sort(F.map_keys("p.dialogues"))
    if max_variants:
        names = F.slice(names, 1, max_variants)
    rows = rows.select("key", "p", F.explode(names).alias("name")).withColumn("lines", F.element_at(F.col("p.dialogues"), F.col("name")))
    both = F.flatten(F.transform("lines", lambda x: F.array(F.struct(F.lit("assistant").alias("role"), x["system"].alias("content")), F.struct(F.lit("user").alias("role"), x["user"].alias("content")))))
    split = F.when(F.contains(F.lower("key"), F.lit("_train_")), "train").when(F.contains(F.lower("key"), F.lit("_test_")), "test").otherwise("unknown")
    return shaped(rows, F.concat_ws("__", "key", "name"), "socraticlm", split, F.col("p.question"), both)


def persuader_csv(spark: SparkSession, path: str, split: str) -> DataFrame:
    """CSV rows of turn, utterance, -, speaker, conversation; rows of fewer columns are dropped, speaker 0 is the assistant."""
    rows = spark.read.option("header", True).option("mode", "PERMISSIVE").option("multiLine", True).schema("c0 string, c1 string, c2 string, c3 string, c4 string").csv(path)
    rows = rows.where("c4 IS NOT NULL AND try_cast(c0 AS int) IS NOT NULL")
    one = F.struct(F.col("c0").cast("int").alias("n"), F.when(F.col("c3") == "0", "assistant").otherwise("user").alias("role"), F.col("c1").alias("content"))
    g = rows.groupBy("c4").agg(F.array_sort(F.collect_list(one)).alias("t"))
    return shaped(g, F.col("c4"), "persuader", F.lit(split), F.lit(None).cast("string"), F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))))


def persuader_sessions(spark: SparkSession, path: str, split: str, max_variants: int | None = None) -> DataFrame:
    """JSON of sessions of (role, response), the first ones in the order of the file; the persuader is the assistant."""
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "array<string>")).alias("doc"))
    names = F.json_object_keys(F.get_json_object("doc", "$.dialog"))
    if max_variants:
        names = F.slice(names, 1, max_variants)
    rows = rows.select("doc", F.explode(names).alias("name"))
    lines = F.element_at(F.from_json(F.get_json_object("doc", "$.dialog"), "map<string,array<struct<role:string,response:string>>>"), F.col("name"))
    turns = F.transform(lines, lambda t: F.struct(F.when(F.lower(t["role"]) == "persuader", "assistant").otherwise("user").alias("role"), t["response"].alias("content")))
    return shaped(rows, F.concat_ws("__", F.get_json_object("doc", "$.id"), "name"), "persuader", F.lit(split), F.get_json_object("doc", "$.scenario.background"), turns)


def soda(spark: SparkSession, path: str, split: str, kind: str = "parquet", start_index: int = 0, max_accepted: int | None = None, gate: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Lines of two speakers in turn, the first the user; the speakers' names in the narrative become roles.

    Rows from ``start_index`` on; a ``gate`` takes rows with ``prompt`` (the lines,
    one speaker a line) and returns those it lets through, of which the first
    ``max_accepted`` stay.
    """
    schema = "original_index bigint, dialogue array<string>, narrative string, speakers array<string>"
    rows = spark.read.schema(schema).format(kind).load(path).where(F.col("original_index") >= start_index)
    if gate is not None:
        lines = F.transform("dialogue", lambda x, i: F.concat(F.lit("Speaker "), (i % 2 + 1).cast("string"), F.lit(": "), F.coalesce(x, F.lit(""))))
        rows = gate(rows.withColumn("prompt", F.array_join(lines, "\n"))).drop("prompt")
    if max_accepted is not None:
        rows = rows.orderBy("original_index").limit(max_accepted)
    turns = F.transform("dialogue", lambda x, i: F.struct(F.when(i % 2 == 0, "user").otherwise("assistant").alias("role"), x.alias("content")))
    story = F.col("narrative")
    for i, role in enumerate(("User", "Assistant")):
        name = F.get("speakers", F.lit(i))
        story = F.when(F.coalesce(name, F.lit("")) != "", X.name_to_role(story, name, role)).otherwise(story)
    return shaped(rows, F.concat(F.lit(f"{split}_"), F.col("original_index").cast("string")), "soda", F.lit(split), story, turns)


def listed(spark: SparkSession, root: str, pattern: str = "*.json") -> DataFrame:
    """(path, dataset, split, stem) of every file below ``root``, at any depth; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select("path")
    part = lambda k: F.try_element_at(F.split("path", "/"), F.lit(k))
    return files.select("path", part(-3).alias("dataset"), part(-2).alias("split"), F.regexp_replace(part(-1), r"\.[^.]*$", "").alias("stem"))


def sampled(files: DataFrame, k: int | None) -> DataFrame:
    """``k`` files of each dataset and split at even distances of their paths, before any is read."""
    from turnloom.operators.sampling import evenly_spaced

    return evenly_spaced(files, ["dataset", "split"], ["path"], k)


def parsed(spark: SparkSession, root: str, datasets: list[str] | None = None, splits: list[str] | None = None, per_split: int | None = None) -> DataFrame:
    """``<root>/.../<dataset>/<split>/*.json`` of one dialogue each; turns are pairs or objects, the id falls back on the file's name.

    Files of other datasets and splits are left out by their path, and with
    ``per_split`` all but an even sample, before any is read.  A file that is no
    JSON, and a dialogue without turns, gives no row.
    """
    files = listed(spark, root)
    if datasets is not None:
        files = files.where(F.col("dataset").isin(*datasets))
    if splits is not None:
        files = files.where(F.col("split").isin(*splits))
    if per_split is not None:
        files = sampled(files, per_split)
    texts = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json").select("value", F.col("_metadata.file_path").alias("_path"))
    # one of the two paths is written for URLs
    plain = F.url_decode(F.replace("_path", F.lit("+"), F.lit("%2B")))
    rows = texts.join(files.withColumnRenamed("path", "_of"), F.regexp_replace(plain, "^file:/+", "/") == F.regexp_replace("_of", "^file:/+", "/"))
    doc = lambda k: F.get_json_object("value", f"$.{k}")
    turns = F.transform(F.from_json(doc("history"), "array<string>"), as_turn)
    turns = F.filter(turns, lambda t: t["role"].isNotNull() & t["content"].isNotNull())
    return rows.select(F.coalesce(doc("example_id"), "stem").alias("example_id"), "dataset", "split", doc("context").alias("context"), spoken(turns).alias("turns")).where("size(turns) > 0")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with a schema; blank lines are skipped, a line that is no JSON is a row of nulls with the line in ``_broken``."""
    lines = spark.read.text(path).where(X.strip(F.col("value")) != "")
    ok = F.try_parse_json(F.concat(F.lit("["), "value", F.lit("]"))).isNotNull()
    return lines.select(F.when(ok, F.from_json("value", schema)).alias("r"), F.when(~ok, F.col("value")).alias("_broken")).select("r.*", "_broken")


def as_turn(item: Column) -> Column:
    """A turn from JSON that is a pair or an object; null parts where it is neither."""
    pair = F.when(item.startswith("["), F.from_json(item, "array<string>"))
    obj = F.when(item.startswith("{"), F.from_json(item, "struct<role:string,content:string>"))
    return F.struct(F.coalesce(F.get(pair, F.lit(0)), obj["role"]).alias("role"), F.coalesce(F.get(pair, F.lit(1)), obj["content"]).alias("content"))


def dump(spark: SparkSession, path: str) -> DataFrame:
    """Parquet in one of three dialects: parsed, dialogue lines, or transcript_id and turns; dataset and split from the path."""
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row"))
    has = set(rows.columns)
    name = F.lower(F.col("_path"))
    split = F.when(F.contains(name, F.lit("train")), "train").when(F.contains(name, F.lit("valid")), "validation").when(F.contains(name, F.lit("test")), "test").otherwise("unknown")
    ids = [F.col(c).cast("string") for c in ("example_id", "transcript_id", "id", "original_index") if c in has]
    if "history" in has:
        turns = F.col("history").cast(TURNS)
    elif "turns" in has:
        turns = F.col("turns").cast(TURNS)
    else:
        turns = F.transform("dialogue", lambda x, i: F.struct(F.when(i % 2 == 0, "user").otherwise("assistant").alias("role"), x.alias("content")))
    context = F.coalesce(*[F.col(c).cast("string") for c in ("context", "narrative") if c in has], F.lit(None).cast("string"))
    own = F.coalesce(F.col("split"), split) if "split" in has else split
    # rows without an id are told apart by their place in their file
    place = F.concat_ws("_", own, F.md5("_path"), F.col("_row").cast("string"))
    return rows.select(F.coalesce(*ids, place).alias("example_id"), F.element_at(F.split("_path", "/"), -2).alias("dataset"), own.alias("split"), context.alias("context"), spoken(turns).alias("turns"))


#: Readers by the name of their collection.
READERS = {"interviewer": interviewer, "multiwoz": multiwoz, "negotiator": negotiator, "socraticlm": socratic, "persuader": persuader_csv, "persuader_sessions": persuader_sessions, "soda": soda}


#: What each reader may be told besides path and split; ``read`` takes them all and passes on those of its reader.
OPTIONS = {"interviewer": {"context"}, "multiwoz": set(), "negotiator": set(), "socraticlm": {"max_variants"}, "persuader": set(), "persuader_sessions": {"max_variants"}, "soda": {"kind", "start_index", "max_accepted", "gate"}}


def resolved_path(dataset: str, input_paths: Mapping[str, str] | None = None, input_path: str | None = None, data_root: str | None = None) -> str:
    """Where a collection is: its own path, else the one for all, else its folder below the root; an error if nothing tells."""
    path = (input_paths or {}).get(dataset) or input_path or (f"{data_root.rstrip('/')}/{dataset}" if data_root else None)
    if not path:
        raise ValueError(f"no path for dataset {dataset!r}")
    return path


def read(spark: SparkSession, dataset: str, path: str, split: str = "train", parsed_root: str | None = None, **options) -> DataFrame:
    """The collection ``dataset`` by its reader; a parsed root goes before it.  Every reader is called alike; an option that no reader knows is an error."""
    if dataset not in READERS:
        raise ValueError(f"unknown dataset {dataset!r}; expected one of {sorted(READERS)}")
    if unknown := set(options) - set().union(*OPTIONS.values()):
        raise TypeError(f"unknown options: {sorted(unknown)}")
    if parsed_root:
        return parsed(spark, parsed_root, datasets=[dataset])
    own = {k: v for k, v in options.items() if k in OPTIONS[dataset]}
    if dataset == "socraticlm":
        return socratic(spark, path, **own)  # its keys tell the split
    return READERS[dataset](spark, path, split, **own)


def joined(parts: list[DataFrame]) -> DataFrame:
    """Tables one after the other; columns that some lack are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def voice_pool(spark: SparkSession, folder: str, least: int = 2) -> DataFrame:
    """(stem, wav, txt, wav_size, wav_mtime): audio files that have a transcript of the same stem beside them; fewer than ``least`` are an error, 0 looks at nothing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length", "modificationTime")
    stem = F.regexp_replace("path", r"\.[^./]+$", "")
    wav = files.where(F.lower("path").endswith(".wav")).select(stem.alias("stem"), F.col("path").alias("wav"), F.col("length").alias("wav_size"), F.col("modificationTime").alias("wav_mtime"))
    txt = files.where(F.lower("path").endswith(".txt")).select(stem.alias("stem"), F.col("path").alias("txt"))
    pool = wav.join(txt, "stem")
    if least and len(pool.select("stem").take(least)) < least:
        raise ValueError(f"fewer than {least} voices with a transcript in {folder}")
    return pool


def speakers_of(spark: SparkSession, folder: str, excluded: DataFrame | None = None) -> DataFrame:
    """(speaker, files) of ``<folder>/<speaker>/<chapter>/*.flac``, without the excluded speakers."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.flac").load(folder).select("path")
    rows = files.select(F.element_at(F.split("path", "/"), -3).alias("speaker"), "path")
    if excluded is not None:
        rows = rows.join(excluded.select("speaker").distinct(), "speaker", "left_anti")
    return rows.groupBy("speaker").agg(F.array_sort(F.collect_list("path")).alias("files"))
