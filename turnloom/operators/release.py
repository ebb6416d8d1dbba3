"""The release form of dialogues and annotations, and the way back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A segment of a turn: its full content, or a decision after one of its words.
SEGMENT = "struct<full_content:string,word_index:int,probs:struct<floor_taking:double,backchannel:double,silence:double>,decision:string,inserted_token:string,content:string>"
BOUNDARY = "struct<word_index:int,total_count:int,counts:struct<backchannel:int,interruption:int,none:int>,probabilities:struct<backchannel:double,interruption:double,none:double>>"
#: Release records, as JSON lines have them.
DIALOGUE = f"struct<example_id:string,scenario:string,license:string,context:string,style:string,disfluency_target:double,speakers:array<string>,history:array<struct<role:string,content:string,segments:array<{SEGMENT}>>>>"
ANNOTATION = f"struct<example_id:string,scenario:string,license:string,history:array<struct<role:string,content:string,boundaries:array<{BOUNDARY}>>>>"


def pack_dialogues(rows: DataFrame, scenario: Column, license_: Column) -> DataFrame:
    """Rows of (example_id, context, style, disfluency_target, speakers, history) in release form.

    A turn's nested ``history`` of decisions becomes ``segments``, empty where it
    is null; style and target are lifted from the record's meta; all other columns
    (config, split and the like) are dropped.
    """
    turn = lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"), F.coalesce(t["history"], F.array().cast(f"array<{SEGMENT}>")).alias("segments"))
    return rows.select("example_id", scenario.alias("scenario"), license_.alias("license"), "context", "style", "disfluency_target", "speakers", F.transform("history", turn).alias("history"))


def unpack_dialogues(rows: DataFrame, dataset: Column, split: Column) -> DataFrame:
    """Release rows as records: ``history`` nested again, and ``meta`` with the licence, style and target where there are any."""
    turn = lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"), F.coalesce(t["segments"], F.array().cast(f"array<{SEGMENT}>")).alias("history"))
    meta = F.struct(dataset.alias("dataset"), split.alias("split"), F.col("license"), F.col("style"), F.col("disfluency_target"))
    return rows.select("example_id", "speakers", F.create_map().cast("map<string,string>").alias("config"), F.transform("history", turn).alias("history"), "context", meta.alias("meta"))


def pack_annotations(rows: DataFrame, scenario: Column, license_: Column) -> DataFrame:
    """Rows of (example_id, history with boundaries) in release form; a turn without boundaries has the empty list."""
    turn = lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"), F.coalesce(t["boundaries"], F.array().cast(f"array<{BOUNDARY}>")).alias("boundaries"))
    return rows.select("example_id", scenario.alias("scenario"), license_.alias("license"), F.transform("history", turn).alias("history"))


def unpack_annotations(rows: DataFrame, dataset: Column, split: Column) -> DataFrame:
    """Release rows as records; ``boundaries`` are there on annotated turns only, null where the list is empty."""
    turn = lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"), F.when(F.size(t["boundaries"]) > 0, t["boundaries"]).alias("boundaries"))
    meta = F.struct(dataset.alias("dataset"), split.alias("split"), F.col("license"))
    return rows.select("example_id", F.transform("history", turn).alias("history"), meta.alias("meta"))
