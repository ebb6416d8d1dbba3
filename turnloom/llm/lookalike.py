"""Problem 5: texts that look the same brought to one form."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from turnloom.llm.forms import Forms
from turnloom.registry import Registry
from turnloom.session import table

registry = Registry()


def _histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0x110000, dtype=np.int64)
    for batch in batches:
        # a batch's texts stand in one buffer, one after the other
        column = batch.column(0)
        column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        data = column.buffers()[2]
        if data is None or offsets[-1] == offsets[0]:
            continue
        raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
        ascii_ = raw < 0x80
        total[:0x80] += np.bincount(raw[ascii_], minlength=0x80)
        if not ascii_.all():
            points = np.frombuffer(raw[~ascii_].tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), dtype=np.uint32)
            at, n = np.unique(points, return_counts=True)
            total[at] += n
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["point", "n"])


def code_points(texts: DataFrame, text: str = "text") -> dict[int, int]:
    """How often each code point stands in all texts; at most as many entries as Unicode has."""
    said = texts.select(F.col(text)).where(F.col(text).isNotNull())
    rows = said.mapInArrow(_histogram, "point int, n bigint").groupBy("point").agg(F.sum("n").alias("n")).collect()
    return {r["point"]: r["n"] for r in rows}


def one_form(texts: DataFrame, text: str = "text", out: str = "canonical", forms: Forms | None = None, changed_only: bool = False) -> DataFrame:
    """``texts`` with a column ``out``: the text in one consistent form, and ``changed`` (boolean).

    Null stays null and is unchanged, the empty text stays empty.  Nothing else of
    a row is touched; rows are neither added nor lost, but with ``changed_only``
    the unchanged ones are left out.  The classes are built from the code points
    of the whole corpus unless ``forms`` is given.  All texts pass through Python
    once, in Arrow batches: whether a text holds a suspect character is a test of
    two sets there, which costs about a quarter of a pattern of some thousand ranges.
    ``texts`` must not have columns named ``out`` or ``changed``.
    """
    forms = forms or Forms(code_points(texts, text))
    fields = list(texts.columns)
    # a schema of its own, as adding to one changes it
    schema = StructType(list(texts.schema.fields)).add(out, "string").add("changed", "boolean")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(fields.index(text)).to_pylist()
            new = [None if x is None else forms.canonical(x) for x in old]
            changed = [a != b for a, b in zip(old, new)]
            columns = [*batch.columns, pa.array(new, pa.string()), pa.array(changed, pa.bool_())]
            if changed_only:
                at = pa.array([i for i, x in enumerate(changed) if x], pa.int32())
                columns = [c.take(at) for c in columns]
            yield pa.RecordBatch.from_arrays(columns, [*fields, out, "changed"])

    return texts.mapInArrow(rewrite, schema)


def corpus_texts(spark, sf_dir: str) -> DataFrame:
    """field_name, row_id, pos, text of history contents, unit texts and backchannels; deliveries may repeat."""
    turns = table(spark, sf_dir, "dialogues").select(F.lit("history.content").alias("field_name"), F.col("record_id").alias("row_id"), F.posexplode("history").alias("pos", "x"))
    units = table(spark, sf_dir, "utterances").select(F.lit("unit.text").alias("field_name"), F.col("utterance_id").alias("row_id"), F.posexplode("units").alias("pos", "x"))
    calls = table(spark, sf_dir, "backchannels").select(F.lit("backchannel.text").alias("field_name"), F.col("backchannel_id").alias("row_id"), F.lit(0).alias("pos"), "text")
    parts = [turns.withColumn("text", F.col("x.content")).drop("x"), units.withColumn("text", F.col("x.text")).drop("x"), calls]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).where("length(text) > 0")


@registry.query("p5_found")
def p5_found(spark, sf_dir):
    """The texts that the consistent form changes."""
    return changed_texts(corpus_texts(spark, sf_dir)).select("field_name", "row_id", "pos").distinct()


def changed_texts(texts: DataFrame) -> DataFrame:
    """The rows of ``texts`` that ``one_form`` changes, with both forms."""
    return one_form(texts, changed_only=True)


@registry.query("p5_canonical")
def p5_canonical(spark, sf_dir):
    """Every text in its consistent form."""
    return one_form(corpus_texts(spark, sf_dir)).select("field_name", "row_id", "pos", "canonical", "changed").dropDuplicates(["field_name", "row_id", "pos"])
