"""Switchboard-style conversations: backchannels marked by their neighbours, floors cut, lines merged into turns."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def is_backchannel_act(da: Column, end: Column) -> Column:
    """A dialogue act that begins with b, or % on a line that isn't broken off."""
    return F.coalesce(da.startswith("b"), F.lit(False)) | F.coalesce((da == "%") & (F.coalesce(end, F.lit("")) != "-/"), F.lit(False))


def marked(lines: DataFrame, by: str, order: str) -> DataFrame:
    """Lines with ``is_bc`` (a backchannel act between two lines of the other speaker) and ``floor_cut``.

    A line that is broken off loses the floor, unless it is the last or the next
    line is the other speaker's backchannel.
    """
    w = Window.partitionBy(by).orderBy(order)
    act = is_backchannel_act(F.col("da"), F.col("end"))
    before, after = F.lag("speaker").over(w), F.lead("speaker").over(w)
    is_bc = before.isNotNull() & after.isNotNull() & (before != F.col("speaker")) & (after != F.col("speaker")) & act
    next_bc = (after != F.col("speaker")) & F.lead(act).over(w)
    cut = (F.col("end") == "-/") & after.isNotNull() & ~F.coalesce(next_bc, F.lit(False))
    return lines.withColumn("is_bc", F.coalesce(is_bc, F.lit(False))).withColumn("floor_cut", F.coalesce(cut, F.lit(False)))


def merged_turns(lines: DataFrame, by: str, order: str, text: Column) -> DataFrame:
    """Consecutive lines of one speaker as one turn: ``turn_no``, ``speaker``, ``n``, ``text``."""
    w = Window.partitionBy(by).orderBy(order)
    opens = F.when(F.lag("speaker").over(w).eqNullSafe(F.col("speaker")), 0).otherwise(1)
    rows = lines.withColumn("_o", opens).withColumn("turn_no", F.sum("_o").over(w) - 1)
    g = rows.groupBy(by, "turn_no").agg(F.first("speaker").alias("speaker"), F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), text.alias("t")))).alias("_p"))
    return g.select(by, "turn_no", "speaker", "n", F.array_join("_p.t", " ").alias("text"))


TOKEN = "[BACKCHANNEL]"


def attach(speakers: list[str], texts: list[str], marked_: list[bool]) -> tuple[list[str], list[bool], list[int | None], list[int | None]]:
    """Backchannels put into the lines that host them: (texts, gone, host, merged), a list of each for the lines.

    A marked line between two lines of one other speaker, the nearest with words
    that are no backchannels, joins these to one; else it goes to the end of the
    line before it, or to the begin of the one after, if the other speaker has it;
    else it is no backchannel.  Lines are taken in order, so a line that was joined
    to another is not there for the next.  ``gone`` lines stand in another;
    ``host`` is where a backchannel went, ``merged`` the line it joined to it.
    """
    n = len(texts)
    texts, is_bc = list(texts), list(marked_)
    gone, host, merged = [False] * n, [None] * n, [None] * n
    # the nearest line with words after each that was no backchannel at first; joined ones are passed over
    after: list[int | None] = [None] * n
    for i in range(n - 2, -1, -1):
        after[i] = i + 1 if not is_bc[i + 1] and texts[i + 1] else after[i + 1]
    before: int | None = None
    for i in range(n):
        if is_bc[i]:
            k = after[i]
            while k is not None and not texts[k]:
                k = after[k]
            me, left, right = speakers[i], None if before is None else speakers[before], None if k is None else speakers[k]
            if left is not None and left == right and left != me:
                texts[before] = " ".join(f"{texts[before]} {TOKEN} {texts[k]}".split())
                texts[k], gone[k] = "", True
                host[i], merged[i], gone[i] = before, k, True
            elif left is not None and left != me:
                texts[before] = f"{texts[before]} {TOKEN}".strip()
                host[i], gone[i] = before, True
            elif right is not None and right != me:
                texts[k] = f"{TOKEN} {texts[k]}".strip()
                host[i], gone[i] = k, True
            else:
                is_bc[i] = False
        if not is_bc[i] and texts[i]:
            before = i
    return texts, gone, host, merged


def attached_backchannels(lines: DataFrame, by: str, order: str, key: str, speaker: str, text: str) -> DataFrame:
    """``lines`` (with ``is_bc``) as (by, order, key, speaker, text, gone, host, merged): what ``attach`` makes of each.

    Conversations are sorted, not gathered: between two lines with words that are
    no backchannels, of which at most one stands right before them, nothing later
    reaches back, so a task holds the lines since the last such place.  A null
    speaker is one of its own, a null text has no words.
    """
    rows = lines.select(by, order, key, speaker, text, "is_bc").repartition(by).sortWithinPartitions(by, order)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"`{by}` {kinds[by]}, `{order}` {kinds[order]}, `{key}` {kinds[key]}, `{speaker}` {kinds[speaker]}, `{text}` string, gone boolean, host {kinds[key]}, merged {kinds[key]}"

    def folded(held: list[tuple]) -> list[tuple]:
        texts, gone, host, merged = attach([x[3] or "" for x in held], [x[4] or "" for x in held], [bool(x[5]) for x in held])
        at = lambda k: None if k is None else held[k][2]
        return [(*x[:4], t, g, at(h), at(m)) for x, t, g, h, m in zip(held, texts, gone, host, merged)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        # backchannels right before the last line with words, and since then
        backs = since = 0
        fields = None
        for batch in batches:
            out: list[tuple] = []
            fields = fields or [batch.schema.field(i).type for i in (0, 1, 2, 3)]
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                words = bool(row[4]) and not row[5]
                if held and row[0] != held[-1][0]:
                    out += folded(held)
                    held, backs, since = [], 0, 0
                elif held and words and held[-1][4] and not held[-1][5] and backs <= 1:
                    out += folded(held)
                    held = []
                if words:
                    backs, since = since, 0
                since += bool(row[5])
                held.append(row)
            if out:
                yield _batch(out, fields)
        if held:
            yield _batch(folded(held), fields)

    def _batch(out: list[tuple], fields: list) -> pa.RecordBatch:
        types = [*fields, pa.string(), pa.bool_(), fields[2], fields[2]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], [by, order, key, speaker, text, "gone", "host", "merged"])

    return rows.mapInArrow(run, schema)


def _bare(word: str) -> str:
    return "".join(c for c in word.lower() if c.isalnum() or c == "_")


def aligned_marks(original: list[str], copy: list[str], mark: str = "|") -> list[int]:
    """The places of ``original`` words that a model's marked copy points at, ascending.

    A copy of as many words is read place by place.  Else words are matched in
    order without case and signs; a copied word that matches nothing is passed
    over with its mark, as is a sign on either side.
    """
    if len(copy) == len(original):
        return [k for k, w in enumerate(copy) if mark in w]
    found, i = [], 0
    for token in copy:
        word = token.replace(mark, "")
        bare = _bare(word)
        # signs of the original that stand before the next word
        while i < len(original) and not _bare(original[i]) and original[i].strip() and (bare or not word.strip()):
            i += 1
        if i >= len(original):
            break
        if bare == _bare(original[i]) and (bare or word.strip() == original[i].strip()):
            if mark in token:
                found.append(i)
            i += 1
    return found


def marks(original: Column, copy: Column, mark: str = "|") -> Column:
    """``aligned_marks`` of two arrays of words; only copies of another length leave the JVM."""
    here = F.filter(F.transform(copy, lambda w, i: F.when(F.contains(w, F.lit(mark)), i)), lambda i: i.isNotNull())

    @F.pandas_udf("array<int>")
    def greedy(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if y is None else aligned_marks(list(x), list(y), mark) for x, y in zip(a, b)], dtype=object)

    same = F.size(original) == F.size(copy)
    # Python gets nothing where the places tell
    return F.when(same, here).otherwise(greedy(F.when(~same, original), F.when(~same, copy)))
