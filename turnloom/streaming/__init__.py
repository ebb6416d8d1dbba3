"""Streaming forms: slots and decisions as turns arrive, contexts in state, sessions by watermark."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from turnloom.functions import text as X
from turnloom.operators import slots as S


def decisions(turns: DataFrame, floor: float = 0.1, backchannel: float = 0.4) -> DataFrame:
    """(record_id, turn, word_index, action, decision): the same for a stream of turns and a table of them."""

    def act(i):
        u = X.uniform(F.lit(42), F.col("record_id"), F.col("turn"), i)
        return F.struct(i.alias("word_index"), S.sampled_action(u, F.lit(floor), F.lit(backchannel)).alias("action"))

    rows = turns.where(X.strip(F.col("content")) != "").withColumn("_words", X.words(F.col("content")))
    return rows.select("record_id", "turn", F.inline(S.decided(F.transform(S.slots_a(F.col("_words")), act))))


def contexts(turns: DataFrame, n: int = 4, idle: str | None = None, time: str = "ts") -> DataFrame:
    """(record_id, turn, context) of turns as they arrive: the last ``n`` turns of each dialogue are its state.

    All turns of a dialogue in one trigger are put in order before any is told, in
    however many batches they come.  A turn no later than the last one told gets
    the context of the turns that are there before it, and doesn't change what
    follows.  With ``idle`` on a stream that has the column ``time``, a dialogue's
    state is dropped once the watermark is past its last turn by that; without it
    state stays.
    """
    timed = idle is not None and turns.isStreaming
    rows = turns.withWatermark(time, idle) if timed else turns

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        empty = pd.DataFrame({"record_id": pd.Series(dtype="int64"), "turn": pd.Series(dtype="int32"), "context": pd.Series(dtype="object")})
        if state.hasTimedOut:
            state.remove()
            yield empty
            return
        kept = list(zip(*state.get)) if state.exists else []
        last = kept[-1][0] if kept else None
        f = pd.concat(list(frames)).sort_values("turn", kind="stable")
        out = []
        for turn, role, content in f[["turn", "role", "content"]].itertuples(index=False):
            before = [line for t, line in kept if t < turn][-n:]
            out.append((key[0], turn, "\n".join(x for x in before if x)))
            if last is None or turn > last:
                blank = content is None or not str(content).strip()
                kept, last = [*kept, (int(turn), "" if blank else f"{role}: {content}")][-2 * n :], turn
        state.update(([t for t, _ in kept], [line for _, line in kept]))
        if timed:
            state.setTimeoutTimestamp(max(int(f[time].max().timestamp() * 1000), state.getCurrentWatermarkMs()) + 1)
        yield pd.DataFrame(out, columns=["record_id", "turn", "context"])

    how = GroupStateTimeout.EventTimeTimeout if timed else GroupStateTimeout.NoTimeout
    return rows.groupBy("record_id").applyInPandasWithState(step, "record_id bigint, turn int, context string", "turns array<int>, lines array<string>", "append", how)


def sessions(events: DataFrame, gap: str = "30 minutes", late: str | None = "1 hour") -> DataFrame:
    """Sessions of each user: start, end, events and their value; with a watermark on a stream."""
    rows = events.withWatermark("ts", late) if events.isStreaming and late else events
    g = rows.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"), F.sum("value").alias("value"))
    return g.select("user_id", F.col("w.start").alias("start_ts"), F.col("w.end").alias("end_ts"), "n", "value")


def once(rows: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    """A stream without the rows that came before, within the watermark."""
    return rows.withWatermark(time, late).dropDuplicatesWithinWatermark([key]) if rows.isStreaming else rows.dropDuplicates([key])
