"""From decided turns to utterances, and from these to the hosts and backchannels of a rendering manifest."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.functions import text as X
from turnloom.operators.bound import bound


def segments(text: Column, contents: Column, pick: Column) -> Column:
    """A turn's text with tokens as an array of (is_bc, text): what is said between its backchannels, and these.

    The text, sanitised before, is cut shortly after its floor token.  The n-th token
    takes the n-th of ``contents``, or ``pick`` where there is none.  Stretches in
    which nothing is left are dropped.
    """

    def parted(parts: Column) -> Column:
        n = F.size(parts)

        def around(p: Column, i: Column) -> Column:
            own = X.without_tokens(F.regexp_replace(p, "^[ ,]+|[ ,]+$", ""))
            told = X.without_tokens(F.coalesce(F.nullif(F.get(contents, i), F.lit("")), pick))
            said = F.array(F.struct(F.lit(False).alias("is_bc"), own.alias("text")))
            back = F.array(F.struct(F.lit(True).alias("is_bc"), told.alias("text")))
            return F.concat(F.when(own != "", said).otherwise(F.slice(said, 1, 0)), F.when(i < n - 1, back).otherwise(F.slice(back, 1, 0)))

        return F.flatten(F.transform(parts, around))

    cut = F.split(X.cut_at_take_floor(text), r"\[BACKCHANNEL\]")
    return F.element_at(F.transform(F.array(cut), parted), 1)


def utterances(turns: DataFrame, dialogue: str, turn: str, role: str, text: str, contents: Column, pick: Column) -> DataFrame:
    """(dialogue, turn, seg, idx, role, uttr_type, text): the utterances of each dialogue in order, ``idx`` from 0.

    ``uttr_type`` is backchannel, interrupt (the utterance right after the last
    host of a turn whose floor was taken, if the other role speaks it) or null.
    Turns of other roles than user and assistant, and turns with no words left,
    give none.  A dialogue's utterances are ordered by a window over its own turns.
    """
    # sanitised in a projection of its own, as it is read several times
    rows = turns.where(F.col(role).isin("user", "assistant")).select(dialogue, turn, role, X.sanitize_text(F.col(text)).alias("_clean"), contents.alias("_contents"), pick.alias("_pick"))
    taken = F.contains("_clean", F.lit(X.TAKE_FLOOR))
    rows = bound(rows.withColumn("_taken", taken), _s=segments(F.col("_clean"), F.col("_contents"), F.col("_pick")))
    last = F.array_max(F.transform("_s", lambda s, i: F.when(~s["is_bc"], i)))
    rows = rows.select(dialogue, turn, role, "_taken", last.alias("_last"), F.posexplode("_s").alias("seg", "_x"))
    rows = rows.select(dialogue, turn, "seg", role, F.col("_x.is_bc").alias("_bc"), F.col("_x.text").alias("text"), (F.col("_taken") & (F.col("seg") == F.col("_last"))).alias("_cuts"))
    w = Window.partitionBy(dialogue).orderBy(turn, "seg")
    cut = F.coalesce(F.lag("_cuts").over(w) & (F.lag(role).over(w) != F.col(role)), F.lit(False))
    return rows.select(dialogue, turn, "seg", (F.row_number().over(w) - 1).alias("idx"), role, F.when(cut, "interrupt").when(F.col("_bc"), "backchannel").alias("uttr_type"), "text")


def fold(kinds: list[str | None], uttered: list[bool], words: list[int], offset: int) -> tuple[list[dict], list[dict]]:
    """The hosts and backchannels of a dialogue's utterances, told by their kinds, whether they are uttered, and their words.

    Channels go by position.  A host's text is gathered across the backchannels
    that interrupt it and flushed when none follows; an utterance that isn't
    uttered takes a dangling backchannel with it and flushes what was gathered.
    A host has ``parts`` (places of its utterances), ``at``, ``speaker_idx``,
    ``uttr_type`` and ``next_type``; a backchannel ``at``, ``speaker_idx``,
    ``word_count`` (words of its host before it) and ``host_idx``.
    """
    hosts: list[dict] = []
    backs: list[dict] = []
    parts, count = [[], []], [0, 0]
    open_, cuts = [False, False], [False, False]
    before: str | None = "first"
    for i, kind in enumerate(kinds):
        me = (i + offset) % 2
        after = kinds[i + 1] if i + 1 < len(kinds) else "last"
        cuts[me] |= kind == "interrupt"
        flush = False
        if uttered[i] and kind == "backchannel":
            backs.append({"at": i, "speaker_idx": me, "word_count": count[1 - me], "host_idx": len(hosts)})
        elif uttered[i]:
            if before != "backchannel":
                parts[me], count[me] = [], 0
            parts[me].append(i)
            count[me] += words[i]
            flush = after != "backchannel"
            open_[me] |= not flush
        else:
            if before == "backchannel" and backs:
                backs.pop()
            flush = after != "backchannel" and open_[me]
        if flush:
            hosts.append({"parts": parts[me], "at": i, "speaker_idx": me, "uttr_type": "interrupt" if cuts[me] else None, "next_type": after})
            parts[me], count[me], open_[me], cuts[me] = [], 0, False, False
        before = kind
    for b in backs:
        b["host_idx"] = min(b["host_idx"], len(hosts) - 1)
    return hosts, backs


_HOST = pa.struct([("parts", pa.list_(pa.int32())), ("at", pa.int32()), ("speaker_idx", pa.int32()), ("uttr_type", pa.string()), ("next_type", pa.string())])
_BACK = pa.struct([("at", pa.int32()), ("speaker_idx", pa.int32()), ("word_count", pa.int32()), ("host_idx", pa.int32())])


def manifests(said: DataFrame, dialogue: str, role: str) -> DataFrame:
    """(dialogue, hosts, backchannels) from ``utterances``: the two lists of a rendering manifest.

    hosts: host_idx, turn (place of the flush), speaker_idx, uttr_type,
    next_uttr_type, tts_text; backchannels: bc_idx, speaker_idx, text, word_count,
    host_idx (held within the hosts, -1 where there is none),
    next_uttr_type_of_host.  A dialogue is one row; its fold passes kinds and
    counts only, once, in Arrow batches, and texts stay in the JVM.
    """
    item = F.struct("idx", "uttr_type", "text", role, X.is_uttered(F.col("text")).alias("uttered"), F.size(X.align_words(F.col("text"))).alias("words"))
    rows = said.groupBy(dialogue).agg(F.array_sort(F.collect_list(item)).alias("_u"))
    rows = rows.select(dialogue, F.col("_u.text").alias("_t"), F.col("_u.uttr_type").alias("_k"), F.col("_u.uttered").alias("_said"), F.col("_u.words").alias("_w"), F.when(F.get(f"_u.{role}", F.lit(0)) == "assistant", 1).otherwise(0).alias("_o"))
    kind = rows.schema[dialogue].dataType.simpleString()

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            told = [fold(*x) for x in zip(*(b.column(i).to_pylist() for i in (2, 3, 4, 5)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([h for h, _ in told], pa.list_(_HOST)), pa.array([k for _, k in told], pa.list_(_BACK))], [dialogue, "_t", "_h", "_b"])

    schema = f"`{dialogue}` {kind}, _t array<string>, _h array<struct<parts:array<int>,at:int,speaker_idx:int,uttr_type:string,next_type:string>>, _b array<struct<at:int,speaker_idx:int,word_count:int,host_idx:int>>"
    rows = rows.mapInArrow(folded, schema)
    text = lambda parts: X.strip(F.array_join(F.transform(parts, lambda k: F.get("_t", k)), " "))
    hosts = F.transform("_h", lambda h, i: F.struct(i.cast("int").alias("host_idx"), h["at"].alias("turn"), h["speaker_idx"].alias("speaker_idx"), h["uttr_type"].alias("uttr_type"), h["next_type"].alias("next_uttr_type"), text(h["parts"]).alias("tts_text")))
    backs = F.transform("_b", lambda b, i: F.struct(i.cast("int").alias("bc_idx"), b["speaker_idx"].alias("speaker_idx"), X.rising(F.get("_t", b["at"])).alias("text"), b["word_count"].alias("word_count"), b["host_idx"].alias("host_idx"), F.get("_h", b["host_idx"])["next_type"].alias("next_uttr_type_of_host")))
    return rows.select(dialogue, hosts.alias("hosts"), backs.alias("backchannels"))


def units(tts_text: Column, host_idx: Column, keep: tuple[str, ...] = ()) -> Column:
    """A host's text as units (kind, unit_id, text): its sentences, parted at pauses, which are units without text.

    Bracket tags are taken off but for those in ``keep``; without ``keep`` only the
    known tags are.
    """
    bare = X.strip(F.regexp_replace(X.strip_tags_but(tts_text, keep) if keep else X.strip_tags(tts_text), X.MASKS, ""))

    def parted(s: Column) -> Column:
        def piece(p: Column, i: Column, parts: Column) -> Column:
            own = X.strip(p)
            said, pause = (F.array(F.struct(F.lit(k).alias("kind"), t.alias("text"))) for k, t in (("text", own), ("pause", F.lit(""))))
            return F.concat(F.when(own != "", said).otherwise(F.slice(said, 1, 0)), F.when(i < F.size(parts) - 1, pause).otherwise(F.slice(pause, 1, 0)))

        return F.element_at(F.transform(F.array(F.split(s, r"\[PAUSE\]")), lambda parts: F.flatten(F.transform(parts, lambda p, i: piece(p, i, parts)))), 1)

    flat = F.flatten(F.transform(X.sentences(bare), parted))
    return F.transform(flat, lambda u, i: F.struct(u["kind"].alias("kind"), F.concat_ws("_", F.lit("u"), host_idx.cast("string"), i.cast("string")).alias("unit_id"), u["text"].alias("text")))
