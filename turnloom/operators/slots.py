"""Turn-taking slots: where a listener could react, what is decided there, and what surrounds it.

A slot stands after word ``word_index`` (from 0).  Slots are found, decided and
used inside the row of their turn, by array functions, so that nothing is
shuffled; only context from other turns needs a window over the dialogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.functions import text as X

#: Guards of the decision fold: first words without floor-taking, words between backchannels, first words without any.
FLOOR_GUARD, GAP, START_GUARD = 3, 4, 0
#: Slot policy B: a gap longer than MAX_GAP words is filled every FILL words.
MAX_GAP, FILL = 8, 4


def is_candidate(word: Column, hesitations: tuple[str, ...] = X.HESITATIONS) -> Column:
    """A word that ends in punctuation, or a hesitation."""
    return word.rlike(X.STOP) | X.clean_word(word).isin(*hesitations)


def candidates(words: Column) -> Column:
    """The indices of candidate words, ascending."""
    marked = F.transform(words, lambda w, i: F.when(is_candidate(w), i))
    return F.filter(marked, lambda i: i.isNotNull())


def slots_a(words: Column, told: Column | None = None) -> Column:
    """Policy A: all candidates, and those in ``told``, but the last."""
    found = candidates(words) if told is None else F.array_sort(F.array_union(candidates(words), told))
    return F.element_at(F.transform(F.array(found), lambda x: F.slice(x, F.lit(1), F.greatest(F.size(x) - 1, F.lit(0)))), 1)


def kept_of_runs(indices: Column) -> Column:
    """Single indices, and the 2nd, 4th ... of each run of consecutive ones."""

    item = "array<struct<i:int,nth:int>>"
    start = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("nth"), F.array().cast(item).alias("out"))

    def step(s: Column, i: Column) -> Column:
        nth = F.when(i == s["last"] + 1, s["nth"] + 1).otherwise(0)
        return F.struct(i.alias("last"), nth.alias("nth"), F.concat(s["out"], F.array(F.struct(i.alias("i"), nth.alias("nth")))).alias("out"))

    def kept(s: Column) -> Column:
        out = s["out"]
        alone = lambda x, k: (x["nth"] == 0) & ~F.coalesce(F.get(out, k + 1)["nth"] == 1, F.lit(False))
        return F.transform(F.filter(out, lambda x, k: (x["nth"] % 2 == 1) | alone(x, k)), lambda x: x["i"])

    return F.aggregate(indices, start, step, kept)


def filled_gaps(indices: Column, n_words: Column, max_gap: int = MAX_GAP, fill: int = FILL) -> Column:
    """``indices`` and, where two are more than ``max_gap`` apart, every ``fill``-th place between; never the last word."""
    ends = F.concat(indices, F.array(n_words - 1))
    starts = F.concat(F.array(F.lit(-1)), indices)

    def between(a: Column, b: Column) -> Column:
        return F.when((b - a > max_gap), F.filter(F.sequence(a + fill, F.greatest(a + fill, b - 1), F.lit(fill)), lambda k: k < b)).otherwise(F.array().cast("array<int>"))

    extra = F.flatten(F.zip_with(starts, ends, between))
    return F.filter(F.array_sort(F.array_distinct(F.concat(indices, extra))), lambda i: (i >= 0) & (i < n_words - 1))


def slots_b(words: Column, max_gap: int = MAX_GAP, fill: int = FILL) -> Column:
    """Policy B: candidates but the last word, thinned in runs, with long gaps filled."""
    n = F.size(words)
    inner = F.filter(candidates(words), lambda i: i < n - 1)
    # the thinned indices are bound once, as filling reads them several times
    full = F.element_at(F.transform(F.array(kept_of_runs(inner)), lambda kept: filled_gaps(kept, n, max_gap, fill)), 1)
    return F.when(n > 0, full).otherwise(F.array().cast("array<int>"))


def sampled_action(u: Column, floor: Column, backchannel: Column) -> Column:
    """The action that a uniform number picks, in the order floor-taking, backchannel, silence."""
    return F.when(u <= floor, "floor_taking").when(u <= floor + backchannel, "backchannel").otherwise("silence")


def decided(slots: Column, start_guard: int = START_GUARD, floor_guard: int = FLOOR_GUARD, gap: int = GAP) -> Column:
    """Decisions over an array of (word_index, action), ascending: the same with ``decision``.

    After the first floor-taking all is silence; floor-taking needs ``floor_guard``
    words before it, and a backchannel ``gap`` words since the last one.
    """
    state = F.struct(F.lit(None).cast("int").alias("last"), F.lit(False).alias("taken"), F.array().cast("array<struct<word_index:int,action:string,decision:string>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        i, action = x["word_index"], x["action"]
        open_ = (i >= start_guard) & ~s["taken"]
        floor = open_ & (action == "floor_taking") & (i >= floor_guard)
        back = open_ & (action == "backchannel") & (s["last"].isNull() | (i - s["last"] >= gap))
        decision = F.when(floor, "floor_taking").when(back, "backchannel").otherwise("silence")
        return F.struct(F.when(back, i).otherwise(s["last"]).alias("last"), (s["taken"] | floor).alias("taken"), F.concat(s["out"], F.array(F.struct(i.alias("word_index"), action.alias("action"), decision.alias("decision")))).alias("out"))

    return F.aggregate(slots, state, step, lambda s: s["out"])


def spoken_text(words: Column, decisions: Column) -> Column:
    """The text up to the floor-taking, with its token; backchannel tokens don't stay in the text."""
    at = F.array_min(F.transform(F.filter(decisions, lambda d: d["decision"] == "floor_taking"), lambda d: d["word_index"]))
    return F.when(at.isNull(), F.array_join(words, " ")).otherwise(F.concat(F.array_join(F.slice(words, F.lit(1), at + 1), " "), F.lit(f" {X.TAKE_FLOOR}")))


def reconstructed(words: Column, decisions: Column) -> Column:
    """The text with a token after each word where floor-taking or a backchannel was decided.

    ``decisions`` are in the order of their words; the text is put together from
    the stretches between them.
    """
    acted = F.filter(decisions, lambda d: d["decision"] != "silence")

    def joined(told: Column) -> Column:
        token = lambda d: F.when(d["decision"] == "floor_taking", X.TAKE_FLOOR).otherwise(X.BACKCHANNEL)
        before = lambda k: F.coalesce(F.get(told, k - 1)["word_index"] + 1, F.lit(0))
        parts = F.transform(told, lambda d, k: F.concat(F.slice(words, before(k) + 1, d["word_index"] + 1 - before(k)), F.array(token(d))))
        rest = F.slice(words, before(F.size(told)) + 1, F.size(words))
        return F.array_join(F.concat(F.flatten(parts), rest), " ")

    return F.element_at(F.transform(F.array(acted), joined), 1)


def last_turns(turns: DataFrame, dialogue: str, order: str, n: int = 4) -> DataFrame:
    """``turns`` with ``context``: the ``n`` turns before, of which those without words are left out."""
    w = Window.partitionBy(dialogue).orderBy(order).rowsBetween(-n, -1)
    before = F.collect_list(F.struct(F.col("role"), F.coalesce(F.col("content"), F.lit("")).alias("content"))).over(w)
    return turns.withColumn("context", F.filter(before, lambda t: X.strip(t["content"]) != ""))
