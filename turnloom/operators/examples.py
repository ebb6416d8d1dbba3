"""Examples for training and inference: annotated turns, their valid boundaries and targets, and their context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.functions import text as X
from turnloom.operators import evaluate as E
from turnloom.operators import slots as S
from turnloom.operators.bound import bound


def is_annotated(boundaries: Column, content: Column, role: Column | None = None) -> Column:
    """A turn with a list of boundaries and words; of the user, unless ``role`` is not given."""
    own = boundaries.isNotNull() & (F.size(X.words(F.coalesce(content, F.lit("")))) > 0)
    return own if role is None else own & F.coalesce(role == "user", F.lit(False))


def valid_place(index: Column, n_words: Column) -> Column:
    """A boundary's word index as an integer, null if it is none or no place of the turn (F8)."""
    i = F.when(index.cast("string").rlike(r"^\s*[+-]?\d{1,9}\s*$"), F.trim(index.cast("string")).try_cast("int"))
    return F.when((i >= 0) & (i < n_words), i)


def with_targets(boundaries: Column, index: str, n_words: Column, target) -> Column:
    """The valid boundaries, in their order, as (word_idx, target_probs)."""
    told = F.transform(boundaries, lambda b: F.struct(valid_place(b[index], n_words).alias("word_idx"), target(b).alias("target_probs")))
    return F.filter(told, lambda b: b["word_idx"].isNotNull())


def human_target(b: Column) -> Column:
    """A boundary's human shares of backchannel, interruption and none as a distribution; all on none where there is no share."""
    p = b["probabilities"]
    return E.renormed(p["backchannel"], p["interruption"], p["none"])


def one_hot(b: Column) -> Column:
    """A typed boundary as a distribution: BACKCHANNEL, TAKE_FLOOR, and none for every other type."""
    kind = F.coalesce(b["type"], F.lit(""))
    at = F.when(kind == "BACKCHANNEL", 0).when(kind == "TAKE_FLOOR", 1).otherwise(2)
    return F.transform(F.sequence(F.lit(0), F.lit(2)), lambda k: (k == at).cast("double"))


def examples(turns: DataFrame, dialogue: str, turn: str, boundaries: str, index: str, target, any_role: bool = False, history: int = 4) -> DataFrame:
    """(dialogue, turn, context, user_utterance, trps): one example for each annotated turn with a valid boundary.

    ``turns`` has role and content besides; the context are the ``history`` turns
    before, those without words left out.  ``index`` names the boundary's word
    index and ``target`` makes its distribution.
    """
    rows = S.last_turns(turns, dialogue, turn, history)
    rows = rows.where(is_annotated(F.col(boundaries), F.col("content"), None if any_role else F.col("role")))
    n = F.size(X.words(F.col("content")))
    rows = bound(rows, trps=with_targets(F.col(boundaries), index, n, target)).where("size(trps) > 0")
    return rows.select(dialogue, turn, "context", F.col("content").alias("user_utterance"), "trps")


def single_slots(found: DataFrame, dialogue: str, turn: str) -> DataFrame:
    """Examples of one slot each: (dialogue, turn, context, user_utterance, word_idx, target_probs)."""
    return found.select(dialogue, turn, "context", "user_utterance", F.inline("trps"))


def typed_boundaries(text: Column) -> Column:
    """(content, typed) of a text with tokens: its words, and (idx, type) of the word that each token follows; of tokens after one word the last counts."""
    marks = F.regexp_extract_all(text, F.lit(r"(?:^|(?<=\s))(\[BACKCHANNEL\]|\[TAKE_FLOOR\])(?=\s|$)"), F.lit(1))
    parts = F.split(text, r"(?:^|(?<=\s))(?:\[BACKCHANNEL\]|\[TAKE_FLOOR\])(?=\s|$)")

    def told(p: Column) -> Column:
        sizes = F.transform(p["parts"], lambda x: F.size(X.words(x)))
        before = lambda k: F.aggregate(F.slice(sizes, F.lit(1), k + 1), F.lit(0), lambda a, b: a + b)
        all_ = F.transform(p["marks"], lambda m, k: F.struct((before(k) - 1).alias("idx"), F.when(m == X.BACKCHANNEL, "BACKCHANNEL").otherwise("TAKE_FLOOR").alias("type")))
        last = F.filter(all_, lambda b, k: (b["idx"] >= 0) & ~F.coalesce(F.get(all_, k + 1)["idx"] == b["idx"], F.lit(False)))
        return F.struct(F.flatten(F.transform(p["parts"], X.words)).alias("words"), last.alias("typed"))

    return F.element_at(F.transform(F.array(F.struct(marks.alias("marks"), parts.alias("parts"))), told), 1)


def joined_boundaries(candidates: Column, typed: Column) -> Column:
    """Candidate places and typed boundaries as one list of (idx, type), ascending; the type wins."""
    own = F.transform(typed, lambda b: b["idx"])
    bare = F.transform(F.filter(candidates, lambda i: ~F.array_contains(own, i)), lambda i: F.struct(i.alias("idx"), F.lit(None).cast("string").alias("type")))
    return F.array_sort(F.concat(bare, typed))


def prompt_lines(context: Column) -> Column:
    """A context's turns as lines; the user speaks, the assistant listens."""
    who = lambda r: F.when(r == "user", "Speaker").when(r == "assistant", "Listener").otherwise(F.initcap(r))
    return F.array_join(F.transform(context, lambda t: F.concat(F.coalesce(who(t["role"]), F.lit("?")), F.lit(": "), t["content"], F.lit("\n"))), "")


def block(turns: Column, first: int = 1) -> Column:
    """Turns of (role, content) as lines numbered from ``first``."""
    line = lambda t, i: F.concat((i + first).cast("string"), F.lit(") "), F.coalesce(t["role"], F.lit("?")), F.lit(": "), X.normalize_ws(F.coalesce(t["content"], F.lit(""))))
    return F.array_join(F.transform(turns, line), "\n")


#: What each prompt is put together from; the names in braces are columns.
TEMPLATES = {
    "first_turn": "Source:\n{source}\n\nWrite the first turn, by {role}, as speech.\nSource turn by {speaker}: {text}",
    "with_history": "Source:\n{source}\n\nSo far:\n{history}\n\nWrite the next turn, by {role}, as speech.",
    "streaming": "Source:\n{source}\n\nSo far, still being spoken:\n{history}\n\nGo on as {role}.",
    "judge": "Source:\n{source}\n\nSpoken:\n{generated}\n\nIs all of the source said? Answer as JSON with done and stop.",
    "evaluate": "{lines}Speaker (so far): {partial}",
    "backchannel": "Conversation:\n[PREVIOUS]\n{previous}\n[SPEAKER CURRENT]\n{prefix} [INSERT] {rest}",
}


def prompt(kind: str, **parts: Column) -> Column:
    """The prompt ``kind`` with its parts filled in; a missing part is an error, a null one is empty."""
    pieces, rest = [], TEMPLATES[kind]
    while "{" in rest:
        before, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        pieces += [F.lit(before), F.coalesce(parts[name], F.lit(""))]
    return F.concat(*pieces, F.lit(rest))


def human_votes(probs: Column) -> Column:
    """A training distribution (backchannel, interruption, none) under the names that annotators used."""
    return F.struct(F.get(probs, F.lit(0)).alias("backchannel"), F.get(probs, F.lit(1)).alias("take_floor"), F.get(probs, F.lit(2)).alias("silent"))
