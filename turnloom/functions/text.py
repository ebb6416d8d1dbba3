"""Text functions over columns: cleaning, peeling, splitting and counting.

All but ``nfkd_lower`` are built-in expressions.  A blank is a blank of Unicode, and letters are
letters of any script.  Null in, null out, unless a function says otherwise.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes and vocabularies shared with the SQL formulations.
BLANK = r"[\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
ROLE = r"(?:user|assistant|ai|human|system|speaker\s*\d+|bot|agent)"
INDEX = r"(?:\d+\s*[.):\]]|[-*#•]\s)"
ROLE_PREFIX = rf"^\s*{ROLE}\s*[:\-—–]\s*"
FULL_PREFIX = rf"^\s*(?:{INDEX}\s*)?(?:{ROLE}\s*[:\-—–]\s*)?"
BAD_START = rf"^\s*(?:{INDEX}\s*)?{ROLE}\s*[:\-—–]"
QUOTED = r"^[\"'“‘`]((?s:.*))[\"'”’`]$"
HESITATIONS = ("um", "uh", "umm", "uhh", "hm", "hmm", "huh", "ưm", "à", "ừ", "ơ", "ơi", "hử", "chà", "á", "ú")
STOP = r"[.,?!;]+$"
TAKE_FLOOR, BACKCHANNEL, PAUSE = "[TAKE_FLOOR]", "[BACKCHANNEL]", "[PAUSE]"
TAGS = ("laughter", "sigh", "confirmation-en", "question-en", "question-ah", "question-oh", "question-ei", "question-yi", "surprise-ah", "surprise-oh", "surprise-wa", "surprise-yo", "dissatisfaction-hnn")
TAG = r"\[(?:" + "|".join(TAGS) + r")\]"
STAGE = (
    "sigh", "sighs", "sighing", "yawn", "yawns", "yawning", "laugh", "laughs", "laughing", "chuckle", "chuckles", "cough", "coughs", "clears throat", "clearing throat",
    "whistle", "whistles", "whistling", "wink", "winks", "wink wink", "smile", "smiles", "smiling", "grin", "grins", "pause", "pauses", "hands receipt", "three times",
)
RISING = ("yeah", "ưm", "vâng", "à", "ừ")
BACKCHANNELS = ("yeah", "uh-huh", "mm-hmm", "right", "okay")
UNUTTERED = ("", "-", "...", ".", ",")
MASKS = r"\[(?:interrupted|MASK1|MASK2)\]"
WORD = r"[A-Za-zÀ-ỹ]+(?:['’\-][A-Za-zÀ-ỹ]+)*|\d+(?:\.\d+)?"
INLINE_ROLE = r"(?:user|assistant|system)"


def strip(x: Column) -> Column:
    """Without blanks at either end."""
    return F.regexp_replace(x, rf"^{BLANK}+|{BLANK}+$", "")


def normalize_ws(x: Column) -> Column:
    """Runs of blanks as one space, none at the ends."""
    return F.trim(F.regexp_replace(x, rf"{BLANK}+", " "))


def words(x: Column) -> Column:
    """The words between blanks; a blank text has none."""
    return F.filter(F.split(normalize_ws(x), " "), lambda w: w != "")


def clean_word(w: Column) -> Column:
    """A word in lower case with letters, digits and underscores only."""
    return F.lower(F.regexp_replace(w, r"[^\p{L}\p{M}\p{N}_\s]", ""))


def without_think(x: Column) -> Column:
    """Without <think> blocks."""
    return strip(F.regexp_replace(x, r"(?s)<think>.*?</think>", ""))


def after_think(x: Column) -> Column:
    """What follows the last </think>."""
    return strip(F.substring_index(x, "</think>", -1))


def sanitize_utterance(x: Column) -> Column:
    """Without think blocks, code fences, up to four rounds of index, role and quote prefixes, and dashes.  Null gives ''."""
    s = without_think(strip(F.coalesce(x, F.lit(""))))
    s = strip(F.regexp_replace(s, r"^```[a-zA-Z0-9_+-]*\s*", ""))
    s = strip(F.regexp_replace(s, r"\s*```\s*$", ""))
    for _ in range(4):
        for pattern in (FULL_PREFIX, ROLE_PREFIX, rf"^\s*{INDEX}\s*"):
            s = F.regexp_replace(F.regexp_replace(s, rf"(?i){pattern}", ""), r"^\s+", "")
        s = F.when((F.length(s) >= 2) & s.rlike(QUOTED), strip(F.regexp_replace(s, QUOTED, "$1"))).otherwise(s)
    return normalize_ws(F.regexp_replace(s, "[—–]", ", "))


def has_prefix(x: Column) -> Column:
    """Whether a text still begins with a role."""
    return F.coalesce(strip(x).rlike(rf"(?i){BAD_START}"), F.lit(False))


def strip_tags(x: Column) -> Column:
    """Without the known paralinguistic tags."""
    return F.regexp_replace(x, TAG, "")


def strip_tags_but(x: Column, keep: tuple[str, ...]) -> Column:
    """Without bracket tags except ``keep`` and the pause."""
    kept = "|".join([*keep, "PAUSE"])
    return F.regexp_replace(x, rf"\[(?!(?:{kept})\])[A-Za-z0-9_\-]+\]", "")


def dashes_to_spaces(x: Column) -> Column:
    """Hyphens as spaces, outside bracket tags."""
    return F.regexp_replace(x, r"-(?![A-Za-z0-9_\-]*\])", " ")


def sentences(x: Column) -> Column:
    """Sentences by . ? !; a text without any is one."""
    found = F.filter(F.transform(F.split(x, r"(?<=[.?!])\s+"), strip), lambda s: s != "")
    return F.when(F.size(found) > 0, found).otherwise(F.array(strip(x)))


def align_words(x: Column) -> Column:
    """The words that alignment counts."""
    bare = F.regexp_replace(x, r"\[(?:BACKCHANNEL|TAKE_FLOOR|PAUSE|interrupted|MASK1|MASK2)\]", "")
    return F.regexp_extract_all(strip(strip_tags(bare)), F.lit(f"({WORD})"), F.lit(1))


def cut_at_take_floor(x: Column) -> Column:
    """What stands before the floor token and one word after it, or three if fewer than five stand before."""
    left, right = strip(F.substring_index(x, TAKE_FLOOR, 1)), strip(F.substring(x, F.locate(TAKE_FLOOR, x) + len(TAKE_FLOOR), F.length(x)))

    def told(p: Column) -> Column:
        keep = F.when(F.size(F.regexp_extract_all(p["left"], F.lit(f"({WORD})"), F.lit(1))) < 5, 3).otherwise(1)
        kept = F.array_join(F.slice(p["after"], F.lit(1), keep), " ")
        return F.when(F.size(p["after"]) == 0, p["left"]).otherwise(F.trim(F.concat_ws(" ", p["left"], kept)))

    # both sides are bound once
    sides = F.struct(left.alias("left"), F.regexp_extract_all(right, F.lit(f"({WORD})"), F.lit(1)).alias("after"))
    return F.when(F.contains(x, F.lit(TAKE_FLOOR)), F.element_at(F.transform(F.array(sides), told), 1)).otherwise(x)


def stage_directions(x: Column) -> Column:
    """*sighs* and the like removed, other starred phrases without their stars; stars pair from left to right."""
    s = F.regexp_replace(x, r"\*([^*\n]{1,60})\*", "\x01$1\x02")
    s = F.regexp_replace(s, rf"(?i)\x01[ ,]*(?:{'|'.join(STAGE)})[ ,]*\x02", "")
    return F.regexp_replace(s, r"[\x01\x02]", "")


def without_tokens(x: Column) -> Column:
    """Without backchannel and floor tokens."""
    return strip(F.replace(F.replace(x, F.lit(BACKCHANNEL), F.lit("")), F.lit(TAKE_FLOOR), F.lit("")))


def is_uttered(x: Column) -> Column:
    """Whether anything is left to say once marks are off."""
    return ~strip(F.regexp_replace(x, MASKS, "")).isin(*UNUTTERED)


def rising(x: Column) -> Column:
    """A backchannel that reads better as a question gets its mark."""
    return F.when(F.lower(strip(strip_tags(x))).isin(*RISING), F.concat(F.regexp_replace(x, rf"{BLANK}+$", ""), F.lit("?"))).otherwise(x)


def sanitize_text(x: Column) -> Column:
    """One spelling of the floor token, dots as pauses, no turn marks, roles or stage directions."""
    s = F.regexp_replace(x, r"(?i)\[TAKING_FLOOR\]", TAKE_FLOOR)
    s = F.regexp_replace(s, r"\.\.\.|…", PAUSE)
    s = F.regexp_replace(s, r"\[(?:User|Assistant) [Tt]urn\]", "")
    s = F.regexp_replace(s, rf"(?i)^(?:\s*(?:\d+\)\s*)?{INLINE_ROLE}\s*:\s*)+", "")
    return strip(F.regexp_replace(stage_directions(s), rf"{BLANK}{{2,}}", " "))


def name_to_role(x: Column, name: Column, role: str = "User") -> Column:
    """``name``, a literal that may differ by row, replaced by a role wherever it stands as a whole word, in any case."""
    bare = F.regexp_replace(name, r"\\E", "")
    return F.regexp_replace(x, F.concat(F.lit(r"(?iu)(?<![\p{L}\p{M}\p{N}_])\Q"), bare, F.lit(r"\E(?![\p{L}\p{M}\p{N}_])")), F.lit(role))


def process_history(x: Column) -> Column:
    """Without backchannel tokens, cut after the floor token."""
    s = F.replace(x, F.lit(BACKCHANNEL), F.lit(""))
    return normalize_ws(F.when(F.contains(s, F.lit(TAKE_FLOOR)), F.concat(F.substring_index(s, TAKE_FLOOR, 1), F.lit(f" {TAKE_FLOOR}"))).otherwise(s))


def backchannel_key(x: Column) -> Column:
    """The key of a backchannel: no punctuation at the ends, lower case."""
    return F.lower(F.regexp_replace(x, r"^[\s.,!?\-]+|[\s.,!?\-]+$", ""))


def safe_id(x: Column) -> Column:
    return F.regexp_replace(x, r"[^\p{L}\p{N}_\-.]", "_")


def safe_stem(x: Column) -> Column:
    """A stem of file-safe characters, 'clip' if none is left."""
    stem = F.regexp_replace(F.regexp_replace(x, r"^.*/", ""), r"(?<=.)\.[^.]*$", "")
    s = F.regexp_replace(F.regexp_replace(stem, r"[^A-Za-z0-9._-]+", "_"), r"^[._-]+|[._-]+$", "")
    return F.when(s == "", "clip").otherwise(s)


def transcript_markup(x: Column) -> Column:
    """Transcription markup off: repairs keep both sides, {F um} its words, laughter its tag."""
    s = normalize_ws(F.regexp_replace(x, r"[\[\]+]", " "))
    s = F.regexp_replace(s, r"\{[A-Z]\s+([^}]+)\}", "$1")
    s = F.regexp_replace(F.regexp_replace(s, r"(?i)<\s*laughter\s*>", " [laughter] "), r"<[^>]+>", " ")
    return F.regexp_replace(normalize_ws(F.regexp_replace(s, "#", " ")), r"^[ \-]+|[ \-]+$", "")


def end_marker(x: Column) -> Column:
    """'-/' or '/' at the end of a line, null if neither stands there."""
    m = F.regexp_extract(x, r"(-?/)\s*$", 1)
    return F.when(m != "", m)


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts only."""
    key = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def first_json(x: Column, schema: str) -> Column:
    """The text as JSON, or else its outermost {...}; null if neither parses."""
    def read(s: Column) -> Column:
        # within an array nothing may follow the value
        return F.when(F.try_parse_json(F.concat(F.lit("["), s, F.lit("]"))).isNotNull(), F.from_json(s, schema))

    return F.coalesce(read(x), read(F.nullif(F.regexp_extract(x, r"(?s)(\{.*\})", 1), F.lit(""))))


def flat_json(x: Column, schema: str) -> Column:
    """The first {...} without braces in it, as JSON; null if there is none or it doesn't parse."""
    found = F.nullif(F.regexp_extract(x, r"(?s)(\{[^{}]*\})", 1), F.lit(""))
    return F.when(F.try_parse_json(found).isNotNull(), F.from_json(found, schema))


def without_fences(x: Column) -> Column:
    """Without a code fence around the text."""
    return strip(F.regexp_replace(F.regexp_replace(strip(x), r"^```[a-zA-Z0-9_+-]*\s*", ""), r"\s*```$", ""))


def told_distribution(x: Column, names: tuple[str, ...], fallback: Column) -> Column:
    """The numbers that an answer's first flat JSON gives for ``names``, as shares of their sum; ``fallback`` where it can't be read or they sum to nothing.

    A missing or null number is 0.
    """
    read = flat_json(x, ", ".join(f"`{n}` double" for n in names))
    values = F.array(*[F.coalesce(read[n], F.lit(0.0)) for n in names])
    told = F.struct(values.alias("v"), F.aggregate(values, F.lit(0.0), lambda a, b: a + b).alias("s"))
    bound = F.transform(F.array(told), lambda t: F.when(read.isNotNull() & (t["s"] > 0), F.transform(t["v"], lambda v: v / t["s"])).otherwise(fallback))
    return F.element_at(bound, 1)


# What a synthesizer's text is rewritten by, in this order, and the signs it may end in, for each of its kinds.
PUNCTUATION = {
    "standard": (("...", ", "), ("…", ", "), (":", ","), (" - ", ", "), (";", ", "), ("—", "-"), ("–", "-"), (" ,", ","), ("“", '"'), ("”", '"'), ("‘", "'"), ("’", "'")),
    "turbo": (("…", ", "), (":", ","), ("—", "-"), ("–", "-"), (" ,", ","), ("“", '"'), ("”", '"'), ("‘", "'"), ("’", "'")),
}
PUNCTUATION["multilingual"] = PUNCTUATION["standard"]
ENDS = {"standard": r"[.!?\-,]$", "turbo": r"[.!?\-,]$", "multilingual": r"[.!?\-,、，。？！]$"}
NO_TEXT = "You need to add some text for me to talk."


def punc_norm(x: Column, kind: str = "standard") -> Column:
    """A text as a synthesizer wants it: a capital first, single blanks, plain signs, a stop at the end; a sentence of its own for the empty text."""
    s = normalize_ws(F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, F.lit(2), F.length(x))))
    for old, new in PUNCTUATION[kind]:
        s = F.replace(s, F.lit(old), F.lit(new))
    s = F.regexp_replace(s, " +$", "")
    return F.when(x == "", NO_TEXT).otherwise(F.when(s.rlike(ENDS[kind]), s).otherwise(F.concat(s, F.lit("."))))


def nfkd_lower(x: Column) -> Column:
    """A text decomposed (NFKD) and in lower case; ASCII texts stay in the JVM."""
    @F.pandas_udf("string")
    def decomposed(s: pd.Series) -> pd.Series:
        return s.str.normalize("NFKD").str.lower()

    plain = ~x.rlike(r"[^\x00-\x7F]")
    return F.when(plain, F.lower(x)).otherwise(decomposed(F.when(~plain, x)))


# The labels that each kind of collection gives the role that answers, or that asks.
ROLE_RULES = {
    "interviewer": ("assistant", ("assistant", "claude", "ai")), "multiwoz": ("user", ("user",)), "negotiator": ("user", ("0",)),
    "persuader": ("assistant", ("persuader",)), "socraticlm": ("assistant", ("system",)), "switchboard": ("assistant", ("a",)),
}


def role_by(rule: str, label: Column, index: Column) -> Column:
    """user or assistant by a collection's rule: from the label, or, for lines of two speakers in turn, from the line's index."""
    if rule == "soda":
        return F.when(index % 2 == 0, "user").otherwise("assistant")
    role, labels = ROLE_RULES[rule]
    return F.when(F.coalesce(F.lower(label).isin(*labels), F.lit(False)), role).otherwise("assistant" if role == "user" else "user")


def floor_positions(x: Column) -> Column:
    """The place of the word before each floor token of a text, 0 at least; tokens count as words."""
    ws = words(x)
    return F.transform(F.filter(F.transform(ws, lambda w, i: F.when(w == TAKE_FLOOR, i)), lambda i: i.isNotNull()), lambda i: F.greatest(i - 1, F.lit(0)))


def moved_decisions(decisions: Column, translated: Column) -> Column:
    """Decisions of a turn after its translation: the k-th floor-taking stands where the translation's k-th floor token does; others stay, as do those without a token."""
    places = floor_positions(translated)
    is_floor = lambda d: d["decision"] == "floor_taking"

    def moved(bound: Column) -> Column:
        def one(d: Column, i: Column) -> Column:
            k = F.size(F.filter(F.slice(bound["d"], F.lit(1), i), is_floor))
            at = F.when(is_floor(d), F.coalesce(F.get(bound["p"], k), d["word_index"])).otherwise(d["word_index"])
            return F.struct(at.alias("word_index"), d["decision"].alias("decision"))

        return F.transform(bound["d"], one)

    return F.element_at(F.transform(F.array(F.struct(decisions.alias("d"), places.alias("p"))), moved), 1)
