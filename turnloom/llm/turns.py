"""Problem 2: raw transcript lines as clean turns of speaker A and speaker B.

Speaker labels are brought to a core, blocked phonetically, and each
conversation's clusters of labels are assigned to the roster that holds across
transcripts.  Times, sounds, fillers and markup are stripped by SQL patterns;
lines in order are folded into turns by windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnloom.registry import Registry
from turnloom.session import cut, table

registry = Registry()

# Forms of times, labels, sounds and fillers.
CLOCK = r"(?:\d+:){1,2}\d+(?:[.,]\d+)?"
TIME = rf"^\s*(?:[\[(<]\s*({CLOCK}|\d+[.,]\d+)\s*[\])>]|({CLOCK}))(?:\s*-->\s*(?:{CLOCK})?|\s+[-–](?=\s|$))?\s*"
ROLE_WORDS = r"(?:speaker|spkr?|caller|voice|channel|participant)"
LABEL = rf"^\s*(?:\[\s*((?i:{ROLE_WORDS})?[\s_]*\p{{L}})\s*\]|((?i:{ROLE_WORDS})?[\s_]*[ABab]|\p{{Lu}}\p{{L}}+)\s*(?::|\s[-–])(?=\s|$))\s*"
SOUNDS = r"laugh\w*|cough\w*|sigh\w*|sneez\w*|sniff\w*|breath\w*|throat\w*|noise|music\w*|applause|silence|pause|inaudible|unintelligible|crosstalk|click\w*"
FILLERS = "um|umm|uhm|uh|uhh|hm|hmm|hmmm|mm|er|err|erm|ừm|ừmm|ờm|ờmm|ưm"
_OFF = r"(?<![\p{L}\p{M}\p{N}'’-])"
_END = r"(?![\p{L}\p{M}\p{N}'’-])"


def seconds_of(clock: Column) -> Column:
    """h:m:s, m:s or s, with a point or a comma, as seconds."""
    return F.aggregate(F.split(F.regexp_replace(clock, ",", "."), ":"), F.lit(0.0), lambda t, x: t * 60 + x.cast("double"))


def without_time(text: Column) -> Column:
    return F.regexp_replace(text, TIME, "")


def spoken_words(text: Column) -> Column:
    """The words of a line: no time, sound, filler, repair or markup.  Null for null."""
    steps = [
        (r"\(\([^()]*\)\)|<<[^<>]*>>|<[^<>]*>|\*[^*]{1,60}\*", " "),
        (rf"(?i)\(\s*(?:{SOUNDS})(?:\s[^()]*)?\)", " "),
        (r"\{F\b[^{}]*\}", " "),
        (r"\{[A-Z]\b\s*([^{}]*)\}", "$1 "),
        (rf"(?iu)[({{]?{_OFF}(?:{FILLERS}){_END}[)}}]?(?:\.\.+|…|[,.](?=\s|$))?", " "),
        (r"\[[^\[\]+]*\+\s*([^\[\]]*)\]", " $1 "),
        (r"\[[^\[\]+]*\+\s*([^\[\]]*)\]", " $1 "),
        (r"\[[^\[\]]*\]", " "),
        (r"\s*-?/\s*$|#|@+|\(\s*\)", " "),
        (r"(?U)\s+", " "),
        (r" (?=[,.?!;:](?:\s|$))", ""),
        (r"^[\s,.;:-]+(?=\S)|\s+$", ""),
        (r"([,;:])(?:\s*[,;:])+", "$1"),
    ]
    for pattern, to in steps:
        text = F.regexp_replace(text, pattern, to)
    return text


def label_core(label: Column) -> Column:
    """A speaker label in lower case and plain width, without role words and signs; null if nothing is left."""
    wide = "".join(chr(c) for c in [*range(0xFF21, 0xFF3B), *range(0xFF41, 0xFF5B)])
    flat = "".join(chr(c - 0xFEE0) for c in [*range(0xFF21, 0xFF3B), *range(0xFF41, 0xFF5B)])
    core = F.regexp_replace(F.lower(F.translate(label, wide, flat)), rf"[^\p{{L}}\p{{N}}]+|{ROLE_WORDS}(?![\p{{L}}])(?=[^\p{{L}}]*[\p{{L}}\p{{N}}])", "")
    core = F.regexp_replace(core, rf"^{ROLE_WORDS}(?=[\p{{L}}\p{{N}}]$)", "")
    return F.when(core != "", core)


def assigned_speakers(labels: DataFrame, conversation: str = "conversation_id", core: str = "core") -> DataFrame:
    """conversation, core, speaker ('A' or 'B') from a row for each line with its label's core.

    The roster is the two phonetic blocks that most conversations use, in their
    alphabetical order.  In a conversation each roster block takes its slot and
    every other block the slot of the least edit distance, unless that leaves a
    slot empty while there are two blocks or more: then the block moves for which
    that costs least.  With two slots this is the assignment of least total cost
    in which both are taken.  A null conversation is one like any other; lines
    without a core have no speaker.
    """
    block = F.when(F.length(core) == 1, F.col(core)).otherwise(F.concat(F.soundex(core), F.substring(core, 1, 1)))
    # the roster is two rows, whatever the corpus holds
    used = labels.where(F.col(core).isNotNull()).groupBy(conversation, core).agg(F.count("*").alias("n")).withColumn("block", block)
    blocks = used.groupBy(conversation, "block").agg(F.sum("n").alias("n"), F.min(core).alias("name"))
    top = blocks.groupBy("block").agg(F.count("*").alias("k")).orderBy(F.desc("k"), "block").limit(2).collect()
    roster = sorted(r["block"] for r in top)
    slot = F.lit(None).cast("string")
    for name, like in reversed(list(zip("AB", roster))):
        slot = F.when(F.col("block") == like, name).otherwise(slot)
    far = [F.levenshtein("name", F.lit(x)) for x in roster] or [F.lit(0)]
    known = blocks.withColumn("slot", slot).withColumn("_a", far[0]).withColumn("_b", far[-1])
    known = known.withColumn("near", F.coalesce("slot", F.when(F.col("_a") <= F.col("_b"), "A").otherwise("B")))
    w = Window.partitionBy(conversation)
    cheapest = F.row_number().over(w.orderBy(F.col("slot").isNotNull(), F.abs(F.col("_a") - F.col("_b")), "n", F.desc("block")))
    one_sided = (F.min("near").over(w) == F.max("near").over(w)) & (F.count("*").over(w) > 1)
    moves = one_sided & (cheapest == 1) & F.col("slot").isNull()
    known = known.select(F.col(conversation).alias("_c"), F.col("block").alias("_b"), F.when(moves, F.when(F.col("near") == "A", "B").otherwise("A")).otherwise(F.col("near")).alias("speaker"))
    return used.join(known, F.col(conversation).eqNullSafe(F.col("_c")) & (F.col("block") == F.col("_b"))).select(conversation, core, "speaker")


def cleaned_lines(lines: DataFrame) -> DataFrame:
    """Lines once each, with ``sec`` (time in the text), ``core`` (of the speaker's label) and ``words``."""
    once = lines.repartition("conversation_id").dropDuplicates(["conversation_id", "line_id"])
    raw = F.regexp_replace(F.coalesce("text_raw", F.lit("")), r"[\x{A0}\x{200B}\x{FEFF}]", " ")
    clock = F.coalesce(F.nullif(F.regexp_extract(raw, TIME, 1), F.lit("")), F.nullif(F.regexp_extract(raw, TIME, 2), F.lit("")))
    rest = without_time(raw)
    told = F.nullif(F.trim("speaker"), F.lit(""))
    in_text = F.coalesce(F.nullif(F.regexp_extract(rest, LABEL, 1), F.lit("")), F.nullif(F.regexp_extract(rest, LABEL, 2), F.lit("")))
    rows = once.select("conversation_id", "line_id", "utt", "da", told.alias("told"), rest.alias("rest"), seconds_of(clock).alias("sec"), in_text.alias("in_text"))
    body = F.when(F.col("told").isNull() & F.col("in_text").isNotNull(), F.regexp_replace("rest", LABEL, "")).otherwise(F.col("rest"))
    return rows.select("conversation_id", "line_id", "utt", "da", "sec", label_core(F.coalesce("told", "in_text")).alias("core"), spoken_words(body).alias("words"))


def placed_lines(rows: DataFrame) -> DataFrame:
    """``rows`` with ``at``, their place in the conversation.

    ``at`` orders by ``utt``; a line without ``utt`` follows the lines whose time
    is not after its own, and one without either comes last.
    """
    # minutes first, then their summary, so that a long conversation is no one task's
    rows = rows.withColumn("_minute", F.floor(F.col("sec") / 60))
    asks = rows.where(F.col("sec").isNotNull())
    minutes = asks.groupBy("conversation_id", "_minute").agg(F.max("utt").alias("_utt"))
    earlier = Window.partitionBy("conversation_id").orderBy("_minute").rowsBetween(Window.unboundedPreceding, -1)
    minutes = minutes.select(F.col("conversation_id").alias("_c"), F.col("_minute").alias("_m"), F.max("_utt").over(earlier).alias("_earlier"))
    by_time = Window.partitionBy("conversation_id", "_minute").orderBy("sec").rangeBetween(Window.unboundedPreceding, 0)
    timed = asks.withColumn("_within", F.max("utt").over(by_time)).join(minutes, F.col("conversation_id").eqNullSafe(F.col("_c")) & (F.col("_minute") == F.col("_m")))
    before = F.coalesce(F.greatest("_within", "_earlier").cast("double"), F.lit(-1e9)) + 0.5
    told_at = F.col("utt").cast("double")
    both = timed.withColumn("at", F.coalesce(told_at, before)).drop("_within", "_earlier", "_c", "_m").unionByName(rows.where(F.col("sec").isNull()).withColumn("at", told_at))
    return both.drop("_minute")


#: Places of a conversation that are folded in one task, and lines where no place is known.
STRETCH, LINES = 1024, 4096


def in_order() -> Column:
    """The order of a conversation's lines, as one comparable value."""
    last = F.lit(float("inf"))
    return F.struct(F.coalesce("at", last), F.coalesce("sec", last), F.col("line_id"))


def turn_lines(lines: DataFrame) -> DataFrame:
    """The lines that belong to turns, with ``speaker``, ``turn_no`` and ``place`` (their order in the conversation).

    Lines of the listener (``da`` begins with b or B), lines without a word, and
    lines whose speaker nothing tells belong to no turn and end none.  Repeated
    deliveries count once; a null conversation is one like any other.  Empty in,
    empty out.
    """
    # cleaned once, read for the roster, the labels and the turns
    rows = cut(cleaned_lines(lines))
    speakers = assigned_speakers(rows.select("conversation_id", "core"))
    spoken = placed_lines(rows).where(~F.coalesce(F.lower(F.substring(F.trim("da"), 1, 1)) == "b", F.lit(False)) & F.col("words").rlike(r"[\p{L}\p{N}]") & F.col("core").isNotNull())
    speakers = speakers.toDF("_c", "_k", "speaker")
    spoken = spoken.join(speakers, F.col("conversation_id").eqNullSafe(F.col("_c")) & (F.col("core") == F.col("_k"))).drop("_c", "_k")
    # stretches of a conversation are folded apart; what opens at their seams comes from a row for each stretch
    stretch = F.struct(F.coalesce(F.floor(F.col("at") / STRETCH), F.lit(2**62)).alias("a"), F.when(F.col("at").isNull(), F.floor(F.col("line_id") / LINES)).alias("b"))
    spoken = spoken.withColumn("_s", stretch).withColumn("_o", in_order())
    w = Window.partitionBy("conversation_id", "_s").orderBy("_o")
    changes = F.when(F.lag("speaker").over(w) != F.col("speaker"), 1).otherwise(0)
    spoken = spoken.withColumn("_changes", changes).withColumn("_own", F.sum("_changes").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    seams = spoken.groupBy("conversation_id", "_s").agg(F.min_by("speaker", "_o").alias("first"), F.max_by("speaker", "_o").alias("last"), F.max("_own").alias("inner"))
    v = Window.partitionBy("conversation_id").orderBy("_s")
    seams = seams.withColumn("opens", F.when(F.lag("last").over(v) != F.col("first"), 1).otherwise(0))
    offset = F.sum(F.col("opens") + F.col("inner")).over(v.rowsBetween(Window.unboundedPreceding, 0)) - F.col("inner")
    seams = seams.select(F.col("conversation_id").alias("_c"), F.col("_s").alias("_t"), offset.alias("_offset"))
    spoken = spoken.join(seams, F.col("conversation_id").eqNullSafe(F.col("_c")) & (F.col("_s") == F.col("_t")))
    spoken = spoken.withColumn("turn_no", (F.col("_offset") + F.col("_own")).cast("int")).withColumn("place", F.col("_o"))
    return spoken.drop("_c", "_s", "_t", "_o", "_changes", "_own", "_offset")


@registry.query("p2_found")
def p2_found(spark, sf_dir):
    """Each turn with the first and last of its lines."""
    rows = turn_lines(table(spark, sf_dir, "transcript_lines"))
    return rows.groupBy("conversation_id", "turn_no").agg(F.first("speaker").alias("speaker"), F.min_by("line_id", "place").alias("first_line_id"), F.max_by("line_id", "place").alias("last_line_id")).select("conversation_id", "turn_no", "speaker", "first_line_id", "last_line_id")


@registry.query("p2_turns")
def p2_turns(spark, sf_dir):
    """Each turn's clean text, dialogue acts and first time."""
    rows = turn_lines(table(spark, sf_dir, "transcript_lines"))
    parts = F.array_sort(F.collect_list(F.struct("place", "words", "da")))
    return (
        rows.groupBy("conversation_id", "turn_no")
        .agg(F.first("speaker").alias("speaker"), F.min("sec").alias("start_sec"), parts.alias("_parts"))
        .select("conversation_id", "turn_no", "speaker", "start_sec", F.array_join("_parts.words", " ").alias("text"), F.col("_parts.da").alias("acts"))
    )
