"""Problem 4: the language of each text and of each segment.

Language-bitmask n-gram filters: one Bloom filter a language, stored bit-sliced,
so that one slot holds a bit for every language and the AND of an n-gram's slots
is the set of languages that contain it.  N-grams are words (pairs of characters
where a script has no blanks), and four-character pieces for words in no filter.
Each n-gram votes for its languages in equal shares; the votes, less what false
positives are expected to add, give each sentence's evidence, and the cheapest
path through the sentences their languages.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.llm.words import any_forms
from turnloom.registry import Registry
from turnloom.session import table

registry = Registry()

LANGUAGES = ("en", "vi", "fr", "es", "pt", "de", "ru", "id", "ja")
# Other spellings of labels, after the region is taken off.
SPELLINGS = {
    "en": "eng english", "vi": "vie vietnamese", "fr": "fra fre french", "es": "spa spanish", "pt": "por portuguese",
    "de": "deu ger german", "ru": "rus russian", "id": "ind indonesian", "ja": "jpn japanese jp",
}
# Sounds, which belong to no language.
SOUNDS = set("um umm uhm uh uhh hm hmm hmmm mm mmm er erm äh ähm öh euh heu eh ehm ah oh эээ эм ммм ừm ừmm ờm ờmm ưm えー えーと あの うーん haha".split())
#: Labelled texts of each language that the filters are fitted on, at most.
SAMPLE = 2500
#: Bloom slots, hashes of an n-gram, votes of one n-gram, and the cost of a change of language in n-grams.
SLOTS, HASHES, VOTE, SWITCH = 1 << 20, 3, 60, 0.9
#: Votes for each n-gram that a sentence of more than two must have: lists of names have hardly any, speech has more than 0.45.
DENSE = 0.3
#: A word that stands less often in the sample, and mostly with a capital, is taken for a name.
NAME = 12
_FIELD = 24
_MASK = (1 << _FIELD) - 1

_TAG = re.compile(r"\[[A-Za-z_ ]+\]|<[^<>]{1,40}>|\{F[^{}]*\}|\*[^*]{1,40}\*|https?://\S+")
_SENTENCE = re.compile(r"[^.!?。！？…\n]*(?:[.!?…]+(?=[\s\"'”’)\]]|$)[\"'”’)\]]*|[。！？]+|\n|[.!?…]+|$)")
# letters beside digits are codes, no words
_WORD = re.compile(r"[぀-ヿ㐀-鿿ー]+|(?<!\d)[^\W\d_぀-ヿ㐀-鿿ー]++(?!\d)")
_JA = re.compile(r"[぀-ヿ㐀-鿿ー]")


def label_language(label: Column) -> Column:
    """The code that a label names, null if it names no language; a code outside LANGUAGES stays itself."""
    key = F.regexp_replace(F.lower(F.trim(label)), r"[-_].*$", "")
    pairs = [F.lit(x) for code, names in SPELLINGS.items() for name in (code, *names.split()) for x in (name, code)]
    nothing = key.isin("", "unknown", "und", "none", "null", "n/a", "na", "mul", "zxx", "mis", "?", "-") | key.isNull()
    return F.when(~nothing, F.coalesce(F.element_at(F.create_map(*pairs), key), key))


def bare(word: str) -> str:
    """A word without accents."""
    return "".join(c for c in unicodedata.normalize("NFD", word.replace("đ", "d")) if not unicodedata.combining(c))


def tokens(text: str) -> list[str]:
    """The n-grams of a text: words in lower case, and pairs of Japanese characters."""
    out = []
    for w in _WORD.findall(text.lower()):
        if _JA.match(w):
            out += [w[i : i + 2] for i in range(max(1, len(w) - 1))]
        else:
            out.append(w)
    return out


def pieces_of(word: str) -> list[str]:
    padded = f"^{word}$"
    return [f"#{padded[i : i + 4]}" for i in range(len(padded) - 3)]


def clean(text: str) -> str:
    return _TAG.sub(" ", any_forms().canonical(text))


def sentences(text: str) -> list[str]:
    return [s for s in _SENTENCE.findall(text) if s.strip()]


class Filters:
    """Bit-sliced Bloom filters over the n-grams of each language."""

    def __init__(self, grams: dict[str, int]) -> None:
        """``grams``: n-gram to the bitmask of its languages."""
        self.slots = np.zeros(SLOTS, dtype=np.uint16)
        for g, mask in grams.items():
            for h in self._at(g):
                self.slots[h] |= mask
        filled = [float(((self.slots >> k) & 1).mean()) for k in range(len(LANGUAGES))]
        #: How often an n-gram of no language is taken for one, for each language.
        self.false = [p**HASHES for p in filled]
        self.memo: dict[str, int] = {}

    @staticmethod
    def _at(gram: str) -> tuple[int, ...]:
        h = xxhash.xxh3_128_intdigest(gram)
        return tuple((h >> (40 * k)) % SLOTS for k in range(HASHES))

    def languages(self, gram: str) -> int:
        """The set of languages whose filters contain an n-gram, as bits."""
        a, b, c = self._at(gram)
        return int(self.slots[a] & self.slots[b] & self.slots[c])

    @staticmethod
    def _packed(mask: int, vote: int) -> int:
        n = mask.bit_count()
        return sum((vote // n) << (_FIELD * k) for k in range(len(LANGUAGES)) if mask >> k & 1) if 0 < n <= 4 else 0

    def votes(self, word: str) -> int:
        """A word's votes, one field a language."""
        got = self.memo.get(word)
        if got is None:
            if word in SOUNDS:
                got = 0
            elif mask := self.languages(word):
                got = self._packed(mask, VOTE)
            else:
                masks = [self.languages(p) for p in pieces_of(word)]
                agreed = Counter(k for m in masks if m.bit_count() <= 2 for k in range(len(LANGUAGES)) if m >> k & 1)
                # a word in no filter counts a fifth, if two thirds of its pieces are of one language alone
                got = next((self._packed(1 << k, VOTE // 5) for k, n in agreed.most_common(1) if len(masks) > 2 and n * 3 >= len(masks) * 2), 0)
            if len(self.memo) > 400_000:
                self.memo.clear()
            self.memo[word] = got
        return got

    def evidence(self, text: str) -> tuple[list[float], int]:
        """N-grams for each language, less those expected by error, and how many n-grams there are."""
        words = tokens(text)
        memo, votes = self.memo, self.votes
        total = sum([memo[w] if w in memo else votes(w) for w in words])
        if not total or (len(words) > 2 and (sum(total >> (_FIELD * k) & _MASK for k in range(len(LANGUAGES))) < DENSE * VOTE * len(words))):
            return [], len(words)
        return [max(0.0, (total >> (_FIELD * k) & _MASK) / VOTE - self.false[k] * len(words)) for k in range(len(LANGUAGES))], len(words)

    def segments(self, parts: list[str]) -> list[tuple[str, float, int]]:
        """(language, confidence, sentences) of the longest runs of sentences in one language; [] without evidence."""
        found = [self.evidence(s) for p in parts for s in sentences(p)]
        told = [e for e, _ in found if e]
        if not told:
            return []
        n = len(LANGUAGES)
        sums = [sum(x) for x in zip(*told)]
        best = max(range(n), key=lambda k: sums[k])
        if all(e[best] >= max(e) for e in told):
            path = [best] * len(found)
        else:
            cost, back = [0.0] * n, []
            for e, _ in found:
                low = min(range(n), key=lambda k: cost[k])
                change = cost[low] + SWITCH
                step = [k if cost[k] <= change else low for k in range(n)]
                top = max(e) if e else 0.0
                cost = [min(cost[k], change) + (top - e[k] if e else 0.0) for k in range(n)]
                back.append(step)
            k = min(range(n), key=lambda k: (cost[k], -sums[k]))
            path = []
            for step in reversed(back):
                path.append(k)
                k = step[k]
            path.reverse()
        out: list[list] = []
        for k, (e, _) in zip(path, found):
            if not out or out[-1][0] != k:
                out.append([k, 0.0, 0.0, 0])
            out[-1][1] += e[k] if e else 0.0
            out[-1][2] += sum(e) if e else 0.0
            out[-1][3] += 1
        return [(LANGUAGES[k], round(mine / all_ if all_ else 0.0, 4), m) for k, mine, all_, m in out]


def fit(labelled: list[tuple[str, str]], rounds: int = 2) -> Filters:
    """Filters from (language, text) pairs, some of which may be labelled wrongly or mixed.

    After a first fit every sentence is labelled anew by the filters, which takes
    wrong labels and second languages out of the next fit.
    """
    index = {x: k for k, x in enumerate(LANGUAGES)}
    parts = [(index[lang], [tokens(s) for s in sentences(clean(text))]) for lang, text in labelled if lang in index]
    rows = [(k, s) for k, own in parts for s in own if s]
    seen, capital = Counter(), Counter()
    for _, text in labelled:
        for w in _WORD.findall(text):
            seen[w.lower()] += 1
            capital[w.lower()] += w[0].isupper()
    names = {w for w, n in seen.items() if n < NAME and capital[w] >= 0.7 * n}
    filters = None
    for turn in range(rounds + 1):
        counts: dict[str, Counter] = defaultdict(Counter)
        size = Counter()
        for k, words in rows:
            size[k] += len(words)
            for w in words:
                counts[w][k] += 1
        grams: dict[str, int] = {}
        pieces: dict[str, Counter] = defaultdict(Counter)
        for w, c in counts.items():
            share = {k: n / size[k] for k, n in c.items() if n > (1 if turn else 2)}
            if not share or w in SOUNDS or w in names:
                continue
            top = max(share.values())
            mask = sum(1 << k for k, x in share.items() if x >= top * (0.08 if turn == rounds else 0.3))
            if mask.bit_count() <= 4:
                grams[w] = grams.get(w, 0) | mask
                for p in pieces_of(w):
                    for k in range(len(LANGUAGES)):
                        if mask >> k & 1:
                            pieces[p][k] += 1
        for p, c in pieces.items():
            grams[p] = sum(1 << k for k in c)
        # Vietnamese is often written without its accents
        vi = index["vi"]
        for w in [w for w, m in grams.items() if m >> vi & 1 and not w.startswith("#")]:
            flat = bare(w)
            grams[flat] = grams.get(flat, 0) | 1 << vi
        filters = Filters(grams)
        if turn < rounds:
            again = []
            for _, words in rows:
                total = sum(map(filters.votes, words))
                fields = [total >> (_FIELD * j) & _MASK for j in range(len(LANGUAGES))]
                top = max(fields)
                if top and fields.count(top) == 1:
                    again.append((fields.index(top), words))
            rows = again
    return filters


def sample(texts: DataFrame, n: int = SAMPLE) -> list[tuple[str, str]]:
    """About ``n`` labelled texts of each language, chosen by a hash of their id and read whole: the bounded sample of the fit."""
    counts = {r["label"]: r["k"] for r in texts.where(F.col("label").isin(*LANGUAGES)).groupBy("label").agg(F.count("*").alias("k")).collect()}
    if not counts:
        return []
    share = F.element_at(F.create_map(*[F.lit(x) for code, k in counts.items() for x in (code, n / k)]), F.col("label"))
    few = texts.where(F.col("label").isin(*counts)).where(F.pmod(F.xxhash64("row_id"), F.lit(1_000_000)) < share * 1_000_000)
    return [(r["label"], r["text"]) for r in few.select("label", "text").collect()]


def language_segments(texts: DataFrame, filters: Filters, parts: str = "parts") -> DataFrame:
    """The rows of ``texts`` with ``segments``: array of (lang, confidence, sentences).

    ``parts`` is an array of strings that are read in order, each starting a new
    sentence.  Null or empty parts are skipped.  A text without evidence (no
    words, or only names, numbers and sounds) has the empty array.  Whole texts
    are read.  ``texts`` must have no column named ``segments``.
    """
    keep = [c for c in texts.columns if c != parts]
    kind = pa.list_(pa.struct([("lang", pa.string()), ("confidence", pa.float64()), ("sentences", pa.int32())]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.select(*keep).schema)

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(parts)
            out = []
            for own in batch.column(at).to_pylist():
                found = filters.segments([clean(p) for p in own or [] if p])
                out.append([{"lang": a, "confidence": b, "sentences": n} for a, b, n in found])
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in keep], pa.array(out, kind)], [*keep, "segments"])

    return texts.mapInArrow(tell, f"{schema}, segments array<struct<lang:string,confidence:double,sentences:int>>")


def corpus(spark, sf_dir: str) -> DataFrame:
    """field_name, row_id, label, parts of every dialogue and every tts_text; deliveries may repeat."""
    talks = table(spark, sf_dir, "dialogues").select(F.lit("history.content").alias("field_name"), F.col("record_id").alias("row_id"), label_language(F.col("lang_label")).alias("label"), F.transform("history", lambda x: x["content"]).alias("parts"))
    said = table(spark, sf_dir, "utterances").select(F.lit("utterance.tts_text").alias("field_name"), F.col("utterance_id").alias("row_id"), label_language(F.col("language_id")).alias("label"), F.array("tts_text").alias("parts"))
    return talks.unionByName(said)


def _segments(spark, sf_dir: str) -> DataFrame:
    """Every text with its segments.  The few repeated deliveries are told twice, which costs less than shuffling all texts to find them."""
    texts = corpus(spark, sf_dir)
    said = table(spark, sf_dir, "utterances").select(F.col("utterance_id").alias("row_id"), label_language(F.col("language_id")).alias("label"), F.col("tts_text").alias("text")).where("length(text) > 0")
    return language_segments(texts, fit(sample(said)))


@registry.query("p4_found")
def p4_found(spark, sf_dir):
    """The segments of texts whose label is missing or wrong, or that hold several languages."""
    told = _segments(spark, sf_dir).where("size(segments) > 0")
    case = told.where((F.size("segments") > 1) | F.col("label").isNull() | (F.col("label") != F.col("segments")[0]["lang"]))
    return case.select("field_name", "row_id", F.posexplode("segments").alias("seg", "s")).select("field_name", "row_id", "seg", F.col("s.lang").alias("lang")).distinct()


@registry.query("p4_languages")
def p4_languages(spark, sf_dir):
    """Every text's language and the language and confidence of its segments."""
    told = _segments(spark, sf_dir).dropDuplicates(["field_name", "row_id"])
    by = F.aggregate("segments", F.create_map().cast("map<string,int>"), lambda m, s: F.map_concat(F.map_filter(m, lambda k, _: k != s["lang"]), F.create_map(s["lang"], F.coalesce(F.element_at(m, s["lang"]), F.lit(0)) + s["sentences"])))
    main = F.array_max(F.transform(F.map_entries(by), lambda e: F.struct(e["value"].alias("n"), e["key"].alias("lang"))))["lang"]
    return told.select("field_name", "row_id", "label", main.alias("lang"), "segments")
