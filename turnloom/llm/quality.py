"""Problem 10: text statistics, and prose told from lists, tables and junk.

Every line is weighed as prose, list item, table row or noise by its characters;
running text is prose only as far as its function words and character classes
are distributed like those of prose in some language (Jensen-Shannon
divergence).  The weights make a document's structural profile, and the nearest
of four profiles, again by Jensen-Shannon divergence, is its kind.  The profiles
of languages and structures are fitted on all texts: each text is read once into
its features, which no profile bears on, and the rounds of the fit read these.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from copy import copy
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.llm.words import any_forms
from turnloom.registry import Registry
from turnloom.session import cut, few, table

registry = Registry()

KINDS = ("prose", "list", "table", "junk")
#: Structural profiles from which fitting starts: shares of prose, item, row and noise characters.
PROFILES = {"prose": (0.85, 0.09, 0.03, 0.03), "list": (0.12, 0.82, 0.03, 0.03), "table": (0.05, 0.05, 0.87, 0.03), "junk": (0.12, 0.03, 0.03, 0.82)}
#: Classes of characters, and their shares in prose of unknown language, from which fitting starts.
CLASSES = ("lower", "upper", "digit", "blank", "stop", "sign")
PROSE_CLASSES = (0.78, 0.03, 0.01, 0.16, 0.02, 0.003)
#: Divergence from every language's function words and from prose's classes beyond which running text is noise.
FAR_WORDS, FAR_CLASSES = 0.93, 0.22
#: Share of common words of two letters or more below which running text is noise.
SURE = 0.03
_EPS = 1e-6

# Markers of list items, ends of sentences, and forms of noise.
_MARKER = re.compile(r"\s*(?:[-*+•·▪◦‣–—○●□■☐☑✓✔➢→>]|\[[ xX]?\]|\(?(?:\d{1,4}|[a-zA-Z]|[ivxIVX]{1,5})[.)]|#\d+)\s+")
_STOP = re.compile(r"[.!?…:。！？][\"'”’)\]]*\s*$")
_CLUSTER = re.compile(r"[bcdfghjklmnpqrstvwxz]{4,}|^[bcdfghjklmnpqrstvwxz]{2,3}$")
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_SIGNS = re.compile(r"[\W_]+")
_JA = re.compile(r"[぀-ヿ㐀-鿿]")
_LOG = re.compile(r"^\W{0,2}(?:\d{4}[-/]\d\d?[-/]\d\d?[T ])?\d\d?:\d\d:\d\d(?:[.,]\d+)?\S*\W+(?:\[?\w*\]?\W+)?(?:TRACE|DEBUG|INFO|WARN(?:ING)?|ERROR|FATAL|CRITICAL)\b|^\W*(?:TRACE|DEBUG|INFO|WARN(?:ING)?|ERROR|FATAL|CRITICAL)\b\W|^\s*(?:at [\w.$]+\(|Traceback |File \"[^\"]+\", line \d+)")
_MARKUP = re.compile(r"</?[a-zA-Z][^<>]*>|<!--.*?-->|&(?:#?\w{1,8});|\{\{[^}]*\}\}|\{\\[a-z]+|\\begin\{|\\end\{")
_DUMP = re.compile(r"[\"'][\w. -]+[\"']\s*:|[{\[]\s*[\"'{\[]|[}\]]\s*,?\s*[{\[}\]]|\b0x[0-9a-fA-F]+\b")
_MOJIBAKE = re.compile("[ÃÂÄÅÆÐÑØÙ][\u0080-\u00bf\u0152-\u0178\u02c6\u02dc\u2013-\u2122€\u0192]|á[º»]|â€|[ã][\u0080-\u0083]|ï¿½|\ufffd|(?:=[0-9A-F]{2}){2,}|(?:%[0-9A-Fa-f]{2}){2,}|\\\\u[0-9a-fA-F]{4}|(?:\\\\x[0-9a-fA-F]{2})+|&#\\d+;|\\+A[A-Za-z0-9]{2}-")
_BLOB = re.compile(r"[A-Za-z0-9+/=_-]{40,}")
_FRAME = re.compile(r"^[\s\-+|=:_.]*$")
_SPLITTERS = [("\t", re.compile(r"\t")), ("|", re.compile(r"\|")), (";", re.compile(r";")), ("  ", re.compile(r"(?<=\S)\s{2,}(?=\S)")), (",", re.compile(r",")), (":", re.compile(r"\s*(?::|=>?)\s*"))]
#: Separators of inline items, each with the signs of which one stands in it.
_INLINE = [(a, re.compile(b)) for a, b in (("|", r"\s\|\s"), (";", r";\s"), ("•·▪*/-", r"\s[•·▪*/-]\s"), (",", r",\s"), ("、", r"、"), ("\t", r"\t"), (".)", r"\s(?:\(?\d{1,3}[.)])\s"))]
_INNER_STOP = re.compile(r"[.!?]\s")
_LINE_END = re.compile(r"\r\n|[\n\r\x0b\x0c\x85\u2028\u2029]")
_LEVEL = re.compile(r"TRACE|DEBUG|INFO|WARN|ERROR|FATAL|CRITICAL|^\s*(?:at |Traceback|File \")", re.M)
_CONTROL = re.compile(r"\[[A-Z_]{3,}\]")


def divergence(p, q) -> float:
    """The Jensen-Shannon divergence of two distributions, in bits."""
    out = 0.0
    for a, b in zip(p, q):
        m = (a + b) / 2
        out += (a * math.log2(a / m) if a > 0 else 0.0) + (b * math.log2(b / m) if b > 0 else 0.0)
    return max(0.0, out / 2)


def divergences(p: np.ndarray, q) -> np.ndarray:
    """The divergence of each row of ``p`` from ``q``."""
    q = np.asarray(q, dtype=float)
    m = (p + q) / 2
    sides = (np.where(x > 0, x * np.log2(np.where(x > 0, x, 1.0) / np.where(m > 0, m, 1.0)), 0.0) for x in (p, np.broadcast_to(q, p.shape)))
    return np.maximum(0.0, sum(x.sum(axis=1) for x in sides) / 2)


def bare(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", word.lower().replace("đ", "d")) if not unicodedata.combining(c))


class Profiles:
    """Function words of each language, by rank."""

    def __init__(self, common: list[tuple[str, int, str]]) -> None:
        self.by_word: dict[str, list[tuple[str, float]]] = {}
        japanese = sorted({w for lang, _, w in common if lang == "ja"}, key=len, reverse=True)
        #: Words of Japanese, which has no blanks: the common words, and else single characters.
        self.pieces = re.compile("|".join([*map(re.escape, japanese), "."]))
        self.structures, self.classes, self.others = dict(PROFILES), [PROSE_CLASSES], 0.55
        self.far_words, self.far_classes = FAR_WORDS, FAR_CLASSES
        langs = sorted({x for x, _, _ in common})
        self.weights: dict[str, dict[str, float]] = {}
        for lang in langs:
            ranked = {w.lower(): 1 / (rank + 1) for x, rank, w in common if x == lang and w}
            total = sum(ranked.values())
            self.weights[lang] = {w: v / total for w, v in ranked.items()}
            for w, v in self.weights[lang].items():
                for form in {w, bare(w)}:
                    self.by_word.setdefault(form, []).append((lang, v))
        self.langs = langs
        #: The number of each form; the kinds of function word, which are (place of the language, share), and those that a form can be.
        self.forms = {w: i for i, w in enumerate(sorted(self.by_word))}
        kinds = sorted({(langs.index(x), v) for own in self.by_word.values() for x, v in own})
        number = {k: i for i, k in enumerate(kinds)}
        own = [sorted({number[langs.index(x), v] for x, v in self.by_word[w]}) for w in self.forms]
        self.lang_of, self.share_of = np.array([x for x, _ in kinds], dtype=np.int64), np.array([v for _, v in kinds])
        self.can_be, self.how_many = np.array([k for x in own for k in x], dtype=np.int64), np.array([len(x) for x in own], dtype=np.int64)

    def apart(self, classes: np.ndarray) -> np.ndarray:
        """The least divergence of each row of character classes from a language's prose."""
        return np.min([divergences(classes, own) for own in self.classes], axis=0)

    def words(self, n_words: np.ndarray, text: np.ndarray, form: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least divergence from a language's function words, that language's place or -1) of each text, whose ``form`` stands ``count`` times in ``text``."""
        n_langs, n_kinds = len(self.langs), len(self.share_of)
        if not len(form):
            return np.ones(len(n_words)), np.full(len(n_words), -1)
        many = self.how_many[form]
        begin = (np.cumsum(self.how_many) - self.how_many)[form]
        kind = self.can_be[np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(many.sum())]
        # forms of one word count together
        key, at = np.unique(np.repeat(text, many) * n_kinds + kind, return_inverse=True)
        n = np.bincount(at, weights=np.repeat(count, many))
        text, kind = key // n_kinds, key % n_kinds
        # the distribution over the language's function words and all other words, against its prose's
        a, b = n / n_words[text], (1 - self.others) * self.share_of[kind]
        m, cell, size = (a + b) / 2, text * n_langs + self.lang_of[kind], len(n_words) * n_langs
        apart, hit, met = (np.bincount(cell, weights=x, minlength=size).reshape(-1, n_langs) for x in (a * np.log2(a / m) + b * np.log2(b / m), n, b))
        other = np.maximum(0.0, 1 - hit / np.maximum(n_words, 1)[:, None])
        m = (other + self.others) / 2
        # a word that doesn't stand adds its whole share
        apart += np.where(other > 0, other * np.log2(np.where(other > 0, other, 1.0) / m), 0.0) + self.others * np.log2(self.others / m) + np.maximum(0.0, 1 - self.others - met)
        apart = np.where(hit > 0, np.maximum(0.0, apart / 2), 1.0)
        best = apart.argmin(axis=1)
        far = apart[np.arange(len(best)), best]
        return far, np.where(far < 1.0, best, -1)


@cache
def _class(ch: str) -> int:
    """The place of a character's class in CLASSES."""
    if ch.isspace():
        return 3
    if ch.isdigit():
        return 2
    if ch.isalpha() or unicodedata.category(ch)[0] == "M":
        return 1 if ch.isupper() else 0
    return 4 if ch in ".,!?'…。、！？’" else 5


#: Signs that encoded characters begin with; letters that wrongly decoded ones begin with.
_ENCODED, _LEADS = frozenset("=%\\&+\ufffd"), frozenset("ÃÂÄÅÆÐÑØÙáâãï")


@cache
def _trail(ch: str) -> bool:
    """Whether a character can be the second of a wrongly decoded one."""
    return "\x80" <= ch <= "\xbf" or "\u0152" <= ch <= "\u0178" or "\u2013" <= ch <= "\u2122" or ch in "\u02c6\u02dc€ƒ"


@cache
def _sign(ch: str) -> bool:
    return not (ch.isspace() or ch.isalnum() or unicodedata.category(ch)[0] == "M")


def char_classes(chars: dict[str, int]) -> list[int]:
    """How many characters of each of CLASSES stand, from how often each character stands."""
    n = [0] * len(CLASSES)
    for ch, k in chars.items():
        n[_class(ch)] += k
    return n


def _rows(lines: list[str]) -> list[bool]:
    """Which lines are rows of the same columns, in whatever layout."""
    best = [False] * len(lines)
    for sign, pattern in _SPLITTERS:
        mark = "" if sign in "  :" else sign
        least = max(3, 0.6 * len(lines)) if sign in ",:" else 3
        if mark and sum(mark in x for x in lines) < least:
            continue
        stripped = [x.strip().strip("|") if sign == "|" else x.strip() for x in lines]
        cells = [[c.strip() for c in (x.split(mark) if mark else pattern.split(x))] for x in stripped]
        sizes = Counter(len(c) for c in cells if len(c) > (2 if sign in ",;" else 1))
        if not sizes:
            continue
        width, n = sizes.most_common(1)[0]
        if n < 3 or (sign in ",:" and n < 0.6 * len(lines)):
            continue
        ok = []
        for x, c in zip(lines, cells):
            short = len(c) == width and sum(len(y) <= 40 and len(y.split()) <= 5 for y in c) >= 0.9 * len(c)
            if short and sign in ",:;":
                short = not _STOP.search(x)
            if short and sign == ":":
                short = len(c[0].split()) <= 2 and len(c[-1].split()) <= 4 and not _MARKER.match(x)
            ok.append(short or (sign in "|" and bool(_FRAME.match(x))) or (sign == "  " and bool(_FRAME.match(x))))
        # columns hold the same sort of thing: numbers, codes or short names from row to row
        if sign == ":":
            keys = Counter(c[0] for c, o in zip(cells, ok) if o and len(c) == width)
            if not keys or sum(n for n in keys.values() if n > 1) < 0.7 * sum(keys.values()):
                continue
        if sum(ok) > sum(best):
            best = ok
    return best


def _inline_list(line: str) -> bool:
    """Short items one after another on one line."""
    for marks, sign in _INLINE:
        if sum(map(line.count, marks)) < 4:
            continue
        items = [x.strip() for x in sign.split(line)]
        if len(items) >= 5 and sum(0 < len(x) <= 60 and len(x.split()) <= 7 and not _INNER_STOP.search(x) for x in items) >= 0.9 * len(items) and sum(len(x.split()) for x in items) <= 5 * len(items):
            return True
    return False


def _loops(words: list[str], text: str) -> bool:
    """Whether a text says the same again and again."""
    if len(words) >= 16:
        distinct, runs = len(set(words)), len(words) - 7
        # every word begins a run but the last seven
        if distinct > 2 and distinct - 7 >= 0.3 * runs:
            return False
        return distinct <= 2 or len({hash(tuple(words[i : i + 8])) for i in range(runs)}) < 0.3 * runs
    raw = text.encode("utf-8", "replace")
    return (len(text) >= 60 and len(zlib.compress(raw, 6)) < 0.15 * len(raw)) or (len(text) >= 30 and len(set(text)) <= 3)


def features(text: str, profiles: Profiles) -> dict:
    """What is known of one text before any profile is held against it; ``text`` is neither null nor blank."""
    lines = [x for x in (_LINE_END.split(text) if {"\x1c", "\x1d", "\x1e"} & set(text) else text.splitlines()) if x.strip()]
    spoken = any_forms().canonical(text)
    control = "[" in spoken and bool(_CONTROL.search(spoken))
    if control:
        spoken = _CONTROL.sub(" ", spoken)
    chars = Counter(text)
    n_solid = sum(k for c, k in chars.items() if _class(c) != 3)
    ja = not text.isascii() and sum(k for c, k in chars.items() if _JA.match(c)) > 0.25 * max(1, n_solid)
    words = tokens = _WORD.findall(spoken.lower())
    if ja:
        words = []
        for t in tokens:
            words += profiles.pieces.findall(t) if _JA.search(t) else [t]
    n_words = len(words)
    hits = [(w, n) for w, n in Counter(words).items() if w in profiles.forms]
    share = sum(n for _, n in hits) / n_words if n_words else 0.0
    sure = sum(n for w, n in hits if len(w) > 1 or w > "\u2fff") / n_words if n_words else 0.0
    classes = char_classes(chars if spoken is text else Counter(spoken))
    signs = sum(k for c, k in chars.items() if _sign(c))

    # what a text doesn't hold at all needn't be looked for in its lines
    has = chars.keys()
    markup = bool({"<", "&", "{", "\\"} & has)
    mojibake = bool(_ENCODED & has) or (not _LEADS.isdisjoint(has) and any(map(_trail, has)))
    blob = max(map(len, text.split()), default=0) >= 40
    dump = bool({'"', "'", "{", "}", "[", "]"} & has) or "0x" in text
    log = bool(_LEVEL.search(text))
    is_row = _rows(lines) if len(lines) >= 3 else [False] * len(lines)
    rows = any(is_row)
    weights = dict.fromkeys(KINDS, 0)
    for i, x in enumerate(lines):
        size = len(x.strip())
        noise = (sum(map(len, _MARKUP.findall(x))) if markup else 0) + (4 * len(_MOJIBAKE.findall(x)) if mojibake else 0) + (sum(map(len, _BLOB.findall(x))) if blob else 0)
        # pieces of data: keys, brackets and hex numbers
        data = sum(map(len, found)) + sum(map(x.count, "{}[]\":")) if dump and (found := _DUMP.findall(x)) else 0
        if noise > 0.3 * size or (data > 0.25 * size and not (control and _CONTROL.search(x))) or (log and _LOG.search(x)):
            weights["junk"] += size
            continue
        if is_row[i]:
            weights["table"] += size
            continue
        n, stop = len(x.split()), bool(_STOP.search(x))
        if size >= 5 and len(_SIGNS.sub("", x)) < 0.3 * size and not (rows and _FRAME.match(x)):
            weights["junk"] += size
        elif n <= 16 and size <= 120 and (not stop or n <= 4) and _MARKER.match(x):
            weights["list"] += size
        elif not stop and n <= 10 and size <= 80 and not ja:
            near = len(lines) >= 4 and any(y is not x and len(y.split()) <= 10 and not _STOP.search(y) for y in lines[max(0, i - 1) : i + 2])
            weights["list" if near else "prose"] += size
        elif ja and not stop and size <= 25 and len(lines) >= 4:
            weights["list"] += size
        elif _inline_list(x):
            weights["list"] += size
        else:
            weights["prose"] += size
    total = sum(weights.values()) or 1.0
    # a text of lists is short of function words, so only running text is held to them
    running = n_words >= 10 and weights["prose"] > 0 and weights["list"] + weights["table"] < 0.5 * total
    return {
        "n_words": n_words,
        "mean_word_len": sum(map(len, words)) / n_words if n_words else 0.0,
        "symbol_ratio": signs / n_solid if n_solid else 0.0,
        "punct_line_share": sum(bool(_STOP.search(x)) for x in lines) / len(lines) if lines else 0.0,
        "common_word_share": share,
        "weights": [weights[k] for k in KINDS],
        "classes": classes,
        "forms": [profiles.forms[w] for w, _ in hits],
        "counts": [n for _, n in hits],
        "ja": ja,
        "loops": weights["table"] < 0.5 * total and _loops(words, text),
        "running": running,
        "odd": running and (sure < SURE or (sure < 3 * SURE and sum(bool(_CLUSTER.search(w)) for w in words) > 0.15 * n_words)),
    }


STATS = "n_words int, mean_word_len double, symbol_ratio double, punct_line_share double, common_word_share double, word_divergence double, class_divergence double, common_lang string, kind string"
#: A blank text has no weights.
FEATURES = "n_words int, mean_word_len double, symbol_ratio double, punct_line_share double, common_word_share double, weights array<int>, classes array<int>, forms array<int>, counts array<int>, ja boolean, loops boolean, running boolean, odd boolean"
_ARROW = {"int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32())}
_BLANK = {"n_words": 0, "mean_word_len": 0.0, "symbol_ratio": 0.0, "punct_line_share": 0.0, "common_word_share": 0.0, "weights": [], "classes": [], "forms": [], "counts": [], "ja": False, "loops": False, "running": False, "odd": False}


def _fields(ddl: str) -> list[tuple[str, pa.DataType]]:
    return [(x.split()[0], _ARROW[x.split()[1]]) for x in ddl.split(", ")]


def read(texts: list[str | None], profiles: Profiles) -> pa.Table:
    """The features of texts."""
    rows = [features(t, profiles) if t and t.strip() else _BLANK for t in texts]
    return pa.table({n: pa.array([r[n] for r in rows], k) for n, k in _fields(FEATURES)})


def judge(read: pa.Table | pa.RecordBatch, profiles: Profiles) -> dict[str, np.ndarray]:
    """From features, each text's divergences, places of its language in ``profiles.langs`` and of its kind in KINDS (-1: none), and structure and character classes in shares."""

    def values(name: str) -> np.ndarray:
        return read.column(name).to_numpy(zero_copy_only=False) if isinstance(read, pa.RecordBatch) else read.column(name).to_numpy()

    def flat(name: str) -> tuple[np.ndarray, np.ndarray]:
        c = read.column(name)
        c = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
        return c.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.diff(c.offsets.to_numpy())

    n_words, share = values("n_words").astype(np.int64), values("common_word_share")
    ja, loops, running, odd = (values(x).astype(bool) for x in ("ja", "loops", "running", "odd"))
    given, sizes = flat("weights")
    there = sizes > 0
    weights, classes = np.zeros((len(there), len(KINDS))), np.zeros((len(there), len(CLASSES)))
    weights[there], classes[there] = given.reshape(-1, len(KINDS)), flat("classes")[0].reshape(-1, len(CLASSES))
    (form, many), (count, _) = flat("forms"), flat("counts")
    far, lang = profiles.words(n_words, np.repeat(np.arange(len(many)), many), form, count)
    total = weights.sum(axis=1)
    total[total == 0] = 1.0
    classes /= np.maximum(1.0, classes.sum(axis=1))[:, None]
    apart = profiles.apart(classes)
    prose, junk = KINDS.index("prose"), KINDS.index("junk")
    # running text that isn't distributed like prose, or says the same for ever, is noise
    unlike = (running & (odd | (far > profiles.far_words))) | (n_words == 0) | ((apart > profiles.far_classes) & (share < 0.1) & ~ja & (weights[:, prose] > 0.5 * total))
    weights[unlike, junk] += weights[unlike, prose]
    weights[unlike, prose] = 0.0
    weights[loops] = 0.0
    weights[loops, junk] = total[loops]
    shares = weights / total[:, None]
    kind = np.argmin([divergences(shares, profiles.structures[k]) for k in KINDS], axis=0)
    return {"word_divergence": far, "class_divergence": np.where(there, apart, 0.0 + ~there), "lang": lang, "kind": np.where(there, kind, -1), "shares": shares, "classes": classes}


def weigh(text: str, profiles: Profiles) -> dict:
    """The statistics of one text and its kind; ``text`` is neither null nor blank."""
    return _stated(read([text], profiles), profiles).to_pylist()[0]


def _stated(read: pa.Table | pa.RecordBatch, profiles: Profiles) -> pa.Table:
    """STATS from features."""
    told = judge(read, profiles)
    names = np.array([*profiles.langs, None], dtype=object), np.array([*KINDS, None], dtype=object)
    own = {"word_divergence": told["word_divergence"], "class_divergence": told["class_divergence"], "common_lang": names[0][told["lang"]], "kind": names[1][told["kind"]]}
    return pa.table({n: pa.array(own[n], k) if n in own else read.column(n) for n, k in _fields(STATS)})


def text_stats(docs: DataFrame, common: list[tuple[str, int, str]], doc_id: str = "doc_id", text: str = "text", fit: bool = False) -> DataFrame:
    """(doc_id, the statistics, kind) of every row of ``docs``.

    Words are runs of letters and digits, in Japanese the common words and else
    single characters.  A null, empty or blank text has 0 words, zeros and the kind
    null.  ``common`` are (lang, rank, word); with ``fit`` profiles are fitted on all
    of ``docs``, else they stay as they begin.  Whole texts are read; other columns
    don't matter.
    """
    profiles = Profiles(common)
    id_type = docs.schema[doc_id].dataType.simpleString()

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = read(batch.column(1).to_pylist(), profiles).combine_chunks()
            yield pa.RecordBatch.from_arrays([batch.column(0), *[c.combine_chunks() for c in rows.columns]], [doc_id, *rows.column_names])

    found = docs.select(doc_id, text).mapInArrow(known, f"`{doc_id}` {id_type}, {FEATURES}")
    if fit:
        found = cut(found)
        own = fitted_on(found, profiles)
    else:
        own = profiles

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _stated(batch, own)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[c.combine_chunks() for c in rows.columns]], [doc_id, *rows.column_names])

    return found.mapInArrow(tell, f"`{doc_id}` {id_type}, {STATS}")


#: Shares are summed as whole numbers of this fraction, so that sums don't depend on their order.
_UNIT = 1 << 32


def gathered(read: pa.Table | pa.RecordBatch, profiles: Profiles) -> dict[tuple[str, int], tuple[int, int]]:
    """(texts, sum in units) by what is fitted and place: the structure of each kind, the character classes of each language's prose, the share of common words in prose."""
    told, n_words, share = judge(read, profiles), np.asarray(read.column("n_words")), np.asarray(read.column("common_word_share"))
    prose = (told["kind"] == KINDS.index("prose")) & (n_words >= 20)
    parts = [(f"kind {k}", told["kind"] == i, told["shares"]) for i, k in enumerate(KINDS)]
    parts += [(f"lang {x}", prose & (told["lang"] == i), told["classes"]) for i, x in enumerate(profiles.langs)]
    parts += [("common", prose, share[:, None])]
    return {(name, i): (int(rows.sum()), int(np.rint(of[rows, i] * _UNIT).astype(np.int64).sum())) for name, rows, of in parts if rows.any() for i in range(of.shape[1])}


def refitted(profiles: Profiles, sums: dict[tuple[str, int], tuple[int, int]], least: int) -> Profiles:
    """``profiles`` with the means of ``sums``; what has fewer than ``least`` texts stays as it is."""

    def mean(name: str, size: int) -> tuple[float, ...] | None:
        return tuple(sums[name, i][1] / (sums[name, i][0] * _UNIT) for i in range(size)) if sums.get((name, 0), (0, 0))[0] >= least else None

    for k in KINDS:
        profiles.structures[k] = mean(f"kind {k}", len(KINDS)) or profiles.structures[k]
    profiles.classes = [c for x in profiles.langs if (c := mean(f"lang {x}", len(CLASSES)))] or profiles.classes
    if common := mean("common", 1):
        profiles.others = 1 - common[0]
    return profiles


def fitted(profiles: Profiles, texts: list[str | None], rounds: int = 2, least: int = 20) -> Profiles:
    """``profiles`` with the structural profiles, the character classes of each language's prose and the share of its words that are no function words as they are in ``texts``.

    Each round weighs the texts by the profiles so far and takes the mean of what
    it told; kinds and languages of fewer than ``least`` texts keep their profile.
    """
    rows = read(texts, profiles)
    for _ in range(rounds if texts else 0):
        refitted(profiles, gathered(rows, profiles), least)
    return profiles


def fitted_on(found: DataFrame, profiles: Profiles, rounds: int = 2, least: int = 20) -> Profiles:
    """The same as ``fitted``, on all texts whose features are in ``found``."""
    own = copy(profiles)
    own.structures = dict(profiles.structures)
    for _ in range(rounds):

        def sums(batches: Iterator[pa.RecordBatch], own: Profiles = own) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows and (of := gathered(batch, own)):
                    names, places = zip(*of)
                    n, total = zip(*of.values())
                    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(places, pa.int32()), pa.array(n, pa.int64()), pa.array(total, pa.int64())], ["name", "place", "n", "total"])

        rows = found.drop(found.columns[0]).mapInArrow(sums, "name string, place int, n bigint, total bigint")
        # a row for each kind or language and place, whatever the texts
        rows = rows.groupBy("name", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(20,0)")).alias("total"))
        refitted(own, {(r["name"], r["place"]): (r["n"], int(r["total"])) for r in few(rows, 100_000, "means of profiles")}, least)
    return own


def _stats(spark, sf_dir: str) -> DataFrame:
    # a small fixed table: the most common words of each language
    common = [(r["lang"], r["freq_no"], r["word"]) for r in few(table(spark, sf_dir, "common_words"), 100_000, "common words")]
    docs = table(spark, sf_dir, "documents")
    return text_stats(docs, common, fit=True)


@registry.query("p10_found")
def p10_found(spark, sf_dir):
    """The documents that are not mainly natural prose."""
    return _stats(spark, sf_dir).where("kind != 'prose'").select("doc_id", "kind")


@registry.query("p10_stats")
def p10_stats(spark, sf_dir):
    """Every document's statistics and kind."""
    return _stats(spark, sf_dir)
