"""Look-alike classes of characters and the rewriting of texts to one form.

Classes come from a union-find over strings and code points: a composed letter
and its spelled-out sequences, a character and its other width, a ligature and
its letters, all blanks, all invisible marks, and letters of different scripts
that look alike.  Each class is represented by its most frequent plain member
(per script, where it spans scripts).  Texts are rewritten greedily, longest
match first, by an Aho-Corasick automaton over all other members; letters that
look alike across scripts are then settled word by word.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from functools import cache
from itertools import permutations

import ahocorasick
import regex

# Letters that look alike, Latin first, then Cyrillic and Greek; '-' where a script has none.
LOOKALIKES = """
a а -
c с -
d ԁ -
e е -
h һ -
i і -
j ј -
o о ο
p р ρ
q ԛ -
s ѕ -
v ѵ ν
w ԝ -
x х -
y у -
A А Α
B В Β
C С -
E Е Ε
H Н Η
I І Ι
J Ј -
K К Κ
M М Μ
N - Ν
O О Ο
P Р Ρ
S Ѕ -
T Т Τ
X Х Χ
Y У Υ
Z - Ζ
ï ї -
ë ё -
"""
# Letters of one script that look alike; the first is the usual one.
TWINS = ["đð", "ĐÐƉ", "iı", "aɑ", "gɡ", "oօ", "lӏ"]
# Invisible characters besides category Cf.
HIDDEN = "͏ᅟᅠ឴឵ㅤﾠ⠀"

SCRIPTS = ("Latin", "Cyrillic", "Greek")
_SCRIPT = {s: regex.compile(rf"\p{{{s}}}") for s in SCRIPTS}
_WORD = regex.compile(r"[\p{Latin}\p{Cyrillic}\p{Greek}][\p{Latin}\p{Cyrillic}\p{Greek}\p{M}]*")
_EMOJI = regex.compile(r"\p{Extended_Pictographic}")


@cache
def script_of(ch: str) -> str | None:
    """Latin, Cyrillic, Greek or None."""
    if ch.isascii():
        return "Latin" if ch.isalpha() else None
    return next((s for s in SCRIPTS if _SCRIPT[s].match(ch)), None)


class Classes:
    """A union-find over strings."""

    def __init__(self) -> None:
        self.parent: dict[str, str] = {}

    def find(self, x: str) -> str:
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def union(self, a: str, b: str) -> None:
        self.parent[self.find(b)] = self.find(a)

    def members(self) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for x in self.parent:
            out.setdefault(self.find(x), []).append(x)
        return out


MARKS = frozenset(chr(p) for p in range(0x300, 0x20000) if unicodedata.category(chr(p))[0] == "M")


def invisible(ch: str) -> bool:
    """Format characters and fillers; controls other than tab and line ends."""
    kind = unicodedata.category(ch)
    return kind == "Cf" or ch in HIDDEN or (kind == "Cc" and ch not in "\t\n\r\x0b\x0c\x85")


def plain_of(ch: str) -> str | None:
    """The plain string that a single character stands for, None if it is plain itself."""
    if ch == " " or ch.isascii() and ch.isprintable():
        return None
    if invisible(ch):
        return ""
    if unicodedata.category(ch) == "Zs":
        return " "
    canonical = unicodedata.normalize("NFC", ch)
    if canonical != ch:
        return canonical
    tag, _, _ = unicodedata.decomposition(ch).partition(" ")
    joined = 0xFB00 <= ord(ch) <= 0xFB17 or 0x2160 <= ord(ch) <= 0x217F or 0x01C4 <= ord(ch) <= 0x01CC or ch in "ĳĲ"
    if tag in ("<wide>", "<narrow>") or (tag == "<font>" and ord(ch) > 0xFFFF) or (tag == "<compat>" and joined):
        flat = unicodedata.normalize("NFKC", ch)
        return flat if flat != ch else None
    return None


def spelled_out(ch: str) -> list[str]:
    """All sequences of a base and marks that compose to ``ch``."""
    full = unicodedata.normalize("NFD", ch)
    if len(full) == 1 or len(full) > 4 or unicodedata.combining(full[0]):
        return []
    base, marks = full[0], full[1:]
    out = set()
    for order in permutations(marks):
        for k in range(len(order)):
            head = unicodedata.normalize("NFC", base + "".join(order[:k]))
            seq = head + "".join(order[k:])
            if unicodedata.normalize("NFC", seq) == ch and seq != ch:
                out.add(seq)
    return sorted(out)


class Forms:
    """The classes and automaton for a corpus in which the code points ``seen`` occur so often; None stands for any corpus."""

    def __init__(self, seen: dict[int, int] | None = None) -> None:
        counts = Counter(seen or {})
        points = sorted(seen) if seen is not None else [*range(0x20, 0x3000), *range(0x3000, 0x3100), *range(0xF900, 0xFB18), *range(0xFE00, 0x10000), *range(0x1D400, 0x1D800)]
        classes = Classes()
        for p in points:
            if 0xD800 <= p < 0xE000:
                continue
            ch = chr(p)
            if (plain := plain_of(ch)) is not None:
                classes.union(plain, ch)
        # compositions: every letter that the corpus' bases and marks can make
        for p in [*range(0xC0, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000), *range(0x304B, 0x30FF)]:
            for seq in spelled_out(chr(p)):
                classes.union(chr(p), seq)
        # letters of different scripts that look alike, and letters of one script
        of_script: dict[str, str] = {}
        for line in LOOKALIKES.split("\n"):
            row = [x for x in line.split() if x != "-"]
            for x in row[1:]:
                classes.union(row[0], x)
        for twins in TWINS:
            usual = max(twins, key=lambda x: (counts[ord(x)], -twins.index(x)))
            for x in twins:
                if counts[ord(usual)] or seen is None:
                    classes.union(usual, x)
                    of_script[x] = script_of(twins[0])

        def script(x: str) -> str | None:
            return of_script.get(x) or (script_of(x[0]) if x else None)

        self.rewrite: dict[str, str] = {}
        #: A letter's representatives in the scripts in which its class has one.
        self.across: dict[str, dict[str, str]] = {}
        for members in classes.members().values():
            plain = [x for x in members if x in ("", " ") or (len(x) == 1 and plain_of(x) is None)] or [x for x in members if all(plain_of(c) is None for c in x)]
            if not plain:
                continue
            # the most frequent plain member of each script, and of all for what belongs to none
            best = lambda own: max(own, key=lambda x: (counts[ord(x)] if len(x) == 1 else 0, x == classes.find(x), x.isascii()))
            reps = {k: best([x for x in plain if script(x) == k]) for k in {script(x) for x in plain}}
            any_rep = best(plain)
            for x in members:
                rep = reps.get(script(x), any_rep)
                if x != rep and x not in ("", " "):
                    self.rewrite[x] = rep
            told = {k: x for k, x in reps.items() if k}
            if len(told) > 1:
                for x in plain:
                    self.across[x] = told
        letters = Counter()
        for ch in self.across:
            letters[script_of(ch)] += counts[ord(ch)]
        #: Look-alikes in use in their script: a word wholly of another script is only read as such letters.
        self.usual = {ch for ch in self.across if seen is None or counts[ord(ch)] * 1000 > letters[script_of(ch)]} | {ch for ch in self.across if ch.isascii()}
        #: For each script, the automaton that writes a word in it.
        self.into = {}
        for s in SCRIPTS:
            self.into[s] = ahocorasick.Automaton()
            for ch, told in self.across.items():
                if s in told and script_of(ch) != s:
                    self.into[s].add_word(ch, ch)
            self.into[s].make_automaton()
        self._known: dict[str, tuple[Counter, set[str]]] = {}
        self.automaton = ahocorasick.Automaton()
        for x in self.rewrite:
            self.automaton.add_word(x, x)
        self.automaton.make_automaton()
        singles = sorted(x for x in self.rewrite if len(x) == 1)
        self._suspect = MARKS.union(singles)

    def _told(self, word: str) -> tuple[Counter, set[str]]:
        """How many letters of each script a word has, and the scripts it can be written in."""
        got = self._known.get(word)
        if got is None:
            own, can = Counter(), set(SCRIPTS)
            for ch in word:
                if s := script_of(ch):
                    own[s] += 1
                    can &= {s, *self.across.get(ch, ())}
            if len(self._known) > 200_000:
                self._known.clear()
            got = self._known[word] = (own, can)
        return got

    def _written(self, word: str, script: str) -> str:
        """A word rewritten greedily in a script."""
        out, at = [], 0
        for end, ch in self.into[script].iter_long(word):
            out += [word[at : end + 1 - len(ch)], self.across[ch][script]]
            at = end + 1
        return "".join([*out, word[at:]])

    def _settle(self, text: str) -> str:
        """Letters of another script that look like their word's own."""
        words = [(m.start(), m.end(), m.group()) for m in _WORD.finditer(text)]
        told = [self._told(w) for _, _, w in words]
        if len({s for own, _ in told for s in own}) < 2:
            return text
        # letters of the words that can only be of one script
        whole = Counter()
        for own, can in told:
            if len(own) == 1 and len(can) == 1:
                for s, n in own.items():
                    whole[s] += n
        # the script of the words that can only be of one, place by place
        sure = [next(iter(can)) if len(can) == 1 else None for _, can in told]
        out, at = [], 0
        for k, (a, b, w) in enumerate(words):
            own, can = told[k]
            if len(own) == 1 and len(can) == 1:
                continue
            to = None
            if len(own) > 1:
                if can:
                    to = max(can, key=lambda s: (own[s], whole[s], s))
            elif len(can) > 1:
                near = sure[max(0, k - 3) : k + 4]
                mine = next(iter(own))
                other = max(can - {mine}, key=lambda s: (near.count(s), s))
                if near.count(other) > near.count(mine) and whole[other] > whole[mine] and all(self.across[ch][other] in self.usual for ch in w if ch in self.across):
                    to = other
            if to:
                out += [text[at:a], self._written(w, to)]
                at = b
        return "".join([*out, text[at:]]) if out else text

    def canonical(self, text: str) -> str:
        """``text`` with every class member replaced by its representative."""
        if text.isascii() and text.isprintable():
            return text
        chars = set(text)
        if not chars.isdisjoint(self._suspect):
            out, at = [], 0
            for end, x in self.automaton.iter_long(text):
                start = end + 1 - len(x)
                if x in "‍︎️" and start and (_EMOJI.match(text[start - 1]) and not text[start - 1].isalnum()):
                    continue  # part of an emoji
                out += [text[at:start], self.rewrite[x]]
                at = end + 1
            text = unicodedata.normalize("NFC", "".join([*out, text[at:]]))
            chars = set(text)
        return self._settle(text) if len({script_of(c) for c in chars} - {None}) > 1 else text
