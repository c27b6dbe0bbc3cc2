"""Sentence boundaries across languages and scripts.

Every line is a unit of its own or several: line breaks are boundaries, and
within a line each mark that may end a sentence is a candidate, unless a pair of
quotation marks or brackets closes behind it. A blank between two Thai letters is a boundary.
Every other candidate is classified by a maximum-entropy model over the neighbouring
tokens, their case, length, digits and script, over whether a blank, lower case,
a separator or a dash follows, and over how often the whole
corpus has the token before the mark at the end of a line and the token behind
it at the start of one. The model learns from reliable candidates: those at line
ends are boundaries; those before lower case, a separator, a dash or no blank, and
those behind tokens that never end a line, are none. Statistics come from all documents, the
model from a bounded sample of them.

Defined results for dirty input: NULL, empty and blank texts have no units;
repeated documents come out each; positions are code points of the text as
stored; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settled, spread_out

_BREAKS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
_LINE = re.compile(f"[^{_BREAKS}]+")
#: Marks that may end a sentence, in all scripts; the Greek question mark looks like a semicolon.
_MARKS = ".!?…。．｡！？।॥؟۔;"
_MARK = re.compile(rf"[{_MARKS}]+(?:[   ]?[!?]+)*|(?<=[Ͱ-Ͽἀ-῿]);")
_THAI = re.compile("(?<=[ก-ฺเ-๎])[  　\t]+(?=[ก-ฺเ-๎])")
_IN_THAI = re.compile("[\u0e01-\u0e4e][ \u00a0\u3000\t]")
_ANY = re.compile(rf"[{_MARKS};]|[ก-๎][  　\t]")
#: Brackets and quotation marks.
_PAIRS = {")": "(", "]": "[", "}": "{", "）": "（", "】": "【", "》": "《", "〉": "〈", "」": "「", "』": "『", "›": "‹"}
_QUOTES = re.compile(r"[()\[\]{}（）【】《》〈〉「」『』‹›\"“”„«»‘’‚]")
_OPENERS = "([{（【《〈「『‹\"“„«»‘‚¿¡'"
_SEPARATORS = "|·•»›>/\\*,;:=+&%)]}”’"
_DASHES = "-–—―"
_DIGITS = re.compile(r"\d+")
_MARKER = re.compile(r"[\s(\[•*·-]*(?:\d{1,3}(?:\.\d{1,3})*|[A-Za-z]|[ivxIVX]{1,4})\Z")
_STRIP = "\"'“”„«»‘’‚()[]{}¿¡「『（-–—"

#: Characters before a mark, and behind it, in which the neighbouring tokens are sought: a longer token counts by its part in them.
BEFORE, BEHIND = 40, 80

#: Hashed statistics and weights have this many slots each, so they stay the same size for any corpus.
SLOTS = 1 << 17
_MASK = SLOTS - 1


def _matched(line: str) -> list[tuple[int, int]]:
    """Outermost and inner (open, close) positions of matched pairs, sorted; marks without a partner count for nothing."""
    stack: list[tuple[str, int]] = []
    spans: list[tuple[int, int]] = []

    def close(*openers: str) -> bool:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in openers:
                spans.append((stack[k][1], at))
                del stack[k:]
                return True
        return False

    n = len(line)
    for m in _QUOTES.finditer(line):
        c, at = m.group(), m.start()
        before = line[at - 1] if at else " "
        after = line[at + 1] if at + 1 < n else " "
        if c in _PAIRS:
            close(_PAIRS[c])
        elif c == '"':
            if not close('"'):
                stack.append((c, at))
        elif c == "“":
            if not (stack and stack[-1][0] == "„" and close("„")):
                stack.append((c, at))
        elif c == "”":
            close("“", "„", "”") or stack.append((c, at))
        elif c in "«»":
            other = "»" if c == "«" else "«"
            if not close(other) and (c == "«" or (not after.isspace() and (before.isspace() or before in _OPENERS or not at))):
                stack.append((c, at))
        elif c == "‘":
            if not (stack and stack[-1][0] == "‚" and close("‚")):
                stack.append((c, at))
        elif c == "’":
            if not after.isalpha():
                close("‘", "‚")
        else:
            stack.append((c, at))
    # pairs around an unmatched opener of the same kind stay; only whole pairs are kept
    spans.sort()
    return spans


@lru_cache(maxsize=1 << 14)
def _char_class(c: str) -> int:
    """0 none, 1 upper, 2 lower, 3 digit, 4 opening mark, 5 dash, 6 separator, 7 letter without case, 8 other."""
    if not c:
        return 0
    if c in "¿¡":
        return 4
    if c in _OPENERS:
        return 4
    if c in _DASHES:
        return 5
    if c in _SEPARATORS:
        return 6
    if c.isupper() or c.istitle():
        return 1
    if c.islower():
        return 2
    if c.isdigit():
        return 3
    if unicodedata.category(c)[0] in "LM":
        return 7
    return 8


@lru_cache(maxsize=1 << 16)
def _script(c: str) -> int:
    o = ord(c)
    for k, (a, b) in enumerate(((0x0, 0x24F), (0x370, 0x3FF), (0x400, 0x52F), (0x590, 0x77F), (0x900, 0xDFF), (0xE00, 0xEFF), (0x3040, 0x30FF), (0x3400, 0x9FFF))):
        if a <= o <= b:
            return k
    return 8


@lru_cache(maxsize=1 << 16)
def _shape(token: str) -> int:
    """Case, length, digits and inner marks of a token in one small number (below 32)."""
    if not token:
        return 0
    if token.isdigit():
        return 1 if len(token) <= 2 else 2 if len(token) <= 3 else 3
    if token[0].isdigit():
        return 4 if token[-1].isdigit() else 5
    if any(c.isdigit() for c in token):
        return 6
    if token[-1] == ".":
        return 21 if len(token) <= 2 else 22
    inner = "." in token
    if len(token) == 1:
        return (7 if token.isupper() else 8 if token.islower() else 9)
    if inner:
        return 10 if token[0].isupper() else 11
    if token.isupper():
        return 12 if len(token) <= 4 else 13
    if token[0].isupper():
        return 14 if len(token) <= 3 else 15 if len(token) <= 5 else 23
    if token[0].islower():
        return 16 if len(token) <= 2 else 17 if len(token) <= 4 else 18 if len(token) <= 6 else 24
    return 19 if len(token) <= 2 else 20


@lru_cache(maxsize=1 << 17)
def _slot(kind: str, token: str) -> int:
    return crc32((kind + _DIGITS.sub(lambda m: "9" * min(len(m.group()), 4), token)).encode("utf-8", "surrogatepass")) & _MASK


def _term(mark: str) -> int:
    if mark == ".":
        return 0
    if mark[0] in "…" or mark.startswith(".."):
        return 1
    if "!" in mark or "！" in mark:
        return 2
    if mark in "。｡．।॥۔":
        return 4
    return 3


def _candidates(line: str, wanted: tuple[int, ...] = (-1, 2), told: bool = True, counted: bool = False) -> list[tuple[int, int, tuple]]:
    """(end, verdict, features) of the candidates inside a line; verdict 1 boundary, 0 none, -1 to be classified.

    verdict 2: the line's end; 3: a list marker. features: slot of the token
    before, slot of the token behind, shape before, class behind, mark, blank,
    closed by a mark, script, shape behind, numbers beside, setting; empty unless
    the verdict is wanted. setting: 0 a token behind a blank or glued as sentences
    are, 1 lower case, 2 a separator, 3 a dash with nothing that begins a sentence
    behind it, 4 no blank behind the mark. Beside a setting from 2 on the tokens
    tell nothing, so their features are left at 0; not told: from 1 on. counted:
    only the features that are counted over the corpus.
    """
    out = []
    context = _neighbours if counted else _context
    spans = _matched(line) if _QUOTES.search(line) else ()
    n = len(line)
    for m in _THAI.finditer(line) if _IN_THAI.search(line) else ():
        if not any(a < m.start() < b for a, b in spans):
            out.append((m.start(), 1, ()))
    for m in _MARK.finditer(line):
        start, end = m.start(), m.end()
        at, closed = end, False
        if spans:
            here = [s for s in spans if s[0] < start < s[1]]
            while here:
                inner = max(here)
                gap = line[at : inner[1]]
                if gap and not gap.isspace():
                    break
                at, closed = inner[1] + 1, True
                here.remove(inner)
            if here:
                continue
        rest = at
        while rest < n and line[rest].isspace():
            rest += 1
        mark = m.group()
        if rest >= n:
            out.append((at, 2, context(line, start, mark, "", True, closed) if 2 in wanted else ()))
            continue
        blank = rest > at
        nxt = line[rest]
        kind = _char_class(nxt)
        if nxt in "»›" and line[rest + 1 : rest + 2].strip() == "":
            kind = 6  # between the entries of a menu
        if kind == 5:
            k = rest + 1
            while k < n and (line[k].isspace() or line[k] in _DASHES):
                k += 1
            behind = _char_class(line[k]) if k < n else 0
            setting = 0 if blank and behind in (1, 3, 4, 7) else 3
        elif kind in (2, 6, 0):
            setting = 1 if kind == 2 else 2
        elif not blank:
            before = line[start - 1] if start else " "
            if mark == ".":
                # a full stop without a blank only ends something if a word ends before and begins behind it
                word = start >= 2 and before.islower() and line[start - 2].isalpha() or before.isdigit() or closed
                setting = 0 if kind in (1, 4) and word and (not before.isdigit() or kind == 1 or nxt in "¿¡") or (kind == 7 and closed) else 4
            else:
                setting = 0 if kind in (1, 4, 7) or (kind == 3 and _term(mark) == 4) or (kind == 3 and _script(before) >= 6) else 4
        else:
            setting = 0
        verdict = -1
        if not setting and mark == "." and _MARKER.match(line[:start]):
            verdict = 3  # a list marker, no boundary and nothing to learn from
        if verdict not in wanted:
            features = ()
        elif setting > told:
            features = (0, 0, 0, kind, _term(mark), int(blank), int(closed), _script(line[start - 1]) if start else 9, 0, 0, setting)
        else:
            features = (*context(line, start, mark, line[rest : rest + BEHIND], blank, closed)[:10], setting)
        out.append((at, verdict, features))
    if len(out) > 1:
        out.sort(key=lambda x: x[0])
    return out


#: The end of a sentence to which the next one is glued without a blank.
_GLUED = re.compile(r"^.*(?:[^\W\d_A-Z]{2}|[\d)\]\"”’»])[.!?…।]+(?=[^\W\d_])(?![^\W\d_]*[.@/]\w)(?=[^a-zß-ÿ])")


_INNER = re.compile(r"[.!?…।]")


def _before(line: str, start: int) -> str:
    """The token before a mark, without opening marks; of scripts without blanks the last two characters."""
    words = line[max(0, start - BEFORE) : start].split()
    if not words:
        return ""
    token = words[-1]
    if _INNER.search(token):
        token = _GLUED.sub("", token)
    token = token.lstrip(_STRIP)
    if token and _script(token[-1]) >= 6:
        return token[-2:]
    return token


_LEADING = _STRIP + " \t\u00a0\u3000\u2009\u202f"
_HEAD = re.compile(r"[^\s.,;:!?…。！？।؟\"»”)\]]{1,40}")


def _behind(text: str) -> str:
    """The first token of a text, without opening marks; of scripts without blanks the first two characters."""
    text = text.lstrip(_LEADING)
    m = _HEAD.match(text)
    token = m.group() if m else ""
    if token and _script(token[0]) >= 6:
        return token[:2]
    # a short token with a full stop of its own is another abbreviation
    return token + "." if m and len(token) <= 5 and text[m.end() : m.end() + 1] == "." and not token.isdigit() else token


def _pair(prev: str, nxt: str) -> int:
    """What tells neighbours apart beyond their slots: the numbers themselves."""
    if prev[-1:].isdigit():
        return crc32(prev[-8:].encode()) & 0xFF
    return crc32(nxt[:8].encode()) & 0xFF if nxt[:1].isdigit() else 0


def _context(line: str, start: int, mark: str, rest: str, blank: bool, closed: bool) -> tuple:
    prev = _before(line, start)
    nxt = _behind(rest)
    term = _term(mark)
    last = line[start - 1] if start else " "
    return (_slot(f"<{term}", prev if term == 0 else "" if term > 1 else prev), _slot(">", nxt), _shape(prev), _char_class(rest[:1]), term, int(blank), int(closed), _script(last) if not last.isspace() else 9, _shape(nxt), _pair(prev, nxt), 0)


def _neighbours(line: str, start: int, mark: str, rest: str, blank: bool, closed: bool) -> tuple:
    """Of _context only what is counted over the corpus: the slots of the tokens and the numbers beside."""
    prev, nxt, term = _before(line, start), _behind(rest), _term(mark)
    return (_slot(f"<{term}", "" if term > 1 else prev), _slot(">", nxt), 0, 0, 0, 0, 0, 0, 0, _pair(prev, nxt))


def _lines(text: str) -> Iterator[tuple[int, str]]:
    """(offset, line) of the lines of a text that aren't blank, without surrounding blanks."""
    for m in _LINE.finditer(text):
        raw = m.group()
        line = raw.strip()
        if line:
            yield m.start() + (len(raw) - len(raw.lstrip())), line


#: Lead characters of UTF-8 read as a single-byte code page, and the code points its upper half shows as.
_GARBLED = re.compile("[Â-ô][\x80-\xbfŒœŠšŽžŸƒˆ˜–—‘’‚“”„†‡•…‰‹›€™]")
_SEQUENCE = re.compile("[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}")
_TO_BYTE = {ord(bytes([b]).decode("cp1252")): b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def repaired(line: str) -> tuple[str, list[int] | None]:
    """A line as it was meant, and where its characters begin in the line as stored; None if they are the same."""
    if not _GARBLED.search(line):
        return line, None
    raw = line.translate(_TO_BYTE)
    out, where, at = [], [], 0
    for m in _SEQUENCE.finditer(raw):
        try:
            c = m.group().encode("latin-1").decode("utf-8")
        except UnicodeDecodeError:
            continue
        out.append(line[at : m.start()])
        where.extend(range(at, m.start()))
        out.append(c)
        where.append(m.start())
        at = m.end()
    out.append(line[at:])
    where.extend(range(at, len(line) + 1))
    return "".join(out), where


# Statistics of the corpus -------------------------------------------------------------------------


class Statistics:
    """How often tokens stand before a mark at line ends and inside lines, and at line starts and behind marks; hashed.

    inside_top and behind_top: how often with the one neighbour that is the most
    frequent. A phrase that every page repeats says nothing about its words.
    plain: how often a token stands inside lines without any mark, which
    abbreviations don't.
    """

    def __init__(self, end, inside, inside_top, begin, behind, behind_top, plain):
        self.plain = plain
        self.end, self.inside, self.inside_top = end, inside, inside_top
        self.begin, self.behind, self.behind_top = begin, behind, behind_top

    @staticmethod
    def _grade(yes: np.ndarray, no: np.ndarray) -> np.ndarray:
        """0 unknown, else 1..11 by the logarithm of the smoothed odds."""
        odds = np.log((yes + 0.1) / (no + 0.1))
        return np.where(yes + no == 0, 0, np.clip(np.round(odds + 6), 1, 11)).astype(np.uint8)

    def never_ends(self, least: int = 10, share: float = 0.01) -> np.ndarray:
        """Slots of tokens whose mark practically never stands at a line end."""
        return (self.inside >= least) & (self.end <= share * (self.end + self.inside))

    def never_begins(self, least: int = 20, share: float = 0.003) -> np.ndarray:
        return (self.behind >= least) & (self.begin <= share * (self.begin + self.behind))

    def one_phrase(self) -> tuple[np.ndarray, np.ndarray]:
        """Slots of tokens that never stand at a line end or start only because of the phrases they occur in."""
        return ((self.inside_top > 0.4 * self.inside) | (self.plain > 0.2 * self.inside)) & (self.end <= 0.01 * self.inside), (self.behind_top > 0.4 * self.behind) & (self.begin <= 0.01 * self.behind)

    def graded(self) -> tuple[np.ndarray, ...]:
        return self._grade(self.end, self.inside), self._grade(self.begin, self.behind), *self.one_phrase()


class Counts:
    """Counts of one task: tokens at line ends and starts, and pairs around the marks inside lines."""

    def __init__(self):
        self.end, self.begin, self.pairs, self.plain = Counter(), Counter(), Counter(), Counter()

    def __len__(self) -> int:
        return len(self.pairs) + len(self.plain)

    def add(self, texts) -> None:
        for text in texts:
            if not text:
                continue
            for _, line in _lines(text):
                line = repaired(line)[0]
                if not _ANY.search(line):
                    continue
                self.plain.update(line.split())
                self.begin[_slot(">", _behind(line[:BEHIND]))] += 1
                for _, verdict, f in _candidates(line, (-1, 2), False, True):
                    if verdict == 2:
                        self.end[f[0]] += 1
                    elif verdict == -1 and not f[10]:
                        self.pairs[f[0], f[1], f[9]] += 1

    def frame(self) -> pd.DataFrame:
        rows = [(0, a, 0, 0, n) for a, n in self.end.items()] + [(1, 0, b, 0, n) for b, n in self.begin.items()] + [(2, a, b, c, n) for (a, b, c), n in self.pairs.items()]
        plain: Counter = Counter()
        for token, n in self.plain.items():
            if token[-1] not in _MARKS:
                plain[_slot("<0", token.strip(_STRIP + ",:"))] += n
        rows += [(3, a, 0, 0, n) for a, n in plain.items()]
        self.__init__()
        return pd.DataFrame(rows, columns=["kind", "a", "b", "c", "n"])


_COUNTS = "kind int, a bigint, b bigint, c bigint, n bigint"


def summed(per_task: DataFrame) -> Statistics:
    """Statistics from the counts of all tasks. What reaches the driver has SLOTS rows per kind at most."""
    total = settled(per_task.groupBy("kind", "a", "b", "c").agg(F.sum("n").alias("n")))

    def array(kind: int, slot: str, pairs: bool) -> list[np.ndarray]:
        of = total.filter(F.col("kind") == kind)
        got = of.groupBy(slot).agg(F.sum("n").alias("n"), F.max("n").alias("top")).toPandas()
        out = []
        for c in ("n", "top") if pairs else ("n",):
            v = np.zeros(SLOTS)
            v[got[slot].to_numpy(dtype=int)] = got[c].to_numpy(dtype=float)
            out.append(v)
        return out

    return Statistics(*array(0, "a", False), *array(2, "a", True), *array(1, "b", False), *array(2, "b", True), *array(3, "a", False))


def statistics(docs: DataFrame, text_col: str = "text") -> Statistics:
    """Statistics of all documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = Counts()
        for pdf in batches:
            counts.add(pdf["text"])
            if len(counts) > 300_000:
                yield counts.frame()
        yield counts.frame()

    return summed(spread_out(docs.filter(F.col(text_col).isNotNull()).select(F.col(text_col).cast("string").alias("text")), "text").mapInPandas(count, _COUNTS))


# The model ----------------------------------------------------------------------------------------

_SMALL = 2 * SLOTS
_WIDTH = _SMALL + 20_000


#: Log odds, before anything is learned, of a boundary in a setting where sentences hardly begin (1 to 4).
PRIOR = -4.0


def _prior(rows: np.ndarray) -> np.ndarray:
    return np.where(rows[:, 10] > 0, PRIOR, 0.0)


#: Shapes of tokens so short that a repeated phrase still shows them to be abbreviations.
_SHORT = (7, 8, 9, 10, 11, 14, 16, 19)


def _features(rows: np.ndarray, grade_end: np.ndarray, grade_begin: np.ndarray, phrase_end: np.ndarray, phrase_begin: np.ndarray, unknown: np.ndarray | None = None) -> np.ndarray:
    """Indices of the active features of candidates, one column per kind of feature."""
    prev, nxt, shape, kind, term, blank, closed, script, shape_next = rows[:, :9].T
    # apart from a common setting, what is told by the setting is told by it alone
    apart = (rows[:, 10] > 1) | ((rows[:, 10] == 1) & (prev == 0) & (nxt == 0) & (shape == 0))
    letter, number = np.isin(shape, _SHORT), (shape >= 1) & (shape <= 6)
    ge = np.where(phrase_end[prev] & ~letter, 0, grade_end[prev].astype(np.int64))
    # that a token never begins a line tells an ordinal from the end of a sentence, but little behind words
    gb = grade_begin[nxt].astype(np.int64)
    gb = np.where(((phrase_begin[nxt] & ~number) | ((gb <= 3) & ~number)) & ~((shape_next == 21) | (shape_next == 22)), 0, gb)
    if unknown is not None:
        ge, gb = np.where(unknown, 0, ge), np.where(unknown, 0, gb)
    small = [
        (shape * 5 + term) * 2 + closed,  # below 320
        ((kind * 5 + term) * 2 + blank) * 2 + closed,  # below 180
        (ge * 9 + kind) * 5 + term,  # below 540
        gb * 9 + kind,  # below 108
        shape * 32 + shape_next,  # below 1024
        script * 5 + term,  # below 50
        ge * 12 + gb,  # below 144
        np.where(rows[:, 10] > 0, (rows[:, 10] * 9 + kind) * 5 + term, 0),  # below 225
    ]
    # tokens that aren't known have no weight of their own
    base, cols = _SMALL, [prev, SLOTS + nxt] if unknown is None else [np.where(unknown, _WIDTH - 1, prev), np.where(unknown, _WIDTH - 2, SLOTS + nxt)]
    for s in small[:-1]:
        cols.append(np.where(apart, _WIDTH - 1, base + s))
        base += 1100
    cols.append(base + small[-1])
    cols[0], cols[1] = np.where(apart, _WIDTH - 1, cols[0]), np.where(apart, _WIDTH - 2, cols[1])
    return np.column_stack(cols)


class Model:
    """Logistic regression over indicator features: the maximum-entropy model of two classes."""

    def __init__(self, weights: np.ndarray, bias: float, grades: tuple[np.ndarray, ...]):
        self.weights, self.bias, self.grades = weights, bias, grades

    def decide(self, rows: np.ndarray) -> np.ndarray:
        if not len(rows):
            return np.empty(0, dtype=bool)
        return self.weights[_features(rows, *self.grades)].sum(axis=1) + self.bias + _prior(rows) > 0

    @staticmethod
    def fit(rows: np.ndarray, y: np.ndarray, stats: Statistics, rounds: int = 150, l2: float = 1e-4) -> Model:
        grades = stats.graded()
        weights, bias = np.zeros(_WIDTH, dtype=np.float32), 0.0
        if not len(rows) or y.all() or not y.any():
            # nothing to tell apart: every candidate is a boundary
            return Model(weights, 1.0, grades)
        # a third of the candidates is also learned from as if their tokens were new
        rng = np.random.default_rng(0)
        again = rng.random(len(rows)) < 1 / 3
        x = np.concatenate([_features(rows, *grades), _features(rows[again], *grades, unknown=np.ones(int(again.sum()), dtype=bool))])
        y = np.concatenate([y, y[again]])
        prior = np.concatenate([_prior(rows), _prior(rows[again])])
        used, inverse = np.unique(x, return_inverse=True)
        inverse = inverse.reshape(x.shape)
        w, m, v = np.zeros(len(used)), np.zeros(len(used)), np.zeros(len(used))
        mb = vb = 0.0
        # both classes weigh the same, so that frequent line ends don't decide what is rare
        apart = np.concatenate([rows[:, 10] > 1, rows[again][:, 10] > 1])
        common = y[~apart].mean() if (~apart).any() else y.mean()
        share = np.where(apart, 0.1 / max(apart.mean(), 1e-9), np.where(y, 0.5 / max(common, 1e-9), 0.5 / max(1 - common, 1e-9)))
        for k in range(1, rounds + 1):
            p = 1 / (1 + np.exp(-np.clip(w[inverse].sum(axis=1) + bias + prior, -30, 30)))
            d = (p - y) * share / len(y)
            g = np.bincount(inverse.ravel(), weights=np.repeat(d, x.shape[1]), minlength=len(used)) + l2 * w
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            mb, vb = 0.9 * mb + 0.1 * d.sum(), 0.99 * vb + 0.01 * d.sum() ** 2
            step = 0.1 / (1 + k / 100)
            w -= step * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-9)
            bias -= step * (mb / (1 - 0.9**k)) / (np.sqrt(vb / (1 - 0.99**k)) + 1e-9)
        weights[used] = w
        weights[[_WIDTH - 1, _WIDTH - 2]] = 0
        return Model(weights, float(bias), grades)


def training_rows(texts: list[str | None], stats: Statistics) -> tuple[np.ndarray, np.ndarray]:
    """Reliable candidates of texts and their classes."""
    phrase_end, phrase_begin = stats.one_phrase()
    never_end, never_begin = stats.never_ends(), stats.never_begins()
    rows, y = [], []
    for text in texts:
        if not text:
            continue
        lines = [repaired(line)[0] for _, line in _lines(text)]
        for line, following in zip(lines, lines[1:] + [""]):
            if not _ANY.search(line):
                continue
            for end, verdict, f in _candidates(line):
                if verdict == 2 and following and _char_class(following[0]) in (1, 3, 4, 7):
                    # as if the next line followed behind a blank
                    nxt = _behind(following[:BEHIND])
                    rows.append((f[0], _slot(">", nxt), f[2], _char_class(following[0]), f[4], 1, *f[6:8], _shape(nxt), 0, 0))
                    y.append(1)
                elif verdict == -1 and f[10]:
                    rows.append(f)
                    y.append(0)
                elif verdict == -1 and f[4] == 0:
                    ends = never_end[f[0]] and (not phrase_end[f[0]] or f[2] in _SHORT or (f[3] == 3 and stats.inside_top[f[0]] <= 0.4 * stats.inside[f[0]]))
                    begins = never_begin[f[1]] and (1 <= f[2] <= 2 or f[8] in (21, 22))
                    if ends or begins:
                        rows.append(f)
                        y.append(0)
    return np.array(rows, dtype=np.int64).reshape(-1, 11), np.array(y, dtype=float)


def train(docs: DataFrame, sample: int = 3000, id_col: str = "doc_id", text_col: str = "text", longest: int = 20_000) -> Model:
    """The model of a corpus: statistics of all documents, classes of reliable candidates of a sample.

    sample: how many documents, those of the least hashed ids, are used to fit;
    longest: characters of each of them, so that the sample's size is bounded.
    """
    stats = statistics(docs, text_col)
    # the least hashes first, so that only these documents' texts are moved
    hashed = docs.filter(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(F.xxhash64(id_col).alias("h"), F.substring(F.col(text_col), 1, longest).alias("text"))
    bound = hashed.select("h").orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    chosen = hashed.filter(F.col("h") <= F.lit(bound)).limit(2 * sample).collect() if bound is not None else []
    rows, y = training_rows([r["text"] for r in sorted(chosen, key=lambda r: (r["h"], r["text"]))[:sample]], stats)
    return Model.fit(rows, y, stats)


def units(texts: list[str | None], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the text, start, end) of the units of texts."""
    plain, pending, rows = [], [], []
    for k, text in enumerate(texts):
        if not text:
            continue
        for offset, line in _lines(text):
            cuts = []
            meant, where = repaired(line)
            found = _candidates(meant, (-1,), False) if _ANY.search(meant) else ()
            for end, verdict, f in found:
                end = end if where is None else where[end]
                if verdict == 1:
                    cuts.append((end, -1))
                elif verdict == -1:
                    cuts.append((end, len(rows)))
                    rows.append(f)
            if cuts:
                pending.append((k, offset, line, cuts))
            else:
                plain.append((k, offset, offset + len(line)))
    yes = model.decide(np.array(rows, dtype=np.int64).reshape(-1, 11))
    for k, offset, line, cuts in pending:
        at = 0
        for end, row in cuts:
            if (row < 0 or yes[row]) and end > at:
                plain.append((k, offset + at, offset + end))
                at = end
                while at < len(line) and line[at].isspace():
                    at += 1
        if at < len(line):
            plain.append((k, offset + at, offset + len(line)))
    if not plain:
        return (np.empty(0, dtype=np.int64),) * 3
    return tuple(np.array(plain, dtype=np.int64).T)


def sentences(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", chunk: int = 4_000_000) -> DataFrame:
    """doc_id, start_pos, end_pos: the sentence units of every document. chunk: characters that a task classifies at a time."""
    model = model or train(docs, id_col=id_col, text_col=text_col)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, texts = pdf["id"].to_numpy(), pdf["text"].tolist()
            # a batch of long texts is taken in parts, so that its candidates fit into memory
            part = np.cumsum([len(t) for t in texts]) // chunk
            for k in range(int(part[-1]) + 1 if len(part) else 0):
                lo, hi = np.searchsorted(part, [k, k + 1])
                if hi > lo:
                    which, start, end = units(texts[lo:hi], model)
                    yield pd.DataFrame({"doc_id": ids[lo:hi][which], "start_pos": start, "end_pos": end})

    texts = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return spread_out(texts, "id").mapInPandas(split, "doc_id bigint, start_pos bigint, end_pos bigint")
