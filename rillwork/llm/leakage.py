"""Evaluation texts leaking into training text.

Each task cuts its documents into shards of bounded size and builds a suffix
array over the words of a shard by prefix doubling. Every suffix of every test
item is looked up in it by binary search; the suffixes of the shard that share
enough words with it are its verbatim matches, extended to their full length.
Items in Chinese are matched on letters and digits instead of words, in shards
of the documents that hold such characters at all.

The test items are a stated set of bounded size and are sent to every task in
blocks; the corpus is read once per block and never shuffled, so hot sources or
masses of equal pages cost no more than others. Suffixes that tie over the whole
sorted depth stand side by side and are all reported.

Defined results for dirty input: NULL or empty texts match nothing; very long
texts are cut into shards that overlap by the longest item; repeated documents
each come out; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread_out

#: Soft hyphens and zero-width spaces, dropped first.
_DROP = {0x00AD: None, 0x200B: None, 0xFEFF: None, 0x2060: None}
_WORD = re.compile(r"[^\W_]+")
_DROPPED = re.compile("[­​﻿⁠]")


def words(text: str) -> list[str]:
    """Lower-case runs of letters and digits."""
    if _DROPPED.search(text):
        text = text.translate(_DROP)
    return _WORD.findall(text.lower())


def letters(text: str) -> str:
    """Letters and digits, all else dropped."""
    return "".join(words(text))


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ids (non-negative) sorted by at least the `depth` ids that follow; a shorter suffix comes first.

    Prefix doubling: the rank of 2k ids comes from the ranks of k ids here and k
    further on. It ends early when all ranks differ.
    """
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64) + 1
    order = np.argsort(rank, kind="stable")
    k = 1
    while k < depth:
        after = np.zeros(n, dtype=np.int64)
        after[: n - k] = rank[k:] if k < n else 0
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate(([1], sorted_key[1:] != sorted_key[:-1])))
        k *= 2
        if rank[order[-1]] == n:
            break
    return order


def _bounds(text: np.ndarray, order: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each query (a row of ids) the range of the sorted suffixes that begin with it."""
    n, width = len(order), queries.shape[1]
    padded = np.concatenate([text, np.full(width, -1, dtype=text.dtype)])

    def search(upper: bool) -> np.ndarray:
        lo, hi = np.zeros(len(queries), dtype=np.int64), np.full(len(queries), n, dtype=np.int64)
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) // 2
            at = order[mid]
            less, equal = np.zeros(len(open_), dtype=bool), np.ones(len(open_), dtype=bool)
            for j in range(width):
                a, b = padded[at + j], queries[open_, j]
                less |= equal & (a < b)
                equal &= a == b
                if not equal.any():
                    break
            right = less | equal if upper else less
            lo[open_] = np.where(right, mid + 1, lo[open_])
            hi[open_] = np.where(right, hi[open_], mid)

    first = search(False)
    return first, search(True)


class Probe:
    """Test items as symbol sequences, and the search of all their suffixes in a shard."""

    def __init__(self, items: list[tuple[int, list]], least: int):
        self.least = least
        self.items = [(i, s) for i, s in items if len(s) >= least]
        self.longest = max((len(s) for _, s in self.items), default=0)
        self.vocabulary = {w: k for k, w in enumerate(dict.fromkeys(w for _, s in self.items for w in s))}
        self.codes = [np.array([self.vocabulary[w] for w in s], dtype=np.int64) for _, s in self.items]
        seen: dict[bytes, int] = {}
        self.windows, self.where = [], []
        for k, c in enumerate(self.codes):
            for p in range(len(c) - least + 1):
                w = c[p : p + least]
                j = seen.setdefault(w.tobytes(), len(self.windows))
                if j == len(self.windows):
                    self.windows.append(w)
                    self.where.append([])
                self.where[j].append((k, p))
        self.windows = np.array(self.windows, dtype=np.int64).reshape(-1, least)

    def search(self, symbols: list, starts: np.ndarray, docs: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
        """(item_id, doc_id, length, item_pos, doc_pos) of the longest match of each item and document of a shard.

        symbols: those of all documents one after another, each ended by None.
        """
        if not len(self.windows) or len(symbols) < self.least:
            return
        # test symbols keep their numbers, all others are numbered behind them, document ends last
        table = dict(self.vocabulary)
        ids = np.fromiter((table.setdefault(w, len(table)) for w in symbols), dtype=np.int64, count=len(symbols))
        order = suffix_array(ids, self.least)
        first, after = _bounds(ids, order, self.windows)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for j in np.flatnonzero(after > first):
            at = order[first[j] : after[j]]
            in_doc = np.searchsorted(starts, at, "right") - 1
            for k, p in self.where[j]:
                code = self.codes[k]
                length = np.full(len(at), self.least, dtype=np.int64)
                going = np.arange(len(at))
                while len(going) and p + length[going[0]] < len(code):
                    nxt = at[going] + length[going]
                    ok = (nxt < len(ids)) & (ids[np.minimum(nxt, len(ids) - 1)] == code[p + length[going[0]]])
                    going = going[ok]
                    length[going] += 1
                for d, n, q in zip(in_doc.tolist(), length.tolist(), at.tolist()):
                    key = (self.items[k][0], docs[d])
                    found = (-n, p, q - int(starts[d]))
                    if key not in best or found < best[key]:
                        best[key] = found
        for (item, doc), (n, p, q) in best.items():
            yield item, doc, -n, p, q


FOUND = "item_id bigint, doc_id bigint, length int, item_pos int, doc_pos bigint"


def leaks(docs: DataFrame, items: DataFrame, least_words: int = 12, least_letters: int = 24, by_letter: tuple[str, ...] = ("zh",), shard: int = 1_000_000, block: int = 8_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """item_id, doc_id, length, item_pos, doc_pos: the longest verbatim match of each leaking pair; of equally long ones the first in the item, then in the document.

    items: item_id, lang, text. block: characters of the test items sent to the
    tasks at a time, so that what a task is sent is bounded however many items
    there are and however long; an item longer than that is a block of its own.
    The corpus is read once per block. shard: symbols of one suffix array.
    """
    out = None
    for part in _blocks(items, by_letter, block):
        by_word = Probe([(i, words(t)) for i, z, t in part if not z], least_words)
        by_char = Probe([(i, list(letters(t))) for i, z, t in part if z], least_letters)
        found = _search(docs, by_word, by_char, shard, id_col, text_col)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], FOUND)
    return out.groupBy("item_id", "doc_id").agg(F.min(F.struct((-F.col("length")).alias("less"), "item_pos", "doc_pos")).alias("m")).select("item_id", "doc_id", (-F.col("m.less")).alias("length"), "m.item_pos", "m.doc_pos")


def _blocks(items: DataFrame, by_letter: tuple[str, ...], size: int) -> Iterator[list[tuple]]:
    """The test items in blocks of about `size` characters, one block at a time on the driver."""
    part, held = [], 0
    for r in items.select("item_id", "lang", "text").filter("item_id is not null and text is not null").orderBy("item_id", "text").toLocalIterator():
        if part and held + len(r["text"]) > size:
            yield part
            part, held = [], 0
        part.append((r["item_id"], r["lang"] in by_letter, r["text"]))
        held += len(r["text"])
    if part:
        yield part


def _needed(probe: Probe) -> re.Pattern | None:
    """Matches texts that hold a character beyond ASCII of the items; None unless every test window has one."""
    beyond = {w for w in probe.vocabulary if not w.isascii()}
    codes = {probe.vocabulary[w] for w in beyond}
    if not len(probe.windows) or not all(any(int(c) in codes for c in w) for w in probe.windows):
        return None
    return re.compile("[" + "".join(map(re.escape, sorted(beyond))) + "]")


def _search(docs: DataFrame, by_word: Probe, by_char: Probe, shard: int, id_col: str, text_col: str) -> DataFrame:
    needed = _needed(by_char)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shards = {p: ([], [], []) for p in (by_word, by_char)}
        found: list[tuple] = []

        def flush(probe: Probe) -> None:
            symbols, starts, ids = shards[probe]
            if symbols:
                # positions in a document cut into pieces count from its begin
                for item, k, n, p, q in probe.search(symbols, np.array(starts, dtype=np.int64), list(range(len(ids)))):
                    found.append((item, ids[k][0], n, p, q + ids[k][1]))
            shards[probe] = ([], [], [])

        def add(probe: Probe, doc: int, symbols: list) -> None:
            step = max(shard - probe.longest, 1)
            at = 0
            while True:
                piece = symbols[at : at + shard] if len(symbols) > shard else symbols
                held, starts, ids = shards[probe]
                starts.append(len(held))
                ids.append((doc, at))
                held.extend(piece)
                held.append(None)
                if len(held) >= shard:
                    flush(probe)
                at += step
                if at + probe.longest >= len(symbols) or len(symbols) <= shard:
                    return

        for pdf in batches:
            for doc, text in zip(pdf["id"], pdf["text"]):
                if not text:
                    continue
                got = words(text)
                if len(got) >= by_word.least and len(by_word.windows):
                    add(by_word, doc, got)
                if len(by_char.windows) and (needed is None or needed.search(text)):
                    chars = "".join(got)
                    if len(chars) >= by_char.least:
                        add(by_char, doc, list(chars))
            if found:
                yield pd.DataFrame(found, columns=["item_id", "doc_id", "length", "item_pos", "doc_pos"])
                found = []
        flush(by_word)
        flush(by_char)
        if found:
            yield pd.DataFrame(found, columns=["item_id", "doc_id", "length", "item_pos", "doc_pos"])

    texts = docs.filter(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return spread_out(texts, "id").mapInPandas(search, FOUND)


def without_leaks(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents that hold no passage of a test item."""
    return docs.join(found.select(F.col("doc_id").alias(id_col)).distinct(), id_col, "left_anti")
