"""Filling fixed-capacity training sequences with documents.

Bounded-space online packing: each partition keeps a fixed number of open
windows, puts a document into the fullest one it fits, and when none fits emits
the fullest and opens a new one. Windows still open at the end of a partition
are merged with those of others, as whole items, in a tree of bounded tasks, so
no task ever sees more than a fixed number of them. A document longer than the
capacity is cut into full sequences and one remainder, which is packed like any
other item; no other document is cut.

Defined results for dirty input: NULL, empty texts and texts without tokens come
out once each, with no sequence; repeated rows are documents of their own;
an empty table gives an empty result; other columns are not read. Documents are
taken in the order of the scan, or of their ids where a small scan is spread over
more tasks, so a second run over the same files packs them alike.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settled, spread_out
from .tokens import TOKENIZER, TOKENIZER_FOLDER, counter

#: Window numbers: partition number times this, plus the number within the partition.
_WINDOWS = 1 << 32

PLACED = "doc_id bigint, piece int, first_token bigint, n_tokens bigint, window bigint, position bigint, open boolean"


class OpenWindows:
    """A fixed number of open windows with best-fit placement."""

    def __init__(self, capacity: int, space: int, first_number: int):
        self.capacity, self.space = capacity, space
        self.fills: list[tuple[int, int]] = []  # (fill, number), sorted
        self.items: dict[int, list] = {}
        self.next = first_number

    def place(self, size: int, item) -> list:
        """Puts an item into the fullest window it fits. Returns [(number, items)] of windows that had to be emitted."""
        out = []
        at = bisect_left(self.fills, (self.capacity - size + 1, -1)) - 1
        if at >= 0:
            fill, number = self.fills.pop(at)
        else:
            if len(self.fills) >= self.space:
                _, full = self.fills.pop()
                out.append((full, self.items.pop(full)))
            fill, number, self.next = 0, self.next, self.next + 1
            self.items[number] = []
        self.items[number].append((item, fill))
        if fill + size == self.capacity:
            out.append((number, self.items.pop(number)))
        else:
            insort(self.fills, (fill + size, number))
        return out

    def rest(self) -> list:
        return [(number, self.items[number]) for _, number in self.fills]


def pack(docs: DataFrame, capacity: int = 2048, space: int = 64, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", merge: int = 4096) -> DataFrame:
    """doc_id, piece, first_token, n_tokens, seq_id, position: where each document, or each piece of a cut one, stands.

    capacity: tokens of a sequence. space: open windows of a task. merge: open
    windows that one merging task takes. Documents without tokens have piece 0,
    n_tokens 0 and a NULL seq_id.
    """
    path = tokenizer or f"{TOKENIZER_FOLDER}/{TOKENIZER}"

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(path)
        windows = OpenWindows(capacity, space, TaskContext.get().partitionId() * _WINDOWS)
        rows: list[tuple] = []

        def emit(done: list, is_open: bool) -> None:
            for number, items in done:
                rows.extend((*item, number, at, is_open) for item, at in items)

        for pdf in batches:
            for doc, text in zip(pdf["id"], pdf["text"]):
                n, first, piece = count(text), 0, 0
                if n == 0:
                    rows.append((doc, 0, 0, 0, None, None, False))
                while n - first > capacity:
                    emit([(windows.next, [((doc, piece, first, capacity), 0)])], False)
                    windows.next += 1
                    first, piece = first + capacity, piece + 1
                if n > first:
                    emit(windows.place(n - first, (doc, piece, first, n - first)), False)
            if rows:
                yield pd.DataFrame(rows, columns=names).astype(kinds)
                rows = []
        emit(windows.rest(), True)
        if rows:
            yield pd.DataFrame(rows, columns=names).astype(kinds)

    names = ["doc_id", "piece", "first_token", "n_tokens", "window", "position", "open"]
    kinds = {"window": "Int64", "position": "Int64"}
    placed = settled(spread_out(docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")), "id").mapInPandas(place, PLACED))
    moved = _merged(placed.filter("open").groupBy("window").agg(F.sum("n_tokens").alias("size")), capacity, space, merge)
    whole = placed.filter("not open").select("doc_id", "piece", "first_token", "n_tokens", F.col("window").alias("seq_id"), "position")
    joined = placed.filter("open").join(moved, "window").select("doc_id", "piece", "first_token", "n_tokens", "seq_id", (F.col("position") + F.col("base")).alias("position"))
    return whole.unionByName(joined)


def _merged(leftovers: DataFrame, capacity: int, space: int, merge: int) -> DataFrame:
    """window, seq_id, base: the sequence each leftover window goes into and the tokens before it there."""
    # a task leaves up to `space` windows open: it has to take more than that for the tree to get narrower
    merge = max(merge, 4 * space)
    level = settled(leftovers)
    n = level.count()
    chain = level.select("window", F.col("window").alias("seq_id"), F.lit(0).cast("bigint").alias("base"))
    final = None
    while True:
        tasks = max(1, -(-n // merge))

        def repack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            got = pd.concat([b for b in batches] or [pd.DataFrame({"window": [], "size": []})])
            got = got.sort_values(["size", "window"], ascending=[False, True])
            windows = OpenWindows(capacity, space, 0)
            rows = []
            # a merged window is named after the first one in it
            for number, size in zip(got["window"], got["size"]):
                for _, items in windows.place(int(size), (int(number), int(size))):
                    rows += [(w, items[0][0][0], at, s, False) for (w, s), at in items]
            for _, items in windows.rest():
                rows += [(w, items[0][0][0], at, s, True) for (w, s), at in items]
            if rows:
                yield pd.DataFrame(rows, columns=["window", "into", "at", "size", "open"])

        packed = settled(level.repartitionByRange(tasks, "window").mapInPandas(repack, "window bigint, into bigint, at bigint, size bigint, open boolean") if tasks > 1 else level.coalesce(1).mapInPandas(repack, "window bigint, into bigint, at bigint, size bigint, open boolean"))
        step = packed.select(F.col("window").alias("w"), "into", "at", "open")
        chain = chain.join(step, F.col("seq_id") == F.col("w")).select("window", F.col("into").alias("seq_id"), (F.col("base") + F.col("at")).alias("base"), "open")
        if tasks == 1:
            done = chain.drop("open")
            return done if final is None else final.unionByName(done)
        closed = chain.filter("not open").drop("open")
        final = closed if final is None else final.unionByName(closed)
        chain = settled(chain.filter("open").drop("open"))
        level = settled(packed.filter("open").groupBy(F.col("into").alias("window")).agg(F.sum("size").alias("size")))
        n = level.count()


def utilisation(packed: DataFrame, capacity: int) -> DataFrame:
    """sequences, tokens, filled: how many sequences there are and which share of their room is used."""
    per = packed.filter("seq_id is not null").groupBy("seq_id").agg(F.sum("n_tokens").alias("fill"))
    return per.agg(F.count(F.lit(1)).alias("sequences"), F.sum("fill").alias("tokens"), F.max("fill").alias("fullest")).withColumn("filled", F.try_divide(F.col("tokens"), F.col("sequences") * F.lit(capacity)))
