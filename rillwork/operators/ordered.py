"""Scans over globally sorted rows.

A range-partitioned sort spreads even one hot key over many partitions. What
crosses a partition border is one number per value column for the key that is
open at the border, so the driver only ever sees one small row per partition.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settled, shuffle_partitions


def range_sorted(df: DataFrame, by: Sequence[str], spread: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """df sorted by `by` across and within partitions, settled.

    `spread` columns only break ties between partitions, so that a run of equal
    `by` values doesn't have to fit into one task.
    """
    n = partitions or shuffle_partitions(df.sparkSession)
    cols = [*by, *spread]
    return settled(df.repartitionByRange(n, *cols).sortWithinPartitions(*cols))


def _key_runs(keys: np.ndarray) -> np.ndarray:
    """Start offsets of the runs of equal keys."""
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, dtype=int)


def running_sums(sorted_df: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Adds run_<value>: the inclusive running sum of each value within its key.

    sorted_df comes from range_sorted with `key` (a non-null string) first in
    its order. NULL values count as 0. Empty input gives an empty result.
    """
    values = list(values)

    def tails(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, last, sums = None, None, np.zeros(len(values))
        for pdf in batches:
            if not len(pdf):
                continue
            keys = pdf[key].to_numpy()
            first = keys[0] if first is None else first
            start = _key_runs(keys)[-1]
            if start > 0 or keys[0] != last:
                sums = np.zeros(len(values))
            last = keys[-1]
            sums = sums + pdf[values].iloc[start:].fillna(0).to_numpy(dtype=float).sum(axis=0)
        if first is not None:
            yield pd.DataFrame({"pid": [TaskContext.get().partitionId()], "first": [first], "last": [last], "sums": [sums.tolist()]})

    rows = sorted_df.select(key, *values).mapInPandas(tails, "pid int, first string, last string, sums array<double>").collect()
    carry: dict[int, tuple[str, list[float]]] = {}
    open_key, open_sums = None, [0.0] * len(values)
    for r in sorted(rows, key=lambda r: r["pid"]):
        carry[r["pid"]] = (open_key, open_sums)
        if r["first"] == r["last"] == open_key:
            open_sums = [a + b for a, b in zip(open_sums, r["sums"])]
        else:
            open_key, open_sums = r["last"], list(r["sums"])

    names = [f"run_{v}" for v in values]
    kept = [c for c in sorted_df.columns if c not in names]
    schema = T.StructType([sorted_df.schema[c] for c in kept] + [T.StructField(n, T.DoubleType()) for n in names])

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_key, open_sums = carry.get(TaskContext.get().partitionId(), (None, [0.0] * len(values)))
        for pdf in batches:
            if not len(pdf):
                continue
            keys = pdf[key].to_numpy()
            starts = _key_runs(keys)
            run_of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(keys))))
            out = pdf[kept].copy()
            after = []
            for name, v, opened in zip(names, values, open_sums):
                total = np.cumsum(pdf[v].fillna(0).to_numpy(dtype=float))
                base = np.concatenate(([0.0], total[starts[1:] - 1]))
                if keys[0] == open_key:
                    base[0] -= opened
                out[name] = total - base[run_of]
                after.append(float(out[name].iloc[-1]))
            open_key, open_sums = keys[-1], after
            yield out

    return sorted_df.mapInPandas(scan, schema)


def with_partition_id(df: DataFrame, name: str = "pid") -> DataFrame:
    return df.withColumn(name, F.spark_partition_id())
