"""References to records that do not exist, no longer exist or come later.

References and parent validity intervals are co-partitioned and sorted by
(parent table, key, time) and merged in one linear pass: an interval is an
opening and a closing event, and a reference is sound if more intervals are
open than closed when it is reached. Memory does not depend on the size of a
key's group, as the merge keeps three counters only.

Defined results for dirty input: NULL, blank and all-zero GUID references are no
references and never come out. Parents with a NULL key or start are in force
never; with deleted_at <= load_ts neither. A reference without a time can't
meet an interval and comes out as 'missing' or 'undated'. Repeated rows each
count. Empty tables give empty results. Only the named columns are read, so
further or clashing column names do no harm.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import range_sorted, running_sums

#: Fixed value: the GUID that stands for "none".
ZERO_GUID = "00000000-0000-0000-0000-000000000000"

_SPACE = r"[\s ​﻿]"


def reference_key(c: Column, guid: bool) -> Column:
    """Canonical key: upper case, no surrounding white space, GUIDs without braces; NULL if it refers to nothing."""
    k = F.upper(F.regexp_replace(c, rf"^{_SPACE}+|{_SPACE}+$", ""))
    if guid:
        k = F.regexp_replace(k, rf"^[{{}}\s ]+|[{{}}\s ]+$", "")
    return F.when((k != "") & (k != F.lit(ZERO_GUID)), k)


@dataclass(frozen=True)
class Reference:
    child: str
    column: str
    parent: str
    key: str
    guid: bool = True


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def dangling(tables: dict[str, DataFrame], references: list[Reference], partitions: int | None = None) -> DataFrame:
    """child_table, child_fid, key, load_ts, reason of every reference without a parent in force.

    reason: 'missing' (the key never existed), 'withdrawn' (existed before, not
    at that time), 'late' (comes only later), 'undated' (no time to compare).
    """
    children, parents = None, None
    for r in references:
        c = tables[r.child].select(F.lit(r.child).alias("child_table"), F.col("fid").alias("child_fid"), F.lit(r.parent).alias("parent"), reference_key(F.col(r.column), r.guid).alias("ref"), _micros(F.col("load_ts")).alias("t"))
        children = c if children is None else children.unionByName(c)
    for parent, key, guid in sorted({(r.parent, r.key, r.guid) for r in references}):
        p = tables[parent].select(F.lit(parent).alias("parent"), reference_key(F.col(key), guid).alias("ref"), _micros(F.col("load_ts")).alias("start"), _micros(F.col("deleted_at")).alias("end"))
        parents = p if parents is None else parents.unionByName(p)

    low = F.lit(-(2**62)).cast("bigint")
    children = children.filter("ref is not null").select(
        F.concat_ws("|", "parent", "ref").alias("k"), F.coalesce("t", low).alias("t"), F.lit(2).alias("kind"), "child_table", "child_fid", F.lit(0).alias("opened"), F.lit(0).alias("begun"), F.lit(0).alias("known"), F.col("t").isNull().alias("undated")
    )
    sound = parents.filter("ref is not null and start is not null and (end is null or end > start)")
    event = lambda t, kind, opened, begun, known: sound.select(F.concat_ws("|", "parent", "ref").alias("k"), t.alias("t"), F.lit(kind).alias("kind"), F.lit(opened).alias("opened"), F.lit(begun).alias("begun"), F.lit(known).alias("known"))
    events = event(low, 0, 0, 0, 1).unionByName(event(F.col("start"), 1, 1, 1, 0)).unionByName(event(F.col("end"), 1, -1, 0, 0).filter("t is not null"))
    events = events.groupBy("k", "t", "kind").agg(*(F.sum(c).alias(c) for c in ("opened", "begun", "known")))

    merged = children.unionByName(events, allowMissingColumns=True)
    run = running_sums(range_sorted(merged, ["k", "t", "kind"], ["child_fid"], partitions), "k", ["opened", "begun", "known"])
    lost = run.filter((F.col("kind") == 2) & ((F.col("run_opened") <= 0) | F.col("undated")))
    reason = F.when(F.col("run_known") <= 0, "missing").when(F.col("undated"), "undated").when(F.col("run_begun") > 0, "withdrawn").otherwise("late")
    return lost.select("child_table", "child_fid", F.regexp_replace("k", r"^[^|]*\|", "").alias("key"), F.when(~F.col("undated"), F.timestamp_micros("t").cast("timestamp_ntz")).alias("load_ts"), reason.alias("reason"))
