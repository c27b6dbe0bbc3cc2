"""Column-level data quality profile of tables that arrive in loads.

Columns are unpivoted and pre-aggregated to (column, load, value, count). A
range sort by column, load and value with per-partition prefix counts gives
exact ranks, hence exact quantiles, distinct counts and medians, without ever
holding one column's values in a task. The same prefix counts, signed and
merged over two loads, are the two cumulative curves of a Kolmogorov-Smirnov
distance.

Defined results for dirty input: missing is NULL, NaN or blank text; a load or
column without values has NULL quantiles and takes no part in medians over
loads; a NULL load_id is a load of its own; repeated rows each count; -0.0
counts as 0.0. Empty tables give empty results. Other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settled
from .ordered import range_sorted, running_sums


@dataclass(frozen=True)
class Field:
    """A column to profile. Text has a code list, numbers a range; both may be absent."""

    layer: str
    column: str
    numeric: bool
    codes: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None
    pattern: str | None = field(default=None)


def unpivoted(tables: dict[str, DataFrame], fields: list[Field], load: str = "load_id") -> DataFrame:
    """layer, field, load_id, text, num: one row per cell; both values NULL where the cell is missing."""
    out = None
    for layer in dict.fromkeys(f.layer for f in fields):
        cells = []
        for f in (f for f in fields if f.layer == layer):
            c = F.col(f"`{f.column}`")
            num = F.when(~F.isnan(c), c.cast("double") + F.lit(0.0)) if f.numeric else F.lit(None).cast("double")
            text = F.lit(None).cast("string") if f.numeric else F.when(F.trim(F.regexp_replace(c, r"[\s ]+", " ")) != "", c)
            cells.append(F.struct(F.lit(f.column).alias("field"), text.alias("text"), num.alias("num")))
        t = tables[layer].select(F.lit(layer).alias("layer"), F.col(load).cast("bigint").alias("load_id"), F.explode(F.array(*cells)).alias("c")).select("layer", "c.field", "load_id", "c.text", "c.num")
        out = t if out is None else out.unionByName(t)
    return out


def value_counts(cells: DataFrame) -> DataFrame:
    """cells with repeats counted; partial counts leave the map side only once per value and task."""
    return cells.groupBy("layer", "field", "load_id", "text", "num").agg(F.count(F.lit(1)).alias("n"))


def _listed(fields: list[Field]) -> Column:
    """Whether a value passes its column's code list or range; NULL where the column has none or the cell is missing."""
    out = F.lit(None).cast("boolean")
    for f in fields:
        here = (F.col("layer") == f.layer) & (F.col("field") == f.column)
        if f.codes:
            out = F.when(here & F.col("text").isNotNull(), F.col("text").isin(*f.codes)).otherwise(out)
        elif f.pattern:
            out = F.when(here & F.col("text").isNotNull(), F.col("text").rlike(f.pattern)).otherwise(out)
        elif f.low is not None or f.high is not None:
            low = F.col("num") >= F.lit(f.low) if f.low is not None else F.lit(True)
            high = F.col("num") <= F.lit(f.high) if f.high is not None else F.lit(True)
            out = F.when(here & F.col("num").isNotNull(), low & high).otherwise(out)
    return out


def _key() -> Column:
    return F.concat_ws("|", "layer", "field", F.coalesce(F.col("load_id").cast("string"), F.lit("none")))


def quantiles(counts: DataFrame, shares: dict[str, float], partitions: int | None = None) -> DataFrame:
    """layer, field, load_id and one column per share: exact quantiles of num weighted by n, interpolated linearly.

    A value occupies the ranks (run - n, run]. Rank h = (total - 1) * share lies
    between its two neighbouring ranks, which are looked up in these intervals.
    """
    numbers = counts.filter("num is not null and n > 0").select("layer", "field", "load_id", "num", "n", _key().alias("k"))
    q = keyed_quantiles(numbers.select("k", "num", "n"), shares, partitions)
    return numbers.groupBy("k").agg(F.first("layer").alias("layer"), F.first("field").alias("field"), F.first("load_id").alias("load_id")).join(q, "k").drop("k")


def keyed_quantiles(counts: DataFrame, shares: dict[str, float], partitions: int | None = None) -> DataFrame:
    """k and one column per share: exact quantiles of num weighted by n, by prefix counts over (k, num), whatever a key's size.

    counts: k (non-null string), num, n, one row per value of a key.
    """
    run = running_sums(range_sorted(counts, ["k", "num"], partitions=partitions), "k", ["n"])
    totals = counts.groupBy("k").agg(F.sum("n").alias("total"))
    ranked = run.join(totals, "k").withColumn("before", F.col("run_n") - F.col("n"))
    aggs = []
    for name, q in shares.items():
        h = (F.col("total") - 1) * F.lit(float(q))
        part = lambda r: (r >= F.col("before")) & (r < F.col("run_n"))
        low, high = F.max(F.when(part(F.floor(h)), F.col("num"))), F.max(F.when(part(F.ceil(h)), F.col("num")))
        aggs.append((low + (high - low) * F.max(h - F.floor(h))).alias(name))
    return ranked.groupBy("k").agg(*aggs)


def group_quantiles(df: DataFrame, group: str, value: str, shares: dict[str, float]) -> DataFrame:
    """group and one column per share: exact quantiles of value within each group; NULL groups and values left out."""
    x = F.col(value).cast("double")
    counts = df.filter(F.col(group).isNotNull() & x.isNotNull() & ~F.isnan(x)).groupBy(F.col(group).alias("g"), (x + F.lit(0.0)).alias("num")).agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.col("g").cast("string"))
    names = counts.select("k", F.col("g").alias(group)).distinct()
    return keyed_quantiles(counts.select("k", "num", "n"), shares).join(names, "k").drop("k")


def profile(tables: dict[str, DataFrame], fields: list[Field], load: str = "load_id", partitions: int | None = None) -> DataFrame:
    """One row per layer, field and load: rows, missing, distinct, off (violations of list, pattern or range), least, greatest, p05, p50, p95."""
    # read by several branches: far smaller than the tables, so it is written once
    counts = settled(value_counts(unpivoted(tables, fields, load)))
    seen = F.col("text").isNotNull() | F.col("num").isNotNull()
    basic = counts.groupBy("layer", "field", "load_id").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(seen, 0).otherwise(F.col("n"))).alias("missing"),
        F.sum(F.when(seen, 1).otherwise(0)).alias("distinct_values"),
        F.sum(F.when(_listed(fields) == F.lit(False), F.col("n")).otherwise(0)).alias("off"),
        F.min("num").alias("least"),
        F.max("num").alias("greatest"),
    )
    q = quantiles(counts, {"p05": 0.05, "p50": 0.5, "p95": 0.95}, partitions)
    keys = ["layer", "field", "load_id"]
    joined = basic.alias("b").join(q.alias("q"), [F.col(f"b.{k}").eqNullSafe(F.col(f"q.{k}")) for k in keys], "left")
    return joined.select("b.*", "q.p05", "q.p50", "q.p95")


def drift(tables: dict[str, DataFrame], fields: list[Field], load: str = "load_id", partitions: int | None = None) -> DataFrame:
    """layer, field, load_id, previous_id, ks: exact Kolmogorov-Smirnov distance of each load's numbers to those of the load before.

    Loads without numbers in the column are passed over.
    """
    counts = settled(value_counts(unpivoted(tables, [f for f in fields if f.numeric], load)).filter("num is not null and load_id is not null"))
    totals = counts.groupBy("layer", "field", "load_id").agg(F.sum("n").alias("total"))
    # loads are few: the order of loads is a window over totals, one row per load
    from pyspark.sql import Window

    pairs = totals.withColumn("next_id", F.lead("load_id").over(Window.partitionBy("layer", "field").orderBy("load_id")))
    weighted = counts.join(pairs, ["layer", "field", "load_id"]).withColumn("w", F.col("n") / F.col("total"))
    # a load's values count up its own curve and down that of the comparison with its successor
    own = weighted.select("layer", "field", F.col("load_id").alias("pair"), "num", F.col("w").alias("w"), F.lit(1).alias("mine"))
    after = weighted.filter("next_id is not null").select("layer", "field", F.col("next_id").alias("pair"), "num", (-F.col("w")).alias("w"), F.lit(0).alias("mine"))
    curve = own.unionByName(after).groupBy("layer", "field", "pair", "num").agg(F.sum("w").alias("w"))
    keyed = curve.withColumn("k", F.concat_ws("|", "layer", "field", F.col("pair").cast("string")))
    run = running_sums(range_sorted(keyed, ["k", "num"], partitions=partitions), "k", ["w"])
    previous = pairs.filter("next_id is not null").select("layer", "field", F.col("load_id").alias("previous_id"), F.col("next_id").alias("pair"))
    ks = run.groupBy("layer", "field", "pair").agg(F.max(F.abs("run_w")).alias("ks"))
    return ks.join(previous, ["layer", "field", "pair"]).select("layer", "field", F.col("pair").alias("load_id"), "previous_id", "ks")


@dataclass(frozen=True)
class Limits:
    """What a load may differ by; the values of the problem's statement."""

    nulls: float = 0.15
    domain: float = 0.2
    range: float = 0.25
    text_shift: float = 0.4
    number_shift: float = 0.5


def breaking_loads(tables: dict[str, DataFrame], fields: list[Field], limits: Limits = Limits(), load: str = "load_id", partitions: int | None = None) -> DataFrame:
    """layer, field, load_id, kind ('nulls', 'domain', 'range', 'shift') of the loads that break the profile of their layer."""
    from pyspark.sql import Window

    counts = settled(value_counts(unpivoted(tables, fields, load)).withColumn("listed", _listed(fields)))
    keys = ["layer", "field", "load_id"]
    seen = F.col("text").isNotNull() | F.col("num").isNotNull()
    per_load = counts.groupBy(*keys).agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(seen, 0).otherwise(F.col("n"))).alias("missing"),
        F.sum(F.when(F.col("listed") == F.lit(False), F.col("n")).otherwise(0)).alias("off"),
        F.max("num").isNotNull().alias("is_number"),
    )
    over_loads = Window.partitionBy("layer", "field")
    median = lambda c: F.percentile(c, F.lit(0.5)).over(over_loads)
    shares = per_load.withColumn("missing_share", F.col("missing") / F.col("rows")).withColumn("off_share", F.try_divide(F.col("off"), F.col("rows") - F.col("missing")))
    shares = shares.withColumn("median_share", median(F.col("missing_share")))
    nulls = shares.filter(F.abs(F.col("missing_share") - F.col("median_share")) > limits.nulls).select(*keys, F.lit("nulls").alias("kind"))
    off = shares.filter((F.col("off_share") > F.when(F.col("is_number"), limits.range).otherwise(limits.domain))).select(*keys, F.when(F.col("is_number"), "range").otherwise("domain").alias("kind"))

    # numbers: medians of in-range values; the prefix counts give them
    mid = quantiles(counts.filter("listed and num is not null"), {"p50": 0.5}, partitions).withColumn("centre", median(F.col("p50")))
    number_shift = mid.filter(F.abs(F.col("p50") - F.col("centre")) > limits.number_shift * F.abs(F.col("centre"))).select(*keys, F.lit("shift").alias("kind"))

    # text: shares of the listed codes; a code a load lacks has share 0 there
    codes = [(f.layer, f.column, c) for f in fields for c in f.codes]
    if codes:
        listed = counts.filter("listed and text is not null").groupBy(*keys, "text").agg(F.sum("n").alias("n"))
        total = listed.groupBy(*keys).agg(F.sum("n").alias("total"))
        grid = total.join(counts.sparkSession.createDataFrame(codes, "layer string, field string, text string"), ["layer", "field"])
        here = grid.alias("g").join(listed.alias("l"), (F.col("g.layer") == F.col("l.layer")) & (F.col("g.field") == F.col("l.field")) & F.col("g.load_id").eqNullSafe(F.col("l.load_id")) & (F.col("g.text") == F.col("l.text")), "left")
        share = here.select(F.col("g.layer").alias("layer"), F.col("g.field").alias("field"), F.col("g.load_id").alias("load_id"), F.col("g.text").alias("text"), (F.coalesce(F.col("l.n"), F.lit(0)) / F.col("g.total")).alias("share"))
        per_code = share.withColumn("centre", F.percentile("share", F.lit(0.5)).over(Window.partitionBy("layer", "field", "text")))
        text_shift = per_code.groupBy(*keys).agg((F.sum(F.abs(F.col("share") - F.col("centre"))) / 2).alias("d")).filter(F.col("d") > limits.text_shift).select(*keys, F.lit("shift").alias("kind"))
        number_shift = number_shift.unionByName(text_shift)
    return nulls.unionByName(off).unionByName(number_shift)
