"""Attribute cleaning: prioritised fallbacks, sparse updates, ids, set edits and quality counts."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import FT_PER_M, finite, missing
from ..session import settled, shuffle_partitions
from .ordered import range_sorted, running_sums
from .profile import group_quantiles

#: Defaults of the source data, in feet where not named otherwise.
DEPTH_M = 3.0
DEPTH_FT = round(DEPTH_M * FT_PER_M, 5)
MAX_DEPTH_FT = 40.0
RIM_TOLERANCE_FT = 15.0
DEFAULT_WIDTH_FT, DEFAULT_BANK_FT, DEFAULT_BED_FT = 13.12, 32.81, 4.92
DEFAULT_PIPE_WIDTH_IN = 78.74
STALE_PIPE_IN = 6.56
CHANNEL_MATERIALS = {"Offroad Channel - Natural": ("EAR", "EAR"), "Offroad Channel - Manmade": ("EAR", "CP")}


def cascade(*steps: tuple[str, Column, Column]) -> tuple[Column, Column]:
    """(value, source) of the first step whose condition holds; steps are (source, condition, value)."""
    value, source = F.lit(None), F.lit(None)
    for name, condition, v in reversed(steps):
        value, source = F.when(condition, v).otherwise(value), F.when(condition, F.lit(name)).otherwise(source)
    return value, source


def normalised_nodes(nodes: DataFrame) -> DataFrame:
    """nodes (rim, invert, depth, dem in metres) with new_rim, new_invert, new_depth, source.

    An invalid depth becomes 3 m below the rim, taken from the rim, the invert,
    the DEM or 0; a valid depth completes a missing rim or invert.
    """
    rim, inv, dep, dem = (finite(F.col(c)) for c in ("rim", "invert", "depth", "dem"))
    bad = dep.isNull() | (dep <= 0)
    has_rim, has_inv = rim.isNotNull() & (rim > 0), inv.isNotNull()
    dem_ft = dem * F.lit(FT_PER_M)
    base, base_source = cascade(("rim", has_rim, rim), ("invert", has_inv & (inv > 0), inv + F.lit(DEPTH_FT)), ("dem", dem.isNotNull(), dem_ft), ("zero", F.lit(True), F.lit(0.0)))
    new_rim = F.when(bad, base).when(~has_rim & has_inv & (inv > 0), inv + dep).when(~has_rim & ~has_inv, F.coalesce(dem_ft, F.lit(0.0))).otherwise(rim)
    new_inv = F.when(bad, base - F.lit(DEPTH_FT)).when(has_rim & ~has_inv, rim - dep).when(~has_rim & ~has_inv, F.coalesce(dem_ft, F.lit(0.0)) - dep).otherwise(inv)
    source = F.when(bad, base_source).when(~has_rim | ~has_inv, "completed").otherwise("kept")
    return nodes.withColumns({"new_rim": F.round(new_rim, 5), "new_invert": F.round(new_inv, 5), "new_depth": F.when(bad, F.lit(DEPTH_FT)).otherwise(dep), "source": source})


def repaired_nodes(nodes: DataFrame, pipe_ends: DataFrame) -> DataFrame:
    """nodes (id, rim, invert, depth, dem_ft) with new_rim, new_invert, new_depth, reason.

    pipe_ends: id, level - the levels of the pipe ends at each node. A rim that
    is absent, not positive or far from the DEM becomes the DEM; an invert that
    is absent, not positive, at or above the rim or too deep becomes the lowest
    valid pipe end, or 3 m below the rim. If only the rim is replaced, a usable
    depth is kept.
    """
    rim, inv, dep, dem = (finite(F.col(c)) for c in ("rim", "invert", "depth", "dem_ft"))
    rim_bad = F.coalesce((rim.isNull() | (rim <= 0) | (F.abs(rim - dem) > RIM_TOLERANCE_FT)) & dem.isNotNull(), F.lit(False))
    n = nodes.withColumn("rim_bad", rim_bad).withColumn("new_rim", F.when(F.col("rim_bad"), dem).otherwise(rim))
    r = F.col("new_rim")
    n = n.withColumn("inv_bad", F.coalesce(inv.isNull() | (inv <= 0) | (inv >= r) | (r - inv > MAX_DEPTH_FT) | r.isNull(), F.lit(True)))
    n = n.withColumn("kept", F.col("rim_bad") & ~F.col("inv_bad") & F.coalesce((dep > 0) & (dep <= MAX_DEPTH_FT), F.lit(False)))
    valid = pipe_ends.filter("level is not null and not isnan(level) and level > 0").select(F.col("id").alias("e_id"), "level")
    low = n.filter("inv_bad").select("id", "new_rim").join(valid, F.col("id") == F.col("e_id")).filter((F.col("level") < F.col("new_rim")) & (F.col("new_rim") - F.col("level") <= MAX_DEPTH_FT)).groupBy("id").agg(F.min("level").alias("low"))
    n = n.join(low, "id", "left")
    new_inv = F.when(F.col("kept"), r - dep).when(F.col("inv_bad"), F.coalesce(F.col("low"), r - F.lit(DEPTH_FT))).otherwise(inv)
    changed = F.col("rim_bad") | F.col("inv_bad")
    reason = F.when(F.col("rim_bad") & (F.col("inv_bad") | F.col("kept")), "rim+invert").when(F.col("rim_bad"), "rim").when(F.col("inv_bad"), "invert")
    n = n.withColumn("new_invert", F.round(new_inv, 5))
    return n.withColumns({"new_depth": F.when(changed, F.round(r - new_inv, 5)).otherwise(dep), "reason": reason, "new_rim": F.round(r, 5)}).drop("rim_bad", "inv_bad", "kept", "low")


def unique_ids(df: DataFrame, column: str, key: str = "fid") -> DataFrame:
    """df with new_<column>: NULL and repeated ids numbered on from the greatest, in key order; the first of equals keeps its id.

    The rows to number are ranked by range-partition counts, not in one task.
    """
    x = finite(F.col(column))
    flagged = df.join(numbered(df.filter(x.isNotNull()), column, key).withColumnRenamed("k", "__k"), key, "left").withColumn("__again", x.isNull() | (F.col("__k") > 1))
    top = df.agg(F.coalesce(F.max(x), F.lit(0.0)).alias("__top"))
    ranks = global_rank(flagged.filter("__again").select(key), [key]).withColumnRenamed("rank", "__rank")
    # one row
    joined = flagged.join(ranks, key, "left").join(F.broadcast(top))
    return joined.withColumn(f"new_{column}", F.when(F.col("__again"), F.col("__top") + F.col("__rank")).otherwise(F.col(column))).drop("__k", "__again", "__rank", "__top")


def numbered(df: DataFrame, group: str, key: str) -> DataFrame:
    """key, k: the number of each row within its group, in key order; a group of any size, as it is counted over a range sort.

    Rows of a NULL group are left out; key is unique.
    """
    rows = df.filter(F.col(group).isNotNull()).select(F.col(group).cast("string").alias("g"), key, F.lit(1).alias("one"))
    return running_sums(range_sorted(rows, ["g", key]), "g", ["one"]).select(key, F.col("run_one").cast("bigint").alias("k"))


def global_rank(df: DataFrame, by: list[str]) -> DataFrame:
    """df with rank 1..n in the order of by: rows are counted per range partition, then numbered within it."""
    rows = settled(df.repartitionByRange(shuffle_partitions(df.sparkSession), *by).sortWithinPartitions(*by)).withColumn("__pid", F.spark_partition_id()).withColumn("__mid", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33))
    counts = sorted((r["__pid"], r["count"]) for r in rows.groupBy("__pid").count().collect())
    if not counts:
        return df.withColumn("rank", F.lit(0).cast("bigint"))
    before = [0, *itertools.accumulate(n for _, n in counts)]
    # one row per partition
    offsets = F.broadcast(df.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(counts, before)], "__pid int, __before bigint"))
    return rows.join(offsets, "__pid").withColumn("rank", (F.col("__mid") + F.col("__before") + 1).cast("bigint")).select(*df.columns, "rank")


def suffixed(df: DataFrame, column: str, key: str) -> DataFrame:
    """df with new_<column>: the second and later rows of a code get _1, _2 and so on."""
    n = numbered(df, column, key).withColumnRenamed("k", "__k")
    return df.join(n, key, "left").withColumn(f"new_{column}", F.when(F.col("__k") > 1, F.concat_ws("_", F.col(column), F.col("__k") - 1)).otherwise(F.col(column))).drop("__k")


def group_fallback(df: DataFrame, value: str, groups: list[str], digits: int = 1) -> DataFrame:
    """df with filled, source: the value, else the exact median of the rows with the same group, group by group."""
    out, seen = df, F.when(~missing(F.col(value)), F.round(F.col(value), digits))
    source = F.when(~missing(F.col(value)), F.lit("own"))
    for g in groups:
        known = group_quantiles(df, g, value, {f"__m_{g}": 0.5}).withColumnRenamed(g, f"__{g}")
        out = out.join(known, out[g] == F.col(f"__{g}"), "left")
        m = F.round(F.col(f"__m_{g}"), digits)
        source = F.coalesce(source, F.when(m.isNotNull(), F.lit(f"same {g}")))
        seen = F.coalesce(seen, m)
    return out.withColumns({"filled": seen, "source": source}).select(*df.columns, "filled", "source")


def sparse_updates(df: DataFrame, changes: DataFrame, key: str = "fid") -> DataFrame:
    """df with long changes (key, column, value as text) applied in one join; a column's type stays."""
    names = [c for c in df.columns if c != key]
    wide = changes.groupBy(key).agg(*[F.max(F.when(F.col("column") == c, F.struct(F.lit(1), F.col("value")))).alias(f"__{c}") for c in names])
    out = df.join(wide, key, "left")
    types = dict(df.dtypes)
    return out.select(key, *[F.when(F.col(f"__{c}").isNotNull(), F.col(f"__{c}.value").cast(types[c])).otherwise(F.col(c)).alias(c) for c in names])


def layer_union(layers: dict[str, DataFrame]) -> DataFrame:
    """All rows of layers with src_layer; columns merged whatever their case; where types differ they become text."""
    kinds: dict[str, set] = {}
    for df in layers.values():
        for c, t in df.dtypes:
            kinds.setdefault(c.lower(), set()).add(t)
    out = None
    for name, df in layers.items():
        cols = [F.lit(name).alias("src_layer")] + [(F.col(f"`{c}`").cast("string") if len(kinds[c.lower()]) > 1 else F.col(f"`{c}`")).alias(c.lower()) for c in df.columns]
        part = df.select(*cols)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def add_if_absent(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old and those rows of new whose key old lacks; of repeated new keys the first by all columns."""
    w = Window.partitionBy(key).orderBy(*[c for c in new.columns if c != key])
    once = new.withColumn("__k", F.row_number().over(w)).filter("__k = 1").drop("__k")
    return old.unionByName(once.join(old.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def reverted(current: DataFrame, removed_keys: DataFrame, restored: DataFrame, key: str) -> DataFrame:
    """current without the keys of an earlier edit, and with the rows it had removed."""
    return current.join(removed_keys.select(key).distinct(), key, "left_anti").unionByName(restored, allowMissingColumns=True)


def quality_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, nulls, blanks, zeros: one aggregate over the table."""
    types = dict(df.dtypes)
    aggs = []
    for c in columns:
        x = F.col(c)
        text = types[c] == "string"
        aggs.append(F.struct(F.lit(c).alias("column"), F.count_if(x.isNull()).alias("nulls"), (F.count_if(F.trim(x) == "") if text else F.lit(0).cast("bigint")).alias("blanks"), (F.lit(0).cast("bigint") if text else F.count_if(x == 0)).alias("zeros")))
    return df.agg(F.array(*aggs).alias("a")).select(F.inline("a"))


def repeated(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def accounting(total: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    """total, the parts' counts, and whether they add up."""
    out = total.agg(F.count(F.lit(1)).alias("total"))
    for name, df in parts.items():
        out = out.join(F.broadcast(df.agg(F.count(F.lit(1)).alias(name))))
    whole = sum((F.col(n) for n in parts), F.lit(0))
    return out.withColumn("adds_up", F.col("total") == whole)


def dropped_where(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """df without the rows whose column is one of values; '' also stands for NULL and blank, else these rows stay."""
    c = F.col(column)
    bad = c.isin([v for v in values if v])
    if "" in values:
        bad = bad | c.isNull() | (F.trim(c) == "")
    return df.filter(~F.coalesce(bad, F.lit(False)))


def by_day(df: DataFrame, day: Column, wanted: str, fills: dict[str, str]) -> DataFrame:
    """df with the columns of fills completed on rows of one local day."""
    hit = day == F.to_date(F.lit(wanted))
    return df.withColumns({c: F.when(hit & missing(F.col(c), text=True), F.lit(v)).otherwise(F.col(c)) for c, v in fills.items()})


def default_sections(channels: DataFrame) -> DataFrame:
    """channels (width, bankwidth, depth) with new_width, new_bank, new_depth, is_default.

    A channel that lacks a size, or whose top is narrower than its bottom, gets
    the default section; a depth it has is kept.
    """
    w, b, d = (F.when(~missing(F.col(c), zero=True), F.col(c)) for c in ("width", "bankwidth", "depth"))
    bad = w.isNull() | b.isNull() | d.isNull() | F.coalesce(b < w, F.lit(False))
    return channels.withColumns({"new_width": F.when(bad, DEFAULT_WIDTH_FT).otherwise(w), "new_bank": F.when(bad, DEFAULT_BANK_FT).otherwise(b), "new_depth": F.coalesce(d, F.lit(DEFAULT_BED_FT)), "is_default": bad})


def default_pipes(pipes: DataFrame) -> DataFrame:
    """pipes with new_type, new_shape, new_width, new_material, new_height: defaults, stale values replaced, square boxes."""
    width = F.when(missing(F.col("width"), zero=True) | (F.col("width") == STALE_PIPE_IN), DEFAULT_PIPE_WIDTH_IN).otherwise(F.col("width"))
    box = F.coalesce(F.upper(F.trim("mainshape")) == "BOX", F.lit(False))
    stale = missing(F.col("height"), zero=True) | (F.col("height") == STALE_PIPE_IN)
    text = lambda c, v: F.when(missing(F.col(c), text=True), F.lit(v)).otherwise(F.col(c))
    return pipes.withColumns({"new_type": text("pipetype", "Collector"), "new_shape": text("mainshape", "RND"), "new_width": width, "new_material": text("material", "RCP"), "new_height": F.when(box & stale, width).otherwise(F.col("height"))})


def storage_levels(nodes: DataFrame, offset: float = DEPTH_M) -> DataFrame:
    """nodes (level, bed, dem) with new_level from the DEM and new_bed `offset` below it, where NaN, NULL or 0."""
    level = F.when(missing(F.col("level"), zero=True), F.col("dem")).otherwise(F.col("level"))
    return nodes.withColumn("new_level", level).withColumn("new_bed", F.when(missing(F.col("bed"), zero=True), F.col("new_level") - offset).otherwise(F.col("bed")))


def culvert_inverts(culverts: DataFrame, max_depth: float = 12.2, default: float = 3.0) -> DataFrame:
    """id, end, level, source: culvert ends (id, end, level, node_level, near_level, dem) repaired.

    A level that is absent, or not positive and far below the DEM, is a
    placeholder. It becomes the node's invert, the other end's level, that of a
    near node, or the DEM less the default depth.
    """
    bad = missing(F.col("level")) | ((F.col("level") <= 0) & (F.col("dem") - F.col("level") > max_depth))
    c = culverts.withColumn("__ok", F.when(~F.coalesce(bad, F.lit(True)), F.col("level")))
    other = F.max(F.col("__ok")).over(Window.partitionBy("id"))
    c = c.withColumn("__other", other)
    value, source = cascade(("own", F.col("__ok").isNotNull(), F.col("__ok")), ("node", F.col("node_level").isNotNull(), F.col("node_level")), ("other end", F.col("__other").isNotNull(), F.col("__other")), ("near node", F.col("near_level").isNotNull(), F.col("near_level")), ("dem", F.col("dem").isNotNull(), F.col("dem") - default))
    return c.select("id", "end", value.alias("level"), source.alias("source"))


def first_region(points: DataFrame, regions: DataFrame) -> DataFrame:
    """id, region: the region with the least number that contains a point; from pairs (region, id)."""
    return points.join(regions.groupBy("id").agg(F.min("region").alias("region")), "id", "left")


def inlets_from_outfalls(outfalls: DataFrame, inlets: DataFrame, key: str = "objectid") -> DataFrame:
    """Orphan outfalls as inlet rows, numbered on from the greatest id."""
    top = inlets.agg(F.coalesce(F.max(finite(F.col(key).cast("double"))), F.lit(0.0)).alias("__top"))
    ranked = global_rank(outfalls, ["fid"])
    return ranked.join(F.broadcast(top)).select((F.col("__top") + F.col("rank")).alias(key), "facilityid", "fid")
