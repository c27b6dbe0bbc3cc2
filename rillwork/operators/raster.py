"""Rasters as tables of tiles: tile, x0, y0 (lower left), dx, dy, nx, ny, nodata, data (row by row from y0).

Tiles may overlap and be missing; the first tile in name order with a value wins.
Nothing is broadcast: points meet tiles on the cells of a common grid.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..session import if_small, settled
from .cleaning import global_rank
from .near import SortedPoints, regions_containing


def _place() -> Column:
    """The place of a point's pixel in its tile's data."""
    col = F.least(F.floor((F.col("x") - F.col("x0")) / F.col("dx")).cast("int"), F.col("nx") - 1)
    row = F.least(F.floor((F.col("y") - F.col("y0")) / F.col("dy")).cast("int"), F.col("ny") - 1)
    return row * F.col("nx") + col


def sample(points: DataFrame, tiles: DataFrame, grid: float, inclusive: bool = True, block: int = 4096) -> DataFrame:
    """id, z: the raster value at each point (id, x, y); NULL outside and on no-data.

    grid: side of the cells on which points and tiles meet, about a tile's size.
    inclusive: whether a tile's upper and right borders belong to it. block: about
    how many points fetch the pixels of a tile together.
    """
    k = lambda c: F.floor(c / grid).cast("bigint")
    x1, y1 = F.col("x0") + F.col("nx") * F.col("dx"), F.col("y0") + F.col("ny") * F.col("dy")
    # points meet the outlines of tiles first; then blocks of a tile's points fetch its pixels, so an array is copied once a block
    head = tiles.select("tile", "x0", "y0", "dx", "dy", "nx", "ny")
    spread = head.withColumn("gx", F.explode(F.sequence(k(F.col("x0")), k(x1)))).withColumn("gy", F.explode(F.sequence(k(F.col("y0")), k(y1))))
    at = points.select("id", "x", "y", k(F.col("x")).alias("gx"), k(F.col("y")).alias("gy"))
    inside = (F.col("x") >= F.col("x0")) & (F.col("y") >= F.col("y0"))
    inside = inside & ((F.col("x") <= x1) & (F.col("y") <= y1) if inclusive else (F.col("x") < x1) & (F.col("y") < y1))
    wanted = settled(at.join(spread, ["gx", "gy"]).filter(inside).select("id", "tile", _place().alias("k")))
    blocks = if_small(wanted.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).alias("blocks")))
    held = wanted.join(blocks, "tile").groupBy("tile", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block")).agg(F.collect_list(F.struct("id", "k")).alias("p"))
    value = held.join(tiles.select("tile", "nodata", "data"), "tile").select("tile", "nodata", F.explode(F.transform("p", lambda v: F.struct(v["id"].alias("id"), F.get("data", v["k"]).cast("double").alias("z")))).alias("v")).select("tile", "nodata", "v.id", "v.z")
    first = value.filter((F.col("nodata").isNull() | (F.col("z") != F.col("nodata"))) & ~F.isnan("z")).groupBy("id").agg(F.min_by("z", "tile").alias("z"))
    return points.select("id").join(first, "id", "left")


def pixels(tiles: DataFrame) -> DataFrame:
    """tile, k, x, y, value: pixel centres with their value; no-data left out."""
    p = tiles.select("tile", "x0", "y0", "dx", "dy", "nx", "nodata", F.posexplode("data").alias("k", "v")).withColumn("value", F.col("v").cast("double"))
    ok = p.filter((F.col("nodata").isNull() | (F.col("value") != F.col("nodata"))) & ~F.isnan("value"))
    return ok.select("tile", "k", (F.col("x0") + (F.col("k") % F.col("nx") + 0.5) * F.col("dx")).alias("x"), (F.col("y0") + (F.floor(F.col("k") / F.col("nx")) + 0.5) * F.col("dy")).alias("y"), "value")


def zonal_mean(faces: DataFrame, tiles: DataFrame, grid: float) -> DataFrame:
    """id, mean, n: mean of the pixels whose centre lies in each face (id, geometry); a face without one takes the value at its centre."""
    # a pixel's number: that of its tile among the tiles, then its own
    most = tiles.agg(F.max(F.size("data"))).first()[0] or 1
    named = global_rank(tiles, ["tile"]).withColumnRenamed("rank", "__tile")
    px = settled(pixels(named.drop("tile").withColumnRenamed("__tile", "tile")).select((F.col("tile") * F.lit(int(most)) + F.col("k")).alias("id"), "x", "y", "value"))
    inside = regions_containing(faces, SortedPoints(px.select("id", "x", "y")))
    means = inside.join(px.select(F.col("id").alias("id2"), "value"), "id2").groupBy(F.col("id1").alias("id")).agg(F.avg("value").alias("mean"), F.count(F.lit(1)).alias("n"))
    ring = F.element_at("geometry", 1)
    centre = faces.join(means.select("id"), "id", "left_anti").select("id", (F.aggregate(ring, F.lit(0.0), lambda a, p: a + p["x"]) / F.size(ring)).alias("x"), (F.aggregate(ring, F.lit(0.0), lambda a, p: a + p["y"]) / F.size(ring)).alias("y"))
    rest = sample(centre, tiles, grid).select("id", F.col("z").alias("mean"), F.lit(0).cast("bigint").alias("n"))
    return means.unionByName(rest)


def class_values(samples: DataFrame, table: DataFrame, default: float) -> DataFrame:
    """samples (id, z) with value from a class table (class, value), or the default."""
    return samples.join(table, F.col("z").cast("int") == F.col("class"), "left").select("id", F.coalesce("value", F.lit(default)).alias("value"))


def transect_points(lines: DataFrame, spacing: float, half: float, step: float) -> DataFrame:
    """line, station, offset, x, y: points across lines (id, geometry), every `spacing` along and `step` across."""
    st = lines.select("id", G.line(F.col("geometry")).alias("c")).filter("c is not null").select("id", "c", F.posexplode(G.stations(F.col("c"), spacing)).alias("station", "d"))
    at = st.withColumn("p", G.at_distance(F.col("c"), F.col("d"))).withColumn("t", G.tangent(F.col("c"), F.col("d"))).filter("t is not null")
    n = int(half / step)
    off = at.withColumn("offset", F.explode(F.transform(F.sequence(F.lit(-n), F.lit(n)), lambda i: i * F.lit(step))))
    return off.select(F.col("id").alias("line"), "station", "offset", (F.col("p.x") + F.col("t.y") * F.col("offset")).alias("x"), (F.col("p.y") - F.col("t.x") * F.col("offset")).alias("y"))


def transect_minimum(lines: DataFrame, tiles: DataFrame, grid: float, spacing: float, half: float, step: float) -> DataFrame:
    """line, station, bed: the lowest raster value across each station of lines."""
    pts = transect_points(lines, spacing, half, step).withColumn("id", F.struct("line", "station", "offset"))
    z = sample(pts.select("id", "x", "y"), tiles, grid)
    return z.select("id.line", "id.station", "z").groupBy("line", "station").agg(F.min("z").alias("bed"))


def walk(crossings: Column, max_inner: float, max_gap: float) -> Column:
    """Crossings (array of struct<d, z>, outward) of one channel side up to its top: levels rise, gaps stay small.

    A repeated equal level closer than 1 is passed over. NULL if the first one is
    too far out. The walk is a fold over the sorted array with a stop flag.
    """
    first = F.element_at(crossings, 1)
    init = F.struct(F.array(first).alias("s"), F.lit(False).alias("stop"))

    def go(acc: Column, c: Column) -> Column:
        last = F.element_at(acc["s"], -1)
        again = (c["z"] == last["z"]) & (c["d"] - last["d"] < 1.0)
        on = (c["z"] > last["z"]) & (c["d"] - last["d"] <= max_gap)
        take = ~acc["stop"] & ~again & on
        return F.struct(F.when(take, F.concat(acc["s"], F.array(c))).otherwise(acc["s"]).alias("s"), (acc["stop"] | (~again & ~on)).alias("stop"))

    return F.when((F.size(crossings) > 0) & (first["d"] <= max_inner), F.aggregate(F.slice(crossings, 2, F.greatest(F.size(crossings) - 1, F.lit(0))), init, go)["s"])


def masked(value: Column) -> Column:
    """Negative codes of gridded rain (no coverage, missing) to NULL."""
    return F.when(value >= 0, value)


def stacked(cubes: list[DataFrame], keys: list[str], newest: str) -> DataFrame:
    """Union of gridded files (time, ..., value); of repeated cells the one from the newest file stays."""
    out = None
    for c in cubes:
        out = c if out is None else out.unionByName(c)
    return out.withColumn("__k", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(newest).desc()))).filter("__k = 1").drop("__k")


def banded(spark: SparkSession, x0: float, y0: float, x1: float, y1: float, cell: float = 10.0, pad: float = 20.0, bands: int = 3) -> DataFrame:
    """Tiles, one for each row of pixels, of a raster of upright bands numbered from the west, over a box and a margin around it."""
    left, low, right, high = x0 - pad, y0 - pad, x1 + pad, y1 + pad
    nx, ny = math.ceil((right - left) / cell), math.ceil((high - low) / cell)
    middle = lambda k: F.lit(left) + (k + 0.5) * F.lit(cell)
    band = lambda k: F.lit(1.0) + sum(((middle(k) > left + (right - left) * b / bands).cast("double") for b in range(1, bands)), F.lit(0.0))
    return spark.range(ny).select(F.col("id").alias("tile"), F.lit(left).alias("x0"), (F.lit(low) + F.col("id") * cell).alias("y0"), F.lit(cell).alias("dx"), F.lit(cell).alias("dy"), F.lit(nx).alias("nx"), F.lit(1).alias("ny"), F.lit(0.0).alias("nodata"), F.transform(F.sequence(F.lit(0), F.lit(nx - 1)), band).alias("data"))
