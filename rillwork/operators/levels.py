"""Levels from what lies around: channel beds under points and pipe ends, inverts along pipes, sections from the DEM, boundary values.

Levels are in metres unless a name says feet. Defined results for dirty input:
NULL, NaN and infinite levels count as absent; geometry without usable vertices
gives no level; a place off the DEM has a NULL level; of repeated rows each
counts; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.columns import FT_PER_M, finite
from ..session import settled
from .graph import clustered_ends, fixed_point_levels, line_ends
from .near import SortedPoints, points_within
from .network import clean_lines, points_on_lines
from .raster import sample
from .sections import flow_areas


def channel_beds(points: DataFrame, channels: DataFrame, tiles: DataFrame, grid: float, limit: float, step: float = 0.5) -> DataFrame:
    """id, channel, off, bed: the nearest channel within limit of points (id, x, y), and the lowest DEM value across its bottom there.

    channels: id, geometry, width. The bottom is looked at every `step` from its
    middle, up to half the width, at least 1 m, to both sides.
    """
    hits = points_on_lines(points, channels.select("id", "geometry"), limit)
    best = hits.groupBy(F.col("pt").alias("id")).agg(F.min(F.struct(F.round("off", 9).alias("o"), F.col("line").alias("channel"), "off", "at")).alias("b")).select("id", "b.channel", "b.off", "b.at")
    c = clean_lines(channels).join(channels.select("id", finite(F.col("width")).alias("width")), "id").withColumnRenamed("id", "channel")
    at = best.join(c, "channel").withColumn("p", G.at_distance(F.col("c"), F.col("at"))).withColumn("t", G.tangent(F.col("c"), F.col("at"), 2.0))
    n = F.floor(F.greatest(F.coalesce(F.col("width"), F.lit(0.0)) / 2, F.lit(1.0)) / step).cast("int")
    across = settled(at.select("id", "channel", "off", "p", "t", F.explode(F.sequence(-n, n)).alias("k")))
    d = F.col("k") * F.lit(step)
    place = across.select(F.struct("id", "k").alias("id"), (F.col("p.x") - F.coalesce(F.col("t.y"), F.lit(0.0)) * d).alias("x"), (F.col("p.y") + F.coalesce(F.col("t.x"), F.lit(1.0)) * d).alias("y"))
    low = sample(place, tiles, grid).groupBy("id.id").agg(F.min("z").alias("bed"))
    return best.select("id", "channel", "off").join(low, "id", "left")


def outfall_levels(points: DataFrame, channels: DataFrame, tiles: DataFrame, grid: float, limit: float) -> DataFrame:
    """id, level_ft, channel, off: the bed of the nearest channel plus a third of its depth (feet), for points (id, x, y, flow_ft) without a level; others keep theirs.

    channels: id, geometry, width (metres), depth_ft.
    """
    bed = channel_beds(points.select("id", "x", "y"), channels, tiles, grid, limit)
    j = points.join(bed, "id", "left").join(channels.select(F.col("id").alias("channel"), finite(F.col("depth_ft")).alias("depth_ft")), "channel", "left")
    return j.select("id", F.coalesce(finite(F.col("flow_ft")), F.round(F.col("bed") * F.lit(FT_PER_M) + F.col("depth_ft") / 3, 2)).alias("level_ft"), "channel", "off")


def end_beds(pipes: DataFrame, channels: DataFrame, tiles: DataFrame, grid: float, tol: float) -> DataFrame:
    """id, end, bed: bed of the channel that the end of a pipe (id, geometry) lies on, within tol, anywhere along it."""
    ends = settled(line_ends(pipes).select((F.col("id") * 2 + F.when(F.col("end") == "start", 0).otherwise(1)).alias("id"), "x", "y"))
    got = channel_beds(ends, channels, tiles, grid, tol).filter("bed is not null")
    return got.select(F.floor(F.col("id") / 2).cast("bigint").alias("id"), F.when(F.col("id") % 2 == 0, "start").otherwise("end").alias("end"), F.round("bed", 2).alias("bed"))


def interior_inverts(pipes: DataFrame, nodes: DataFrame, tol: float) -> DataFrame:
    """id, along: the lowest positive invert of the nodes (id, x, y, invert) along a pipe, within tol of it but of neither of its ends."""
    ok = settled(nodes.withColumn("invert", finite(F.col("invert"))).filter("invert > 0").select("id", "x", "y", "invert"))
    hits = points_on_lines(ok.select("id", "x", "y"), pipes, tol).filter(F.col("d_ends") > tol)
    return hits.join(ok.select(F.col("id").alias("pt"), "invert"), "pt").groupBy(F.col("line").alias("id")).agg(F.min("invert").alias("along"))


def network_levels(pipes: DataFrame, nodes: DataFrame, beds: DataFrame, tol: float) -> DataFrame:
    """pt, id, end, value, source of the ends of pipes (id, geometry, up, down), filled along the network.

    Sources as in fixed_point_levels: other pipes at the node, nodes (id, x, y,
    invert) along the pipe, beds (id, end, bed), the pipe's other end; 0 was there.
    """
    ends = settled(clustered_ends(pipes.select("id", "geometry"), tol))
    along = interior_inverts(pipes.select("id", "geometry"), nodes, tol)
    own = pipes.select("id", finite(F.col("up")).alias("up"), finite(F.col("down")).alias("down"))
    at = ends.join(own, "id").join(along, "id", "left").join(beds, ["id", "end"], "left")
    pt = F.col("id") * 2 + F.when(F.col("end") == "start", 0).otherwise(1)
    got = fixed_point_levels(at.select(pt.alias("pt"), "id", "node", "along", "bed", F.when(F.col("end") == "start", F.col("up")).otherwise(F.col("down")).alias("value")))
    return got.select("pt", F.floor(F.col("pt") / 2).cast("bigint").alias("id"), F.when(F.col("pt") % 2 == 0, "start").otherwise("end").alias("end"), "value", "source")


def resampled_sections(locations: DataFrame, definitions: DataFrame, branches: DataFrame, tiles: DataFrame, grid: float) -> tuple[DataFrame, DataFrame]:
    """(locations, definitions) with a profile of its own, put on the DEM, for every location of a trapezium.

    locations: id, branch, definition, fraction, ...; definitions: name, bottom,
    top, ...; branches: code, geometry. A location's profile is named
    definition__branch; its bottom is the DEM at the location, its top rises by as
    much. Locations off the DEM or without a branch keep theirs; definitions that
    nothing refers to any more are dropped; of locations with one name the last,
    by id, is the one that counts.
    """
    rows = locations.select("id", "branch", "definition", "fraction").join(definitions.select(F.col("name").alias("definition")).distinct(), "definition", "left_semi")
    line = branches.select(F.col("code").alias("branch"), G.line(F.col("geometry")).alias("c")).filter("c is not null").dropDuplicates(["branch"])
    spot = rows.join(line, "branch").withColumn("p", G.at_distance(F.col("c"), F.col("fraction") * G.length(F.col("c")))).select("id", F.col("p.x").alias("x"), F.col("p.y").alias("y"))
    dem = settled(sample(settled(spot), tiles, grid).filter("z is not null"))
    name = F.concat_ws("__", "definition", "branch")
    moved = settled(rows.join(dem, "id").withColumn("new", name))
    last = moved.groupBy("new").agg(F.max_by(F.struct("definition", "z"), "id").alias("m"))
    made = definitions.join(last.select("new", F.col("m.definition").alias("name"), F.col("m.z").alias("z")), "name").select(*[F.col("new").alias("name") if c == "name" else F.col("z").alias("bottom") if c == "bottom" else (F.col("top") + F.col("z")).alias("top") if c == "top" else F.col(c) for c in definitions.columns])
    new = locations.join(moved.select("id", "new"), "id", "left").select(*[F.coalesce("new", "definition").alias("definition") if c == "definition" else F.col(c) for c in locations.columns])
    kept = definitions.join(new.select(F.col("definition").alias("name")).distinct(), "name", "left_semi")
    return new, kept.unionByName(made)


def boundary_setup(boundaries: DataFrame, branches: DataFrame, locations: DataFrame, profiles: DataFrame, level_codes: list[str], velocity: float = 1.0, coef: float = 0.85, fraction: float = 1.0, tol: float = 0.01, level: float | None = None) -> DataFrame:
    """boundaries (code, x, y) with branch, bed, depth, area, kind, waterlevel, discharge from the profile of the branch that ends there.

    branches: id, code, geometry; locations: id, branch, definition, shift, of
    which a branch's first counts; profiles as flow_areas takes them, with
    definition. Codes in level_codes get a water level, the given one or bed plus
    depth; the others the discharge of the filled profile. A boundary without a
    branch end within tol, or without a profile, is an error.
    """
    pts = settled(boundaries.select("code", "x", "y").withColumn("id", F.monotonically_increasing_id()))
    ends = settled(line_ends(branches).select((F.col("id") * 2 + F.when(F.col("end") == "start", 0).otherwise(1)).alias("id"), "x", "y"))
    near = points_within(pts.select("id", "x", "y"), SortedPoints(ends), tol).groupBy("id1").agg(F.min(F.struct("distance", "id2")).alias("b"))
    of = near.select(F.col("id1").alias("id"), F.floor(F.col("b.id2") / 2).cast("bigint").alias("line")).join(branches.select(F.col("id").alias("line"), F.col("code").alias("branch")), "line")
    w = Window.partitionBy("branch").orderBy("id")
    first = locations.withColumn("__k", F.row_number().over(w)).filter("__k = 1").select("branch", "definition", F.coalesce(finite(F.col("shift")), F.lit(0.0)).alias("shift"))
    areas = flow_areas(profiles, fraction).select("definition", F.coalesce("bed", F.lit(0.0)).alias("own_bed"), "flow_depth", "area")
    j = pts.join(of, "id", "left").join(first, "branch", "left").join(areas, "definition", "left")
    why = F.when(F.col("branch").isNull(), "no branch end at ").when(F.col("area").isNull(), "no profile for ")
    fine = j.withColumn("bed", F.when(why.isNotNull(), F.raise_error(F.concat(why, "code")).cast("double")).otherwise(F.col("own_bed") + F.col("shift")))
    is_level = F.col("code").isin(list(level_codes))
    value = F.lit(level).cast("double") if level is not None else F.col("bed") + F.col("flow_depth")
    return fine.select("code", "x", "y", "branch", "bed", F.col("flow_depth").alias("depth"), "area", F.when(is_level, "waterlevel").otherwise("discharge").alias("kind"), F.when(is_level, value).alias("waterlevel"), F.when(~is_level, F.lit(coef * velocity) * F.col("area")).alias("discharge"))
