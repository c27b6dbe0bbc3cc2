"""Cross-sections, levels and storage along branches: what a model of the network needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import geometry as G

#: Rules that turn a device into a structure.
STRUCTURES = {"overlaat": "weir", "onderlaat": "orifice"}


def located(locations: DataFrame, branches: DataFrame, definitions: DataFrame) -> DataFrame:
    """branch, definition, chainage, shift: locations of branches that exist, their fraction turned into a distance.

    locations: branch, definition, fraction, shift; branches: branch, length;
    definitions: definition. Only defined profiles stay.
    """
    return locations.join(branches, "branch").join(definitions.select("definition").distinct(), "definition", "left_semi").select("branch", "definition", (F.col("fraction") * F.col("length")).alias("chainage"), F.coalesce(C.finite(F.col("shift")), F.lit(0.0)).alias("shift"))


def flow_areas(profiles: DataFrame, fraction: float) -> DataFrame:
    """profiles (kind, diameter, width, height, bottom, slope, bed, top) with depth and area at a fraction of full depth."""
    f = F.lit(fraction)
    bed = F.coalesce("bed", F.lit(0.0))
    depth = F.when(F.col("kind") == "circle", f * F.col("diameter")).when(F.col("kind") == "rectangle", f * F.col("height")).otherwise(f * (F.coalesce("top", bed + 2.0) - bed))
    area = F.when(F.col("kind") == "circle", C.circle_segment_area(F.col("diameter"), f)).when(F.col("kind") == "rectangle", C.rectangle_area(F.col("width"), F.col("height"), f)).otherwise(C.trapezium_area(F.col("bottom"), F.col("slope"), F.col("bed"), F.col("top"), f))
    return profiles.withColumns({"flow_depth": depth, "area": area})


def shifts(hits: DataFrame, fallback: DataFrame, margin: float = 0.0) -> DataFrame:
    """branch, shift: the highest floor of the nodes on each branch; nodes on none count for their nearest branch.

    hits: branch, node, floor; fallback: branch, node, floor of nodes without a hit.
    """
    rest = fallback.join(hits.select("node").distinct(), "node", "left_anti")
    return hits.unionByName(rest).groupBy("branch").agg((F.max("floor") + margin).alias("shift"))


def violations(nodes: DataFrame, incident: DataFrame, tol: float = 1e-6) -> DataFrame:
    """nodes, above, without: how many nodes (node, floor) there are, have their floor above the lowest bed of the branches at them, and no bed at all.

    incident: node, bed - a row for each branch at a node, its bed NULL if it carries none.
    """
    low = incident.filter(C.finite(F.col("bed")).isNotNull()).groupBy("node").agg(F.min("bed").alias("bed"))
    j = nodes.join(low, "node", "left")
    return j.agg(F.count(F.lit(1)).alias("nodes"), F.count_if(F.col("floor") > F.col("bed") + tol).alias("above"), F.count_if(F.col("bed").isNull()).alias("without"))


def lowered_floors(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """nodes (node, floor) with new_floor: not above the lowest branch end at the node (node, level)."""
    low = ends.filter(C.finite(F.col("level")).isNotNull()).groupBy("node").agg(F.min("level").alias("low"))
    return nodes.join(low, "node", "left").select("node", "floor", F.least("floor", F.coalesce("low", "floor")).alias("new_floor"))


def storage_tables(long: DataFrame) -> DataFrame:
    """code, levels, areas: stage-storage rows (code, level, area) as text lists in level order; a single row becomes a prism of two levels."""
    pts = F.array_sort(F.collect_list(F.struct("level", "area")))
    g = long.groupBy("code").agg(pts.alias("p"))
    p = F.when(F.size("p") == 1, F.array(F.element_at("p", 1), F.struct((F.element_at("p", 1)["level"] + 1.0).alias("level"), F.element_at("p", 1)["area"].alias("area")))).otherwise(F.col("p"))
    text = lambda key: F.array_join(F.transform("q", lambda v: F.format_string("%.2f", v[key])), " ")
    return g.withColumn("q", p).select("code", text("level").alias("levels"), text("area").alias("areas"))


def bad_storage(nodes: DataFrame) -> DataFrame:
    """Storage nodes that no model accepts: no level, street below bed, or no area."""
    ok = C.finite(F.col("bed")).isNotNull() & C.finite(F.col("street")).isNotNull() & (F.col("street") > F.col("bed")) & (F.col("area") > 0)
    return nodes.filter(~F.coalesce(ok, F.lit(False)))


def checked_storage(nodes: DataFrame, name: str = "code") -> DataFrame:
    """nodes as they are; reading one that no model accepts is an error that names it."""
    ok = C.finite(F.col("bed")).isNotNull() & C.finite(F.col("street")).isNotNull() & (F.col("street") > F.col("bed")) & (F.col("area") > 0)
    return nodes.withColumn("bed", F.when(F.coalesce(ok, F.lit(False)), F.col("bed")).otherwise(F.raise_error(F.concat(F.lit("bad storage at "), F.coalesce(F.col(name).cast("string"), F.lit("?")))).cast("double")))


def structures(devices: DataFrame, weirs: DataFrame) -> DataFrame:
    """device, kind, weir, crest: devices (fid, stuwid, overlaatonderlaat) of weirs (globalid, crest) by their rule; others left out."""
    kind = C.lookup(F.lower(F.trim("overlaatonderlaat")), STRUCTURES)
    return devices.withColumn("kind", kind).filter("kind is not null").join(weirs.select(F.col("globalid").alias("stuwid"), F.col("fid").alias("weir"), "crest"), "stuwid").select(F.col("fid").alias("device"), "kind", "weir", "crest")


def initial_depths(nodes: DataFrame, manholes: float, lakes: float, prefix: tuple[str, ...] = ("M_", "I_", "RD_")) -> DataFrame:
    return nodes.select("fid", F.when(C.has_prefix(F.col("code"), prefix), manholes).otherwise(lakes).alias("depth"))


def boundary_points(ends: DataFrame, lines: DataFrame, side: str = "both") -> DataFrame:
    """id, end, x, y, code: boundary points at dangling ends of lines, numbered in line order."""
    g = lines.select("id", G.line(F.col("geometry")).alias("c"))
    p = F.when(F.col("end") == "start", G.start(F.col("c"))).otherwise(G.end(F.col("c")))
    e = ends if side == "both" else ends.filter(F.col("end") == side)
    return e.join(g, "id").select("id", "end", p["x"].alias("x"), p["y"].alias("y"), F.concat(F.lit("BC_"), F.col("id").cast("string"), F.lit("_"), F.col("end")).alias("code"))


def beds(pipes: DataFrame, rivers: DataFrame) -> DataFrame:
    """branch, bed: the lower end of pipes (branch, up, down), and the least shifted profile bed of rivers (branch, bed, shift)."""
    a = pipes.select("branch", F.least("up", "down").alias("bed"))
    b = rivers.select("branch", (F.col("bed") + F.coalesce("shift", F.lit(0.0))).alias("bed"))
    return a.unionByName(b).groupBy("branch").agg(F.min("bed").alias("bed"))


def remapped(locations: DataFrame, definitions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(locations on per-branch definitions named base__branch, definitions without orphans)."""
    new = locations.withColumn("name", F.concat_ws("__", "definition", "branch"))
    per = new.join(definitions, "definition").select("name", *[c for c in definitions.columns if c != "definition"]).dropDuplicates(["name"])
    return new.select("branch", F.col("name").alias("definition")), per.withColumnRenamed("name", "definition")


def beds_around(points: DataFrame, culverts: DataFrame) -> DataFrame:
    """branch, at, bed: bed of pipe grid points (branch, at) from the culverts (branch, pos, bed) before, on or behind them."""
    j = points.join(culverts, "branch", "left")
    before = F.max(F.when(F.col("pos") <= F.col("at"), F.struct("pos", "bed")))
    after = F.min(F.when(F.col("pos") > F.col("at"), F.struct("pos", "bed")))
    return j.groupBy("branch", "at").agg(before.alias("b"), after.alias("a")).select("branch", "at", F.coalesce(F.col("b.bed"), F.col("a.bed")).alias("bed"))


def ordered_profile(points: DataFrame) -> DataFrame:
    """name, n, ys, zs: profile points (name, order, y, z) as text lists in order."""
    g = points.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("order", "y", "z"))).alias("p"))
    text = lambda k: F.array_join(F.transform("p", lambda v: F.format_string("%.3f", v[k])), " ")
    return g.select("name", F.size("p").alias("n"), text("y").alias("ys"), text("z").alias("zs"))


def last_by_name(definitions: DataFrame, order: str) -> DataFrame:
    w = Window.partitionBy("name").orderBy(F.col(order).desc())
    return definitions.withColumn("__k", F.row_number().over(w)).filter("__k = 1").drop("__k")
