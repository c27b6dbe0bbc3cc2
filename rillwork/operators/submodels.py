"""Cutting a region into submodels: which part a feature belongs to, what goes with it, links between parts, cut ends, and edits by hand.

Defined results for dirty input: features without usable geometry belong to no
part; NULL keys refer to nothing; repeated rows each count; empty tables give
empty results; further columns are carried along untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..session import settled
from .graph import line_ends
from .near import SortedPoints, lines_within, points_within, regions_containing
from .network import clean_lines, crossing_segments, cut_directions, split_at

#: Which column of an aspatial table refers to which table, parents first.
REFERENCES = {
    "pomp": [("gemaalid", "gemaal")],
    "sturing": [("pompid", "pomp")],
    "kunstwerkopening": [("stuwid", "stuw")],
    "regelmiddel": [("kunstwerkopeningid", "kunstwerkopening"), ("stuwid", "stuw")],
    "profielgroep": [("brugid", "brug"), ("stuwid", "stuw")],
    "ruwheidprofiel": [("profielpuntid", "profielpunt")],
}


# Small rules -------------------------------------------------------------------------------------------------


def protected(removal: DataFrame, keep: DataFrame, key: str = "code") -> DataFrame:
    """The rows of a removal list whose key isn't on the list of what must stay."""
    return removal.join(keep.select(key).distinct(), key, "left_anti").select(*removal.columns)


def without_rings(lines: DataFrame, tol: float = 1e-6) -> DataFrame:
    """lines (id, geometry, ...) without those that end where they start."""
    c = G.line(F.col("geometry"))
    return lines.filter(~F.coalesce(G.distance(G.start(c), G.end(c)) < tol, F.lit(False)))


def lifted(points: DataFrame, column: str, name: str = "code") -> DataFrame:
    """points (geometry) with z from a column; a NULL or non-finite value is an error that names the point."""
    z = F.col(column).cast("double")
    bad = z.isNull() | F.isnan(z) | (F.abs(z) == F.lit(float("inf")))
    safe = F.when(bad, F.raise_error(F.concat(F.lit(f"no usable {column} at "), F.coalesce(F.col(name).cast("string"), F.lit("?")))).cast("double")).otherwise(z)
    return points.withColumn("geometry", F.struct(F.col("geometry.x").alias("x"), F.col("geometry.y").alias("y"), safe.alias("z")))


def chosen_regions(regions: DataFrame, key: str, columns: tuple[str, ...] = ("wtshname", "wtshunit")) -> DataFrame:
    """The regions whose name or code is key, whatever its case; an error that names up to 200 there are if none is."""
    want = F.upper(F.trim(F.lit(key)))
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.upper(F.trim(F.col(c))) == want, F.lit(False))
    found = regions.filter(hit)
    if found.isEmpty():
        there = [" / ".join(str(v) for v in r) for r in regions.select(*columns).distinct().orderBy(*columns).limit(200).collect()]
        raise ValueError(f"no region {key!r}; there are {', '.join(there)}")
    return found


def in_both(a: DataFrame, b: DataFrame, key: str = "code") -> DataFrame:
    """The keys that stand on two lists which exclude each other."""
    return a.select(key).intersect(b.select(key)).filter(F.col(key).isNotNull())


def piece_catalogue(layers: dict[str, DataFrame]) -> DataFrame:
    """prefix, code, geometry of the lines (objectid, geometry) that pieces may be named after: prefix and number."""
    out = None
    for prefix, df in layers.items():
        p = df.select(F.lit(prefix).alias("prefix"), F.concat(F.lit(prefix), F.col("objectid").cast("bigint").cast("string")).alias("code"), G.line(F.col("geometry")).alias("geometry")).filter("geometry is not null and code is not null")
        out = p if out is None else out.unionByName(p)
    return out


def station_series(stations: DataFrame, regions: DataFrame, series: DataFrame) -> DataFrame:
    """The readings (station, time, ...) of stations (station, x, y) inside a region (id, geometry), each station's newest first.

    Stations are sorted across partitions, so that writing them partitioned by
    station gives a file or few for each.
    """
    numbered = settled(stations.select("station", "x", "y").distinct().withColumn("id", F.monotonically_increasing_id()))
    inside = regions_containing(regions, SortedPoints(numbered.select("id", "x", "y"))).select(F.col("id2").alias("id")).distinct()
    mine = numbered.join(inside, "id", "left_semi").select("station").distinct()
    return series.join(mine, "station", "left_semi").repartitionByRange("station", F.col("time").desc()).sortWithinPartitions("station", F.col("time").desc())


# Parts -------------------------------------------------------------------------------------------------------


def part_of(points: DataFrame, parts: DataFrame) -> DataFrame:
    """id, part: the first part (id, geometry), by number, that contains a point (id, x, y); NULL outside all."""
    inside = regions_containing(parts, SortedPoints(points)).groupBy(F.col("id2").alias("id")).agg(F.min("id1").alias("part"))
    return points.select("id").join(inside, "id", "left")


def lines_in_parts(lines: DataFrame, parts: DataFrame, strict: bool = False) -> DataFrame:
    """id, part of lines (id, geometry): the part their midpoint lies in; strict: only if all vertices lie in it and no edge of it is crossed."""
    c = settled(clean_lines(lines))
    m = c.withColumn("m", G.midpoint(F.col("c")))
    of = part_of(m.select("id", F.col("m.x").alias("x"), F.col("m.y").alias("y")), parts)
    if not strict:
        return lines.select("id").join(of, "id", "left")
    pts = settled(c.select("id", F.explode("c").alias("p")).select(F.monotonically_increasing_id().alias("pt"), "id", "p.x", "p.y"))
    inside = regions_containing(parts, SortedPoints(pts.select(F.col("pt").alias("id"), "x", "y"))).select(F.col("id1").alias("part"), F.col("id2").alias("pt")).join(pts, "pt").groupBy("id", "part").agg(F.count(F.lit(1)).alias("in"))
    whole = inside.join(c.select("id", F.size("c").alias("n")), "id").filter(F.col("in") == F.col("n"))
    edges = parts.select(F.col("id").alias("part"), F.explode("geometry").alias("geometry")).withColumn("id", F.monotonically_increasing_id())
    edges = settled(edges)
    crossed = crossing_segments(c.select("id", F.col("c").alias("geometry")), edges.select((-F.col("id") - 1).alias("id"), F.concat("geometry", F.slice("geometry", 1, 1)).alias("geometry"))).join(edges.select((-F.col("id") - 1).alias("b"), "part"), "b").select(F.col("a").alias("id"), "part").distinct()
    return lines.select("id").join(whole.join(crossed, ["id", "part"], "left_anti").groupBy("id").agg(F.min("part").alias("part")), "id", "left")


def near_parts(lines: DataFrame, parts: DataFrame, tol: float) -> DataFrame:
    """id, part: the parts within tol of a line (id, geometry): those that contain a point of it or whose border comes that near."""
    c = settled(clean_lines(lines))
    vertices = settled(c.select("id", F.explode("c").alias("p")).select(F.monotonically_increasing_id().alias("pt"), "id", "p.x", "p.y"))
    sorted_points = SortedPoints(vertices.select(F.col("pt").alias("id"), "x", "y"))
    inside = regions_containing(parts, sorted_points).select(F.col("id1").alias("part"), F.col("id2").alias("pt"))
    rings = settled(parts.select(F.col("id").alias("part"), F.explode("geometry").alias("g")).select("part", F.monotonically_increasing_id().alias("id"), F.concat("g", F.slice("g", 1, 1)).alias("geometry")))
    # exact: vertices of either against the edges of the other, and crossings
    by_line = lines_within(rings.select("id", "geometry"), sorted_points, tol).join(vertices.select(F.col("pt").alias("id2"), "id"), "id2").join(rings.select(F.col("id").alias("id1"), "part"), "id1").select("id", "part")
    corners = settled(rings.select("part", F.explode("geometry").alias("p")).select("part", F.monotonically_increasing_id().alias("pt"), "p.x", "p.y"))
    by_ring = lines_within(c.select("id", F.col("c").alias("geometry")), SortedPoints(corners.select(F.col("pt").alias("id"), "x", "y")), tol).join(corners.select(F.col("pt").alias("id2"), "part"), "id2").select(F.col("id1").alias("id"), "part")
    crossed = crossing_segments(c.select("id", F.col("c").alias("geometry")), rings.select((-F.col("id") - 1).alias("id"), "geometry")).join(rings.select((-F.col("id") - 1).alias("b"), "part"), "b").select(F.col("a").alias("id"), "part")
    return inside.join(vertices.select("pt", "id"), "pt").select("id", "part").unionByName(by_line).unionByName(by_ring).unionByName(crossed).distinct()


def parts_at_ends(lines: DataFrame, parts: DataFrame, tol: float) -> DataFrame:
    """id, part: the parts the ends of lines lie in, or else the nearest part within tol of an end."""
    ends = settled(line_ends(lines).select((F.col("id") * 2 + F.when(F.col("end") == "start", 0).otherwise(1)).alias("id"), "x", "y"))
    inside = settled(regions_containing(parts, SortedPoints(ends)).select(F.col("id2").alias("pt"), F.col("id1").alias("part")))
    out = settled(ends.join(inside.select(F.col("pt").alias("id")).distinct(), "id", "left_anti"))
    rings = settled(parts.select(F.col("id").alias("part"), F.explode("geometry").alias("g")).select("part", F.monotonically_increasing_id().alias("id"), F.concat("g", F.slice("g", 1, 1)).alias("geometry")))
    near = lines_within(rings, SortedPoints(out), tol).join(rings.select(F.col("id").alias("id1"), "part"), "id1").groupBy(F.col("id2").alias("pt")).agg(F.min(F.struct(F.round("distance", 9).alias("d"), "part")).alias("b")).select("pt", "b.part")
    return inside.unionByName(near).select(F.floor(F.col("pt") / 2).cast("bigint").alias("id"), "part").distinct()


def part_links(drains: DataFrame, culverts: DataFrame, borders: DataFrame, parts: DataFrame, side: float = 30.0, snap: float = 60.0) -> DataFrame:
    """kind, id, role, connects: what joins parts: open drains that are or meet a border branch, and culverts that cross one.

    drains, borders: id, code, geometry; culverts: id, geometry. connects: the
    numbers of the parts, ascending, with bars between: those within `side` of a
    drain, or those the ends of a culvert lie in or, within `snap`, near.
    """
    used = drains.join(borders.select("code").distinct(), "code", "left_semi").select("id", F.lit("used_as_boundary").alias("role"))
    lines = borders.select((-F.col("id") - 1).alias("id"), "geometry")
    met = crossing_segments(drains.select("id", "geometry"), lines).select(F.col("a").alias("id")).distinct().join(used, "id", "left_anti").withColumn("role", F.lit("connected"))
    role = settled(used.unionByName(met))
    crossing = settled(crossing_segments(culverts.select("id", "geometry"), lines).select(F.col("a").alias("id")).distinct())
    listed = lambda df: df.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_set("part")), lambda p: p.cast("string")), "|").alias("connects"))
    a = role.join(listed(near_parts(drains.select("id", "geometry").join(role, "id", "left_semi"), parts, side)), "id", "left")
    b = crossing.join(listed(parts_at_ends(culverts.select("id", "geometry").join(crossing, "id", "left_semi"), parts, snap)), "id", "left")
    out = a.select(F.lit("open_drain").alias("kind"), "id", "role", "connects").unionByName(b.select(F.lit("gravity_main").alias("kind"), "id", F.lit("crossing").alias("role"), "connects"))
    return out.withColumn("connects", F.coalesce("connects", F.lit("")))


def submodel(part: int, assigned: dict[str, DataFrame], tables: dict[str, DataFrame], locations: DataFrame, definitions: dict[str, DataFrame], near: dict[str, float], lines: tuple[str, ...] = ("hydroobject", "duikersifonhevel")) -> tuple[dict[str, DataFrame], DataFrame]:
    """(tables of one part, standalone nodes that were left out as src_layer, id).

    assigned: layers with id, geometry and part. near: layers of points (geometry
    struct) whose rows stay only within so many metres of a branch that stays.
    Aspatial tables follow their references, cross-section locations (branch_id)
    their branch code, and definitions (name) their locations.
    """
    mine = {n: df.filter(F.col("part") == part).drop("part") for n, df in assigned.items()}
    network = None
    for n in lines:
        if n in mine:
            ls = mine[n].select("id", "geometry")
            network = ls if network is None else network.unionByName(ls)
    network = settled(network)
    alone = None
    for n, tol in near.items():
        pts = mine[n].select("id", F.col("geometry.x").alias("x"), F.col("geometry.y").alias("y"))
        hit = settled(lines_within(network, SortedPoints(pts), tol).select(F.col("id2").alias("id")).distinct())
        lost = mine[n].join(hit, "id", "left_anti").select(F.lit(n).alias("src_layer"), "id")
        alone = lost if alone is None else alone.unionByName(lost)
        mine[n] = mine[n].join(hit, "id", "left_semi")
    for name, refs in REFERENCES.items():
        if name in tables:
            known = {p: mine[p] for _, p in refs if p in mine}
            use = [(c, p, "globalid") for c, p in refs if p in known and c in tables[name].columns]
            mine[name] = _kept(tables[name], known, use) if use else tables[name].limit(0)
    codes = None
    for n in lines:
        if n in mine and "code" in mine[n].columns:
            codes = mine[n].select("code") if codes is None else codes.unionByName(mine[n].select("code"))
    if codes is not None:
        here = locations.join(codes.distinct().withColumnRenamed("code", "branch_id"), "branch_id", "left_semi")
        mine["crosssection_location"] = here
        used = here.select(F.col("definition").alias("name")).distinct()
        for n, df in definitions.items():
            mine[f"{n}_definition"] = df.join(used, "name", "left_semi")
    return mine, alone if alone is not None else network.select(F.lit("").alias("src_layer"), "id").limit(0)


def _kept(table: DataFrame, parents: dict[str, DataFrame], refs: list[tuple[str, str, str]]) -> DataFrame:
    """Rows of a table that refer, through any of their keys, to a parent that stays; each once."""
    hit = F.lit(False)
    out = table
    for i, (column, parent, pkey) in enumerate(refs):
        keys = parents[parent].select(F.col(pkey).alias(f"__k{i}")).filter(F.col(f"__k{i}").isNotNull()).distinct()
        out = out.join(keys, F.col(column) == F.col(f"__k{i}"), "left")
        hit = hit | F.col(f"__k{i}").isNotNull()
    return out.filter(hit).select(*table.columns)


# Cut ends ------------------------------------------------------------------------------------------------------


def _degrees(ends: DataFrame, all_ends: DataFrame, tol: float) -> DataFrame:
    """id, degree: how many of all_ends lie within tol of each end (both id, x, y)."""
    # places instead of ends: ends that coincide are counted, not paired
    at = settled(all_ends.groupBy("x", "y").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")))
    near = points_within(ends, SortedPoints(at.select("id", "x", "y")), tol).select("id1", F.col("id2").alias("id"))
    return near.join(at.select("id", "n"), "id").groupBy(F.col("id1").alias("id")).agg(F.sum("n").alias("degree"))


def cut_ends(branches: DataFrame, master: DataFrame, boundaries: DataFrame, prefixes: tuple[str, ...] = ("R_",), tol: float = 0.01) -> DataFrame:
    """id, code, end, x, y: ends of branches that are open in the submodel but weren't in the master network.

    branches, master: id, code, geometry. boundaries: points (id, x, y); an end
    that has one is left out.
    """
    point = lambda e: (F.col("id") * 2 + F.when(F.col("end") == "start", 0).otherwise(1)).alias("id")
    ends = settled(line_ends(branches).select(point("id"), "x", "y"))
    whole = settled(line_ends(master).select(point("id"), "x", "y"))
    open_ = _degrees(ends, ends, tol).filter("degree = 1").select("id")
    had = _degrees(ends.join(open_, "id", "left_semi"), whole, tol).filter("degree > 1").select("id")
    cut = settled(ends.join(had, "id", "left_semi"))
    held = points_within(cut, SortedPoints(boundaries), tol).select(F.col("id1").alias("id")).distinct()
    of = cut.join(held, "id", "left_anti").select(F.floor(F.col("id") / 2).cast("bigint").alias("id"), F.when(F.col("id") % 2 == 0, "start").otherwise("end").alias("end"), "x", "y")
    kind = F.lit(False)
    for p in prefixes:
        kind = kind | F.startswith(F.col("code"), F.lit(p))
    return of.join(branches.select("id", "code"), "id").filter(kind).select("id", "code", "end", "x", "y")


def cut_boundaries(cuts: DataFrame, master: DataFrame, beds: DataFrame, level: float = 0.1, inflow: float = 0.0, tol: float = 0.01) -> DataFrame:
    """cuts (rows of cut_ends) with direction, rule, z_cut, z_far, z_beyond, neighbours, waterlevel, discharge.

    beds: code, z_start, z_end. The bed beyond is the lowest at the far ends of the
    master's other lines that meet there; the rule is that of cut_directions.
    """
    ends = settled(line_ends(master).withColumn("pt", F.col("id") * 2 + F.when(F.col("end") == "start", 0).otherwise(1)).join(master.select("id", F.col("code").alias("m_code")), "id"))
    spot = settled(cuts.withColumn("cut", F.col("id") * 2 + F.when(F.col("end") == "start", 0).otherwise(1)))
    near = points_within(spot.select(F.col("cut").alias("id"), "x", "y"), SortedPoints(ends.select(F.col("pt").alias("id"), "x", "y")), tol).select(F.col("id1").alias("cut"), F.col("id2").alias("pt"))
    other = near.join(ends.select("pt", "m_code", F.col("end").alias("m_end")), "pt").join(spot.select("cut", "code"), "cut").filter("m_code <> code")
    b = beds.select(F.col("code").alias("b_code"), "z_start", "z_end")
    beyond = other.join(b, F.col("m_code") == F.col("b_code"), "left").groupBy("cut").agg(F.min(F.when(F.col("m_end") == "start", F.col("z_end")).otherwise(F.col("z_start"))).alias("z_beyond"), F.array_join(F.array_sort(F.collect_set("m_code")), ",").alias("neighbours"))
    own = spot.join(b, F.col("code") == F.col("b_code"), "left").join(beyond, "cut", "left")
    at_start = F.col("end") == "start"
    own = own.withColumns({"z_cut": F.when(at_start, F.col("z_start")).otherwise(F.col("z_end")), "z_far": F.when(at_start, F.col("z_end")).otherwise(F.col("z_start")), "is_pipe": F.startswith(F.col("code"), F.lit("C_"))})
    told = cut_directions(own)
    out = F.col("direction") == "outflow"
    return told.select(*cuts.columns, "direction", "rule", "z_cut", "z_far", "z_beyond", F.coalesce("neighbours", F.lit("")).alias("neighbours"), F.when(out, F.lit(level)).alias("waterlevel"), F.when(~out, F.lit(inflow)).alias("discharge"))


# Edits by hand -------------------------------------------------------------------------------------------------


def culvert_code(code: Column) -> Column:
    """The culvert of a pipe branch: DU_n for C_n."""
    return F.concat(F.lit("DU_"), F.substr(code, F.lit(3)))


def edited(sub: dict[str, DataFrame], master: dict[str, DataFrame], keep: DataFrame, remove: DataFrame, tol: float = 0.5, end_tol: float = 0.01) -> dict[str, DataFrame]:
    """The tables of a submodel with branches taken over from the master (keep: code) and others taken out (remove: code).

    Tables: hydroobject and duikersifonhevel (id, code, geometry), storagenodes
    and boundaries (id, code, x, y), crosssection_location (branch_id, definition),
    definition (name). A branch brings its culvert, the nodes within tol of it, the
    boundaries within end_tol of its ends, its sections and their definitions; one
    that goes takes along the nodes and boundaries that no other branch holds. A
    code on both lists, or one to keep that the master lacks, is an error.
    """
    clash = in_both(keep, remove).limit(20).collect()
    if clash:
        raise ValueError(f"to keep and to remove: {', '.join(r['code'] for r in clash)}")
    lacking = keep.select("code").distinct().join(master["hydroobject"].select("code"), "code", "left_anti").limit(20).collect()
    if lacking:
        raise ValueError(f"not in the master: {', '.join(r['code'] for r in lacking)}")
    have = sub["hydroobject"].select("code")
    add = settled(keep.select("code").distinct().join(have, "code", "left_anti"))
    out = settled(remove.select("code").distinct().join(have, "code", "left_semi"))
    du = lambda df: df.select(culvert_code(F.col("code")).alias("code"))
    got: dict[str, DataFrame] = {}
    changed = {"hydroobject": (add, out), "duikersifonhevel": (du(add), du(out))}
    for name, (plus, minus) in changed.items():
        got[name] = settled(sub[name].join(minus, "code", "left_anti").unionByName(master[name].join(plus, "code", "left_semi"), allowMissingColumns=True))
    new_lines = settled(master["hydroobject"].join(add, "code", "left_semi").select("id", "geometry"))
    old_lines = settled(sub["hydroobject"].join(out, "code", "left_semi").select("id", "geometry"))
    rest = settled(got["hydroobject"].select("geometry").unionByName(got["duikersifonhevel"].select("geometry")).withColumn("id", F.monotonically_increasing_id()).select("id", "geometry"))

    def on(points: DataFrame, lines: DataFrame, reach: float) -> DataFrame:
        return settled(lines_within(lines, SortedPoints(points.select("id", "x", "y")), reach).select(F.col("id2").alias("id")).distinct())

    def at_ends(points: DataFrame, lines: DataFrame) -> DataFrame:
        ends = line_ends(lines).select((F.col("id") * 2 + F.when(F.col("end") == "start", 0).otherwise(1)).alias("id"), "x", "y")
        return settled(points_within(ends, SortedPoints(points.select("id", "x", "y")), end_tol).select(F.col("id2").alias("id")).distinct())

    for name, held, touches in (("storagenodes", lambda p, ls: on(p, ls, tol), lambda p: on(p, rest, tol)), ("boundaries", at_ends, lambda p: on(p, rest, end_tol))):
        mine, theirs = sub[name], master[name]
        gone = held(mine, old_lines).join(touches(mine), "id", "left_anti")
        came = theirs.join(held(theirs, new_lines), "id", "left_semi").join(mine.select("code"), "code", "left_anti")
        got[name] = mine.join(gone, "id", "left_anti").unionByName(came, allowMissingColumns=True)
    loc, mloc = sub["crosssection_location"], master["crosssection_location"]
    as_branch = lambda df: df.select(F.col("code").alias("branch_id"))
    more = mloc.join(as_branch(add), "branch_id", "left_semi").join(loc.select("branch_id").distinct(), "branch_id", "left_anti")
    alive = as_branch(got["hydroobject"]).unionByName(as_branch(got["duikersifonhevel"])).distinct()
    got["crosssection_location"] = settled(loc.join(as_branch(out), "branch_id", "left_anti").unionByName(more, allowMissingColumns=True).join(alive, "branch_id", "left_semi"))
    defs = sub["definition"].unionByName(master["definition"].join(sub["definition"].select("name"), "name", "left_anti"), allowMissingColumns=True)
    got["definition"] = defs.join(got["crosssection_location"].select(F.col("definition").alias("name")).distinct(), "name", "left_semi")
    return got


# Splits of converted data ---------------------------------------------------------------------------------------


def named_pieces(branches: DataFrame, nodes: DataFrame, catalogue: DataFrame | None, tol: float = 1.0) -> DataFrame:
    """host, piece, code, d0, d1, length, c: branches (id, code, geometry) cut at nodes (host, at), each piece with a code of its own.

    A piece takes the code of the catalogue's line (code, geometry) of its prefix
    that lies closest to it, its midpoint within tol, if their distance is at most
    tol or half the piece's length. The host's code stays with the piece so matched,
    or with the first; a code that is taken already, or none, gives <host>_<k>.
    """
    hosts = settled(branches.join(nodes.select(F.col("host").alias("id")).distinct(), "id", "left_semi"))
    cut = settled(split_at(hosts.select("id", "geometry"), nodes))
    p = cut.select(F.col("id").alias("host"), "piece", "d0", "d1", "c", (F.col("id") * 65536 + F.col("piece")).alias("no")).join(hosts.select(F.col("id").alias("host"), F.col("code").alias("host_code")), "host").withColumn("length", G.length(F.col("c")))
    p = settled(p)
    if catalogue is not None:
        src = settled(catalogue.select("prefix", F.col("code").alias("src"), "geometry").withColumn("id", F.monotonically_increasing_id()))
        lim = F.greatest(F.lit(tol), F.col("length") * 0.5)
        mids = p.withColumn("m", G.midpoint(F.col("c"))).select(F.col("no").alias("id"), F.col("m.x").alias("x"), F.col("m.y").alias("y"))
        near = lines_within(src.select("id", "geometry"), SortedPoints(mids), tol).select(F.col("id1").alias("s_id"), F.col("id2").alias("no"))
        others = branches.select(F.col("code").alias("taken")).distinct()
        cand = near.join(src.select(F.col("id").alias("s_id"), "prefix", "src", F.col("geometry").alias("sc")), "s_id").join(p, "no").filter(F.startswith(F.col("host_code"), F.col("prefix"))).join(others, F.col("src") == F.col("taken"), "left").filter(F.col("taken").isNull() | (F.col("src") == F.col("host_code")))
        far = lambda a, b: F.array_max(F.transform(a, lambda v: G.locate(b, v)["off"]))
        best = cand.withColumn("h", F.greatest(far(F.col("c"), F.col("sc")), far(F.col("sc"), F.col("c")))).filter(F.col("h") <= lim).groupBy("no").agg(F.min(F.struct(F.round("h", 9).alias("h"), "src")).alias("b")).select("no", F.col("b.src").alias("match"))
        p = p.join(best, "no", "left")
    else:
        p = p.withColumn("match", F.lit(None).cast("string"))
    w = Window.partitionBy("host")
    own = F.coalesce(F.min(F.when(F.col("match") == F.col("host_code"), F.col("piece"))).over(w), F.lit(0))
    p = settled(p.withColumn("own", F.col("piece") == own))
    # of several pieces that one source line matches, the first keeps its code
    first = F.row_number().over(Window.partitionBy(F.coalesce("match", F.concat_ws("|", "host", "piece"))).orderBy("host", "piece"))
    code = F.when(F.col("own"), F.col("host_code")).when(F.col("match").isNotNull() & (F.col("match") != F.col("host_code")) & (first == 1), F.col("match")).otherwise(F.concat_ws("_", "host_code", F.col("piece").cast("string")))
    return p.withColumn("code", code).select("host", "host_code", "piece", "code", "d0", "d1", "length", "c")


def cut_culverts(culverts: DataFrame, pieces: DataFrame) -> DataFrame:
    """code, up, down, length, c: culverts (code, up, down, geometry) cut as their branches were, levels interpolated along them.

    A culvert may run against its branch; a piece is named after the branch piece with the same midpoint.
    """
    c = culverts.select("code", "up", "down", G.line(F.col("geometry")).alias("k")).filter("k is not null")
    j = c.join(pieces.select(culvert_code(F.col("host_code")).alias("code"), F.col("code").alias("piece_code"), "d0", "d1", F.col("c").alias("pc")), "code")
    n = G.length(F.col("k"))
    a, b = G.locate(F.col("k"), G.start(F.col("pc")))["at"], G.locate(F.col("k"), G.end(F.col("pc")))["at"]
    at = j.withColumns({"n": n, "s0": F.least(a, b), "s1": F.greatest(a, b)})
    level = lambda s: F.when(F.col("n") > 0, F.col("up") + (F.col("down") - F.col("up")) * s / F.col("n")).otherwise(F.col("up"))
    return at.select(culvert_code(F.col("piece_code")).alias("code"), level(F.col("s0")).alias("up"), level(F.col("s1")).alias("down"), (F.col("s1") - F.col("s0")).alias("length"), G.cut(F.col("k"), F.col("s0"), F.col("s1")).alias("c"))


def copied_sections(locations: DataFrame, trapezia: DataFrame, pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(locations, trapezia) with every host's rows repeated for its other pieces; a profile named after the host gets a copy named after the piece."""
    other = pieces.filter("code <> host_code").select(F.col("host_code").alias("branch_id"), F.col("code").alias("piece_code"))
    names = trapezia.select("name").distinct().withColumn("is_trapezium", F.lit(True))
    rows = locations.join(other, "branch_id").join(names, F.col("definition") == F.col("name"), "left").drop("name")
    own = F.coalesce(F.col("is_trapezium"), F.lit(False)) & F.endswith(F.col("definition"), F.concat(F.lit("__"), F.col("branch_id")))
    new_name = F.concat(F.expr("substring(definition, 1, length(definition) - length(branch_id))"), F.col("piece_code"))
    rows = settled(rows.withColumn("renamed", F.when(own, new_name)))
    copies = rows.select(*[F.col("piece_code").alias("branch_id") if c == "branch_id" else F.coalesce("renamed", "definition").alias("definition") if c == "definition" else F.col(c) for c in locations.columns])
    made = rows.filter("renamed is not null").select(F.col("definition").alias("__from"), "renamed").distinct()
    more = trapezia.join(made, F.col("name") == F.col("__from")).select(*[F.col("renamed").alias("name") if c == "name" else F.col(c) for c in trapezia.columns])
    return locations.unionByName(copies), trapezia.unionByName(more)


def snapped_to_branch(points: DataFrame, branches: DataFrame, reach: float) -> DataFrame:
    """points (id, x, y, ...) within reach of a branch (id, code, geometry), with branch, chainage, off and their place on it; others are left out.

    What refers to those left out goes with them, by `closure`.
    """
    hits = lines_within(branches.select("id", "geometry"), SortedPoints(points.select("id", "x", "y")), reach).groupBy(F.col("id2").alias("id")).agg(F.min(F.struct(F.round("distance", 9).alias("d"), F.col("id1").alias("branch"))).alias("b")).select("id", "b.branch")
    c = clean_lines(branches).join(branches.select("id", "code"), "id").select(F.col("id").alias("branch"), "code", "c")
    j = points.join(hits, "id").join(c, "branch").withColumn("f", G.locate(F.col("c"), G.point(F.col("x"), F.col("y"))))
    return j.select(*points.columns, F.col("code").alias("branch_code"), F.col("f.at").alias("chainage"), F.col("f.off").alias("off"), F.col("f.x").alias("on_x"), F.col("f.y").alias("on_y"))
