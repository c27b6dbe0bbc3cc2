"""Editing line networks: junctions, splits, collapsed and extended branches, cuts, and the tables that depend on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..session import if_small, settled
from .graph import clustered_ends, components, dangling_ends, degrees, line_ends, network
from .near import PAIR, SortedPoints, lines_within, points_within, usable


def clean_lines(lines: DataFrame) -> DataFrame:
    """id, c of lines (id, geometry) with usable vertices only."""
    return lines.select("id", G.line(F.col("geometry")).alias("c")).filter("c is not null")


def _ends_as_points(ends: DataFrame) -> DataFrame:
    return ends.select((F.col("id") * 2 + F.when(F.col("end") == "start", 0).otherwise(1)).alias("id"), "x", "y")


def points_on_lines(points: DataFrame, lines: DataFrame, tol: float) -> DataFrame:
    """line, pt, off, at, length, foot_x, foot_y, d_ends: points (id, x, y) within tol of lines, with chainage and foot."""
    pairs = lines_within(lines, SortedPoints(points), tol).select(F.col("id1").alias("line"), F.col("id2").alias("pt"))
    c = clean_lines(lines).select(F.col("id").alias("line"), "c")
    p = points.select(F.col("id").alias("pt"), G.point(F.col("x"), F.col("y")).alias("p"))
    at = pairs.join(c, "line").join(p, "pt").withColumn("f", G.locate(F.col("c"), F.col("p")))
    return at.select("line", "pt", F.col("f.off").alias("off"), F.col("f.at").alias("at"), G.length(F.col("c")).alias("length"), F.col("f.x").alias("foot_x"), F.col("f.y").alias("foot_y"), F.least(G.distance(G.start(F.col("c")), F.col("p")), G.distance(G.end(F.col("c")), F.col("p"))).alias("d_ends"))


def nearest_lines(points: DataFrame, lines: DataFrame, limit: float) -> DataFrame:
    """pt, line, off, at: for each point the nearest line within limit; ties go to the least id."""
    hits = points_on_lines(points, lines, limit)
    best = F.min(F.struct(F.round("off", 9).alias("o"), "line", "off", "at")).alias("b")
    return hits.groupBy("pt").agg(best).select("pt", "b.line", "b.off", "b.at")


def nearest_points(centres: DataFrame, points: DataFrame, limit: float) -> DataFrame:
    """id1, id2, distance: for each centre the nearest point closer than limit; ties go to the least id."""
    pairs = points_within(centres, SortedPoints(points), limit).filter(F.col("distance") < limit)
    return pairs.groupBy("id1").agg(F.min(F.struct("distance", "id2")).alias("b")).select("id1", "b.id2", "b.distance")


def nearest_unbounded(centres: DataFrame, points: DataFrame, first: float, growth: float = 4.0) -> DataFrame:
    """id1, id2, distance: nearest point however far, searched in growing discs; only centres without a hit go on.

    The discs grow until every centre has found one, or there are no points.
    """
    left = settled(centres.filter(usable(F.col("x"), F.col("y"))))
    sorted_points = SortedPoints(points)
    found, radius = None, first
    while len(sorted_points.pids):
        hits = settled(points_within(left, sorted_points, radius).groupBy("id1").agg(F.min(F.struct("distance", "id2")).alias("b")).select("id1", "b.id2", "b.distance"))
        found = hits if found is None else found.unionByName(hits)
        left = settled(left.join(hits.select(F.col("id1").alias("id")), "id", "left_anti"))
        if left.isEmpty():
            return found
        radius *= growth
    return centres.sparkSession.createDataFrame([], PAIR)


def t_junctions(lines: DataFrame, tol: float) -> DataFrame:
    """branch, end, host, at, off, x, y: line ends on the interior of another line, more than tol from its ends."""
    ends = settled(line_ends(lines))
    hits = points_on_lines(_ends_as_points(ends), lines, tol)
    at = hits.withColumns({"branch": F.floor(F.col("pt") / 2).cast("bigint"), "end": F.when(F.col("pt") % 2 == 0, "start").otherwise("end")})
    inner = at.filter((F.col("branch") != F.col("line")) & (F.col("at") > tol) & (F.col("at") < F.col("length") - tol))
    return inner.join(ends.withColumnRenamed("id", "branch"), ["branch", "end"]).select("branch", "end", F.col("line").alias("host"), "at", "off", "x", "y")


def near_t_junctions(lines: DataFrame, tol: float, snap: float) -> DataFrame:
    """branch, end, host, at, off, x, y: dangling ends that stop within snap of another line's interior; x, y is the foot.

    An end within snap of the host's own ends is an end-to-end gap and left out,
    as is a foot that lies on a third line.
    """
    ends = settled(line_ends(lines))
    pts = _ends_as_points(ends)
    sorted_ends = SortedPoints(pts)
    met = points_within(pts, sorted_ends, tol).filter("id1 <> id2").select(F.col("id1").alias("id")).distinct()
    exact = t_junctions(lines, tol).select((F.col("branch") * 2 + F.when(F.col("end") == "start", 0).otherwise(1)).alias("id"))
    loose = settled(pts.join(met, "id", "left_anti").join(exact, "id", "left_anti"))
    hits = points_on_lines(loose, lines, snap).withColumn("branch", F.floor(F.col("pt") / 2).cast("bigint"))
    ok = hits.filter((F.col("branch") != F.col("line")) & (F.col("off") > tol) & (F.col("d_ends") > snap))
    best = settled(ok.groupBy("pt", "branch").agg(F.min(F.struct("off", "line", "at", "foot_x", "foot_y")).alias("b")).select("pt", "branch", F.col("b.line").alias("host"), F.col("b.at").alias("at"), F.col("b.off").alias("off"), F.col("b.foot_x").alias("x"), F.col("b.foot_y").alias("y")))
    third = lines_within(lines, SortedPoints(best.select(F.col("pt").alias("id"), "x", "y")), tol).select(F.col("id1").alias("other"), F.col("id2").alias("pt")).join(best.select("pt", "branch", "host"), "pt").filter("other <> host and other <> branch").select("pt")
    return best.join(third, "pt", "left_anti").select("branch", F.when(F.col("pt") % 2 == 0, "start").otherwise("end").alias("end"), "host", "at", "off", "x", "y")


def junction_nodes(junctions: DataFrame, tol: float) -> DataFrame:
    """host, branch, end, at, junction, x, y: junctions closer than tol along a host are one, at the first of them."""
    w = Window.partitionBy("host").orderBy("at", "branch", "end")
    new = junctions.withColumn("new", F.when(F.col("at") - F.lag("at").over(w) <= tol, 0).otherwise(1))
    numbered = new.withColumn("junction", F.sum("new").over(w))
    g = Window.partitionBy("host", "junction").orderBy("at", "branch", "end").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return numbered.select("host", "branch", "end", "at", "junction", F.first("x").over(g).alias("x"), F.first("y").over(g).alias("y"))


def split_at(lines: DataFrame, nodes: DataFrame) -> DataFrame:
    """id, piece, d0, d1, c: lines cut at the distances of nodes (host, at); lines without nodes stay whole."""
    cuts = nodes.groupBy(F.col("host").alias("id")).agg(F.array_sort(F.collect_set("at")).alias("ats"))
    c = clean_lines(lines).join(cuts, "id", "left").withColumn("n", G.length(F.col("c")))
    marks = F.concat(F.array(F.lit(0.0)), F.filter(F.coalesce("ats", F.array().cast("array<double>")), lambda d: (d > 0) & (d < F.col("n"))), F.array(F.col("n")))
    pieces = c.withColumn("m", marks).select("id", "c", "m", F.posexplode(F.slice("m", 1, F.size("m") - 1)).alias("piece", "d0")).withColumn("d1", F.get("m", F.col("piece") + 1))
    return pieces.select("id", "piece", "d0", "d1", F.when(F.size("m") == 2, F.col("c")).otherwise(G.cut(F.col("c"), F.col("d0"), F.col("d1"))).alias("c"))


def standalone(lines: DataFrame, tol: float, min_length: float = 0.0) -> DataFrame:
    """id of lines that are a whole component of their own, at least min_length long; ends snapped to a grid."""
    c = clean_lines(lines).select("id", G.length(F.col("c")).alias("n"), G.start(F.col("c")).alias("s"), G.end(F.col("c")).alias("e"))
    key = lambda p: F.concat_ws(",", F.bround(p["x"] / tol, 0).cast("bigint"), F.bround(p["y"] / tol, 0).cast("bigint"))
    ends = c.select("id", "n", F.explode(F.array_distinct(F.array(key(F.col("s")), key(F.col("e"))))).alias("k"))
    shared = ends.groupBy("k").agg(F.count(F.lit(1)).alias("lines"))
    return ends.join(shared, "k").groupBy("id", "n").agg(F.max("lines").alias("lines")).filter((F.col("lines") == 1) & (F.col("n") >= min_length)).select("id")


def isolated(lines: DataFrame) -> DataFrame:
    """id of lines that meet no other line anywhere; a line without length counts as meeting none."""
    met = crossing_segments(lines, lines)
    return clean_lines(lines).select("id").join(met.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id", "left_anti")


def unattached(points: DataFrame, lines: DataFrame, tol: float, ends_only: bool = False) -> DataFrame:
    """id of points that no line comes within tol of, or no line end."""
    if ends_only:
        ends = _ends_as_points(line_ends(lines))
        hit = points_within(points, SortedPoints(ends), tol).select(F.col("id1").alias("id"))
    else:
        hit = lines_within(lines, SortedPoints(points), tol).select(F.col("id2").alias("id"))
    return points.select("id").join(hit.distinct(), "id", "left_anti")


def end_hits(lines: DataFrame, points: DataFrame, tol: float, require: str = "either") -> DataFrame:
    """id, at_start, at_end of lines with points on either or both ends."""
    ends = _ends_as_points(line_ends(lines))
    hit = points_within(ends, SortedPoints(points), tol).select("id1").distinct()
    by = hit.groupBy(F.floor(F.col("id1") / 2).cast("bigint").alias("id")).agg(F.max(F.col("id1") % 2 == 0).alias("at_start"), F.max(F.col("id1") % 2 == 1).alias("at_end"))
    return by.filter(F.col("at_start") & F.col("at_end") if require == "both" else F.col("at_start") | F.col("at_end"))


def _meeting_segments(lines: DataFrame, other: DataFrame, cell: float, crowded: int = 4_000_000, least: float = 0.5) -> DataFrame:
    """a, a1, a2, d, n, b, b1, b2: pairs of segments of two different lines that meet, by a join on grid cells and an exact orientation test.

    d, n: the length of line a before its segment, and of the segment. A cell that
    would give more than `crowded` candidates is cut into 8 by 8 smaller ones, and
    so on down to `least`, so a crowded place is spread over many cells. A segment
    in several cells is judged in each; pairs may come repeatedly.
    """

    def boxed(df: DataFrame, name: str) -> DataFrame:
        s = clean_lines(df).select(F.col("id").alias(name), F.explode(G.segments(F.col("c"))).alias("s")).select(name, F.col("s.a").alias(f"{name}1"), F.col("s.b").alias(f"{name}2"), *([F.col("s.d").alias("d"), F.col("s.n").alias("n")] if name == "a" else []))
        return spread(s, name, cell, None)

    def spread(s: DataFrame, name: str, size: float, inside: str | None) -> DataFrame:
        """The segments with the cells of a size that their boxes meet, within the cell they are in already, if any."""
        for axis in ("x", "y"):
            k = lambda f: F.floor(f(F.col(f"{name}1.{axis}"), F.col(f"{name}2.{axis}")) / size).cast("bigint")  # noqa: B023, E731
            low, high = k(F.least), k(F.greatest)
            if inside:
                low, high = F.greatest(low, F.col(f"c{axis}") * 8), F.least(high, F.col(f"c{axis}") * 8 + 7)
            s = s.withColumn(f"n{axis}", F.explode(F.sequence(low, high)))
        if inside:
            # a cell with all corners on one side of the segment isn't met
            p, q = f"{name}1", f"{name}2"
            dx, dy = F.col(f"{q}.x") - F.col(f"{p}.x"), F.col(f"{q}.y") - F.col(f"{p}.y")
            side = [dx * ((F.col("ny") + j) * size - F.col(f"{p}.y")) - dy * ((F.col("nx") + i) * size - F.col(f"{p}.x")) for i in (0, 1) for j in (0, 1)]
            room = F.lit(1e-6) * (F.abs(dx) + F.abs(dy))
            s = s.filter((F.least(*side) <= room) & (F.greatest(*side) >= -room))
        return s.withColumns({"cx": F.col("nx"), "cy": F.col("ny")}).drop("nx", "ny")

    mine, theirs, size, out = settled(boxed(lines, "a")), settled(boxed(other, "b")), cell, None
    while True:
        per = lambda df, name: df.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias(name))
        full = if_small(per(mine, "na").join(per(theirs, "nb"), ["cx", "cy"]).filter(F.col("na") * F.col("nb") > crowded).select("cx", "cy"))
        last = size <= least or full.isEmpty()
        rest = (mine, theirs) if last else (mine.join(full, ["cx", "cy"], "left_anti"), theirs.join(full, ["cx", "cy"], "left_anti"))
        pairs = rest[0].join(rest[1], ["cx", "cy"]).filter("a <> b")
        out = pairs if out is None else out.unionByName(pairs)
        if last:
            return out.filter(G.crosses(F.col("a1"), F.col("a2"), F.col("b1"), F.col("b2")))
        size /= 8
        mine, theirs = (settled(spread(df.join(full, ["cx", "cy"], "left_semi"), name, size, "cell")) for df, name in ((mine, "a"), (theirs, "b")))


def crossing_segments(lines: DataFrame, other: DataFrame, cell: float = 64.0) -> DataFrame:
    """a, b: pairs of lines that meet."""
    return _meeting_segments(lines, other, cell).select("a", "b").distinct()


def meetings(lines: DataFrame, other: DataFrame, cell: float = 64.0) -> DataFrame:
    """a, b, at, x, y: the points where lines meet others, with the distance along a; lines that run along each other meet at no single point there."""
    m = _meeting_segments(lines, other, cell)
    ax, ay, bx, by = F.col("a2.x") - F.col("a1.x"), F.col("a2.y") - F.col("a1.y"), F.col("b2.x") - F.col("b1.x"), F.col("b2.y") - F.col("b1.y")
    turn = ax * by - ay * bx
    t = ((F.col("b1.x") - F.col("a1.x")) * by - (F.col("b1.y") - F.col("a1.y")) * bx) / turn
    at = m.filter(turn != 0).withColumn("t", F.greatest(F.lit(0.0), F.least(F.lit(1.0), t)))
    return at.select("a", "b", (F.col("d") + F.col("t") * F.col("n")).alias("at"), (F.col("a1.x") + F.col("t") * ax).alias("x"), (F.col("a1.y") + F.col("t") * ay).alias("y")).distinct()


def collapse_short(lines: DataFrame, tol: float, min_length: float, keep: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(lines left as id, c; removed as id, reason): short lines vanish and the ends around them meet in one node.

    Of the nodes joined by short lines, the one with most ends of lasting lines
    stays, then the one with most ends. Lines that become loops vanish too. keep:
    nodes (x, y) of boundaries: a short line with an open end there stays.
    """
    ends = settled(clustered_ends(lines, tol))
    c = settled(clean_lines(lines).withColumn("n", G.length(F.col("c"))))
    e = settled(ends.groupBy("id").agg(F.max(F.when(F.col("end") == "start", F.col("node"))).alias("u"), F.max(F.when(F.col("end") == "end", F.col("node"))).alias("v")).join(c.select("id", "n"), "id"))
    deg = degrees(e)
    short = e.filter(F.col("n") < min_length)
    if keep is not None:
        spot = ends.groupBy("node").agg(F.min(F.struct("x", "y")).alias("p")).select(F.col("node").alias("id"), "p.x", "p.y")
        bound = points_within(keep, SortedPoints(spot), tol).select(F.col("id2").alias("node")).distinct().join(deg.filter("degree = 1"), "node", "left_semi")
        held = short.select("id", F.explode(F.array("u", "v")).alias("node")).join(bound, "node", "left_semi").select("id").distinct()
        short = short.join(held, "id", "left_anti")
    short = settled(short)
    comp = components(short.select("u", "v"))
    lasting = e.join(short.select("id"), "id", "left_anti")
    score = deg.join(degrees(lasting).withColumnRenamed("degree", "lasting"), "node", "left").select("node", F.coalesce("lasting", F.lit(0)).alias("lasting"), "degree")
    spot = ends.groupBy("node").agg(F.min_by(F.struct("x", "y"), F.struct("id", "end")).alias("p"))
    ranked = comp.join(score, "node").withColumn("k", F.row_number().over(Window.partitionBy("component").orderBy(F.col("lasting").desc(), F.col("degree").desc(), "node")))
    best = ranked.filter("k = 1").select("component", F.col("node").alias("to")).join(spot.withColumnRenamed("node", "to"), "to")
    moved = settled(comp.join(best, "component").select("node", "to", "p"))
    left = lasting.join(moved.select(F.col("node").alias("u"), F.col("to").alias("u2"), F.col("p").alias("up")), "u", "left").join(moved.select(F.col("node").alias("v"), F.col("to").alias("v2"), F.col("p").alias("vp")), "v", "left")
    left = settled(left.withColumn("loop", F.coalesce("u2", "u") == F.coalesce("v2", "v")))
    kept = left.filter(~F.col("loop")).join(c.select("id", "c"), "id")
    shape = F.when(F.col("up").isNotNull(), G.with_start(F.col("c"), F.col("up"))).otherwise(F.col("c"))
    kept = kept.withColumn("c", shape).withColumn("c", F.when(F.col("vp").isNotNull(), G.with_end(F.col("c"), F.col("vp"))).otherwise(F.col("c")))
    removed = short.select("id", F.lit("short").alias("reason")).unionByName(left.filter("loop").select("id", F.lit("loop after collapse").alias("reason")))
    return kept.select("id", "c"), removed


def extend_stubs(lines: DataFrame, boundaries: DataFrame, tol: float, min_length: float) -> DataFrame:
    """id, end, old_length, extension, c: short lines whose open end carries a boundary point, prolonged to min_length.

    A line without a vertex more than a centimetre from that end has no direction and is left out.
    """
    edges = settled(network(lines, tol))
    loose = dangling_ends(edges)
    ends = line_ends(lines).join(loose.select("id", "end"), ["id", "end"], "left_semi")
    hit = points_within(_ends_as_points(ends), SortedPoints(boundaries), tol).select("id1").distinct().select(F.floor(F.col("id1") / 2).cast("bigint").alias("id"), F.when(F.col("id1") % 2 == 0, "start").otherwise("end").alias("end"))
    c = clean_lines(lines).withColumn("old_length", G.length(F.col("c"))).filter(F.col("old_length") < min_length - 1e-3)
    by = F.lit(min_length) - F.col("old_length")
    new = F.when(F.col("end") == "start", G.extended_start(F.col("c"), by)).otherwise(G.extended_end(F.col("c"), by))
    return hit.join(c, "id").select("id", "end", "old_length", by.alias("extension"), new.alias("c")).filter(G.length(F.col("c")) > F.col("old_length"))


def cut_directions(cuts: DataFrame, eps: float = 0.01) -> DataFrame:
    """cuts with direction and rule, from z_cut, z_far, z_beyond and is_pipe: the own slope, the bed beyond, or outflow."""
    own = F.col("is_pipe") & F.col("z_cut").isNotNull() & F.col("z_far").isNotNull() & (F.abs(F.col("z_cut") - F.col("z_far")) > eps)
    beyond = F.col("z_cut").isNotNull() & F.col("z_beyond").isNotNull() & (F.abs(F.col("z_beyond") - F.col("z_cut")) > eps)
    out = F.when(own, F.col("z_cut") < F.col("z_far")).when(beyond, F.col("z_beyond") < F.col("z_cut")).otherwise(F.lit(True))
    return cuts.withColumns({"direction": F.when(out, "outflow").otherwise("inflow"), "rule": F.when(own, "own pipe slope").when(beyond, "bed beyond the cut").otherwise("flat or unknown")})


def gaps(edges_from: DataFrame, edges_to: DataFrame, tol: float, limit: float) -> DataFrame:
    """id1, id2, distance: near misses between ends of two sets of lines, farther than tol, the best of each pair."""
    a, b = _ends_as_points(line_ends(edges_from)), _ends_as_points(line_ends(edges_to))
    pairs = points_within(a, SortedPoints(b), limit).filter(F.col("distance") > tol)
    half = lambda c: F.floor(F.col(c) / 2).cast("bigint")
    return pairs.groupBy(half("id1").alias("id1"), half("id2").alias("id2")).agg(F.min("distance").alias("distance"))


def network_outlets(edges: DataFrame, lines: DataFrame, wet: DataFrame, targets: DataFrame, limit: float, nodes: DataFrame | None = None, tol: float = 0.01) -> DataFrame:
    """component, id, end, target, distance: for each component without a wet line, the bare end, as drawn, nearest to a target line.

    nodes: points (id, x, y) of which none may lie within tol of such an end.
    """
    comp = settled(components(edges.select("u", "v")))
    of = edges.join(comp, edges["u"] == comp["node"]).select("id", "component")
    has = of.join(wet.select("id"), "id", "left_semi").select("component").distinct()
    dry = settled(of.join(has, "component", "left_anti"))
    loose = dangling_ends(edges).filter("end = 'end'").join(dry, "id")
    ends = settled(_ends_as_points(line_ends(lines).join(loose.select("id", "end"), ["id", "end"], "left_semi")))
    if nodes is not None:
        ends = ends.join(points_within(ends, SortedPoints(nodes), tol).select(F.col("id1").alias("id")).distinct(), "id", "left_anti")
    hit = nearest_lines(ends, targets, limit)
    at = hit.withColumn("id", F.floor(F.col("pt") / 2).cast("bigint")).join(dry, "id")
    return at.groupBy("component").agg(F.min(F.struct(F.round("off", 9).alias("o"), "id", "line", "off")).alias("b")).select("component", "b.id", F.lit("end").alias("end"), F.col("b.line").alias("target"), F.col("b.off").alias("distance"))


def closure(parents: DataFrame, children: dict[str, tuple[DataFrame, list[tuple[str, str, str]]]], key: str = "globalid") -> dict[str, DataFrame]:
    """Tables cut down to what refers, through any of their keys, to rows that stay.

    children: name -> (table, [(column, parent name, parent key)]), parents first.
    The parent name '' stands for `parents`. A row with several references stays
    if one of them does.
    """
    kept = {"": parents}
    for name, (table, refs) in children.items():
        row = table.withColumn("__row", F.struct(*table.columns))
        parts = None
        for column, parent, pkey in refs:
            keys = kept[parent].select(F.col(pkey).alias(column)).filter(F.col(column).isNotNull()).distinct()
            hit = table.join(keys, column, "left_semi").select(*table.columns)
            parts = hit if parts is None else parts.unionByName(hit)
        kept[name] = parts if len(refs) == 1 else parts.dropDuplicates([key] if key in table.columns else None)
        del row
    return kept


def _directed(lines: DataFrame, others: DataFrame, tol: float, spacing: float) -> DataFrame:
    """id, match, far: the greatest distance of a line's vertices, added every `spacing`, from another, where all of them lie within tol of it."""
    dense = lines.select("id", F.explode(G.densified(F.col("c"), spacing)).alias("v"))
    pts = settled(dense.select(F.monotonically_increasing_id().alias("pt"), "id", "v.x", "v.y"))
    n = pts.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    hits = lines_within(others.select("id", F.col("c").alias("geometry")), SortedPoints(pts.select(F.col("pt").alias("id"), "x", "y")), tol).select(F.col("id1").alias("match"), F.col("id2").alias("pt"), "distance")
    per = hits.join(pts.select("pt", "id"), "pt").groupBy("id", "match").agg(F.count(F.lit(1)).alias("near"), F.max("distance").alias("far"))
    return per.join(n, "id").filter("near = n").select("id", "match", "far")


def hausdorff_matches(lines: DataFrame, others: DataFrame, tol: float, same: bool = False, spacing: float = 2.0) -> DataFrame:
    """id, match, distance: for each line the other whose Hausdorff distance is least, among those its midpoint lies within tol of.

    same: both are one table, where a line is no match of itself. Distances are
    taken from vertices, added every `spacing` along a line, to the other line; a
    vertex farther than tol from it rules a pair out, so all is a search of points
    near lines.
    """
    a = settled(clean_lines(lines).withColumn("m", G.midpoint(F.col("c"))))
    mids = a.select("id", F.col("m.x").alias("x"), F.col("m.y").alias("y"))
    pairs = lines_within(others, SortedPoints(mids), tol).select(F.col("id1").alias("match"), F.col("id2").alias("id"))
    pairs = settled(pairs.filter("match <> id") if same else pairs)
    mine = settled(a.select("id", "c").join(pairs.select("id").distinct(), "id", "left_semi"))
    theirs = settled(clean_lines(others).join(pairs.select(F.col("match").alias("id")).distinct(), "id", "left_semi"))
    there = _directed(mine, theirs, tol, spacing)
    back = _directed(theirs, mine, tol, spacing).select(F.col("id").alias("match"), F.col("match").alias("id"), F.col("far").alias("back"))
    d = pairs.join(there, ["id", "match"]).join(back, ["id", "match"]).select("id", "match", F.greatest("far", "back").alias("distance"))
    return d.groupBy("id").agg(F.min(F.struct(F.round("distance", 9).alias("r"), "match", "distance")).alias("b")).select("id", "b.match", "b.distance")


def carriageway_pairs(lines: DataFrame, reach: float, step: float = 10.0, opposite: float = -0.8, beside: float = 0.5, apart: float = 1.0) -> DataFrame:
    """id, other, samples: lines that run beside another in the opposite direction over at least two successive samples.

    lines: id, geometry and optionally kind and name. Samples stand about every
    `step` along a line. Of the lines of its kind, and of its name or without one,
    a sample's partner is the nearest between `apart` and `reach` away that runs
    against it (cosine below `opposite`) and lies beside it, not ahead (cosine of
    the way there at most `beside`). Two successive samples with the same partner
    make a pair; samples: how many such successions there are.
    """
    for c in ("kind", "name"):
        lines = lines if c in lines.columns else lines.withColumn(c, F.lit(None).cast("string"))
    full = settled(lines.select("id", "kind", "name", G.line(F.col("geometry")).alias("c")).filter("c is not null").withColumn("n", G.length(F.col("c"))).filter("n > 0"))
    k = F.greatest(F.lit(1), F.floor(F.col("n") / step).cast("int"))
    s = full.select("id", "kind", "name", "c", F.posexplode(F.transform(F.sequence(F.lit(0), k), lambda i: F.col("n") * i / k)).alias("k", "d"))
    at = s.select("id", "kind", "name", "k", G.at_distance(F.col("c"), F.col("d")).alias("p"), G.tangent(F.col("c"), F.col("d"), 2.0).alias("t")).filter("t is not null")
    pts = settled(at.select(F.monotonically_increasing_id().alias("pt"), "id", "kind", "name", "k", "p", "t"))
    near = lines_within(full.select("id", F.col("c").alias("geometry")), SortedPoints(pts.select(F.col("pt").alias("id"), "p.x", "p.y")), reach).filter(F.col("distance") >= apart).select(F.col("id1").alias("other"), F.col("id2").alias("pt"))
    there = full.select(F.col("id").alias("other"), F.col("kind").alias("o_kind"), F.col("name").alias("o_name"), F.col("c").alias("oc"))
    j = near.join(pts, "pt").filter("id <> other").join(there, "other").filter(F.col("kind").eqNullSafe(F.col("o_kind")) & (F.col("name").isNull() | F.col("o_name").isNull() | (F.col("name") == F.col("o_name"))))
    f = j.withColumn("f", G.locate(F.col("oc"), F.col("p"))).withColumn("ot", G.tangent(F.col("oc"), F.col("f.at"), 2.0))
    against = F.col("t.x") * F.col("ot.x") + F.col("t.y") * F.col("ot.y") <= opposite
    side = F.abs(F.col("t.x") * (F.col("f.x") - F.col("p.x")) + F.col("t.y") * (F.col("f.y") - F.col("p.y"))) <= beside * F.col("f.off")
    best = f.filter(against & side).groupBy("id", "k").agg(F.min(F.struct(F.round("f.off", 9).alias("o"), "other")).alias("b")).select("id", "k", "b.other")
    # successive samples with one partner
    w = Window.partitionBy("id").orderBy("k")
    runs = best.withColumns({"k2": F.lead("k").over(w), "other2": F.lead("other").over(w)}).filter("k2 = k + 1 and other2 = other")
    return runs.groupBy("id", "other").agg(F.count(F.lit(1)).alias("samples"))


def connect_ends(lines: DataFrame, outfalls: DataFrame, channels: DataFrame, tol: float, limit: float) -> DataFrame:
    """id, end, channel, c: lines whose end carries an outfall, prolonged to the nearest vertex of the nearest channel.

    Ends are those of the original lines; a line is prolonged at one end only,
    the one nearer to its channel.
    """
    ends = settled(line_ends(lines))
    pts = _ends_as_points(ends)
    hit = points_within(pts, SortedPoints(outfalls), tol).select(F.col("id1").alias("id")).distinct()
    at = settled(pts.join(hit, "id", "left_semi"))
    near = nearest_lines(at, channels, limit)
    vertex = clean_lines(channels).select(F.col("id").alias("line"), F.explode("c").alias("v"))
    to = near.join(at.withColumnRenamed("id", "pt"), "pt").join(vertex, "line").groupBy("pt", "line").agg(F.min(F.struct(F.hypot(F.col("v.x") - F.col("x"), F.col("v.y") - F.col("y")).alias("d"), "v")).alias("b"))
    best = to.withColumn("id", F.floor(F.col("pt") / 2).cast("bigint")).groupBy("id").agg(F.min(F.struct("b.d", "pt", "line", "b.v")).alias("t"))
    j = best.join(clean_lines(lines), "id")
    rev = F.col("t.pt") % 2 == 0
    new = F.when(rev, F.reverse(G.appended(F.reverse(F.col("c")), F.col("t.v"), tol))).otherwise(G.appended(F.col("c"), F.col("t.v"), tol))
    return j.select("id", F.when(rev, "start").otherwise("end").alias("end"), F.col("t.line").alias("channel"), new.alias("c"))
