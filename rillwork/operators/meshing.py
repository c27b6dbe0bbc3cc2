"""Preparing and mending meshes: resampled borders, edges of faces, convex cells, merged cells.

Meshes are cells (cell, nodes ARRAY, counterclockwise) and nodes (node, x, y), as
in `mesh`. Defined results for dirty input: lines without length stay as they
are; cells that lack a node or have less than three corners are left alone;
empty tables give empty results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..session import settled
from .mesh import areas, centres, links, rings
from .network import clean_lines


def resampled(lines: DataFrame, corner: float = 30.0, least: float = 0.0) -> DataFrame:
    """id, c: lines (id, geometry, spacing) with vertices evenly spaced, at most about `spacing` apart, between their corners.

    A corner is a vertex where the line turns by more than `corner` degrees; one
    closer than `least` to the corner kept before it, or to the end, isn't kept.
    Ends stay. The corners are found by a fold over the vertices.
    """
    c = clean_lines(lines).join(lines.select("id", "spacing"), "id").withColumn("s", G.segments(F.col("c"))).withColumn("n", G.length(F.col("c")))
    ahead = lambda g: F.atan2(g["b"]["y"] - g["a"]["y"], g["b"]["x"] - g["a"]["x"])

    def turns(g: Column, i: Column) -> Column:
        t = F.abs(ahead(g) - ahead(F.get("s", i - 1)))
        return F.when(i > 0, F.least(t, F.lit(2 * math.pi) - t) > math.radians(corner)).otherwise(False)

    at = c.withColumn("corners", F.transform(F.filter(F.transform("s", lambda g, i: F.struct(g["d"].alias("d"), turns(g, i).alias("t"))), lambda v: v["t"]), lambda v: v["d"]))
    kept = F.aggregate("corners", F.array(F.lit(0.0)), lambda acc, d: F.when((d - F.element_at(acc, -1) >= least) & (F.col("n") - d >= least), F.concat(acc, F.array(d))).otherwise(acc))
    at = at.withColumn("cuts", F.concat(kept, F.array("n")))

    def spaced(a: Column, i: Column) -> Column:
        b = F.get("cuts", i + 1)
        k = F.greatest(F.ceil((b - a) / F.col("spacing") - 0.2).cast("int"), F.lit(1))
        return F.transform(F.sequence(F.lit(0), k - 1), lambda j: a + (b - a) * j / k)

    steps = F.flatten(F.transform(F.slice("cuts", 1, F.size("cuts") - 1), spaced))
    points = F.transform(F.concat(steps, F.array("n")), lambda d: G.at_distance(F.col("c"), d))
    return at.select("id", F.when(F.col("n") > 0, points).otherwise(F.col("c")).alias("c"))


def edges_of_faces(edges: DataFrame, faces: DataFrame, share: float = 0.5) -> DataFrame:
    """edge, face: edges (id, geometry) of which more than `share` of the length runs along the border of a face (id, geometry: rings).

    Edges and faces of one partition have their vertices in common, so pieces of
    border are matched by their end points.
    """
    def pieces(df: DataFrame, name: str) -> DataFrame:
        s = df.select(name, F.explode(G.segments(F.col("c"))).alias("s"))
        text = lambda p: F.concat_ws(" ", F.round(p["x"], 6).cast("string"), F.round(p["y"], 6).cast("string"))
        a, b = text(F.col("s.a")), text(F.col("s.b"))
        return s.select(name, F.concat_ws(",", F.least(a, b), F.greatest(a, b)).alias("k"), F.col("s.n").alias("n"))

    lines = clean_lines(edges).select(F.col("id").alias("edge"), "c")
    borders = faces.select(F.col("id").alias("face"), F.explode("geometry").alias("r")).select("face", G.line(F.concat("r", F.slice("r", 1, 1))).alias("c")).filter("c is not null")
    whole = lines.select("edge", G.length(F.col("c")).alias("length"))
    along = pieces(lines, "edge").join(pieces(borders, "face").select("face", "k").distinct(), "k").groupBy("edge", "face").agg(F.sum("n").alias("n"))
    return along.join(whole, "edge").filter(F.col("n") > F.col("length") * share).select("edge", "face")


def convex(ring: Column, strict: bool = False) -> Column:
    """Whether a ring of corner points, counterclockwise, turns left everywhere, or nowhere right; strict: no straight corner either."""
    n = F.size(ring)
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    room = F.array_max(xs) - F.array_min(xs) + F.array_max(ys) - F.array_min(ys)
    tol = F.lit(1e-9) * room * room

    def turn(p: Column, i: Column) -> Column:
        q, r = F.get(ring, (i + 1) % n), F.get(ring, (i + 2) % n)
        return (q["x"] - p["x"]) * (r["y"] - q["y"]) - (q["y"] - p["y"]) * (r["x"] - q["x"])

    return F.forall(F.transform(ring, turn), (lambda t: t > tol) if strict else (lambda t: t >= -tol)) & (n >= 3)


def _from(nodes: Column, first: Column) -> Column:
    """A ring of nodes told from one of them on."""
    at = F.array_position(nodes, first).cast("int")
    return F.concat(F.slice(nodes, at, F.size(nodes) - at + 1), F.slice(nodes, 1, F.greatest(at - 1, F.lit(0))))


def joined_ring(a: Column, b: Column, u: Column, v: Column) -> Column:
    """The nodes of two cells without the link u-v between them; NULL if they don't share it in opposite directions, or share more."""
    after = lambda nodes, k: F.get(nodes, F.array_position(nodes, k).cast("int") % F.size(nodes))
    s = F.when(after(a, u) == v, u).when(after(a, v) == u, v)
    t = F.when(s == u, v).otherwise(u)
    other = _from(b, s)
    ring = F.concat(_from(a, t), F.slice(other, 2, F.greatest(F.size(b) - 2, F.lit(0))))
    fits = s.isNotNull() & (after(b, t) == s)
    return F.when(fits & (F.size(F.array_distinct(ring)) == F.size(ring)), ring)


def _skewness(cells: DataFrame, nodes: DataFrame, mid: DataFrame) -> DataFrame:
    """n1, n2, c1, c2, cos, flow, length of inner links, cos NULL where both centres coincide."""
    at = lambda k, a: mid.select(F.col("cell").alias(k), F.col("x").alias(f"{a}x"), F.col("y").alias(f"{a}y"))
    n = lambda k, a: nodes.select(F.col("node").alias(k), F.col("x").alias(f"{a}x"), F.col("y").alias(f"{a}y"))
    j = links(cells).filter("c2 is not null").join(at("c1", "p"), "c1").join(at("c2", "q"), "c2").join(n("n1", "a"), "n1").join(n("n2", "b"), "n2")
    flow, length = F.hypot(F.col("qx") - F.col("px"), F.col("qy") - F.col("py")), F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))
    dot = F.abs((F.col("bx") - F.col("ax")) * (F.col("qx") - F.col("px")) + (F.col("by") - F.col("ay")) * (F.col("qy") - F.col("py")))
    return j.select("n1", "n2", "c1", "c2", F.when((flow > 0) & (length > 0), dot / length / flow).alias("cos"), flow.alias("flow"), length.alias("length"))


def merged_cells(cells: DataFrame, nodes: DataFrame, least_area: float, most_cos: float, most_nodes: int = 6, short: float = 0.0, small_cos: float | None = None) -> DataFrame:
    """cell, nodes: a mesh without cells smaller than least_area, skew links and short flow links, as far as merging two cells mends them.

    A merge removes the link between two cells; it needs a convex cell of at most
    most_nodes corners. Candidates are, in this order, the links of small cells,
    the smallest cell and its longest link first, links whose flow link is shorter
    than `short` times the mean side of its cells, the shortest first, and links
    with a cosine above most_cos, the worst first. In a pass those are tried that
    come before every other candidate around their two cells and their neighbours,
    so no two of a pass touch. A merge for a skew link stays if the worst cosine
    around gets less, others if it doesn't exceed the greater of what it was and
    small_cos. What was refused is only tried again if one of its cells has
    changed. The passes end when no candidate is left.
    """
    limit = most_cos if small_cos is None else small_cos
    mesh = settled(cells.select("cell", F.filter("nodes", lambda v: v.isNotNull() & (v >= 0)).alias("nodes")))
    whole = settled(rings(mesh, nodes).join(mesh.select("cell", F.size("nodes").alias("had")), "cell").filter("n = had and n >= 3").select("cell"))
    odd, mesh = mesh.join(whole, "cell", "left_anti"), settled(mesh.join(whole, "cell", "left_semi"))
    refused = None
    while True:
        mid = settled(centres(mesh, nodes))
        size = settled(areas(mesh, nodes).select("cell", F.abs("area").alias("area")))
        link = settled(_skewness(mesh, nodes, mid))
        area = lambda k, a: size.select(F.col("cell").alias(k), F.col("area").alias(a))
        l = link.join(area("c1", "a1"), "c1").join(area("c2", "a2"), "c2")
        least = F.least("a1", "a2")
        side = (F.sqrt("a1") + F.sqrt("a2")) / 2
        rank = F.when(least < least_area, F.struct(F.lit(0).alias("r"), least.alias("v"), (-F.col("length")).alias("w"))).when(F.col("flow") < F.lit(short) * side, F.struct(F.lit(1).alias("r"), F.col("flow").alias("v"), F.lit(0.0).alias("w"))).when(F.col("cos") > most_cos, F.struct(F.lit(2).alias("r"), (-F.col("cos")).alias("v"), F.lit(0.0).alias("w")))
        cand = l.withColumn("rank", rank).filter("rank is not null")
        if refused is not None:
            cand = cand.join(refused, ["c1", "c2"], "left_anti")
        ns = lambda k, a: mesh.select(F.col("cell").alias(k), F.col("nodes").alias(a))
        ring = cand.join(ns("c1", "na"), "c1").join(ns("c2", "nb"), "c2").withColumn("ring", joined_ring(F.col("na"), F.col("nb"), F.col("n1"), F.col("n2"))).filter((F.size("ring") <= most_nodes) & F.col("ring").isNotNull())
        ring = settled(ring.select("c1", "c2", "n1", "n2", F.struct("rank", "c1", "c2", "n1", "n2").alias("prio"), "ring"))
        shape = rings(ring.select(F.struct("c1", "c2", "n1", "n2").alias("cell"), F.col("ring").alias("nodes")), nodes).filter(convex(F.col("ring")))
        fit = settled(ring.join(shape.select("cell.c1", "cell.c2", "cell.n1", "cell.n2"), ["c1", "c2", "n1", "n2"], "left_semi"))
        if fit.isEmpty():
            return mesh.unionByName(odd)
        # the first candidate at each cell, then around each cell, then around each candidate
        own = fit.select(F.explode(F.array("c1", "c2")).alias("cell"), "prio").groupBy("cell").agg(F.min("prio").alias("first"))
        beside = link.select("c1", "c2").unionByName(link.select(F.col("c2").alias("c1"), F.col("c1").alias("c2")))
        around = settled(beside.join(own.withColumnRenamed("cell", "c2"), "c2").select(F.col("c1").alias("cell"), "first").unionByName(own).groupBy("cell").agg(F.min("first").alias("first")))
        first = lambda k, a: around.select(F.col("cell").alias(k), F.col("first").alias(a))
        chosen = settled(fit.join(first("c1", "f1"), "c1").join(first("c2", "f2"), "c2").filter((F.col("f1") >= F.col("prio")) & (F.col("f2") >= F.col("prio"))).select("c1", "c2", "ring", F.col("prio.rank.r").alias("r")))
        # what the merge would make of the links around it
        new = settled(centres(chosen.select(F.col("c1").alias("cell"), F.col("ring").alias("nodes")), nodes).join(areas(chosen.select(F.col("c1").alias("cell"), F.col("ring").alias("nodes")), nodes), "cell").select("cell", "x", "y", F.sqrt(F.abs("area")).alias("side")))
        pair = chosen.select("c1", "c2", F.explode(F.array("c1", "c2")).alias("mine"))
        both = link.select("n1", "n2", F.col("c1").alias("mine"), F.col("c2").alias("far"), "cos").unionByName(link.select("n1", "n2", F.col("c2").alias("mine"), F.col("c1").alias("far"), "cos"))
        near = settled(pair.join(both, "mine"))
        was = near.groupBy("c1", "c2").agg(F.max(F.coalesce("cos", F.lit(0.0))).alias("was"))
        n = lambda k, a: nodes.select(F.col("node").alias(k), F.col("x").alias(f"{a}x"), F.col("y").alias(f"{a}y"))
        out = near.filter((F.col("far") != F.col("c1")) & (F.col("far") != F.col("c2"))).join(new.select(F.col("cell").alias("c1"), "x", "y", "side"), "c1").join(mid.select(F.col("cell").alias("far"), F.col("x").alias("fx"), F.col("y").alias("fy")), "far").join(size.select(F.col("cell").alias("far"), F.sqrt("area").alias("far_side")), "far").join(n("n1", "a"), "n1").join(n("n2", "b"), "n2")
        dx, dy, ex, ey = F.col("fx") - F.col("x"), F.col("fy") - F.col("y"), F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
        flow = F.hypot(dx, dy)
        seen = F.when((flow > 0) & (flow >= F.lit(short) * (F.col("side") + F.col("far_side")) / 2), F.abs(ex * dx + ey * dy) / F.hypot(ex, ey) / flow)
        then = out.groupBy("c1", "c2").agg(F.max(seen).alias("then"))
        judged = settled(chosen.join(was, ["c1", "c2"]).join(then, ["c1", "c2"], "left").withColumn("then", F.coalesce("then", F.lit(0.0))))
        better = F.when(F.col("r") == 2, F.col("then") < F.col("was")).otherwise(F.col("then") <= F.greatest("was", F.lit(limit)))
        good = settled(judged.filter(better).select("c1", "c2", "ring"))
        bad = judged.filter(~better).select("c1", "c2")
        touched = good.select(F.explode(F.array("c1", "c2")).alias("cell"))
        refused = settled(bad if refused is None else refused.unionByName(bad).join(touched.withColumnRenamed("cell", "c1"), "c1", "left_anti").join(touched.withColumnRenamed("cell", "c2"), "c2", "left_anti"))
        mesh = settled(mesh.join(touched.distinct(), "cell", "left_anti").unionByName(good.select(F.col("c1").alias("cell"), F.col("ring").alias("nodes"))))
