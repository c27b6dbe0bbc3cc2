"""Geometry as column expressions: points are struct<x,y>, lines array<struct<x,y>>, polygons arrays of rings.

Everything here is a higher-order function over arrays and stays in the JVM.
NULL geometries give NULL; lines are expected to be cleaned by `line`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, f) -> Column:
    """f(value) with value evaluated once: higher-order functions are not shared between the places they are written in."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def line(c: Column) -> Column:
    """The usable vertices of a line without immediate repeats; NULL if none is left."""
    ok = F.filter(c, lambda p: p.isNotNull() & p["x"].isNotNull() & p["y"].isNotNull() & ~F.isnan(p["x"]) & ~F.isnan(p["y"]))
    kept = F.filter(ok, lambda p, i: (i == 0) | (p["x"] != F.get(ok, i - 1)["x"]) | (p["y"] != F.get(ok, i - 1)["y"]))
    return F.when(F.size(kept) > 0, kept)


def start(c: Column) -> Column:
    return F.element_at(c, 1)


def end(c: Column) -> Column:
    return F.element_at(c, -1)


def distance(a: Column, b: Column) -> Column:
    return F.hypot(a["x"] - b["x"], a["y"] - b["y"])


def segments(c: Column) -> Column:
    """array<struct<a,b,d>>: the segments of a line and the distance at which each begins."""
    pairs = F.zip_with(F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0))), F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b"), distance(a, b).alias("n")))
    # the running length is carried through the fold
    first = F.struct(F.lit(0.0).alias("d"), F.array().cast("array<struct<a:struct<x:double,y:double>,b:struct<x:double,y:double>,n:double,d:double>>").alias("s"))
    return F.aggregate(pairs, first, lambda acc, p: F.struct((acc["d"] + p["n"]).alias("d"), F.concat(acc["s"], F.array(F.struct(p["a"].alias("a"), p["b"].alias("b"), p["n"].alias("n"), acc["d"].alias("d")))).alias("s")))["s"]


def length(c: Column) -> Column:
    n = F.greatest(F.size(c) - 1, F.lit(0))
    return F.aggregate(F.zip_with(F.slice(c, 1, n), F.slice(c, 2, n), distance), F.lit(0.0), lambda a, d: a + d)


def _at(s: Column, c: Column, d: Column) -> Column:
    """The point at a distance along a line c with segments s."""

    def inner(h: Column) -> Column:
        t = F.greatest(F.lit(0.0), (d - h["d"]) / h["n"])
        p = F.struct((h["a"]["x"] + (h["b"]["x"] - h["a"]["x"]) * t).alias("x"), (h["a"]["y"] + (h["b"]["y"] - h["a"]["y"]) * t).alias("y"))
        return F.when(h.isNotNull(), p).otherwise(F.when(d <= 0, start(c)).otherwise(end(c)))

    return let(F.get(F.filter(s, lambda g: (g["d"] + g["n"] >= d) & (g["n"] > 0)), F.lit(0)), inner)


def at_distance(c: Column, d: Column) -> Column:
    """The point at a distance along a line, clamped to its ends."""
    return let(segments(c), lambda s: _at(s, c, d))


def midpoint(c: Column) -> Column:
    return at_distance(c, length(c) / 2)


def _nearest(c: Column, px: Column, py: Column) -> Column:
    """struct<off, at, x, y>: distance, chainage and foot of the nearest point of a line; the first of equals."""

    def foot(g: Column) -> Column:
        dx, dy = g["b"]["x"] - g["a"]["x"], g["b"]["y"] - g["a"]["y"]
        n2 = dx * dx + dy * dy
        t = F.when(n2 > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - g["a"]["x"]) * dx + (py - g["a"]["y"]) * dy) / n2))).otherwise(0.0)
        x, y = g["a"]["x"] + t * dx, g["a"]["y"] + t * dy
        return F.struct(F.hypot(px - x, py - y).alias("off"), (g["d"] + t * g["n"]).alias("at"), x.alias("x"), y.alias("y"))

    return F.array_min(F.transform(segments(c), foot))


def locate(c: Column, p: Column) -> Column:
    """struct<off, at, x, y> of the point of a line nearest to p."""
    return F.when(F.size(c) > 1, _nearest(c, p["x"], p["y"])).when(F.size(c) == 1, F.struct(distance(start(c), p).alias("off"), F.lit(0.0).alias("at"), start(c)["x"].alias("x"), start(c)["y"].alias("y")))


def cut(c: Column, d0: Column, d1: Column) -> Column:
    """The part of a line between two distances, with exact end points."""
    inner = lambda s: F.transform(F.filter(s, lambda g: (g["d"] > d0) & (g["d"] < d1)), lambda g: g["a"])
    return let(segments(c), lambda s: F.concat(F.array(_at(s, c, d0)), inner(s), F.array(_at(s, c, d1))))


def with_start(c: Column, p: Column) -> Column:
    return F.concat(F.array(p), F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0))))


def with_end(c: Column, p: Column) -> Column:
    return F.concat(F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0))), F.array(p))


def extended_end(c: Column, by: Column, least: float = 0.01) -> Column:
    """A line prolonged beyond its end along the direction from the last vertex that is more than `least` away."""
    tip = end(c)
    base = F.element_at(F.filter(c, lambda p: distance(p, tip) > F.lit(least)), -1)
    n = distance(base, tip)
    new = F.struct((tip["x"] + (tip["x"] - base["x"]) / n * by).alias("x"), (tip["y"] + (tip["y"] - base["y"]) / n * by).alias("y"))
    return F.when(base.isNotNull(), with_end(c, new)).otherwise(c)


def reversed_line(c: Column) -> Column:
    return F.reverse(c)


def extended_start(c: Column, by: Column, least: float = 0.01) -> Column:
    return F.reverse(extended_end(F.reverse(c), by, least))


def appended(c: Column, p: Column, tol: float) -> Column:
    """p as a new last vertex, unless the line already ends there."""
    return F.when(distance(end(c), p) < F.lit(tol), c).otherwise(F.concat(c, F.array(p)))


def stations(c: Column, spacing: float) -> Column:
    """Distances every `spacing` along a line, its ends trimmed by the lesser of 10 and a fifth of its length."""

    def along(n: Column) -> Column:
        trim = F.least(F.lit(10.0), n * 0.2)
        k = F.floor((n - 2 * trim) / F.lit(spacing)).cast("int")
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(k, F.lit(0))), lambda i: trim + i * F.lit(spacing)))

    return let(length(c), along)


def tangent(c: Column, d: Column, step: float = 0.5) -> Column:
    """The direction of a line at a distance along it, over a short way to both sides."""

    def unit(q: Column) -> Column:
        n = distance(q["a"], q["b"])
        return F.when(n > 0, F.struct(((q["b"]["x"] - q["a"]["x"]) / n).alias("x"), ((q["b"]["y"] - q["a"]["y"]) / n).alias("y")))

    return let(segments(c), lambda s: let(F.struct(_at(s, c, F.greatest(d - step, F.lit(0.0))).alias("a"), _at(s, c, F.least(d + step, length(c))).alias("b")), unit))


def transect(c: Column, d: Column, half: float) -> Column:
    """The two ends of the line across c at a distance along it."""

    def across(q: Column) -> Column:
        p, t = q["p"], q["t"]
        left = F.struct((p["x"] - t["y"] * half).alias("x"), (p["y"] + t["x"] * half).alias("y"))
        right = F.struct((p["x"] + t["y"] * half).alias("x"), (p["y"] - t["x"] * half).alias("y"))
        return F.when(t.isNotNull(), F.array(left, right))

    return let(F.struct(at_distance(c, d).alias("p"), tangent(c, d).alias("t")), across)


def densified(c: Column, spacing: float) -> Column:
    """A line with vertices at most about `spacing` apart."""

    def points(n: Column) -> Column:
        k = F.greatest(F.ceil(n / F.lit(spacing) - 0.2).cast("int"), F.lit(1))
        return let(segments(c), lambda s: F.transform(F.sequence(F.lit(0), k), lambda i: _at(s, c, n * i / k)))

    return let(length(c), points)


def normalised(c: Column) -> Column:
    """The same for a line and its reverse, for equality joins."""
    key = F.transform(c, lambda p: F.concat_ws(" ", F.round(p["x"], 6).cast("string"), F.round(p["y"], 6).cast("string")))
    return F.least(F.concat_ws(",", key), F.concat_ws(",", F.reverse(key)))


def box(c: Column) -> Column:
    """struct<minx,miny,maxx,maxy> of a line, to be stored beside it so that box filters reach the scan."""
    xs, ys = F.transform(c, lambda p: p["x"]), F.transform(c, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"), F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"))


def ring_area(r: Column) -> Column:
    """Signed area of a ring by the shoelace formula, taken about its first vertex so that large coordinates don't cancel."""
    n = F.size(r)
    o = F.element_at(r, 1)
    term = lambda p, i: (p["x"] - o["x"]) * (F.get(r, (i + 1) % n)["y"] - o["y"]) - (F.get(r, (i + 1) % n)["x"] - o["x"]) * (p["y"] - o["y"])
    return F.aggregate(F.transform(r, term), F.lit(0.0), lambda a, v: a + v) / 2


def area(polygon: Column) -> Column:
    """Area of a polygon: ring 0 without the others, whatever their direction."""
    return F.aggregate(F.transform(polygon, lambda r, i: F.abs(ring_area(r)) * F.when(i == 0, 1).otherwise(-1)), F.lit(0.0), lambda a, v: a + v)


def contains(polygon: Column, x: Column, y: Column) -> Column:
    """Even-odd rule over all rings, so holes exclude."""

    def crossings(r: Column) -> Column:
        n = F.size(r)
        hit = lambda p, i: F.when(((p["y"] > y) != (F.get(r, (i + 1) % n)["y"] > y)) & (x < (F.get(r, (i + 1) % n)["x"] - p["x"]) * (y - p["y"]) / (F.get(r, (i + 1) % n)["y"] - p["y"]) + p["x"]), 1).otherwise(0)
        return F.aggregate(F.transform(r, hit), F.lit(0), lambda a, v: a + v)

    return F.aggregate(F.transform(polygon, crossings), F.lit(0), lambda a, v: a + v) % 2 == 1


def crosses(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Whether segments ab and cd meet, by orientation; touching ends count."""

    def turn(p: Column, q: Column, r: Column) -> Column:
        return F.signum((q["x"] - p["x"]) * (r["y"] - p["y"]) - (q["y"] - p["y"]) * (r["x"] - p["x"]))

    def apart(axis: str) -> Column:
        return (F.least(a[axis], b[axis]) > F.greatest(c[axis], d[axis])) | (F.least(c[axis], d[axis]) > F.greatest(a[axis], b[axis]))

    return ~apart("x") & ~apart("y") & (turn(a, b, c) * turn(a, b, d) <= 0) & (turn(c, d, a) * turn(c, d, b) <= 0)


def stitched(parts: Column, tol: float = 1e-6) -> Column:
    """One line from parts whose ends follow one another; NULL where they don't."""
    empty = F.slice(F.element_at(parts, 1), 1, 0)
    fold = F.aggregate(parts, F.struct(empty.alias("c"), F.lit(True).alias("ok")), lambda acc, p: F.struct(F.when(F.size(acc["c"]) == 0, p).otherwise(F.concat(acc["c"], F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))))).alias("c"), (acc["ok"] & ((F.size(acc["c"]) == 0) | (distance(F.element_at(acc["c"], -1), F.element_at(p, 1)) <= F.lit(tol)))).alias("ok")))
    return F.when(fold["ok"], fold["c"])


def clipped_ring(ring: Column, x0: float, y0: float, x1: float, y1: float) -> Column:
    """A ring cut to a window, side by side; empty if nothing of it is inside."""

    def side(r: Column, axis: str, bound: float, keep_above: bool) -> Column:
        other = "y" if axis == "x" else "x"
        inside = lambda p: p[axis] >= F.lit(bound) if keep_above else p[axis] <= F.lit(bound)

        def step(p: Column, i: Column) -> Column:
            q = F.get(r, (i + 1) % F.size(r))
            t = (F.lit(bound) - p[axis]) / (q[axis] - p[axis])
            at = p[other] + (q[other] - p[other]) * t
            cut = F.struct(F.lit(bound).alias("x"), at.alias("y")) if axis == "x" else F.struct(at.alias("x"), F.lit(bound).alias("y"))
            none = F.slice(F.array(p), 1, 0)
            through = F.when(inside(p) != inside(q), F.array(cut)).otherwise(none)
            return F.concat(F.when(inside(p), F.array(p)).otherwise(none), through)

        return F.when(F.size(r) > 0, F.flatten(F.transform(r, step))).otherwise(r)

    cuts = [("x", x0, True), ("x", x1, False), ("y", y0, True), ("y", y1, False)]

    def go(r: Column, k: int) -> Column:
        return r if k == len(cuts) else let(side(r, *cuts[k]), lambda v: go(v, k + 1))

    return let(F.transform(ring, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))), lambda r: go(r, 0))
