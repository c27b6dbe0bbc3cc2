"""Points near other points, near lines, or inside regions.

Every point gets a Morton cell code. A disc, a buffered line piece or a polygon
is covered by a few ranges of codes. Points are sorted by code across
partitions; each range is sent to the partitions whose codes it meets and is
resolved there by binary search in the sorted codes; what the ranges return is
refined with exact distances or ray casting.

Skew: a dense place only means more partitions there, as the sort splits
anywhere, even inside one cell. Partitions that attract many ranges are split
on the range side, with the points repeated for each part.

Defined results for dirty input: geometries that are NULL, or hold NULL, NaN or
infinite coordinates only, are unusable and left out; single unusable vertices
of a line or ring are skipped; a line of one vertex is a point. Distances are
inclusive. Repeated rows each count. Rings of fewer than three vertices contain
nothing; a point in a hole is outside. Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geometry import contains
from ..session import if_small, settled, shuffle_partitions

#: Cells are squares of this side at the finest level, in metres, with indices offset to be positive.
CELL = 0.5
_BITS = 31
_OFFSET = 1 << (_BITS - 1)
_TOP = (1 << _BITS) - 1
_CHUNK = 1_000_000


def usable(x: Column, y: Column) -> Column:
    big = F.lit(1e15)
    return x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y) & (F.abs(x) < big) & (F.abs(y) < big)


# Morton codes, the same in the JVM and in numpy -------------------------------------------------

#: The masks that spread the bits of an index to every second place.
_SPREAD = [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)]


def _spread_column(v: Column) -> Column:
    for shift, mask in _SPREAD:
        v = (v.bitwiseOR(F.shiftleft(v, shift))).bitwiseAND(F.lit(mask))
    return v


def cell_code(x: Column, y: Column) -> Column:
    """Morton code of the finest cell of a point, as bigint."""

    def index(c: Column) -> Column:
        return F.least(F.greatest(F.floor(c / F.lit(CELL)) + F.lit(_OFFSET), F.lit(0)), F.lit(_TOP)).cast("bigint")

    return _spread_column(index(x)).bitwiseOR(F.shiftleft(_spread_column(index(y)), 1))


def _spread(v: np.ndarray) -> np.ndarray:
    for shift, mask in _SPREAD:
        v = (v | (v << np.int64(shift))) & np.int64(mask)
    return v


def _index(v: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(v / CELL) + _OFFSET, 0, _TOP).astype(np.int64)


def cover_boxes(x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code ranges that cover boxes: (row of the box, lowest code, highest code).

    Each box is covered by cells of a level at which it spans at most 3 x 3 of
    them; neighbouring ranges are merged.
    """
    ix0, iy0, ix1, iy1 = _index(x0), _index(y0), _index(x1), _index(y1)
    span = np.maximum(ix1 - ix0, iy1 - iy0)
    level = np.ceil(np.log2(np.maximum(span / 2, 1))).astype(np.int64)
    cx0, cy0, cx1, cy1 = (v >> level for v in (ix0, iy0, ix1, iy1))
    rows, codes = [], []
    here = np.arange(len(x0))
    for dx in range(4):
        for dy in range(4):
            ok = (cx0 + dx <= cx1) & (cy0 + dy <= cy1)
            rows.append(here[ok])
            codes.append(_spread(cx0[ok] + dx) | (_spread(cy0[ok] + dy) << np.int64(1)))
    rows, codes = np.concatenate(rows), np.concatenate(codes)
    return _merged(rows, codes, level[rows])


def _merged(rows: np.ndarray, codes: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of finest codes from cell codes of a level, runs of successive cells joined."""
    order = np.lexsort((codes, rows))
    rows, codes, level = rows[order], codes[order], level[order]
    if not len(rows):
        return rows, codes, codes
    new = np.concatenate(([True], (rows[1:] != rows[:-1]) | (codes[1:] != codes[:-1] + 1)))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(rows)) - 1
    shift = 2 * level[first]
    return rows[first], codes[first] << shift, ((codes[last] + 1) << shift) - 1


# Exact refinement --------------------------------------------------------------------------------


def segment_distance(px, py, ax, ay, bx, by):
    """Distances of points to segments, elementwise."""
    dx, dy = bx - ax, by - ay
    length2 = dx * dx + dy * dy
    with np.errstate(divide="ignore", invalid="ignore"):
        t = np.where(length2 > 0, ((px - ax) * dx + (py - ay) * dy) / length2, 0.0)
    t = np.clip(t, 0, 1)
    return np.hypot(px - (ax + t * dx), py - (ay + t * dy))


def inside_rings(px: np.ndarray, py: np.ndarray, rings: list[np.ndarray]) -> np.ndarray:
    """Even-odd rule over all rings, so holes exclude whatever their direction."""
    inside = np.zeros(len(px), dtype=bool)
    for r in rings:
        x0, y0 = r[:, 0], r[:, 1]
        x1, y1 = np.roll(x0, -1), np.roll(y0, -1)
        for ax, ay, bx, by in zip(x0, y0, x1, y1):
            if ay != by:
                hit = ((ay > py) != (by > py)) & (px < (bx - ax) * (py - ay) / (by - ay) + ax)
                inside ^= hit
    return inside


# The range join ----------------------------------------------------------------------------------


class SortedPoints:
    """Points (id, x, y), sorted by cell code across partitions and settled; with the codes at partition borders."""

    def __init__(self, points: DataFrame, partitions: int | None = None):
        n = partitions or shuffle_partitions(points.sparkSession)
        coded = points.filter(usable(F.col("x"), F.col("y"))).select(F.col("id").cast("bigint").alias("id"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).withColumn("code", cell_code(F.col("x"), F.col("y")))
        self.rows = settled(coded.repartitionByRange(n, "code", "id").sortWithinPartitions("code"))

        def borders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            lo, hi = None, None
            for pdf in batches:
                if len(pdf):
                    lo = int(pdf["code"].iloc[0]) if lo is None else lo
                    hi = int(pdf["code"].iloc[-1])
            if lo is not None:
                yield pd.DataFrame({"pid": [TaskContext.get().partitionId()], "lo": [lo], "hi": [hi]})

        found = sorted(self.rows.select("code").mapInPandas(borders, "pid int, lo bigint, hi bigint").collect(), key=lambda r: r["pid"])
        self.pids = np.array([r["pid"] for r in found], dtype=np.int64)
        self.lows = np.array([r["lo"] for r in found], dtype=np.int64)
        self.highs = np.array([r["hi"] for r in found], dtype=np.int64)


def _routed(ranges: DataFrame, points: SortedPoints) -> DataFrame:
    """ranges with one row for each partition of points whose codes they meet."""
    pids, lows, highs = points.pids, points.lows, points.highs

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            first = np.searchsorted(highs, pdf["lo"].to_numpy(), "left")
            after = np.searchsorted(lows, pdf["hi"].to_numpy(), "right")
            n = np.maximum(after - first, 0)
            rows = np.repeat(np.arange(len(pdf)), n)
            nth = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
            out = pdf.iloc[rows].copy()
            out["pid"] = pids[first[rows] + nth] if len(rows) else np.empty(0, dtype=np.int64)
            yield out

    return ranges.mapInPandas(route, f"{ranges.schema.simpleString()[7:-1].replace(':', ' ')}, pid bigint")


def _parts(routed: DataFrame, part_rows: int) -> DataFrame:
    """pid, parts: into how many tasks each partition's ranges are split; one row per partition."""
    return if_small(routed.groupBy("pid").agg(F.ceil(F.count(F.lit(1)) / F.lit(part_rows)).cast("int").alias("parts")))


def range_join(ranges: DataFrame, points: SortedPoints, refine, schema: str, part_rows: int = 200_000) -> DataFrame:
    """Rows of refine(region rows, point ids, xs, ys) over all candidates.

    ranges: lo, hi and whatever refine needs of a region. A task holds one
    partition of the points and reads its ranges as a stream; candidates are made,
    refined and handed on in chunks, so what a dense place matches is never held
    at once. Partitions that attract many ranges are split on the range side.
    """
    routed = settled(_routed(ranges, points))
    parts = _parts(routed, part_rows)
    extra = [f for f in routed.schema.fields if f.name not in ("lo", "hi", "pid")]
    # one stream for each (partition, part): first the points by code, then the ranges
    part = F.expr("cast(pmod(xxhash64(*), 1073741824) as int)")
    # no NULLs: they would turn whole numbers into inexact ones
    zero = lambda t: F.lit(None if isinstance(t, (T.StringType, T.ArrayType, T.StructType)) else 0).cast(t)
    left = routed.withColumn("part", part).join(parts, "pid").select("pid", (F.col("part") % F.col("parts")).alias("part"), F.lit(True).alias("is_range"), F.col("lo").alias("code"), "hi", F.lit(0.0).alias("px"), F.lit(0.0).alias("py"), F.lit(0).cast("bigint").alias("pt"), *[F.col(f.name).alias(f"r_{f.name}") for f in extra])
    right = points.rows.withColumn("pid", F.spark_partition_id().cast("bigint")).join(parts, "pid").select("pid", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(False).alias("is_range"), "code", F.lit(0).cast("bigint").alias("hi"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("id").alias("pt"), *[zero(f.dataType).alias(f"r_{f.name}") for f in extra])
    names = [f.name for f in extra]

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held, sorted_points = None, [], None
        for pdf in batches:
            pid, prt, ranged = pdf["pid"].to_numpy(), pdf["part"].to_numpy(), pdf["is_range"].to_numpy(dtype=bool)
            cut = np.flatnonzero((pid[1:] != pid[:-1]) | (prt[1:] != prt[:-1]) | (ranged[1:] != ranged[:-1])) + 1
            for i, j in zip(np.concatenate(([0], cut)), np.append(cut, len(pdf))) if len(pdf) else ():
                if (pid[i], prt[i]) != at:
                    at, held, sorted_points = (pid[i], prt[i]), [], None
                if not ranged[i]:
                    held.append(tuple(pdf[c].to_numpy()[i:j] for c in ("code", "pt", "px", "py")))
                    continue
                if sorted_points is None:
                    if not held:
                        continue
                    sorted_points, held = [np.concatenate(c) for c in zip(*held)], []
                codes, ids, xs, ys = sorted_points
                region = pdf.iloc[i:j][[f"r_{n}" for n in names]].set_axis(names, axis=1)
                first = np.searchsorted(codes, pdf["code"].to_numpy()[i:j], "left")
                n = np.searchsorted(codes, pdf["hi"].to_numpy()[i:j], "right") - first
                for rows, nth in _chunks(n):
                    found = refine(region, rows, *(v[first[rows] + nth] for v in (ids, xs, ys)))
                    if len(found):
                        yield found

    both = left.unionByName(right)
    spread = both.repartition(shuffle_partitions(routed.sparkSession), "pid", "part").sortWithinPartitions("pid", "part", "is_range", "code")
    return spread.mapInPandas(match, schema)


def _chunks(n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, number within the row) of all candidates, n for each row, in chunks of about _CHUNK; a row may be cut as well."""
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    for begin in range(0, total, _CHUNK):
        k = np.arange(begin, min(total, begin + _CHUNK))
        rows = np.searchsorted(ends, k, "right")
        yield rows, k - (ends[rows] - n[rows])


# Queries ------------------------------------------------------------------------------------------


def disc_ranges(centres: DataFrame, radius: float) -> DataFrame:
    """lo, hi, id, x, y: ranges that cover the disc of each centre (id, x, y)."""

    def cover(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x, y = pdf["x"].to_numpy(), pdf["y"].to_numpy()
            rows, lo, hi = cover_boxes(x - radius, y - radius, x + radius, y + radius)
            yield pd.DataFrame({"lo": lo, "hi": hi, "id": pdf["id"].to_numpy()[rows], "x": x[rows], "y": y[rows]})

    usable_centres = centres.filter(usable(F.col("x"), F.col("y"))).select(F.col("id").cast("bigint").alias("id"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    return usable_centres.mapInPandas(cover, "lo bigint, hi bigint, id bigint, x double, y double")


PAIR = "id1 bigint, id2 bigint, distance double"


def points_within(centres: DataFrame, points: SortedPoints, radius: float, same: bool = False) -> DataFrame:
    """id1 (centre), id2 (point), distance for distances <= radius; same: one table with itself, id1 < id2 only."""

    def refine(region, rows, ids, xs, ys):
        rid = region["id"].to_numpy()[rows]
        d = np.hypot(xs - region["x"].to_numpy()[rows], ys - region["y"].to_numpy()[rows])
        ok = (d <= radius) & (rid < ids) if same else d <= radius
        return pd.DataFrame({"id1": rid[ok], "id2": ids[ok], "distance": d[ok]})

    return range_join(disc_ranges(centres, radius), points, refine, PAIR)


def line_pieces(lines: DataFrame, piece: float) -> DataFrame:
    """id, ax, ay, bx, by: segments of lines (id, geometry), cut to pieces of at most `piece` length."""
    vertex = F.filter(F.col("geometry"), lambda p: p.isNotNull() & usable(p["x"], p["y"]))
    segments = (
        lines.select(F.col("id").cast("bigint").alias("id"), vertex.alias("v"))
        .filter(F.size("v") > 0)
        .select("id", F.explode(F.expr("transform(sequence(0, greatest(size(v) - 2, 0)), i -> struct(v[i] as a, v[least(i + 1, size(v) - 1)] as b))")).alias("s"))
        .select("id", F.col("s.a.x").cast("double").alias("ax"), F.col("s.a.y").cast("double").alias("ay"), F.col("s.b.x").cast("double").alias("bx"), F.col("s.b.y").cast("double").alias("by"))
    )
    n = F.greatest(F.ceil(F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")) / F.lit(piece)), F.lit(1)).cast("bigint")
    cut = segments.withColumn("n", n).withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
    return cut


def lines_within(lines: DataFrame, points: SortedPoints, radius: float, piece: float = 32.0) -> DataFrame:
    """id1 (line), id2 (point), distance: points within radius of a line, each pair once, with the least distance."""

    def cover(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ax, ay, bx, by, n, i = (pdf[c].to_numpy() for c in ("ax", "ay", "bx", "by", "n", "i"))
            sx, sy, ex, ey = ax + (bx - ax) * i / n, ay + (by - ay) * i / n, ax + (bx - ax) * (i + 1) / n, ay + (by - ay) * (i + 1) / n
            pad = radius + 1e-6
            rows, lo, hi = cover_boxes(np.minimum(sx, ex) - pad, np.minimum(sy, ey) - pad, np.maximum(sx, ex) + pad, np.maximum(sy, ey) + pad)
            yield pd.DataFrame({"lo": lo, "hi": hi, "id": pdf["id"].to_numpy()[rows], "ax": ax[rows], "ay": ay[rows], "bx": bx[rows], "by": by[rows]})

    ranges = line_pieces(lines, piece).mapInPandas(cover, "lo bigint, hi bigint, id bigint, ax double, ay double, bx double, by double")

    def refine(region, rows, ids, xs, ys):
        d = segment_distance(xs, ys, *(region[c].to_numpy()[rows] for c in ("ax", "ay", "bx", "by")))
        ok = d <= radius
        return pd.DataFrame({"id1": region["id"].to_numpy()[rows][ok], "id2": ids[ok], "distance": d[ok]})

    return range_join(ranges, points, refine, PAIR).groupBy("id1", "id2").agg(F.min("distance").alias("distance"))


def _rings(xs, ys, sizes) -> list[np.ndarray]:
    """Rings of one polygon from its flat coordinates; empty if the shell is degenerate."""
    pts = np.column_stack([np.asarray(xs, dtype=float), np.asarray(ys, dtype=float)])
    rings = [r if len(r) >= 3 else np.empty((0, 2)) for r in np.split(pts, np.cumsum(np.asarray(sizes, dtype=int))[:-1])]
    return rings if rings and len(rings[0]) else []


def cover_polygon(rings: list[np.ndarray], cells: int = 32) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code ranges (lowest, highest, whether wholly inside) of the cells of a grid over the polygon's box that meet it."""
    shell = rings[0]
    ix0, ix1 = _index(np.array([shell[:, 0].min(), shell[:, 0].max()]))
    iy0, iy1 = _index(np.array([shell[:, 1].min(), shell[:, 1].max()]))
    level = max(0, math.ceil(math.log2(max(ix1 - ix0, iy1 - iy0, 1) / cells)))
    cx0, cx1, cy0, cy1 = ix0 >> level, ix1 >> level, iy0 >> level, iy1 >> level
    side = CELL * (1 << level)
    left, low = ((c << level) - _OFFSET for c in (int(cx0), int(cy0)))
    gx, gy = left * CELL + (np.arange(cx1 - cx0 + 1) + 0.5) * side, low * CELL + (np.arange(cy1 - cy0 + 1) + 0.5) * side
    mx, my = (m.ravel() for m in np.meshgrid(gx, gy))
    # a cell is on the border if an edge comes within its half diagonal of its centre, else its centre tells for all of it
    edge = np.zeros(len(mx), dtype=bool)
    reach = side * math.sqrt(0.5) + 1e-6
    for r in rings:
        for (ax, ay), (bx, by) in zip(r, np.roll(r, -1, axis=0)):
            edge |= segment_distance(mx, my, ax, ay, bx, by) <= reach
    out = []
    # codes are clamped at the rim of the plane, so a cell there may hold points from beyond it
    rim = (_index(mx) <= 0) | (_index(mx) >= _TOP) | (_index(my) <= 0) | (_index(my) >= _TOP)
    edge |= rim
    for take, whole in ((inside_rings(mx, my, rings) & ~edge, True), (edge, False)):
        codes = _spread(_index(mx[take]) >> level) | (_spread(_index(my[take]) >> level) << np.int64(1))
        _, lo, hi = _merged(np.zeros(len(codes), dtype=np.int64), codes, np.full(len(codes), level, dtype=np.int64))
        out.append((lo, hi, np.full(len(lo), whole)))
    return tuple(np.concatenate(c) for c in zip(*out))


def regions_containing(regions: DataFrame, points: SortedPoints, small: int = 10_000) -> DataFrame:
    """id1 (region), id2 (point), distance 0: the points inside each polygon (id, geometry).

    Code ranges carry the polygon's number only. Points in cells wholly inside are
    matches as they are; those in border cells meet their polygon's edges again,
    in the JVM, by a broadcast of up to `small` polygons or else a join on the number.
    """

    ok_ring = lambda r: F.filter(F.coalesce(r, F.array()), lambda p: p.isNotNull() & usable(p["x"], p["y"]))
    clean = settled(regions.filter(F.size("geometry") > 0).select(F.col("id").cast("bigint").alias("id"), F.transform("geometry", ok_ring).alias("rings")))
    flat = clean.select("id", F.flatten(F.transform("rings", lambda r: r["x"])).alias("xs"), F.flatten(F.transform("rings", lambda r: r["y"])).alias("ys"), F.transform("rings", F.size).alias("sizes"))

    def cover(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for rid, xs, ys, sizes in zip(pdf["id"], pdf["xs"], pdf["ys"], pdf["sizes"]):
                rings = _rings(xs, ys, sizes)
                if rings:
                    lo, hi, whole = cover_polygon(rings)
                    yield pd.DataFrame({"lo": lo, "hi": hi, "id": np.full(len(lo), rid), "whole": whole})

    ranges = flat.mapInPandas(cover, "lo bigint, hi bigint, id bigint, whole boolean")

    def refine(region, rows, ids, xs, ys):
        return pd.DataFrame({"id1": region["id"].to_numpy()[rows].astype(np.int64), "id2": ids, "x": xs, "y": ys, "whole": region["whole"].to_numpy()[rows].astype(bool)})

    met = settled(range_join(ranges, points, refine, "id1 bigint, id2 bigint, x double, y double, whole boolean"))
    solid = F.filter("rings", lambda r: F.size(r) >= 3)
    edges = if_small(clean.select(F.col("id").alias("id1"), solid.alias("rings")).filter("size(rings) > 0"), small)
    border = met.filter("not whole").join(edges, "id1").filter(contains(F.col("rings"), F.col("x"), F.col("y")))
    return met.filter("whole").select("id1", "id2").unionByName(border.select("id1", "id2")).withColumn("distance", F.lit(0.0))


def spots(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(spots: id, x, y; members: id, spot): equal coordinates as one spot named after its least point, with who stands there.

    A search over spots has no pairs of copies; members bring each of them back.
    """
    ok = points.filter(usable(F.col("x"), F.col("y"))).select("id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    at = settled(ok.groupBy("x", "y").agg(F.min("id").alias("spot")))
    return at.select(F.col("spot").alias("id"), "x", "y"), ok.join(at, ["x", "y"]).select("id", "spot")
