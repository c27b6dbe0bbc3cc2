"""Queries of levels, submodels and what is filled from the surroundings, with the SQL they are held against.

The DEM is the vectors of `embeddings` laid over the plane: tiles of 8 by 8 pixels of 1,100 m, in rows of 20 tiles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import cleaning as K
from ..operators import graph as A
from ..operators import levels as L
from ..operators import network as N
from ..operators import raster as R
from ..operators import sections as X
from ..operators import submodels as S
from ..operators.near import SortedPoints, points_within
from ..session import read, settled
from .networks import _ENDS, _PTS, _SEGS, _hits, _lines, _points

QUERIES, ORACLE = {}, {}
_GRID = 8800.0


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _dem(s: SparkSession, d: str) -> DataFrame:
    v = F.col("vec_id")
    data = F.transform("embedding", lambda e: F.when(e > 0.25, F.lit(-9999.0)).otherwise(e.cast("double") * 20 + 20))
    return read(s, d, "embeddings").select(v.alias("tile"), (F.lit(870000.0) + v % 20 * _GRID).alias("x0"), (F.lit(4140000.0) + F.floor(v / 20) * _GRID).alias("y0"), F.lit(1100.0).alias("dx"), F.lit(1100.0).alias("dy"), F.lit(8).alias("nx"), F.lit(8).alias("ny"), F.lit(-9999.0).alias("nodata"), data.alias("data"))


def _at_dem(s: SparkSession, d: str, points: DataFrame) -> DataFrame:
    """id, dem in metres; on-grid coordinates are moved a little so that floors agree everywhere."""
    return R.sample(points.select("id", "x", "y"), _dem(s, d).withColumn("x0", F.col("x0") + 0.001).withColumn("y0", F.col("y0") + 0.001), _GRID).withColumnRenamed("z", "dem")


def _dem_sql(points: str, name: str = "z") -> str:
    """CTEs: the DEM at points (id, x, y)."""
    return f"""{name}t AS (SELECT vec_id % 20 AS tc, vec_id // 20 AS tr, embedding AS e FROM embeddings),
{name} AS (SELECT id, CASE WHEN v <= 0.25 THEN v * 20 + 20 END AS dem FROM (SELECT p.id, CAST(e[CAST(floor((y - 4140000.001 - tr * 8800) / 1100) AS INTEGER) * 8 + CAST(floor((x - 870000.001 - tc * 8800) / 1100) AS INTEGER) + 1] AS DOUBLE) AS v
 FROM {points} p LEFT JOIN {name}t ON tc = CAST(floor((x - 870000.001) / 8800) AS BIGINT) AND tr = CAST(floor((y - 4140000.001) / 8800) AS BIGINT)) q)"""


def _n(c: str) -> str:
    return f"(CASE WHEN isnan({c}) THEN NULL ELSE {c} END)"


_INLETS = _PTS.format("inlets")


@query(f"""WITH {_dem_sql(_INLETS)}, n AS (SELECT fid, {_n('rimelev')} AS rim, {_n('invertelev')} AS inv, {_n('depth')} AS dep, dem FROM inlets LEFT JOIN z ON id = fid),
b AS (SELECT *, dep IS NULL OR dep <= 0 AS bad, rim IS NOT NULL AND rim > 0 AS hr, inv IS NOT NULL AS hi FROM n),
c AS (SELECT *, CASE WHEN hr THEN rim WHEN hi AND inv > 0 THEN inv + 9.84252 WHEN dem IS NOT NULL THEN dem * 3.28084 ELSE 0 END AS base, CASE WHEN hr THEN 'rim' WHEN hi AND inv > 0 THEN 'invert' WHEN dem IS NOT NULL THEN 'dem' ELSE 'zero' END AS bs FROM b)
SELECT fid, round(CASE WHEN bad THEN base WHEN NOT hr AND hi AND inv > 0 THEN inv + dep WHEN NOT hr AND NOT hi THEN coalesce(dem * 3.28084, 0) ELSE rim END, 3) AS new_rim,
 round(CASE WHEN bad THEN base - 9.84252 WHEN hr AND NOT hi THEN rim - dep WHEN NOT hr AND NOT hi THEN coalesce(dem * 3.28084, 0) - dep ELSE inv END, 3) AS new_invert,
 CASE WHEN bad THEN 9.84252 ELSE dep END AS new_depth, CASE WHEN bad THEN bs WHEN NOT hr OR NOT hi THEN 'completed' ELSE 'kept' END AS source FROM c""")
def node_level_normalise(s: SparkSession, d: str) -> DataFrame:
    """Levels of inlets completed from each other and from the DEM at the inlet."""
    t = read(s, d, "inlets").select("fid", F.col("rimelev").alias("rim"), F.col("invertelev").alias("invert"), "depth")
    dem = _at_dem(s, d, _points(s, d, "inlets")).withColumnRenamed("id", "fid")
    return K.normalised_nodes(t.join(dem, "fid", "left")).select("fid", F.round("new_rim", 3).alias("new_rim"), F.round("new_invert", 3).alias("new_invert"), "new_depth", "source")


_END_LEVELS = f"(SELECT q.id, side, x, y, CASE side WHEN 'start' THEN upelev ELSE downelev END AS level FROM {_ENDS.format('gravity_mains')} q JOIN gravity_mains g ON g.fid = q.id)"


@query(f"""WITH {_dem_sql(_INLETS)}, n AS (SELECT fid, geometry.x AS x, geometry.y AS y, {_n('rimelev')} AS rim, {_n('invertelev')} AS inv, {_n('depth')} AS dep, dem * 3.28084 AS dem FROM inlets LEFT JOIN z ON id = fid),
b AS (SELECT *, coalesce((rim IS NULL OR rim <= 0 OR abs(rim - dem) > 15) AND dem IS NOT NULL, false) AS rb FROM n),
c AS (SELECT *, CASE WHEN rb THEN dem ELSE rim END AS nr FROM b),
e AS (SELECT *, coalesce(inv IS NULL OR inv <= 0 OR inv >= nr OR nr - inv > 40 OR nr IS NULL, true) AS ib FROM c),
k AS (SELECT *, rb AND NOT ib AND coalesce(dep > 0 AND dep <= 40, false) AS kp FROM e),
l AS (SELECT k.fid, min(level) AS low FROM k JOIN {_END_LEVELS} g ON g.x BETWEEN k.x - 5 AND k.x + 5 AND g.y BETWEEN k.y - 5 AND k.y + 5 AND sqrt((g.x-k.x)*(g.x-k.x)+(g.y-k.y)*(g.y-k.y)) <= 5 AND k.ib AND level > 0 AND NOT isnan(level) AND level < nr AND nr - level <= 40 GROUP BY k.fid)
SELECT k.fid, round(nr, 3) AS new_rim, round(CASE WHEN kp THEN nr - dep WHEN ib THEN coalesce(low, nr - 9.84252) ELSE inv END, 3) AS new_invert,
 CASE WHEN rb AND (ib OR kp) THEN 'rim+invert' WHEN rb THEN 'rim' WHEN ib THEN 'invert' END AS reason FROM k LEFT JOIN l USING (fid)""")
def node_level_repair(s: SparkSession, d: str) -> DataFrame:
    """Implausible levels of inlets repaired from the DEM and the pipe ends within 5 m."""
    pts = _points(s, d, "inlets")
    dem = _at_dem(s, d, pts).select("id", (F.col("dem") * C.FT_PER_M).alias("dem_ft"))
    t = read(s, d, "inlets").select(F.col("fid").alias("id"), F.col("rimelev").alias("rim"), F.col("invertelev").alias("invert"), "depth").join(dem, "id", "left")
    ends = settled(_levelled_ends(s, d))
    low = points_within(pts, SortedPoints(ends.select("id", "x", "y")), 5.0).join(ends.select(F.col("id").alias("id2"), "level"), "id2").select(F.col("id1").alias("id"), "level")
    return K.repaired_nodes(t, low).select(F.col("id").alias("fid"), F.round("new_rim", 3).alias("new_rim"), F.round("new_invert", 3).alias("new_invert"), "reason")


def _levelled_ends(s: SparkSession, d: str) -> DataFrame:
    """id (twice the pipe's, plus one for its end), x, y, level of pipe ends."""
    m = read(s, d, "gravity_mains")
    ends = A.line_ends(m.select(F.col("fid").alias("id"), "geometry")).join(m.select(F.col("fid").alias("id"), "upelev", "downelev"), "id")
    return ends.select((F.col("id") * 2 + F.when(F.col("end") == "start", 0).otherwise(1)).alias("id"), "x", "y", F.when(F.col("end") == "start", F.col("upelev")).otherwise(F.col("downelev")).alias("level"))


_PIPE_ENDS = f"(SELECT id * 2 + CASE side WHEN 'start' THEN 0 ELSE 1 END AS id, x, y FROM {_ENDS.format('gravity_mains')})"


@query(f"""WITH {_dem_sql(_PIPE_ENDS)}, p AS (SELECT fid, {_n('upelev')} AS u, {_n('downelev')} AS w FROM gravity_mains),
e AS (SELECT q.id, q.id // 2 AS fid, x, y, CASE WHEN q.id % 2 = 0 THEN CASE WHEN u > 0 AND u < 200 THEN u END ELSE CASE WHEN w > 0 AND w < 200 THEN w END END AS own, CASE WHEN q.id % 2 = 1 THEN CASE WHEN u > 0 AND u < 200 THEN u END ELSE CASE WHEN w > 0 AND w < 200 THEN w END END AS other FROM {_PIPE_ENDS} q JOIN p ON p.fid = q.id // 2),
i AS (SELECT e.id, min(invertelev) AS inv FROM e JOIN inlets n ON n.geometry.x BETWEEN e.x - 5 AND e.x + 5 AND n.geometry.y BETWEEN e.y - 5 AND e.y + 5 AND sqrt((n.geometry.x-e.x)*(n.geometry.x-e.x)+(n.geometry.y-e.y)*(n.geometry.y-e.y)) <= 5 WHERE {_n('invertelev')} > 0 GROUP BY e.id)
SELECT fid, CASE WHEN e.id % 2 = 0 THEN 'up' ELSE 'down' END AS side, round(coalesce(own, inv, other, dem * 3.28084 - 9.84252), 4) AS level, CASE WHEN own IS NOT NULL THEN 'own' WHEN inv IS NOT NULL THEN 'node' WHEN other IS NOT NULL THEN 'other end' WHEN dem IS NOT NULL THEN 'dem' END AS source FROM e LEFT JOIN i USING (id) LEFT JOIN z USING (id)""")
def pipe_end_cascade(s: SparkSession, d: str) -> DataFrame:
    """Pipe ends from their own level, the lowest invert of the inlets within 5 m, the other end, or the DEM."""
    ends = settled(_levelled_ends(s, d))
    ok = F.when((F.col("level") > 0) & (F.col("level") < 200) & ~F.isnan("level"), F.col("level"))
    e = ends.select("id", F.floor(F.col("id") / 2).cast("bigint").alias("fid"), ok.alias("own"))
    other = e.select(F.col("id").bitwiseXOR(F.lit(1)).alias("id"), F.col("own").alias("other"))
    inlets = read(s, d, "inlets").withColumn("inv", C.finite(F.col("invertelev"))).filter("inv > 0").select(F.col("fid").alias("id2"), "inv", F.col("geometry.x").alias("x"), F.col("geometry.y").alias("y"))
    near = points_within(ends.select("id", "x", "y"), SortedPoints(inlets.select(F.col("id2").alias("id"), "x", "y")), 5.0).join(inlets.select("id2", "inv"), "id2").groupBy(F.col("id1").alias("id")).agg(F.min("inv").alias("inv"))
    j = e.join(other, "id").join(near, "id", "left").join(_at_dem(s, d, ends), "id", "left")
    value, source = K.cascade(("own", F.col("own").isNotNull(), F.col("own")), ("node", F.col("inv").isNotNull(), F.col("inv")), ("other end", F.col("other").isNotNull(), F.col("other")), ("dem", F.col("dem").isNotNull(), F.col("dem") * C.FT_PER_M - F.lit(K.DEPTH_FT)))
    return j.select("fid", F.when(F.col("id") % 2 == 0, "up").otherwise("down").alias("side"), F.round(value, 4).alias("level"), source.alias("source"))


def _nearest_sql(limit: float) -> str:
    return f"(SELECT e.id, min_by(invertelev, (sqrt((n.geometry.x-e.x)*(n.geometry.x-e.x)+(n.geometry.y-e.y)*(n.geometry.y-e.y)), n.fid)) AS inv FROM {_PIPE_ENDS} e JOIN inlets n ON n.geometry.x BETWEEN e.x - {limit} AND e.x + {limit} AND n.geometry.y BETWEEN e.y - {limit} AND e.y + {limit} AND sqrt((n.geometry.x-e.x)*(n.geometry.x-e.x)+(n.geometry.y-e.y)*(n.geometry.y-e.y)) < {limit} WHERE {_n('invertelev')} > 0 GROUP BY e.id)"


@query(f"""WITH {_dem_sql(_PIPE_ENDS)}, c AS (SELECT e.id // 2 AS id, CASE WHEN e.id % 2 = 0 THEN 'up' ELSE 'down' END AS side, CASE WHEN e.id % 2 = 0 THEN {_n('upelev')} ELSE {_n('downelev')} END AS l, a.inv AS nl, b.inv AS near, dem FROM {_PIPE_ENDS} e JOIN gravity_mains g ON g.fid = e.id // 2 LEFT JOIN {_nearest_sql(5.0)} a USING (id) LEFT JOIN {_nearest_sql(40.0)} b USING (id) LEFT JOIN z USING (id)),
k AS (SELECT *, CASE WHEN NOT coalesce(l IS NULL OR (l <= 0 AND dem - l > 12.2), true) THEN l END AS own FROM c), o AS (SELECT *, max(own) OVER (PARTITION BY id) AS oth FROM k)
SELECT id, side AS "end", round(coalesce(own, nl, oth, near, dem - 3), 4) AS level, CASE WHEN own IS NOT NULL THEN 'own' WHEN nl IS NOT NULL THEN 'node' WHEN oth IS NOT NULL THEN 'other end' WHEN near IS NOT NULL THEN 'near node' WHEN dem IS NOT NULL THEN 'dem' END AS source FROM o""")
def culvert_invert_cascade(s: SparkSession, d: str) -> DataFrame:
    """Placeholder levels of pipe ends replaced by the nearest inlet's invert, the other end, a near inlet, or the DEM."""
    ends = settled(_levelled_ends(s, d))
    inlets = settled(read(s, d, "inlets").withColumn("inv", C.finite(F.col("invertelev"))).filter("inv > 0").select(F.col("fid").alias("id2"), "inv", F.col("geometry.x").alias("x"), F.col("geometry.y").alias("y")))
    near = lambda limit, name: N.nearest_points(ends.select("id", "x", "y"), inlets.select(F.col("id2").alias("id"), "x", "y"), limit).join(inlets.select("id2", "inv"), "id2").select(F.col("id1").alias("id"), F.col("inv").alias(name))
    j = ends.join(near(5.0, "node_level"), "id", "left").join(near(40.0, "near_level"), "id", "left").join(_at_dem(s, d, ends), "id", "left")
    e = j.select(F.floor(F.col("id") / 2).cast("bigint").alias("id"), F.when(F.col("id") % 2 == 0, "up").otherwise("down").alias("end"), C.finite(F.col("level")).alias("level"), "node_level", "near_level", "dem")
    return K.culvert_inverts(e).withColumn("level", F.round("level", 4))


@query(f"""WITH {_dem_sql(_PTS.format('storagenodes'))}, n AS (SELECT fid, CASE WHEN name IS NULL THEN 0.0 WHEN length(name) % 3 = 0 THEN NULL ELSE CAST(length(name) AS DOUBLE) END AS level, CASE WHEN code IS NULL THEN NULL ELSE 2.0 END AS bed, dem FROM storagenodes LEFT JOIN z ON id = fid),
m AS (SELECT *, CASE WHEN level IS NULL OR level = 0 THEN dem ELSE level END AS nl FROM n) SELECT fid, round(nl, 5) AS new_level, round(CASE WHEN bed IS NULL OR bed = 0 THEN nl - 3 ELSE bed END, 5) AS new_bed FROM m""")
def storage_fill(s: SparkSession, d: str) -> DataFrame:
    """Levels of storage nodes from the DEM where they have none; what stands for their own level is the length of their name."""
    name = F.length("name")
    n = read(s, d, "storagenodes").select("fid", F.when(F.col("name").isNull(), 0.0).when(name % 3 != 0, name.cast("double")).alias("level"), F.when(F.col("code").isNotNull(), 2.0).alias("bed"))
    dem = _at_dem(s, d, _points(s, d, "storagenodes")).withColumnRenamed("id", "fid")
    return K.storage_levels(n.join(dem, "fid", "left")).select("fid", F.round("new_level", 5).alias("new_level"), F.round("new_bed", 5).alias("new_bed"))


# Along and beside lines --------------------------------------------------------------------------------------------


@query(f"WITH {_hits('gravity_mains', '(SELECT id, x, y FROM ' + _INLETS + ' q JOIN inlets n ON n.fid = q.id WHERE ' + _n('invertelev') + ' > 0)', 3.0)}, e AS {_PIPE_ENDS}, i AS {_INLETS} SELECT line AS id, min(invertelev) AS along FROM h JOIN i ON i.id = pt JOIN e a ON a.id = line * 2 JOIN e b ON b.id = line * 2 + 1 JOIN inlets n ON n.fid = pt WHERE least(sqrt((a.x-i.x)*(a.x-i.x)+(a.y-i.y)*(a.y-i.y)), sqrt((b.x-i.x)*(b.x-i.x)+(b.y-i.y)*(b.y-i.y))) > 3 GROUP BY line")
def interior_inverts(s: SparkSession, d: str) -> DataFrame:
    """The lowest invert of the inlets along each pipe but not at its ends."""
    return L.interior_inverts(_lines(s, d, "gravity_mains"), _inverts(s, d), 3.0)


@query(f"""WITH {_hits('gravity_mains', _INLETS, 1.0)}, i AS (SELECT fid AS node, invertelev AS floor FROM inlets WHERE {_n('invertelev')} IS NOT NULL), b AS (SELECT pt, min(least({_n('upelev')}, {_n('downelev')})) AS bed FROM h JOIN gravity_mains g ON g.fid = line GROUP BY pt)
SELECT count(*) AS nodes, count(*) FILTER (floor > bed + 1e-6) AS above, count(*) FILTER (bed IS NULL) AS without FROM i LEFT JOIN b ON pt = node""")
def floor_violations(s: SparkSession, d: str) -> DataFrame:
    """Inlets whose invert lies above the lowest end of the pipes within 1 m of them."""
    nodes = read(s, d, "inlets").select(F.col("fid").alias("node"), C.finite(F.col("invertelev")).alias("floor")).filter("floor is not null")
    hits = N.points_on_lines(_points(s, d, "inlets"), _lines(s, d, "gravity_mains"), 1.0).select(F.col("pt").alias("node"), "line")
    bed = read(s, d, "gravity_mains").select(F.col("fid").alias("line"), F.least(C.finite(F.col("upelev")), C.finite(F.col("downelev"))).alias("bed"))
    return X.violations(nodes, hits.join(bed, "line").select("node", "bed"))


def _inverts(s: SparkSession, d: str) -> DataFrame:
    return _points(s, d, "inlets").join(read(s, d, "inlets").select(F.col("fid").alias("id"), F.col("invertelev").alias("invert")), "id")


def _channels(s: SparkSession, d: str) -> DataFrame:
    """Branches as channels; their width in metres and depth in feet stand in the roughness columns."""
    return read(s, d, "hydroobject").select(F.col("fid").alias("id"), "geometry", (F.col("ruwheidhoog") / 5).alias("width"), (F.col("ruwheidlaag") / 3).alias("depth_ft"))


@query()
def end_beds(s: SparkSession, d: str) -> DataFrame:
    """Bed of the channel that a pipe end lies on."""
    return L.end_beds(_lines(s, d, "gravity_mains"), _channels(s, d), _dem(s, d), _GRID, 6.0)


@query()
def outfall_levels(s: SparkSession, d: str) -> DataFrame:
    """Levels of discharge points from the bed and depth of the nearest channel."""
    p = _points(s, d, "discharge_points").join(read(s, d, "discharge_points").select(F.col("fid").alias("id"), F.col("flowelev").alias("flow_ft")), "id")
    return L.outfall_levels(p, _channels(s, d), _dem(s, d), _GRID, 40.0).select("id", "level_ft", "channel", F.round("off", 4).alias("off"))


@query()
def elevation_propagation(s: SparkSession, d: str) -> DataFrame:
    """Levels of pipe ends filled along the network in rounds, from other pipes, inlets along them, channels at their ends, and their other end."""
    z = lambda c: F.when(F.col(c).between(1, 400) & ~F.isnan(c), F.col(c))
    pipes = read(s, d, "gravity_mains").select(F.col("fid").alias("id"), "geometry", z("upelev").alias("up"), z("downelev").alias("down"))
    beds = L.end_beds(pipes.select("id", "geometry"), _channels(s, d), _dem(s, d), _GRID, 6.0)
    return L.network_levels(pipes, _inverts(s, d), beds, 0.0001).select("id", "end", F.round("value", 4).alias("value"), "source")


#: The point at a share of each branch, by the segment in which it lies.
_SHARE = """sg0 AS (SELECT *, sqrt((ax-bx)*(ax-bx)+(ay-by_)*(ay-by_)) AS n FROM {segs} q), sg AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS d0, sum(n) OVER (PARTITION BY id) AS len FROM sg0)"""


@query(f"""WITH {_SHARE.format(segs=_SEGS.format('hydroobject'))}, br AS (SELECT code, min(fid) AS id FROM hydroobject WHERE len(geometry) > 1 GROUP BY code),
lo AS (SELECT fid, upper(trim(branch_id)) AS branch, definition, chainage_fraction AS f FROM crosssection_location WHERE definition IS NOT NULL),
pt AS (SELECT lo.fid AS id, CASE WHEN n > 0 THEN ax + (f * len - d0) / n * (bx - ax) ELSE ax END AS x, CASE WHEN n > 0 THEN ay + (f * len - d0) / n * (by_ - ay) ELSE ay END AS y FROM lo JOIN br ON br.code = lo.branch JOIN sg ON sg.id = br.id AND (n > 0 OR len = 0) AND f * len >= d0 - 1e-9 AND f * len <= d0 + n + 1e-9 QUALIFY row_number() OVER (PARTITION BY lo.fid ORDER BY d0) = 1),
{_dem_sql('pt')}, nw AS (SELECT lo.fid, definition, definition || '__' || branch AS name, dem FROM lo JOIN z ON z.id = lo.fid WHERE dem IS NOT NULL),
kept AS (SELECT DISTINCT definition AS name FROM lo WHERE fid NOT IN (SELECT fid FROM nw))
SELECT name, round(max_by(dem, fid), 4) AS bottom, round(max_by(dem, fid) + 2, 4) AS top FROM nw GROUP BY name UNION ALL SELECT name, 0.0, 2.0 FROM kept""")
def trapezium_resample(s: SparkSession, d: str) -> DataFrame:
    """Profiles put on the DEM, one for each branch and definition, without those that nothing refers to any more."""
    loc = read(s, d, "crosssection_location").filter("definition is not null").select(F.col("fid").alias("id"), F.upper(F.expr("trim(branch_id)")).alias("branch"), "definition", F.col("chainage_fraction").alias("fraction"))
    h = read(s, d, "hydroobject").filter("size(geometry) > 1")
    first = h.groupBy("code").agg(F.min("fid").alias("fid"))
    br = h.join(first, ["code", "fid"]).select("code", "geometry")
    defs = loc.select(F.col("definition").alias("name"), F.lit(0.0).alias("bottom"), F.lit(2.0).alias("top")).distinct()
    tiles = _dem(s, d).withColumn("x0", F.col("x0") + 0.001).withColumn("y0", F.col("y0") + 0.001)
    return L.resampled_sections(loc, defs, br, tiles, _GRID)[1].select("name", F.round("bottom", 4).alias("bottom"), F.round("top", 4).alias("top"))


@query(f"""WITH {_SHARE.format(segs=_SEGS.format('hydroobject'))}, mid AS (SELECT id, ax + (len / 2 - d0) / n * (bx - ax) AS x, ay + (len / 2 - d0) / n * (by_ - ay) AS y FROM sg WHERE n > 0 AND len / 2 >= d0 AND len / 2 <= d0 + n QUALIFY row_number() OVER (PARTITION BY id ORDER BY d0) = 1),
{_dem_sql('mid')}, b AS (SELECT 'C_' || fid AS branch, least({_n('upelev')}, {_n('downelev')}) / 3.28084 AS bed FROM gravity_mains UNION ALL SELECT 'R_' || id, dem FROM z)
SELECT branch, round(min(bed), 4) AS bed FROM b GROUP BY branch""")
def bed_per_branch(s: SparkSession, d: str) -> DataFrame:
    """Beds of pipes from their lower end, of branches from the DEM at their middle."""
    p = read(s, d, "gravity_mains").select(F.concat(F.lit("C_"), F.col("fid").cast("string")).alias("branch"), (C.finite(F.col("upelev")) / C.FT_PER_M).alias("up"), (C.finite(F.col("downelev")) / C.FT_PER_M).alias("down"))
    r = _at_dem(s, d, settled(_middles(s, d))).select(F.concat(F.lit("R_"), F.col("id").cast("string")).alias("branch"), F.col("dem").alias("bed"), F.lit(None).cast("double").alias("shift"))
    return X.beds(p, r).withColumn("bed", F.round("bed", 4))


def _middles(s: SparkSession, d: str) -> DataFrame:
    from ..functions import geometry as G

    c = N.clean_lines(_lines(s, d, "hydroobject")).filter(G.length(F.col("c")) > 0).withColumn("m", G.midpoint(F.col("c")))
    return c.select("id", F.col("m.x").alias("x"), F.col("m.y").alias("y"))


# Submodels ---------------------------------------------------------------------------------------------------------

_PART = f"""{_SHARE.format(segs=_SEGS.format('hydroobject'))}, mid AS (SELECT id, ax + (len / 2 - d0) / n * (bx - ax) AS x, ay + (len / 2 - d0) / n * (by_ - ay) AS y FROM sg WHERE n > 0 AND len / 2 >= d0 AND len / 2 <= d0 + n QUALIFY row_number() OVER (PARTITION BY id ORDER BY d0) = 1),
rg AS (SELECT fid, unnest(range(1, len(ring)+1)) AS k, ring FROM (SELECT fid, unnest(geometry) AS ring FROM watersheds)), ed AS (SELECT fid, ring[k].x AS ax, ring[k].y AS ay, ring[k % len(ring) + 1].x AS bx, ring[k % len(ring) + 1].y AS by_ FROM rg),
ins AS (SELECT ed.fid AS region, o.id FROM ed JOIN mid o ON (ay > o.y) <> (by_ > o.y) AND o.x < (bx-ax)*(o.y-ay)/(by_-ay)+ax GROUP BY ed.fid, o.id HAVING count(*) % 2 = 1),
part AS (SELECT id, min(region) AS part FROM ins GROUP BY id)"""


def _watersheds(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "watersheds").select(F.col("fid").alias("id"), "geometry")


@query(f"WITH {_PART} SELECT h.fid AS id, part FROM hydroobject h LEFT JOIN part ON part.id = h.fid WHERE h.geometry IS NULL OR h.fid IN (SELECT id FROM mid) OR len(h.geometry) = 0")
def branch_parts(s: SparkSession, d: str) -> DataFrame:
    """Which watershed each branch belongs to, by its middle."""
    from ..functions import geometry as G

    lines = _lines(s, d, "hydroobject")
    c = G.line(F.col("geometry"))
    # a branch that is one place only is left out on both sides: it has no middle in the SQL
    return S.lines_in_parts(lines.filter(c.isNull() | (G.length(c) > 0)), _watersheds(s, d))


@query(f"""WITH en AS (SELECT q.id, side, x, y, coalesce(lower(trim(categorieoppwaterlichaam)) = 'secundair', false) AS sub FROM {_ENDS.format('hydroobject')} q JOIN hydroobject h ON h.fid = q.id),
nb AS (SELECT a.id, a.side, count(*) FILTER (b.sub) AS own, count(*) AS all_ FROM en a JOIN en b ON b.x BETWEEN a.x - 4 AND a.x + 4 AND b.y BETWEEN a.y - 4 AND a.y + 4 AND sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)) <= 4 WHERE a.sub GROUP BY a.id, a.side)
SELECT id, side AS "end" FROM nb WHERE own = 1 AND all_ > 1""")
def cut_ends(s: SparkSession, d: str) -> DataFrame:
    """Ends of secondary branches that are open only because what they meet is of another category."""
    sub, master = _secondary(s, d)
    none = s.createDataFrame([], "id bigint, x double, y double")
    return S.cut_ends(sub, master, none, ("",), 4.0).select("id", "end")


def _secondary(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    h = read(s, d, "hydroobject").select(F.col("fid").alias("id"), F.coalesce("code", F.lit("")).alias("code"), "geometry", F.lower(F.trim("categorieoppwaterlichaam")).alias("kind"))
    return h.filter("kind = 'secundair'").drop("kind"), h.drop("kind")


@query()
def cut_boundary_direction(s: SparkSession, d: str) -> DataFrame:
    """Boundaries at cut ends, with their direction from the beds of the branches that meet there."""
    sub, master = _secondary(s, d)
    none = s.createDataFrame([], "id bigint, x double, y double")
    cuts = settled(S.cut_ends(sub, master, none, ("",), 4.0))
    dem = _at_dem(s, d, settled(_middles(s, d)))
    beds = master.join(dem, "id").groupBy("code").agg(F.min("dem").alias("z_start")).withColumn("z_end", F.col("z_start"))
    return S.cut_boundaries(cuts, master, beds, tol=4.0).select("id", "end", "direction", "rule", "neighbours", F.round("z_beyond", 4).alias("z_beyond"))


@query()
def part_links(s: SparkSession, d: str) -> DataFrame:
    """Branches and pipes that join watersheds: branches without a category stand for the borders."""
    h = read(s, d, "hydroobject").select(F.col("fid").alias("id"), "code", "geometry", "categorieoppwaterlichaam")
    borders = h.filter("categorieoppwaterlichaam is null and code is not null").select("id", "code", "geometry")
    return S.part_links(h.select("id", "code", "geometry"), _lines(s, d, "gravity_mains"), borders, _watersheds(s, d))


@query()
def submodel_counts(s: SparkSession, d: str) -> DataFrame:
    """Rows of the first watershed's submodel, layer by layer."""
    h = read(s, d, "hydroobject").withColumnRenamed("fid", "id")
    part = settled(S.lines_in_parts(h.select("id", "geometry"), _watersheds(s, d)))
    nodes = read(s, d, "storagenodes").withColumnRenamed("fid", "id")
    of = settled(S.part_of(_points(s, d, "storagenodes"), _watersheds(s, d)))
    first = part.agg(F.min("part")).first()[0]
    loc = read(s, d, "crosssection_location").withColumn("branch_id", F.upper(F.expr("trim(branch_id)")))
    defs = {"trapezium": loc.select(F.col("definition").alias("name")).filter("name is not null").distinct()}
    got, alone = S.submodel(first if first is not None else -1, {"hydroobject": h.join(part, "id"), "storagenodes": nodes.join(of, "id")}, {}, loc, defs, {"storagenodes": 5.0})
    out = None
    for name, df in [*got.items(), ("standalone", alone)]:
        row = df.agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("rows"))
        out = row if out is None else out.unionByName(row)
    return out


@query()
def named_pieces(s: SparkSession, d: str) -> DataFrame:
    """Branches cut at the ends of others that meet them, and what their pieces are called."""
    h = read(s, d, "hydroobject").select(F.col("fid").alias("id"), F.coalesce("code", F.concat(F.lit("X_"), F.col("fid").cast("string"))).alias("code"), "geometry")
    j = settled(N.junction_nodes(N.t_junctions(h.select("id", "geometry"), 2.0), 5.0))
    nodes = j.groupBy("host", "junction").agg(F.min("at").alias("at")).select("host", "at")
    return S.named_pieces(h, nodes, None).select("host", "piece", "code", F.round("length", 3).alias("length"))
