"""Queries of raster, section, mesh and forcing operators, with the SQL they are held against.

Raster tiles are the vectors of `embeddings`, 8 by 8 pixels each in rows of 20 tiles.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import geometry as G
from ..operators import forcing as T
from ..operators import mesh as M
from ..operators import raster as R
from ..operators import sections as X
from ..operators.network import clean_lines
from ..session import read

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _tiles(s: SparkSession, d: str) -> DataFrame:
    v = F.col("vec_id")
    data = F.transform("embedding", lambda e: F.when(e > 0.25, F.lit(-9999.0)).otherwise(e.cast("double")))
    return read(s, d, "embeddings").select(v.alias("tile"), (v % 20 * 8.0).alias("x0"), (F.floor(v / 20) * 8.0).alias("y0"), F.lit(1.0).alias("dx"), F.lit(1.0).alias("dy"), F.lit(8).alias("nx"), F.lit(8).alias("ny"), F.lit(-9999.0).alias("nodata"), data.alias("data"))


def _samples(s: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    return read(s, d, "orders").select(k.alias("id"), (k % 1601 / 10.0 + 0.03).alias("x"), (k * 7 % 2011 / 10.0 + 0.03).alias("y"))


_TILE = "t AS (SELECT vec_id AS tile, vec_id % 20 AS tc, vec_id // 20 AS tr, embedding AS e FROM embeddings)"
_ORDER_PTS = "p AS (SELECT o_orderkey AS id, o_orderkey % 1601 / 10.0 + 0.03 AS x, o_orderkey * 7 % 2011 / 10.0 + 0.03 AS y FROM orders)"
_Z = "z AS (SELECT p.id, CASE WHEN v <= 0.25 THEN v END AS z FROM (SELECT p.id, CAST(e[CAST(floor(y - tr * 8) AS INTEGER) * 8 + CAST(floor(x - tc * 8) AS INTEGER) + 1] AS DOUBLE) AS v FROM p LEFT JOIN t ON tc = CAST(floor(x / 8) AS BIGINT) AND tr = CAST(floor(y / 8) AS BIGINT)) p)"


@query(f"WITH {_TILE}, {_ORDER_PTS}, {_Z} SELECT id, round(z, 5) AS z FROM z")
def raster_point_sample(s: SparkSession, d: str) -> DataFrame:
    return R.sample(_samples(s, d), _tiles(s, d), 8.0).select("id", F.round("z", 5).alias("z"))


@query(f"WITH {_TILE}, {_ORDER_PTS}, {_Z} SELECT id, CASE WHEN CAST(trunc(z * 40) AS INTEGER) IN (-3, -2, -1, 0, 1, 2) THEN CAST(trunc(z * 40) AS INTEGER) * 1.5 + 10 ELSE 5.0 END AS value FROM z")
def class_lookup(s: SparkSession, d: str) -> DataFrame:
    z = R.sample(_samples(s, d), _tiles(s, d), 8.0).select("id", (F.col("z") * 40).alias("z"))
    table = s.createDataFrame([(k, k * 1.5 + 10) for k in (-3, -2, -1, 0, 1, 2)], "class int, value double")
    return R.class_values(z, table, 5.0)


@query(f"""WITH {_TILE}, px AS (SELECT tc * 8 + (k - 1) % 8 + 0.5 AS x, tr * 8 + (k - 1) // 8 + 0.5 AS y, CAST(e[k] AS DOUBLE) AS v FROM t, range(1, 65) r(k) WHERE e[k] <= 0.25),
f AS (SELECT n_nationkey AS id, n_nationkey % 5 * 30.2 AS x0, n_nationkey // 5 * 30.2 AS y0 FROM nation)
SELECT id, round(avg(v), 5) AS mean, count(*) AS n FROM f JOIN px ON x > x0 AND x < x0 + 24.5 AND y > y0 AND y < y0 + 18.4 GROUP BY id""")
def zonal_mean(s: SparkSession, d: str) -> DataFrame:
    k = F.col("n_nationkey")
    x, y = k % 5 * 30.2, F.floor(k / 5) * 30.2
    ring = F.array(*[G.point(x + dx, y + dy) for dx, dy in ((0.0, 0.0), (24.5, 0.0), (24.5, 18.4), (0.0, 18.4))])
    faces = read(s, d, "nation").select(k.cast("bigint").alias("id"), F.array(ring).alias("geometry"))
    return R.zonal_mean(faces, _tiles(s, d), 8.0).select("id", F.round("mean", 5).alias("mean"), "n")


@query(f"""WITH {_TILE}, l AS (SELECT s_suppkey AS id, (s_suppkey % 12) * 10.0 + 20.3 AS x, (s_suppkey % 7) * 5.0 + 20.3 AS y0, 100.0 AS n FROM supplier),
st AS (SELECT id, x, k AS station, y0 + 10 + k * 25 AS y FROM l, range(0, 4) r(k)), o AS (SELECT id, station, x + w * 1.0 AS px, y AS py FROM st, range(-6, 7) q(w)),
v AS (SELECT id, station, CAST(e[CAST(floor(py - tr * 8) AS INTEGER) * 8 + CAST(floor(px - tc * 8) AS INTEGER) + 1] AS DOUBLE) AS v FROM o LEFT JOIN t ON tc = CAST(floor(px / 8) AS BIGINT) AND tr = CAST(floor(py / 8) AS BIGINT))
SELECT id AS line, station, round(min(CASE WHEN v <= 0.25 THEN v END), 5) AS bed FROM v GROUP BY id, station""")
def transect_profile_min(s: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    x, y = (k % 12) * 10.0 + 20.3, (k % 7) * 5.0 + 20.3
    lines = read(s, d, "supplier").select(k.alias("id"), F.array(G.point(x, y), G.point(x, y + 100)).alias("geometry"))
    got = R.transect_minimum(lines, _tiles(s, d), 8.0, 25.0, 6.0, 1.0)
    return got.select("line", F.col("station").cast("bigint").alias("station"), F.round("bed", 5).alias("bed"))


# Sections -------------------------------------------------------------------------------------------------------

_LEN = "(SELECT code AS branch, fid, sum(n) AS length FROM (SELECT code, fid, sqrt((geometry[k].x-geometry[k+1].x)*(geometry[k].x-geometry[k+1].x)+(geometry[k].y-geometry[k+1].y)*(geometry[k].y-geometry[k+1].y)) AS n FROM (SELECT code, fid, geometry, unnest(range(1, len(geometry))) AS k FROM hydroobject)) GROUP BY code, fid)"


def _lengths(s: SparkSession, d: str) -> DataFrame:
    h = read(s, d, "hydroobject")
    n = clean_lines(h.select(F.col("fid").alias("id"), "geometry")).select(F.col("id").alias("fid"), G.length(F.col("c")).alias("length"))
    return h.select("fid", F.col("code").alias("branch")).join(n, "fid")


@query(f"WITH l AS {_LEN} SELECT c.fid, round(c.chainage_fraction * l.length, 4) AS chainage, coalesce(CASE WHEN isnan(c.shift) THEN NULL ELSE c.shift END, 0) AS shift FROM crosssection_location c JOIN (SELECT branch, max(length) AS length FROM l GROUP BY branch) l ON l.branch = upper(trim(c.branch_id)) WHERE c.definition IS NOT NULL")
def section_locations(s: SparkSession, d: str) -> DataFrame:
    loc = read(s, d, "crosssection_location").select(F.upper(F.expr("trim(branch_id)")).alias("branch"), "definition", F.col("chainage_fraction").alias("fraction"), "shift", "fid")
    length = _lengths(s, d).groupBy("branch").agg(F.max("length").alias("length"))
    known = loc.filter("definition is not null").select("definition").distinct()
    at = X.located(loc.withColumn("branch", F.concat_ws("|", "branch", "fid")), loc.join(length, "branch").select(F.concat_ws("|", "branch", "fid").alias("branch"), "length"), known)
    return at.select(F.substring_index("branch", "|", -1).cast("bigint").alias("fid"), F.round("chainage", 4).alias("chainage"), "shift")


@query("""WITH p AS (SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN 'circle' WHEN 1 THEN 'rectangle' ELSE 'trapezium' END AS kind, p_size / 10.0 AS s, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE 1.0 END AS bed, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE 4.0 END AS top FROM part),
q AS (SELECT *, coalesce(top, coalesce(bed, 0) + 2) - coalesce(bed, 0) AS full_ FROM p)
SELECT id, round(CASE kind WHEN 'circle' THEN 0.6 * s WHEN 'rectangle' THEN 0.6 * s * 2 ELSE 0.6 * full_ END, 5) AS flow_depth,
round(CASE kind WHEN 'circle' THEN (s/2)*(s/2)*(2*acos((s/2-0.6*s)/(s/2)) - sin(2*acos((s/2-0.6*s)/(s/2))))/2 WHEN 'rectangle' THEN 0.6*s*2*s ELSE 0.6*full_*(s + s + 2*0.6*full_*1.5)/2 END, 5) AS area FROM q""")
def flow_area(s: SparkSession, d: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size") / 10.0
    p = read(s, d, "part").select(k.alias("id"), F.when(k % 3 == 0, "circle").when(k % 3 == 1, "rectangle").otherwise("trapezium").alias("kind"), size.alias("diameter"), size.alias("width"), (size * 2).alias("height"), size.alias("bottom"), F.lit(1.5).alias("slope"), F.when(k % 4 != 0, 1.0).alias("bed"), F.when(k % 5 != 0, 4.0).alias("top"))
    return X.flow_areas(p, 0.6).select("id", F.round("flow_depth", 5).alias("flow_depth"), F.round("area", 5).alias("area"))


@query("""WITH n AS (SELECT fid AS node, 'C_' || (fid % 500) AS branch, 10.0 + fid % 37 AS floor FROM storagenodes), h AS (SELECT * FROM n WHERE branch <> 'C_7'), f AS (SELECT 'C_' || (node % 333) AS branch, node, floor FROM n WHERE node NOT IN (SELECT node FROM h))
SELECT branch, max(floor) AS shift FROM (SELECT branch, floor FROM h UNION ALL SELECT branch, floor FROM f) GROUP BY branch""")
def pipe_shift_max_floor(s: SparkSession, d: str) -> DataFrame:
    """Greatest floor of the nodes of each branch; nodes of branch C_7, which has no section, count for the branch nearest to them."""
    f = F.col("fid")
    n = read(s, d, "storagenodes").select(F.concat(F.lit("C_"), (f % 500).cast("string")).alias("branch"), f.alias("node"), (10.0 + f % 37).alias("floor"))
    fall = n.select(F.concat(F.lit("C_"), (F.col("node") % 333).cast("string")).alias("branch"), "node", "floor")
    return X.shifts(n.filter("branch <> 'C_7'"), fall)


@query("WITH n AS (SELECT ufid AS node, CASE WHEN isnan(invertelev) THEN NULL ELSE invertelev END AS floor FROM inlets WHERE NOT isnan(invertelev) AND invertelev IS NOT NULL), e AS (SELECT 7000000000 + fid % 5000 AS node, min(downelev) AS low FROM gravity_mains WHERE downelev IS NOT NULL AND NOT isnan(downelev) GROUP BY 1) SELECT node, floor, least(floor, coalesce(low, floor)) AS new_floor FROM n LEFT JOIN e USING (node)")
def floor_lowering(s: SparkSession, d: str) -> DataFrame:
    n = read(s, d, "inlets").select(F.col("ufid").alias("node"), C.finite(F.col("invertelev")).alias("floor")).filter("floor is not null")
    e = read(s, d, "gravity_mains").select((F.lit(7000000000) + F.col("fid") % 5000).alias("node"), F.col("downelev").alias("level"))
    return X.lowered_floors(n, e)


@query("""WITH l AS (SELECT p_partkey AS code, k AS level, round(p_size * (k + 1.0), 2) AS area FROM part, range(0, 6) r(k) WHERE k <= p_partkey % 6)
SELECT code, CASE WHEN count(*) = 1 THEN printf('%.2f %.2f', min(level) + 0.0, min(level) + 1.0) ELSE string_agg(printf('%.2f', level + 0.0), ' ' ORDER BY level) END AS levels, CASE WHEN count(*) = 1 THEN printf('%.2f %.2f', min(area) + 0.0, min(area) + 0.0) ELSE string_agg(printf('%.2f', area + 0.0), ' ' ORDER BY level) END AS areas FROM l GROUP BY code""")
def storage_tables(s: SparkSession, d: str) -> DataFrame:
    p = read(s, d, "part").select(F.col("p_partkey").alias("code"), "p_size", F.explode(F.sequence(F.lit(0), (F.col("p_partkey") % 6).cast("int"))).alias("k"))
    return X.storage_tables(p.select("code", F.col("k").cast("double").alias("level"), F.round(F.col("p_size") * (F.col("k") + 1.0), 2).alias("area")))


@query("WITH k AS (SELECT fid, upper(trim(regexp_replace(globalid, '[{}\\s]', '', 'g'))) AS g, kruinbreedte FROM stuw) SELECT r.fid AS device, CASE lower(trim(overlaatonderlaat)) WHEN 'overlaat' THEN 'weir' ELSE 'orifice' END AS kind, k.fid AS weir, k.kruinbreedte AS crest FROM regelmiddel r JOIN k ON k.g = upper(trim(regexp_replace(stuwid, '[{}\\s]', '', 'g'))) WHERE lower(trim(overlaatonderlaat)) IN ('overlaat', 'onderlaat')")
def structure_table(s: SparkSession, d: str) -> DataFrame:
    key = lambda c: F.upper(F.trim(F.regexp_replace(F.col(c), r"[{}\s]", "")))
    r = read(s, d, "regelmiddel").select("fid", "overlaatonderlaat", key("stuwid").alias("stuwid"))
    return X.structures(r, read(s, d, "stuw").select("fid", key("globalid").alias("globalid"), F.col("kruinbreedte").alias("crest")))


@query("SELECT fid, CASE WHEN code LIKE 'M\\_%' ESCAPE '\\' OR code LIKE 'I\\_%' ESCAPE '\\' OR code LIKE 'RD\\_%' ESCAPE '\\' THEN 0.1 ELSE 2.0 END AS depth FROM storagenodes")
def initial_depths(s: SparkSession, d: str) -> DataFrame:
    return X.initial_depths(read(s, d, "storagenodes").select("fid", F.coalesce("code", F.lit("")).alias("code")), 0.1, 2.0)


@query("""WITH p AS (SELECT fid - fid % 5 AS branch, fid % 5 * 6.0 + k * 10.0 AS at_ FROM gravity_mains, range(0, 3) r(k)), c AS (SELECT fid - fid % 5 AS branch, (fid % 5) * 6.0 AS pos, downelev AS bed FROM gravity_mains WHERE NOT isnan(downelev) AND downelev IS NOT NULL)
SELECT branch, at_ AS at, coalesce(max_by(bed, (pos, bed)) FILTER (pos <= at_), min_by(bed, (pos, bed)) FILTER (pos > at_)) AS bed FROM p LEFT JOIN c USING (branch) GROUP BY branch, at_""")
def pipe_beds_around(s: SparkSession, d: str) -> DataFrame:
    """Three places on every pipe, each a piece of a branch of five."""
    m = read(s, d, "gravity_mains")
    branch, pos = (F.col("fid") - F.col("fid") % 5).alias("branch"), F.col("fid") % 5 * 6.0
    p = m.select(branch, F.explode(F.array(pos, pos + 10.0, pos + 20.0)).alias("at"))
    c = m.select(branch, pos.alias("pos"), C.finite(F.col("downelev")).alias("bed")).filter("bed is not null")
    return X.beds_around(p, c)


# Mesh ---------------------------------------------------------------------------------------------------------------

#: A mesh as wide as it is high, with about as many squares of 5 m as there are pipes; nodes are moved by up to 0.9 m, every third square is two triangles.
_MESH = """g AS (SELECT greatest(CAST(floor(sqrt(count(*))) AS BIGINT), 2) AS m FROM gravity_mains),
nd AS (SELECT k AS node, k % (m + 1) * 5.0 + (k * 7919 % 13 - 6) * 0.15 AS x, k // (m + 1) * 5.0 + (k * 104729 % 11 - 5) * 0.15 AS y FROM g, range(0, (SELECT (m + 1) * (m + 1) FROM g)) r(k)),
sq AS (SELECT k, k // m * (m + 1) + k % m AS a, k // m * (m + 1) + k % m + 1 AS b, (k // m + 1) * (m + 1) + k % m + 1 AS c, (k // m + 1) * (m + 1) + k % m AS d FROM g, range(0, (SELECT m * m FROM g)) r(k)),
cl AS (SELECT 2 * k AS cell, [a, b, c, d] AS nodes FROM sq WHERE k % 3 <> 0 UNION ALL SELECT 2 * k, [a, b, c] FROM sq WHERE k % 3 = 0 UNION ALL SELECT 2 * k + 1, [a, c, d] FROM sq WHERE k % 3 = 0),
si AS (SELECT cell, len(nodes) AS n, j, nodes[j] AS n1, nodes[j % len(nodes) + 1] AS n2 FROM cl, range(1, 5) r(j) WHERE j <= len(nodes)),
sd AS (SELECT cell, n, j, n1, n2, p.x AS x, p.y AS y, q.x - p.x AS ex, q.y - p.y AS ey FROM si JOIN nd p ON p.node = n1 JOIN nd q ON q.node = n2)"""


def _mesh(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    m = max(math.isqrt(read(s, d, "gravity_mains").count()), 2)
    k = F.col("id")
    row = F.floor(k / (m + 1))
    nodes = s.range((m + 1) ** 2).select(k.alias("node"), (k % (m + 1) * 5.0 + (k * 7919 % 13 - 6) * 0.15).alias("x"), (row * 5.0 + (k * 104729 % 11 - 5) * 0.15).alias("y"))
    a = F.floor(k / m) * (m + 1) + k % m
    b, c, e = a + 1, a + m + 2, a + m + 1
    made = lambda *v: F.array(*v).cast("array<bigint>")
    squares = s.range(m * m).select(F.when(k % 3 == 0, F.array(F.struct((2 * k).alias("cell"), made(a, b, c).alias("nodes")), F.struct((2 * k + 1).alias("cell"), made(a, c, e).alias("nodes")))).otherwise(F.array(F.struct((2 * k).alias("cell"), made(a, b, c, e).alias("nodes")))).alias("c"))
    return squares.select(F.inline("c")), nodes


@query(f"WITH {_MESH}, l AS (SELECT least(n1, n2), greatest(n1, n2), count(*) AS cells FROM si GROUP BY ALL) SELECT cells, count(*) AS links FROM l GROUP BY cells")
def edge_multiplicity(s: SparkSession, d: str) -> DataFrame:
    return M.multiplicity(_mesh(s, d)[0])


#: Centres: of triangles by their sides, of others by least squares; then the way from the vertex mean, as far as it stays inside.
_CENTRES = """ce AS (SELECT cell, any_value(n) AS n, avg(x) AS mx, avg(y) AS my, sum(x * (y + ey) - (x + ex) * y) / 2 AS area, sum(ex*ex/(ex*ex+ey*ey)) AS a, sum(ex*ey/(ex*ex+ey*ey)) AS b, sum(ey*ey/(ex*ex+ey*ey)) AS d_,
 sum(ex*(ex*(x+ex/2)+ey*(y+ey/2))/(ex*ex+ey*ey)) AS f, sum(ey*(ex*(x+ex/2)+ey*(y+ey/2))/(ex*ex+ey*ey)) AS g FROM sd GROUP BY cell),
t AS (SELECT cell, max(x) FILTER (j = 1) AS x1, max(y) FILTER (j = 1) AS y1, max(x) FILTER (j = 2) AS x2, max(y) FILTER (j = 2) AS y2, max(x) FILTER (j = 3) AS x3, max(y) FILTER (j = 3) AS y3 FROM sd WHERE n = 3 GROUP BY cell),
tc AS (SELECT cell, ((x1*x1+y1*y1)*(y2-y3)+(x2*x2+y2*y2)*(y3-y1)+(x3*x3+y3*y3)*(y1-y2)) / (2*(x1*(y2-y3)+x2*(y3-y1)+x3*(y1-y2))) AS cx, ((x1*x1+y1*y1)*(x3-x2)+(x2*x2+y2*y2)*(x1-x3)+(x3*x3+y3*y3)*(x2-x1)) / (2*(x1*(y2-y3)+x2*(y3-y1)+x3*(y1-y2))) AS cy FROM t),
r AS (SELECT ce.*, coalesce(tc.cx, (f*d_-g*b)/(a*d_-b*b)) - mx AS rx, coalesce(tc.cy, (a*g-b*f)/(a*d_-b*b)) - my AS ry FROM ce LEFT JOIN tc USING (cell)),
w AS (SELECT cell, min(((x-mx)*ey-(y-my)*ex)/(rx*ey-ry*ex)) AS s FROM sd JOIN r USING (cell) WHERE rx*ey-ry*ex > 1e-9 GROUP BY cell),
z AS (SELECT cell, area, mx + least(1, coalesce(s, 1))*rx AS x, my + least(1, coalesce(s, 1))*ry AS y FROM r LEFT JOIN w USING (cell))"""


@query(f"""WITH {_MESH}, {_CENTRES}, l AS (SELECT least(n1, n2) AS n1, greatest(n1, n2) AS n2, min(cell) AS c1, max(cell) AS c2 FROM si GROUP BY 1, 2 HAVING count(*) = 2)
SELECT l.n1, l.n2, round(abs((b.x-a.x)*(q.x-p.x)+(b.y-a.y)*(q.y-p.y)) / sqrt((b.x-a.x)*(b.x-a.x)+(b.y-a.y)*(b.y-a.y)) / sqrt((q.x-p.x)*(q.x-p.x)+(q.y-p.y)*(q.y-p.y)), 4) AS cos, round(sqrt((q.x-p.x)*(q.x-p.x)+(q.y-p.y)*(q.y-p.y)), 4) AS flow_length
FROM l JOIN z p ON p.cell = c1 JOIN z q ON q.cell = c2 JOIN nd a ON a.node = l.n1 JOIN nd b ON b.node = l.n2""")
def orthogonality(s: SparkSession, d: str) -> DataFrame:
    c, n = _mesh(s, d)
    return M.orthogonality(c, n).select("n1", "n2", F.round("cos", 4).alias("cos"), F.round("flow_length", 4).alias("flow_length"))


@query(f"""WITH {_MESH}, ar AS (SELECT cell, sum(x * (y + ey) - (x + ex) * y) / 2 AS area FROM sd GROUP BY cell),
an AS (SELECT s.cell, min(degrees(acos(greatest(-1, least(1, -(s.ex*p.ex+s.ey*p.ey)/sqrt((s.ex*s.ex+s.ey*s.ey)*(p.ex*p.ex+p.ey*p.ey))))))) AS angle FROM sd s JOIN sd p ON p.cell = s.cell AND s.j = p.j % s.n + 1 GROUP BY s.cell)
SELECT cell, round(area, 5) AS area, round(angle, 4) AS angle FROM ar JOIN an USING (cell)""")
def cell_shapes(s: SparkSession, d: str) -> DataFrame:
    c, n = _mesh(s, d)
    return M.areas(c, n).join(M.least_angles(c, n), "cell").select("cell", F.round("area", 5).alias("area"), F.round("angle", 4).alias("angle"))


@query(f"""WITH {_MESH}, {_CENTRES}, l AS (SELECT least(n1, n2) AS n1, greatest(n1, n2) AS n2, min(cell) AS c1, max(cell) AS c2 FROM si GROUP BY 1, 2 HAVING count(*) = 2),
o AS (SELECT abs((b.x-a.x)*(q.x-p.x)+(b.y-a.y)*(q.y-p.y)) / sqrt((b.x-a.x)*(b.x-a.x)+(b.y-a.y)*(b.y-a.y)) / sqrt((q.x-p.x)*(q.x-p.x)+(q.y-p.y)*(q.y-p.y)) AS cos FROM l JOIN z p ON p.cell = c1 JOIN z q ON q.cell = c2 JOIN nd a ON a.node = l.n1 JOIN nd b ON b.node = l.n2)
SELECT round(quantile_cont(cos, 0.01), 4) AS p1, round(quantile_cont(cos, 0.05), 4) AS p5, round(quantile_cont(cos, 0.5), 4) AS p50, round(quantile_cont(cos, 0.95), 4) AS p95, round(quantile_cont(cos, 0.99), 4) AS p99, round(avg(cos), 4) AS mean, round(max(cos), 4) AS greatest FROM o""")
def mesh_quality(s: SparkSession, d: str) -> DataFrame:
    q = M.quality(M.orthogonality(*_mesh(s, d)), "cos")
    return q.select(*[F.round(c, 4).alias(c) for c in q.columns])


# Forcing ------------------------------------------------------------------------------------------------------------


@query("""WITH e AS (SELECT s_suppkey AS scenario, 10.0 + s_suppkey % 40 AS mm_h, 1.0 + s_suppkey % 3 AS du, s_suppkey % 2 * 0.5 AS st FROM supplier),
r AS (SELECT scenario, 0 AS o, 0.0 AS minute, 0.0 AS mm_day FROM e WHERE st > 0 UNION ALL SELECT scenario, 1, st * 60, mm_h * 24 FROM e UNION ALL SELECT scenario, 2, (st + du) * 60, mm_h * 24 FROM e UNION ALL SELECT scenario, 3, (st + du) * 60, 0 FROM e UNION ALL SELECT scenario, 4, 360, 0 FROM e)
SELECT scenario, CAST(row_number() OVER (PARTITION BY scenario ORDER BY o) - 1 AS INTEGER) AS k, CAST(minute AS DOUBLE) AS minute, CAST(mm_day AS DOUBLE) AS mm_day FROM r""")
def rain_block(s: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    e = read(s, d, "supplier").select(k.alias("scenario"), (10.0 + k % 40).alias("mm_h"), (1.0 + k % 3).alias("duration_h"), (k % 2 * 0.5).alias("start_h"))
    return T.rain_blocks(e, 360.0)


@query("SELECT time, round(sum(v * area), 3) AS volume, count(v) AS wet FROM (SELECT date_trunc('day', ts) AS time, CASE WHEN event_id % 6 = 0 THEN NULL ELSE value END AS v, 1.0 + user_id % 9 AS area FROM events) GROUP BY time HAVING count(v) > 0")
def volume_series(s: SparkSession, d: str) -> DataFrame:
    e = read(s, d, "events")
    steps = e.select(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("time"), F.col("user_id").alias("face"), F.when(F.col("event_id") % 6 != 0, F.col("value")).alias("depth"))
    faces = e.select(F.col("user_id").alias("face")).distinct().withColumn("area", 1.0 + F.col("face") % 9)
    return T.volumes(steps, faces).select("time", F.round("volume", 3).alias("volume"), "wet")


@query("WITH t AS (SELECT date_trunc('day', ts) AS time, event_type, sum(value) AS v FROM events GROUP BY ALL), a AS (SELECT time, v FROM t WHERE event_type = (SELECT min(event_type) FROM events)), b AS (SELECT time, v FROM t WHERE event_type = (SELECT max(event_type) FROM events)) SELECT time, round(a.v, 3) AS off, round(b.v, 3) AS on, round(a.v - b.v, 3) AS delta FROM a JOIN b USING (time)".replace(" AS on,", ' AS "on",'))
def scenario_difference(s: SparkSession, d: str) -> DataFrame:
    e = read(s, d, "events")
    t = e.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("time"), "event_type").agg(F.sum("value").alias("v"))
    edge = e.agg(F.min("event_type").alias("lo"), F.max("event_type").alias("hi"))
    run = lambda c: t.join(F.broadcast(edge.select(F.col(c).alias("event_type"))), "event_type").select("time", "v")
    return T.differences(run("lo"), run("hi"), ["time"], "v").select("time", *[F.round(c, 3).alias(c) for c in ("off", "on", "delta")])


@query("SELECT user_id AS station, date_trunc('hour', ts) AS \"begin\", round(sum(value), 4) AS total, count(*) AS readings FROM events GROUP BY ALL")
def gauge_totals(s: SparkSession, d: str) -> DataFrame:
    e = read(s, d, "events").select(F.col("user_id").alias("station"), "ts", "value")
    return T.gauge_totals(e).select("station", F.col("begin").cast("timestamp_ntz").alias("begin"), F.round("total", 4).alias("total"), "readings")


@query("SELECT s_suppkey AS scenario, CAST(m AS INTEGER) AS minute, round(greatest(0, (5.0 + s_suppkey % 20) * (1 - abs(m - 60) / 60)), 5) AS mm_h FROM supplier, range(0, 121, 10) r(m)")
def rain_triangle(s: SparkSession, d: str) -> DataFrame:
    e = read(s, d, "supplier").select(F.col("s_suppkey").alias("scenario"), (5.0 + F.col("s_suppkey") % 20).alias("peak"), F.lit(120.0).alias("duration"))
    return T.hyetographs(e, 10).withColumn("mm_h", F.round("mm_h", 5))


@query(f"WITH l AS {_LEN} SELECT fid, round(length, 4) AS length, round(coalesce(CASE WHEN isnan(lengte) THEN NULL ELSE lengte END, length), 4) AS lengte FROM hydroobject h JOIN (SELECT fid, length FROM l) l USING (fid)")
def branch_lengths(s: SparkSession, d: str) -> DataFrame:
    n = _lengths(s, d).select("fid", "length").filter("length is not null")
    h = read(s, d, "hydroobject").filter(F.size("geometry") > 1).select("fid", "lengte").join(n, "fid")
    return h.select("fid", F.round("length", 4).alias("length"), F.round(F.coalesce(C.finite(F.col("lengte")), "length"), 4).alias("lengte"))


@query("""WITH c AS (SELECT n_nationkey AS id, n_nationkey % 5 * 30.0 AS x0, n_nationkey // 5 * 30.0 AS y0 FROM nation) SELECT id, round(greatest(0, least(x0 + 24, 77) - greatest(x0, 11)) * greatest(0, least(y0 + 18, 70) - greatest(y0, 5)), 4) AS area FROM c""")
def window_clip(s: SparkSession, d: str) -> DataFrame:
    """Area of rectangles inside a window."""
    k = F.col("n_nationkey")
    x, y = k % 5 * 30.0, F.floor(k / 5) * 30.0
    ring = F.array(*[G.point(x + dx, y + dy) for dx, dy in ((0.0, 0.0), (24.0, 0.0), (24.0, 18.0), (0.0, 18.0))])
    c = read(s, d, "nation").select(k.cast("bigint").alias("id"), ring.alias("r")).withColumn("c", G.clipped_ring(F.col("r"), 11.0, 5.0, 77.0, 70.0))
    return c.select("id", F.round(F.when(F.size("c") > 2, F.abs(G.ring_area(F.col("c")))).otherwise(0.0), 4).alias("area"))


@query("SELECT fid, CASE WHEN d <= 50 THEN 5.0 WHEN d <= 200 THEN 15.0 ELSE 40.0 END AS size FROM (SELECT fid, CAST(fid % 331 AS DOUBLE) AS d FROM discharge_points)")
def target_sizes(s: SparkSession, d: str) -> DataFrame:
    c = read(s, d, "discharge_points").select("fid", (F.col("fid") % 331).cast("double").alias("distance"))
    return M.zones(c, [(200.0, 15.0), (50.0, 5.0)], 40.0).select("fid", "size")


@query("SELECT fid, CASE WHEN split_part(code, '_', 1) IN ('C') THEN 5 ELSE 3 END AS contact FROM hydroobject WHERE code IS NOT NULL")
def contact_types(s: SparkSession, d: str) -> DataFrame:
    h = read(s, d, "hydroobject").filter("code is not null").select("fid", F.col("code").alias("branch"))
    return M.contact_types(h, ["C"]).select("fid", "contact")
