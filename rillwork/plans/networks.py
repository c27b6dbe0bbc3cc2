"""Queries of the network operators, with the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import graph as A
from ..operators import network as N
from ..operators import outfalls as O
from ..operators.near import SortedPoints, points_within, regions_containing, spots
from ..operators.ordered import range_sorted, running_sums
from ..session import read, settled

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _lines(s: SparkSession, d: str, name: str) -> DataFrame:
    return read(s, d, name).select(F.col("fid").alias("id"), "geometry")


def _points(s: SparkSession, d: str, name: str) -> DataFrame:
    return read(s, d, name).select(F.col("fid").alias("id"), F.col("geometry.x").alias("x"), F.col("geometry.y").alias("y"))


_PTS = "(SELECT fid AS id, geometry.x AS x, geometry.y AS y FROM {} WHERE geometry.x IS NOT NULL AND geometry.y IS NOT NULL AND NOT isnan(geometry.x) AND NOT isnan(geometry.y))"
_ENDS = "(SELECT fid AS id, 'start' AS side, geometry[1].x AS x, geometry[1].y AS y FROM {0} WHERE len(geometry) > 0 UNION ALL SELECT fid, 'end', geometry[-1].x, geometry[-1].y FROM {0} WHERE len(geometry) > 0)"
_SEGS = "(SELECT fid AS id, k, geometry[k].x AS ax, geometry[k].y AS ay, geometry[k+1].x AS bx, geometry[k+1].y AS by_ FROM (SELECT fid, geometry, unnest(range(1, len(geometry))) AS k FROM {}))"
#: Segments with the length before them, and candidates near points with offset and chainage.
_HITS = """s0 AS (SELECT *, sqrt((ax-bx)*(ax-bx)+(ay-by_)*(ay-by_)) AS n FROM {segs} q),
s AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS d0, sum(n) OVER (PARTITION BY id) AS len FROM s0),
h0 AS (SELECT s.id AS line, p.id AS pt, p.x, p.y, ax, ay, bx, by_, n, d0, len, CASE WHEN n = 0 THEN 0.0 ELSE greatest(0.0, least(1.0, ((p.x-ax)*(bx-ax)+(p.y-ay)*(by_-ay)) / (n*n))) END AS t FROM s JOIN {pts} p ON p.x BETWEEN least(ax,bx)-{tol} AND greatest(ax,bx)+{tol} AND p.y BETWEEN least(ay,by_)-{tol} AND greatest(ay,by_)+{tol}),
h1 AS (SELECT *, sqrt((x-(ax+t*(bx-ax)))*(x-(ax+t*(bx-ax)))+(y-(ay+t*(by_-ay)))*(y-(ay+t*(by_-ay)))) AS off, d0 + t*n AS at_ FROM h0),
h AS (SELECT line, pt, min(off) AS off, min_by(at_, (off, at_)) AS at_, any_value(len) AS len, min_by(ax+t*(bx-ax), (off, at_)) AS fx, min_by(ay+t*(by_-ay), (off, at_)) AS fy FROM h1 WHERE off <= {tol} GROUP BY line, pt)"""


def _hits(layer: str, pts: str, tol: float) -> str:
    return _HITS.format(segs=_SEGS.format(layer), pts=pts, tol=tol)


# Tolerance and nearest joins -----------------------------------------------------------------------------


_SPOTS = f"""e AS (SELECT *, id * 2 + CASE side WHEN 'start' THEN 0 ELSE 1 END AS pt FROM {_ENDS.format('gravity_mains')}), sp AS (SELECT x, y, min(pt) AS pt FROM e GROUP BY x, y)"""


@query(f"""WITH {_SPOTS} SELECT a.pt AS id1, b.pt AS id2, round(sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)), 4) AS distance FROM sp a JOIN sp b ON a.pt < b.pt AND a.x BETWEEN b.x - 0.5 AND b.x + 0.5 AND a.y BETWEEN b.y - 0.5 AND b.y + 0.5 AND sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)) <= 0.5""")
def endpoint_tolerance_pairs(s: SparkSession, d: str) -> DataFrame:
    """Near pairs of different places where pipes end, each named after its least end."""
    at, _ = spots(N._ends_as_points(A.line_ends(_lines(s, d, "gravity_mains"))))
    at = settled(at)
    return points_within(at, SortedPoints(at), 0.5, same=True).withColumn("distance", F.round("distance", 4))


@query(f"WITH {_SPOTS} SELECT e.pt AS id, sp.pt AS spot FROM e JOIN sp USING (x, y)")
def endpoint_places(s: SparkSession, d: str) -> DataFrame:
    """Every pipe end with the place it stands at: what endpoint_tolerance_pairs leaves unexpanded."""
    return spots(N._ends_as_points(A.line_ends(_lines(s, d, "gravity_mains"))))[1]


@query(f"""SELECT o.id AS id1, min_by(n.id, (sqrt((o.x-n.x)*(o.x-n.x)+(o.y-n.y)*(o.y-n.y)), n.id)) AS id2, round(min(sqrt((o.x-n.x)*(o.x-n.x)+(o.y-n.y)*(o.y-n.y))), 4) AS distance FROM {_PTS.format('discharge_points')} o JOIN {_PTS.format('storagenodes')} n
ON n.x BETWEEN o.x - 12 AND o.x + 12 AND n.y BETWEEN o.y - 12 AND o.y + 12 AND sqrt((o.x-n.x)*(o.x-n.x)+(o.y-n.y)*(o.y-n.y)) < 12 GROUP BY o.id""")
def nearest_bounded(s: SparkSession, d: str) -> DataFrame:
    return N.nearest_points(_points(s, d, "discharge_points"), _points(s, d, "storagenodes"), 12.0).withColumn("distance", F.round("distance", 4))


@query(f"SELECT o.id AS id1, min_by(n.id, (sqrt((o.x-n.x)*(o.x-n.x)+(o.y-n.y)*(o.y-n.y)), n.id)) AS id2, round(min(sqrt((o.x-n.x)*(o.x-n.x)+(o.y-n.y)*(o.y-n.y))), 4) AS distance FROM {_PTS.format('discharge_points')} o CROSS JOIN {_PTS.format('storagenodes')} n GROUP BY o.id")
def nearest_unbounded(s: SparkSession, d: str) -> DataFrame:
    return N.nearest_unbounded(_points(s, d, "discharge_points"), _points(s, d, "storagenodes"), 16.0).withColumn("distance", F.round("distance", 4))


@query(f"WITH {_hits('hydroobject', _PTS.format('storagenodes'), 3.0)} SELECT line, pt, round(off, 4) AS off, round(at_, 3) AS at FROM h")
def point_on_line(s: SparkSession, d: str) -> DataFrame:
    return N.points_on_lines(_points(s, d, "storagenodes"), _lines(s, d, "hydroobject"), 3.0).select("line", "pt", F.round("off", 4).alias("off"), F.round("at", 3).alias("at"))


@query(f"""WITH {_hits('hydroobject', _PTS.format('discharge_points'), 25.0)}, near AS (SELECT pt, min_by(line, (round(off, 9), line)) AS line, min(off) AS off FROM h GROUP BY pt)
SELECT p.id AS pt, near.line, CASE WHEN off <= 5 THEN 'on line' WHEN off IS NOT NULL THEN 'near line' ELSE 'none' END AS how FROM {_PTS.format('discharge_points')} p LEFT JOIN near ON near.pt = p.id""")
def nearest_with_fallback(s: SparkSession, d: str) -> DataFrame:
    pts, lines = _points(s, d, "discharge_points"), _lines(s, d, "hydroobject")
    first = settled(N.nearest_lines(pts, lines, 5.0).withColumn("how", F.lit("on line")))
    usable = settled(pts.filter("x is not null and y is not null and not isnan(x) and not isnan(y)"))
    rest = usable.join(first.select(F.col("pt").alias("id")), "id", "left_anti")
    second = N.nearest_lines(rest, lines, 25.0).withColumn("how", F.lit("near line"))
    both = first.unionByName(second)
    return usable.join(both, F.col("id") == F.col("pt"), "left").select(F.col("id").alias("pt"), "line", F.coalesce("how", F.lit("none")).alias("how"))


@query("""WITH w AS (SELECT fid, unnest(range(1, len(ring)+1)) AS k, ring FROM (SELECT fid, unnest(geometry) AS ring FROM watersheds)),
e AS (SELECT fid, ring[k].x AS ax, ring[k].y AS ay, ring[k % len(ring) + 1].x AS bx, ring[k % len(ring) + 1].y AS by_ FROM w),
c AS (SELECT e.fid AS region, o.id FROM e JOIN """ + _PTS.format("storagenodes") + """ o ON (ay > o.y) <> (by_ > o.y) AND o.x < (bx-ax)*(o.y-ay)/(by_-ay)+ax GROUP BY e.fid, o.id HAVING count(*) % 2 = 1)
SELECT s.fid AS id, min(region) AS region FROM storagenodes s LEFT JOIN c ON c.id = s.fid GROUP BY s.fid""")
def roi_first_wins(s: SparkSession, d: str) -> DataFrame:
    from ..operators.cleaning import first_region

    pts = _points(s, d, "storagenodes")
    inside = regions_containing(read(s, d, "watersheds").select(F.col("fid").alias("id"), "geometry"), SortedPoints(pts)).select(F.col("id1").alias("region"), F.col("id2").alias("id"))
    return first_region(pts.select("id"), inside)


_TURN = "sign(({q}x-{p}x)*({r}y-{p}y)-({q}y-{p}y)*({r}x-{p}x))"


_MEETING = f"""WITH s AS (SELECT id, ax, ay, bx, by_ AS by FROM {_SEGS.format('hydroobject')} q)
SELECT DISTINCT a.id AS a, b.id AS b FROM s a JOIN s b ON a.id < b.id AND least(a.ax,a.bx) <= greatest(b.ax,b.bx) AND least(b.ax,b.bx) <= greatest(a.ax,a.bx) AND least(a.ay,a.by) <= greatest(b.ay,b.by) AND least(b.ay,b.by) <= greatest(a.ay,a.by)
WHERE sign((a.bx-a.ax)*(b.ay-a.ay)-(a.by-a.ay)*(b.ax-a.ax)) * sign((a.bx-a.ax)*(b.by-a.ay)-(a.by-a.ay)*(b.bx-a.ax)) <= 0 AND sign((b.bx-b.ax)*(a.ay-b.ay)-(b.by-b.ay)*(a.ax-b.ax)) * sign((b.bx-b.ax)*(a.by-b.ay)-(b.by-b.ay)*(a.bx-b.ax)) <= 0
AND NOT (a.ax = a.bx AND a.ay = a.by) AND NOT (b.ax = b.bx AND b.ay = b.by)"""


@query(_MEETING)
def segment_crossings(s: SparkSession, d: str) -> DataFrame:
    """All pairs of branches that meet."""
    h = _lines(s, d, "hydroobject")
    return N.crossing_segments(h, h).filter("a < b")


@query(f"""WITH mt AS ({_MEETING}) SELECT fid AS id FROM hydroobject WHERE len(geometry) > 0 AND fid NOT IN (SELECT a FROM mt) AND fid NOT IN (SELECT b FROM mt)""")
def isolated_branches(s: SparkSession, d: str) -> DataFrame:
    """Branches that meet no other branch."""
    return N.isolated(_lines(s, d, "hydroobject"))


# Nodes, degrees, components ---------------------------------------------------------------------------------

_MAIN_EDGES = "(SELECT fid AS id, printf('%.6f %.6f', geometry[1].x, geometry[1].y) AS u, printf('%.6f %.6f', geometry[-1].x, geometry[-1].y) AS v FROM {} WHERE len(geometry) > 0)"


@query(f"""WITH e AS {_MAIN_EDGES.format('gravity_mains')}, dg AS (SELECT n, count(*) AS k FROM (SELECT u AS n FROM e UNION ALL SELECT v FROM e) GROUP BY n)
SELECT id, 'start' AS "end" FROM e JOIN dg ON n = u AND k = 1 UNION ALL SELECT id, 'end' FROM e JOIN dg ON n = v AND k = 1""")
def dangling_ends(s: SparkSession, d: str) -> DataFrame:
    return A.dangling_ends(settled(A.network(_lines(s, d, "gravity_mains"), 0.0001))).select("id", "end")


@query(f"SELECT p.id FROM {_PTS.format('storagenodes')} p LEFT JOIN (SELECT DISTINCT round_even(x / 0.5, 0) AS gx, round_even(y / 0.5, 0) AS gy FROM {_ENDS.format('hydroobject')}) e ON e.gx = round_even(p.x / 0.5, 0) AND e.gy = round_even(p.y / 0.5, 0) WHERE e.gx IS NULL")
def isolated_nodes(s: SparkSession, d: str) -> DataFrame:
    from ..functions.columns import snapped

    pts = _points(s, d, "storagenodes").filter("x is not null and y is not null and not isnan(x) and not isnan(y)")
    key = lambda df: df.withColumns({"gx": snapped(F.col("x"), 0.5), "gy": snapped(F.col("y"), 0.5)})
    return key(pts).join(key(A.line_ends(_lines(s, d, "hydroobject"))).select("gx", "gy").distinct(), ["gx", "gy"], "left_anti").select("id")


@query(f"""WITH e AS (SELECT id, round_even(x / 0.01, 0) AS gx, round_even(y / 0.01, 0) AS gy FROM {_ENDS.format('hydroobject')}), g AS (SELECT gx, gy, count(DISTINCT id) AS n FROM e GROUP BY ALL)
SELECT id FROM e JOIN g USING (gx, gy) GROUP BY id HAVING max(n) = 1""")
def standalone_branches(s: SparkSession, d: str) -> DataFrame:
    return N.standalone(_lines(s, d, "hydroobject"), 0.01)


@query(f"""WITH e AS {_ENDS.format('hydroobject')}, h AS (SELECT DISTINCT e.id, side FROM e JOIN {_PTS.format('storagenodes')} p ON p.x BETWEEN e.x - 6 AND e.x + 6 AND p.y BETWEEN e.y - 6 AND e.y + 6 AND sqrt((p.x-e.x)*(p.x-e.x)+(p.y-e.y)*(p.y-e.y)) <= 6)
SELECT id, true AS at_start, true AS at_end FROM h GROUP BY id HAVING count(*) = 2""")
def endpoint_hits_both(s: SparkSession, d: str) -> DataFrame:
    return N.end_hits(_lines(s, d, "hydroobject"), _points(s, d, "storagenodes"), 6.0, "both")


@query(f"""WITH RECURSIVE e AS {_MAIN_EDGES.format('gravity_mains')}, n AS (SELECT u AS k, min(id) AS c FROM (SELECT u, id FROM e UNION ALL SELECT v, id FROM e) GROUP BY u), b AS (SELECT u AS x, v AS y FROM e WHERE u <> v UNION SELECT v, u FROM e WHERE u <> v),
cc(k, c) USING KEY (k) AS (SELECT k, c FROM n UNION SELECT b.y, min(cc.c) FROM cc JOIN b ON b.x = cc.k JOIN recurring.cc r ON r.k = b.y WHERE cc.c < r.c GROUP BY b.y)
SELECT lines, count(*) AS components FROM (SELECT c, count(*) AS lines FROM e JOIN cc ON cc.k = e.u GROUP BY c) GROUP BY lines""")
def component_sizes(s: SparkSession, d: str) -> DataFrame:
    """How many components have how many lines."""
    e = settled(A.network(_lines(s, d, "gravity_mains"), 0.0001))
    comp = A.components(e.select("u", "v"))
    return e.join(comp, e["u"] == comp["node"]).groupBy("component").agg(F.count(F.lit(1)).alias("lines")).groupBy("lines").agg(F.count(F.lit(1)).alias("components"))


@query(f"WITH dg AS (SELECT n, count(*) AS k FROM (SELECT u AS n FROM {_MAIN_EDGES.format('gravity_mains')} UNION ALL SELECT v FROM {_MAIN_EDGES.format('gravity_mains')}) GROUP BY n) SELECT k AS degree, count(*) AS nodes FROM dg GROUP BY k")
def node_degrees(s: SparkSession, d: str) -> DataFrame:
    return A.degrees(settled(A.network(_lines(s, d, "gravity_mains"), 0.0001))).groupBy("degree").agg(F.count(F.lit(1)).alias("nodes"))


# Trees: orders as branches of a ternary tree ------------------------------------------------------------------

_TREE = "t AS (SELECT o_orderkey AS id, (o_orderkey - 1) // 3 AS up, CASE WHEN o_orderstatus = 'F' THEN 'open_drains' ELSE 'gravity_mains' END AS layer, CAST(round(o_totalprice) AS BIGINT) AS len FROM orders)"
_BFS = "b(id, hop, up) AS (SELECT id, 0, CAST(NULL AS BIGINT) FROM t WHERE id = 0 UNION ALL SELECT t.id, b.hop + 1, b.id FROM b JOIN t ON t.up = b.id AND t.id > 0{})"


def _tree_edges(s: SparkSession, d: str) -> DataFrame:
    """id, u, v, layer, length: branch k runs from the head of its parent to its own."""
    k = F.col("o_orderkey")
    up = F.when(k > 0, F.floor((k - 1) / 3)).otherwise(F.lit(-1)).cast("bigint")
    layer = F.when(F.col("o_orderstatus") == "F", "open_drains").otherwise("gravity_mains")
    return read(s, d, "orders").select(k.alias("id"), up.alias("u"), k.alias("v"), layer.alias("layer"), F.round("o_totalprice").cast("bigint").alias("length"))


def _root(s: SparkSession) -> DataFrame:
    return s.createDataFrame([(0,)], "id bigint")


def _tree(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = settled(_tree_edges(s, d))
    return e, settled(A.bfs(e, _root(s)).join(e.select("id", "layer", "length"), "id"))


@query(f"WITH RECURSIVE {_TREE}, {_BFS.format('')} SELECT hop, count(*) AS branches, CAST(sum(len) AS BIGINT) AS length FROM b JOIN t USING (id) GROUP BY hop")
def bfs_hops(s: SparkSession, d: str) -> DataFrame:
    _, t = _tree(s, d)
    return t.groupBy("hop").agg(F.count(F.lit(1)).alias("branches"), F.sum("length").alias("length"))


@query(f"""WITH RECURSIVE {_TREE}, {_BFS.format(' AND b.id % 97 <> 5')} SELECT count(*) AS reached, (SELECT count(*) FROM t) - count(*) AS lost, count(*) FILTER (id % 97 = 5) AS cut FROM b""")
def bfs_with_cuts(s: SparkSession, d: str) -> DataFrame:
    e = settled(_tree_edges(s, d))
    stops = e.filter("id % 97 = 5").select("id")
    got = settled(A.bfs(e, _root(s), stops))
    lost = e.join(got.select("id"), "id", "left_anti")
    return got.agg(F.count(F.lit(1)).alias("reached"), F.count_if(F.col("id") % 97 == 5).alias("cut")).join(F.broadcast(lost.agg(F.count(F.lit(1)).alias("lost")))).select("reached", "lost", "cut")


_ACC = "a(id, up, total) AS (SELECT id, up, len FROM t UNION ALL SELECT (a.up), CASE WHEN a.up > 0 THEN (a.up - 1) // 3 END, a.total FROM a WHERE a.up IS NOT NULL), s AS (SELECT id, CAST(sum(total) AS BIGINT) AS total FROM a GROUP BY id)"
_TREE0 = _TREE.replace("(o_orderkey - 1) // 3 AS up", "CASE WHEN o_orderkey > 0 THEN (o_orderkey - 1) // 3 END AS up")


@query(f"WITH RECURSIVE {_TREE0}, {_ACC} SELECT id, total FROM s")
def upstream_length(s: SparkSession, d: str) -> DataFrame:
    _, t = _tree(s, d)
    return A.accumulated(t.select("id", "parent", "length"), "length")


_LEVELS = f"""{_TREE0}, {_ACC}, k AS (SELECT t.id, t.up, row_number() OVER (PARTITION BY t.up ORDER BY CASE WHEN t.layer = p.layer THEN 0 ELSE 1 END, s.total DESC, t.id) AS k FROM t JOIN s USING (id) LEFT JOIN t p ON p.id = t.up WHERE t.up IS NOT NULL),
l(id, level) AS (SELECT id, 0 FROM t WHERE id = 0 UNION ALL SELECT k.id, l.level + CASE WHEN k.k = 1 THEN 0 ELSE 1 END FROM l JOIN k ON k.up = l.id)"""


@query(f"WITH RECURSIVE {_LEVELS} SELECT id, level FROM l")
def branch_levels(s: SparkSession, d: str) -> DataFrame:
    _, t = _tree(s, d)
    return A.levels(t.select("id", "parent", "layer"), settled(A.accumulated(t.select("id", "parent", "length"), "length")))


@query(f"""WITH RECURSIVE {_LEVELS}, r AS (SELECT l.id, row_number() OVER (ORDER BY s.total DESC, l.id) AS rk FROM l JOIN t USING (id) JOIN l p ON p.id = t.up JOIN s ON s.id = l.id WHERE l.level = 1 AND p.level = 0),
q(id, trib) AS (SELECT id, 0 FROM l WHERE level = 0 UNION ALL SELECT id, CAST(rk AS INTEGER) FROM r UNION ALL SELECT t.id, q.trib FROM q JOIN t ON t.up = q.id JOIN l ON l.id = t.id WHERE q.trib > 0)
SELECT trib AS tributary, count(*) AS branches, CAST(sum(t.len) AS BIGINT) AS length FROM q JOIN t USING (id) GROUP BY trib""")
def tributary_rank(s: SparkSession, d: str) -> DataFrame:
    _, t = _tree(s, d)
    up = settled(A.accumulated(t.select("id", "parent", "length"), "length"))
    lev = settled(A.levels(t.select("id", "parent", "layer"), up))
    trib = A.tributaries(t.select("id", "parent"), lev, up)
    return t.select("id", "length").join(trib, "id").groupBy("tributary").agg(F.count(F.lit(1)).alias("branches"), F.sum("length").alias("length"))


@query()
def dfs_order(s: SparkSession, d: str) -> DataFrame:
    """Discovery order within the component of each facility's first pipe."""
    e = settled(A.network(_lines(s, d, "gravity_mains"), 0.0001))
    first = read(s, d, "gravity_mains").groupBy("facilityid").agg(F.min("fid").alias("id")).select("id")
    return A.dfs_order(e, first)


def _chorded(s: SparkSession, d: str) -> tuple[DataFrame, int]:
    """The tree with the chords of all order lines, with capacities; and its last branch."""
    e = _tree_edges(s, d)
    n = e.agg(F.max("v")).first()[0]
    # parallel chords are one, as strong as all of them; ids of chords are negative
    chords = read(s, d, "lineitem").select(F.col("l_orderkey").alias("u"), F.least(F.col("l_partkey"), F.lit(n)).alias("v")).filter("u < v").groupBy("u", "v").agg(F.count(F.lit(1)).alias("capacity")).withColumn("id", -(F.col("u") * (n + 1) + F.col("v")) - 1)
    cap = F.when(F.col("layer") == "open_drains", 1000).otherwise(1)
    return settled(e.select("id", "u", "v", cap.alias("capacity")).unionByName(chords.select("id", "u", "v", "capacity"))), n


@query()
def min_cut(s: SparkSession, d: str) -> DataFrame:
    """The cheapest cut between the root and the last branch of the tree with chords, and its cost."""
    edges, n = _chorded(s, d)
    return A.min_cut(edges, s.createDataFrame([(0,)], "node bigint"), n)


@query("SELECT true AS adds_up, true AS separates")
def min_cut_holds(s: SparkSession, d: str) -> DataFrame:
    """Whether the cut costs what its lines are worth, which the flow through them shows to be least, and whether it separates."""
    edges, n = _chorded(s, d)
    cut = settled(A.min_cut(edges, s.createDataFrame([(0,)], "node bigint"), n))
    worth = cut.join(edges, "id").agg((F.sum("capacity") == F.max("cost")).alias("adds_up"))
    comp = A.components(edges.join(cut.select("id"), "id", "left_anti").select("u", "v"))
    apart = comp.filter(F.col("node").isin(0, n)).agg((F.countDistinct("component") == F.count(F.lit(1))).alias("separates"))
    # one row each
    return worth.join(F.broadcast(apart))


# Junctions and edits -----------------------------------------------------------------------------------------

_END_PTS = "(SELECT id * 2 + CASE side WHEN 'start' THEN 0 ELSE 1 END AS id, x, y FROM " + _ENDS.format("hydroobject") + ")"


@query(f"WITH {_hits('hydroobject', _END_PTS, 2.0)} SELECT pt // 2 AS branch, CASE WHEN pt % 2 = 0 THEN 'start' ELSE 'end' END AS \"end\", line AS host, round(at_, 3) AS at, round(off, 3) AS off FROM h WHERE pt // 2 <> line AND at_ > 2 AND at_ < len - 2")
def t_junctions(s: SparkSession, d: str) -> DataFrame:
    return N.t_junctions(_lines(s, d, "hydroobject"), 2.0).select("branch", "end", "host", F.round("at", 3).alias("at"), F.round("off", 3).alias("off"))


@query(f"""WITH {_hits('hydroobject', _END_PTS, 3.0)}, e AS {_END_PTS},
met AS (SELECT DISTINCT a.id FROM e a JOIN e b ON a.id <> b.id AND b.x BETWEEN a.x - 0.01 AND a.x + 0.01 AND b.y BETWEEN a.y - 0.01 AND a.y + 0.01 AND sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)) <= 0.01),
ex AS (SELECT pt FROM h WHERE off <= 0.01 AND pt // 2 <> line AND at_ > 0.01 AND at_ < len - 0.01),
ok AS (SELECT h.* FROM h JOIN e p ON p.id = pt JOIN e s0 ON s0.id = line * 2 JOIN e s1 ON s1.id = line * 2 + 1 WHERE pt // 2 <> line AND off > 0.01 AND least(sqrt((p.x-s0.x)*(p.x-s0.x)+(p.y-s0.y)*(p.y-s0.y)), sqrt((p.x-s1.x)*(p.x-s1.x)+(p.y-s1.y)*(p.y-s1.y))) > 3
 AND pt NOT IN (SELECT id FROM met) AND pt NOT IN (SELECT pt FROM ex)),
b AS (SELECT * FROM ok QUALIFY row_number() OVER (PARTITION BY pt ORDER BY off, line) = 1),
th AS (SELECT DISTINCT b.pt FROM b JOIN s ON s.id <> b.line AND s.id <> b.pt // 2 AND fx BETWEEN least(ax,bx)-0.01 AND greatest(ax,bx)+0.01 AND fy BETWEEN least(ay,by_)-0.01 AND greatest(ay,by_)+0.01
 WHERE sqrt(pow(fx-ax-(CASE WHEN n = 0 THEN 0.0 ELSE greatest(0.0, least(1.0, ((fx-ax)*(bx-ax)+(fy-ay)*(by_-ay)) / (n*n))) END)*(bx-ax), 2) + pow(fy-ay-(CASE WHEN n = 0 THEN 0.0 ELSE greatest(0.0, least(1.0, ((fx-ax)*(bx-ax)+(fy-ay)*(by_-ay)) / (n*n))) END)*(by_-ay), 2)) <= 0.01)
SELECT pt // 2 AS branch, CASE WHEN pt % 2 = 0 THEN 'start' ELSE 'end' END AS "end", line AS host, round(at_, 3) AS at, round(off, 3) AS off, round(fx, 3) AS x, round(fy, 3) AS y FROM b WHERE pt NOT IN (SELECT pt FROM th)""")
def near_t_junctions(s: SparkSession, d: str) -> DataFrame:
    return N.near_t_junctions(_lines(s, d, "hydroobject"), 0.01, 3.0).select("branch", "end", "host", *[F.round(c, 3).alias(c) for c in ("at", "off", "x", "y")])


@query(f"""WITH {_hits('hydroobject', _END_PTS, 2.0)}, j AS (SELECT line AS host, pt // 2 AS branch, CASE WHEN pt % 2 = 0 THEN 'start' ELSE 'end' END AS side, at_ FROM h WHERE pt // 2 <> line AND at_ > 2 AND at_ < len - 2),
k AS (SELECT *, CASE WHEN at_ - lag(at_) OVER (PARTITION BY host ORDER BY at_, branch, side) <= 5 THEN 0 ELSE 1 END AS new FROM j)
SELECT host, branch, side AS "end", CAST(sum(new) OVER (PARTITION BY host ORDER BY at_, branch, side) AS BIGINT) AS junction FROM k""")
def junction_clusters(s: SparkSession, d: str) -> DataFrame:
    return N.junction_nodes(N.t_junctions(_lines(s, d, "hydroobject"), 2.0), 5.0).select("host", "branch", "end", "junction")


@query("""WITH s AS (SELECT fid, k, geometry, sqrt((geometry[k].x-geometry[k+1].x)*(geometry[k].x-geometry[k+1].x)+(geometry[k].y-geometry[k+1].y)*(geometry[k].y-geometry[k+1].y)) AS n FROM (SELECT fid, geometry, unnest(range(1, len(geometry))) AS k FROM hydroobject)), l AS (SELECT fid, sum(n) AS n FROM s GROUP BY fid HAVING sum(n) > 0)
SELECT fid AS id, piece, round(n * lo, 3) AS d0, round(n * hi, 3) AS d1, round(n * (hi - lo), 3) AS length FROM l, (VALUES (0, 0.0, 0.25), (1, 0.25, 0.6), (2, 0.6, 1.0)) v(piece, lo, hi)""")
def split_branches(s: SparkSession, d: str) -> DataFrame:
    h = _lines(s, d, "hydroobject")
    n = N.clean_lines(h).select(F.col("id").alias("host"), G.length(F.col("c")).alias("n")).filter("n > 0")
    nodes = n.select("host", F.explode(F.array(F.col("n") * 0.25, F.col("n") * 0.6)).alias("at"))
    return N.split_at(h.join(n.select(F.col("host").alias("id")), "id", "left_semi"), nodes).select("id", "piece", F.round("d0", 3).alias("d0"), F.round("d1", 3).alias("d1"), F.round(G.length(F.col("c")), 3).alias("length"))


@query(f"""WITH e AS {_ENDS.format('hydroobject')}
SELECT a.id AS id1, b.id AS id2, round(min(sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y))), 4) AS distance FROM e a JOIN e b ON a.id < b.id AND a.x BETWEEN b.x - 4 AND b.x + 4 AND a.y BETWEEN b.y - 4 AND b.y + 4 AND sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)) <= 4 AND sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)) > 0.01 GROUP BY a.id, b.id""")
def near_miss_pairs(s: SparkSession, d: str) -> DataFrame:
    """All pairs of branches with a gap."""
    h = _lines(s, d, "hydroobject")
    return N.gaps(h, h, 0.01, 4.0).filter("id1 < id2").withColumn("distance", F.round("distance", 4))


@query(f"""WITH {_hits('hydroobject', _PTS.format('storagenodes'), 2.0)} SELECT p.id FROM storagenodes s JOIN (SELECT fid AS id FROM storagenodes) p ON p.id = s.fid WHERE p.id NOT IN (SELECT pt FROM h)""")
def unattached_nodes(s: SparkSession, d: str) -> DataFrame:
    return N.unattached(_points(s, d, "storagenodes"), _lines(s, d, "hydroobject"), 2.0)


@query("""WITH g AS (SELECT fid, geometry[1] AS a, geometry[-1] AS b FROM gravity_mains WHERE len(geometry) > 0), l AS (SELECT fid, sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)) AS n FROM g) SELECT fid AS id FROM l WHERE n < 8""")
def short_branches_removed(s: SparkSession, d: str) -> DataFrame:
    _, removed = N.collapse_short(_lines(s, d, "gravity_mains"), 0.0001, 8.0)
    return removed.filter("reason = 'short'").select("id")


@query(f"""WITH RECURSIVE p AS (SELECT id * 2 + CASE side WHEN 'start' THEN 0 ELSE 1 END AS pt, id, side, x, y, printf('%.6f %.6f', x, y) AS k FROM {_ENDS.format('gravity_mains')}), nd AS (SELECT k, min(pt) AS node, any_value(x) AS x, any_value(y) AS y FROM p GROUP BY k),
e AS (SELECT a.id, na.node AS u, nb.node AS v, sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)) AS n FROM p a JOIN p b ON b.id = a.id AND b.side = 'end' JOIN nd na ON na.k = a.k JOIN nd nb ON nb.k = b.k WHERE a.side = 'start'),
sh AS (SELECT * FROM e WHERE n < 8), b AS (SELECT u AS x, v AS y FROM sh UNION SELECT v, u FROM sh), n0 AS (SELECT DISTINCT x AS k FROM b),
cc(k, c) USING KEY (k) AS (SELECT k, k FROM n0 UNION SELECT b.y, min(cc.c) FROM cc JOIN b ON b.x = cc.k JOIN recurring.cc r ON r.k = b.y WHERE cc.c < r.c GROUP BY b.y),
dg AS (SELECT node, count(*) AS deg, count(*) FILTER (n >= 8) AS lasting FROM (SELECT u AS node, n FROM e UNION ALL SELECT v, n FROM e) GROUP BY node),
best AS (SELECT c, k AS goal FROM cc JOIN dg ON dg.node = cc.k QUALIFY row_number() OVER (PARTITION BY c ORDER BY lasting DESC, deg DESC, k) = 1),
mv AS (SELECT k AS node, goal FROM cc JOIN best USING (c)),
kept AS (SELECT e.id, coalesce(mu.goal, u) AS u, coalesce(mw.goal, v) AS v FROM e LEFT JOIN mv mu ON mu.node = u LEFT JOIN mv mw ON mw.node = v WHERE n >= 8)
SELECT id, round(sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)), 3) AS length FROM kept JOIN nd a ON a.node = u JOIN nd b ON b.node = v WHERE u <> v""")
def short_branch_collapse(s: SparkSession, d: str) -> DataFrame:
    kept, _ = N.collapse_short(_lines(s, d, "gravity_mains"), 0.0001, 8.0)
    return kept.select("id", F.round(G.length(F.col("c")), 3).alias("length"))


@query(f"""WITH e AS {_MAIN_EDGES.format('gravity_mains')}, dg AS (SELECT n, count(*) AS k FROM (SELECT u AS n FROM e UNION ALL SELECT v FROM e) GROUP BY n),
l AS (SELECT fid AS id, sqrt((geometry[1].x-geometry[-1].x)*(geometry[1].x-geometry[-1].x)+(geometry[1].y-geometry[-1].y)*(geometry[1].y-geometry[-1].y)) AS n FROM gravity_mains WHERE len(geometry) > 0),
o AS (SELECT id, 'start' AS side, u AS k FROM e JOIN dg ON n = u AND k = 1 UNION ALL SELECT id, 'end', v FROM e JOIN dg ON n = v AND k = 1)
SELECT o.id, o.side AS "end", round(l.n, 3) AS old_length, round(20 - l.n, 3) AS extension, CAST(20.0 AS DOUBLE) AS new_length FROM o JOIN l USING (id) WHERE l.n < 19.999 AND l.n > 0.01 AND o.k IN (SELECT v FROM e)""")
def stub_extension(s: SparkSession, d: str) -> DataFrame:
    """Short pipes with an open end as drawn, prolonged to 20 m; every drawn end carries a boundary."""
    h = _lines(s, d, "gravity_mains")
    bounds = A.line_ends(h).filter("end = 'end'").select("id", "x", "y")
    got = N.extend_stubs(h, settled(bounds), 0.0001, 20.0)
    return got.select("id", "end", F.round("old_length", 3).alias("old_length"), F.round("extension", 3).alias("extension"), F.round(G.length(F.col("c")), 3).alias("new_length"))


_BARE_ENDS = "(SELECT id * 2 + 1 AS id, x, y FROM " + _ENDS.format("gravity_mains") + " q WHERE side = 'end')"


@query(f"""WITH RECURSIVE e AS {_MAIN_EDGES.format('gravity_mains')}, n AS (SELECT u AS k, min(id) AS c FROM (SELECT u, id FROM e UNION ALL SELECT v, id FROM e) GROUP BY u), bb AS (SELECT u AS x, v AS y FROM e WHERE u <> v UNION SELECT v, u FROM e WHERE u <> v),
cc(k, c) USING KEY (k) AS (SELECT k, c FROM n UNION SELECT bb.y, min(cc.c) FROM cc JOIN bb ON bb.x = cc.k JOIN recurring.cc r ON r.k = bb.y WHERE cc.c < r.c GROUP BY bb.y),
co AS (SELECT e.id, c FROM e JOIN cc ON cc.k = e.u), wet AS (SELECT DISTINCT c FROM co JOIN gravity_mains g ON g.fid = co.id WHERE pipetype = 'Trunk'),
dg AS (SELECT k, count(*) AS m FROM (SELECT u AS k FROM e UNION ALL SELECT v FROM e) GROUP BY k), lo AS (SELECT e.id * 2 + 1 AS pt, c FROM e JOIN dg ON k = v AND m = 1 JOIN co ON co.id = e.id WHERE c NOT IN (SELECT c FROM wet)),
nn AS (SELECT DISTINCT q.id FROM {_BARE_ENDS} q JOIN {_PTS.format('storagenodes')} p ON p.x BETWEEN q.x - 0.5 AND q.x + 0.5 AND p.y BETWEEN q.y - 0.5 AND q.y + 0.5 AND sqrt((p.x-q.x)*(p.x-q.x)+(p.y-q.y)*(p.y-q.y)) <= 0.5),
{_hits('hydroobject', _BARE_ENDS, 60.0)}, best AS (SELECT pt, min_by(line, (round(off, 9), line)) AS line, min(off) AS off FROM h GROUP BY pt)
SELECT pt // 2 AS id, line AS target, round(off, 3) AS distance FROM lo JOIN best USING (pt) WHERE pt NOT IN (SELECT id FROM nn) QUALIFY row_number() OVER (PARTITION BY c ORDER BY round(off, 9), pt) = 1""")
def network_outlets(s: SparkSession, d: str) -> DataFrame:
    """For components of pipes without a trunk, the bare end nearest to a branch that has no node."""
    m = read(s, d, "gravity_mains")
    lines = m.select(F.col("fid").alias("id"), "geometry")
    e = settled(A.network(lines, 0.0001))
    return N.network_outlets(e, lines, m.filter("pipetype = 'Trunk'").select(F.col("fid").alias("id")), _lines(s, d, "hydroobject"), 60.0, _points(s, d, "storagenodes"), 0.5).select("id", "target", F.round("distance", 3).alias("distance"))


@query(f"""WITH p AS {_PTS.format('storagenodes')}, c AS (SELECT id, x, y, row_number() OVER (PARTITION BY round_even(x / 100, 0), round_even(y / 100, 0) ORDER BY x, id) AS k FROM p) SELECT count(*) FILTER (k = 1) AS cells, count(*) AS points FROM c""")
def cells_in_use(s: SparkSession, d: str) -> DataFrame:
    from ..functions.columns import snapped

    p = _points(s, d, "storagenodes").filter("x is not null and y is not null and not isnan(x) and not isnan(y)")
    return p.groupBy(snapped(F.col("x"), 100.0).alias("gx"), snapped(F.col("y"), 100.0).alias("gy")).agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("points"))


@query("""WITH b AS (SELECT least(printf('%.6f %.6f,%.6f %.6f', geometry[1].x, geometry[1].y, geometry[-1].x, geometry[-1].y), printf('%.6f %.6f,%.6f %.6f', geometry[-1].x, geometry[-1].y, geometry[1].x, geometry[1].y)) AS k, fid FROM gravity_mains WHERE len(geometry) > 1)
SELECT fid AS id, min(fid) OVER (PARTITION BY k) AS same_as FROM b""")
def same_geometry(s: SparkSession, d: str) -> DataFrame:
    """Every pipe with the least one along the same line in either direction, its own id where there is no other."""
    k = N.clean_lines(_lines(s, d, "gravity_mains")).select("id", G.normalised(F.col("c")).alias("k"))
    return k.join(k.groupBy("k").agg(F.min("id").alias("same_as")), "k").select("id", "same_as")


def _ranked(s: SparkSession, d: str) -> DataFrame:
    """facilityid, fid, ahead of all culverts with a line and a level. The sort splits inside a line, however many rows it holds."""
    t = read(s, d, "gravity_mains").filter("upelev is not null and not isnan(upelev) and facilityid is not null and pipetype in ('Culvert', 'Trunk')").select("fid", "facilityid", (0.0 - F.col("upelev")).alias("down"), (F.col("pipetype") == "Trunk").cast("int").alias("trunk"))
    # culverts come before the trunks of their own level, which aren't higher
    run = running_sums(range_sorted(t, ["facilityid", "down", "trunk"], ["fid"]), "facilityid", ["trunk"])
    return run.filter("trunk = 0").select("facilityid", "fid", F.col("run_trunk").cast("bigint").alias("ahead"))


@query("SELECT p.fid, count(q.fid) AS ahead FROM (SELECT fid, facilityid, upelev FROM gravity_mains WHERE pipetype = 'Culvert' AND NOT isnan(upelev) AND facilityid IS NOT NULL) p LEFT JOIN (SELECT fid, facilityid, upelev FROM gravity_mains WHERE pipetype = 'Trunk' AND NOT isnan(upelev)) q ON q.facilityid = p.facilityid AND q.upelev > p.upelev GROUP BY p.fid")
def ranked_within_line(s: SparkSession, d: str) -> DataFrame:
    """How many trunk pipes of its line lie higher than each culvert, by a running count instead of pairs."""
    return _ranked(s, d).select("fid", "ahead")


@query()
def hausdorff_matches(s: SparkSession, d: str) -> DataFrame:
    """For each branch the other one that runs closest to it."""
    h = _lines(s, d, "hydroobject")
    return N.hausdorff_matches(h, h, 20.0, same=True)


@query()
def carriageway_pairs(s: SparkSession, d: str) -> DataFrame:
    """Branches of one category that run beside each other in opposite directions."""
    h = read(s, d, "hydroobject").select(F.col("fid").alias("id"), "geometry", F.lower(F.trim("categorieoppwaterlichaam")).alias("kind"))
    return N.carriageway_pairs(h, 15.0)


_PIPE_PTS = "(SELECT id * 2 + CASE side WHEN 'start' THEN 0 ELSE 1 END AS id, x, y FROM " + _ENDS.format("gravity_mains") + ")"


@query(f"""WITH {_hits('hydroobject', _PIPE_PTS, 40.0)}, e AS {_PIPE_PTS},
o AS (SELECT DISTINCT e.id FROM e JOIN {_PTS.format('discharge_points')} p ON p.x BETWEEN e.x - 6 AND e.x + 6 AND p.y BETWEEN e.y - 6 AND e.y + 6 AND sqrt((p.x-e.x)*(p.x-e.x)+(p.y-e.y)*(p.y-e.y)) <= 6),
near AS (SELECT pt, min_by(line, (round(off, 9), line)) AS line FROM h WHERE pt IN (SELECT id FROM o) GROUP BY pt),
v AS (SELECT fid AS line, unnest(geometry) AS p FROM hydroobject), vd AS (SELECT pt, near.line, min(sqrt((p.x-e.x)*(p.x-e.x)+(p.y-e.y)*(p.y-e.y))) AS d FROM near JOIN v USING (line) JOIN e ON e.id = pt GROUP BY pt, near.line),
b AS (SELECT * FROM vd QUALIFY row_number() OVER (PARTITION BY pt // 2 ORDER BY d, pt) = 1),
l AS (SELECT fid, sum(sqrt((geometry[k].x-geometry[k+1].x)*(geometry[k].x-geometry[k+1].x)+(geometry[k].y-geometry[k+1].y)*(geometry[k].y-geometry[k+1].y))) AS n FROM (SELECT fid, geometry, unnest(range(1, len(geometry))) AS k FROM gravity_mains) GROUP BY fid)
SELECT pt // 2 AS id, CASE WHEN pt % 2 = 0 THEN 'start' ELSE 'end' END AS "end", line AS channel, round(n + CASE WHEN d < 6 THEN 0 ELSE d END, 3) AS length FROM b JOIN l ON l.fid = pt // 2""")
def connected_outfalls(s: SparkSession, d: str) -> DataFrame:
    """Pipes ending at an outfall, prolonged to the nearest vertex of a branch."""
    got = N.connect_ends(_lines(s, d, "gravity_mains"), _points(s, d, "discharge_points"), _lines(s, d, "hydroobject"), 6.0, 40.0)
    return got.select("id", "end", "channel", F.round(G.length(F.col("c")), 3).alias("length"))


# Outfalls ----------------------------------------------------------------------------------------------------


def _outfall_input(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pipes, branches as channels (those without a category are other drains), and discharge points that are outfalls."""
    pipes = read(s, d, "gravity_mains").select(F.col("fid").alias("id"), "geometry", F.lit(False).alias("outfall"))
    drains = read(s, d, "hydroobject").select(F.col("fid").alias("id"), "geometry", F.col("categorieoppwaterlichaam").isNotNull().alias("channel"))
    points = read(s, d, "discharge_points").filter("lower(trim(dischrgtyp)) = 'outfall'").select(F.col("fid").alias("id"), F.col("geometry.x").alias("x"), F.col("geometry.y").alias("y"))
    return pipes, drains, points


@query(f"""WITH e AS {_ENDS.format('gravity_mains')}, k AS (SELECT *, printf('%.6f %.6f', x, y) AS node FROM e), n AS (SELECT node, count(*) AS n, bool_and(side = 'end') AS sink FROM k GROUP BY node)
SELECT id, side AS "end", n <= 1 OR sink AS outlet FROM k JOIN n USING (node)""")
def outlet_ends(s: SparkSession, d: str) -> DataFrame:
    """Which ends of pipes are outlets of the network: bare ones, and those that pipes only flow into."""
    return O.node_ends(_lines(s, d, "gravity_mains").withColumn("is_pipe", F.lit(True)), 0.0001).select("id", "end", "outlet")


@query()
def outfall_connections(s: SparkSession, d: str) -> DataFrame:
    """What becomes of each pipe with an outfall: status, channel, and where its end comes to lie."""
    pipes, drains, points = _outfall_input(s, d)
    got = O.outfall_connections(pipes, drains, points, tol=6.0, snap=8.0, limit=40.0)
    return got.select("id", "end", "trigger", "status", "channel", *[F.round(c, 3).alias(c) for c in ("x", "y", "moved", "added", "trimmed")])


@query()
def outfalls_as_inlets(s: SparkSession, d: str) -> DataFrame:
    """Outfalls too far from a channel, or without a pipe, as inlets."""
    pipes, drains, points = _outfall_input(s, d)
    found = settled(O.outfall_connections(pipes, drains, points, tol=6.0, snap=8.0, limit=40.0))
    rows = points.join(read(s, d, "discharge_points").select(F.col("fid").alias("id"), "facilityid", "flowelev"), "id")
    return O.converted_outfalls(found, rows.select(F.col("id").alias("fid"), "facilityid", "x", "y", (F.col("flowelev") / 3.28084).alias("dem")), read(s, d, "inlets").select("objectid"), 6.0, 10.0).drop("pipes")
