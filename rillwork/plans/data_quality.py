"""Queries of the general problems 1 to 5, and the SQL they are held against where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.fill import fill_network, fill_shapes, hold_out
from ..operators.near import SortedPoints, lines_within, points_within, regions_containing
from ..operators.orphans import Reference, dangling
from ..operators.profile import Field, breaking_loads, drift, profile
from ..operators.units import recorded_units
from ..session import read

REFERENCES = [
    Reference("pomp", "gemaalid", "gemaal", "globalid"),
    Reference("sturing", "pompid", "pomp", "globalid"),
    Reference("regelmiddel", "stuwid", "stuw", "globalid"),
    Reference("crosssection_location", "branch_id", "hydroobject", "code", guid=False),
]

#: The code lists and ranges of the problem's statement.
FIELDS = [
    Field("gravity_mains", "mainshape", False, ("RND", "BOX", "ELL", "ARC", "TRP", "OTH")),
    Field("gravity_mains", "upelev", True, low=-20.0, high=250.0),
    Field("inlets", "inlettype", False, ("A", "B", "BB", "C", "C1", "D", "E", "H2")),
    Field("inlets", "depth", True, low=0.0, high=60.0),
]


def _tables(spark: SparkSession, d: str, *names: str) -> dict[str, DataFrame]:
    return {n: read(spark, d, n) for n in names}


def p1_units(spark: SparkSession, d: str) -> DataFrame:
    """Every measured cell in canonical units."""
    return recorded_units(_tables(spark, d, "inlets", "gravity_mains")).drop("converted")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Cells whose composed conversion to the nominal unit changes them."""
    return recorded_units(_tables(spark, d, "inlets", "gravity_mains")).filter("converted").select("layer", "field", "fid")


def p2_filled(spark: SparkSession, d: str) -> DataFrame:
    """Every cell of the numeric fields, missing ones filled and flagged."""
    return fill_network(read(spark, d, "gravity_mains"), read(spark, d, "open_drains"))


def p2_shapes(spark: SparkSession, d: str) -> DataFrame:
    return fill_shapes(read(spark, d, "gravity_mains"))


def p2_holdout(spark: SparkSession, d: str) -> DataFrame:
    """How far fills lie from observed values that were hidden, one of ten of each field: hidden, filled, median and mean error."""
    h = hold_out(read(spark, d, "gravity_mains"), read(spark, d, "open_drains"))
    error = F.abs(F.col("filled") - F.col("value"))
    return h.groupBy("field").agg(F.count(F.lit(1)).alias("hidden"), F.count("filled").alias("filled"), F.round(F.percentile_approx(error, 0.5, 10_000), 3).alias("median_error"), F.round(F.avg(error), 3).alias("mean_error"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_filled(spark, d).filter("filled").select("layer", "field", "fid")


def _dangling(spark: SparkSession, d: str) -> DataFrame:
    names = {r.child for r in REFERENCES} | {r.parent for r in REFERENCES}
    return dangling(_tables(spark, d, *sorted(names)), REFERENCES)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _dangling(spark, d).select("child_table", "child_fid")


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    """Dangling references per table, month and reason."""
    month = F.date_format("load_ts", "yyyy-MM").alias("month")
    return _dangling(spark, d).groupBy("child_table", month, "reason").agg(F.count(F.lit(1)).alias("dangling"))


def _points(spark: SparkSession, d: str, name: str) -> DataFrame:
    return read(spark, d, name).select(F.col("fid").alias("id"), F.col("geometry.x").alias("x"), F.col("geometry.y").alias("y"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    nodes, outfalls = _points(spark, d, "storagenodes"), _points(spark, d, "discharge_points")
    lines = read(spark, d, "hydroobject").select(F.col("fid").alias("id"), "geometry")
    areas = read(spark, d, "watersheds").select(F.col("fid").alias("id"), "geometry")
    by_node, by_outfall = SortedPoints(nodes), SortedPoints(outfalls)
    found = {
        "node_node": points_within(nodes, by_node, 2.0, same=True),
        "outfall_node": points_within(outfalls, by_node, 10.0),
        "outfall_branch": lines_within(lines, by_outfall, 7.5),
        "area_outfall": regions_containing(areas, by_outfall),
    }
    out = None
    for rel, pairs in found.items():
        p = pairs.select(F.lit(rel).alias("rel"), F.least("id1", "id2").alias("id1"), F.greatest("id1", "id2").alias("id2"))
        out = p if out is None else out.unionByName(p)
    return out


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return breaking_loads(_tables(spark, d, "gravity_mains", "inlets"), FIELDS)


def p5_profile(spark: SparkSession, d: str) -> DataFrame:
    p = profile(_tables(spark, d, "gravity_mains", "inlets"), FIELDS)
    return p.select("layer", "field", "load_id", "rows", "missing", "distinct_values", "off", *[F.round(c, 6).alias(c) for c in ("least", "greatest", "p05", "p50", "p95")])


def p5_drift(spark: SparkSession, d: str) -> DataFrame:
    return drift(_tables(spark, d, "gravity_mains", "inlets"), FIELDS).withColumn("ks", F.round("ks", 6))


QUERIES = {f.__name__: f for f in (p1_found, p1_units, p2_found, p2_filled, p2_holdout, p2_shapes, p3_found, p3_report, p4_found, p5_found, p5_profile, p5_drift)}

_GUID = "nullif(nullif(upper(regexp_replace({}, '^[\\s{{}}]+|[\\s{{}}]+$', '', 'g')), ''), '00000000-0000-0000-0000-000000000000')"
_CODE = "nullif(upper(regexp_replace({}, '^\\s+|\\s+$', '', 'g')), '')"


def _dangling_sql() -> str:
    parts = []
    for r in REFERENCES:
        key = _GUID if r.guid else _CODE
        parts.append(f"""SELECT '{r.child}' AS child_table, c.fid AS child_fid, c.load_ts, c.k,
  CASE WHEN NOT EXISTS (SELECT 1 FROM (SELECT {key.format(r.key)} AS k, load_ts, deleted_at FROM {r.parent}) p WHERE p.k = c.k AND (deleted_at IS NULL OR deleted_at > p.load_ts)) THEN 'missing'
       WHEN EXISTS (SELECT 1 FROM (SELECT {key.format(r.key)} AS k, load_ts, deleted_at FROM {r.parent}) p WHERE p.k = c.k AND (deleted_at IS NULL OR deleted_at > p.load_ts) AND p.load_ts <= c.load_ts) THEN 'withdrawn' ELSE 'late' END AS reason
  FROM (SELECT *, {key.format(r.column)} AS k FROM {r.child}) c
  WHERE c.k IS NOT NULL AND NOT EXISTS (SELECT 1 FROM (SELECT {key.format(r.key)} AS k, load_ts, deleted_at FROM {r.parent}) p
    WHERE p.k = c.k AND p.load_ts <= c.load_ts AND (deleted_at IS NULL OR deleted_at > c.load_ts))""")
    return " UNION ALL ".join(parts)


_CELLS = """
cells AS (
  SELECT 'gravity_mains' AS layer, 'mainshape' AS field, load_id, CASE WHEN trim(mainshape) <> '' THEN mainshape END AS t, CAST(NULL AS DOUBLE) AS x FROM gravity_mains
  UNION ALL SELECT 'gravity_mains', 'upelev', load_id, NULL, CASE WHEN NOT isnan(upelev) THEN upelev END FROM gravity_mains
  UNION ALL SELECT 'inlets', 'inlettype', load_id, CASE WHEN trim(inlettype) <> '' THEN inlettype END, NULL FROM inlets
  UNION ALL SELECT 'inlets', 'depth', load_id, NULL, CASE WHEN NOT isnan(depth) THEN depth END FROM inlets),
judged AS (SELECT *, CASE WHEN field = 'mainshape' THEN t IN ('RND','BOX','ELL','ARC','TRP','OTH') WHEN field = 'inlettype' THEN t IN ('A','B','BB','C','C1','D','E','H2')
  WHEN field = 'upelev' THEN x BETWEEN -20 AND 250 ELSE x BETWEEN 0 AND 60 END AS ok FROM cells)
"""

ORACLE = {
    "p3_found": f"SELECT child_table, child_fid FROM ({_dangling_sql()})",
    "p3_report": f"SELECT child_table, strftime(load_ts, '%Y-%m') AS month, reason, count(*) AS dangling FROM ({_dangling_sql()}) GROUP BY ALL",
    "p4_found": """
WITH n AS (SELECT fid, geometry.x AS x, geometry.y AS y FROM storagenodes WHERE geometry.x IS NOT NULL AND NOT isnan(geometry.x) AND geometry.y IS NOT NULL AND NOT isnan(geometry.y)),
o AS (SELECT fid, geometry.x AS x, geometry.y AS y FROM discharge_points WHERE geometry.x IS NOT NULL AND NOT isnan(geometry.x) AND geometry.y IS NOT NULL AND NOT isnan(geometry.y)),
s AS (SELECT fid, geometry[k].x AS ax, geometry[k].y AS ay, geometry[k+1].x AS bx, geometry[k+1].y AS by_ FROM (SELECT fid, geometry, unnest(range(1, len(geometry))) AS k FROM hydroobject)),
sd AS (SELECT s.fid AS l, o.fid AS p, o.x, o.y, ax, ay, bx, by_, CASE WHEN ax = bx AND ay = by_ THEN 0.0 ELSE greatest(0.0, least(1.0, ((o.x-ax)*(bx-ax)+(o.y-ay)*(by_-ay)) / ((bx-ax)*(bx-ax)+(by_-ay)*(by_-ay)))) END AS t
  FROM s JOIN o ON o.x BETWEEN least(ax,bx)-7.5 AND greatest(ax,bx)+7.5 AND o.y BETWEEN least(ay,by_)-7.5 AND greatest(ay,by_)+7.5),
w AS (SELECT fid, r, unnest(range(1, len(ring)+1)) AS k, ring FROM (SELECT fid, unnest(range(1, len(geometry)+1)) AS r, unnest(geometry) AS ring FROM watersheds)),
e AS (SELECT fid, ring[k].x AS ax, ring[k].y AS ay, ring[k % len(ring) + 1].x AS bx, ring[k % len(ring) + 1].y AS by_ FROM w)
SELECT 'node_node' AS rel, a.fid AS id1, b.fid AS id2 FROM n a JOIN n b ON a.fid < b.fid AND a.x BETWEEN b.x - 2 AND b.x + 2 AND a.y BETWEEN b.y - 2 AND b.y + 2 AND sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)) <= 2
UNION ALL SELECT 'outfall_node', o.fid, n.fid FROM o JOIN n ON n.x BETWEEN o.x - 10 AND o.x + 10 AND n.y BETWEEN o.y - 10 AND o.y + 10 AND sqrt((o.x-n.x)*(o.x-n.x)+(o.y-n.y)*(o.y-n.y)) <= 10
UNION ALL SELECT DISTINCT 'outfall_branch', p, l FROM sd WHERE sqrt((x-(ax+t*(bx-ax)))*(x-(ax+t*(bx-ax)))+(y-(ay+t*(by_-ay)))*(y-(ay+t*(by_-ay)))) <= 7.5
UNION ALL SELECT 'area_outfall', e.fid, o.fid FROM e JOIN o ON (ay > o.y) <> (by_ > o.y) AND o.x < (bx-ax)*(o.y-ay)/(by_-ay)+ax GROUP BY e.fid, o.fid HAVING count(*) % 2 = 1""",
    "p5_profile": f"""WITH {_CELLS}
SELECT layer, field, load_id, count(*) AS rows, count(*) - count(t) - count(x) AS missing, count(DISTINCT t) + count(DISTINCT x) AS distinct_values,
  CAST(coalesce(sum(CASE WHEN ok = false AND (t IS NOT NULL OR x IS NOT NULL) THEN 1 ELSE 0 END), 0) AS BIGINT) AS off, round(min(x), 6) AS least, round(max(x), 6) AS greatest,
  round(quantile_cont(x, 0.05), 6) AS p05, round(quantile_cont(x, 0.5), 6) AS p50, round(quantile_cont(x, 0.95), 6) AS p95 FROM judged GROUP BY layer, field, load_id""",
    "p5_drift": f"""WITH {_CELLS},
v AS (SELECT layer, field, load_id, x FROM cells WHERE x IS NOT NULL),
l AS (SELECT layer, field, load_id, lag(load_id) OVER (PARTITION BY layer, field ORDER BY load_id) AS previous_id, n FROM (SELECT layer, field, load_id, count(*) AS n FROM v GROUP BY ALL)),
u AS (SELECT l.layer, l.field, l.load_id, l.previous_id, v.x, 1.0 / l.n AS w FROM l JOIN v ON v.layer = l.layer AND v.field = l.field AND v.load_id = l.load_id WHERE l.previous_id IS NOT NULL
  UNION ALL SELECT l.layer, l.field, l.load_id, l.previous_id, v.x, -1.0 / p.n FROM l JOIN l p ON p.layer = l.layer AND p.field = l.field AND p.load_id = l.previous_id JOIN v ON v.layer = l.layer AND v.field = l.field AND v.load_id = l.previous_id),
g AS (SELECT layer, field, load_id, previous_id, x, sum(w) AS w FROM u GROUP BY ALL),
c AS (SELECT layer, field, load_id, previous_id, sum(w) OVER (PARTITION BY layer, field, load_id ORDER BY x) AS f FROM g)
SELECT layer, field, load_id, previous_id, round(max(abs(f)), 6) AS ks FROM c GROUP BY ALL""",
    "p5_found": f"""WITH {_CELLS},
s AS (SELECT layer, field, load_id, max(x) IS NOT NULL AS num, 1 - (count(t) + count(x)) / count(*) AS ms, sum(CASE WHEN ok = false AND (t IS NOT NULL OR x IS NOT NULL) THEN 1 ELSE 0 END) / nullif(count(t) + count(x), 0) AS os FROM judged GROUP BY ALL),
m AS (SELECT layer, field, load_id, median(x) AS md FROM judged WHERE ok AND x IS NOT NULL GROUP BY ALL),
tc AS (SELECT layer, field, load_id, count(*) AS n FROM judged WHERE ok AND t IS NOT NULL GROUP BY ALL),
codes AS (SELECT DISTINCT layer, field, t FROM judged WHERE ok AND t IS NOT NULL),
sh AS (SELECT tc.layer, tc.field, tc.load_id, codes.t, coalesce(c.n, 0) / tc.n AS share FROM tc JOIN codes ON codes.layer = tc.layer AND codes.field = tc.field
  LEFT JOIN (SELECT layer, field, load_id, t, count(*) AS n FROM judged WHERE ok AND t IS NOT NULL GROUP BY ALL) c ON c.layer = tc.layer AND c.field = tc.field AND c.load_id = tc.load_id AND c.t = codes.t),
shm AS (SELECT *, median(share) OVER (PARTITION BY layer, field, t) AS ctr FROM sh)
SELECT layer, field, load_id, 'nulls' AS kind FROM (SELECT *, median(ms) OVER (PARTITION BY layer, field) AS mm FROM s) WHERE abs(ms - mm) > 0.15
UNION ALL SELECT layer, field, load_id, CASE WHEN num THEN 'range' ELSE 'domain' END FROM s WHERE os > CASE WHEN num THEN 0.25 ELSE 0.2 END
UNION ALL SELECT layer, field, load_id, 'shift' FROM (SELECT *, median(md) OVER (PARTITION BY layer, field) AS c FROM m) WHERE abs(md - c) > 0.5 * abs(c)
UNION ALL SELECT layer, field, load_id, 'shift' FROM shm GROUP BY layer, field, load_id HAVING sum(abs(share - ctr)) / 2 > 0.4""",
}
