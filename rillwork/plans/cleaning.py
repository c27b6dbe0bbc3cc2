"""Queries of the cleaning operators, with the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import cleaning as K
from ..operators.profile import group_quantiles
from ..session import read


def _n(c: str) -> str:
    return f"(CASE WHEN isnan({c}) THEN NULL ELSE {c} END)"


QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


@query("SELECT fid, CASE WHEN linetype IS NULL OR trim(linetype) = '' THEN 'Roadside Ditch' ELSE linetype END AS linetype, linetype IS NULL OR trim(linetype) = '' AS filled FROM open_drains")
def fill_missing_category(s: SparkSession, d: str) -> DataFrame:
    t = read(s, d, "open_drains")
    return t.select("fid", C.fill(F.col("linetype"), "Roadside Ditch", text=True).alias("linetype"), C.missing(F.col("linetype"), text=True).alias("filled"))


@query("""SELECT fid, CASE WHEN day = DATE '2023-01-01' AND (material IS NULL OR trim(material) = '') THEN 'RCP' ELSE material END AS material, CASE WHEN day = DATE '2023-01-01' AND (mainshape IS NULL OR trim(mainshape) = '') THEN 'RND' ELSE mainshape END AS mainshape
FROM (SELECT *, CASE WHEN regexp_matches(installdate, '^\\d{4}-\\d{2}-\\d{2}T.*Z$') THEN CAST(TRY_CAST(replace(replace(installdate, 'T', ' '), 'Z', '') AS TIMESTAMP) - INTERVAL 6 HOUR AS DATE) WHEN regexp_matches(installdate, '^\\d{4}-\\d{2}-\\d{2}$') THEN TRY_CAST(installdate AS DATE) END AS day FROM gravity_mains)""")
def autofill_by_install_day(s: SparkSession, d: str) -> DataFrame:
    t = read(s, d, "gravity_mains").select("fid", "installdate", "material", "mainshape")
    return K.by_day(t, C.local_date(F.col("installdate"), "Etc/GMT+6"), "2023-01-01", {"material": "RCP", "mainshape": "RND"}).drop("installdate")


@query("SELECT fid, 'outfall' AS mark FROM discharge_points WHERE upper(trim(dischrgtyp)) = 'OUTFALL' UNION ALL SELECT fid, 'box' FROM gravity_mains WHERE mainshape IN ('BOX', 'ELL')")
def mark_layers(s: SparkSession, d: str) -> DataFrame:
    a = read(s, d, "discharge_points").filter(F.upper(F.trim("dischrgtyp")).isin("OUTFALL")).select("fid", F.lit("outfall").alias("mark"))
    return a.unionByName(read(s, d, "gravity_mains").filter(F.col("mainshape").isin("BOX", "ELL")).select("fid", F.lit("box").alias("mark")))


@query("SELECT 'stays' AS rule, fid FROM gravity_mains WHERE NOT coalesce(pipetype IN ('Culvert', 'Lateral'), false) UNION ALL SELECT 'goes', fid FROM gravity_mains WHERE pipetype IS NOT NULL AND trim(pipetype) <> '' AND pipetype NOT IN ('Culvert')")
def drop_by_values_null_safe(s: SparkSession, d: str) -> DataFrame:
    t = read(s, d, "gravity_mains").select("fid", "pipetype")
    a = K.dropped_where(t, "pipetype", ["Culvert", "Lateral"]).select(F.lit("stays").alias("rule"), "fid")
    return a.unionByName(K.dropped_where(t, "pipetype", ["Culvert", ""]).select(F.lit("goes").alias("rule"), "fid"))


@query("SELECT fid, round(width / 39.3701, 4) AS width_m, round(upelev / 3.28084, 4) AS up_m FROM gravity_mains WHERE NOT isnan(width) AND NOT isnan(upelev) AND width IS NOT NULL AND upelev IS NOT NULL")
def unit_conversion(s: SparkSession, d: str) -> DataFrame:
    t = read(s, d, "gravity_mains").filter(~C.missing(F.col("width")) & ~C.missing(F.col("upelev")))
    return t.select("fid", F.round(F.col("width") / C.IN_PER_M, 4).alias("width_m"), C.metres(F.col("upelev"), 4).alias("up_m"))


@query(f"""WITH c AS (SELECT fid, nullif({_n('width')}, 0) AS w, nullif({_n('bankwidth')}, 0) AS b, nullif({_n('depth')}, 0) AS dp FROM open_drains), k AS (SELECT *, w IS NULL OR b IS NULL OR dp IS NULL OR coalesce(b < w, false) AS bad FROM c)
SELECT fid, CASE WHEN bad THEN 13.12 ELSE w END AS new_width, CASE WHEN bad THEN 32.81 ELSE b END AS new_bank, coalesce(dp, 4.92) AS new_depth, bad AS is_default FROM k""")
def default_cross_section(s: SparkSession, d: str) -> DataFrame:
    t = read(s, d, "open_drains").select("fid", *[C.finite(F.col(c)).alias(c) for c in ("width", "bankwidth", "depth")])
    return K.default_sections(t).select("fid", "new_width", "new_bank", "new_depth", "is_default")


@query(f"""SELECT fid, CASE WHEN pipetype IS NULL OR trim(pipetype) = '' THEN 'Collector' ELSE pipetype END AS new_type, CASE WHEN {_n('width')} IS NULL OR width = 0 OR width = 6.56 THEN 78.74 ELSE width END AS new_width,
CASE WHEN coalesce(upper(trim(mainshape)) = 'BOX', false) AND ({_n('height')} IS NULL OR height = 0 OR height = 6.56) THEN (CASE WHEN {_n('width')} IS NULL OR width = 0 OR width = 6.56 THEN 78.74 ELSE width END) ELSE {_n('height')} END AS new_height FROM gravity_mains""")
def default_pipe_attributes(s: SparkSession, d: str) -> DataFrame:
    return K.default_pipes(read(s, d, "gravity_mains")).select("fid", "new_type", "new_width", C.finite(F.col("new_height")).alias("new_height"))


@query("SELECT fid, CASE linetype WHEN 'Offroad Channel - Natural' THEN 'EAR' WHEN 'Offroad Channel - Manmade' THEN 'EAR' END AS bed, CASE linetype WHEN 'Offroad Channel - Natural' THEN 'EAR' WHEN 'Offroad Channel - Manmade' THEN 'CP' END AS side FROM open_drains")
def material_lookup(s: SparkSession, d: str) -> DataFrame:
    t = read(s, d, "open_drains")
    return t.select("fid", C.lookup(F.col("linetype"), {k: v[0] for k, v in K.CHANNEL_MATERIALS.items()}).alias("bed"), C.lookup(F.col("linetype"), {k: v[1] for k, v in K.CHANNEL_MATERIALS.items()}).alias("side"))


@query(f"""WITH f AS (SELECT fid, {_n('objectid')} AS o FROM gravity_mains), k AS (SELECT *, o IS NULL OR row_number() OVER (PARTITION BY o ORDER BY fid) > 1 AS again FROM f)
SELECT fid, CASE WHEN again THEN (SELECT max(o) FROM f) + row_number() OVER (PARTITION BY again ORDER BY fid) ELSE o END AS new_objectid FROM k""")
def unique_ids(s: SparkSession, d: str) -> DataFrame:
    t = read(s, d, "gravity_mains").select("fid", C.finite(F.col("objectid")).alias("objectid"))
    return K.unique_ids(t, "objectid").select("fid", "new_objectid")


@query("SELECT fid, CASE WHEN code IS NOT NULL AND k > 1 THEN code || '_' || (k - 1) ELSE code END AS new_code FROM (SELECT fid, code, row_number() OVER (PARTITION BY code ORDER BY fid) AS k FROM storagenodes)")
def duplicate_suffix(s: SparkSession, d: str) -> DataFrame:
    return K.suffixed(read(s, d, "storagenodes").select("fid", "code"), "code", "fid").select("fid", "new_code")


_DEPTHS = f"(SELECT fid, objectid, facilityid, CASE WHEN {_n('depth')} > 0 AND depth < 900 THEN depth END AS v FROM open_drains)"


@query(f"""WITH d AS (SELECT * FROM {_DEPTHS}), o AS (SELECT objectid, median(v) AS m FROM d WHERE v IS NOT NULL AND objectid IS NOT NULL AND NOT isnan(objectid) GROUP BY 1), f AS (SELECT facilityid, median(v) AS m FROM d WHERE v IS NOT NULL AND facilityid IS NOT NULL GROUP BY 1)
SELECT fid, round(coalesce(v, o.m, f.m), 3) AS filled, CASE WHEN v IS NOT NULL THEN 'own' WHEN o.m IS NOT NULL THEN 'same objectid' WHEN f.m IS NOT NULL THEN 'same facilityid' END AS source FROM d LEFT JOIN o ON o.objectid = d.objectid LEFT JOIN f ON f.facilityid = d.facilityid""")
def fallback_group_median(s: SparkSession, d: str) -> DataFrame:
    t = read(s, d, "open_drains").select("fid", C.finite(F.col("objectid")).alias("objectid"), "facilityid", F.when((F.col("depth") > 0) & (F.col("depth") < 900), F.col("depth")).alias("v"))
    return K.group_fallback(t, "v", ["objectid", "facilityid"], 3).select("fid", "filled", "source")


@query("""SELECT 'gravity_mains' AS src_layer, fid, objectid, facilityid, digitizedby, CAST(width AS VARCHAR) IS NOT NULL AS has_width FROM gravity_mains
UNION ALL SELECT 'discharge_points', fid, objectid, facilityid, NULL, false FROM discharge_points UNION ALL SELECT 'open_drains', fid, objectid, facilityid, digitizedby, width IS NOT NULL FROM open_drains""")
def layer_union_case_merge(s: SparkSession, d: str) -> DataFrame:
    m = read(s, d, "gravity_mains").drop("geometry").withColumnsRenamed({"width": "WIDTH", "facilityid": "FacilityID"})
    o = read(s, d, "open_drains").withColumnRenamed("width", "Width")
    u = K.layer_union({"gravity_mains": m, "discharge_points": read(s, d, "discharge_points").drop("geometry"), "open_drains": o})
    return u.select("src_layer", "fid", "objectid", "facilityid", "digitizedby", F.col("width").isNotNull().alias("has_width"))


@query("""WITH o AS (SELECT definition AS name, count(*) AS n FROM crosssection_location WHERE fid % 3 = 0 GROUP BY 1), e AS (SELECT definition || CASE WHEN fid % 11 = 0 THEN '_new' ELSE '' END AS name, fid FROM crosssection_location WHERE fid % 3 <> 0 AND definition IS NOT NULL)
SELECT name, n FROM o UNION ALL SELECT name, min(fid) FROM e WHERE name NOT IN (SELECT name FROM o WHERE name IS NOT NULL) GROUP BY name""")
def definition_add_if_absent(s: SparkSession, d: str) -> DataFrame:
    t = read(s, d, "crosssection_location")
    old = t.filter("fid % 3 = 0").groupBy(F.col("definition").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    new = t.filter("fid % 3 <> 0 and definition is not null").select(F.concat("definition", F.when(F.col("fid") % 11 == 0, "_new").otherwise("")).alias("name"), F.col("fid").alias("n"))
    return K.add_if_absent(old, new, "name")


@query("SELECT fid, code FROM storagenodes WHERE fid % 5 <> 0 AND fid % 7 <> 0 UNION ALL SELECT fid, code || '*' FROM storagenodes WHERE fid % 5 = 0")
def revert_set(s: SparkSession, d: str) -> DataFrame:
    t = read(s, d, "storagenodes").select("fid", "code")
    restored = t.filter("fid % 5 = 0").withColumn("code", F.concat("code", F.lit("*")))
    return K.reverted(t, t.filter("fid % 5 = 0 or fid % 7 = 0"), restored, "fid")


@query("""SELECT 'width' AS "column", count(*) FILTER (width IS NULL) AS nulls, CAST(0 AS BIGINT) AS blanks, count(*) FILTER (width = 0) AS zeros FROM gravity_mains UNION ALL SELECT 'upelev', count(*) FILTER (upelev IS NULL), 0, count(*) FILTER (upelev = 0) FROM gravity_mains
UNION ALL SELECT 'material', count(*) FILTER (material IS NULL), count(*) FILTER (trim(material) = ''), 0 FROM gravity_mains UNION ALL SELECT 'mainshape', count(*) FILTER (mainshape IS NULL), count(*) FILTER (trim(mainshape) = ''), 0 FROM gravity_mains""")
def field_quality_counts(s: SparkSession, d: str) -> DataFrame:
    return K.quality_counts(read(s, d, "gravity_mains"), ["width", "upelev", "material", "mainshape"])


@query(f"SELECT objectid, count(*) AS n FROM gravity_mains WHERE {_n('objectid')} IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def repeated_ids(s: SparkSession, d: str) -> DataFrame:
    return K.repeated(read(s, d, "gravity_mains").select(C.finite(F.col("objectid")).alias("objectid")), "objectid")


_KEY = "upper(trim(regexp_replace({}, '[{{}}\\s]', '', 'g')))"


@query(f"""WITH g AS (SELECT *, {_KEY.format('globalid')} AS k FROM gemaal), big AS (SELECT k FROM g WHERE maximalecapaciteit > 20), p AS (SELECT fid, {_KEY.format('globalid')} AS k FROM pomp WHERE {_KEY.format('gemaalid')} IN (SELECT k FROM big)), t AS (SELECT fid FROM sturing WHERE {_KEY.format('pompid')} IN (SELECT k FROM p))
SELECT 'pomp' AS tab, fid FROM p UNION ALL SELECT 'sturing', fid FROM t""")
def fk_closure(s: SparkSession, d: str) -> DataFrame:
    from ..operators.network import closure

    key = lambda c: F.upper(F.trim(F.regexp_replace(F.col(c), r"[{}\s]", "")))
    g = read(s, d, "gemaal").filter("maximalecapaciteit > 20").select(key("globalid").alias("globalid"))
    p = read(s, d, "pomp").select("fid", key("globalid").alias("globalid"), key("gemaalid").alias("gemaalid"))
    t = read(s, d, "sturing").select("fid", key("globalid").alias("globalid"), key("pompid").alias("pompid"))
    kept = closure(g, {"pomp": (p, [("gemaalid", "", "globalid")]), "sturing": (t, [("pompid", "pomp", "globalid")])})
    return kept["pomp"].select(F.lit("pomp").alias("tab"), "fid").unionByName(kept["sturing"].select(F.lit("sturing").alias("tab"), "fid"))


@query("""WITH p AS (SELECT fid, code FROM pomp WHERE maximalecapaciteit >= 5), g AS (SELECT fid FROM pomp WHERE NOT coalesce(maximalecapaciteit >= 5, false))
SELECT (SELECT count(*) FROM pomp) AS total, (SELECT count(*) FROM p) AS kept, (SELECT count(*) FROM g) AS removed, (SELECT count(*) FROM pomp) = (SELECT count(*) FROM p) + (SELECT count(*) FROM g) AS adds_up""")
def accounting_identity(s: SparkSession, d: str) -> DataFrame:
    p = read(s, d, "pomp")
    return K.accounting(p, {"kept": p.filter("maximalecapaciteit >= 5"), "removed": p.filter(~F.coalesce(F.col("maximalecapaciteit") >= 5, F.lit(False)))})


@query(f"SELECT pipetype, count(*) AS pipes, round(sum(CASE WHEN {_n('width')} BETWEEN 6 AND 130 THEN width END), 3) AS width_sum, round(max({_n('downelev')}), 3) AS top FROM gravity_mains GROUP BY 1")
def class_totals(s: SparkSession, d: str) -> DataFrame:
    t = read(s, d, "gravity_mains")
    return t.groupBy("pipetype").agg(F.count(F.lit(1)).alias("pipes"), F.round(F.sum(F.when(F.col("width").between(6, 130), F.col("width"))), 3).alias("width_sum"), F.round(F.max(C.finite(F.col("downelev"))), 3).alias("top"))


@query(f"SELECT mainshape, round(quantile_cont(w, 0.01), 6) AS p1, round(quantile_cont(w, 0.05), 6) AS p5, round(quantile_cont(w, 0.5), 6) AS p50, round(quantile_cont(w, 0.95), 6) AS p95, round(quantile_cont(w, 0.99), 6) AS p99, round(min(w), 6) AS least, round(avg(w), 6) AS mean, round(max(w), 6) AS greatest FROM (SELECT mainshape, {_n('width')} AS w FROM gravity_mains) WHERE w IS NOT NULL GROUP BY 1")
def percentile_report(s: SparkSession, d: str) -> DataFrame:
    t = read(s, d, "gravity_mains").filter(~C.missing(F.col("width")))
    shares = {"p1": 0.01, "p5": 0.05, "p50": 0.5, "p95": 0.95, "p99": 0.99}
    t = t.withColumn("shape", F.coalesce("mainshape", F.lit("(none)")))
    q = group_quantiles(t, "shape", "width", shares)
    plain = t.groupBy("shape").agg(F.first("mainshape").alias("mainshape"), F.min("width").alias("least"), F.avg("width").alias("mean"), F.max("width").alias("greatest"))
    return plain.join(q, "shape").select("mainshape", *[F.round(c, 6).alias(c) for c in (*shares, "least", "mean", "greatest")])


@query("SELECT code, fid, load_ts FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY load_ts DESC, fid) AS k FROM hydroobject) WHERE k = 1")
def last_row_per_key(s: SparkSession, d: str) -> DataFrame:
    t = read(s, d, "hydroobject").select("code", "fid", "load_ts")
    return t.withColumn("k", F.row_number().over(Window.partitionBy("code").orderBy(F.col("load_ts").desc(), "fid"))).filter("k = 1").drop("k")


@query("SELECT facilityid, string_agg(DISTINCT dischrgtyp, '|' ORDER BY dischrgtyp) AS types, count(*) AS n FROM discharge_points WHERE facilityid IS NOT NULL GROUP BY 1")
def listed_types(s: SparkSession, d: str) -> DataFrame:
    t = read(s, d, "discharge_points").filter("facilityid is not null")
    listed = F.array_join(F.array_sort(F.collect_set("dischrgtyp")), "|")
    return t.groupBy("facilityid").agg(F.when(F.size(F.collect_set("dischrgtyp")) > 0, listed).alias("types"), F.count(F.lit(1)).alias("n"))


@query("SELECT fid, code, split_part(code, '_', 1) AS kind, 'NL.template.hydroobject.' || code AS nen, TRY_CAST(regexp_extract(code, '(\\d+)$', 1) AS INTEGER) AS number, regexp_matches(globalid, '^\\{[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\\}$') AS guid, trim(regexp_replace(naam, '[^\\p{L}\\p{N}]+', '_', 'g'), '_') AS name FROM hydroobject")
def key_functions(s: SparkSession, d: str) -> DataFrame:
    t = read(s, d, "hydroobject")
    c = F.col("code")
    return t.select("fid", "code", C.kind_of(c).alias("kind"), F.when(c.isNotNull(), C.nen_id("hydroobject", c)).alias("nen"), C.suffix_number(c).alias("number"), C.is_guid(F.col("globalid")).alias("guid"), C.sanitised(F.col("naam")).alias("name"))


@query(f"""SELECT fid, CAST(round_even({_n('geometry.x')} / 0.5, 0) AS BIGINT) AS gx, CAST(round_even({_n('geometry.y')} / 0.5, 0) AS BIGINT) AS gy FROM storagenodes WHERE {_n('geometry.x')} IS NOT NULL AND {_n('geometry.y')} IS NOT NULL""")
def grid_snapping(s: SparkSession, d: str) -> DataFrame:
    t = read(s, d, "storagenodes").filter(~C.missing(F.col("geometry.x")) & ~C.missing(F.col("geometry.y")))
    return t.select("fid", C.snapped(F.col("geometry.x"), 0.5).alias("gx"), C.snapped(F.col("geometry.y"), 0.5).alias("gy"))


@query("SELECT facilityid, fid, upelev FROM (SELECT *, row_number() OVER (ORDER BY upelev DESC, fid) AS k FROM gravity_mains WHERE upelev < 9000) WHERE k <= 20")
def top_report(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "gravity_mains").filter("upelev < 9000").orderBy(F.col("upelev").desc(), "fid").limit(20).select("facilityid", "fid", "upelev")


@query("""SELECT fid, 'DU_' || substr(code, 3) AS culvert FROM hydroobject WHERE starts_with(code, 'C_') AND code IN (SELECT trim(branch_id) FROM crosssection_location)""")
def culvert_of_branch(s: SparkSession, d: str) -> DataFrame:
    h = read(s, d, "hydroobject").filter(C.has_prefix(F.col("code"), ["C_"])).select("fid", "code")
    loc = read(s, d, "crosssection_location").select(F.expr("trim(branch_id)").alias("code")).distinct()
    return h.join(loc, "code", "left_semi").select("fid", F.concat(F.lit("DU_"), F.substr("code", F.lit(3))).alias("culvert"))


@query("SELECT o.facilityid, m.n + row_number() OVER (ORDER BY o.fid) AS objectid, o.fid FROM discharge_points o, (SELECT max(objectid) AS n FROM inlets) m WHERE o.dischrgtyp IS NULL")
def outfalls_to_inlets(s: SparkSession, d: str) -> DataFrame:
    o = read(s, d, "discharge_points").filter("dischrgtyp is null").select("fid", "facilityid")
    return K.inlets_from_outfalls(o, read(s, d, "inlets").select("objectid"))


@query("SELECT fid, CASE WHEN fid % 10 = 3 THEN 'RCP' ELSE material END AS material, CASE WHEN fid % 10 = 4 THEN 12.5 ELSE width END AS width FROM (SELECT fid, material, CASE WHEN isnan(width) THEN NULL ELSE width END AS width FROM gravity_mains)")
def update_by_key(s: SparkSession, d: str) -> DataFrame:
    t = read(s, d, "gravity_mains").select("fid", "material", C.finite(F.col("width")).alias("width"))
    changes = t.filter("fid % 10 = 3").select("fid", F.lit("material").alias("column"), F.lit("RCP").alias("value")).unionByName(t.filter("fid % 10 = 4").select("fid", F.lit("width").alias("column"), F.lit("12.5").alias("value")))
    return K.sparse_updates(t, changes)


@query("SELECT code FROM hydroobject WHERE code IS NOT NULL EXCEPT SELECT upper(trim(branch_id)) FROM crosssection_location")
def codes_without_sections(s: SparkSession, d: str) -> DataFrame:
    h = read(s, d, "hydroobject").filter("code is not null").select("code")
    known = read(s, d, "crosssection_location").select(F.upper(F.expr("trim(branch_id)")).alias("code"))
    return h.distinct().join(known.distinct(), "code", "left_anti")
