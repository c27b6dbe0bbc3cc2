"""Quantities recorded in different units.

Units are nodes of a graph, conversions its edges, each an affine function
y = scale * x + offset. Shortest compositions between all units of a dimension
are precomputed and every cycle is checked for consistency; data are converted
by an equi-join on (source unit, canonical unit) with that small table.

Which unit a cell is in comes from the whole data: what the remark says (named
units, negations, field words, or a value with its unit), the habit of the
crew in that load (median against the load's median), the value's own size and
decimals, and whether the measures of a row fit together. The most likely
combination of units of a row is taken.

Defined results for dirty input: NULL and NaN cells have no unit and no
canonical value, unless the remark gives the value; fillers have neither. A
cell without crew or load is judged by its value and remark alone. Repeated rows
each count; empty tables give empty results; other columns are kept apart.
"""

from __future__ import annotations

import itertools
import math
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import if_small, settled
from .fillers import FillerRules, by_form, short_nines

# The unit graph ----------------------------------------------------------------------------------

#: Defining conversions (source, target, scale, offset).
LENGTH_EDGES = [("ft", "in", 12.0, 0.0), ("in", "cm", 2.54, 0.0), ("m", "cm", 100.0, 0.0), ("cm", "mm", 10.0, 0.0), ("yd", "ft", 3.0, 0.0), ("ft", "m", 0.3048, 0.0)]
TEMPERATURE_EDGES = [("C", "F", 1.8, 32.0), ("C", "K", 1.0, 273.15)]


class UnitGraph:
    """All shortest compositions of a set of affine conversions."""

    def __init__(self, edges: list[tuple[str, str, float, float]], tolerance: float = 1e-9):
        step: dict[str, dict[str, tuple[float, float]]] = {}
        for a, b, s, o in edges:
            if s == 0 or not math.isfinite(s) or not math.isfinite(o):
                raise ValueError(f"{a} -> {b}: not invertible")
            step.setdefault(a, {})[b] = (s, o)
            step.setdefault(b, {})[a] = (1 / s, -o / s)
        self.table: dict[tuple[str, str], tuple[float, float]] = {}
        for start in step:
            self.table[start, start] = (1.0, 0.0)
            queue = deque([start])
            while queue:
                at = queue.popleft()
                s, o = self.table[start, at]
                for to, (s2, o2) in step[at].items():
                    if (start, to) not in self.table:
                        self.table[start, to] = (s * s2, o * s2 + o2)
                        queue.append(to)
        # every edge against every composition: a cycle is consistent if all of its edges agree with the table
        for (a, b), (s, o) in ((k, v) for x in step for k, v in (((x, y), v) for y, v in step[x].items())):
            for start in step:
                if (start, a) in self.table:
                    s1, o1 = self.table[start, a]
                    want = self.table[start, b]
                    got = (s1 * s, o1 * s + o)
                    if any(abs(x - y) > tolerance * max(1.0, abs(x), abs(y)) for x, y in zip(got, want)):
                        raise ValueError(f"inconsistent cycle at {a} -> {b} from {start}")

    def convert(self, x: float, source: str, target: str) -> float:
        s, o = self.table[source, target]
        return x * s + o

    def frame(self, spark: SparkSession) -> DataFrame:
        """source, target, scale, offset; units squared rows, so it may be broadcast."""
        return spark.createDataFrame([(a, b, s, o) for (a, b), (s, o) in self.table.items()], "source string, target string, scale double, offset double")


def to_canonical(df: DataFrame, graph: UnitGraph, value: str, unit: str, target: Column, out: str) -> DataFrame:
    """df with `out`, the value in the target unit, by an equi-join, NULL where unit or value is; and whether the composition found `converted` it."""
    t = F.broadcast(graph.frame(df.sparkSession).withColumnsRenamed({"source": "__source", "target": "__target"}))
    joined = df.withColumn("__to", target).join(t, (F.col(unit) == F.col("__source")) & (F.col("__to") == F.col("__target")), "left")
    other = (F.col("scale") != 1.0) | (F.col("offset") != 0.0)
    return joined.withColumn(out, F.col(value) * F.col("scale") + F.col("offset")).withColumn("converted", other).drop("__source", "__target", "__to", "scale", "offset")


# What remarks say --------------------------------------------------------------------------------

UNITS = ("ft", "m", "cm", "mm", "in")

#: How units are written in remarks (lower case); longer names first.
UNIT_WORDS = {
    "mm": r"millim\w*|mm",
    "cm": r"centim\w*|cm",
    "m": r"met(?:er|re|ers|res)|metric|m",
    "ft": r"feet|foot|ft",
    "in": r"inch(?:es)?|\"|in(?=\s*(?:[.,;)\]]|$))",
}
_ANY = "|".join(UNIT_WORDS[u] for u in ("mm", "cm", "m", "ft", "in"))
_NUMBER = r"[-+]?[0-9]+(?:[.,][0-9]+)?"


def _has(c: Column, words: str) -> Column:
    return c.rlike(rf'(?:^|[^a-z0-9])(?:{words})(?![a-z0-9])')


def said_unit(remark: Column) -> Column:
    """The unit a remark names outside measurements of other things; NULL if none.

    "not X" and "was X" name what is not the unit; a number with a unit is the
    size of something else, unless a field word leads it (see said_value).
    """
    c = F.lower(remark)
    c = F.regexp_replace(c, rf"\b(?:not|no)\s+(?:{_ANY})", " ")
    c = F.regexp_replace(c, r"\bwas\s.*$", " ")
    c = F.regexp_replace(c, rf"{_NUMBER}\s*(?:{_ANY})(?![a-z])", " ")
    # "metric" alone is metres, but a named unit beside it goes first
    plain = r"met(?:er|re|ers|res)|m"
    out = F.when(_has(c, UNIT_WORDS["mm"]), "mm").when(_has(c, UNIT_WORDS["cm"]), "cm").when(_has(c, plain), "m").when(_has(c, UNIT_WORDS["ft"]), "ft").when(_has(c, UNIT_WORDS["in"]) | c.rlike(r'["]\s*$'), "in").when(_has(c, "metric"), "m")
    return out


def said_field(remark: Column, words: str) -> Column:
    """Whether the remark names the field."""
    return _has(F.lower(remark), words)


def said_value(remark: Column, words: str) -> Column:
    """struct(value, unit) of a measurement of the field given in the remark; NULL if there is none."""
    c = F.lower(remark)
    pattern = rf"(?:^|[^a-z0-9])(?:{words})[^a-z0-9]{{0,5}}(?:(?:is|of|at|level|elev)[ .:=]{{1,3}})?({_NUMBER})\s*({_ANY})(?![a-z0-9])"
    value = F.regexp_replace(F.regexp_extract(c, pattern, 1), ",", ".").try_cast("double")
    word = F.regexp_extract(c, pattern, 2)
    unit = F.when(word.rlike(r"^(?:millim|mm)"), "mm").when(word.rlike(r"^(?:centim|cm)"), "cm").when(word.rlike(r"^(?:met|m$)"), "m").when(word.rlike(r"^(?:f)"), "ft").when(word != "", "in")
    return F.when(value.isNotNull() & unit.isNotNull(), F.struct(value.alias("value"), unit.alias("unit")))


# Which unit a cell is in --------------------------------------------------------------------------


@dataclass(frozen=True)
class Measure:
    """A measured column. spread: usual standard deviation of its logarithm; words: how remarks name it."""

    column: str
    canonical: str
    spread: float
    words: str


@dataclass(frozen=True)
class UnitRules:
    strange: float = 0.006  # prior share of cells in a unit their crew doesn't use and no remark names
    named: float = 0.97  # weight of a unit named for the field
    loose: float = 0.5  # weight of a unit named for no field in particular
    group_least: int = 8  # rows of a crew in a load for its habit to count
    #: Decimals to which values are recorded in each unit, and whether fewer of them count against it.
    decimals: tuple[tuple[str, int, bool], ...] = (("ft", 2, True), ("m", 3, True), ("cm", 1, True), ("mm", 0, True), ("in", 1, True))
    fit: float | None = None  # standard error of first = second + third measure, if they must fit


def _medians(cells: DataFrame) -> DataFrame:
    """of ('crew', 'load', 'all'), field, crew, load_id, mid, n: medians of values without a named unit, over each crew in a load, each load and all.

    One pass for the three of them; medians come from mergeable sketches, so a
    crew or load of any size is fine.
    """
    plain = cells.filter("said is null and x is not null")
    level = F.grouping_id("field", "load_id", "crew")
    sets = [[F.col("field"), F.col("load_id"), F.col("crew")], [F.col("field"), F.col("load_id")], [F.col("field")]]
    out = plain.groupingSets(sets, F.col("field"), F.col("load_id"), F.col("crew")).agg(F.percentile_approx("x", F.lit(0.5), F.lit(2000)).alias("mid"), F.count(F.lit(1)).alias("n"), level.alias("g"))
    return settled(out.select(F.when(F.col("g") == 0, "crew").when(F.col("g") == 1, "load").otherwise("all").alias("of"), "field", "crew", "load_id", "mid", "n"))


def _crew_units(medians: DataFrame, graph: UnitGraph, canonical: dict[str, str], rules: UnitRules) -> DataFrame:
    """field, crew, load_id, crew_unit: the unit whose factor explains a crew's median against the load's."""
    own = medians.filter("of = 'crew'").select("field", "crew", "load_id", "mid", "n")
    load = medians.filter("of = 'load'").select("field", "load_id", F.col("mid").alias("level"))
    both = own.join(load, ["field", "load_id"]).filter((F.col("n") >= rules.group_least) & (F.col("mid") > 0) & (F.col("level") > 0))
    choices = []
    for field, to in canonical.items():
        for u in UNITS:
            s = graph.table[u, to][0]
            choices.append(F.when(F.col("field") == field, F.struct(F.abs(F.log(F.col("mid") * F.lit(s) / F.col("level"))).alias("d"), F.lit(u).alias("u"))))
    return both.withColumn("best", F.array_min(F.array_compact(F.array(*choices)))).select("field", "crew", "load_id", F.col("best.u").alias("crew_unit"))


def resolve_units(df: DataFrame, measures: list[Measure], graph: UnitGraph, rules: UnitRules, fillers: FillerRules = FillerRules(), crew: str = "digitizedby", load: str = "load_id", remarks: str = "remarks", key: str = "fid") -> DataFrame:
    """fid, field, raw, unit, canonical_unit, value, from_remark: one row per cell that holds a measurement."""
    names = [m.column for m in measures]
    canonical = {m.column: m.canonical for m in measures}
    nines = short_nines(df, names, fillers)
    base = df.select(F.col(key).cast("bigint").alias("fid"), F.col(crew).alias("crew"), F.col(load).cast("bigint").alias("load_id"), F.col(remarks).alias("remark"), *names)
    said = base.withColumn("said", said_unit(F.col("remark")))
    named_any = F.lit(False)
    for m in measures:
        c = F.col(m.column).cast("double")
        empty = by_form(c, fillers)
        if nines[m.column]:
            empty = empty | c.isin(*nines[m.column])
        said = said.withColumn(f"{m.column}__named", F.coalesce(said_field(F.col("remark"), m.words), F.lit(False))).withColumn(f"{m.column}__given", F.when(c.isNull() | F.isnan(c), said_value(F.col("remark"), m.words)))
        said = said.withColumn(f"{m.column}__x", F.when(~empty, c))
        named_any = named_any | F.col(f"{m.column}__named")
    said = said.withColumn("named_any", named_any)

    cells = said.select("crew", "load_id", "said", F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col(f"{n}__x").alias("x")) for n in names])).alias("c")).select("crew", "load_id", "said", "c.field", "c.x")
    medians = _medians(cells)
    habits = _crew_units(medians, graph, canonical, rules)
    wide = habits.groupBy("crew", "load_id").agg(*[F.max(F.when(F.col("field") == n, F.col("crew_unit"))).alias(f"{n}__crew_unit") for n in names])
    # a load's level is its median, whatever the units of its crews
    levels = medians.filter("of = 'load'").groupBy("load_id").agg(*[F.max(F.when(F.col("field") == n, F.col("mid"))).alias(f"{n}__level") for n in names])
    overall = medians.filter("of = 'all'").agg(*[F.max(F.when(F.col("field") == n, F.col("mid"))).alias(f"{n}__usual") for n in names])
    # one row for a crew in a load, a load, and all: broadcast while there are few
    rows = said.join(if_small(wide), ["crew", "load_id"], "left").join(if_small(levels), ["load_id"], "left").join(F.broadcast(overall))

    factors = np.array([[graph.table[u, m.canonical][0] for u in UNITS] for m in measures])
    usual_decimals = {u: (d, fewer) for u, d, fewer in rules.decimals}
    combos = np.array(list(itertools.product(range(len(UNITS)), repeat=len(measures))))
    unit_index = {u: i for i, u in enumerate(UNITS)}
    home = [unit_index[m.canonical] for m in measures]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n = len(pdf)
            ll = np.zeros((n, len(measures), len(UNITS)))
            said_i = pdf["said"].map(unit_index).fillna(-1).to_numpy(dtype=int)
            xs = np.full((n, len(measures)), np.nan)
            for j, m in enumerate(measures):
                x = pdf[f"{m.column}__x"].to_numpy(dtype=float)
                xs[:, j] = x
                prior = np.full((n, len(UNITS)), rules.strange)
                crew_i = pdf[f"{m.column}__crew_unit"].map(unit_index).fillna(home[j]).to_numpy(dtype=int)
                prior[np.arange(n), crew_i] = 1.0
                named, any_named = pdf[f"{m.column}__named"].to_numpy(dtype=bool), pdf["named_any"].to_numpy(dtype=bool)
                weight = np.where(said_i < 0, 0.0, np.where(named, rules.named, np.where(any_named, rules.strange, rules.loose)))
                prior *= (1 - weight)[:, None]
                hit = said_i >= 0
                prior[np.flatnonzero(hit), said_i[hit]] += weight[hit]
                level = pdf[f"{m.column}__level"].fillna(pdf[f"{m.column}__usual"]).to_numpy(dtype=float)
                with np.errstate(divide="ignore", invalid="ignore"):
                    z = np.log(x[:, None] * factors[j][None, :] / level[:, None]) / m.spread
                    z = np.where(np.isfinite(z), z, 0.0)
                    got = np.full(n, 4)
                    for d in (3, 2, 1, 0):
                        got[np.abs(x * 10**d - np.round(x * 10**d)) < 1e-6 * np.maximum(1, np.abs(x) * 10**d)] = d
                    ll[:, j, :] = np.log(prior + 1e-9) - 0.5 * z * z
                for i, u in enumerate(UNITS):
                    if u in usual_decimals:
                        finer = got - usual_decimals[u][0]
                        ll[:, j, i] -= np.where(finer > 0, 6.0, -finer * math.log(10) * usual_decimals[u][1])
                ll[np.isnan(x), j, :] = np.where(np.arange(len(UNITS)) == home[j], 0.0, -50.0)
            total = sum(ll[:, j, :][:, combos[:, j]] for j in range(len(measures)))
            if rules.fit is not None:
                conv = [xs[:, j][:, None] * factors[j][combos[:, j]][None, :] for j in range(3)]
                span = conv[0] - conv[1]
                off = np.abs(span - conv[2])
                loose = (conv[2] > 0.5 * span) & (conv[2] < 1.1 * span)
                total += np.where(np.isnan(span + conv[2]), 0.0, np.where(off <= rules.fit * 3, 0.0, np.where(loose, -2.0, -5.0)))
            best = combos[np.argmax(total, axis=1)] if n else np.empty((0, len(measures)), dtype=int)
            units = np.array(UNITS, dtype=object)
            parts = []
            for j, m in enumerate(measures):
                ok = ~np.isnan(xs[:, j])
                parts.append(pd.DataFrame({"fid": pdf["fid"][ok], "field": m.column, "raw": xs[ok, j], "unit": units[best[ok, j]], "from_remark": False}))
                given = pdf[f"{m.column}__given"]
                at = given.notna().to_numpy()
                if at.any():
                    parts.append(pd.DataFrame({"fid": pdf["fid"][at], "field": m.column, "raw": [g["value"] for g in given[at]], "unit": [g["unit"] for g in given[at]], "from_remark": True}))
            yield pd.concat(parts, ignore_index=True)

    found = rows.mapInPandas(score, "fid bigint, field string, raw double, unit string, from_remark boolean")
    target = F.create_map(*[F.lit(v) for kv in canonical.items() for v in kv])[F.col("field")]
    return to_canonical(found, graph, "raw", "unit", target, "value").withColumn("canonical_unit", target)


#: The layers of the drainage network with their nominal units.
INLETS = [
    Measure("rimelev", "ft", 0.28, r"rim\w*|cover|r\.?l\.?|top|elev\w*"),
    Measure("invertelev", "ft", 0.32, r"inv\w*|i\.?l\.?|bottom|elev\w*"),
    Measure("depth", "ft", 0.45, r"d|dep\w*|deep"),
]
INLET_RULES = UnitRules(fit=0.04)
MAINS = [Measure("width", "in", 0.45, r"w|w/h|width|dia\w*|size|barrel|ø|box|dimensions")]
MAIN_RULES = UnitRules(loose=0.97, decimals=(("ft", 2, False), ("m", 3, True), ("cm", 1, True), ("mm", 0, False), ("in", 0, False)))


def recorded_units(tables: dict[str, DataFrame]) -> DataFrame:
    """layer, field, fid, raw, unit, value, canonical_unit, from_remark, converted for inlets (feet) and gravity mains (inches)."""
    graph = UnitGraph(LENGTH_EDGES)
    a = resolve_units(tables["inlets"], INLETS, graph, INLET_RULES).withColumn("layer", F.lit("inlets"))
    b = resolve_units(tables["gravity_mains"], MAINS, graph, MAIN_RULES).withColumn("layer", F.lit("gravity_mains"))
    return a.unionByName(b).select("layer", "field", "fid", "raw", "unit", "value", "canonical_unit", "from_remark", "converted")
