"""Problems 1 to 5 against brute force on small tables, and their behaviour on dirty and empty input."""

import datetime as dt
import math
import random
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillwork.operators import fill, near, orphans, profile, units
from rillwork.operators.fillers import FillerRules, crew_defaults
from rillwork.operators.ordered import range_sorted, running_sums

NAN = float("nan")


# Ordered scans ------------------------------------------------------------------------------------------


def test_running_sums_over_a_hot_key(spark):
    random.seed(1)
    rows = [("hot" if random.random() < 0.7 else f"k{random.randrange(9)}", k, float(random.randrange(5))) for k in range(3000)]
    df = spark.createDataFrame(rows, "k string, n bigint, v double").repartition(5)
    got = running_sums(range_sorted(df, ["k", "n"], partitions=7), "k", ["v"]).collect()
    sums, want = {}, {}
    for k, n, v in sorted(rows):
        sums[k] = sums.get(k, 0) + v
        want[k, n] = sums[k]
    assert {(r.k, r.n): r.run_v for r in got} == want


def test_running_sums_of_nothing(spark):
    df = spark.createDataFrame([], "k string, n bigint, v double")
    assert running_sums(range_sorted(df, ["k", "n"]), "k", ["v"]).count() == 0


def test_settled_rows_are_written_once_and_cleaned_up(spark):
    import gc
    import glob
    import time

    from rillwork.session import settled

    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir")
    there = lambda: set(glob.glob(folder.replace("file:", "") + "/**/rdd-*", recursive=True))
    before = there()
    kept = settled(spark.range(100).withColumn("r", F.rand()))
    a, b = kept.agg(F.sum("r")).first()[0], kept.agg(F.sum("r")).first()[0]
    new = (there() | {p for p in glob.glob(spark.sparkContext.getCheckpointDir().replace("file:", "") + "/**/rdd-*", recursive=True)}) - before
    assert a == b and new
    del kept
    for _ in range(40):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.25)
        if not any(glob.glob(p) for p in new):
            break
    assert not any(glob.glob(p) for p in new)


# Problem 1 ------------------------------------------------------------------------------------------------


def test_unit_graph_composes_and_checks_cycles():
    g = units.UnitGraph(units.LENGTH_EDGES)
    assert math.isclose(g.convert(1, "m", "ft"), 1 / 0.3048)
    assert math.isclose(g.convert(36, "in", "yd"), 1)
    t = units.UnitGraph(units.TEMPERATURE_EDGES)
    assert math.isclose(t.convert(t.convert(20, "C", "F"), "F", "K"), 293.15)
    with pytest.raises(ValueError):
        units.UnitGraph([("a", "b", 2.0, 0.0), ("b", "c", 2.0, 0.0), ("c", "a", 0.3, 0.0)])
    with pytest.raises(ValueError):
        units.UnitGraph([("a", "b", 0.0, 0.0)])


INLET = "fid bigint, rimelev double, invertelev double, depth double, digitizedby string, load_id bigint, remarks string, layer string, value double, unit string"


def _inlets(spark, rows):
    return spark.createDataFrame([(*r, "x", 0.0, "y") for r in rows], INLET)


def _usual(n=60):
    rnd = random.Random(3)
    out = []
    for k in range(n):
        rim = round(rnd.uniform(45, 80), 2)
        d = round(rnd.uniform(3, 10), 2)
        out.append((k, rim, round(rim - d, 2), d, "AAA", 1, None))
    return out


def test_units_of_inlets(spark):
    rows = _usual()
    rows += [(100 + k, float(round(r[1] * 304.8)), float(round(r[2] * 304.8)), float(round(r[3] * 304.8)), "MMM", 1, None) for k, r in enumerate(_usual(12))]
    rows += [
        (200, 18.288, 16.764, 1.524, "AAA", 1, "all values metres"),
        (201, 60.0, 55.0, 152.4, "AAA", 1, "d=cm"),
        (202, 60.0, 55.0, 5.0, "AAA", 1, "grate 60 cm wide"),
        (203, None, 55.0, 5.0, "AAA", 1, "RIM: 18.288 m (sheet)"),
        (204, None, 55.0, 5.0, "AAA", 1, "rim 60.0 ft"),
        (205, -1.0, -9999.0, 0.0, "AAA", 1, None),
        (206, NAN, None, None, None, None, None),
        (207, 60.0, 55.0, 5.0, "AAA", 1, "ft, was metres before"),
        (208, 1828.8, 55.0, 5.0, "AAA", 1, None),
        (208, 1828.8, 55.0, 5.0, "AAA", 1, None),
    ]
    g = units.UnitGraph(units.LENGTH_EDGES)
    got = units.resolve_units(_inlets(spark, rows), units.INLETS, g, units.INLET_RULES).collect()
    by = {(r.fid, r.field): r for r in got}
    assert all(by[k, "rimelev"].unit == "ft" for k in range(60))
    assert all(by[100 + k, f].unit == "mm" for k in range(12) for f in ("rimelev", "invertelev", "depth"))
    assert {by[200, f].unit for f in ("rimelev", "invertelev", "depth")} == {"m"}
    assert (by[201, "depth"].unit, by[201, "rimelev"].unit) == ("cm", "ft")
    assert by[202, "depth"].unit == by[207, "rimelev"].unit == "ft"
    assert by[203, "rimelev"].from_remark and by[203, "rimelev"].unit == "m" and math.isclose(by[203, "rimelev"].value, 60, abs_tol=1e-6)
    assert by[204, "rimelev"].unit == "ft"
    assert not any(k[0] in (205, 206) for k in by)
    assert by[208, "rimelev"].unit == "cm" and sum(r.fid == 208 for r in got) == 6


def test_units_of_nothing(spark):
    g = units.UnitGraph(units.LENGTH_EDGES)
    assert units.resolve_units(_inlets(spark, []), units.INLETS, g, units.INLET_RULES).count() == 0


@pytest.mark.parametrize(
    "remark, unit",
    [("not mm", None), ("W=cm not inches", "cm"), ("feet, not inches", "ft"), ("in place", None), ("W/H in.", "in"), ('depth "', "in"), ("sheet metric, cm", "cm"), ("metric survey", "m"), ("moved 3 m east", None), ("", None), (None, None), ("MM!", "mm"), ("niveaux en m", "m")],
)
def test_remarks(spark, remark, unit):
    assert spark.createDataFrame([(remark,)], "r string").select(units.said_unit(F.col("r"))).first()[0] == unit


# Problem 2 ------------------------------------------------------------------------------------------------


def test_propagation_keeps_observed_and_fills_from_the_nearest(spark):
    cells = spark.createDataFrame([("v", 1, 10.0, "a"), ("v", 2, None, "a"), ("v", 3, 20.0, "b"), ("v", 4, None, "c"), ("v", 5, None, None), ("v", 6, None, "a")], "field string, fid bigint, observed double, g string")
    hubs = {"v": [fill.Hub("g", F.col("g"), 1.0), fill.Hub("all", F.lit(1), 1.0, 1)]}
    got = {r.fid: r for r in fill.with_fills(cells, fill.propagate(fill.hub_edges(cells, hubs))).collect()}
    assert (got[1].value, got[1].filled, got[3].value) == (10.0, False, 20.0)
    assert got[2].filled and (got[2].value, got[6].value, got[4].value, got[5].value) == (10.0, 10.0, 15.0, 15.0)


def _exact(cells, groups, trust):
    """What the rounds settle at, as a system of equations. cells: value or None; groups: (weight, members)."""
    n = len(cells)
    steps = [None if v is None else 0 for v in cells]
    for r in range(1, n):
        for i in [i for i in range(n) if steps[i] is None and any(i in g and any(steps[j] == r - 1 for j in g) for _, g in groups)]:
            steps[i] = r
    a, b = np.eye(n), np.array([v if v is not None else 0.0 for v in cells])
    for i in range(n):
        if cells[i] is None and steps[i]:
            w = np.zeros(n)
            for k, g in groups:
                others = [j for j in g if i in g and j != i]
                for j in others:
                    w[j] += k * (steps[j] == 0)
                guess = [j for j in others if steps[j]]
                near = [j for j in guess if steps[j] == min(steps[m] for m in guess)]
                for j in near:
                    w[j] += k * trust ** (steps[j] - steps[i] + 1) / len(near)
            a[i] -= w / w.sum()
    return np.linalg.solve(a, b)


def test_propagation_settles_at_the_exact_solution(spark):
    # a chain between 0 and 9 with a side arm, links of two weights
    rows = [(0, 0.0, "a", None, None), (1, None, "a", "b", None), (2, None, "b", "c", "s"), (3, None, "c", "d", None), (4, 9.0, "d", None, None), (5, None, None, None, "s"), (6, None, None, "z", "s"), (7, None, None, "z", None)]
    cells = spark.createDataFrame([("v", *r) for r in rows], "field string, fid bigint, observed double, p string, q string, r string")
    hubs = {"v": [fill.Hub("l", F.col("p"), 1.0), fill.Hub("l", F.col("q"), 1.0), fill.Hub("s", F.col("r"), 5.0)]}
    got = {r.fid: r.value for r in fill.propagate(fill.hub_edges(cells, hubs), tol=1e-9).collect()}
    groups = [(1.0, [i for i, r in enumerate(rows) if k in r[2:4]]) for k in "abcdz"] + [(5.0, [2, 5, 6])]
    want = _exact([r[1] for r in rows], groups, fill.TRUST)
    assert all(abs(v - want[i]) < 1e-6 for i, v in got.items()) and set(got) == {1, 2, 3, 5, 6, 7}
    assert 0 < got[1] < 4.5 < got[3] < 9


def test_guesses_do_not_outweigh_what_is_observed(spark):
    # the other end of pipe 1 is 10; it shares a junction with pipe 2, of which nothing is known; the line is near 100
    cells = spark.createDataFrame([("up", 1, 10.0, "a"), ("down", 1, None, "b"), ("up", 2, None, "b"), ("down", 2, None, "c"), *[(f, k, 100.0, f"{f}{k}") for f in ("up", "down") for k in range(10, 30)]], "field string, fid bigint, observed double, junction string")
    level = [fill.Hub("junction", F.col("junction"), fill.JUNCTION), fill.Hub("pipe", F.col("fid"), 1.0), fill.Hub("line", F.lit(1), 1.0, 1)]
    got = {(r.field, r.fid): r.value for r in fill.propagate(fill.hub_edges(cells, {"up": level, "down": level})).collect()}
    assert all(abs(v - 10) < 0.01 for v in got.values()) and len(got) == 3


def test_near_values_come_before_the_line_mean(spark):
    # a line of about 95; apart from it: blank dead-end pipe 900 beside an end of 12, and blank pipes 911-913 in a row from an end of 10
    rows = [(k, 95.0, 95.0, "x%d" % k, "y%d" % k) for k in range(40)]
    rows += [(899, 95.0, 12.0, "f", "a"), (900, None, None, "a", "b"), (910, 95.0, 10.0, "g", "p"), (911, None, None, "p", "q"), (912, None, None, "q", "r"), (913, None, None, "r", "s")]
    cells = spark.createDataFrame([("up", f, u, a) for f, u, _, a, _ in rows] + [("down", f, w, b) for f, _, w, _, b in rows], "field string, fid bigint, observed double, junction string")
    level = [fill.Hub("junction", F.col("junction"), 10.0), fill.Hub("pipe", F.col("fid"), 1.0), fill.Hub("line", F.lit(1), 1.0, 1)]
    got = {(r.field, r.fid): r.value for r in fill.propagate(fill.hub_edges(cells, {"up": level, "down": level})).collect()}
    assert abs(got["up", 900] - 12) < 0.5 and abs(got["down", 900] - 12) < 0.5
    assert all(abs(got[f, k] - 10) < 1 for f in ("up", "down") for k in (911, 912, 913))


def test_categories(spark):
    rows = [("s", k, v, "a", None) for k, v in enumerate(["RND", "RND", "BOX", None])] + [("s", 9, None, None, None)]
    # a chain of blanks beside a box
    rows += [("s", 20, "BOX", "p", None), ("s", 21, None, "p", "q"), ("s", 22, None, "q", None)]
    cells = spark.createDataFrame(rows, "field string, fid bigint, observed string, g string, h string")
    hubs = {"s": [fill.Hub("g", F.col("g"), 1.0), fill.Hub("g", F.col("h"), 1.0)]}
    got = {r.fid: r for r in fill.with_fills(cells, fill.propagate(fill.hub_edges(cells, hubs, True), True)).collect()}
    assert (got[3].value, got[3].filled, got[9].value, got[9].filled) == ("RND", True, None, True)
    assert (got[21].value, got[22].value) == ("BOX", "BOX")


def test_hot_hubs_are_looked_up_alike(spark, monkeypatch):
    cells = spark.createDataFrame([("v", k, float(k) if k % 3 == 0 else None, "a" if k < 50 else "b") for k in range(60)], "field string, fid bigint, observed double, g string")
    edges = fill.hub_edges(cells, {"v": [fill.Hub("g", F.col("g"), 1.0)]})
    plain = {r.fid: r.value for r in fill.propagate(edges).collect()}
    monkeypatch.setattr(fill, "HOT", 10)
    hot = {r.fid: r.value for r in fill.propagate(edges).collect()}
    assert len(plain) == 40 and all(abs(plain[k] - hot[k]) < 1e-9 for k in plain)


MAIN = "fid bigint, upelev double, downelev double, width double, digitizedby string, load_id bigint, facilityid string, remarks string, mainshape string, value string, geometry array<struct<x:double,y:double>>"


def _mains(spark, rows):
    return spark.createDataFrame([(*r, None, None, "clash", [{"x": float(r[0]), "y": 0.0}, {"x": float(r[0] + 1), "y": 0.0}] if r[0] % 7 else None) for r in rows], MAIN)


DRAIN = "fid bigint, objectid double, facilityid string, width double, depth double, digitizedby string, load_id bigint"


def test_every_kind_of_missing_cell_is_filled(spark):
    rows = [(k, 50.0 - k * 0.1, 49.9 - k * 0.1, 24.0 if k % 2 else 30.0, "A", 1, "L1") for k in range(1, 40)]
    rows += [(40, None, NAN, -1.0, "A", 1, "L1"), (41, 0.0, -9999.0, 9999.0, None, None, None), (42, 45.0, 45.0, None, "A", 1, "  ")]
    # one crew enters a value of its own where it measured nothing
    rows += [(50 + k, 41.3, 41.3, 24.0, "B", 2, "L2") for k in range(20)] + [(80 + k, 60.0 + k * 0.3, 59.9 + k * 0.3, 24.0, "B", 2, "L2") for k in range(20)]
    drains = spark.createDataFrame([(1, 1.0, "S", 10.0, 4.0, "A", 1), (2, 1.0, "S", 10.0, NAN, "A", 1), (3, None, None, None, None, None, None)], DRAIN)
    got = fill.fill_network(_mains(spark, rows), drains).collect()
    flagged = {(r.field, r.fid) for r in got if r.filled}
    want = {("upelev", 40), ("downelev", 40), ("width", 40), ("upelev", 41), ("downelev", 41), ("width", 41), ("width", 42), ("depth", 2), ("depth", 3)}
    want |= {(f, 50 + k) for f in ("upelev", "downelev") for k in range(20)}
    assert flagged == want
    assert all(r.value is not None for r in got if r.filled)
    assert len(got) == 3 * len(rows) + 3
    v = {(r.field, r.fid): r.value for r in got}
    assert abs(v["upelev", 40] - (49.9 - 3.9)) < 0.5


def test_observed_shapes_stay_and_widths_fill(spark):
    # a pipe without a line takes the shape of pipes as wide, not that of most
    given = {1: "ELLIPSE", 2: "RND?", 3: "BX", 4: "RN D", 5: "odd"}
    shapes = given | {k: "RND" for k in range(6, 60)} | {k: "BOX" for k in range(60, 80)} | {90: None, 91: "N/A", 92: "0", 93: " ", 95: None}
    rows = [(k, 50.0, 49.0, 96.0 if 60 <= k < 80 or k == 95 else 12.0, "A", 1, None if k == 95 else "L1" if k < 60 or k >= 90 else "L2") for k in shapes]
    mains = _mains(spark, rows).drop("mainshape").join(spark.createDataFrame(list(shapes.items()), "fid bigint, mainshape string"), "fid")
    got = {r.fid: (r.value, r.filled) for r in fill.fill_shapes(mains).collect()}
    assert [got[k] for k in given] == [("ELL", False), ("RND", False), ("BOX", False), ("RND", False), ("ODD", False)]
    assert [got[k] for k in (90, 91, 92, 93)] == [("RND", True)] * 4 and got[95] == ("BOX", True)


def test_fill_of_nothing(spark):
    assert fill.fill_network(_mains(spark, []), spark.createDataFrame([], DRAIN)).count() == 0


def test_crew_defaults(spark):
    rows = [("d", "A", 4.27) for _ in range(30)] + [("d", "A", 3.0 + k / 100) for k in range(30)] + [("d", "B", 2.0 + k / 10) for k in range(60)] + [("d", None, 4.27)] * 9
    assert [tuple(r) for r in crew_defaults(spark.createDataFrame(rows, "field string, crew string, value double"), FillerRules()).collect()] == [("d", "A", 4.27)]


# Problem 3 ------------------------------------------------------------------------------------------------


def _day(k):
    return dt.datetime(2020, 1, 1) + dt.timedelta(days=k) if k is not None else None


def test_dangling_references_against_brute_force(spark):
    rnd = random.Random(5)
    keys = [f"{{{k:08X}-0000-0000-0000-000000000001}}" for k in range(12)]
    parents = [(k, rnd.choice(keys[:9]), _day(rnd.choice([None, *range(40)])), _day(rnd.choice([None, None, *range(40)])), "x") for k in range(60)]
    wild = lambda k: rnd.choice([k, k.lower(), k.strip("{}"), f" {k}\t", k])
    children = [(k, rnd.choice([None, "", "  ", "{00000000-0000-0000-0000-000000000000}", keys[0], *map(wild, keys)]), _day(rnd.choice([None, *range(45)])), "y") for k in range(400)]
    c = spark.createDataFrame(children, "fid bigint, pid string, load_ts timestamp_ntz, k string")
    p = spark.createDataFrame(parents, "fid bigint, gid string, load_ts timestamp_ntz, deleted_at timestamp_ntz, t string")
    got = {r.child_fid: r.reason for r in orphans.dangling({"c": c, "p": p}, [orphans.Reference("c", "pid", "p", "gid")], partitions=5).collect()}
    norm = lambda s: (s or "").strip().strip("{}").strip().upper()
    want = {}
    for fid, ref, t, _ in children:
        r = norm(ref)
        if not r or r == orphans.ZERO_GUID:
            continue
        mine = [(s, e) for _, g, s, e, _ in parents if norm(g) == r and s is not None and (e is None or e > s)]
        if t is not None and any(s <= t and (e is None or e > t) for s, e in mine):
            continue
        want[fid] = "missing" if not mine else "undated" if t is None else "withdrawn" if any(s <= t for s, _ in mine) else "late"
    assert got == want


def test_dangling_of_empty_tables(spark):
    c = spark.createDataFrame([], "fid bigint, pid string, load_ts timestamp_ntz")
    p = spark.createDataFrame([], "fid bigint, gid string, load_ts timestamp_ntz, deleted_at timestamp_ntz")
    ref = [orphans.Reference("c", "pid", "p", "gid", guid=False)]
    assert orphans.dangling({"c": c, "p": p}, ref).count() == 0
    one = spark.createDataFrame([(1, "A|B", _day(1))], c.schema)
    assert [tuple(r)[:3] for r in orphans.dangling({"c": one, "p": p}, ref).collect()] == [("c", 1, "A|B")]


# Problem 4 ------------------------------------------------------------------------------------------------


def _pts(spark, rows):
    return spark.createDataFrame(rows, "id bigint, x double, y double")


def _cloud(n, seed):
    rnd = random.Random(seed)
    # a third in one spot, some on cell borders, some unusable
    out = []
    for k in range(n):
        if k % 3 == 0:
            out.append((k, 1000.0 + rnd.random() * 3, 2000.0 + rnd.random() * 3))
        elif k % 3 == 1:
            out.append((k, 1000.0 + rnd.randrange(60) * 0.5, 2000.0 + rnd.randrange(60) * 0.5))
        else:
            out.append((k, -5.0 + rnd.random() * 10, -5.0 + rnd.random() * 10))
    return out + [(n, None, 1.0), (n + 1, NAN, 1.0), (n + 2, float("inf"), 0.0), (n + 3, 1e12, -1e12), (n + 4, 1e12, -1e12)]


def _ok(p):
    return p[1] is not None and p[2] is not None and math.isfinite(p[1]) and math.isfinite(p[2])


@pytest.mark.parametrize("radius", [0.0, 0.5, 2.0, 7.3])
def test_points_within_against_brute_force(spark, radius):
    pts = _cloud(240, 7)
    got = near.points_within(_pts(spark, pts), near.SortedPoints(_pts(spark, pts), partitions=6), radius, same=True)
    want = {(a[0], b[0]) for a in pts for b in pts if a[0] < b[0] and _ok(a) and _ok(b) and math.hypot(a[1] - b[1], a[2] - b[2]) <= radius}
    rows = [(r.id1, r.id2) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_split_parts_lose_nothing(spark):
    pts = _cloud(300, 8)
    sp = near.SortedPoints(_pts(spark, pts), partitions=4)

    def refine(region, rows, ids, xs, ys):
        import numpy as np
        import pandas as pd

        d = np.hypot(xs - region["x"].to_numpy()[rows], ys - region["y"].to_numpy()[rows])
        return pd.DataFrame({"id1": region["id"].to_numpy()[rows][d <= 3], "id2": ids[d <= 3], "distance": d[d <= 3]})

    a = near.range_join(near.disc_ranges(_pts(spark, pts), 3.0), sp, refine, near.PAIR, part_rows=40).select("id1", "id2").collect()
    b = near.points_within(_pts(spark, pts), sp, 3.0).select("id1", "id2").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_lines_and_regions_against_brute_force(spark):
    rnd = random.Random(9)
    pts = [(k, rnd.uniform(0, 100), rnd.uniform(0, 100)) for k in range(300)]
    lines = [(500 + k, [{"x": rnd.uniform(0, 100), "y": rnd.uniform(0, 100)} for _ in range(rnd.choice([1, 2, 4]))]) for k in range(20)]
    lines += [(600, None), (601, []), (602, [{"x": NAN, "y": 1.0}]), (603, [{"x": 5.0, "y": 5.0}, {"x": 5.0, "y": 5.0}]), (604, [{"x": 1.0, "y": 1.0}, None, {"x": 90.0, "y": 90.0}])]
    geom = spark.createDataFrame(lines, "id bigint, geometry array<struct<x:double,y:double>>")
    sp = near.SortedPoints(_pts(spark, pts), partitions=3)

    def dist(p, v):
        v = [(q["x"], q["y"]) for q in v or [] if q is not None and math.isfinite(q["x"])]
        best = math.inf
        for (ax, ay), (bx, by) in zip(v, v[1:] or v):
            n2 = (bx - ax) ** 2 + (by - ay) ** 2
            t = max(0, min(1, ((p[1] - ax) * (bx - ax) + (p[2] - ay) * (by - ay)) / n2)) if n2 else 0
            best = min(best, math.hypot(p[1] - ax - t * (bx - ax), p[2] - ay - t * (by - ay)))
        return best

    got = {(r.id1, r.id2): r.distance for r in near.lines_within(geom, sp, 4.0, piece=9.0).collect()}
    want = {(i, p[0]): dist(p, v) for i, v in lines for p in pts if dist(p, v) <= 4}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], abs_tol=1e-9) for k in want)

    ring = lambda *q: [{"x": float(x), "y": float(y)} for x, y in q]
    areas = [(1, [ring((10, 10), (80, 15), (70, 90), (5, 60)), ring((30, 30), (30, 50), (50, 50), (50, 30))]), (2, [ring((0, 0), (100, 0), (100, 100.5), (0, 100.5), (0, 0))]), (3, [ring((1, 1), (2, 2))]), (4, None), (5, [])]
    regions = spark.createDataFrame(areas, "id bigint, geometry array<array<struct<x:double,y:double>>>")
    inside = {(r.id1, r.id2) for r in near.regions_containing(regions, sp).collect()}

    def within(p, rings):
        n = 0
        for r in rings or []:
            for a, b in zip(r, r[1:] + r[:1]):
                if (a["y"] > p[2]) != (b["y"] > p[2]) and p[1] < (b["x"] - a["x"]) * (p[2] - a["y"]) / (b["y"] - a["y"]) + a["x"]:
                    n += 1
        return n % 2 == 1

    assert inside == {(i, p[0]) for i, r in areas for p in pts if i != 3 and within(p, r)}


def test_near_of_nothing(spark):
    none = _pts(spark, [])
    assert near.points_within(none, near.SortedPoints(none), 1.0).count() == 0
    some = _pts(spark, [(1, 0.0, 0.0)])
    assert near.points_within(some, near.SortedPoints(none), 1.0).count() == 0
    assert near.points_within(none, near.SortedPoints(some), 1.0).count() == 0


# Problem 5 ------------------------------------------------------------------------------------------------

FIELDS = [profile.Field("t", "code", False, ("A", "B", "C")), profile.Field("t", "x", True, low=0.0, high=100.0)]


def _loads(spark, rows):
    return {"t": spark.createDataFrame(rows, "load_id bigint, code string, x double, layer string, n bigint")}


def test_profile_against_brute_force(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice([1, 2, 3, None]), rnd.choice(["A", "B", " ", "", None, "Q"]), rnd.choice([None, NAN, -0.0, 0.0, rnd.uniform(-20, 130), 5.0]), "z", 1) for _ in range(900)]
    got = {(r.field, r.load_id): r for r in profile.profile(_loads(spark, rows), FIELDS, partitions=5).collect()}
    for load in (1, 2, 3, None):
        mine = [r for r in rows if r[0] == load]
        x = sorted(v[2] for v in mine if v[2] is not None and not math.isnan(v[2]))
        g = got["x", load]
        assert (g.rows, g.missing, g.distinct_values, g.off) == (len(mine), len(mine) - len(x), len(set(x)), sum(not 0 <= v <= 100 for v in x))
        assert math.isclose(g.p50, median(x), abs_tol=1e-9) and g.least == x[0] and g.greatest == x[-1]
        c = [v[1] for v in mine if v[1] and v[1].strip()]
        g = got["code", load]
        assert (g.missing, g.distinct_values, g.off, g.p50) == (len(mine) - len(c), len(set(c)), sum(v == "Q" for v in c), None)


def test_drift_is_the_exact_distance(spark):
    rnd = random.Random(4)
    a, b = [rnd.gauss(0, 1) for _ in range(300)], [rnd.gauss(0.6, 1) for _ in range(200)]
    rows = [(1, None, v, "z", 1) for v in a] + [(5, None, v, "z", 1) for v in b] + [(3, "A", None, "z", 1)]
    got = profile.drift(_loads(spark, rows), FIELDS, partitions=4).collect()
    want = max(abs(sum(v <= t for v in a) / len(a) - sum(v <= t for v in b) / len(b)) for t in a + b)
    assert [(r.load_id, r.previous_id) for r in got] == [(5, 1)] and math.isclose(got[0].ks, want, abs_tol=1e-9)


def test_loads_that_break_the_profile(spark):
    rows = []
    for load in range(1, 8):
        for k in range(100):
            code, x = "AAAAABBBCC"[k % 10], 10.0 + k % 9
            if load == 2 and k < 40:
                code = None
            if load == 3 and k < 30:
                code = "zz"
            if load == 4 and k < 30:
                x = 999.0
            if load == 5:
                x += 20
            if load == 6:
                code = "C"
            rows.append((load, code, x, "z", 1))
    got = {(r.field, r.load_id, r.kind) for r in profile.breaking_loads(_loads(spark, rows), FIELDS).collect()}
    assert got == {("code", 2, "nulls"), ("code", 3, "domain"), ("x", 4, "range"), ("x", 5, "shift"), ("code", 6, "shift")}


def test_profile_of_nothing(spark):
    t = _loads(spark, [])
    assert profile.profile(t, FIELDS).count() == profile.drift(t, FIELDS).count() == profile.breaking_loads(t, FIELDS).count() == 0
