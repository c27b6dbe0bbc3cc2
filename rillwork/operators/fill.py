"""Filling missing values from similar records by label propagation.

Cells are nodes; the groups they belong to (a junction, a pipe, a line, a
system, a load, everything) are hubs that stand for the edges between all
members, so a group of n records costs n edges, not n squared.

Near hubs (tier 0) make up the graph that values run along. A missing cell is
the weighted mean of what its hubs hold besides itself: every observed cell,
clamped, with the weight of the hub; and the mean of those estimates in the hub
that are the fewest steps from an observed cell. Such a mean has the weight of
the hub if these are nearer to an observed cell than the cell itself, TRUST
times that if they are as near, and TRUST squared times that if they are
farther. So estimates never outvote what they were made from, however many
there are, and a cell's own part never comes back to it. The rounds end when no
value moves by more than a tolerance; as every cell leans towards those nearer
to an observed one, they converge geometrically. Cells whose hubs hold no other
missing cell are final at once and take no part in the rounds.

Far hubs (tiers 1, 2, ...) are priors outside the rounds: a cell that the near
hubs don't reach takes the weighted mean, over observed cells, of its hubs of
the lowest tier that holds any.

Hot groups: hubs are aggregated with partial sums on the map side, and hubs with
many missing members - there can be few of these - are looked up by broadcast
instead of by a join on their key.

Defined results for dirty input: a NULL key joins no hub; cells of a column with
no observed value at all stay NULL, and are marked as filled all the same;
repeated rows are separate records of the same group; empty tables give empty
results; further columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import if_small, settled
from .fillers import FillerRules, by_form, crew_defaults, short_nines
from .units import LENGTH_EDGES, MAIN_RULES, MAINS, UnitGraph, resolve_units

#: Weight of estimates as far from an observed cell as the one they tell, against nearer ones.
TRUST = 0.1
#: A hub with more missing members than this is looked up by broadcast.
HOT = 200_000


@dataclass(frozen=True)
class Hub:
    """A kind of group: key (NULL: no member), weight of its edges, and tier: 0 for a hub values run along, else the rank as a prior."""

    kind: str
    key: Column
    weight: float
    tier: int = 0


def hub_edges(cells: DataFrame, hubs: dict[str, list[Hub]], categorical: bool = False) -> DataFrame:
    """One row for each cell and hub: field, fid, label, value, missing, hub, weight, tier.

    cells: field, fid, observed (double, or string if categorical; NULL where
    missing) and what the hub keys use. Hubs of different fields are apart unless
    their kind and key agree, which lets fields share them. A hub is named by a
    64-bit hash of its kind and key; should two of billions share one, a few means
    mix, but no cell is lost or takes part twice.
    """
    there = F.col("observed").isNotNull()
    out = None
    for field, of_field in hubs.items():
        made = F.array_distinct(F.array_compact(F.array(*[F.when(h.key.isNotNull(), F.struct(F.xxhash64(F.lit(h.kind), h.key.cast("string")).alias("hub"), F.lit(float(h.weight)).alias("weight"), F.lit(int(h.tier)).alias("tier"))) for h in of_field])))
        out = F.when(F.col("field") == field, made) if out is None else out.when(F.col("field") == field, made)
    nodes = cells.select("field", "fid", (F.col("observed") if categorical else F.lit("")).alias("label"), (F.when(there, F.lit(1.0)) if categorical else F.col("observed")).alias("value"), (~there).alias("missing"), F.explode(out).alias("e"))
    return nodes.select("field", "fid", "label", "value", "missing", "e.hub", "e.weight", "e.tier")


CELL = ["field", "fid"]


def _looked_up(edges: DataFrame, hubs: DataFrame) -> DataFrame:
    """edges with what is known of their hub (hub, missing_in, ...); hubs that many edges lead to are broadcast, the others joined.

    There are at most as many hot hubs as HOT goes into the number of edges.
    """
    hot = settled(hubs.filter(F.col("missing_in") > HOT))
    if hot.isEmpty():
        return edges.join(hubs, "hub")
    few = if_small(hot)
    return edges.join(hubs.filter(F.col("missing_in") <= HOT), "hub").unionByName(edges.join(few, "hub"))


def propagate(edges: DataFrame, categorical: bool = False, tol: float = 0.01, trust: float = TRUST) -> DataFrame:
    """field, fid, value (or label): what label propagation over hub_edges gives the missing cells.

    tol: the rounds end when no value (or share of a category) moves by more.
    Each round is written to the checkpoint folder, so plans stay small and a
    lost executor costs one round.
    """
    near = edges.filter("tier = 0")
    # one pass over all near edges: what is observed in each hub that misses something
    per_label = near.groupBy("hub", "label").agg(F.sum("value").alias("total"), F.count("value").alias("n"), F.count_if("missing").alias("missing_in"))
    if categorical:
        # missing cells are the rows without a label
        of_hub = Window.partitionBy("hub")
        per_label = per_label.withColumn("missing_in", F.sum("missing_in").over(of_hub))
    clamped = settled(per_label.filter("missing_in > 0"))
    loose = near.filter("missing").select(*CELL, "hub", "weight")
    seen = _looked_up(loose, clamped).filter("n > 0 or missing_in > 1")
    at = settled(seen.groupBy(*CELL, "hub", "weight").agg(F.collect_list(F.when(F.col("n") > 0, F.struct("label", "total", "n"))).alias("known"), F.max("missing_in").alias("missing_in")) if categorical else seen.select(*CELL, "hub", "weight", F.when(F.col("n") > 0, F.array(F.struct("label", "total", "n"))).alias("known"), "missing_in"))
    base = at.select(*CELL, "weight", F.inline("known")).groupBy(*CELL, "label").agg(F.sum(F.col("weight") * F.col("total")).alias("top"), F.sum(F.col("weight") * F.col("n")).alias("bottom"))
    base = settled(base)
    links = settled(at.filter("missing_in > 1").select(*CELL, "hub", "weight"))
    touched = settled(links.select(*CELL).distinct())
    crowds = links.groupBy("hub").agg(F.count(F.lit(1)).alias("missing_in"))
    hot = (crowds.agg(F.max("missing_in")).first()[0] or 0) > HOT
    whole = Window.partitionBy(*CELL)

    def valued(sums: DataFrame) -> DataFrame:
        """Values from sums (field, fid, label, top, bottom, ...); a category's value is its share."""
        bottom = F.sum("top").over(whole) if categorical else F.col("bottom")
        return sums.withColumn("value", F.col("top") / bottom)

    # cells that no other missing cell touches are done
    done = valued(base.join(touched, CELL, "left_anti")).select(*CELL, "label", "value")
    active = settled(base.join(touched, CELL, "left_semi"))
    now = settled(valued(active).select(*CELL, "label", "value", F.lit(1).alias("steps")))
    none = lambda t: F.lit(None).cast(t)
    even, first_even = F.col("steps") % 2 == 0, F.col("least") % 2 == 0
    of_hub = Window.partitionBy("hub")
    linked = not links.isEmpty()
    while linked:
        # the members of a hub are the same number of steps from an observed cell, or one more
        held = now.join(links, CELL).groupBy("hub", "label").agg(F.min("steps").alias("least"), *[f for n, c in (("e", even), ("o", ~even)) for f in (F.sum(F.when(c, F.col("value"))).alias(f"x{n}"), (F.sum(F.when(c, F.col("value"))) if categorical else F.count(F.when(c, F.col("value")))).alias(f"n{n}"))])
        if categorical:
            held = held.withColumns({"least": F.min("least").over(of_hub), "ne": F.sum("ne").over(of_hub), "no": F.sum("no").over(of_hub)})
        sides = {c: F.coalesce(F.when(first_even, F.col(a)).otherwise(F.col(b)), F.lit(0.0)) for c, a, b in (("x1", "xe", "xo"), ("n1", "ne", "no"), ("x2", "xo", "xe"), ("n2", "no", "ne"))}
        held = held.select("hub", "label", "least", *[v.alias(c) for c, v in sides.items()])
        steps = now.groupBy(*CELL).agg(F.min("steps").alias("steps")) if categorical else now.select(*CELL, "steps")
        mine = links.join(steps, CELL, "left")
        pair = (_looked_up(mine, settled(held.join(crowds, "hub"))) if hot else mine.join(held, "hub")).withColumn("n1", F.round("n1", 6))
        among = F.col("steps") == F.col("least")
        alone = among & (F.col("n1") <= 1)
        n = F.when(alone, F.col("n2")).when(among, F.col("n1") - 1).otherwise(F.col("n1"))
        w = F.col("weight") * F.when(alone, trust * trust).when(among, trust).otherwise(1.0)
        parts = pair.withColumns({"n": n, "w": w}).filter("n > 1e-9").select(*CELL, "label", (F.col("w") * F.when(alone, F.col("x2")).otherwise(F.col("x1")) / F.col("n")).alias("top"), F.col("w").alias("bottom"), F.when(among & ~alone, F.col("w") / F.col("n")).alias("own"), F.when(F.col("steps").isNull(), F.col("least") + 1).alias("reach"), none("int").alias("steps"), none("double").alias("old"))
        own = now.select(*CELL, "label", none("double").alias("top"), none("double").alias("bottom"), none("double").alias("own"), none("int").alias("reach"), "steps", F.col("value").alias("old"))
        fixed = active.select(*CELL, "label", "top", "bottom", none("double").alias("own"), none("int").alias("reach"), none("int").alias("steps"), none("double").alias("old"))
        sums = parts.unionByName(own).unionByName(fixed).groupBy(*CELL, "label").agg(F.sum("top").alias("top"), F.sum("bottom").alias("bottom"), F.coalesce(F.sum("own"), F.lit(0.0)).alias("own"), F.min("reach").alias("reach"), F.max("steps").alias("steps"), F.max("old").alias("old"))
        sums = sums.withColumn("top", F.col("top") - F.col("own") * F.coalesce("old", F.lit(0.0)))
        if categorical:
            sums = sums.withColumns({"steps": F.max("steps").over(whole), "reach": F.min("reach").over(whole), "top": F.greatest("top", F.lit(0.0))})
        after = settled(valued(sums).select(*CELL, "label", F.coalesce("value", "old").alias("value"), F.coalesce("steps", "reach").alias("steps"), "old"))
        moved = after.agg(F.max(F.when(F.col("old").isNull(), F.lit(float("inf"))).otherwise(F.abs(F.col("value") - F.col("old")))).alias("most")).first()["most"]
        now = after.drop("old")
        linked = moved is not None and moved > tol
    near_found = settled(done.unionByName(now.select(*CELL, "label", "value")))

    far = settled(edges.filter("missing and tier > 0").select(*CELL, "hub", "weight", "tier").join(near_found.select(*CELL).distinct(), CELL, "left_anti"))
    wanted = far.groupBy("hub").agg(F.count(F.lit(1)).alias("missing_in"))
    prior = edges.filter("not missing and tier > 0").groupBy("hub", "label").agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("n")).join(wanted, "hub")
    if categorical:
        prior = prior.withColumn("n", F.sum("n").over(Window.partitionBy("hub")))
    prior = settled(prior.select("hub", "label", (F.col("total") / F.col("n")).alias("mean"), "missing_in"))
    from_far = _looked_up(far, prior).groupBy(*CELL, "tier", "label").agg((F.sum(F.col("weight") * F.col("mean")) / (F.lit(1.0) if categorical else F.sum("weight"))).alias("value"))
    first = from_far.groupBy(*CELL).agg(F.min("tier").alias("tier"))
    found = near_found.unionByName(from_far.join(first, [*CELL, "tier"]).select(*CELL, "label", "value"))
    if categorical:
        return found.groupBy(*CELL).agg(F.max_by("label", F.struct(F.round("value", 9), "label")).alias("label"))
    return found.select(*CELL, "value")


def with_fills(cells: DataFrame, got: DataFrame, keys: tuple[str, ...] = ("field", "fid")) -> DataFrame:
    """keys, value, filled: observed cells as they are, missing ones with what was found, flagged.

    Every missing cell comes out, even where there was nothing to fill it from.
    """
    name = "label" if "label" in got.columns else "value"
    kept = cells.filter("observed is not null").select(*keys, F.col("observed").alias("value"), F.lit(False).alias("filled"))
    lost = cells.filter("observed is null").select(*keys).join(got, list(keys), "left").select(*keys, F.col(name).alias("value"), F.lit(True).alias("filled"))
    return kept.unionByName(lost)


#: Weight of a junction, where ends meet at one level, against that of a pipe between its ends.
JUNCTION = 5.0

# The layers of the drainage network ----------------------------------------------------------------


def _blank(c: Column) -> Column:
    return F.when(F.trim(c) != "", F.trim(c))


def _measured(df: DataFrame, fields: list[str], rules: FillerRules) -> DataFrame:
    """df with fillers of all kinds in the fields as NULL; one row for each of df."""
    nines = short_nines(df, fields, rules)
    out = df
    for f in fields:
        c = F.col(f).cast("double")
        empty = by_form(c, rules) | (c.isin(*nines[f]) if nines[f] else F.lit(False))
        out = out.withColumn(f, F.when(~empty, c))
    long = out.select("crew", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("c")).select("crew", "c.field", "c.value").filter("value is not null")
    default = if_small(crew_defaults(long, rules))
    for f in fields:
        own = default.filter(F.col("field") == f).select(F.col("crew").alias("__crew"), F.col("value").alias("__value"))
        out = out.join(own, (F.col("crew") == F.col("__crew")) & (F.col(f) == F.col("__value")), "left").withColumn(f, F.when(F.col("__value").isNull(), F.col(f))).drop("__crew", "__value")
    return out


def _cells(df: DataFrame, fields: list[str]) -> DataFrame:
    """One row for each cell of the fields: field, observed, blank_beside (whether another of them is missing in the row), and the other columns."""
    others = [c for c in df.columns if c not in fields]
    cell = [F.struct(F.lit(f).alias("field"), F.col(f).alias("observed"), F.coalesce(*[F.when(F.col(g).isNull(), F.lit(True)) for g in fields if g != f], F.lit(False)).alias("blank_beside")) for f in fields]
    return df.select(*others, F.explode(F.array(*cell)).alias("c")).select(*others, "c.*")


def _end(which: int) -> Column:
    p = F.element_at("geometry", which)
    at = F.concat_ws(",", F.round(p["x"], 2), F.round(p["y"], 2))
    return F.when((F.size("geometry") > 0) & p["x"].isNotNull() & p["y"].isNotNull(), at)


def _main_cells(mains: DataFrame) -> list[tuple[DataFrame, dict[str, list[Hub]]]]:
    """Cells and hubs of upelev, downelev (feet) and width (inches).

    Elevations: pipes of a line share the level of the junction where their ends
    meet; the two ends of a pipe are alike; then the line, the load, all. Width:
    pipes that meet, the line, the load, all.
    """
    # keys as numbers: they are written between rounds
    line = _blank(F.col("facilityid"))
    met = lambda k: F.when(_end(k).isNotNull(), F.xxhash64(line, _end(k)))
    base = mains.select("fid", "upelev", "downelev", F.col("digitizedby").alias("crew"), "load_id", F.when(line.isNotNull(), F.xxhash64(line)).alias("line"), met(1).alias("start"), met(-1).alias("end"))
    ends = _cells(_measured(base, ["upelev", "downelev"], FillerRules(negatives_measure=True)).drop("crew"), ["upelev", "downelev"])
    level = [
        Hub("junction", F.when(F.col("field") == "upelev", F.col("start")).otherwise(F.col("end")), JUNCTION),
        # two observed ends have nothing to tell each other
        Hub("pipe", F.when(F.col("blank_beside") | F.col("observed").isNull(), F.col("fid")), 1.0),
        Hub("line", F.col("line"), 1.0, 1),
        Hub("load", F.col("load_id"), 1.0, 2),
        Hub("all", F.lit(1), 1.0, 3),
    ]
    known = resolve_units(mains, MAINS, UnitGraph(LENGTH_EDGES), MAIN_RULES).filter("not from_remark").select(F.col("fid").alias("k_fid"), F.col("value").alias("observed"))
    widths = base.select("fid", "line", "load_id", "start", "end").join(known, F.col("fid") == F.col("k_fid"), "left").drop("k_fid").withColumn("field", F.lit("width"))
    size = [Hub("meet", F.col("start"), 1.0), Hub("meet", F.col("end"), 1.0), Hub("w-line", F.col("line"), 1.0, 1), Hub("w-load", F.col("load_id"), 1.0, 2), Hub("w-all", F.lit(1), 1.0, 3)]
    return [(ends, {"upelev": level, "downelev": level}), (widths, {"width": size})]


def _drain_cells(drains: DataFrame) -> list[tuple[DataFrame, dict[str, list[Hub]]]]:
    """Cells and hubs of depth (feet): pieces of a channel, channels of like width, the system, the load, all."""
    width = F.col("width").cast("double")
    like = F.when((width > 0) & (width < 9000), F.round(F.log(width) * 4))
    base = drains.select("fid", "depth", F.col("digitizedby").alias("crew"), "load_id", F.when(~F.isnan("objectid"), F.col("objectid")).alias("channel"), _blank(F.col("facilityid")).alias("system"), like.alias("like"))
    cells = _cells(_measured(base, ["depth"], FillerRules()), ["depth"])
    return [(cells, {"depth": [Hub("channel", F.col("channel"), 1.0), Hub("like", F.col("like"), 10.0, 1), Hub("system", F.col("system"), 1.0, 1), Hub("d-load", F.col("load_id"), 1.0, 2), Hub("d-all", F.lit(1), 1.0, 3)]})]


def network_cells(mains: DataFrame, drains: DataFrame) -> list[tuple[DataFrame, dict[str, list[Hub]]]]:
    """Cells of upelev, downelev and width of mains and depth of drains with their hubs, settled."""
    return [(settled(c), h) for c, h in _main_cells(mains) + _drain_cells(drains)]


def _edges_of(parts: list[tuple[DataFrame, dict[str, list[Hub]]]]) -> DataFrame:
    edges = None
    for cells, hubs in parts:
        e = hub_edges(cells, hubs)
        edges = e if edges is None else edges.unionByName(e)
    return edges


def hold_out(mains: DataFrame, drains: DataFrame, share: int = 10) -> DataFrame:
    """field, fid, value, filled: one of `share` observed cells, chosen by hashed id, hidden and filled again from the others."""
    hidden = F.pmod(F.xxhash64("field", "fid"), F.lit(share)) == 0
    parts = network_cells(mains, drains)
    masked = [(c.withColumn("observed", F.when(~hidden, F.col("observed"))), h) for c, h in parts]
    masked = [(c.withColumn("blank_beside", F.lit(True)) if "blank_beside" in c.columns else c, h) for c, h in masked]
    truth = None
    for c, _ in parts:
        t = c.filter(hidden & F.col("observed").isNotNull()).select("field", "fid", F.col("observed").alias("value"))
        truth = t if truth is None else truth.unionByName(t)
    return truth.join(propagate(_edges_of(masked)).withColumnRenamed("value", "filled"), ["field", "fid"], "left")


def fill_network(mains: DataFrame, drains: DataFrame) -> DataFrame:
    """layer, field, fid, value, filled for upelev, downelev and width of mains and depth of drains, in one propagation."""
    parts = network_cells(mains, drains)
    got = propagate(_edges_of(parts))
    cells = None
    for c, _ in parts:
        p = c.select("field", "fid", "observed")
        cells = p if cells is None else cells.unionByName(p)
    layer = F.when(F.col("field") == "depth", "open_drains").otherwise("gravity_mains")
    return with_fills(cells, got).select(layer.alias("layer"), "field", "fid", "value", "filled")


#: How the listed main shapes are also written, without blanks and question marks.
SHAPES = {"RND": ("RND", "R", "CIRC", "CIRC.", "CIRCULAR", "ROUND"), "BOX": ("BOX", "BX", "RECT"), "ELL": ("ELL", "ELLIPSE"), "ARC": ("ARC", "ARCH"), "TRP": ("TRP",), "OTH": ("OTH",)}
#: Entries that stand for no shape.
NO_SHAPE = ("", "N/A", "NA", "0")


def fill_shapes(mains: DataFrame) -> DataFrame:
    """layer, field, fid, value, filled for mainshape: shapes of the pipes it meets, of the line and of pipes of like width, the load, all.

    Only NULL, blanks and NO_SHAPE are missing; a spelling that isn't listed is observed and stays, in capitals.
    """
    c = F.upper(F.trim("mainshape"))
    bare = F.regexp_replace(c, r"[\s?]", "")
    known = c
    for shape, written in SHAPES.items():
        known = F.when(bare.isin(*written), shape).otherwise(known)
    known = F.when(~bare.isin(*NO_SHAPE), known)
    inches = resolve_units(mains, MAINS, UnitGraph(LENGTH_EDGES), MAIN_RULES).filter("not from_remark").select(F.col("fid").alias("k_fid"), F.col("value").alias("inches"))
    like = F.when(F.col("inches") > 0, F.round(F.log("inches") * 4))
    line = _blank(F.col("facilityid"))
    met = lambda k: F.when(_end(k).isNotNull(), F.xxhash64(line, _end(k)))
    own = mains.select("fid", "load_id", line.alias("line"), F.when(line.isNotNull(), met(1)).alias("start"), F.when(line.isNotNull(), met(-1)).alias("end"), F.lit("mainshape").alias("field"), known.alias("observed"))
    cells = settled(own.join(inches, F.col("fid") == F.col("k_fid"), "left").select(*own.columns, like.alias("like")))
    hubs = [Hub("meet", F.col("start"), 1.0), Hub("meet", F.col("end"), 1.0), Hub("line", F.col("line"), 10.0, 1), Hub("like", F.col("like"), 1.0, 1), Hub("load", F.col("load_id"), 1.0, 2), Hub("all", F.lit(1), 1.0, 3)]
    got = propagate(hub_edges(cells, {"mainshape": hubs}, categorical=True), categorical=True)
    return with_fills(cells, got).withColumn("layer", F.lit("gravity_mains")).select("layer", "field", "fid", "value", "filled")
