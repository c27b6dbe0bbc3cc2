"""Outfalls: which end of a pipe discharges, how it is joined to a channel, and what becomes of those too far from one.

Defined results for dirty input: lines without usable vertices and points
without coordinates take no part; NULL flags count as false; of repeated rows
each is a line of its own; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.columns import FT_PER_M
from ..session import settled
from .cleaning import DEPTH_FT, global_rank
from .graph import clustered_ends
from .near import SortedPoints, lines_within, points_within
from .network import clean_lines, crossing_segments, meetings, nearest_points, points_on_lines

#: Statuses of a target whose end is on a channel afterwards.
JOINED = ("connected", "trim_vertex", "trim_split", "snap_vertex", "extend")


def node_ends(lines: DataFrame, tol: float) -> DataFrame:
    """id, end, x, y, node, others, outlet of the ends of lines (id, geometry, is_pipe).

    others: ends of other lines at the node. outlet: nothing else ends there, or
    only pipes that flow into it, that is, end there as drawn.
    """
    ends = settled(clustered_ends(lines.select("id", "geometry"), tol).join(lines.select("id", F.coalesce("is_pipe", F.lit(False)).alias("is_pipe")), "id"))
    node = ends.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min(F.col("is_pipe") & (F.col("end") == "end")).alias("sink"))
    own = ends.groupBy("node", "id").agg(F.count(F.lit(1)).alias("own"))
    return ends.join(node, "node").join(own, ["node", "id"]).select("id", "end", "x", "y", "node", "is_pipe", (F.col("n") - F.col("own")).alias("others"), ((F.col("n") <= 1) | F.col("sink")).alias("outlet"))


def _nearest_channel(points: DataFrame, channels: DataFrame, limit: float) -> DataFrame:
    """id, channel, off, foot_x, foot_y: the nearest channel within limit of points (id, x, y); ties go to the least id."""
    hits = points_on_lines(points, channels, limit)
    best = F.min(F.struct(F.round("off", 9).alias("o"), "line", "off", "foot_x", "foot_y")).alias("b")
    return hits.groupBy(F.col("pt").alias("id")).agg(best).select("id", F.col("b.line").alias("channel"), "b.off", "b.foot_x", "b.foot_y")


def outfall_connections(pipes: DataFrame, drains: DataFrame, triggers: DataFrame, tol: float = 0.01, snap: float = 2.0, limit: float = 20.0) -> DataFrame:
    """One row per target pipe: id, end, trigger, status, channel, node, x, y, moved, added, trimmed.

    pipes: id, geometry, outfall (whether its type says so). drains: id, geometry,
    channel (whether outfalls may be joined to it). triggers: points (id, x, y)
    that make a pipe end a target. x, y is where the end comes to lie.

    Statuses, the first that holds: shared (an earlier target joined this node to
    a channel), connected (the end is on a channel), not_outfall (the node is no
    outlet), on_drain (it lies on another drain), crossing_shared, trim_vertex,
    trim_split (the pipe crosses a channel before its end: other lines end there
    too; a channel vertex is near the crossing; none is), snap_vertex (a channel
    vertex is near the end), extend_crosses, extend (a straight way to the nearest
    channel meets another line; meets none), too_far.

    Only `shared` depends on an order, that of ids: the first target of a node
    that comes to a channel is found by a minimum over the node, not by a walk.
    All distances are judged on the lines as given.
    """
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    lines = settled(pipes.select((F.col("id") * 2).alias("id"), "geometry", F.lit(True).alias("is_pipe"), flag("outfall").alias("outfall"), F.lit(False).alias("channel")).unionByName(drains.select((F.col("id") * 2 + 1).alias("id"), "geometry", F.lit(False).alias("is_pipe"), F.lit(False).alias("outfall"), flag("channel").alias("channel"))))
    channels = lines.filter("channel").select("id", "geometry")
    c = settled(clean_lines(lines))
    ends = settled(node_ends(lines, tol).withColumn("pt", F.col("id") * 2 + F.when(F.col("end") == "start", 0).otherwise(1)))
    pipe_ends = ends.filter("is_pipe").select(F.col("pt").alias("id"), "x", "y")
    hit = points_within(pipe_ends, SortedPoints(triggers), tol).select(F.col("id1").alias("pt")).distinct().withColumn("trigger", F.lit("discharge_point"))
    both = ends.filter("is_pipe").join(hit, "pt", "left").join(lines.select("id", "outfall"), "id")
    wanted = both.groupBy("id").agg(F.max(F.col("outfall") | F.col("trigger").isNotNull()).alias("wanted")).filter("wanted").select("id")
    both = settled(both.join(wanted, "id", "left_semi"))
    near = _nearest_channel(both.select(F.col("pt").alias("id"), "x", "y"), channels, limit).withColumnRenamed("id", "pt")
    facts = both.join(near, "pt", "left").withColumn("f", F.struct("end", "trigger", "outlet", "off", "channel", "foot_x", "foot_y", "x", "y", "node", "others"))
    pair = facts.groupBy("id").agg(F.max(F.when(F.col("end") == "start", F.col("f"))).alias("s"), F.max(F.when(F.col("end") == "end", F.col("f"))).alias("e"))
    on = lambda f: F.coalesce(F.col(f"{f}.off") <= tol, F.lit(False))
    told = lambda f: F.col(f"{f}.trigger").isNotNull()
    nearer = F.coalesce(F.col("s.off"), F.lit(float("inf"))) < F.coalesce(F.col("e.off"), F.lit(float("inf")))
    which = F.when(on("s"), F.col("s")).when(on("e"), F.col("e")).when(told("s") != told("e"), F.when(told("s"), F.col("s")).otherwise(F.col("e"))).when(F.col("s.outlet") != F.col("e.outlet"), F.when(F.col("s.outlet"), F.col("s")).otherwise(F.col("e"))).when(nearer, F.col("s")).otherwise(F.col("e"))
    target = settled(pair.select("id", which.alias("f")).select("id", "f.*").withColumn("trigger", F.coalesce("trigger", F.lit("pipetype"))))

    # places on other drains; the last crossing with a channel before the end; vertices near all places in question
    drain = lines.filter("not is_pipe and not channel").select("id", "geometry")
    on_drain = lines_within(drain, SortedPoints(target.select("id", "x", "y")), tol).select(F.col("id2").alias("id")).distinct().withColumn("on_drain", F.lit(True))
    mine = target.join(c, "id").select("id", "end", "c", G.length(F.col("c")).alias("length"))
    crossed = meetings(mine.select("id", F.col("c").alias("geometry")), channels).withColumnsRenamed({"a": "id", "b": "crossed"}).join(mine.select("id", "end", "length"), "id")
    chain = F.when(F.col("end") == "start", F.col("length") - F.col("at")).otherwise(F.col("at"))
    inner = crossed.withColumn("chain", chain).filter((F.col("chain") > tol) & (F.col("chain") < F.col("length") - tol))
    last = inner.groupBy("id", "length").agg(F.max(F.struct("chain", (-F.col("crossed")).alias("less"), "x", "y")).alias("m")).withColumn("over", F.col("length") - F.col("m.chain")).filter(F.col("over") <= limit).select("id", (-F.col("m.less")).alias("crossed"), F.col("m.x").alias("cross_x"), F.col("m.y").alias("cross_y"), "over")
    t = settled(target.join(on_drain, "id", "left").join(last, "id", "left"))
    vertices = settled(clean_lines(channels).select(F.col("id").alias("owner"), F.explode("c").alias("v")).select(F.monotonically_increasing_id().alias("id"), "owner", "v.x", "v.y"))
    asked = [("x", "y", 0), ("cross_x", "cross_y", 1), ("foot_x", "foot_y", 2)]
    places = None
    for x, y, k in asked:
        p = t.filter(F.col(x).isNotNull()).select((F.col("id") * 3 + k).alias("id"), F.col(x).alias("x"), F.col(y).alias("y"))
        places = p if places is None else places.unionByName(p)
    found = points_within(places, SortedPoints(vertices), max(snap, tol)).join(vertices.select(F.col("id").alias("id2"), "owner", "x", "y"), "id2")
    vertex = settled(found.groupBy("id1").agg(F.min(F.struct("distance", "owner", "x", "y")).alias("v")).select(F.floor(F.col("id1") / 3).cast("bigint").alias("id"), (F.col("id1") % 3).alias("k"), "v"))
    for k, name in enumerate(("at_end", "at_cross", "at_foot")):
        t = t.join(vertex.filter(F.col("k") == k).select("id", F.col("v").alias(name)), "id", "left")
    foot_vertex = F.coalesce(F.col("at_foot.distance") <= tol, F.lit(False))
    t = t.withColumns({"to_x": F.when(foot_vertex, F.col("at_foot.x")).otherwise(F.col("foot_x")), "to_y": F.when(foot_vertex, F.col("at_foot.y")).otherwise(F.col("foot_y")), "to_channel": F.when(foot_vertex, F.col("at_foot.owner")).otherwise(F.col("channel"))})
    t = settled(t)

    # the way to the channel, without its ends, against all lines that don't end at its foot
    n = F.hypot(F.col("to_x") - F.col("x"), F.col("to_y") - F.col("y"))
    along = lambda s: G.point(F.col("x") + (F.col("to_x") - F.col("x")) * s, F.col("y") + (F.col("to_y") - F.col("y")) * s)
    way = t.filter(n > 2 * tol).select("id", "to_x", "to_y", F.array(along(F.lit(tol) / n), along(1 - F.lit(tol) / n)).alias("geometry"))
    met = crossing_segments(way.select("id", "geometry"), lines.select("id", "geometry")).join(way.select(F.col("id").alias("a"), "to_x", "to_y"), "a").join(c.select(F.col("id").alias("b"), "c"), "b")
    to = G.point(F.col("to_x"), F.col("to_y"))
    blocked = met.filter((G.distance(G.start(F.col("c")), to) > tol) & (G.distance(G.end(F.col("c")), to) > tol)).select(F.col("a").alias("id")).distinct().withColumn("blocked", F.lit(True))

    near_v = lambda a: F.coalesce(F.col(f"{a}.distance") <= snap, F.lit(False))
    known = lambda b: F.coalesce(b, F.lit(False))
    own = (
        F.when(known(F.col("off") <= tol), "connected")
        .when(~F.col("outlet"), "not_outfall")
        .when(known(F.col("on_drain")), "on_drain")
        .when(F.col("crossed").isNotNull(), F.when(F.col("others") > 0, "crossing_shared").when(near_v("at_cross"), "trim_vertex").otherwise("trim_split"))
        .when(near_v("at_end"), "snap_vertex")
        .when(known(F.col("off") <= limit), F.when(known(F.col("blocked")), "extend_crosses").otherwise("extend"))
        .otherwise("too_far")
    )
    judged = settled(t.join(blocked, "id", "left").withColumn("own", own))
    first = judged.filter(F.col("own").isin(*JOINED)).groupBy("node").agg(F.min("id").alias("first"))
    s = judged.join(first, "node", "left").withColumn("status", F.when(known(F.col("id") > F.col("first")), "shared").otherwise(F.col("own")))
    is_ = lambda *names: F.col("status").isin(*names)
    on_vertex = F.coalesce(F.col("at_end.distance") <= tol, F.lit(False))
    place = lambda a: (
        F.when(is_("connected"), F.when(on_vertex, F.col(f"at_end.{a}")).otherwise(F.col(f"foot_{a}"))).when(is_("trim_vertex"), F.col(f"at_cross.{a}")).when(is_("trim_split"), F.col(f"cross_{a}")).when(is_("snap_vertex"), F.col(f"at_end.{a}")).when(is_("extend"), F.col(f"to_{a}")).otherwise(F.col(a))
    )
    channel = F.when(is_("connected"), F.when(on_vertex, F.col("at_end.owner")).otherwise(F.col("channel"))).when(is_("trim_vertex"), F.col("at_cross.owner")).when(is_("trim_split", "crossing_shared"), F.col("crossed")).when(is_("snap_vertex"), F.col("at_end.owner")).when(is_("extend", "extend_crosses"), F.col("to_channel")).when(is_("too_far"), F.col("channel"))
    s = s.withColumns({"q_x": place("x"), "q_y": place("y"), "on": channel})
    moved = F.when(is_("connected", "snap_vertex"), F.hypot(F.col("q_x") - F.col("x"), F.col("q_y") - F.col("y"))).when(is_("trim_vertex"), F.col("at_cross.distance")).otherwise(0.0)
    return s.select(
        (F.col("id") / 2).cast("bigint").alias("id"), "end", "trigger", "status", F.floor((F.col("on") - 1) / 2).cast("bigint").alias("channel"), "node", F.col("q_x").alias("x"), F.col("q_y").alias("y"),
        moved.alias("moved"), F.when(is_("extend"), F.hypot(F.col("q_x") - F.col("x"), F.col("q_y") - F.col("y"))).otherwise(0.0).alias("added"), F.when(is_("trim_vertex", "trim_split"), F.col("over")).otherwise(0.0).alias("trimmed"),
    )


def connected_lines(pipes: DataFrame, found: DataFrame) -> DataFrame:
    """id, c: pipes (id, geometry) as outfall_connections leaves them: trimmed, extended, or with their end moved."""
    j = clean_lines(pipes).join(found.filter(F.col("status").isin(*JOINED)).select("id", "end", "status", "trimmed", G.point(F.col("x"), F.col("y")).alias("q")), "id", "left")
    # told from the outfall end
    away = F.when(F.col("end") == "start", F.reverse("c")).otherwise(F.col("c"))
    j = j.withColumn("o", away)
    cut = F.when(F.col("status").startswith("trim"), G.with_end(G.cut(F.col("o"), F.lit(0.0), G.length(F.col("o")) - F.col("trimmed")), F.col("q"))).when(F.col("status") == "extend", F.concat("o", F.array("q"))).otherwise(G.with_end(F.col("o"), F.col("q")))
    return j.select("id", F.when(F.col("status").isNull(), F.col("c")).otherwise(F.when(F.col("end") == "start", F.reverse(cut)).otherwise(cut)).alias("c"))


def channel_nodes(channels: DataFrame, found: DataFrame, tol: float = 0.01) -> DataFrame:
    """host, at: where channels (id, geometry) get a node, to be cut by split_at; none at their own ends."""
    q = found.filter(F.col("status").isin(*JOINED)).select(F.col("channel").alias("id"), G.point(F.col("x"), F.col("y")).alias("q"))
    at = q.join(clean_lines(channels), "id").withColumn("at", G.locate(F.col("c"), F.col("q"))["at"]).filter((F.col("at") > tol) & (F.col("at") < G.length(F.col("c")) - tol))
    w = Window.partitionBy("host").orderBy("at")
    spot = at.select(F.col("id").alias("host"), "at").distinct()
    return spot.withColumn("before", F.lag("at").over(w)).filter(F.col("before").isNull() | (F.col("at") - F.col("before") > tol)).select("host", "at")


def converted_outfalls(found: DataFrame, outfalls: DataFrame, inlets: DataFrame, tol: float = 0.5, orphan: float = 5.0) -> DataFrame:
    """Outfalls that become inlets: objectid, fid, facilityid, legacyid, rim, invert, depth, digitizedby, source, pipes.

    found: rows of outfall_connections. outfalls: fid, facilityid, x, y, dem (metres).
    An outfall is taken if it is the nearest within tol of a pipe end that is too
    far from a channel, else if no target lies within `orphan` of it. New ids go
    on from the greatest of inlets (objectid), in the order of fid.
    """
    pts = settled(outfalls.select(F.col("fid").alias("id"), "x", "y"))
    far = settled(found.filter("status = 'too_far'").select("id", "x", "y"))
    hit = nearest_points(far, pts, tol + 1e-12).select(F.col("id1").alias("pipe"), F.col("id2").alias("fid")).groupBy("fid").agg(F.array_join(F.transform(F.array_sort(F.collect_set("pipe")), lambda v: v.cast("string")), ",").alias("pipes"))
    met = points_within(pts, SortedPoints(found.select("id", "x", "y")), orphan).select(F.col("id1").alias("fid")).distinct()
    taken = outfalls.join(hit, "fid", "left").join(met.withColumn("met", F.lit(True)), "fid", "left").filter("pipes is not null or met is null")
    ranked = global_rank(settled(taken.select("fid", "facilityid", "dem", F.when(F.col("pipes").isNotNull(), "too_far").otherwise("orphan").alias("source"), F.coalesce("pipes", F.lit("")).alias("pipes"))), ["fid"])
    # one row
    top = F.broadcast(inlets.agg(F.coalesce(F.max(F.when(~F.isnan("objectid"), F.col("objectid"))), F.lit(0.0)).cast("bigint").alias("top")))
    rim = F.when(~F.isnan("dem"), F.col("dem") * F.lit(FT_PER_M))
    return ranked.join(top).select((F.col("top") + F.col("rank")).alias("objectid"), "fid", "facilityid", F.col("facilityid").alias("legacyid"), F.round(rim, 5).alias("rim"), F.round(rim - F.lit(DEPTH_FT), 5).alias("invert"), F.lit(DEPTH_FT).alias("depth"), F.lit("auto").alias("digitizedby"), "source", "pipes")
