"""Networks as DataFrames: nodes from line ends, components, traversals and what accumulates along them.

Iterations join on node keys, count their own progress with one aggregate and
cut lineage with checkpoints in the shared folder, every round or few.
"""

from __future__ import annotations

import itertools
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..session import if_small, settled
from .cleaning import global_rank
from .near import SortedPoints, points_within

# Nodes ------------------------------------------------------------------------------------------------


def line_ends(lines: DataFrame) -> DataFrame:
    """id, end ('start' or 'end'), x, y of lines (id, geometry); both ends of a line without usable vertices are left out."""
    c = lines.select("id", G.line(F.col("geometry")).alias("c")).filter("c is not null")
    return c.select("id", F.explode(F.array(F.struct(F.lit("start").alias("end"), G.start(F.col("c")).alias("p")), F.struct(F.lit("end").alias("end"), G.end(F.col("c")).alias("p")))).alias("e")).select("id", "e.end", "e.p.x", "e.p.y")


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node in it) of undirected edges (u, v), by alternating large and small stars.

    Each round is two grouped aggregates over the edges; their number shrinks to
    one per node. Hot nodes are aggregated with partial minima on the map side.
    Loops keep a node without other edges in the result.
    """
    nodes = edges.select(F.col("u").alias("node")).unionByName(edges.select(F.col("v").alias("node"))).distinct()
    e = settled(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct())
    before = None
    while True:
        # large star: neighbours above a node link to the least node around it
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its neighbours below link to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = settled(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).filter("u > v").distinct())
        mark = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == before:
            break
        before = mark
    root = e.groupBy("u").agg(F.min("v").alias("m"))
    return nodes.join(root, nodes["node"] == root["u"], "left").select("node", F.coalesce("m", "node").alias("component"))


def clustered_ends(lines: DataFrame, tol: float) -> DataFrame:
    """id, end, x, y, node: line ends whose chain of gaps is at most tol are one node, named after its least end."""
    ends = settled(line_ends(lines).withColumn("pt", F.col("id") * 2 + F.when(F.col("end") == "start", 0).otherwise(1)))
    pts = ends.select(F.col("pt").alias("id"), "x", "y")
    # equal coordinates are one point: pairs are only sought between different ones
    spots = settled(pts.groupBy("x", "y").agg(F.min("id").alias("id")))
    pairs = points_within(spots, SortedPoints(spots), tol, same=True)
    comp = components(pairs.select(F.col("id1").alias("u"), F.col("id2").alias("v")))
    node = spots.join(comp, spots["id"] == comp["node"], "left").select("x", "y", F.coalesce("component", "id").alias("node"))
    return ends.join(node, ["x", "y"]).select("id", "end", "x", "y", "node")


def network(lines: DataFrame, tol: float) -> DataFrame:
    """id, u, v: the nodes at both ends of each line."""
    ends = clustered_ends(lines, tol)
    return ends.groupBy("id").agg(F.max(F.when(F.col("end") == "start", F.col("node"))).alias("u"), F.max(F.when(F.col("end") == "end", F.col("node"))).alias("v"))


def incidence(edges: DataFrame) -> DataFrame:
    """id, node: each line with its nodes, loops once."""
    return edges.select("id", F.explode(F.array_distinct(F.array("u", "v"))).alias("node"))


def degrees(edges: DataFrame) -> DataFrame:
    """node, degree: how many line ends meet in a node; a loop counts twice."""
    return edges.select(F.explode(F.array("u", "v")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


def dangling_ends(edges: DataFrame) -> DataFrame:
    """id, end, node of the line ends nothing else meets, judged on the whole network."""
    deg = degrees(edges).filter("degree = 1").select("node")
    ends = edges.select("id", F.explode(F.array(F.struct(F.lit("start").alias("end"), F.col("u").alias("node")), F.struct(F.lit("end").alias("end"), F.col("v").alias("node")))).alias("e")).select("id", "e.end", "e.node")
    return ends.join(deg, "node", "left_semi").select("id", "end", "node")


# Traversals --------------------------------------------------------------------------------------------


def bfs(edges: DataFrame, starts: DataFrame, stops: DataFrame | None = None) -> DataFrame:
    """id, hop, parent of the lines reached from the start lines; lines in stops are reached but not passed.

    A line's parent is the least line of the hop before that it meets, which is
    a fixed choice where a queue would take any order. A hop is one job that
    writes the new lines with their nodes; however many hops there are, all are taken.
    """
    at = settled(edges.select("id", "u", "v", F.explode(F.array_distinct(F.array("u", "v"))).alias("node")))
    stop = stops.select("id").distinct().withColumn("stops", F.lit(True)) if stops is not None else None
    first = edges.join(starts.select("id").distinct(), "id", "left_semi").select("id", "u", "v", F.lit(None).cast("bigint").alias("parent"), F.lit(False).alias("stops"))
    frontier = settled(first)
    parts, held, seen_lines, seen_nodes = [], [], [frontier.select("id")], []
    for hop in itertools.count():
        parts.append(frontier.select("id", F.lit(hop).alias("hop"), "parent"))
        if len(parts) >= 64:
            parts = [settled(_all(parts))]
        open_ = frontier.filter(~F.col("stops"))
        nodes = open_.select(F.explode(F.array_distinct(F.array("u", "v"))).alias("node"), "id").groupBy("node").agg(F.min("id").alias("from"))
        # neighbours of a frontier lie at most one hop from it, so the last two are all that can be met again
        for seen in seen_nodes:
            nodes = nodes.join(seen, "node", "left_anti")
        fresh = at.join(nodes, "node").groupBy("id", "u", "v").agg(F.min("from").alias("parent"))
        for seen in [*seen_lines, *held]:
            fresh = fresh.join(seen, "id", "left_anti")
        fresh = fresh.withColumn("stops", F.lit(False)) if stop is None else fresh.join(stop, "id", "left").withColumn("stops", F.coalesce("stops", F.lit(False)))
        frontier = settled(fresh)
        if frontier.isEmpty():
            return _all(parts)
        opened = parts_nodes(open_)
        seen_nodes = [opened, *seen_nodes][:2]
        seen_lines = [frontier.select("id"), *seen_lines][:2]
        if stop is not None:
            # a line that isn't passed can be met again much later, from its other end
            held.append(frontier.filter("stops").select("id"))
            if len(held) >= 16:
                held = [settled(_all(held))]


def parts_nodes(lines: DataFrame) -> DataFrame:
    """node: every node of lines (u, v) once."""
    return lines.select(F.explode(F.array("u", "v")).alias("node")).distinct()


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def accumulated(tree: DataFrame, value: str) -> DataFrame:
    """id, total: the sum of value over a line and everything below it in the tree (id, parent, value).

    Pointer doubling: each line passes what it holds to its ancestor 2^k above,
    so the rounds are the logarithm of the depth. Lines whose pointer has left
    the tree take no further part; what ancestors are given is added up at the end.
    """
    own = tree.select("id", F.col(value).alias("total"))
    live = settled(tree.filter("parent is not null").select("id", F.col("parent").alias("up"), F.col(value).alias("total")))
    given = []
    while not live.isEmpty():
        more = settled(live.groupBy(F.col("up").alias("id")).agg(F.sum("total").alias("total")))
        given.append(more)
        above = live.select(F.col("id").alias("up"), F.col("up").alias("next"))
        live = settled(live.join(above, "up").join(more.withColumnRenamed("total", "more"), "id", "left").select("id", F.col("next").alias("up"), (F.col("total") + F.coalesce("more", F.lit(0))).alias("total")))
    return _all([own, *given]).groupBy("id").agg(F.sum("total").alias("total")).join(own.select("id"), "id", "left_semi")


def inherited(tree: DataFrame, step: str) -> DataFrame:
    """id, total: the sum of step from the root down to each line, by pointer doubling; lines that have reached the root stay out of the rounds."""
    done = [settled(tree.filter("parent is null").select("id", F.col(step).alias("total")))]
    live = settled(tree.filter("parent is not null").select("id", F.col("parent").alias("up"), F.col(step).alias("total")))
    while not live.isEmpty():
        none = F.lit(None).cast("bigint")
        above = _all([live.select(F.col("id").alias("a"), F.col("up").alias("next"), F.col("total").alias("more")), *[d.select(F.col("id").alias("a"), none.alias("next"), F.col("total").alias("more")) for d in done]])
        # a parent that isn't in the tree ends the way as a root does
        new = settled(live.join(above, F.col("up") == F.col("a"), "left").select("id", F.col("next").alias("up"), (F.col("total") + F.coalesce("more", F.lit(0))).alias("total")))
        done.append(new.filter("up is null").select("id", "total"))
        live = new.filter("up is not null")
    return _all(done)


def levels(tree: DataFrame, upstream: DataFrame) -> DataFrame:
    """id, level: the stem below a line keeps its level, its other children are one higher.

    tree: id, parent, layer. The stem is the child with the most upstream length
    among those of the parent's layer, or among all if none is; ties go to the
    least id.
    """
    t = settled(tree.join(upstream, "id"))
    up = t.select(F.col("id").alias("parent"), F.col("layer").alias("parent_layer"))
    kids = t.filter("parent is not null").select("id", "parent", "layer", "total").join(up, "parent", "left")
    rank = F.struct(F.when(F.col("layer") == F.col("parent_layer"), 0).otherwise(1), -F.col("total"), "id")
    stems = kids.groupBy("parent").agg(F.min_by("id", rank).alias("id")).select("id", F.lit(True).alias("stem"))
    steps = t.select("id", "parent").join(stems, "id", "left").select("id", "parent", F.when(F.col("parent").isNull() | F.col("stem"), 0).otherwise(1).alias("step"))
    return inherited(steps, "step").select("id", F.col("total").cast("int").alias("level"))


def tributaries(tree: DataFrame, level: DataFrame, upstream: DataFrame) -> DataFrame:
    """id, tributary: 0 on the main stem; else the rank, by upstream length, of the level-1 root the line drains through."""
    t = settled(tree.select("id", "parent").join(level, "id").join(upstream, "id"))
    up = t.select(F.col("id").alias("parent"), F.col("level").alias("parent_level"))
    roots = t.join(up, "parent").filter("level = 1 and parent_level = 0").select("id", (-F.col("total")).alias("less"))
    rank = global_rank(roots, ["less", "id"]).select("id", F.col("rank").alias("tributary"))
    # climb to the nearest root by doubling; the stem and the roots are there from the start
    start = t.join(rank, "id", "left").select("id", "parent", F.when(F.col("level") == 0, F.lit(0)).otherwise(F.col("tributary")).alias("tributary"))
    start = settled(start)
    done = [start.filter("tributary is not null or parent is null").select("id", "tributary")]
    live = start.filter("tributary is null and parent is not null").select("id", F.col("parent").alias("up"))
    while not live.isEmpty():
        none = F.lit(None).cast("bigint")
        above = _all([live.select(F.col("id").alias("a"), F.col("up").alias("next"), none.alias("tributary")), *[d.select(F.col("id").alias("a"), none.alias("next"), "tributary") for d in done]])
        new = settled(live.select("id", "up").join(above, F.col("up") == F.col("a"), "left").select("id", F.col("next").alias("up"), "tributary"))
        done.append(new.filter("up is null").select("id", "tributary"))
        live = new.filter("up is not null").select("id", "up")
    return _all(done).select("id", F.col("tributary").cast("int").alias("tributary"))


def dfs_order(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """id, visit_order, depth, parent: discovery order of a depth-first search, per component.

    Depth-first numbering is sequential, so a component is one task; the
    components come from `components`, and only those with a start are taken.
    Neighbours are discovered in descending id when their line is taken from the
    stack.
    """
    comp = components(edges.select("u", "v"))
    tagged = edges.join(comp, edges["u"] == comp["node"]).select("id", "u", "v", "component")
    mine = tagged.join(starts.select("id").distinct().withColumn("is_start", F.lit(True)), "id", "left").withColumn("is_start", F.coalesce("is_start", F.lit(False)))
    held = mine.filter("is_start").select("component").distinct()

    def visit(pdf: pd.DataFrame) -> pd.DataFrame:
        at: dict[int, list[int]] = {}
        ends = {}
        for i, u, v in zip(pdf["id"].tolist(), pdf["u"].tolist(), pdf["v"].tolist()):
            ends[i] = (u, v)
            for n in {u, v}:
                at.setdefault(n, []).append(i)
        order: dict[int, tuple[int, int, int | None]] = {}
        stack = []
        for i in sorted(pdf["id"][pdf["is_start"]].tolist()):
            order[i] = (len(order), 0, None)
            stack.insert(0, i)
        while stack:
            i = stack.pop()
            for j in sorted({k for n in ends[i] for k in at[n]}, reverse=True):
                if j not in order:
                    order[j] = (len(order), order[i][1] + 1, i)
                    stack.append(j)
        return pd.DataFrame({"id": list(order), "visit_order": [o[0] for o in order.values()], "depth": [o[1] for o in order.values()], "parent": pd.array([o[2] for o in order.values()], dtype="Int64")})

    return mine.join(held, "component", "left_semi").groupBy("component").applyInPandas(visit, "id bigint, visit_order bigint, depth int, parent bigint")


def min_cut(edges: DataFrame, sources: DataFrame, far: int, capacity: str = "capacity", stops: DataFrame | None = None) -> DataFrame:
    """id, cost: the cheapest lines to cut, besides those in stops, so that node `far` isn't reached from the source nodes, and what they cost together.

    No row comes out if nothing has to be cut; of equally cheap cuts it is the one
    nearest the sources. A line without capacity is an error. Lines that hang on a
    single node carry no flow and are taken off in rounds, as long as a round takes a
    tenth. Augmenting paths are sequential: what is left is one task, which keeps its
    lines in files and only holds some numbers for each node.
    """
    if stops is not None:
        edges = edges.join(stops.select("id").distinct(), "id", "left_anti")
    lines = edges.filter("u <> v").select(F.col("id").cast("bigint").alias("id"), F.least("u", "v").cast("bigint").alias("a"), F.greatest("u", "v").cast("bigint").alias("b"), F.col(capacity).cast("bigint").alias("capacity"))
    roots = sources.filter("node is not null").select(F.col("node").cast("bigint").alias("node")).distinct()
    n = lines.agg(F.count(F.lit(1)).alias("all"), F.count("capacity").alias("known"), F.count_if(F.col("capacity") > 0).alias("kept")).first()
    if n["known"] < n["all"]:
        raise ValueError(f"{n['all'] - n['known']} lines have no capacity")
    core = _core(lines.filter("capacity > 0").select("a", "b", "capacity"), roots, far, n["kept"])
    pairs = core.groupBy("a", "b").agg(F.sum("capacity").alias("capacity"))
    arcs = pairs.select(F.explode(F.array(F.struct("a", "b", "capacity"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "capacity"))).alias("e")).select("e.*")
    # a loop marks a source
    arcs = arcs.unionByName(roots.select(F.col("node").alias("a"), F.col("node").alias("b"), F.lit(0).cast("bigint").alias("capacity")))
    cut = if_small(arcs.repartition(1).sortWithinPartitions("a", "b").mapInPandas(lambda batches: _Flow(batches).cut(far), "a bigint, b bigint, cost bigint"))
    found = lines.join(cut, ["a", "b"]).select("id", "cost")
    if n["kept"] == n["all"]:
        return found
    # lines that cost nothing are cut too where they lead from one side to the other
    cost = cut.agg(F.max("cost")).first()[0] or 0
    held = lines.filter("capacity > 0").join(cut, ["a", "b"], "left_anti").select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(roots.select(F.col("node").alias("u"), F.col("node").alias("v")))
    side, whole = settled(components(held)), settled(components(lines.select(F.col("a").alias("u"), F.col("b").alias("v"))))
    near = settled(side.join(side.join(roots, "node", "left_semi").select("component").distinct(), "component", "left_semi").select("node", F.lit(True).alias("near")))
    inside = whole.join(whole.filter(F.col("node") == far).select("component"), "component", "left_semi").select(F.col("node").alias("a"))
    free = lines.filter("capacity <= 0").join(cut, ["a", "b"], "left_anti").join(inside, "a", "left_semi")
    ends = free.join(near.toDF("a", "near_a"), "a", "left").join(near.toDF("b", "near_b"), "b", "left")
    return found.unionByName(ends.filter("(near_a is null) <> (near_b is null)").select("id", F.lit(cost).cast("bigint").alias("cost")))


def _core(lines: DataFrame, roots: DataFrame, far: int, n: int) -> DataFrame:
    """n lines (a, b, capacity) without most of those that hang on a single node; roots and far hold theirs."""
    mark = roots.select("node", F.lit(None).cast("bigint").alias("other"), F.lit(True).alias("root"))
    while n:
        ends = _all([lines.select(F.col(x).alias("node"), F.col(y).alias("other"), F.lit(False).alias("root")) for x, y in ("ab", "ba")])
        nodes = ends.unionByName(mark).groupBy("node").agg(F.min("other").alias("least"), F.max("other").alias("most"), F.max("root").alias("root")).filter((F.col("least") < F.col("most")) | F.col("root") | (F.col("node") == far))
        lines = settled(lines.join(nodes.select(F.col("node").alias("a")), "a", "left_semi").join(nodes.select(F.col("node").alias("b")), "b", "left_semi").select("a", "b", "capacity"))
        before, n = n, lines.count()
        if n > 0.9 * before:
            break
    return lines


class _Flow:
    """The flow through arcs that come sorted by (a, b), each with its reverse; a loop marks a source.

    Arcs lie in files that are mapped into memory, so what they take is cache that the
    system can drop. For each node there are its name, its first arc and its level.
    """

    #: arcs looked at together
    STEP = 1 << 20

    def __init__(self, batches: Iterator[pd.DataFrame]):
        heads, caps, flows = (tempfile.TemporaryFile(dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None) for _ in range(3))
        nodes, counts, roots, last = [], [], [], None
        for pdf in batches:
            a, b = pdf["a"].to_numpy(), pdf["b"].to_numpy()
            if not len(a):
                continue
            heads.write(b.tobytes())
            caps.write(pdf["capacity"].to_numpy().tobytes())
            roots.append(a[a == b])
            node, count = np.unique(a, return_counts=True)
            if node[0] == last:
                counts[-1][-1] += count[0]
                node, count = node[1:], count[1:]
            last = a[-1]
            if len(node):
                nodes.append(node)
                counts.append(count)
        none = np.empty(0, dtype=np.int64)
        self.node = np.concatenate([none, *nodes])
        del nodes
        self.start = np.concatenate([[0], np.cumsum(np.concatenate([none, *counts]))])
        self.roots = np.searchsorted(self.node, np.concatenate([none, *roots]))
        self.n = int(self.start[-1])
        self.head, self.cap, self.flow = (self._mapped(f) for f in (heads, caps, flows))
        for lo in range(0, self.n, self.STEP):
            self.head[lo : lo + self.STEP] = np.searchsorted(self.node, self.head[lo : lo + self.STEP])

    def _mapped(self, file) -> np.ndarray:
        file.flush()
        file.truncate(8 * max(1, self.n))  # what wasn't written reads as zeros
        return np.memmap(file, np.int64, "r+").view(np.ndarray)

    def levels(self, far: int) -> np.ndarray:
        """How many arcs with room lead from a source to each node; -1 where none do, or after far was met."""
        level = np.full(len(self.node), -1, dtype=np.int32)
        level[self.roots] = 0
        front = self.roots
        for hop in itertools.count(1):
            n = self.start[front + 1] - self.start[front]
            ends = np.cumsum(n)
            first = self.start[front] - (ends - n)
            met = []
            for lo in range(0, int(n.sum()), self.STEP):
                k = np.arange(lo, min(lo + self.STEP, ends[-1]))
                k += first[np.searchsorted(ends, k, side="right")]
                new = self.head[k[self.cap[k] > self.flow[k]]]
                new = np.unique(new[level[new] < 0])
                level[new] = hop
                met.append(new)
            if not sum(map(len, met)) or level[far] >= 0:
                return level
            front = np.concatenate(met)

    def pushed(self, far: int, level: np.ndarray) -> int:
        """What more comes to far over shortest ways; they are sought from far, against the arcs, until none is left."""
        head, cap, flow, start = self.head, self.cap, self.flow, self.start
        total, way, at = 0, [], [far]
        tried: dict[int, list] = {}
        while True:
            x = at[-1]
            if level[x] == 0:
                more = min(int(cap[k] + flow[k]) for k in way)
                total += more
                full = len(way)
                for j, k in enumerate(way):
                    flow[k] -= more
                    lo, hi = start[at[j + 1]], start[at[j + 1] + 1]
                    flow[lo + np.searchsorted(head[lo:hi], at[j])] += more
                    if cap[k] + flow[k] == 0:
                        full = min(full, j)
                del way[full:], at[full + 1 :]
                continue
            if x not in tried:
                lo, hi = int(start[x]), int(start[x + 1])
                tried[x] = [lo + np.flatnonzero((level[head[lo:hi]] == level[x] - 1) & (cap[lo:hi] + flow[lo:hi] > 0)), 0]
            arcs, k = tried[x]
            while k < len(arcs) and cap[arcs[k]] + flow[arcs[k]] == 0:
                k += 1
            tried[x][1] = k
            if k < len(arcs):
                way.append(int(arcs[k]))
                at.append(int(head[arcs[k]]))
            elif way:
                way.pop()
                at.pop()
                tried[at[-1]][1] += 1
            else:
                return total

    def cut(self, name: int) -> Iterator[pd.DataFrame]:
        """a, b, cost: the pairs of nodes between what the sources still reach at full flow and the rest."""
        far = int(np.searchsorted(self.node, name))
        if far == len(self.node) or self.node[far] != name or far in self.roots:
            return
        cost = 0
        while (level := self.levels(far))[far] >= 0:
            cost += self.pushed(far, level)
        for lo in range(0, self.n, self.STEP):
            k = np.arange(lo, min(lo + self.STEP, self.n))
            tail = np.searchsorted(self.start, k, side="right") - 1
            out = (level[tail] >= 0) & (level[self.head[k]] < 0)
            u, v = self.node[tail[out]], self.node[self.head[k[out]]]
            yield pd.DataFrame({"a": np.minimum(u, v), "b": np.maximum(u, v), "cost": np.full(len(u), cost, dtype=np.int64)})


def fixed_point_levels(ends: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """pt, value, source: missing levels of line ends filled in rounds until nothing changes.

    ends: pt, id, node, value, along, bed. Each round uses the first source that
    fills anything, for all ends at once: 1 the lowest level of other lines' ends
    at the node, 2 a level along the line, 3 the bed, 4 the line's other end. Every
    round fills an end, so they come to an end; needing more than max_rounds is an
    error. The rounds only see missing ends and what is known beside them.
    """
    every = settled(ends.select("pt", "id", "node", "along", "bed", "value"))
    lost = every.filter("value is null")
    at_node, of_line = lost.select("node").distinct(), lost.select("id").distinct()
    known = every.filter("value is not null")
    beside = known.join(at_node, "node", "left_semi").unionByName(known.join(of_line, "id", "left_semi")).dropDuplicates(["pt"])
    held = settled(beside.select("pt", "id", "node", "value"))
    todo = settled(lost.drop("value"))
    filled = []
    for done in itertools.count():
        # the lowest of the other lines at a node: the lowest line, or for its own ends the next
        per = held.groupBy("node", "id").agg(F.min("value").alias("z"))
        low = per.groupBy("node").agg(F.min(F.struct("z", "id")).alias("m")).select("node", F.col("m.id").alias("id1"), F.col("m.z").alias("z1"))
        next_ = per.join(low, "node").filter("id <> id1").groupBy("node").agg(F.min("z").alias("z2"))
        other = held.groupBy("id").agg(F.min("value").alias("z4"))
        tried = settled(todo.join(low, "node", "left").join(next_, "node", "left").join(other, "id", "left").select("pt", "id", "node", "along", "bed", F.when(F.col("id1") != F.col("id"), F.col("z1")).otherwise(F.col("z2")).alias("s1"), F.col("along").alias("s2"), F.col("bed").alias("s3"), F.col("z4").alias("s4")))
        n = tried.agg(*[F.count(f"s{k}").alias(f"s{k}") for k in (1, 2, 3, 4)]).first()
        k = next((k for k in (1, 2, 3, 4) if n[f"s{k}"]), 0)
        if not k:
            break
        if done == max_rounds:
            raise RuntimeError(f"levels not settled after {max_rounds} rounds")
        new = tried.filter(F.col(f"s{k}").isNotNull()).select("pt", "id", "node", F.col(f"s{k}").alias("value"))
        filled.append(new.select("pt", "value", F.lit(k).alias("source")))
        todo = tried.filter(F.col(f"s{k}").isNull()).select("pt", "id", "node", "along", "bed")
        held = held.unionByName(new)
        if len(filled) % 8 == 0:
            held, filled = settled(held), [settled(_all(filled))]
    empty = known.select("pt", "value", F.lit(0).alias("source"))
    return _all([empty, todo.select("pt", F.lit(None).cast("double").alias("value"), F.lit(0).alias("source")), *filled])
