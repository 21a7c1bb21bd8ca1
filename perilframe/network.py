"""Graph operators on edge tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from perilframe.io import dropped, only, written
from perilframe.operators.joins import near_pairs


#: Rows of two longs up to which ``components`` broadcasts a table of nodes: some 10 MB in memory.
SMALL = 200_000


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component): the smallest node id that each node of an edge table reaches.

    By contraction: in each round every node goes to the one that comes first within two steps of it, itself included, in an order by hash, new for
    each round; so all leaves of a star, which are two steps apart, meet in the first round. Edges go to where their ends went, and
    those within one node are dropped. So the number of rounds grows with the
    logarithm of the nodes, however long the ways are, and each round has a share of the last one's edges. Then the rounds are
    followed backwards. Each is written to the shared folder, so the plan stays short; the driver sees only whether edges are left.
    A table of nodes with at most SMALL rows is broadcast, which spares all shuffles but those of the groups; larger ones are joined by
    sort-merge, by hint: a file of nodes is small beside its rows in memory. Null ends are ignored, repeated edges change nothing.
    """
    there = edges.where(F.col(u).isNotNull() & F.col(v).isNotNull())
    left = written(there.select(F.least(u, v).alias("u"), F.greatest(u, v).alias("v")).distinct(), "edges")
    gone, hints = [], []
    while edge_count := left.count():
        hints.append("broadcast" if 2 * edge_count <= SMALL else "merge")  # an edge has two nodes at most
        order = lambda k: F.struct(F.xxhash64(F.lit(len(gone)), k).alias("h"), F.col(k).alias("node"))
        both = left.select(F.col("u").alias("node"), F.col("v").alias("other")).union(left.select("v", "u"))
        one = both.groupBy("node").agg(F.min(order("other")).alias("b")).select(F.col("node").alias("other"), F.least(order("node"), F.col("b")).alias("b"))
        to = both.join(one.hint(hints[-1]), "other").groupBy("node").agg(F.min("b").alias("b")).select("node", F.col("b.node").alias("to"))
        gone.append(written(to, "went"))
        a, b = (gone[-1].select(F.col("node").alias(k), F.col("to").alias(f"{k}2")).hint(hints[-1]) for k in "uv")
        moved = left.join(a, "u").join(b, "v").where("u2 != v2")
        last, left = left, written(moved.select(F.least("u2", "v2").alias("u"), F.greatest("u2", "v2").alias("v")).distinct(), "edges")
        dropped(last)
    if not gone:
        return left.select(F.col("u").alias("node"), F.col("v").alias("component"))
    found = gone[-1]
    for step, hint in zip(gone[-2::-1], hints[:0:-1]):  # nodes that a round left without edges have gone no further
        last = found.select(F.col("node").alias("to"), F.col("to").alias("end")).hint(hint)
        later, found = found, written(step.join(last, "to", "left").select("node", F.coalesce("end", "to").alias("to")), "went")
        dropped(later, step)
    least = found.groupBy("to").agg(F.min("node").alias("component"))
    return found.join(least.hint(hints[0]), "to").select("node", "component")


def stitched_nodes(segs: DataFrame, snap_m: float = 250.0) -> DataFrame:
    """(part_id, end, node): ends of polylines, 0 first and 1 last, those within ``snap_m`` of each other, also in steps, as
    one node. A node's id is the least of its ends' ids (twice the part's plus the end)."""
    first, last = F.min_by(F.struct("x1", "y1"), "seq"), F.max_by(F.struct("x2", "y2"), "seq")
    parts = segs.groupBy("part_id").agg(first.alias("a"), last.alias("b"))
    at = F.inline(F.array(F.struct(F.lit(0).alias("end"), F.col("a.x1").alias("x"), F.col("a.y1").alias("y")), F.struct(F.lit(1).alias("end"), F.col("b.x2").alias("x"), F.col("b.y2").alias("y"))))
    ends = written(parts.select("part_id", at).withColumn("u", (F.col("part_id") * 2 + F.col("end")).cast("long")), "ends")
    other = ends.select(F.col("u").alias("v"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    found = components(near_pairs(ends.select("u", "x", "y"), other, snap_m, F.col("u") < F.col("v")).select("u", "v"))
    return ends.join(found, ends["u"] == found["node"], "left").select("part_id", "end", F.coalesce("component", "u").alias("node"))


def part_edges(nodes: DataFrame, lengths: DataFrame) -> DataFrame:
    """(u, v, cost) both ways, the shortest of parallel parts. nodes: as from ``stitched_nodes``; lengths: part_id, length_m."""
    ends = nodes.groupBy("part_id").agg(F.min_by("node", "end").alias("u"), F.max_by("node", "end").alias("v")).join(lengths, "part_id")
    both = ends.select("u", "v", "length_m").union(ends.select("v", "u", "length_m"))
    return both.where("u != v").groupBy("u", "v").agg(F.min("length_m").alias("cost"))


def shortest(edges: DataFrame, sources: DataFrame, cap: float, keys: list[str] = [], shared: DataFrame | None = None, stop: Column | None = None) -> DataFrame:
    """(keys, source, node, cost, path): the least cost from each source, if not above ``cap``, and the nodes of the way there, both
    ends included; of equal costs the least path. A source reaches itself at 0.

    edges: keys, u, v, cost; shared: u, v, cost of edges that hold for all keys; sources: keys, source. Every round joins only
    the pairs that the last one found or improved, and is written to the shared folder; as long as a pair improves there is
    another one, so no way is cut short by its number of edges. stop: a condition on (keys, source, node); such nodes are reached, but not passed.
    """
    found = sources.select(*keys, "source").distinct()
    best = found.select(*keys, "source", F.col("source").alias("node"), F.lit(0.0).alias("cost"), F.array("source").alias("path"), F.lit(True).alias("fresh"))
    pair, former = [*keys, "source", "node"], None
    while True:
        last = best.where("fresh")
        if stop is not None:
            last = last.where((F.col("node") == F.col("source")) | ~stop)
        last = last.select(*keys, "source", F.col("node").alias("u"), F.col("cost").alias("so_far"), "path")
        step = last.join(edges, [*keys, "u"])
        if shared is not None:
            step = step.unionByName(last.join(shared, "u"))
        step = step.select(*keys, "source", F.col("v").alias("node"), F.struct((F.col("so_far") + F.col("cost")).alias("cost"), F.concat("path", F.array("v")).alias("path")).alias("way")).where(F.col("way.cost") <= cap)
        both = best.select(*pair, F.struct("cost", "path").alias("way"), F.col("cost").alias("was")).unionByName(step.withColumn("was", F.lit(None).cast("double")))
        best = both.groupBy(*pair).agg(F.min("way").alias("way"), F.min("was").alias("was"))
        done = written(best.select(*pair, "way.*", (F.col("was").isNull() | (F.col("way.cost") < F.col("was"))).alias("fresh")), "ways")
        if former is not None:
            dropped(former)
        best = former = done
        if best.where("fresh").isEmpty():
            return best.drop("fresh")


def station_edges(points: DataFrame, nodes: DataFrame, lengths: DataFrame) -> DataFrame:
    """(event_id, u, v, cost) both ways: each part that holds points of an event, cut at them; neighbours along the part are linked.

    points: event_id, node (0 or more), part_id, station_m; nodes: as from ``stitched_nodes``, here as -1 - node, so that the
    two kinds don't mix; lengths: part_id, length_m. Stations beyond a part's ends count as its ends.
    """
    held = points.join(lengths, "part_id").select("event_id", "part_id", "node", F.least("length_m", F.greatest(F.lit(0.0), "station_m")).alias("at"))
    ends = held.select("event_id", "part_id").distinct().join(nodes, "part_id").join(lengths, "part_id")
    ends = ends.select("event_id", "part_id", (-1 - F.col("node")).alias("node"), F.when(F.col("end") == 0, 0.0).otherwise(F.col("length_m")).alias("at"), (F.col("end") * 2).alias("side"))
    order = Window.partitionBy("event_id", "part_id").orderBy("at", "side", "node")
    rows = held.withColumn("side", F.lit(1)).unionByName(ends).withColumn("v", F.lead("node").over(order)).withColumn("cost", F.lead("at").over(order) - F.col("at"))
    both = rows.where("v IS NOT NULL AND v != node").select("event_id", F.inline(F.array(F.struct(F.col("node").alias("u"), "v", "cost"), F.struct(F.col("v").alias("u"), F.col("node").alias("v"), "cost"))))
    return both.groupBy("event_id", "u", "v").agg(F.min("cost").alias("cost"))


def coast_edges(nodes: DataFrame, lengths: DataFrame) -> DataFrame:
    """(u, v, cost) of whole parts between their ends, as ``station_edges`` names them."""
    return part_edges(nodes, lengths).select((-1 - F.col("u")).alias("u"), (-1 - F.col("v")).alias("v"), "cost")


def station_distances(points: DataFrame, sources: DataFrame, nodes: DataFrame, lengths: DataFrame, cap: float) -> DataFrame:
    """(event_id, source, node, cost): along the coast between an event's points, if not above ``cap``. points: as in
    ``station_edges``; sources: event_id, source, some of the points.

    A way stays in its part or leaves it by an end: so only the ends' ways to each other, few however many points there are, are searched in
    rounds. Where a point lies in several parts, ways lead through it, and the points themselves are searched.
    """
    held = points.join(lengths, "part_id").select("event_id", "part_id", "node", F.least("length_m", F.greatest(F.lit(0.0), "station_m")).alias("at"), "length_m")
    held = written(held.distinct(), "stations")
    if not held.groupBy("event_id", "node").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        edges, shared = written(station_edges(points, nodes, lengths), "station-edges"), written(coast_edges(nodes, lengths), "coast-edges")
        return shortest(edges, sources, cap, ["event_id"], shared).where("node >= 0").select("event_id", "source", "node", "cost")
    pair, near = ["event_id", "source", "node"], F.col("cost") <= cap
    start = sources.distinct().join(held.withColumnRenamed("node", "source"), ["event_id", "source"])
    other = held.select("event_id", "part_id", "node", F.col("at").alias("at2"))
    within = start.join(other, ["event_id", "part_id"]).select(*pair, F.abs(F.col("at") - F.col("at2")).alias("cost")).where(near)
    ends = nodes.select("part_id", "end", F.col("node").alias("u"))
    leave = F.when(F.col("end") == 0, F.col("at")).otherwise(F.col("length_m") - F.col("at")).alias("cost")
    out = start.join(ends, "part_id").select("event_id", "source", "u", leave).where(near)
    ways = distances(part_edges(nodes, lengths), nodes.select(F.col("node").alias("source")), cap).select(F.col("source").alias("u"), F.col("node").alias("v"), F.col("cost").alias("way"))
    out = out.join(ways, "u").groupBy("event_id", "source", "v").agg(F.min(F.col("cost") + F.col("way")).alias("so_far")).where(F.col("so_far") <= cap)
    reach = held.join(ends.withColumnRenamed("u", "v"), "part_id").select("event_id", "node", "v", leave.alias("last"))
    across = out.join(reach, ["event_id", "v"]).select(*pair, (F.col("so_far") + F.col("last")).alias("cost")).where(near)
    itself = sources.distinct().where("source >= 0").select("event_id", "source", F.col("source").alias("node"), F.lit(0.0).alias("cost"))
    return within.unionByName(across).unionByName(itself).groupBy(*pair).agg(F.min("cost").alias("cost"))


def distances(edges: DataFrame, sources: DataFrame, cap: float) -> DataFrame:
    """(source, node, cost): the least cost between nodes, if not above ``cap``. edges: u, v, cost; sources: source."""
    return shortest(edges, sources, cap).select("source", "node", "cost")
