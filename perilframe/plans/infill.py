"""Infill of the coast between an event's run-up segments: by rules, by evidence, by coverage, and by chains over the coast network.

Segments and their gaps are intervals of metres along a part (event_id, part_id, s0, s1); amplifiers are stations (event_id, part_id,
station_m) of low run-ups or of ray hits. Everything that looks for neighbours along a part is an as-of search (a union and a window);
what lies on other parts is reached over the coast network, whose parts meet where their ends do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from perilframe import network
from perilframe.io import written
from perilframe.operators import joins, sequence

KEYS = ["event_id", "part_id"]
LOW_M, HIGH_M = 0.2, 0.5
ROUTE = "event_id long, part_a long, station_a double, part_b long, station_b double, length_m double"


def low_runups(snapped: DataFrame, low_m: float = LOW_M, high_m: float = HIGH_M) -> DataFrame:
    """(event_id, part_id, station_m) of run-ups with low <= height < high; snapped: event_id, part_id, station_m, h."""
    return sequence.in_band(snapped, "h", low_m, high_m).select(*KEYS, "station_m")


def amplifiers(low: DataFrame, hits: DataFrame | None = None) -> DataFrame:
    """Stations of low run-ups and, if given, of ray hits."""
    rows = low.select(*KEYS, "station_m")
    return (rows if hits is None else rows.unionByName(hits.select(*KEYS, "station_m"))).where("station_m IS NOT NULL").distinct()


def _seen(points: DataFrame) -> DataFrame:
    return points.select(*KEYS, F.col("station_m").cast("double").alias("_at"))


def _gaps(base: DataFrame, merge_m: float = 1.0) -> DataFrame:
    return sequence.gaps(sequence.merge_intervals(base.select(*KEYS, "s0", "s1"), KEYS, merge_m), KEYS).where("g1 > g0")


def rulebased_decisions(base: DataFrame, points: DataFrame, cap_m: float = 250_000.0, eps_m: float = 10_000.0) -> DataFrame:
    """(event_id, part_id, g0, g1, left_to, right_from, passed, reason) of each gap between an event's segments on one part.

    A gap of at most ``cap_m`` is bridged whole. Of a longer one, a piece from its left edge to the next amplifier, ``left_to``, and one from
    the last amplifier before its right edge, ``right_from``, are bridged, if the amplifier lies within ``eps_m`` of the edge
    and the piece is at most ``cap_m`` long. An amplifier just outside the gap is near an edge, too, but makes no piece.
    """
    gaps = _gaps(base)
    seen, has = _seen(points), points.select(*KEYS).distinct().withColumn("_any", F.lit(True))
    for name, at, ahead in (("_lb", "g0", False), ("_la", "g0", True), ("_rb", "g1", False), ("_ra", "g1", True)):
        gaps = sequence.asof(gaps, seen, KEYS, at, name, ahead, strict=not ahead)
    gaps = gaps.join(has, KEYS, "left")
    whole = F.col("g1") - F.col("g0") <= cap_m

    def near(name, at) -> Column:
        return F.coalesce(F.abs(F.col(name)["_at"] - F.col(at)) <= eps_m, F.lit(False))

    def piece(name, at, length) -> Column:
        return F.when(~whole & near(name, at) & (length > 0) & (length <= cap_m), F.col(name)["_at"])

    left, right = piece("_la", "g0", F.col("_la._at") - F.col("g0")), piece("_rb", "g1", F.col("g1") - F.col("_rb._at"))
    by_left, by_right = near("_lb", "g0") | near("_la", "g0"), near("_rb", "g1") | near("_ra", "g1")
    gaps = gaps.select(*KEYS, "g0", "g1", left.alias("left_to"), right.alias("right_from"), by_left.alias("_l"), by_right.alias("_r"), "_any", whole.alias("_whole"))
    made = F.col("left_to").isNotNull() | F.col("right_from").isNotNull()
    reason = (
        F.when(F.col("_whole"), "unconditional").when(made & F.col("_l") & F.col("_r"), "amp_both_edges_ok").when(made & F.col("_l"), "amp_left_ok").when(made, "amp_right_ok")
        .when(F.col("_l") | F.col("_r"), "amp_near_edge_but_subgap_too_long").when(F.col("_any").isNull(), "no_amplifiers_available").otherwise("no_amplifiers_near_edges")
    )
    return gaps.select(*KEYS, "g0", "g1", "left_to", "right_from", (F.col("_whole") | made).alias("passed"), reason.alias("reason"))


def rulebased_bridges(decisions: DataFrame) -> DataFrame:
    """(event_id, part_id, s0, s1): what the decisions bridge, merged."""
    whole = F.when(F.col("reason") == "unconditional", F.struct(F.col("g0").alias("s0"), F.col("g1").alias("s1")))
    left = F.when(F.col("left_to").isNotNull(), F.struct(F.col("g0").alias("s0"), F.col("left_to").alias("s1")))
    right = F.when(F.col("right_from").isNotNull(), F.struct(F.col("right_from").alias("s0"), F.col("g1").alias("s1")))
    rows = decisions.where("passed").select(*KEYS, F.inline(F.filter(F.array(whole, left, right), lambda x: x.isNotNull())))
    return sequence.merge_intervals(rows.where("s1 > s0"), KEYS, 1.0).drop("n")


def routes(pairs: DataFrame, nodes: DataFrame, lengths: DataFrame, cap_m: float) -> DataFrame:
    """``pairs`` (event_id, part_a, station_a, part_b, station_b) with ``length_m``, the way along the coast network from a to b, if at most ``cap_m``."""
    sides = F.array(*(F.struct(F.col(f"part_{k}").alias("part_id"), F.col(f"station_{k}").alias("station_m")) for k in "ab"))
    pairs = written(pairs.select(*ROUTE.split()[0:9:2]), "pairs")
    points = pairs.select("event_id", F.inline(sides)).distinct()
    points = written(points.withColumn("node", F.row_number().over(Window.partitionBy("event_id").orderBy("part_id", "station_m")).cast("long")), "points")
    named = pairs
    for k, name in (("a", "source"), ("b", "node")):
        named = named.join(points.select("event_id", F.col("part_id").alias(f"part_{k}"), F.col("station_m").alias(f"station_{k}"), F.col("node").alias(name)), ["event_id", f"part_{k}", f"station_{k}"])
    named = written(named, "named-pairs")
    ways = network.station_distances(points, named.select("event_id", "source"), nodes, lengths, cap_m)
    return named.join(ways.withColumnRenamed("cost", "length_m"), ["event_id", "source", "node"]).select(*ROUTE.split()[::2])


def cross_part_pairs(segments: DataFrame, segs: DataFrame, max_m: float) -> DataFrame:
    """Right ends of an event's segments with left ends on other parts at most ``max_m`` away: event_id, right_part, right_s,
    left_part, left_s, distance_m. segments: event_id, part_id, s0, s1; segs: the parts' line segments."""
    both = F.inline(F.array(F.struct(F.lit("l").alias("side"), F.col("s0").alias("station_m")), F.struct(F.lit("r").alias("side"), F.col("s1").alias("station_m"))))
    at = sequence.located(segs, segments.select("event_id", "part_id", both).distinct())
    right = at.where("side = 'r'").select("event_id", F.col("part_id").alias("right_part"), F.col("station_m").alias("right_s"), "x", "y")
    left = at.where("side = 'l'").select("event_id", F.col("part_id").alias("left_part"), F.col("station_m").alias("left_s"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    pairs = joins.near_pairs(right, left, max_m, F.col("right_part") != F.col("left_part"), ["event_id"])
    return pairs.select("event_id", "right_part", "right_s", "left_part", "left_s", "distance_m")


def cross_part_bridges(base: DataFrame, segs: DataFrame, cap_m: float = 250_000.0, snap_m: float = 250.0) -> DataFrame:
    """(event_id, part_a, station_a, part_b, station_b, length_m): from the right end of a segment to the left end of one on another part,
    along the coast, at most ``cap_m`` long; each pair of ends once. A way along the coast is no shorter than the straight one,
    so only ends within ``cap_m`` of each other are tried."""
    base = sequence.merge_intervals(base.select(*KEYS, "s0", "s1"), KEYS, 1.0)
    pairs = cross_part_pairs(base, segs, cap_m)
    a, b = F.struct(F.col("right_part").alias("part"), F.col("right_s").alias("s")), F.struct(F.col("left_part").alias("part"), F.col("left_s").alias("s"))
    pairs = pairs.select("event_id", F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
    pairs = pairs.select("event_id", F.col("a.part").alias("part_a"), F.col("a.s").alias("station_a"), F.col("b.part").alias("part_b"), F.col("b.s").alias("station_b"))
    return routes(pairs, network.stitched_nodes(segs, snap_m), joins.part_lengths(segs), cap_m)


# --------------------------------------------------------------------------------------------------- by evidence


def _covered_to(rows: DataFrame, base: DataFrame, at: str, name: str) -> DataFrame:
    """Adds the length of the disjoint intervals ``base`` before each row's ``at``."""
    before = Window.partitionBy(*KEYS).orderBy("s0").rowsBetween(Window.unboundedPreceding, -1)
    sums = base.select(*KEYS, F.col("s0").alias("_at"), "s0", "s1", F.coalesce(F.sum(F.col("s1") - F.col("s0")).over(before), F.lit(0.0)).alias("past"))
    rows = sequence.asof(rows, sums, KEYS, at, "_b")
    return rows.withColumn(name, F.coalesce(F.col("_b.past") + F.least(F.col(at), F.col("_b.s1")) - F.col("_b.s0"), F.lit(0.0))).drop("_b")


def evidence_clusters(points: DataFrame, base: DataFrame, eps_m: float = 15_000.0, least: int = 2, majority: float = 0.5, bridge_m: float = 20_000.0, combined: float = 0.6, zero_cover: bool = False, one_side: bool = False, singletons: bool = False, seed_m: float | None = None) -> DataFrame:
    """(event_id, part_id, c0, c1, n, cover, accepted, reason, s0, s1) of each cluster of low run-ups, with what it adds.

    Stations of at most ``eps_m`` between neighbours are a cluster; ``cover`` is the share that base intervals cover. Reasons in this order: ``min_samples``
    (rejected: fewer than ``least``, unless one alone is allowed), ``majority`` (cover enough), ``bridge`` (base on both sides, the gap between them at
    most ``bridge_m``, and cover ``combined`` or none asked for), ``one_side`` (the same for the nearer side, where allowed), ``overlap`` (it touches a base interval),
    ``proximity`` (a single station, no base on one side but some within ``bridge_m``, where no cover is asked for), ``seed`` (no base on the part, where ``seed_m``
    is given: an interval of that length at least about the middle), else rejected for ``no_base_for_part``, ``no_left_or_right``,
    ``bridge_gap_large`` or ``cover_too_small``.
    """
    base = sequence.merge_intervals(base.select(*KEYS, "s0", "s1"), KEYS, 1.0).drop("n")
    rows = sequence.cluster_1d(points.select(*KEYS, "station_m"), KEYS, "station_m", eps_m).groupBy(*KEYS, "cluster").agg(F.min("station_m").alias("c0"), F.max("station_m").alias("c1"), F.count(F.lit(1)).alias("n"))
    rows = _covered_to(_covered_to(rows, base, "c0", "_f0"), base, "c1", "_f1")
    starts, ends = base.select(*KEYS, F.col("s0").alias("_at"), "s1"), base.select(*KEYS, F.col("s1").alias("_at"))
    rows = sequence.asof(rows, ends, KEYS, "c0", "_left")
    rows = sequence.asof(rows, starts, KEYS, "c1", "_right", ahead=True)
    rows = sequence.asof(rows, starts, KEYS, "c1", "_upto")
    rows = rows.join(base.select(*KEYS).distinct().withColumn("_base", F.lit(True)), KEYS, "left")
    span, has = F.col("c1") - F.col("c0"), F.col("_base").isNotNull()
    cover = F.when(span > 0, (F.col("_f1") - F.col("_f0")) / F.greatest(F.lit(1.0), span)).otherwise(0.0)
    left, right = F.col("_left._at"), F.col("_right._at")
    enough = F.lit(True) if zero_cover else cover >= combined
    gap = right - left  # null without both; the cluster lies between them
    nearer = F.least(F.col("c0") - left, right - F.col("c1"))
    overlap = F.coalesce(F.col("_upto.s1") >= F.col("c0"), F.lit(False))
    few = F.col("n") < least
    few = few & (F.col("n") != 1) if singletons else few
    reason = F.when(few, "min_samples").when(cover >= majority, "majority").when((gap <= bridge_m) & enough, "bridge")
    if one_side:
        reason = reason.when((nearer <= bridge_m) & enough, "one_side")
    reason = reason.when(overlap, "overlap")
    if zero_cover:
        reason = reason.when((span <= 0) & left.isNull() & right.isNull() & has, "proximity")
    if seed_m is not None:
        reason = reason.when(~has, "seed")
    reason = reason.when(~has, "no_base_for_part").when(left.isNull() | right.isNull(), "no_left_or_right").when(gap > bridge_m, "bridge_gap_large").otherwise("cover_too_small")
    rows = rows.select(*KEYS, "c0", "c1", "n", cover.alias("cover"), reason.alias("reason"))
    accepted = F.col("reason").isin("majority", "bridge", "one_side", "overlap", "proximity", "seed")
    half, mid = F.greatest(F.lit(float(seed_m or 0.0)), F.col("c1") - F.col("c0")) / 2.0, (F.col("c0") + F.col("c1")) / 2.0
    seeded = F.col("reason") == "seed"
    s0, s1 = F.when(seeded, mid - half).when(accepted, F.col("c0")), F.when(seeded, mid + half).when(accepted, F.col("c1"))
    return rows.select(*KEYS, "c0", "c1", "n", "cover", accepted.alias("accepted"), "reason", s0.alias("s0"), s1.alias("s1"))


def scored_gaps(base: DataFrame, points: DataFrame, lengths: DataFrame, eps_m: float = 8_000.0, std_m: float = 40_000.0, long_m: float = 100_000.0, w_edges: float = 1.0, w_length: float = 0.7, power: float = 1.2, tau: float = 0.2, tau_step: float = 0.15, free_m: float | None = None) -> DataFrame:
    """(event_id, part_id, g0, g1, edges, score, accepted, reason, seed_at, s0, s1) of each gap of at most ``long_m``, with the padded bridge.

    ``edges`` counts the gap's ends with a low run-up within ``eps_m``; the score is w_edges * edges - w_length * (length / long_m) ** power. Accepted are gaps of at most
    ``free_m``, if given (``unconditional``); then those with a low run-up inside that is at most ``free_m`` from both ends (``seed``, at
    ``seed_at``); then tier by tier longer gaps of higher scores: ``tier_1`` up to std_m from tau, ``tier_2`` up to the mean of both lengths from tau + tau_step, ``tier_3``
    up to long_m from tau + 2 * tau_step. Bridges are padded and stay on the part.
    """
    gaps, seen = _gaps(base).where(F.col("g1") - F.col("g0") <= long_m), _seen(points)
    length, pad = F.col("g1") - F.col("g0"), min(eps_m, 0.5 * std_m)
    middle = gaps.withColumn("_mid", (F.col("g0") + F.col("g1")) / 2.0)
    for name, at, ahead in (("_lb", "g0", False), ("_la", "g0", True), ("_rb", "g1", False), ("_ra", "g1", True), ("_mb", "_mid", False), ("_ma", "_mid", True)):
        middle = sequence.asof(middle, seen, KEYS, at, name, ahead, strict=not ahead)

    def hit(at, *names) -> Column:
        return F.coalesce(F.least(*(F.abs(F.col(n)["_at"] - F.col(at)) for n in names)) <= eps_m, F.lit(False)).cast("int")

    def inside(name) -> Column:  # the station nearest to the middle is the one whose longer side is the shortest
        return F.when((F.col(name)["_at"] > F.col("g0")) & (F.col(name)["_at"] < F.col("g1")), F.struct(F.greatest(F.col(name)["_at"] - F.col("g0"), F.col("g1") - F.col(name)["_at"]).alias("far"), F.col(name)["_at"].alias("at")))

    edges = hit("g0", "_lb", "_la") + hit("g1", "_rb", "_ra")
    rows = middle.select(*KEYS, "g0", "g1", edges.alias("edges"), (w_edges * edges - w_length * F.pow(length / long_m, power)).alias("score"), F.least(inside("_mb"), inside("_ma")).alias("_seed"))
    reason = F
    if free_m is not None:
        reason = reason.when(length <= free_m, "unconditional").when(F.col("_seed.far") <= free_m, "seed")
    reason = (
        reason.when((length <= std_m) & (F.col("score") >= tau), "tier_1").when((length <= 0.5 * (std_m + long_m)) & (F.col("score") >= tau + tau_step), "tier_2")
        .when(F.col("score") >= tau + 2 * tau_step, "tier_3").otherwise("score_too_small")
    )
    rows = rows.withColumn("reason", reason).withColumn("seed_at", F.when(F.col("reason") == "seed", F.col("_seed.at"))).join(lengths, "part_id")
    accepted = F.col("reason") != "score_too_small"
    s0, s1 = F.when(accepted, F.greatest(F.lit(0.0), F.col("g0") - pad)), F.when(accepted, F.least("length_m", F.col("g1") + pad))
    return rows.select(*KEYS, "g0", "g1", "edges", "score", accepted.alias("accepted"), "reason", "seed_at", s0.alias("s0"), s1.alias("s1"))


def evidence_segments(clusters: DataFrame, gaps: DataFrame, lengths: DataFrame) -> DataFrame:
    """(event_id, part_id, s0, s1): what accepted clusters and gaps add, merged, within the part."""
    rows = clusters.where("accepted").select(*KEYS, "s0", "s1").unionByName(gaps.where("accepted").select(*KEYS, "s0", "s1"))
    rows = sequence.merge_intervals(rows, KEYS, 1.0).join(lengths, "part_id")
    return rows.select(*KEYS, F.greatest(F.lit(0.0), "s0").alias("s0"), F.least("length_m", "s1").alias("s1")).where("s1 > s0")


# --------------------------------------------------------------------------------------------------- by coverage


def coverage(base: DataFrame, snapped: DataFrame, lengths: DataFrame, pad_m: float = 1_000.0, least_h: float = LOW_M, km_per_m: float = 60.0, low_km: float = 20.0, high_km: float = 200.0, merge_m: float = 2_000.0) -> DataFrame:
    """(event_id, part_id, s0, s1): base segments and seed intervals about run-ups, long in proportion to their height, padded and merged."""
    half = F.least(F.lit(high_km), F.greatest(F.lit(low_km), F.greatest(F.coalesce("h", F.lit(least_h)), F.lit(least_h)) * km_per_m)) * 500.0

    def padded(rows: DataFrame, by: Column) -> DataFrame:
        """Intervals widened by ``by`` at both ends, within the part."""
        rows = rows.withColumn("_by", by).join(lengths, "part_id")
        return rows.select(*KEYS, F.greatest(F.lit(0.0), F.col("s0") - F.col("_by")).alias("s0"), F.least(F.col("length_m"), F.col("s1") + F.col("_by")).alias("s1")).where("s1 > s0")

    at = F.col("station_m")
    seeds = padded(snapped.where("station_m IS NOT NULL").select(*KEYS, at.alias("s0"), at.alias("s1"), "h"), half + pad_m)
    both = base.select(*KEYS, "s0", "s1").unionByName(sequence.merge_intervals(seeds, KEYS, merge_m).select(*KEYS, "s0", "s1"))
    return sequence.merge_intervals(padded(both, F.lit(pad_m)), KEYS, pad_m).drop("n")


def coverage_bridges(cover: DataFrame, points: DataFrame, lengths: DataFrame, cap_m: float = 250_000.0, pad_m: float = 1_000.0) -> DataFrame:
    """(event_id, part_id, g0, g1, pieces, longest_m, passed): the gaps of a part with cover, its head and tail included.

    Amplifiers more than ``pad_m`` from its ends cut a gap into pieces; it is bridged if it is at most ``cap_m`` long, or cut into pieces that
    all are. (A long gap without amplifiers isn't bridged: the cap is a hard one.)
    """
    gaps = sequence.gaps(cover.select(*KEYS, "s0", "s1"), KEYS, lengths).where("g1 > g0")
    cuts = sequence.asof(points.select(*KEYS, "station_m"), gaps.select(*KEYS, F.col("g0").alias("_at"), "g1"), KEYS, "station_m", "_gap")
    cuts = cuts.where((F.col("station_m") > F.col("_gap._at") + pad_m) & (F.col("station_m") < F.col("_gap.g1") - pad_m)).select(*KEYS, F.col("_gap._at").alias("g0"), F.col("_gap.g1").alias("g1"), F.col("station_m").alias("at")).distinct()
    marks = cuts.unionByName(gaps.select(*KEYS, "g0", "g1", F.col("g0").alias("at")))
    steps = marks.withColumn("to", F.coalesce(F.lead("at").over(Window.partitionBy(*KEYS, "g0").orderBy("at")), "g1"))
    rows = steps.groupBy(*KEYS, "g0", "g1").agg(F.count(F.lit(1)).alias("pieces"), F.max(F.col("to") - F.col("at")).alias("longest_m"))
    passed = (F.col("g1") - F.col("g0") <= cap_m) | ((F.col("pieces") > 1) & (F.col("longest_m") <= cap_m))
    return rows.select(*KEYS, "g0", "g1", "pieces", "longest_m", passed.alias("passed"))


def coverage_segments(bridges: DataFrame, pad_m: float = 1_000.0) -> DataFrame:
    """(event_id, part_id, s0, s1): the bridged gaps, merged."""
    return sequence.merge_intervals(bridges.where("passed").select(*KEYS, F.col("g0").alias("s0"), F.col("g1").alias("s1")), KEYS, pad_m).drop("n")


def coverage_cross_bridges(cover: DataFrame, segs: DataFrame, cap_m: float = 250_000.0, pad_m: float = 1_000.0, snap_m: float = 250.0) -> DataFrame:
    """(event_id, part_a, station_a, part_b, station_b, length_m): from each boundary of the cover within ``pad_m`` of its part's end to the nearest such boundary
    of another part (straight; the lower part and station of equals), along the coast and at most ``cap_m`` long. Each pair once."""
    lengths = joins.part_lengths(segs)
    ends = cover.join(lengths, "part_id").select(*KEYS, "length_m", F.explode(F.array("s0", "s1")).alias("station_m")).where((F.col("station_m") <= pad_m) | (F.col("length_m") - F.col("station_m") <= pad_m))
    at = written(sequence.located(segs, ends.select(*KEYS, "station_m").distinct()), "cover-ends")
    other = at.select("event_id", F.col("part_id").alias("part_b"), F.col("station_m").alias("station_b"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    pairs = joins.near_pairs(at, other, cap_m, F.col("part_id") != F.col("part_b"), ["event_id"])
    best = pairs.groupBy(*KEYS, "station_m").agg(F.min(F.struct("distance_m", "part_b", "station_b")).alias("n"))
    a, b = F.struct(F.col("part_id").alias("part"), F.col("station_m").alias("s")), F.struct(F.col("n.part_b").alias("part"), F.col("n.station_b").alias("s"))
    once = best.select("event_id", F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
    once = once.select("event_id", F.col("a.part").alias("part_a"), F.col("a.s").alias("station_a"), F.col("b.part").alias("part_b"), F.col("b.s").alias("station_b"))
    return routes(once, network.stitched_nodes(segs, snap_m), lengths, cap_m)


# ----------------------------------------------------------------------------------------------------- by chains


def chain_nodes(base: DataFrame, boosters: DataFrame | None = None) -> DataFrame:
    """(event_id, node, kind, part_id, station_m): ``term`` for both ends of each segment, ``aux`` for boosters (event_id, part_id, station_m)."""
    rows = base.select(*KEYS, F.explode(F.array("s0", "s1")).alias("station_m")).distinct().withColumn("kind", F.lit("term"))
    if boosters is not None:
        rows = rows.unionByName(boosters.select(*KEYS, "station_m").distinct().withColumn("kind", F.lit("aux")))
    return _numbered(rows)


def _numbered(rows: DataFrame) -> DataFrame:
    """Nodes of an event numbered from 1: terminals first, so that they keep their numbers when others are added."""
    order = Window.partitionBy("event_id").orderBy(F.desc("kind"), "part_id", "station_m")
    return written(rows.select(*KEYS, "station_m", "kind").distinct().withColumn("node", F.row_number().over(order).cast("long")), "chain-nodes")


def chain_edges(nodes: DataFrame, places: DataFrame, coast: DataFrame, lengths: DataFrame, hop_m: float, k: int) -> DataFrame:
    """(event_id, u, v, cost): from each node to its ``k`` nearest neighbours, of each part the nearest, if one end is a terminal and the way
    along the coast is at most ``hop_m``. places: part_id, station_m, x, y of the nodes' stations; coast: the stitched ends of the parts."""
    at = written(nodes.join(places, ["part_id", "station_m"]), "chain-points")
    other = at.select("event_id", F.col("node").alias("v"), F.col("part_id").alias("part_v"), F.col("kind").alias("kind_v"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    pairs = joins.near_pairs(at, other, hop_m, F.col("node") != F.col("v"), ["event_id"])
    near = pairs.groupBy("event_id", "node", "kind", "part_v").agg(F.min(F.struct("distance_m", "kind_v", "v")).alias("n"))
    place = F.row_number().over(Window.partitionBy("event_id", "node").orderBy("n.distance_m", "n.v"))
    meta = near.withColumn("_place", place).where((F.col("_place") <= k) & ((F.col("kind") == "term") | (F.col("n.kind_v") == "term")))
    meta = written(meta.select("event_id", F.col("node").alias("u"), F.col("n.v").alias("v"), (F.col("kind") == "term").alias("_from")), "meta-edges")
    # ways are the same in both directions, so they are looked for from terminals only
    asked = meta.select("event_id", F.when(F.col("_from"), F.col("u")).otherwise(F.col("v")).alias("source"), F.when(F.col("_from"), F.col("v")).otherwise(F.col("u")).alias("node"), "u", "v")
    ways = network.station_distances(nodes.select("event_id", "node", "part_id", "station_m"), asked.select("event_id", "source"), coast, lengths, hop_m)
    return written(asked.join(ways, ["event_id", "source", "node"]).select("event_id", "u", "v", "cost"), "meta-lengths")


def infill_chain(base: DataFrame, segs: DataFrame, boosters: DataFrame | None = None, hop_m: float = 750_000.0, total_m: float = 750_000.0, k: int = 6, passes: int = 3, snap_m: float = 250.0) -> DataFrame:
    """(event_id, pass, part_start, station_start, part_end, station_end, hops, length_m): from each terminal, an end of a segment, the shortest
    chain to a terminal on another part, every hop at most ``hop_m`` and all of it at most ``total_m`` along the coast.

    Hops go over the meta-edges of ``chain_edges``; chains pass boosters and terminals of the part that they start from. After each of
    at most ``passes`` passes the ends of its chains join the nodes, of the kind that boosters are, for longer chains; a pass that gives no new pair of
    ends is the last. Of equal lengths the least node counts.
    """
    coast, lengths = written(network.stitched_nodes(segs, snap_m), "coast-nodes"), written(joins.part_lengths(segs), "part-lengths")
    nodes, out = chain_nodes(base, boosters), None
    # later passes add no stations, so the segments of the coast, many more than the stations, are gone through once
    places = written(sequence.located(segs, nodes.select("part_id", "station_m").distinct()), "chain-places")
    for step in range(1, passes + 1):
        edges = chain_edges(nodes, places, coast, lengths, hop_m, k)
        names = nodes.where("kind = 'term'").select("event_id", F.col("node").alias("v"), F.col("part_id").alias("_part"))
        from_part = names.select("event_id", F.col("v").alias("source"), F.col("_part").alias("part_start"))
        # the part of the end is carried in the edges, and that of the start in the source, so that a goal is known where it is reached
        tagged = written(edges.join(names.select("event_id", "v", F.col("_part").alias("goal_part")), ["event_id", "v"], "left"), "tagged-edges")
        ways = _ways_to_goals(tagged, from_part, total_m)
        goal = ways.groupBy("event_id", "source").agg(F.min(F.struct("cost", "node", "hops")).alias("g"))
        at = nodes.select("event_id", "node", "part_id", "station_m")
        a, b = (at.select("event_id", F.col("node").alias(n), F.col("part_id").alias(f"part_{w}"), F.col("station_m").alias(f"station_{w}")) for n, w in (("source", "start"), ("node", "end")))
        found = goal.select("event_id", "source", F.col("g.node").alias("node"), F.col("g.hops").alias("hops"), F.col("g.cost").alias("length_m")).join(a, ["event_id", "source"]).join(b, ["event_id", "node"])
        found = found.select("event_id", F.lit(step).alias("pass"), "part_start", "station_start", "part_end", "station_end", "hops", "length_m")
        if out is not None:
            found = found.join(out.select("event_id", "part_start", "station_start", "part_end", "station_end"), ["event_id", "part_start", "station_start", "part_end", "station_end"], "left_anti").select(*out.columns)
        found = written(found, "chains")
        if found.isEmpty():
            return found if out is None else out
        out = found if out is None else written(out.unionByName(found), "all-chains")
        if step < passes:
            ends = F.inline(F.array(*(F.struct(F.col(f"part_{w}").alias("part_id"), F.col(f"station_{w}").alias("station_m")) for w in ("start", "end"))))
            nodes = _numbered(nodes.select(*KEYS, "station_m", "kind").unionByName(found.select("event_id", ends, F.lit("aux").alias("kind"))))
    return out


def _ways_to_goals(edges: DataFrame, sources: DataFrame, cap: float) -> DataFrame:
    """(event_id, source, node, cost, hops) for the terminals on other parts that each source reaches; ways end there. edges: event_id, u, v, cost, goal_part
    (the part of v if it is a terminal); sources: event_id, source, part_start."""
    keys = ["event_id", "source", "part_start", "node", "goal_part"]
    best = sources.select("event_id", "source", "part_start", F.col("source").alias("node"), F.col("part_start").alias("goal_part"), F.struct(F.lit(0.0).alias("cost"), F.lit(0).alias("hops")).alias("way"), F.lit(True).alias("fresh"))
    while True:
        last = best.where("fresh AND (goal_part IS NULL OR goal_part = part_start)").select("event_id", "source", "part_start", F.col("node").alias("u"), F.col("way").alias("so_far"))
        step = last.join(edges, ["event_id", "u"]).select("event_id", "source", "part_start", F.col("v").alias("node"), "goal_part", F.struct((F.col("so_far.cost") + F.col("cost")).alias("cost"), (F.col("so_far.hops") + 1).alias("hops")).alias("way")).where(F.col("way.cost") <= cap)
        both = best.select(*keys, "way", F.col("way").alias("was")).unionByName(step.withColumn("was", F.lit(None).cast("struct<cost:double,hops:int>")))
        best = both.groupBy(*keys).agg(F.min("way").alias("way"), F.min("was").alias("was"))
        best = written(best.select(*keys, "way", (F.col("was").isNull() | (F.col("way") < F.col("was"))).alias("fresh")), "chain-ways")
        if best.where("fresh").isEmpty():
            return best.where("goal_part != part_start").select("event_id", "source", "node", "way.cost", "way.hops")
