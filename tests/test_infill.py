"""Infill of coast gaps and the coast network between stations, against plain Python on made-up coasts."""

import heapq
import math
import random
from bisect import bisect_left

import pytest
from pyspark.sql import functions as F

from perilframe import network
from perilframe.operators import joins, sequence
from perilframe.plans import infill, infill_queries, tsunami

BASE, POINTS = "event_id long, part_id long, s0 double, s1 double", "event_id long, part_id long, station_m double"


def merged(rows, gap):
    out = []
    for a, b in sorted(rows):
        if out and a - out[-1][1] <= gap:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


@pytest.fixture(scope="module")
def made():
    """(base, points, lengths) as lists: two events on six parts, with every kind of gap and cluster."""
    draw = random.Random(3)
    lengths = {p: draw.uniform(200_000.0, 2_500_000.0) for p in range(6)}
    base, points = [], []
    for e in (1, 2):
        for p in lengths:
            at = draw.uniform(0, 60_000)
            while p != 5 and at < lengths[p]:
                base.append((e, p, at, min(lengths[p], at + draw.choice([500.0, 8_000.0, 60_000.0]))))
                at += draw.choice([9_000.0, 30_000.0, 55_000.0, 90_000.0, 200_000.0, 320_000.0, 600_000.0])
            if p != 4:
                points += [(e, p, draw.uniform(0, lengths[p])) for _ in range(25)]
                for b in [b for b in base if b[:2] == (e, p)]:
                    points += [(e, p, b[draw.choice([2, 3])] + draw.choice([-9_000.0, -3_000.0, 0.0, 4_000.0, 9_500.0]))] * draw.randint(0, 2)
    points = [(e, p, min(lengths[p], max(0.0, s))) for e, p, s in points]
    return base + base[:3], points + [points[0]], lengths


def keyed(rows):
    out = {}
    for e, p, *x in rows:
        out.setdefault((e, p), []).append(x[0] if len(x) == 1 else tuple(x))
    return out


def close(got, want):
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=str), sorted(want, key=str)):
        assert len(a) == len(b) and all(x == y or isinstance(x, float) and isinstance(y, float) and abs(x - y) < 1e-6 for x, y in zip(a, b)), (a, b)


def rounded(rows):
    return [tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows]


def test_asof(spark):
    draw = random.Random(1)
    rows, seen = ([(draw.randint(0, 2), draw.randint(0, 30) * 1.0) for _ in range(80)] for _ in range(2))
    a = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, k long, at double")
    b = spark.createDataFrame([(k, s, int(s * 10)) for k, s in seen], "k long, _at double, value long")
    for ahead in (False, True):
        for strict in (False, True):
            for r in sequence.asof(a, b, ["k"], "at", "m", ahead, strict).collect():
                fit = [s for k, s in seen if k == r.k and ((s > r.at if ahead else s < r.at) or (s == r.at and not strict))]
                want = (min if ahead else max)(fit) if fit else None
                assert (r.m._at if r.m else None) == want and (not r.m or r.m.value == int(want * 10))
    assert sequence.asof(a, b.limit(0), ["k"], "at", "m").where("m IS NOT NULL").isEmpty()


def test_rulebased(spark, made):
    base, points, _ = made
    cap, eps, want, pieces = 250_000.0, 10_000.0, [], []
    stations = keyed(points)
    for (e, p), ivals in keyed(base).items():
        s, ivals = sorted(set(stations.get((e, p), []))), merged(ivals, 1.0)
        for (_, b0), (a1, _) in zip(ivals, ivals[1:]):
            left_to = right_from = None
            if a1 - b0 <= cap:
                reason, ok = "unconditional", True
                pieces.append((e, p, b0, a1))
            else:
                near = [[x for x in s[max(0, bisect_left(s, at) - 1) : bisect_left(s, at) + 1] if abs(x - at) <= eps] for at in (b0, a1)]
                for x in near[0]:
                    if 0 < x - b0 <= cap:
                        left_to = x
                        pieces.append((e, p, b0, x))
                for x in near[1]:
                    if 0 < a1 - x <= cap:
                        right_from = x
                        pieces.append((e, p, x, a1))
                ok = left_to is not None or right_from is not None
                if ok:
                    reason = "amp_both_edges_ok" if near[0] and near[1] else "amp_left_ok" if near[0] else "amp_right_ok"
                else:
                    reason = "no_amplifiers_available" if not s else "amp_near_edge_but_subgap_too_long" if near[0] or near[1] else "no_amplifiers_near_edges"
            want.append((e, p, b0, a1, left_to, right_from, ok, reason))
    b, pts = spark.createDataFrame(base, BASE), infill.amplifiers(spark.createDataFrame(points, POINTS))
    got = infill.rulebased_decisions(b, pts, cap, eps)
    close([tuple(r) for r in got.collect()], want)
    assert {"unconditional", "amp_both_edges_ok", "amp_left_ok", "amp_right_ok", "no_amplifiers_available", "no_amplifiers_near_edges"} <= {w[-1] for w in want}
    bridges = [(*k, *x) for k, v in keyed(pieces).items() for x in merged(v, 1.0)]
    close([tuple(r) for r in infill.rulebased_bridges(got).collect()], bridges)
    assert infill.rulebased_decisions(b.limit(0), pts).isEmpty() and infill.rulebased_bridges(got.limit(0)).isEmpty()
    none = {r.reason for r in infill.rulebased_decisions(b, pts.limit(0)).collect()}
    assert none == {"unconditional", "no_amplifiers_available"}
    assert "amp_near_edge_but_subgap_too_long" in {r.reason for r in infill.rulebased_decisions(b, pts, 2_000.0, eps).collect()}


@pytest.mark.parametrize("options", [{}, {"zero_cover": True}, {"zero_cover": True, "one_side": True, "singletons": True, "seed_m": 30_000.0}, {"one_side": True, "combined": 0.01, "majority": 0.9}])
def test_evidence_clusters(spark, made, options):
    base, points, _ = made
    zero, one, single, seed = (options.get(k) for k in ("zero_cover", "one_side", "singletons", "seed_m"))
    majority, combined, eps, bridge, want = options.get("majority", 0.5), options.get("combined", 0.6), 15_000.0, 20_000.0, []
    intervals = {k: merged(v, 1.0) for k, v in keyed(base).items()}
    for (e, p), s in keyed(points).items():
        s.sort()
        starts = [0] + [i for i in range(1, len(s)) if s[i] - s[i - 1] > eps] + [len(s)]
        for c in (s[i:j] for i, j in zip(starts, starts[1:])):
            c0, c1, held = c[0], c[-1], intervals.get((e, p), [])
            cover = sum(max(0.0, min(b, c1) - max(a, c0)) for a, b in held) / max(1.0, c1 - c0) if c1 > c0 else 0.0
            left, right = [b for _, b in held if b <= c0], [a for a, _ in held if a >= c1]
            gap = max(0.0, min(right) - max(left)) if left and right else math.inf
            nearer = min([max(0.0, c0 - x) for x in left] + [max(0.0, x - c1) for x in right], default=math.inf)
            enough = zero or cover >= combined
            if len(c) < 2 and not (single and len(c) == 1):
                reason = "min_samples"
            elif cover >= majority:
                reason = "majority"
            elif gap <= bridge and enough:
                reason = "bridge"
            elif one and nearer <= bridge and enough:
                reason = "one_side"
            elif any(a <= c1 and b >= c0 for a, b in held):
                reason = "overlap"
            elif zero and c1 <= c0 and not left and not right and held:
                reason = "proximity"
            elif seed and not held:
                reason = "seed"
            else:
                reason = "no_base_for_part" if not held else "no_left_or_right" if not left or not right else "bridge_gap_large" if gap > bridge else "cover_too_small"
            good = reason in ("majority", "bridge", "one_side", "overlap", "proximity", "seed")
            half, mid = max(seed or 0.0, c1 - c0) / 2, (c0 + c1) / 2
            span = (mid - half, mid + half) if reason == "seed" else (c0, c1) if good else (None, None)
            want.append((e, p, c0, c1, len(c), cover, good, reason, *span))
    got = infill.evidence_clusters(spark.createDataFrame(points, POINTS), spark.createDataFrame(base, BASE), **options)
    close(rounded(got.collect()), rounded(want))
    assert infill.evidence_clusters(spark.createDataFrame([], POINTS), spark.createDataFrame(base, BASE)).isEmpty()


@pytest.mark.parametrize("free", [None, 25_000.0])
def test_scored_gaps_and_segments(spark, made, free):
    base, points, lengths = made
    want, pad = [], 8_000.0
    stations = keyed(points)
    for (e, p), ivals in keyed(base).items():
        s, ivals = sorted(set(stations.get((e, p), []))), merged(ivals, 1.0)
        for (_, b0), (a1, _) in zip(ivals, ivals[1:]):
            length = a1 - b0
            if length > 100_000.0:
                continue
            edges = sum(min((abs(x - at) for x in s), default=math.inf) <= 8_000.0 for at in (b0, a1))
            score = edges - 0.7 * (length / 100_000.0) ** 1.2
            inside = sorted((max(x - b0, a1 - x), x) for x in s if b0 < x < a1)
            seed = None
            if free and length <= free:
                reason = "unconditional"
            elif free and inside and inside[0][0] <= free:
                reason, seed = "seed", inside[0][1]
            else:
                reason = "tier_1" if length <= 40_000 and score >= 0.2 else "tier_2" if length <= 70_000 and score >= 0.35 else "tier_3" if score >= 0.5 else "score_too_small"
            ok = reason != "score_too_small"
            want.append((e, p, b0, a1, edges, score, ok, reason, seed, *((max(0.0, b0 - pad), min(lengths[p], a1 + pad)) if ok else (None, None))))
    b, pts = spark.createDataFrame(base, BASE), spark.createDataFrame(points, POINTS)
    length = spark.createDataFrame(list(lengths.items()), "part_id long, length_m double")
    got = infill.scored_gaps(b, pts, length, free_m=free)
    close(rounded(got.collect()), rounded(want))
    assert {"tier_1", "tier_2", "tier_3", "score_too_small"} <= {w[7] for w in want} or free
    clusters = infill.evidence_clusters(pts, b)
    adds = [(r.event_id, r.part_id, r.s0, r.s1) for r in clusters.where("accepted").collect()] + [(w[0], w[1], *w[-2:]) for w in want if w[6]]
    out = [(*k, max(0.0, x), min(lengths[k[1]], y)) for k, v in keyed(adds).items() for x, y in merged(v, 1.0) if y > x]
    close(rounded(infill.evidence_segments(clusters, got, length).collect()), rounded(out))


def test_coverage(spark, made):
    base, points, lengths = made
    draw, pad, cap = random.Random(2), 1_000.0, 250_000.0
    heights = [(e, p, s, draw.choice([None, 0.1, 0.3, 0.9, 5.0])) for e, p, s in points[::20]]
    clip = lambda p, a, b: (max(0.0, a), min(lengths[p], b))
    seeds = [(e, p, *clip(p, s - w - pad, s + w + pad)) for e, p, s, h in heights for w in [min(200.0, max(20.0, max(h or 0.2, 0.2) * 60.0)) * 500.0]]
    seeds = [(*k, *x) for k, v in keyed(seeds).items() for x in merged(v, 2_000.0)]
    cover = {k: merged(v, pad) for k, v in keyed([(e, p, *clip(p, a - pad, b + pad)) for e, p, a, b in base + seeds]).items()}
    b, length = spark.createDataFrame(base, BASE), spark.createDataFrame(list(lengths.items()), "part_id long, length_m double")
    got = infill.coverage(b, spark.createDataFrame(heights, POINTS + ", h double"), length)
    close(rounded(got.collect()), rounded([(*k, *x) for k, v in cover.items() for x in v]))
    want, stations = [], keyed(points)
    for (e, p), v in cover.items():
        edges = [(0.0, 0.0), *v, (lengths[p], lengths[p])]
        for (_, a), (z, _) in zip(edges, edges[1:]):
            if z > a:
                cuts = [a, *sorted({x for x in stations.get((e, p), []) if a + pad < x < z - pad}), z]
                longest = max(y - x for x, y in zip(cuts, cuts[1:]))
                want.append((e, p, a, z, len(cuts) - 1, longest, z - a <= cap or (len(cuts) > 2 and longest <= cap)))
    bridges = infill.coverage_bridges(got, infill.amplifiers(spark.createDataFrame(points, POINTS)), length)
    close(rounded(bridges.collect()), rounded(want))
    assert {w[-1] for w in want} == {True, False} or all(w[-1] for w in want)
    close(rounded(infill.coverage_segments(bridges).collect()), rounded([(*k, *x) for k, v in keyed([w[:4] for w in want if w[-1]]).items() for x in merged(v, pad)]))
    assert infill.coverage_bridges(got.limit(0), infill.amplifiers(spark.createDataFrame(points, POINTS)), length).isEmpty()


@pytest.fixture(scope="module")
def coast(spark):
    """(segs, lengths, links): a net of parts that meet at their ends, one part apart from the others."""
    draw = random.Random(6)
    corners = {(i, j): (i * 100_000.0 + draw.uniform(-2e4, 2e4), j * 100_000.0 + draw.uniform(-2e4, 2e4)) for i in range(4) for j in range(3)}
    lines, k = [], 0
    for (i, j), a in corners.items():
        for b in ((i + 1, j), (i, j + 1)):
            if b in corners and draw.random() < 0.75:
                b = corners[b]
                mid = ((a[0] + b[0]) / 2 + draw.uniform(-1e4, 1e4), (a[1] + b[1]) / 2 + draw.uniform(-1e4, 1e4))
                lines.append((k, [(a[0] + draw.uniform(-50, 50), a[1]), mid, b]))
                k += 1
    lines.append((k, [(0.0, 900_000.0), (80_000.0, 900_000.0)]))
    rows = [(p, i, x, y) for p, pts in lines for i, (x, y) in enumerate(pts)]
    segs = joins.segments(spark.createDataFrame(rows, "part_id long, seq int, x_m double, y_m double")).cache()
    lengths = {p: sum(math.dist(a, b) for a, b in zip(pts, pts[1:])) for p, pts in lines}
    ends = [(p, e, pts[-e]) for p, pts in lines for e in (0, 1)]
    name = {(p, e): min((q, f) for q, f, z in ends if math.dist(at, z) <= 250.0) for p, e, at in ends}
    return segs, lengths, name


def ways(lengths, name, points, source, cap):
    """Dijkstra over the net with the points (part, station) put in: {point: length}."""
    graph = {}
    for p, length in lengths.items():
        along = [(0.0, ("end", name[p, 0])), *sorted((s, ("at", i)) for i, (q, s) in enumerate(points) if q == p), (length, ("end", name[p, 1]))]
        for (s, u), (t, v) in zip(along, along[1:]):
            graph.setdefault(u, []).append((v, t - s))
            graph.setdefault(v, []).append((u, t - s))
    best, heap = {}, [(0.0, ("at", source))]
    while heap:
        d, u = heapq.heappop(heap)
        if u not in best:
            best[u] = d
            for v, w in graph[u]:
                if d + w <= cap:
                    heapq.heappush(heap, (d + w, v))
    return {u[1]: d for u, d in best.items() if u[0] == "at"}


def test_station_distances(spark, coast):
    segs, lengths, name = coast
    draw = random.Random(8)
    points = [(p, draw.choice([0.0, lengths[p], draw.uniform(0, lengths[p])])) for p in draw.choices(sorted(lengths), k=14)]
    points += [points[0]]
    rows = [(e, i, p, s) for e in (1, 2) for i, (p, s) in enumerate(points[: 15 if e == 1 else 6])]
    nodes = network.stitched_nodes(segs, 250.0)
    length = spark.createDataFrame(list(lengths.items()), "part_id long, length_m double")
    df = spark.createDataFrame(rows, "event_id long, node long, part_id long, station_m double")
    got = network.station_distances(df, df.where("node % 3 = 0").select("event_id", F.col("node").alias("source")), nodes, length, 420_000.0)
    want = {(e, i, j): d for e, n in ((1, 15), (2, 6)) for i in range(0, n, 3) for j, d in ways(lengths, name, points[:n], i, 420_000.0).items()}
    found = {(r.event_id, r.source, r.node): r.cost for r in got.collect()}
    assert found.keys() == want.keys() and all(abs(found[k] - want[k]) < 1e-6 for k in want) and len(want) > 30


def position(segs, p, s):
    rows = sorted((r for r in segs if r.part_id == p), key=lambda r: r.s0)
    r = [r for r in rows if r.s0 <= s][-1]
    t = min(1.0, (s - r.s0) / r.length)
    return r.x1 + t * (r.x2 - r.x1), r.y1 + t * (r.y2 - r.y1)


def test_cross_part_bridges(spark, coast):
    segs, lengths, name = coast
    draw = random.Random(9)
    base = [(1, p, a, min(lengths[p], a + 9_000.0)) for p in sorted(lengths) for a in [draw.uniform(0, lengths[p] - 9_500.0)] if draw.random() < 0.8]
    cap, held, want = 120_000.0, segs.collect(), {}
    ends = [(p, s) for _, p, a, b in base for s in (a, b)]
    for _, p, _, s in base:
        reach = ways(lengths, name, ends, ends.index((p, s)), cap)
        for _, q, t, _ in base:
            if p != q and ends.index((q, t)) in reach and math.dist(position(held, p, s), position(held, q, t)) <= cap:
                a, b = sorted([(p, s), (q, t)])
                want[(*a, *b)] = reach[ends.index((q, t))]
    got = {tuple(r)[1:5]: r.length_m for r in infill.cross_part_bridges(spark.createDataFrame(base, BASE), segs, cap).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want) and len(want) > 3
    cover = spark.createDataFrame([(1, 0, 0.0, 500.0), (1, 1, 0.0, lengths[1]), (2, 2, 0.0, 800.0)], BASE)
    links = infill.coverage_cross_bridges(cover, segs, cap).collect()
    assert all(r.event_id == 1 and r.part_a != r.part_b and r.length_m <= cap for r in links)


def test_chains(spark, coast):
    segs, lengths, name = coast
    draw, held = random.Random(10), segs.collect()
    base = [(e, p, a, a + 4_000.0) for e in (1, 2) for p in sorted(lengths) for a in [draw.uniform(0, lengths[p] - 9_500.0)] if draw.random() < 0.45]
    boost = [(e, p, draw.uniform(0, lengths[p])) for e in (1, 2) for p in sorted(lengths) if draw.random() < 0.4]
    hop, total, k = 90_000.0, 170_000.0, 3
    want = {}
    for e in (1, 2):
        nodes = [(p, s) for i, p, a, b in base if i == e for s in (a, b)]
        terms = len(nodes)
        nodes += [(p, s) for i, p, s in boost if i == e]
        order = sorted(range(len(nodes)), key=lambda i: (i >= terms, nodes[i]))
        at = [position(held, *n) for n in nodes]
        edges = {}
        for u in range(len(nodes)):
            reach, near = ways(lengths, name, nodes, u, hop), {}
            for v in range(len(nodes)):
                d = math.dist(at[u], at[v])
                if v != u and d <= hop:
                    key = (d, "aux" if v >= terms else "term", order.index(v))
                    near[nodes[v][0]] = min(near.get(nodes[v][0], (math.inf,)), (*key, v))
            for *_, v in sorted(near.values(), key=lambda x: (x[0], x[2]))[:k]:
                if (u < terms or v < terms) and v in reach:
                    edges.setdefault(u, []).append((v, reach[v]))
        for s in range(terms):
            best, heap, goal = {}, [(0.0, s)], None
            while heap:
                d, u = heapq.heappop(heap)
                if u in best:
                    continue
                best[u] = d
                if u < terms and nodes[u][0] != nodes[s][0]:
                    goal = u
                    break
                for v, w in edges.get(u, []):
                    if d + w <= total:
                        heapq.heappush(heap, (d + w, v))
            if goal is not None:
                want[(e, *nodes[s])] = (*nodes[goal], best[goal])
    args = spark.createDataFrame(base, BASE), segs, spark.createDataFrame(boost, POINTS), hop, total, k
    got = {(r.event_id, r.part_start, r.station_start): (r.part_end, r.station_end, r.length_m) for r in infill.infill_chain(*args, passes=1).collect()}
    assert got.keys() == want.keys() and len(want) > 8
    assert all(got[k][:2] == want[k][:2] and abs(got[k][2] - want[k][2]) < 1e-6 for k in want)
    more = infill.infill_chain(*args, passes=3)
    assert more.where("length_m > 170000 OR hops < 1 OR pass > 3 OR part_start = part_end").isEmpty()
    assert {tuple(r)[:1] + tuple(r)[2:6] for r in more.collect()} >= {(e, p, s, *w[:2]) for (e, p, s), w in want.items()}
    assert any(r.hops > 1 for r in more.collect())
    assert infill.infill_chain(args[0].limit(0), segs).isEmpty()


def test_snapping_broadcasts_no_runups(spark):
    vertices = spark.createDataFrame([(p, i, i * 10_000.0, p * 200_000.0) for p in range(3) for i in range(5)], "part_id long, seq int, x_m double, y_m double")
    runups = spark.createDataFrame([(i, i % 2, i * 1_000.0, (i % 3) * 200_000.0 + 500.0, float(i)) for i in range(30)], "runup_id long, tsunami_event_id long, x_m double, y_m double, runup_ht double")
    got = tsunami.events_snapped(runups, vertices)
    assert {(r.runup_id, r.event_id, r.part_id, r.station_m, r.h) for r in got.collect()} == {(i, i % 2, i % 3, i * 1_000.0, float(i)) for i in range(30)}
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()


def test_chains_go_through_the_coast_once(spark, coast, monkeypatch):
    segs, lengths, _ = coast
    calls, located = [], sequence.located
    monkeypatch.setattr(infill.sequence, "located", lambda *args: calls.append(1) or located(*args))
    base = spark.createDataFrame([(1, p, 1_000.0, 5_000.0) for p in sorted(lengths)], BASE)
    found = infill.infill_chain(base, segs, None, 90_000.0, 170_000.0, 3, passes=3)
    assert found.count() and len(calls) == 1


def test_chains_take_low_runups_of_the_whole_part(spark, monkeypatch):
    vertices = spark.createDataFrame([(p, i, i * 10_000.0, p * 200_000.0) for p in range(2) for i in range(61)], "part_id long, seq int, x_m double, y_m double")
    runups = spark.createDataFrame([(i, 1, i * 50_000.0, (i % 2) * 200_000.0 + 500.0, 1.0 if i % 3 else 4.0) for i in range(12)], "runup_id long, tsunami_event_id long, x_m double, y_m double, runup_ht double")
    taken, chain = [], infill.infill_chain
    monkeypatch.setattr(infill, "infill_chain", lambda base, segs, boosters, *args, **kwargs: taken.append(boosters) or chain(base, segs, boosters, *args, **kwargs))
    infill_queries.infill_chain(runups, vertices).collect()
    assert {(r.part_id, r.station_m) for r in taken[0].collect()} == {(i % 2, i * 50_000.0) for i in range(12) if i % 3}
