"""Ray hits, coast network and hulls against brute force on small tables, with ties, repeats, nulls and empty input."""

import itertools
import math
import os
import random

from pyspark.sql import functions as F

from perilframe import io, network
from perilframe.operators import joins
from perilframe.plans import storm
from perilframe.sources import tables

SEGS = "part_id long, seq int, x1 double, y1 double, x2 double, y2 double, s0 double, length double"


def test_first_hits(spark):
    rng = random.Random(3)
    lines = [(i, 0, *(rng.uniform(-900, 900) for _ in range(4))) for i in range(40)]
    segs = [(*s, 0.0, math.hypot(s[4] - s[2], s[5] - s[3])) for s in lines]
    origins = [(1, 0.5, 0.5), (2, 310.5, -220.5), (3, 9000.0, 9000.0)]
    got = {(r.event_id, r.bearing_deg): (r.range_m, r.part_id) for r in joins.first_hits(spark.createDataFrame(origins, "event_id long, ox double, oy double"), spark.createDataFrame(segs, SEGS), 5.0, 700.0).collect()}
    want = {}
    for (e, ox, oy), k in itertools.product(origins, range(72)):
        cb, sb = math.cos(math.radians(5 * k)), math.sin(math.radians(5 * k))
        for p, _, x1, y1, x2, y2, _, _ in segs:
            cross = cb * (y2 - y1) - sb * (x2 - x1)
            t, u = ((x1 - ox) * (y2 - y1) - (y1 - oy) * (x2 - x1)) / cross, ((x1 - ox) * sb - (y1 - oy) * cb) / cross
            if 0 <= u <= 1 and 0 <= t <= 700:
                want[e, 5.0 * k] = min(want.get((e, 5.0 * k), (1e9, 0)), (t, p))
    assert got.keys() == want.keys() and len(got) > 50
    assert all(abs(got[k][0] - want[k][0]) < 1e-6 and got[k][1] == want[k][1] for k in want)
    assert joins.first_hits(spark.createDataFrame([], "event_id long, ox double, oy double"), spark.createDataFrame(segs, SEGS)).isEmpty()


def test_near_pairs(spark):
    rng = random.Random(5)
    a, b = ([(i, rng.uniform(-30, 30), rng.uniform(-30, 30)) for i in range(60)] for _ in range(2))
    a.append((99, None, 1.0))
    got = joins.near_pairs(spark.createDataFrame(a, "i long, x double, y double"), spark.createDataFrame(b, "j long, x2 double, y2 double"), 7.0)
    want = {(i, j) for (i, x, y), (j, x2, y2) in itertools.product(a[:-1], b) if math.hypot(x - x2, y - y2) <= 7.0}
    assert sorted((r.i, r.j) for r in got.collect()) == sorted(want)


def test_coast_network(spark):
    # parts 0 and 1 meet within the snap distance; part 2 runs beside part 0 and is longer; part 3 is apart
    lines = [(0, 0, 0.0, 0.0, 10.0, 0.0), (1, 0, 10.5, 0.0, 20.0, 0.0), (2, 0, 0.0, 0.5, 5.0, 9.0), (2, 1, 5.0, 9.0, 10.0, 0.5), (3, 0, 90.0, 90.0, 95.0, 90.0)]
    segs = spark.createDataFrame([(*s, 0.0, math.hypot(s[4] - s[2], s[5] - s[3])) for s in lines], SEGS)
    nodes = network.stitched_nodes(segs, 1.0)
    assert {(r.part_id, r.end): r.node for r in nodes.collect()} == {(0, 0): 0, (0, 1): 1, (1, 0): 1, (1, 1): 3, (2, 0): 0, (2, 1): 1, (3, 0): 6, (3, 1): 7}
    edges = network.part_edges(nodes, segs.groupBy("part_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "length_m"))
    source = spark.createDataFrame([(0,), (0,)], "source long")
    found = lambda cap: {r.node: round(r.cost, 6) for r in network.distances(edges, source, cap).collect()}
    assert found(100.0) == {0: 0.0, 1: 10.0, 3: 19.5} and found(19.0) == {0: 0.0, 1: 10.0}
    ways = network.shortest(edges, source, 100.0, stop=F.col("node") == 1)
    assert {r.node: r.path for r in ways.collect()} == {0: [0], 1: [0, 1]}
    assert network.distances(edges, source.where("false"), 1.0).isEmpty()


def test_track_hull(spark):
    rng = random.Random(9)
    pts = [(1, rng.randint(0, 12) * 1.0, rng.randint(0, 12) * 1.0) for _ in range(60)]
    rows = [*pts, (2, 1.0, 1.0), (2, 1.0, 1.0), (3, 0.0, 0.0), (3, 1.0, 1.0), (3, 2.0, 2.0), (4, None, 1.0)]
    got = {}
    for r in storm.track_hull(spark.createDataFrame(rows, "sid long, x double, y double")).orderBy("sid", "i").collect():
        got.setdefault(r.sid, []).append((r.x, r.y))
    assert got[2] == [(1.0, 1.0)] and got[3] == [(0.0, 0.0), (2.0, 2.0)] and 4 not in got
    ring = got[1]
    turn = lambda a, b, p: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
    assert ring[0] == min(ring)
    for a, b in zip(ring, ring[1:] + ring[:1]):
        assert all(turn(a, b, (x, y)) >= 0 for _, x, y in pts)


def test_track_hull_goes_by_many_tracks(spark):
    """No group of its own for each track; repeated points, lines and nulls in tracks beside each other."""
    points = spark.createDataFrame([(1, 0.0, 0.0), (1, 0.0, 0.0), (2, 0.0, 0.0), (2, 1.0, 1.0), (2, 2.0, 2.0), (3, None, 1.0), (4, 0.0, 0.0), (4, 1.0, 0.0), (4, 0.0, 1.0), (4, 0.2, 0.2)], "sid long, x double, y double")
    hull = storm.track_hull(points)
    assert "FlatMapGroups" not in hull._jdf.queryExecution().sparkPlan().toString()
    got = {}
    for r in sorted(hull.collect(), key=lambda r: (r.sid, r.i)):
        got.setdefault(r.sid, []).append((r.x, r.y))
    assert got == {1: [(0.0, 0.0)], 2: [(0.0, 0.0), (2.0, 2.0)], 4: [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)]}


def test_datetime_profile(spark):
    rows = spark.createDataFrame([("x", "2020-01-01", "2020-01-01"), ("y", None, "2020-01-02"), ("2020-02-30", "2020-01-03", "z"), (None, "n", "2020-03-03")], "a string, b string, c string")
    assert [tuple(r) for r in tables.datetime_profile(rows, ["a", "b", "c"]).collect()] == [("a", 0.0, False), ("b", 0.5, False), ("c", 0.75, True)]
    assert [tuple(r) for r in tables.datetime_profile(rows, ["b", "b"]).collect()] == [("b", 0.5, True), ("b", 0.5, False)]
    assert [tuple(r) for r in tables.datetime_profile(rows.where("false"), ["a"]).collect()] == [("a", None, False)]


def test_steps_leave_only_their_result(spark):
    """Tables of earlier rounds are gone once a later one has taken their place, and a step's own are gone at its end."""
    edges = spark.range(300).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    before = len(io._MADE)
    found = io.only(lambda: network.components(edges), "found")
    assert len(io._MADE) == before + 1 and found.where("component = 0").count() == 301
    new = io.written(found, "again")
    io.dropped(found)
    assert new.count() == 301 and not os.path.exists(found.written_to)


def test_station_distances_in_few_rounds(spark, monkeypatch):
    """Ways along a part don't go from point to point: as many tables are written for many points as for few."""
    nodes = spark.createDataFrame([(0, 0, 0), (0, 1, 1), (1, 0, 1), (1, 1, 3)], "part_id long, end int, node long")
    lengths = spark.createDataFrame([(0, 100.0), (1, 50.0)], "part_id long, length_m double")
    points = spark.createDataFrame([(7, i, 0 if i < 50 else 1, float(2 * i if i < 50 else i - 50)) for i in range(60)], "event_id long, node long, part_id long, station_m double")
    calls, plain = [], network.written
    monkeypatch.setattr(network, "written", lambda df, name: calls.append(name) or plain(df, name))
    got = {r.node: r.cost for r in network.station_distances(points, points.where("node = 3").selectExpr("event_id", "node AS source"), nodes, lengths, 99.0).collect()}
    at = [2.0 * i if i < 50 else 50.0 + i for i in range(60)]
    assert got == {i: abs(a - 6.0) for i, a in enumerate(at) if abs(a - 6.0) <= 99.0} and len(got) > 50 and len(calls) < 8


def test_stars_contract_in_one_round(spark, monkeypatch):
    rounds, plain = [], network.written
    monkeypatch.setattr(network, "written", lambda df, name: (rounds.append(name), plain(df, name))[1])
    edges = [(500, i) for i in range(2000) if i != 500] + [(5000, 4000 + i) for i in range(900)] + [(9000, 9001)]
    for small in (network.SMALL, 0):  # broadcast, and by sort-merge
        monkeypatch.setattr(network, "SMALL", small)
        rounds.clear()
        got = {r.node: r.component for r in network.components(spark.createDataFrame(edges, "u long, v long")).collect()}
        assert got == {i: 0 for i in range(2000)} | {i: 4000 for i in range(4000, 4900)} | {5000: 4000, 9000: 9000, 9001: 9000}
        assert rounds.count("went") == 1
    path = spark.range(3000).selectExpr("id AS u", "id + 1 AS v")
    rounds.clear()
    assert network.components(path).where("component = 0").count() == 3001 and rounds.count("edges") < 12
