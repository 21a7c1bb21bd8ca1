"""Operators against brute force on small made-up data."""

import itertools
import math
import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from perilframe import io, network
from perilframe.functions import geo
from perilframe.functions import scalars as S
from perilframe.operators import cover, joins, sequence
from perilframe.plans import flood
from perilframe.sources import tables as T


def hav(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    x = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1, math.sqrt(x)))


@pytest.mark.parametrize("km", [25.0, 500.0])
def test_distance_cells_lose_no_pair(spark, km):
    rng = random.Random(1)
    pts = [(i, rng.choice([rng.uniform(-90, 90), 89.9, -90.0, 0.0]), rng.choice([rng.uniform(-180, 180), 179.99, -180.0])) for i in range(150)]
    df = spark.createDataFrame(pts, "id long, lat double, lon double")
    a = df.select(F.col("id").alias("a"), geo.own_cell(F.col("lat"), F.col("lon"), km).alias("cell"), F.col("lat").alias("la"), F.col("lon").alias("lo"))
    b = df.select(F.col("id").alias("b"), F.explode(geo.reached_cells(F.col("lat"), F.col("lon"), km)).alias("cell"), F.col("lat").alias("lb"), F.col("lon").alias("lp"))
    got = [(r.a, r.b) for r in a.join(b, "cell").where(geo.haversine_km(F.col("la"), F.col("lo"), F.col("lb"), F.col("lp")) <= km).select("a", "b").collect()]
    want = {(i, j) for (i, a1, b1), (j, a2, b2) in itertools.product(pts, pts) if hav(a1, b1, a2, b2) <= km}
    assert len(got) == len(set(got)) and set(got) == want


def test_overlap_pairs_with_nulls_and_long_intervals(spark):
    rng = random.Random(2)
    day = lambda: date(2000, 1, 1) + timedelta(days=rng.randrange(1500))
    left = [(i, day(), None) for i in range(30)] + [(50, date(1990, 1, 1), date(2003, 1, 1)), (51, None, None)]
    left = [(i, s, s and (e or s + timedelta(days=rng.randrange(90)))) for i, s, e in left]
    right = [(i, day(), None) for i in range(30)] + [(60, date(1999, 1, 1), date(2010, 1, 1)), (61, None, None)]
    a = spark.createDataFrame(left, "l_id long, l_start date, l_end date")
    b = spark.createDataFrame(right, "r_id long, r_start date, r_end date")
    got = [(r.l_id, r.r_id) for r in joins.overlap_pairs(a, b, 7).collect()]
    week = timedelta(days=7)
    want = {(i, j) for i, s, e in left for j, u, v in right if s and u and s <= (v or u) + week and (e or s) >= u - week}
    assert len(got) == len(set(got)) and set(got) == want
    assert {r.l_id for r in joins.temporal_overlap_semi(a, b, 7).collect()} == {i for i, _ in want}


def test_exploded_sides_are_not_broadcast(spark):
    """A side exploded to cells and months has many times the rows that its file's size promises, so it must not go through the driver."""
    day = date(2000, 1, 1)
    left = spark.createDataFrame([(1, day, day, 1.0, 1.0)], "l_id long, l_start date, l_end date, l_lat double, l_lon double")
    right = spark.createDataFrame([(2, day, day, 1.0, 1.0)], "r_id long, r_start date, r_end date, r_lat double, r_lon double")
    plan = joins.spacetime_pairs(left, right, 200.0)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_components_of_a_long_way(spark):
    """Far fewer rounds than the way is long, whatever the order of its ids."""
    ids = list(range(1000))
    random.Random(2).shuffle(ids)
    edges = spark.createDataFrame(list(zip(ids, ids[1:])) + [(2000, 2001), (3000, 3000)], "u long, v long").coalesce(1)
    made = len(io._MADE)
    got = dict(network.components(edges).collect())
    assert got == dict.fromkeys(range(1000), 0) | {2000: 2000, 2001: 2000, 3000: 3000}
    assert len(io._MADE) - made < 60


def test_matches_by_time_alone_build_no_pairs(spark):
    """Rows without coordinates match by time alone: against brute force, with nulls, turned intervals and long ones. No join goes by the hazard alone."""
    rng = random.Random(8)
    day = lambda: date(2000, 1, 1) + timedelta(rng.randrange(3000))
    end = lambda s: None if rng.random() < 0.2 else s + timedelta(rng.choice([-3, 0, 5, 1200]))
    left = [(i, rng.choice("ab"), s := day(), end(s)) for i in range(12)] + [(90, "a", None, None)]
    right = [(i, rng.choice("abc"), s := day(), end(s)) for i in range(60)] + [(91, "a", None, None)]
    a = spark.createDataFrame(left, "l_id long, hazard string, l_start date, l_end date").withColumn("l_lat", F.lit(1.0)).withColumn("l_lon", F.lit(1.0))
    b = spark.createDataFrame(right, "r_id long, hazard string, r_start date, r_end date").withColumn("r_lat", F.lit(None).cast("double")).withColumn("r_lon", F.lit(None).cast("double"))
    tol = timedelta(7)
    pairs = [(h, i, k) for i, h, s, e in left if s for k, g, u, v in right if u and g == h and s <= max(u - tol, (v or u) + tol) and max(s, e or s) >= u - tol]
    got = joins.matched_ids(a, b, 250.0, 7, ["hazard"])
    assert not re.search(r"Join \[hazard#\d+\],", got._jdf.queryExecution().sparkPlan().toString())
    assert {tuple(r) for r in got.collect()} == {(h, k) for h, _, k in pairs}
    assert {r.l_id for r in joins.temporal_overlap_semi(a, b, 7).collect()} == {i for i, _, s, e in left if s and any(u and s <= max(u - tol, (v or u) + tol) and max(s, e or s) >= u - tol for _, _, u, v in right)}


def test_equally_long_parts_are_a_tie(spark):
    """Parts with the same segments in another order are equally long, so the first one is the longest."""
    a, b = [1e8] + [0.1] * 10, [0.1] * 10 + [1e8]
    total = lambda v: list(itertools.accumulate(v))[-1]
    low, high = sorted((a, b), key=total)
    assert total(low) < total(high)
    segs = spark.createDataFrame([(k, x) for k, v in ((4, low), (8, high)) for x in v], "part_id long, length double").coalesce(1)
    assert sequence.longest_part(joins.part_lengths(segs).withColumn("g", F.lit(0)), "g").first().part_id == 4


def test_snap_and_nearest(spark):
    rng = random.Random(3)
    verts = [(p, s, s * 1000.0, p * 5000.0 + rng.uniform(-300, 300)) for p in range(3) for s in range(8)]
    pts = [(i, rng.uniform(-2000, 9000), rng.uniform(-3000, 14000)) for i in range(40)] + [(99, 1e6, 1e6)]
    segs = joins.segments(spark.createDataFrame(verts, "part_id long, seq int, x_m double, y_m double"))

    def dist(x, y):
        best = None
        for p in range(3):
            v = [(a, b) for q, _, a, b in verts if q == p]
            for (x1, y1), (x2, y2) in zip(v, v[1:]):
                t = max(0, min(1, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2)))
                best = min(best or (1e18, 0), (math.hypot(x - x1 - t * (x2 - x1), y - y1 - t * (y2 - y1)), p))
        return best

    df = spark.createDataFrame(pts, "pt_id long, x double, y double")
    snapped = {r.pt_id: (r.distance_m, r.part_id) for r in joins.snapped(df, segs, 1500.0).collect()}
    want = {i: dist(x, y) for i, x, y in pts if dist(x, y)[0] <= 1500}
    assert snapped.keys() == want.keys() and all(abs(snapped[i][0] - want[i][0]) < 1e-6 for i in want)
    near = {r.pt_id: r.distance_m for r in joins.nearest(df, segs, 1000.0).collect()}
    assert all(abs(near[i] - dist(x, y)[0]) < 1e-6 for i, x, y in pts)


def test_intervals(spark):
    rows = [(1, 0.0, 5.0), (1, 0.0, 5.0), (1, 5.5, 6.0), (1, 9.0, 9.5), (2, 1.0, 2.0), (2, -3.0, 4.0)]
    df = spark.createDataFrame(rows, "k int, s0 double, s1 double")
    got = sorted(tuple(r) for r in sequence.merge_intervals(df, ["k"], 1.0).collect())
    assert got == [(1, 0.0, 6.0, 3), (1, 9.0, 9.5, 1), (2, -3.0, 4.0, 2)]
    merged = sequence.merge_intervals(df, ["k"], 1.0)
    assert [tuple(r) for r in sequence.gaps(merged, ["k"]).collect()] == [(1, 6.0, 9.0)]
    assert sequence.merge_intervals(df.limit(0), ["k"]).count() == 0
    v = spark.createDataFrame([(1, 0.0, 1000.0, 0.0), (1, 20_000.0, 21_000.0, 0.0), (1, 60_000.0, 61_000.0, 2000.0)], "k int, s0 double, s1 double, range_km double")
    assert [(r.s0, r.s1) for r in sequence.merge_intervals_variable(v, ["k"]).collect()] == [(0.0, 61_000.0)]


def test_components_and_clusters(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(20)] + [(1, None)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        if v is not None:
            a, b = sorted((root(u), root(v)))
            parent[b] = a
    got = {r.node: r.component for r in network.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for x in parent}
    rows = [(i, "DFO", date(2000, 1, 1 + i), None, 10.0 + i * 0.5, 20.0, 1.0) for i in range(5)] + [(9, "USFD", date(2001, 1, 1), None, 0.0, 0.0, None)]
    df = spark.createDataFrame(rows, "row_id long, source string, start_date date, end_date date, lat double, lon double, area_km2 double")
    got = dict(flood.clusters(df).collect())
    assert set(got) == {0, 1, 2, 3, 4, 9} and got[0] == got[1] and got[9] == 9


def test_dates_and_numbers(spark):
    row = spark.range(1).select(
        S.ymd_clamped(F.lit(2001), F.lit(2), F.lit(31)).alias("a"), S.ymd_clamped(F.lit(2000), F.lit(None).cast("int"), F.lit(None).cast("int")).alias("b"),
        S.ymd_clamp28(F.lit(2001), F.lit(13), F.lit(31)).alias("c"), S.compact_datetime(F.lit("1.9961E+11")).alias("d"), S.compact_datetime(F.lit("199605")).alias("e"),
        S.coerce_int(F.lit("2.7")).alias("f"), S.coerce_double(F.lit("nan")).alias("g"), S.classify_hazard(F.lit(None).cast("string")).alias("h"), S.wind_category(F.lit(96.0)).alias("i"),
        S.norm_event_id(F.lit(" 2001–0123 ")).alias("j"), S.norm_iso(F.lit("")).alias("k"), S.wrap_lon(F.lit(190.0)).alias("l"),
    ).first()
    assert str(row.a) == "2001-02-28" and str(row.b) == "2000-01-01" and str(row.c) == "2001-12-28"
    assert row.d is None and str(row.e) == "1996-05-01 00:00:00" and row.f == 2 and row.g is None
    assert (row.h, row.i, row.j, row.k, row.l) == ("other", 3, "2001-0123", "UNK", -170.0)


def test_quake_ellipse_area_and_disc_cover(spark):
    ring = geo.ellipse_ring(F.lit(10.0), F.lit(179.9), F.lit(50.0), F.lit(20.0), F.lit(30.0), 360)
    pts = spark.range(1).select(F.explode(ring).alias("p")).select("p.*").collect()
    assert all(-180 <= p.x < 180 for p in pts)
    area = spark.range(1).select(geo.ring_area_km2(F.slice(geo.ellipse_ring(F.lit(10.0), F.lit(20.0), F.lit(50.0), F.lit(20.0), F.lit(30.0), 360), 1, 360))).first()[0]
    assert abs(area / (math.pi * 1000) - 1) < 0.01
    discs = spark.createDataFrame([(1, 0.0, 0.0, 10.0), (1, 3.0, 0.0, 10.0), (2, 0.0, 0.0, 0.1)], "k int, x double, y double, r_m double")
    got = {(r.cx, r.cy) for r in cover.union(cover.disc_cover(discs, 1.0, ["k"]), ["k"]).collect()}
    want = {(x, y) for x in range(-20, 20) for y in range(-20, 20) if min((x + 0.5) ** 2, (x - 2.5) ** 2) + (y + 0.5) ** 2 <= 100}
    assert got == want


def test_names():
    assert T.find_column(["Event ID", "Lat."], ["eventid"]) == "Event ID" and T.find_column(["a"], ["b"]) is None
    assert T.safe_names(["a b", "A_b", "1x", "a.b", "__x -- y_", "...", "Band", "band"]) == ["a_b", "A_b_raw", "f_1x", "a_b_raw2", "x_y", "field", "Band", "band_2"]
