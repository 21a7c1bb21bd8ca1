"""Polygons and projections against plain Python: concave rings, holes, shared sides, points on sides, rings over the antimeridian."""

import math
import random

import pytest
from pyspark.sql import functions as F

from perilframe.functions import projections as P
from perilframe.operators import cover, rings

RINGS = "id long, code string, ring array<struct<x:double,y:double>>"


def star(draw, cx, cy, n, r):
    """A ring with n corners at changing distances: concave, but not crossing itself."""
    return [(cx + r * draw.uniform(0.3, 1) * math.cos(2 * math.pi * i / n), cy + r * draw.uniform(0.3, 1) * math.sin(2 * math.pi * i / n)) for i in range(n)]


def inside(ring, x, y):
    hit = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if min(y1, y2) <= y < max(y1, y2) and x1 + (y - y1) / (y2 - y1) * (x2 - x1) <= x:
            hit = not hit
    return hit


@pytest.fixture(scope="module")
def made():
    draw = random.Random(5)
    polygons = [(i, f" c{i} ", [star(draw, draw.uniform(-50, 50), draw.uniform(-50, 50), 9 + i, 22.0)]) for i in range(6)]
    polygons += [(6, "C6", [[(60.0, 60.0), (90.0, 60.0), (90.0, 90.0), (60.0, 90.0)], [(70.0, 70.0), (80.0, 70.0), (80.0, 80.0), (70.0, 80.0)]])]  # a hole
    polygons += [(7, "c7", [[(90.0, 60.0), (120.0, 60.0), (120.0, 90.0), (90.0, 90.0)]])]  # shares a side on a line of the grid
    rows = [(i, c, [tuple(p) for p in r] + [r[0]] * (i % 2)) for i, c, rs in polygons for r in rs]
    return polygons, rows + [(8, None, None), (9, "c9", []), (10, "c10", [(0.0, 0.0), (1.0, 1.0)]), (11, "c11", [(0.0, 0.0), (float("nan"), 1.0), (1.0, 0.0)])]


def test_ring_cover(spark, made):
    polygons, rows = made
    got = {(r.id, r.cx, r.cy) for r in rings.ring_cover(spark.createDataFrame(rows, RINGS), 1.5, ["id"]).collect() if r.id < 8}
    want = {(i, cx, cy) for i, _, rs in polygons for cx in range(-60, 90) for cy in range(-60, 90) if sum(inside(r, (cx + 0.5) * 1.5, (cy + 0.5) * 1.5) for r in rs) % 2}
    assert got == want and len(want) > 1000
    assert rings.ring_cover(spark.createDataFrame([], RINGS), 1.0, ["id"]).isEmpty()


@pytest.mark.parametrize("res", [0.7, 6.0, 30.0])
def test_points_in_rings(spark, made, res):
    polygons, rows = made
    draw = random.Random(6)
    pts = [(draw.uniform(-75, 125), draw.uniform(-75, 100)) for _ in range(500)] + [(90.0, 70.0), (60.0, 60.0), (90.0, 90.0), (70.0, 75.0), (80.0, 75.0), (75.0, 75.0)]
    pts += [p for _, _, rs in polygons for p in rs[0][:3]] + [pts[0]]
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(pts)] + [(-1, None, 1.0), (-2, float("nan"), 1.0)], "k long, x double, y double")
    table = spark.createDataFrame(rows, RINGS)
    got = {(r.k, r.id) for r in rings.points_in_rings(df, table, res, "id").collect() if r.id < 8}
    want = {(k, i) for k, (x, y) in enumerate(pts) for i, _, rs in polygons if sum(inside(r, x, y) for r in rs) % 2}
    assert got == want and len(want) > 80
    tags = {r.k: r.code for r in rings.tagged(df, table.where("id < 8"), res, "code").collect()}
    assert tags == {k: min((c.strip().upper() for i, c, _ in polygons if (k, i) in want), default="UNK") for k in [*range(len(pts)), -1, -2]}


def test_edge_cells_hold_every_side(spark, made):
    polygons, rows = made
    cells = {}
    for r in rings.classified_cells(spark.createDataFrame(rows, RINGS), 4.0, ["id"]).collect():
        cells.setdefault(r.id, {})[r.cx, r.cy] = r.edge
    draw = random.Random(1)
    for i, _, rs in polygons:
        for ring in rs:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
                for t in (draw.random() for _ in range(30)):
                    assert cells[i][math.floor((x1 + t * (x2 - x1)) / 4), math.floor((y1 + t * (y2 - y1)) / 4)]
        for (cx, cy), edge in cells[i].items():
            if not edge:
                assert all(sum(inside(r, (cx + a) * 4, (cy + b) * 4) for r in rs) % 2 for a in (0.01, 0.99) for b in (0.01, 0.99))
    meets = rings.covers_in_rings(spark.createDataFrame([(1, 16, 16), (2, 100, 100)], "e long, cx long, cy long"), ["e"], spark.createDataFrame(rows[:9], RINGS), 4.0, "code")
    assert [tuple(r) for r in meets.collect()] == [(1, "C6")]


def test_line_cover_by_brute_force(spark):
    draw, width, res = random.Random(4), 7.0, 2.0
    lines = [(i, *(draw.uniform(-60, 60) for _ in range(4))) for i in range(12)] + [(20, 0.0, 0.0, 0.0, 0.0), (21, -30.0, 5.0, 30.0, 5.0), (22, 5.0, -30.0, 5.0, 30.0), (23, -40.0, -40.0, 40.0, 41.0)]
    got = {tuple(r) for r in cover.line_cover(spark.createDataFrame(lines, "id long, x1 double, y1 double, x2 double, y2 double"), width, res, ["id"]).collect()}
    want = set()
    for i, x1, y1, x2, y2 in lines:
        for cx in range(-36, 36):
            for cy in range(-36, 36):
                px, py, dx, dy = (cx + 0.5) * res, (cy + 0.5) * res, x2 - x1, y2 - y1
                t = max(0.0, min(1.0, ((px - x1) * dx + (py - y1) * dy) / (dx * dx + dy * dy))) if dx or dy else 0.0
                if math.hypot(px - x1 - t * dx, py - y1 - t * dy) <= width:
                    want.add((i, cx, cy))
    assert got == want and len(want) > 1000


def area(ring):
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1]))) / 2


def test_split_at_antimeridian(spark):
    draw = random.Random(2)
    rows = []
    for i in range(30):
        ring = star(draw, draw.uniform(-200, 200), draw.uniform(-60, 60), 12, draw.choice([5.0, 25.0]))
        rows.append((i, "x", ring))
    wrapped = [(i, c, [((x + 540) % 360 - 180, y) for x, y in r] + [((r[0][0] + 540) % 360 - 180, r[0][1])] * (i % 2)) for i, c, r in rows]
    got = {}
    for r in rings.split_at_antimeridian(spark.createDataFrame(wrapped + [(98, "x", None), (99, "x", [])], RINGS)).collect():
        assert all(-180 <= p.x <= 180 for p in r.ring)
        got.setdefault(r.id, []).append([(p.x, p.y) for p in r.ring])
    assert set(got) == set(range(30)) and any(len(v) == 2 for v in got.values()) and any(len(v) == 1 for v in got.values())
    for i, _, ring in rows:
        assert abs(sum(map(area, got[i])) - area(ring)) < 1e-6


def metres(a, b):
    """Distance of two near points."""
    lat = math.radians((a[1] + b[1]) / 2)
    return math.hypot(((a[0] - b[0] + 540) % 360 - 180) * 111_320 * math.cos(lat), (a[1] - b[1]) * 110_574)


def test_projections_there_and_back(spark):
    draw = random.Random(3)
    rows = []
    for i in range(300):
        lon0, lat0 = draw.uniform(-180, 180), draw.uniform(-84, 84)
        lon, lat = (lon0 + draw.uniform(-40, 40) + 540) % 360 - 180, max(-89.0, min(89.0, lat0 + draw.uniform(-30, 30)))
        rows.append((i, lon, lat, lon0, lat0))
    rows += [(900, 10.0, 20.0, 10.0, 20.0), (901, -179.9, 0.0, 179.9, 0.0)]
    df = spark.createDataFrame(rows, "i long, lon double, lat double, lon0 double, lat0 double")
    c = F.col
    args = [c("lon0"), c("lat0")]
    for there, back, near in ((P.laea, P.laea_inverse, False), (P.aeqd, P.aeqd_inverse, False), (P.affine, P.affine_inverse, True)):
        got = df.withColumn("p", there(c("lon"), c("lat"), *args)).withColumn("q", back(c("p.x"), c("p.y"), *args)).collect()
        assert all(metres((r.q.x, r.q.y), (r.lon, r.lat)) < 1e-3 for r in got)
    same = df.where("i = 900").select(P.laea(c("lon"), c("lat"), *args).alias("a"), P.aeqd(c("lon"), c("lat"), *args).alias("b")).first()
    assert max(abs(v) for v in (*same.a, *same.b)) < 1e-6
    # equal area: a small quadrangle keeps the ellipsoid's area wherever it is; equidistant: distance and bearing hold
    lat, lon, d = 50.0, 30.0, 0.01
    quad = spark.createDataFrame([(k, lon + x, lat + y, 10.0, 40.0) for k, (x, y) in enumerate([(0, 0), (d, 0), (d, d), (0, d)])], "i long, lon double, lat double, lon0 double, lat0 double")
    flat = [tuple(r.p) for r in quad.select("i", P.laea(c("lon"), c("lat"), *args).alias("p")).orderBy("i").collect()]
    e2, a = P.E2, P.WGS84_A
    mid = math.radians(lat + d / 2)
    true = (a * (1 - e2) / (1 - e2 * math.sin(mid) ** 2) ** 1.5) * (a * math.cos(mid) / math.sqrt(1 - e2 * math.sin(mid) ** 2)) * math.radians(d) ** 2
    assert abs(area(flat) / true - 1) < 1e-6
    r = df.where("i = 5").select("*", P.aeqd(c("lon"), c("lat"), *args).alias("p")).first()
    p0, p1, dl = math.radians(r.lat0), math.radians(r.lat), math.radians(r.lon - r.lon0)
    assert abs(math.hypot(*r.p) - 6_371_000 * math.acos(math.sin(p0) * math.sin(p1) + math.cos(p0) * math.cos(p1) * math.cos(dl))) < 1e-2


def test_ring_cover_of_quakes_shuffles_quakes_only(spark):
    from perilframe.plans import ring_queries

    quake = spark.createDataFrame([(i, float(i % 50), float(i % 40)) for i in range(40)], "event_id long, lon double, lat double")
    got = rings.ring_cover(ring_queries._stars(quake), 0.5, ["event_id"]).groupBy("event_id").agg(F.count(F.lit(1)).alias("cells"), F.count_distinct("cx", "cy").alias("n"))
    assert got.where("cells = n").count() == 40
    cells = rings.ring_cover(ring_queries._stars(quake), 0.5, ["event_id"]).groupBy("event_id").count()
    assert cells._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 1
