"""The composite layers against plain Python on small data."""

import itertools
import math
import os
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from perilframe import fixtures
from perilframe.functions import geo
from perilframe.operators import sequence
from perilframe.plans import audit, flood, layer_queries, quake, registry, storm, tsunami

DIR = "/root/testdata/sf0.001"
there = pytest.mark.skipif(not os.path.isdir(DIR), reason="tables are not there")


def hav(a, b, c, d):
    if None in (a, b, c, d):
        return None
    p, q = math.radians(a), math.radians(c)
    x = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1, math.sqrt(x)))


def test_distance_is_null_without_coordinates(spark):
    row = spark.sql("SELECT 1.0D AS a, CAST(NULL AS DOUBLE) AS n").select(geo.haversine_km(F.col("a"), F.col("a"), F.col("n"), F.col("a")).alias("x"), geo.haversine_km(F.col("a"), F.col("a"), F.col("a"), F.col("a")).alias("y")).first()
    assert row.x is None and row.y == 0.0


def test_hysteresis_keeps_the_last_method(spark):
    rng, names = random.Random(7), {"a": 0.9, "b": 0.85, "c": 0.5}
    steps = [(sid, i, [(m, names[m]) for m in names if rng.random() < 0.6]) for sid in range(5) for i in range(20)]
    df = spark.createDataFrame(steps, "sid int, t int, candidates array<struct<method:string,conf:double>>")
    got = {(r.sid, r.t): r.method for r in sequence.hysteresis(df, "sid", ["t"], 0.1).collect()}
    want, last = {}, {}
    for sid, i, cands in steps:
        if cands:
            best = max(cands, key=lambda c: c[1])
            prev = next((c for c in cands if c[0] == last.get(sid)), None)
            pick = prev if prev and best[1] - prev[1] < 0.1 else best
            want[sid, i] = last[sid] = pick[0]
    assert got == want and {"a", "b", "c"} == set(want.values())


def test_hysteresis_carries_columns(spark):
    """Columns come along with their step, in tracks that are folded and in those that aren't."""
    steps = [(1, i, [("a", 0.9), ("c", 0.5)], i * 10) for i in range(4)] + [(2, 0, [("b", 0.85)], 7), (2, 1, [("a", 0.9), ("b", 0.85)], 8), (2, 2, [], 9)]
    df = spark.createDataFrame(steps, "sid int, t int, candidates array<struct<method:string,conf:double>>, v int")
    got = {(r.sid, r.t, r.method, r.conf, r.v) for r in sequence.hysteresis(df, "sid", ["t"], 0.1, ["v"]).collect()}
    assert got == {(1, i, "a", 0.9, i * 10) for i in range(4)} | {(2, 0, "b", 0.85, 7), (2, 1, "b", 0.85, 8)}


def test_rings_are_dealt_to_all_tasks(spark):
    rows = spark.createDataFrame([(i, date(2000, 1, 1), 10.0, 20.0, 7.0, 10.0, 0.0, 30.0) for i in range(40)], "event_id long, eq_time date, lat double, lon double, mw double, depth_km double, rake1 double, strike double").coalesce(1)
    assert quake.quake_footprints(rows).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1


def test_rings_of_many_splits_are_not_dealt_out(spark):
    rows = spark.createDataFrame([(i, date(2000, 1, 1), 10.0, 20.0, 7.0, 10.0, 0.0, 30.0) for i in range(40)], "event_id long, eq_time date, lat double, lon double, mw double, depth_km double, rake1 double, strike double")
    rows = rows.repartition(spark.sparkContext.defaultParallelism)
    got, dealt = quake.quake_footprints(rows), quake.quake_footprints(rows.coalesce(1))
    assert "hashpartitioning(event_id" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 80 and sorted(got.collect()) == sorted(dealt.collect())


def greedy(rows, days=14, km=200.0):
    """The reference order: every record joins the first open cluster in reach of its running centre, over the whole table."""
    out, clusters = {}, []
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        home = None
        for c in clusters:
            if r[1] - timedelta(days) <= c["end"] and r[2] + timedelta(days) >= c["start"] and hav(r[3], r[4], c["lat"], c["lon"]) <= km:
                home = c
                break
        if home is None:
            home = {"id": r[0], "n": 0, "lat": 0.0, "lon": 0.0, "start": r[1], "end": r[2]}
            clusters.append(home)
        n = home["n"]
        home |= {"n": n + 1, "lat": (home["lat"] * n + r[3]) / (n + 1), "lon": (home["lon"] * n + r[4]) / (n + 1), "start": min(home["start"], r[1]), "end": max(home["end"], r[2])}
        out[r[0]] = home["id"]
    return out


def test_greedy_clusters_over_long_chains(spark):
    rng = random.Random(9)
    rows = [(i, date(2000, 1, 1) + timedelta(rng.randrange(400)), None, rng.uniform(0, 6), rng.uniform(0, 6)) for i in range(250)]
    rows = [(i, s, s + timedelta(rng.randrange(6)), a, b) for i, s, _, a, b in rows]
    df = spark.createDataFrame([(i, "DFO", s, e, a, b, 1.0) for i, s, e, a, b in rows], "row_id long, source string, start_date date, end_date date, lat double, lon double, area_km2 double")
    assert dict(flood.clusters(df).collect()) == greedy(rows)


@pytest.mark.parametrize(("tile", "margin"), [(2.0, 0.0), (3.0, 150.0)])
def test_greedy_clusters_over_tiles(spark, tile, margin):
    """Dense records are one component in space and time; no pass holds them all, and the tiles agree on one pass over the table, at the date line and a pole, too."""
    rng = random.Random(11)
    rows = [(i, date(2000, 1, 1) + timedelta(rng.randrange(60)), *((rng.uniform(0, 8), rng.uniform(176, 184)) if i % 4 else (rng.uniform(84, 90), rng.uniform(-180, 180)))) for i in range(400)]
    rows = [(i, s, s + timedelta(rng.randrange(6)), a, b) for i, s, a, b in rows]
    df = spark.createDataFrame([(i, "DFO", s, e, a, b, 1.0) for i, s, e, a, b in rows], "row_id long, source string, start_date date, end_date date, lat double, lon double, area_km2 double")
    reached = df.select(F.explode(flood._tiles_reached("lat", "lon", margin + 400.0, tile))).groupBy("col").count().agg(F.max("count")).first()[0]
    assert reached < 350 and dict(flood.clusters(df, tile_deg=tile, margin_km=margin).collect()) == greedy(rows)


@pytest.mark.parametrize("tile", [4.0, 360.0])
def test_greedy_clusters_over_windows(spark, tile):
    """Clusters that stay open over several windows of days keep their number, mean and order, and none of a settled window is gone over again."""
    rng = random.Random(12)
    rows = [(i, date(2000, 1, 1) + timedelta(rng.randrange(120)), rng.uniform(0, 9), rng.uniform(176, 184)) for i in range(300)]
    rows = [(i, s, s + timedelta(rng.randrange(60) if i % 40 == 0 else rng.randrange(6)), a, b) for i, s, a, b in rows]
    df = spark.createDataFrame(rows, "row_id long, start_date date, end_date date, lat double, lon double")
    want = greedy(rows)
    assert dict(flood.clusters(df, tile_deg=tile, margin_km=300.0, window=100).collect()) == want
    begun = {r[0]: r[1] for r in rows}
    assert max(r[1] - begun[want[r[0]]] for r in rows) > timedelta(60)


def test_greedy_clusters_without_coordinates(spark):
    """A record without coordinates is a cluster of its own, and no other joins it."""
    day = date(2000, 1, 1)
    rows = [(1, 10.0, 10.0), (2, None, None), (3, -60.0, 170.0), (4, 50.0, -100.0), (5, 10.5, 10.0), (6, float("nan"), 10.0), (7, 10.2, None)]
    df = spark.createDataFrame([(i, "DFO", day + timedelta(k), None, a, b, 1.0) for k, (i, a, b) in enumerate(rows)] + [(8, "DFO", None, None, 10.0, 10.0, 1.0)], "row_id long, source string, start_date date, end_date date, lat double, lon double, area_km2 double")
    assert dict(flood.clusters(df).collect()) == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1, 6: 6, 7: 7, 8: 8}


def test_footprints_at_the_poles(spark):
    """A step at a pole reaches all columns, and none twice; one beside it as many as lie within its radius."""
    steps = spark.createDataFrame([(1, 90.0, 0.0), (2, 89.9, 30.0), (3, -90.0, 10.0), (4, 0.0, 179.9)], "sid long, lat double, lon double")
    for q in ("ne", "se", "sw", "nw"):
        steps = steps.withColumn(f"{q}_km", F.lit(100.0))
    got = {}
    for r in storm.footprint_cells(steps, 0.5).collect():
        got.setdefault(r.sid, []).append((r.row, r.col))
    assert set(got) == {1, 2, 3, 4} and all(0 <= c < 720 and 0 <= r < 360 for v in got.values() for r, c in v)
    assert {c for r, c in got[1] if r == 359} == set(range(720)) and {c for _, c in got[4]} & {0, 719} == {0, 719}


def test_audit_isolates_a_failing_pipeline(spark):
    losses = spark.createDataFrame([(1, "a", "flood", date(2000, 1, 1), 1.0, 1.0, True), (2, "b", "storm", date(2000, 1, 1), 1.0, 1.0, True), (3, "c", "tsunami", date(2000, 1, 1), None, None, True), (4, "d", "flood", date(2000, 1, 1), 1.0, 1.0, False)], "rec_id long, event_id string, hazard string, start_date date, lat double, lon double, in_scope boolean").withColumn("end_date", F.col("start_date"))
    feature = spark.createDataFrame([(9, date(2000, 1, 2), date(2000, 1, 2), 1.5, 1.0)], "l_id long, l_start date, l_end date, l_lat double, l_lon double")

    def broken():
        raise ValueError("no such file")

    got = audit.run_audit(losses, {"flood": lambda: feature, "storm": broken, "tsunami": lambda: feature.limit(0), "earthquake": lambda: feature}, dict.fromkeys(audit.PIPELINES, 250.0))
    assert {r.rec_id: r.reason for r in got.collect()} == {1: "matched", 2: "pipeline_error", 3: "pipeline_empty", 4: "oecd_excluded"}


def test_quake_errors_and_strikes(spark):
    rows = spark.createDataFrame([(1, date(2000, 1, 1), 10.0, 20.0, 7.0, 10.0, 0.0, 30.0), (2, date(2000, 1, 1), 10.0, 20.0, None, 10.0, 0.0, 30.0), (3, date(2000, 1, 1), None, 20.0, 7.0, 10.0, 0.0, 30.0)], "event_id long, eq_time date, lat double, lon double, mw double, depth_km double, rake1 double, strike double")
    plain = {r.band: r for r in quake.quake_bands(rows).collect()}
    more = rows.withColumn("SMAJAX", F.lit(12.0)).withColumn("sminax", F.lit(None).cast("double")).withColumn("str1", F.lit(75.0))
    got = {r.band: r for r in quake.quake_bands(more).collect()}
    assert set(plain) == set(got) == {"VI", "VII"}
    for band, r in got.items():
        assert abs(r.a_km - math.hypot(plain[band].a_km, 12.0)) < 1e-9 and r.b_km == plain[band].b_km and (plain[band].strike_deg, r.strike_deg) == (30.0, 75.0)


@pytest.mark.parametrize("days", [0, 14])
def test_enrichment_by_brute_force(spark, days):
    rng = random.Random(3)
    day = lambda: date(2000, 1, 1) + timedelta(rng.randrange(200))
    place = lambda: (rng.uniform(-60, 60), rng.uniform(-180, 180)) if rng.random() < 0.8 else (None, None)
    floods = [(i, s := day(), s + timedelta(rng.randrange(5)), *place()) for i in range(60)] + [(99, None, None, 1.0, 1.0)]
    losses = [(100 + i, s := day(), s + timedelta(rng.randrange(3)), *place()) for i in range(25)]
    a = spark.createDataFrame(floods, "row_id long, start_date date, end_date date, lat double, lon double")
    b = spark.createDataFrame(losses, "rec_id long, start_date date, end_date date, lat double, lon double")
    want = {}
    for i, s, e, la, lo in floods:
        pairs = [(hav(la, lo, x, y), k) for k, u, v, x, y in losses if s and s <= v + timedelta(days) and e >= u - timedelta(days)]
        near = [p for p in pairs if p[0] is not None]
        if pairs:
            want[i] = min(near)[1] if near else min(k for _, k in pairs)
    got = {r.row_id: (r.rec_id, r.km) for r in flood.enriched(a, b, days).collect()}
    assert {i: k for i, (k, _) in got.items()} == want and any(km is None for _, km in got.values()) and flood.enriched(a.limit(0), b).count() == 0


def test_enrichment_reaches_as_far_as_losses_are_dense(spark):
    rng = random.Random(4)
    spread = [(i, date(2000, 1, 1 + i % 28), date(2000, 1, 1 + i % 28), rng.uniform(-60, 60), rng.uniform(-180, 180)) for i in range(4000)]
    kind = "r_id long, r_start date, r_end date, r_lat double, r_lon double"
    few, many = (flood._tiers(spark.createDataFrame(rows, kind)) for rows in (spread[:40], spread))
    assert many[0] < few[0] and many[-1] == few[-1] == 3200.0 and all(b == 2 * a for a, b in zip(many, many[1:]))
    assert flood._tiers(spark.createDataFrame([(i, date(2000, 1, 1), date(2000, 1, 1), 1.0, 1.0) for i in range(40)], kind))[0] <= 1.0 and flood._tiers(spark.createDataFrame([], kind)) == [3200.0]
    a = spark.createDataFrame([(i, s, e, la, lo) for i, s, e, la, lo in spread[::40]] + [(-1, date(1990, 1, 1), date(2010, 1, 1), 5.0, 5.0)], "row_id long, start_date date, end_date date, lat double, lon double")
    b = spark.createDataFrame([(k * 10_000 + i, *x) for i, *x in spread for k in (2, 1)], "rec_id long, start_date date, end_date date, lat double, lon double")
    got = {r.row_id: (r.rec_id, round(r.km, 6)) for r in flood.enriched(a, b).collect()}
    near = min((hav(5.0, 5.0, la, lo), i) for i, _, _, la, lo in spread)
    assert got == {i: (10_000 + i, 0.0) for i, *_ in spread[::40]} | {-1: (10_000 + near[1], round(near[0], 6))}


def test_storm_without_candidates_gets_a_capsule(spark):
    rows = [(1, date(2000, 1, 1 + i), 1, i, 1, 1, 10.0, 179.0 + i if i < 1 else -180.0 + i, None, "XX", None, None, None, None, None, None) for i in range(3)]
    kinds = "sid int, iso_time date, k1 int, k2 int, k3 int, k4 int, lat double, lon double, category int, basin string, ne double, se double, sw double, nw double, roci_nm double, rmw_nm double"
    cells, chosen = storm.storm_footprints(spark.createDataFrame(rows, kinds), 0.25)
    found = {(r.row, r.col) for r in cells.collect()}
    assert chosen.count() == 0 and {c for _, c in found} >= {0, 1439} and (400, round((179.0 + 180) * 4)) in found
    quad = [(*rows[0][:8], 3, "WP", 60.0, None, None, 30.0, None, None)]
    step = storm.step_footprints(spark.createDataFrame(quad, kinds)).first()
    assert step.method == "quadrant_smoothed" and abs(step.ne_km - 60 * 1.852) < 1e-9 and step.se_km is None


@there
def test_bundle_agrees_with_its_parts(spark):
    runup, coast = (fixtures.view(spark, DIR, v) for v in ("fx_runup", "fx_coast_vertex"))
    found = tsunami.layers(runup, coast, sample_m=4000.0)
    assert found["runups_snapped"].count() + found["runups_rejected"].count() == runup.count()
    merged = {(r.event_id, r.cx, r.cy) for r in found["merged_impact"].collect()}
    assert merged == {(r.event_id, r.cx, r.cy) for k in ("runups_impact", "rays_impact") for r in found[k].collect()}
    kept = {(r.event_id, r.cx, r.cy) for r in found["merged_conservative"].collect()}
    base = {(r.event_id, r.cx, r.cy) for r in tsunami.buffer_on_land(tsunami.lines_of(found["runups_segments"], layer_queries.joins.segments(coast)), 2000.0, 6000.0).collect()}
    assert base <= kept
    counts = {(r.layer, r.event_id): r.n for r in registry.queries()["tsunami_layers"](spark, DIR).collect()}
    assert counts["origin", 3] == 1 and len({k for k, _ in counts}) >= 9


@there
def test_flood_events_cover_all_records(spark):
    views = [fixtures.view(spark, DIR, v) for v in ("fx_flood", "fx_loss")]
    records = flood.flood_records(*layer_queries._sources(views[0]))
    events = flood.flood_events(records, audit.loss_records(views[1]).where("hazard = 'flood'")).collect()
    rows = [(r.row_id, r.start_date, r.end_date or r.start_date, r.lat, r.lon) for r in records.select("row_id", "start_date", "end_date", "lat", "lon").collect()]
    sizes = {}
    for k in greedy(rows).values():
        sizes[k] = sizes.get(k, 0) + 1
    assert {e.cluster: e.n for e in events} == sizes and all(len(e.source_event_ids.split("|")) == e.n for e in events)
    assert all(e.fields["event_id"].startswith(e.sources.split("|")[-1]) or len(e.sources.split("|")) > 1 for e in events)
    assert list(itertools.islice((e for e in events if e.km is not None and e.km < 0), 1)) == []


@pytest.mark.parametrize("spread, days", [(1.0, 14), (30.0, 14), (30.0, 0)])
def test_flood_components_by_brute_force(spark, monkeypatch, spread, days):
    draw, rows = random.Random(round(spread) + days), []
    for i in range(500):
        lat, lon = draw.choice([0.0, 50.0, 89.0]) + draw.uniform(-spread / 2, spread / 2), draw.choice([0.0, 180.0]) + draw.uniform(-spread, spread)
        start = date(2000, 1, 1) + timedelta(draw.randrange(700))
        end = draw.choice([None, start + timedelta(draw.randrange(9)), start + timedelta(5), start - timedelta(draw.choice([3, 40])) if i % 9 == 0 else start, start + timedelta(1500) if i % 97 == 0 else start])
        rows.append((1000 - i, None if i % 50 == 7 else start, end, min(lat, 90.0), lon - 360.0 * (lon > 180)))
    rows += [(2000 + i, date(2003, 1, 1) + timedelta(40 * i), None, *draw.choice([(None, 1.0), (1.0, None)])) for i in range(3)] + [(3000, date(2003, 1, 9), None, float("nan"), 2.0), (3001, date(2003, 1, 9), None, 3.0, 4.0)]
    up = {r[0]: r[0] for r in rows}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    by_time = timedelta(days)
    pairs = 0
    for k, p in enumerate(rows):
        for q in rows[:k]:
            if p[1] and q[1] and p[1] <= (q[2] or q[1]) + by_time and q[1] <= (p[2] or p[1]) + by_time and (None in p[3:] + q[3:] or hav(*p[3:], *q[3:]) <= 200.0):
                up[max(top(p[0]), top(q[0]))], pairs = min(top(p[0]), top(q[0])), pairs + 1
    want, edges, components = {i: top(i) for i in up}, [], flood.network.components
    monkeypatch.setattr(flood.network, "components", lambda links, *args: edges.append(links.count()) or components(links, *args))
    got = flood.pair_clusters(spark.createDataFrame(rows, "row_id long, start_date date, end_date date, lat double, lon double"), days)
    assert {r.row_id: r.component for r in got.collect()} == want and got.count() == len(rows)
    assert len(set(want.values())) > 8 and (spread > 1 or sum(edges) < len(rows) < pairs)  # pairs of dense records aren't listed


@there
def test_storm_steps_are_dealt_out_once(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        cells, _ = storm.storm_footprints(layer_queries._storm_steps(fixtures.view(spark, DIR, "fx_track")), 0.5)
        plan = cells.groupBy("sid").count()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    dealt = [line for line in plan.split("\n") if " Exchange hashpartitioning" in line and "ReusedExchange" not in line]
    assert sum("REPARTITION_BY_COL" in line for line in dealt) == 1 and len(dealt) <= 2
