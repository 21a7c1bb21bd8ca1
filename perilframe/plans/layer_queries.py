"""Registered queries of the composite layers: tsunami covers and bundle, storm footprints, flood events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from perilframe.functions import geo
from perilframe.functions import scalars as S
from perilframe.operators import cover, joins, sequence
from perilframe.plans import tsunami as TS
from perilframe.plans import audit as A
from perilframe.plans import flood as FL
from perilframe.plans import storm as ST
from perilframe.plans.registry import _K0, DISC, RSEG, SEG, STEPS, _authalic_sql, _discs, _lengths, _losses, _runup_segments, c, query, r6
from perilframe.sources import tables as T

# Ray hits of every event at each whole degree, as in bearing_first_hit.
HITS = f"""{SEG}, o AS (SELECT tsunami_event_id AS event_id, avg(x_m) + 0.5 AS ox, avg(y_m) + 0.5 AS oy FROM fx_runup GROUP BY 1), k AS (SELECT unnest(range(0, 360)) AS k),
r AS (SELECT event_id, k, part_id, s0, len, x1 - ox AS ax, y1 - oy AS ay, x2 - x1 AS dx, y2 - y1 AS dy, cos(radians(k * 1.0)) AS cb, sin(radians(k * 1.0)) AS sb FROM o, seg, k),
h AS (SELECT *, (ax * dy - ay * dx) / (cb * dy - sb * dx) AS t, (ax * sb - ay * cb) / (cb * dy - sb * dx) AS u FROM r WHERE cb * dy - sb * dx <> 0),
hit AS (SELECT event_id, k, part_id, t AS range_m, s0 + u * len AS station_m FROM h WHERE u BETWEEN -1e-9 AND 1 + 1e-9 AND t BETWEEN 0 AND 3000000.0 QUALIFY row_number() OVER (PARTITION BY event_id, k ORDER BY t, part_id, s0 + u * len) = 1)"""


def _hits(runup, coast):
    origins = runup.groupBy(c("tsunami_event_id").alias("event_id")).agg((F.avg("x_m") + 0.5).alias("ox"), (F.avg("y_m") + 0.5).alias("oy"))
    return joins.first_hits(origins, joins.segments(coast))


VARIABLE = f"""{HITS}, hv AS (SELECT event_id, part_id, station_m - 62500.0 AS a, station_m + 62500.0 AS b, range_m / 1000.0 AS rng, row_number() OVER (PARTITION BY event_id, part_id ORDER BY station_m - 62500.0, station_m + 62500.0, range_m) AS rn FROM hit),
w AS (SELECT event_id, part_id, rn, a, b, rng, 1 AS g FROM hv WHERE rn = 1 UNION ALL
  SELECT event_id, part_id, rn, CASE WHEN j THEN a ELSE na END, CASE WHEN j THEN greatest(b, nb) ELSE nb END, CASE WHEN j THEN (rng + nr) / 2.0 ELSE nr END, CASE WHEN j THEN g ELSE g + 1 END
  FROM (SELECT w.event_id, w.part_id, hv.rn, w.a, w.b, w.rng, w.g, hv.a AS na, hv.b AS nb, hv.rng AS nr, hv.a - w.b <= (20.0 + 40.0 * ((hv.rng + w.rng) / 2.0 / 1000.0)) * 1000.0 AS j FROM w JOIN hv ON hv.event_id = w.event_id AND hv.part_id = w.part_id AND hv.rn = w.rn + 1)),
mv AS (SELECT event_id, part_id, min(a) AS s0, max(b) AS s1, arg_max(rng, rn) AS range_km FROM w GROUP BY event_id, part_id, g)"""


@query(f"WITH RECURSIVE {VARIABLE} SELECT event_id, part_id, round(s0, 2) AS s0, round(s1, 2) AS s1, round(range_km, 3) AS range_km FROM mv", "fx_runup", "fx_coast_vertex")
def merge_intervals_variable(runup, coast):
    rows = _hits(runup, coast).select("event_id", "part_id", (c("station_m") - 62_500.0).alias("s0"), (c("station_m") + 62_500.0).alias("s1"), (c("range_m") / 1000.0).alias("range_km"))
    got = sequence.merge_intervals_variable(rows, ["event_id", "part_id"])
    return got.select("event_id", "part_id", F.round("s0", 2).alias("s0"), F.round("s1", 2).alias("s1"), F.round("range_km", 3).alias("range_km"))


@query(f"WITH RECURSIVE {VARIABLE} SELECT event_id, mv.part_id, round(greatest(0.0, s0), 2) AS s0, round(least(length_m, s1), 2) AS s1 FROM mv JOIN len ON len.part_id = mv.part_id WHERE least(length_m, s1) > greatest(0.0, s0)", "fx_runup", "fx_coast_vertex")
def hit_segments(runup, coast):
    return TS.hit_segments(_hits(runup, coast), _lengths(coast)).select("event_id", "part_id", F.round("s0", 2).alias("s0"), F.round("s1", 2).alias("s1"))


@query(f"""WITH {RSEG}, e AS (SELECT event_id, rseg.part_id, s0, s1 FROM rseg UNION ALL SELECT DISTINCT event_id, rseg.part_id, 0.0, 0.0 FROM rseg UNION ALL SELECT DISTINCT event_id, rseg.part_id, length_m, length_m FROM rseg JOIN len ON len.part_id = rseg.part_id),
g AS (SELECT event_id, part_id, max(s1) OVER w AS g0, lead(s0) OVER w AS g1 FROM e WINDOW w AS (PARTITION BY event_id, part_id ORDER BY s0, s1))
SELECT event_id, part_id, round(g0, 3) AS g0, round(g1, 3) AS g1 FROM g WHERE g1 > g0""", "fx_runup", "fx_coast_vertex")  # fmt: skip
def coverage_gaps_ends(runup, coast):
    return sequence.gaps(_runup_segments(runup, coast), ["event_id", "part_id"], _lengths(coast)).select("event_id", "part_id", F.round("g0", 3).alias("g0"), F.round("g1", 3).alias("g1"))


# Cells of 2 km whose centre lies in discs (event_id, x, y, r).
CELLS = """cells AS (SELECT DISTINCT event_id, cx, cy FROM (SELECT event_id, x, y, r, cx, unnest(range(CAST(floor((y - r) / 2000) AS BIGINT), CAST(ceil((y + r) / 2000) AS BIGINT) + 1)) AS cy
  FROM (SELECT *, unnest(range(CAST(floor((x - r) / 2000) AS BIGINT), CAST(ceil((x + r) / 2000) AS BIGINT) + 1)) AS cx FROM discs WHERE r >= 1000)) WHERE pow((cx + 0.5) * 2000 - x, 2) + pow((cy + 0.5) * 2000 - y, 2) <= r * r)"""
INLAND = f"""{RSEG}, sm AS (SELECT DISTINCT event_id, part_id, s0 + i * (s1 - s0) / (n - 1) AS station_m FROM (SELECT *, unnest(range(0, n)) AS i FROM (SELECT event_id, part_id, s0, s1, greatest(2, CAST(ceil((s1 - s0) / 4000.0) AS BIGINT)) AS n FROM rseg WHERE s1 > s0))),
ob AS (SELECT event_id, part_id, station_m, max(h) AS h FROM snap GROUP BY 1, 2, 3),
ht AS (SELECT sm.event_id, sm.part_id, sm.station_m, h FROM sm JOIN ob ON ob.event_id = sm.event_id AND ob.part_id = sm.part_id QUALIFY row_number() OVER (PARTITION BY sm.event_id, sm.part_id, sm.station_m ORDER BY abs(ob.station_m - sm.station_m), ob.station_m) = 1),
discs AS (SELECT event_id, x1 + (station_m - s0) / len * (x2 - x1) AS x, y1 + (station_m - s0) / len * (y2 - y1) AS y, greatest(0.1, least(12.0, h)) * 1000.0 AS r FROM ht JOIN seg ON seg.part_id = ht.part_id AND s0 <= station_m AND station_m <= s0 + len + 1e-6
  QUALIFY row_number() OVER (PARTITION BY event_id, ht.part_id, station_m ORDER BY s0 DESC) = 1), {CELLS}"""


@query(f"WITH {INLAND} SELECT event_id, count(*) AS cells, CAST(sum(cx) AS BIGINT) AS sx, CAST(sum(cy) AS BIGINT) AS sy FROM cells GROUP BY 1", "fx_runup", "fx_coast_vertex")
def inland_cover(runup, coast):
    got = TS.inland_cover(_runup_segments(runup, coast), TS.events_snapped(runup, coast), joins.segments(coast), 2000.0, 4000.0)
    return got.groupBy("event_id").agg(F.count(F.lit(1)).alias("cells"), F.sum("cx").alias("sx"), F.sum("cy").alias("sy"))


@query(f"""WITH {HITS}, st AS (SELECT event_id, st.part_id, s FROM (SELECT part_id, i * length_m / (n - 1) AS s FROM (SELECT *, unnest(range(0, n)) AS i FROM (SELECT *, greatest(2, CAST(floor(length_m / 4000.0) AS BIGINT)) AS n FROM len))) st JOIN (SELECT DISTINCT event_id, part_id FROM hit) p ON p.part_id = st.part_id),
ds AS (SELECT st.event_id, st.part_id, s, sum(exp(-(range_m / 1000.0) / 1500.0)) AS w FROM st LEFT JOIN hit ON hit.event_id = st.event_id AND hit.part_id = st.part_id AND hit.station_m BETWEEN s - 500000.0 AND s + 500000.0 GROUP BY 1, 2, 3),
discs AS (SELECT event_id, x1 + (s - s0) / len * (x2 - x1) AS x, y1 + (s - s0) / len * (y2 - y1) AS y, greatest(0.1, least(12.0, 100.0 * coalesce(w, 0) / 1000.0)) * 1000.0 AS r FROM ds JOIN seg ON seg.part_id = ds.part_id AND s0 <= s AND s <= s0 + len + 1e-6
  QUALIFY row_number() OVER (PARTITION BY event_id, ds.part_id, s ORDER BY s0 DESC) = 1), {CELLS} SELECT event_id, count(*) AS cells FROM cells GROUP BY 1""", "fx_runup", "fx_coast_vertex")  # fmt: skip
def hit_density_cover(runup, coast):
    hits = _hits(runup, coast).withColumn("weight", S.decay_weight(c("range_m") / 1000.0, 1500.0))
    got = TS.hit_density_cover(hits, joins.segments(coast), _lengths(coast), 2000.0, k=100.0, cap_km=12.0, step_m=4000.0)
    return got.groupBy("event_id").agg(F.count(F.lit(1)).alias("cells"))


BUFFER = f"""{RSEG}, pc AS (SELECT event_id, x1 + (greatest(rseg.s0, seg.s0) - seg.s0) / len * (x2 - x1) AS xa, y1 + (greatest(rseg.s0, seg.s0) - seg.s0) / len * (y2 - y1) AS ya,
  x1 + (least(rseg.s1, seg.s0 + len) - seg.s0) / len * (x2 - x1) AS xb, y1 + (least(rseg.s1, seg.s0 + len) - seg.s0) / len * (y2 - y1) AS yb FROM rseg JOIN seg ON seg.part_id = rseg.part_id AND rseg.s0 < seg.s0 + len AND rseg.s1 > seg.s0),
bx AS (SELECT *, unnest(range(CAST(floor((least(xa, xb) - 5000) / 2000) AS BIGINT), CAST(ceil((greatest(xa, xb) + 5000) / 2000) AS BIGINT) + 1)) AS cx FROM pc),
by_ AS (SELECT *, unnest(range(CAST(floor((least(ya, yb) - 5000) / 2000) AS BIGINT), CAST(ceil((greatest(ya, yb) + 5000) / 2000) AS BIGINT) + 1)) AS cy FROM bx),
bt AS (SELECT *, greatest(0.0, least(1.0, coalesce((((cx + 0.5) * 2000 - xa) * (xb - xa) + ((cy + 0.5) * 2000 - ya) * (yb - ya)) / nullif(pow(xb - xa, 2) + pow(yb - ya, 2), 0), 0))) AS t FROM by_),
bc AS (SELECT DISTINCT event_id, cx, cy FROM bt WHERE sqrt(pow((cx + 0.5) * 2000 - xa - t * (xb - xa), 2) + pow((cy + 0.5) * 2000 - ya - t * (yb - ya), 2)) <= 5000), {DISC}"""


@query(f"WITH {BUFFER} SELECT event_id, count(*) AS cells FROM bc WHERE (cx, cy) IN (SELECT (cx, cy) FROM dc) GROUP BY 1", "fx_runup", "fx_coast_vertex")
def buffer_on_land(runup, coast):
    segs = joins.segments(coast)
    got = TS.buffer_on_land(TS.lines_of(_runup_segments(runup, coast), segs), 2000.0, 5000.0, _discs(runup))
    return got.groupBy("event_id").agg(F.count(F.lit(1)).alias("cells"))


@query(f"WITH {BUFFER} SELECT event_id, count(*) AS cells FROM bc WHERE (cx, cy) NOT IN (SELECT (cx, cy) FROM dc) GROUP BY 1", "fx_runup", "fx_coast_vertex")
def cover_minus(runup, coast):
    lines = TS.lines_of(_runup_segments(runup, coast), joins.segments(coast))
    return cover.minus(cover.line_cover(lines, 5000.0, 2000.0, ["event_id"]), _discs(runup)).groupBy("event_id").agg(F.count(F.lit(1)).alias("cells"))


@query(None, "fx_runup", "fx_coast_vertex")
def tsunami_layers(runup, coast):
    """(layer, event_id, n): rows of each layer of the bundle, written and read back."""
    found = TS.written_layers(TS.layers(runup, coast, sample_m=4000.0))
    key = {"runups_rejected": "tsunami_event_id"}
    counts = [df.groupBy(c(key.get(name, "event_id")).alias("event_id")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("layer"), "event_id", "n") for name, df in found.items()]
    return reduce(lambda a, b: a.unionByName(b), counts)


@query("SELECT runup_id, round(greatest(0.1, least(12.0, runup_ht)), 6) AS km FROM fx_runup", "fx_runup")
def inland_distance(runup):
    return runup.select("runup_id", r6(S.inland_km(c("runup_ht"))).alias("km"))


@query("""SELECT row_id, CASE WHEN row_id % 25 = (row_id + 7) % 25 THEN CAST(row_id % 25 AS VARCHAR) ELSE array_to_string(list_sort([CAST(row_id % 25 AS VARCHAR), CAST((row_id + 7) % 25 AS VARCHAR)]), '|') END AS codes FROM fx_flood""", "fx_flood")
def code_list(flood):
    text = F.concat(F.lit(" "), (c("row_id") % 25).cast("string"), F.lit(";; "), ((c("row_id") + 7) % 25).cast("string"), F.lit(" ;"), (c("row_id") % 25).cast("string"))
    return flood.select("row_id", F.array_join(S.code_list(text), "|").alias("codes"))


# --------------------------------------------------------------------------------------------------------------- storms

BASINS = ("ATL", "EP", "WP", "SI", "SP", "NI")


def _storm_steps(track):
    """Track steps with four quadrants, an outer closed isobar and a radius of maximum wind made of the view's columns."""
    rows = ST.steps(track).withColumn("basin", F.element_at(F.array(*map(F.lit, BASINS)), (F.floor(c("sid") / 8) % 6 + 1).cast("int")))
    return rows.select(
        "sid", *ST.STEP_ORDER, "lat", "lon", "category", "basin", c("usa_r34_ne").alias("ne"), c("usa_r34_se").alias("se"), F.when(c("k4") % 3 != 0, (c("k4") % 60 + 10).cast("double")).alias("sw"),
        F.lit(None).cast("double").alias("nw"), F.when(c("k3") % 7 == 0, c("tokyo_wind")).alias("roci_nm"), (c("usa_wind") * 0.3).alias("rmw_nm"),
    )


_CLIMO = ", ".join(f"('{b}', {k}, {float(v)})" for b, row in ST.GALE_RADIUS_NM.items() for k, v in enumerate(row))
_FACTOR = " ".join(f"WHEN {k} THEN {v}" for k, v in ST.SIZE_FACTOR.items())
FOOT = f"""{STEPS}, climo(basin, cat, nm) AS (VALUES {_CLIMO}),
ss AS (SELECT sid, iso_time, k1, k2, k3, k4, lat, lon, category, CASE WHEN usa_r34_ne > 0 THEN usa_r34_ne END AS ne, CASE WHEN usa_r34_se > 0 THEN usa_r34_se END AS se, CASE WHEN k4 % 3 <> 0 THEN CAST(k4 % 60 + 10 AS DOUBLE) END AS sw, CAST(NULL AS DOUBLE) AS nw,
  CASE WHEN k3 % 7 = 0 AND tokyo_wind > 0 THEN tokyo_wind END AS roci, CASE WHEN usa_wind > 0 THEN usa_wind * 0.3 * CASE coalesce(category, 2) {_FACTOR} ELSE 2.0 END END AS rmw, {list(BASINS)!r}[CAST(sid // 8 % 6 AS INT) + 1] AS basin, max(category) OVER (PARTITION BY sid) AS top FROM sc),
mm AS (SELECT ss.*, CASE WHEN coalesce(ne, se, sw, nw) IS NOT NULL THEN 'quadrant_smoothed' WHEN roci IS NOT NULL THEN 'roci' WHEN rmw IS NOT NULL THEN 'rmw_scaled' WHEN nm > 0 THEN 'climo_r34' END AS method, coalesce(roci, rmw, nm) AS r FROM ss LEFT JOIN climo ON climo.basin = ss.basin AND cat = category),
qq AS (SELECT sid, iso_time, k1, k2, k3, k4, lat, lon, method, top, CASE method WHEN 'quadrant_smoothed' THEN 0.92 WHEN 'roci' THEN 0.80 WHEN 'rmw_scaled' THEN 0.65 ELSE 0.55 END::DOUBLE AS conf,
  {", ".join(f"CASE WHEN method = 'quadrant_smoothed' THEN {q} ELSE r END AS {q}" for q in ST.QUADS)} FROM mm WHERE method IS NOT NULL),
ar AS (SELECT *, ({" + ".join(f"coalesce((pow(coalesce({a}, {b}), 2) + coalesce({a}, {b}) * coalesce({b}, {a}) + pow(coalesce({b}, {a}), 2)) / 3.0, 0)" for a, b in (("ne", "se"), ("se", "sw"), ("sw", "nw"), ("nw", "ne")))}) * {3.141592653589793 / 4 * 1.852 * 1.852!r} AS area FROM qq),
fp AS (SELECT *, {", ".join(f"{q} * 1.852 * grow AS {q}_km" for q in ST.QUADS)} FROM (SELECT *, greatest(1.0, sqrt((60.0 + 20.0 * greatest(0, coalesce(top, 0))) / area)) AS grow FROM ar))"""


@query(f"WITH {FOOT} SELECT sid, k1, k2, k3, k4, CAST(iso_time AS VARCHAR) AS at, method, conf, {', '.join(f'round({q}_km, 4) AS {q}_km' for q in ST.QUADS)} FROM fp", "fx_track")
def storm_steps(track):
    got = ST.step_footprints(_storm_steps(track))
    return got.select("sid", "k1", "k2", "k3", "k4", c("iso_time").cast("string").alias("at"), "method", "conf", *(F.round(f"{q}_km", 4).alias(f"{q}_km") for q in ST.QUADS))


def _raw_sql(i):
    arms = " ".join(f"WHEN {i} // 90 = {k} THEN (1 - ({i} % 90) / 89.0) * coalesce({a}_km, {b}_km) + ({i} % 90) / 89.0 * coalesce({b}_km, {a}_km)" for k, (a, b) in enumerate((("ne", "se"), ("se", "sw"), ("sw", "nw"), ("nw", "ne"))))
    return f"CASE {arms} END"


CELLED = f"""{FOOT}, br AS (SELECT *, greatest({", ".join(f"coalesce({q}_km, 0)" for q in ST.QUADS)}) AS reach, 111.0 * cos(radians(lat)) AS flat FROM fp),
rw AS (SELECT *, unnest(range(CAST(floor((lat + 90 - reach / 111.0) / 0.5) AS BIGINT), CAST(ceil((lat + 90 + reach / 111.0) / 0.5) AS BIGINT) + 1)) AS row FROM br),
cl AS (SELECT *, unnest(range(CAST(floor((lon + 180 - reach / flat) / 0.5) AS BIGINT), CAST(ceil((lon + 180 + reach / flat) / 0.5) AS BIGINT) + 1)) AS col FROM rw),
dd AS (SELECT *, ((col + 0.5) * 0.5 - 180.0 - lon) * flat AS dx, ((row + 0.5) * 0.5 - 90.0 - lat) * 111.0 AS dy FROM cl),
ii AS (SELECT *, CAST(floor((degrees(atan2(dy, dx)) % 360 + 360) % 360) AS BIGINT) % 360 AS i FROM dd WHERE sqrt(dx * dx + dy * dy) <= reach),
rr AS (SELECT *, {_raw_sql("((i + 359) % 360)")} AS ra, {_raw_sql("i")} AS rb, {_raw_sql("((i + 1) % 360)")} AS rc FROM ii),
ce AS (SELECT DISTINCT sid, row, (col % 720 + 720) % 720 AS col FROM rr WHERE sqrt(dx * dx + dy * dy) <= (coalesce(ra, rb) + 2 * coalesce(rb, (coalesce(ra, rb) + coalesce(rc, rb)) * 0.5) + coalesce(rc, rb)) / 4.0)"""


@query(f"WITH {CELLED} SELECT sid, count(*) AS cells, round(sum(({_authalic_sql('((row + 1) * 0.5 - 90.0)')} - {_authalic_sql('(row * 0.5 - 90.0)')}) * {geo.WGS84_A / (2 * _K0) / (geo.WGS84_A / (2 * _K0))!r} * radians(0.5) * {geo.WGS84_A * _K0!r} / 1e6), 0) AS area_km2 FROM ce GROUP BY 1", "fx_track")
def storm_footprints(track):
    cells, _ = ST.storm_footprints(_storm_steps(track), 0.5)
    return cells.groupBy("sid").agg(F.count(F.lit(1)).alias("cells"), F.round(F.sum(ST.cell_area_km2(c("row"), 0.5)), 0).alias("area_km2"))


@query("""SELECT l_orderkey AS k1, l_linenumber AS k2, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN 'BLEND(USA,TOKYO)' WHEN a IS NOT NULL THEN 'USA' WHEN b IS NOT NULL THEN 'TOKYO' END AS source,
  round(CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN (degrees(atan2(sin(radians(a)) + 0.9 * sin(radians(b)), cos(radians(a)) + 0.9 * cos(radians(b)))) + 540) % 360 - 180 ELSE coalesce(a, b) END, 6) AS lon
  FROM (SELECT *, CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE CAST(l_partkey % 40 AS DOUBLE) - 190 + CASE WHEN l_partkey % 40 < 10 THEN 360 ELSE 0 END END AS a, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(l_suppkey % 20 AS DOUBLE) - 180 END AS b FROM lineitem)""", "lineitem")  # fmt: skip
def blend_position_tagged(lineitem):
    a = F.when(c("l_linenumber") % 2 != 0, (c("l_partkey") % 40).cast("double") - 190 + F.when(c("l_partkey") % 40 < 10, 360).otherwise(0))
    b = F.when(c("l_linenumber") % 3 != 0, (c("l_suppkey") % 20).cast("double") - 180)
    none = F.lit(None).cast("double")
    rows = lineitem.select(c("l_orderkey").alias("k1"), c("l_linenumber").alias("k2"), none.alias("lat"), none.alias("lon"), F.lit(1.0).alias("usa_lat"), a.alias("usa_lon"), F.lit(2.0).alias("tokyo_lat"), b.alias("tokyo_lon"))
    return ST.blended_position(rows, ["usa", "tokyo"]).select("k1", "k2", c("pos_source").alias("source"), r6(c("pos_lon")).alias("lon"))


@query("SELECT l_orderkey AS k1, l_linenumber AS k2, round((CAST(l_quantity AS DOUBLE) * 1.0 + CASE WHEN l_partkey % 4 = 0 THEN 0 ELSE l_partkey % 50 * 0.9 END + 0.75 * (l_suppkey % 30)) / (1.75 + CASE WHEN l_partkey % 4 = 0 THEN 0 ELSE 0.9 END), 6) AS ne FROM lineitem", "lineitem")
def quadrant_radius_all(lineitem):
    rows = lineitem.select(c("l_orderkey").alias("k1"), c("l_linenumber").alias("k2"), c("l_quantity").cast("double").alias("usa_r34_ne"), F.when(c("l_partkey") % 4 != 0, (c("l_partkey") % 50).cast("double")).alias("tokyo_r50_ne"), (c("l_suppkey") % 30).cast("double").alias("mlc_r64_ne"))
    return ST.weighted_radii(rows).select("k1", "k2", r6(c("ne")).alias("ne"))


# --------------------------------------------------------------------------------------------------------------- floods


def _sources(flood):
    """The view's floods in the forms of three sources: texts, each with its own date format and column names."""
    text = lambda v: c(v).cast("string")
    day = lambda v, form: F.date_format(v, form)
    k = c("row_id")
    dfo = flood.where("source = 'DFO'").select("row_id", k.cast("string").alias("ID"), F.lit("X").alias("Country"), text("lon").alias("long"), text("lat").alias("lat"), text("area_km2").alias("Area"), day("start_date", "yyyy-MM-dd").alias("Began"), day("end_date", "yyyy-MM-dd").alias("Ended"),
                                               F.when(k % 2 == 0, (k % 50).cast("string")).alias("Dead"), (k % 900).cast("string").alias("Displaced"), F.lit("rain").alias("MainCause"), F.when(k % 4 != 0, (k % 3).cast("string")).alias("Severity"))
    hanze = flood.where("source = 'HANZE'").select("row_id", k.cast("string").alias("ID"), F.lit("Y").alias("Country name"), text("lat").alias("lat"), text("lon").alias("lon"), day("start_date", "dd/MM/yyyy").alias("Start date"), day("end_date", "dd/MM/yyyy").alias("End date"),
                                                   text("area_km2").alias("Area flooded"), (k % 7).cast("string").alias("Fatalities"), F.lit("many").alias("Persons affected"), F.lit("river").alias("Cause"))
    usfd = flood.where("source = 'USFD'").select("row_id", F.lit("US").alias("COUNTRY"), text("lat").alias("LAT"), text("lon").alias("LON"), text("area_km2").alias("AREA"), day("start_date", "yyyyMMdd").alias("DATE_BEGIN"), day("end_date", "yyyyMMdd").alias("DATE_END"),
                                                 F.when(k % 5 == 0, (k % 11).cast("string")).alias("FATALITY"), F.lit("storm").alias("CAUSE"), F.when(k % 6 == 0, "high").alias("SEVERITY"))
    return dfo, hanze, usfd


RECORDS = """fr AS (SELECT row_id, source, source || '_' || row_id AS event_id, CAST(start_date AS DATE) AS start_date, CAST(end_date AS DATE) AS end_date, lat, lon, area_km2,
  CAST(CASE source WHEN 'DFO' THEN CASE WHEN row_id % 2 = 0 THEN row_id % 50 END WHEN 'HANZE' THEN row_id % 7 ELSE CASE WHEN row_id % 5 = 0 THEN row_id % 11 END END AS DOUBLE) AS fatalities,
  CAST(CASE source WHEN 'DFO' THEN row_id % 900 END AS DOUBLE) AS people_affected, CASE WHEN source = 'DFO' AND row_id % 4 <> 0 THEN CAST(row_id % 3 AS VARCHAR) END AS dfo_severity, CASE WHEN source = 'USFD' AND row_id % 6 = 0 THEN 'high' END AS usfd_severity FROM fx_flood)"""


@query(f"WITH {RECORDS} SELECT row_id, source, event_id, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date, round(lat, 6) AS lat, round(lon, 6) AS lon, round(area_km2, 6) AS area_km2, fatalities, people_affected, dfo_severity, usfd_severity FROM fr", "fx_flood")
def flood_records(flood):
    got = FL.flood_records(*_sources(flood))
    return got.select("row_id", "source", "event_id", c("start_date").cast("string").alias("start_date"), c("end_date").cast("string").alias("end_date"), r6(c("lat")).alias("lat"), r6(c("lon")).alias("lon"), r6(c("area_km2")).alias("area_km2"), "fatalities", "people_affected", "dfo_severity", "usfd_severity")


@query(f"""WITH {RECORDS}, p AS (SELECT *, row_id - row_id % 40 AS cluster, CASE source WHEN 'USFD' THEN 1 WHEN 'HANZE' THEN 2 ELSE 3 END::BIGINT * 1000000000 + row_id AS o FROM fr)
SELECT cluster, string_agg(source || ':' || event_id, '|' ORDER BY source || ':' || event_id) AS source_event_ids, coalesce(arg_min(usfd_severity, o), arg_min(dfo_severity, o)) AS severity,
  CASE WHEN arg_min(usfd_severity, o) IS NOT NULL THEN 'USFD severity as given' WHEN arg_min(dfo_severity, o) IS NOT NULL THEN 'DFO severity class (1, 1.5 or 2)' END AS severity_notes, arg_min(fatalities, o) AS fatalities_any, arg_min(people_affected, o) AS people_affected_any FROM p GROUP BY 1""", "fx_flood")  # fmt: skip
def flood_merge_records(flood):
    rows = FL.flood_records(*_sources(flood)).withColumn("cluster", c("row_id") - c("row_id") % 40)
    return FL.merged_records(rows).select("cluster", "source_event_ids", "severity", "severity_notes", "fatalities_any", "people_affected_any")


@query(None, "fx_flood", "fx_loss")
def flood_events(flood, loss):
    got = FL.flood_events(FL.flood_records(*_sources(flood)), _losses(loss).where("hazard = 'flood'"))
    return got.select("cluster", "event_id", c("start_date").cast("string").alias("start_date"), c("end_date").cast("string").alias("end_date"), "sources", "source_event_ids", "n", "severity", "rec_id", r6(c("km")).alias("km"))


# ------------------------------------------------------------------------------------------------ filters, rings, times


@query(f"WITH {STEPS} SELECT sid, count(*) AS n FROM st WHERE year(iso_time) >= 1998 GROUP BY 1", "fx_track")
def season_filter(track):
    return ST.in_seasons(ST.steps(track), 1998).groupBy("sid").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT runup_id, round(runup_ht, 6) AS h FROM fx_runup WHERE runup_ht >= 1.0 AND runup_ht < 2.0", "fx_runup")
def half_open_band(runup):
    return sequence.in_band(runup, "runup_ht", 1.0, 2.0).select("runup_id", r6(c("runup_ht")).alias("h"))


@query("SELECT rec_id FROM fx_loss WHERE start_month IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL", "fx_loss")
def required_columns(loss):
    return T.required(loss, ["start_month", "lat", "lon"]).select("rec_id")


@query("SELECT event_id, CAST(NULL AS VARCHAR) AS band, CAST(NULL AS DOUBLE) AS area_km2, round(mw, 6) AS mw FROM fx_quake", "fx_quake")
def ensured_columns(quake):
    return T.with_columns(quake, band="string", area_km2="double", mw="double").select("event_id", "band", "area_km2", r6(c("mw")).alias("mw"))


@query("SELECT runup_id, tsunami_event_id AS event_id FROM fx_runup WHERE tsunami_event_id IN (3, 11)", "fx_runup")
def event_filter(runup):
    return T.of_events(runup, "tsunami_event_id", [" 3 ", "11"]).select("runup_id", c("tsunami_event_id").alias("event_id"))


@query("""SELECT event_id, lat IS NOT NULL AND lon - 8000.0 / 111.0 / cos(radians(lat)) >= -180 AND lon + 8000.0 / 111.0 / cos(radians(lat)) <= 180 AND lat + 8000.0 / 111.0 <= 90 AND lat - 8000.0 / 111.0 >= -90 AS ok FROM fx_quake""", "fx_quake")
def ring_bounds_ok(quake):
    return quake.select("event_id", geo.ring_in_bounds(geo.circle_ring(c("lat"), c("lon"), F.lit(8000.0), 180)).alias("ok"))


@query("SELECT country_id, CASE country_id % 5 WHEN 0 THEN 'none' WHEN 1 THEN 'empty' WHEN 2 THEN 'invalid' WHEN 3 THEN 'zero_area' ELSE 'ok' END AS label FROM fx_country", "fx_country")
def ring_diagnosis(country):
    at = lambda x, y: F.struct(c(x).alias("x"), c(y).alias("y"))
    a, b, d = at("minx", "miny"), at("maxx", "miny"), at("maxx", "maxy")
    empty, k = F.slice(F.array(a), 1, 0), c("country_id") % 5
    ring = F.when(k == 1, empty).when(k == 2, F.array(a, b, a)).when(k == 3, F.array(a, b, F.struct(((c("minx") + c("maxx")) / 2).alias("x"), c("miny").alias("y")), a)).when(k == 4, F.array(a, b, d, a))
    return country.select("country_id", geo.diagnosis(ring).alias("label"))


@query("SELECT country_id, 5 AS vertices FROM fx_country", "fx_country")
def ring_thinned(country):
    """A box with a vertex in the middle of each side loses those."""
    at = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    mx, my = (c("minx") + c("maxx")) / 2, (c("miny") + c("maxy")) / 2
    ring = F.array(*(at(x, y) for x, y in ((c("minx"), c("miny")), (mx, c("miny")), (c("maxx"), c("miny")), (c("maxx"), my), (c("maxx"), c("maxy")), (mx, c("maxy")), (c("minx"), c("maxy")), (c("minx"), my), (c("minx"), c("miny")))))
    return country.select("country_id", F.size(geo.thinned(ring)).alias("vertices"))


@query("""WITH q AS (SELECT DISTINCT sid, CAST(sid % 90 + 10 AS DOUBLE) AS ne, CAST(sid % 70 + 20 AS DOUBLE) AS se FROM fx_track)
SELECT sid, 271 AS vertices, round(20.0 + ne * cos(radians(1)) / 111.0 / cos(radians(10.0)) + ((se - ne) / 89.0) * cos(radians(1)) / 111.0 / cos(radians(10.0)), 6) AS x1 FROM q""", "fx_track")  # fmt: skip
def quadrant_ring(track):
    """Two radii only, north-east and south-east: degrees 0 to 179 and, from the north-west on, 270 to 359, and the closing vertex."""
    s, none = c("sid"), F.lit(None).cast("double")
    q = track.select("sid").distinct().select("sid", (s % 90 + 10).cast("double").alias("ne"), (s % 70 + 20).cast("double").alias("se"))
    ring = geo.quadrant_ring(F.lit(10.0), F.lit(20.0), c("ne"), c("se"), none, none)
    return q.withColumn("ring", ring).select("sid", F.size("ring").alias("vertices"), r6(F.get("ring", F.lit(1))["x"]).alias("x1"))


@query("SELECT runup_id FROM (SELECT runup_id FROM fx_runup WHERE runup_ht < 0.5 ORDER BY runup_id LIMIT 50)", "fx_runup")
def reject_sample(runup):
    """The first fifty rejects, for a log: the limit is the feature."""
    return runup.where("runup_ht < 0.5").orderBy("runup_id").limit(50).select("runup_id")


@query(f"WITH {SEG} SELECT g AS coast, arg_max(part_id, struct_pack(l := length_m, p := -part_id)) AS part_id, round(max(length_m), 3) AS length_m FROM (SELECT *, part_id % 4 AS g FROM len) GROUP BY 1", "fx_coast_vertex")
def longest_part(coast):
    return sequence.longest_part(joins.part_lengths(joins.segments(coast)).withColumn("coast", c("part_id") % 4), "coast").select("coast", "part_id", F.round("length_m", 3).alias("length_m"))


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(eq_time AS VARCHAR) || ' 01:30:00' END AS at FROM fx_quake", "fx_quake")
def datetime_assembly(quake):
    """No row has a date and a time in columns of their own, so the datetime column is taken, though the date column is fuller."""
    rows = quake.select("event_id", F.lit("unknown").alias("date_text"), F.lit("01:30").alias("time_text"), F.when(c("event_id") % 4 != 0, F.concat(F.date_format("eq_time", "yyyy-MM-dd"), F.lit(" 01:30:00"))).alias("stamp"), F.date_format("eq_time", "yyyy-MM-dd").alias("day"))
    ways = {"date and time": F.try_to_timestamp(F.concat_ws(" ", "date_text", "time_text"), F.lit("yyyy-MM-dd HH:mm")), "datetime": F.try_to_timestamp("stamp", F.lit("yyyy-MM-dd HH:mm:ss")), "date": F.try_to_timestamp("day", F.lit("yyyy-MM-dd"))}
    return T.with_event_time(rows, ways).select("event_id", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("SELECT row_id FROM fx_flood WHERE area_km2 IS NULL UNION SELECT row_id FROM fx_flood WHERE end_date IS NULL", "fx_flood")
def distinct_union(flood):
    return flood.where("area_km2 IS NULL").select("row_id").union(flood.where("end_date IS NULL").select("row_id")).distinct()


@query("SELECT DISTINCT least(country_id, o) AS a, greatest(country_id, o) AS b FROM (SELECT country_id, unnest([(country_id + 1) % 25, (country_id + 24) % 25]) AS o FROM fx_country)", "fx_country")
def unordered_pairs(country):
    both = country.select("country_id", F.explode(F.array((c("country_id") + 1) % 25, (c("country_id") + 24) % 25)).alias("o"))
    return both.select(F.least("country_id", "o").alias("a"), F.greatest("country_id", "o").alias("b")).dropDuplicates(["a", "b"])
