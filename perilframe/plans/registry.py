"""Registered queries over the derived views, each with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from perilframe import fixtures, network
from perilframe.functions import geo
from perilframe.functions import scalars as S
from perilframe.io import shared_dir
from perilframe.operators import cover, joins, sequence
from perilframe.plans import audit as A
from perilframe.plans import flood as FL
from perilframe.plans import infill
from perilframe.plans import quake as QK
from perilframe.plans import storm as ST
from perilframe.plans import tsunami as TS
from perilframe.sources import tables as T

_QUERIES: dict[str, tuple[Callable, str | None]] = {}


def _losses(loss):
    """Loss records of the view, whose countries below 13 are the members."""
    return A.loss_records(loss, F.col("country_id") < 13)


def query(sql: str | None, *views: str):
    """Registers a function of the named views' DataFrames, with its SQL."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(*(fixtures.view(spark, sf_dir, v) for v in views))

        _QUERIES[fn.__name__] = (run, sql)
        return fn

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for name, (run, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: fixtures.with_views(sql) for name, (_, sql) in _QUERIES.items() if sql}


def r6(x):
    return F.round(x, 6)


c = F.col

# SQL that several oracles share. HAV: distance of points p and q; NL: normalised losses.
HAV = "CASE WHEN p.lat + p.lon + q.lat + q.lon IS NOT NULL THEN 2 * 6371.0 * asin(sqrt(least(1.0, greatest(0.0, pow(sin(radians(q.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(q.lat)) * pow(sin(radians(q.lon - p.lon) / 2), 2))))) END"
NL = """nl AS (SELECT rec_id, trim(translate(event_id_raw, '‐‑‒–—−', '------')) AS event_id,
  CASE WHEN lower(disaster_type) LIKE '%storm%' OR lower(disaster_type) LIKE '%cyclone%' THEN 'storm' WHEN lower(disaster_type) LIKE '%earth%' THEN 'earthquake'
       WHEN lower(disaster_type) LIKE '%tsunami%' THEN 'tsunami' WHEN lower(disaster_type) LIKE '%flood%' THEN 'flood' ELSE 'other' END AS hazard,
  country_id, lat, lon, country_id < 13 AS in_scope,
  make_date(start_year, coalesce(start_month, 1), CAST(least(start_day, day(last_day(make_date(start_year, coalesce(start_month, 1), 1)))) AS INT)) AS start_date FROM fx_loss)"""
#: Quake and loss match within 200 km and 7 days; a side without coordinates matches by time.
EQ = f"p.eq_time <= q.start_date + 7 AND p.eq_time >= q.start_date - 7 AND (q.lat IS NULL OR {HAV} <= 200.0)"
INTENSITY = "(12.27 + 2.270 * (mw - 6.0) + 0.1304 * pow(mw - 6.0, 2) - 1.30 * log10(R) - 7.07e-4 * R + 1.95 * CASE WHEN R > 30.0 THEN log10(R / 30.0) ELSE 0 END - 0.577 * mw * log10(R))"
MECH = "CASE WHEN rake1 IS NULL THEN 'U' WHEN abs(((rake1 + 180) % 360 + 360) % 360 - 180) <= 30 THEN 'SS' WHEN rake1 BETWEEN 45 AND 135 THEN 'R' WHEN rake1 BETWEEN -135 AND -45 THEN 'N' ELSE 'SS' END"
SEG = """seg AS (SELECT *, sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)) AS len, coalesce(sum(sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2))) OVER (PARTITION BY part_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s0
  FROM (SELECT part_id, seq, x_m AS x1, y_m AS y1, lead(x_m) OVER (PARTITION BY part_id ORDER BY seq) AS x2, lead(y_m) OVER (PARTITION BY part_id ORDER BY seq) AS y2 FROM fx_coast_vertex) WHERE x2 IS NOT NULL),
len AS (SELECT part_id, sum(len) AS length_m FROM seg GROUP BY 1)"""
SNAP = f"""{SEG}, near AS (SELECT runup_id, tsunami_event_id AS event_id, runup_ht AS h, part_id, s0 + t * len AS station_m, sqrt(pow(x_m - x1 - t * (x2 - x1), 2) + pow(y_m - y1 - t * (y2 - y1), 2)) AS d
  FROM (SELECT *, greatest(0.0, least(1.0, ((x_m - x1) * (x2 - x1) + (y_m - y1) * (y2 - y1)) / (pow(x2 - x1, 2) + pow(y2 - y1, 2)))) AS t FROM fx_runup, seg
        WHERE y_m BETWEEN least(y1, y2) - 25000 AND greatest(y1, y2) + 25000 AND x_m BETWEEN least(x1, x2) - 25000 AND greatest(x1, x2) + 25000)),
snap AS (SELECT * FROM near WHERE d <= 25000 QUALIFY row_number() OVER (PARTITION BY runup_id ORDER BY d, part_id, station_m) = 1)"""
RSEG = f"""{SNAP}, iv AS (SELECT event_id, snap.part_id, greatest(0.0, station_m - w) AS s0, least(length_m, station_m + w) AS s1
  FROM (SELECT *, CASE WHEN h > 0 THEN greatest(4.0, least(60.0, 8.0 * h)) ELSE 4.0 END * 500.0 AS w FROM snap) snap JOIN len ON len.part_id = snap.part_id),
isl AS (SELECT *, sum(CASE WHEN s0 - b <= 1000.0 THEN 0 ELSE 1 END) OVER (PARTITION BY event_id, part_id ORDER BY s0, s1, b NULLS FIRST ROWS UNBOUNDED PRECEDING) AS g
  FROM (SELECT *, max(s1) OVER (PARTITION BY event_id, part_id ORDER BY s0, s1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM iv WHERE s1 > s0)),
rseg AS (SELECT event_id, part_id, min(s0) AS s0, max(s1) AS s1, count(*) AS n FROM isl GROUP BY event_id, part_id, g)"""
STEPS = """st AS (SELECT *, CASE WHEN usa_wind IS NULL THEN tokyo_wind WHEN tokyo_wind IS NULL THEN usa_wind ELSE (usa_wind + 0.9 * tokyo_wind) / 1.9 END AS wind
  FROM (SELECT * FROM fx_track QUALIFY row_number() OVER (PARTITION BY sid, iso_time, k1, k2, k3, k4) = 1)),
sc AS (SELECT *, CASE WHEN wind IS NULL THEN NULL WHEN wind < 34 THEN -1 WHEN wind < 64 THEN 0 WHEN wind < 83 THEN 1 WHEN wind < 96 THEN 2 WHEN wind < 113 THEN 3 WHEN wind < 137 THEN 4 ELSE 5 END AS category FROM st)"""

# ---------------------------------------------------------------------------------------------------------------- scalars


@query(f"WITH {NL} SELECT rec_id, event_id FROM nl", "fx_loss")
def norm_event_id(loss):
    return loss.select("rec_id", S.norm_event_id(c("event_id_raw")).alias("event_id"))


@query(f"WITH {NL} SELECT hazard, count(*) AS n FROM nl GROUP BY 1", "fx_loss")
def classify_hazard(loss):
    return loss.groupBy(S.classify_hazard(c("disaster_type")).alias("hazard")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT country_id, CASE WHEN country_id % 7 = 0 THEN 'UNK' WHEN country_id % 7 = 1 THEN 'GBR' ELSE iso3 END AS iso FROM fx_country", "fx_country")
def norm_iso(country):
    raw = F.when(c("country_id") % 7 == 1, " ukm ").when(c("country_id") % 7 != 0, F.concat(F.lit(" "), F.lower("iso3")))
    return country.select("country_id", S.norm_iso(raw).alias("iso"))


@query(f"WITH {NL} SELECT rec_id, CAST(start_date AS VARCHAR) AS start_date FROM nl", "fx_loss")
def ymd_clamped(loss):
    return loss.select("rec_id", S.ymd_clamped(c("start_year"), c("start_month"), c("start_day")).cast("string").alias("start_date"))


@query("SELECT rec_id, CAST(make_date(start_year, coalesce(start_month, 1), least(28, start_day)) AS VARCHAR) AS start_date FROM fx_loss", "fx_loss")
def ymd_clamp28(loss):
    return loss.select("rec_id", S.ymd_clamp28(c("start_year"), c("start_month"), c("start_day")).cast("string").alias("start_date"))


@query("""SELECT row_id, CAST(CASE row_id % 4 WHEN 0 THEN CAST(start_date AS TIMESTAMP) WHEN 1 THEN CAST(start_date AS TIMESTAMP) + INTERVAL 90 MINUTE
  WHEN 2 THEN date_trunc('month', CAST(start_date AS TIMESTAMP)) ELSE NULL END AS VARCHAR) AS at FROM fx_flood""", "fx_flood")  # fmt: skip
def compact_dates(flood):
    form = F.when(c("row_id") % 4 == 0, F.date_format("start_date", "yyyyMMdd")).when(c("row_id") % 4 == 1, F.concat(F.date_format("start_date", "yyyyMMdd"), F.lit("0130"))).when(c("row_id") % 4 == 2, F.date_format("start_date", "yyyyMM")).otherwise("19x")
    return flood.select("row_id", F.date_format(S.compact_datetime(form), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("SELECT (year(eq_time) - year(eq_time) % 10)::VARCHAR || 's' AS decade, count(*) AS n FROM fx_quake GROUP BY 1", "fx_quake")
def decade(quake):
    return quake.groupBy(S.decade(c("eq_time")).alias("decade")).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT p.rec_id, round({HAV.replace('q.lat', '10.0').replace('q.lon', '20.0')}, 6) AS km FROM fx_loss p", "fx_loss")
def haversine(loss):
    return loss.select("rec_id", r6(geo.haversine_km(c("lat"), c("lon"), F.lit(10.0), F.lit(20.0))).alias("km"))


@query(f"WITH {STEPS} SELECT sid, k1, k2, k3, k4, CAST(iso_time AS VARCHAR) AS at, round(wind, 6) AS wind, CAST(category AS INT) AS category FROM sc", "fx_track")
def sshs(track):
    return ST.steps(track).select("sid", "k1", "k2", "k3", "k4", c("iso_time").cast("string").alias("at"), r6(c("wind")).alias("wind"), "category")


@query(f"SELECT event_id, {MECH} AS mech FROM fx_quake", "fx_quake")
def mechanism(quake):
    return quake.select("event_id", S.mechanism(c("rake1")).alias("mech"))


@query(f"SELECT event_id, round(sqrt(pow(10, -3.49 + 0.91 * mw) * ar), 6) AS l, round(pow(10, -3.49 + 0.91 * mw) / sqrt(pow(10, -3.49 + 0.91 * mw) * ar), 6) AS w FROM (SELECT *, CASE WHEN ({MECH}) = 'SS' THEN 3.0 ELSE 2.0 END AS ar FROM fx_quake)", "fx_quake")
def rupture_dims(quake):
    m = S.mechanism(c("rake1"))
    return quake.select("event_id", r6(S.rupture_length(c("mw"), m)).alias("l"), r6(S.rupture_width(c("mw"), m)).alias("w"))


@query(f"SELECT event_id, round({INTENSITY}, 6) AS mmi FROM (SELECT *, sqrt(10000.0 + pow(greatest(14.0, depth_km), 2)) AS R FROM fx_quake)", "fx_quake")
def intensity(quake):
    return quake.select("event_id", r6(S.intensity(c("mw"), F.lit(100.0), c("depth_km"))).alias("mmi"))


_BISECT = " ".join(
    f"""WITH RECURSIVE h AS (SELECT event_id, mw, greatest(14.0, depth_km) AS h FROM fx_quake),
b AS (SELECT event_id, mw, h, 0 AS i, 0.0::DOUBLE AS lo, 1500.0::DOUBLE AS hi FROM h
 UNION ALL SELECT event_id, mw, h, i + 1, CASE WHEN ok THEN (lo + hi) * 0.5 ELSE lo END, CASE WHEN ok THEN hi ELSE (lo + hi) * 0.5 END
 FROM (SELECT *, {INTENSITY} >= TARGET AS ok FROM (SELECT *, sqrt(pow((lo + hi) * 0.5, 2) + h * h) AS R FROM b WHERE i < 60))),
z AS (SELECT event_id, {INTENSITY} AS top FROM (SELECT *, h AS R FROM h))
SELECT event_id, round(CASE WHEN top < TARGET THEN 0.0 ELSE lo END, 5) AS radius_km FROM b JOIN z USING (event_id) WHERE i = 60""".split("\n")
)


@query(_BISECT.replace("TARGET", "6.0"), "fx_quake")
def intensity_radius(quake):
    return quake.select("event_id", F.round(S.intensity_radius(c("mw"), c("depth_km"), 6.0), 5).alias("radius_km"))


@query("SELECT runup_id, round(CASE WHEN runup_ht > 0 THEN greatest(4.0, least(60.0, 8.0 * runup_ht)) ELSE 4.0 END, 6) AS km FROM fx_runup", "fx_runup")
def runup_length(runup):
    return runup.select("runup_id", r6(S.runup_length_km(c("runup_ht"))).alias("km"))


@query("SELECT runup_id, round(exp(-(x_m / 1000.0) / 1500.0), 6) AS w FROM fx_runup", "fx_runup")
def decay_weight(runup):
    return runup.select("runup_id", r6(S.decay_weight(c("x_m") / 1000.0, 1500.0)).alias("w"))


@query("SELECT rec_id, round(radians(lon) * 6378137.0, 4) AS x, round(ln(tan(pi() / 4 + radians(lat) / 2)) * 6378137.0, 4) AS y FROM fx_loss", "fx_loss")
def mercator_xy(loss):
    return loss.select("rec_id", F.round(geo.mercator_x(c("lon")), 4).alias("x"), F.round(geo.mercator_y(c("lat")), 4).alias("y"))


_E, _K0 = geo.WGS84_E, math.cos(math.pi / 6) / math.sqrt(1 - geo.WGS84_E**2 / 4)


@query(f"SELECT rec_id, round(radians(lon) * {geo.WGS84_A * _K0!r}, 4) AS x, round(({1 - _E * _E!r} * (s / (1 - {_E * _E!r} * s * s) - ln((1 - {_E!r} * s) / (1 + {_E!r} * s)) / {2 * _E!r})) * {geo.WGS84_A / (2 * _K0)!r}, 4) AS y FROM (SELECT *, sin(radians(lat)) AS s FROM fx_loss)", "fx_loss")
def equal_area_xy(loss):
    return loss.select("rec_id", F.round(geo.equal_area_x(c("lon")), 4).alias("x"), F.round(geo.equal_area_y(c("lat")), 4).alias("y"))


@query("SELECT event_id, i, round(lon + 50.0 * cos(i * 2 * pi() / 12) / (111.0 * cos(radians(lat))), 6) AS x, round(lat + 50.0 * sin(i * 2 * pi() / 12) / 111.0, 6) AS y FROM (SELECT *, unnest(range(0, 12)) AS i FROM fx_quake)", "fx_quake")
def circle_ring(quake):
    ring = quake.select("event_id", F.posexplode(F.slice(geo.circle_ring(c("lat"), c("lon"), F.lit(50.0), 12), 1, 12)).alias("i", "p"))
    return ring.select("event_id", c("i").cast("long").alias("i"), r6(c("p.x")).alias("x"), r6(c("p.y")).alias("y"))


@query("SELECT rec_id, round(((lon * 3 + 180) % 360 + 360) % 360 - 180, 6) AS lon, round(greatest(-90.0, least(90.0, lat * 2)), 6) AS lat FROM fx_loss", "fx_loss")
def wrap_lonlat(loss):
    return loss.select("rec_id", r6(S.wrap_lon(c("lon") * 3)).alias("lon"), r6(F.greatest(F.lit(-90.0), F.least(F.lit(90.0), c("lat") * 2))).alias("lat"))


@query("SELECT rec_id, floor(lon * 10 + 0.5) / 10 AS lon, floor(lat * 10 + 0.5) / 10 AS lat FROM fx_loss", "fx_loss")
def snap_precision(loss):
    return loss.select("rec_id", (F.floor(c("lon") * 10 + 0.5) / 10).alias("lon"), (F.floor(c("lat") * 10 + 0.5) / 10).alias("lat"))


@query("SELECT rec_id, CASE WHEN rec_id % 4 = 0 THEN NULL ELSE damage END AS v, CASE WHEN rec_id % 4 = 0 THEN NULL ELSE CAST(trunc(damage) AS INT) END AS k FROM fx_loss", "fx_loss")
def coerce_numeric(loss):
    raw = F.when(c("rec_id") % 4 == 0, "n/a").otherwise(F.concat(F.lit(" "), c("damage").cast("string")))
    return loss.select("rec_id", S.coerce_double(raw).alias("v"), S.coerce_int(raw).alias("k"))


@query("SELECT sid, k1, k2, k3, k4, CASE WHEN usa_r34_ne > 60 THEN usa_r34_ne WHEN usa_r34_se > 0 THEN usa_r34_se END AS r FROM fx_track", "fx_track")
def first_positive(track):
    return track.select("sid", "k1", "k2", "k3", "k4", S.first_positive(F.when(c("usa_r34_ne") > 60, c("usa_r34_ne")).otherwise(-1.0), c("usa_r34_se")).alias("r"))


@query("SELECT rec_id, lon, lat * 1.6 AS lat FROM fx_loss WHERE lon BETWEEN -180 AND 180 AND lat * 1.6 BETWEEN -90 AND 90", "fx_loss")
def valid_points(loss):
    return loss.select("rec_id", "lon", (c("lat") * 1.6).alias("lat")).where(S.bounds_ok(c("lon"), c("lat")))


@query("SELECT rec_id, lon, lat FROM fx_loss WHERE lat IS NOT NULL", "fx_loss")
def points_from_lonlat(loss):
    raw = loss.select("rec_id", c("lon").cast("string").alias("lon"), c("lat").cast("string").alias("lat"))
    return raw.select("rec_id", S.coerce_double(c("lon")).alias("lon"), S.coerce_double(c("lat")).alias("lat")).where(S.bounds_ok(c("lon"), c("lat")))


# ----------------------------------------------------------------------------------------------------- scans, sinks, filters


@query("SELECT rec_id, disaster_type, lat, lon, CASE WHEN rec_id % 9 = 0 THEN NULL ELSE damage END AS damage FROM fx_loss", "fx_loss")
def scan_catalogue(loss):
    path = f"{shared_dir(loss.sparkSession)}/catalogue-{uuid.uuid4().hex}"
    T.write_csv(loss.select("rec_id", "disaster_type", "lat", "lon", F.when(c("rec_id") % 9 == 0, "unknown").otherwise(c("damage").cast("string")).alias("damage")), path)
    return T.scan_catalogue(loss.sparkSession, path, {"rec_id": "bigint", "lat": "double", "lon": "double", "damage": "double"})


@query("SELECT disaster_type, count(*) AS n, round(sum(lat), 3) AS lat FROM fx_loss GROUP BY 1", "fx_loss")
def scan_sniffed(loss):
    path = f"{shared_dir(loss.sparkSession)}/sniffed-{uuid.uuid4().hex}"
    loss.select("rec_id", "disaster_type", "lat").write.csv(path, header=True, sep=";")
    back = T.scan_sniffed(loss.sparkSession, path, {"rec_id": "bigint", "lat": "double"})
    return back.groupBy("disaster_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("lat"), 3).alias("lat"))


@query("SELECT 'n' || lpad(CAST(p_partkey % 60 AS VARCHAR), 2, '0') || CASE WHEN p_partkey % 2 = 0 THEN 'w' ELSE 'e' END || lpad(CAST(p_partkey % 180 AS VARCHAR), 3, '0') AS tile_id, CAST(p_partkey % 60 AS INT) AS sw_lat, CAST(CASE WHEN p_partkey % 2 = 0 THEN -1 ELSE 1 END * (p_partkey % 180) AS INT) AS sw_lon, count(*) AS n FROM part WHERE p_partkey % 3 <> 0 GROUP BY 1, 2, 3", "part")
def tile_index(part):
    k = c("p_partkey")
    name = F.concat(F.lit("n"), F.lpad((k % 60).cast("string"), 2, "0"), F.when(k % 2 == 0, "w").otherwise("e"), F.lpad((k % 180).cast("string"), 3, "0"))
    paths = part.select(F.when(k % 3 == 0, F.concat(F.lit("/dem/readme"), k.cast("string"))).otherwise(F.concat(F.lit("/dem/"), name, F.lit("_elv.tif"))).alias("path"))
    return T.tile_index(paths).groupBy("tile_id", "sw_lat", "sw_lon").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 'flood_' || (year(start_date) - year(start_date) % 10)::VARCHAR || 's_unk_' || lower(source) AS layer_name, count(*) AS n FROM fx_flood GROUP BY 1", "fx_flood")
def layer_manifest(flood):
    rows = flood.select(F.lit("Flood").alias("event_type"), c("start_date").alias("start_time"), F.lit(None).cast("string").alias("iso3"), c("source").alias("band"))
    return T.with_layer_name(rows).groupBy("layer_name").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT source AS band, count(*) AS n, round(sum(area_km2), 3) AS area_km2 FROM fx_flood GROUP BY 1", "fx_flood")
def write_layer(flood):
    path = f"{shared_dir(flood.sparkSession)}/layer-{uuid.uuid4().hex}"
    T.write_layer(flood.select(F.lit("flood").alias("event_type"), c("source").alias("band"), "area_km2"), path)
    return flood.sparkSession.read.parquet(path).groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("area_km2"), 3).alias("area_km2"))


@query("SELECT 'name' AS field, CAST(0 AS BIGINT) AS hits UNION ALL SELECT 'code', count(*) FROM fx_country WHERE iso3 IN ('CAX', 'CBX', 'CCX')", "fx_country")
def code_column_hits(country):
    codes = ["CAX", "CBX", "CCX"]
    hits = country.agg(*(F.count_if(c(f).isin(codes)).alias(n) for n, f in (("name", "country_name"), ("code", "iso3"))))
    return hits.select(F.inline(F.array(*(F.struct(F.lit(n).alias("field"), c(n).alias("hits")) for n in ("name", "code")))))


@query(f"WITH {STEPS} SELECT sid, max(category) AS category, count(*) AS n FROM sc WHERE category >= 3 GROUP BY 1", "fx_track")
def min_category(track):
    return ST.steps(track).where("category >= 3").groupBy("sid").agg(F.max("category").alias("category"), F.count(F.lit(1)).alias("n"))


@query(f"WITH {NL} SELECT 'oecd' AS scope, count(*) AS n FROM nl WHERE in_scope UNION ALL SELECT 'non_oecd', count(*) FROM nl WHERE NOT in_scope", "fx_loss")
def scope_filter(loss):
    return _losses(loss).groupBy(F.when(c("in_scope"), "oecd").otherwise("non_oecd").alias("scope")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {NL} SELECT DISTINCT hazard FROM nl WHERE in_scope", "fx_loss")
def hazards_in_scope(loss):
    return _losses(loss).where("in_scope").select("hazard").distinct()


@query("SELECT tsunami_event_id AS event_id, count(*) AS n, round(max(runup_ht), 6) AS top FROM fx_runup GROUP BY 1", "fx_runup")
def runups_for_event(runup):
    return runup.groupBy(c("tsunami_event_id").alias("event_id")).agg(F.count(F.lit(1)).alias("n"), r6(F.max("runup_ht")).alias("top"))


# ----------------------------------------------------------------------------------------------------------------- matching


@query(f"WITH {NL} SELECT event_id FROM fx_quake p WHERE EXISTS (SELECT 1 FROM nl q WHERE q.hazard = 'earthquake' AND p.eq_time <= q.start_date + 7 AND p.eq_time >= q.start_date - 7)", "fx_quake", "fx_loss")
def temporal_overlap_semi(quake, loss):
    return joins.temporal_overlap_semi(A.quakes_as_left(quake), A.as_right(_losses(loss), "earthquake")).select(c("l_id").alias("event_id"))


@query(f"WITH {NL} SELECT DISTINCT p.event_id FROM fx_quake p JOIN nl q ON {EQ} WHERE q.hazard = 'earthquake' AND q.lat IS NOT NULL", "fx_quake", "fx_loss")
def spacetime_filter(quake, loss):
    right = A.as_right(_losses(loss).where("lat IS NOT NULL"), "earthquake")
    return joins.spacetime_filter(A.quakes_as_left(quake), right, 200.0).select(c("l_id").alias("event_id"))


@query(f"WITH {NL} SELECT DISTINCT q.rec_id FROM fx_quake p JOIN nl q ON {EQ} WHERE q.hazard = 'earthquake'", "fx_quake", "fx_loss")
def matched_records(quake, loss):
    return joins.matched_ids(A.quakes_as_left(quake), A.as_right(_losses(loss), "earthquake"), 200.0).select(c("r_id").alias("rec_id"))


@query(f"WITH {NL} SELECT rec_id, event_id FROM nl x WHERE hazard = 'earthquake' AND NOT EXISTS (SELECT 1 FROM fx_quake p JOIN nl q ON {EQ} WHERE q.rec_id = x.rec_id)", "fx_quake", "fx_loss")
def unmatched_records(quake, loss):
    losses = _losses(loss).where("hazard = 'earthquake'")
    hit = joins.matched_ids(A.quakes_as_left(quake), A.as_right(losses), 200.0)
    return losses.join(hit, c("rec_id") == c("r_id"), "left_anti").select("rec_id", "event_id")


@query(f"WITH {NL} SELECT event_id FROM fx_quake WHERE event_id NOT IN (SELECT p.event_id FROM fx_quake p JOIN nl q ON {EQ} WHERE q.hazard = 'earthquake' AND q.lat IS NOT NULL)", "fx_quake", "fx_loss")
def excluded_features(quake, loss):
    kept = spacetime_filter(quake, loss)
    return quake.select("event_id").join(kept, "event_id", "left_anti")


@query(f"WITH {NL} SELECT rec_id, count(*) AS n FROM (SELECT q.rec_id FROM fx_quake p JOIN nl q ON {EQ} WHERE q.hazard = 'earthquake' AND q.lat IS NOT NULL UNION ALL SELECT rec_id FROM nl WHERE hazard = 'flood') GROUP BY 1", "fx_quake", "fx_loss")
def matched_union(quake, loss):
    losses = _losses(loss)
    pairs = joins.spacetime_pairs(A.quakes_as_left(quake), A.as_right(losses.where("lat IS NOT NULL"), "earthquake"), 200.0)
    return pairs.select(c("r_id").alias("rec_id")).unionByName(losses.where("hazard = 'flood'").select("rec_id")).groupBy("rec_id").agg(F.count(F.lit(1)).alias("n"))


AUDIT = f"""WITH {NL}, eq AS (SELECT DISTINCT q.rec_id FROM fx_quake p JOIN nl q ON {EQ} WHERE q.hazard = 'earthquake' AND q.in_scope),
fl AS (SELECT DISTINCT q.rec_id FROM fx_flood p JOIN nl q ON p.start_date <= q.start_date + 7 AND coalesce(p.end_date, p.start_date) >= q.start_date - 7 AND (q.lat IS NULL OR {HAV} <= 250.0) WHERE q.hazard = 'flood' AND q.in_scope),
tr AS (SELECT sid, min(iso_time) AS a, max(iso_time) AS b, avg(lat) AS lat, degrees(atan2(avg(sin(radians(lon))), avg(cos(radians(lon))))) AS lon FROM fx_track GROUP BY 1),
sm AS (SELECT DISTINCT q.rec_id FROM tr p JOIN nl q ON p.a <= q.start_date + 7 AND p.b >= q.start_date - 7 AND (q.lat IS NULL OR {HAV} <= 250.0) WHERE q.hazard = 'storm' AND q.in_scope),
au AS (SELECT rec_id, event_id, hazard, start_date, in_scope, CASE WHEN NOT in_scope THEN 'oecd_excluded' WHEN hazard = 'other' THEN 'hazard_unrecognized' WHEN hazard NOT IN (SELECT hazard FROM nl WHERE in_scope) THEN 'hazard_disabled'
  WHEN hazard = 'tsunami' AND NOT EXISTS (SELECT 1 FROM fx_runup) THEN 'pipeline_empty' WHEN (hazard = 'storm' AND rec_id IN (SELECT rec_id FROM sm)) OR (hazard = 'earthquake' AND rec_id IN (SELECT rec_id FROM eq)) OR (hazard = 'flood' AND rec_id IN (SELECT rec_id FROM fl)) THEN 'matched' ELSE 'not_matched' END AS reason FROM nl)"""


@query(AUDIT + " SELECT rec_id, event_id, hazard, CAST(start_date AS VARCHAR) AS start_date, in_scope, reason FROM au", "fx_loss", "fx_quake", "fx_flood", "fx_track", "fx_runup")
def loss_audit(loss, quake, flood, track, runup):
    return A.audit(_losses(loss), quake, flood, track, runup).select("rec_id", "event_id", "hazard", c("start_date").cast("string").alias("start_date"), "in_scope", "reason")


@query(AUDIT + " SELECT hazard, reason, count(*) AS n FROM au GROUP BY 1, 2", "fx_loss", "fx_quake", "fx_flood", "fx_track", "fx_runup")
def audit_summary(loss, quake, flood, track, runup):
    return A.audit(_losses(loss), quake, flood, track, runup).groupBy("hazard", "reason").agg(F.count(F.lit(1)).alias("n"))


@query(AUDIT + " SELECT CASE WHEN reason = 'matched' THEN 'matched' WHEN reason = 'oecd_excluded' THEN 'out_of_scope' ELSE 'unmatched' END AS split, count(*) AS n FROM au GROUP BY 1", "fx_loss", "fx_quake", "fx_flood", "fx_track", "fx_runup")
def audit_splits(loss, quake, flood, track, runup):
    path = f"{shared_dir(loss.sparkSession)}/audit-{uuid.uuid4().hex}"
    split = F.when(c("reason") == "matched", "matched").when(c("reason") == "oecd_excluded", "out_of_scope").otherwise("unmatched")
    A.audit(_losses(loss), quake, flood, track, runup).withColumn("split", split).write.partitionBy("split").csv(path, header=True)
    return loss.sparkSession.read.csv(path, header=True).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, iso3 FROM fx_quake JOIN fx_country ON lon >= minx AND lon < maxx AND lat >= miny AND lat < maxy", "fx_quake", "fx_country")
def tag_country(quake, country):
    return _in_country(quake, country).select("event_id", "iso3")


def _in_country(points, country):
    """Points with the box country they lie in: boxes as 12-degree cells, joined on the cell, then tested."""
    cell = lambda v: F.floor(v / 12.0).cast("int")
    boxes = country.withColumn("cx", F.explode(F.sequence(cell(c("minx")), cell(c("maxx"))))).withColumn("cy", F.explode(F.sequence(cell(c("miny")), cell(c("maxy")))))
    both = points.withColumn("cx", cell(c("lon"))).withColumn("cy", cell(c("lat"))).join(boxes, ["cx", "cy"])
    return both.where("lon >= minx AND lon < maxx AND lat >= miny AND lat < maxy")


@query("SELECT event_id, iso3 FROM fx_quake JOIN fx_country ON lon >= minx AND lon < maxx AND lat >= miny AND lat < maxy WHERE country_id IN (SELECT country_id FROM fx_loss WHERE disaster_type = 'Earthquake')", "fx_quake", "fx_country", "fx_loss")
def quakes_in_loss_countries(quake, country, loss):
    wanted = loss.where("disaster_type = 'Earthquake'").select(c("country_id").alias("_c")).distinct()
    return _in_country(quake, country.join(wanted, c("country_id") == c("_c"), "left_semi")).select("event_id", "iso3")


@query("SELECT row_id, source, o_orderpriority AS priority FROM fx_flood LEFT JOIN orders ON o_orderkey = row_id", "fx_flood", "orders")
def attr_left_join(flood, orders):
    attrs = orders.select(c("o_orderkey").alias("_id"), c("o_orderpriority").alias("priority"))
    return flood.join(attrs, c("row_id") == c("_id"), "left").select("row_id", "source", "priority")


@query("""WITH e AS (SELECT row_id, unnest([row_id % 25, (row_id + 7) % 25]) AS code FROM fx_flood)
SELECT row_id, count(*) AS regions, round(min(minx), 3) AS minx, round(max(maxx), 3) AS maxx FROM e JOIN fx_country ON country_id = code GROUP BY 1""", "fx_flood", "fx_country")  # fmt: skip
def code_list_join(flood, country):
    codes = flood.select("row_id", F.concat_ws(";", (c("row_id") % 25).cast("string"), ((c("row_id") + 7) % 25).cast("string")).alias("codes"))
    each = codes.select("row_id", F.explode(F.split("codes", ";")).alias("code"))
    return each.join(country, F.trim("code").try_cast("int") == c("country_id")).groupBy("row_id").agg(F.count(F.lit(1)).alias("regions"), F.round(F.min("minx"), 3).alias("minx"), F.round(F.max("maxx"), 3).alias("maxx"))


@query("SELECT event_id, concat(CASE WHEN la < 0 THEN 's' ELSE 'n' END, lpad(CAST(abs(la) AS VARCHAR), 2, '0'), CASE WHEN lo < 0 THEN 'w' ELSE 'e' END, lpad(CAST(abs(lo) AS VARCHAR), 3, '0')) AS tile_id FROM (SELECT event_id, CAST(floor(lat / 5) * 5 AS INT) AS la, CAST(floor(lon / 5) * 5 AS INT) AS lo FROM fx_quake)", "fx_quake")
def tiles_for_footprint(quake):
    la, lo = (F.floor(c("lat") / 5) * 5).cast("int"), (F.floor(c("lon") / 5) * 5).cast("int")
    name = F.concat(F.when(la < 0, "s").otherwise("n"), F.lpad(F.abs(la).cast("string"), 2, "0"), F.when(lo < 0, "w").otherwise("e"), F.lpad(F.abs(lo).cast("string"), 3, "0"))
    return quake.select("event_id", name.alias("tile_id"))


@query("SELECT tsunami_event_id AS event_id, round(avg(x_m), 3) AS x, round(avg(y_m), 3) AS y, count(*) AS n FROM fx_runup GROUP BY 1", "fx_runup")
def event_origin(runup):
    return runup.groupBy(c("tsunami_event_id").alias("event_id")).agg(F.round(F.avg("x_m"), 3).alias("x"), F.round(F.avg("y_m"), 3).alias("y"), F.count(F.lit(1)).alias("n"))


# -------------------------------------------------------------------------------------------------------------------- coast


@query("SELECT part_id, count(*) AS vertices, min(seq) AS first_seq, max(seq) AS last_seq FROM fx_coast_vertex GROUP BY 1", "fx_coast_vertex")
def coast_vertices(coast):
    return coast.groupBy("part_id").agg(F.count(F.lit(1)).alias("vertices"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))


@query(f"WITH {SEG} SELECT part_id, round(length_m, 3) AS length_m FROM len", "fx_coast_vertex")
def coast_parts(coast):
    return _lengths(coast).select("part_id", F.round("length_m", 3).alias("length_m"))


def _lengths(coast):
    return joins.segments(coast).groupBy("part_id").agg(F.sum("length").alias("length_m"))


@query(f"WITH {SEG} SELECT part_id, seq, round(s0, 3) AS s0, round(len, 3) AS length FROM seg", "fx_coast_vertex")
def linear_reference(coast):
    return joins.segments(coast).select("part_id", "seq", F.round("s0", 3).alias("s0"), F.round("length", 3).alias("length"))


@query(f"WITH {SEG} SELECT part_id, CAST(i AS INT) AS i, round(i * length_m / (n - 1), 3) AS station_m FROM (SELECT *, unnest(range(0, n)) AS i FROM (SELECT *, greatest(2, CAST(ceil(length_m / 5000.0) AS BIGINT)) AS n FROM len))", "fx_coast_vertex")
def sample_stations(coast):
    return sequence.stations(_lengths(coast), 5000.0).select("part_id", "i", F.round("station_m", 3).alias("station_m"))


@query(f"WITH {SEG} SELECT part_id, seq, round(greatest(12000.0, s0), 3) AS from_m, round(least(47000.0, s0 + len), 3) AS to_m, round(x1 + (greatest(12000.0, s0) - s0) / len * (x2 - x1), 3) AS xa, round(x1 + (least(47000.0, s0 + len) - s0) / len * (x2 - x1), 3) AS xb FROM seg WHERE 12000.0 < s0 + len AND 47000.0 > s0", "fx_coast_vertex")
def cut_substring(coast):
    iv = coast.select("part_id").distinct().withColumn("s0", F.lit(12000.0)).withColumn("s1", F.lit(47000.0))
    got = sequence.cut(joins.segments(coast), iv)
    return got.select("part_id", "seq", *(F.round(k, 3).alias(k) for k in ("from_m", "to_m", "xa", "xb")))


@query(f"WITH {SNAP} SELECT runup_id, part_id, round(station_m, 3) AS station_m, round(d, 3) AS distance_m FROM snap", "fx_runup", "fx_coast_vertex")
def snap_to_coast(runup, coast):
    return TS.events_snapped(runup, coast).select("runup_id", "part_id", F.round("station_m", 3).alias("station_m"), F.round("distance_m", 3).alias("distance_m"))


@query(f"WITH {SNAP} SELECT runup_id, 'no_coast_in_range' AS reason FROM fx_runup WHERE runup_id NOT IN (SELECT runup_id FROM snap)", "fx_runup", "fx_coast_vertex")
def snap_rejects(runup, coast):
    return runup.join(TS.events_snapped(runup, coast).select("runup_id"), "runup_id", "left_anti").select("runup_id", F.lit("no_coast_in_range").alias("reason"))


@query(f"WITH {SNAP} SELECT runup_id, part_id, round(min(d), 3) AS distance_m FROM near WHERE d <= 25000 GROUP BY 1, 2", "fx_runup", "fx_coast_vertex")
def knn_per_part(runup, coast):
    pts = runup.select(c("runup_id").alias("pt_id"), c("x_m").alias("x"), c("y_m").alias("y"))
    return joins.snapped(pts, joins.segments(coast), 25_000.0, per_part=True).select(c("pt_id").alias("runup_id"), "part_id", F.round("distance_m", 3).alias("distance_m"))


@query(f"""WITH {SEG}, d AS (SELECT s_suppkey, part_id, sqrt(pow(px - x1 - t * (x2 - x1), 2) + pow(py - y1 - t * (y2 - y1), 2)) AS d FROM (SELECT *, greatest(0.0, least(1.0, ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / (pow(x2 - x1, 2) + pow(y2 - y1, 2)))) AS t
  FROM (SELECT s_suppkey, CAST(s_suppkey * 7919 % 3000 AS DOUBLE) * 1000.0 AS px, CAST(s_suppkey * 104729 % 6000 AS DOUBLE) * 1000.0 AS py FROM supplier), seg))
SELECT s_suppkey AS pt_id, round(min(d), 3) AS distance_m FROM d GROUP BY 1""", "supplier", "fx_coast_vertex")  # fmt: skip
def nearest_part(supplier, coast):
    k = c("s_suppkey")
    pts = supplier.select(k.alias("pt_id"), ((k * 7919) % 3000).cast("double").alias("x"), ((k * 104729) % 6000).cast("double").alias("y")).select("pt_id", (c("x") * 1000.0).alias("x"), (c("y") * 1000.0).alias("y"))
    return joins.nearest(pts, joins.segments(coast)).select("pt_id", F.round("distance_m", 3).alias("distance_m"))


@query(f"""WITH {SNAP}, st AS (SELECT part_id, CAST(i AS INT) AS i, i * length_m / (n - 1) AS s FROM (SELECT *, unnest(range(0, n)) AS i FROM (SELECT *, greatest(2, CAST(ceil(length_m / 20000.0) AS BIGINT)) AS n FROM len))),
ob AS (SELECT part_id, station_m, max(h) AS h FROM snap GROUP BY 1, 2)
SELECT st.part_id, st.i, round(h, 6) AS h FROM st JOIN ob ON ob.part_id = st.part_id QUALIFY row_number() OVER (PARTITION BY st.part_id, st.i ORDER BY abs(station_m - s), station_m) = 1""", "fx_runup", "fx_coast_vertex")  # fmt: skip
def asof_nearest_height(runup, coast):
    got = joins.asof_nearest(sequence.stations(_lengths(coast), 20_000.0), TS.events_snapped(runup, coast), ["part_id"], "station_m", "h")
    return got.where("h IS NOT NULL").select("part_id", "i", r6(c("h")).alias("h"))


@query(f"WITH {SNAP} SELECT parts, count(*) AS events FROM (SELECT event_id, count(DISTINCT part_id) AS parts FROM snap GROUP BY 1) GROUP BY 1", "fx_runup", "fx_coast_vertex")
def parts_histogram(runup, coast):
    per = TS.events_snapped(runup, coast).groupBy("event_id").agg(F.countDistinct("part_id").alias("parts"))
    return per.groupBy("parts").agg(F.count(F.lit(1)).alias("events"))


def _runup_segments(runup, coast):
    return TS.runup_segments(TS.events_snapped(runup, coast), _lengths(coast))


@query(f"WITH {RSEG} SELECT event_id, part_id, round(s0, 3) AS s0, round(s1, 3) AS s1, n FROM rseg", "fx_runup", "fx_coast_vertex")
def runup_segments(runup, coast):
    return _runup_segments(runup, coast).select("event_id", "part_id", F.round("s0", 3).alias("s0"), F.round("s1", 3).alias("s1"), "n")


@query(f"WITH {RSEG} SELECT part_id, round(s0, 3) AS s0, round(s1, 3) AS s1 FROM (SELECT part_id, min(s0) AS s0, max(s1) AS s1 FROM (SELECT *, sum(CASE WHEN s0 <= b THEN 0 ELSE 1 END) OVER (PARTITION BY part_id ORDER BY s0, s1, b NULLS FIRST ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT part_id, s0, s1, max(s1) OVER (PARTITION BY part_id ORDER BY s0, s1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM rseg)) GROUP BY part_id, g)", "fx_runup", "fx_coast_vertex")
def merge_intervals(runup, coast):
    return sequence.merge_intervals(_runup_segments(runup, coast), ["part_id"]).select("part_id", F.round("s0", 3).alias("s0"), F.round("s1", 3).alias("s1"))


@query(f"WITH {RSEG} SELECT event_id, part_id, round(s1, 3) AS g0, round(g1, 3) AS g1 FROM (SELECT *, lead(s0) OVER (PARTITION BY event_id, part_id ORDER BY s0) AS g1 FROM rseg) WHERE g1 IS NOT NULL", "fx_runup", "fx_coast_vertex")
def coverage_gaps(runup, coast):
    return sequence.gaps(_runup_segments(runup, coast), ["event_id", "part_id"]).select("event_id", "part_id", F.round("g0", 3).alias("g0"), F.round("g1", 3).alias("g1"))


CLUSTER = "cl AS (SELECT *, sum(CASE WHEN station_m - b <= 50000.0 THEN 0 ELSE 1 END) OVER (PARTITION BY event_id, part_id ORDER BY station_m RANGE UNBOUNDED PRECEDING) AS cluster FROM (SELECT *, lag(station_m) OVER (PARTITION BY event_id, part_id ORDER BY station_m) AS b FROM snap))"


@query(f"WITH {SNAP}, {CLUSTER} SELECT runup_id, event_id, part_id, CAST(cluster AS BIGINT) AS cluster FROM cl", "fx_runup", "fx_coast_vertex")
def cluster_1d(runup, coast):
    return sequence.cluster_1d(TS.events_snapped(runup, coast), ["event_id", "part_id"], "station_m", 50_000.0).select("runup_id", "event_id", "part_id", c("cluster").cast("long").alias("cluster"))


@query(f"""WITH {SNAP}, st AS (SELECT part_id, CAST(i AS INT) AS i, i * length_m / (n - 1) AS s FROM (SELECT *, unnest(range(0, n)) AS i FROM (SELECT *, greatest(2, CAST(ceil(length_m / 50000.0) AS BIGINT)) AS n FROM len)))
SELECT st.part_id, st.i, round(coalesce(sum(h), 0), 6) AS weight FROM st LEFT JOIN snap ON snap.part_id = st.part_id AND snap.station_m BETWEEN s - 50000.0 AND s + 50000.0 GROUP BY 1, 2""", "fx_runup", "fx_coast_vertex")  # fmt: skip
def hit_density(runup, coast):
    hits = TS.events_snapped(runup, coast).select("part_id", "station_m", c("h").alias("weight"))
    return sequence.density(hits, sequence.stations(_lengths(coast), 50_000.0), 100_000.0).select("part_id", "i", r6(c("sum_weight")).alias("weight"))


@query(f"WITH {SNAP} SELECT part_id, runup_id, r FROM (SELECT part_id, runup_id, CAST(row_number() OVER (PARTITION BY part_id ORDER BY round(d, 3), runup_id) AS INT) AS r FROM snap) WHERE r <= 50", "fx_runup", "fx_coast_vertex")
def topk_nearest(runup, coast):
    w = Window.partitionBy("part_id").orderBy(F.round("distance_m", 3), "runup_id")
    return TS.events_snapped(runup, coast).withColumn("r", F.row_number().over(w)).where("r <= 50").select("part_id", "runup_id", "r")


ENVELOPE = """d AS (SELECT x_m / 1000.0 AS d, runup_ht AS h, CAST(floor(x_m / 1000.0 / 250.0) AS INT) AS bin FROM fx_runup WHERE runup_ht > 0),
e AS (SELECT bin, count(*) AS n, (bin + 0.5) * 250.0 AS d, quantile_cont(h, 0.9) AS q FROM d GROUP BY 1 HAVING count(*) >= 10)"""


@query(f"WITH {ENVELOPE} SELECT bin, n, round(d, 3) AS d, round(q, 6) AS q FROM e", "fx_runup")
def runup_envelope(runup):
    got = TS.runup_envelope(runup.select((c("x_m") / 1000.0).alias("d_km"), c("runup_ht").alias("h")))
    return got.select("bin", "n", F.round("d", 3).alias("d"), r6(c("q")).alias("q"))


@query(f"WITH {ENVELOPE}, f AS (SELECT count(*) AS bins, regr_slope(ln(q + 1e-6), d) AS slope FROM e) SELECT bins, round(slope, 9) AS slope, round(CASE WHEN bins >= 2 AND slope < 0 THEN greatest(500.0, least(5000.0, -1.0 / slope)) ELSE 1500.0 END, 3) AS r0_km FROM f", "fx_runup")
def decay_fit(runup):
    env = TS.runup_envelope(runup.select((c("x_m") / 1000.0).alias("d_km"), c("runup_ht").alias("h")))
    return TS.decay_fit(env).select("bins", F.round("slope", 9).alias("slope"), F.round("r0_km", 3).alias("r0_km"))


# ------------------------------------------------------------------------------------------------------------------- storms


@query(f"WITH {STEPS} SELECT sid, count(*) AS n, round(avg(wind), 6) AS wind FROM st GROUP BY 1", "fx_track")
def blend_wind(track):
    return ST.steps(track).groupBy("sid").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("wind")).alias("wind"))


@query("""SELECT sid, k1, k2, k3, k4, CAST(iso_time AS VARCHAR) AS at, round(degrees(atan2(sin(radians(lon)) + 0.9 * sin(radians(lon + 1)), cos(radians(lon)) + 0.9 * cos(radians(lon + 1)))), 6) AS lon,
  round((lat + 0.9 * (lat + 0.5)) / 1.9, 6) AS lat FROM fx_track""", "fx_track")  # fmt: skip
def blend_position(track):
    s = F.sin(F.radians("lon")) + 0.9 * F.sin(F.radians(c("lon") + 1))
    k = F.cos(F.radians("lon")) + 0.9 * F.cos(F.radians(c("lon") + 1))
    return track.select("sid", "k1", "k2", "k3", "k4", c("iso_time").cast("string").alias("at"), r6(F.degrees(F.atan2(s, k))).alias("lon"), r6((c("lat") + 0.9 * (c("lat") + 0.5)) / 1.9).alias("lat"))


@query(f"WITH {STEPS} SELECT sid, greatest(0, coalesce(max(category), -1)) AS category, greatest(25.0, 20.0 + 12.0 * greatest(0, coalesce(max(category), -1))) AS union_nm, 60.0 + 20.0 * greatest(0, coalesce(max(category), -1)) AS min_area_km2 FROM sc GROUP BY 1", "fx_track")
def adaptive_params(track):
    return ST.adaptive_params(ST.steps(track)).select("sid", "category", "union_nm", "min_area_km2")


@query(f"WITH {STEPS} SELECT sid, quad, count(r) AS n, round(sum(r), 6) AS total FROM (SELECT sid, 'NE' AS quad, CASE WHEN usa_r34_ne > 0 THEN usa_r34_ne END AS r FROM st UNION ALL SELECT sid, 'SE', CASE WHEN usa_r34_se > 0 THEN usa_r34_se END FROM st) GROUP BY 1, 2", "fx_track")
def quadrant_radius(track):
    return ST.quadrant_radii(ST.steps(track)).groupBy("sid", "quad").agg(F.count("radius").alias("n"), r6(F.sum("radius")).alias("total"))


@query(f"WITH {STEPS} SELECT sid, round(avg(CASE WHEN usa_r34_ne > 0 OR usa_r34_se > 0 THEN 1.0 ELSE 0.0 END), 6) AS coverage, CASE WHEN avg(CASE WHEN usa_r34_ne > 0 OR usa_r34_se > 0 THEN 1.0 ELSE 0.0 END) >= 0.15 THEN 'weighted' ELSE 'first' END AS mode FROM st GROUP BY 1", "fx_track")
def coverage_mode(track):
    return ST.coverage_mode(ST.steps(track)).select("sid", r6(c("coverage")).alias("coverage"), "mode")


@query(f"WITH {STEPS} SELECT sid, coalesce(usa_r34_ne, usa_r34_se) AS radius FROM st WHERE usa_r34_ne > 0 OR usa_r34_se > 0 QUALIFY row_number() OVER (PARTITION BY sid ORDER BY iso_time DESC, k1 DESC, k2 DESC, k3 DESC, k4 DESC) = 1", "fx_track")
def preferred_radii(track):
    rows = ST.steps(track).withColumn("radius", S.first_positive(c("usa_r34_ne"), c("usa_r34_se"))).where("radius IS NOT NULL")
    return rows.groupBy("sid").agg(F.max_by("radius", F.struct(*ST.STEP_ORDER)).alias("radius"))


@query(f"""WITH {STEPS}, l AS (SELECT *, lag(usa_r34_ne) OVER w AS p, lead(usa_r34_ne) OVER w AS n FROM st WINDOW w AS (PARTITION BY sid ORDER BY iso_time, k1, k2, k3, k4))
SELECT sid, k1, k2, k3, k4, CAST(iso_time AS VARCHAR) AS at, round((coalesce(p * 0.25, 0) + coalesce(usa_r34_ne * 0.5, 0) + coalesce(n * 0.25, 0)) / nullif(CASE WHEN p IS NULL THEN 0 ELSE 0.25 END + CASE WHEN usa_r34_ne IS NULL THEN 0 ELSE 0.5 END + CASE WHEN n IS NULL THEN 0 ELSE 0.25 END, 0), 6) AS ne FROM l""", "fx_track")  # fmt: skip
def smooth_3pt(track):
    return ST.smoothed(ST.steps(track)).select("sid", "k1", "k2", "k3", "k4", c("iso_time").cast("string").alias("at"), r6(c("ne")).alias("ne"))


@query(f"""WITH {STEPS}, l AS (SELECT *, lon - lag(lon) OVER (PARTITION BY sid ORDER BY iso_time, k1, k2, k3, k4) AS d FROM st)
SELECT sid, k1, k2, k3, k4, CAST(iso_time AS VARCHAR) AS at, round(lon + sum(CASE WHEN d > 180 THEN -360.0 WHEN d < -180 THEN 360.0 ELSE 0.0 END) OVER (PARTITION BY sid ORDER BY iso_time, k1, k2, k3, k4 ROWS UNBOUNDED PRECEDING), 6) AS lon FROM l""", "fx_track")  # fmt: skip
def unwrap_lon(track):
    return sequence.unwrapped(ST.steps(track), ["sid"], ST.STEP_ORDER).select("sid", "k1", "k2", "k3", "k4", c("iso_time").cast("string").alias("at"), r6(c("lon_unwrapped")).alias("lon"))


@query("""WITH x AS (SELECT DISTINCT sid, (lon % 360 + 360) % 360 AS x FROM fx_track), n AS (SELECT *, coalesce(lead(x) OVER (PARTITION BY sid ORDER BY x), min(x) OVER (PARTITION BY sid) + 360.0) AS nx FROM x),
b AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY sid ORDER BY nx - x DESC, x) = 1) SELECT sid, round(nx - x, 6) AS gap FROM b""", "fx_track")  # fmt: skip
def track_seam(track):
    return sequence.track_seam(track).select("sid", r6(c("gap")).alias("gap"))


@query(f"""WITH {STEPS}, l AS (SELECT sid, row_number() OVER w AS leg, lat, lon, lead(lat) OVER w AS lat2, lead(lon) OVER w AS lon2 FROM st WINDOW w AS (PARTITION BY sid ORDER BY iso_time, k1, k2, k3, k4)),
n AS (SELECT *, greatest(1, CAST(ceil(greatest(abs(lat2 - lat), abs(lon2 - lon)) / 0.5) AS BIGINT)) AS n FROM l WHERE lat2 IS NOT NULL)
SELECT sid, count(*) AS points, round(sum(lat + i * 1.0 / n * (lat2 - lat)), 4) AS lat FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM n) GROUP BY 1""", "fx_track")  # fmt: skip
def densify_track(track):
    got = sequence.densified(ST.steps(track), "sid", ST.STEP_ORDER, 0.5, "lon", "lat", F.greatest(F.abs(c("_y2") - c("lat")), F.abs(c("_x2") - c("lon"))))
    return got.groupBy("sid").agg(F.count(F.lit(1)).alias("points"), F.round(F.sum("y"), 4).alias("lat"))


@query(f"""WITH {STEPS} SELECT sid, CAST(iso_time AS VARCHAR) AS iso_time, k1, k2, k3, k4, CASE WHEN usa_r34_ne > 0 OR usa_r34_se > 0 THEN 'quadrant_smoothed' WHEN usa_wind IS NOT NULL THEN 'rmw_scaled' ELSE 'climo_r34' END AS method,
  CASE WHEN usa_r34_ne > 0 OR usa_r34_se > 0 THEN 0.92 WHEN usa_wind IS NOT NULL THEN 0.65 ELSE 0.55 END::DOUBLE AS conf FROM sc WHERE usa_r34_ne > 0 OR usa_r34_se > 0 OR usa_wind IS NOT NULL OR category >= 0""", "fx_track")  # fmt: skip
def method_hysteresis(track):
    """At the default margin no two of these methods are close enough for the last one to stay; tests fold with a wider one."""
    return ST.chosen_methods(ST.steps(track)).withColumn("iso_time", c("iso_time").cast("string"))


@query("""WITH q AS (SELECT DISTINCT sid, CAST(sid % 90 + 10 AS DOUBLE) AS ne, CAST(sid % 70 + 20 AS DOUBLE) AS se, CAST(sid % 50 + 30 AS DOUBLE) AS sw, CAST(sid % 30 + 40 AS DOUBLE) AS nw FROM fx_track),
r AS (SELECT sid, i, CASE WHEN i < 90 THEN (1 - t) * ne + t * se WHEN i < 180 THEN (1 - t) * se + t * sw WHEN i < 270 THEN (1 - t) * sw + t * nw ELSE (1 - t) * nw + t * ne END AS r FROM (SELECT *, (i % 90) / 89.0 AS t FROM (SELECT *, unnest(range(0, 360)) AS i FROM q)))
SELECT a.sid, a.i, round((b.r + 2 * a.r + d.r) / 4, 6) AS r FROM r a JOIN r b ON a.sid = b.sid AND b.i = (a.i + 359) % 360 JOIN r d ON a.sid = d.sid AND d.i = (a.i + 1) % 360""", "fx_track")  # fmt: skip
def radius_curve(track):
    s = c("sid")
    q = track.select("sid").distinct().select("sid", *((s % m + k).cast("double").alias(n) for n, m, k in (("ne", 90, 10), ("se", 70, 20), ("sw", 50, 30), ("nw", 30, 40))))
    curve = q.select("sid", F.posexplode(geo.radius_curve(c("ne"), c("se"), c("sw"), c("nw"))).alias("i", "r"))
    return curve.select("sid", c("i").cast("long").alias("i"), r6(c("r")).alias("r"))


# ----------------------------------------------------------------------------------------------------- quakes, floods, covers


@query(f"""WITH RECURSIVE h AS (SELECT event_id, mw, greatest(14.0, depth_km) AS h, band, target FROM fx_quake, (VALUES ('VI', 6.0), ('VII', 7.0)) v(band, target)),
b AS (SELECT event_id, band, target, mw, h, 0 AS i, 0.0::DOUBLE AS lo, 1500.0::DOUBLE AS hi FROM h
 UNION ALL SELECT event_id, band, target, mw, h, i + 1, CASE WHEN ok THEN (lo + hi) * 0.5 ELSE lo END, CASE WHEN ok THEN hi ELSE (lo + hi) * 0.5 END
 FROM (SELECT *, {INTENSITY} >= target AS ok FROM (SELECT *, sqrt(pow((lo + hi) * 0.5, 2) + h * h) AS R FROM b WHERE i < 60))),
z AS (SELECT event_id, band, {INTENSITY} AS top FROM (SELECT *, h AS R FROM h)),
m AS (SELECT event_id, strike, {MECH} AS mech FROM fx_quake),
r AS (SELECT b.event_id, b.band, b.mw, CASE WHEN top < target THEN 0.0 ELSE lo END AS r FROM b JOIN z ON b.event_id = z.event_id AND b.band = z.band WHERE i = 60)
SELECT r.event_id, band, mech AS mechanism, round(r, 4) AS b_km, round((r + 0.5 * sqrt(pow(10, -3.49 + 0.91 * mw) * CASE WHEN mech = 'SS' THEN 3.0 ELSE 2.0 END)) * CASE WHEN mech = 'SS' THEN 1.15 ELSE 1.0 END, 4) AS a_km, coalesce(strike, 0.0) AS strike_deg FROM r JOIN m USING (event_id)""", "fx_quake")  # fmt: skip
def quake_bands(quake):
    return QK.quake_bands(quake).select("event_id", "band", "mechanism", F.round("b_km", 4).alias("b_km"), F.round("a_km", 4).alias("a_km"), "strike_deg")


@query(None, "fx_quake")
def quake_rings(quake):
    return QK.quake_footprints(quake)


def _authalic_sql(lat):
    s = f"sin(radians({lat}))"
    return f"{1 - _E * _E!r} * ({s} / (1 - {_E * _E!r} * {s} * {s}) - ln((1 - {_E!r} * {s}) / (1 + {_E!r} * {s})) / {2 * _E!r}) * {geo.WGS84_A / (2 * _K0)!r}"


@query(f"SELECT country_id, round((radians(maxx) - radians(minx)) * {geo.WGS84_A * _K0!r} * ({_authalic_sql('maxy')} - {_authalic_sql('miny')}) / 1e6, 0) AS area_km2 FROM fx_country", "fx_country")
def ring_area(country):
    ring = F.array(*(F.struct(c(x).alias("x"), c(y).alias("y")) for x, y in (("minx", "miny"), ("maxx", "miny"), ("maxx", "maxy"), ("minx", "maxy"))))
    return country.select("country_id", F.round(geo.ring_area_km2(ring), 0).alias("area_km2"))


@query("""SELECT source, start_year, count(*) AS n, CAST(min(start_date) AS VARCHAR) AS start_date, CAST(max(coalesce(end_date, start_date)) AS VARCHAR) AS end_date, arg_min(row_id, CAST(p AS BIGINT) * 1000000000 + row_id) AS primary_id,
  round(arg_min(area_km2, row_id) FILTER (area_km2 IS NOT NULL), 6) AS area_km2 FROM (SELECT *, CAST(year(start_date) AS INT) AS start_year, CASE source WHEN 'USFD' THEN 1 WHEN 'HANZE' THEN 2 ELSE 3 END AS p FROM fx_flood) GROUP BY 1, 2""", "fx_flood")  # fmt: skip
def first_nonnull(flood):
    rows = flood.withColumn("start_year", F.year("start_date"))
    return rows.groupBy("source", "start_year").agg(
        F.count(F.lit(1)).alias("n"), F.min("start_date").cast("string").alias("start_date"), F.max(F.coalesce("end_date", "start_date")).cast("string").alias("end_date"),
        F.min("row_id").alias("primary_id"), r6(S.first_nonnull("area_km2", "row_id")).alias("area_km2"),
    )


@query("""SELECT cluster, CAST(min(start_date) AS VARCHAR) AS start_date, CAST(max(coalesce(end_date, start_date)) AS VARCHAR) AS end_date, arg_min(row_id, CAST(p AS BIGINT) * 1000000000 + row_id) AS primary_id, arg_min(source, CAST(p AS BIGINT) * 1000000000 + row_id) AS primary_source,
  string_agg(DISTINCT source, '|' ORDER BY source) AS sources, count(*) AS n, round(arg_min(area_km2, CAST(p AS BIGINT) * 1000000000 + row_id) FILTER (area_km2 IS NOT NULL), 6) AS area_km2, round(avg(lat), 6) AS lat
  FROM (SELECT *, row_id - row_id % 40 AS cluster, CASE source WHEN 'USFD' THEN 1 WHEN 'HANZE' THEN 2 ELSE 3 END AS p FROM fx_flood) GROUP BY 1""", "fx_flood")  # fmt: skip
def flood_merge(flood):
    got = FL.merged(flood.withColumn("cluster", c("row_id") - c("row_id") % 40))
    return got.select("cluster", c("start_date").cast("string").alias("start_date"), c("end_date").cast("string").alias("end_date"), "primary_id", "primary_source", "sources", "n", r6(c("area_km2")).alias("area_km2"), r6(c("lat")).alias("lat"))


@query(f"""WITH {NL}, pr AS (SELECT p.row_id, q.rec_id, {HAV} AS km FROM fx_flood p JOIN nl q ON p.start_date <= q.start_date AND coalesce(p.end_date, p.start_date) >= q.start_date WHERE q.hazard = 'flood')
SELECT row_id, coalesce(arg_min(rec_id, struct_pack(k := km, r := rec_id)) FILTER (km IS NOT NULL), min(rec_id)) AS rec_id, round(min(km), 6) AS km FROM pr GROUP BY 1""", "fx_flood", "fx_loss")  # fmt: skip
def flood_enrich_best(flood, loss):
    got = FL.enriched(flood, _losses(loss).where("hazard = 'flood'"))
    return got.select("row_id", "rec_id", r6(c("km")).alias("km"))


FLOOD_PAIRS = f"""pr AS (SELECT p.row_id AS u, q.row_id AS v FROM fx_flood p JOIN fx_flood q ON p.row_id < q.row_id AND p.start_date <= coalesce(q.end_date, q.start_date) + 14 AND coalesce(p.end_date, p.start_date) >= q.start_date - 14 AND {HAV} <= 200.0)"""


@query(f"""WITH RECURSIVE {FLOOD_PAIRS}, e AS (SELECT u, v FROM pr UNION SELECT v, u FROM pr), t AS (SELECT row_id AS a, row_id AS b FROM fx_flood UNION SELECT t.a, e.v FROM t JOIN e ON t.b = e.u)
SELECT a AS row_id, min(b) AS component FROM t GROUP BY 1""", "fx_flood")  # fmt: skip
def components(flood):
    return FL.pair_clusters(flood)


@query(None, "fx_flood")
def flood_clusters(flood):
    return FL.clusters(flood)


@query("SELECT source, kind, count(*) AS n FROM (SELECT source, 'flood' AS kind FROM fx_flood UNION ALL SELECT NULL, 'quake' FROM fx_quake) GROUP BY 1, 2", "fx_flood", "fx_quake")
def union_sources(flood, quake):
    rows = flood.select("row_id", "source", F.lit("flood").alias("kind")).unionByName(quake.select("event_id", F.lit("quake").alias("kind")), allowMissingColumns=True)
    return rows.groupBy("source", "kind").agg(F.count(F.lit(1)).alias("n"))


DISC = "dc AS (SELECT DISTINCT event_id, cx, cy FROM (SELECT event_id, x_m, y_m, r, cx, unnest(range(CAST(floor((y_m - r) / 2000) AS BIGINT), CAST(ceil((y_m + r) / 2000) AS BIGINT) + 1)) AS cy FROM (SELECT tsunami_event_id AS event_id, x_m, y_m, 5000.0 + runup_ht * 1000 AS r, unnest(range(CAST(floor((x_m - 5000 - runup_ht * 1000) / 2000) AS BIGINT), CAST(ceil((x_m + 5000 + runup_ht * 1000) / 2000) AS BIGINT) + 1)) AS cx FROM fx_runup)) WHERE pow((cx + 0.5) * 2000 - x_m, 2) + pow((cy + 0.5) * 2000 - y_m, 2) <= r * r)"


def _discs(runup):
    return cover.disc_cover(runup.select(c("tsunami_event_id").alias("event_id"), c("x_m").alias("x"), c("y_m").alias("y"), (5000.0 + c("runup_ht") * 1000).alias("r_m")), 2000.0, ["event_id"])


@query(f"WITH {DISC} SELECT event_id, CAST(cx AS BIGINT) AS cx, CAST(cy AS BIGINT) AS cy FROM dc", "fx_runup")
def disc_cover(runup):
    return cover.union(_discs(runup), ["event_id"])


@query(f"WITH {DISC} SELECT event_id, count(*) AS cells, round(count(*) * 4.0, 3) AS area_km2 FROM dc GROUP BY 1", "fx_runup")
def cover_union(runup):
    return cover.area_km2(_discs(runup), ["event_id"], 2000.0).select("event_id", "cells", F.round("area_km2", 3).alias("area_km2"))


@query(f"WITH {DISC} SELECT event_id, CAST(cx AS BIGINT) AS cx, CAST(cy AS BIGINT) AS cy FROM dc WHERE EXISTS (SELECT 1 FROM fx_coast_vertex WHERE floor(x_m / 2000) = cx AND floor(y_m / 2000) = cy)", "fx_runup", "fx_coast_vertex")
def cover_clip(runup, coast):
    mask = coast.select(F.floor(c("x_m") / 2000).alias("cx"), F.floor(c("y_m") / 2000).alias("cy"))
    return cover.clip(cover.union(_discs(runup), ["event_id"]), mask).select("event_id", "cx", "cy")


@query("SELECT event_id, 'earthquake' AS event_type, CAST(eq_time AS VARCHAR) AS start_time, CAST(eq_time AS VARCHAR) AS end_time, CAST(NULL AS VARCHAR) AS band FROM fx_quake", "fx_quake")
def canonical_quakes(quake):
    t = c("eq_time").cast("string")
    return quake.select("event_id", F.lit("earthquake").alias("event_type"), t.alias("start_time"), t.alias("end_time"), F.lit(None).cast("string").alias("band"))


@query(f"WITH {STEPS} SELECT sid AS event_id, 'storm' AS event_type, CAST(min(iso_time) AS VARCHAR) AS start_time, CAST(max(iso_time) AS VARCHAR) AS end_time FROM st GROUP BY 1", "fx_track")
def canonical_storms(track):
    return ST.steps(track).groupBy(c("sid").alias("event_id")).agg(F.lit("storm").alias("event_type"), F.min("iso_time").cast("string").alias("start_time"), F.max("iso_time").cast("string").alias("end_time"))


@query("SELECT row_id AS event_id, 'flood' AS event_type, CAST(start_date AS VARCHAR) AS start_time, CAST(coalesce(end_date, start_date) AS VARCHAR) AS end_time, round(area_km2, 6) AS area_km2 FROM fx_flood", "fx_flood")
def canonical_floods(flood):
    return flood.select(c("row_id").alias("event_id"), F.lit("flood").alias("event_type"), c("start_date").cast("string").alias("start_time"), F.coalesce("end_date", "start_date").cast("string").alias("end_time"), r6(c("area_km2")).alias("area_km2"))


@query(f"WITH {DISC} SELECT event_id, 'tsunami' AS event_type, CAST(NULL AS VARCHAR) AS start_time, CAST(NULL AS VARCHAR) AS end_time, CAST(NULL AS VARCHAR) AS band, 'runup_discs' AS geom_method, CAST(NULL AS DOUBLE) AS geom_confidence, count(*) * 4.0::DOUBLE AS area_km2 FROM (SELECT DISTINCT event_id, cx, cy FROM dc) GROUP BY 1", "fx_runup")
def canonical_tsunamis(runup):
    none = F.lit(None).cast("string")
    area = cover.area_km2(_discs(runup), ["event_id"], 2000.0)
    return area.select("event_id", F.lit("tsunami").alias("event_type"), none.alias("start_time"), none.alias("end_time"), none.alias("band"), F.lit("runup_discs").alias("geom_method"), F.lit(None).cast("double").alias("geom_confidence"), "area_km2")


@query("""WITH r AS (SELECT avg(CASE WHEN event_id % 3 = 0 THEN 0.0 ELSE 1.0 END) AS a, avg(CASE WHEN event_id % 5 = 0 THEN 1.0 ELSE 0.0 END) AS b FROM fx_quake)
SELECT 'size' AS field, 0.0::DOUBLE AS rate, false AS chosen FROM r UNION ALL SELECT 'seen', round(a, 6), a >= 0.5 AND a >= b FROM r UNION ALL SELECT 'revised', round(b, 6), b >= 0.5 AND b > a FROM r""", "fx_quake")  # fmt: skip
def datetime_profile(quake):
    day = F.date_format("eq_time", "yyyy-MM-dd")
    rows = quake.select(F.concat(F.lit("M"), c("mw").cast("string")).alias("size"), F.when(c("event_id") % 3 == 0, "unknown").otherwise(day).alias("seen"), F.when(c("event_id") % 5 == 0, day).alias("revised"))
    return T.datetime_profile(rows, ["size", "seen", "revised"]).select("field", r6(c("rate")).alias("rate"), "chosen")


@query(f"""WITH {SEG}, o AS (SELECT tsunami_event_id AS event_id, avg(x_m) + 0.5 AS ox, avg(y_m) + 0.5 AS oy FROM fx_runup GROUP BY 1), k AS (SELECT unnest(range(0, 360)) AS k),
r AS (SELECT event_id, k, part_id, s0, len, x1 - ox AS ax, y1 - oy AS ay, x2 - x1 AS dx, y2 - y1 AS dy, cos(radians(k * 1.0)) AS cb, sin(radians(k * 1.0)) AS sb FROM o, seg, k),
h AS (SELECT *, (ax * dy - ay * dx) / (cb * dy - sb * dx) AS t, (ax * sb - ay * cb) / (cb * dy - sb * dx) AS u FROM r WHERE cb * dy - sb * dx <> 0)
SELECT event_id, k * 1.0::DOUBLE AS bearing_deg, round(t, 2) AS range_m, part_id, round(s0 + u * len, 2) AS station_m FROM h WHERE u BETWEEN -1e-9 AND 1 + 1e-9 AND t BETWEEN 0 AND 3000000.0
QUALIFY row_number() OVER (PARTITION BY event_id, k ORDER BY t, part_id, s0 + u * len) = 1""", "fx_runup", "fx_coast_vertex")  # fmt: skip
def bearing_first_hit(runup, coast):
    origins = runup.groupBy(c("tsunami_event_id").alias("event_id")).agg((F.avg("x_m") + 0.5).alias("ox"), (F.avg("y_m") + 0.5).alias("oy"))
    hits = joins.first_hits(origins, joins.segments(coast))
    return hits.select("event_id", "bearing_deg", F.round("range_m", 2).alias("range_m"), "part_id", F.round("station_m", 2).alias("station_m"))


@query(f"""WITH {RSEG}, e AS (SELECT event_id, part_id, 'l' AS side, s0 AS s FROM rseg UNION ALL SELECT event_id, part_id, 'r', s1 FROM rseg),
pos AS (SELECT e.*, x1 + (s - s0) / len * (x2 - x1) AS x, y1 + (s - s0) / len * (y2 - y1) AS y FROM e JOIN seg ON seg.part_id = e.part_id AND s0 <= s AND s <= s0 + len + 1e-6
  QUALIFY row_number() OVER (PARTITION BY e.event_id, e.part_id, side, s ORDER BY s0 DESC) = 1)
SELECT a.event_id, a.part_id AS right_part, round(a.s, 3) AS right_s, b.part_id AS left_part, round(b.s, 3) AS left_s, round(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)), 3) AS distance_m
FROM pos a JOIN pos b ON a.event_id = b.event_id AND a.side = 'r' AND b.side = 'l' AND a.part_id <> b.part_id WHERE sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= 250000.0""", "fx_runup", "fx_coast_vertex")  # fmt: skip
def cross_part_pairs(runup, coast):
    pairs = infill.cross_part_pairs(_runup_segments(runup, coast), joins.segments(coast), 250_000.0)
    return pairs.select("event_id", "right_part", F.round("right_s", 3).alias("right_s"), "left_part", F.round("left_s", 3).alias("left_s"), F.round("distance_m", 3).alias("distance_m"))


NODES = f"""{SEG}, ends AS (SELECT part_id, 0 AS "end", part_id * 2 AS u, arg_min(x1, seq) AS x, arg_min(y1, seq) AS y FROM seg GROUP BY part_id UNION ALL SELECT part_id, 1, part_id * 2 + 1, arg_max(x2, seq), arg_max(y2, seq) FROM seg GROUP BY part_id),
el AS (SELECT a.u, b.u AS v FROM ends a JOIN ends b ON sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= 200000.0), reach AS (SELECT u AS a, u AS b FROM ends UNION SELECT reach.a, el.v FROM reach JOIN el ON el.u = reach.b),
nodes AS (SELECT part_id, "end", node FROM ends JOIN (SELECT a, min(b) AS node FROM reach GROUP BY 1) ON a = u)"""


@query(f'WITH RECURSIVE {NODES} SELECT part_id, "end", CAST(node AS BIGINT) AS node FROM nodes', "fx_coast_vertex")
def coast_nodes(coast):
    return network.stitched_nodes(joins.segments(coast), 200_000.0)


@query(None, "fx_track")
def track_hull(track):
    return ST.track_hull(ST.steps(track).select("sid", c("lon").alias("x"), c("lat").alias("y")))


from perilframe.plans import infill_queries, layer_queries, lookup_queries, ring_queries  # noqa: E402,F401  their queries register themselves
