"""Registered queries of polygons and local projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from perilframe.functions import projections as P
from perilframe.operators import rings
from perilframe.plans.registry import c, query, r6


def _ring(*corners):
    return F.array(*(F.struct(x.alias("x"), y.alias("y")) for x, y in corners))


def _stars(quake):
    """A concave ring of eight corners about each quake, and a diamond in its middle as a hole."""
    lon, lat, far = c("lon"), c("lat"), (c("event_id") % 7 + 3).cast("double")
    star = _ring((lon + far, lat + 0.0), (lon + 1.0, lat + 1.0), (lon + 0.0, lat + far), (lon - 1.0, lat + 1.0), (lon - far, lat + 0.0), (lon - 1.0, lat - 1.0), (lon + 0.0, lat - far), (lon + 1.0, lat - 1.0))
    hole = _ring((lon + 0.7, lat + 0.0), (lon + 0.0, lat + 0.7), (lon - 0.7, lat + 0.0), (lon + 0.0, lat - 0.7))
    # dealt out as quakes, so that their many crossings and cells, which keep the key, need no shuffle
    return quake.repartition("event_id").select("event_id", F.explode(F.array(star, hole)).alias("ring"))


@query("""WITH f AS (SELECT event_id, lon, lat, CAST(event_id % 7 + 3 AS DOUBLE) AS r FROM fx_quake),
sd AS (SELECT event_id, unnest([{a: lon + r, b: lat, c: lon + 1.0, d: lat + 1.0}, {a: lon + 1.0, b: lat + 1.0, c: lon, d: lat + r}, {a: lon, b: lat + r, c: lon - 1.0, d: lat + 1.0}, {a: lon - 1.0, b: lat + 1.0, c: lon - r, d: lat}, {a: lon - r, b: lat, c: lon - 1.0, d: lat - 1.0},
  {a: lon - 1.0, b: lat - 1.0, c: lon, d: lat - r}, {a: lon, b: lat - r, c: lon + 1.0, d: lat - 1.0}, {a: lon + 1.0, b: lat - 1.0, c: lon + r, d: lat}, {a: lon + 0.7, b: lat, c: lon, d: lat + 0.7}, {a: lon, b: lat + 0.7, c: lon - 0.7, d: lat}, {a: lon - 0.7, b: lat, c: lon, d: lat - 0.7}, {a: lon, b: lat - 0.7, c: lon + 0.7, d: lat}]) AS s FROM f),
ro AS (SELECT event_id, lon, r, unnest(range(CAST(floor((lat - r) / 0.5) AS BIGINT), CAST(ceil((lat + r) / 0.5) AS BIGINT) + 1)) AS cy FROM f),
ce AS (SELECT event_id, cy, unnest(range(CAST(floor((lon - r) / 0.5) AS BIGINT), CAST(ceil((lon + r) / 0.5) AS BIGINT) + 1)) AS cx FROM ro),
cr AS (SELECT sd.event_id, cy, s.a + ((cy + 0.5) * 0.5 - s.b) / (s.d - s.b) * (s.c - s.a) AS x FROM sd JOIN ro ON ro.event_id = sd.event_id WHERE (cy + 0.5) * 0.5 >= least(s.b, s.d) AND (cy + 0.5) * 0.5 < greatest(s.b, s.d)),
hi AS (SELECT ce.event_id, cx, ce.cy FROM ce JOIN cr ON cr.event_id = ce.event_id AND cr.cy = ce.cy AND cr.x <= (cx + 0.5) * 0.5 GROUP BY ALL HAVING count(*) % 2 = 1)
SELECT event_id, count(*) AS cells, CAST(sum(cx) AS BIGINT) AS sx, CAST(sum(cy) AS BIGINT) AS sy FROM hi GROUP BY 1""", "fx_quake")  # fmt: skip
def ring_cover(quake):
    got = rings.ring_cover(_stars(quake), 0.5, ["event_id"])
    return got.groupBy("event_id").agg(F.count(F.lit(1)).alias("cells"), F.sum("cx").alias("sx"), F.sum("cy").alias("sy"))


def _boxes(country, shift=0.0):
    x0, x1, y0, y1 = (c(n) for n in ("minx", "maxx", "miny", "maxy"))
    turn = lambda x: F.pmod(x + shift + 180.0, F.lit(360.0)) - 180.0 if shift else x
    return country.withColumn("ring", _ring((turn(x0), y0), (turn(x1), y0), (turn(x1), y1), (turn(x0), y1), (turn(x0), y0)))


@query("SELECT row_id, coalesce(iso3, 'UNK') AS iso3 FROM fx_flood LEFT JOIN fx_country ON lon >= minx AND lon < maxx AND lat >= miny AND lat < maxy AND country_id % 3 <> 0", "fx_flood", "fx_country")
def tag_country_rings(flood, country):
    """Floods with the country whose polygon holds them; a third of the polygons are missing, so some floods have none."""
    boxes = _boxes(country.where(c("country_id") % 3 != 0)).select("iso3", "ring")
    return rings.tagged(flood.select("row_id", "lon", "lat"), boxes, 5.0, "iso3", "lon", "lat").select("row_id", "iso3")


@query("SELECT country_id, CASE WHEN minx + 100 < 180 AND maxx + 100 > 180 THEN 2 ELSE 1 END::BIGINT AS pieces, 2592.0::DOUBLE AS area FROM fx_country", "fx_country")
def rings_split(country):
    """The countries' boxes moved 100 degrees east: those that come to lie over the antimeridian are cut in two of the same area in all."""
    pieces = rings.split_at_antimeridian(_boxes(country, 100.0).select("country_id", "ring"))
    sides = rings.edges(pieces, ["country_id", "world"])
    area = sides.groupBy("country_id", "world").agg((F.abs(F.sum(c("x1") * c("y2") - c("x2") * c("y1"))) / 2.0).alias("a"))
    return area.groupBy("country_id").agg(F.count(F.lit(1)).alias("pieces"), r6(F.sum("a")).alias("area"))


_Q = lambda s: f"({1 - P.E2!r} * ({s} / (1 - {P.E2!r} * {s} * {s}) - ln((1 - {P.E!r} * {s}) / (1 + {P.E!r} * {s})) / {2 * P.E!r}))"


@query(f"""WITH p AS (SELECT event_id, lon, lat, asin({_Q('sin(radians(lat))')} / {P.QP!r}) AS b, {_Q('sin(radians(lat / 2))')} / {P.QP!r} AS s1, radians(lat / 2) AS f, radians(8.0) AS t FROM fx_quake),
k AS (SELECT *, sqrt(1 - s1 * s1) AS c1, {P.WGS84_A!r} * cos(f) / sqrt(1 - {P.E2!r} * sin(f) * sin(f)) / ({P.RQ!r} * sqrt(1 - s1 * s1)) AS d FROM p),
m AS (SELECT *, {P.RQ!r} * sqrt(2 / (1 + s1 * sin(b) + c1 * cos(b) * cos(t))) AS w FROM k)
SELECT event_id, round(w * d * cos(b) * sin(t), 1) AS x_m, round(w / d * (c1 * sin(b) - s1 * cos(b) * cos(t)), 1) AS y_m, round((lon + 540.0) % 360 - 180, 6) AS lon, round(lat, 6) AS lat FROM m""", "fx_quake")  # fmt: skip
def local_projection(quake):
    """Each quake in the equal-area projection about a centre 8 degrees west of it at half its latitude, and back."""
    lon0, lat0 = c("lon") - 8.0, c("lat") / 2
    rows = quake.withColumn("p", P.laea(c("lon"), c("lat"), lon0, lat0)).withColumn("q", P.laea_inverse(c("p.x"), c("p.y"), lon0, lat0))
    return rows.select("event_id", F.round("p.x", 1).alias("x_m"), F.round("p.y", 1).alias("y_m"), r6(c("q.x")).alias("lon"), r6(c("q.y")).alias("lat"))
