"""Spherical and planar geometry as column expressions; a ring is an array of structs (x, y)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

WGS84_A, WGS84_E = 6378137.0, 0.081819190842621
KM_PER_DEGREE = 111.19


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = 6371.0) -> Column:
    """Great-circle distance; null if a coordinate is (``greatest`` would pass over it)."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.when(a.isNotNull(), 2 * radius_km * F.asin(F.sqrt(F.least(F.lit(1.0), F.greatest(F.lit(0.0), a)))))


def mercator_x(lon) -> Column:
    return F.radians(lon) * WGS84_A


def mercator_y(lat) -> Column:
    return F.log(F.tan(math.pi / 4 + F.radians(lat) / 2)) * WGS84_A


def _authalic(s):
    e = WGS84_E
    return (1 - e * e) * (s / (1 - e * e * s * s) - F.log((1 - e * s) / (1 + e * s)) / (2 * e))


def equal_area_x(lon) -> Column:
    """Cylindrical equal-area metres, true at 30 degrees."""
    s = math.sin(math.pi / 6)
    return F.radians(lon) * (WGS84_A * math.cos(math.pi / 6) / math.sqrt(1 - WGS84_E**2 * s * s))


def equal_area_y(lat) -> Column:
    s = math.sin(math.pi / 6)
    k = math.cos(math.pi / 6) / math.sqrt(1 - WGS84_E**2 * s * s)
    return _authalic(F.sin(F.radians(lat))) * (WGS84_A / (2 * k))


def cell_band(lat, d: float) -> Column:
    return F.floor((lat + 90.0) / d).cast("int")


def cell_columns(band, d: float) -> Column:
    """How many cells a latitude band has."""
    top = F.least(F.lit(90.0), F.greatest(F.abs(band * d - 90.0), F.abs((band + 1) * d - 90.0)))
    c = F.cos(F.radians(top))
    return F.when(c < 0.05, 1).otherwise(F.greatest(F.lit(1), F.floor(360.0 * c / d).cast("int")))


def own_cell(lat, lon, radius_km: float) -> Column:
    """The (band, column) cell of a point, for joins within ``radius_km``."""
    d = radius_km / KM_PER_DEGREE
    band = cell_band(lat, d)
    n = cell_columns(band, d)
    return F.struct(band.alias("band"), F.pmod(F.floor((lon + 180.0) / 360.0 * n).cast("int"), n).alias("col"))


def reached_cells(lat, lon, radius_km: float) -> Column:
    """All cells that hold a point within ``radius_km`` of this one: about nine, and no repeats."""
    d = radius_km / KM_PER_DEGREE
    ratio = F.sin(F.lit(radius_km / 6371.0)) / F.cos(F.radians(lat))
    wide = F.when((F.abs(lat) + d >= 90) | (ratio >= 1), 180.0).otherwise(F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) * 1.0001)

    def columns(band):
        n = cell_columns(band, d)
        lo, hi = F.floor((lon - wide + 180.0) / 360.0 * n).cast("int"), F.floor((lon + wide + 180.0) / 360.0 * n).cast("int")
        span = F.when(hi - lo + 1 >= n, F.sequence(F.lit(0), n - 1)).otherwise(F.sequence(lo, hi))
        return F.transform(span, lambda c: F.struct(band.alias("band"), F.pmod(c, n).alias("col")))

    own = cell_band(lat, d)
    return F.flatten(F.transform(F.sequence(own - 1, own + 1), columns))


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once for a row: inside a lambda, an outer expression would be worked out anew
    for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def ring_area_km2(ring: Column) -> Column:
    """Area of a ring of lon/lat by the shoelace rule on equal-area metres."""
    flat = F.transform(ring, lambda p: F.struct(equal_area_x(p["x"]).alias("x"), equal_area_y(p["y"]).alias("y")))

    def twice(v):
        turned = F.concat(F.slice(v, 2, F.greatest(F.size(v) - 1, F.lit(0))), F.slice(v, 1, 1))
        return F.aggregate(F.zip_with(v, turned, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"]), F.lit(0.0), lambda acc, x: acc + x)

    return F.when(F.size(ring) >= 3, F.abs(bound(flat, twice)) / 2e6).otherwise(0.0)


def circle_ring(lat, lon, radius_km, points: int = 180) -> Column:
    """A circle on a flat earth of 111 km a degree, closed."""
    def at(i):
        th = i * (2 * math.pi / points)
        return F.struct((lon + radius_km * F.cos(th) / (111.0 * F.cos(F.radians(lat)))).alias("x"), (lat + radius_km * F.sin(th) / 111.0).alias("y"))

    return F.transform(F.sequence(F.lit(0), F.lit(points)), lambda i: at(F.pmod(i, F.lit(points))))


def destination(lat, lon, east_km, north_km, radius_km: float = 6371.0088) -> Column:
    """The point at a plane offset, by the inverse azimuthal equidistant projection on a sphere."""
    p = {"lat": lat, "lon": lon, "sin_lat": F.sin(F.radians(lat)), "cos_lat": F.cos(F.radians(lat))}
    return _destination(p, east_km, north_km, radius_km)


def _destination(p, east_km, north_km, radius_km: float = 6371.0088) -> Column:
    """As ``destination``, with the sine and cosine of the latitude given; what several terms share is worked out once."""
    scaled = F.struct((F.hypot(east_km, north_km) / radius_km).alias("c"), east_km.alias("e"), north_km.alias("n"))

    def place(v):
        turn = F.struct(F.cos(v["c"]).alias("cos"), F.when(v["c"] == 0, 0.0).otherwise(F.sin(v["c"]) / (v["c"] * radius_km)).alias("scale"))

        def at(t):
            y = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), t["cos"] * p["sin_lat"] + v["n"] * t["scale"] * p["cos_lat"])))
            x = F.radians(p["lon"]) + F.atan2(v["e"] * t["scale"], p["cos_lat"] * t["cos"] - v["n"] * t["scale"] * p["sin_lat"])
            return F.struct((F.pmod(F.degrees(x) + 540.0, F.lit(360.0)) - 180.0).alias("x"), F.degrees(y).alias("y"))

        return bound(turn, at)

    return bound(scaled, place)


def ellipse_ring(lat, lon, a_km, b_km, strike_deg, points: int = 72) -> Column:
    """A closed ellipse with its long axis along the strike (clockwise from north)."""
    s = F.radians(F.coalesce(strike_deg, F.lit(0.0)))
    fixed = F.struct(lat.alias("lat"), lon.alias("lon"), a_km.alias("a"), b_km.alias("b"), F.sin(s).alias("sin"), F.cos(s).alias("cos"), F.sin(F.radians(lat)).alias("sin_lat"), F.cos(F.radians(lat)).alias("cos_lat"))

    def ring(p):
        def offset(i):
            th = F.pmod(i, F.lit(points)) * (2 * math.pi / points)
            along, across = p["a"] * F.cos(th), p["b"] * F.sin(th)
            return F.struct((along * p["sin"] + across * p["cos"]).alias("e"), (along * p["cos"] - across * p["sin"]).alias("n"))

        return F.transform(F.transform(F.sequence(F.lit(0), F.lit(points)), offset), lambda o: _destination(p, o["e"], o["n"]))

    return bound(fixed, ring)


def quadrant_radius(i: Column, ne, se, sw, nw, points: int = 360) -> Column:
    """The radius at whole degree ``i``: linear between quadrants, a missing end as the other one, not smoothed."""
    q, out = points // 4, F
    t = (i % q) / float(q - 1)
    for k, (a, b) in enumerate([(ne, se), (se, sw), (sw, nw), (nw, ne)]):
        a, b = F.coalesce(a, b), F.coalesce(b, a)
        out = out.when(F.floor(i / q) == k, (1 - t) * a + t * b)
    return out


def smoothed_radius(a, b, c) -> Column:
    """Weights 1/4, 1/2, 1/4 of three neighbours; a missing side counts as the middle, a missing middle as the mean of the sides."""
    a, c = F.coalesce(a, b), F.coalesce(c, b)
    return (a + 2 * F.coalesce(b, (a + c) * 0.5) + c) / 4.0


def radius_curve(ne, se, sw, nw, points: int = 360) -> Column:
    """Radii by whole degree: ``quadrant_radius``, smoothed round the circle."""

    def smooth(curve):
        back = F.concat(F.slice(curve, points, 1), F.slice(curve, 1, points - 1))
        ahead = F.concat(F.slice(curve, 2, points - 1), F.slice(curve, 1, 1))
        sides = F.zip_with(back, ahead, lambda a, c: F.struct(a.alias("a"), c.alias("c")))
        return F.zip_with(curve, sides, lambda b, x: smoothed_radius(x["a"], b, x["c"]))

    return bound(F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: quadrant_radius(i, ne, se, sw, nw, points)), smooth)


def quadrant_ring(lat, lon, ne_km, se_km, sw_km, nw_km, points: int = 360) -> Column:
    """The closed ring of a quadrant footprint on a flat earth of 111 km a degree; degrees without a radius have no vertex, and a
    footprint of fewer than three vertices is null."""

    def ring(curve):
        at = F.filter(F.zip_with(curve, F.sequence(F.lit(0), F.lit(points - 1)), lambda r, i: F.struct(r.alias("r"), F.radians(i).alias("th"))), lambda p: p["r"] > 0)
        ends = F.transform(at, lambda p: F.struct((lon + p["r"] * F.cos(p["th"]) / (111.0 * F.cos(F.radians(lat)))).alias("x"), (lat + p["r"] * F.sin(p["th"]) / 111.0).alias("y")))
        return bound(ends, lambda v: F.when(F.size(v) >= 3, F.concat(v, F.slice(v, 1, 1))))

    return bound(radius_curve(ne_km, se_km, sw_km, nw_km, points), ring)


def thinned(ring: Column) -> Column:
    """A ring without the vertices that lie on the line between their neighbours; first and last stay."""

    def keep(v):
        n = F.size(v)
        inner = F.filter(F.sequence(F.lit(1), F.greatest(F.lit(1), n - 2)), lambda i: (i < n - 1) & ((F.get(v, i)["x"] - F.get(v, i - 1)["x"]) * (F.get(v, i + 1)["y"] - F.get(v, i)["y"]) != (F.get(v, i)["y"] - F.get(v, i - 1)["y"]) * (F.get(v, i + 1)["x"] - F.get(v, i)["x"])))
        return F.when(n < 3, v).otherwise(F.concat(F.slice(v, 1, 1), F.transform(inner, lambda i: F.get(v, i)), F.slice(v, -1, 1)))

    return bound(ring, keep)


def ring_in_bounds(ring: Column) -> Column:
    """Whether a ring is there, has finite coordinates only, and those are on the globe."""
    ok = F.forall(ring, lambda p: p["x"].between(-180.0, 180.0) & p["y"].between(-90.0, 90.0))
    return F.coalesce((F.size(ring) > 0) & ok, F.lit(False))


def diagnosis(ring: Column) -> Column:
    """``none``, ``empty``, ``invalid`` (fewer than three places), ``zero_area`` or ``ok``."""
    places = F.size(F.array_distinct(ring))
    return F.when(ring.isNull(), "none").when(F.size(ring) == 0, "empty").when(places < 3, "invalid").when(ring_area_km2(ring) < 1e-6, "zero_area").otherwise("ok")
