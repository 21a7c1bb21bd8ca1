"""Local map projections as column expressions, forward and back, in metres; points are structs x (longitude), y (latitude)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from perilframe.functions.geo import bound

#: Fixed values of WGS84.
WGS84_A, WGS84_F = 6378137.0, 1 / 298.257223563
E2 = WGS84_F * (2 - WGS84_F)
E = math.sqrt(E2)


def _q(sin: Column) -> Column:
    return (1 - E2) * (sin / (1 - E2 * sin * sin) - F.log((1 - E * sin) / (1 + E * sin)) / (2 * E))


QP = (1 - E2) * (1 / (1 - E2) - math.log((1 - E) / (1 + E)) / (2 * E))
RQ = WGS84_A * math.sqrt(QP / 2)


def _turned(degrees: Column) -> Column:
    """A difference of longitudes as -180 to 180."""
    return F.pmod(degrees + 540.0, F.lit(360.0)) - 180.0


def _unit(x: Column) -> Column:
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x))


def _centre(lat0: Column) -> Column:
    """Struct s, c (sine and cosine of the centre's authalic latitude) and d, the projection's scale; centres within 5 degrees of a pole are
    moved away from it."""
    phi = F.radians(F.greatest(F.lit(-85.0), F.least(F.lit(85.0), lat0)))

    def of(v):
        cos = F.sqrt(1 - v["s"] * v["s"])
        return F.struct(v["s"].alias("s"), cos.alias("c"), (WGS84_A * F.cos(v["phi"]) / F.sqrt(1 - E2 * F.sin(v["phi"]) * F.sin(v["phi"])) / (RQ * cos)).alias("d"))

    return bound(F.struct(phi.alias("phi"), _unit(_q(F.sin(phi)) / QP).alias("s")), of)


def laea(lon: Column, lat: Column, lon0: Column, lat0: Column) -> Column:
    """Lambert's azimuthal equal-area projection of the ellipsoid about (lon0, lat0): struct x, y; null at the centre's antipode."""
    values = F.struct(_centre(lat0).alias("o"), F.asin(_unit(_q(F.sin(F.radians(lat))) / QP)).alias("beta"), F.radians(_turned(lon - lon0)).alias("turn"))

    def of(v):
        o, beta, turn = v["o"], v["beta"], v["turn"]
        k = 1 + o["s"] * F.sin(beta) + o["c"] * F.cos(beta) * F.cos(turn)
        b = RQ * F.sqrt(2 / F.when(k > 1e-12, k))
        x = b * o["d"] * F.cos(beta) * F.sin(turn)
        return F.when(k > 1e-12, F.struct(x.alias("x"), (b / o["d"] * (o["c"] * F.sin(beta) - o["s"] * F.cos(beta) * F.cos(turn))).alias("y")))

    return bound(values, of)


def laea_inverse(x: Column, y: Column, lon0: Column, lat0: Column) -> Column:
    """The place of a point of ``laea``; null beyond the projection's edge. The latitude comes from the authalic one by its series and
    two steps of Newton's method."""

    def polar(o):  # by the distance from the centre, each coordinate scaled back
        return bound(F.struct(o.alias("o"), F.hypot(x / o["d"], o["d"] * y).alias("rho")), angles)

    def angles(v):
        return bound(F.struct(v["o"].alias("o"), v["rho"].alias("rho"), (2 * F.asin(F.least(F.lit(1.0), v["rho"] / (2 * RQ)))).alias("ce")), place)

    def place(v):
        o, rho, ce = v["o"], v["rho"], v["ce"]
        sin_beta = F.when(rho == 0, o["s"]).otherwise(F.cos(ce) * o["s"] + o["d"] * y * F.sin(ce) * o["c"] / F.nullif(rho, F.lit(0.0)))
        turn = F.when(rho == 0, 0.0).otherwise(F.atan2(x * F.sin(ce), o["d"] * rho * o["c"] * F.cos(ce) - o["d"] * o["d"] * y * o["s"] * F.sin(ce)))
        found = bound(F.struct(F.asin(_unit(sin_beta)).alias("beta"), (QP * _unit(sin_beta)).alias("q")), latitude)
        return F.when(rho <= 2 * RQ, F.struct(_turned(F.degrees(turn) + lon0).alias("x"), F.degrees(found).alias("y")))

    def latitude(v):
        beta = v["beta"]
        phi = beta + (E2 / 3 + 31 * E2**2 / 180 + 517 * E2**3 / 5040) * F.sin(2 * beta) + (23 * E2**2 / 360 + 251 * E2**3 / 3780) * F.sin(4 * beta) + 761 * E2**3 / 45360 * F.sin(6 * beta)

        def step(w):
            return bound(F.sin(w), lambda s: w + F.when(F.abs(F.cos(w)) > 1e-9, (1 - E2 * s * s) * (1 - E2 * s * s) / (2 * F.cos(w)) * (v["q"] - _q(s)) / (1 - E2)).otherwise(0.0))

        return bound(bound(phi, step), step)

    return bound(_centre(lat0), polar)


def aeqd(lon: Column, lat: Column, lon0: Column, lat0: Column, radius_m: float = 6_371_000.0) -> Column:
    """The azimuthal equidistant projection of a sphere about (lon0, lat0): struct x, y, at the great-circle distance and true bearing."""
    p, p0, turn = F.radians(lat), F.radians(lat0), F.radians(_turned(lon - lon0))
    u = F.cos(p) * F.sin(turn)
    v = F.cos(p0) * F.sin(p) - F.sin(p0) * F.cos(p) * F.cos(turn)
    away = F.hypot(u, v)
    c = F.atan2(away, F.sin(p0) * F.sin(p) + F.cos(p0) * F.cos(p) * F.cos(turn))
    k = F.when(away > 0, radius_m * c / F.nullif(away, F.lit(0.0))).otherwise(0.0)
    return F.struct((k * u).alias("x"), (k * v).alias("y"))


def aeqd_inverse(x: Column, y: Column, lon0: Column, lat0: Column, radius_m: float = 6_371_000.0) -> Column:
    """The place of a point of ``aeqd``."""
    c, p0 = F.hypot(x, y) / radius_m, F.radians(lat0)
    k = F.when(c > 0, F.sin(c) / F.nullif(c * radius_m, F.lit(0.0))).otherwise(0.0)
    lat = F.asin(_unit(F.cos(c) * F.sin(p0) + y * k * F.cos(p0)))
    turn = F.atan2(x * k, F.cos(p0) * F.cos(c) - y * k * F.sin(p0))
    return F.struct(_turned(F.degrees(turn) + lon0).alias("x"), F.degrees(lat).alias("y"))


def _scale(lat0: Column) -> tuple[Column, float]:
    """Metres a degree, as a rough fallback has them."""
    return 111_320.0 * F.cos(F.radians(F.greatest(F.lit(-85.0), F.least(F.lit(85.0), lat0)))), 110_540.0


def affine(lon: Column, lat: Column, lon0: Column, lat0: Column) -> Column:
    """A flat earth about (lon0, lat0): struct x, y. The fallback where no projection is to be had."""
    mx, my = _scale(lat0)
    return F.struct(((lon - lon0) * mx).alias("x"), ((lat - lat0) * my).alias("y"))


def affine_inverse(x: Column, y: Column, lon0: Column, lat0: Column) -> Column:
    mx, my = _scale(lat0)
    return F.struct((x / mx + lon0).alias("x"), (y / my + lat0).alias("y"))
