"""Scalar column functions: identifiers, dates, hazard classes, seismic and wind scales."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from perilframe.functions.geo import bound

# Unicode dashes that stand for a hyphen; keywords of hazard types in order of precedence; member countries.
DASHES = "‐‑‒–—−"
HAZARDS = (("storm", ("storm", "cyclone", "typhoon", "hurricane")), ("earthquake", ("earth",)), ("tsunami", ("tsunami",)), ("flood", ("flood",)))
MEMBERS = "AUS AUT BEL CAN CHL COL CZE DNK EST FIN FRA DEU GRC HUN ISL IRL ISR ITA JPN KOR LVA LTU LUX MEX NLD NZL NOR POL PRT SVK SVN ESP SWE CHE TUR GBR USA".split()
#: Upper wind bounds in knots of categories -1 to 4.
WIND_BOUNDS = (34, 64, 83, 96, 113, 137)
#: Intensity attenuation by regime.
ATTENUATION = {
    "active": {"C1": 12.27, "C2": 2.270, "C3": 0.1304, "C4": -1.30, "C5": -7.07e-4, "C6": 1.95, "C7": -0.577, "h": 14.0, "Rt": 30.0},
    "stable": {"C1": 11.72, "C2": 2.36, "C3": 0.1155, "C4": -0.44, "C5": -0.002044, "C6": 2.31, "C7": -0.479, "h": 17.0, "Rt": 80.0},
}


def norm_event_id(x: Column) -> Column:
    """Null as empty; Unicode dashes as hyphens; trimmed."""
    return F.trim(F.translate(F.coalesce(x.cast("string"), F.lit("")), DASHES, "-" * len(DASHES)))


def classify_hazard(x: Column) -> Column:
    """The first hazard of ``HAZARDS`` with a keyword in the text, else ``other``."""
    t = F.lower(F.coalesce(x, F.lit("")))
    out = F
    for name, keys in HAZARDS:
        hit = t.contains(keys[0])
        for k in keys[1:]:
            hit = hit | t.contains(k)
        out = out.when(hit, name)
    return out.otherwise("other")


def norm_iso(x: Column) -> Column:
    """Upper-cased country code; ``UNK`` where missing; one historic alias."""
    t = F.upper(F.trim(x))
    return F.when(t.isNull() | (t == ""), "UNK").when(t == "UKM", "GBR").otherwise(t)


def norm_name(x: Column) -> Column:
    return F.regexp_replace(F.lower(x), "[^a-z0-9]", "")


def is_member(iso: Column) -> Column:
    return F.coalesce(F.upper(F.trim(iso)).isin(MEMBERS), F.lit(False))


def coerce_double(x: Column) -> Column:
    """A number, or null for what isn't one or isn't finite."""
    v = F.trim(x.cast("string")).try_cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)


def coerce_int(x: Column) -> Column:
    """A number without its fraction, as an int."""
    return coerce_double(x).cast("int")


def positive(x: Column) -> Column:
    return F.when((x > 0) & ~F.isnan(x.cast("double")), x)


def first_positive(*columns: Column) -> Column:
    return F.coalesce(*map(positive, columns))


def bounds_ok(lon: Column, lat: Column) -> Column:
    return F.coalesce(lon.between(-180, 180) & lat.between(-90, 90), F.lit(False))


def ymd_clamped(y: Column, m: Column, d: Column) -> Column:
    """A date with month in 1..12 and day up to the month's end; 1 where missing; null without a year."""
    month = F.greatest(F.lit(1), F.least(F.lit(12), F.coalesce(m, F.lit(1))))
    first = F.make_date(y, month, F.lit(1))
    day = F.least(F.dayofmonth(F.last_day(first)), F.greatest(F.lit(1), F.coalesce(d, F.lit(1))))
    return F.date_add(first, day - 1)


def ymd_clamp28(y: Column, m: Column, d: Column) -> Column:
    """A date with month in 1..12 and day in 1..28; 1 where missing."""
    month = F.greatest(F.lit(1), F.least(F.lit(12), F.coalesce(m, F.lit(1))))
    return F.make_date(y, month, F.greatest(F.lit(1), F.least(F.lit(28), F.coalesce(d, F.lit(1)))))


def dmy_date(x: Column) -> Column:
    return F.try_to_timestamp(F.trim(x), F.lit("dd/MM/yyyy")).cast("date")


def compact_datetime(x: Column) -> Column:
    """Digits as a time by their number (14 and more, 12 or 13, 8, 6, 4); scientific notation counts as its whole number."""
    s = F.trim(x.cast("string"))
    plain = F.when(F.lower(s).contains("e"), s.try_cast("double").cast("decimal(20,0)").cast("string")).otherwise(s)
    n = F.length(plain)
    full = F.when(n >= 14, plain.substr(1, 14)).when(n.isin(12, 13), F.concat(plain.substr(1, 12), F.lit("00"))).when(n == 8, F.concat(plain, F.lit("000000"))).when(n == 6, F.concat(plain, F.lit("01000000"))).when(n == 4, F.concat(plain, F.lit("0101000000")))
    return F.try_to_timestamp(full, F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz")


def decade(t: Column) -> Column:
    y = F.year(t)
    return F.coalesce(F.concat((y - F.pmod(y, F.lit(10))).cast("string"), F.lit("s")), F.lit("unknown"))


def wind_category(knots: Column) -> Column:
    """-1 to 5 from wind speed; null where missing."""
    out = F
    for k, bound in enumerate(WIND_BOUNDS):
        out = out.when(knots < bound, k - 1)
    return F.when(knots.isNotNull() & ~F.isnan(knots.cast("double")), out.otherwise(5)).cast("int")


def wrap_lon(lon: Column) -> Column:
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def mechanism(rake: Column) -> Column:
    """SS, R, N or U (unknown) from the rake in degrees."""
    folded = F.abs(F.pmod(rake + 180.0, F.lit(360.0)) - 180.0)
    return F.when(rake.isNull(), "U").when(folded <= 30, "SS").when(rake.between(45, 135), "R").when(rake.between(-135, -45), "N").otherwise("SS")


def rupture_length(mw: Column, mech: Column) -> Column:
    """Kilometres, from an area of 10^(-3.49 + 0.91 Mw) and an aspect of 3 (SS) or 2."""
    return F.sqrt(F.pow(F.lit(10.0), 0.91 * mw - 3.49) * F.when(mech == "SS", 3.0).otherwise(2.0))


def rupture_width(mw: Column, mech: Column) -> Column:
    return F.pow(F.lit(10.0), 0.91 * mw - 3.49) / rupture_length(mw, mech)


def intensity(mw: Column, r_km: Column, depth_km: Column, regime: str = "active") -> Column:
    c = ATTENUATION[regime]
    r = F.greatest(F.hypot(r_km, F.greatest(F.lit(c["h"]), F.coalesce(depth_km, F.lit(0.0)))), F.lit(1e-6))
    far = F.when(r > c["Rt"], F.log10(r / c["Rt"])).otherwise(0.0)
    return c["C1"] + c["C2"] * (mw - 6.0) + c["C3"] * F.pow(mw - 6.0, 2) + c["C4"] * F.log10(r) + c["C5"] * r + c["C6"] * far + c["C7"] * mw * F.log10(r)


def intensity_radius(mw: Column, depth_km: Column, target: float, regime: str = "active", most_km: float = 1500.0, steps: int = 60) -> Column:
    """The distance at which intensity falls to ``target``, by bisection inside one expression; 0 if it never reaches it.

    A step adds its half width where intensity still reaches the target there; what doesn't change along the way is bound once.
    """
    c = ATTENUATION[regime]
    level = c["C1"] + c["C2"] * (mw - 6.0) + c["C3"] * F.pow(mw - 6.0, 2)
    fixed = F.struct((level - target).alias("over"), (c["C4"] + c["C7"] * mw).alias("slope"), F.pow(F.greatest(F.lit(c["h"]), F.coalesce(depth_km, F.lit(0.0))), F.lit(2)).alias("h2"))

    def search(p):
        def step(lo, width):
            def reaches(r):
                far = F.when(r > c["Rt"], F.log10(r / c["Rt"])).otherwise(0.0)
                return p["over"] + p["slope"] * F.log10(r) + c["C5"] * r + c["C6"] * far >= 0

            mid = lo + width
            return F.when(bound(F.greatest(F.sqrt(mid * mid + p["h2"]), F.lit(1e-6)), reaches), mid).otherwise(lo)

        return F.aggregate(F.array(*(F.lit(most_km / 2.0**k) for k in range(1, steps + 1))), F.lit(0.0), step)

    return F.when(intensity(mw, F.lit(0.0), depth_km, regime) < target, 0.0).otherwise(bound(fixed, search))


def runup_length_km(h: Column, least: float = 4.0, most: float = 60.0, factor: float = 8.0, exponent: float = 1.0) -> Column:
    """Alongshore length from a run-up height in metres, a clamped power law."""
    grown = F.greatest(F.lit(least), F.least(F.lit(most), factor * F.pow(F.greatest(h, F.lit(0.0)), F.lit(exponent))))
    return F.when(h > 0, grown).otherwise(F.lit(least))


def inland_km(h: Column, least: float = 0.1, most: float = 12.0, factor: float = 1.0, exponent: float = 1.0) -> Column:
    """How far inland a run-up height in metres reaches, a clamped power law; heights below 0 and nulls count as 0."""
    return F.greatest(F.lit(least), F.least(F.lit(most), factor * F.pow(F.greatest(F.coalesce(h, F.lit(0.0)), F.lit(0.0)), F.lit(exponent))))


def code_list(x: Column, separator: str = ";") -> Column:
    """The distinct trimmed codes of a list in one string, in order; blanks are none."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.split(F.coalesce(x, F.lit("")), separator), lambda v: F.trim(v)), lambda v: v != "")))


def decay_weight(d_km: Column, r0_km: Column | float) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.exp(-d_km / (F.lit(r0_km) if isinstance(r0_km, float) else r0_km))))


def first_nonnull(column: str, *order: str) -> Column:
    """An aggregate: the value of ``column`` in the first row, by ``order``, that has one."""
    return F.min_by(F.col(column), F.when(F.col(column).isNotNull(), F.struct(*order)))
