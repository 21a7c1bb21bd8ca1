"""Storm tracks: agency blending, adaptive parameters, per-step candidates."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from perilframe.functions import geo
from perilframe.functions import scalars as S
from perilframe.operators import sequence

#: Agency weights (others 0.75), storm-size factors by category, climatological gale radius by basin and category 0 to 5.
AGENCIES = {"usa": 1.00, "reunion": 0.95, "bom": 0.95, "tokyo": 0.90, "cma": 0.90, "hko": 0.85, "kma": 0.85, "nadi": 0.85}
SIZE_FACTOR = {0: 1.8, 1: 2.0, 2: 2.2, 3: 2.4, 4: 2.6, 5: 2.8}
GALE_RADIUS_NM = {
    "ATL": (60, 75, 90, 110, 120, 130), "EP": (55, 70, 85, 100, 115, 125), "WP": (60, 80, 95, 115, 130, 140),
    "SI": (55, 70, 85, 105, 120, 130), "SP": (55, 70, 85, 100, 115, 125), "NI": (50, 65, 80, 95, 110, 120),
}
STEP_ORDER = ["iso_time", "k1", "k2", "k3", "k4"]


def blended(columns: dict[str, float]):
    """Weighted mean over agencies' columns (name: weight), nulls left out."""
    items = F.filter(F.array(*(F.struct(F.col(c).cast("double").alias("v"), F.lit(w).alias("w")) for c, w in columns.items())), lambda x: x["v"].isNotNull())
    total = F.aggregate(items, F.lit(0.0), lambda a, x: a + x["w"])
    return F.aggregate(items, F.lit(0.0), lambda a, x: a + x["v"] * x["w"]) / F.nullif(total, F.lit(0.0))


def steps(tracks: DataFrame) -> DataFrame:
    """Track steps, one for each order key, with blended wind and its category. They are dealt out by track once, before the copies go, so that neither these
    nor what goes along a track later needs a shuffle of its own."""
    rows = tracks.repartition("sid").dropDuplicates(["sid", *STEP_ORDER])
    wind = blended({"usa_wind": AGENCIES["usa"], "tokyo_wind": AGENCIES["tokyo"]})
    return rows.withColumn("wind", wind).withColumn("category", S.wind_category(F.col("wind")))


def in_seasons(rows: DataFrame, first: int, last: int | None = None, time: str = "iso_time") -> DataFrame:
    """Steps of seasons from ``first`` on, up to ``last`` if it is given: by the column ``season`` where there is one (in the south a season begins in
    the year before), else by the calendar year."""
    named = next((n for n in rows.columns if n.lower() == "season"), None)
    year = F.col(named).cast("string").try_cast("int") if named else F.year(time)
    return rows.where(year >= first if last is None else year.between(first, last))


def _top(category):
    return F.greatest(F.lit(0), F.coalesce(category, F.lit(-1))).cast("int")


def _union_nm(category):
    return F.greatest(F.lit(25.0), 20.0 + 12.0 * _top(category))


def adaptive_params(rows: DataFrame) -> DataFrame:
    """(sid, category, union_nm, line_m, min_area_km2) from each track's highest category, 0 where it has none."""
    return rows.groupBy("sid").agg(_top(F.max("category")).alias("category")).select(
        "sid", "category", _union_nm(F.col("category")).alias("union_nm"),
        F.greatest(F.lit(3000.0), 3000.0 * (F.col("category") + 1.0)).alias("line_m"), (60.0 + 20.0 * F.col("category")).alias("min_area_km2"),
    )


def quadrant_radii(rows: DataFrame) -> DataFrame:
    """Long form (sid, order keys, quad, radius) of the weighted positive radii of each step's quadrants."""
    long = rows.select("sid", *STEP_ORDER, F.inline(F.array(F.struct(F.lit("NE").alias("quad"), S.positive(F.col("usa_r34_ne")).alias("radius")), F.struct(F.lit("SE").alias("quad"), S.positive(F.col("usa_r34_se")).alias("radius")))))
    return long


def coverage_mode(rows: DataFrame, least: float = 0.15) -> DataFrame:
    """(sid, coverage, mode): share of steps with any radius; ``weighted`` from ``least`` on, else ``first``."""
    any_radius = S.positive(F.col("usa_r34_ne")).isNotNull() | S.positive(F.col("usa_r34_se")).isNotNull()
    return rows.groupBy("sid").agg(F.avg(any_radius.cast("double")).alias("coverage")).withColumn("mode", F.when(F.col("coverage") >= least, "weighted").otherwise("first"))


def smoothed(rows: DataFrame) -> DataFrame:
    """Quadrant radii smoothed along each track."""
    w = Window.partitionBy("sid").orderBy(*STEP_ORDER)
    return rows.select("sid", *STEP_ORDER, sequence.smooth_3pt("usa_r34_ne", w).alias("ne"), sequence.smooth_3pt("usa_r34_se", w).alias("se"))


def chosen_methods(rows: DataFrame, basin: str = "WP") -> DataFrame:
    """Each step's footprint method with hysteresis: quadrants, then a radius scaled by category, then climatology."""
    quad = F.when(S.positive(F.col("usa_r34_ne")).isNotNull() | S.positive(F.col("usa_r34_se")).isNotNull(), F.struct(F.lit("quadrant_smoothed").alias("method"), F.lit(0.92).alias("conf")))
    scaled = F.when(F.col("usa_wind").isNotNull(), F.struct(F.lit("rmw_scaled").alias("method"), F.lit(0.65).alias("conf")))
    climo = F.when(F.col("category") >= 0, F.struct(F.lit("climo_r34").alias("method"), F.lit(0.55).alias("conf")))
    rows = rows.withColumn("candidates", F.filter(F.array(quad, scaled, climo), lambda c: c.isNotNull()))
    return sequence.hysteresis(rows.select("sid", *STEP_ORDER, "candidates"), "sid", STEP_ORDER)


#: Kilometres in a nautical mile; confidences of the footprint methods, best first.
NM_KM = 1.852
METHODS = (("quadrant_smoothed", 0.92), ("roci", 0.80), ("rmw_scaled", 0.65), ("climo_r34", 0.55))
QUADS = ("ne", "se", "sw", "nw")


def weighted_radii(rows: DataFrame, tiers: tuple[str, ...] = ("r34", "r50", "r64")) -> DataFrame:
    """Adds ne, se, sw, nw (nm): the weighted mean of the radii that there are, over all agencies' columns ``{agency}_{tier}_{quadrant}``."""
    for q in QUADS:
        found = {k: AGENCIES.get(k.split("_")[0], 0.75) for k in rows.columns if any(k.endswith(f"_{t}_{q}") for t in tiers)}
        rows = rows.withColumn(f"_{q}", blended(found) if found else F.lit(None).cast("double"))
    return rows.withColumnsRenamed({f"_{q}": q for q in QUADS})


def blended_position(rows: DataFrame, agencies: list[str]) -> DataFrame:
    """Adds pos_lat, pos_lon, pos_source: the master position (lat, lon) where both are there; else, of the agencies' positions
    (``{agency}_lat``, ``{agency}_lon``, in this order), the only one, or their weighted mean, circular in longitude."""
    place = lambda a: F.when(F.col(f"{a}_lat").isNotNull() & F.col(f"{a}_lon").isNotNull(), F.struct(F.lit(a.upper()).alias("name"), F.col(f"{a}_lat").cast("double").alias("lat"), F.col(f"{a}_lon").cast("double").alias("lon"), F.lit(AGENCIES.get(a, 0.75)).alias("w")))
    rows = rows.withColumn("_p", F.filter(F.array(*map(place, agencies)), lambda p: p.isNotNull()))

    def total(f):
        return F.aggregate("_p", F.lit(0.0), lambda acc, p: acc + p["w"] * f(p))

    lon = F.degrees(F.atan2(total(lambda p: F.sin(F.radians(p["lon"]))), total(lambda p: F.cos(F.radians(p["lon"])))))
    lat = total(lambda p: F.greatest(F.lit(-90.0), F.least(F.lit(90.0), p["lat"]))) / F.nullif(total(lambda p: F.lit(1.0)), F.lit(0.0))
    names = F.concat(F.lit("BLEND("), F.array_join(F.transform("_p", lambda p: p["name"]), ","), F.lit(")"))
    one, master = F.get("_p", F.lit(0)), F.col("lat").isNotNull() & F.col("lon").isNotNull()
    pick = lambda a, b, c: F.when(master, a).when(F.size("_p") == 1, b).when(F.size("_p") > 1, c)
    return rows.select("*", pick(F.col("lat"), one["lat"], lat).alias("pos_lat"), pick(F.col("lon"), one["lon"], S.wrap_lon(lon)).alias("pos_lon"), pick(F.lit("MASTER"), one["name"], names).alias("pos_source")).drop("_p")


def climatology(steps: DataFrame) -> DataFrame:
    """Adds climo_nm, the gale radius of a step's basin and category, and rmw_factor, the size factor of its category (2.2 without a
    category, 2.0 for others). The tables have a few dozen rows and are broadcast."""
    spark = steps.sparkSession
    radii = spark.createDataFrame([(b, k, float(v)) for b, row in GALE_RADIUS_NM.items() for k, v in enumerate(row)], "_basin string, _cat int, climo_nm double")
    factors = spark.createDataFrame(list(SIZE_FACTOR.items()), "_k int, _factor double")
    rows = steps.join(F.broadcast(radii), (F.col("basin") == F.col("_basin")) & (F.col("category") == F.col("_cat")), "left").drop("_basin", "_cat")
    rows = rows.join(F.broadcast(factors), F.coalesce("category", F.lit(2)) == F.col("_k"), "left")
    return rows.withColumn("rmw_factor", F.coalesce("_factor", F.lit(2.0))).drop("_k", "_factor")


def step_footprints(steps: DataFrame, margin: float = 0.08, least_coverage: float = 0.15) -> DataFrame:
    """Each step's footprint: method, conf, and its radii ne_km to nw_km (a circle has four equal ones), grown to the track's least area.

    steps: sid, order keys, lat, lon, category, basin, ne, se, sw, nw, roci_nm, rmw_nm (all nm). A track whose steps mostly lack
    quadrants (coverage below ``least_coverage``) has them smoothed along the track. The last method stays while it is there and less
    than ``margin`` worse. A step without any candidate has no footprint.
    """
    w = Window.partitionBy("sid").orderBy(*STEP_ORDER)
    rows = steps
    for q in QUADS:
        rows = rows.withColumn(q, S.positive(F.col(q)))
    some = F.coalesce(*QUADS).isNotNull()
    rows = rows.withColumn("_cover", F.avg(some.cast("double")).over(Window.partitionBy("sid"))).withColumn("_top", F.max("category").over(Window.partitionBy("sid")))
    thin = F.col("_cover") < least_coverage
    rows = rows.select("*", *(F.when(thin, sequence.smooth_3pt(q, w)).otherwise(F.col(q)).alias(f"_{q}") for q in QUADS))
    rows = climatology(rows)
    circle = {"roci": S.positive(F.col("roci_nm")), "rmw_scaled": S.positive(F.col("rmw_nm")) * F.col("rmw_factor"), "climo_r34": F.col("climo_nm")}
    there = {"quadrant_smoothed": F.coalesce(*(f"_{q}" for q in QUADS)).isNotNull()} | {k: v > 0 for k, v in circle.items()}
    found = F.filter(F.array(*(F.when(there[m], F.struct(F.lit(m).alias("method"), F.lit(conf).alias("conf"))) for m, conf in METHODS)), lambda x: x.isNotNull())
    rows = rows.withColumn("candidates", found)
    rows = rows.select("sid", *STEP_ORDER, "candidates", "lat", "lon", "_top", *(f"_{q}" for q in QUADS), *(v.alias(f"_{m}") for m, v in circle.items()))
    rows = sequence.hysteresis(rows, "sid", STEP_ORDER, margin, ["lat", "lon", "_top", *(f"_{q}" for q in QUADS), *(f"_{m}" for m in circle)])
    radius = F
    for m in circle:
        radius = radius.when(F.col("method") == m, F.col(f"_{m}"))
    quad = F.col("method") == "quadrant_smoothed"
    rows = rows.withColumn("_r", radius).select("sid", *STEP_ORDER, "lat", "lon", "method", "conf", "_top", *(F.when(quad, F.col(f"_{q}")).otherwise(F.col("_r")).alias(q) for q in QUADS))
    # sectors of 90 degrees between two radii have the area pi / 4 * (a2 + ab + b2) / 3
    sides = [(F.coalesce(a, b), F.coalesce(b, a)) for a, b in (("ne", "se"), ("se", "sw"), ("sw", "nw"), ("nw", "ne"))]
    area = sum((F.coalesce((a * a + a * b + b * b) / 3.0, F.lit(0.0)) for a, b in sides), F.lit(0.0)) * (3.141592653589793 / 4 * NM_KM * NM_KM)
    least = 60.0 + 20.0 * F.greatest(F.lit(0), F.coalesce("_top", F.lit(0)))
    grow = F.greatest(F.lit(1.0), F.sqrt(least / F.nullif(area, F.lit(0.0))))
    return rows.select("sid", *STEP_ORDER, "lat", "lon", "method", "conf", *((F.col(q) * NM_KM * grow).alias(f"{q}_km") for q in QUADS))


def footprint_cells(steps: DataFrame, res_deg: float) -> DataFrame:
    """(sid, row, col): cells of a longitude-latitude grid whose centre lies in a step's footprint, once a track. Columns go round the globe."""
    n = round(360 / res_deg)
    reach, flat = F.greatest(*(f"{q}_km" for q in QUADS)), 111.0 * F.greatest(F.lit(0.0), F.cos(F.radians("lat")))
    low = lambda v, far: F.ceil((v - far) / res_deg - 0.5).cast("int")
    high = lambda v, far: F.floor((v + far) / res_deg - 0.5).cast("int")
    rows = steps.withColumn("row", F.explode(F.sequence(low(F.col("lat") + 90.0, reach / 111.0), high(F.col("lat") + 90.0, reach / 111.0)))).where(F.col("row").between(0, round(180 / res_deg) - 1))
    # near a pole a step may reach all columns; each is looked at once, by its shorter way round
    span = F.when(reach >= 180.0 * flat, F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.sequence(low(F.col("lon") + 180.0, reach / F.nullif(flat, F.lit(0.0))), high(F.col("lon") + 180.0, reach / F.nullif(flat, F.lit(0.0)))))
    rows = rows.withColumn("col", F.explode(span))
    turn = F.pmod((F.col("col") + 0.5) * res_deg - F.col("lon"), F.lit(360.0)) - 180.0  # of the centre from the step
    dx, dy = turn * flat, ((F.col("row") + 0.5) * res_deg - 90.0 - F.col("lat")) * 111.0
    rows = rows.withColumn("_d", F.hypot(dx, dy)).where(F.col("_d") <= reach).withColumn("_i", F.pmod(F.floor(F.pmod(F.degrees(F.atan2(dy, dx)), F.lit(360.0))).cast("int"), F.lit(360)))
    radii = [F.col(f"{q}_km") for q in QUADS]
    three = F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda k: geo.quadrant_radius(F.pmod(F.col("_i") + k, F.lit(360)), *radii))
    # within a quadrant the radius is linear, and smoothing leaves it as it is
    edge = geo.bound(three, lambda v: geo.smoothed_radius(v[0], v[1], v[2]))
    inside = F.col("_d") <= F.when((F.col("_i") % 90).between(1, 88), geo.quadrant_radius(F.col("_i"), *radii)).otherwise(edge)
    return rows.where(inside).select("sid", "row", F.pmod("col", F.lit(n)).alias("col")).distinct()


def capsules(steps: DataFrame) -> DataFrame:
    """Footprints for tracks without any: circles of the track's union radius about its points, at most 20 km apart."""
    steps = sequence.unwrapped(steps, ["sid"], STEP_ORDER).withColumn("lon", F.col("lon_unwrapped"))  # the short way over the antimeridian
    far = geo.haversine_km(F.col("lat"), F.col("lon"), F.col("_y2"), F.col("_x2"))
    points = sequence.densified(steps, "sid", STEP_ORDER, 20.0, "lon", "lat", far).select("sid", F.col("y").alias("lat"), F.col("x").alias("lon"), F.lit(None).cast("int").alias("category"))
    points = points.unionByName(steps.select("sid", "lat", "lon", F.col("category").cast("int").alias("category")))
    # the greatest category along the track: a join with the tracks' parameters would read, and deal out, the steps once more
    points = points.withColumn("union_nm", _union_nm(F.max("category").over(Window.partitionBy("sid"))))
    return points.select("sid", "lat", "lon", F.lit("capsule").alias("method"), *((F.col("union_nm") * NM_KM).alias(f"{q}_km") for q in QUADS))


def storm_footprints(steps: DataFrame, res_deg: float = 0.25, margin: float = 0.08) -> tuple[DataFrame, DataFrame]:
    """(cells, steps): the union of each track's step footprints as (sid, row, col), and the steps with their methods.

    Tracks without a candidate in any step get a capsule along the track; they are told apart by what they are made of, as their footprints
    would have to be worked out again for it. Rows without a position take no part.
    """
    steps = steps.where("lat IS NOT NULL AND lon IS NOT NULL")
    made = climatology(steps).withColumn("_any", F.coalesce(F.greatest(*QUADS, "roci_nm", "rmw_nm", "climo_nm") > 0, F.lit(False)))
    made = made.withColumn("_any", F.max("_any").over(Window.partitionBy("sid"))).select(*steps.columns, "_any")
    chosen, bare = step_footprints(made.where("_any").drop("_any"), margin), made.where("NOT _any").drop("_any")
    # apart, as the steps of a track lie in one partition: its cells are made distinct there, without a shuffle
    return footprint_cells(chosen, res_deg).unionByName(footprint_cells(capsules(bare), res_deg)), chosen


def cell_area_km2(row, res_deg: float):
    """Area of a grid cell by its row, on the authalic sphere."""
    south, north = row * res_deg - 90.0, (row + 1) * res_deg - 90.0
    return (geo.equal_area_y(north) - geo.equal_area_y(south)) * geo.equal_area_x(F.lit(res_deg)) / 1e6


def track_hull(points: DataFrame, key: str = "sid") -> DataFrame:
    """(key, i, x, y): corners of the convex hull of a track's points (x, y), counter-clockwise from the lowest x, then y.

    Repeated points count once and null ones not at all; a track of one place or on one line has one or two corners. A track's
    distinct positions are one row, and pandas gets many tracks at a time: a group for each would cost more than its hull.
    """
    tracks = points.where("x IS NOT NULL AND y IS NOT NULL").groupBy(key).agg(F.collect_set(F.struct("x", "y")).alias("v"))
    tracks = tracks.select(key, F.transform("v", lambda p: p["x"]).alias("x"), F.transform("v", lambda p: p["y"]).alias("y"))
    kind = dict(tracks.dtypes)[key]

    def chain(run):
        out = []
        for p in run:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out

    def hulls(batches):
        for batch in batches:
            rows = []
            for k, xs, ys in zip(batch[key], batch["x"], batch["y"]):
                at = sorted(zip(xs.tolist(), ys.tolist()))
                ring = chain(at)[:-1] + chain(at[::-1])[:-1] or at
                rows += [(k, i, x, y) for i, (x, y) in enumerate(ring)]
            yield pd.DataFrame(rows, columns=[key, "i", "x", "y"]).astype({"i": "int64", "x": "float64", "y": "float64"})

    return tracks.mapInPandas(hulls, f"{key} {kind}, i long, x double, y double")
