"""Joins that Spark has no single operator for: interval overlap, distance, nearest, as-of.

All go by an equi-key (month, grid cell) and a residual condition. They are sort-merge joins by hint, whose skewed partitions adaptive
execution can split: a side is exploded to several keys, which the size estimate doesn't know of, so a small file
would be broadcast with many times its rows. Only that side grows, by a bounded factor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from perilframe.functions.geo import haversine_km, own_cell, reached_cells
from perilframe.io import written

#: Intervals of more months than this go to a side branch of their own (they would be exploded too far).
LONG_MONTHS = 24


def _months(start: Column, end: Column) -> Column:
    return F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("INTERVAL 1 MONTH"))


def _split(df: DataFrame, start: Column, end: Column) -> tuple[DataFrame, DataFrame]:
    df = df.withColumn("_s", start.cast("date")).withColumn("_e", F.greatest(F.coalesce(end, start), start).cast("date")).where("_s IS NOT NULL")
    short = F.months_between(F.trunc("_e", "MM"), F.trunc("_s", "MM")) <= LONG_MONTHS
    return df.where(short).withColumn("_month", F.explode(_months(F.col("_s"), F.col("_e")))), df.where(~short)


def _sides(left: DataFrame, right: DataFrame, tolerance_days: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    end = F.date_add(F.coalesce("r_end", "r_start"), tolerance_days)
    return *_split(left, F.col("l_start"), F.col("l_end")), *_split(right, F.date_sub("r_start", tolerance_days), end)


def none_long(left: DataFrame, right: DataFrame, tolerance_days: int = 7) -> bool:
    """Whether no interval of either side, as ``overlap_pairs`` has them, is a long one."""
    _, a_long, _, b_long = _sides(left, right, tolerance_days)
    return a_long.isEmpty() and b_long.isEmpty()


def overlap_pairs(left: DataFrame, right: DataFrame, tolerance_days: int = 7, extra: Column | None = None, keys: list[str] = [], short: bool = False) -> DataFrame:
    """Pairs whose closed intervals (l_start, l_end) and (r_start, r_end) overlap, the right ones widened by a tolerance.

    Null ends count as starts; rows without a start pair with none. ``keys`` are equi-columns that both sides share. short: both sides are known
    to have no long intervals (``none_long``), so the joins of those, which deal out all rows again, are left out.
    """
    a, a_long, b, b_long = _sides(left, right, tolerance_days)
    b, b_long = (x.withColumnsRenamed({"_s": "_s2", "_e": "_e2", "_month": "_month2"} | {k: f"_r_{k}" for k in keys}) for x in (b, b_long))
    on = (F.col("_s") <= F.col("_e2")) & (F.col("_e") >= F.col("_s2"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"_r_{k}"))
    if extra is not None:
        on = on & extra
    gone = ["_s", "_e", "_s2", "_e2", "_month", "_month2", *(f"_r_{k}" for k in keys)]
    once = F.col("_month") == F.trunc(F.greatest("_s", "_s2"), "MM")
    out = a.join(b.hint("merge"), on & once & (F.col("_month") == F.col("_month2"))).drop(*gone)
    if short:
        return out
    if keys:  # long intervals still meet on the other keys
        plain = a.where(F.col("_month") == F.trunc("_s", "MM")).drop("_month")
        b_long = b_long.hint("merge")
        both = plain.join(b_long, on).drop(*gone).unionByName(a_long.join(b_long, on).drop(*gone))
        plain_b = b.where(F.col("_month2") == F.trunc("_s2", "MM")).drop("_month2")
        return out.unionByName(both).unionByName(a_long.join(plain_b.hint("merge"), on).drop(*gone))
    return out.unionByName(_long_pairs(a, a_long, b, b_long, on, gone))


def _long_pairs(a, a_long, b, b_long, on, gone) -> DataFrame:
    """Pairs with a long interval: years are the key there, as long intervals have few of them each."""
    def years(df, s, e, name):
        return df.withColumn(name, F.explode(F.sequence(F.year(s), F.year(e))))

    plain = a.where(F.col("_month") == F.trunc("_s", "MM")).drop("_month")
    plain_b = b.where(F.col("_month2") == F.trunc("_s2", "MM")).drop("_month2")
    once = (F.col("_y") == F.col("_y2")) & (F.col("_y") == F.year(F.greatest("_s", "_s2")))
    gone = [*gone, "_y", "_y2"]
    parts = [(plain, b_long), (a_long, b_long), (a_long, plain_b)]
    out = None
    for x, y in parts:
        part = years(x, "_s", "_e", "_y").join(years(y, "_s2", "_e2", "_y2").hint("merge"), on & once).drop(*gone)
        out = part if out is None else out.unionByName(part)
    return out


def _met(rows: DataFrame, others: DataFrame, keys: list[str] = []) -> DataFrame:
    """Rows (keys, _s, _e, others) whose interval of days meets one of ``others`` (keys, _s, _e), by the latest end of those that start up to
    the row's end. No pair is built: the running maximum goes over distinct days, which are few however many rows there are."""
    ends = others.groupBy(*keys, F.col("_s").alias("_d")).agg(F.max("_e").alias("_m"))
    days = ends.unionByName(rows.select(*keys, F.col("_e").alias("_d"), F.lit(None).cast("date").alias("_m")).distinct()).groupBy(*keys, "_d").agg(F.max("_m").alias("_m"))
    past = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_d").rowsBetween(Window.unboundedPreceding, 0)
    reach = days.select(*(F.col(k).alias(f"_r_{k}") for k in keys), "_d", F.max("_m").over(past).alias("_m"))
    on = F.col("_e") == F.col("_d")
    for k in keys:
        on = on & (F.col(k) == F.col(f"_r_{k}"))
    return rows.join(reach, on).where("_m >= _s").drop("_d", "_m", *(f"_r_{k}" for k in keys))


def _left_days(df: DataFrame) -> DataFrame:
    return df.withColumn("_s", F.col("l_start").cast("date")).withColumn("_e", F.greatest(F.coalesce("l_end", "l_start"), "l_start").cast("date")).where("_s IS NOT NULL")


def _right_days(df: DataFrame, tolerance_days: int) -> DataFrame:
    start, end = F.date_sub("r_start", tolerance_days), F.date_add(F.coalesce("r_end", "r_start"), tolerance_days)
    return df.withColumn("_s", start).withColumn("_e", F.greatest(end, start)).where("_s IS NOT NULL")


def temporal_overlap_semi(left: DataFrame, right: DataFrame, tolerance_days: int = 7) -> DataFrame:
    """Rows of ``left`` whose interval (l_start, l_end) some interval of ``right`` (r_start, r_end) overlaps.

    Whether there is one is all that counts, so no pairs are built.
    """
    ids = _met(_left_days(left.select("l_id", "l_start", "l_end")), _right_days(right, tolerance_days)).select(F.col("l_id").alias("_id")).distinct()
    return left.join(ids, F.col("l_id") == F.col("_id"), "left_semi")


def spacetime_pairs(left: DataFrame, right: DataFrame, max_km: float, tolerance_days: int = 7) -> DataFrame:
    """(l_id, r_id) that overlap in time and lie within ``max_km``; time alone decides where either has no coordinates.

    ``left``: l_id, l_start, l_end, l_lat, l_lon; ``right`` likewise with r_. The right side is exploded to the cells it
    reaches.
    """
    l_has, r_has = F.col("l_lat").isNotNull() & F.col("l_lon").isNotNull(), F.col("r_lat").isNotNull() & F.col("r_lon").isNotNull()
    near = haversine_km(F.col("l_lat"), F.col("l_lon"), F.col("r_lat"), F.col("r_lon")) <= max_km
    a = left.where(l_has).withColumn("cell", own_cell(F.col("l_lat"), F.col("l_lon"), max_km))
    b = right.where(r_has).withColumn("cell", F.explode(reached_cells(F.col("r_lat"), F.col("r_lon"), max_km)))
    placed = overlap_pairs(a, b, tolerance_days, near, ["cell"]).select("l_id", "r_id")
    timed = overlap_pairs(left.where(~l_has), right, tolerance_days).select("l_id", "r_id")
    return placed.unionByName(timed).unionByName(overlap_pairs(left.where(l_has), right.where(~r_has), tolerance_days).select("l_id", "r_id"))


def _placed_ids(left: DataFrame, right: DataFrame, max_km: float, tolerance_days: int, keep: str, keys: list[str] = []) -> DataFrame:
    """Distinct ``keep`` ids (with the keys that both sides share) that match; the time-only branches look at days, not at pairs. Left rows may have a reach of their own, ``reach_km``, at most ``max_km``."""
    l_has, r_has = F.col("l_lat").isNotNull() & F.col("l_lon").isNotNull(), F.col("r_lat").isNotNull() & F.col("r_lon").isNotNull()
    near = haversine_km(F.col("l_lat"), F.col("l_lon"), F.col("r_lat"), F.col("r_lon")) <= (F.col("reach_km") if "reach_km" in left.columns else max_km)
    a = left.where(l_has).withColumn("cell", own_cell(F.col("l_lat"), F.col("l_lon"), max_km))
    b = right.where(r_has).withColumn("cell", F.explode(reached_cells(F.col("r_lat"), F.col("r_lon"), max_km)))
    out = overlap_pairs(a, b, tolerance_days, near, [*keys, "cell"]).select(*keys, keep)
    for x, y in ((left.where(~l_has), right), (left.where(l_has), right.where(~r_has))):
        x, y = _left_days(x), _right_days(y, tolerance_days)
        out = out.unionByName(_met(*((x, y) if keep == "l_id" else (y, x)), keys).select(*keys, keep))
    return out.distinct()


def spacetime_filter(left: DataFrame, right: DataFrame, max_km: float = 250.0, tolerance_days: int = 7) -> DataFrame:
    """Rows of ``left`` with a match in ``right`` (see ``spacetime_pairs``)."""
    ids = _placed_ids(left, right, max_km, tolerance_days, "l_id").withColumnRenamed("l_id", "_id")
    return left.join(ids, F.col("l_id") == F.col("_id"), "left_semi")


def matched_ids(left: DataFrame, right: DataFrame, max_km: float = 250.0, tolerance_days: int = 7, keys: list[str] = []) -> DataFrame:
    """(keys, r_id) of rows of ``right`` that some row of ``left`` with the same keys matches."""
    return _placed_ids(left, right, max_km, tolerance_days, "r_id", keys)


def segments(vertices: DataFrame, part: str = "part_id", seq: str = "seq", x: str = "x_m", y: str = "y_m") -> DataFrame:
    """Segments of polylines: part_id, seq, x1, y1, x2, y2, s0 (distance along the part to its start) and length."""
    w = Window.partitionBy(part).orderBy(seq)
    rows = vertices.select(F.col(part).alias("part_id"), F.col(seq).alias("seq"), F.col(x).alias("x1"), F.col(y).alias("y1"), F.lead(x).over(w).alias("x2"), F.lead(y).over(w).alias("y2"))
    rows = rows.where("x2 IS NOT NULL").withColumn("length", F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")))
    along = Window.partitionBy("part_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("s0", F.coalesce(F.sum("length").over(along), F.lit(0.0)))


def part_lengths(segs: DataFrame) -> DataFrame:
    """(part_id, length_m) of parts given by ``segments``. Summed in whole nanometres, so that parts with the same segments are equally
    long, in whatever order they are read."""
    return segs.groupBy("part_id").agg(F.sum(F.col("length").cast("decimal(28,9)")).cast("double").alias("length_m"))


def _at(px, py) -> Column:
    """Share (0 to 1) of the segment at which it is nearest to a point."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    t = ((px - F.col("x1")) * dx + (py - F.col("y1")) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(t, F.lit(0.0))))


def snapped(points: DataFrame, segs: DataFrame, max_m: float, per_part: bool = False) -> DataFrame:
    """Points (pt_id, x, y) with the nearest segment's part_id, station_m and distance_m, if within ``max_m``.

    Segments are exploded to the square cells of size ``max_m`` that their widened box touches; ties go to the lower part, then
    station. With ``per_part``, the best of each part.
    """
    cell = lambda v: F.floor(v / max_m).cast("long")
    xs = F.sequence(cell(F.least("x1", "x2") - max_m), cell(F.greatest("x1", "x2") + max_m))
    ys = F.sequence(cell(F.least("y1", "y2") - max_m), cell(F.greatest("y1", "y2") + max_m))
    reach = segs.withColumn("cx", F.explode(xs)).withColumn("cy", F.explode(ys))
    both = points.withColumn("cx", cell(F.col("x"))).withColumn("cy", cell(F.col("y"))).join(reach.hint("merge"), ["cx", "cy"])
    t = _at(F.col("x"), F.col("y"))
    dx, dy = F.col("x") - (F.col("x1") + t * (F.col("x2") - F.col("x1"))), F.col("y") - (F.col("y1") + t * (F.col("y2") - F.col("y1")))
    both = both.select("pt_id", "part_id", (F.col("s0") + t * F.col("length")).alias("station_m"), F.hypot(dx, dy).alias("distance_m")).where(F.col("distance_m") <= max_m)
    group = ["pt_id", "part_id"] if per_part else ["pt_id"]
    best = F.min(F.struct("distance_m", "part_id", "station_m")).alias("b")
    return both.groupBy(*group).agg(best).select("pt_id", "b.part_id", "b.station_m", "b.distance_m")


def nearest(points: DataFrame, segs: DataFrame, first_m: float = 50_000.0, tiers: int = 8) -> DataFrame:
    """As ``snapped`` in tiers: what is missed is tried again within four times the distance, at most ``tiers`` times; beyond the last
    distance (first_m * 4 ** (tiers - 1), more than the globe's girth by default) there is no row. Returns (pt_id, part_id, station_m, distance_m)."""
    out, left, reach = None, points, first_m
    for k in range(tiers):
        found = snapped(left, segs, reach)
        out = found if out is None else out.unionByName(found)
        left = left.join(found.select("pt_id"), "pt_id", "left_anti")
        reach *= 4.0
        if k and left.isEmpty():
            break
    return out


def asof_nearest(samples: DataFrame, observed: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """Each sample with the value observed nearest along ``at`` within its keys, looking both ways; ties go back.

    A union and two window passes: no pair of sample and observation is ever built. Of observations at one place the
    greatest value counts.
    """
    seen = observed.groupBy(*keys, at).agg(F.max(value).alias("_v")).withColumn("_kind", F.lit(0))
    rows = samples.withColumn("_kind", F.lit(1)).unionByName(seen, allowMissingColumns=True)
    mark = F.when(F.col("_kind") == 0, F.struct(F.col(at).alias("at"), F.col("_v").alias("v")))
    back = Window.partitionBy(*keys).orderBy(F.col(at), F.col("_kind")).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*keys).orderBy(F.col(at).desc(), F.col("_kind")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_m", mark).withColumn("_b", F.last("_m", True).over(back)).withColumn("_a", F.last("_m", True).over(ahead))
    closer = F.when(F.col("_b").isNull() | (F.col("_a")["at"] - F.col(at) < F.col(at) - F.col("_b")["at"]), F.col("_a")["v"]).otherwise(F.col("_b")["v"])
    return rows.where("_kind = 1").withColumn(value, closer).select(*samples.columns, value)


def first_hits(origins: DataFrame, segs: DataFrame, step_deg: float = 1.0, max_m: float = 3_000_000.0, first_m: float = 200_000.0) -> DataFrame:
    """First segment hit by each ray from an origin: event_id, bearing_deg, range_m, part_id, station_m; no row without a hit.

    origins: event_id, ox, oy, in the segments' plane, and, if ranges differ, reach_m (at most ``max_m``); bearings count from the x
    axis. The search goes in rings, each four times as wide as the last: a bearing with a hit in a ring is done, and an
    origin whose bearings are all done, or whose reach ends there, meets no segment of the next ring. Ties go to the lower part, then station;
    segments along a ray are hit at their neighbours' ends.
    """
    count = round(360 / step_deg)
    reach = F.col("reach_m").cast("double") if "reach_m" in origins.columns else F.lit(float(max_m))
    left = origins.select("event_id", "ox", "oy", F.least(reach, F.lit(float(max_m))).alias("reach_m"), F.sequence(F.lit(0), F.lit(count - 1)).alias("open"))
    radius, out = min(first_m, max_m), None
    while True:
        hits = written(_hits_within(left, segs, step_deg, radius), "ray-hits")
        out = hits if out is None else out.unionByName(hits)
        if radius >= max_m:
            break
        done = hits.groupBy("event_id").agg(F.collect_set("k").alias("_done"))  # a bearing each at most
        left = left.join(done, "event_id", "left").withColumn("open", F.array_except("open", F.coalesce("_done", F.array().cast("array<int>")))).drop("_done")
        left = written(left.where((F.col("reach_m") > radius) & (F.size("open") > 0)), "open-rays")
        if left.isEmpty():
            break
        radius = min(4.0 * radius, max_m)
    return out.select("event_id", (F.col("k") * step_deg).alias("bearing_deg"), "range_m", "part_id", "station_m")


def _hits_within(origins: DataFrame, segs: DataFrame, step_deg: float, radius: float) -> DataFrame:
    """(event_id, k, range_m, part_id, station_m): the first hits of the open bearings of origins (event_id, ox, oy, reach_m, open) up to ``radius``.

    Segments are exploded to the cells of that size that their box touches, origins to the 3 x 3 cells round their own; a pair is exploded
    to the bearings that the segment spans, and the nearest hit is taken before the shuffle as well as after.
    """
    cell = lambda v: F.floor(v / radius).cast("long")
    around = F.sequence(F.lit(-1), F.lit(1))
    near = origins.withColumn("_dx", F.explode(around)).withColumn("_dy", F.explode(around)).select("event_id", "ox", "oy", "reach_m", "open", (cell(F.col("ox")) + F.col("_dx")).alias("cx"), (cell(F.col("oy")) + F.col("_dy")).alias("cy"))
    first = lambda axis: cell(F.least(f"{axis}1", f"{axis}2"))
    reach = segs.withColumn("cx", F.explode(F.sequence(first("x"), cell(F.greatest("x1", "x2"))))).withColumn("cy", F.explode(F.sequence(first("y"), cell(F.greatest("y1", "y2")))))
    ax, ay, dx, dy = F.col("x1") - F.col("ox"), F.col("y1") - F.col("oy"), F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    both = near.join(reach.hint("merge"), ["cx", "cy"])
    one = (F.col("cx") == F.greatest(cell(F.col("ox")) - 1, first("x"))) & (F.col("cy") == F.greatest(cell(F.col("oy")) - 1, first("y")))
    both = both.where(one)  # the first shared cell stands for all
    start = F.degrees(F.atan2(ay, ax))
    turn = F.degrees(F.atan2(ax * (ay + dy) - ay * (ax + dx), ax * (ax + dx) + ay * (ay + dy)))
    lo, hi = start + F.least(F.lit(0.0), turn), start + F.greatest(F.lit(0.0), turn)
    low, high = F.ceil(lo / step_deg - 1e-6).cast("int"), F.floor(hi / step_deg + 1e-6).cast("int")
    n = round(360 / step_deg)
    rays = both.where(low <= high).withColumn("k", F.explode(F.sequence(low, high))).withColumn("k", F.pmod("k", F.lit(n))).where(F.array_contains("open", F.col("k")))
    cb, sb = F.cos(F.radians(F.col("k") * step_deg)), F.sin(F.radians(F.col("k") * step_deg))
    cross = F.nullif(cb * dy - sb * dx, F.lit(0.0))
    rays = rays.withColumn("range_m", (ax * dy - ay * dx) / cross).withColumn("_u", (ax * sb - ay * cb) / cross)
    rays = rays.where((F.col("_u") >= -1e-9) & (F.col("_u") <= 1 + 1e-9) & (F.col("range_m") >= 0) & (F.col("range_m") <= F.least(F.lit(float(radius)), "reach_m")))
    best = F.min(F.struct("range_m", "part_id", (F.col("s0") + F.col("_u") * F.col("length")).alias("station_m"))).alias("b")
    return rays.groupBy("event_id", "k").agg(best).select("event_id", "k", "b.range_m", "b.part_id", "b.station_m")


def near_pairs(left: DataFrame, right: DataFrame, max_m: float, extra: Column | None = None, keys: list[str] = []) -> DataFrame:
    """Pairs of ``left`` (x, y) and ``right`` (x2, y2) at most ``max_m`` apart, with distance_m; equal in ``keys``.

    The right side is exploded to the 3 x 3 cells of that size round each point.
    """
    cell = lambda v: F.floor(F.col(v) / max_m).cast("long")
    around = F.sequence(F.lit(-1), F.lit(1))
    b = right.withColumn("_dx", F.explode(around)).withColumn("_dy", F.explode(around)).withColumn("_cx", cell("x2") + F.col("_dx")).withColumn("_cy", cell("y2") + F.col("_dy")).drop("_dx", "_dy")
    both = left.withColumn("_cx", cell("x")).withColumn("_cy", cell("y")).join(b.hint("merge"), [*keys, "_cx", "_cy"])
    both = both.withColumn("distance_m", F.hypot(F.col("x") - F.col("x2"), F.col("y") - F.col("y2"))).where(F.col("distance_m") <= max_m)
    return (both if extra is None else both.where(extra)).drop("_cx", "_cy")
