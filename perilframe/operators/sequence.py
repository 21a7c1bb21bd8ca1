"""Ordered-sequence operators: islands, gaps, smoothing, densifying, linear referencing. Windows are per key (part, track)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def merge_intervals(df: DataFrame, keys: list[str], gap: float = 0.0, start: str = "s0", end: str = "s1") -> DataFrame:
    """Intervals merged where the gap to what came before is at most ``gap``: keys, start, end, n."""
    df = df.groupBy(*keys, start, end).agg(F.count(F.lit(1)).alias("_n"))  # equal intervals would be a tie in the order
    w = Window.partitionBy(*keys).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = df.withColumn("_new", F.when(F.col(start) - before <= gap, 0).otherwise(1))
    rows = rows.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end), F.sum("_n").alias("n")).drop("_island")


def merge_intervals_variable(df: DataFrame, keys: list[str], base_km: float = 20.0, per_1000_km: float = 40.0) -> DataFrame:
    """Intervals (s0, s1, range_km) merged by a gap that grows with the mean of the running and the next range.

    The running mean depends on all merges so far, so this is an ordered fold over one key's intervals.
    """
    item = F.array_sort(F.collect_list(F.struct("s0", "s1", "range_km")))

    def fold(acc, x):
        last = F.element_at(acc, -1)
        allow = (base_km + per_1000_km * ((x["range_km"] + last["range_km"]) / 2.0 / 1000.0)) * 1000.0
        joined = F.struct(last["s0"].alias("s0"), F.greatest(last["s1"], x["s1"]).alias("s1"), ((last["range_km"] + x["range_km"]) / 2.0).alias("range_km"))
        return F.when(x["s0"] - last["s1"] <= allow, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(joined))).otherwise(F.concat(acc, F.array(x)))

    rows = df.groupBy(*keys).agg(item.alias("v"))
    return rows.select(*keys, F.inline(F.aggregate(F.slice("v", 2, F.greatest(F.size("v") - 1, F.lit(0))), F.slice("v", 1, 1), fold)))


def gaps(merged: DataFrame, keys: list[str], lengths: DataFrame | None = None) -> DataFrame:
    """Gaps (g0, g1) between a key's disjoint intervals (s0, s1); with lengths (part_id, length_m) also a part's head and tail."""
    w = Window.partitionBy(*keys).orderBy("s0")
    if lengths is not None:  # ends without extent stand before the first interval and behind the last
        keyed = merged.select(*keys).distinct().join(lengths, "part_id")
        ends = keyed.select(*keys, F.inline(F.array(F.struct(F.lit(0.0).alias("s0"), F.lit(0.0).alias("s1")), F.struct(F.col("length_m").alias("s0"), F.col("length_m").alias("s1")))))
        w = Window.partitionBy(*keys).orderBy("s0", "s1")
        rows = merged.select(*keys, "s0", "s1").unionByName(ends).withColumn("g0", F.max("s1").over(w)).withColumn("g1", F.lead("s0").over(w))
        return rows.where("g1 > g0").select(*keys, "g0", "g1")
    return merged.withColumn("g1", F.lead("s0").over(w)).where("g1 IS NOT NULL").select(*keys, F.col("s1").alias("g0"), "g1")


def cluster_1d(df: DataFrame, keys: list[str], at: str, eps: float) -> DataFrame:
    """Adds ``cluster`` (from 1): a new one after each step over ``eps``."""
    w = Window.partitionBy(*keys).orderBy(at)
    rows = df.withColumn("_new", F.when(F.col(at) - F.lag(at).over(w) <= eps, 0).otherwise(1))
    return rows.withColumn("cluster", F.sum("_new").over(w.rangeBetween(Window.unboundedPreceding, 0))).drop("_new")


def smooth_3pt(column: str, w) -> Column:
    """Weights 1/4, 1/2, 1/4, renormalised over what isn't null."""
    parts = [(F.lag(column).over(w), 0.25), (F.col(column), 0.5), (F.lead(column).over(w), 0.25)]
    total = sum((F.when(v.isNotNull(), F.lit(k)).otherwise(0.0) for v, k in parts), F.lit(0.0))
    return sum((F.coalesce(v * k, F.lit(0.0)) for v, k in parts), F.lit(0.0)) / F.nullif(total, F.lit(0.0))


def unwrap_lon(column: str, w) -> Column:
    """Adds the turns that make a longitude sequence continuous; needs the step flags as a column first."""
    step = F.col(column) - F.lag(column).over(w)
    return F.when(step > 180, -360.0).when(step < -180, 360.0).otherwise(0.0)


def unwrapped(df: DataFrame, keys: list[str], order: list[str], lon: str = "lon") -> DataFrame:
    """Adds ``lon_unwrapped``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    rows = df.withColumn("_turn", unwrap_lon(lon, w))
    return rows.withColumn("lon_unwrapped", F.col(lon) + F.sum("_turn").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_turn")


def track_seam(df: DataFrame, key: str = "sid", lon: str = "lon") -> DataFrame:
    """(key, gap, seam): the widest empty stretch of longitude round the globe, and its middle; ties go west."""
    w = Window.partitionBy(key).orderBy("x")
    rows = df.select(key, F.pmod(F.col(lon), F.lit(360.0)).alias("x")).distinct()
    rows = rows.withColumn("_next", F.coalesce(F.lead("x").over(w), F.min("x").over(Window.partitionBy(key)) + 360.0))
    best = F.max(F.struct((F.col("_next") - F.col("x")).alias("gap"), (-F.col("x")).alias("x"))).alias("b")
    rows = rows.groupBy(key).agg(best)
    mid = F.pmod(-F.col("b.x") + F.col("b.gap") / 2.0 + 180.0, F.lit(360.0)) - 180.0
    return rows.select(key, F.col("b.gap").alias("gap"), mid.alias("seam"))


def densified(df: DataFrame, key: str, order: list[str], step: float, x: str, y: str, length: Column) -> DataFrame:
    """Points between a row and the next of its key, at most ``step`` apart: key, leg, i, x, y. ``length`` uses _x2 and _y2."""
    w = Window.partitionBy(key).orderBy(*order)
    rows = df.withColumn("leg", F.row_number().over(w)).withColumn("_x2", F.lead(x).over(w)).withColumn("_y2", F.lead(y).over(w)).where("_x2 IS NOT NULL")
    rows = rows.withColumn("_n", F.greatest(F.lit(1), F.ceil(length / step).cast("int"))).withColumn("i", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    t = F.col("i") / F.col("_n")
    return rows.select(key, "leg", "i", (F.col(x) + t * (F.col("_x2") - F.col(x))).alias("x"), (F.col(y) + t * (F.col("_y2") - F.col(y))).alias("y"))


def located(segs: DataFrame, stations: DataFrame) -> DataFrame:
    """Points (x, y) at stations (part_id, station_m) along parts, stations clamped to the part.

    As of the segment start before each station: a union and a window, no range join.
    """
    w = Window.partitionBy("part_id").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    seg = segs.select("part_id", F.col("s0").alias("_at"), F.lit(0).alias("_kind"), F.struct("s0", "length", "x1", "y1", "x2", "y2").alias("_g"))
    rows = stations.withColumn("_at", F.greatest(F.col("station_m"), F.lit(0.0))).withColumn("_kind", F.lit(1)).unionByName(seg, allowMissingColumns=True)
    rows = rows.withColumn("_g", F.last("_g", True).over(w)).where("_kind = 1 AND _g IS NOT NULL")
    t = F.least(F.lit(1.0), (F.col("_at") - F.col("_g.s0")) / F.nullif(F.col("_g.length"), F.lit(0.0)))
    t = F.coalesce(t, F.lit(0.0))
    return rows.select(*stations.columns, (F.col("_g.x1") + t * (F.col("_g.x2") - F.col("_g.x1"))).alias("x"), (F.col("_g.y1") + t * (F.col("_g.y2") - F.col("_g.y1"))).alias("y"))


def cut(segs: DataFrame, intervals: DataFrame) -> DataFrame:
    """Pieces of segments inside intervals (part_id, s0, s1) of their part: part_id, i0, i1, seq, from_m, to_m, with end points."""
    iv = intervals.select("part_id", F.col("s0").alias("i0"), F.col("s1").alias("i1"))
    rows = segs.join(iv, "part_id").where("i0 < s0 + length AND i1 > s0")
    a, b = F.greatest("i0", "s0"), F.least(F.col("i1"), F.col("s0") + F.col("length"))
    at = lambda v, s: F.col(f"{v}1") + (s - F.col("s0")) / F.col("length") * (F.col(f"{v}2") - F.col(f"{v}1"))
    return rows.select("part_id", "i0", "i1", "seq", a.alias("from_m"), b.alias("to_m"), at("x", a).alias("xa"), at("y", a).alias("ya"), at("x", b).alias("xb"), at("y", b).alias("yb"))


def stations(lengths: DataFrame, step_m: float, up: bool = True) -> DataFrame:
    """Evenly spaced stations of parts (part_id, length_m), both ends included: part_id, i, station_m. Their number is the
    length over the step, rounded up or down, and two at least."""
    n = (F.ceil if up else F.floor)(F.col("length_m") / step_m).cast("int")
    rows = lengths.withColumn("_n", F.greatest(F.lit(2), n)).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return rows.select("part_id", "i", (F.col("i") * F.col("length_m") / (F.col("_n") - 1)).alias("station_m"))


def density(hits: DataFrame, samples: DataFrame, window_m: float, keys: tuple[str, ...] = ("part_id",)) -> DataFrame:
    """Samples (keys, i, station_m) with the weight of their keys' hits (keys, station_m, weight) within half a window either way."""
    rows = samples.withColumn("weight", F.lit(0.0)).withColumn("_kind", F.lit(1)).unionByName(hits.select(*keys, "station_m", "weight", F.lit(0).alias("_kind")), allowMissingColumns=True)
    half = float(window_m) / 2
    near = F.expr(f"sum(weight) OVER (PARTITION BY {', '.join(keys)} ORDER BY station_m RANGE BETWEEN {half}D PRECEDING AND {half}D FOLLOWING)")
    return rows.withColumn("sum_weight", near).where("_kind = 1").select(*keys, "i", "station_m", "sum_weight")


def hysteresis(df: DataFrame, key: str, order: list[str], margin: float = 0.08, keep: list[str] = []) -> DataFrame:
    """Chosen method per step: the best candidate, but the last one while it is there and less than ``margin`` worse.

    ``df``: key, order columns, candidates (array of structs method, conf) and the columns ``keep``, which are carried along. Only
    where another candidate comes that near to the best one does a step depend on the last; tracks with such a step are folded in order, the
    others are left as they are. All rows of a key stay in its partition.
    """
    best = F.array_max(F.transform("candidates", lambda c: F.struct(c["conf"].alias("conf"), c["method"].alias("method"))))
    rows = df.where(F.size("candidates") > 0).withColumn("_b", best)
    near = F.exists("candidates", lambda c: ((c["method"] != F.col("_b.method")) | (c["conf"] != F.col("_b.conf"))) & (F.col("_b.conf") - c["conf"] < margin))
    rows = rows.select(key, *order, F.col("_b.method").alias("method"), F.col("_b.conf").alias("conf"), F.when(near, F.col("candidates")).alias("_near"), *keep)
    step = rows.drop(key).columns
    grouped = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*step))).alias("s"), F.max(F.col("_near").isNotNull()).alias("_open"))

    def fold(acc, s):
        prev = F.get(F.filter(s["_near"], lambda c: c["method"] == F.element_at(acc, -1)["method"]), F.lit(0))
        held = F.coalesce(prev.isNotNull() & (s["conf"] - prev["conf"] < margin), F.lit(False))
        chosen = {"method": F.when(held, prev["method"]).otherwise(s["method"]), "conf": F.when(held, prev["conf"]).otherwise(s["conf"])}
        return F.concat(acc, F.array(F.struct(*(chosen.get(n, s[n]).alias(n) for n in step))))

    folded = F.aggregate(F.slice("s", 2, F.greatest(F.size("s") - 1, F.lit(0))), F.slice("s", 1, 1), fold)
    return grouped.select(key, F.inline(F.when(F.col("_open"), folded).otherwise(F.col("s")))).drop("_near")


def in_band(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows with low <= value < high."""
    return df.where((F.col(column) >= low) & (F.col(column) < high))


def longest_part(lengths: DataFrame, key: str) -> DataFrame:
    """(key, part_id, length_m): the longest part of each group, the first of equals."""
    best = F.max(F.struct("length_m", (-F.col("part_id")).alias("p"))).alias("b")
    return lengths.groupBy(key).agg(best).select(key, (-F.col("b.p")).alias("part_id"), F.col("b.length_m").alias("length_m"))


def asof(rows: DataFrame, seen: DataFrame, keys: list[str], at: str, name: str, ahead: bool = False, strict: bool = False) -> DataFrame:
    """Adds ``name``: a struct of the columns of the last row of ``seen`` (keys, _at, others) at or before each row's ``at``, or of the
    first one at or after it (``ahead``); ``strict`` leaves out equal places. Null where there is none. Of several rows at one
    place the greatest counts. A union and a window, no range join.
    """
    marks = seen.select(*keys, F.col("_at"), F.struct(*(c for c in seen.columns if c not in keys)).alias("_g")).groupBy(*keys, "_at").agg(F.max("_g").alias(name))
    both = rows.withColumn("_at", F.col(at).cast("double")).withColumn("_kind", F.lit(1)).unionByName(marks.withColumn("_kind", F.lit(2 if strict else 0)), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(F.desc("_at") if ahead else F.asc("_at"), "_kind").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(name, F.last(name, True).over(w)).where("_kind = 1").select(*rows.columns, name)
