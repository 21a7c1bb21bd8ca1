"""Tsunami run-ups: decay of heights with distance, alongshore segments, infill, coverage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilframe.functions import scalars as S
from perilframe.io import shared_dir, written
from perilframe.operators import cover, joins, sequence
from perilframe.plans import infill


def runup_envelope(runups: DataFrame, bin_km: float = 250.0, q: float = 0.9, least_n: int = 10, keys: list[str] = []) -> DataFrame:
    """(keys, bin, n, d, q): quantile of heights in distance bins; a bin with few run-ups is merged with the next one.

    runups: keys, d_km, h. The merge walks the bins in order (an ordered fold over a few dozen bins); heights of a merged pair
    are pooled, so the quantile is of both.
    """
    rows = runups.where("d_km >= 0 AND h > 0").withColumn("bin", F.floor(F.col("d_km") / bin_km).cast("int"))
    sizes = rows.groupBy(*keys, "bin").agg(F.count(F.lit(1)).cast("int").alias("n"))
    walk = sizes.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("bin", "n"))).alias("v"))

    def fold(acc, x):
        last = F.element_at(acc, -1)
        # a small bin takes the next one along; a bin that was taken stands for the pair and takes no other
        takes = (F.size(acc) > 0) & (last["n"] < least_n) & (last["bin"] == last["into"]) & (x["bin"] == last["bin"] + 1) & ~last["full"]
        into = F.when(takes, last["into"]).otherwise(x["bin"])
        return F.concat(acc, F.array(F.struct(x["bin"].alias("bin"), x["n"].alias("n"), into.alias("into"), takes.alias("full"))))

    start = F.array().cast("array<struct<bin:int,n:int,into:int,full:boolean>>")
    plan = walk.select(*keys, F.inline(F.aggregate("v", start, fold))).select(*keys, "bin", "into")
    pooled = rows.join(plan, [*keys, "bin"]).groupBy(*keys, "into").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("bin").alias("bins"), F.expr(f"percentile(h, {q})").alias("q"))
    kept = pooled.where((F.col("bins") > 1) | (F.col("n") >= least_n))
    d = (F.col("into") + 0.5 + (F.col("bins") - 1) * 0.5) * bin_km
    return kept.select(*keys, F.col("into").alias("bin"), "n", d.alias("d"), "q")


def decay_fit(envelope: DataFrame, least_h: float = 0.0, keys: list[str] = [], among: DataFrame | None = None) -> DataFrame:
    """One row, or one for each of ``keys``: slope, intercept, r2 of ln(q) over distance, R0 = 1/decay clamped to 500..5000 km, search radius 3 R0
    clamped to 2000..10000; 1500 and 3000 where there are fewer than two bins or no decay. among: keys that get a row in any case."""
    y = F.log(F.col("q") + 1e-6)
    fit = envelope.where(F.col("q") > least_h).groupBy(*keys).agg(F.count(F.lit(1)).alias("bins"), F.regr_slope(y, F.col("d")).alias("slope"), F.regr_intercept(y, F.col("d")).alias("intercept"), F.regr_r2(y, F.col("d")).alias("r2"))
    if among is not None:
        fit = among.select(*keys).distinct().join(fit, keys, "left").withColumn("bins", F.coalesce("bins", F.lit(0)))
    ok = (F.col("bins") >= 2) & (F.col("slope") < 0)
    r0 = F.when(ok, F.greatest(F.lit(500.0), F.least(F.lit(5000.0), -1.0 / F.col("slope")))).otherwise(1500.0)
    search = F.when(ok, F.greatest(F.lit(2000.0), F.least(F.lit(10000.0), 3.0 * r0))).otherwise(3000.0)
    return fit.select(*keys, "bins", "slope", "intercept", "r2", r0.alias("r0_km"), search.alias("search_km"))


def runup_segments(snapped: DataFrame, lengths: DataFrame, gap_m: float = 1000.0) -> DataFrame:
    """Height-sized alongshore intervals (event_id, part_id, s0, s1, n), clamped to the part and merged.

    snapped: event_id, part_id, station_m, h; lengths: part_id, length_m.
    """
    half = S.runup_length_km(F.col("h")) * 500.0
    rows = snapped.join(lengths, "part_id").select("event_id", "part_id", F.greatest(F.lit(0.0), F.col("station_m") - half).alias("s0"), F.least(F.col("length_m"), F.col("station_m") + half).alias("s1"))
    return sequence.merge_intervals(rows.where("s1 > s0"), ["event_id", "part_id"], gap_m)


def events_snapped(runups: DataFrame, vertices: DataFrame, max_m: float = 25_000.0) -> DataFrame:
    """Run-ups on their nearest coast part: runup_id, event_id, part_id, station_m, distance_m, h.

    Both sides of the join grow with the run-ups, so it is a sort-merge join by hint: their columns make small files, which would be broadcast."""
    pts = runups.select(F.col("runup_id").alias("pt_id"), F.col("x_m").alias("x"), F.col("y_m").alias("y"))
    near = joins.snapped(pts, joins.segments(vertices), max_m)
    return runups.join(near.hint("merge"), runups["runup_id"] == near["pt_id"]).select("runup_id", F.col("tsunami_event_id").alias("event_id"), "part_id", "station_m", "distance_m", F.col("runup_ht").alias("h"))


def inland_cover(segments: DataFrame, snapped: DataFrame, segs: DataFrame, res_m: float, step_m: float = 250.0, land: DataFrame | None = None) -> DataFrame:
    """(event_id, cx, cy): cells within reach inland of an event's segments, by the nearest run-up height along the part.

    segments: event_id, part_id, s0, s1, sampled every ``step_m`` at most; snapped: event_id, part_id, station_m, h; land: cx, cy.
    """
    length = F.col("s1") - F.col("s0")
    rows = segments.where("s1 > s0").select("event_id", "part_id", "s0", "s1").withColumn("_n", F.greatest(F.lit(2), F.ceil(length / step_m).cast("int")))
    rows = rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).select("event_id", "part_id", (F.col("s0") + F.col("i") * length / (F.col("_n") - 1)).alias("station_m")).distinct()
    heights = joins.asof_nearest(rows, snapped.select("event_id", "part_id", "station_m", "h"), ["event_id", "part_id"], "station_m", "h")
    discs = sequence.located(segs, heights).select("event_id", "x", "y", (S.inland_km(F.col("h")) * 1000.0).alias("r_m"))
    out = cover.union(cover.disc_cover(discs, res_m, ["event_id"]), ["event_id"])
    return out if land is None else cover.clip(out, land)


def hit_segments(hits: DataFrame, lengths: DataFrame, expand_km: float = 125.0, base_km: float = 20.0, per_1000_km: float = 40.0) -> DataFrame:
    """(event_id, part_id, s0, s1): alongshore intervals about ray hits, merged by a gap that grows with their range, within the part.

    hits: event_id, part_id, station_m, range_m; lengths: part_id, length_m.
    """
    half = expand_km * 500.0
    rows = hits.select("event_id", "part_id", (F.col("station_m") - half).alias("s0"), (F.col("station_m") + half).alias("s1"), (F.col("range_m") / 1000.0).alias("range_km"))
    merged = sequence.merge_intervals_variable(rows, ["event_id", "part_id"], base_km, per_1000_km).join(lengths, "part_id")
    merged = merged.select("event_id", "part_id", F.greatest(F.lit(0.0), "s0").alias("s0"), F.least("length_m", "s1").alias("s1"))
    return merged.where("s1 > s0")


def hit_density_cover(hits: DataFrame, segs: DataFrame, lengths: DataFrame, res_m: float, window_km: float = 1000.0, k: float = 0.02, least_km: float = 0.1, cap_km: float = 1.0, step_m: float = 250.0, land: DataFrame | None = None) -> DataFrame:
    """(event_id, cx, cy): cells within reach of the parts that an event's rays hit, the reach in proportion to the hits' weight
    in a window along the coast. hits: event_id, part_id, station_m, weight."""
    samples = hits.select("event_id", "part_id").distinct().join(sequence.stations(lengths, step_m, up=False), "part_id")
    dense = sequence.density(hits, samples, window_km * 1000.0, ("event_id", "part_id"))
    reach = F.greatest(F.lit(least_km), F.least(F.lit(cap_km), k * F.col("sum_weight") / max(1.0, window_km)))
    discs = sequence.located(segs, dense.select("event_id", "part_id", "station_m", (reach * 1000.0).alias("r_m")))
    out = cover.union(cover.disc_cover(discs, res_m, ["event_id"]), ["event_id"])
    return out if land is None else cover.clip(out, land)


def buffer_on_land(lines: DataFrame, res_m: float, width_m: float = 1000.0, land: DataFrame | None = None, coast: DataFrame | None = None, coast_km: float | None = None) -> DataFrame:
    """(event_id, cx, cy): cells within ``width_m`` of an event's lines, on land. lines: event_id, x1, y1, x2, y2.

    Without a land mask, land is what lies within ``coast_km`` of the ``coast`` segments; without either, everything is.
    """
    out = cover.line_cover(lines, width_m, res_m, ["event_id"])
    if land is None and coast is not None and coast_km is not None:
        land = cover.line_cover(coast, coast_km * 1000.0, res_m, [])
    return out if land is None else cover.clip(out, land)


def lines_of(segments: DataFrame, segs: DataFrame) -> DataFrame:
    """(event_id, x1, y1, x2, y2): the pieces of coast under an event's segments."""
    cuts = sequence.cut(segs, segments.select("part_id", "s0", "s1").distinct())
    both = segments.select("event_id", F.col("part_id").alias("_p"), "s0", "s1").join(cuts, (F.col("_p") == F.col("part_id")) & (F.col("s0") == F.col("i0")) & (F.col("s1") == F.col("i1")))
    return both.where("to_m > from_m").select("event_id", F.col("xa").alias("x1"), F.col("ya").alias("y1"), F.col("xb").alias("x2"), F.col("yb").alias("y2"))


def event_origins(runups: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """(event_id, ox, oy): of each event with run-ups, the place that ``events`` gives (longitude and latitude before lon and lat, before x and y;
    names in any case; of several rows the least), or else the mean of its run-ups. Ids compare as trimmed text."""
    means = runups.groupBy(F.col("tsunami_event_id").alias("event_id")).agg(F.avg("x_m").alias("mx"), F.avg("y_m").alias("my"))
    if events is None:
        return means.select("event_id", F.col("mx").alias("ox"), F.col("my").alias("oy"))
    names = {n.lower(): n for n in events.columns}
    first = lambda *wanted: next((names[n] for n in wanted if n in names), None)
    x, y, key = first("longitude", "lon", "x", "x_m"), first("latitude", "lat", "y", "y_m"), first("event_id", "id", "tsunamieventid")
    if not (x and y and key):
        raise ValueError("events need an id and two coordinates")
    at = events.select(F.lower(F.trim(F.col(key).cast("string"))).alias("_key"), F.col(x).cast("double").alias("ex"), F.col(y).cast("double").alias("ey")).where("ex IS NOT NULL AND ey IS NOT NULL")
    at = at.groupBy("_key").agg(F.min(F.struct("ex", "ey")).alias("e"))
    rows = means.withColumn("_key", F.lower(F.trim(F.col("event_id").cast("string")))).join(at, "_key", "left")
    return rows.select("event_id", F.coalesce("e.ex", "mx").alias("ox"), F.coalesce("e.ey", "my").alias("oy"))


def layers(runups: DataFrame, vertices: DataFrame, res_m: float = 2000.0, max_snap_m: float = 25_000.0, step_deg: float = 1.0, sample_m: float = 250.0, conservative_km: float = 12.0, land: DataFrame | None = None, events: DataFrame | None = None, infill_cap_m: float = 250_000.0) -> dict[str, DataFrame]:
    """The layers of all tsunami events in one pass, ``event_id`` in each: origin, snapped and rejected run-ups, their segments
    and infill, ray hits and their segments, impact covers of both, their union, and a conservative cover about all segments.

    An event's layers don't depend on the others: its decay length and search range are fitted on its own snapped run-ups by their distance
    from its origin (see ``event_origins``). The infill is rule-based, with low run-ups and ray hits as amplifiers.
    """
    segs = written(joins.segments(vertices), "coast-segments")
    lengths = joins.part_lengths(segs)
    snapped = written(events_snapped(runups, vertices, max_snap_m), "snapped")
    origin = written(event_origins(runups, events), "origins")
    near = snapped.select("runup_id", "h").join(runups, "runup_id").withColumnRenamed("tsunami_event_id", "event_id")
    far = near.join(origin, "event_id").select("event_id", (F.hypot(F.col("x_m") - F.col("ox"), F.col("y_m") - F.col("oy")) / 1000.0).alias("d_km"), "h")
    fit = written(decay_fit(runup_envelope(far, keys=["event_id"]), keys=["event_id"], among=origin), "decay")
    base = written(runup_segments(snapped, lengths), "runup-segments")
    hits = joins.first_hits(origin.join(fit.select("event_id", (F.col("search_km") * 1000.0).alias("reach_m")), "event_id"), segs, step_deg, 10_000_000.0)
    found = infill.rulebased_decisions(base, infill.amplifiers(infill.low_runups(snapped), hits), infill_cap_m)
    bridges = written(infill.rulebased_bridges(found), "infill")
    weighted = hits.join(fit.select("event_id", "r0_km"), "event_id").withColumn("weight", S.decay_weight(F.col("range_m") / 1000.0, F.col("r0_km")))
    every = base.select("event_id", "part_id", "s0", "s1").unionByName(bridges)
    ray_segments = hit_segments(hits, lengths)
    impact, ray_impact = inland_cover(every, snapped, segs, res_m, sample_m, land), hit_density_cover(weighted, segs, lengths, res_m, step_m=sample_m, land=land)
    both = base.select("event_id", "part_id", "s0", "s1").unionByName(ray_segments)
    return {
        "origin": origin, "runups_snapped": snapped, "runups_rejected": runups.join(snapped.select("runup_id"), "runup_id", "left_anti"),
        "runups_segments": base, "runups_infill": bridges, "runups_impact": impact, "rays_hits": hits, "rays_segments": ray_segments, "rays_impact": ray_impact,
        "merged_impact": cover.union(impact.unionByName(ray_impact), ["event_id"]), "merged_conservative": buffer_on_land(lines_of(both, segs), res_m, conservative_km * 1000.0, land),
    }


def written_layers(found: dict[str, DataFrame], path: str | None = None) -> dict[str, DataFrame]:
    """Each layer as a Parquet folder of its name under ``path`` (a new one of the shared folder), read back."""
    spark = next(iter(found.values())).sparkSession
    path = path or f"{shared_dir(spark)}/tsunami-{uuid.uuid4().hex}"
    for name, df in found.items():
        df.write.parquet(f"{path}/{name}")
    return {name: spark.read.schema(df.schema).parquet(f"{path}/{name}") for name, df in found.items()}
