"""Footprint set algebra on covers: a footprint is its cells on a square grid, so set operations are joins on the cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def disc_cover(discs: DataFrame, res_m: float, keep: list[str]) -> DataFrame:
    """Cells (cx, cy) whose centre lies in a disc (x, y, r_m). Rows first, then each row's chord, so no cell is tried in vain."""
    row = F.explode(F.sequence(F.ceil((F.col("y") - F.col("r_m")) / res_m - 0.5).cast("long"), F.floor((F.col("y") + F.col("r_m")) / res_m - 0.5).cast("long")))
    rows = discs.where(F.col("r_m") >= res_m / 2).withColumn("cy", row)
    chord = F.sqrt(F.greatest(F.lit(0.0), F.pow("r_m", 2) - F.pow((F.col("cy") + 0.5) * res_m - F.col("y"), 2)))
    lo, hi = F.ceil((F.col("x") - chord) / res_m - 0.5).cast("long"), F.floor((F.col("x") + chord) / res_m - 0.5).cast("long")
    return rows.withColumn("_lo", lo).withColumn("_hi", hi).where("_lo <= _hi").withColumn("cx", F.explode(F.sequence("_lo", "_hi"))).select(*keep, "cx", "cy")


def union(cover: DataFrame, keys: list[str]) -> DataFrame:
    return cover.select(*keys, "cx", "cy").distinct()


def area_km2(cover: DataFrame, keys: list[str], res_m: float) -> DataFrame:
    """Cells and area of each footprint's union."""
    return union(cover, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("cells"), (F.count(F.lit(1)) * (res_m * res_m / 1e6)).alias("area_km2"))


def clip(cover: DataFrame, mask: DataFrame) -> DataFrame:
    """Cells that the mask (cx, cy) has."""
    return cover.join(mask.select("cx", "cy").distinct(), ["cx", "cy"], "left_semi")


def minus(cover: DataFrame, mask: DataFrame) -> DataFrame:
    """Cells that the mask doesn't have."""
    return cover.join(mask.select("cx", "cy").distinct(), ["cx", "cy"], "left_anti")


def line_cover(segs: DataFrame, width_m: float, res_m: float, keep: list[str]) -> DataFrame:
    """Cells (cx, cy) whose centre lies within ``width_m`` of a segment (x1, y1, x2, y2), once for each ``keep``.

    Rows first, then in each row the stretch between the outermost points of the strip's two sides and of the discs about its ends (the
    shape is convex, so it is one stretch): the work goes with the cells that are found, however a segment runs.
    """
    low = F.ceil((F.least("y1", "y2") - width_m) / res_m - 0.5).cast("long")
    high = F.floor((F.greatest("y1", "y2") + width_m) / res_m - 0.5).cast("long")
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    norm = F.nullif(F.hypot(dx, dy), F.lit(0.0))
    rows = segs.withColumn("_nx", -dy / norm * width_m).withColumn("_ny", dx / norm * width_m).withColumn("cy", F.explode(F.sequence(low, high)))
    y, xs = (F.col("cy") + 0.5) * res_m, []
    for k in ("1", "2"):
        away = y - F.col(f"y{k}")
        chord = F.when(F.abs(away) <= width_m, F.sqrt(F.greatest(F.lit(0.0), width_m * width_m - away * away)))
        xs += [F.col(f"x{k}") - chord, F.col(f"x{k}") + chord]
    for sign in (1.0, -1.0):
        t = (y - F.col("y1") - sign * F.col("_ny")) / F.nullif(dy, F.lit(0.0))
        xs.append(F.when(t.between(0.0, 1.0), F.col("x1") + sign * F.col("_nx") + t * dx))
    rows = rows.withColumn("_from", F.least(*xs)).withColumn("_to", F.greatest(*xs)).where("_from IS NOT NULL")
    rows = rows.withColumn("cx", F.explode(F.sequence(F.floor(F.col("_from") / res_m - 0.5).cast("long"), F.ceil(F.col("_to") / res_m - 0.5).cast("long"))))
    px, py = (F.col("cx") + 0.5) * res_m, (F.col("cy") + 0.5) * res_m
    t = F.coalesce(((px - F.col("x1")) * dx + (py - F.col("y1")) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    near = F.hypot(px - F.col("x1") - t * dx, py - F.col("y1") - t * dy) <= width_m
    return union(rows.where(near), keep)
