"""Polygons: covers by scan lines, points in polygons by cells, splits at the antimeridian.

A polygon is one or more rings (arrays of structs x, y, closed or not) under one key; by parity, a ring inside another is a hole. Grid
cells are squares of size ``res``; cell (cx, cy) has its centre at ((cx + 0.5) * res, (cy + 0.5) * res). Work goes by edges and
grid rows, each a row of a table, so that a polygon of any number of vertices is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def edges(rings: DataFrame, keys: list[str], ring: str = "ring") -> DataFrame:
    """(keys, x1, y1, x2, y2): the sides of rings, the closing one included; sides without extent, and those with null or non-finite ends, are left out."""
    v = F.col(ring)
    both = F.zip_with(v, F.concat(F.slice(v, 2, F.greatest(F.size(v) - 1, F.lit(0))), F.slice(v, 1, 1)), lambda p, q: F.struct(p["x"].cast("double").alias("x1"), p["y"].cast("double").alias("y1"), q["x"].cast("double").alias("x2"), q["y"].cast("double").alias("y2")))
    rows = rings.where(F.size(v) >= 3).select(*keys, F.inline(both))
    there = F.lit(True)
    for name in ("x1", "y1", "x2", "y2"):
        there = there & F.coalesce(F.abs(F.col(name)) < float("inf"), F.lit(False)) & ~F.isnan(name)
    return rows.where(there & ~((F.col("x1") == F.col("x2")) & (F.col("y1") == F.col("y2"))))


def crossings(sides: DataFrame, keys: list[str], res: float) -> DataFrame:
    """(keys, cy, x): where sides cross the middle line of each grid row; a side holds its lower end, not its upper one."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    first, last = F.ceil(low / res - 0.5).cast("long"), F.ceil(high / res - 0.5).cast("long") - 1
    rows = sides.where(first <= last).withColumn("cy", F.explode(F.sequence(first, last)))
    y = (F.col("cy") + 0.5) * res
    return rows.select(*keys, "cy", (F.col("x1") + (y - F.col("y1")) / (F.col("y2") - F.col("y1")) * (F.col("x2") - F.col("x1"))).alias("x"))


def runs(sides: DataFrame, keys: list[str], res: float) -> DataFrame:
    """(keys, cy, from_cx, to_cx): stretches of cells of a grid row whose centre lies inside: crossings in order, paired by parity."""
    order = Window.partitionBy(*keys, "cy").orderBy("x")
    rows = crossings(sides, keys, res).withColumn("_i", F.row_number().over(order)).withColumn("_to", F.lead("x").over(order)).where("_i % 2 = 1")
    rows = rows.select(*keys, "cy", F.ceil(F.col("x") / res - 0.5).cast("long").alias("from_cx"), (F.ceil(F.col("_to") / res - 0.5).cast("long") - 1).alias("to_cx"))
    return rows.where("from_cx <= to_cx")


def ring_cover(rings: DataFrame, res: float, keys: list[str], ring: str = "ring") -> DataFrame:
    """(keys, cx, cy): the cells whose centre lies inside a polygon, holes left out, each once: the runs of a row share no cell."""
    return runs(edges(rings, keys, ring), keys, res).select(*keys, F.explode(F.sequence("from_cx", "to_cx")).alias("cx"), "cy")


def _side_rows(sides: DataFrame, res: float) -> DataFrame:
    """Sides with each grid row ``cy`` that they touch."""
    cell = lambda v: F.floor(v / res).cast("long")
    return sides.withColumn("cy", F.explode(F.sequence(cell(F.least("y1", "y2")), cell(F.greatest("y1", "y2")))))


def classified_cells(rings: DataFrame, res: float, keys: list[str], ring: str = "ring") -> DataFrame:
    """(keys, cx, cy, edge): the cells that a polygon touches; those with a side in them are edge cells, the others lie inside whole."""
    sides = edges(rings, keys, ring)
    rows = _side_rows(sides, res)
    level = F.col("y1") == F.col("y2")

    def at(y: Column) -> Column:  # the side's x at a height within it
        t = (F.greatest(F.least("y1", "y2"), F.least(F.greatest("y1", "y2"), y)) - F.col("y1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0))
        return F.col("x1") + t * (F.col("x2") - F.col("x1"))

    a = F.when(level, F.col("x1")).otherwise(at(F.col("cy") * res))
    b = F.when(level, F.col("x2")).otherwise(at((F.col("cy") + 1) * res))
    slack = res * 1e-9  # a side along a line of the grid belongs to the cells on both of its sides
    cols = F.sequence(F.floor((F.least(a, b) - slack) / res).cast("long"), F.floor((F.greatest(a, b) + slack) / res).cast("long"))
    touched = rows.select(*keys, F.explode(cols).alias("cx"), "cy").distinct().withColumn("edge", F.lit(True))
    inside = runs(sides, keys, res).select(*keys, F.explode(F.sequence("from_cx", "to_cx")).alias("cx"), "cy").withColumn("edge", F.lit(False))
    return touched.unionByName(inside).groupBy(*keys, "cx", "cy").agg(F.max("edge").alias("edge"))


def points_in_rings(points: DataFrame, rings: DataFrame, res: float, key: str, x: str = "x", y: str = "y", ring: str = "ring") -> DataFrame:
    """``points`` with the ``key`` of each polygon that they lie in, a row for each pair; points in none are left out.

    A point meets the polygons of its cell: of an inside cell by the key alone; in an edge cell the polygon's sides in its grid row
    are crossed. A side holds its lower end, and a point on a side counts as right of it, so polygons that share a side share no point.
    """
    cell = lambda v: F.floor(F.col(v) / res).cast("long")
    cells = classified_cells(rings, res, [key], ring)
    at = points.where(F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(x) & ~F.isnan(y)).withColumn("_pt", F.struct(*points.columns)).withColumn("cx", cell(x)).withColumn("cy", cell(y))
    met = at.join(cells, ["cx", "cy"]).select("_pt", F.col(x).alias("_x"), F.col(y).alias("_y"), "cy", key, "edge")
    sides = _side_rows(edges(rings, [key], ring), res)
    tested = met.where("edge").join(sides, [key, "cy"], "inner").where((F.col("_y") >= F.least("y1", "y2")) & (F.col("_y") < F.greatest("y1", "y2")))
    across = F.col("x1") + (F.col("_y") - F.col("y1")) / (F.col("y2") - F.col("y1")) * (F.col("x2") - F.col("x1"))
    inside = tested.where(across <= F.col("_x")).groupBy("_pt", key).agg(F.count(F.lit(1)).alias("_n")).where("_n % 2 = 1").select("_pt", key)
    return met.where("NOT edge").select("_pt", key).distinct().unionByName(inside).select("_pt.*", key)


def tagged(points: DataFrame, rings: DataFrame, res: float, code: str, x: str = "x", y: str = "y", missing: str = "UNK") -> DataFrame:
    """``points`` with the ``code`` of the polygon that they lie in, the least of several; ``missing`` where there is none. Repeated rows
    stay; codes are trimmed and upper-cased."""
    found = points_in_rings(points.select(x, y).distinct(), rings.withColumn(code, F.upper(F.trim(code))), res, code, x, y).groupBy(x, y).agg(F.min(code).alias(code))
    found = found.select(F.col(x).alias("_x"), F.col(y).alias("_y"), code)
    both = points.join(found, (F.col(x) == F.col("_x")) & (F.col(y) == F.col("_y")), "left").drop("_x", "_y")
    return both.withColumn(code, F.coalesce(code, F.lit(missing)))


def covers_in_rings(cover: DataFrame, keys: list[str], rings: DataFrame, res: float, code: str) -> DataFrame:
    """(keys, code): the polygons that a footprint, given by its cells (keys, cx, cy), meets: those that touch one of its cells."""
    cells = classified_cells(rings.withColumn(code, F.upper(F.trim(code))), res, [code]).select("cx", "cy", code)
    return cover.select(*keys, "cx", "cy").join(cells, ["cx", "cy"]).select(*keys, code).distinct()


def unwrapped(ring: Column) -> Column:
    """A ring whose longitudes go on over the antimeridian: no step is longer than 180 degrees."""

    def on(acc, p):
        last = F.element_at(acc, -1)["x"]
        x = p["x"] - 360.0 * F.round((p["x"] - last) / 360.0)
        return F.concat(acc, F.array(F.struct(x.cast("double").alias("x"), p["y"].cast("double").alias("y"))))

    first = F.transform(F.slice(ring, 1, 1), lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y")))
    return F.aggregate(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), first, on)


def clipped(ring: Column, bound: float, below: bool) -> Column:
    """The part of a ring with x at most ``bound`` (``below``) or at least: a side that crosses the line is cut there."""

    def cut(v):
        n = F.size(v)

        def step(i):
            p, q = F.get(v, i), F.get(v, F.pmod(i + 1, n))
            p_in, q_in = ((p["x"] <= bound), (q["x"] <= bound)) if below else ((p["x"] >= bound), (q["x"] >= bound))
            t = (bound - p["x"]) / F.nullif(q["x"] - p["x"], F.lit(0.0))
            at = F.struct(F.lit(float(bound)).alias("x"), (p["y"] + t * (q["y"] - p["y"])).alias("y"))
            none = F.slice(v, 1, 0)
            return F.when(p_in & q_in, F.array(q)).when(p_in, F.array(at)).when(q_in, F.array(at, q)).otherwise(none)

        return F.when(n >= 3, F.flatten(F.transform(F.sequence(F.lit(0), n - 1), step))).otherwise(F.slice(v, 1, 0))

    return F.get(F.transform(F.array(ring), cut), F.lit(0))


def split_at_antimeridian(rings: DataFrame, ring: str = "ring") -> DataFrame:
    """``rings`` with ``ring`` in pieces within -180 to 180, a row and a number ``world`` for each: the ring is unwrapped, and cut by the half-planes of
    three copies of the world. Rings that don't cross stay one piece (closed ones lose their repeated last vertex); null rings and those without
    area in a world give no row there."""
    open_ring = F.when((F.size(ring) > 1) & (F.element_at(F.col(ring), 1) == F.element_at(F.col(ring), -1)), F.slice(ring, 1, F.size(ring) - 1)).otherwise(F.col(ring))
    rows = rings.withColumn("_whole", unwrapped(open_ring)).withColumn("world", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))))
    moved = F.transform("_whole", lambda p: F.struct((p["x"] - 360.0 * F.col("world")).alias("x"), p["y"].alias("y")))
    piece = clipped(clipped(moved, 180.0, True), -180.0, False)
    rows = rows.withColumn(ring, piece).drop("_whole").where(F.size(ring) >= 3)
    xs = F.transform(ring, lambda p: p["x"])
    return rows.where(F.array_max(xs) > F.array_min(xs))
