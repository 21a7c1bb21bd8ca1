"""Lookups by identifiers, code lists and tiles; the first agency with radii."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilframe.functions import scalars as S


def with_attributes(rows: DataFrame, attributes: DataFrame, key: str = "ID", attribute_key: str | None = None) -> DataFrame:
    """``rows`` with the other columns of ``attributes`` whose id is the same number; ids that are none have no attributes. An id that stands in
    several rows of ``attributes`` gives as many rows; columns that both have are left as ``rows`` has them."""
    name = attribute_key or next(c for c in attributes.columns if c.strip().lower() == key.strip().lower())
    there = {c.lower() for c in rows.columns}
    extra = [c for c in attributes.columns if c.lower() not in there and c != name]
    side = attributes.select(S.coerce_double(F.col(name)).alias("_id"), *extra).where("_id IS NOT NULL")
    return rows.withColumn("_key", S.coerce_double(F.col(key))).join(side, F.col("_key") == F.col("_id"), "left").select(*rows.columns, *extra)


def regions_of_codes(rows: DataFrame, key: str, editions: list[tuple[str, DataFrame]]) -> DataFrame:
    """(key, edition, cx, cy): the union of the regions that a row's code lists name, as cells.

    editions: (column of ``;``-separated codes, regions with code, cx, cy), the preferred one first; of each row the first edition counts in
    which any of its codes is a region. ``edition`` is its place in the list, from 0. Codes compare as trimmed text.
    """
    found = []
    for place, (column, regions) in enumerate(editions):
        codes = rows.select(key, F.explode(S.code_list(F.col(column))).alias("_code"))
        cells = regions.select(F.trim(F.col("code").cast("string")).alias("_code"), "cx", "cy")
        found.append(codes.join(cells, "_code").select(key, F.lit(place).alias("edition"), "cx", "cy"))
    every = reduce(DataFrame.unionByName, found).distinct()
    first = every.groupBy(key).agg(F.min("edition").alias("edition"))
    return every.join(first, [key, "edition"], "left_semi")


def tiles_of_cover(cover: DataFrame, keys: list[str], tiles: DataFrame, res_deg: float, size_deg: float = 5.0) -> DataFrame:
    """(keys, tile_id): the tiles that a footprint's cells overlap. cover: keys, cx, cy on a grid of ``res_deg`` degrees of longitude and
    latitude; tiles: tile_id, sw_lon, sw_lat, each of ``size_deg``, on whole multiples of it."""

    def span(v: str) -> Column:
        low = F.floor(F.col(v) * res_deg / size_deg + 1e-9).cast("long")
        high = F.ceil((F.col(v) + 1) * res_deg / size_deg - 1e-9).cast("long") - 1
        return F.sequence(low, F.greatest(low, high))

    reach = cover.select(*keys, F.explode(span("cx")).alias("tx"), "cy").select(*keys, "tx", F.explode(span("cy")).alias("ty")).distinct()
    at = tiles.select("tile_id", F.round(F.col("sw_lon") / size_deg).cast("long").alias("tx"), F.round(F.col("sw_lat") / size_deg).cast("long").alias("ty"))
    return reach.join(at, ["tx", "ty"]).select(*keys, "tile_id").distinct()


def preferred_radii(columns: list[str], agencies: list[str], tiers: list[str], quads: tuple[str, ...] = ("ne", "se", "sw", "nw"), unit_km: float = 1.852) -> Column:
    """Struct agency, tier and {quad}_km of the first agency, and of its tiers the first, that has a positive radius in any quadrant; null if none has.
    Columns are named {agency}_{tier}_{quad} in any case; those that aren't among ``columns`` count as null."""
    names = {c.lower(): c for c in columns}
    ways = []
    for agency in agencies:
        for tier in tiers:
            held = {q: names.get(f"{agency}_{tier}_{q}".lower()) for q in quads}
            if any(held.values()):
                radius = {q: S.positive(F.col(n)) * unit_km if n else F.lit(None).cast("double") for q, n in held.items()}
                some = reduce(lambda a, b: a | b, (radius[q].isNotNull() for q in quads))
                ways.append(F.when(some, F.struct(F.lit(agency).alias("agency"), F.lit(tier).alias("tier"), *(radius[q].alias(f"{q}_km") for q in quads))))
    kind = "struct<agency:string,tier:string," + ",".join(f"{q}_km:double" for q in quads) + ">"
    return F.coalesce(*ways) if ways else F.lit(None).cast(kind)
