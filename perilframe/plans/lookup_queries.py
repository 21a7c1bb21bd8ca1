"""Registered queries of lookups: code lists in editions, tiles of footprints, first agency with radii, attributes by number."""

from __future__ import annotations

from pyspark.sql import functions as F

from perilframe.operators import lookups
from perilframe.plans.registry import c, query, r6


@query("""WITH e AS (SELECT row_id, unnest([row_id % 25, (row_id + 7) % 25]) AS code FROM fx_flood), n AS (SELECT DISTINCT row_id, 0 AS edition, code FROM e WHERE code % 4 = 0),
o AS (SELECT row_id, 1 AS edition, (row_id + 3) % 25 AS code FROM fx_flood WHERE row_id NOT IN (SELECT row_id FROM n) AND row_id % 3 <> 0)
SELECT row_id, edition, CAST(code % 5 AS BIGINT) AS cx, CAST(code // 5 AS BIGINT) AS cy FROM n UNION ALL SELECT row_id, edition, CAST(code % 5 AS BIGINT), CAST(code // 5 AS BIGINT) FROM o""", "fx_flood", "fx_country")  # fmt: skip
def code_list_editions(flood, country):
    """A newer edition that has every fourth region, and an older one that has all, with lists of their own; a third of the floods have no older list."""
    k, text = c("row_id"), lambda x: x.cast("string")
    rows = flood.select("row_id", F.concat(F.lit(" "), text(k % 25), F.lit(";; "), text((k + 7) % 25)).alias("newer"), F.when(k % 3 != 0, text((k + 3) % 25)).alias("older"))
    regions = country.select(c("country_id").alias("code"), (c("country_id") % 5).cast("long").alias("cx"), F.floor(c("country_id") / 5).cast("long").alias("cy"))
    return lookups.regions_of_codes(rows, "row_id", [("newer", regions.where("code % 4 = 0")), ("older", regions)])


@query("""WITH t AS (SELECT DISTINCT CAST(floor(lon / 5) AS BIGINT) AS tx, CAST(floor(lat / 5) AS BIGINT) AS ty FROM fx_flood), q AS (SELECT event_id, CAST(floor(lon / 2) AS BIGINT) AS cx, CAST(floor(lat / 2) AS BIGINT) AS cy FROM fx_quake)
SELECT event_id, tx || '/' || ty AS tile_id FROM q JOIN t ON tx * 5 < (cx + 1) * 2 AND (tx + 1) * 5 > cx * 2 AND ty * 5 < (cy + 1) * 2 AND (ty + 1) * 5 > cy * 2""", "fx_quake", "fx_flood")  # fmt: skip
def tiles_of_cover(quake, flood):
    """The tiles, of those that floods lie in, that the two-degree cell of each quake overlaps."""
    cell = lambda v, d: F.floor(c(v) / d).cast("long")
    tiles = flood.select(cell("lon", 5).alias("tx"), cell("lat", 5).alias("ty")).distinct().select(F.concat_ws("/", "tx", "ty").alias("tile_id"), (c("tx") * 5.0).alias("sw_lon"), (c("ty") * 5.0).alias("sw_lat"))
    return lookups.tiles_of_cover(quake.select("event_id", cell("lon", 2).alias("cx"), cell("lat", 2).alias("cy")), ["event_id"], tiles, 2.0)


@query("""WITH r AS (SELECT l_orderkey AS k1, l_linenumber AS k2, CASE WHEN l_partkey % 3 = 0 THEN l_partkey % 90 ELSE 0 END AS a, CASE WHEN l_partkey % 4 = 0 THEN l_suppkey % 40 END AS b, CASE WHEN l_suppkey % 2 = 0 THEN l_suppkey % 70 ELSE -5 END AS d, l_partkey % 50 AS e FROM lineitem)
SELECT k1, k2, CASE WHEN a > 0 OR b > 0 THEN 'USA' WHEN d > 0 OR e > 0 THEN 'TOKYO' END AS agency, CASE WHEN a > 0 THEN 'R64' WHEN b > 0 THEN 'R34' WHEN d > 0 THEN 'R64' WHEN e > 0 THEN 'R34' END AS tier,
  round(CASE WHEN a > 0 THEN a WHEN b > 0 THEN NULL WHEN d > 0 THEN d END * 1.852, 6) AS ne_km, round(CASE WHEN a > 0 THEN NULL WHEN b > 0 THEN b WHEN d > 0 THEN NULL WHEN e > 0 THEN e END * 1.852, 6) AS sw_km FROM r""", "lineitem")  # fmt: skip
def preferred_radii_ordered(lineitem):
    rows = lineitem.select(
        c("l_orderkey").alias("k1"), c("l_linenumber").alias("k2"), F.when(c("l_partkey") % 3 == 0, c("l_partkey") % 90).otherwise(0).alias("usa_r64_ne"), F.when(c("l_partkey") % 4 == 0, c("l_suppkey") % 40).alias("USA_R34_SW"),
        F.when(c("l_suppkey") % 2 == 0, c("l_suppkey") % 70).otherwise(-5).alias("tokyo_r64_ne"), (c("l_partkey") % 50).alias("tokyo_r34_sw"),
    )
    got = rows.withColumn("p", lookups.preferred_radii(rows.columns, ["USA", "CMA", "TOKYO"], ["R64", "R50", "R34"]))
    return got.select("k1", "k2", "p.agency", "p.tier", r6(c("p.ne_km")).alias("ne_km"), r6(c("p.sw_km")).alias("sw_km"))


@query("SELECT row_id, CASE WHEN row_id % 5 <> 0 THEN o_orderpriority END AS priority FROM fx_flood LEFT JOIN orders ON o_orderkey = row_id", "fx_flood", "orders")
def attributes_by_number(flood, orders):
    """Ids as texts of numbers, with those of every fifth flood unreadable."""
    rows = flood.select("row_id", F.when(c("row_id") % 5 == 0, F.concat(F.lit("no. "), c("row_id"))).otherwise(F.concat(F.lit(" "), c("row_id"), F.lit(".0"))).alias("ID"))
    attributes = orders.select(c("o_orderkey").alias(" id"), c("o_orderpriority").alias("priority"))
    return lookups.with_attributes(rows, attributes).select("row_id", "priority")
