"""Derived views over the standard tables that stand in for hazard and loss catalogues. The same SQL runs in DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "fx_country": """SELECT n_nationkey AS country_id, concat('C', chr(65 + CAST(n_nationkey AS INT)), 'X') AS iso3, n_name AS country_name,
       CAST(n_nationkey % 5 AS DOUBLE) * 72.0 - 180.0 AS minx, CAST(n_nationkey % 5 AS DOUBLE) * 72.0 - 108.0 AS maxx,
       CAST((n_nationkey - n_nationkey % 5) AS DOUBLE) / 5.0 * 36.0 - 90.0 AS miny, CAST((n_nationkey - n_nationkey % 5) AS DOUBLE) / 5.0 * 36.0 - 54.0 AS maxy
       FROM nation""",
    "fx_loss": """SELECT o_orderkey AS rec_id, concat(CAST(o_orderkey AS VARCHAR(20)), '–', substr(o_orderpriority,1,1)) AS event_id_raw, o_custkey % 25 AS country_id,
       CASE substr(o_orderpriority,1,1) WHEN '1' THEN 'Tropical cyclone' WHEN '2' THEN 'Earthquake' WHEN '3' THEN 'Riverine flood' WHEN '4' THEN 'Tsunami' ELSE 'Drought' END AS disaster_type,
       CAST(year(o_orderdate) AS INT) AS start_year, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(month(o_orderdate) AS INT) END AS start_month,
       CASE WHEN o_orderkey % 7 = 0 THEN 31 ELSE CAST(day(o_orderdate) AS INT) END AS start_day,
       CASE WHEN o_orderkey % 10 < 3 THEN NULL ELSE CAST(o_orderkey * 7919 % 12001 AS DOUBLE) / 100.0 - 60.0 END AS lat,
       CASE WHEN o_orderkey % 10 < 3 THEN NULL ELSE CAST(o_orderkey * 104729 % 36000 AS DOUBLE) / 100.0 - 180.0 END AS lon, o_totalprice AS damage
       FROM orders""",
    "fx_quake": """SELECT o_orderkey AS event_id, CAST(o_orderdate AS DATE) AS eq_time, CAST(o_orderkey * 6211 % 12001 AS DOUBLE) / 100.0 - 60.0 AS lat,
       CAST(o_orderkey * 90001 % 36000 AS DOUBLE) / 100.0 - 180.0 AS lon, 5.0 + CAST(o_orderkey * 31 % 400 AS DOUBLE) / 100.0 AS mw, CAST(o_orderkey * 13 % 70 AS DOUBLE) AS depth_km,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderkey * 53 % 361 AS DOUBLE) - 180.0 END AS rake1,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey * 17 % 360 AS DOUBLE) END AS strike
       FROM orders""",
    "fx_track": """SELECT l_orderkey - l_orderkey % 8 AS sid, CAST(l_shipdate AS DATE) AS iso_time, l_orderkey AS k1, l_linenumber AS k2, l_partkey AS k3, l_suppkey AS k4,
       CAST((l_orderkey - l_orderkey % 8) % 500 + l_partkey * 7 % 21 AS DOUBLE) / 10.0 - 25.0 AS lat,
       CAST(((l_orderkey - l_orderkey % 8) * 170 + 60 + l_partkey * 3 % 40) % 3600 AS DOUBLE) / 10.0 - 180.0 AS lon,
       CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE 20.0 + CAST(l_quantity AS DOUBLE) * 2.5 END AS usa_wind, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE 18.0 + CAST(l_quantity AS DOUBLE) * 2.4 END AS tokyo_wind,
       CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE CAST(l_quantity AS DOUBLE) * 3.0 END AS usa_r34_ne, CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE CAST(l_quantity AS DOUBLE) * 2.0 END AS usa_r34_se
       FROM lineitem""",
    "fx_flood": """SELECT o_orderkey AS row_id, CASE o_orderkey % 3 WHEN 0 THEN 'USFD' WHEN 1 THEN 'HANZE' ELSE 'DFO' END AS source, CAST(o_orderdate AS DATE) AS start_date,
       CAST(CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderdate + INTERVAL 5 DAY END AS DATE) AS end_date,
       CAST(o_custkey * 7919 % 12001 AS DOUBLE) / 100.0 - 60.0 AS lat, CAST(o_custkey * 104729 % 36000 AS DOUBLE) / 100.0 - 180.0 AS lon,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_totalprice AS DOUBLE) / 1000.0 END AS area_km2
       FROM orders""",
    "fx_coast_vertex": """SELECT p_partkey % 20 AS part_id, CAST((p_partkey - p_partkey % 20) / 20 AS INT) AS seq,
       CAST((p_partkey - p_partkey % 20) / 20 AS DOUBLE) * 10000.0 AS x_m, CAST(p_partkey % 20 AS DOUBLE) * 200000.0 + CAST(p_partkey * 71 % 97 AS DOUBLE) * 100.0 AS y_m
       FROM part""",
    "fx_runup": """SELECT c_custkey AS runup_id, c_nationkey AS tsunami_event_id, CAST(c_custkey * 89 % 1000 AS DOUBLE) * 1000.0 AS x_m,
       CAST(c_custkey * 41 % 20 AS DOUBLE) * 200000.0 + CAST(c_custkey * 29 % 500 AS DOUBLE) * 100.0 AS y_m, CAST(c_custkey * 13 % 500 AS DOUBLE) / 100.0 AS runup_ht
       FROM customer""",
}
BASE = {name: re.search(r"FROM (\w+)\s*$", sql)[1] for name, sql in VIEWS.items()}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view, or a table as it is."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    base = BASE[name]
    return spark.sql(re.sub(rf"FROM {base}\s*$", "FROM {base}", VIEWS[name]), base=spark.read.parquet(f"{sf_dir}/{base}.parquet"))


def with_views(sql: str) -> str:
    """DuckDB SQL with the views that it names as common tables before its own."""
    used = [n for n in VIEWS if re.search(rf"\b{n}\b", sql)]
    if not used:
        return sql
    ctes = ", ".join(f"{n} AS ({VIEWS[n]})" for n in used)
    body = sql.strip()
    for start in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(start):
            return f"{start}{ctes}, {body[len(start):]}"
    return f"WITH {ctes} {body}"
