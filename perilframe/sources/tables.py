"""Scans and sinks: lenient CSV catalogues, GeoJSON features, elevation-tile indexes, canonical layers."""

from __future__ import annotations

import itertools
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEPARATORS = (",", ";", "\t", "|")
CANONICAL = ["event_id", "event_type", "start_time", "end_time", "band", "geom_method", "geom_confidence", "area_km2"]


def scan_catalogue(spark: SparkSession, path: str, types: dict[str, str] | None = None, sep: str = ",") -> DataFrame:
    """A CSV with a header; all columns as text, then the named ones converted leniently (what doesn't convert is null)."""
    df = spark.read.csv(path, header=True, sep=sep, multiLine=False, encoding="UTF-8")
    return df.select(*(F.trim(F.col(f"`{c}`")).try_cast(types[c]).alias(c) if types and c in types else F.col(f"`{c}`") for c in df.columns))


def sniff_separator(spark: SparkSession, path: str) -> str:
    """The separator that is most frequent in the file's lines, comma on a tie."""
    lines = spark.read.text(path)
    counts = lines.agg(*(F.sum(F.length("value") - F.length(F.replace("value", F.lit(s), F.lit("")))).alias(f"n{i}") for i, s in enumerate(SEPARATORS))).first()
    return max(range(len(SEPARATORS)), key=lambda i: (counts[i] or 0, -i)) and SEPARATORS[max(range(len(SEPARATORS)), key=lambda i: (counts[i] or 0, -i))] or SEPARATORS[0]


def sniff_encoding(spark: SparkSession, path: str) -> str:
    """UTF-8 if all lines are, else ISO-8859-1, in which every byte is a character."""
    return "UTF-8" if spark.read.text(path).where(~F.is_valid_utf8("value")).isEmpty() else "ISO-8859-1"


def scan_sniffed(spark: SparkSession, path: str, types: dict[str, str] | None = None) -> DataFrame:
    """A CSV whose separator and encoding are found out; a byte order mark before the first column's name goes."""
    encoding = sniff_encoding(spark, path)
    df = spark.read.csv(path, header=True, sep=sniff_separator(spark, path), encoding=encoding)
    names = [c.removeprefix("\ufeff").removeprefix("ï»¿") for c in df.columns]
    df = df.toDF(*names)
    return df.select(*(F.trim(F.col(f"`{c}`")).try_cast(types[c]).alias(c) if types and c in types else F.col(f"`{c}`") for c in names))


def required(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that have a value in every one of the columns; a column that isn't there is an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    return df.dropna(subset=columns)


def with_columns(df: DataFrame, **kinds: str) -> DataFrame:
    """``df`` with the named columns, null where it lacks them."""
    return df.select("*", *(F.lit(None).cast(kind).alias(c) for c, kind in kinds.items() if c not in df.columns))


def of_events(df: DataFrame, column: str, ids: list[str]) -> DataFrame:
    """Rows of the given events; ids are compared as trimmed lower-case text."""
    return df.where(F.lower(F.trim(F.col(column).cast("string"))).isin([str(i).strip().lower() for i in ids]))


def with_event_time(df: DataFrame, ways: dict[str, object], name: str = "event_time") -> DataFrame:
    """Adds the time by the first of the ``ways`` (expressions that give a timestamp or null, in order of precedence) that any row
    can be read by; null if there is none. One pass over the table finds it: a number for each way."""
    found = df.agg(*(F.count(x).alias(f"_{i}") for i, x in enumerate(ways.values()))).first()
    first = next((x for i, x in enumerate(ways.values()) if found[i]), F.lit(None))
    return df.withColumn(name, first.cast("timestamp_ntz"))


def scan_features(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Vertices of GeoJSON features: file, feature, kind, properties (map of texts), part, ring, seq, x, y.

    A file holds a feature collection, or, with ``lines``, a feature in each of its lines, which large layers should have, as a collection is
    read by one task. Coordinates nest to any depth (points, lines, polygons with holes, and several of each), which no one schema holds, so they are read
    as VARIANT and cast by the geometry's kind: a line or point is ring 0 of its part. Features without a geometry, and geometry collections, have no rows.
    """
    text = spark.read.text(path, wholetext=not lines).select(F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("v")).where("v IS NOT NULL")
    many = F.coalesce(F.try_variant_get("v", "$.features", "array<variant>"), F.array("v"))
    at = text.select("file", F.posexplode(many).alias("feature", "f")).select("file", "feature", "f", F.try_variant_get("f", "$.geometry.type", "string").alias("kind"))

    def read(depth: int):
        return F.try_variant_get("f", "$.geometry.coordinates", "array<" * depth + "double" + ">" * depth)

    k = F.col("kind")
    parts = (
        F.when(k == "Point", F.array(F.array(F.array(read(1))))).when(k == "LineString", F.array(F.array(read(2)))).when(k == "MultiPoint", F.transform(read(2), lambda p: F.array(F.array(p))))
        .when(k == "MultiLineString", F.transform(read(3), lambda line: F.array(line))).when(k == "Polygon", F.array(read(3))).when(k == "MultiPolygon", read(4))
    )
    keep = ["file", "feature", "kind", "properties"]
    rows = at.select("file", "feature", "kind", F.try_variant_get("f", "$.properties", "map<string,string>").alias("properties"), F.posexplode(parts).alias("part", "r"))
    rows = rows.select(*keep, "part", F.posexplode("r").alias("ring", "v")).select(*keep, "part", "ring", F.posexplode("v").alias("seq", "p"))
    return rows.select(*keep, "part", "ring", "seq", F.get("p", F.lit(0)).alias("x"), F.get("p", F.lit(1)).alias("y")).where("x IS NOT NULL AND y IS NOT NULL")


def rings_of(vertices: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ring): the rings of polygons given by ``scan_features``, for the operators on rings; holes are rings of their own."""
    order = F.array_sort(F.collect_list(F.struct("seq", "x", "y")))
    rows = vertices.where(F.col("kind").isin("Polygon", "MultiPolygon")).groupBy(*dict.fromkeys([*keys, "file", "feature", "part", "ring"])).agg(order.alias("v"))
    return rows.select(*keys, F.transform("v", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("ring"))


def tile_index(paths: DataFrame, size_deg: int = 5, path: str = "path") -> DataFrame:
    """(tile_id, sw_lat, sw_lon, ne_lat, ne_lon, path) of paths that name an elevation tile, as ``n60w075``."""
    pattern = r"([ns])(\d{2})([ew])(\d{3})"
    part = lambda i: F.regexp_extract(F.lower(path), pattern, i)
    rows = paths.where(F.lower(path).rlike(pattern))
    lat, lon = part(2).cast("int") * F.when(part(1) == "s", -1).otherwise(1), part(4).cast("int") * F.when(part(3) == "w", -1).otherwise(1)
    return rows.select(F.concat(part(1), part(2), part(3), part(4)).alias("tile_id"), lat.alias("sw_lat"), lon.alias("sw_lon"), (lat + size_deg).alias("ne_lat"), (lon + size_deg).alias("ne_lon"), F.col(path))


def find_column(columns: list[str], wanted: list[str]) -> str | None:
    """The first column whose normalised name equals a wanted one, else the first that contains one."""
    norm = lambda s: re.sub("[^a-z0-9]", "", s.lower())
    names = {c: norm(c) for c in columns}
    for test in (lambda n, w: n == w, lambda n, w: w in n):
        for w in map(norm, wanted):
            for c, n in names.items():
                if test(n, w):
                    return c
    return None


def safe_names(columns: list[str], longest: int = 60, prefer: list[str] = CANONICAL) -> list[str]:
    """Field names for writers: words of letters, digits and single ``_``, no leading digit (``f_`` comes before it), distinct
    whatever their case. Of names that clash, a later canonical one is numbered from 2 on, any other is marked as raw."""
    out: list[str] = []
    for c in columns:
        words = [w for w in re.split(r"[\W_]+", c) if w]
        base = "_".join(words) or "field"
        base = (f"f_{base}" if base[0].isdigit() else base)[:longest]
        taken, tails = {o.lower() for o in out}, itertools.count(2)
        name = base if base.lower() not in taken or c in prefer else f"{base}_raw"
        while name.lower() in taken:
            name = f"{base}_{next(tails)}" if c in prefer else f"{base}_raw{next(tails)}"
        out.append(name)
    return out


def with_layer_name(df: DataFrame) -> DataFrame:
    """Adds ``layer_name`` from event_type, start_time, iso3 and band: lower case, at most 60 characters."""
    from perilframe.functions.scalars import decade

    name = F.concat_ws("_", F.coalesce("event_type", F.lit("unknown")), decade(F.col("start_time")), F.coalesce("iso3", F.lit("UNK")), F.nullif(F.coalesce("band", F.lit("")), F.lit("")))
    return df.withColumn("layer_name", F.substring(F.translate(F.lower(name), "- ", "__"), 1, 60))


def write_layer(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The canonical layer as Parquet by event type."""
    df.write.mode(mode).partitionBy("event_type").parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=True)


def datetime_profile(df: DataFrame, columns: list[str], form: str = "yyyy-MM-dd", least: float = 0.5) -> DataFrame:
    """(field, rate, chosen): the share of rows of each column that read as a date, nulls counted as unread, and the column to
    use: the best one, the first of equals, if its rate is at least ``least``. One pass; an empty table has null rates."""
    rates = df.agg(*(F.avg(F.try_to_timestamp(F.col(x).cast("string"), F.lit(form)).isNotNull().cast("double")).alias(f"_{i}") for i, x in enumerate(columns)))
    best = F.greatest(*(F.coalesce(f"_{i}", F.lit(-1.0)) for i in range(len(columns)))) if len(columns) > 1 else F.col("_0")
    earlier, rows = F.lit(False), []
    for i, x in enumerate(columns):
        top = F.coalesce((F.col(f"_{i}") == best) & (best >= least), F.lit(False))
        rows.append(F.struct(F.lit(x).alias("field"), F.col(f"_{i}").alias("rate"), (top & ~earlier).alias("chosen")))
        earlier = earlier | top
    return rates.select(F.inline(F.array(*rows)))
