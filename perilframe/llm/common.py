"""Helpers that the corpus operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perilframe.io import dropped, only, shared_dir, written  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of ``sf_dir``; any path that Spark can read will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text"):
    """The text, with null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def mapped(df: DataFrame, run, schema, rows: int = 1000) -> DataFrame:
    """``df.mapInArrow(run, schema)`` with at most ``rows`` rows a batch, as texts can be long: a batch is held by Spark and
    by the worker. Spark has this as a setting of the session only; it is lowered there, and a smaller one stays."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= rows:
        conf.set(key, rows)
    return df.mapInArrow(run, schema)


def slices(batch, rows: int = 500):
    """An Arrow batch in slices, so that only few texts are Python strings at a time."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def pieces(texts: list, most_chars: int = 4_000_000):
    """Index ranges (start, end) over ``texts`` with at most so many characters each, or one text alone."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > most_chars:
            yield start, i
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)


def of_hashes(h: np.ndarray) -> int:
    """The 64-bit SimHash of hashes (big-endian): a bit is 1 if it is in over half of them."""
    n, set_bits = len(h), np.unpackbits(h.view(np.uint8)).reshape(-1, 64)
    if n > 255:
        head = set_bits[: n // 255 * 255].reshape(-1, 255, 64).sum(1, dtype=np.uint8)  # small sums stay in bytes
        count = head.sum(0, dtype=np.int64) + set_bits[n // 255 * 255 :].sum(0, dtype=np.int64)
    else:
        count = set_bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(count * 2 > n).tobytes(), "big")
