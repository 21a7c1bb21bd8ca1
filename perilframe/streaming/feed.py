"""A hazard feed as a stream, matched to a static loss table batch by batch (an addition; the batch jobs do without it)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilframe.operators import joins


def windowed_counts(events: DataFrame, time: str = "ts", late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Events by type and time window, with a watermark for late ones."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), "event_type").count()


def match_feed(feed: DataFrame, losses: DataFrame, out: str, checkpoint: str, max_km: float = 200.0):
    """Starts a query that appends each micro-batch's matches (l_id, r_id) to ``out``."""

    def each(batch: DataFrame, batch_id: int) -> None:
        joins.spacetime_pairs(batch, losses, max_km).withColumn("batch", F.lit(batch_id)).write.mode("append").parquet(out)

    return feed.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
