"""Loss records: loading, matching against features, and the audit of why each was or wasn't matched."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perilframe.functions import scalars as S
from perilframe.io import written
from perilframe.operators import joins

#: Loss hazards that have a pipeline.
PIPELINES = ("storm", "earthquake", "tsunami", "flood")


def loss_records(raw: DataFrame, member: Column | None = None) -> DataFrame:
    """Normalised loss records: rec_id, event_id, hazard, country_id, start_date, end_date, lat, lon, in_scope.

    Day and month are clamped to real dates; in_scope tells whether the country is a member: by its code in column ``iso3``, or by ``member``.
    """
    member = S.is_member(F.col("iso3")) if member is None else member
    start = S.ymd_clamped(F.col("start_year"), F.col("start_month"), F.col("start_day"))
    return raw.select(
        "rec_id", S.norm_event_id(F.col("event_id_raw")).alias("event_id"), S.classify_hazard(F.col("disaster_type")).alias("hazard"), "country_id",
        start.alias("start_date"), start.alias("end_date"), "lat", "lon", F.coalesce(member, F.lit(False)).alias("in_scope"),
    )


def as_right(losses: DataFrame, hazard: str | None = None) -> DataFrame:
    """Losses as the right side of the matching joins."""
    if hazard:
        losses = losses.where(F.col("hazard") == hazard)
    return losses.select(F.col("rec_id").alias("r_id"), F.col("start_date").alias("r_start"), F.col("end_date").alias("r_end"), F.col("lat").alias("r_lat"), F.col("lon").alias("r_lon"))


def quakes_as_left(quakes: DataFrame) -> DataFrame:
    return quakes.select(F.col("event_id").alias("l_id"), F.col("eq_time").alias("l_start"), F.col("eq_time").alias("l_end"), F.col("lat").alias("l_lat"), F.col("lon").alias("l_lon"))


def floods_as_left(floods: DataFrame) -> DataFrame:
    return floods.select(F.col("row_id").alias("l_id"), F.col("start_date").alias("l_start"), F.coalesce("end_date", "start_date").alias("l_end"), F.col("lat").alias("l_lat"), F.col("lon").alias("l_lon"))


def loss_audit(losses: DataFrame, matched: DataFrame, status: DataFrame) -> DataFrame:
    """Every loss record with its reason. matched: (hazard, rec_id); status: (hazard, enabled, status, n_before, error), one row a pipeline.

    Matching is by record id within the record's own hazard. The status table has a row for each pipeline and is broadcast.
    """
    hit = matched.select(F.col("hazard").alias("_h"), F.col("rec_id").alias("_r")).distinct()
    rows = losses.join(F.broadcast(status.withColumnRenamed("hazard", "_hazard")), F.col("hazard") == F.col("_hazard"), "left").drop("_hazard")
    rows = rows.join(hit, (F.col("hazard") == F.col("_h")) & (F.col("rec_id") == F.col("_r")), "left")
    reason = (
        F.when(~F.col("in_scope"), "oecd_excluded").when(F.col("status").isNull(), "hazard_unrecognized").when(~F.col("enabled"), "hazard_disabled")
        .when(F.col("status") == "error", "pipeline_error").when(F.col("n_before") == 0, "pipeline_empty").when(F.col("_r").isNotNull(), "matched").otherwise("not_matched")
    )
    return rows.withColumn("reason", reason).select("rec_id", "event_id", "hazard", "start_date", "in_scope", "reason", (F.col("reason") == "matched").alias("matched"), F.col("status").alias("pipeline_status"), "n_before")


def storms_as_left(tracks: DataFrame) -> DataFrame:
    """One feature a track: its span in time and its mean position, circular in longitude."""
    lon = F.radians("lon")
    mean = F.degrees(F.atan2(F.avg(F.sin(lon)), F.avg(F.cos(lon))))
    return tracks.groupBy(F.col("sid").alias("l_id")).agg(F.min("iso_time").alias("l_start"), F.max("iso_time").alias("l_end"), F.avg("lat").alias("l_lat"), mean.alias("l_lon"))


def isolated(pipelines: dict[str, Callable[[], DataFrame]]) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """(features, errors) by hazard: each pipeline's rows, written; one that fails is left out with its message, and the others go on."""
    done, errors = {}, {}
    for hazard, run in pipelines.items():
        try:
            done[hazard] = written(run(), f"features-{hazard}")
        except Exception as error:  # whatever a peril's own data or code may raise: the audit reports it as pipeline_error
            errors[hazard] = f"{type(error).__name__}: {error}"[:500]
    return done, errors


def run_audit(losses: DataFrame, pipelines: dict[str, Callable[[], DataFrame]], reach_km: dict[str, float]) -> DataFrame:
    """The audit over pipelines that give features (l_id, l_start, l_end, l_lat, l_lon), matched to losses of their hazard within ``reach_km``.

    A pipeline is enabled if its hazard is among the losses in scope; it is empty without features, and in error if it fails. The losses are cut
    into months and cells once, for all hazards, and there is one join, with the hazard in its key.
    """
    spark, scope = losses.sparkSession, written(losses.where("in_scope"), "losses-in-scope")
    done, errors = isolated(pipelines)
    left = [df.select(F.lit(hazard).alias("hazard"), "l_id", F.col("l_start").cast("date").alias("l_start"), F.col("l_end").cast("date").alias("l_end"), F.col("l_lat").cast("double").alias("l_lat"), F.col("l_lon").cast("double").alias("l_lon"), F.lit(reach_km[hazard]).alias("reach_km")) for hazard, df in done.items()]
    matched = spark.createDataFrame([], "hazard string, rec_id long")
    if left:
        right = as_right(scope).join(scope.select(F.col("rec_id").alias("r_id"), "hazard"), "r_id")
        matched = joins.matched_ids(reduce(DataFrame.unionByName, left), right, max(reach_km.values()), keys=["hazard"]).select("hazard", F.col("r_id").alias("rec_id"))
    counts = [(hazard, done[hazard].count() if hazard in done else None, errors.get(hazard)) for hazard in pipelines]
    status = spark.createDataFrame(counts, "hazard string, n_before long, error string")
    enabled = scope.select(F.col("hazard").alias("_h")).distinct()
    kind = F.when(F.col("error").isNotNull(), "error").when(F.col("n_before") > 0, "ok").otherwise("empty")
    status = status.join(enabled, F.col("hazard") == F.col("_h"), "left").select("hazard", F.col("_h").isNotNull().alias("enabled"), kind.alias("status"), "n_before")
    return loss_audit(losses, matched, status)


def audit(losses: DataFrame, quakes: DataFrame, floods: DataFrame, tracks: DataFrame, runups: DataFrame, quake_km: float = 200.0, other_km: float = 250.0) -> DataFrame:
    """The audit over the four perils. Run-ups have neither times nor places on the globe, so tsunami losses are matched by none of them."""
    none = (F.lit(None).cast("date").alias("l_start"), F.lit(None).cast("date").alias("l_end"), F.lit(None).cast("double").alias("l_lat"), F.lit(None).cast("double").alias("l_lon"))
    pipelines = {
        "storm": lambda: storms_as_left(tracks), "earthquake": lambda: quakes_as_left(quakes),
        "tsunami": lambda: runups.select(F.col("tsunami_event_id").alias("l_id")).distinct().select("l_id", *none), "flood": lambda: floods_as_left(floods),
    }
    return run_audit(losses, pipelines, {h: quake_km if h == "earthquake" else other_km for h in pipelines})
