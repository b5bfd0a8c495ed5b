"""Readings collected on the watch itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulselake.functions.scalars import field

READINGS = "array<struct<metric_type:string,value:double,unit:string,recorded_at:string,device_id:string,source:string>>"
NO_STRESS_READING = 127


def explode_watch_records(payloads: DataFrame) -> DataFrame:
    """Payloads with ``body.records`` -> one row per reading."""
    rows = payloads.select("record_id", "ingested_at", F.explode(field("body", "records", READINGS)).alias("r"))
    return rows.select("record_id", "ingested_at", "r.*").withColumn(
        "recorded_at", F.col("recorded_at").try_cast("timestamp")
    )


def incremental_readings(readings: DataFrame, since: str, cap: int | None = None) -> DataFrame:
    """Readings newer than the last collection, without missing values and stress readings of 127.

    With ``cap`` only the newest readings of each device and metric are looked
    at. Ranking from the newest on does not depend on older readings, so these
    are left out before it.
    """
    newest = Window.partitionBy("device_id", "metric_type").orderBy(F.desc("recorded_at"), F.desc("record_id"))
    no_stress = (F.col("metric_type") == "stress_level") & (F.col("value") == NO_STRESS_READING)
    recent = readings.where(F.col("recorded_at") > F.lit(since).cast("timestamp"))
    if cap is not None:
        recent = recent.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= cap).drop("_rank")
    return recent.where(F.col("value").isNotNull() & ~no_stress)
