"""Adapters that bring other platforms' payloads into the common typed shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.functions import codes
from pulselake.functions.scalars import (
    android_exercise,
    android_sleep_stage,
    canonical_unit,
    cast_or_null,
    field,
    lookup,
    minutes_between,
)
from pulselake.operators.ingest import route
from pulselake.operators.typed import ENVELOPE, body

SERIES = "array<struct<time:string,beats_per_minute:double>>"
ANDROID_STAGES = "array<struct<stage:string,stage_code:int,start_time:string,end_time:string>>"


# ---- Android Health Connect -------------------------------------------------


def _android_sample(record_id: Column, value: Column, start: Column, end: Column) -> list[Column]:
    return [
        *[F.col(c) for c in ENVELOPE],
        record_id.alias("uuid"),
        F.col("sample_type"),
        value.alias("value"),
        lookup(F.col("sample_type"), codes.ANDROID_SAMPLE_UNITS, F.lit(None).cast("string")).alias("unit"),
        start.alias("start_ts"),
        end.alias("end_ts"),
        body("data_origin", "string", "source_bundle_id"),
        body("start_zone_offset", "string"),
        body("end_zone_offset", "string"),
        body("last_modified_time", "timestamp", "last_modified_ts"),
    ]


def android_samples(bronze: DataFrame) -> DataFrame:
    """Health Connect records -> samples; record types without a unit are skipped.

    A heart-rate record that carries a series of beats becomes one sample per
    beat with the id ``<id>-<index>``.
    """
    records = (
        route(bronze, "samples")
        .withColumns({"sample_type": field("body", "type", "string"), "id": field("body", "id", "string")})
        .where(F.col("sample_type").isin(list(codes.ANDROID_SAMPLE_UNITS)))
    )
    series = field("body", "samples", SERIES)
    single = records.where(series.isNull()).select(
        *_android_sample(
            F.col("id"),
            field("body", "value", "double"),
            field("body", "start_time", "timestamp"),
            field("body", "end_time", "timestamp"),
        )
    )
    beats = records.select("*", F.posexplode(series).alias("index", "beat"))
    at = cast_or_null(F.col("beat.time"), "timestamp")
    flattened = beats.select(
        *_android_sample(F.concat("id", F.lit("-"), "index"), F.col("beat.beats_per_minute"), at, at)
    )
    return single.unionByName(flattened)


def android_workouts(bronze: DataFrame) -> DataFrame:
    """Exercise sessions; the length is the difference of the instants in milliseconds."""
    rows = route(bronze, "workouts").select(
        *ENVELOPE,
        body("id", "string", "uuid"),
        body("exercise_type_code", "int", "activity_type_raw"),
        body("start_time", "timestamp", "start_ts"),
        body("end_time", "timestamp", "end_ts"),
        body("title", "string"),
    )
    millis = F.unix_millis("end_ts") - F.unix_millis("start_ts")
    return rows.withColumns(
        {
            "activity_type": android_exercise(F.col("activity_type_raw")),
            "duration_seconds": millis / F.lit(1000.0),
        }
    )


def android_sleep_stages(bronze: DataFrame) -> DataFrame:
    """Sleep sessions -> one row per stage; stages have no id of their own, so it is ``<id>-<index>``."""
    rows = route(bronze, "sleep").select(
        *ENVELOPE,
        body("id", "string"),
        body("start_time", "timestamp", "session_start_ts"),
        body("end_time", "timestamp", "session_end_ts"),
        F.posexplode(field("body", "stages", ANDROID_STAGES)).alias("index", "s"),
    )
    start, end = cast_or_null(F.col("s.start_time"), "timestamp"), cast_or_null(F.col("s.end_time"), "timestamp")
    return rows.select(
        *ENVELOPE,
        F.concat("id", F.lit("-"), "index").alias("stage_uuid"),
        android_sleep_stage(F.col("s.stage_code")).alias("stage"),
        start.alias("stage_start_ts"),
        end.alias("stage_end_ts"),
        minutes_between(start, end).alias("stage_duration_minutes"),
        "session_start_ts",
        "session_end_ts",
        F.to_date("session_start_ts").alias("sleep_date"),
    )


def android_deletes(bronze: DataFrame) -> DataFrame:
    """Health Connect deletes with the table they aim at."""
    kind = F.col("android_type")
    target = (
        F.when(kind == "SleepSessionRecord", "silver_sleep_stages")
        .when(kind == "ExerciseSessionRecord", "silver_workouts")
        .when(kind.isin(list(codes.ANDROID_SAMPLE_UNITS)), "silver_health_samples")
        .otherwise("unknown")
    )
    return (
        route(bronze, "deletes")
        .select(
            *ENVELOPE,
            body("id", "string", "deleted_uuid"),
            body("record_type", "string", "android_type"),
            body("deleted_time", "timestamp", "deleted_ts"),
        )
        .withColumn("target_table", target)
    )


# ---- iOS --------------------------------------------------------------------


def quantity_samples(samples: DataFrame) -> DataFrame:
    """Quantity samples with the canonical unit of their type."""
    return samples.where(F.col("sample_type").startswith("HKQuantityType")).withColumn(
        "unit", canonical_unit(F.col("sample_type"))
    )


def category_samples(samples: DataFrame) -> DataFrame:
    """Category samples as numeric samples with the unit ``category``."""
    return samples.where(F.col("sample_type").startswith("HKCategoryType")).select(
        *[c for c in samples.columns if c not in ("value", "unit")],
        F.col("value").cast("double").alias("value"),
        F.lit("category").alias("unit"),
    )
