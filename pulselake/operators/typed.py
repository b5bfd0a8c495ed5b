"""Raw bronze rows -> typed rows per record type.

Every function is a projection (plus one explode for sleep), so batch and
stream share it. Values of the wrong kind become NULL; the drop rules of the
contract remove the rows that need them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.functions.scalars import cast_or_null, field, minutes_between
from pulselake.operators.ingest import route

ENVELOPE = ["record_id", "ingested_at", "user_id", "source_platform"]
STAGE_ARRAY = "array<struct<stage:string,start_date:string,end_date:string,uuid:string>>"

# Stage name -> short name used in column names.
STAGES = {"asleepDeep": "deep", "asleepREM": "rem", "asleepCore": "core", "awake": "awake"}


def body(path: str, dtype: str, name: str | None = None) -> Column:
    return field("body", path, dtype).alias(name or path)


def type_health_samples(bronze: DataFrame) -> DataFrame:
    typed = route(bronze, "samples").select(
        *ENVELOPE,
        body("uuid", "string"),
        body("type", "string", "sample_type"),
        body("value", "double"),
        body("unit", "string"),
        body("start_date", "timestamp", "start_ts"),
        body("end_date", "timestamp", "end_ts"),
        body("source_name", "string"),
        body("source_bundle_id", "string"),
        F.try_variant_get("body", "$.metadata", "variant").alias("metadata"),
    )
    return typed.withColumns({"sample_date": F.to_date("start_ts"), "sample_hour": F.hour("start_ts")})


def type_workouts(bronze: DataFrame) -> DataFrame:
    typed = route(bronze, "workouts").select(
        *ENVELOPE,
        body("uuid", "string"),
        body("activity_type", "string"),
        body("activity_type_raw", "int"),
        body("duration_seconds", "double"),
        body("start_date", "timestamp", "start_ts"),
        body("end_date", "timestamp", "end_ts"),
        body("total_distance_meters", "double"),
        body("total_energy_burned_kcal", "double"),
        body("source_name", "string"),
        F.try_variant_get("body", "$.metadata", "variant").alias("metadata"),
    )
    return typed.withColumns(
        {
            "workout_date": F.to_date("start_ts"),
            "duration_minutes": F.col("duration_seconds") / F.lit(60.0),
            "distance_km": F.col("total_distance_meters") / F.lit(1000.0),
        }
    )


def type_sleep_stages(bronze: DataFrame) -> DataFrame:
    """One row per stage; a session with no stages gives no row."""
    exploded = route(bronze, "sleep").select(
        *ENVELOPE,
        body("start_date", "timestamp", "session_start_ts"),
        body("end_date", "timestamp", "session_end_ts"),
        F.explode(field("body", "stages", STAGE_ARRAY)).alias("s"),
    )
    stages = exploded.select(
        *ENVELOPE,
        F.col("s.uuid").alias("stage_uuid"),
        F.col("s.stage").alias("stage"),
        cast_or_null(F.col("s.start_date"), "timestamp").alias("stage_start_ts"),
        cast_or_null(F.col("s.end_date"), "timestamp").alias("stage_end_ts"),
        "session_start_ts",
        "session_end_ts",
    )
    return stages.select(
        *ENVELOPE,
        "stage_uuid",
        "stage",
        "stage_start_ts",
        "stage_end_ts",
        minutes_between(F.col("stage_start_ts"), F.col("stage_end_ts")).alias("stage_duration_minutes"),
        "session_start_ts",
        "session_end_ts",
        F.to_date("session_start_ts").alias("sleep_date"),
    )


def type_activity_summaries(bronze: DataFrame) -> DataFrame:
    """Daily rings. A goal of 0 gives a NULL ratio, which the contract counts."""
    rings = route(bronze, "activity_summaries").select(
        *ENVELOPE,
        body("date", "date", "activity_date"),
        body("active_energy_burned_kcal", "double", "energy_burned_kcal"),
        body("active_energy_burned_goal_kcal", "double", "energy_goal_kcal"),
        body("exercise_minutes", "int"),
        body("exercise_minutes_goal", "int", "exercise_goal_minutes"),
        body("stand_hours", "int"),
        body("stand_hours_goal", "int", "stand_goal_hours"),
    )

    def ratio(part: str, goal: str) -> Column:
        return F.try_divide(F.col(part).cast("double"), F.col(goal).cast("double"))

    return rings.withColumns(
        {
            "energy_goal_pct": ratio("energy_burned_kcal", "energy_goal_kcal"),
            "exercise_goal_pct": ratio("exercise_minutes", "exercise_goal_minutes"),
            "stand_goal_pct": ratio("stand_hours", "stand_goal_hours"),
        }
    )


def type_deletes(bronze: DataFrame) -> DataFrame:
    return route(bronze, "deletes").select(
        *ENVELOPE, body("uuid", "string", "deleted_uuid"), body("sample_type", "string")
    )


def type_sleep_sessions(bronze: DataFrame) -> DataFrame:
    """One row per session, stage minutes summed inside the array, stages kept."""
    sessions = route(bronze, "sleep").select(
        *ENVELOPE,
        body("start_date", "timestamp", "start_ts"),
        body("end_date", "timestamp", "end_ts"),
        body("stages", STAGE_ARRAY),
    )

    def minutes_in(stage: str) -> Column:
        def add(total: Column, s: Column) -> Column:
            start = cast_or_null(s["start_date"], "timestamp")
            end = cast_or_null(s["end_date"], "timestamp")
            return total + minutes_between(start, end)

        return F.aggregate(F.filter("stages", lambda s: s["stage"] == stage), F.lit(0.0), add)

    return sessions.select(
        *ENVELOPE,
        "start_ts",
        "end_ts",
        minutes_between(F.col("start_ts"), F.col("end_ts")).alias("total_duration_minutes"),
        minutes_in("asleepDeep").alias("deep_sleep_minutes"),
        minutes_in("asleepREM").alias("rem_sleep_minutes"),
        minutes_in("asleepCore").alias("core_sleep_minutes"),
        minutes_in("awake").alias("awake_minutes"),
        "stages",
        F.to_date("start_ts").alias("sleep_date"),
        F.size("stages").alias("num_stages"),
    )


# Typed table -> (record type it is built from, function).
TYPED_TABLES = {
    "bronze_typed_health_samples": ("samples", type_health_samples),
    "bronze_typed_workouts": ("workouts", type_workouts),
    "bronze_typed_sleep_stages": ("sleep", type_sleep_stages),
    "bronze_typed_activity_summaries": ("activity_summaries", type_activity_summaries),
    "bronze_typed_deletes": ("deletes", type_deletes),
}
