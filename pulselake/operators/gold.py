"""Sleep sessions, quarantine of orphan deletes, match report and daily summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.functions import codes
from pulselake.functions.scalars import minutes_between
from pulselake.operators.skew import anti_join, union_all
from pulselake.operators.typed import STAGES

SESSION_KEYS = ["user_id", "source_platform", "session_start_ts", "session_end_ts", "sleep_date"]


def sleep_sessions(stages: DataFrame) -> DataFrame:
    """One row per session from its current stages, one hash aggregate.

    A stage kind that does not occur has NULL minutes and count 0. Unknown
    stage names count in the totals only. Efficiency is NULL for sessions that
    do not last longer than 0 seconds and may exceed 1 when stages overlap.
    """
    minutes = {f"{short}_sleep_minutes" if short != "awake" else "awake_minutes": stage for stage, short in STAGES.items()}
    sums = [
        F.sum(F.when(F.col("stage") == stage, F.col("stage_duration_minutes"))).alias(name)
        for name, stage in minutes.items()
    ]
    counts = [F.count_if(F.col("stage") == stage).alias(f"{short}_stage_count") for stage, short in STAGES.items()]
    grouped = stages.groupBy(*SESSION_KEYS).agg(
        *sums,
        F.sum("stage_duration_minutes").alias("total_tracked_minutes"),
        F.count(F.lit(1)).alias("stage_count"),
        *counts,
    )
    asleep = [F.coalesce(f"{s}_sleep_minutes", F.lit(0.0)) for s in ("deep", "rem", "core")]
    derived = grouped.withColumns(
        {
            "session_duration_minutes": minutes_between(F.col("session_start_ts"), F.col("session_end_ts")),
            "total_sleep_minutes": asleep[0] + asleep[1] + asleep[2],
        }
    )
    longer_than_zero = F.col("session_duration_minutes") > 0
    return derived.withColumn(
        "sleep_efficiency",
        F.when(longer_than_zero, F.try_divide("total_sleep_minutes", "session_duration_minutes")),
    )


def delete_target(sample_type: Column) -> Column:
    """Table a delete event aims at."""
    return (
        F.when(sample_type.startswith("HKQuantityType"), "silver_health_samples")
        .when(sample_type == codes.WORKOUT_TYPE, "silver_workouts")
        .when(sample_type == codes.SLEEP_TYPE, "silver_sleep_stages")
        .otherwise("unknown")
    )


def known_uuids(samples: DataFrame, workouts: DataFrame, stages: DataFrame) -> DataFrame:
    """Ids of all typed tables, one column, duplicates kept."""
    return (
        samples.select("uuid")
        .unionAll(workouts.select("uuid"))
        .unionAll(stages.select(F.col("stage_uuid").alias("uuid")))
    )


def unmatched_deletes(
    deletes: DataFrame, samples: DataFrame, workouts: DataFrame, stages: DataFrame
) -> DataFrame:
    """Delete events whose id is in no typed table, whatever type or time they name."""
    orphans = anti_join(deletes, known_uuids(samples, workouts, stages), "deleted_uuid", "uuid")
    return orphans.withColumns(
        {
            "target_table": delete_target(F.col("sample_type")),
            "reason": F.lit("no matching uuid in target"),
        }
    )


def delete_match_report(
    deletes: DataFrame, samples: DataFrame, workouts: DataFrame, stages: DataFrame
) -> DataFrame:
    """Per target table: delete events, distinct ids, ids found in that table, share in percent.

    Both sides are grouped to unique (table, id) pairs by one key, so the join
    needs no further shuffle and no pair is large.
    """
    asked = (
        deletes.select(delete_target(F.col("sample_type")).alias("target_table"), F.col("deleted_uuid").alias("uuid"))
        .groupBy("target_table", "uuid")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    sources = {
        "silver_health_samples": samples.select("uuid"),
        "silver_workouts": workouts.select("uuid"),
        "silver_sleep_stages": stages.select(F.col("stage_uuid").alias("uuid")),
    }
    present = (
        union_all([df.select(F.lit(t).alias("target_table"), "uuid") for t, df in sources.items()])
        .groupBy("target_table", "uuid")
        .agg(F.lit(1).alias("found"))
    )
    return (
        asked.join(present, ["target_table", "uuid"], "left")
        .groupBy("target_table")
        .agg(
            F.sum("n").alias("delete_events"),
            F.count(F.lit(1)).alias("distinct_uuids"),
            F.count("found").alias("matched_uuids"),
        )
        .withColumn("matched_pct", F.col("matched_uuids") * F.lit(100.0) / F.col("distinct_uuids"))
    )


# Sample types that count as steps, active energy and distance.
DAILY_TOTALS = {
    "total_steps": ["StepsRecord", "HKQuantityTypeIdentifierStepCount"],
    "active_calories_burned_kcal": ["ActiveCaloriesBurnedRecord", "HKQuantityTypeIdentifierActiveEnergyBurned"],
    "total_distance_meters": ["DistanceRecord", "HKQuantityTypeIdentifierDistanceWalkingRunning"],
}


def daily_summary(samples: DataFrame, tz: str, first_day: str, last_day: str) -> DataFrame:
    """Totals per user and local day, with a row for every day of the range.

    A sample belongs to the local day it starts on. Users are those with any
    sample in the input.
    """
    first, last = F.lit(first_day).cast("date"), F.lit(last_day).cast("date")
    local_day = F.to_date(F.from_utc_timestamp("start_ts", tz))
    relevant = [t for types in DAILY_TOTALS.values() for t in types]
    counts = F.col("sample_type").isin(relevant) & local_day.between(first, last)
    totals = [
        F.sum(F.when(F.col("sample_type").isin(types), F.col("value")).otherwise(0.0)).alias(name)
        for name, types in DAILY_TOTALS.items()
    ]
    # Samples that do not count share one group without a day, so users who have
    # only such samples are kept and the input is read once.
    measured = samples.groupBy("user_id", F.when(counts, local_day).alias("date")).agg(*totals)
    entry = F.struct("date", F.struct(*DAILY_TOTALS).alias("totals"))
    # At most one entry per day of the range.
    per_user = measured.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("date").isNotNull(), entry))).alias("by_day")
    )
    spread = per_user.select("user_id", "by_day", F.explode(F.sequence(first, last)).alias("date"))
    found = F.element_at("by_day", F.col("date"))
    return spread.select(
        "user_id",
        "date",
        F.lit(tz).alias("timezone"),
        F.coalesce(found["total_steps"], F.lit(0.0)).cast("long").alias("total_steps"),
        *[F.coalesce(found[c], F.lit(0.0)).alias(c) for c in list(DAILY_TOTALS)[1:]],
    )
