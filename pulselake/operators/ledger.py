"""Sync statistics from sync events (one event per upload)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.functions import codes
from pulselake.functions.scalars import type_label
from pulselake.sources.ndjson import parse_line, split_lines

# Field of a payload line that names its kind, per record type and platform.
BREAKDOWN_FIELDS = {
    "ios": {"samples": "type", "workouts": "activity_type", "deletes": "sample_type"},
    "android": {"samples": "type", "workouts": "exercise_type", "deletes": "record_type"},
}
# Record types that only add up their record counts, and under which label.
COUNT_ONLY = {"sleep": "sessions", "activity_summaries": "days", "daily_summaries": "days"}


def sync_totals(events: DataFrame) -> DataFrame:
    """Records sent and time of the last sync per record type."""
    return events.groupBy("record_type").agg(
        F.sum("record_count").alias("total_records"), F.max("timestamp").alias("last_sync")
    )


def sync_breakdown(events: DataFrame, platform: str = "ios") -> DataFrame:
    """Counts per kind inside the payload lines, per record type.

    Lines that are no JSON object or lack the field are skipped. Sleep and
    summaries have no kinds; their record counts are summed instead.
    """
    fields = BREAKDOWN_FIELDS[platform]
    lines = events.where(F.col("record_type").isin(list(fields))).select(
        "record_type",
        F.explode(F.transform(split_lines(F.col("ndjson_payload")), parse_line)).alias("v"),
    )
    per_type: Column = F.lit(None).cast("string")
    for record_type, name in fields.items():
        value = F.try_variant_get("v", f"$.{name}", "variant")
        text = F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get("v", f"$.{name}", "string"))
        per_type = F.when(F.col("record_type") == record_type, text).otherwise(per_type)
    kinds = (
        lines.select("record_type", per_type.alias("kind"))
        .where(F.col("kind").isNotNull())
        .groupBy("record_type", "kind")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    label = F.element_at(F.create_map(*[F.lit(x) for kv in COUNT_ONLY.items() for x in kv]), F.col("record_type"))
    counted = (
        events.where(F.col("record_type").isin(list(COUNT_ONLY)))
        .groupBy("record_type", label.alias("kind"))
        .agg(F.sum("record_count").alias("count"))
    )
    return kinds.unionByName(counted)


def breakdown(counts: DataFrame, record_type: str) -> DataFrame:
    """Breakdown of one record type with readable labels, largest first."""
    return (
        counts.where(F.col("record_type") == record_type)
        .select(type_label(F.col("kind")).alias("label"), "count")
        .orderBy(F.desc("count"), "label")
    )


def category_overview(events: DataFrame) -> DataFrame:
    """All known record types with their totals, 0 where nothing was sent yet."""
    listed = [
        F.struct(
            F.lit(i).alias("position"), F.lit(t).alias("record_type"), F.lit(label).alias("display_name")
        )
        for i, (t, label) in enumerate(codes.RECORD_TYPE_LABELS.items())
    ]
    names = events.sparkSession.range(1).select(F.inline(F.array(*listed)))
    return (
        names.join(sync_totals(events), "record_type", "left")
        .select(
            "position",
            "record_type",
            "display_name",
            F.coalesce("total_records", F.lit(0)).alias("total_records"),
            "last_sync",
        )
        .orderBy("position")
    )


def last_payload(events: DataFrame) -> DataFrame:
    """The newest event per record type, payload included.

    The newest event of each type is found by its time and id alone; only
    these few events are then fetched with their payloads.
    """
    newest = events.groupBy("record_type").agg(F.max(F.struct("timestamp", "id")).alias("_newest"))
    wanted = newest.select(F.col("record_type").alias("_type"), F.col("_newest.id").alias("_id"))
    return events.join(wanted, (F.col("id") == F.col("_id")) & F.col("record_type").eqNullSafe(F.col("_type")), "left_semi")


def recent_events(events: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` newest events without payloads."""
    return events.drop("ndjson_payload").orderBy(F.desc("timestamp"), F.desc("id")).limit(n)
