"""Operational questions about bronze rows, telemetry and payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.functions import codes
from pulselake.functions.scalars import field
from pulselake.operators.ingest import platform_of
from pulselake.operators.skew import union_all

def _rows(name: str = "row_count") -> Column:
    return F.count(F.lit(1)).alias(name)


def count_platform(bronze: DataFrame, platform: str) -> DataFrame:
    """Rows of one platform, also those that name it only in their headers."""
    return platform_of(bronze).where(F.col("source_platform") == platform).agg(_rows("total_rows"))


def record_type_summary(bronze: DataFrame) -> DataFrame:
    """Rows and first and last arrival per record type, most frequent first."""
    return (
        bronze.groupBy("record_type")
        .agg(_rows("cnt"), F.min("ingested_at").alias("earliest"), F.max("ingested_at").alias("latest"))
        .orderBy(F.desc("cnt"), "record_type")
    )


def record_type_coverage(bronze: DataFrame) -> DataFrame:
    """Rows and first and last data date per record type; dates compare as text.

    The least of texts needs sorted rows, so the rows of a date are counted first, which
    needs none; few are left to sort.
    """
    dated = bronze.groupBy("record_type", field("body", "date", "string").alias("day")).agg(_rows("n"))
    return (
        dated.groupBy("record_type")
        .agg(F.sum("n").alias("cnt"), F.min("day").alias("earliest_date"), F.max("day").alias("latest_date"))
        .orderBy(F.desc("cnt"), "record_type")
    )


def source_matrix(bronze: DataFrame) -> DataFrame:
    """Rows per platform and record type; rows without a platform are a group."""
    return (
        platform_of(bronze)
        .groupBy(F.col("source_platform").alias("platform"), "record_type")
        .agg(_rows("cnt"))
        .orderBy("platform", "record_type")
    )


def ingest_cube(bronze: DataFrame) -> DataFrame:
    """Rows and first and last arrival for every grouping of platform, record type and day, in one pass.

    ``grouping_id`` tells subtotals from groups whose value is NULL: bit 4 for a
    total over platforms, 2 over record types, 1 over days.
    """
    rows = platform_of(bronze).select(
        F.col("source_platform").alias("platform"), "record_type", F.to_date("ingested_at").alias("day"), "ingested_at"
    )
    return rows.cube("platform", "record_type", "day").agg(
        F.grouping_id().alias("grouping_id"),
        _rows("cnt"),
        F.min("ingested_at").alias("earliest"),
        F.max("ingested_at").alias("latest"),
    )


def metric_catalog(metrics: DataFrame, since: str | None = None) -> DataFrame:
    """Rows per metric name, type, unit and description."""
    return _signal_counts(
        metrics, since, F.col("name").alias("metric_name"), "metric_type", "unit", "description"
    )


def log_summary(logs: DataFrame, since: str | None = None) -> DataFrame:
    """Rows per severity and event name."""
    return _signal_counts(logs, since, "severity_text", "event_name")


def span_summary(spans: DataFrame, since: str | None = None) -> DataFrame:
    """Rows per span name, kind and status code."""
    return _signal_counts(
        spans, since, F.col("name").alias("span_name"), "kind", F.col("status.code").alias("status_code")
    )


def _signal_counts(df: DataFrame, since: str | None, *groups) -> DataFrame:
    rows = df if since is None else df.where(F.col("date") >= F.lit(since).cast("date"))
    counted = rows.groupBy(*groups).agg(_rows())
    return counted.orderBy(F.desc("row_count"), *[c for c in counted.columns if c != "row_count"])


def table_overview(tables: dict[str, DataFrame], since: str | None = None) -> DataFrame:
    """Rows and first and last date of several tables."""
    parts = []
    for name, df in tables.items():
        rows = df if since is None else df.where(F.col("date") >= F.lit(since).cast("date"))
        parts.append(
            rows.agg(_rows(), F.min("date").alias("min_date"), F.max("date").alias("max_date")).select(
                F.lit(name).alias("table_name"), "*"
            )
        )
    return union_all(parts)


def search_logs(logs: DataFrame, pattern: str, n: int = 5) -> DataFrame:
    """The newest ``n`` log rows whose text is LIKE a pattern."""
    return (
        logs.select("time", _log_text(logs))
        .where(F.col("body_text").like(pattern))
        .orderBy(F.desc("time"), "body_text")
        .limit(n)
    )


def _log_text(logs: DataFrame) -> Column:
    body = F.col("body")
    if logs.schema["body"].dataType.typeName() == "variant":
        body = body.cast("string")
    return body.alias("body_text")


def sample_rows(bronze: DataFrame, platform: str, n: int = 5) -> DataFrame:
    """A few rows of a platform, lowest record ids first so the choice is repeatable."""
    return (
        platform_of(bronze)
        .where(F.col("source_platform") == platform)
        .orderBy("record_id")
        .limit(n)
        .select(
            "record_id",
            "record_type",
            field("body", "source", "string").alias("source"),
            field("body", "date", "string").alias("data_date"),
        )
    )


def payload_summary(records: DataFrame, payload_id: str) -> DataFrame:
    """Per payload: record count and a text such as ``6 samples (3 HeartRate, 3 StepCount)``.

    Records are counted per payload and type first; the text then joins one
    entry per type that occurs.
    """
    short = F.replace("sample_type", F.lit(codes.QUANTITY_PREFIX), F.lit(""))
    counts = records.groupBy(payload_id, short.alias("short_type")).agg(_rows("n"))
    total = F.sum("n")
    types = F.array_join(
        F.transform(
            F.array_sort(F.collect_list(F.struct("short_type", "n"))),
            lambda x: F.concat_ws(" ", x["n"].cast("string"), x["short_type"]),
        ),
        ", ",
    )
    return counts.groupBy(payload_id).agg(total.alias("record_count"), types.alias("types")).select(
        payload_id,
        "record_count",
        F.concat(
            F.col("record_count").cast("string"),
            F.when(F.col("record_count") > 1, " samples (").otherwise(" sample ("),
            "types",
            F.lit(")"),
        ).alias("description"),
    )
