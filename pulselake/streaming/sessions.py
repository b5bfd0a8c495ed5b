"""Gap sessions on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake.operators.sessions import sessionize
from pulselake.streaming.cdc import _stored_changes


def sessionize_stream(
    df: DataFrame,
    by: list[str],
    start: str = "start_ts",
    end: str = "end_ts",
    gap_seconds: int = 1800,
    watermark: str | None = None,
) -> DataFrame:
    """Sessions through Spark's own session windows.

    Each row holds its session open until its end plus the gap; a row that
    starts exactly then still belongs to it. This is the batch rule, but for one
    case: when a long row contains a later short one, the long row's end counts
    here, while the batch operator looks at the previous row only. For the exact
    rule store the rows and use :func:`read_sessions`.

    With a watermark a session is final once no row can join it any more (output
    mode ``append``); rows that arrive later than it are lost, so it has to
    cover the latest upload. Without one, use output mode ``complete``.
    """
    length = F.unix_micros(F.col(end)) - F.unix_micros(F.col(start))
    seconds = (length / F.lit(1_000_000) + F.lit(gap_seconds)).cast("decimal(18,6)")
    gap = F.make_interval(secs=seconds)
    rows = df.withWatermark(start, watermark) if watermark else df
    grouped = rows.groupBy(*by, F.session_window(F.col(start), gap).alias("w")).agg(
        F.min(start).alias("session_start_ts"),
        F.max(end).alias("session_end_ts"),
        F.count(F.lit(1)).alias("stage_count"),
    )
    return grouped.drop("w")


def read_sessions(spark: SparkSession, path: str, by: list[str], **rule) -> DataFrame:
    """Exact sessions of the rows that a stream has stored with ``change_sink``, however late they came."""
    rows, _ = _stored_changes(spark, path)
    return sessionize(rows, by, **rule)
