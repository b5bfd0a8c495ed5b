"""Stateless streaming flows: typing, change feeds, passthrough and rule counts."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulselake.operators.quality import expect_or_drop, holds
from pulselake.sources.contracts import get_expectations_drop, get_expectations_warn

AVAILABLE_NOW = {"availableNow": True}


def run_batches(
    df: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start a stream whose micro-batches go to ``sink(batch, batch_id)``."""
    writer = df.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or AVAILABLE_NOW)).start()


def checked_sink(cfg: dict[str, Any], table: str, counts: str, as_of: str | None = None):
    """Sink that applies the rules of a contract and counts their violations in the same pass.

    Every micro-batch writes its rows to ``table/batch_id=<n>`` and one row per
    rule to ``counts/batch_id=<n>``. A replayed batch overwrites its own folders,
    so nothing is stored or counted twice.
    """
    drop, warn = get_expectations_drop(cfg, as_of), get_expectations_warn(cfg, as_of)
    actions = {**{r: "drop" for r in drop}, **{r: "warn" for r in warn}}

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        violations = [F.count_if(~holds(rule)).alias(name) for name, rule in {**drop, **warn}.items()]
        watched = batch.observe(seen, F.count(F.lit(1)).alias("_rows"), *violations)
        expect_or_drop(watched, drop).write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")
        numbers = seen.get
        report = [
            (cfg["table"]["name"], action, rule, numbers["_rows"], numbers[rule]) for rule, action in actions.items()
        ]
        batch.sparkSession.createDataFrame(
            report, "table_name string, action string, rule string, total_rows bigint, violations bigint"
        ).coalesce(1).write.mode("overwrite").parquet(f"{counts}/batch_id={batch_id}")

    return write


def rule_totals(spark, counts: str) -> DataFrame:
    """Rule counts summed over all micro-batches."""
    stored = spark.read.parquet(counts)
    return stored.groupBy("table_name", "action", "rule").agg(
        F.sum("total_rows").alias("total_rows"), F.sum("violations").alias("violations")
    )


def once(df: DataFrame, ident: str = "record_id", at: str = "ingested_at", delay: str = "1 day") -> DataFrame:
    """Rows whose id has not come before: a file that is sent again changes nothing.

    Ids are remembered until the watermark, ``delay`` behind the latest arrival,
    has passed them, so the state is bounded by the rows of that time. A row
    behind the watermark is dropped, so the delay has to cover the latest repeat.
    """
    return df.withWatermark(at, delay).dropDuplicatesWithinWatermark([ident])


def sliding_throughput(
    df: DataFrame, at: str = "ts", length: str = "5 minutes", step: str = "1 minute", delay: str | None = None
) -> DataFrame:
    """Rows and sum of ``value`` by platform and sliding window, batch or stream.

    On a stream with a ``delay`` a window is final once the watermark has passed
    its end: output mode ``append`` gives it once, ``update`` each time it changes.
    A row counts in those of its windows that are still open.
    """
    rows = df.withWatermark(at, delay) if delay else df
    counted = rows.groupBy(F.window(F.col(at), length, step).alias("w"), "platform").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("value").alias("total")
    )
    return counted.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "platform", "n_rows", "total"
    )


def observed_counts(query: StreamingQuery, name: str) -> dict[str, int]:
    """Counts of :func:`pulselake.operators.quality.expect` summed over the reported micro-batches."""
    totals: dict[str, int] = {}
    for progress in query.recentProgress:
        row = progress.observedMetrics.get(name)
        for key, value in (row.asDict() if row is not None else {}).items():
            totals[key] = totals.get(key, 0) + value
    return totals
