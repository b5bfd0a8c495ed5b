"""Streaming operators as queries: each runs a stream over the given tables to its end."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake.operators import typed
from pulselake.plans.pipeline import HealthGraph
from pulselake.plans.queries import AS_OF, publish
from pulselake.session import prepare, work_dir
from pulselake.sources import fixtures, tables
from pulselake.sources.contracts import load_table_config
from pulselake.streaming import buckets, cdc, flows, sessions, state

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


# A table arrives in so many slices, each a micro-batch of its own. The slices are
# dealt by a hash of the id, so rows come out of the order of time in all of them.
SLICES = 3


def arrivals(spark: SparkSession, sf_dir: str, folder: str) -> Iterator[DataFrame]:
    """The stream of events, once after each slice has arrived."""
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    for i in range(SLICES):
        part = fixtures.spread(table.where(F.pmod(F.xxhash64("event_id"), F.lit(SLICES)) == i))
        part.write.mode("append").parquet(f"{folder}/arrived/events.parquet")
        yield fixtures.events_stream(spark, f"{folder}/arrived")


def query(name: str):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            folder = work_dir(spark, name)
            return publish(fn(spark, arrivals(spark, sf_dir, folder), folder))

        QUERIES[name] = run
        return fn

    return register


def graph(ev: DataFrame) -> HealthGraph:
    return HealthGraph(lambda record_type: fixtures.bronze(ev, record_type), AS_OF)


def stored(spark: SparkSession, arriving: Iterator[DataFrame], attribute: str, folder: str) -> DataFrame:
    """Append a table of the graph to a folder as events arrive and read the folder."""
    for ev in arriving:
        tables.append_stream(getattr(graph(ev), attribute), f"{folder}/table", f"{folder}/checkpoint").awaitTermination()
    return tables.read_table(spark, f"{folder}/table")


def logged(arriving: Iterator[DataFrame], rows_of: Callable[[DataFrame], DataFrame], sink, folder: str) -> None:
    """Send what arrives through a sink, one micro-batch for each slice."""
    for ev in arriving:
        flows.run_batches(rows_of(ev), sink, f"{folder}/checkpoint").awaitTermination()


for _name, _attribute in [
    ("stream_typed_samples", "samples"),
    ("stream_typed_workouts", "workouts"),
    ("stream_typed_sleep_stages", "sleep_stages"),
    ("stream_typed_activity_summaries", "activity_summaries"),
    ("stream_typed_deletes", "deletes"),
    ("stream_cdc_sleep_stages", "cdc_sleep_stages"),
    ("stream_cdc_health_samples", "cdc_health_samples"),
    ("stream_passthrough", "silver_activity_summaries"),
]:
    query(_name)(lambda spark, arriving, folder, a=_attribute: stored(spark, arriving, a, folder))


@query("stream_scd1")
def _(spark, arriving, folder):
    logged(arriving, lambda ev: graph(ev).cdc_health_samples, cdc.change_sink(folder, ["uuid"]), folder)
    return cdc.read_current(spark, folder, ["uuid"])


@query("stream_scd2")
def _(spark, arriving, folder):
    logged(arriving, lambda ev: graph(ev).cdc_workouts, cdc.change_sink(folder), folder)
    return cdc.read_history(spark, folder, ["uuid"])


@query("stream_expectations")
def _(spark, arriving, folder):
    sink = flows.checked_sink(load_table_config("bronze_typed_workouts"), f"{folder}/table", f"{folder}/counts", AS_OF)
    logged(arriving, lambda ev: typed.type_workouts(fixtures.bronze(ev, "workouts")), sink, folder)
    return flows.rule_totals(spark, f"{folder}/counts")


@query("stream_sessions")
def _(spark, arriving, folder):
    logged(arriving, fixtures.intervals, cdc.change_sink(folder), folder)
    return sessions.read_sessions(spark, folder, ["user_id"])


@query("stream_scd1_state")
def _(spark, arriving, folder):
    """Keyed state: each batch gives out the keys it changes, and their buckets are rewritten."""
    path = f"{folder}/table"
    for ev in arriving:
        with state.state_store(spark):
            changed = state.latest_changes(graph(ev).cdc_health_samples, ["uuid"])
            sink = buckets.current_sink(path, ["uuid"])
            flows.run_batches(changed, sink, f"{folder}/checkpoint", mode="update").awaitTermination()
    return buckets.read_current(spark, path)


@query("stream_scd2_buckets")
def _(spark, arriving, folder):
    """History by buckets of keys: each batch chains the changes of its own keys anew."""
    sink = buckets.history_sink(f"{folder}/table", ["uuid"])
    logged(arriving, lambda ev: graph(ev).cdc_workouts, sink, folder)
    return buckets.read_history(spark, f"{folder}/table")


@query("stream_ingest_once")
def _(spark, arriving, folder):
    """Workouts of a feed in which every file of bronze rows arrives twice."""
    for ev in arriving:
        bronze = fixtures.bronze(ev, "workouts")
        first = flows.once(bronze.unionByName(bronze), delay="60 days")
        rows = typed.type_workouts(first)
        tables.append_stream(rows, f"{folder}/table", f"{folder}/checkpoint").awaitTermination()
    return tables.read_table(spark, f"{folder}/table")


# Times at which the slices of :func:`in_order` end. Every twentieth event is held back to the last one.
BOUNDS = ("2024-01-11", "2024-01-21")
HELD_BACK = 20


def in_order(spark: SparkSession, sf_dir: str, folder: str) -> Iterator[DataFrame]:
    """The stream of events in slices of time; some events come with the last slice, whatever their time.

    After the slices comes one event far ahead, which lets the watermark pass all others.
    """
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    held, ts = F.col("event_id") % HELD_BACK == 0, F.col("ts")
    early, late = (F.lit(b).cast("timestamp_ntz") for b in BOUNDS)
    ahead = table.limit(1).select(
        *[
            {"event_id": F.lit(-1).cast("long"), "ts": F.lit("2034-01-01").cast("timestamp_ntz"),
             "user_id": F.lit(-1).cast("long")}.get(c, F.col(c)).alias(c)
            for c in table.columns
        ]
    )
    slices = (
        table.where(~held & (ts < early)),
        table.where(~held & (ts >= early) & (ts < late)),
        table.where(held | (ts >= late)),
        ahead,
    )
    for part in slices:
        fixtures.spread(part).write.mode("append").parquet(f"{folder}/arrived/events.parquet")
        yield fixtures.events_stream(spark, f"{folder}/arrived")


def ordered_query(name: str):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            folder = work_dir(spark, name)
            return publish(fn(spark, in_order(spark, sf_dir, folder), folder))

        QUERIES[name] = run
        return fn

    return register


def run_sessions(spark: SparkSession, arriving: Iterator[DataFrame], folder: str) -> None:
    for ev in arriving:
        with state.state_store(spark):
            found = state.timed_sessions(fixtures.intervals(ev), ["user_id"], delay="1 hour")
            flows.run_batches(found, state.session_sink(folder, ["user_id"]), f"{folder}/checkpoint").awaitTermination()


@ordered_query("stream_timed_sessions")
def _(spark, arriving, folder):
    """Sessions by event time, of the rows that came in time."""
    run_sessions(spark, arriving, folder)
    return spark.read.parquet(f"{folder}/sessions").drop("batch_id").where("user_id <> '-1'")


@ordered_query("stream_late_rows")
def _(spark, arriving, folder):
    """The rows that came too late for their session."""
    run_sessions(spark, arriving, folder)
    return spark.read.parquet(f"{folder}/late").drop("batch_id")


@ordered_query("stream_sliding_throughput")
def _(spark, arriving, folder):
    """Closed sliding windows; a row counts in those of its windows that were open when it came."""
    for ev in arriving:
        rows = ev.select("ts", F.col("event_type").alias("platform"), "value")
        windows = flows.sliding_throughput(rows, length="10 minutes", step="5 minutes", delay="1 hour")
        tables.append_stream(windows, f"{folder}/table", f"{folder}/checkpoint").awaitTermination()
    return tables.read_table(spark, f"{folder}/table").withColumn("total", F.round("total", 4))
