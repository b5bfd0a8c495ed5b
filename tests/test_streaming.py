import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_cdc import CHANGES, CURRENT, brute_history, feed_of, minutes

from pulselake.operators import quality, typed
from pulselake.operators import sessions as batch_sessions
from pulselake.sources import fixtures, tables
from pulselake.sources.contracts import load_table_config
from pulselake.streaming import cdc, flows, sessions

DATA = "/root/testdata/sf0.001"


def arriving(spark, folder, changes, batches=3):
    """A feed that arrives in several files, one per micro-batch."""
    size = -(-len(changes) // batches)
    for i in range(batches):
        feed_of(spark, changes[i * size : (i + 1) * size]).coalesce(1).write.mode("append").parquet(folder)
    schema = spark.read.parquet(folder).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.mark.parametrize("seed", [1, 2])
def test_scd1_in_any_order(spark, tmp_path, seed):
    mixed = random.Random(seed).sample(CHANGES, len(CHANGES))
    feed = arriving(spark, f"{tmp_path}/in", mixed)
    path = f"{tmp_path}/state"
    sink = cdc.change_sink(path, ["uuid"])
    flows.run_batches(feed, sink, f"{tmp_path}/ck").awaitTermination()
    assert rows(cdc.read_current(spark, path, ["uuid"]), "uuid", "v") == CURRENT
    cdc.compact(spark, path, ["uuid"])
    assert rows(cdc.read_current(spark, path, ["uuid"]), "uuid", "v") == CURRENT

    # A late insert and a replayed batch change nothing, and earlier folders stay as they are.
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "state/changes").rglob("*.parquet")}
    late = feed_of(spark, [("z", 2, "gone", 5)])
    late.write.mode("append").parquet(f"{tmp_path}/in")
    flows.run_batches(feed, sink, f"{tmp_path}/ck").awaitTermination()
    assert rows(cdc.read_current(spark, path, ["uuid"]), "uuid", "v") == CURRENT
    assert before.items() <= {f: f.stat().st_mtime_ns for f in (tmp_path / "state/changes").rglob("*.parquet")}.items()
    sink(late, 3)
    assert rows(cdc.read_current(spark, path, ["uuid"]), "uuid", "v") == CURRENT


def test_unfinished_batches_do_not_count(spark, tmp_path):
    path = f"{tmp_path}/state"
    cdc.change_sink(path, ["uuid"])(feed_of(spark, CHANGES), 0)
    feed_of(spark, [("z", 99, "gone", 5)]).write.parquet(f"{path}/changes/batch_id=1")
    assert rows(cdc.read_current(spark, path, ["uuid"]), "uuid", "v") == CURRENT


def test_scd2_in_any_order_and_replayed(spark, tmp_path):
    mixed = random.Random(4).sample(CHANGES, len(CHANGES))
    path = f"{tmp_path}/history"
    sink = cdc.change_sink(path)
    flows.run_batches(arriving(spark, f"{tmp_path}/in", mixed), sink, f"{tmp_path}/ck").awaitTermination()
    assert minutes(cdc.read_history(spark, path, ["uuid"])) == brute_history(CHANGES)
    again = spark.read.parquet(f"{path}/changes/batch_id=2")
    sink(spark.createDataFrame(again.collect(), again.schema), 2)
    assert minutes(cdc.read_history(spark, path, ["uuid"])) == brute_history(CHANGES)


def test_other_sequence_column(spark, tmp_path):
    feed = feed_of(spark, CHANGES).withColumnRenamed("ingested_at", "seen_at")
    path = f"{tmp_path}/log"
    cdc.change_sink(path, ["uuid"], "seen_at")(feed, 0)
    assert rows(cdc.read_current(spark, path, ["uuid"], "seen_at"), "uuid", "v") == CURRENT


@pytest.mark.parametrize("parts", [1, 3])
def test_stream_reads_the_whole_table(spark, tmp_path, parts):
    """As a folder of several files, and as one file."""
    table = spark.read.parquet(f"{DATA}/events.parquet")
    table.repartition(3).write.parquet(f"{tmp_path}/folder/events.parquet")
    sf_dir = DATA if parts == 1 else f"{tmp_path}/folder"
    got = tables.append_stream(fixtures.events_stream(spark, sf_dir), f"{tmp_path}/t{parts}", f"{tmp_path}/ck{parts}")
    got.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/t{parts}").count() == table.count()


def test_stored_sessions_are_exact(spark, tmp_path):
    """A long interval that contains a short one; rows arrive out of order."""
    from test_sessions import intervals

    spans = [("a", 0, 100), ("a", 10, 20), ("a", 60, 70), (None, 5, 6), ("a", 300, 310), ("a", 320, 330)]
    sink, path = cdc.change_sink(f"{tmp_path}/log"), f"{tmp_path}/log"
    for i, part in enumerate((spans[3:], spans[:2], spans[2:3])):
        sink(intervals(spark, part), i)
    whole = batch_sessions.sessionize(intervals(spark, spans), ["user_id"])
    assert rows(sessions.read_sessions(spark, path, ["user_id"])) == rows(whole)


def test_rules_counted_while_streaming(spark, tmp_path):
    cfg = load_table_config("bronze_typed_workouts")
    as_of = "2024-02-01 00:00:00"
    batch = typed.type_workouts(fixtures.bronze(fixtures.events(spark, DATA), "workouts"))
    stream = typed.type_workouts(fixtures.bronze(fixtures.events_stream(spark, DATA), "workouts"))
    sink = flows.checked_sink(cfg, f"{tmp_path}/t", f"{tmp_path}/c", as_of)
    flows.run_batches(stream, sink, f"{tmp_path}/ck").awaitTermination()
    assert rows(flows.rule_totals(spark, f"{tmp_path}/c")) == rows(quality.expectation_report(batch, cfg, as_of))
    assert spark.read.parquet(f"{tmp_path}/t").count() == batch.count()

    watched = quality.apply_contract(stream, cfg, as_of, observe=True).drop("metadata")
    query = tables.append_stream(watched, f"{tmp_path}/o", f"{tmp_path}/ck2")
    query.awaitTermination()
    counted = flows.observed_counts(query, cfg["table"]["name"])
    expected = {r.rule: r.violations for r in quality.expectation_report(batch, cfg, as_of).collect()}
    assert counted.pop("rows") == batch.count()
    assert counted == expected


def test_variant_tables_round_trip_as_stream(spark, tmp_path):
    fixtures.bronze(fixtures.events(spark, DATA)).write.parquet(f"{tmp_path}/raw")
    stream = tables.read_bronze_stream(spark, f"{tmp_path}/raw")
    tables.append_stream(typed.type_deletes(stream), f"{tmp_path}/t", f"{tmp_path}/ck").awaitTermination()
    stored = rows(tables.read_table(spark, f"{tmp_path}/t"))
    assert stored == rows(typed.type_deletes(tables.read_bronze(spark, f"{tmp_path}/raw")))
    assert len(stored) > 0
