"""Keyed state, bucketed tables and timed sessions on streams."""

import random
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_cdc import CHANGES, CURRENT, brute_history, feed_of, minutes
from test_streaming import arriving

from pulselake.operators.sessions import sessionize
from pulselake.streaming import buckets, flows, state


def files(path):
    return {f: f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


def run_current(spark, feed, folder, trigger=None, **options):
    emitted = []

    def sink(batch, batch_id):
        emitted.append(rows(batch, "uuid", "_deleted"))
        buckets.current_sink(f"{folder}/table", ["uuid"], 8)(batch, batch_id)

    with state.state_store(spark):
        changed = state.latest_changes(feed, ["uuid"], **options)
        query = flows.run_batches(changed, sink, f"{folder}/ck", mode="update", trigger=trigger)
    # Processing time never ends, so such a stream is stopped from outside.
    query.awaitTermination(20 if trigger else None)
    query.stop()
    return emitted


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_current_state_in_any_order(spark, tmp_path, seed):
    mixed = random.Random(seed).sample(CHANGES, len(CHANGES))
    feed = arriving(spark, f"{tmp_path}/in", mixed, batches=seed + 1)
    run_current(spark, feed, tmp_path)
    assert rows(buckets.read_current(spark, f"{tmp_path}/table"), "uuid", "v") == CURRENT

    # A restart goes on from the checkpoint: a late insert is behind its tombstone,
    # and only the key that changes is given out and rewritten.
    before = files(f"{tmp_path}/table")
    feed_of(spark, [("z", 2, "gone", 5), ("z", 30, "once", 7)]).write.mode("append").parquet(f"{tmp_path}/in")
    emitted = run_current(spark, feed, tmp_path)
    assert [x for batch in emitted for x in batch] == [("once", False)]
    want = [("once", 7) if k == "once" else (k, v) for k, v in CURRENT]
    assert rows(buckets.read_current(spark, f"{tmp_path}/table"), "uuid", "v") == want
    after = files(f"{tmp_path}/table")
    folders = {f.parent.name for f in before.items() ^ after.items() for f in f[:1]}
    assert len(folders) == 1


def test_tombstones_with_time_to_live_and_null_keys(spark, tmp_path):
    feed = arriving(spark, f"{tmp_path}/in", [("a", 1, None, 4), (None, 2, None, None), ("b", 1, "k", 1)], batches=2)
    emitted = run_current(spark, feed, tmp_path, {"processingTime": "2 seconds"}, tombstone_ttl_ms=3_600_000)
    assert rows(buckets.read_current(spark, f"{tmp_path}/table"), "uuid", "v") == [("k", 1)]
    assert sum(len(x) for x in emitted) == 2


@pytest.mark.parametrize("seed", [4, 5])
def test_history_in_any_order_and_repeated(spark, tmp_path, seed):
    mixed = random.Random(seed).sample(CHANGES, len(CHANGES))
    path = f"{tmp_path}/history"
    sink = buckets.history_sink(path, ["uuid"], buckets=8)
    flows.run_batches(arriving(spark, f"{tmp_path}/in", mixed), sink, f"{tmp_path}/ck").awaitTermination()
    assert minutes(buckets.read_history(spark, path)) == brute_history(CHANGES)

    last = feed_of(spark, mixed[-4:])
    before = files(path)
    sink(last, 2)
    assert minutes(buckets.read_history(spark, path)) == brute_history(CHANGES)
    kept = before.items() & files(path).items()
    assert kept
    of_keys = spark.read.parquet(path).where(F.col("_key.uuid").isin([c[2] for c in mixed[-4:]]))
    rewritten = {f"_bucket={r[0]}" for r in of_keys.select("_bucket").distinct().collect()}
    assert {f.parent.name for f in before} - rewritten == {f.parent.name for f, _ in kept}


def intervals(spark, data):
    """(user, id, start minute, length) as rows."""
    made = [(u, i, s * 60, (s + n) * 60) for u, i, s, n in data]
    return spark.createDataFrame(made, "user_id string, uuid string, s long, e long").select(
        "user_id", "uuid", F.timestamp_seconds("s").alias("start_ts"), F.timestamp_seconds("e").alias("end_ts")
    )


def run_sessions(spark, folder, batches, delay="60 minutes"):
    """Sessions and late rows of batches that arrive one after the other, and a last row far ahead."""
    schema = intervals(spark, []).schema
    for data in [*batches, [("clock", "tick", 100_000, 0)]]:
        intervals(spark, data).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        with state.state_store(spark):
            found = state.timed_sessions(stream, ["user_id"], delay=delay)
            flows.run_batches(found, state.session_sink(f"{folder}/out", ["user_id"]), f"{folder}/ck").awaitTermination()
    got = spark.read.parquet(f"{folder}/out/sessions").where("user_id is null or user_id <> 'clock'")
    late = spark.read.parquet(f"{folder}/out/late")
    return got, late


SESSION = ("user_id", "session_no", "session_start_ts", "session_end_ts", "stage_count")


def test_sessions_of_rows_in_time_and_late_rows(spark, tmp_path):
    rng = random.Random(9)
    data = [(rng.choice(["a", "b", None]), f"r{i}", rng.randrange(0, 900), rng.choice([1, 5, 20, 90])) for i in range(120)]
    # The watermark covers two hours of disorder; rows come in shuffled slices of an hour.
    slices = [[d for d in data if d[2] // 180 == n] for n in range(5)]
    for part in slices:
        rng.shuffle(part)
    moved = [d for d in slices[1] if d[2] > 300][:3]  # within the delay of an hour after slice 1
    too_late = slices[0][:4]
    slices[0] = slices[0][4:]
    slices[1] = [d for d in slices[1] if d not in moved]
    slices[2] = slices[2] + [d for d in moved if d[2] >= max(x[2] for x in slices[1]) - 60]
    lost = [d for d in moved if d not in slices[2]]
    slices[3] = slices[3] + too_late + lost
    got, late = run_sessions(spark, tmp_path, slices)
    in_time = [d for d in data if d not in too_late and d not in lost]
    assert rows(got, *SESSION) == rows(sessionize(intervals(spark, in_time), ["user_id"]), *SESSION)
    assert rows(late, "uuid") == sorted((d[1],) for d in too_late + lost)


def test_session_rules_across_batches(spark, tmp_path):
    """A gap of exactly the limit, a long row that holds a short one, and equal starts, each in a batch of its own."""
    batches = [
        [("a", "1", 0, 10)], [("a", "2", 40, 100)], [("a", "3", 50, 1)], [("a", "4", 82, 1)], [("a", "5", 82, 2)],
        [("a", "6", 400, 5)],
    ]
    got, late = run_sessions(spark, tmp_path, batches, delay="10 minutes")
    every = [d for b in batches for d in b]
    assert rows(got, *SESSION) == rows(sessionize(intervals(spark, every), ["user_id"]), *SESSION)
    assert got.count() == 3 and late.count() == 0
