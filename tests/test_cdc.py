import itertools
import random

from conftest import rows
from pyspark.sql import functions as F

from pulselake.operators import cdc, skew

DDL = "record_id string, ingested_at timestamp, uuid string, v int, operation string"


def at(n):
    return f"2024-01-01 {n // 60:02d}:{n % 60:02d}:00"


def feed_of(spark, changes):
    """Changes as (record id, minute, key, value or None for a delete)."""
    data = [(r, at(n), k, v, "DELETE" if v is None else "INSERT") for r, n, k, v in changes]
    text = DDL.replace("ingested_at timestamp", "ingested_at string")
    return spark.createDataFrame(data, text).withColumn("ingested_at", F.col("ingested_at").cast("timestamp"))


CHANGES = [
    ("a", 1, "once", 1),
    ("b", 1, "updated", 1), ("c", 5, "updated", 2),
    ("d", 1, "gone", 1), (None, 3, "gone", None),
    ("e", 1, "back", 1), (None, 3, "back", None), ("f", 7, "back", 2),
    (None, 1, "early", None), ("g", 4, "early", 9),
    ("h", 1, "twice", 1), (None, 3, "twice", None), (None, 6, "twice", None),
    ("i", 2, "tie", 1), (None, 2, "tie", None),
    ("j", 2, "tie2", 1), ("k", 2, "tie2", 5),
    (None, 2, "orphan", None),
    ("l", 1, "copy", 3), ("l", 1, "copy", 3),
    ("m", 1, "resent", 3), ("n", 2, "resent", 3),
]
CURRENT = [("back", 2), ("copy", 3), ("early", 9), ("once", 1), ("resent", 3), ("tie2", 5), ("updated", 2)]


def brute_history(changes):
    out = []
    for key, group in itertools.groupby(sorted(changes, key=lambda c: c[2]), key=lambda c: c[2]):
        winners = {}
        for r, n, _, v in group:
            order = (v is None, r or "")
            if n not in winners or order > winners[n][0]:
                winners[n] = (order, v)
        times = sorted(winners)
        for i, n in enumerate(times):
            v = winners[n][1]
            if v is not None:
                end = times[i + 1] if i + 1 < len(times) else None
                out.append((key, v, n, end, end is not None and winners[end][1] is None))
    return sorted(out, key=repr)


def minutes(history):
    minute = lambda c: (F.unix_timestamp(c) - F.unix_timestamp(F.lit("2024-01-01 00:00:00"))).cast("int") / 60
    return rows(
        history.select("uuid", "v", minute("__START_AT").cast("int"), minute("__END_AT").cast("int"), "__IS_DELETED")
    )


def test_scd1_cases(spark):
    state = cdc.apply_scd1(feed_of(spark, CHANGES), ["uuid"])
    assert state.columns == ["ingested_at", "uuid", "v"]
    assert rows(state, "uuid", "v") == CURRENT


def test_scd2_cases(spark):
    history = cdc.apply_scd2(feed_of(spark, CHANGES), ["uuid"])
    assert minutes(history) == brute_history(CHANGES)
    resent = [r for r in minutes(history) if r[0] == "resent"]
    assert resent == [("resent", 3, 1, 2, False), ("resent", 3, 2, None, False)]


def test_any_order_of_arrival(spark):
    for seed in range(3):
        mixed = random.Random(seed).sample(CHANGES, len(CHANGES))
        assert rows(cdc.apply_scd1(feed_of(spark, mixed), ["uuid"]), "uuid", "v") == CURRENT
        assert minutes(cdc.apply_scd2(feed_of(spark, mixed), ["uuid"])) == brute_history(CHANGES)


def test_hot_keys_in_chunks(spark):
    draw = random.Random(5)
    changes = [
        (f"r{i:03d}" if v else None, draw.randrange(600), draw.choice("xyyyyy"), v)
        for i in range(300)
        for v in [draw.choice([None, 1, 2, 3])]
    ]
    feed = feed_of(spark, changes)
    for chunk in ("minute", "hour", "day", "year"):
        assert minutes(cdc.apply_scd2(feed, ["uuid"], chunk=chunk)) == brute_history(changes)


def test_history_answers_like_the_state_at_that_time(spark):
    feed = feed_of(spark, CHANGES)
    history = cdc.apply_scd2(feed, ["uuid"])
    for n in (1, 2, 3, 6):
        until = feed.where(F.col("ingested_at") <= F.lit(at(n)).cast("timestamp"))
        assert rows(cdc.as_of(history, at(n)), "uuid", "v") == rows(cdc.apply_scd1(until, ["uuid"]), "uuid", "v")
    assert rows(cdc.current_state(history, ["uuid"]), "uuid", "v") == CURRENT


def test_feed_columns_of_deletes(spark):
    inserts = feed_of(spark, CHANGES[:1]).drop("operation")
    deletes = spark.sql(
        "SELECT 'd1' record_id, TIMESTAMP '2024-01-02' ingested_at, 'u' user_id, x deleted_uuid, t sample_type "
        "FROM VALUES ('p', 'HKQuantityTypeIdentifierVO2Max'), ('q', 'HKWorkoutTypeIdentifier'), "
        "('r', 'HKCategoryTypeIdentifierAppleStandHour'), ('s', NULL) AS d(x, t)"
    )
    feed = cdc.cdc_health_samples(inserts, deletes)
    assert rows(feed.where("operation = 'DELETE'"), "uuid", "record_id", "v") == [("p", None, None)]
    both = cdc.cdc_health_samples(inserts, deletes, stand_hours=True)
    assert rows(both.where("operation = 'DELETE'"), "uuid") == [("p",), ("r",)]


def test_anti_join_paths_agree(spark):
    left = spark.sql("SELECT id, CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE concat('k', id) END k FROM range(90)")
    for right in ("SELECT 'hot' x", "SELECT concat('k', id * 2) x FROM range(30) UNION ALL SELECT NULL"):
        right = spark.sql(right)
        expected = rows(left.join(right, left.k == right.x, "left_anti"))
        assert rows(skew.anti_join(left, right, "k", "x")) == expected


def test_backfill_twice_changes_nothing(spark):
    runs = spark.createDataFrame([("a", None, None), ("b", 7, None), ("c", None, 1)], "run_id string, s int, e int")
    fixes = spark.createDataFrame([("a", 2, 4), ("b", 3, 5)], "run_id string, s int, e int")
    once = cdc.backfill_nulls(runs, fixes, "run_id", "s", ["s", "e"])
    assert rows(once) == [("a", 2, 4), ("b", 7, None), ("c", None, 1)]
    assert rows(cdc.backfill_nulls(once, fixes, "run_id", "s", ["s", "e"])) == rows(once)
