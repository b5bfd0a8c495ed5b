import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pulselake.functions.scalars import preview
from pulselake.operators.reconcile import reconcile
from pulselake.operators.sketches import HLL_BITS, HLL_ERROR, KLL_ERROR, daily_sketches, merged, quantile
from pulselake.sources.clustering import files_for, store_by_contract, write_clustered
from pulselake.sources import tables
from pulselake.sources.contracts import ensure_table, load_table_config
from pulselake.streaming import cdc


def test_filters_on_each_column_skip_files(spark, tmp_path):
    rng = random.Random(1)
    data = [(f"user{rng.randrange(200):03d}", rng.randrange(1000), rng.choice(["x", "y", None]), i) for i in range(20_000)]
    df = spark.createDataFrame(data, "u string, n int, kind string, id long")
    path = f"{tmp_path}/t"
    write_clustered(df, path, ["u", "n"], 64)
    assert rows(spark.read.parquet(path)) == rows(df)
    for column, value in (("u", "user077"), ("n", 500)):
        hit, files = files_for(spark, path, column, value)
        assert files >= 50 and hit <= files / 3


def test_table_of_a_contract(spark, tmp_path):
    cfg = load_table_config("silver_workouts")
    made = spark.range(500).select(
        F.concat(F.lit("u"), F.col("id") % 9).alias("user_id"), F.col("id").cast("string").alias("uuid"),
        F.lit("2024-01-01").alias("workout_date"), F.lit(1).alias("extra"),
    )
    stored = store_by_contract(made, cfg, f"{tmp_path}/w", files=4)
    assert stored.columns == [c["name"] for c in cfg["columns"]] and stored.count() == 500
    assert store_by_contract(made.limit(0), cfg, f"{tmp_path}/e").count() == 0


def test_merged_sketches_keep_their_bounds(spark):
    ev = spark.range(200_000).select(
        (F.col("id") % 14).alias("d"), (F.xxhash64("id") % 30_000).cast("string").alias("u"), F.rand(3).alias("v")
    )
    whole = ev.agg(F.count_distinct("u").alias("n"), F.hll_sketch_estimate(F.hll_sketch_agg("u", HLL_BITS)).alias("e")).first()
    by_day = daily_sketches(ev, F.date_add(F.lit("2024-01-01"), F.col("d").cast("int")), F.col("u"), F.col("v"))
    got = merged(by_day, F.lit(1), "all").select("n_rows", "distinct_ids", quantile("quantiles", 0.25).alias("q")).first()
    assert got.n_rows == 200_000 and got.distinct_ids == whole.e
    assert abs(got.distinct_ids - whole.n) <= 3 * HLL_ERROR * whole.n
    assert abs(got.q - 0.25) <= 2 * KLL_ERROR


def test_bags_count_repeats_and_ignore_the_order_of_json_keys(spark):
    def bag(values):
        return spark.createDataFrame(values, "id string, j string").select("id", F.parse_json("j").alias("body"))

    left = bag([("a", '{"x":1,"y":2}')] * 3 + [("b", None), (None, None), (None, None)])
    right = bag([("a", '{"y":2,"x":1}'), ("a", '{"x":1, "y":2}'), (None, None), ("c", "1"), ("c", "1")])
    assert rows(reconcile(left, right, ["id", "body"]), "side", "id") == sorted(
        [("both", "a")] * 2 + [("both", None), ("stored", "a"), ("stored", "b"), ("stored", None)] + [("pulled", "c")] * 2,
        key=repr,
    )


def test_tables_are_created_once(spark):
    for name in ("silver_workouts", "raw_bronze"):
        cfg = load_table_config(name)
        try:
            assert ensure_table(spark, cfg) == ensure_table(spark, cfg) == f"default.{name}"
            assert spark.table(f"default.{name}").columns == [c["name"] for c in cfg["columns"]]
        finally:
            spark.sql(f"DROP TABLE IF EXISTS default.{name}")


def test_a_retried_run_replaces_its_own_rows(spark, tmp_path):
    path = f"{tmp_path}/t"
    for run, n in (("a", 5), ("b", 3), ("a", 5), ("b", 4)):
        tables.append_run(spark.range(n), path, run)
    assert rows(spark.read.parquet(path).groupBy("_run").count()) == [("a", 5), ("b", 4)]


def test_readers_of_a_view_keep_the_old_rows_until_it_is_new(spark, tmp_path):
    tables.materialized_view(spark.range(3), f"{tmp_path}/v", "kept_view")
    reader = spark.table("kept_view")
    tables.materialized_view(spark.range(7), f"{tmp_path}/v", "kept_view")
    assert reader.count() == 3 and spark.table("kept_view").count() == 7


def test_a_log_of_all_changes_is_not_folded(spark, tmp_path):
    from test_cdc import CHANGES, feed_of

    cdc.change_sink(f"{tmp_path}/log")(feed_of(spark, CHANGES), 0)
    with pytest.raises(ValueError):
        cdc.compact(spark, f"{tmp_path}/log", ["uuid"])


def test_preview(spark):
    made = spark.createDataFrame([("abcdef",), ("abc",), (None,)], "t string").select(preview(F.col("t"), 3).alias("p"))
    assert rows(made) == sorted([("abc...",), ("abc",), (None,)], key=repr)
