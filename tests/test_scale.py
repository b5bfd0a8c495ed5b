from conftest import rows
from pyspark.sql import functions as F

from pulselake.operators.reports import record_type_coverage
from pulselake.sources import fixtures


def test_one_file_is_worked_on_by_many_tasks(spark, tmp_path):
    ids = spark.range(250_000).selectExpr("if(id % 9 = 0, null, id) as event_id", "timestamp_ntz '2024-01-01' as ts")
    ids.coalesce(1).write.parquet(f"{tmp_path}/one")
    raw = spark.read.parquet(f"{tmp_path}/one")
    dealt = fixtures.spread(raw)
    assert raw.rdd.getNumPartitions() < 3 == dealt.rdd.getNumPartitions()
    assert dealt.exceptAll(raw).isEmpty() and raw.exceptAll(dealt).isEmpty()
    few = raw.limit(10)
    assert fixtures.spread(few) is few


def test_coverage_sorts_dates_and_no_rows(spark):
    data = [("a", '{"date":"2024-01-02"}'), ("a", '{"date":"2024-01-01"}'), ("a", "{}"), ("b", "{}"), (None, '{"date":"x"}')]
    bronze = spark.createDataFrame(data, "record_type string, t string").select("record_type", F.parse_json("t").alias("body"))
    got = record_type_coverage(bronze)
    want = [("a", 3, "2024-01-01", "2024-01-02"), ("b", 1, None, None), (None, 1, "x", "x")]
    assert rows(got) == sorted(want, key=repr)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [record_type") == 2


def test_templates_with_nulls(spark):
    ev = spark.createDataFrame([(1, "u", None, None), (2, "u", 7, 9.0)], "event_id long, user_id string, k int, value double")
    ev = ev.withColumns({"ts": F.lit("2024-01-01 00:00:30").cast("timestamp"), "t0": F.lit("2024-01-01").cast("timestamp")})
    none, seven = fixtures.extractions(ev).orderBy("extraction_id").collect()
    assert none.spo2 == '{"averageSpO2":null,"averageSpO2Value":null}'
    assert none.hrv == '{"hrvSummary":{"weeklyAvg":null,"lastNight5MinHigh":null,"status":""}}'
    assert seven.respiration == '{"avgWakingRespirationValue":13,"avgSleepRespirationValue":14}'
