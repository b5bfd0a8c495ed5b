import pytest
from conftest import rows
from pyspark.sql import functions as F

from pulselake.operators import garmin, ingest, ledger, watch
from pulselake.sources import contracts, ndjson, tables


def test_ndjson_lines(spark):
    bodies = [
        ("ok", '{"a":1}\r\n\r\n  \n{"a":2}\n'),
        ("mixed", '\n{"a":1}\nbroken\n{"a":3} junk\nnull\n'),
        ("long", "\n".join(["1"] * 10_001)),
        ("full", "\n".join(["1"] * 10_000)),
        ("blank", " \n\t\n"),
    ]
    df = spark.createDataFrame(bodies, "id string, body string")
    records, errors = ndjson.parse_ndjson(df)
    assert records.where("id = 'long'").count() == 10_001 and errors.where("id = 'long'").count() == 0
    records, errors = ndjson.parse_ndjson(df, max_lines=10_000)
    counts = {r["id"]: r["count"] for r in records.groupBy("id").count().collect()}
    assert counts == {"ok": 2, "mixed": 2, "full": 10_000}
    assert rows(errors) == [
        ("long", "Too many NDJSON lines (10001). Maximum allowed is 10000."),
        ("mixed", "Line 2: invalid JSON"),
        ("mixed", "Line 3: invalid JSON"),
    ]
    assert rows(records.where("id = 'ok'"), "line_no") == [(1,), (2,)]


def test_only_whole_lines_are_values(spark):
    good = ['{"a":[1,{"b":"]"}]}', "[1,2]", "null", ' "x" ', "7", "[]", '{"a":1,"a":2}']
    bad = ['{"a":1} x', "1,2", '{"a":1}],[{', "1},{", '1,"b":2', "[1]]", "{", "nul", "'x'", '{"a":1}{"a":2}']
    df = spark.createDataFrame([(x,) for x in good + bad], "line string")
    parsed = df.select("line", ndjson.parse_line(F.col("line")).isNotNull().alias("ok")).collect()
    assert {r.line for r in parsed if r.ok} == set(good)


def test_headers_user_and_platform(spark):
    df = spark.createDataFrame(
        [({"Authorization": "x", "COOKIE": "y", "x-platform": "Apple"}, "", "a@b"), ({"x-platform": ""}, "sub", None), ({}, None, "")],
        "headers map<string,string>, sub string, mail string",
    )
    shown = df.select(
        F.map_keys(ingest.strip_headers(F.col("headers"))).alias("kept"),
        ingest.source_platform(F.col("headers")).alias("platform"),
        ingest.resolve_user(F.col("sub"), F.col("mail")).alias("user"),
    )
    assert rows(shown) == [(["x-platform"], "apple", "a@b"), (["x-platform"], "unknown", "sub"), ([], "unknown", "anonymous")]


def test_record_ids_are_stable(spark):
    requests = spark.createDataFrame(
        [(1, {"x-record-type": " Samples "}, "{}\n{}"), (2, {}, "{}")], "request_id int, headers map<string,string>, body string"
    ).withColumns({"received_at": F.lit("2024-01-01").cast("timestamp"), "jwt_sub": F.lit(None).cast("string")})
    first, second = (rows(ingest.build_bronze(requests)[0], "record_id", "record_type") for _ in range(2))
    assert first == second and len({r[0] for r in first}) == 2
    assert {r[1] for r in first} == {"samples"}


def test_staging_needs_its_columns(spark):
    staging = spark.createDataFrame(
        [("r", "2024-01-01T00:00:00+00:00", "{}", None, "hrv")],
        "record_id string, ingested_at string, body_json string, headers_json string, record_type string",
    )
    with pytest.raises(Exception, match="staging row without headers_json"):
        tables.ingest_staging(staging).collect()
    with pytest.raises(ValueError, match="headers_json"):
        tables.ingest_staging(staging.drop("headers_json"))


def test_ndjson_writer_sorts_keys_and_omits_nulls(spark):
    df = spark.sql("SELECT 2 AS b, CAST(NULL AS INT) AS c, named_struct('z', 1, 'a', named_struct('y', 1, 'x', 2)) AS a, array(named_struct('d', 1, 'c', 2)) AS l")
    assert rows(tables.to_ndjson(df)) == [('{"a":{"a":{"x":2,"y":1},"z":1},"b":2,"l":[{"c":2,"d":1}]}',)]


def sync(spark, *events):
    data = [(str(i), t, f"2024-01-01 00:00:{i:02d}", n, 200, True, p, {"X-Record-Type": t}) for i, (t, n, p) in enumerate(events)]
    return spark.createDataFrame(
        data, "id string, record_type string, timestamp string, record_count int, http_status_code int, success boolean, ndjson_payload string, request_headers map<string,string>"
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def test_ledger_breakdowns(spark):
    events = sync(
        spark,
        ("samples", 4, '{"type":"stepCount"}\nnot-a-json-line\n{"unrelated":"field"}\n{"type":"distanceWalkingRunning"}\n{"type":7}'),
        ("samples", 1, '{"type":"stepCount"}'),
        ("workouts", 3, '{"activity_type":"running"}\n{"activity_type":"running"}\n{"activity_type":"cycling"}'),
        ("deletes", 2, '{"sample_type":"stepCount"}\n{"sample_type":"heartRate"}'),
        ("sleep", 5, "ignored"),
        ("activity_summaries", 7, "ignored"),
    )
    assert rows(ledger.sync_breakdown(events)) == sorted([
        ("samples", "stepCount", 2), ("samples", "distanceWalkingRunning", 1),
        ("workouts", "running", 2), ("workouts", "cycling", 1),
        ("deletes", "stepCount", 1), ("deletes", "heartRate", 1),
        ("sleep", "sessions", 5), ("activity_summaries", "days", 7),
    ], key=repr)
    assert dict(rows(ledger.sync_totals(events), "record_type", "total_records"))["samples"] == 5
    assert rows(ledger.last_payload(events).where("record_type = 'samples'"), "ndjson_payload") == [('{"type":"stepCount"}',)]


def test_recent_events(spark):
    events = sync(spark, *[("samples", i, "{}") for i in range(25)])
    recent = ledger.recent_events(events)
    counts = [r.record_count for r in recent.collect()]
    assert counts == list(range(24, 4, -1))
    assert "ndjson_payload" not in recent.columns and "request_headers" in recent.columns


def test_empty_ledger_lists_all_types(spark):
    found = ledger.category_overview(sync(spark, ("samples", 1, "{}")).limit(0))
    assert [(r.record_type, r.total_records, r.last_sync) for r in found.collect()] == [
        (t, 0, None) for t in ("samples", "workouts", "sleep", "activity_summaries", "deletes")
    ]


def extraction(spark, **data):
    columns = {c: data.get(c) for c in garmin.codes.GARMIN_CATEGORIES}
    row = spark.createDataFrame([("e1", "w")], "extraction_id string, device_id string")
    return row.select(
        "*",
        F.lit("2024-01-05").cast("date").alias("date"),
        F.lit("2024-01-06").cast("timestamp").alias("pulled_at"),
        *[F.lit(v).cast("string").alias(c) for c, v in columns.items()],
    )


def test_vendor_edge_values(spark):
    e = extraction(
        spark,
        stats='{"totalSteps":"n/a","restingHeartRate":null,"moderateIntensityMinutes":0,"vigorousIntensityMinutes":null}',
        heart_rates='{"heartRateValues":[[1704412800000,70],[1704412860000,null],[1704412920000],5,[1704412980000,0]]}',
        stress='{"stressValuesArray":null}',
        hrv='{"hrvSummary":{"status":"strange"}}',
        spo2='{"averageSpO2":0,"averageSpO2Value":0}',
        body_battery="[[1,0],[2,null]]",
        activities='[7,{"activityId":1,"activityType":"x","startTimeLocal":"","startTimeGMT":"2024-01-05T10:00:00Z","calories":"bad"}]',
    )
    found = garmin.normalize(garmin.garmin_to_bronze(e))
    assert rows(found, "metric_type", "value") == [
        ("heart_rate_intraday", 70.0), ("hrv_status", -1.0), ("spo2", 0.0), ("steps_daily", 0.0), ("workout_calories", 0.0),
    ]
    calories = found.where("metric_type = 'workout_calories'").collect()[0]
    assert calories.metadata["activity_type"] == "unknown" and str(calories.recorded_at) == "2024-01-05 10:00:00"


def test_missing_days_excludes_the_end(spark):
    b = garmin.garmin_to_bronze(extraction(spark, hrv="{}"))
    assert [str(r.day) for r in garmin.missing_days(b, "2024-01-04", "2024-01-07").orderBy("day").collect()] == ["2024-01-04", "2024-01-06"]
    with pytest.raises(ValueError):
        garmin.missing_days(b, "2024-01-04", "2024-01-04")


def test_watch_cap_comes_before_the_filter(spark):
    readings = spark.sql(
        "SELECT 'd' device_id, 'stress_level' metric_type, IF(id = 99, 127D, CAST(id AS DOUBLE)) value, "
        "timestamp_seconds(id) recorded_at, CAST(id AS STRING) record_id FROM range(100)"
    )
    kept = watch.incremental_readings(readings, "1970-01-01 00:00:50", cap=60)
    assert sorted(r.value for r in kept.collect()) == [float(i) for i in range(51, 99)]


def test_contracts(spark):
    cfg = contracts.load_table_config("bronze_typed_workouts")
    ddl = contracts.build_schema_ddl(cfg)
    assert ddl.startswith("record_id STRING NOT NULL COMMENT") and ddl.endswith("PRIMARY KEY (record_id)")
    assert contracts.get_foreign_keys_ddl(cfg, "main.x.") == [
        "CONSTRAINT bronze_typed_workouts_bronze_fk FOREIGN KEY (record_id) REFERENCES main.x.raw_bronze (record_id)"
    ]
    assert len(contracts.get_expectations_warn(cfg)) == 10
    assert "TIMESTAMP '2024-02-01 00:00:00'" in contracts.get_expectations_warn(cfg, "2024-02-01 00:00:00")["reasonable_timestamp"]
    with pytest.raises(FileNotFoundError, match="bronze_typed_deletes"):
        contracts.load_table_config("nothing")
    for path in contracts.CONTRACT_DIR.glob("*.yml"):
        loaded = contracts.load_table_config(path.stem)
        empty = contracts.conform(spark.range(0), loaded)
        assert empty.columns == [c["name"] for c in loaded["columns"]]
        assert set(contracts.primary_key(loaded)) <= set(empty.columns)
