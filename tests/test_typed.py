from conftest import rows
from pyspark.sql import functions as F

from pulselake.operators import gold, quality, typed
from pulselake.plans.pipeline import HealthGraph
from pulselake.sources.contracts import load_table_config

AS_OF = "2024-02-01 00:00:00"


def bronze(spark, record_type, *bodies):
    data = [(f"r{i}", b, record_type) for i, b in enumerate(bodies)]
    return spark.createDataFrame(data, "record_id string, text string, record_type string").select(
        "record_id",
        F.lit("2024-01-10 00:00:00").cast("timestamp").alias("ingested_at"),
        F.parse_json("text").alias("body"),
        "record_type",
        F.lit("apple_healthkit").alias("source_platform"),
        F.lit("u").alias("user_id"),
    )


def test_samples_bad_values(spark):
    b = bronze(
        spark, "samples",
        '{"uuid":"A","type":"HKQ","value":30.7,"start_date":"2024-01-01T23:59:59Z","metadata":null}',
        '{"uuid":null,"value":1}',
        '{"uuid":"B","value":"much"}',
        '{"uuid":"C","value":"4.5","start_date":"soon"}',
        '{"id":"android","value":2}',
    )
    kept = quality.apply_contract(typed.type_health_samples(b), load_table_config("bronze_typed_health_samples"), AS_OF)
    assert rows(kept, "uuid", "value", "sample_hour") == [("A", 30.7, 23), ("C", 4.5, None)]
    report = quality.expectation_report(
        typed.type_health_samples(b), load_table_config("bronze_typed_health_samples"), AS_OF
    )
    failed = {r.rule: r.violations for r in report.collect()}
    assert (failed["valid_uuid"], failed["valid_value"], failed["chronological_timestamps"]) == (2, 1, 5)


def test_sleep_without_stages_gives_no_rows(spark):
    b = bronze(
        spark, "sleep",
        '{"start_date":"2024-01-01T22:00:00Z","end_date":"2024-01-02T06:00:00Z"}',
        '{"start_date":"2024-01-01T22:00:00Z","end_date":"2024-01-02T06:00:00Z","stages":[]}',
        '{"start_date":"2024-01-01T22:00:00Z","end_date":"2024-01-02T06:00:00Z","stages":'
        '[{"uuid":"s","stage":"awake","start_date":"2024-01-01T22:00:00.900Z","end_date":"2024-01-01T22:01:40.100Z"}]}',
    )
    stages = typed.type_sleep_stages(b)
    assert rows(stages, "stage_uuid", "stage_duration_minutes") == [("s", 1.666667)]


def test_ring_goals(spark):
    b = bronze(
        spark, "activity_summaries",
        '{"date":"2024-01-01","active_energy_burned_kcal":100,"active_energy_burned_goal_kcal":0,'
        '"exercise_minutes":30.7,"exercise_minutes_goal":30.0,"stand_hours":6,"stand_hours_goal":12}',
    )
    rings = typed.type_activity_summaries(b)
    assert rows(rings, "energy_goal_pct", "exercise_minutes", "exercise_goal_pct", "stand_goal_pct") == [(None, 30, 1.0, 0.5)]


def test_gold_overlaps_unknown_and_empty_sessions(spark):
    stage = "user_id string, source_platform string, session_start_ts timestamp, session_end_ts timestamp, sleep_date date, stage string, stage_duration_minutes double"
    data = spark.sql(
        "SELECT 'u' user_id, 'p' source_platform, TIMESTAMP '2024-01-01 22:00:00' session_start_ts, "
        "TIMESTAMP '2024-01-01 23:00:00' session_end_ts, DATE '2024-01-01' sleep_date, stage, CAST(m AS DOUBLE) stage_duration_minutes "
        "FROM VALUES ('asleepCore', 50), ('asleepREM', 40), ('inBed', 5) AS t(stage, m) "
        "UNION ALL SELECT 'u', 'p', TIMESTAMP '2024-01-02 22:00:00', TIMESTAMP '2024-01-02 22:00:00', DATE '2024-01-02', 'awake', 1.0"
    )
    assert len(stage.split(",")) == len(data.columns)
    found = rows(
        gold.sleep_sessions(data), "sleep_date", "deep_sleep_minutes", "rem_sleep_minutes", "total_tracked_minutes",
        "stage_count", "deep_stage_count", "total_sleep_minutes", "sleep_efficiency",
    )
    assert [r[1:] for r in found] == [(None, 40.0, 95.0, 3, 0, 90.0, 1.5), (None, None, 1.0, 1, 0, 0.0, None)]


def test_quarantine_ignores_type_and_time(spark):
    samples = bronze(spark, "samples", '{"uuid":"A","value":1}')
    deletes = bronze(
        spark, "deletes",
        '{"uuid":"A","sample_type":"HKWorkoutTypeIdentifier"}',
        '{"uuid":"Z","sample_type":"HKCategoryTypeIdentifierAppleStandHour"}',
        '{"uuid":null,"sample_type":"HKWorkoutTypeIdentifier"}',
    )
    by_type = {"samples": samples, "deletes": deletes}
    g = HealthGraph(lambda t: by_type.get(t, samples.limit(0)), AS_OF)
    assert rows(g.quarantine_unmatched_deletes, "deleted_uuid", "target_table") == [("Z", "unknown")]


def test_derived_headers_keep_their_names(spark):
    from pulselake.operators.ingest import platform_of
    from pulselake.sources import fixtures

    ev = fixtures.events(spark, "/root/testdata/sf0.001")
    for chosen in (["deletes"], []):
        assert platform_of(fixtures.bronze(ev, *chosen)).where("source_platform IS NULL").count() == 0
