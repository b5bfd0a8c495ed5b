from pulselake.operators.runs import list_runs, page_size


def test_a_page_holds_as_many_runs_as_asked_for(spark):
    runs = spark.range(700).selectExpr("cast(id as string) as run_id", "timestamp_seconds(id) as started_at")
    types = runs.selectExpr(
        "run_id", "'view' as record_type", "1L as payload_count", "2L as record_count", "3L as duration_ms", "4L as records_per_sec"
    )
    rows = list_runs(runs, types, limit=500, offset=10).collect()
    assert [r.run_id for r in rows] == [str(i) for i in range(689, 189, -1)]
    assert all(len(r.type_results) == 1 for r in rows)


def test_size_of_a_requested_page():
    assert [page_size(n) for n in (None, 0, -3, 7, 200, 500)] == [50, 50, 1, 7, 200, 200]
