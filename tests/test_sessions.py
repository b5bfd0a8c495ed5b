import random
from datetime import datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F

from pulselake.operators import sessions
from pulselake.streaming.sessions import sessionize_stream

T0 = datetime(2024, 1, 1, 20)


def intervals(spark, spans):
    data = [(u, str(i), str(T0 + timedelta(minutes=a)), str(T0 + timedelta(minutes=b))) for i, (u, a, b) in enumerate(spans)]
    df = spark.createDataFrame(data, "user_id string, uuid string, s string, e string")
    return df.select("user_id", "uuid", F.col("s").cast("timestamp").alias("start_ts"), F.col("e").cast("timestamp").alias("end_ts"))


def brute(spans, gap=30):
    out = {}
    for user in {u for u, *_ in spans}:
        mine = sorted((a, b, str(i)) for i, (u, a, b) in enumerate(spans) if u == user)
        number, place, opened, last = 0, 0, None, None
        for a, b, uuid in mine:
            if last is None or a - last > gap:
                number, place, opened = number + 1, 0, a
            place, last = place + 1, b
            out[uuid] = (user, number, place, str(T0 + timedelta(minutes=opened)))
    return sorted((u, *v) for u, v in out.items())


def labelled(df):
    return sorted(
        (r.uuid, r.user_id, r.session_no, r.stage_no, str(r.session_start_ts)) for r in df.collect()
    )


def test_gap_edges(spark):
    spans = [("a", 0, 10), ("a", 40, 50), ("a", 81, 90), ("b", 0, 300), ("b", 10, 20), ("b", 51, 60)]
    assert labelled(sessions.label_sessions(intervals(spark, spans), ["user_id"])) == brute(spans)
    found = sessions.sessionize(intervals(spark, spans), ["user_id"])
    # A stage of exactly 30 minutes later joins; the previous row counts, not the latest end.
    assert rows(found, "user_id", "session_no", "stage_count") == [("a", 1, 2), ("a", 2, 1), ("b", 1, 2), ("b", 2, 1)]


def test_random_spans_over_chunk_borders(spark):
    draw = random.Random(3)
    spans = [(draw.choice("abb"), s, s + draw.randrange(0, 90)) for s in (draw.randrange(0, 4000) for _ in range(250))]
    for chunk in ("day", "hour"):
        assert labelled(sessions.label_sessions(intervals(spark, spans), ["user_id"], chunk=chunk)) == brute(spans)


def test_rows_without_a_user_are_kept(spark):
    spans = [("a", 0, 10), (None, 0, 10), (None, 20, 30), (None, 90, 95)]
    found = rows(sessions.sessionize(intervals(spark, spans), ["user_id"]), "user_id", "session_no", "stage_count")
    assert found == [("a", 1, 1), (None, 1, 2), (None, 2, 1)]


def test_session_windows_agree_without_containment(spark):
    draw, spans, clock = random.Random(8), [], 0
    for _ in range(60):
        clock += draw.choice([0, 5, 29, 30, 31, 200])
        spans.append(("a", clock, clock + 20))
        clock += 20
    df = intervals(spark, spans)
    columns = ["session_start_ts", "session_end_ts", "stage_count"]
    assert rows(sessionize_stream(df, ["user_id"], watermark=None), *columns) == rows(
        sessions.sessionize(df, ["user_id"]), *columns
    )
