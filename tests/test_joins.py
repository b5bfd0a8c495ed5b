import random

from conftest import rows
from pyspark.sql import functions as F

from pulselake.operators.joins import point_in_time, within_intervals


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stamped(spark, data, ddl, *columns):
    df = spark.createDataFrame(data, ddl)
    for c in columns:
        df = df.withColumn(c, F.timestamp_seconds(F.col(c)))
    return df


def histories(rng, keys, n):
    out = []
    for key in keys:
        times = sorted(rng.sample(range(0, 40 * 86400, 3600), n))
        for i, t in enumerate(times):
            end = times[i + 1] if i + 1 < len(times) and rng.random() < 0.8 else (t + 1800 if rng.random() < 0.5 else None)
            if end is None and i + 1 < len(times):
                end = times[i + 1]
            out.append((key, t, end, f"{key}-{i}"))
    return out


def test_each_event_meets_its_version(spark):
    rng = random.Random(1)
    versions = histories(rng, ["a", "b", None, "hot"], 12) + histories(rng, ["only"], 2)
    keys = ["a", "b", None, "none"] + ["hot"] * 20
    events = [(i, rng.choice(keys), rng.choice([rng.randrange(0, 45 * 86400), rng.choice(versions)[1]])) for i in range(3000)]
    events += [(9000, "a", None), (9001, None, None)]
    ev = stamped(spark, events, "id long, k string, at long", "at")
    hist = stamped(spark, versions, "k string, __START_AT long, __END_AT long, note string", "__START_AT", "__END_AT")
    want = []
    for i, k, t in events:
        valid = [v for v in versions if t is not None and v[0] == k and v[1] <= t and (v[2] is None or v[2] > t)]
        want.append((i, valid[0][3] if valid else None))
    assert sum(w is not None for _, w in want) > 1000
    for chunk in ("day", "hour", "year"):
        got = point_in_time(ev, hist, ["k"], "at", chunk=chunk)
        assert got.columns == ["id", "k", "at", "v___START_AT", "v___END_AT", "v_note"]
        assert rows(got, "id", "v_note") == sorted(want, key=repr)
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    assert point_in_time(ev, hist.limit(0), ["k"], "at").where("v_note is not null").count() == 0
    assert point_in_time(ev.limit(0), hist, ["k"], "at").count() == 0


def test_points_within_intervals_of_any_length(spark):
    rng = random.Random(2)
    lengths = [0, 1, 60, 3599, 3600, 86400, 40 * 86400, 9 * 365 * 86400]
    spans = []
    for i in range(150):
        begin = rng.randrange(-86400, 60 * 86400)
        spans.append((rng.choice(["a", "b", None, "hot", "hot"]), begin, begin + rng.choice(lengths), f"i{i}"))
    spans += [("a", 5, None, "x"), ("a", None, 5, "y"), ("a", 100, 50, "z"), spans[0]]
    points = [(i, rng.choice(["a", "hot", None]), rng.choice([rng.randrange(0, 60 * 86400), rng.choice(spans)[1] or 0])) for i in range(800)]
    points.append((9000, "a", None))
    p = stamped(spark, points, "id long, u string, at long", "at")
    s = stamped(spark, spans, "u string, start_ts long, end_ts long, name string", "start_ts", "end_ts")
    want = [
        (i, v[3]) for i, u, t in points for v in spans
        if u is not None and u == v[0] and None not in (t, v[1], v[2]) and v[1] <= t < v[2]
    ]
    got = within_intervals(p, s, ["u"], "at")
    assert len(want) > 1000 and rows(got, "id", "i_name") == sorted(want, key=repr)
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)


def test_copies_of_intervals_are_bounded(spark):
    s = stamped(spark, [("a", 0, n, str(n)) for n in (10, 50_000, 900_000, 10_000_000)], "u string, start_ts long, end_ts long, n string", "start_ts", "end_ts")
    p = stamped(spark, [(0, "a", 5)], "id long, u string, at long", "at")
    joined = within_intervals(p, s, ["u"], "at")
    assert joined.count() == 4
