"""Inputs of every operator, derived row by row from the ``events`` table.

One event gives one payload, so the derived data grows with the table and no
group of rows is ever collected into one payload.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"
RECORD_TYPE_OF = {
    "view": "samples",
    "click": "workouts",
    "purchase": "sleep",
    "signup": "activity_summaries",
    "error": "deletes",
}
EVENT_TYPE_OF = {v: k for k, v in RECORD_TYPE_OF.items()}
PLATFORMS = ["apple_healthkit", "android_health_connect", "garmin_connect"]
QUANTITIES = [
    ("HKQuantityTypeIdentifierHeartRate", "count/min"),
    ("HKQuantityTypeIdentifierStepCount", "count"),
    ("HKQuantityTypeIdentifierOxygenSaturation", "%"),
    ("HKQuantityTypeIdentifierActiveEnergyBurned", "kcal"),
]
ACTIVITIES = [("running", 37), ("walking", 52), ("cycling", 13)]


# Events of one task: each becomes many rows and long texts, so a task has few of them.
TASK_EVENTS = 100_000


def spread(raw: DataFrame) -> DataFrame:
    """The same events in tasks of about ``TASK_EVENTS``, whatever the files and row groups they come in.

    One large file may have one row group, which a single task would read and
    work on. The count of a whole table reads the footers of its files.
    """
    tasks = -(-raw.count() // TASK_EVENTS)
    return raw.repartition(tasks, "event_id", "ts") if tasks > 1 else raw


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(spread(spark.read.parquet(f"{sf_dir}/events.parquet")))


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a stream, stored as one file or as a folder of part files.

    A pattern names the table, as a stream does not take the plain path of a file.
    """
    schema = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    return shape(spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]"))


def shape(raw: DataFrame) -> DataFrame:
    """Event columns plus the small integer ``k``, the shared key ``ukey`` and the minute ``t0``."""
    return raw.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.expr("event_id div 4").alias("ukey"),
        F.date_trunc("minute", F.col("ts").cast("timestamp")).alias("t0"),
    )


def iso(ts: Column) -> Column:
    return F.date_format(ts, ISO)


def plus(ts: Column, **parts: Column | int) -> Column:
    """``ts`` moved by minutes and seconds given as columns or numbers."""
    seconds = F.lit(0)
    for unit, n in parts.items():
        seconds = seconds + (n if isinstance(n, Column) else F.lit(n)) * {"minutes": 60, "seconds": 1}[unit]
    return F.timestamp_seconds(ts.cast("long") + seconds)


def one_of(number: Column, values: list) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), number.cast("int") + 1)


def uuid_of() -> Column:
    return F.concat(F.lit("U"), F.col("ukey").cast("string"))


def to_text(body: Column) -> Column:
    return F.to_json(body, {"ignoreNullFields": "false"})


# ---- bodies of the five record types ----------------------------------------


def sample_body() -> Column:
    k = F.col("k")
    start = plus(F.col("t0"), minutes=-(k + 1))
    return F.struct(
        uuid_of().alias("uuid"),
        one_of(k % 4, [q for q, _ in QUANTITIES]).alias("type"),
        "value",
        one_of(k % 4, [u for _, u in QUANTITIES]).alias("unit"),
        iso(start).alias("start_date"),
        iso(plus(start, minutes=k % 5)).alias("end_date"),
        F.lit("Apple Watch").alias("source_name"),
        F.concat(F.lit("com.example.u"), "user_id").alias("source_bundle_id"),
        F.when(k % 2 == 0, F.struct((k % 3).cast("string").alias("motion"))).alias("metadata"),
    )


def workout_body() -> Column:
    k = F.col("k")
    start = plus(F.col("t0"), minutes=-120)
    seconds = 600 + 60 * k + k % 7
    return F.struct(
        uuid_of().alias("uuid"),
        one_of(k % 3, [a for a, _ in ACTIVITIES]).alias("activity_type"),
        one_of(k % 3, [c for _, c in ACTIVITIES]).alias("activity_type_raw"),
        iso(start).alias("start_date"),
        iso(plus(start, seconds=seconds)).alias("end_date"),
        seconds.alias("duration_seconds"),
        F.col("value").alias("total_energy_burned_kcal"),
        F.when(k % 10 != 0, 100 * k).alias("total_distance_meters"),
        F.lit("Apple Watch").alias("source_name"),
        F.lit(None).cast("string").alias("metadata"),
    )


def sleep_stage_bounds() -> list[tuple[str, Column, Column]]:
    """Stage name with start and end in seconds after the session start."""
    k = F.col("k")
    bounds, cursor = [], F.lit(0)
    lengths = [
        ("awake", F.lit(20 * 60)),
        ("asleepCore", F.lit(210 * 60) + k),
        ("asleepDeep", F.lit(84 * 60)),
        ("asleepREM", (90 + k % 16) * 60),
        ("inBed", F.lit(5 * 60)),
    ]
    for name, seconds in lengths:
        bounds.append((name, cursor, cursor + seconds))
        cursor = cursor + seconds
    return bounds


def sleep_body() -> Column:
    k = F.col("k")
    start = plus(F.col("t0"), minutes=-(440 + k))
    stages = [
        F.struct(
            F.concat(uuid_of(), F.lit(f"-{i}")).alias("uuid"),
            F.lit(name).alias("stage"),
            iso(plus(start, seconds=begin)).alias("start_date"),
            iso(plus(start, seconds=end)).alias("end_date"),
        )
        for i, (name, begin, end) in enumerate(sleep_stage_bounds(), 1)
    ]
    return F.struct(
        iso(start).alias("start_date"),
        iso(plus(start, minutes=420)).alias("end_date"),
        F.when(k % 10 == 0, F.array(*stages)).otherwise(F.array(*stages[:4])).alias("stages"),
    )


def summary_body() -> Column:
    k = F.col("k")
    return F.struct(
        F.to_date("ts").cast("string").alias("date"),
        (F.col("value") * 2).alias("active_energy_burned_kcal"),
        one_of(k % 3, [400.0, 500.0, 600.0]).alias("active_energy_burned_goal_kcal"),
        (k + 0.7).alias("exercise_minutes"),
        F.when(k == 0, 0.0).otherwise(30.0).alias("exercise_minutes_goal"),
        (k % 25).alias("stand_hours"),
        F.lit(12).alias("stand_hours_goal"),
    )


def delete_body() -> Column:
    k = F.col("k")
    types = [
        "HKQuantityTypeIdentifierHeartRate",
        "HKQuantityTypeIdentifierHeartRate",
        "HKWorkoutTypeIdentifier",
        "HKCategoryTypeIdentifierSleepAnalysis",
    ]
    return F.struct(
        F.concat(uuid_of(), F.when(k % 4 == 3, "-1").otherwise("")).alias("uuid"),
        one_of(k % 4, types).alias("sample_type"),
    )


BODIES = {
    "samples": sample_body,
    "workouts": workout_body,
    "sleep": sleep_body,
    "activity_summaries": summary_body,
    "deletes": delete_body,
}


def bronze(ev: DataFrame, *record_types: str) -> DataFrame:
    """Raw bronze rows of the chosen record types, or of all in one scan.

    Naming the types turns them into a filter on ``event_type``, which reaches
    the Parquet scan.
    """
    chosen = list(record_types or BODIES)
    if record_types:
        ev = ev.where(F.col("event_type").isin([EVENT_TYPE_OF[t] for t in chosen]))
    if len(chosen) == 1:
        text, kind = to_text(BODIES[chosen[0]]()), F.lit(chosen[0])
    else:
        text = kind = F.lit(None).cast("string")
        for t in chosen:
            is_type = F.col("event_type") == EVENT_TYPE_OF[t]
            text = F.when(is_type, to_text(BODIES[t]())).otherwise(text)
            kind = F.when(is_type, F.lit(t)).otherwise(kind)
    platform = one_of(F.col("event_id") % 3, PLATFORMS)
    headers = F.struct(
        F.lit("application/x-ndjson").alias("content-type"),
        platform.alias("x-platform"),
        kind.alias("x-record-type"),
    )
    rows = ev.select(
        F.col("event_id").cast("string").alias("record_id"),
        F.col("ts").alias("ingested_at"),
        text.alias("_text"),
        F.parse_json(F.to_json(headers)).alias("headers"),
        kind.alias("record_type"),
        # Every seventh row predates the platform column and has it in its headers only.
        F.when(F.col("event_id") % 7 != 0, platform).alias("source_platform"),
        "user_id",
    )
    # As the output of an explode, a body is not parsed again for every rule that
    # Spark pushes down. Reports over all types rarely look into it; there it
    # stays a plain column, which is pruned when it is not used.
    parsed = F.explode(F.array(F.parse_json("_text"))) if record_types else F.parse_json("_text")
    return rows.select(
        "record_id", "ingested_at", parsed.alias("body"), "headers", "record_type", "source_platform", "user_id"
    )


# ---- ingest requests and sync events ----------------------------------------


def _payload(kind: Column) -> Column:
    """NDJSON text with one to three lines, a blank line and now and then a broken one."""
    k = F.col("k")

    def line(i: Column) -> Column:
        n = (k + i) % 4
        return F.when(
            kind == "samples",
            F.to_json(F.struct(one_of(n, [q for q, _ in QUANTITIES]).alias("type"), (k + i).alias("value"))),
        ).when(
            kind == "workouts",
            F.to_json(F.struct(one_of((k + i) % 3, [a for a, _ in ACTIVITIES]).alias("activity_type"))),
        ).when(
            kind == "deletes",
            F.to_json(F.struct(one_of(n % 2, ["HKWorkoutTypeIdentifier", "HKQuantityTypeIdentifierStepCount"]).alias("sample_type"))),
        ).otherwise(F.to_json(F.struct((k + i).alias("other"))))

    lines = F.transform(F.sequence(F.lit(0), k % 3), line)
    broken = F.when(k % 13 == 0, F.array(F.lit("not json"))).otherwise(F.array().cast("array<string>"))
    blank = F.when(k % 5 == 0, F.array(F.lit("  "))).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.concat(blank, lines, broken), "\n")


def record_type_of() -> Column:
    kind = F.lit(None).cast("string")
    for event_type, record_type in RECORD_TYPE_OF.items():
        kind = F.when(F.col("event_type") == event_type, record_type).otherwise(kind)
    return kind


def sync_events(ev: DataFrame) -> DataFrame:
    """One upload per event, as the phones log it."""
    kind = record_type_of()
    return ev.select(
        F.col("event_id").alias("id"),
        kind.alias("record_type"),
        F.col("ts").alias("timestamp"),
        (F.col("k") % 3 + 1).alias("record_count"),
        F.lit(200).alias("http_status_code"),
        F.lit(True).alias("success"),
        _payload(kind).alias("ndjson_payload"),
        F.create_map(F.lit("x-record-type"), kind).alias("request_headers"),
    )


def requests(ev: DataFrame) -> DataFrame:
    """One ingest request per event; headers vary in case, some are secret, some are missing."""
    k = F.col("k")
    kind = record_type_of()
    platform = one_of(F.col("event_id") % 4, [*[p.upper() for p in PLATFORMS], ""])
    pairs = F.map_from_arrays(
        F.array(
            F.lit("x-record-type"), F.lit("x-platform"), F.lit("authorization"), F.lit("cookie"),
            F.lit("x-forwarded-email"), F.lit("x-device-id"),
        ),
        F.array(
            F.when(k % 17 == 0, "  ").when(k % 11 == 0, "Custom").otherwise(F.concat(F.lit(" "), F.upper(kind))),
            platform,
            F.lit("Bearer secret"),
            F.lit("session"),
            F.when(k % 3 == 0, F.concat("user_id", F.lit("@example.org"))).otherwise(""),
            F.concat(F.lit("device-"), "user_id"),
        ),
    )
    rows = ev.select(
        F.col("event_id").alias("request_id"),
        F.col("ts").alias("received_at"),
        pairs.alias("headers"),
        F.when(k % 2 == 0, F.concat(F.lit("sub-"), "user_id")).otherwise(
            F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise("")
        ).alias("jwt_sub"),
        _payload(kind).alias("_text"),
    )
    # An explode keeps the text from being built again for each condition on it.
    text = F.explode(F.array("_text")).alias("body")
    return rows.select("request_id", "received_at", "headers", "jwt_sub", text)


# ---- vendor pulls and watch payloads ----------------------------------------


def extractions(ev: DataFrame) -> DataFrame:
    """One vendor day extraction per event: a JSON text per category, some missing."""
    k, value = F.col("k"), F.col("value")
    ms = F.unix_millis("t0")
    num = lambda c: F.coalesce(c.cast("string"), F.lit("null"))

    def fmt(template: str, *args: Column) -> Column:
        """The template with a text in place of each ``%s``; NULL is the text null."""
        first, *rest = template.split("%s")
        filled = [x for a, part in zip(args, rest, strict=True) for x in (F.coalesce(a.cast("string"), F.lit("null")), F.lit(part))]
        return F.concat(F.lit(first), *filled)

    stats = fmt(
        '{"restingHeartRate":%s,"totalSteps":%s,"activeKilocalories":%s,"totalKilocalories":%s,"vO2MaxValue":%s,'
        '"floorsAscended":%s,"averageStressLevel":%s,"moderateIntensityMinutes":%s,"vigorousIntensityMinutes":%s}',
        num(F.when(k % 4 != 0, 50 + k % 30)),
        num(k * 100),
        num(k * 3),
        num(k * 3 + 1500),
        num(F.when(k % 3 != 0, 40 + k % 10)),
        num(k % 20),
        F.when(k % 7 == 0, F.lit('"n/a"')).otherwise(num(k % 50)),
        num(F.when(k % 5 != 0, k % 40)),
        num(F.when(k % 2 == 0, F.lit(0)).otherwise(k % 15)),
    )
    series = "[[%s,%s],[%s,null],[%s,-1],[%s],[%s,0],[%s,%s]]"
    times = [num(ms + 60_000 * i) for i in range(6)]
    pairs = fmt(series, times[0], num(50 + k), times[1], times[2], times[3], times[4], times[5], num(60 + k))
    sleep = fmt(
        '{"dailySleepDTO":{"sleepTimeSeconds":%s,"deepSleepSeconds":%s,"lightSleepSeconds":%s,"remSleepSeconds":%s,'
        '"awakeSleepSeconds":%s,"averageSpO2Value":%s,"averageRespirationValue":%s,"sleepScores":{"overall":{"value":%s}}}}',
        num(25000 + k * 37),
        num(4000 + k * 11),
        num(14000 + k * 13),
        num(F.when(k % 6 != 0, 5000 + k * 7)),
        num(F.when(k % 9 != 0, k * 5)),
        num(90 + k % 10),
        num(12 + k % 5),
        num(F.when(k % 8 != 0, 60 + k % 40)),
    )
    status = one_of(k % 5, ["BALANCED", "unbalanced", "Low", "POOR", ""])
    hrv = fmt(
        '{"hrvSummary":{"weeklyAvg":%s,"lastNight5MinHigh":%s,"status":%s}}',
        num(F.when(k % 3 != 1, 30 + k)),
        num(45 + k),
        F.when(k % 5 == 4, F.lit("null")).otherwise(F.concat(F.lit('"'), status, F.lit('"'))),
    )
    spo2 = fmt('{"averageSpO2":%s,"averageSpO2Value":%s}', num(F.when(k % 2 == 0, F.lit(0)).otherwise(90 + k % 9)), num(F.when(k % 4 != 0, 91 + k % 8)))
    battery = F.when(
        k % 2 == 0, fmt("[[%s,%s],[%s,null],[%s,%s],[%s,0]]", times[0], num(20 + k % 70), times[1], times[2], num(10 + k % 60), times[3])
    ).otherwise(fmt('{"bodyBatteryHighestValue":%s,"bodyBatteryLowestValue":%s}', num(60 + k % 40), num(F.when(k % 3 != 0, 5 + k % 20))))
    respiration = fmt('{"avgWakingRespirationValue":%s,"avgSleepRespirationValue":%s}', num(F.when(k % 3 != 0, 12 + k % 6)), num(11 + k % 4))
    activity = fmt(
        '[{"activityId":%s,"activityType":%s,"activityName":"Run %s","startTimeLocal":%s,"startTimeGMT":"%s","duration":%s,"distance":%s,"calories":%s,"averageHR":%s,"maxHR":%s},"junk"]',
        num(F.col("event_id")),
        F.when(k % 3 == 0, F.lit("null")).otherwise(F.lit('{"typeKey":"running"}')),
        num(k),
        F.when(k % 4 == 0, F.lit("null")).when(k % 4 == 1, F.lit('"bad time"')).otherwise(
            F.concat(F.lit('"'), F.date_format(plus(F.col("t0"), minutes=60), "yyyy-MM-dd HH:mm:ss"), F.lit('"'))
        ),
        F.date_format("t0", "yyyy-MM-dd HH:mm:ss"),
        num(600 + k),
        num(F.when(k % 5 != 0, k * 50)),
        num(k * 4),
        num(F.when(k % 2 == 0, 100 + k % 50)),
        num(F.when(k % 2 == 0, 120 + k % 50)),
    )
    return ev.select(
        F.col("event_id").alias("extraction_id"),
        F.concat(F.lit("watch-"), "user_id").alias("device_id"),
        F.to_date("ts").alias("date"),
        F.col("ts").alias("pulled_at"),
        F.when(k % 11 != 0, stats).alias("stats"),
        F.concat(F.lit('{"heartRateValues":'), pairs, F.lit("}")).alias("heart_rates"),
        sleep.alias("sleep"),
        F.when(k % 6 != 0, F.concat(F.lit('{"stressValuesArray":'), pairs, F.lit("}"))).alias("stress"),
        hrv.alias("hrv"),
        spo2.alias("spo2"),
        battery.alias("body_battery"),
        F.when(k % 2 == 0, fmt("[%s]", num(k * 100))).alias("steps"),
        respiration.alias("respiration"),
        F.when(value > 5, activity).alias("activities"),
    )


def watch_payloads(ev: DataFrame) -> DataFrame:
    """Payloads sent by the watch, three readings each."""
    k = F.col("k")

    def reading(metric: str, value: Column, unit: str, minutes: int) -> Column:
        return F.struct(
            F.lit(metric).alias("metric_type"),
            value.alias("value"),
            F.lit(unit).alias("unit"),
            iso(plus(F.col("t0"), minutes=minutes)).alias("recorded_at"),
            F.concat(F.lit("garmin_"), "user_id").alias("device_id"),
            F.lit("garmin_connect_iq").alias("source"),
        )

    records = F.array(
        reading("heart_rate_intraday", F.when(k % 9 != 0, 50.0 + k), "bpm", 0),
        reading("stress_level", F.when(k % 4 == 0, 127.0).otherwise(k * 1.0), "score", 1),
        reading("spo2", 90.0 + k % 10, "pct", 2),
    )
    return ev.select(
        F.col("event_id").cast("string").alias("record_id"),
        F.col("ts").alias("ingested_at"),
        F.parse_json(to_text(F.struct(records.alias("records")))).alias("body"),
    )


# ---- Android payloads -------------------------------------------------------

ANDROID_TYPES = [
    "StepsRecord", "DistanceRecord", "ActiveCaloriesBurnedRecord", "BasalMetabolicRateRecord", "HeartRateRecord",
    "RestingHeartRateRecord", "HeartRateVariabilityRmssdRecord", "OxygenSaturationRecord", "Vo2MaxRecord",
    "HydrationRecord",
]
ANDROID_EXERCISE_CODES = [56, 8, 79, 83, 9999]
ANDROID_DELETE_TYPES = ["StepsRecord", "ExerciseSessionRecord", "SleepSessionRecord", "HydrationRecord"]


def android_bronze(ev: DataFrame, record_type: str) -> DataFrame:
    """Bronze rows with Android field names."""
    k, t0 = F.col("k"), F.col("t0")
    rid = F.concat(F.lit("A"), F.col("event_id").cast("string"))
    start = plus(t0, minutes=-(k + 1))
    common = [F.lit("com.example.app").alias("data_origin"), iso(t0).alias("last_modified_time")]
    beat = lambda i: F.struct(
        iso(plus(start, seconds=30 * i)).alias("time"), (60.0 + k + i).alias("beats_per_minute")
    )
    bodies = {
        "samples": F.struct(
            rid.alias("id"),
            one_of(k % 10, ANDROID_TYPES).alias("type"),
            F.when(k % 10 != 4, F.col("value")).alias("value"),
            iso(start).alias("start_time"),
            iso(plus(start, minutes=k % 5)).alias("end_time"),
            F.lit("+01:00").alias("start_zone_offset"),
            F.lit("+01:00").alias("end_zone_offset"),
            F.when(k % 10 == 4, F.array(*[beat(i) for i in range(3)])).alias("samples"),
            *common,
        ),
        "workouts": F.struct(
            rid.alias("id"),
            one_of(k % 5, ANDROID_EXERCISE_CODES).alias("exercise_type_code"),
            iso(start).alias("start_time"),
            iso(plus(start, seconds=600 + k)).alias("end_time"),
            F.concat(F.lit("Session "), k.cast("string")).alias("title"),
            *common,
        ),
        "sleep": F.struct(
            rid.alias("id"),
            iso(plus(t0, minutes=-480)).alias("start_time"),
            iso(t0).alias("end_time"),
            F.array(
                *[
                    F.struct(
                        ((k + i) % 9).alias("stage_code"),
                        iso(plus(t0, minutes=-480 + 120 * i)).alias("start_time"),
                        iso(plus(t0, minutes=-360 + 120 * i, seconds=k)).alias("end_time"),
                    )
                    for i in range(3)
                ]
            ).alias("stages"),
            *common,
        ),
        "deletes": F.struct(
            rid.alias("id"),
            one_of(k % 4, ANDROID_DELETE_TYPES).alias("record_type"),
            iso(t0).alias("deleted_time"),
        ),
    }
    return ev.where(F.col("event_type") == EVENT_TYPE_OF[record_type]).select(
        F.col("event_id").cast("string").alias("record_id"),
        F.col("ts").alias("ingested_at"),
        F.parse_json(F.to_json(bodies[record_type])).alias("body"),
        F.lit(record_type).alias("record_type"),
        F.lit("android_health_connect").alias("source_platform"),
        "user_id",
    )


# ---- intervals, load runs and telemetry -------------------------------------


def intervals(ev: DataFrame) -> DataFrame:
    """Sleep category samples: an interval of ``k`` minutes per event with a stage code."""
    return ev.select(
        "user_id",
        F.col("event_id").cast("string").alias("uuid"),
        (F.col("k") % 7).alias("stage_code"),
        F.col("ts").alias("start_ts"),
        (F.col("ts") + F.make_dt_interval(mins=F.col("k"))).alias("end_ts"),
    )


def load_type_results(ev: DataFrame) -> DataFrame:
    """Counts per user day (the run) and event type."""
    return ev.groupBy(
        F.concat_ws("/", "user_id", F.to_date("ts").cast("string")).alias("run_id"),
        F.col("event_type").alias("record_type"),
    ).agg(
        F.count(F.lit(1)).alias("payload_count"),
        F.sum(F.col("k") % 12).alias("record_count"),
        F.sum(F.when(F.col("k") > 9, F.col("k")).otherwise(0)).alias("duration_ms"),
    )


def load_runs(ev: DataFrame) -> DataFrame:
    """One run per user day; a run without any click has no preset label."""
    return (
        ev.groupBy(F.concat_ws("/", "user_id", F.to_date("ts").cast("string")).alias("run_id"), "user_id")
        .agg(
            F.min("ts").alias("started_at"),
            F.sum("k").alias("duration_ms"),
            F.sum(F.col("k") % 12).alias("total_records"),
            F.max(F.when(F.col("event_type") == "click", "Small")).alias("preset_label"),
            F.min(F.when(F.col("k") > 20, F.col("k") % 8)).alias("pool_size_start"),
            F.max(F.col("k") % 16).alias("pool_size_end"),
        )
    )


def run_events(ev: DataFrame) -> DataFrame:
    """Life-cycle events of load runs: signups create a run, other events report on it."""
    k = F.col("k")
    created = F.col("event_type") == "signup"
    end = lambda c: F.when(~created, c)
    return ev.select(
        "event_id",
        F.col("ts").alias("event_ts"),
        F.concat_ws("/", "user_id", (F.col("event_id") % 5).cast("string")).alias("run_id"),
        F.when(created, "create").otherwise("update").alias("event"),
        F.when(created, F.col("user_id")).alias("user_id"),
        F.when(created, one_of(k % 3, ["Smoke", "Small", "Medium"])).alias("preset_label"),
        F.when(created, k * 10).alias("batch_size"),
        F.when(created, k * 100).alias("total_payloads"),
        F.when(created, k % 16).alias("pool_size_start"),
        end(one_of(k % 3, ["complete", "error", "aborted"])).alias("status"),
        end(k * 7).alias("duration_ms"),
        end(F.when(k % 3 == 0, k * 9)).alias("total_records"),
        end(F.when(k % 3 == 0, k)).alias("records_per_sec"),
        end(k % 12).alias("pool_size_end"),
        end(F.when(k % 3 == 1, F.concat(F.lit("failed "), k.cast("string")))).alias("error_message"),
    )


def sign_ins(ev: DataFrame) -> DataFrame:
    """Sign-in events: a name only now and then, an app version usually."""
    k = F.col("k")
    return ev.select(
        "event_id",
        "ts",
        F.concat(F.lit("sub-"), "user_id").alias("apple_sub"),
        F.concat(F.lit("device-"), (F.col("event_id") % 500).cast("string")).alias("device_id"),
        "user_id",
        F.when(k % 10 == 0, F.concat(F.lit("Name "), k.cast("string"))).alias("display_name"),
        one_of(k % 3, PLATFORMS).alias("platform"),
        F.when(k % 4 != 0, F.concat(F.lit("1."), k.cast("string"))).alias("app_version"),
    )


def telemetry(ev: DataFrame, signal: str) -> DataFrame:
    """Metric, log and span rows of a service, one per event."""
    k = F.col("k")
    date = F.to_date("ts").alias("date")
    if signal == "metrics":
        return ev.select(
            date,
            F.concat(F.lit("http."), "event_type").alias("name"),
            one_of(k % 3, ["gauge", "sum", "histogram"]).alias("metric_type"),
            one_of(k % 2, ["ms", "1"]).alias("unit"),
            F.when(k % 2 == 0, F.concat(F.lit("about "), "event_type")).alias("description"),
        )
    if signal == "logs":
        return ev.select(
            date,
            F.col("ts").alias("time"),
            one_of(k % 4, ["DEBUG", "INFO", "WARN", "ERROR"]).alias("severity_text"),
            F.when(k % 3 != 0, F.col("event_type")).alias("event_name"),
            F.parse_json(
                F.to_json(F.struct(F.concat_ws(" ", F.lit("run"), "event_type", k.cast("string")).alias("msg")))
            ).alias("body"),
        )
    return ev.select(
        date,
        F.concat(F.lit("GET /"), "event_type").alias("name"),
        one_of(k % 2, ["SERVER", "CLIENT"]).alias("kind"),
        F.struct(one_of(k % 3, ["OK", "ERROR", "UNSET"]).alias("code")).alias("status"),
    )
