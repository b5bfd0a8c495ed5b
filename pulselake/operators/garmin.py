"""Garmin pulls: day extractions -> bronze rows -> long metric events."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.functions import codes
from pulselake.functions.scalars import field, lookup, number_or, stable_uuid
from pulselake.operators.ingest import route

SOURCE = "garmin_connect"
META = "map<string,string>"


def garmin_to_bronze(extractions: DataFrame, categories: Iterable[str] = tuple(codes.GARMIN_CATEGORIES)) -> DataFrame:
    """Day extractions -> one bronze row per category that has data.

    An extraction has ``device_id``, ``date``, ``pulled_at``, a unique
    ``extraction_id`` and one JSON text column per category. Only the columns
    of the chosen categories are read.
    """
    present = F.array(
        *[
            F.struct(F.lit(codes.GARMIN_CATEGORIES[c]).alias("record_type"), F.col(c).alias("data"))
            for c in categories
        ]
    )
    rows = extractions.select(
        "extraction_id",
        "device_id",
        F.col("date").cast("string").alias("date"),
        "pulled_at",
        F.explode(F.filter(present, lambda c: c["data"].isNotNull())).alias("c"),
    )
    prefix = F.to_json(F.struct(F.lit(SOURCE).alias("source"), "device_id", "date"))
    # The vendor JSON is put in as it came, then the whole text is parsed. The
    # explode keeps Spark from copying the parse into every path that reads it.
    body = F.concat(F.expr("substring(_p, 1, length(_p) - 1)"), F.lit(',"data":'), F.col("c.data"), F.lit("}"))
    headers = F.struct(
        F.lit("application/json").alias("Content-Type"),
        F.lit(SOURCE).alias("X-Platform"),
        F.col("c.record_type").alias("X-Record-Type"),
        F.col("device_id").alias("X-Device-Id"),
        F.date_format("pulled_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("X-Upload-Timestamp"),
    )
    shaped = rows.withColumn("_p", prefix).select(
        stable_uuid(F.col("extraction_id"), F.col("c.record_type")).alias("record_id"),
        F.col("pulled_at").alias("ingested_at"),
        body.alias("_text"),
        F.parse_json(F.to_json(headers)).alias("headers"),
        F.col("c.record_type").alias("record_type"),
        F.lit(None).cast("string").alias("source_platform"),
        F.lit(None).cast("string").alias("user_id"),
    )
    parsed = F.explode(F.array(F.parse_json("_text"))).alias("body")
    return shaped.select(
        "record_id", "ingested_at", parsed, "headers", "record_type", "source_platform", "user_id"
    )


# ---- building blocks of the long form ---------------------------------------


def _data(path: str, dtype: str = "string") -> Column:
    return field("body", f"data.{path}" if path else "data", dtype)


def _struct(keys: Iterable[str], **nested: str) -> str:
    """Type of an object with text fields and fields of other types."""
    fields = [f"{k}:string" for k in keys] + [f"{k}:{kind}" for k, kind in nested.items()]
    return f"struct<{','.join(fields)}>"


PAIRS = "array<array<double>>"
ACTIVITY_TEXTS = ("activityName", "activityId", "startTimeLocal", "startTimeGMT")
# The data of a bronze row is read once, in the type of its record type. Fields of the
# wrong kind and missing ones are NULL.
DATA_TYPES = {
    "daily_stats": _struct([*codes.GARMIN_DAILY_METRICS, "moderateIntensityMinutes", "vigorousIntensityMinutes"]),
    "heart_rates": _struct([], heartRateValues=PAIRS),
    "sleep": _struct(
        [], dailySleepDTO=_struct(codes.GARMIN_SLEEP_METRICS, sleepScores=_struct([], overall=_struct(["value"])))
    ),
    "stress": _struct([], stressValuesArray=PAIRS),
    "hrv": _struct([], hrvSummary=_struct(["status", "weeklyAvg", "lastNight5MinHigh"])),
    "spo2": _struct(["averageSpO2", "averageSpO2Value"]),
    "body_battery": _struct(["bodyBatteryHighestValue", "bodyBatteryLowestValue"]),
    "respiration": _struct(["avgWakingRespirationValue", "avgSleepRespirationValue"]),
    "activities": "array<" + _struct([*ACTIVITY_TEXTS, *codes.GARMIN_ACTIVITY_METRICS], activityType=_struct(["typeKey"])) + ">",
}


def _no_meta() -> Column:
    return F.create_map().cast(META)


def _metric(name: str, value: Column, unit: str, meta: Column | None = None) -> Column:
    """One reading at the start of its day; NULL in ``value`` means there is none."""
    return _reading(name, value, unit, F.col("_day"), meta)


def _reading(name: str, value: Column, unit: str, at: Column, meta: Column | None = None) -> Column:
    return F.struct(
        F.lit(name).alias("metric_type"),
        value.cast("double").alias("value"),
        F.lit(unit).alias("unit"),
        at.alias("recorded_at"),
        (meta if meta is not None else _no_meta()).alias("metadata"),
    )


def _present(raw: Column, value: Column | None = None) -> Column:
    """Number of a vendor value, 0 if it is no number, NULL if it is missing."""
    return F.when(raw.isNotNull(), value if value is not None else number_or(raw))


def _known(*metrics: Column) -> Column:
    return F.filter(F.array(*metrics), lambda m: m["value"].isNotNull())


def _series(pairs: Column, metric: str, unit: str, in_range: Callable[[Column], Column]) -> Column:
    """Intraday pairs ``[epoch millis, value]``; short pairs, nulls and values out of range are left out."""

    def reading(pair: Column) -> Column:
        return _reading(metric, F.get(pair, F.lit(1)), unit, F.timestamp_millis(F.get(pair, F.lit(0)).cast("long")))

    return F.filter(F.transform(pairs, reading), lambda m: m["recorded_at"].isNotNull() & in_range(m["value"]))


# ---- readings of one bronze row, per record type ----------------------------


def _stats_readings(data: Column) -> Column:
    return _known(
        *[_metric(metric, _present(data[key]), unit) for key, (metric, unit) in codes.GARMIN_DAILY_METRICS.items()]
    )


def _intensity_readings(data: Column) -> Column:
    """Moderate plus vigorous minutes, if either is above 0."""
    moderate = number_or(data["moderateIntensityMinutes"])
    vigorous = number_or(data["vigorousIntensityMinutes"])
    meta = F.create_map(
        F.lit("moderate"), moderate.cast("long").cast("string"), F.lit("vigorous"), vigorous.cast("long").cast("string")
    )
    total = F.when((moderate > 0) | (vigorous > 0), moderate + vigorous)
    return _known(_metric("intensity_minutes", total, "minutes", meta))


def _heart_readings(data: Column) -> Column:
    return _series(data["heartRateValues"], "heart_rate_intraday", "bpm", lambda v: v > 0)


def _sleep_readings(data: Column) -> Column:
    sleep, metrics = data["dailySleepDTO"], []
    for key, (metric, divisor, unit) in codes.GARMIN_SLEEP_METRICS.items():
        metrics.append(_metric(metric, _present(sleep[key], number_or(sleep[key]) / F.lit(divisor)), unit))
    score = _present(sleep["sleepScores"]["overall"]["value"])
    return _known(*metrics, _metric("sleep_score", score, "score"))


def _stress_readings(data: Column) -> Column:
    return _series(data["stressValuesArray"], "stress_level", "score", lambda v: v >= 0)


def _hrv_readings(data: Column) -> Column:
    summary = data["hrvSummary"]
    status = summary["status"]
    score = lookup(F.upper(status), codes.GARMIN_HRV_SCORES, F.lit(-1.0))
    return _known(
        _metric("hrv_weekly_avg", _present(summary["weeklyAvg"]), "ms"),
        _metric("hrv_last_night", _present(summary["lastNight5MinHigh"]), "ms"),
        _metric("hrv_status", F.when(status.isNotNull(), score), "score", F.create_map(F.lit("status_label"), status)),
    )


def _first_nonzero(a: Column, second: Column) -> Column:
    """The first of two values, unless it is missing, 0 or empty; then the second as it is."""
    zero = (a == "") | (F.coalesce(a.try_cast("double"), F.lit(1.0)) == 0) | (a == "false")
    return F.coalesce(F.when(~zero, a), second)


def _spo2_readings(data: Column) -> Column:
    return _known(_metric("spo2", _present(_first_nonzero(data["averageSpO2"], data["averageSpO2Value"])), "pct"))


def _respiration_readings(data: Column) -> Column:
    value = _first_nonzero(data["avgWakingRespirationValue"], data["avgSleepRespirationValue"])
    return _known(_metric("respiration_rate", _present(value), "brpm"))


def _battery_readings(data: Column) -> Column:
    """Highest and lowest level, from a list of pairs or from two named values."""
    levels = F.filter(F.transform("_levels", lambda pair: F.get(pair, F.lit(1))), lambda v: v > 0)
    high = F.coalesce(F.array_max(levels), _present(data["bodyBatteryHighestValue"]))
    low = F.coalesce(F.array_min(levels), _present(data["bodyBatteryLowestValue"]))
    return _known(_metric("body_battery_high", high, "score"), _metric("body_battery_low", low, "score"))


def _activity_readings(data: Column) -> Column:
    """Five readings per activity. An unreadable time is NULL, not the time of the run."""

    def readings(one: Column) -> Column:
        meta = F.create_map(
            F.lit("activity_type"), F.coalesce(one["activityType"]["typeKey"], F.lit("unknown")),
            F.lit("activity_name"), F.coalesce(one["activityName"], F.lit("")),
            F.lit("activity_id"), F.coalesce(one["activityId"], F.lit("")),
        )
        local = F.nullif(one["startTimeLocal"], F.lit(""))
        at = F.coalesce(local, one["startTimeGMT"]).try_cast("timestamp")
        # Entries that are no objects are NULL and so have no readings.
        return F.array(
            *[
                _reading(name, _present(one[key]), unit, at, meta)
                for key, (name, unit) in codes.GARMIN_ACTIVITY_METRICS.items()
            ]
        )

    flat = F.flatten(F.transform(data, readings))
    return F.filter(flat, lambda m: m["value"].isNotNull())


READINGS = {
    "daily_stats": lambda data: F.concat(_stats_readings(data), _intensity_readings(data)),
    "heart_rates": _heart_readings,
    "sleep": _sleep_readings,
    "stress": _stress_readings,
    "hrv": _hrv_readings,
    "spo2": _spo2_readings,
    "body_battery": _battery_readings,
    "respiration": _respiration_readings,
    "activities": _activity_readings,
}


def _events(bronze: DataFrame, readings: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Metric events from the arrays of readings of bronze rows, by record type."""
    of_type = F.col("record_type")
    typed = [F.when(of_type == t, field("body", "data", DATA_TYPES[t])).alias(f"_{t}") for t in readings]
    if "body_battery" in readings:
        typed.append(F.when(of_type == "body_battery", field("body", "data", PAIRS)).alias("_levels"))
    read = bronze.where(of_type.isin(list(readings))).select(
        field("body", "device_id", "string").alias("device_id"),
        "ingested_at",
        "record_type",
        field("body", "date", "date").cast("timestamp").alias("_day"),
        *typed,
    )
    events = F.lit(None)
    for record_type, build in readings.items():
        events = F.when(of_type == record_type, build(F.col(f"_{record_type}"))).otherwise(events)
    return read.select("device_id", "ingested_at", F.explode(events).alias("m")).select(
        F.lit(SOURCE).alias("source"),
        "device_id",
        "m.metric_type",
        "m.value",
        "m.unit",
        "m.recorded_at",
        "ingested_at",
        "m.metadata",
    )


def daily_stats(bronze: DataFrame) -> DataFrame:
    return _events(bronze, {"daily_stats": _stats_readings})


def intensity_minutes(bronze: DataFrame) -> DataFrame:
    return _events(bronze, {"daily_stats": _intensity_readings})


def events_of(bronze: DataFrame, record_type: str) -> DataFrame:
    """Metric events of one record type."""
    return _events(bronze, {record_type: READINGS[record_type]})


def normalize(bronze: DataFrame) -> DataFrame:
    """All metric events, in one pass over the bronze rows.

    Day step counts have no long form and stay in bronze.
    """
    return _events(bronze, READINGS)


def rejected_times(events: DataFrame) -> DataFrame:
    """Events per metric whose time could not be read."""
    return (
        events.where(F.col("recorded_at").isNull()).groupBy("metric_type").agg(F.count(F.lit(1)).alias("rejected"))
    )


# ---- wide daily queries -----------------------------------------------------


def daily_stats_wide(bronze: DataFrame) -> DataFrame:
    whole = {
        "resting_hr": "restingHeartRate",
        "steps": "totalSteps",
        "total_calories": "totalKilocalories",
        "active_calories": "activeKilocalories",
        "floors": "floorsAscended",
        "avg_stress": "averageStressLevel",
    }
    return (
        route(bronze, "daily_stats")
        .select(
            field("body", "date", "string").alias("day"),
            *[_data(key, "int").alias(name) for name, key in whole.items()],
            _data("vO2MaxValue", "double").alias("vo2_max"),
        )
        .orderBy(F.desc("day"))
    )


def sleep_wide(bronze: DataFrame) -> DataFrame:
    def part(key: str, seconds: str, digits: int) -> Column:
        return F.round(_data(f"dailySleepDTO.{key}", "int") / F.expr(seconds), digits)

    return (
        route(bronze, "sleep")
        .select(
            field("body", "date", "string").alias("day"),
            part("sleepTimeSeconds", "3600.0BD", 1).alias("sleep_hours"),
            part("deepSleepSeconds", "60.0BD", 0).alias("deep_min"),
            part("lightSleepSeconds", "60.0BD", 0).alias("light_min"),
            part("remSleepSeconds", "60.0BD", 0).alias("rem_min"),
            _data("dailySleepDTO.sleepScores.overall.value", "int").alias("sleep_score"),
        )
        .orderBy(F.desc("day"))
    )


def hrv_wide(bronze: DataFrame) -> DataFrame:
    return (
        route(bronze, "hrv")
        .select(
            field("body", "date", "string").alias("day"),
            _data("hrvSummary.weeklyAvg", "double").alias("hrv_weekly_avg_ms"),
            _data("hrvSummary.lastNight5MinHigh", "double").alias("hrv_last_night_ms"),
            _data("hrvSummary.status").alias("hrv_status"),
        )
        .orderBy(F.desc("day"))
    )


# ---- coverage of a pull -----------------------------------------------------


def _days(start: str, end: str) -> Column:
    """Days of [start, end)."""
    return F.explode(F.sequence(F.lit(start).cast("date"), F.date_sub(F.lit(end).cast("date"), 1)))


def missing_days(bronze: DataFrame, start: str, end: str) -> DataFrame:
    """Device days of [start, end) without any bronze row; the end day is not part of the range."""
    if start >= end:
        raise ValueError("start must be before end")
    seen = bronze.select(
        field("body", "device_id", "string").alias("device_id"), field("body", "date", "date").alias("day")
    ).distinct()
    spine = seen.select("device_id").distinct().select("device_id", _days(start, end).alias("day"))
    return spine.join(seen, ["device_id", "day"], "left_anti")


def backfill_gaps(extractions: DataFrame, start: str, end: str, categories: Iterable[str]) -> DataFrame:
    """Device days of [start, end) to pull again, by ``state``.

    ``missing`` days have no extraction at all; on ``failed`` days there are some,
    but none of the categories came with any of them.
    """
    if start >= end:
        raise ValueError("start must be before end")
    came = F.max(F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(True)) for c in categories], F.lit(False)))
    pulled = extractions.groupBy("device_id", F.col("date").cast("date").alias("day")).agg(came.alias("came"))
    spine = pulled.select("device_id").distinct().select("device_id", _days(start, end).alias("day"))
    state = F.when(F.col("came").isNull(), "missing").when(~F.col("came"), "failed").alias("state")
    return spine.join(pulled, ["device_id", "day"], "left").select("device_id", "day", state).where("state is not null")


def category_completeness(extractions: DataFrame) -> DataFrame:
    """``ok`` or ``missing`` per device, day and category."""
    names = list(codes.GARMIN_CATEGORIES)
    found = extractions.groupBy("device_id", F.col("date").alias("day")).agg(
        *[F.max(F.col(c).isNotNull()).alias(c) for c in names]
    )
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("category"), F.when(F.col(c), "ok").otherwise("missing").alias("state"))
            for c in names
        ]
    )
    return found.select("device_id", "day", F.explode(entries).alias("e")).select("device_id", "day", "e.*")
