"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake.functions import codes, scalars
from pulselake.operators import (
    cdc,
    garmin,
    gold,
    ingest,
    joins,
    ledger,
    platforms,
    quality,
    reconcile,
    reports,
    runs,
    sessions,
    sketches,
    typed,
    watch,
)
from pulselake.plans.pipeline import HealthGraph
from pulselake.session import prepare, work_dir
from pulselake.sources import clustering, fixtures, ndjson, tables
from pulselake.sources.contracts import load_table_config

AS_OF = "2024-02-01 00:00:00"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def publish(df: DataFrame) -> DataFrame:
    """Output form any SQL engine can be compared with.

    VARIANT columns become JSON text with ordered keys, instants become
    zone-free, dates text and doubles are rounded to 6 decimals.
    """
    out = []
    for f in df.schema:
        kind, column = f.dataType.typeName(), F.col(f"`{f.name}`")
        if kind == "variant":
            column = F.to_json(column)
        elif kind == "timestamp":
            column = column.cast("timestamp_ntz")
        elif kind == "date":
            column = column.cast("string")
        elif kind == "double":
            column = F.round(column, 6)
        out.append(column.alias(f.name))
    return df.select(*out)


def query(name: str):
    """Register a query; ``fn(ev, spark)`` gets the shaped events of the folder."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return publish(fn(fixtures.events(spark, sf_dir), spark, sf_dir))

        QUERIES[name] = run
        return fn

    return register


def graph(ev: DataFrame) -> HealthGraph:
    return HealthGraph(lambda record_type: fixtures.bronze(ev, record_type), AS_OF)


# ---- table graph ------------------------------------------------------------

GRAPH_TABLES = {
    "bronze_typed_health_samples": "samples",
    "bronze_typed_workouts": "workouts",
    "bronze_typed_sleep_stages": "sleep_stages",
    "bronze_typed_activity_summaries": "activity_summaries",
    "bronze_typed_deletes": "deletes",
}
for _table in [
    "cdc_health_samples",
    "cdc_workouts",
    "cdc_sleep_stages",
    "silver_health_samples",
    "silver_workouts",
    "silver_sleep_stages",
    "silver_health_samples_history",
    "silver_workouts_history",
    "silver_sleep_stages_history",
    "silver_activity_summaries",
    "gold_sleep_sessions",
    "quarantine_unmatched_deletes",
    "delete_match_report",
]:
    GRAPH_TABLES[_table] = _table

for _name, _attribute in GRAPH_TABLES.items():
    query(_name)(lambda ev, spark, sf, a=_attribute: getattr(graph(ev), a))


@query("typed_sleep_sessions")
def _(ev, spark, sf):
    rows = typed.type_sleep_sessions(fixtures.bronze(ev, "sleep"))
    names = F.array_join(F.transform("stages", lambda s: s["stage"]), ">")
    return rows.withColumn("stages", names)


@query("silver_activity_summaries_dedup")
def _(ev, spark, sf):
    return cdc.passthrough(graph(ev).activity_summaries, dedup=["user_id", "activity_date"])


@query("known_uuids")
def _(ev, spark, sf):
    g = graph(ev)
    return gold.known_uuids(g.samples, g.workouts, g.sleep_stages)


@query("history_as_of")
def _(ev, spark, sf):
    return cdc.as_of(graph(ev).silver_workouts_history, "2024-01-15 12:00:00")


@query("history_current_state")
def _(ev, spark, sf):
    return cdc.current_state(graph(ev).silver_workouts_history, ["uuid"])


@query("history_hot_keys")
def _(ev, spark, sf):
    """SCD2 in chunks of a minute, so nearly every change looks beyond its own chunk."""
    return cdc.apply_scd2(graph(ev).cdc_workouts, ["uuid"], chunk="minute")


@query("stand_hour_deletes")
def _(ev, spark, sf):
    """Feed of samples with the stand-hour option; every fourth heart-rate delete is a stand-hour one."""
    g = graph(ev)
    stand = F.when(F.col("record_id").cast("long") % 4 == 0, "HKCategoryTypeIdentifierAppleStandHour")
    deletes = g.deletes.withColumn("sample_type", F.coalesce(stand, "sample_type"))
    feed = cdc.cdc_health_samples(g.samples, deletes, stand_hours=True)
    return feed.select("uuid", "ingested_at", "operation", "sample_type")


# ---- quality ----------------------------------------------------------------

for _name, _table, _type, _build in [
    ("expectation_report_samples", "bronze_typed_health_samples", "samples", typed.type_health_samples),
    ("expectation_report_workouts", "bronze_typed_workouts", "workouts", typed.type_workouts),
    ("expectation_report_sleep_stages", "bronze_typed_sleep_stages", "sleep", typed.type_sleep_stages),
    ("expectation_report_activity", "bronze_typed_activity_summaries", "activity_summaries", typed.type_activity_summaries),
    ("expectation_report_deletes", "bronze_typed_deletes", "deletes", typed.type_deletes),
    ("expectation_report_sleep_sessions", "sleep_sessions", "sleep", typed.type_sleep_sessions),
]:
    query(_name)(
        lambda ev, spark, sf, t=_table, r=_type, b=_build: quality.expectation_report(
            b(fixtures.bronze(ev, r)), load_table_config(t), AS_OF
        )
    )


@query("expect_or_drop")
def _(ev, spark, sf):
    """Workouts that hold the warn rules as if they were hard ones."""
    rules = {"long_enough": "duration_seconds > 3600", "has_distance": "total_distance_meters > 0"}
    return quality.expect_or_drop(graph(ev).workouts, rules).select("record_id", "uuid", "duration_seconds")


@query("key_check")
def _(ev, spark, sf):
    g = graph(ev)
    raw = fixtures.bronze(ev).select("record_id")
    named = {t: (getattr(g, a), load_table_config(t)) for t, a in GRAPH_TABLES.items() if t.startswith("bronze_typed")}
    named["silver_workouts"] = (g.silver_workouts, load_table_config("silver_workouts"))
    named["silver_activity_summaries"] = (g.silver_activity_summaries, load_table_config("silver_activity_summaries"))
    return quality.check_keys(named, {"raw_bronze": raw})


@query("duplicate_keys")
def _(ev, spark, sf):
    return quality.duplicate_keys(graph(ev).sleep_stages, load_table_config("bronze_typed_sleep_stages"))


@query("orphan_rows")
def _(ev, spark, sf):
    """Workouts whose id is not among the samples."""
    g = graph(ev)
    fk = {"columns": ["uuid"], "references": {"table": "bronze_typed_health_samples", "columns": ["uuid"]}}
    return quality.orphan_rows(g.workouts.select("record_id", "uuid"), fk, g.samples)


@query("orphan_rows_hot_keys")
def _(ev, spark, sf):
    """As before, with one id that a third of all rows share."""
    g = graph(ev)
    fk = {"columns": ["uuid"], "references": {"table": "bronze_typed_health_samples", "columns": ["uuid"]}}
    hot = F.when(F.col("record_id").cast("long") % 3 == 0, "hot")
    return quality.orphan_rows(g.workouts.select("record_id", F.coalesce(hot, "uuid").alias("uuid")), fk, g.samples)


@query("validate_ingest")
def _(ev, spark, sf):
    """All event ids are asked for; one in a hundred is an id that never arrived."""
    asked = F.when(F.col("k") == 50, F.concat(F.lit("lost-"), F.col("event_id").cast("string")))
    ids = ev.select(F.coalesce(asked, F.col("event_id").cast("string")).alias("record_id"))
    return quality.validate_ingest(fixtures.bronze(ev), ids, "apple_healthkit", "1")


# ---- ingest -----------------------------------------------------------------


@query("parse_ndjson_records")
def _(ev, spark, sf):
    records, _ = ndjson.parse_ndjson(fixtures.requests(ev).select("request_id", "body"))
    return records.select("request_id", "line_no", F.try_variant_get("record", "$.type", "string").alias("type"))


@query("parse_ndjson_errors")
def _(ev, spark, sf):
    return ndjson.parse_ndjson(fixtures.requests(ev).select("request_id", "body"))[1]


@query("build_bronze")
def _(ev, spark, sf):
    bronze, _ = ingest.build_bronze(fixtures.requests(ev))
    kept = F.array_join(F.array_sort(F.map_keys(F.try_variant_get("headers", "$", "map<string,string>"))), ",")
    return bronze.withColumn("header_names", kept)


@query("build_bronze_errors")
def _(ev, spark, sf):
    return ingest.build_bronze(fixtures.requests(ev))[1]


@query("normalize_record_type")
def _(ev, spark, sf):
    raw = fixtures.requests(ev).select("request_id", F.element_at("headers", "x-record-type").alias("record_type"))
    return ingest.normalize_record_type(raw)


@query("resolve_user")
def _(ev, spark, sf):
    r = fixtures.requests(ev)
    user = ingest.resolve_user(F.col("jwt_sub"), F.element_at("headers", "x-forwarded-email"))
    return r.select("request_id", user.alias("user_id"), ingest.source_platform(F.col("headers")).alias("platform"))


@query("platform_fallback")
def _(ev, spark, sf):
    return ingest.platform_of(fixtures.bronze(ev)).select("record_id", "source_platform")


def _some_without_user(ev):
    user = F.when(F.col("record_id").cast("long") % 6 != 0, F.col("user_id"))
    return fixtures.bronze(ev).select("record_id", user.alias("user_id"))


@query("null_user_filled")
def _(ev, spark, sf):
    return ingest.null_user(_some_without_user(ev), "fill")


@query("null_user_dropped")
def _(ev, spark, sf):
    return ingest.null_user(_some_without_user(ev), "drop")


@query("ingest_staging")
def _(ev, spark, sf):
    b = fixtures.bronze(ev, "activity_summaries")
    staging = b.select(
        "record_id",
        F.col("ingested_at").cast("string").alias("ingested_at"),
        F.to_json("body").alias("body_json"),
        F.to_json("headers").alias("headers_json"),
        "record_type",
    )
    rows = tables.ingest_staging(staging)
    return rows.withColumn("date", F.try_variant_get("body", "$.date", "string"))


@query("to_ndjson")
def _(ev, spark, sf):
    rows = ev.select(
        F.col("user_id").alias("zone"),
        F.when(F.col("k") % 2 == 0, F.col("k")).alias("count"),
        F.struct(F.col("k").alias("b"), F.col("event_type").alias("a")).alias("inner"),
        F.col("event_id").alias("id"),
    )
    return tables.to_ndjson(rows)


@query("events_as_json")
def _(ev, spark, sf):
    b = garmin.garmin_to_bronze(fixtures.extractions(ev), ["hrv"])
    events = garmin.events_of(b, "hrv").where(F.col("metric_type") == "hrv_status")
    return tables.events_as_json(events)


@query("json_files")
def _(ev, spark, sf):
    """Readings written as JSON files and as NDJSON files with ordered keys, both read back line by line."""
    b = garmin.garmin_to_bronze(fixtures.extractions(ev), ["spo2", "hrv"])
    events = garmin.events_of(b, "spo2").unionByName(garmin.events_of(b, "hrv"))
    folder = work_dir(spark, "json_files")
    tables.write_events_json(events, f"{folder}/events")
    tables.write_ndjson(events.drop("metadata"), f"{folder}/ndjson")
    parts = []
    for kind in ("events", "ndjson"):
        line = ndjson.read_ndjson_files(spark, f"{folder}/{kind}").select("record")
        read = lambda path, dtype: F.try_variant_get("record", f"$.{path}", dtype)
        parts.append(
            line.groupBy(F.lit(kind).alias("file_kind"), read("device_id", "string").alias("device_id"), read("metric_type", "string").alias("metric_type"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum(read("value", "double")).alias("total"))
        )
    return parts[0].unionByName(parts[1])


@query("refused_payloads")
def _(ev, spark, sf):
    """Payloads of more than two lines are refused whole."""
    records, errors = ndjson.parse_ndjson(fixtures.requests(ev).select("request_id", "body"), max_lines=2)
    taken = records.groupBy("request_id").agg(F.count(F.lit(1)).alias("n_records"))
    refused = errors.where(F.col("error").startswith("Too many"))
    return refused.join(taken, "request_id", "left").select("request_id", "error", F.coalesce("n_records", F.lit(0)).alias("n_records"))


@query("watch_records")
def _(ev, spark, sf):
    return watch.explode_watch_records(fixtures.watch_payloads(ev))


@query("incremental_readings")
def _(ev, spark, sf):
    readings = watch.explode_watch_records(fixtures.watch_payloads(ev))
    return watch.incremental_readings(readings, "2024-01-10 00:00:00")


@query("incremental_readings_newest")
def _(ev, spark, sf):
    """The newest 60 readings of each device and metric."""
    readings = watch.explode_watch_records(fixtures.watch_payloads(ev))
    return watch.incremental_readings(readings, "2024-01-02 00:00:00", cap=60)


# ---- stored tables ----------------------------------------------------------


@query("stored_gold_view")
def _(ev, spark, sf):
    """Gold as a stored view: recomputed, written and read back."""
    rows = tables.materialized_view(graph(ev).gold_sleep_sessions, work_dir(spark, "gold"))
    return tables.view(rows, "gold_sleep_sessions").groupBy("sleep_date").agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("total_sleep_minutes").alias("total_sleep_minutes")
    )


@query("stored_typed_samples")
def _(ev, spark, sf):
    """Typed samples appended to a date-partitioned table and read back."""
    path = work_dir(spark, "samples")
    tables.append_batch(graph(ev).samples, path, ["sample_date"], ["user_id", "sample_type"])
    return tables.read_table(spark, path).select("record_id", "user_id", "sample_type", "value", "sample_date", "metadata")


# ---- bronze and telemetry reports -------------------------------------------


@query("count_platform")
def _(ev, spark, sf):
    return reports.count_platform(fixtures.bronze(ev), "garmin_connect")


@query("record_type_summary")
def _(ev, spark, sf):
    return reports.record_type_summary(fixtures.bronze(ev))


@query("record_type_coverage")
def _(ev, spark, sf):
    return reports.record_type_coverage(garmin.garmin_to_bronze(fixtures.extractions(ev)))


@query("source_matrix")
def _(ev, spark, sf):
    return reports.source_matrix(fixtures.bronze(ev))


@query("sample_rows")
def _(ev, spark, sf):
    return reports.sample_rows(garmin.garmin_to_bronze(fixtures.extractions(ev)), "garmin_connect")


@query("metric_catalog")
def _(ev, spark, sf):
    return reports.metric_catalog(fixtures.telemetry(ev, "metrics"), "2024-01-05")


@query("log_summary")
def _(ev, spark, sf):
    return reports.log_summary(fixtures.telemetry(ev, "logs"), "2024-01-05")


@query("span_summary")
def _(ev, spark, sf):
    return reports.span_summary(fixtures.telemetry(ev, "spans"), "2024-01-05")


@query("table_overview")
def _(ev, spark, sf):
    named = {"metrics": "metrics", "logs": "logs", "traces": "spans"}
    return reports.table_overview({n: fixtures.telemetry(ev, s) for n, s in named.items()}, "2024-01-05")


@query("payload_summary")
def _(ev, spark, sf):
    return reports.payload_summary(graph(ev).samples, "uuid")


@query("search_logs")
def _(ev, spark, sf):
    return reports.search_logs(fixtures.telemetry(ev, "logs"), "%signup%")


# ---- sync ledger ------------------------------------------------------------


@query("sync_totals")
def _(ev, spark, sf):
    return ledger.sync_totals(fixtures.sync_events(ev))


@query("sync_breakdown")
def _(ev, spark, sf):
    return ledger.sync_breakdown(fixtures.sync_events(ev))


@query("breakdown_labels")
def _(ev, spark, sf):
    return ledger.breakdown(ledger.sync_breakdown(fixtures.sync_events(ev)), "samples")


@query("category_overview")
def _(ev, spark, sf):
    return ledger.category_overview(fixtures.sync_events(ev))


@query("last_payload")
def _(ev, spark, sf):
    rows = ledger.last_payload(fixtures.sync_events(ev))
    return rows.select("id", "record_type", "timestamp", "record_count", "ndjson_payload")


@query("recent_events")
def _(ev, spark, sf):
    rows = ledger.recent_events(fixtures.sync_events(ev))
    return rows.select("id", "record_type", "timestamp", "record_count", "http_status_code", "success")


# ---- sessions and days ------------------------------------------------------


@query("sessionize")
def _(ev, spark, sf):
    return sessions.sessionize(fixtures.intervals(ev), ["user_id"])


@query("label_sessions")
def _(ev, spark, sf):
    rows = sessions.label_sessions(fixtures.intervals(ev), ["user_id"])
    return rows.withColumn("stage", scalars.ios_sleep_stage(F.col("stage_code")))


@query("daily_summary")
def _(ev, spark, sf):
    rows = platforms.android_samples(fixtures.android_bronze(ev, "samples"))
    return gold.daily_summary(rows, "America/New_York", "2023-12-31", "2024-02-01")


# ---- load runs and registries -----------------------------------------------


@query("throughput")
def _(ev, spark, sf):
    return runs.throughput(fixtures.load_type_results(ev))


def _runs(ev):
    r = fixtures.load_runs(ev)
    return r.withColumn("records_per_sec", runs.records_per_second(F.col("total_records"), F.col("duration_ms")))


def _types(ev):
    return runs.throughput(fixtures.load_type_results(ev))


def _as_text(df):
    entry = lambda t: F.concat_ws(":", *[t[c].cast("string") for c in runs.TYPE_COLUMNS])
    return df.withColumn("type_results", F.array_join(F.transform("type_results", entry), ";"))


@query("runs_with_types")
def _(ev, spark, sf):
    return _as_text(runs.runs_with_types(_runs(ev), _types(ev)))


@query("list_runs")
def _(ev, spark, sf):
    return _as_text(runs.list_runs(_runs(ev), _types(ev), limit=500, offset=10))


@query("list_runs_after")
def _(ev, spark, sf):
    return _as_text(runs.list_runs_after(_runs(ev), _types(ev), "2024-01-20 00:00:00", "", limit=100))


@query("fold_type_results")
def _(ev, spark, sf):
    """Signups open a run with two configured types; every other event reports on its own type."""
    k, created = F.col("k"), F.col("event_type") == "signup"
    events = ev.select(
        "event_id",
        F.col("ts").alias("event_ts"),
        F.concat_ws("/", "user_id", (F.col("event_id") % 5).cast("string")).alias("run_id"),
        F.when(created, "create").otherwise("result").alias("event"),
        F.col("event_type").alias("record_type"),
        k.alias("payload_count"),
        (k * 3).alias("record_count"),
        (k * 7).alias("duration_ms"),
    )
    return cdc.fold_type_results(events, ["view", "click"])


@query("run_detail")
def _(ev, spark, sf):
    return runs.run_detail(
        _runs(ev).select("run_id", "started_at"), _types(ev), "1/2024-01-10"
    )


@query("delete_runs")
def _(ev, spark, sf):
    gone = _runs(ev).where(F.col("preset_label").isNull())
    return runs.delete_runs(_runs(ev), _types(ev), gone)[0]


@query("delete_runs_types")
def _(ev, spark, sf):
    gone = _runs(ev).where(F.col("preset_label").isNull())
    return runs.delete_runs(_runs(ev), _types(ev), gone)[1]


@query("sort_runs")
def _(ev, spark, sf):
    return runs.sort_runs(_runs(ev), "preset_label", "asc")


@query("run_labels")
def _(ev, spark, sf):
    user = F.concat("user_id", F.when(F.col("total_records") % 2 == 0, "@example.org").otherwise(""))
    return _runs(ev).select(
        "run_id",
        scalars.short_user(user).alias("short_user"),
        scalars.pseudonym(F.col("user_id")).alias("pseudonym"),
        scalars.number_label(F.col("duration_ms") * 977).alias("number_label"),
        scalars.duration_label(F.col("duration_ms") * 463).alias("duration_label"),
    )


@query("fold_runs")
def _(ev, spark, sf):
    return cdc.fold_runs(fixtures.run_events(ev))


@query("upsert_users")
def _(ev, spark, sf):
    return cdc.upsert_registry(fixtures.sign_ins(ev), "apple_sub", "ts", ["display_name"], first="created_at")


@query("upsert_devices")
def _(ev, spark, sf):
    return cdc.upsert_registry(fixtures.sign_ins(ev), "device_id", "ts", ["app_version"], ["user_id", "platform"])


@query("backfill_nulls")
def _(ev, spark, sf):
    """Pool sizes missing in a run are taken from a table of fixes, here one per user's first run."""
    base = _runs(ev)
    fixes = base.groupBy("user_id").agg(F.min("run_id").alias("run_id")).select(
        "run_id", F.lit(2).alias("pool_size_start"), F.lit(4).alias("pool_size_end")
    )
    filled = cdc.backfill_nulls(base, fixes, "run_id", "pool_size_start", ["pool_size_start", "pool_size_end"])
    return filled.select("run_id", "pool_size_start", "pool_size_end")


# ---- Garmin -----------------------------------------------------------------


def _garmin(ev, *categories):
    return garmin.garmin_to_bronze(fixtures.extractions(ev), categories)


def _flat(events):
    """Metric events with the metadata as sorted text."""
    entries = F.transform(
        F.array_sort(F.map_entries("metadata")), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return events.withColumn("metadata", F.array_join(entries, ";"))


for _name, _category, _type in [
    ("garmin_heart_rates", "heart_rates", "heart_rates"),
    ("garmin_sleep", "sleep", "sleep"),
    ("garmin_stress", "stress", "stress"),
    ("garmin_hrv", "hrv", "hrv"),
    ("garmin_spo2", "spo2", "spo2"),
    ("garmin_respiration", "respiration", "respiration"),
    ("garmin_body_battery", "body_battery", "body_battery"),
    ("garmin_activities", "activities", "activities"),
]:
    query(_name)(lambda ev, spark, sf, c=_category, t=_type: _flat(garmin.events_of(_garmin(ev, c), t)))


@query("garmin_daily_stats")
def _(ev, spark, sf):
    return _flat(garmin.daily_stats(_garmin(ev, "stats")))


@query("garmin_intensity_minutes")
def _(ev, spark, sf):
    return _flat(garmin.intensity_minutes(_garmin(ev, "stats")))


@query("garmin_to_bronze")
def _(ev, spark, sf):
    b = _garmin(ev, *codes.GARMIN_CATEGORIES)
    return b.select(
        "record_id",
        "ingested_at",
        "record_type",
        scalars.field("body", "source", "string").alias("source"),
        scalars.field("body", "device_id", "string").alias("device_id"),
        scalars.field("body", "date", "string").alias("date"),
        F.try_variant_get("headers", "$['X-Record-Type']", "string").alias("header_type"),
    )


@query("garmin_normalize")
def _(ev, spark, sf):
    events = garmin.normalize(_garmin(ev, *codes.GARMIN_CATEGORIES))
    return events.groupBy("metric_type", "unit").agg(
        F.count(F.lit(1)).alias("readings"), F.sum("value").alias("total"), F.max("recorded_at").alias("latest")
    )


@query("garmin_rejected_times")
def _(ev, spark, sf):
    return garmin.rejected_times(garmin.events_of(_garmin(ev, "activities"), "activities"))


@query("garmin_daily_stats_wide")
def _(ev, spark, sf):
    return garmin.daily_stats_wide(_garmin(ev, "stats"))


@query("garmin_sleep_wide")
def _(ev, spark, sf):
    wide = garmin.sleep_wide(_garmin(ev, "sleep"))
    return wide.select("day", *[F.col(c).cast("double").alias(c) for c in wide.columns[1:5]], "sleep_score")


@query("garmin_hrv_wide")
def _(ev, spark, sf):
    return garmin.hrv_wide(_garmin(ev, "hrv"))


@query("garmin_missing_days")
def _(ev, spark, sf):
    return garmin.missing_days(_garmin(ev, "hrv"), "2024-01-01", "2024-02-03")


@query("garmin_backfill_gaps")
def _(ev, spark, sf):
    return garmin.backfill_gaps(fixtures.extractions(ev), "2024-01-01", "2024-02-03", ["steps", "activities"])


@query("garmin_category_completeness")
def _(ev, spark, sf):
    return garmin.category_completeness(fixtures.extractions(ev))


# ---- platform adapters ------------------------------------------------------


@query("android_samples")
def _(ev, spark, sf):
    return platforms.android_samples(fixtures.android_bronze(ev, "samples"))


@query("android_workouts")
def _(ev, spark, sf):
    return platforms.android_workouts(fixtures.android_bronze(ev, "workouts"))


@query("android_sleep_stages")
def _(ev, spark, sf):
    return platforms.android_sleep_stages(fixtures.android_bronze(ev, "sleep"))


@query("android_deletes")
def _(ev, spark, sf):
    return platforms.android_deletes(fixtures.android_bronze(ev, "deletes"))


@query("ios_codes")
def _(ev, spark, sf):
    return ev.select(
        "event_id",
        scalars.ios_sleep_stage(F.col("k") % 8).alias("stage"),
        scalars.ios_activity(F.col("k")).alias("activity"),
    )


@query("quantity_samples")
def _(ev, spark, sf):
    return platforms.quantity_samples(graph(ev).samples.drop("unit")).select("record_id", "sample_type", "value", "unit")


@query("category_samples")
def _(ev, spark, sf):
    """Every third sample is a stand-hour one with an integer value."""
    s = graph(ev).samples
    kind = F.when(F.col("record_id").cast("long") % 3 == 0, "HKCategoryTypeIdentifierAppleStandHour")
    rows = s.withColumns(
        {"sample_type": F.coalesce(kind, "sample_type"), "value": F.floor("value").cast("int") % 2}
    )
    return platforms.category_samples(rows).select("record_id", "sample_type", "value", "unit")


@query("delete_targets")
def _(ev, spark, sf):
    return graph(ev).deletes.select("record_id", gold.delete_target(F.col("sample_type")).alias("target_table"))


@query("type_labels")
def _(ev, spark, sf):
    return graph(ev).samples.select("record_id", scalars.type_label(F.col("sample_type")).alias("label"))


# ---- joins over time --------------------------------------------------------


@query("point_in_time_workouts")
def _(ev, spark, sf):
    """Every event with the version of its workout that was valid when it happened."""
    events = ev.select("event_id", fixtures.uuid_of().alias("uuid"), "ts")
    found = joins.point_in_time(events, graph(ev).silver_workouts_history, ["uuid"], "ts")
    return found.select("event_id", "uuid", "ts", "v_activity_type", "v___START_AT", "v___END_AT")


@query("samples_in_workouts")
def _(ev, spark, sf):
    """Samples that fall into a workout of the same user."""
    g = graph(ev)
    samples = g.silver_health_samples.select("user_id", "uuid", "sample_type", "value", "start_ts")
    workouts = g.silver_workouts.select("user_id", F.col("uuid").alias("workout_uuid"), "activity_type", "start_ts", "end_ts")
    return joins.within_intervals(samples, workouts, ["user_id"], "start_ts", prefix="w_").drop("w_start_ts")


# ---- grouping sets, sketches, bags, layout ----------------------------------


@query("ingest_cube")
def _(ev, spark, sf):
    return reports.ingest_cube(fixtures.bronze(ev))


@query("daily_sketches")
def _(ev, spark, sf):
    """Sketches stored by day and merged by week, held against a sketch of the whole week and exact figures."""
    day = F.to_date("ts")
    path = work_dir(spark, "daily_sketches")
    sketches.daily_sketches(ev, day, F.col("user_id"), F.col("value")).write.parquet(path)
    week = lambda d: F.date_trunc("week", d).cast("date")
    merged = sketches.merged(spark.read.parquet(path), week(F.col("day")), "week")
    exact = ev.groupBy(week(day).alias("week")).agg(
        F.count_distinct("user_id").alias("users"),
        F.hll_sketch_estimate(F.hll_sketch_agg("user_id", sketches.HLL_BITS)).alias("whole"),
        F.percentile("value", 0.5).alias("median"),
    )
    close = lambda a, b, bound: F.abs(a - b) <= bound
    return merged.join(exact, "week").select(
        "week",
        "n_rows",
        "users",
        close(F.col("distinct_ids"), F.col("whole"), 0).alias("merged_is_whole"),
        close(F.col("distinct_ids"), F.col("users"), 3 * sketches.HLL_ERROR * F.col("users") + 1).alias("users_close"),
        F.col("median")
        .between(sketches.quantile("quantiles", 0.5 - 2 * sketches.KLL_ERROR), sketches.quantile("quantiles", 0.5 + 2 * sketches.KLL_ERROR))
        .alias("median_close"),
    )


@query("reconcile_repulled")
def _(ev, spark, sf):
    """Bronze against a second pull that lacks some rows and has others twice."""
    stored = fixtures.bronze(ev)
    number = F.col("record_id").cast("long")
    pulled = stored.where(number % 5 != 0)
    pulled = pulled.unionByName(pulled.where(number % 7 == 0))
    found = reconcile.reconcile(stored, pulled, ["record_type", "user_id", "ingested_at", "body"])
    return found.groupBy("side", "record_type", F.to_date("ingested_at").alias("day")).agg(F.count(F.lit(1)).alias("n_rows"))


CLUSTERED = {"silver_workouts": "user_id activity_type workout_date", "silver_health_samples": "user_id sample_type sample_date"}


@query("clustered_tables")
def _(ev, spark, sf):
    """Tables stored by their contracts: rows of the commonest value of each column, and whether a filter on it skips files."""
    folder, found = work_dir(spark, "clustered"), []
    for name, columns in CLUSTERED.items():
        path = f"{folder}/{name}"
        stored = clustering.store_by_contract(getattr(graph(ev), name), load_table_config(name), path, files=64)
        for column in columns.split():
            counts = stored.groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
            top = counts.orderBy(F.desc("n_rows"), "value").first()
            hit, files = clustering.files_for(spark, path, column, top.value)
            found.append((name, column, top.value, top.n_rows, files > 32, hit <= 0.7 * files))
    schema = "table_name string, column string, value string, n_rows long, many_files boolean, skips_files boolean"
    return spark.createDataFrame(found, schema)
