"""SQL that any engine can run on the given tables, one text per query.

The texts compute every result from the event columns alone. They do not use
the JSON payloads, so they check the payload handling as well.
"""

from __future__ import annotations

from pulselake.sources.contracts import get_expectations_drop, get_expectations_warn, load_table_config

AS_OF = "2024-02-01 00:00:00"
ORACLE: dict[str, str] = {}

# ---- shared building blocks -------------------------------------------------

CTES = {
    "base": """
SELECT event_id, ts, CAST(user_id AS VARCHAR) AS user_id, event_type, value,
       CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
       event_id // 4 AS ukey, date_trunc('minute', ts) AS t0,
       CAST(event_id AS VARCHAR) AS record_id,
       CASE event_id % 3 WHEN 0 THEN 'apple_healthkit' WHEN 1 THEN 'android_health_connect' ELSE 'garmin_connect' END AS plat,
       CASE WHEN event_id % 7 <> 0 THEN plat END AS source_platform,
       CASE event_type WHEN 'view' THEN 'samples' WHEN 'click' THEN 'workouts' WHEN 'purchase' THEN 'sleep'
                       WHEN 'signup' THEN 'activity_summaries' WHEN 'error' THEN 'deletes' END AS record_type
FROM events""",
    "samples": """
SELECT record_id, ts AS ingested_at, user_id, source_platform, 'U' || ukey AS uuid,
       CASE k % 4 WHEN 0 THEN 'HKQuantityTypeIdentifierHeartRate' WHEN 1 THEN 'HKQuantityTypeIdentifierStepCount'
                  WHEN 2 THEN 'HKQuantityTypeIdentifierOxygenSaturation'
                  ELSE 'HKQuantityTypeIdentifierActiveEnergyBurned' END AS sample_type,
       value, CASE k % 4 WHEN 0 THEN 'count/min' WHEN 1 THEN 'count' WHEN 2 THEN '%' ELSE 'kcal' END AS unit,
       t0 - to_minutes(k + 1) AS start_ts, t0 - to_minutes(k + 1) + to_minutes(k % 5) AS end_ts,
       'Apple Watch' AS source_name, 'com.example.u' || user_id AS source_bundle_id,
       CAST(CAST(t0 - to_minutes(k + 1) AS DATE) AS VARCHAR) AS sample_date,
       CAST(hour(t0 - to_minutes(k + 1)) AS INTEGER) AS sample_hour,
       CASE WHEN k % 2 = 0 THEN '{"motion":"' || k % 3 || '"}' ELSE 'null' END AS metadata
FROM base WHERE event_type = 'view'""",
    "workouts": """
SELECT record_id, ts AS ingested_at, user_id, source_platform, 'U' || ukey AS uuid,
       CASE k % 3 WHEN 0 THEN 'running' WHEN 1 THEN 'walking' ELSE 'cycling' END AS activity_type,
       CASE k % 3 WHEN 0 THEN 37 WHEN 1 THEN 52 ELSE 13 END AS activity_type_raw,
       CAST(600 + 60 * k + k % 7 AS DOUBLE) AS duration_seconds,
       t0 - to_minutes(120) AS start_ts, t0 - to_minutes(120) + to_seconds(600 + 60 * k + k % 7) AS end_ts,
       CASE WHEN k % 10 <> 0 THEN CAST(100 * k AS DOUBLE) END AS total_distance_meters,
       value AS total_energy_burned_kcal, 'Apple Watch' AS source_name,
       CAST(CAST(t0 - to_minutes(120) AS DATE) AS VARCHAR) AS workout_date,
       round((600 + 60 * k + k % 7) / 60.0, 6) AS duration_minutes,
       CASE WHEN k % 10 <> 0 THEN 100 * k / 1000.0 END AS distance_km, 'null' AS metadata
FROM base WHERE event_type = 'click'""",
    "nights": """
SELECT *, t0 - to_minutes(440 + k) AS session_start_ts, t0 - to_minutes(20 + k) AS session_end_ts,
       unnest([{'i': 1, 'stage': 'awake', 'b': 0, 'e': 1200},
               {'i': 2, 'stage': 'asleepCore', 'b': 1200, 'e': 13800 + k},
               {'i': 3, 'stage': 'asleepDeep', 'b': 13800 + k, 'e': 18840 + k},
               {'i': 4, 'stage': 'asleepREM', 'b': 18840 + k, 'e': 18840 + k + (90 + k % 16) * 60},
               {'i': 5, 'stage': 'inBed', 'b': 18840 + k + (90 + k % 16) * 60, 'e': 19140 + k + (90 + k % 16) * 60}]) AS s
FROM base WHERE event_type = 'purchase'""",
    "stages": """
SELECT record_id, ts AS ingested_at, user_id, source_platform, 'U' || ukey || '-' || s.i AS stage_uuid, s.stage AS stage,
       session_start_ts + to_seconds(s.b) AS stage_start_ts, session_start_ts + to_seconds(s.e) AS stage_end_ts,
       round((s.e - s.b) / 60.0, 6) AS stage_duration_minutes, session_start_ts, session_end_ts,
       CAST(CAST(session_start_ts AS DATE) AS VARCHAR) AS sleep_date
FROM nights WHERE s.i < 5 OR k % 10 = 0""",
    "rings": """
SELECT record_id, ts AS ingested_at, user_id, source_platform, CAST(CAST(ts AS DATE) AS VARCHAR) AS activity_date,
       round(value * 2, 6) AS energy_burned_kcal,
       CASE k % 3 WHEN 0 THEN 400.0 WHEN 1 THEN 500.0 ELSE 600.0 END::DOUBLE AS energy_goal_kcal,
       k AS exercise_minutes, CASE WHEN k = 0 THEN 0 ELSE 30 END AS exercise_goal_minutes,
       k % 25 AS stand_hours, 12 AS stand_goal_hours,
       round(value * 2 / CASE k % 3 WHEN 0 THEN 400.0 WHEN 1 THEN 500.0 ELSE 600.0 END, 6) AS energy_goal_pct,
       CASE WHEN k <> 0 THEN round(k / 30.0, 6) END AS exercise_goal_pct, round((k % 25) / 12.0, 6) AS stand_goal_pct
FROM base WHERE event_type = 'signup'""",
    "deletes": """
SELECT record_id, ts AS ingested_at, user_id, source_platform,
       'U' || ukey || CASE WHEN k % 4 = 3 THEN '-1' ELSE '' END AS deleted_uuid,
       CASE k % 4 WHEN 2 THEN 'HKWorkoutTypeIdentifier' WHEN 3 THEN 'HKCategoryTypeIdentifierSleepAnalysis'
                  ELSE 'HKQuantityTypeIdentifierHeartRate' END AS sample_type
FROM base WHERE event_type = 'error'""",
    "targets": """
SELECT *, CASE WHEN sample_type LIKE 'HKQuantityType%' THEN 'silver_health_samples'
               WHEN sample_type = 'HKWorkoutTypeIdentifier' THEN 'silver_workouts'
               WHEN sample_type = 'HKCategoryTypeIdentifierSleepAnalysis' THEN 'silver_sleep_stages'
               ELSE 'unknown' END AS target_table
FROM deletes""",
    "ids": """
SELECT uuid FROM samples UNION ALL SELECT uuid FROM workouts UNION ALL SELECT stage_uuid FROM stages""",
}
USES = {
    "samples": ["base"],
    "workouts": ["base"],
    "nights": ["base"],
    "stages": ["nights"],
    "rings": ["base"],
    "deletes": ["base"],
    "targets": ["deletes"],
    "ids": ["samples", "workouts", "stages"],
}


def with_(*names: str, **extra: str) -> str:
    """WITH clause of the named blocks and what they use, then the extra ones."""
    order: list[str] = []

    def add(name: str) -> None:
        for used in USES.get(name, []):
            add(used)
        if name not in order:
            order.append(name)

    for n in names:
        add(n)
    parts = [f"{n} AS ({CTES[n].strip()})" for n in order] + [f"{n} AS ({sql})" for n, sql in extra.items()]
    return "WITH " + ",\n".join(parts) + "\n"


BASE = with_("base")
COLUMNS = {
    "samples": "ingested_at user_id source_platform uuid sample_type value unit start_ts end_ts source_name "
    "source_bundle_id sample_date sample_hour metadata".split(),
    "workouts": "ingested_at user_id source_platform uuid activity_type activity_type_raw duration_seconds start_ts "
    "end_ts total_distance_meters total_energy_burned_kcal source_name workout_date duration_minutes distance_km metadata".split(),
    "stages": "ingested_at user_id source_platform stage_uuid stage stage_start_ts stage_end_ts "
    "stage_duration_minutes session_start_ts session_end_ts sleep_date".split(),
}
FEEDS = {
    "samples": ("uuid", "sample_type LIKE 'HKQuantityType%'"),
    "workouts": ("uuid", "sample_type = 'HKWorkoutTypeIdentifier'"),
    "stages": ("stage_uuid", "sample_type = 'HKCategoryTypeIdentifierSleepAnalysis'"),
}


def feed(table: str) -> str:
    key, aimed = FEEDS[table]
    nulls = ", ".join(
        "deleted_uuid" if c == key else "ingested_at" if c == "ingested_at" else "NULL" for c in ["record_id", *COLUMNS[table]]
    )
    cols = ", ".join(["record_id", *COLUMNS[table]])
    return (
        f"SELECT {cols}, 'INSERT' AS operation FROM {table} "
        f"UNION ALL SELECT {nulls}, 'DELETE' FROM deletes WHERE {aimed}"
    )


def current(table: str, without: str = "") -> str:
    key = FEEDS[table][0]
    return (
        f"SELECT {', '.join(c for c in COLUMNS[table] if c != without)} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY "
        "ingested_at DESC, operation, record_id DESC NULLS LAST) AS rn FROM feed) WHERE rn = 1 AND operation = 'INSERT'"
    )


def history(table: str) -> str:
    key = FEEDS[table][0]
    columns = [c for c in COLUMNS[table] if c != "metadata"]
    return f"""SELECT {', '.join(columns)}, ingested_at AS "__START_AT", next_at AS "__END_AT",
       coalesce(next_op = 'DELETE', false) AS "__IS_DELETED"
FROM (SELECT *, lead(ingested_at) OVER w AS next_at, lead(operation) OVER w AS next_op
      FROM (SELECT *, row_number() OVER (PARTITION BY {key}, ingested_at ORDER BY operation, record_id DESC NULLS LAST) AS rn FROM feed)
      WHERE rn = 1 WINDOW w AS (PARTITION BY {key} ORDER BY ingested_at)) WHERE operation = 'INSERT'"""


# ---- table graph ------------------------------------------------------------

for _table, _cte in [
    ("bronze_typed_health_samples", "samples"),
    ("bronze_typed_workouts", "workouts"),
    ("bronze_typed_sleep_stages", "stages"),
    ("bronze_typed_activity_summaries", "rings"),
    ("bronze_typed_deletes", "deletes"),
]:
    ORACLE[_table] = with_(_cte) + f"SELECT * FROM {_cte}"

for _name, _table in [("health_samples", "samples"), ("workouts", "workouts"), ("sleep_stages", "stages")]:
    _head = with_(_table, "deletes", feed=feed(_table))
    ORACLE[f"cdc_{_name}"] = _head + "SELECT * FROM feed"
    ORACLE[f"silver_{_name}"] = _head + current(_table)
    ORACLE[f"silver_{_name}_history"] = _head + history(_table)

_workout_history = with_("workouts", "deletes", feed=feed("workouts"), history=history("workouts"))
ORACLE["history_hot_keys"] = _workout_history + "SELECT * FROM history"
ORACLE["history_as_of"] = (
    _workout_history + """SELECT * FROM history WHERE "__START_AT" <= TIMESTAMP '2024-01-15 12:00:00'
AND ("__END_AT" IS NULL OR "__END_AT" > TIMESTAMP '2024-01-15 12:00:00')"""
)
ORACLE["history_current_state"] = with_("workouts", "deletes", feed=feed("workouts")) + current("workouts", "metadata")
ORACLE["silver_activity_summaries"] = with_("rings") + "SELECT * EXCLUDE (record_id) FROM rings"
ORACLE["silver_activity_summaries_dedup"] = (
    with_("rings")
    + """SELECT * EXCLUDE (record_id, rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, activity_date
ORDER BY ingested_at DESC, record_id DESC) AS rn FROM rings) WHERE rn = 1"""
)
ORACLE["known_uuids"] = with_("ids") + "SELECT uuid FROM ids"

GOLD = """SELECT user_id, source_platform, session_start_ts, session_end_ts, sleep_date,
  round(sum(CASE WHEN stage = 'asleepDeep' THEN stage_duration_minutes END), 6) AS deep_sleep_minutes,
  round(sum(CASE WHEN stage = 'asleepREM' THEN stage_duration_minutes END), 6) AS rem_sleep_minutes,
  round(sum(CASE WHEN stage = 'asleepCore' THEN stage_duration_minutes END), 6) AS core_sleep_minutes,
  round(sum(CASE WHEN stage = 'awake' THEN stage_duration_minutes END), 6) AS awake_minutes,
  round(sum(stage_duration_minutes), 6) AS total_tracked_minutes,
  count(*) AS stage_count,
  count(*) FILTER (WHERE stage = 'asleepDeep') AS deep_stage_count,
  count(*) FILTER (WHERE stage = 'asleepREM') AS rem_stage_count,
  count(*) FILTER (WHERE stage = 'asleepCore') AS core_stage_count,
  count(*) FILTER (WHERE stage = 'awake') AS awake_stage_count,
  round(date_diff('second', session_start_ts, session_end_ts) / 60.0, 6) AS session_duration_minutes,
  round(coalesce(sum(CASE WHEN stage IN ('asleepDeep', 'asleepREM', 'asleepCore') THEN stage_duration_minutes END), 0), 6) AS total_sleep_minutes,
  CASE WHEN session_end_ts > session_start_ts THEN
    round(coalesce(sum(CASE WHEN stage IN ('asleepDeep', 'asleepREM', 'asleepCore') THEN stage_duration_minutes END), 0)
          / (date_diff('second', session_start_ts, session_end_ts) / 60.0), 6) END AS sleep_efficiency
FROM {source} GROUP BY user_id, source_platform, session_start_ts, session_end_ts, sleep_date"""
_stage_state = with_("stages", "deletes", feed=feed("stages"), silver=current("stages"))
ORACLE["gold_sleep_sessions"] = _stage_state + GOLD.format(source="silver")
ORACLE["stored_gold_view"] = (
    with_("stages", "deletes", feed=feed("stages"), silver=current("stages"), gold=GOLD.format(source="silver"))
    + """SELECT sleep_date, count(*) AS sessions, round(sum(total_sleep_minutes), 6) AS total_sleep_minutes
FROM gold GROUP BY sleep_date"""
)
ORACLE["stored_typed_samples"] = (
    with_("samples")
    + "SELECT record_id, user_id, sample_type, value, sample_date, metadata FROM samples"
)
ORACLE["quarantine_unmatched_deletes"] = (
    with_("targets", "ids")
    + """SELECT *, 'no matching uuid in target' AS reason FROM targets t
WHERE NOT EXISTS (SELECT 1 FROM ids WHERE ids.uuid = t.deleted_uuid)"""
)
ORACLE["delete_match_report"] = (
    with_("targets", "samples", "workouts", "stages")
    + """, present AS (SELECT DISTINCT 'silver_health_samples' AS target_table, uuid FROM samples
  UNION SELECT 'silver_workouts', uuid FROM workouts UNION SELECT 'silver_sleep_stages', stage_uuid FROM stages)
SELECT t.target_table, count(*) AS delete_events, count(DISTINCT deleted_uuid) AS distinct_uuids,
  count(DISTINCT p.uuid) AS matched_uuids,
  round(count(DISTINCT p.uuid) * 100.0 / count(DISTINCT deleted_uuid), 6) AS matched_pct
FROM targets t LEFT JOIN present p ON p.target_table = t.target_table AND p.uuid = t.deleted_uuid
GROUP BY t.target_table"""
)
ORACLE["delete_targets"] = with_("targets") + "SELECT record_id, target_table FROM targets"
SLEEP_SESSIONS = """SELECT record_id, ts AS ingested_at, user_id, source_platform, session_start_ts AS start_ts,
  session_end_ts AS end_ts, 420.0::DOUBLE AS total_duration_minutes,
  sum(CASE WHEN s.stage = 'asleepDeep' THEN round((s.e - s.b) / 60.0, 6) END) AS deep_sleep_minutes,
  sum(CASE WHEN s.stage = 'asleepREM' THEN round((s.e - s.b) / 60.0, 6) END) AS rem_sleep_minutes,
  sum(CASE WHEN s.stage = 'asleepCore' THEN round((s.e - s.b) / 60.0, 6) END) AS core_sleep_minutes,
  sum(CASE WHEN s.stage = 'awake' THEN round((s.e - s.b) / 60.0, 6) END) AS awake_minutes,
  string_agg(s.stage, '>' ORDER BY s.i) AS stages,
  CAST(CAST(session_start_ts AS DATE) AS VARCHAR) AS sleep_date, CAST(count(*) AS INTEGER) AS num_stages
FROM nights WHERE s.i < 5 OR k % 10 = 0 GROUP BY ALL"""
ORACLE["typed_sleep_sessions"] = with_("nights") + SLEEP_SESSIONS
ORACLE["stand_hour_deletes"] = (
    with_("samples", "deletes")
    + """SELECT uuid, ingested_at, 'INSERT' AS operation, sample_type FROM samples
UNION ALL SELECT deleted_uuid, ingested_at, 'DELETE', NULL FROM deletes
WHERE sample_type LIKE 'HKQuantityType%' OR CAST(record_id AS BIGINT) % 4 = 0"""
)

# ---- quality ----------------------------------------------------------------


def report(table: str, rows: str, head: str) -> str:
    cfg = load_table_config(table)
    rules = [("drop", n, r) for n, r in get_expectations_drop(cfg, AS_OF).items()]
    rules += [("warn", n, r) for n, r in get_expectations_warn(cfg, AS_OF).items()]
    parts = []
    for action, name, rule in rules:
        rule = rule.replace(f"DATE '{AS_OF[:10]}'", f"'{AS_OF[:10]}'")  # dates are text here
        rule = rule.replace("deleted_uuid RLIKE '^[0-9A-Fa-f-]{36}$'", "regexp_matches(deleted_uuid, '^[0-9A-Fa-f-]{36}$')")
        parts.append(
            f"SELECT '{table}' AS table_name, '{action}' AS action, '{name}' AS rule, count(*) AS total_rows, "
            f"count(*) FILTER (WHERE NOT coalesce(({rule}), false)) AS violations FROM {rows}"
        )
    return head + "\nUNION ALL ".join(parts)


for _name, _table, _cte in [
    ("expectation_report_samples", "bronze_typed_health_samples", "samples"),
    ("expectation_report_workouts", "bronze_typed_workouts", "workouts"),
    ("expectation_report_sleep_stages", "bronze_typed_sleep_stages", "stages"),
    ("expectation_report_activity", "bronze_typed_activity_summaries", "rings"),
    ("expectation_report_deletes", "bronze_typed_deletes", "deletes"),
]:
    ORACLE[_name] = report(_table, _cte, with_(_cte))
ORACLE["expectation_report_sleep_sessions"] = report(
    "sleep_sessions", "sessions", with_("nights", sessions=SLEEP_SESSIONS)
)
ORACLE["expect_or_drop"] = (
    with_("workouts")
    + "SELECT record_id, uuid, duration_seconds FROM workouts WHERE duration_seconds > 3600 AND total_distance_meters > 0"
)


def _pk(table: str, key: str, rows: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{table}_pk' AS constraint_name, 'primary' AS kind, count(*) AS violations "
        f"FROM (SELECT 1 FROM {rows} GROUP BY {key} HAVING count(*) > 1)"
    )


def _fk(table: str, rows: str) -> str:
    return (
        f"SELECT '{table}', '{table}_bronze_fk', 'foreign', count(*) FROM {rows} r "
        "WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.record_id = r.record_id)"
    )


ORACLE["key_check"] = with_(
    "samples", "workouts", "stages", "rings", "deletes", feed=feed("workouts"), silver=current("workouts")
) + "\nUNION ALL ".join(
    [
        _pk("bronze_typed_health_samples", "record_id", "samples"),
        _fk("bronze_typed_health_samples", "samples"),
        _pk("bronze_typed_workouts", "record_id", "workouts"),
        _fk("bronze_typed_workouts", "workouts"),
        _pk("bronze_typed_sleep_stages", "stage_uuid", "stages"),
        _pk("bronze_typed_activity_summaries", "record_id", "rings"),
        _fk("bronze_typed_activity_summaries", "rings"),
        _pk("bronze_typed_deletes", "record_id", "deletes"),
        _fk("bronze_typed_deletes", "deletes"),
        _pk("silver_workouts", "uuid", "silver"),
        _pk("silver_activity_summaries", "user_id, activity_date", "rings"),
    ]
)
ORACLE["duplicate_keys"] = (
    with_("stages") + "SELECT stage_uuid, count(*) AS row_count FROM stages GROUP BY stage_uuid HAVING count(*) > 1"
)
ORACLE["orphan_rows_hot_keys"] = (
    with_("samples", "workouts")
    + """, w AS (SELECT record_id, CASE WHEN CAST(record_id AS BIGINT) % 3 = 0 THEN 'hot' ELSE uuid END AS uuid FROM workouts)
SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM samples s WHERE s.uuid = w.uuid)"""
)
ORACLE["orphan_rows"] = (
    with_("samples", "workouts")
    + "SELECT record_id, uuid FROM workouts w WHERE NOT EXISTS (SELECT 1 FROM samples s WHERE s.uuid = w.uuid)"
)
ORACLE["validate_ingest"] = (
    BASE
    + """, matched AS (SELECT * FROM base WHERE k <> 50)
SELECT check_name, violations, violations = 0 AS passed FROM (
  SELECT 'all_ids_present' AS check_name, (SELECT count(*) FROM base WHERE k = 50) AS violations
  UNION ALL SELECT 'single_platform', count(*) FILTER (WHERE coalesce(source_platform, '') <> 'apple_healthkit') FROM matched
  UNION ALL SELECT 'no_secret_headers', 0
  UNION ALL SELECT 'sample_keys', 0
  UNION ALL SELECT 'all_types', 5 - count(DISTINCT record_type) FROM matched
  UNION ALL SELECT 'single_user', count(*) FILTER (WHERE user_id <> '1') FROM matched)"""
)

# ---- ingest -----------------------------------------------------------------

QUANTITY = (
    "['HKQuantityTypeIdentifierHeartRate', 'HKQuantityTypeIdentifierStepCount', "
    "'HKQuantityTypeIdentifierOxygenSaturation', 'HKQuantityTypeIdentifierActiveEnergyBurned']"
)
# One row per good payload line of an event: number, kind and text.
CTES["lines"] = f"""
SELECT *, CASE record_type WHEN 'samples' THEN {QUANTITY}[(k + i) % 4 + 1]
     WHEN 'workouts' THEN ['running', 'walking', 'cycling'][(k + i) % 3 + 1]
     WHEN 'deletes' THEN ['HKWorkoutTypeIdentifier', 'HKQuantityTypeIdentifierStepCount'][(k + i) % 4 % 2 + 1] END AS line_kind,
  CASE record_type WHEN 'samples' THEN '{{"type":"' || line_kind || '","value":' || (k + i) || '}}'
     WHEN 'workouts' THEN '{{"activity_type":"' || line_kind || '"}}'
     WHEN 'deletes' THEN '{{"sample_type":"' || line_kind || '"}}'
     ELSE '{{"other":' || (k + i) || '}}' END AS line
FROM (SELECT *, CAST(unnest(range(0, k % 3 + 1)) AS INTEGER) AS i FROM base)"""
USES["lines"] = ["base"]
UUID = (
    "upper(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || "
    "substr({h}, 17, 4) || '-' || substr({h}, 21, 12))"
)


def uuid(*parts: str) -> str:
    joined = " || chr(31) || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return UUID.format(h=f"md5({joined})")


HEADER_TYPE = "CASE WHEN k % 17 = 0 THEN '' WHEN k % 11 = 0 THEN 'custom' ELSE record_type END"
USER = """CASE WHEN k % 2 = 0 THEN 'sub-' || user_id WHEN k % 3 = 0 THEN user_id || '@example.org' ELSE 'anonymous' END"""
PLATFORM = "['apple_healthkit', 'android_health_connect', 'garmin_connect', 'unknown'][CAST(event_id % 4 AS INTEGER) + 1]"

ORACLE["parse_ndjson_records"] = (
    with_("lines")
    + """SELECT event_id AS request_id, i + 1 AS line_no, CASE WHEN record_type = 'samples' THEN line_kind END AS type
FROM lines"""
)
ORACLE["parse_ndjson_errors"] = (
    BASE
    + """SELECT event_id AS request_id, 'Line ' || (k % 3 + 2) || ': invalid JSON' AS error FROM base WHERE k % 13 = 0"""
)
ORACLE["build_bronze"] = (
    with_("lines")
    + f"""SELECT {uuid('event_id', 'i + 1')} AS record_id, ts AS ingested_at, {HEADER_TYPE} AS record_type,
  {PLATFORM} AS source_platform, {USER} AS user_id,
  'x-device-id,x-forwarded-email,x-platform,x-record-type' AS header_names, line AS body,
  '{{"x-device-id":"device-' || user_id || '","x-forwarded-email":"' || CASE WHEN k % 3 = 0 THEN user_id || '@example.org' ELSE '' END
  || '","x-platform":"' || ['APPLE_HEALTHKIT', 'ANDROID_HEALTH_CONNECT', 'GARMIN_CONNECT', ''][CAST(event_id % 4 AS INTEGER) + 1]
  || '","x-record-type":"' || CASE WHEN k % 11 = 0 THEN 'Custom' ELSE ' ' || upper(record_type) END || '"}}' AS headers
FROM lines WHERE k % 17 <> 0"""
)
ORACLE["build_bronze_errors"] = (
    BASE
    + f"""SELECT event_id AS request_id, {HEADER_TYPE} AS record_type, 'Line ' || (k % 3 + 2) || ': invalid JSON' AS error
FROM base WHERE k % 13 = 0 AND k % 17 <> 0"""
)
ORACLE["normalize_record_type"] = (
    BASE
    + f"""SELECT event_id AS request_id, {HEADER_TYPE} AS record_type, k % 11 <> 0 AS known_type
FROM base WHERE k % 17 <> 0"""
)
ORACLE["resolve_user"] = BASE + f"SELECT event_id AS request_id, {USER} AS user_id, {PLATFORM} AS platform FROM base"
ORACLE["platform_fallback"] = BASE + "SELECT record_id, plat AS source_platform FROM base"
ORACLE["null_user_filled"] = (
    BASE + "SELECT record_id, CASE WHEN event_id % 6 <> 0 THEN user_id ELSE 'unknown' END AS user_id FROM base"
)
ORACLE["null_user_dropped"] = BASE + "SELECT record_id, user_id FROM base WHERE event_id % 6 <> 0"
ORACLE["ingest_staging"] = (
    BASE
    + """SELECT '{"active_energy_burned_goal_kcal":' || [400, 500, 600][k % 3 + 1] || ',"active_energy_burned_kcal":'
  || regexp_replace(CAST(value * 2 AS VARCHAR), '[.]0$', '') || ',"date":"' || CAST(ts AS DATE) || '","exercise_minutes":' || k
  || '.7,"exercise_minutes_goal":' || CASE WHEN k = 0 THEN 0 ELSE 30 END || ',"stand_hours":' || k % 25
  || ',"stand_hours_goal":12}' AS body,
  '{"content-type":"application/x-ndjson","x-platform":"' || plat || '","x-record-type":"activity_summaries"}' AS headers,
  record_id, ts AS ingested_at, record_type, CAST(NULL AS VARCHAR) AS source_platform,
  CAST(NULL AS VARCHAR) AS user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date FROM base WHERE event_type = 'signup'"""
)
ORACLE["to_ndjson"] = (
    BASE
    + """SELECT '{' || CASE WHEN k % 2 = 0 THEN '"count":' || k || ',' ELSE '' END || '"id":' || event_id ||
  ',"inner":{"a":"' || event_type || '","b":' || k || '},"zone":"' || user_id || '"}' AS value FROM base"""
)
HRV_STATUS = "['BALANCED', 'unbalanced', 'Low', 'POOR'][k % 5 + 1]"
HRV_SCORE = "[2.0, 1.0, 0.0, -1.0][k % 5 + 1]"
ORACLE["events_as_json"] = (
    BASE
    + f"""SELECT '{{"source":"garmin_connect","device_id":"watch-' || user_id || '","metric_type":"hrv_status","value":' ||
  CAST(CAST({HRV_SCORE} AS DOUBLE) AS VARCHAR) || ',"unit":"score","recorded_at":"' || strftime(CAST(ts AS DATE), '%Y-%m-%d') ||
  'T00:00:00Z","ingested_at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z","metadata":{{"status_label":"' ||
  {HRV_STATUS} || '"}}}}' AS value FROM base WHERE k % 5 <> 4"""
)
CTES["readings"] = """
SELECT record_id, ts AS ingested_at, r.metric_type AS metric_type, CAST(r.v AS DOUBLE) AS value, r.unit AS unit,
       t0 + to_minutes(r.m) AS recorded_at, 'garmin_' || user_id AS device_id, 'garmin_connect_iq' AS source
FROM (SELECT *, unnest([
  {'metric_type': 'heart_rate_intraday', 'v': CASE WHEN k % 9 <> 0 THEN 50 + k END, 'unit': 'bpm', 'm': 0},
  {'metric_type': 'stress_level', 'v': CASE WHEN k % 4 = 0 THEN 127 ELSE k END, 'unit': 'score', 'm': 1},
  {'metric_type': 'spo2', 'v': 90 + k % 10, 'unit': 'pct', 'm': 2}]) AS r FROM base)"""
USES["readings"] = ["base"]
ORACLE["watch_records"] = with_("readings") + "SELECT * FROM readings"
ORACLE["incremental_readings"] = (
    with_("readings")
    + """SELECT * FROM readings WHERE recorded_at > TIMESTAMP '2024-01-10 00:00:00' AND value IS NOT NULL
  AND NOT (metric_type = 'stress_level' AND value = 127)"""
)
ORACLE["incremental_readings_newest"] = (
    with_("readings")
    + """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY device_id, metric_type
  ORDER BY recorded_at DESC, record_id DESC) AS rn FROM readings WHERE recorded_at > TIMESTAMP '2024-01-02')
WHERE rn <= 60 AND value IS NOT NULL AND NOT (metric_type = 'stress_level' AND value = 127)"""
)
ORACLE["refused_payloads"] = (
    BASE
    + """SELECT event_id AS request_id, 'Too many NDJSON lines (' || (k % 3 + 1 + CASE WHEN k % 13 = 0 THEN 1 ELSE 0 END) ||
  '). Maximum allowed is 2.' AS error, CAST(0 AS BIGINT) AS n_records FROM base
WHERE k % 3 + 1 + CASE WHEN k % 13 = 0 THEN 1 ELSE 0 END > 2"""
)

# ---- bronze and telemetry reports -------------------------------------------

ORACLE["count_platform"] = BASE + "SELECT count(*) AS total_rows FROM base WHERE plat = 'garmin_connect'"
ORACLE["record_type_summary"] = (
    BASE
    + "SELECT record_type, count(*) AS cnt, min(ts) AS earliest, max(ts) AS latest FROM base GROUP BY record_type"
)
ORACLE["source_matrix"] = BASE + "SELECT plat AS platform, record_type, count(*) AS cnt FROM base GROUP BY ALL"
CATEGORY = {
    "daily_stats": "k % 11 <> 0",
    "heart_rates": "true",
    "sleep": "true",
    "stress": "k % 6 <> 0",
    "hrv": "true",
    "spo2": "true",
    "body_battery": "true",
    "steps": "k % 2 = 0",
    "respiration": "true",
    "activities": "value > 5",
}
_pulls = " UNION ALL ".join(f"SELECT *, '{c}' AS category FROM base WHERE {cond}" for c, cond in CATEGORY.items())
ORACLE["record_type_coverage"] = (
    with_("base", pulls=_pulls)
    + """SELECT category AS record_type, count(*) AS cnt, min(CAST(CAST(ts AS DATE) AS VARCHAR)) AS earliest_date,
  max(CAST(CAST(ts AS DATE) AS VARCHAR)) AS latest_date FROM pulls GROUP BY category"""
)
ORACLE["garmin_to_bronze"] = (
    with_("base", pulls=_pulls)
    + f"""SELECT {uuid('event_id', 'category')} AS record_id, ts AS ingested_at, category AS record_type,
  'garmin_connect' AS source, 'watch-' || user_id AS device_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
  category AS header_type FROM pulls"""
)
ORACLE["sample_rows"] = (
    with_("base", pulls=_pulls)
    + f"""SELECT {uuid('event_id', 'category')} AS record_id, category AS record_type, 'garmin_connect' AS source,
  CAST(CAST(ts AS DATE) AS VARCHAR) AS data_date FROM pulls ORDER BY record_id LIMIT 5"""
)
_since = "CAST(ts AS DATE) >= DATE '2024-01-05'"
ORACLE["metric_catalog"] = (
    BASE
    + f"""SELECT 'http.' || event_type AS metric_name, ['gauge', 'sum', 'histogram'][k % 3 + 1] AS metric_type,
  ['ms', '1'][k % 2 + 1] AS unit, CASE WHEN k % 2 = 0 THEN 'about ' || event_type END AS description, count(*) AS row_count
FROM base WHERE {_since} GROUP BY ALL"""
)
ORACLE["log_summary"] = (
    BASE
    + f"""SELECT ['DEBUG', 'INFO', 'WARN', 'ERROR'][k % 4 + 1] AS severity_text,
  CASE WHEN k % 3 <> 0 THEN event_type END AS event_name, count(*) AS row_count FROM base WHERE {_since} GROUP BY ALL"""
)
ORACLE["span_summary"] = (
    BASE
    + f"""SELECT 'GET /' || event_type AS span_name, ['SERVER', 'CLIENT'][k % 2 + 1] AS kind,
  ['OK', 'ERROR', 'UNSET'][k % 3 + 1] AS status_code, count(*) AS row_count FROM base WHERE {_since} GROUP BY ALL"""
)
ORACLE["table_overview"] = BASE + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST(min(CAST(ts AS DATE)) AS VARCHAR) AS min_date, "
    f"CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS max_date FROM base WHERE {_since}"
    for t in ["metrics", "logs", "traces"]
)
ORACLE["search_logs"] = (
    BASE
    + """SELECT ts AS time, '{"msg":"run signup ' || k || '"}' AS body_text FROM base WHERE event_type = 'signup'
ORDER BY ts DESC, body_text LIMIT 5"""
)

# ---- sync ledger ------------------------------------------------------------

ORACLE["sync_totals"] = (
    BASE
    + """SELECT record_type, CAST(sum(k % 3 + 1) AS BIGINT) AS total_records, max(ts) AS last_sync
FROM base GROUP BY record_type"""
)
CTES["breakdown"] = """
SELECT record_type, line_kind AS kind, count(*) AS count FROM lines WHERE line_kind IS NOT NULL GROUP BY ALL
UNION ALL SELECT record_type, CASE record_type WHEN 'sleep' THEN 'sessions' ELSE 'days' END, CAST(sum(k % 3 + 1) AS BIGINT)
FROM base WHERE record_type IN ('sleep', 'activity_summaries') GROUP BY record_type"""
USES["breakdown"] = ["lines"]
ORACLE["sync_breakdown"] = with_("breakdown") + "SELECT * FROM breakdown"
ORACLE["breakdown_labels"] = (
    with_("breakdown")
    + """SELECT CASE kind WHEN 'HKQuantityTypeIdentifierHeartRate' THEN 'Heart Rate'
  WHEN 'HKQuantityTypeIdentifierStepCount' THEN 'Step Count'
  WHEN 'HKQuantityTypeIdentifierOxygenSaturation' THEN 'Oxygen Saturation'
  ELSE 'Active Energy Burned' END AS label, count FROM breakdown WHERE record_type = 'samples'"""
)
ORACLE["category_overview"] = (
    BASE
    + """SELECT c.position, c.record_type, c.display_name, coalesce(CAST(sum(b.k % 3 + 1) AS BIGINT), 0) AS total_records,
  max(b.ts) AS last_sync
FROM (VALUES (0, 'samples', 'Health Samples'), (1, 'workouts', 'Workouts'), (2, 'sleep', 'Sleep Sessions'),
  (3, 'activity_summaries', 'Activity Summaries'), (4, 'deletes', 'Deletions')) c(position, record_type, display_name)
LEFT JOIN base b ON b.record_type = c.record_type GROUP BY ALL"""
)
ORACLE["last_payload"] = (
    with_("lines")
    + """SELECT event_id AS id, record_type, ts AS timestamp, k % 3 + 1 AS record_count,
  CASE WHEN k % 5 = 0 THEN '  ' || chr(10) ELSE '' END || string_agg(line, chr(10) ORDER BY i)
  || CASE WHEN k % 13 = 0 THEN chr(10) || 'not json' ELSE '' END AS ndjson_payload
FROM lines WHERE event_id IN (SELECT arg_max(event_id, ts) FROM base GROUP BY record_type) GROUP BY event_id, record_type, ts, k"""
)
ORACLE["recent_events"] = (
    BASE
    + """SELECT event_id AS id, record_type, ts AS timestamp, k % 3 + 1 AS record_count, 200 AS http_status_code,
  true AS success FROM base ORDER BY ts DESC, event_id DESC LIMIT 20"""
)

# ---- sessions and days ------------------------------------------------------

CTES["sessions"] = """
SELECT *, CAST(sum(opens) OVER (PARTITION BY user_id ORDER BY start_ts, end_ts, uuid) AS BIGINT) AS session_no FROM (
  SELECT *, CASE WHEN prev_end IS NULL OR start_ts - prev_end > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS opens FROM (
    SELECT user_id, record_id AS uuid, k % 7 AS stage_code, ts AS start_ts, ts + to_minutes(k) AS end_ts,
      lag(ts + to_minutes(k)) OVER (PARTITION BY user_id ORDER BY ts, ts + to_minutes(k), record_id) AS prev_end FROM base))"""
USES["sessions"] = ["base"]
ORACLE["sessionize"] = (
    with_("sessions")
    + """SELECT user_id, session_no, min(start_ts) AS session_start_ts, max(end_ts) AS session_end_ts,
  count(*) AS stage_count FROM sessions GROUP BY user_id, session_no"""
)
ORACLE["label_sessions"] = (
    with_("sessions")
    + """SELECT user_id, uuid, stage_code, start_ts, end_ts, session_no,
  row_number() OVER (PARTITION BY user_id, session_no ORDER BY start_ts, end_ts, uuid) AS stage_no,
  min(start_ts) OVER (PARTITION BY user_id, session_no) AS session_start_ts,
  ['inBed', 'asleepUnspecified', 'awake', 'asleepCore', 'asleepDeep', 'asleepREM', 'unknown_6'][stage_code + 1] AS stage
FROM sessions"""
)
ANDROID_TYPE = (
    "['StepsRecord', 'DistanceRecord', 'ActiveCaloriesBurnedRecord', 'BasalMetabolicRateRecord', 'HeartRateRecord', "
    "'RestingHeartRateRecord', 'HeartRateVariabilityRmssdRecord', 'OxygenSaturationRecord', 'Vo2MaxRecord'][k % 10 + 1]"
)
ANDROID_UNIT = "['steps', 'meters', 'kcal', 'kcal_per_day', 'bpm', 'bpm', 'milliseconds', 'percent', 'mL/kg/min'][k % 10 + 1]"
_android_tail = """source_bundle_id, '+01:00' AS start_zone_offset, '+01:00' AS end_zone_offset, t0 AS last_modified_ts"""
CTES["android"] = f"""
SELECT record_id, ts AS ingested_at, user_id, 'android_health_connect' AS source_platform, 'A' || event_id AS uuid,
  {ANDROID_TYPE} AS sample_type, value, {ANDROID_UNIT} AS unit, t0 - to_minutes(k + 1) AS start_ts,
  t0 - to_minutes(k + 1) + to_minutes(k % 5) AS end_ts, 'com.example.app' AS {_android_tail}
FROM base WHERE event_type = 'view' AND k % 10 NOT IN (4, 9)
UNION ALL
SELECT record_id, ts, user_id, 'android_health_connect', 'A' || event_id || '-' || i, 'HeartRateRecord', 60.0 + k + i, 'bpm',
  t0 - to_minutes(k + 1) + to_seconds(30 * i), t0 - to_minutes(k + 1) + to_seconds(30 * i), 'com.example.app', '+01:00', '+01:00', t0
FROM (SELECT *, CAST(unnest(range(0, 3)) AS INTEGER) AS i FROM base) WHERE event_type = 'view' AND k % 10 = 4"""
USES["android"] = ["base"]
ORACLE["android_samples"] = with_("android") + "SELECT * FROM android"
ORACLE["daily_summary"] = (
    with_("android")
    + """, days AS (SELECT CAST(d AS DATE) AS d FROM (SELECT unnest(generate_series(TIMESTAMP '2023-12-31', TIMESTAMP '2024-02-01', INTERVAL 1 DAY)) AS d)),
local AS (SELECT *, CAST(start_ts - INTERVAL 5 HOUR AS DATE) AS d FROM android)
SELECT u.user_id, CAST(days.d AS VARCHAR) AS date, 'America/New_York' AS timezone,
  CAST(floor(coalesce(sum(value) FILTER (WHERE sample_type = 'StepsRecord'), 0) + 1e-9) AS BIGINT) AS total_steps,
  round(coalesce(sum(value) FILTER (WHERE sample_type = 'ActiveCaloriesBurnedRecord'), 0), 6) AS active_calories_burned_kcal,
  round(coalesce(sum(value) FILTER (WHERE sample_type = 'DistanceRecord'), 0), 6) AS total_distance_meters
FROM (SELECT DISTINCT user_id FROM android) u CROSS JOIN days
LEFT JOIN local l ON l.user_id = u.user_id AND l.d = days.d GROUP BY u.user_id, days.d"""
)
ORACLE["android_workouts"] = (
    BASE
    + """SELECT record_id, ts AS ingested_at, user_id, 'android_health_connect' AS source_platform, 'A' || event_id AS uuid,
  [56, 8, 79, 83, 9999][k % 5 + 1] AS activity_type_raw, t0 - to_minutes(k + 1) AS start_ts,
  t0 - to_minutes(k + 1) + to_seconds(600 + k) AS end_ts, 'Session ' || k AS title,
  ['running', 'biking', 'walking', 'yoga', 'unknown_9999'][k % 5 + 1] AS activity_type,
  CAST(600 + k AS DOUBLE) AS duration_seconds FROM base WHERE event_type = 'click'"""
)
ORACLE["android_sleep_stages"] = (
    BASE
    + """SELECT record_id, ts AS ingested_at, user_id, 'android_health_connect' AS source_platform,
  'A' || event_id || '-' || i AS stage_uuid,
  ['unknown', 'awake', 'sleeping', 'out_of_bed', 'light', 'deep', 'rem', 'unknown_7', 'unknown_8'][(k + i) % 9 + 1] AS stage,
  t0 - to_minutes(480 - 120 * i) AS stage_start_ts, t0 - to_minutes(360 - 120 * i) + to_seconds(k) AS stage_end_ts,
  round((7200 + k) / 60.0, 6) AS stage_duration_minutes, t0 - to_minutes(480) AS session_start_ts, t0 AS session_end_ts,
  CAST(CAST(t0 - to_minutes(480) AS DATE) AS VARCHAR) AS sleep_date
FROM (SELECT *, CAST(unnest(range(0, 3)) AS INTEGER) AS i FROM base) WHERE event_type = 'purchase'"""
)
ORACLE["android_deletes"] = (
    BASE
    + """SELECT record_id, ts AS ingested_at, user_id, 'android_health_connect' AS source_platform,
  'A' || event_id AS deleted_uuid,
  ['StepsRecord', 'ExerciseSessionRecord', 'SleepSessionRecord', 'HydrationRecord'][k % 4 + 1] AS android_type,
  t0 AS deleted_ts,
  ['silver_health_samples', 'silver_workouts', 'silver_sleep_stages', 'unknown'][k % 4 + 1] AS target_table
FROM base WHERE event_type = 'error'"""
)

# ---- load runs and registries -----------------------------------------------

CTES["types"] = """
SELECT *, CASE WHEN duration_ms > 0 THEN CAST(floor(record_count / duration_ms * 1000 + 0.5) AS BIGINT) ELSE 0 END AS records_per_sec
FROM (SELECT user_id || '/' || CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, event_type AS record_type, count(*) AS payload_count,
        CAST(sum(k % 12) AS BIGINT) AS record_count, CAST(sum(CASE WHEN k > 9 THEN k ELSE 0 END) AS BIGINT) AS duration_ms
      FROM base GROUP BY ALL)"""
CTES["runs"] = """
SELECT *, CASE WHEN duration_ms > 0 THEN CAST(floor(total_records / duration_ms * 1000 + 0.5) AS BIGINT) ELSE 0 END AS records_per_sec
FROM (SELECT user_id || '/' || CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, user_id, min(ts) AS started_at,
        CAST(sum(k) AS BIGINT) AS duration_ms, CAST(sum(k % 12) AS BIGINT) AS total_records,
        max(CASE WHEN event_type = 'click' THEN 'Small' END) AS preset_label,
        min(CASE WHEN k > 20 THEN k % 8 END) AS pool_size_start, max(k % 16) AS pool_size_end
      FROM base GROUP BY ALL)"""
CTES["nested"] = """
SELECT run_id, string_agg(record_type || ':' || payload_count || ':' || record_count || ':' || duration_ms || ':' || records_per_sec,
  ';' ORDER BY record_type) AS type_results FROM types GROUP BY run_id"""
USES.update(types=["base"], runs=["base"], nested=["types"])
ORACLE["throughput"] = with_("types") + "SELECT * FROM types"
ORACLE["runs_with_types"] = (
    with_("runs", "nested")
    + "SELECT runs.*, coalesce(type_results, '') AS type_results FROM runs LEFT JOIN nested USING (run_id)"
)
ORACLE["list_runs"] = (
    with_("runs", "nested")
    + """SELECT p.*, coalesce(type_results, '') AS type_results
FROM (SELECT * FROM runs ORDER BY started_at DESC, run_id LIMIT 500 OFFSET 10) p LEFT JOIN nested USING (run_id)"""
)
ORACLE["list_runs_after"] = (
    with_("runs", "nested")
    + """SELECT p.*, coalesce(type_results, '') AS type_results FROM (SELECT * FROM runs WHERE started_at < TIMESTAMP '2024-01-20'
  ORDER BY started_at DESC, run_id LIMIT 100) p LEFT JOIN nested USING (run_id)"""
)
ORACLE["fold_type_results"] = (
    BASE
    + """, e AS (SELECT *, user_id || '/' || (event_id % 5) AS run_id FROM base),
opened AS (SELECT run_id, unnest(['view', 'click']) AS record_type, ts, event_id, NULL AS k FROM e WHERE event_type = 'signup'
  UNION ALL SELECT run_id, event_type, ts, event_id, k FROM e WHERE event_type <> 'signup'),
r AS (SELECT run_id, record_type, min(ts) AS opened_at, arg_max(k, ts) FILTER (WHERE k IS NOT NULL) AS k FROM opened GROUP BY ALL)
SELECT run_id, record_type, opened_at, CASE WHEN k IS NULL THEN 'pending' ELSE 'done' END AS status,
  coalesce(k, 0) AS payload_count, coalesce(k * 3, 0) AS record_count, coalesce(k * 7, 0) AS duration_ms FROM r"""
)
ORACLE["run_detail"] = (
    with_("runs", "types")
    + """SELECT r.run_id, r.started_at, t.record_type, t.payload_count, t.record_count, t.duration_ms, t.records_per_sec
FROM runs r LEFT JOIN types t ON t.run_id = r.run_id WHERE r.run_id = '1/2024-01-10'"""
)
ORACLE["delete_runs"] = with_("runs") + "SELECT * FROM runs WHERE preset_label IS NOT NULL"
ORACLE["delete_runs_types"] = (
    with_("runs", "types")
    + """SELECT * FROM types WHERE run_id IN (SELECT run_id FROM runs WHERE preset_label IS NOT NULL)"""
)
ORACLE["sort_runs"] = with_("runs") + "SELECT * FROM runs ORDER BY coalesce(preset_label, ''), run_id"
ORACLE["run_labels"] = (
    with_("runs")
    + """, n AS (SELECT *, duration_ms * 977 AS n, duration_ms * 463 AS ms FROM runs)
SELECT run_id, user_id || CASE WHEN total_records % 2 = 0 THEN '@' ELSE '' END AS short_user,
  substr(sha256(user_id), 1, 12) AS pseudonym,
  CASE WHEN n >= 1000000 THEN ((n + 50000) // 1000000) || '.' || ((n + 50000) // 100000 % 10) || 'M'
       WHEN n >= 1000 THEN ((n + 50) // 1000) || '.' || ((n + 50) // 100 % 10) || 'K' ELSE CAST(n AS VARCHAR) END AS number_label,
  CASE WHEN ms < 1000 THEN ms || 'ms'
       WHEN ms < 60000 THEN ((ms + 50) // 1000) || '.' || ((ms + 50) // 100 % 10) || 's'
       ELSE (ms // 60000) || 'm ' || ((ms % 60000 + 500) // 1000) || 's' END AS duration_label FROM n"""
)
_fold = """CASE WHEN event_type = 'signup' THEN {c} END"""
ORACLE["fold_runs"] = (
    BASE
    + """, e AS (SELECT *, user_id || '/' || (event_id % 5) AS run_id, event_type = 'signup' AS created FROM base),
s AS (SELECT run_id, min(ts) AS started_at, arg_max(k, ts) AS k FROM e WHERE created GROUP BY run_id),
u AS (SELECT run_id, max(ts) AS completed_at, arg_max(k, ts) AS k FROM e WHERE NOT created GROUP BY run_id)
SELECT r.run_id, s.started_at, u.completed_at, CASE WHEN s.run_id IS NOT NULL THEN split_part(r.run_id, '/', 1) END AS user_id,
  ['Smoke', 'Small', 'Medium'][s.k % 3 + 1] AS preset_label, s.k * 10 AS batch_size, s.k * 100 AS total_payloads,
  s.k % 16 AS pool_size_start,
  coalesce(['complete', 'error', 'aborted'][u.k % 3 + 1], 'running') AS status, u.k * 7 AS duration_ms,
  CASE WHEN u.k % 3 = 0 THEN u.k * 9 END AS total_records, CASE WHEN u.k % 3 = 0 THEN u.k END AS records_per_sec,
  u.k % 12 AS pool_size_end, CASE WHEN u.k % 3 = 1 THEN 'failed ' || u.k END AS error_message
FROM (SELECT DISTINCT run_id FROM e) r LEFT JOIN s USING (run_id) LEFT JOIN u USING (run_id)"""
)
ORACLE["upsert_users"] = (
    BASE
    + """SELECT 'sub-' || user_id AS apple_sub, min(ts) AS created_at, max(ts) AS last_seen_at,
  arg_max('Name ' || k, ts) FILTER (WHERE k % 10 = 0) AS display_name FROM base GROUP BY user_id"""
)
ORACLE["upsert_devices"] = (
    BASE
    + """SELECT 'device-' || (event_id % 500) AS device_id, min(ts) AS first_seen_at, max(ts) AS last_seen_at,
  arg_max('1.' || k, ts) FILTER (WHERE k % 4 <> 0) AS app_version, arg_max(user_id, ts) AS user_id,
  arg_max(['apple_healthkit', 'android_health_connect', 'garmin_connect'][k % 3 + 1], ts) AS platform
FROM base GROUP BY event_id % 500"""
)
ORACLE["backfill_nulls"] = (
    with_("runs")
    + """, f AS (SELECT min(run_id) AS run_id FROM runs GROUP BY user_id)
SELECT r.run_id, CASE WHEN pool_size_start IS NULL AND f.run_id IS NOT NULL THEN 2 ELSE pool_size_start END AS pool_size_start,
  CASE WHEN pool_size_start IS NULL AND f.run_id IS NOT NULL THEN 4 ELSE pool_size_end END AS pool_size_end
FROM runs r LEFT JOIN f ON f.run_id = r.run_id"""
)

# ---- Garmin -----------------------------------------------------------------


def metric(name: str, value: str, unit: str, present: str = "true", at: str = "CAST(CAST(ts AS DATE) AS TIMESTAMP)", meta: str = "''") -> str:
    return (
        f"SELECT 'garmin_connect' AS source, 'watch-' || user_id AS device_id, '{name}' AS metric_type, "
        f"CAST({value} AS DOUBLE) AS value, '{unit}' AS unit, {at} AS recorded_at, ts AS ingested_at, {meta} AS metadata "
        f"FROM base WHERE {present}"
    )


def series(name: str, unit: str, pairs: list[tuple[int, str]], present: str = "true") -> list[str]:
    return [metric(name, v, unit, present, f"t0 + to_minutes({i})") for i, v in pairs]


def minutes(seconds: str) -> str:
    return f"({seconds}) / 60.0"


_stats = "k % 11 <> 0"
_meta = "'activity_id=' || event_id || ';activity_name=Run ' || k || ';activity_type=' || CASE WHEN k % 3 = 0 THEN 'unknown' ELSE 'running' END"
_when = "CASE k % 4 WHEN 0 THEN t0 WHEN 1 THEN NULL ELSE t0 + to_minutes(60) END"
GARMIN = {
    "garmin_daily_stats": [
        metric("heart_rate_resting", "50 + k % 30", "bpm", f"{_stats} AND k % 4 <> 0"),
        metric("steps_daily", "k * 100", "count", _stats),
        metric("calories_active", "k * 3", "kcal", _stats),
        metric("calories_total", "k * 3 + 1500", "kcal", _stats),
        metric("vo2_max", "40 + k % 10", "ml/kg/min", f"{_stats} AND k % 3 <> 0"),
        metric("floors_climbed", "k % 20", "count", _stats),
        metric("stress_avg", "CASE WHEN k % 7 = 0 THEN 0 ELSE k % 50 END", "score", _stats),
    ],
    "garmin_intensity_minutes": [
        metric(
            "intensity_minutes",
            "CASE WHEN k % 5 <> 0 THEN k % 40 ELSE 0 END + CASE WHEN k % 2 = 0 THEN 0 ELSE k % 15 END",
            "minutes",
            f"{_stats} AND (CASE WHEN k % 5 <> 0 THEN k % 40 ELSE 0 END > 0 OR CASE WHEN k % 2 = 0 THEN 0 ELSE k % 15 END > 0)",
            meta="'moderate=' || CASE WHEN k % 5 <> 0 THEN k % 40 ELSE 0 END || ';vigorous=' || CASE WHEN k % 2 = 0 THEN 0 ELSE k % 15 END",
        )
    ],
    "garmin_heart_rates": series("heart_rate_intraday", "bpm", [(0, "50 + k"), (5, "60 + k")]),
    "garmin_sleep": [
        metric("sleep_duration", minutes("25000 + k * 37"), "minutes"),
        metric("sleep_deep", minutes("4000 + k * 11"), "minutes"),
        metric("sleep_light", minutes("14000 + k * 13"), "minutes"),
        metric("sleep_rem", minutes("5000 + k * 7"), "minutes", "k % 6 <> 0"),
        metric("sleep_awake", minutes("k * 5"), "minutes", "k % 9 <> 0"),
        metric("spo2_avg", "90 + k % 10", "pct"),
        metric("respiration_avg", "12 + k % 5", "brpm"),
        metric("sleep_score", "60 + k % 40", "score", "k % 8 <> 0"),
    ],
    "garmin_stress": series("stress_level", "score", [(0, "50 + k"), (4, "0"), (5, "60 + k")], "k % 6 <> 0"),
    "garmin_hrv": [
        metric("hrv_weekly_avg", "30 + k", "ms", "k % 3 <> 1"),
        metric("hrv_last_night", "45 + k", "ms"),
        metric("hrv_status", HRV_SCORE, "score", "k % 5 <> 4", meta=f"'status_label=' || {HRV_STATUS}"),
    ],
    "garmin_spo2": [
        metric("spo2", "90 + k % 9", "pct", "k % 2 = 1"),
        metric("spo2", "91 + k % 8", "pct", "k % 4 = 2"),
    ],
    "garmin_respiration": [
        metric("respiration_rate", "CASE WHEN k % 3 <> 0 THEN 12 + k % 6 ELSE 11 + k % 4 END", "brpm"),
    ],
    "garmin_body_battery": [
        metric("body_battery_high", "greatest(20 + k % 70, 10 + k % 60)", "score", "k % 2 = 0"),
        metric("body_battery_low", "least(20 + k % 70, 10 + k % 60)", "score", "k % 2 = 0"),
        metric("body_battery_high", "60 + k % 40", "score", "k % 2 = 1"),
        metric("body_battery_low", "5 + k % 20", "score", "k % 2 = 1 AND k % 3 <> 0"),
    ],
    "garmin_activities": [
        metric("workout_duration", "600 + k", "seconds", "value > 5", _when, _meta),
        metric("workout_distance", "k * 50", "meters", "value > 5 AND k % 5 <> 0", _when, _meta),
        metric("workout_calories", "k * 4", "kcal", "value > 5", _when, _meta),
        metric("workout_avg_hr", "100 + k % 50", "bpm", "value > 5 AND k % 2 = 0", _when, _meta),
        metric("workout_max_hr", "120 + k % 50", "bpm", "value > 5 AND k % 2 = 0", _when, _meta),
    ],
}
for _name, _parts in GARMIN.items():
    _long = with_("base", readings="\nUNION ALL ".join(_parts))
    ORACLE[_name] = _long + "SELECT * REPLACE (round(value, 6) AS value) FROM readings"
ORACLE["garmin_normalize"] = (
    with_("base", readings="\nUNION ALL ".join(p for parts in GARMIN.values() for p in parts))
    + """SELECT metric_type, unit, count(*) AS readings, round(sum(value), 6) AS total, max(recorded_at) AS latest
FROM readings GROUP BY ALL"""
)
ORACLE["garmin_rejected_times"] = (
    with_("base", readings="\nUNION ALL ".join(GARMIN["garmin_activities"]))
    + "SELECT metric_type, count(*) AS rejected FROM readings WHERE recorded_at IS NULL GROUP BY metric_type"
)
ORACLE["garmin_daily_stats_wide"] = (
    BASE
    + f"""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CASE WHEN k % 4 <> 0 THEN 50 + k % 30 END AS resting_hr, k * 100 AS steps,
  k * 3 + 1500 AS total_calories, k * 3 AS active_calories, k % 20 AS floors,
  CASE WHEN k % 7 <> 0 THEN k % 50 END AS avg_stress, CASE WHEN k % 3 <> 0 THEN CAST(40 + k % 10 AS DOUBLE) END AS vo2_max
FROM base WHERE {_stats}"""
)
ORACLE["garmin_sleep_wide"] = (
    BASE
    + """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
  CAST(((25000 + k * 37) * 10 + 1800) // 3600 AS DOUBLE) / 10 AS sleep_hours,
  CAST((4000 + k * 11 + 30) // 60 AS DOUBLE) AS deep_min, CAST((14000 + k * 13 + 30) // 60 AS DOUBLE) AS light_min,
  CASE WHEN k % 6 <> 0 THEN CAST((5000 + k * 7 + 30) // 60 AS DOUBLE) END AS rem_min,
  CASE WHEN k % 8 <> 0 THEN 60 + k % 40 END AS sleep_score FROM base"""
)
ORACLE["garmin_hrv_wide"] = (
    BASE
    + f"""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CASE WHEN k % 3 <> 1 THEN CAST(30 + k AS DOUBLE) END AS hrv_weekly_avg_ms,
  CAST(45 + k AS DOUBLE) AS hrv_last_night_ms, CASE WHEN k % 5 <> 4 THEN {HRV_STATUS} END AS hrv_status FROM base"""
)
ORACLE["garmin_missing_days"] = (
    BASE
    + """, days AS (SELECT CAST(d AS DATE) AS d FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-02', INTERVAL 1 DAY)) AS d))
SELECT 'watch-' || u.user_id AS device_id, CAST(days.d AS VARCHAR) AS day FROM (SELECT DISTINCT user_id FROM base) u CROSS JOIN days
WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.user_id = u.user_id AND CAST(b.ts AS DATE) = days.d)"""
)
_names = {"daily_stats": "stats"}
ORACLE["garmin_category_completeness"] = BASE + " UNION ALL ".join(
    f"SELECT 'watch-' || user_id AS device_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, '{_names.get(c, c)}' AS category, "
    f"CASE WHEN bool_or({cond}) THEN 'ok' ELSE 'missing' END AS state FROM base GROUP BY user_id, CAST(ts AS DATE)"
    for c, cond in CATEGORY.items()
)

# ---- platform adapters ------------------------------------------------------

ORACLE["quantity_samples"] = with_("samples") + "SELECT record_id, sample_type, value, unit FROM samples"
ORACLE["category_samples"] = (
    with_("samples")
    + """SELECT record_id, 'HKCategoryTypeIdentifierAppleStandHour' AS sample_type,
  CAST(CAST(floor(value) AS INTEGER) % 2 AS DOUBLE) AS value, 'category' AS unit
FROM samples WHERE CAST(record_id AS BIGINT) % 3 = 0"""
)
ORACLE["type_labels"] = (
    with_("samples")
    + """SELECT record_id, CASE sample_type WHEN 'HKQuantityTypeIdentifierHeartRate' THEN 'Heart Rate'
  WHEN 'HKQuantityTypeIdentifierStepCount' THEN 'Step Count'
  WHEN 'HKQuantityTypeIdentifierOxygenSaturation' THEN 'Oxygen Saturation' ELSE 'Active Energy Burned' END AS label FROM samples"""
)


def _names_of(table: dict[int, str], code: str) -> str:
    cases = " ".join(f"WHEN {c} THEN '{n}'" for c, n in table.items())
    return f"CASE {code} {cases} ELSE 'unknown_' || ({code}) END"


def _ios_codes() -> str:
    from pulselake.functions.codes import IOS_ACTIVITIES, IOS_SLEEP_STAGES

    return (
        BASE + f"SELECT event_id, {_names_of(IOS_SLEEP_STAGES, 'k % 8')} AS stage, "
        f"{_names_of(IOS_ACTIVITIES, 'k')} AS activity FROM base"
    )


ORACLE["ios_codes"] = _ios_codes()


ORACLE["payload_summary"] = (
    with_("samples")
    + """SELECT uuid, CAST(sum(n) AS BIGINT) AS record_count,
  sum(n) || CASE WHEN sum(n) > 1 THEN ' samples (' ELSE ' sample (' END || string_agg(n || ' ' || st, ', ' ORDER BY st) || ')' AS description
FROM (SELECT uuid, replace(sample_type, 'HKQuantityTypeIdentifier', '') AS st, count(*) AS n FROM samples GROUP BY ALL)
GROUP BY uuid"""
)

# ---- streams end in the same tables as the batch queries --------------------

for _stream, _batch in {
    "stream_typed_samples": "bronze_typed_health_samples",
    "stream_typed_workouts": "bronze_typed_workouts",
    "stream_typed_sleep_stages": "bronze_typed_sleep_stages",
    "stream_typed_activity_summaries": "bronze_typed_activity_summaries",
    "stream_typed_deletes": "bronze_typed_deletes",
    "stream_cdc_sleep_stages": "cdc_sleep_stages",
    "stream_cdc_health_samples": "cdc_health_samples",
    "stream_passthrough": "silver_activity_summaries",
    "stream_scd1": "silver_health_samples",
    "stream_scd2": "silver_workouts_history",
    "stream_expectations": "expectation_report_workouts",
    "stream_sessions": "sessionize",
}.items():
    ORACLE[_stream] = ORACLE[_batch]

# ---- joins over time --------------------------------------------------------

ORACLE["point_in_time_workouts"] = (
    _workout_history
    + """SELECT b.event_id, 'U' || b.ukey AS uuid, b.ts, h.activity_type AS v_activity_type,
  h."__START_AT" AS "v___START_AT", h."__END_AT" AS "v___END_AT"
FROM base b LEFT JOIN history h ON h.uuid = 'U' || b.ukey AND h."__START_AT" <= b.ts
  AND (h."__END_AT" IS NULL OR h."__END_AT" > b.ts)"""
)
ORACLE["samples_in_workouts"] = (
    with_("samples", "workouts", "deletes")
    + ", "
    + ", ".join(f"feed_{t} AS ({feed(t)}), now_{t} AS ({current(t).replace('FROM feed', f'FROM feed_{t}')})" for t in ("samples", "workouts"))
    + """ SELECT s.user_id, s.uuid, s.sample_type, s.value, s.start_ts, w.uuid AS w_workout_uuid,
  w.activity_type AS w_activity_type, w.end_ts AS w_end_ts
FROM now_samples s JOIN now_workouts w ON s.user_id = w.user_id AND s.start_ts >= w.start_ts AND s.start_ts < w.end_ts"""
)

# ---- grouping sets, sketches, bags, layout ----------------------------------

ORACLE["ingest_cube"] = (
    BASE
    + """SELECT plat AS platform, record_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
  CAST(grouping(plat, record_type, CAST(CAST(ts AS DATE) AS VARCHAR)) AS BIGINT) AS grouping_id,
  count(*) AS cnt, min(ts) AS earliest, max(ts) AS latest
FROM base GROUP BY CUBE (plat, record_type, CAST(CAST(ts AS DATE) AS VARCHAR))"""
)
ORACLE["daily_sketches"] = (
    BASE
    + """SELECT CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS week, count(*) AS n_rows,
  count(DISTINCT user_id) AS users, true AS merged_is_whole, true AS users_close, true AS median_close
FROM base GROUP BY ALL"""
)
ORACLE["reconcile_repulled"] = (
    BASE
    + """SELECT side, record_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n_rows FROM (
  SELECT *, CASE WHEN event_id % 5 = 0 THEN 'stored' ELSE 'both' END AS side FROM base
  UNION ALL SELECT *, 'pulled' FROM base WHERE event_id % 5 <> 0 AND event_id % 7 = 0) GROUP BY ALL"""
)
ORACLE["clustered_tables"] = (
    with_("samples", "workouts", "deletes")
    + ", "
    + ", ".join(f"feed_{t} AS ({feed(t)}), now_{t} AS ({current(t).replace('FROM feed', f'FROM feed_{t}')})" for t in ("samples", "workouts"))
    + ", counts AS ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{column}' AS \"column\", CAST({column} AS VARCHAR) AS value, count(*) AS n_rows FROM {table} GROUP BY 3"
        for name, table, columns in (
            ("silver_workouts", "now_workouts", ("user_id", "activity_type", "workout_date")),
            ("silver_health_samples", "now_samples", ("user_id", "sample_type", "sample_date")),
        )
        for column in columns
    )
    + """) SELECT table_name, "column", value, n_rows, true AS many_files, true AS skips_files FROM (
  SELECT *, row_number() OVER (PARTITION BY table_name, "column" ORDER BY n_rows DESC, value) AS rn FROM counts) WHERE rn = 1"""
)

# ---- keyed state and event time on streams ----------------------------------

ORACLE["stream_scd1_state"] = ORACLE["silver_health_samples"]
ORACLE["stream_scd2_buckets"] = ORACLE["silver_workouts_history"]
ORACLE["stream_ingest_once"] = ORACLE["bronze_typed_workouts"]
# Rows by arrival: what is held back comes after a watermark one hour behind the second slice.
CTES["arrived"] = """
SELECT *, event_id % 20 = 0 AND ts < (SELECT max(ts) FILTER (WHERE event_id % 20 <> 0 AND ts < TIMESTAMP '2024-01-21')
  - INTERVAL 1 HOUR FROM base) AS late FROM base"""
USES["arrived"] = ["base"]
CTES["timed"] = CTES["sessions"].replace("FROM base", "FROM arrived WHERE NOT late")
USES["timed"] = ["arrived"]
ORACLE["stream_timed_sessions"] = with_("timed") + ORACLE["sessionize"][ORACLE["sessionize"].rindex("SELECT user_id, session_no"):].replace(
    "FROM sessions", "FROM timed"
)
ORACLE["stream_late_rows"] = (
    with_("arrived") + "SELECT user_id, ts AS start_ts, ts + to_minutes(k) AS end_ts, record_id AS uuid FROM arrived WHERE late"
)
ORACLE["stream_sliding_throughput"] = (
    BASE
    + """, mark AS (SELECT max(ts) FILTER (WHERE event_id % 20 <> 0 AND ts < TIMESTAMP '2024-01-21') - INTERVAL 1 HOUR AS at FROM base),
slid AS (SELECT *, time_bucket(INTERVAL 5 MINUTE, ts) - to_minutes(CAST(unnest([0, 5]) AS INTEGER)) AS window_start FROM base)
SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, event_type AS platform, count(*) AS n_rows,
  round(sum(value), 4) AS total
FROM slid, mark WHERE event_id % 20 <> 0 OR window_start + INTERVAL 10 MINUTE > date_trunc('millisecond', mark.at) GROUP BY ALL"""
)

# ---- files and gaps of a pull -----------------------------------------------

ORACLE["garmin_backfill_gaps"] = (
    BASE
    + """, days AS (SELECT CAST(d AS DATE) AS d FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-02', INTERVAL 1 DAY)) AS d)),
pulled AS (SELECT user_id, CAST(ts AS DATE) AS d, bool_or(k % 2 = 0 OR value > 5) AS came FROM base GROUP BY ALL)
SELECT 'watch-' || u.user_id AS device_id, CAST(days.d AS VARCHAR) AS day,
  CASE WHEN p.came IS NULL THEN 'missing' ELSE 'failed' END AS state
FROM (SELECT DISTINCT user_id FROM base) u CROSS JOIN days LEFT JOIN pulled p ON p.user_id = u.user_id AND p.d = days.d
WHERE p.came IS NULL OR NOT p.came"""
)
_readings = " UNION ALL ".join(
    f"SELECT device_id, metric_type, value FROM ({ORACLE[name]})" for name in ("garmin_spo2", "garmin_hrv")
)
ORACLE["json_files"] = f"""SELECT kind AS file_kind, device_id, metric_type, count(*) AS n_rows, round(sum(value), 6) AS total
FROM ({_readings}), (VALUES ('events'), ('ndjson')) v(kind) GROUP BY ALL"""
