"""Change feeds, SCD type 1 and 2, and the upsert folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulselake.functions import codes

IS_DELETE = "operation = 'DELETE'"


# ---- change feeds -----------------------------------------------------------


def deletes_of_samples(sample_type: Column, stand_hours: bool = False) -> Column:
    """Deletes aimed at health samples.

    Stand-hour samples arrive as samples but carry a category type, so their
    deletes are left out unless ``stand_hours`` is set.
    """
    quantity = sample_type.startswith("HKQuantityType")
    return quantity | (sample_type == codes.STAND_HOUR_TYPE) if stand_hours else quantity


def deletes_of_workouts(sample_type: Column) -> Column:
    return sample_type == codes.WORKOUT_TYPE


def deletes_of_sleep(sample_type: Column) -> Column:
    return sample_type == codes.SLEEP_TYPE


def cdc_feed(inserts: DataFrame, deletes: DataFrame, key: str, aimed_here: Column) -> DataFrame:
    """Inserts and the deletes aimed at them as one feed.

    Delete rows carry the key, the arrival time and the operation; all other
    columns are NULL.
    """
    removed = deletes.where(aimed_here).select(
        F.col("deleted_uuid").alias(key), "ingested_at", F.lit("DELETE").alias("operation")
    )
    return inserts.withColumn("operation", F.lit("INSERT")).unionByName(removed, allowMissingColumns=True)


def cdc_health_samples(samples: DataFrame, deletes: DataFrame, stand_hours: bool = False) -> DataFrame:
    return cdc_feed(samples, deletes, "uuid", deletes_of_samples(F.col("sample_type"), stand_hours))


def cdc_workouts(workouts: DataFrame, deletes: DataFrame) -> DataFrame:
    return cdc_feed(workouts, deletes, "uuid", deletes_of_workouts(F.col("sample_type")))


def cdc_sleep_stages(stages: DataFrame, deletes: DataFrame) -> DataFrame:
    return cdc_feed(stages, deletes, "stage_uuid", deletes_of_sleep(F.col("sample_type")))


# ---- SCD type 1 -------------------------------------------------------------


def change_order(sequence_by: str, delete_when: str, tie_break: str | None) -> Column:
    """Order of changes of a key: sequence, then delete after insert, then the tie column."""
    parts = [F.col(sequence_by).alias("seq"), F.expr(delete_when).alias("is_delete")]
    if tie_break:
        parts.append(F.col(tie_break).alias("tie"))
    return F.struct(*parts)


def latest_change(
    feed: DataFrame,
    keys: list[str],
    sequence_by: str = "ingested_at",
    delete_when: str = IS_DELETE,
    tie_break: str | None = "record_id",
) -> DataFrame:
    """The latest change of each key, deletes included, with a flag ``_deleted``.

    One shuffle. The latest change is kept per map task first, so copies and
    frequently changed keys shrink before they move.
    """
    payload = [c for c in feed.columns if c not in keys]
    row = F.struct(*payload, F.expr(delete_when).alias("_deleted"))
    latest = feed.groupBy(*keys).agg(F.max_by(row, change_order(sequence_by, delete_when, tie_break)).alias("_row"))
    return latest.select(*keys, "_row.*").select(*feed.columns, "_deleted")


def apply_scd1(
    feed: DataFrame,
    keys: list[str],
    sequence_by: str = "ingested_at",
    delete_when: str = IS_DELETE,
    except_cols: tuple[str, ...] = ("operation", "record_id"),
    tie_break: str | None = "record_id",
) -> DataFrame:
    """Current state: the latest row per key, without keys whose latest change is a delete."""
    latest = latest_change(feed, keys, sequence_by, delete_when, tie_break)
    return latest.where(~F.col("_deleted")).drop("_deleted", *except_cols)


# ---- SCD type 2 -------------------------------------------------------------


def apply_scd2(
    feed: DataFrame,
    keys: list[str],
    sequence_by: str = "ingested_at",
    delete_when: str = IS_DELETE,
    except_cols: tuple[str, ...] = ("operation", "record_id", "metadata"),
    tie_break: str | None = "record_id",
    chunk: str = "day",
) -> DataFrame:
    """All versions of each key with ``__START_AT``, ``__END_AT`` and ``__IS_DELETED``.

    Per key and sequence value one change counts, by the same order as in
    :func:`apply_scd1`. A version ends where the next change starts; a delete
    closes the version before it and gives no row of its own.

    Keys are worked on in chunks of time, so no task gets all changes of a key,
    nor all rows without one. Within a chunk the next change is a window; the
    last change of a chunk gets the first one of the next chunk from a summary
    of one narrow row for each key and chunk. The key is joined as a struct,
    which makes NULL keys equal and keeps the partitioning of the window.
    """
    return versions_of(chained_changes(scd2_changes(feed, keys, sequence_by, delete_when, except_cols, tie_break, chunk)))


def scd2_changes(
    feed: DataFrame,
    keys: list[str],
    sequence_by: str = "ingested_at",
    delete_when: str = IS_DELETE,
    except_cols: tuple[str, ...] = ("operation", "record_id", "metadata"),
    tie_break: str | None = "record_id",
    chunk: str = "day",
) -> DataFrame:
    """The tracked columns of a feed with the order, key and chunk of each change."""
    tie = F.col(tie_break).cast("string") if tie_break else F.lit(None).cast("string")
    return feed.select(
        *[c for c in feed.columns if c not in except_cols],
        F.col(sequence_by).alias("_seq"),
        F.expr(delete_when).alias("_deleted"),
        tie.alias("_tie"),
        F.struct(*keys).alias("_key"),
        F.date_trunc(chunk, F.col(sequence_by)).alias("_chunk"),
    )


def chained_changes(changes: DataFrame) -> DataFrame:
    """The changes that count, each with ``_next``, sequence and delete flag of the change after it."""
    order = Window.partitionBy("_key", "_chunk").orderBy(
        F.col("_seq").asc(), F.col("_deleted").desc(), F.col("_tie").desc_nulls_last()
    )
    following = F.struct(F.col("_seq").alias("seq"), F.col("_deleted").alias("deleted"))

    def winners(of: DataFrame) -> DataFrame:
        before = of.withColumn("_before", F.lag("_seq").over(order))
        return before.where(F.col("_before").isNull() | (F.col("_before") < F.col("_seq"))).drop("_before")

    narrow = changes.select("_key", "_chunk", "_seq", "_deleted", "_tie")
    firsts = winners(narrow).groupBy("_key", "_chunk").agg(F.min_by(following, "_seq").alias("_first"))
    chunks = firsts.select(
        "_key", "_chunk", F.lead("_first").over(Window.partitionBy("_key").orderBy("_chunk")).alias("_later")
    )
    placed = winners(changes).withColumn("_next", F.lead(following).over(order)).join(chunks, ["_key", "_chunk"])
    return placed.select(*changes.columns, F.coalesce("_next", "_later").alias("_next"))


def versions_of(chained: DataFrame) -> DataFrame:
    """The versions that chained changes open, with ``__START_AT``, ``__END_AT`` and ``__IS_DELETED``."""
    helpers = ("_seq", "_deleted", "_tie", "_key", "_chunk", "_next")
    return chained.where(~F.col("_deleted")).select(
        *[c for c in chained.columns if c not in helpers],
        F.col("_seq").alias("__START_AT"),
        F.col("_next.seq").alias("__END_AT"),
        F.coalesce("_next.deleted", F.lit(False)).alias("__IS_DELETED"),
    )


def as_of(history: DataFrame, ts: str | Column) -> DataFrame:
    """Versions that were valid at an instant."""
    at = F.lit(ts).cast("timestamp") if isinstance(ts, str) else ts
    return history.where(
        (F.col("__START_AT") <= at) & (F.col("__END_AT").isNull() | (F.col("__END_AT") > at))
    )


def current_state(history: DataFrame, keys: list[str]) -> DataFrame:
    """The latest version of each key of a history table, without deleted keys."""
    payload = [c for c in history.columns if c not in keys]
    latest = history.groupBy(*keys).agg(F.max_by(F.struct(*payload), "__START_AT").alias("_row"))
    return (
        latest.select(*keys, "_row.*")
        .where(~F.col("__IS_DELETED"))
        .select(*[c for c in history.columns if not c.startswith("__")])
    )


def passthrough(typed: DataFrame, dedup: list[str] | None = None) -> DataFrame:
    """Typed rows without the technical id.

    With ``dedup`` only the latest row per key is kept.
    """
    if not dedup:
        return typed.drop("record_id")
    payload = [c for c in typed.columns if c not in dedup]
    latest = typed.groupBy(*dedup).agg(
        F.max_by(F.struct(*payload), F.struct("ingested_at", "record_id")).alias("_row")
    )
    return latest.select(*dedup, "_row.*").select(*[c for c in typed.columns if c != "record_id"])


# ---- upsert folds -----------------------------------------------------------


def latest_non_null(column: str, order: Column) -> Column:
    """The newest value that is not NULL."""
    return F.max_by(column, F.when(F.col(column).isNotNull(), order))


def upsert_registry(
    events: DataFrame,
    key: str,
    ts: str,
    keep_if_missing: list[str],
    overwrite: list[str] = (),
    first: str = "first_seen_at",
    last: str = "last_seen_at",
    tie_break: str = "event_id",
) -> DataFrame:
    """Registry rows folded from sign-in events.

    ``first`` stays at the first event and ``last`` moves along. Columns in
    ``keep_if_missing`` change only when an event supplies a value; those in
    ``overwrite`` always follow the newest event.
    """
    order = F.struct(ts, tie_break)
    return events.groupBy(key).agg(
        F.min(ts).alias(first),
        F.max(ts).alias(last),
        *[latest_non_null(c, order).alias(c) for c in keep_if_missing],
        *[F.max_by(c, order).alias(c) for c in overwrite],
    )


RUN_START = ["user_id", "preset_label", "batch_size", "total_payloads", "pool_size_start"]
RUN_END = ["status", "duration_ms", "total_records", "records_per_sec", "pool_size_end", "error_message"]


def fold_runs(events: DataFrame) -> DataFrame:
    """One row per load run from its life-cycle events.

    A ``create`` event sets the start columns and the status ``running``; each
    later event replaces all end columns, so the last one wins.
    """
    is_start = F.col("event") == "create"
    order = F.struct("event_ts", "event_id")
    end = F.max_by(F.struct("event_ts", *RUN_END), F.when(~is_start, order))
    folded = events.groupBy("run_id").agg(
        F.min(F.when(is_start, F.col("event_ts"))).alias("started_at"),
        F.max_by(F.struct(*RUN_START), F.when(is_start, order)).alias("_start"),
        end.alias("_end"),
    )
    return folded.select(
        "run_id",
        "started_at",
        F.col("_end.event_ts").alias("completed_at"),
        "_start.*",
        F.coalesce("_end.status", F.lit("running")).alias("status"),
        *[F.col(f"_end.{c}").alias(c) for c in RUN_END if c != "status"],
    )


def fold_type_results(events: DataFrame, types: list[str]) -> DataFrame:
    """One row per load run and record type: the configured types at its start, then the last result of each.

    A ``create`` event opens all configured types with zeros and the status
    ``pending``. Each other event replaces the numbers of its own type, also of
    one that was not configured; the last one wins.
    """
    numbers = ["payload_count", "record_count", "duration_ms"]
    is_start = F.col("event") == "create"
    kinds = F.when(is_start, F.array(*[F.lit(t) for t in types])).otherwise(F.array("record_type"))
    rows = events.withColumn("record_type", F.explode(kinds))
    order = F.struct("event_ts", "event_id")
    latest = F.max_by(F.struct("event_ts", *numbers), F.when(~is_start, order))
    folded = rows.groupBy("run_id", "record_type").agg(F.min("event_ts").alias("opened_at"), latest.alias("_r"))
    return folded.select(
        "run_id",
        "record_type",
        "opened_at",
        F.when(F.col("_r").isNull(), "pending").otherwise("done").alias("status"),
        *[F.coalesce(F.col(f"_r.{c}"), F.lit(0)).alias(c) for c in numbers],
    )


def backfill_nulls(df: DataFrame, fixes: DataFrame, key: str, marker: str, columns: list[str]) -> DataFrame:
    """Fill ``columns`` from a small table of fixes where ``marker`` is NULL.

    Rows that already have a value stay as they are, so a second run changes
    nothing. ``fixes`` has at most one row per key; Spark broadcasts it when its
    measured size allows.
    """
    renamed = fixes.select(key, F.lit(True).alias("_has_fix"), *[F.col(c).alias(f"_fix_{c}") for c in columns])
    joined = df.join(renamed, key, "left")
    open_row = F.col(marker).isNull() & F.col("_has_fix")
    filled = {c: F.when(open_row, F.col(f"_fix_{c}")).otherwise(F.col(c)) for c in columns}
    return joined.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])
