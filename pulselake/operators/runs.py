"""Load-run history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.functions.scalars import round_half_up

TYPE_COLUMNS = ["record_type", "payload_count", "record_count", "duration_ms", "records_per_sec"]
SORT_FIELDS = {"started_at": None, "total_records": 0, "records_per_sec": 0, "duration_ms": 0, "preset_label": ""}
DEFAULT_PAGE, LARGEST_PAGE = 50, 200


def records_per_second(records: Column, millis: Column) -> Column:
    """Rounded records per second, 0 if no time passed."""
    return F.when(millis > 0, round_half_up(records / millis * 1000)).otherwise(F.lit(0)).cast("long")


def throughput(types: DataFrame) -> DataFrame:
    """Records per second per run and record type."""
    return types.withColumn("records_per_sec", records_per_second(F.col("record_count"), F.col("duration_ms")))


def runs_with_types(runs: DataFrame, types: DataFrame) -> DataFrame:
    """Each run with the array of its type results, ordered by type, empty if there are none.

    (run, type) is the key of the results, so an array has at most one entry
    per record type; repeated rows of a key are reduced to one beforehand.
    """
    one_per_type = types.groupBy("run_id", "record_type").agg(
        F.max(F.struct(*TYPE_COLUMNS[1:])).alias("r")
    )
    nested = one_per_type.groupBy("run_id").agg(
        F.sort_array(F.collect_list(F.struct("record_type", "r.*"))).alias("type_results")
    )
    joined = runs.join(nested, "run_id", "left")
    empty = F.array().cast("array<struct<record_type:string,payload_count:bigint,record_count:bigint,duration_ms:bigint,records_per_sec:bigint>>")
    return joined.withColumn("type_results", F.coalesce("type_results", empty))


def page_size(requested: int | None = None) -> int:
    """Page size of a request from outside: ``LARGEST_PAGE`` at most, ``DEFAULT_PAGE`` if none is named."""
    return min(max(requested or DEFAULT_PAGE, 1), LARGEST_PAGE)


def list_runs(runs: DataFrame, types: DataFrame, limit: int = DEFAULT_PAGE, offset: int = 0) -> DataFrame:
    """One page of runs, newest first, with their type results.

    The page has as many runs as asked for; :func:`page_size` bounds a size that
    comes from outside. A negative offset is the start. The page is cut first, so
    only its runs are joined.
    """
    page = runs.orderBy(F.desc("started_at"), "run_id").offset(max(offset, 0)).limit(max(limit, 1))
    wanted = types.join(page.select("run_id"), "run_id", "left_semi")
    return runs_with_types(page, wanted).orderBy(F.desc("started_at"), "run_id")


def run_detail(runs: DataFrame, types: DataFrame, run_id: str) -> DataFrame:
    """Type results of one run next to its columns, ordered by type."""
    one = runs.where(F.col("run_id") == run_id)
    return one.join(types.where(F.col("run_id") == run_id), "run_id", "left").orderBy("record_type")


def list_runs_after(
    runs: DataFrame, types: DataFrame, started_at: str, run_id: str, limit: int = DEFAULT_PAGE
) -> DataFrame:
    """The page after a given run, found by its place in the order instead of a count of rows before it."""
    last = F.lit(started_at).cast("timestamp")
    older = (F.col("started_at") < last) | ((F.col("started_at") == last) & (F.col("run_id") > run_id))
    return list_runs(runs.where(older), types, limit)


def delete_runs(runs: DataFrame, types: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables without the given runs; results go with their run."""
    gone = ids.select("run_id").distinct()
    return runs.join(gone, "run_id", "left_anti"), types.join(gone, "run_id", "left_anti")


def sort_runs(runs: DataFrame, by: str = "started_at", direction: str = "desc") -> DataFrame:
    """Runs by one of five columns; missing numbers sort as 0 and missing text as ''."""
    if by not in SORT_FIELDS:
        raise ValueError(f"cannot sort by {by!r}")
    key = F.col(by) if SORT_FIELDS[by] is None else F.coalesce(by, F.lit(SORT_FIELDS[by]))
    return runs.orderBy(key.asc() if direction == "asc" else key.desc(), "run_id")
