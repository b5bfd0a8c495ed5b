"""Change tables on streams: an append-only log of changes, folded when it is read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake.operators.cdc import IS_DELETE, apply_scd2, latest_change


def change_sink(
    path: str,
    keys: list[str] | None = None,
    sequence_by: str = "ingested_at",
    delete_when: str = IS_DELETE,
    tie_break: str | None = "record_id",
) -> Callable[[DataFrame, int], None]:
    """Sink that appends the changes of a micro-batch to the log.

    With ``keys`` only the latest change of each key within the batch is kept,
    which is enough for the current state; a history needs all of them. The
    work of a batch grows with the batch alone: no state is held, and folders
    of earlier batches stay as they are. A replayed batch overwrites its own
    folder; a batch counts once its number is among the finished ones.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if keys:
            batch = latest_change(batch, keys, sequence_by, delete_when, tie_break).drop("_deleted")
        else:
            _note(batch.sparkSession, f"{path}/all_changes", 0)
        batch.write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")
        _note(batch.sparkSession, f"{path}/finished/batch_id={batch_id}", batch_id)

    return write


def _note(spark: SparkSession, folder: str, number: int) -> None:
    spark.range(number, number + 1).select(F.col("id").alias("number")).coalesce(1).write.mode("overwrite").parquet(folder)


def _noted(spark: SparkSession, folder: str) -> list[int]:
    """Numbers noted in a folder, one for each micro-batch or fold; none if it does not exist yet."""
    try:
        return sorted(r.number for r in spark.read.parquet(folder).select("number").distinct().collect())
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def _stored_changes(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """Newest folded state plus the changes after it, and the last batch number."""
    bases = _noted(spark, f"{path}/folded")
    base = bases[-1] if bases else -1
    batches = [b for b in _noted(spark, f"{path}/finished") if b > base]
    parts = [f"{path}/base/upto={base}"] if bases else []
    parts += [f"{path}/changes/batch_id={b}" for b in batches]
    if not parts:
        raise ValueError(f"no changes stored in {path}")
    return spark.read.parquet(*parts), max([base, *batches])


def read_current(
    spark: SparkSession,
    path: str,
    keys: list[str],
    sequence_by: str = "ingested_at",
    delete_when: str = IS_DELETE,
    except_cols: tuple[str, ...] = ("operation", "record_id"),
    tie_break: str | None = "record_id",
) -> DataFrame:
    """Current state of the stored changes."""
    rows, _ = _stored_changes(spark, path)
    latest = latest_change(rows, keys, sequence_by, delete_when, tie_break)
    return latest.where(~F.col("_deleted")).drop("_deleted", *except_cols)


def compact(
    spark: SparkSession,
    path: str,
    keys: list[str],
    sequence_by: str = "ingested_at",
    delete_when: str = IS_DELETE,
    tie_break: str | None = "record_id",
) -> None:
    """Fold all finished changes into one state, so readers have less to fold.

    For logs of latest changes; a log of all changes is a history and is refused. The folded state keeps deletes, so a late insert
    cannot bring a key back; it counts once its number is noted, and a failed
    run leaves the readers on the older state.
    """
    if _noted(spark, f"{path}/all_changes"):
        raise ValueError(f"{path} keeps all changes, folding it would lose versions")
    rows, last = _stored_changes(spark, path)
    folded = latest_change(rows, keys, sequence_by, delete_when, tie_break).drop("_deleted")
    folded.write.mode("overwrite").parquet(f"{path}/base/upto={last}")
    _note(spark, f"{path}/folded/upto={last}", last)


def read_history(spark: SparkSession, path: str, keys: list[str], **scd2) -> DataFrame:
    """SCD type 2 history of a log of all changes; the arguments are those of the batch operator."""
    rows, _ = _stored_changes(spark, path)
    return apply_scd2(rows, keys, **scd2)
