"""Tables in buckets of keys: a micro-batch rewrites the buckets of its keys and no others.

A bucket is a partition of the table by the hash of the key. Spark's dynamic
partition overwrite replaces the partitions that a batch touches; files of all
other buckets stay as they are. A batch that is repeated gives the same rows
again. Spark moves finished partitions one after the other: a driver that dies
in that moment can leave some of them missing, and such a table is built anew
from its feed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake.operators.cdc import IS_DELETE, chained_changes, scd2_changes, versions_of

BUCKETS = 64
BUCKET = "_bucket"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def read_buckets(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored rows with their bucket, None if nothing has been stored yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def rewrite_buckets(
    batch: DataFrame, path: str, keys: list[str], buckets: int, merge: Callable[[DataFrame | None, DataFrame], DataFrame]
) -> None:
    """Replace the buckets of the keys of a batch.

    ``merge`` gets the stored rows of the batch's own keys (None at first) and the
    batch, both without bucket, and returns the new rows of these keys. Rows of
    other keys in the same buckets are written back unchanged. Keys are
    compared as structs, so NULL is a key like others.
    """
    spark = batch.sparkSession
    key = F.struct(*keys)
    batch = batch.persist()
    try:
        # At most one number for each bucket.
        touched = [r[0] for r in batch.select(bucket_of(keys, buckets)).distinct().collect()]
        if not touched:
            return
        stored = read_buckets(spark, path)
        if stored is None:
            new = merge(None, batch)
        else:
            here = stored.where(F.col(BUCKET).isin(touched)).drop(BUCKET).withColumn("_of", key)
            changed = batch.select(key.alias("_of")).distinct()
            mine = here.join(changed, "_of", "left_semi").drop("_of")
            others = here.join(changed, "_of", "left_anti").drop("_of")
            new = merge(mine, batch)
            new = new.unionByName(others.select(*new.columns))
        new.withColumn(BUCKET, bucket_of(keys, buckets)).repartition(len(touched), BUCKET, *keys).write.mode(
            "overwrite"
        ).option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    finally:
        batch.unpersist()


def current_sink(path: str, keys: list[str], buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """Sink for :func:`pulselake.streaming.state.latest_changes`: one row for each key, deleted ones as tombstones."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rewrite_buckets(batch, path, keys, buckets, lambda old, new: new)

    return write


def read_current(spark: SparkSession, path: str, except_cols: tuple[str, ...] = ("operation", "record_id")) -> DataFrame:
    """Current state without deleted keys."""
    return read_buckets(spark, path).where(~F.col("_deleted")).drop("_deleted", BUCKET, *except_cols)


def history_sink(
    path: str,
    keys: list[str],
    sequence_by: str = "ingested_at",
    delete_when: str = IS_DELETE,
    except_cols: tuple[str, ...] = ("operation", "record_id", "metadata"),
    tie_break: str | None = "record_id",
    buckets: int = BUCKETS,
    chunk: str = "day",
) -> Callable[[DataFrame, int], None]:
    """Sink that keeps an SCD type 2 history of a change feed.

    Stored are the changes that count, deletes included, each with the change
    that follows it; a batch chains the changes of its own keys anew.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        changes = scd2_changes(batch, keys, sequence_by, delete_when, except_cols, tie_break, chunk)

        def merge(old: DataFrame | None, new: DataFrame) -> DataFrame:
            return chained_changes(new if old is None else new.unionByName(old.drop("_next")))

        rewrite_buckets(changes, path, ["_key"], buckets, merge)

    return write


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """All versions, in the form of :func:`pulselake.operators.cdc.apply_scd2`."""
    return versions_of(read_buckets(spark, path).drop(BUCKET))
