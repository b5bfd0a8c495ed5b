"""Reading and writing the pipeline tables, batch and stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

RAW_BRONZE_DDL = (
    "record_id STRING, ingested_at TIMESTAMP, body VARIANT, headers VARIANT, "
    "record_type STRING, source_platform STRING, user_id STRING"
)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Raw bronze rows, batch."""
    return spark.read.schema(RAW_BRONZE_DDL).parquet(path)


def read_bronze_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw bronze rows as a stream of newly arriving files."""
    reader = spark.readStream.schema(RAW_BRONZE_DDL)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A pipeline table by catalog name or by folder."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def append_batch(df: DataFrame, path: str, partition_by: list[str] | None = None, sort_by: list[str] | None = None) -> None:
    """Append rows to a table folder.

    ``partition_by`` should be a coarse column (a date, the record type). With
    ``sort_by`` the rows are sorted inside each file, which gives Parquet tight
    min/max statistics and so plays the role of clustering.
    """
    if partition_by and sort_by:
        # One writer per (partition, range) instead of every task writing every
        # partition; a rebalance lets AQE split partitions that are too large.
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*(partition_by or []), *sort_by)
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_run(df: DataFrame, path: str, run: str) -> None:
    """Append the rows of one run of a job; a retry of the run replaces its own rows and no others.

    Readers see the run's name as the column ``_run``.
    """
    rows = df.withColumn("_run", F.lit(run))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_run").parquet(path)


def append_stream(
    df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, name: str | None = None
) -> StreamingQuery:
    """Append-only flow from a stream into a table folder."""
    writer = df.writeStream.outputMode("append").format("parquet")
    if name:
        writer = writer.queryName(name)
    trigger = trigger or {"availableNow": True}
    return writer.option("path", path).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def materialized_view(df: DataFrame, path: str, name: str | None = None) -> DataFrame:
    """Recompute an aggregate table in full and return it as stored.

    Without a name the folder itself is replaced. With one, the rows go to a new
    folder below it and the view of that name then points there, so readers
    of the view keep the old rows until the new ones are complete.
    """
    if name is None:
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.parquet(path)
    fresh = f"{path}/{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    return view(df.sparkSession.read.parquet(fresh), name)


def view(df: DataFrame, name: str) -> DataFrame:
    """Name a batch or stream DataFrame without storing it."""
    df.createOrReplaceTempView(name)
    return df


STAGING_COLUMNS = ["record_id", "ingested_at", "body_json", "headers_json", "record_type"]


def ingest_staging(df: DataFrame) -> DataFrame:
    """JSON text staging rows -> bronze rows.

    Columns are checked by name; the first four must hold a value, a missing
    one raises. Platform and user stay NULL, as this path has no request.
    """
    missing = [c for c in STAGING_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"staging rows lack {missing}")

    def required(name: str):
        return F.coalesce(F.col(name), F.raise_error(F.lit(f"staging row without {name}")).cast("string"))

    return df.select(
        required("record_id").alias("record_id"),
        required("ingested_at").cast("timestamp").alias("ingested_at"),
        F.parse_json(required("body_json")).alias("body"),
        F.parse_json(required("headers_json")).alias("headers"),
        "record_type",
        F.lit(None).cast("string").alias("source_platform"),
        F.lit(None).cast("string").alias("user_id"),
    )


def events_as_json(events: DataFrame) -> DataFrame:
    """Metric events as one JSON text per row: ISO instants, metadata values as text."""
    iso = "yyyy-MM-dd'T'HH:mm:ssXXX"
    return events.select(
        F.to_json(
            F.struct(
                "source",
                "device_id",
                "metric_type",
                "value",
                "unit",
                F.date_format("recorded_at", iso).alias("recorded_at"),
                F.date_format("ingested_at", iso).alias("ingested_at"),
                F.coalesce("metadata", F.create_map().cast("map<string,string>")).alias("metadata"),
            ),
            {"ignoreNullFields": "false"},
        ).alias("value")
    )


def write_events_json(events: DataFrame, path: str) -> None:
    """Metric events as JSON-lines files."""
    events_as_json(events).write.mode("overwrite").text(path)


def to_ndjson(df: DataFrame) -> DataFrame:
    """One JSON text per row with keys in alphabetical order and no null fields.

    Keys of nested structs are ordered too, by rebuilding the column type.
    """
    return df.select(F.to_json(F.struct(*_sorted_columns(df.schema, F.col))).alias("value"))


def _sorted_columns(schema, column_of):
    return [_sort_fields(column_of(f.name), f.dataType).alias(f.name) for f in sorted(schema, key=lambda f: f.name)]


def _sort_fields(column, dtype):
    kind = dtype.typeName()
    if kind == "struct":
        rebuilt = F.struct(*_sorted_columns(dtype, lambda name: column[name]))
        return F.when(column.isNotNull(), rebuilt)
    if kind == "array" and dtype.elementType.typeName() in ("struct", "array"):
        return F.transform(column, lambda x: _sort_fields(x, dtype.elementType))
    if kind == "map":
        return F.map_from_entries(F.array_sort(F.map_entries(column)))
    return column


def write_ndjson(df: DataFrame, path: str) -> None:
    to_ndjson(df).write.mode("overwrite").text(path)
