"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from pulselake.session import work_dir

# Rows of one Arrow batch. Texts may be long, so batches are short: a batch
# holds at most this many texts at a time in a Python worker.
ARROW_ROWS = 512

# One word of `[^\x20\x09-\x0D]+` per match.
WORD = r"[^\x20\x09-\x0D]+"


# Removes the shuffle files of a query when it ends; otherwise they stay until
# the driver happens to collect its garbage, and those of all steps add up.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of these operators; all can be changed at run time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set(CLEANUP, "true")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str, partition_by: str | None = None) -> DataFrame:
    """Write to the shared folder of the session and read back.

    Cuts the lineage, so that lost executors cost no more than the tasks they
    ran, and lets several consumers share one computation.
    """
    path = work_dir(df.sparkSession, purpose)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a :func:`stored` table that nothing reads any more."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo the divisor; NULL ids have none."""
    return F.crc32(doc_id.cast("string")) % divisor


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """Map batches to columns named in the schema, without a shuffle.

    ``fn`` gets a batch and returns arrays or lists by column name. Its
    state, if any, lives as long as one task.
    """
    target = to_arrow_schema(StructType.fromDDL(schema))
    names = target.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield pa.RecordBatch.from_arrays(
                    [_typed(out[name], target.field(name).type) for name in names], schema=target
                )

    return df.mapInArrow(run, schema)


def _typed(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8; NULL counts as empty."""
    return [value or b"" for value in batch.column(column).cast(pa.binary()).to_pylist()]
