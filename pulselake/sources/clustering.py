"""Clustered layout: rows sorted along a space-filling curve over several columns."""

from __future__ import annotations

from os.path import commonprefix
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake.sources.contracts import conform, get_cluster_by

# Each column is cut into up to 2 ** BITS parts of equal size.
BITS = 6
ROWS_PER_FILE = 1_000_000


def as_numbers(df: DataFrame, columns: list[str]) -> list[Column]:
    """A number in the order of each column; of text the first six bytes after what all its values begin with."""
    kinds = dict(df.dtypes)
    bounds = {c: [F.min(c).alias(f"low_{c}"), F.max(c).alias(f"high_{c}")] for c in columns if kinds[c] == "string"}
    row = df.agg(*[b for pair in bounds.values() for b in pair]).first() if bounds else None
    shared = {c: commonprefix([row[f"low_{c}"] or "", row[f"high_{c}"] or ""]) for c in bounds}
    return [as_number(c, kinds[c], len(shared.get(c, "").encode())) for c in columns]


def as_number(column: str, kind: str, skip: int = 0) -> Column:
    value = F.col(column)
    if kind == "string":
        part = F.substring(F.encode(value, "UTF-8"), skip + 1, 6)
        return F.conv(F.rpad(F.hex(part), 12, "0"), 16, 10).cast("double")
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.unix_seconds(value.cast("timestamp")).cast("double")
    return value.cast("double")


def cuts_of(df: DataFrame, numbers: list[Column], bits: int = BITS) -> list[list[float]]:
    """Numbers that cut each column into parts of about equal size; one pass, small summaries."""
    numbers = df.select(*[n.alias(f"n{i}") for i, n in enumerate(numbers)])
    shares = [i / 2**bits for i in range(1, 2**bits)]
    found = numbers.approxQuantile(numbers.columns, shares, 1 / 2 ** (bits + 2))
    return [sorted(set(cuts)) for cuts in found]


def place(number: Column, cuts: list[float], bits: int = BITS) -> Column:
    """Number of cuts up to a value, spread over all bits; NULL comes first."""
    if not cuts:
        return F.lit(0)
    limits = F.array(*[F.lit(float(c)) for c in cuts])
    return F.when(number.isNull(), F.lit(0)).otherwise(F.floor(F.size(F.filter(limits, lambda c: c <= number)) * F.lit(2**bits / (len(cuts) + 1))))


def z_order(places: list[Column], bits: int = BITS) -> Column:
    """The bits of all places interleaved, the highest bits first."""
    key = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for p in places:
            key = F.shiftleft(key, 1).bitwiseOR(F.shiftright(p.cast("long"), bit).bitwiseAND(F.lit(1)))
    return key


def write_clustered(df: DataFrame, path: str, columns: list[str], files: int, bits: int = BITS) -> None:
    """Write a table in ``files`` files along the Z-order of some columns.

    Two passes over the columns find the cuts; rows are then dealt by ranges of
    the key, so a file holds a small box of the space of all columns and its
    minima and maxima let filters skip it.
    """
    bits = min(bits, 60 // max(len(columns), 1))
    numbers = as_numbers(df, columns)
    places = [place(n, cuts, bits) for n, cuts in zip(numbers, cuts_of(df, numbers, bits), strict=True)]
    keyed = df.withColumn("_z", z_order(places, bits))
    keyed.repartitionByRange(files, "_z").sortWithinPartitions("_z").drop("_z").write.mode("overwrite").parquet(path)


def store_by_contract(df: DataFrame, cfg: dict[str, Any], path: str, files: int | None = None) -> DataFrame:
    """Store a table in the columns, types and layout of its contract and read it back."""
    shaped = conform(df, cfg)
    columns = get_cluster_by(cfg)
    files = files or 1 + shaped.count() // ROWS_PER_FILE
    if columns:
        write_clustered(shaped, path, columns, files)
    else:
        shaped.repartition(files).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def files_for(spark: SparkSession, path: str, column: str, value: Any) -> tuple[int, int]:
    """How many files may hold a value, by their minima and maxima, and how many there are."""
    bounds = (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.min(column).alias("low"), F.max(column).alias("high"))
    )
    hit = F.count_if((F.col("low") <= F.lit(value)) & (F.col("high") >= F.lit(value)))
    return tuple(bounds.agg(hit, F.count(F.lit(1))).first())
