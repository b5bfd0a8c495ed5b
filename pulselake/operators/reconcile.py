"""Bags of rows compared with their repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from pulselake.operators.skew import union_all


def canonical(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns in a form that equal values share: VARIANT as JSON text with ordered keys."""
    kinds = {f.name: f.dataType for f in df.schema}
    return df.select(
        *[F.to_json(F.col(c)).alias(c) if isinstance(kinds[c], VariantType) else F.col(c) for c in columns]
    )


def reconcile(stored: DataFrame, pulled: DataFrame, columns: list[str]) -> DataFrame:
    """Rows by ``side``: in ``both``, ``stored`` only or ``pulled`` only.

    Both sides are bags: a row that one side has twice and the other once is in
    both once and on the one side alone once. NULLs are equal to each other.
    """
    left, right = canonical(stored, columns), canonical(pulled, columns)
    parts = {"both": left.intersectAll(right), "stored": left.exceptAll(right), "pulled": right.exceptAll(left)}
    return union_all([rows.withColumn("side", F.lit(side)) for side, rows in parts.items()])
