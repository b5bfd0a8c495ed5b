"""Joins and windows that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def anti_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``; NULL keys never match.

    ``right`` is reduced to distinct keys, combining before the shuffle, so a
    key copied many times there costs one row. A key that fills a partition on
    the left is split by Spark's skew join, as only that side is large.
    """
    known = right.select(F.col(right_on).alias(left_on)).where(F.col(left_on).isNotNull()).distinct()
    return left.join(known, left_on, "left_anti").select(*left.columns)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
