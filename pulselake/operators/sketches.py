"""Sketches that are stored by group and merged for any range of groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 2^12 registers: a relative standard error of 1.04 / 2^6.
HLL_BITS = 12
HLL_ERROR = 1.04 / 2 ** (HLL_BITS / 2)
# A rank found with this size is off by less than 1.4 % of the rows, at 99 % confidence.
KLL_SIZE = 200
KLL_ERROR = 0.014


def daily_sketches(rows: DataFrame, day: Column, ident: Column, value: Column) -> DataFrame:
    """Per day the number of rows, a sketch of the distinct ids and one of the values' quantiles.

    Two small binary values for a day, whatever the number of rows; both are
    combined before the shuffle.
    """
    return rows.groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.hll_sketch_agg(ident, HLL_BITS).alias("ids"),
        F.kll_sketch_agg_double(value, KLL_SIZE).alias("quantiles"),
    )


def merged(sketches: DataFrame, group: Column, name: str) -> DataFrame:
    """The stored sketches of each group of days as one: rows, distinct ids and the merged quantile sketch."""
    return sketches.groupBy(group.alias(name)).agg(
        F.sum("n_rows").alias("n_rows"),
        F.hll_sketch_estimate(F.hll_union_agg("ids")).alias("distinct_ids"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )


def quantile(sketch: str, share: float) -> Column:
    return F.kll_sketch_get_quantile_double(F.col(sketch), F.lit(share))
