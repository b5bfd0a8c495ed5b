"""Joins over time: the version valid at an instant, and the intervals around an instant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def point_in_time(
    events: DataFrame,
    history: DataFrame,
    keys: list[str],
    at: str,
    valid_from: str = "__START_AT",
    valid_to: str = "__END_AT",
    prefix: str = "v_",
    chunk: str = "day",
) -> DataFrame:
    """Each event with the version of its key that is valid at the event's own instant.

    A version holds from ``valid_from`` up to, but not including, ``valid_to``
    (NULL: without end); versions of a key do not overlap. Its columns come with
    ``prefix``, all NULL where no version is valid; every event stays, one with a NULL
    instant too. NULL keys are equal to each other.

    Both sides are merged in order of time, and an event takes the last version
    before it. The merge runs in chunks of time for each key, so a key with a
    large part of all rows spreads over many tasks; the last version of a chunk
    reaches the next ones through one row for each key and chunk. No pair of an
    event and a version other than its own is ever built.
    """
    columns = [c for c in history.columns if c not in keys]
    version = F.struct(*columns)
    none = F.lit(None)
    key = F.struct(*keys)
    own = F.struct(*events.columns)
    kind = history.select(version.alias("v")).schema["v"].dataType
    timeline = events.select(
        key.alias("_key"), F.col(at).cast("timestamp").alias("_at"), F.lit(1).alias("_side"), own.alias("_event"),
        none.cast(kind).alias("_version"),
    ).unionByName(
        history.where(F.col(valid_from).isNotNull()).select(
            key.alias("_key"), F.col(valid_from).cast("timestamp").alias("_at"), F.lit(0).alias("_side"),
            none.cast(events.select(own.alias("e")).schema["e"].dataType).alias("_event"), version.alias("_version"),
        )
    ).withColumn("_chunk", F.date_trunc(chunk, F.col("_at")))
    # A version that begins at the very instant of an event holds for it.
    so_far = (
        Window.partitionBy("_key", "_chunk").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    merged = timeline.withColumn("_here", F.last("_version", ignorenulls=True).over(so_far))
    chunks = timeline.groupBy("_key", "_chunk").agg(
        F.max_by("_version", F.when(F.col("_side") == 0, F.col("_at"))).alias("_last")
    )
    earlier = Window.partitionBy("_key").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = chunks.select("_key", "_chunk", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    # NULL instants have a chunk of their own, which nothing joins.
    found = merged.where("_side = 1").join(carried, ["_key", "_chunk"], "left")
    latest = F.coalesce("_here", "_carried")
    holds = latest[valid_to].isNull() | (latest[valid_to] > F.col("_at"))
    return found.withColumn("_valid", F.when(holds, latest)).select(
        *[F.col(f"_event.{c}").alias(c) for c in events.columns],
        *[F.col(f"_valid.{c}").alias(f"{prefix}{c}") for c in columns],
    )


def _cell(instant: Column, seconds: int) -> Column:
    """Number of the stretch of time of a given length that holds an instant."""
    return F.floor(F.unix_micros(instant.cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("long")


def within_intervals(
    points: DataFrame,
    intervals: DataFrame,
    by: list[str],
    at: str,
    start: str = "start_ts",
    end: str = "end_ts",
    prefix: str = "i_",
    cell_seconds: int = 3600,
    levels: int = 4,
    factor: int = 16,
) -> DataFrame:
    """Each point with each interval of its group that holds it (from ``start``, before ``end``).

    Time is cut into cells, on several grids, each coarser than the last by
    ``factor``. An interval lies on the finest grid where it spans few cells and is
    copied to each of these; a point has one cell on each grid. Both meet by an
    equality of group, grid and cell, so no other pair is built, and a pair
    meets once, in the cell of the point. Intervals longer than that are on the
    coarsest grid. The columns of the interval, without those of the group,
    come with ``prefix``. Groups, instants and bounds of NULL join nothing.
    """
    lengths = [cell_seconds * factor**i for i in range(levels)]
    span = F.col(end).cast("timestamp").cast("double") - F.col(start).cast("timestamp").cast("double")
    level = F.lit(levels - 1)
    for i in reversed(range(levels - 1)):
        level = F.when(span <= lengths[i] * factor, F.lit(i)).otherwise(level)
    sides = intervals.where(F.col(start) < F.col(end)).select(
        *[F.col(c).alias(f"_by_{c}") for c in by],
        *[F.col(c).alias(f"{prefix}{c}") for c in intervals.columns if c not in by],
        level.alias("_level"),
    )
    first, last = F.col(f"{prefix}{start}"), F.col(f"{prefix}{end}")
    pick = lambda of: F.element_at(F.array(*[_cell(of, n) for n in lengths]), F.col("_level") + 1)
    sides = sides.withColumn("_cell", F.explode(F.sequence(pick(first), pick(last))))
    cells = F.array(*[F.struct(F.lit(i).alias("_level"), _cell(F.col(at), n).alias("_cell")) for i, n in enumerate(lengths)])
    placed = points.withColumn("_grid", F.explode(cells)).select(*points.columns, "_grid.*")
    same = [F.col(c) == F.col(f"_by_{c}") for c in by]
    met = placed.join(
        sides.withColumnsRenamed({"_level": "_of", "_cell": "_in"}),
        [*same, F.col("_level") == F.col("_of"), F.col("_cell") == F.col("_in"), F.col(at) >= first, F.col(at) < last],
    )
    return met.select(*points.columns, *[f"{prefix}{c}" for c in intervals.columns if c not in by])
