"""Gap sessions over time-stamped intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def label_sessions(
    df: DataFrame,
    by: list[str],
    start: str = "start_ts",
    end: str = "end_ts",
    tie_break: str = "uuid",
    gap: str = "30 minutes",
    chunk: str = "hour",
) -> DataFrame:
    """Each row with ``session_no``, its place ``stage_no`` and ``session_start_ts``.

    Rows of a group are ordered by start. A row opens a new session when it
    starts more than ``gap`` after the end of the row before it; a gap of
    exactly that length does not. Only the previous row counts, not the latest
    end so far.

    The windows run over (group, ``chunk`` of time) instead of the whole group,
    so a group with a large part of all rows spreads over many tasks. What
    crosses a chunk border travels through a summary of one row per group and
    chunk: the last end before the chunk, the sessions opened so far and the
    position and start of the open session. The group is kept as a struct: NULL
    groups are then equal to each other, and the join with the summary reuses
    the partitioning of the windows.
    """
    step = F.expr(f"INTERVAL {gap}")
    place = [F.col(start), F.col(end), F.col(tie_break)]
    in_chunk = Window.partitionBy("_group", "_chunk").orderBy(*place)
    so_far = in_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    rows = df.withColumns({"_group": F.struct(*by), "_chunk": F.date_trunc(chunk, F.col(start))}).withColumns(
        {"_prev_end": F.lag(end).over(in_chunk), "_rn": F.row_number().over(in_chunk)}
    )
    opens = (F.col("_rn") > 1) & (F.col(start) - F.col("_prev_end") > step)
    rows = rows.withColumn("_opens", F.coalesce(opens, F.lit(False)))

    open_at = F.when(F.col("_opens"), F.col("_rn"))
    summary = rows.groupBy("_group", "_chunk").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if("_opens").alias("_opened"),
        F.max(open_at).alias("_last_open"),
        F.max_by(start, open_at).alias("_last_open_start"),
        F.min(start).alias("_first_start"),
        F.max_by(end, F.struct(*place)).alias("_last_end"),
    )

    over_chunks = Window.partitionBy("_group").orderBy("_chunk")
    up_to_here = over_chunks.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = over_chunks.rowsBetween(Window.unboundedPreceding, -1)
    gap_at_border = F.col("_first_start") - F.lag("_last_end").over(over_chunks) > step
    summary = summary.withColumn("_head", F.coalesce(gap_at_border, F.lag("_rows").over(over_chunks).isNull()))
    summary = summary.withColumns(
        {
            "_offset": F.coalesce(F.sum("_rows").over(before), F.lit(0)),
            "_sessions": F.sum(F.col("_opened") + F.col("_head").cast("int")).over(up_to_here) - F.col("_opened"),
        }
    )
    # Last place in this chunk, counted over the whole group, where a session opened.
    newest = (
        F.when(
            F.col("_last_open").isNotNull(),
            F.struct((F.col("_offset") + F.col("_last_open")).alias("at"), F.col("_last_open_start").alias("start")),
        )
        .when(F.col("_head"), F.struct((F.col("_offset") + 1).alias("at"), F.col("_first_start").alias("start")))
    )
    summary = summary.withColumn("_newest", newest)
    carried = F.when(
        F.col("_head"), F.struct((F.col("_offset") + 1).alias("at"), F.col("_first_start").alias("start"))
    ).otherwise(F.max("_newest").over(before))
    summary = summary.select("_group", "_chunk", "_offset", "_sessions", carried.alias("_carried"))

    placed = rows.withColumns(
        {
            "_opened_here": F.sum(F.col("_opens").cast("int")).over(so_far),
            "_open_rn": F.max(open_at).over(so_far),
            "_open_start": F.max(F.when(F.col("_opens"), F.col(start))).over(so_far),
        }
    )
    joined = placed.join(summary, ["_group", "_chunk"])
    opened_at = F.coalesce(F.col("_offset") + F.col("_open_rn"), F.col("_carried.at"))
    return joined.select(
        *df.columns,
        (F.col("_sessions") + F.col("_opened_here")).alias("session_no"),
        (F.col("_offset") + F.col("_rn") - opened_at + 1).alias("stage_no"),
        F.coalesce("_open_start", "_carried.start").alias("session_start_ts"),
    )


def sessionize(
    df: DataFrame,
    by: list[str],
    start: str = "start_ts",
    end: str = "end_ts",
    tie_break: str = "uuid",
    gap: str = "30 minutes",
    chunk: str = "hour",
) -> DataFrame:
    """One row per session: number, earliest start, latest end and number of rows."""
    labelled = label_sessions(df, by, start, end, tie_break, gap, chunk)
    return labelled.groupBy(*by, "session_no").agg(
        F.min(start).alias("session_start_ts"),
        F.max(end).alias("session_end_ts"),
        F.count(F.lit(1)).alias("stage_count"),
    )
