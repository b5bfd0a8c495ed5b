"""Keyed state on streams: latest changes with tombstones, and sessions by event time.

The state of a key lives in Spark's state store, so the work of a micro-batch
grows with the batch alone and a restart goes on from the checkpoint. The
processors are classes inside functions: Spark then sends them to the Python
workers whole, and workers need no package of ours.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType, VariantType

from pulselake.operators.cdc import IS_DELETE

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """The state store that keyed state needs, for streams started inside; the session's own afterwards."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def variants_as_text(df: DataFrame) -> DataFrame:
    """VARIANT columns as JSON text, which Python workers can hold."""
    return df.select(
        *[
            F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, VariantType) else F.col(f.name)
            for f in df.schema
        ]
    )


def text_as_variants(df: DataFrame, like: StructType) -> DataFrame:
    """The reverse of :func:`variants_as_text`, by the schema there was."""
    variant = {f.name for f in like if isinstance(f.dataType, VariantType)}
    return df.select(*[F.parse_json(F.col(c)).alias(c) if c in variant else F.col(c) for c in df.columns])


def latest_changes(
    feed: DataFrame,
    keys: list[str],
    sequence_by: str = "ingested_at",
    delete_when: str = IS_DELETE,
    tie_break: str | None = "record_id",
    tombstone_ttl_ms: int | None = None,
) -> DataFrame:
    """The keys that a micro-batch changes, each with its latest change and the flag ``_deleted``.

    A key's state is the place of its latest change in the order of changes
    (sequence, delete after insert, tie column), for a delete as a tombstone.
    A change that comes late, after a later one, gives no row. With a time to
    live a tombstone is forgotten after it; an insert older than the delete
    that comes later still would then bring the key back, so the time has to
    cover the latest upload. Spark counts that time by the clock, so such a stream
    has to run on a processing-time trigger; ``availableNow`` would not end.
    Rows of a key are read one by one, never held.
    Run it in output mode ``update`` within :func:`state_store`.
    """
    tie = F.col(tie_break).cast("string") if tie_break else F.lit(None).cast("string")
    plain = variants_as_text(feed)
    rows = plain.select(
        *plain.columns,
        F.unix_micros(F.col(sequence_by).cast("timestamp")).alias("_seq"),
        F.coalesce(F.expr(delete_when), F.lit(False)).alias("_deleted"),
        tie.alias("_tie"),
    )
    out = StructType([*plain.schema.fields, rows.schema["_deleted"]])
    names = plain.columns

    class Latest(StatefulProcessor):
        def init(self, handle) -> None:
            schema = "seq long, tie string"
            self.live = handle.getValueState("live", schema)
            if tombstone_ttl_ms:
                self.gone = handle.getValueState("gone", schema, tombstone_ttl_ms)
            else:
                self.gone = handle.getValueState("gone", schema)

        @staticmethod
        def order(seq, deleted, tie) -> tuple:
            return (seq is not None, seq or 0, deleted, tie is not None, tie or "")

        def handleInputRows(self, key, rows, timerValues):
            best, newest, held = None, None, set()
            # Each call is a message to the store and back, so there are as few as can be.
            for state, deleted in ((self.live, False), (self.gone, True)):
                value = state.get()
                if value is not None:
                    held.add(deleted)
                    best = max(best or (False,), self.order(value[0], deleted, value[1]))
            for r in rows:
                place = self.order(r["_seq"], r["_deleted"], r["_tie"])
                if best is None or place > best:
                    best, newest = place, r
            if newest is not None:
                here, other = (self.gone, self.live) if newest["_deleted"] else (self.live, self.gone)
                here.update((newest["_seq"], newest["_tie"]))
                if (not newest["_deleted"]) in held:
                    other.clear()
                yield Row(**{n: newest[n] for n in names}, _deleted=newest["_deleted"])

        def close(self) -> None:
            pass

    mode = "ProcessingTime" if tombstone_ttl_ms else "None"
    changed = rows.groupBy(*keys).transformWithState(Latest(), out, "Update", mode)
    return text_as_variants(changed, feed.schema)


SESSION_ROWS = (
    "kind string, session_no long, session_start long, session_end long, stage_count long, start long, end long, tie string"
)


def timed_sessions(
    df: DataFrame,
    by: list[str],
    start: str = "start_ts",
    end: str = "end_ts",
    tie_break: str = "uuid",
    gap_seconds: int = 1800,
    delay: str = "1 hour",
) -> DataFrame:
    """Sessions by the rule of the previous row, and the rows that came too late for it.

    A row waits until the watermark (latest start less ``delay``) has passed
    its start; then all rows before it are known, and it goes on with the
    session at hand or opens a new one, as in the batch operator. A session is
    given out (``kind`` is ``session``) when a row opens the next one or when the
    watermark has passed its last end by more than the gap. A row that
    arrives behind the watermark is given out at once as ``late`` and belongs to
    no session; none is dropped silently. State holds the waiting rows of the
    delay and one open session for each group.

    The group of NULL is a group like others. Rows without a start are late.
    Run it in output mode ``append`` within :func:`state_store`.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    # Spark drops late rows by the watermarked column, so that column stays behind and its
    # value goes on as a number.
    rows = df.withWatermark(start, delay).select(
        *by, micros(start).alias("_start"), micros(end).alias("_end"), F.col(tie_break).cast("string").alias("_tie")
    )
    keys = StructType([rows.schema[c] for c in by])
    out = StructType([*keys.fields, *StructType.fromDDL(SESSION_ROWS).fields])
    names, gap = list(by), gap_seconds * 1_000_000
    empty = dict.fromkeys([f.name for f in StructType.fromDDL(SESSION_ROWS)])

    class Sessions(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.waiting = handle.getListState("waiting", "start long, end long, tie string")
            self.open = handle.getValueState(
                "open", "number long, start long, end long, stages long, last_end long"
            )

        def row(self, key, **values):
            return Row(**dict(zip(names, key, strict=True)), **{**empty, **values})

        def session(self, key, number, first, last, stages, _last_end):
            return self.row(
                key, kind="session", session_no=number, session_start=first, session_end=last, stage_count=stages
            )

        def wait(self, micros) -> None:
            self.handle.registerTimer(micros // 1000 + 1)

        def handleInputRows(self, key, rows, timerValues):
            watermark = timerValues.getCurrentWatermarkInMs() * 1000
            kept, first = [], None
            for r in rows:
                if r["_start"] is None or r["_start"] < watermark:
                    yield self.row(key, kind="late", start=r["_start"], end=r["_end"], tie=r["_tie"])
                else:
                    kept.append((r["_start"], r["_end"], r["_tie"]))
                    first = min(first if first is not None else r["_start"], r["_start"])
                if len(kept) >= 10_000:
                    self.waiting.appendList(kept)
                    kept = []
            if kept:
                self.waiting.appendList(kept)
            if first is not None:
                self.wait(first)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            watermark = timerValues.getCurrentWatermarkInMs() * 1000
            at_hand = self.open.get()
            number = at_hand[0] if at_hand else 0
            rows = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
            due = sorted((r for r in rows if r[0] < watermark), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or ""))
            rest = [r for r in rows if r[0] >= watermark]
            for first, last, _ in due:
                opens = at_hand and at_hand[4] is not None and first - at_hand[4] > gap
                if at_hand and at_hand[1] is not None and not opens:
                    ends = [e for e in (at_hand[2], last) if e is not None]
                    at_hand = (number, at_hand[1], max(ends, default=None), at_hand[3] + 1, last)
                    continue
                if opens and at_hand[1] is not None:
                    yield self.session(key, *at_hand)
                number += 1
                at_hand = (number, first, last, 1, last)
            if at_hand and at_hand[1] is not None and at_hand[4] is not None and at_hand[4] + gap < watermark:
                yield self.session(key, *at_hand)
                # Its number and last end stay, for the sessions after it.
                at_hand = (number, None, None, 0, at_hand[4])
            if due:
                self.waiting.clear()
                if rest:
                    self.waiting.put(rest)
                    self.wait(min(r[0] for r in rest))
            if at_hand:
                self.open.update(at_hand)
                if at_hand[1] is not None and at_hand[4] is not None:
                    self.wait(at_hand[4] + gap)

        def close(self) -> None:
            pass

    return rows.groupBy(*by).transformWithState(Sessions(), out, "Append", "EventTime")


def instant(column: str) -> Column:
    return F.timestamp_micros(F.col(column))


def session_sink(path: str, by: list[str], start: str = "start_ts", end: str = "end_ts", tie_break: str = "uuid"):
    """Sink that puts sessions and late rows of :func:`timed_sessions` into tables of their own.

    A replayed batch overwrites its own folders.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        batch.where("kind = 'session'").select(
            *by,
            "session_no",
            instant("session_start").alias("session_start_ts"),
            instant("session_end").alias("session_end_ts"),
            "stage_count",
        ).write.mode("overwrite").parquet(f"{path}/sessions/batch_id={batch_id}")
        batch.where("kind = 'late'").select(
            *by, instant("start").alias(start), instant("end").alias(end), F.col("tie").alias(tie_break)
        ).write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
        batch.unpersist()

    return write


