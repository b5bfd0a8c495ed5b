"""Benchmark decontamination with one Aho-Corasick automaton.

Test items are cut into windows of consecutive words; all windows form one
automaton over the normalised bytes. Every document is normalised and
scanned once, and matches are mapped back to words and to character offsets
of the original text.

The windows of up to ``SHARD_BYTES`` of test texts are broadcast as one
automaton. Larger test sets are dealt by item over several such automata of
the same bound, one at a time, and their matches are joined.

Results:

* one row for each document row, NULL and repeated ids included;
* NULL and empty texts have no words, no hits and no items;
* items without words, or with NULL text, never occur; an item with a NULL
  id marks words but adds nothing to the list of items;
* repeated items count once by id; the same window may belong to many items;
* an empty benchmark leaves all documents clean, an empty table stays empty.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from pulselake.llm.common import fresh, stored, texts

WINDOW_WORDS = 10
# UTF-8 bytes of test items in one automaton. Each word begins a window, so the
# automaton takes some 300 times that in memory, 120 MB in each Python worker.
SHARD_BYTES = 400_000

# Bytes of words stay, A-Z become a-z, anything else becomes a blank.
KEEP = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)

MATCHES = (
    "struct<n_words:bigint,ranges:array<struct<from:bigint,to:bigint>>,items:array<string>,"
    "spans:array<struct<start:bigint,end:bigint>>>"
)


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(KEEP).split()


def windows_of(words: list[bytes], size: int = WINDOW_WORDS) -> list[tuple[bytes, ...]]:
    """All windows of an item; one that is shorter than a window counts whole."""
    if not words:
        return []
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


class Automaton:
    """Windows of the test items, to be found in normalised text."""

    def __init__(self, items: list[tuple[str | None, str | None]], size: int = WINDOW_WORDS):
        import ahocorasick

        owners = defaultdict(set)
        for item_id, text in items:
            for window in windows_of(words_of((text or "").encode()), size):
                owners[window].add(item_id)
        self.owners, self.lengths = [], []
        # Each byte is one character of the pattern; blanks mark word ends.
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for window, ids in owners.items():
            self.machine.add_word(f" {b' '.join(window).decode('latin-1')} ", len(self.owners))
            self.owners.append(sorted(i for i in ids if i is not None))
            self.lengths.append(len(window))
        if owners:
            self.machine.make_automaton()

    def scan(self, raw: bytes) -> tuple[int, list[tuple[int, int]], list[str]]:
        """Number of words, merged hit ranges of words, and the items found."""
        words = words_of(raw)
        if not words or not self.owners:
            return len(words), [], []
        line = b" " + b" ".join(words) + b" "
        found = list(self.machine.iter(line.decode("latin-1")))
        if not found:
            return len(words), [], []
        blanks = np.cumsum(np.frombuffer(line, dtype=np.uint8) == 0x20)
        ranges, items = [], set()
        for end, window in found:
            last = int(blanks[end]) - 1  # words before the closing blank
            ranges.append((last - self.lengths[window], last))
            items.update(self.owners[window])
        return len(words), merged(ranges), sorted(items)


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def character_spans(raw: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as [start, end) code points of the original text."""
    if not ranges:
        return []
    data = np.frombuffer(raw, dtype=np.uint8)
    in_word = np.frombuffer(raw.translate(KEEP), dtype=np.uint8) != 0x20
    edges = np.diff(np.concatenate(([0], in_word.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return [(int(points[starts[a]]), int(points[ends[b - 1]])) for a, b in ranges]


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    size: int = WINDOW_WORDS,
    shard_bytes: int = SHARD_BYTES,
    name: str = "leak",
) -> DataFrame:
    """All columns of ``docs`` with a struct ``name``: words, hit words, items, digest and spans.

    One pass over the documents and no shuffle while the test items fit one
    automaton.
    """
    docs, row = docs.drop(name), fresh(docs, "leak_row")
    items = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").alias("item_text"))
    total = items.agg(F.sum(F.octet_length("item_text"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    if shards == 1:
        return _digested(_scan(docs, items.collect(), size, name), name, F.expr(
            f"aggregate({name}.ranges, 0L, (n, r) -> n + r.to - r.from)"
        ))
    keyed = docs.withColumn(row, F.monotonically_increasing_id())
    keyed = stored(keyed, "leak-rows")
    found = None
    for shard in range(shards):
        part = items.where(F.pmod(F.xxhash64("item_text"), F.lit(shards)) == shard).collect()
        hits = _scan(keyed.select(F.col(row).alias("leak_row"), "text"), part, size, "part").drop("text")
        hits = stored(hits.where((F.size("part.ranges") > 0) | F.lit(shard == 0)), "leak-shard")
        found = hits if found is None else found.unionByName(hits)
    together = found.groupBy(F.col("leak_row").alias(row)).agg(
        F.struct(
            F.max("part.n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_list("part.ranges"))).alias("ranges"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("part.items")))).alias("items"),
            F.array_sort(F.flatten(F.collect_list("part.spans"))).alias("spans"),
        ).alias(name)
    )
    covered = F.expr(
        f"aggregate({name}.ranges, named_struct('n', 0L, 'to', 0L), "
        "(s, r) -> named_struct('n', s.n + greatest(0L, r.to - greatest(r.from, s.to)), 'to', greatest(s.to, r.to)), "
        "s -> s.n)"
    )
    return _digested(keyed.join(together, row).drop(row), name, covered)


def _scan(docs: DataFrame, items, size: int, name: str) -> DataFrame:
    """``docs`` with the matches of one automaton as a struct column."""
    held = docs.sparkSession.sparkContext.broadcast([(r[0], r[1]) for r in items])
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(f"{name} {MATCHES}").fields])
    target = to_arrow_type(schema[name].dataType)

    def scan(batches):
        automaton = Automaton(held.value, size)
        for batch in batches:
            rows = []
            for raw in texts(batch):
                n, ranges, found = automaton.scan(raw)
                rows.append(
                    {
                        "n_words": n,
                        "ranges": [{"from": a, "to": b} for a, b in ranges],
                        "items": found,
                        "spans": [{"start": a, "end": b} for a, b in character_spans(raw, ranges)],
                    }
                )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rows, type=target)], names=[*batch.schema.names, name]
            )

    return docs.mapInArrow(scan, schema)


def _digested(df: DataFrame, name: str, covered: Column) -> DataFrame:
    part = F.col(name)
    return df.withColumn(
        name,
        F.struct(
            part["n_words"].alias("n_words"),
            covered.cast("long").alias("n_hit"),
            F.size(part["items"]).cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", part["items"]), 256).alias("items_sha256"),
            part["items"].alias("items"),
            part["spans"].alias("spans"),
        ),
    )
