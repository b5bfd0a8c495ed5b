"""Mixing sources to target weights by blocks of fixed length.

The words of each source, laid end to end in a fixed pseudorandom order of
its documents, are packed into blocks of ``BLOCK_WORDS``. A source fills as
many slots of the mix as its target asks for; how many of them go into each
output shard is a multinomial draw. The slots of a source are numbered
through, and slot k holds block permutation(k mod blocks) of pass k div
blocks, each pass with a permutation of its own, so blocks are repeated only
when all have been used. Slots and blocks meet in a join by block index.

Targets: sources in code-point order, NULL last, weigh 5, 2, 1 and so on, and
share all words; none gets more than three times its own words, what is over
goes to the others by weight.

Results:

* one row for each input row, NULL and repeated ids included;
* NULL, empty and blank texts have size 0 and are never taken;
* NULL is a source of its own; a source without words has the target 0;
* all draws depend on the seed and on the rows alone, so reruns agree; rows
  that agree in id and size are interchangeable;
* an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulselake.llm.common import WORD, arrow_map, stored

WEIGHTS = (5.0, 2.0, 1.0)
LIMIT = 3
BLOCK_WORDS = 256
SHARDS = 64
# Slots that one row of the plan stands for until they are dealt.
PIECE = 65_536
# Rows of a source whose running sums one task makes.
CHUNK_ROWS = 4096
SEED = "mix-1"


def sized(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, limit: float = LIMIT
) -> DataFrame:
    """``source``, ``source_size`` and ``target``: one row for each source.

    A source is at its limit exactly if the common rate of words per weight
    exceeds limit times its size by weight; the rate follows from sorting the
    sources by that quotient. These windows see one row for each source only.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*[F.lit(w) for w in weights])
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = totals.withColumn("weight", F.element_at(cycle, (F.pmod(place, F.lit(len(weights))) + 1).cast("int")))
    cap = F.col("source_size") * F.lit(float(limit))
    everything = W.partitionBy()
    below = W.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    rated = weighed.select(
        "*",
        (
            (F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(below), F.lit(0.0)))
            / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(below), F.lit(0.0)))
        ).alias("rate"),
        (cap / F.col("weight")).alias("bound"),
    )
    # The first source, in that order, which its rate does not lift over its limit sets the rate.
    open_rate = F.min(F.when(F.col("rate") <= F.col("bound"), F.struct("bound", "rate"))).over(everything)["rate"]
    return rated.select(
        "source",
        "source_size",
        F.least(cap, F.coalesce(open_rate, F.lit(0.0)) * F.col("weight")).alias("target"),
    )


def packed(sizes: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Rows with words and ``first_word``, their place in the word order of the source.

    Running sums in two steps, so no task sees more of a source than a chunk:
    chunks of rows by hash of the id, then the sums of the chunks.
    """
    words = sizes.where("size > 0")
    chunks = F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / F.lit(chunk_rows))).cast("long")
    counted = words.agg(chunks.alias("chunks")).first()["chunks"] if chunk_rows else 1
    dealt = words.withColumn("chunk", F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "size"), F.lit(counted)))
    inner = (
        W.partitionBy("source", "chunk")
        .orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id", "size")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    order = W.partitionBy("source").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    ahead = (
        dealt.groupBy("source", "chunk")
        .agg(F.sum("size").alias("chunk_size"))
        .select("source", "chunk", F.coalesce(F.sum("chunk_size").over(order), F.lit(0)).alias("ahead"))
    )
    local = dealt.withColumn("within", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    return local.join(ahead, local.source.eqNullSafe(ahead.source) & (local.chunk == ahead.chunk)).select(
        local["*"], (F.col("ahead") + F.col("within")).alias("first_word")
    )


def permuted(index: np.ndarray, blocks: int, key: str) -> np.ndarray:
    """A pseudorandom permutation of range(blocks), at the given places only.

    Four rounds of a Feistel network over the next even power of two, walked
    until the value lies below ``blocks``.
    """
    half = max(1, (max(blocks - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    shift = np.uint64(half)
    keys = [np.uint64(xxhash.xxh64_intdigest(f"{key}:{r}")) for r in range(4)]

    def network(x):
        left, right = x >> shift, x & mask
        for k in keys:
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        return (left << shift) | right

    with np.errstate(over="ignore"):
        out = network(index.astype(np.uint64))
        outside = out >= blocks
        while outside.any():
            out[outside] = network(out[outside])
            outside = out >= blocks
    return out.astype(np.int64)


def slots(targets: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """``source``, ``shard``, ``slot`` and ``block``: what every slot of the mix holds.

    A source with n blocks gets target / size * n slots, so that its last,
    shorter block is accounted for. Their multinomial counts by shard are
    drawn for each source from a generator of its own; the rows are then made
    in parallel, at most a chunk of slots from each row.
    """
    planned = targets.where("source_size > 0").select(
        "source",
        F.ceil(F.col("source_size") / block_words).alias("blocks"),
        F.round(
            F.col("target") / F.col("source_size") * F.ceil(F.col("source_size") / block_words)
        ).cast("long").alias("n_slots"),
    )
    pieces = planned.where("n_slots > 0").withColumn(
        "first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_slots") - 1, F.lit(PIECE).cast("long")))
    )
    # By number, as these few short rows become many in each task.
    tasks = int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = pieces.repartition(tasks, F.col("source"), F.col("first"))

    def deal(batch):
        out = {"source": [], "shard": [], "slot": [], "block": []}
        for row in batch.to_pylist():
            source, blocks, n_slots, first = row["source"], row["blocks"], row["n_slots"], row["first"]
            name = f"{seed}:{'-' if source is None else '+' + source}"
            rng = np.random.default_rng(xxhash.xxh64_intdigest(name))
            bounds = np.cumsum(rng.multinomial(n_slots, np.full(shards, 1.0 / shards)))
            slot = np.arange(first, min(first + PIECE, n_slots), dtype=np.int64)
            passes, place = slot // blocks, slot % blocks
            block = np.empty_like(slot)
            for p in np.unique(passes):
                at = passes == p
                block[at] = permuted(place[at], blocks, f"{name}:{p}")
            out["source"] += [source] * len(slot)
            out["shard"].append(np.searchsorted(bounds, slot, side="right"))
            out["slot"].append(slot)
            out["block"].append(block)
        return {k: v if k == "source" else np.concatenate(v) for k, v in out.items()}

    return arrow_map(pieces, deal, "source string, shard long, slot long, block long")


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    limit: float = LIMIT,
    block_words: int = BLOCK_WORDS,
    shards: int = SHARDS,
    chunk_rows: int = CHUNK_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """The digest of the mix by document, and the plan of its slots.

    The plan joins with the blocks by (source, block); the digest has
    ``doc_id``, ``size``, ``source_size``, ``target`` and ``taken``.
    """
    sizes = stored(sized(docs), "mix-sizes")
    targets = stored(source_targets(sizes, weights, limit), "mix-targets")
    plan = stored(slots(targets, block_words, shards), "mix-slots")
    uses = plan.groupBy("source", "block").agg(F.count(F.lit(1)).alias("uses"))
    placed = stored(
        packed(sizes, chunk_rows).withColumn("row", F.monotonically_increasing_id()), "mix-placed"
    )
    parts = placed.select(
        "row",
        "source",
        "size",
        "first_word",
        F.explode(
            F.sequence(
                F.floor(F.col("first_word") / block_words),
                F.floor((F.col("first_word") + F.col("size") - 1) / block_words),
            )
        ).alias("block"),
    ).select(
        "row",
        "source",
        "block",
        (
            F.least((F.col("block") + 1) * block_words, F.col("first_word") + F.col("size"))
            - F.greatest(F.col("block") * block_words, F.col("first_word"))
        ).alias("words"),
    )
    met = parts.join(uses, _same("source", parts, uses) & (parts.block == uses.block)).groupBy("row").agg(
        F.sum(F.col("words") * F.col("uses")).alias("taken")
    )
    with_words = placed.join(met, "row", "left").select("doc_id", "source", "size", F.coalesce("taken", F.lit(0)).alias("taken"))
    without = sizes.where("size = 0").select("doc_id", "source", "size", F.lit(0).cast("long").alias("taken"))
    rows = with_words.unionByName(without)
    digest = rows.join(targets, _same("source", rows, targets)).select(
        "doc_id", "size", targets.source_size, targets.target, "taken"
    )
    return digest, plan


def _same(name: str, left: DataFrame, right: DataFrame) -> Column:
    return left[name].eqNullSafe(right[name])
