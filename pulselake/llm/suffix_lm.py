"""Language-model scores from a probabilistic suffix tree.

The tree holds contexts of up to ``DEPTH`` words. A context and a next symbol
enter it when they occur together at least ``LEAST_COUNT`` times in training,
however large the corpus is; a context stays only if its own next-symbol distribution
diverges from that of its longest retained suffix, that is if it raises the
log likelihood of the training tokens by more than ``LEAST_GAIN`` for each of
its entries. Distributions are smoothed by absolute discounting: what the
entries leave goes to the distribution of the suffix, down to the unigrams.
A token is scored in the state of the longest suffix that is retained.

The tree is a table. As a longer context adds to the log probability of its
suffix, the score of a text is a sum over its words and word sequences: each
sequence has a weight, from its place as an entry of a retained context and as
a retained context itself. Counts come from the whole training part by partial
aggregates; a sequence is counted only if the shorter ones in it are entries.
Words and sequences that make up a share of ``HEAD_SHARE`` or more are
broadcast with their weights, at most 1 / ``HEAD_SHARE`` of each length; all
rarer ones meet theirs in a join. Marks, a bit for each hash of an entry in a
field of bounded size, keep most sequences that are no entries out of counts
and join; a wrong mark costs time only.

Results:

* one row for each input row, NULL and repeated ids included; rows with a
  NULL id are not held out;
* NULL, empty and blank texts consist of the end symbol alone;
* without training rows every token has the probability one, by the formula;
* an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulselake.llm.common import dropped, remainder, stored
from pulselake.llm.parity_join import WordHashes, in_steps

DEPTH = 2
HEAD_SHARE = 2.0**-22
# Share of all training tokens that an entry needs besides ``LEAST_COUNT``; none by default.
LEAST_SHARE = 0.0
LEAST_COUNT = 2
LEAST_GAIN = 2.0
DISCOUNT = 0.5
# Bits of the marks: about so many for an entry, and the limits of their number as powers of two.
MARK_BITS, LEAST_MARKS, MOST_MARKS = 8, 16, 27
# Parts, by hash, in which contexts are judged and rare sequences meet their weights, one after the other.
PARTS = 4
# Distinct keys that a task holds before it sends them on.
HELD_KEYS = 2_000_000
# No word contains a line feed.
END = np.uint64(xxhash.xxh3_64_intdigest(b"\n"))


def token_hashes(raws: list[bytes], known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, the end of each text included, and whether each begins a text."""
    parts, lengths = [], np.empty(len(raws), dtype=np.int64)
    for i, raw in enumerate(raws):
        words = raw.lower().split()
        lengths[i] = len(words) + 1
        parts.append(np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words)))
        parts.append(np.array([END]))
    first = np.zeros(int(lengths.sum()), dtype=bool)
    first[np.cumsum(lengths) - lengths] = True
    return np.concatenate(parts), first


def find(keys: np.ndarray, asked: np.ndarray, where: np.ndarray) -> np.ndarray:
    """Places of ``asked[where]`` in the sorted keys, -1 elsewhere and where absent."""
    out = np.full(len(asked), -1, dtype=np.int64)
    at = np.flatnonzero(where)
    if len(keys) and len(at):
        place = np.minimum(np.searchsorted(keys, asked[at]), len(keys) - 1)
        hit = keys[place] == asked[at]
        out[at[hit]] = place[hit]
    return out


def joined(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a sequence from that of all but its last word, and the last; of the empty context the word itself."""
    return ((context << np.uint64(23)) | (context >> np.uint64(41))) ^ word


def joined_columns(context: str, word: str) -> Column:
    turned = F.shiftleft(F.col(context), 23).bitwiseOR(F.shiftrightunsigned(F.col(context), 41))
    return turned.bitwiseXOR(F.col(word))


def sequences(hashes: np.ndarray, first: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length up to ``most`` the hash of the sequence that ends at each token, and whether there is one."""
    out = [(hashes, np.ones(len(hashes), dtype=bool))]
    for _ in range(most - 1):
        keys, inside = np.zeros_like(hashes), np.zeros(len(hashes), dtype=bool)
        keys[1:] = joined(out[-1][0][:-1], hashes[1:])
        inside[1:] = out[-1][1][:-1] & ~first[1:]
        out.append((keys, inside))
    return out


@dataclass
class Marks:
    """Hashes by their first bits."""

    bits: int
    field: np.ndarray

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> np.uint64(64 - self.bits)
        return (self.field[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def marked(entries: DataFrame) -> Marks:
    """Marks of the column ``key``."""
    bits = int(np.clip(int(np.ceil(np.log2(max(entries.count(), 1) * MARK_BITS))), LEAST_MARKS, MOST_MARKS))
    at = F.shiftrightunsigned("key", 64 - bits)
    bit = F.expr("shiftleft(1L, cast(at & 63 as int))")
    got = entries.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("place")).agg(F.bit_or(bit).alias("bit")).toArrow()
    field = np.zeros(1 << (bits - 6), dtype=np.uint64)
    field[got.column("place").to_numpy()] = got.column("bit").to_numpy().view(np.uint64)
    return Marks(bits, field)


@dataclass
class Level:
    """Of one length the commonest sequences by hash, with their weights, and the marks of all that have one.

    Of words, ``lp`` is the log10 probability without context.
    """

    keys: np.ndarray
    weights: np.ndarray
    lp: np.ndarray | None = None
    marks: Marks | None = None


@dataclass
class Tree:
    """A fitted tree: what is broadcast in ``levels``, the weights of all rarer sequences as a table."""

    tokens: int
    types: int
    levels: list[Level] = field(default_factory=list)
    weights: DataFrame | None = None

    @property
    def mass(self) -> float:
        return self.tokens + 0.5 * (self.types + 1)


# ---- counting and scoring on Spark ------------------------------------------


class Counter:
    """Counts of sequences of one length within a task, sent on when there are many."""

    def __init__(self, length: int):
        self.length, self.parts, self.size = length, [], 0

    def add(self, context: np.ndarray, word: np.ndarray):
        self.parts.append((context, word, np.ones(len(word), dtype=np.int64)))
        self.size += len(word)
        if self.size > HELD_KEYS:
            self._merge()
            if self.size > HELD_KEYS // 2:
                yield from self.flush()

    def _merge(self):
        context, word, counts = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        keys = joined(context, word)
        order = np.argsort(keys)
        keys = keys[order]
        change = np.ones(len(keys), dtype=bool)
        change[1:] = keys[1:] != keys[:-1]
        starts = np.flatnonzero(change)
        at = order[starts]
        counts = np.add.reduceat(counts[order], starts) if len(starts) else counts
        self.parts, self.size = [(context[at], word[at], counts)], len(starts)

    def flush(self):
        if self.parts:
            self._merge()
            context, word, counts = self.parts[0]
            self.parts, self.size = [], 0
            # Equal contexts side by side compress.
            order = np.argsort(context)
            context, word, counts = context[order], word[order], counts[order]
            for at in range(0, len(word), 100_000):
                to = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(context[to].view(np.int64)), pa.array(word[to].view(np.int64)), pa.array(counts[to])],
                    names=["context", "word", "n"],
                )


def counted(texts: DataFrame, lengths: list[int], marks: Marks | None = None) -> DataFrame:
    """``context``, ``word``, ``n``: how often a word ends a sequence of these lengths, after the context of its other words.

    Words alone have the context 0. With ``marks`` of the sequences one word shorter, only of sequences that begin and end with a marked one.
    """

    def count(batches):
        known, counters = WordHashes(), [Counter(n) for n in lengths]
        for batch in batches:
            for step in in_steps(batch):
                hashes, first = token_hashes(_raws(step), known)
                found = sequences(hashes, first, max(lengths))
                for counter in counters:
                    if counter.length == 1:
                        yield from counter.add(np.zeros_like(hashes), hashes)
                        continue
                    (shorter, _), (_, inside) = found[counter.length - 2 : counter.length]
                    if marks is not None:
                        has = marks.has(shorter)
                        inside = inside & has
                        inside[1:] &= has[:-1]
                    at = np.flatnonzero(inside)
                    yield from counter.add(shorter[at - 1], hashes[at])
        for counter in counters:
            yield from counter.flush()

    parts = texts.select("text").mapInArrow(count, "context long, word long, n long")
    return parts.groupBy("context", "word").agg(F.sum("n").alias("n"))


def _raws(step: pa.RecordBatch) -> list[bytes]:
    return [x or b"" for x in step.column("text").cast(pa.binary()).to_pylist()]


def grow(entries: DataFrame, above: DataFrame, discount: float = DISCOUNT, least_gain: float = LEAST_GAIN) -> DataFrame:
    """The next level: entries (``context``, ``word``, ``n``) with smoothed distributions, and which contexts diverge.

    ``above`` has ``key``, ``n``, ``suffix`` and ``lp`` (log10 probability of the last word in
    the tree so far) of the sequences one word shorter. Besides these columns, each entry gets
    ``added``, what it adds to the log probability of its suffix beyond ``rest``, and ``rest``,
    what its context leaves to the suffix; both are 0 if the context is not retained.
    """
    contexts = entries.groupBy("context").agg(F.sum("n").alias("seen"), F.count(F.lit(1)).alias("entries"))
    contexts = contexts.join(
        above.select(F.col("key").alias("context"), F.col("n").alias("total"), F.col("suffix").alias("shorter")), "context"
    )
    left = 1.0 - (F.col("seen") - F.col("entries") * discount) / F.col("total")
    contexts = contexts.select("context", "total", "shorter", left.alias("left"), (F.col("total") - F.col("seen")).alias("unseen"))
    met = entries.join(contexts, "context").select(
        "context", "n", "total", "left", "unseen",
        joined_columns("context", "word").alias("key"), joined_columns("shorter", "word").alias("suffix"),
    )
    met = met.join(above.select(F.col("key").alias("suffix"), F.col("lp").alias("before")), "suffix")
    own = (F.col("n") - discount) / F.col("total") + F.col("left") * F.pow(F.lit(10.0), F.col("before"))
    met = met.select("context", "key", "suffix", "n", "left", "unseen", "before", F.log10(own).alias("lp"))
    rest = F.log10(F.greatest("left", F.lit(1e-300)))
    same = W.partitionBy("context")
    gain = F.sum(F.col("n") * (F.col("lp") - F.col("before"))).over(same) + F.col("unseen") * rest
    kept = gain * float(np.log(10.0)) > F.count(F.lit(1)).over(same) * least_gain
    met = met.withColumn("kept", kept)
    return met.select(
        "context", "key", "n", "suffix",
        F.when(F.col("kept"), F.col("lp")).otherwise(F.col("before")).alias("lp"),
        F.when(F.col("kept"), F.col("lp") - F.col("before") - rest).otherwise(0.0).alias("added"),
        F.when(F.col("kept"), rest).otherwise(0.0).alias("rest"),
    )


def in_parts(df: DataFrame, name: str) -> list[DataFrame]:
    """The rows in ``PARTS`` parts by a hash; shuffle files of one go before the next begins."""
    return [df.where(F.pmod(F.col(name), F.lit(PARTS)) == i) for i in range(PARTS)]


def fit(
    train: DataFrame,
    depth: int = DEPTH,
    head_share: float = HEAD_SHARE,
    least_share: float = LEAST_SHARE,
    least_gain: float = LEAST_GAIN,
) -> tuple[Tree, DataFrame]:
    """A tree, and the table of all words of the training rows (``key``, ``n``, ``rest``).

    What comes to the driver are the commonest words and sequences, whose
    number the share bounds, and the marks.
    """
    lengths = list(range(1, min(depth, 1) + 2))
    counts = stored(counted(train, lengths).where((F.col("context") == 0) | (F.col("n") >= LEAST_COUNT)), "suffix-counts")
    words = counts.where("context = 0").select(F.col("word").alias("key"), "n")
    tokens, types = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tree = Tree(int(tokens), int(types))
    least, common = max(LEAST_COUNT, int(np.ceil(tokens * least_share))), int(np.ceil(tokens * head_share))
    base = F.log10((F.col("n") + 0.5) / F.lit(tree.mass))
    above = words.select("key", "n", F.lit(0).cast("long").alias("suffix"), base.alias("lp"), F.lit(0.0).alias("added"))
    levels, used, marks = [], [counts], None
    for length in range(2, depth + 2):
        if length > 2:
            counts = stored(counted(train, [length], marks).where(F.col("n") >= least), "suffix-counts")
            used.append(counts)
        entries = counts.where((F.col("context") != 0) & (F.col("n") >= least))
        parts = [stored(grow(x, above, least_gain=least_gain), "suffix-level") for x in in_parts(entries, "context")]
        used += parts
        grown = reduce(DataFrame.unionByName, parts)
        levels.append((above, grown))
        above = grown
        if length <= depth:
            marks = marked(grown.select("key"))
    # As a context, a sequence leaves ``rest`` to its suffix wherever a word follows it.
    weighted = []
    for below, grown in [*levels, (above, None)]:
        if grown is None:
            weighted.append(below.select("key", "n", F.col("added").alias("weight")))
            continue
        rests = grown.where("rest <> 0").groupBy("context").agg(F.max("rest").alias("rest"))
        rests = rests.withColumnRenamed("context", "key")
        weight = (F.col("added") + F.coalesce("rest", F.lit(0.0))).alias("weight")
        weighted.append(below.select("key", "n", "added").join(rests, "key", "left").select("key", "n", weight))
    unigrams = stored(weighted[0].withColumnRenamed("weight", "rest"), "suffix-words")
    keys, numbers, rests = _arrays(unigrams.where(F.col("n") >= common), "n", "rest")
    tree.levels.append(Level(keys, rests, np.log10((numbers + 0.5) / tree.mass)))
    rare = []
    for table in weighted[1:]:
        table = stored(table.where("weight <> 0"), "suffix-weights")
        keys, weights = _arrays(table.where(F.col("n") >= common), "weight")
        others = table.where(F.col("n") < common).select("key", "weight")
        tree.levels.append(Level(keys, weights, marks=marked(table)))
        rare.append(others)
    tree.weights = reduce(DataFrame.unionByName, rare) if rare else None
    for table in used:
        dropped(table)
    return tree, unigrams


def _arrays(table: DataFrame, *names: str) -> tuple[np.ndarray, ...]:
    """The column ``key`` in order, and the named ones."""
    got = table.select("key", *names).toArrow()
    keys = got.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], *(got.column(c).to_numpy()[order] for c in names)


def score(docs: DataFrame, tree: Tree, unigrams: DataFrame) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``base_score`` and ``score`` of every row."""
    held = docs.sparkSession.sparkContext.broadcast(tree.levels)

    def run(batches):
        known, levels = WordHashes(), held.value
        for batch in batches:
            for step in in_steps(batch):
                hashes, first = token_hashes(_raws(step), known)
                found = sequences(hashes, first, len(levels))
                starts = np.flatnonzero(first)
                of = np.cumsum(first) - 1
                ids = find(levels[0].keys, hashes, found[0][1])
                base = np.where(ids >= 0, levels[0].lp[ids], 0.0) if len(levels[0].keys) else np.zeros(len(ids))
                lp = base + (np.where(ids >= 0, levels[0].weights[ids], 0.0) if len(levels[0].keys) else 0.0)
                met = []
                for level, (keys, inside) in zip(levels[1:], found[1:], strict=True):
                    at = np.flatnonzero(inside & level.marks.has(keys))
                    keys = keys[at]
                    place = find(level.keys, keys, np.ones(len(keys), dtype=bool))
                    lp[at[place >= 0]] += level.weights[place[place >= 0]]
                    met.append((at[place < 0], keys[place < 0]))
                rare = np.flatnonzero(ids < 0)
                columns = [*_grouped(of[rare], hashes[rare], len(starts))]
                at, keys = (np.concatenate(x) for x in zip(*met, strict=True)) if met else (rare[:0], hashes[:0])
                columns += _grouped(of[at], keys, len(starts))
                yield pa.RecordBatch.from_arrays(
                    [
                        step.column("row"),
                        step.column("doc_id"),
                        pa.array(np.diff(np.append(starts, len(hashes)))),
                        pa.array(np.add.reduceat((ids >= 0).astype(np.int64), starts)),
                        pa.array(np.add.reduceat(base, starts)),
                        pa.array(np.add.reduceat(lp, starts)),
                        *columns,
                    ],
                    names=["row", "doc_id", "n_tokens", "head", "base", "lp", "rare", "times", "longer", "longer_times"],
                )

    narrow = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    parts = stored(
        narrow.mapInArrow(
            run,
            "row long, doc_id long, n_tokens long, head long, base double, lp double, "
            "rare array<long>, times array<int>, longer array<long>, longer_times array<int>",
        ),
        "suffix-parts",
    )
    exploded = lambda keys, times: parts.select("row", F.explode(F.arrays_zip(keys, times)).alias("r")).select(
        "row", F.col(f"r.{keys}").alias("key"), F.col(f"r.{times}").alias("times")
    )
    met = exploded("rare", "times").join(unigrams, "key", "left").select(
        "row", "times", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("rest", F.lit(0.0)).alias("rest")
    )
    added = met.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.col("times") * F.log10((F.col("n") + 0.5) / F.lit(tree.mass))).alias("more"),
        F.sum(F.col("times") * F.col("rest")).alias("rest"),
    )
    out = parts.select("row", "doc_id", "n_tokens", "head", "base", "lp").join(added, "row", "left")
    longer = F.lit(0.0)
    if tree.weights is not None:
        sums, found = [], in_parts(exploded("longer", "longer_times"), "key")
        for mine, weights in zip(found, in_parts(tree.weights, "key"), strict=True):
            met = mine.join(weights, "key").groupBy("row")
            sums.append(stored(met.agg(F.sum(F.col("times") * F.col("weight")).alias("longer")), "suffix-longer"))
        by_row = reduce(DataFrame.unionByName, sums).groupBy("row").agg(F.sum("longer").alias("longer"))
        out, longer = out.join(by_row, "row", "left"), F.coalesce("longer", F.lit(0.0))
    more = F.coalesce("more", F.lit(0.0))
    return out.select(
        "doc_id",
        "n_tokens",
        (F.col("head") + F.coalesce("known", F.lit(0))).cast("long").alias("n_known"),
        (F.col("base") + more).alias("base_score"),
        (F.col("lp") + more + F.coalesce("rest", F.lit(0.0)) + longer).alias("score"),
    )


def _grouped(of: np.ndarray, keys: np.ndarray, size: int) -> tuple[pa.ListArray, pa.ListArray]:
    """The keys of each of ``size`` texts, and how often each occurs there."""
    # One number of the text and the first bits of the key: a key may come in two runs, both are counted.
    bits = np.uint64(max(size, 2).bit_length())
    order = np.argsort((of.astype(np.uint64) << (np.uint64(64) - bits)) | (keys >> bits))
    of, keys = of[order], keys[order]
    change = np.ones(len(order), dtype=bool)
    change[1:] = (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(change)
    offsets = pa.array(np.searchsorted(of[at], np.arange(size + 1)).astype(np.int32))
    times = np.diff(np.append(at, len(order))).astype(np.int32)
    return (
        pa.ListArray.from_arrays(offsets, pa.array(keys[at].view(np.int64))),
        pa.ListArray.from_arrays(offsets, pa.array(times)),
    )


def score_documents(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Scores of every row by a tree of the rows whose id is not held out."""
    held_out = F.coalesce(remainder(F.col("doc_id").cast("long"), 5) == 1, F.lit(False))
    tree, unigrams = fit(docs.where(~held_out).select("text"), depth)
    return score(docs.select("doc_id", "text"), tree, unigrams).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(tree.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
