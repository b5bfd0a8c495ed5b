"""N-gram Jaccard join with parity sketches.

A document is the set of its distinct word shingles; two documents link when
their Jaccard similarity reaches the threshold. Copies with the same set form
one class, so links are sought between classes only.

A sketch flips one bit for each shingle, so the Hamming distance of two
sketches never exceeds the symmetric difference of the sets, and a threshold
on the similarity bounds that difference: for 0.8, a ninth of the sum of both
sizes. Sets are joined by bands of size. In a band, the sketch is cut into
about twice as many segments as bits may differ; similar sets agree in all
but so many of them, and a join on the content of segments finds every pair.
What the join finds is checked by the Hamming distance of a second, dense
sketch, of a third that grows with the set where the set is too large for the
second, and then by the sets themselves.

As similar sets agree in many segments, each may leave out all but one of
those that must agree, provided that all sets leave out in the same order.
Segments without a rare shingle go first: shingles that a bounded sample of
the documents holds several times count as common. The sample decides on
speed only; no pair depends on it.

Content shared by many sets is not paired in full. Such a bucket first yields
the pairs with its smallest member, which joins most copies into components.
Afterwards only buckets whose members still lie in several components are
looked at again. Their members are joined once more, by the shingles of which
similar sets must share one: the rare ones first, so that a passage that many
texts hold brings together only texts that are little else. Of what is still
crowded then, members outside the main component of a bucket meet one member
of it, and only those that this does not join meet all others; the join
itself lets through only pairs whose dense sketches are near enough.

Components need no more links than join them: each set is first checked with
one of its partners, and of all other pairs those that still lie in different
components. Links found later join whole components, one node each, so that
the links found before are not gone through again.

Results:

* one row for each input row, NULL and repeated ids included; rows with the
  same id but other texts are nodes of their own;
* a document of fewer words than a shingle is its whole sequence of words;
  NULL, empty and blank texts have the empty set and link with nothing: their
  component is their own id;
* the component id is the smallest id of the rows of the component, NULL only
  if all of them are NULL;
* an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from pulselake.llm.common import fresh, stored
from pulselake.llm.components import apart, connected_components, grown_components

SHINGLE_WORDS = 5
PERCENT = 80
# Ratio of the limits of a band of sizes.
BAND = 1.5
# Buckets of up to so many members yield all their pairs at once.
SMALL_BUCKET = 8
# Segments beyond twice those that may differ.
SPARE = 3
# Documents sampled for common shingles, how often these occur there, and how many are kept.
SAMPLE_DOCS = 10_000
COMMON_TIMES = 3
COMMON_SHINGLES = 500_000
DENSE_BITS = 1024
# Text of one vectorised step, and words remembered by one task.
STEP_BYTES = 4_000_000
KNOWN_WORDS = 200_000
# Wanted documents, and copies whose keys are left out, are broadcast by id up to this number, else joined by a shuffle.
BROADCAST_IDS = 1_000_000

SETS = "row long, doc_id long, n long, c1 long, c2 long, keys array<long>, dense array<long>, wide array<long>"


# ---- sets -------------------------------------------------------------------


class WordHashes(dict):
    """64-bit hashes of words, remembered while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(raws: list[bytes], known: WordHashes, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts in one array, and the number of each text."""
    parts, counts = [], np.zeros(len(raws), dtype=np.int64)
    for i, raw in enumerate(raws):
        words = raw.lower().split()
        if not words:
            continue
        if len(words) < size:
            parts.append(np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], dtype=np.uint64))
            counts[i] = 1
            continue
        hashes = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        n = len(words) - size + 1
        rolled = hashes[:n].copy()
        for k in range(1, size):
            rolled *= np.uint64(0x9E3779B97F4A7C15)
            rolled += hashes[k : k + n]
        rolled = np.unique(mixed(rolled))
        parts.append(rolled)
        counts[i] = len(rolled)
    return (np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)), counts


def in_steps(batch: pa.RecordBatch, limit: int = STEP_BYTES):
    """Slices of a batch with a bounded amount of text each."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0))
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    yield batch.slice(start)


# ---- bands and segments -----------------------------------------------------


def limits(largest: int) -> list[int]:
    """Lower limits of the bands, up to the first beyond ``largest``."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, int(out[-1] * BAND)))
    return out


def may_differ(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Largest symmetric difference of similar sets of these sizes."""
    # |A xor B| <= (1 - t) / (1 + t) * (|A| + |B|)
    return (a + b) * (100 - percent) // (100 + percent)


def plan_segments(n: np.ndarray, percent: int = PERCENT) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For the own band and for the one below: band, its segments, those of each set, and how many it emits.

    A set of size n has the first ``segments_of(n)`` segments of its band. In
    the band below it takes part as the larger of a pair only; it emits
    nothing there if it is too large for that.
    """
    edges = np.array(limits(int(n.max(initial=1))), dtype=np.int64)
    band = np.searchsorted(edges, n, side="right") - 1

    def segments_of(size, most):
        size = np.minimum(size, most)
        return 2 * may_differ(size, size * 100 // percent, percent) + SPARE

    out = []
    for shift in (0, 1):
        j = band - shift
        inside = (j >= 0) & (n > 0)
        j = np.maximum(j, 0)
        least, most = edges[j], edges[j + 1] - 1
        mine = segments_of(n, most)
        # The fewest segments that agree with a similar set, as the smaller of the two ...
        agree = mine - may_differ(n, n * 100 // percent, percent) if shift == 0 else mine
        # ... and as the larger; the smallest partner is the worst but for rounding.
        smallest = np.maximum(-(-n * percent // 100), least)
        for more in range(2 * 9):
            partner = smallest + more
            possible = (partner <= n) & (partner <= most)
            agreed = segments_of(partner, most) - may_differ(partner, n, percent)
            agree = np.where(possible, np.minimum(agree, agreed), agree)
        inside &= smallest <= np.minimum(n, most)
        out.append((j, segments_of(most, most), np.where(inside, mine, 0), np.where(inside, mine - agree + 1, 0)))
    return out


def segment_keys(
    hashes: np.ndarray, counts: np.ndarray, common: np.ndarray, percent: int = PERCENT
) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the segments that each set emits, and their number by set.

    ``common`` are the sorted hashes of common shingles.
    """
    owner = np.repeat(np.arange(len(counts)), counts)
    spot, zobrist = hashes >> np.uint64(32), mixed(hashes ^ np.uint64(0x5851F42D4C957F2D))
    rare = np.ones(len(hashes), dtype=bool)
    if len(common):
        rare = common[np.minimum(np.searchsorted(common, hashes), len(common) - 1)] != hashes
    keys, owners = [], []
    for band, segments, own, emitted in plan_segments(counts, percent):
        where = ((spot * segments[owner].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        inside = where < own[owner]
        starts = np.concatenate(([0], np.cumsum(own)))
        where = (starts[owner] + where)[inside]
        has_rare = np.bincount(where[rare[inside]], minlength=starts[-1]) > 0
        content = np.zeros(starts[-1], dtype=np.uint64)
        np.bitwise_xor.at(content, where, zobrist[inside])
        of = np.repeat(np.arange(len(counts)), own)
        number = np.arange(starts[-1]) - starts[of]
        label = (band[of].astype(np.uint64) << np.uint64(40)) | number.astype(np.uint64)
        key = mixed(content + mixed(label + np.uint64(1)))
        # The same order in every set: with a rare shingle first, then by key.
        order = np.lexsort(((key >> np.uint64(1)) | np.where(has_rare, 0, 1 << 63).astype(np.uint64), of))
        shown = order[(np.arange(len(of)) - starts[of]) < emitted[of]]
        keys.append(key[shown])
        owners.append(of[shown])
    order = np.argsort(np.concatenate(owners), kind="stable")
    return np.concatenate(keys)[order], np.bincount(np.concatenate(owners), minlength=len(counts))


def dense_sketches(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    owner = np.repeat(np.arange(len(counts)), counts)
    at = owner * DENSE_BITS + (hashes & np.uint64(DENSE_BITS - 1)).astype(np.int64)
    bits = np.bincount(at, minlength=len(counts) * DENSE_BITS).astype(np.uint8) & 1
    return np.packbits(bits).view(np.int64).reshape(len(counts), DENSE_BITS // 64)


def wide_sketches(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sketches of at least two bits a shingle, and their lengths; none for sets that the dense sketch tells apart.

    The number of bits is a power of two, so that halves laid over each other
    are the sketch of half as many bits.
    """
    large = counts > DENSE_BITS
    bits = np.where(large, 1 << np.ceil(np.log2(np.maximum(2 * counts, 1))).astype(np.int64), 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    held = large[owner]
    owner, hashes = owner[held], hashes[held]
    at = (np.cumsum(bits) - bits)[owner] + (hashes & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
    parity = np.zeros(int(bits.sum()), dtype=np.uint8)
    np.bitwise_xor.at(parity, at, 1)
    return np.packbits(parity).view(np.int64), bits // 64


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _digests(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    ends = np.cumsum(counts)
    raw = b"".join(
        xxhash.xxh3_128_digest(hashes[end - n : end].tobytes()) for end, n in zip(ends, counts, strict=True)
    )
    return np.frombuffer(raw, dtype=np.int64).reshape(-1, 2)


def common_shingles(docs: DataFrame, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted hashes of shingles that occur in several of at most about ``SAMPLE_DOCS`` documents."""
    share = min(1.0, SAMPLE_DOCS / max(docs.count(), 1))
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(2**30)) < int(share * 2**30)).select("text")

    def shingles(batches):
        known = WordHashes()
        for batch in batches:
            for step in in_steps(batch):
                raws = [x or b"" for x in step.column("text").cast(pa.binary()).to_pylist()]
                hashes, _ = shingle_sets(raws, known, size)
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], names=["shingle"])

    often = (
        sample.mapInArrow(shingles, "shingle long")
        .groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("times"))
        .where(F.col("times") >= COMMON_TIMES)
        .orderBy(F.desc("times"), "shingle")
        .limit(COMMON_SHINGLES)
    )
    return np.sort(often.select("shingle").toArrow().column("shingle").to_numpy().view(np.uint64))


def sketched(docs: DataFrame, frequent: np.ndarray, percent: int = PERCENT, size: int = SHINGLE_WORDS) -> DataFrame:
    """One row for each document; of copies met by one task the first alone carries keys and sketch."""
    schema = to_arrow_schema(StructType.fromDDL(SETS))
    common = docs.sparkSession.sparkContext.broadcast(frequent)

    def sketch(batches):
        known, carried = WordHashes(), set()
        for batch in batches:
            for step in in_steps(batch):
                raws = [x or b"" for x in step.column("text").cast(pa.binary()).to_pylist()]
                hashes, counts = shingle_sets(raws, known, size)
                digests = _digests(hashes, counts)
                fresh = np.zeros(len(raws), dtype=bool)
                for i, digest in enumerate(map(bytes, digests)):
                    if counts[i] and digest not in carried:
                        carried.add(digest)
                        fresh[i] = True
                held = hashes[np.repeat(fresh, counts)]
                key_values, key_counts = segment_keys(held, np.where(fresh, counts, 0), common.value, percent)
                dense = dense_sketches(held, np.where(fresh, counts, 0))
                wide = wide_sketches(held, np.where(fresh, counts, 0))
                yield pa.RecordBatch.from_arrays(
                    [
                        step.column("row"),
                        step.column("doc_id"),
                        pa.array(counts),
                        pa.array(digests[:, 0]),
                        pa.array(digests[:, 1]),
                        _lists(key_values, key_counts),
                        _lists(dense[fresh].reshape(-1), np.where(fresh, DENSE_BITS // 64, 0)),
                        _lists(*wide),
                    ],
                    schema=schema,
                )

    narrow = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    return narrow.mapInArrow(sketch, SETS)


# ---- candidates -------------------------------------------------------------


_NOTHING = (np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))


class Buckets:
    """Runs of equal keys in sorted input, over the limits of batches."""

    def __init__(self):
        self.key, self.members, self.hot = None, _NOTHING[1], False

    def take(self, keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether hot, first and second number: pairs of rows, or (key, row) of hot buckets."""
        starts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
        ends = np.concatenate((starts[1:], [len(keys)]))
        out = [self._edge(keys[0], rows[: ends[0]])]
        if len(starts) > 1:
            out.append(self._inner(keys, rows, starts[1:-1], ends[1:-1]))
            out.append(self._edge(keys[-1], rows[starts[-1] :]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def _edge(self, key: int, rows: np.ndarray):
        """A run that may go on in the next batch."""
        done = self.finish() if key != self.key else _NOTHING
        self.key = key
        if not self.hot:
            self.members = np.concatenate((self.members, rows))
            if len(self.members) <= SMALL_BUCKET:
                return done
            rows, self.hot, self.members = self.members, True, self.members[:1]
        return tuple(np.concatenate(x) for x in zip(done, _hot(key, self.members[0], rows), strict=True))

    def finish(self):
        members, hot = self.members, self.hot
        self.key, self.members, self.hot = None, _NOTHING[1], False
        return _NOTHING if hot or len(members) < 2 else _pairs(members[None, :])

    @staticmethod
    def _inner(keys, rows, starts, ends):
        out, lengths = [_NOTHING], ends - starts
        for n in range(2, SMALL_BUCKET + 1):
            at = starts[lengths == n]
            if len(at):
                out.append(_pairs(rows[at[:, None] + np.arange(n)]))
        for start, end in zip(starts[lengths > SMALL_BUCKET], ends[lengths > SMALL_BUCKET], strict=True):
            out.append(_hot(keys[start], rows[start], rows[start:end]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _pairs(members: np.ndarray):
    a, b = np.triu_indices(members.shape[1], 1)
    first, second = members[:, a].ravel(), members[:, b].ravel()
    return np.zeros(len(first), dtype=bool), first, second


def _hot(key: int, leader: int, rows: np.ndarray):
    others = rows[rows != leader]
    return (
        np.repeat([False, True], [len(others), len(rows)]),
        np.concatenate((np.full(len(others), leader), np.full(len(rows), key))).astype(np.int64),
        np.concatenate((others, rows)).astype(np.int64),
    )


def bucketed(keyed: DataFrame) -> DataFrame:
    """``hot``, ``x``, ``y`` from rows (``key``, ``row``): pairs, and members of hot buckets."""

    def run(batches):
        buckets = Buckets()
        for batch in batches:
            if batch.num_rows:
                yield batch_of(*buckets.take(batch.column("key").to_numpy(), batch.column("row").to_numpy()))
        yield batch_of(*buckets.finish())

    def batch_of(hot, x, y):
        if len(x):
            rows = np.unique(np.stack((hot.astype(np.int64), x, y), axis=1), axis=0)
            hot, x, y = rows[:, 0] > 0, rows[:, 1], rows[:, 2]
        return pa.RecordBatch.from_arrays([pa.array(hot), pa.array(x), pa.array(y)], names=["hot", "x", "y"])

    dealt = keyed.repartition(F.col("key")).sortWithinPartitions("key", "row")
    return dealt.mapInArrow(run, "hot boolean, x long, y long")


def first_members(
    hashes: np.ndarray, counts: np.ndarray, common: np.ndarray, percent: int = PERCENT
) -> tuple[np.ndarray, np.ndarray]:
    """Of each set the members of which similar sets share one, in the order rare, common, then by hash."""
    owner = np.repeat(np.arange(len(counts)), counts)
    is_common = np.zeros(len(hashes), dtype=bool)
    if len(common):
        is_common = common[np.minimum(np.searchsorted(common, hashes), len(common) - 1)] == hashes
    order = np.lexsort((hashes, is_common, owner))
    starts = np.concatenate(([0], np.cumsum(counts)))[:-1]
    # Similar sets share at least this part of either; one member more than the rest meets it.
    kept = np.where(counts > 0, counts - -(-counts * percent // 100) + 1, 0)
    shown = order[(np.arange(len(hashes)) - starts[owner]) < kept[owner]]
    return hashes[shown], kept


def _distance(a: str, b: str) -> Column:
    return F.expr(f"aggregate(zip_with({a}, {b}, (x, y) -> bit_count(x ^ y)), 0, (s, v) -> s + v)")


def _most(a: str, b: str, percent: int) -> Column:
    """The largest symmetric difference with which ``a`` and ``b`` link."""
    return F.floor((F.col(f"{a}.n") + F.col(f"{b}.n")) * (100 - percent) / F.lit(100 + percent))


def may_link(a: str, b: str, percent: int) -> Column:
    """Sizes and dense sketches of the structs ``a`` and ``b`` allow a link."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    sizes = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    return sizes & (_distance(f"{a}.dense", f"{b}.dense") <= _most(a, b, percent))


def may_link_wide(a: str, b: str, percent: int) -> Column:
    """Wide sketches of the structs ``a`` and ``b``, if both have one, allow a link."""
    half = "zip_with(slice({0}, 1, size({0}) div 2), slice({0}, size({0}) div 2 + 1, size({0}) div 2), (x, y) -> x ^ y)"
    wa, wb, most = f"{a}.wide", f"{b}.wide", _most(a, b, percent)
    return (
        F.when(F.expr(f"size({wa}) = 0 or size({wb}) = 0"), True)
        .when(F.expr(f"size({wa}) = size({wb})"), _distance(wa, wb) <= most)
        .when(F.expr(f"size({wa}) = 2 * size({wb})"), _distance(half.format(wa), wb) <= most)
        .when(F.expr(f"size({wb}) = 2 * size({wa})"), _distance(wa, half.format(wb)) <= most)
        .otherwise(True)
    )


# ---- links and components ---------------------------------------------------


class Join:
    """The similarity join of one table of documents."""

    def __init__(self, docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE_WORDS):
        self.docs, self.percent, self.size = docs.select("doc_id", "text"), percent, size
        spark = docs.sparkSession
        self.common = common_shingles(self.docs, size)
        self.sets = stored(sketched(self.docs, self.common, percent, size), "join-sets")
        filled = self.sets.where("n > 0")
        carries = F.size("dense") > 0
        # Copies in one class; its root is the first row that carries the sketch.
        self.classes = stored(
            filled.groupBy("c1", "c2").agg(
                F.min("doc_id").alias("first_id"), F.min(F.when(carries, F.col("row"))).alias("root")
            ),
            "join-classes",
        )
        self.nodes = stored(
            filled.where(carries).join(self.classes, ["c1", "c2"]).select("row", "root", "n", "dense", "wide", "doc_id", "c1", "c2"),
            "join-nodes",
        )
        keyed = self.of_roots(filled.where(carries).select("row", "keys"))
        self.found = self.bucketed(keyed.select(F.explode("keys").alias("key"), "row"))

    def bucketed(self, keyed: DataFrame) -> DataFrame:
        """:func:`bucketed`, stored: its rows are numbers only, so batches are longer."""
        conf, name = keyed.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
        before = conf.get(name)
        conf.set(name, "100000")
        try:
            return stored(bucketed(keyed), "join-buckets")
        finally:
            conf.set(name, before)

    def of_roots(self, rows: DataFrame) -> DataFrame:
        """Of rows that carry keys those of roots: each task that met a copy carries the same keys once more."""
        surplus = self.nodes.where("row <> root").select("row")
        if surplus.count() <= BROADCAST_IDS:
            return rows.join(F.broadcast(surplus), "row", "left_anti")
        return rows.join(self.nodes.where("row = root").select("row"), "row", "left_semi")

    def near(self, pairs: DataFrame) -> DataFrame:
        """Of pairs of roots (``a``, ``b``) those that may link by sizes and sketches, as ``ra`` < ``rb``."""
        ordered = pairs.where("a <> b").select(F.least("a", "b").alias("ra"), F.greatest("a", "b").alias("rb")).distinct()
        ordered = stored(ordered, "join-pairs")
        asked = ordered.select(F.explode(F.array("ra", "rb")).alias("root")).distinct()
        if asked.count() <= BROADCAST_IDS:
            asked = F.broadcast(asked)
        roots = self.nodes.where("row = root").join(asked, "root", "left_semi")
        described = roots.select("root", F.struct("n", "dense", "wide").alias("s"))
        both = ordered.join(described.toDF("ra", "a"), "ra").join(described.toDF("rb", "b"), "rb")
        met = may_link("a", "b", self.percent) & may_link_wide("a", "b", self.percent)
        return stored(both.where(met).select("ra", "rb"), "join-near")

    def joining(self, pairs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
        """The components after all links among pairs of roots (``a``, ``b``).

        ``labels`` are the components found before. Each root is checked with its smallest
        partner first, then all pairs that lie in different components.
        """
        near = self.near(pairs)
        partner = near.unionByName(near.select(F.col("rb").alias("ra"), F.col("ra").alias("rb"))).groupBy("ra").agg(
            F.min("rb").alias("rb")
        )
        stars = stored(
            partner.select(F.least("ra", "rb").alias("ra"), F.greatest("ra", "rb").alias("rb")).distinct(), "join-stars"
        )
        links = self.links(stars)
        labels = stored(connected_components(links), "join-labels") if labels is None else grown_components(labels, links)
        others = near.join(stars, ["ra", "rb"], "left_anti")
        rest = stored(apart(others, labels, "ra", "rb").select("ra", "rb"), "join-rest")
        return labels if rest.isEmpty() else grown_components(labels, self.links(rest))

    def links(self, near: DataFrame) -> DataFrame:
        """Of pairs of roots (``ra``, ``rb``) those that link by their sets, as ``a`` and ``b``."""
        roots = self.nodes.where("row = root")
        asked = near.select(F.explode(F.array("ra", "rb")).alias("root")).distinct()
        wanted = stored(
            roots.join(asked, "root", "left_semi").select("root", "doc_id", "c1", "c2"), "join-wanted"
        )
        # The sets are dealt by class once, for both sides; pairs name the classes of their roots.
        sets = self._sets(wanted)
        shared = F.size(F.array_intersect("sa", "sb"))
        classes = wanted.select("root", "c1", "c2")
        both = (
            near.join(classes.toDF("ra", "a1", "a2"), "ra")
            .join(classes.toDF("rb", "b1", "b2"), "rb")
            .join(sets.toDF("a1", "a2", "sa"), ["a1", "a2"])
            .join(sets.toDF("b1", "b2", "sb"), ["b1", "b2"])
            .select("ra", "rb", shared.cast("long").alias("i"), (F.size("sa") + F.size("sb")).cast("long").alias("s"))
        )
        linked = both.where(F.col("i") * 100 >= (F.col("s") - F.col("i")) * self.percent)
        return stored(linked.select(F.col("ra").alias("a"), F.col("rb").alias("b")), "join-links")

    def _sets(self, wanted: DataFrame, common: np.ndarray | None = None) -> DataFrame:
        """``c1``, ``c2`` and ``members`` (shingle hashes) of the wanted classes, from the texts.

        Rows with the id of a wanted class but another text give their own class besides.

        With the hashes of ``common`` shingles only the first members of each set in the
        order rare, common: so many that similar sets share one of them.
        """
        ids = wanted.select(F.col("doc_id").alias("wanted_id"))
        if wanted.count() <= BROADCAST_IDS:
            ids = F.broadcast(ids)
        texts = self.docs.join(ids, F.col("doc_id").cast("long").eqNullSafe(F.col("wanted_id")), "left_semi").select("text")
        size, percent = self.size, self.percent
        shared = None if common is None else self.docs.sparkSession.sparkContext.broadcast(common)

        def members(batches):
            known = WordHashes()
            for batch in batches:
                for step in in_steps(batch):
                    raws = [x or b"" for x in step.column("text").cast(pa.binary()).to_pylist()]
                    hashes, counts = shingle_sets(raws, known, size)
                    digests = _digests(hashes, counts)
                    if shared is not None:
                        hashes, counts = first_members(hashes, counts, shared.value, percent)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(digests[:, 0]), pa.array(digests[:, 1]), _lists(hashes, counts)],
                        names=["c1", "c2", "members"],
                    )

        return texts.mapInArrow(members, "c1 long, c2 long, members array<long>").dropDuplicates(["c1", "c2"])

    def open_members(self, hot: DataFrame, labels: DataFrame) -> DataFrame:
        """Members (``key``, ``root``, ``label``) of the buckets that hold several components, and the largest, ``main``."""
        named = hot.join(labels.withColumnRenamed("node", "root"), "root", "left")
        named = named.select("key", "root", F.coalesce("label", "root").alias("label"))
        by_label = named.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
        by_key = by_label.groupBy("key").agg(
            F.sum("n").alias("all"), F.max(F.struct("n", "label")).alias("main")
        )
        mixed_keys = by_key.where(F.col("all") > F.col("main.n")).select("key", F.col("main.label").alias("main"))
        return stored(named.join(mixed_keys, "key"), "join-open")

    def all_pairs(self, members: DataFrame) -> DataFrame:
        """Pairs of members of a bucket that lie in different components and may link."""
        described = members.join(
            self.nodes.where("row = root").select("root", F.struct("n", "dense").alias("s")), "root"
        )
        strays = described.where("label <> main").select(
            "key", F.col("root").alias("a"), F.col("label").alias("la"), F.col("s").alias("sa")
        )
        others = described.select(
            F.col("key").alias("same"), F.col("root").alias("b"), F.col("label").alias("lb"), F.col("s").alias("sb"), "main"
        )
        # Two strays meet once, a stray and a member of the main component once.
        once = (F.col("lb") == F.col("main")) | (F.col("a") < F.col("b"))
        met = (F.col("key") == F.col("same")) & (F.col("la") != F.col("lb")) & once & may_link("sa", "sb", self.percent)
        return strays.join(others, met).select("a", "b").distinct()

    def components(self) -> DataFrame:
        """``root`` and ``component``, a number of a root, for every class that links."""
        labels = self.joining(self.found.where("not hot").select(F.col("x").alias("a"), F.col("y").alias("b")))
        hot = self.found.where("hot").select(F.col("x").alias("key"), F.col("y").alias("root"))
        crowd = self.open_members(hot, labels)
        if crowd.isEmpty():
            return labels
        # Once more by the first members of the sets, for all that may still link.
        wanted = crowd.select("root").distinct()
        roots = self.nodes.where("row = root").select("root", "doc_id", "c1", "c2")
        wanted = stored(roots.join(wanted, "root", "left_semi"), "join-wanted")
        first = self._sets(wanted, self.common).join(wanted, ["c1", "c2"])
        found = self.bucketed(first.select(F.explode("members").alias("key"), F.col("root").alias("row")))
        pairs = apart(found.where("not hot").select(F.col("x").alias("a"), F.col("y").alias("b")), labels, "a", "b")
        labels = self.joining(pairs.select("a", "b"), labels)
        hot = found.where("hot").select(F.col("x").alias("key"), F.col("y").alias("root"))
        crowd = self.open_members(hot, labels)
        if crowd.isEmpty():
            return labels
        mains = crowd.where("label = main").groupBy("key").agg(F.min_by("root", F.xxhash64("root")).alias("b"))
        met = crowd.where("label <> main").join(mains, "key").select(F.col("root").alias("a"), "b")
        labels = self.joining(met, labels)
        more = stored(self.all_pairs(self.open_members(hot, labels)), "join-open-pairs")
        return labels if more.isEmpty() else self.joining(more, labels)

    def result(self) -> DataFrame:
        labels = self.components().select(F.col("node").alias("root"), "label")
        named = stored(
            self.classes.join(labels, "root", "left").select("c1", "c2", "first_id", F.coalesce("label", "root").alias("label")),
            "join-named",
        )
        ids = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
        by_class = named.join(ids, "label").select("c1", "c2", "component_id", F.col("label").alias("component"))
        rows = self.sets.select("row", "doc_id", F.col("n").alias("n_shingles"), "c1", "c2")
        filled = rows.where("n_shingles > 0").join(by_class, ["c1", "c2"]).drop("c1", "c2")
        bare = rows.where("n_shingles = 0").select(
            "row", "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("component")
        )
        return filled.select(*bare.columns).unionByName(bare)


def one_of_each(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``docs`` that stay when one row of each component does, all columns kept.

    The row with the smallest id stays (NULL ids last, then in table order);
    rows with the empty set all stay. Decisions go back to the rows by id.
    Only where rows of one id are decided differently, that is where ids
    repeat, their sets are computed again to tell these rows apart.
    """
    join = Join(docs, percent, size)
    rows = stored(join.result(), "join-result")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    first = rows.where("component is not null").groupBy("component").agg(F.min(order)["row"].alias("row"))
    stays = rows.where("component is null").select("row").unionByName(first.select("row"))
    judged = rows.join(stays.withColumn("stays", F.lit(1)), "row", "left").select(
        "row", "doc_id", F.coalesce("stays", F.lit(0)).alias("stays")
    )
    by_id = stored(judged.groupBy("doc_id").agg(F.sum("stays").alias("stay"), F.count(F.lit(1)).alias("all")), "join-by-id")
    gone = by_id.where("stay < all").select(F.col("doc_id").alias("gone_id"))
    if by_id.where("stay < all").count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    same_id = docs["doc_id"].cast("long").eqNullSafe(F.col("gone_id"))
    clear = docs.join(gone, same_id, "left_anti")
    torn = by_id.where("stay > 0 and stay < all").select(F.col("doc_id").alias("gone_id"))
    if torn.isEmpty():
        return clear
    mixed_rows = docs.join(torn, same_id, "left_semi")
    names = [fresh(docs, n) for n in ("c1", "c2", "place")]
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(f"{names[0]} long, {names[1]} long").fields])

    def digest(batches):
        known = WordHashes()
        for batch in batches:
            for step in in_steps(batch):
                raws = [x or b"" for x in step.column("text").cast(pa.binary()).to_pylist()]
                digests = _digests(*shingle_sets(raws, known, size))
                yield pa.RecordBatch.from_arrays(
                    [*step.columns, pa.array(digests[:, 0]), pa.array(digests[:, 1])],
                    names=[*step.schema.names, *names[:2]],
                )

    kept = (
        judged.where("stays = 1")
        .join(torn, F.col("doc_id").eqNullSafe(F.col("gone_id")), "left_semi")
        .join(join.sets.select("row", "c1", "c2"), "row")
        .groupBy(F.col("doc_id").alias("kept_id"), F.col("c1").alias("k1"), F.col("c2").alias("k2"))
        .agg(F.count(F.lit(1)).alias("kept_rows"))
    )
    told = mixed_rows.mapInArrow(digest, schema)
    place = F.row_number().over(W.partitionBy("doc_id", *names[:2]).orderBy("text"))
    told = told.withColumn(names[2], place)
    same = (
        told["doc_id"].cast("long").eqNullSafe(F.col("kept_id"))
        & (told[names[0]] == F.col("k1"))
        & (told[names[1]] == F.col("k2"))
        & (told[names[2]] <= F.col("kept_rows"))
    )
    return clear.unionByName(told.join(kept, same, "left_semi").select(*[told[c] for c in docs.columns]))


def similarity_components(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row."""
    return Join(docs, percent, size).result().select("doc_id", "n_shingles", "component_id")
