"""Approximate nearest neighbours by collision counting.

Each of ``PROJECTIONS`` random directions has one sorted array of the
projected vectors. Around a query's own projections, windows grow step by
step with the search radius; a step counts only what the windows take in
anew (virtual rehashing). A vector whose windows have met it in at least
``threshold`` directions is verified: its distance is computed from the
original vectors in double precision. A search ends when its k-th nearest
verified vector lies within the radius, at which vectors that near have
passed the threshold with a known probability, or when all are verified.
There is no limit to the number of candidates.

Vectors are dealt by hash of the id over blocks of bounded size, each with
its own sorted arrays, queries over blocks as well; a task sees one block of
either. The best of each block are merged by query.

Results:

* one row for each query and rank; queries are the ids divisible by
  ``every``; fewer rows where there are fewer candidates;
* vectors that are NULL, empty, all zero, or hold NULL, NaN or infinity take
  no part, nor do rows with a NULL id; vectors meet those of their own length;
* ties go to the smaller id; a query never finds its own id;
* repeated rows count once; an id with several vectors is found at the
  nearest of them and queries with each of them;
* an empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PROJECTIONS = 96
# Width of a window at radius 1, and growth of the radius by step.
WIDTH = 2.7
GROWTH = 1.15
# Standard deviations of the collision count left below its mean at the radius.
SLACK = 2.0
BLOCK_VECTORS = 8192
BLOCK_QUERIES = 1024
NEIGHBOURS = 10
EVERY = 100
SEED = 20_240

FOUND = "query_id long, vec_id long, score double"


def threshold(projections: int = PROJECTIONS) -> int:
    """Collisions that a vector at the radius reaches but for a few per cent of cases."""
    p = math.erf(WIDTH / 2 / math.sqrt(2))
    return max(1, math.floor(projections * p - SLACK * math.sqrt(projections * p * (1 - p))))


def valid(vectors: DataFrame) -> DataFrame:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite & some
    )


class Block:
    """Sorted projections of a block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projections: int = PROJECTIONS):
        self.ids, self.vectors = ids, vectors
        dims = vectors.shape[1]
        self.directions = np.random.default_rng((SEED, dims)).standard_normal((projections, dims))
        spots = vectors @ self.directions.T
        self.order = np.argsort(spots, axis=0, kind="stable").T.astype(np.int32)
        self.sorted = np.take_along_axis(spots.T, self.order, axis=1)
        self.least = threshold(projections)

    def radii(self, query: np.ndarray) -> np.ndarray:
        """Radii from well below the nearest of a few vectors to beyond the farthest possible."""
        some = self.vectors[:: max(1, len(self.ids) // 64)]
        near = np.sqrt(((some - query) ** 2).sum(axis=1))
        first = max(float(np.min(near[near > 0], initial=np.max(near))) / 4, 1e-12)
        last = float(np.linalg.norm(query) + np.linalg.norm(self.vectors, axis=1).max())
        steps = max(1, math.ceil(math.log(max(last / first, 1.0) * 2) / math.log(GROWTH)))
        return first * GROWTH ** np.arange(steps + 1)

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids and distances of the nearest found, and how many were verified."""
        here = self.directions @ query
        n = len(self.ids)
        radii = self.radii(query)
        half = WIDTH / 2 * radii
        low = np.stack([np.searchsorted(s, h - half, side="left") for s, h in zip(self.sorted, here, strict=True)])
        high = np.stack([np.searchsorted(s, h + half, side="right") for s, h in zip(self.sorted, here, strict=True)])
        counts = np.zeros(n, dtype=np.int64)
        distances = np.full(n, np.inf)
        done = self.ids == query_id
        verified = 0
        left = right = low[:, 0]
        for step, radius in enumerate(radii):
            rings = [o[a:b] for o, a, b in zip(self.order, low[:, step], left, strict=True)]
            rings += [o[a:b] for o, a, b in zip(self.order, right, high[:, step], strict=True)]
            left, right = low[:, step], high[:, step]
            counts += np.bincount(np.concatenate(rings), minlength=n)
            fresh = np.flatnonzero((counts >= self.least) & ~done)
            if step == len(radii) - 1:
                fresh = np.flatnonzero(~done)
            if len(fresh):
                distances[fresh] = np.sqrt(((self.vectors[fresh] - query) ** 2).sum(axis=1))
                done[fresh] = True
                verified += len(fresh)
            if done.all() or self._settled(distances, k, radius):
                break
        at = np.flatnonzero(np.isfinite(distances))
        at = at[np.lexsort((self.ids[at], distances[at]))]
        _, first = np.unique(self.ids[at], return_index=True)
        at = at[np.sort(first)][:k]
        return self.ids[at], distances[at], verified

    def _settled(self, distances: np.ndarray, k: int, radius: float) -> bool:
        near = np.flatnonzero(distances <= radius)
        return len(near) >= k and len(np.unique(self.ids[near])) >= k


def _rows(table: pa.Table, id_name: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (id, vector) rows in doubles."""
    ids = table.column(id_name).to_numpy()
    flat = table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    vectors = flat.astype(np.float64).reshape(len(ids), -1)
    keep = np.unique(np.column_stack((ids.view(np.float64), vectors)).view(np.uint64), axis=0, return_index=True)[1]
    keep.sort()
    return ids[keep], vectors[keep]


def nearest(
    vectors: DataFrame,
    k: int = NEIGHBOURS,
    every: int = EVERY,
    block_vectors: int = BLOCK_VECTORS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: the k nearest found of every query."""
    good = valid(vectors)
    asked = good.where(F.col("vec_id") % every == 0)
    n, n_queries = good.agg(F.count(F.lit(1)), F.sum((F.col("vec_id") % every == 0).cast("int"))).first()
    blocks = max(1, -(-n // block_vectors))
    query_blocks = max(1, -(-(n_queries or 0) // block_queries))
    each = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    own = lambda count: F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")
    dims = F.size("embedding").alias("dims")
    left = good.select(dims, own(blocks).alias("block"), each(query_blocks).alias("part"), "vec_id", "embedding")
    right = asked.select(
        dims, each(blocks).alias("block"), own(query_blocks).alias("part"), F.col("vec_id").alias("query_id"), "embedding"
    )

    def search(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out = ([], [], [])
        if vectors.num_rows and queries.num_rows:
            block = Block(*_rows(vectors, "vec_id"))
            for query_id, query in zip(*_rows(queries, "query_id"), strict=True):
                ids, distances, _ = block.search(query_id, query, k)
                out[0].append(np.full(len(ids), query_id))
                out[1].append(ids)
                out[2].append(distances)
        arrays = [np.concatenate(x) if x else np.zeros(0) for x in out]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(a).cast(t) for a, t in zip(arrays, kinds, strict=True)], names=["query_id", "vec_id", "score"])

    keys = ["dims", "block", "part"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, FOUND)
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
