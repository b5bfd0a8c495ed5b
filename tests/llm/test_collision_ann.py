import math

import numpy as np
from helpers import DATA, rows_of
from pyspark.sql import functions as F

from pulselake.llm import queries
from pulselake.llm.collision_ann import Block, nearest, threshold


def brute(rows, k=10, every=100):
    good = {
        i: np.array(v, dtype=np.float64)
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    out = {}
    for q in (i for i in good if i % every == 0):
        d = sorted(
            (float(np.sqrt(((good[q] - v) ** 2).sum())), i) for i, v in good.items() if i != q and len(v) == len(good[q])
        )
        out[q] = d[:k]
    return out


def recall(got, want):
    return sum(len({i for _, i in want[q]} & {r.vec_id for r in got if r.query_id == q}) for q in want) / sum(
        map(len, want.values())
    )


def test_recall_and_scores(spark):
    folder = DATA.parent / "sf0.1"
    got = queries.op4_collision_counting_ann(spark, str(folder)).collect()
    rows = [(r["vec_id"], r["embedding"]) for r in rows_of("embeddings", folder)]
    want, vectors = brute(rows), {i: np.array(v, dtype=np.float64) for i, v in rows}
    assert {r.query_id for r in got} == set(want)
    assert recall(got, want) >= 0.95
    for q in want:
        mine = sorted((r.rank, r.score, r.vec_id) for r in got if r.query_id == q)
        assert [r for r, _, _ in mine] == list(range(1, len(want[q]) + 1))
        assert [(s, i) for _, s, i in mine] == sorted((s, i) for _, s, i in mine)
        for _, s, i in mine:
            assert math.isclose(s, float(np.linalg.norm(vectors[q] - vectors[i])), rel_tol=1e-12)


def test_many_blocks(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(900)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest(frame, every=10, block_vectors=120, block_queries=25).collect()
    assert recall(got, brute(rows, every=10)) >= 0.95


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]),
        (4, None), (5, []), (6, [1.0, None]), (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (None, [1.0, 0.5]),
        (9, [1.0, 2.0, 3.0]), (100, [1.0, 2.0, 3.5]), (200, [5.0]), (-100, [2.0, 0.0]), (10, [-1.0, 0.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in nearest(frame).collect())
    want = brute(rows)
    assert got == sorted((q, k + 1, i, s) for q, found in want.items() for k, (s, i) in enumerate(found))
    assert nearest(frame.limit(0)).count() == 0


def test_search_verifies_a_part_of_clustered_vectors():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((40, 32)) * 3
    vectors = np.repeat(centres, 50, axis=0) + 0.3 * rng.standard_normal((2000, 32))
    block = Block(np.arange(2000), vectors)
    ids, _, verified = block.search(-1, vectors[7] + 0.01, 10)
    exact = np.argsort(np.linalg.norm(vectors - vectors[7] - 0.01, axis=1))[:10]
    assert len(set(ids) & set(exact)) >= 9 and verified < 400
    assert 0 < threshold() < 96
