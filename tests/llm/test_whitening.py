import math

import numpy as np
from helpers import DATA, rows_of

from pulselake.llm import queries
from pulselake.llm.whitening import whiten


def brute_force(rows, top=16):
    """Rows by id, n, deviation by row, whitened rows and explained shares of (id, vector) rows."""
    x = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows]
    fit = [list(t) for t in {tuple(v) for _, v in x}]
    n, total = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array(fit, dtype=float) - np.array(total) / n
    values, bases = np.linalg.eigh(centred.T @ centred / n)
    values, bases = values[::-1], bases[:, ::-1]
    k = min(top, int((values > values[0] * 1e-12).sum()))
    white = (np.array([v for _, v in x], dtype=float) - np.array(total) / n) @ (bases[:, :k] / np.sqrt(values[:k]))
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, total, strict=True)) for _, v in x]
    return n, deviation, white, values[:k] / values.sum()


def check(got, rows, top=16):
    n, deviation, white, explained = brute_force(rows, top)
    k = white.shape[1]
    assert len(got) == len(rows) * k
    signs = {}
    by_id = {}
    for r in got:
        by_id.setdefault((r.vec_id, r.component), []).append(r)
    for (vec_id, _), d, w in zip(rows, deviation, white, strict=True):
        for c in range(k):
            r = next(r for r in by_id[vec_id, c + 1] if abs(abs(r.whitened) - abs(w[c])) < 1e-6 and r.deviation == d)
            assert r.n == n and abs(r.explained - explained[c]) < 1e-9 and r.identity_error < 1e-6
            if abs(w[c]) > 1e-6:
                assert signs.setdefault(c, r.whitened * w[c] > 0) == (r.whitened * w[c] > 0)


def test_whole_table_against_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in rows_of("embeddings")]
    check(queries.op12_embedding_whitening(spark, str(DATA)).collect(), rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    good = [(i, rng.normal(size=4).round(2).tolist()) for i in range(40)]
    good += [(100, good[0][1]), (0, good[0][1]), (None, good[1][1])] + [(200 + i, good[2][1]) for i in range(30)]
    bad = [
        (300, None),
        (301, []),
        (302, [1.0, None, 1.0, 1.0]),
        (303, [float("nan"), 1.0, 1.0, 1.0]),
        (304, [float("-inf"), 1.0, 1.0, 1.0]),
        (305, [1e300, 1.0, 1.0, 1.0]),
        (306, [1.0, 2.0]),
    ]
    schema = "vec_id long, embedding array<double>, x int, i string, p int, w int, at int, squares int"
    data = [(*r, 1, "i", 2, 3, 4, 5) for r in good + bad]
    check(whiten(spark.createDataFrame(data, schema)).collect(), good)
    check(whiten(spark.createDataFrame(data, schema), components=2).collect(), good, top=2)
    # A dimension that follows from the others has no component.
    flat = [(i, [v[0], v[1], v[0], 0.5]) for i, v in good]
    got = whiten(spark.createDataFrame([(*r, 1, "i", 2, 3, 4, 5) for r in flat], schema)).collect()
    assert {r.component for r in got} == {1, 2}
    check(got, flat)
    same = spark.createDataFrame([(1, [1.0, 2.0], 1, "", 1, 1, 1, 1)] * 5, schema)
    for none in (same, same.limit(0), spark.createDataFrame([(*r, 1, "i", 2, 3, 4, 5) for r in bad[:4]], schema)):
        assert whiten(none).count() == 0


def test_blocks_and_zero_vectors(spark):
    """More rows than a block holds; the zero vector is a row like others."""
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(2600, 3)))] + [(9999, [0.0, -0.0, 0.0])]
    check(whiten(spark.createDataFrame(rows, "vec_id int, embedding array<float>")).collect(), [
        (i, np.float32(v).astype(float).tolist()) for i, v in rows
    ])
