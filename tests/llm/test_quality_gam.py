import zlib
from pathlib import Path

import numpy as np
from helpers import DATA, empty_documents, odd_documents, rows_of

from pulselake.llm import queries
from pulselake.llm.quality_gam import FEATURES, fit, score_quality, text_features, with_score


def test_held_out_accuracy(spark):
    folder = Path("/root/testdata/sf0.01")
    got = {r.doc_id: r for r in queries.op8_quality_classifier(spark, str(folder)).collect()}
    assert len(got) == len(rows_of("documents", folder))
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in got}
    assert all(r.held_out == held[i] for i, r in got.items())
    marks = [(r["quality"], got[r["doc_id"]]) for r in rows_of("labels", folder) if held[r["doc_id"]]]
    good, bad = [r.score for q, r in marks if q == 1], [r.score for q, r in marks if q == 0]
    ranked = np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good])
    assert ranked > 0.97
    assert np.mean([r.predicted == q for q, r in marks]) > 0.95
    assert all(r.predicted == (r.score >= 0.7) for r in got.values())


def test_labels_of_held_out_rows_play_no_part(spark):
    docs = spark.read.parquet(str(DATA / "documents.parquet"))
    labels = spark.read.parquet(str(DATA / "labels.parquet"))
    flipped = labels.selectExpr(
        "doc_id", "case when crc32(string(doc_id)) % 4 = 2 then 1 - quality else quality end as quality"
    )
    one, two = (sorted(map(tuple, score_quality(docs, x).collect())) for x in (labels, flipped))
    assert one == two


def test_interaction_is_learned():
    rng = np.random.default_rng(5)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = fit(x, y)
    assert (0, 1) in model.pairs
    assert np.mean((model.score(x) > 0.5) == y) > 0.97


def test_odd_rows(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame(
        [(1, 1), (1, 1), (5, 0), (None, 1), (7, None), (3, 0), (99, 1)], "doc_id long, quality int"
    )
    rows = score_quality(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(not r.held_out for r in rows if r.doc_id is None)
    assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1
    unlabelled = score_quality(docs, labels.limit(0)).collect()
    assert {r.score for r in unlabelled} == {0.5}
    assert score_quality(empty_documents(spark), labels).count() == 0
    kept = with_score(docs, labels)
    assert kept.columns == [*docs.columns, "quality_score"] and kept.count() == docs.count()
    assert len(text_features(b"a")) == len(FEATURES) == len(text_features(b""))
