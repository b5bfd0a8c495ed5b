import pytest
from helpers import DATA, empty_documents, odd_documents
from pyspark.sql import functions as F
from test_decontamination import brute as leaks
from test_parity_join import brute as groups
from test_parity_join import shingles
from test_secret_ledger import brute as secrets
from test_source_mix import check

import corpus_pipeline as pipeline
from pulselake.llm import quality_gam
from pulselake.llm.common import prepare, table
from pulselake.llm.parity_join import one_of_each

FOLDER = DATA.parent / "sf0.01"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What each stage gets and gives, over a whole table."""
    base, docs, out = tmp_path_factory.mktemp("pipeline"), table(spark, str(FOLDER), "documents"), {}
    for name, stage in pipeline.STAGES:
        stage(spark, docs, str(FOLDER)).write.parquet(str(base / name))
        out[name] = (docs.collect(), spark.read.parquet(str(base / name)).collect())
        docs = spark.read.parquet(str(base / name))
    return out


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_stage_order_and_columns(steps):
    assert [n for n, _ in pipeline.STAGES] == list(steps)
    for name, (given, kept) in list(steps.items())[:-1]:
        assert kept[0].__fields__ == given[0].__fields__, name
        same = {r.doc_id: r for r in given}
        if name != "mask_secrets":
            assert all(r == same[r.doc_id] for r in kept)


def test_quality(spark, steps):
    given, kept = steps["quality"]
    scores = quality_gam.score_quality(table(spark, str(FOLDER), "documents"), table(spark, str(FOLDER), "labels"))
    assert ids(kept) == sorted(r.doc_id for r in scores.collect() if r.predicted)
    assert 0.5 * len(given) < len(kept) < len(given)


def test_one_of_each_group_stays(steps):
    given, kept = steps["near_duplicates"]
    want = groups([(r.doc_id, r.text) for r in given])
    assert ids(kept) == sorted({c for _, _, c in want})
    assert len(kept) < len(given)


def test_no_passage_of_the_benchmark_stays(spark, steps):
    given, kept = steps["decontaminate"]
    items = [(r.item_id, r.text) for r in table(spark, str(FOLDER), "benchmark").collect()]
    want = [r[0] for r in leaks([(r.doc_id, r.text) for r in given], items) if not r[5]]
    assert ids(kept) == sorted(want) and len(kept) < len(given)


def test_secrets_are_masked(steps):
    given, kept = steps["mask_secrets"]
    assert ids(kept) == ids(given)
    before = {r.doc_id: r for r in given}
    for r in kept:
        if secrets(before[r.doc_id].text):
            assert secrets(r.text) == "" and r.n_chars == len(r.text)
        else:
            assert r == before[r.doc_id]


def test_mix(spark, steps):
    given, kept = steps["mix_sources"]
    check(kept, [(r.source, r.text) for r in given], 512)
    assert sorted(map(tuple, pipeline.run(spark, str(FOLDER)).collect())) == sorted(map(tuple, kept))


def test_odd_rows(spark):
    docs = odd_documents(
        spark, [(7, "one", "", "", 0), (7, "token=abcdefgh1 other text", "x", "y", 26), (1, "alpha Beta gamma delta epsilon zeta eta theta", "", "", 0)]
    ).withColumns({"spans": F.lit("s"), "quality_score": F.lit("q"), "c1": F.lit(1)})
    prepare(spark)
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(DATA))
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        out.collect()
        assert stage(spark, docs.limit(0), str(DATA)).count() == 0
    assert pipeline.mix_sources(spark, docs, str(DATA)).count() == docs.count()
    assert pipeline.near_duplicates(spark, empty_documents(spark), str(DATA)).count() == 0
    kept = one_of_each(docs).collect()
    given = docs.collect()
    # Rows with words: one of each set remains here, as no two sets are merely similar.
    assert sorted(map(repr, {frozenset(shingles(r.text)) for r in given if shingles(r.text)})) == sorted(
        repr(frozenset(shingles(r.text))) for r in kept if shingles(r.text)
    )
    assert sum(not shingles(r.text) for r in kept) == sum(not shingles(r.text) for r in given)
    masked = {(r.doc_id, r.text, r.n_chars) for r in pipeline.mask_secrets(spark, docs, str(DATA)).collect()}
    assert (7, "[assign] other text", 19) in masked
