from helpers import DATA, empty_documents, odd_documents, rows_of
from pyspark.sql import functions as F

from pulselake.llm import license_scan, queries
from pulselake.llm.license_scan import (
    NOTICES,
    against_notices,
    calibrated,
    find_licenses,
    may_be_licensed,
    notice_pairs,
    ordinary_words,
    train,
    with_hits,
    words,
)

# The notices that the table holds, each on a line of its own.
PLANTED = {
    "Licensed under CC BY-NC 4.0.": "cc-by-nc",
    "This work is licensed under the GNU General Public License, version 3.": "gpl",
    "Licensed under the Apache License, Version 2.0.": "apache-2.0",
    "Released under the MIT License.": "mit",
    "All rights reserved.": "reserved",
}


def test_whole_table(spark):
    folder = DATA.parent / "sf0.01"
    got = {r.doc_id: r for r in queries.op6_license_scan(spark, str(folder)).collect()}
    docs = rows_of("documents", folder)
    assert len(got) == len(docs)
    for d in docs:
        lines = (d["text"] or "").split("\n")
        assert got[d["doc_id"]].families == ",".join(sorted({PLANTED[x] for x in lines if x in PLANTED}))
        assert got[d["doc_id"]].n_paragraphs == sum(any(c.isalnum() for c in x) for x in lines)
    assert sum(bool(r.families) for r in got.values()) > 10


UNSEEN = [
    ("mit", "This software is released under the MIT license"),
    ("apache-2.0", "Code licensed under the Apache License, Version 2.0 (see LICENSE)"),
    ("gpl", "it is distributed under the terms of the GNU General Public License version 3"),
    ("", "the general public was informed of the version under review"),
    ("", "he released the balloon under the bridge of the town"),
]


def test_unseen_wordings_and_odd_rows(spark):
    texts = [(100 + i, f"some first line of prose\n{t}\nand a last line", "en", "s", 0) for i, (_, t) in enumerate(UNSEEN)]
    texts += [(200 + i, n, "en", "s", 0) for i, n in enumerate(n for ns in NOTICES.values() for n in ns)]
    prose = spark.read.parquet(str(DATA / "documents.parquet")).selectExpr("doc_id + 1000 as doc_id", "text")
    docs = odd_documents(spark, texts).select("doc_id", "text").unionByName(prose)
    rows, found = find_licenses(docs)
    got = rows.collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got}
    assert [by_id[100 + i].families for i in range(len(UNSEEN))] == [f for f, _ in UNSEEN]
    want = [f for f, ns in NOTICES.items() for _ in ns]
    hits = [by_id[200 + i].families == f for i, f in enumerate(want)]
    assert sum(hits) >= len(hits) - 2
    assert by_id[2].n_paragraphs == by_id[3].n_paragraphs == by_id[4].n_licensed == 0
    assert found.where("probability < 0.1 or shared < 0.6").count() == 0
    assert find_licenses(empty_documents(spark))[0].count() == 0


def test_every_ordinary_line_is_learned_from(spark):
    lines = spark.range(6000).selectExpr("concat('the software of town ', id, ' came late') as line")
    candidates = lines.withColumn("words", words(F.col("line")))
    assert ordinary_words(candidates.unionByName(candidates)).count() == 6000


def test_calibration_counts_every_line(spark):
    assert calibrated(spark.range(10_000).selectExpr("id / 10000D as p")) == 0.999401
    assert calibrated(spark.range(10).selectExpr("id / 10D as p")) == 0.900001
    assert calibrated(spark.range(0).selectExpr("id / 10D as p")) == 0.0


def test_words_of_notices_in_lines(spark):
    rows = [("LICENSED", True), ("unlicensed", False), ("(license)", True), ("the of and", False), ("Ünlicense", False), ("agpl3", False)]
    got = spark.createDataFrame(rows, "line string, want boolean").select("want", may_be_licensed(F.col("line")).alias("got"))
    assert all(r.got == r.want for r in got.collect())


def test_many_ordinary_lines_do_not_outweigh_notices(spark, monkeypatch):
    """Lines that weigh a hundred times as much stand for a hundred times as many."""
    monkeypatch.setattr(license_scan, "ORDINARY_WEIGHT", 50.0)
    lines = [(f"the software of town {i} came with version {i * 7 % 900}",) for i in range(2000)] + [("All rights reserved.",)]
    candidates = spark.createDataFrame(lines, "line string").select("line", words(F.col("line")).alias("words"))
    model, least = train(spark, candidates)
    # One vector of coefficients tells notices from the many ordinary lines; families are told apart by the notices alone.
    assert model.notice.coefficientMatrix.numRows == 1
    assert model.family.numClasses == len(NOTICES)
    scored = model.families(model.licensed(license_scan.hashed(candidates)).where(F.col("licensed") >= least))
    assert [(r.line, r.family) for r in scored.collect()] == [("All rights reserved.", "reserved")]


def test_shares_of_pairs_with_notices(spark):
    texts = [n for ns in NOTICES.values() for n in ns] + ["the MIT license of the town", "of the town", "software", ""]
    lines = with_hits(spark.createDataFrame([(x, words_of(x)) for x in texts], "line string, words array<string>"), "test-hits")
    got = lines.select("line", F.array(*[share for _, share in against_notices()]).alias("shares")).collect()
    listed = [set(notice_pairs(n)) for ns in NOTICES.values() for n in ns]
    assert len(got) == len(texts)
    for r in got:
        own = set(notice_pairs(r.line))
        assert r.shares == [len(own & n) / max(min(len(own), len(n)), 1) for n in listed]


def words_of(text):
    return license_scan.notice_words(text)
