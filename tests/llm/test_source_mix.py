import re
from collections import Counter
from pathlib import Path

import numpy as np
from helpers import empty_documents, odd_documents, rows_of

from pulselake.llm import queries
from pulselake.llm.source_mix import mix, permuted

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    """Sizes by source to targets, by taking the excess away until none is left."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, target, full = sum(sizes.values()), {}, set()
    while True:
        free = [s for s in order if s not in full]
        rest = total - sum(3 * sizes[s] for s in full)
        target = {s: 3.0 * sizes[s] for s in full}
        target |= {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if target[s] > 3 * sizes[s] + 1e-9}
        if not over:
            return target
        full |= over


def check(rows, texts, slack):
    sizes = Counter()
    for source, text in texts:
        sizes[source] += len(WORD.findall(text or ""))
    want = brute_targets(sizes)
    taken, by_source = Counter(), {}
    for r in rows:
        assert r.taken <= 3 * r.size and r.taken >= 0
        by_source.setdefault((r.source_size, round(r.target, 6)), 0)
    got = sorted((r.source_size, round(r.target, 4)) for r in rows)
    assert got == sorted((sizes[s], round(want[s], 4)) for s, _ in texts)
    for r in rows:
        taken[round(r.target, 4)] += r.taken
    for source, target in want.items():
        same = sum(t for s, t in want.items() if round(t, 4) == round(target, 4))
        assert abs(taken[round(target, 4)] - same) <= max(slack, 0.02 * same), source


def test_whole_table_and_reruns(spark):
    folder = Path("/root/testdata/sf0.01")
    one = queries.op9_source_mix(spark, str(folder)).collect()
    docs = rows_of("documents", folder)
    check(one, [(d["source"], d["text"]) for d in docs], 512)
    again = queries.op9_source_mix(spark, str(folder)).repartition(3).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, again))


def test_odd_rows_and_chunks(spark):
    docs = odd_documents(spark)
    texts = [(r.source, r.text) for r in docs.collect()]
    for chunk_rows in (100_000, 2):
        digest, plan = mix(docs, block_words=2, chunk_rows=chunk_rows)
        check(digest.collect(), texts, 4)
        assert plan.selectExpr("count(distinct source, slot) = count(*) as ok").count() == 1
    assert mix(empty_documents(spark))[0].count() == 0


def test_passes_use_every_block_before_a_repeat(spark):
    docs = spark.createDataFrame([(i, "w " * 7, s) for i in range(40) for s in "ab"], "doc_id long, text string, source string")
    digest, plan = mix(docs, block_words=5)
    uses = Counter((r.source, r.block) for r in plan.collect())
    for s in "ab":
        mine = [n for (source, _), n in uses.items() if source == s]
        assert max(mine) - min(mine) <= 1
    assert len({r.shard for r in plan.collect()}) > 10


def test_permutation():
    for n in (1, 2, 3, 7, 64, 1000):
        assert sorted(permuted(np.arange(n), n, "k")) == list(range(n))
    assert list(permuted(np.arange(50), 50, "a")) != list(permuted(np.arange(50), 50, "b"))
