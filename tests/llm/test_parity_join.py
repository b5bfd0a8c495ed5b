import random
import re
from collections import Counter, defaultdict

import numpy as np
from helpers import DATA, empty_documents, odd_documents, rows_of

from pulselake.llm import parity_join, queries
from pulselake.llm.parity_join import BAND, Buckets, limits, may_differ, plan_segments, similarity_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=5):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(docs):
    """(doc_id, set size, component id) by comparing all pairs that share a shingle."""
    sets = [shingles(t) for _, t in docs]
    at = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            at[x].append(i)
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in at[x] if j < i)
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        ids = [x for x in (least.get(find(i)), doc_id) if x is not None]
        least[find(i)] = min(ids, default=None)
    return sorted(((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))), key=repr)


def got(df):
    return sorted(map(tuple, similarity_components(df).collect()), key=repr)


def test_whole_table(spark):
    folder = DATA.parent / "sf0.01"
    rows = sorted(map(tuple, queries.op3_ngram_jaccard_join(spark, str(folder)).collect()), key=repr)
    want = brute([(d["doc_id"], d["text"]) for d in rows_of("documents", folder)])
    assert rows == want
    assert sum(r[0] != r[2] for r in want) > 20


def test_odd_rows(spark):
    docs = odd_documents(spark, [(9, "one two three four", "", "", 0), (8, "ONE two\nthree\x0bfour", "", "", 0)])
    assert got(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert similarity_components(empty_documents(spark)).count() == 0


def crowded(seed):
    """Near copies around drifting bases, shared passages, short texts, and texts next to the threshold."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(25)]
    out = []
    for size in (6, 12, 40, 90):
        base = [word() for _ in range(size)]
        for _ in range(60):
            text = list(base)
            for _ in range(rng.randrange(1 + size // 20 * 2)):
                text[rng.randrange(len(text))] = word()
            if rng.random() < 0.3:
                base = text
            if rng.random() < 0.2:
                text = text[: int(len(text) * rng.uniform(0.8, 1.0))]
            out.append(text)
    for _ in range(120):
        own = [word() for _ in range(rng.randrange(2, 30))]
        out.append([*own, *passage] if rng.random() < 0.5 else [*passage[: rng.randrange(5, 25)], *own])
    out += [[word() for _ in range(rng.randrange(1, 9))] for _ in range(60)] + [["a"], ["a"], ["a", "a"], ["a"] * 9]
    rng.shuffle(out)
    return [(i, " ".join(x)) for i, x in enumerate(out)]


def test_crowded_buckets(spark, monkeypatch):
    for seed, small, times in ((1, 8, 3), (2, 2, 2)):
        monkeypatch.setattr(parity_join, "SMALL_BUCKET", small)
        monkeypatch.setattr(parity_join, "COMMON_TIMES", times)
        docs = crowded(seed)
        frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
        assert got(frame) == brute(docs)


def test_similar_sets_share_a_segment():
    rng = np.random.default_rng(3)
    for n in (*range(1, 30), 40, 64, 200, 433, 1500):
        for _ in range(40):
            m = int(rng.integers(n, n * 100 // 80 + 1))
            shared = next(i for i in range(1, n + 1) if 100 * i >= 80 * (n + m - i))
            pool = rng.integers(0, 2**63, size=n + m - shared, dtype=np.uint64) * np.uint64(2)
            common = np.sort(pool[rng.random(len(pool)) < rng.choice([0, 0.3, 0.9])])
            a, b = np.unique(pool[:n]), np.unique(pool[n - shared :])
            keys, counts = parity_join.segment_keys(np.concatenate((a, b)), np.array([len(a), len(b)]), common)
            assert len(np.intersect1d(keys[: counts[0]], keys[counts[0] :])) >= 1


def test_bands():
    edges = limits(10_000)
    for j in range(len(edges) - 2):
        assert (edges[j + 1] - 1) * 100 // 80 < edges[j + 2]
    assert BAND >= 1.25 and all(a < b for a, b in zip(edges, edges[1:], strict=False))
    assert may_differ(np.array([9]), np.array([9]))[0] == 2
    for band, segments, own, emitted in plan_segments(np.arange(0, 3000)):
        assert (emitted <= own).all() and (own <= segments).all() and (band >= 0).all()
    # By far the most sets emit about three keys for ten shingles in their own band.
    _, _, _, emitted = plan_segments(np.arange(100, 3000))[0]
    assert emitted.sum() < 0.32 * np.arange(100, 3000).sum()


def test_runs_over_batch_limits():
    rng = np.random.default_rng(1)
    keys = np.sort(rng.integers(0, 60, 400))
    rows = np.arange(400)
    for width in (1, 3, 7, 50, 400):
        buckets, pairs, hot = Buckets(), set(), set()
        chunks = [buckets.take(keys[i : i + width], rows[i : i + width]) for i in range(0, 400, width)]
        for h, x, y in [*chunks, buckets.finish()]:
            pairs |= {(a, b) for f, a, b in zip(h, x, y, strict=True) if not f}
            hot |= {(a, b) for f, a, b in zip(h, x, y, strict=True) if f}
        want, want_hot = set(), set()
        for k in np.unique(keys):
            run = rows[keys == k]
            if len(run) > parity_join.SMALL_BUCKET:
                want_hot |= {(k, r) for r in run}
                want |= {(run[0], r) for r in run[1:]}
            else:
                want |= {(a, b) for i, a in enumerate(run) for b in run[i + 1 :]}
        assert pairs == want and hot == want_hot


def test_sets_are_dealt_once_for_both_sides(spark, monkeypatch):
    """Texts are cut and their sets sent once for all pairs; no other exchange before the pairs meet carries sets."""
    plans = []
    stored = parity_join.stored

    def seen(df, purpose, *rest):
        if purpose == "join-links":
            df = df.select("a", "b")
            df.collect()
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, purpose, *rest)

    monkeypatch.setattr(parity_join, "stored", seen)
    docs = crowded(3)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert got(frame) == brute(docs)
    finals = [p.split("== Initial Plan ==")[0] for p in plans]
    finals = [p for p in finals if "EmptyRelation" not in p]
    assert finals
    for final in finals:
        assert "ReusedExchange" in final
        assert final.count("MapInArrow") == 1


def test_copies_met_by_several_tasks_fill_no_bucket(spark, monkeypatch):
    """Each task carries the keys of a copy; only those of one row are dealt out."""
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(3)]
    rows = [(i, texts[i % 3]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(20)
    for limit in (parity_join.BROADCAST_IDS, 0):
        monkeypatch.setattr(parity_join, "BROADCAST_IDS", limit)
        join = parity_join.Join(docs)
        assert join.sets.where("size(dense) > 0").count() > 2 * len(texts)
        assert join.found.where("hot").isEmpty()
        assert got(docs) == brute(rows)


def test_wide_sketches_tell_large_sets_apart(spark):
    """Of large sets the dense sketch is full, so that it tells none apart; the wide one does."""
    rng = random.Random(5)
    base = [rng.randrange(2**62) for _ in range(4300)]
    sets = [base, base[:3990], base[:2000] + [rng.randrange(2**62) for _ in range(2300)], base[:1000], base[200:1400]]
    hashes, counts = np.array([x for s in sets for x in s], dtype=np.uint64), np.array([len(s) for s in sets])
    wide, lengths = parity_join.wide_sketches(hashes, counts)
    ends = np.cumsum(lengths)
    dense = parity_join.dense_sketches(hashes, counts)
    rows = [
        (i, len(s), dense[i].tolist(), wide[ends[i] - lengths[i] : ends[i]].tolist()) for i, s in enumerate(sets)
    ]
    frame = spark.createDataFrame(rows, "i int, n long, dense array<long>, wide array<long>")
    frame = frame.selectExpr("i", "struct(n, dense, wide) as s")
    assert list(lengths) == [256, 128, 256, 0, 64]
    both = frame.toDF("i", "a").crossJoin(frame.toDF("j", "b")).where("i < j")
    told = {
        (r.i, r.j): (r.dense, r.wide)
        for r in both.select(
            "i", "j", parity_join.may_link("a", "b", 80).alias("dense"), parity_join.may_link_wide("a", "b", 80).alias("wide")
        ).collect()
    }
    assert told[0, 1] == (True, True)  # 3990 of 4300 shared, sketches of two lengths
    assert told[0, 2] == (True, False) and told[1, 2] == (True, False)
    assert told[3, 4][1]
