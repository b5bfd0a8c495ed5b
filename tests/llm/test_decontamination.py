import hashlib
import re

from helpers import DATA, empty_documents, odd_documents, rows_of

from pulselake.llm import queries
from pulselake.llm.decontamination import find_leaks

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    windows = []
    for item_id, text in items:
        w = words(text)
        windows += [(item_id, w[i : i + 10]) for i in range(max(1, len(w) - 9)) if w]
    out = []
    for doc_id, text in docs:
        w = words(text)
        at = {}
        for i, x in enumerate(w):
            at.setdefault(x, []).append(i)
        hit, ids = set(), set()
        for item_id, window in windows:
            for i in at.get(window[0], ()):
                if w[i : i + len(window)] == window:
                    hit |= set(range(i, i + len(window)))
                    ids |= {str(item_id)} if item_id is not None else set()
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(ids), digest, bool(hit)))
    return sorted(out, key=repr)


def test_whole_table(spark):
    got = queries.op2_benchmark_decontamination(spark, str(DATA)).collect()
    want = brute(
        [(d["doc_id"], d["text"]) for d in rows_of("documents")],
        [(b["item_id"], b["text"]) for b in rows_of("benchmark")],
    )
    assert sorted(map(tuple, got), key=repr) == want
    assert any(r[5] for r in want)


ITEMS = [
    (1, "alpha BETA gamma, delta"),
    (1, "alpha BETA gamma, delta"),
    (12, "zeta eta"),
    (2, "zeta eta"),
    (None, "theta"),
    (3, None),
    (4, ".,;"),
    (5, "word1 number7919 word2 number5 word3 number6"),
    (6, "ünïcode äö"),
]


def flat(df):
    return sorted(
        (
            (r.doc_id, r.leak.n_words, r.leak.n_hit, r.leak.n_items, r.leak.items_sha256, r.leak.n_hit > 0)
            for r in df.collect()
        ),
        key=repr,
    )


def test_odd_rows_and_shards_agree(spark):
    docs = odd_documents(spark, [(8, "x word1 Number910 word2 number820", "en", "z", 3)])
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], ITEMS)
    assert flat(find_leaks(docs, items)) == want
    assert flat(find_leaks(docs, items, shard_bytes=20)) == want


def test_spans_are_offsets_of_the_original(spark):
    text = "Éa 😀 Alpha--beta. GAMMA delta!"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    (row,) = find_leaks(docs, items).collect()
    assert [text[s.start : s.end] for s in row.leak.spans] == ["Alpha--beta. GAMMA"]


def test_empty(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert find_leaks(empty_documents(spark), items).count() == 0
    assert all(not r[5] for r in flat(find_leaks(odd_documents(spark), items.limit(0))))
