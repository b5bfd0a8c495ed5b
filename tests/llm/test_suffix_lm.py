import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from helpers import DATA, empty_documents, odd_documents, rows_of

from pulselake.llm import queries, suffix_lm
from pulselake.llm.parity_join import WordHashes
from pulselake.llm.suffix_lm import fit, score, score_documents, token_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), "\n"]


def brute(docs, depth=2, least_share=suffix_lm.LEAST_SHARE, gain=suffix_lm.LEAST_GAIN):
    """Base and tree scores with dictionaries of whole contexts."""
    train = [tokens(t) for d, t in docs if d is None or zlib.crc32(str(d).encode()) % 5 != 1]
    counts = [Counter() for _ in range(depth + 1)]
    for doc in train:
        for k in range(depth + 1):
            counts[k].update(tuple(doc[i : i + k + 1]) for i in range(len(doc) - k))
    n, v = sum(counts[0].values()), len(counts[0])
    least = max(suffix_lm.LEAST_COUNT, math.ceil(n * least_share))
    base = lambda w: (counts[0][(w,)] + 0.5) / (n + 0.5 * (v + 1))
    tree = {}

    def p(context, word):
        while context and context not in tree:
            context = context[1:]
        if not context:
            return base(word)
        own, rest = tree[context]
        return own.get(word, 0.0) + rest * p(context[1:], word)

    for k in range(1, depth + 1):
        found = {}
        for seq, c in counts[k].items():
            if c >= least:
                found.setdefault(seq[:-1], {})[seq[-1]] = c
        new = {}
        for context, own in found.items():
            total = counts[k - 1][context]
            share = {w: (c - suffix_lm.DISCOUNT) / total for w, c in own.items()}
            rest = 1 - sum(share.values())
            g = sum(c * math.log((share[w] + rest * p(context[1:], w)) / p(context[1:], w)) for w, c in own.items())
            g += (total - sum(own.values())) * math.log(max(rest, 1e-300))
            if g > gain * len(own):
                new[context] = (share, rest)
        tree |= new
    out = []
    for d, text in docs:
        doc = tokens(text)
        lp = sum(math.log10(p(tuple(doc[max(0, i - depth) : i]), w)) for i, w in enumerate(doc))
        out.append(
            (d, len(doc), sum(counts[0][(w,)] > 0 for w in doc), n, sum(math.log10(base(w)) for w in doc), lp)
        )
    return out, tree, p


def compare(rows, want):
    rows = sorted(rows, key=lambda r: (repr(r.doc_id), r.n_tokens, round(r.score, 6)))
    want = sorted(want, key=lambda r: (repr(r[0]), r[1], round(r[5], 6)))
    assert len(rows) == len(want)
    for r, w in zip(rows, want, strict=True):
        assert (r.doc_id, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert math.isclose(r.base_score, w[4], rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(r.score, w[5], rel_tol=1e-8, abs_tol=1e-8)


def test_whole_table_and_held_out_gain(spark):
    rows = queries.op10_suffix_tree_scores(spark, str(DATA)).collect()
    want, tree, _ = brute([(d["doc_id"], d["text"]) for d in rows_of("documents")])
    compare(rows, want)
    assert {len(c) for c in tree} == {1, 2}
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1) for r in rows)
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_rare_words_by_join(spark):
    """A head so small that most words take the join."""
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice("abcdefghij") * rng.randrange(1, 4) for _ in range(60))) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    train = frame.where("crc32(string(doc_id)) % 5 <> 1")
    tree, unigrams = fit(train, head_share=0.04, least_share=0.05)
    assert 0 < len(tree.levels[0].keys) < unigrams.count()
    want, _, _ = brute(docs, least_share=0.05)
    got = {r.doc_id: r for r in score(frame, tree, unigrams).collect()}
    for w in want:
        assert got[w[0]].n_known == w[2]
        assert math.isclose(got[w[0]].base_score, w[4], rel_tol=1e-9)
        assert math.isclose(got[w[0]].score, w[5], rel_tol=1e-8)


def test_distributions_sum_to_one():
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choice(["a b c", "a b d", "c a", "d d b"]) for _ in range(30))) for i in range(30)]
    _, tree, p = brute(docs)
    words = {w for _, t in docs for w in tokens(t)}
    for context in [(), *tree]:
        assert math.isclose(sum(p(context, w) for w in words) + p(context, "never seen"), 1.0, rel_tol=1e-9)


def test_odd_rows(spark):
    docs = odd_documents(spark, [(11, "new words only", "", "", 0), (12, "alpha beta gamma delta", "", "", 0)])
    want, _, _ = brute([(r.doc_id, r.text) for r in docs.collect()])
    compare(score_documents(docs).collect(), want)
    assert score_documents(empty_documents(spark)).count() == 0
    lone = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    (row,) = score_documents(spark.createDataFrame([(lone, "a b")], "doc_id long, text string")).collect()
    assert row.held_out and (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and row.score == row.base_score == 0


def test_tokens():
    hashes, first = token_hashes([b"A b\x0bA", b"", b" "], WordHashes())
    assert list(first) == [True, False, False, False, True, True]
    assert hashes[0] == hashes[2] != hashes[1] and len(np.unique(hashes[3:])) == 1


def test_contexts_stay_however_large_the_corpus(spark):
    """Sequences that occur twice among more than two million tokens."""
    rng = random.Random(6)
    train = [i for i in range(99) if zlib.crc32(str(i).encode()) % 5 != 1]
    docs = [(i, " ".join(rng.choices("abcdefgh", k=45_000))) for i in train[:50]]
    docs += [(i, "seldom seen words a b") for i in train[50:52]]
    docs.append((next(i for i in range(99) if i not in train), "some seldom seen words here"))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    want, tree, _ = brute(docs, least_share=0.0)
    assert {("seldom",), ("seldom", "seen")} & set(tree)
    rows = score_documents(frame).collect()
    compare(rows, want)
    held = next(r for r in rows if r.held_out)
    assert held.score > held.base_score + 3
