import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import DATA, LONG, empty_documents, odd_documents, rows_of
from tokenizers import Tokenizer

from pulselake.llm import queries
from pulselake.llm.token_alignment import (
    FIRST,
    SECOND,
    Fragment,
    Tokens,
    align,
    byte_letters,
    chunks,
    compose,
    encoders,
    fragment,
    fragment_of,
    fragment_row,
    result_row,
)


@pytest.fixture(scope="module")
def enc():
    return encoders(FIRST, SECOND)


def brute_force(texts):
    """Groups of each text by a walk over both token lists, and the counts of all links."""
    a_model = Tokenizer.from_file(public_tokenizers.path(FIRST))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(SECOND))
    letters = byte_letters()
    groups_of = []
    for text in texts:
        groups = []
        if text:
            found = a_model.encode(" " + text, add_special_tokens=False)
            a = [(i, bytes(letters[c] for c in a_model.id_to_token(i))) for i in found.ids]
            b = []
            for i in b_model.encode(text):
                piece = b_model.id_to_piece(i)
                b.append((i, bytes([int(piece[3:5], 16)]) if b_model.is_byte(i) else piece.replace("▁", " ").encode()))
            whole = (" " + text).encode()
            if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b):
                at_a = at_b = 0
                left, right, now = iter(a), iter(b), ([], [])
                while at_a < len(whole) or at_b < len(whole):
                    if at_a <= at_b:
                        i, x = next(left)
                        now[0].append(i)
                        at_a += len(x)
                    else:
                        i, x = next(right)
                        now[1].append(i)
                        at_b += len(x)
                    if at_a == at_b:
                        groups.append(now)
                        now = ([], [])
        groups_of.append(groups)
    links = [Counter((x, y) for a, b in groups for x in a for y in b) for groups in groups_of]
    count = Counter(pair for c in links for pair in c)
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for groups, pairs in zip(groups_of, links, strict=True):
        digest = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append(
            (
                sum(len(a) for a, _ in groups),
                sum(len(b) for _, b in groups),
                len(groups),
                sum(pairs.values()),
                sum(n for (x, y), n in pairs.items() if count[x, y] == best[x]),
                sum(n * count[pair] for pair, n in pairs.items()),
                hashlib.sha256(digest.encode()).hexdigest() if groups else "",
            )
        )
    return out


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def found(df):
    return sorted(((r.doc_id, *(r[c] for c in COLUMNS)) for r in df.collect()), key=repr)


def expected(rows):
    return sorted(((i, *b) for (i, _), b in zip(rows, brute_force([t for _, t in rows]), strict=True)), key=repr)


def test_whole_table_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in rows_of("documents")]
    assert found(queries.op11_token_alignment(spark, str(DATA))) == expected(rows)


def test_odd_rows_chunks_and_rare_pairs(spark):
    spaced = " ".join(f"Zahl{i}\nwort  {i % 7}" for i in range(900))
    extra = [
        (20, "a<|endoftext|>b <s>", "en", "a", 1),
        (21, "ab" * 3000, "en", "a", 1),
        (22, spaced, "en", "a", 1),
        (23, spaced + " ", "en", "a", 1),
        (24, spaced + " ▁ " + spaced, "en", "a", 1),
        (25, " lead  and trail \n", "en", "a", 1),
        (26, "日本語 のテキスト " * 400, "ja", "a", 1),
        (27, " thin blank\x1c " * 300, "en", "a", 1),
    ]
    docs = odd_documents(spark, extra)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = expected(rows)
    assert found(align(docs)) == want
    # Small chunks and few pairs held by tasks: the tree and the join do the work.
    assert found(align(docs, chunk=500, fan_in=3, head_pairs=100)) == want
    assert found(align(docs, chunk=50, fan_in=2, head_pairs=0)) == want
    assert align(empty_documents(spark)).count() == 0


def test_composition_is_associative(enc):
    rng = random.Random(3)
    text = "Ünïcode words, der Straße 😀 and 12345 <s> x" * 8
    ids = [np.array(enc.encode_first([" " + text])[0]), np.array(enc.encode_second([text])[0])]
    ends = [np.cumsum(enc.size_a[ids[0]]), np.cumsum(enc.size_b[ids[1]])]
    whole = Tokens(ids[0], ends[0], ids[1], ends[1])
    want = result_row(fragment(whole, enc, at_start=True))
    assert want["n_groups"] > 20
    for _ in range(40):
        # Cut the two lists at unrelated offsets.
        n = rng.randint(2, 9)
        cuts = [[0, *sorted(rng.randint(0, len(x)) for _ in range(n - 1)), len(x)] for x in ids]
        parts = [
            Tokens(ids[0][i:j], ends[0][i:j], ids[1][k:m], ends[1][k:m])
            for (i, j), (k, m) in zip(*(zip(c, c[1:]) for c in cuts), strict=True)
        ]
        pieces = [fragment(p, enc, at_start=i == 0) for i, p in enumerate(parts)]
        while len(pieces) > 1:
            at = rng.randrange(len(pieces) - 1)
            both = compose(pieces[at], pieces[at + 1], enc)
            pieces[at : at + 2] = [fragment_of({k: v for k, v in fragment_row(both).items()})]
        got = result_row(pieces[0])
        assert {k: v for k, v in got.items() if k not in ("pairs", "times")} == {
            k: v for k, v in want.items() if k not in ("pairs", "times")
        }
        assert (got["pairs"] == want["pairs"]).all() and (got["times"] == want["times"]).all()
    assert compose(Fragment(is_valid=False), pieces[0], enc).is_valid is False


def test_chunks_cover_the_text(enc):
    for text in (LONG, "ab" * 5000, LONG + " ", "x \n " * 400):
        parts = chunks(text, enc, 300)
        assert "".join(a for _, a, _, _ in parts) == " " + text
        assert " ".join(b for _, _, _, b in parts) == text
        assert parts[-1][0] + len(parts[-1][1].encode()) == len(text.encode()) + 1
    assert len(chunks(LONG, enc, 300)) > 50
