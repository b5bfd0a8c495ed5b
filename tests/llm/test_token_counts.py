import public_tokenizers
import sentencepiece
from helpers import DATA, LONG, empty_documents, odd_documents, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from pulselake.llm import queries
from pulselake.llm.token_counts import MODEL, PieceEncoder, count_tokens, encoder, token_counts

ENC = encoder(public_tokenizers.path(MODEL))
PLAIN = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))


def test_whole_table(spark):
    got = {r.doc_id: r for r in queries.op1_token_counts(spark, str(DATA)).collect()}
    docs = rows_of("documents")
    assert len(got) == len(docs)
    for d in docs:
        r, text = got[d["doc_id"]], d["text"] or ""
        n = len(PLAIN.encode(text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 4096)


def test_small_chunks_splice_exactly():
    for d in rows_of("documents")[:60]:
        n, splices = count_tokens(ENC, d["text"], chunk=200, overlap=16)
        assert n == len(PLAIN.encode(d["text"]))
        assert splices or len(d["text"]) <= 216


def test_text_without_stable_boundary_widens():
    for text in ("x" * 5000, "ab" * 4000 + " tail", "漢字" * 3000, " " * 4000, "a" * 900 + " " + "b" * 3000):
        assert count_tokens(ENC, text, chunk=256, overlap=8)[0] == len(PLAIN.encode(text))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é漢😀\n\t .<s>▁", min_size=0, max_size=400))
def test_any_text(text):
    assert count_tokens(ENC, text, chunk=20, overlap=2)[0] == len(PLAIN.encode(text))


def test_odd_rows(spark):
    got = sorted(token_counts(odd_documents(spark), chunk=1000, overlap=32).collect(), key=repr)
    assert len(got) == 10
    by_id = {r.doc_id: r for r in got if r.doc_id}
    assert by_id[2].n_tokens == by_id[3].n_tokens == by_id[2].n_bytes == 0
    assert by_id[5].n_tokens == len(PLAIN.encode(LONG)) and by_id[5].over_limit and by_id[5].n_splices > 0
    assert [r.n_tokens for r in got if r.doc_id == 1] == [by_id[1].n_tokens] * 2
    assert token_counts(empty_documents(spark)).count() == 0


def test_marks_of_blanks_and_texts_without_boundary():
    enc = encoder(public_tokenizers.path(MODEL))
    marked = ("some words of a text " * 3000) + "▁ and ▁▁more " + ("words of a text " * 3000)
    n, splices = count_tokens(enc, marked)
    assert n == len(enc.model.encode(marked)) and splices > 3

    encoded = []

    class Counting:
        def encode(self, text):
            encoded.append(len(text))
            return enc.model.encode(text)

    class Watched:
        model, width, stable = Counting(), enc.width, staticmethod(enc.stable)
        ends = PieceEncoder.ends

    work = []
    for size in (100_000, 200_000, 400_000):
        encoded.clear()
        text = "ab" * (size // 2)
        assert count_tokens(Watched(), text)[0] == len(enc.model.encode(text))
        work.append(sum(encoded))
    assert work[1] < 2.6 * work[0] and work[2] < 2.6 * work[1]
