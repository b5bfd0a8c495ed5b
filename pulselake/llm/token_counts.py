"""Token counts by overlap resynchronisation.

Short texts are encoded as they are. A huge one is cut into overlapping
chunks; each chunk is encoded with the offset of every token, and two
neighbours are spliced at a token boundary that both have and that the
vocabulary proves to be stable: no piece of the vocabulary holds the two
characters around it side by side, so no merge can ever cross it and the
tokens on either side depend on nothing beyond it. If an overlap has no such
boundary, it is widened until there is one or the text ends.

Results:

* one row for each input row, whatever its id (NULL and repeated ids too);
* NULL and empty texts count 0 bytes and 0 tokens;
* an empty table gives an empty table;
* only ``doc_id`` and ``text`` are read, further columns play no part.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselake.llm.common import arrow_map, texts

MODEL = "piece_bpe_32k.model"
CHUNK_CHARS = 16_384
OVERLAP_CHARS = 256
TOKEN_LIMIT = 4096
SPACE = "▁"


class PieceEncoder:
    """A sentencepiece model, with the places where its encoding cannot join."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(size)]
        is_byte = [self.model.is_byte(i) for i in range(size)]
        # Length of each token in bytes of the text; the marked space is one byte there.
        self.width = np.array(
            [1 if b else len(p.replace(SPACE, " ").encode()) for p, b in zip(pieces, is_byte, strict=True)],
            dtype=np.int64,
        )
        self.joined = {
            pair
            for i, p in enumerate(pieces)
            if not is_byte[i] and not self.model.is_control(i)
            for pair in zip(p.replace(SPACE, " "), p.replace(SPACE, " ")[1:], strict=False)
        }

    def ends(self, text: str) -> np.ndarray | None:
        """Byte offsets of the token ends within the text.

        None if the tokens do not spell the text byte by byte, that is if
        the model's normaliser has changed it.
        """
        ids = np.asarray(self.model.encode(text), dtype=np.int64)
        ends = np.cumsum(self.width[ids])
        # The model puts one space before the first character.
        if ids.size and ends[-1] - 1 != len(text.encode()):
            return None
        return ends - 1

    def stable(self, left: str, right: str) -> bool:
        return (left, right) not in self.joined


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def count_tokens(
    enc: PieceEncoder, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS
) -> tuple[int, int]:
    """Number of tokens of the whole text, and of the splices it took."""
    if len(text) <= chunk + overlap:
        return len(enc.model.encode(text)), 0
    # The model takes its mark of a blank for a blank, wherever it stands.
    text = text.replace(SPACE, " ")
    counted, splices = 0, 0
    start = 0  # first character of the chunk at hand
    known = 0  # character up to which tokens are counted
    stop = min(len(text), chunk)
    while True:
        part = text[start:stop]
        ends = enc.ends(part)
        if ends is None:
            return len(enc.model.encode(text)), 0
        # The blank that the model puts first ends at 0 and counts in the first chunk only.
        skipped = len(text[start:known].encode()) if known else -1
        if stop == len(text):
            return counted + int((ends > skipped).sum()), splices
        width = overlap
        while True:
            # The next chunk begins inside this one, by the width of the overlap.
            begin = max(known, stop - width)
            after_stop = min(len(text), begin + chunk + width)
            following = text[begin:after_stop]
            next_ends = enc.ends(following)
            if next_ends is None:
                return len(enc.model.encode(text)), 0
            cut = _common_boundary(enc, text, start, begin, stop, ends, next_ends)
            if cut is not None:
                break
            if begin == known:
                # Nothing stable up to here: the chunk itself becomes twice as long, so the
                # work stays in proportion to the text.
                stop = min(len(text), stop + max(chunk, stop - start))
                cut = -1
                break
            width *= 2
        if cut == -1:
            continue
        until = len(text[start:cut].encode())
        counted += int(((ends > skipped) & (ends <= until)).sum())
        splices += 1
        start, known, stop = begin, cut, after_stop


def _common_boundary(enc, text, start, begin, stop, ends, next_ends) -> int | None:
    """The last character of the overlap at which both chunks end a token, stably."""
    shared = text[begin:stop]
    # Character offsets of the shared part as byte offsets within either chunk.
    sizes = np.fromiter((len(c.encode()) for c in shared), dtype=np.int64, count=len(shared))
    inner = np.concatenate(([0], np.cumsum(sizes)))
    both = np.isin(inner + len(text[start:begin].encode()), ends) & np.isin(inner, next_ends)
    for k in np.flatnonzero(both)[::-1]:
        if 0 < k < len(shared) and enc.stable(shared[k - 1], shared[k]):
            return begin + int(k)
    return None


def token_counts(
    docs: DataFrame,
    model: str = MODEL,
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
    limit: int = TOKEN_LIMIT,
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` and the number of splices of each row.

    One pass over the text, no shuffle. ``model`` names a file of the public
    tokenizer package, which every executor has.
    """

    def count(batch):
        enc = encoder(public_tokenizers.path(model))
        counts = [count_tokens(enc, raw.decode(), chunk, overlap) for raw in texts(batch)]
        return {
            "doc_id": batch.column("doc_id"),
            "n_bytes": batch.column("n_bytes"),
            "n_tokens": [n for n, _ in counts],
            "n_splices": [s for _, s in counts],
        }

    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
    )
    out = arrow_map(narrow, count, "doc_id long, n_bytes long, n_tokens long, n_splices long")
    return out.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "n_splices"
    )
