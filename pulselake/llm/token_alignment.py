"""Alignment of two tokenizers by an associative monoid of fragments.

Both tokenizers spell a text in the same bytes. Byte offsets at which tokens
of both end cut the tokens into groups; every token of one tokenizer links to
every token of the other in its group.

A fragment stands for a stretch of a text. It holds the tokens before its
first common offset (open prefix), what is known of the groups between its
first and last one (closed), and the tokens after the last (open suffix).
Two neighbours compose: suffix and prefix meet, the common offsets among
them close further groups, and the rest stays open. The operation is
associative, and fragments of one token list may even end at other offsets
than those of the other list. So a very long document is cut into chunks that
are encoded by many tasks, and a tree of compositions brings them together.
Chunks begin where the encoding on either side depends on nothing beyond:
the first tokenizer never crosses the begin of white space, and for the second
the vocabulary proves that no piece crosses the blank.

A pair of ids counts the documents that hold it linked. The pairs with the
largest counts, ``HEAD_PAIRS`` at most, are held by every task; all others meet
their counts in a join.

Results:

* one row for each input row, whatever its id (NULL and repeated ids too);
  each row is a document of its own;
* NULL and empty texts, and texts that one of the tokenizers spells in other
  bytes, have zeros and an empty digest;
* an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import os
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from pulselake.llm.common import arrow_map, stored

FIRST = "byte_bpe_50k.json"
SECOND = "piece_bpe_32k.model"
# Texts beyond twice this size are encoded in chunks of about this size.
CHUNK_BYTES = 32_768
TASK_BYTES = 2_000_000
FAN_IN = 8
HEAD_PAIRS = 1_000_000
SPACE = "▁"
EMPTY = np.zeros(0, dtype=np.int64)


# ---- tokenizers -------------------------------------------------------------


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable bytes stand for themselves; the others, in order, for the
    letters from number 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoders:
    """Both tokenizers, the bytes of their tokens and the text of their ids."""

    def __init__(self, first: str, second: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(first)
        self.a.encode_special_tokens = True
        letters = byte_letters()
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in letters for c in token)
            self.bytes_a[i] = bytes(letters[c] for c in token) if known else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=second)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        # Letters that some piece has right before a blank.
        self.before_blank = {
            left
            for i, p in enumerate(pieces)
            if not self.b.is_byte(i) and not self.b.is_control(i)
            for left, right in zip(p, p[1:], strict=False)
            if right in (SPACE, " ")
        }
        self.size_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        self.ids_b = len(self.bytes_b)
        # The text of an id with each separator that may follow it.
        self.texts = [f"{i}{s}" for i in range(max(len(self.bytes_a), self.ids_b)) for s in ",|;"]

    def encode_first(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_second(self, texts: list[str]) -> list[list[int]]:
        return self.b.encode(texts, num_threads=1)

    def spells(self, ids_a: list[int], text_a: bytes, ids_b: list[int], text_b: bytes) -> bool:
        """Whether the tokens of both spell their texts byte by byte."""
        return (
            b"".join(map(self.bytes_b.__getitem__, ids_b)) == text_b
            and b"".join(map(self.bytes_a.__getitem__, ids_a)) == text_a
        )

    def cuts_first(self, text: str, at: int) -> bool:
        """A blank or line feed after something visible begins a new word."""
        return text[at] in " \n" and not text[at - 1].isspace()

    def cuts_second(self, text: str, at: int) -> bool:
        """A blank that no piece holds together with the letter before it."""
        inside = text[at] == " " and text[at - 1] != " " and at + 1 < len(text) and text[at + 1] != " "
        return inside and text[at - 1] not in self.before_blank


@lru_cache(maxsize=2)
def encoders(first: str, second: str) -> Encoders:
    return Encoders(public_tokenizers.path(first), public_tokenizers.path(second))


# ---- fragments --------------------------------------------------------------


@dataclass
class Tokens:
    """Ids of both tokenizers and the byte offset at which each ends."""

    a: np.ndarray = field(default_factory=lambda: EMPTY)
    a_end: np.ndarray = field(default_factory=lambda: EMPTY)
    b: np.ndarray = field(default_factory=lambda: EMPTY)
    b_end: np.ndarray = field(default_factory=lambda: EMPTY)

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(
            np.concatenate((self.a, other.a)),
            np.concatenate((self.a_end, other.a_end)),
            np.concatenate((self.b, other.b)),
            np.concatenate((self.b_end, other.b_end)),
        )

    def split(self, offset: int) -> tuple[Tokens, Tokens]:
        """Tokens that end up to an offset, and those after it."""
        i, j = np.searchsorted(self.a_end, offset, "right"), np.searchsorted(self.b_end, offset, "right")
        return (
            Tokens(self.a[:i], self.a_end[:i], self.b[:j], self.b_end[:j]),
            Tokens(self.a[i:], self.a_end[i:], self.b[j:], self.b_end[j:]),
        )

    def common(self) -> np.ndarray:
        return np.intersect1d(self.a_end, self.b_end, assume_unique=True)


@dataclass
class Closed:
    """Groups that nothing can change any more: counts, text, linked pairs."""

    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    text: str = ""
    pairs: np.ndarray = field(default_factory=lambda: EMPTY)
    times: np.ndarray = field(default_factory=lambda: EMPTY)

    def __add__(self, other: Closed) -> Closed:
        if not (self.n_groups and other.n_groups):
            return self if self.n_groups else other
        pairs, at = np.unique(np.concatenate((self.pairs, other.pairs)), return_inverse=True)
        times = np.zeros(len(pairs), dtype=np.int64)
        np.add.at(times, at, np.concatenate((self.times, other.times)))
        return Closed(
            self.n_a + other.n_a,
            self.n_b + other.n_b,
            self.n_groups + other.n_groups,
            self.n_links + other.n_links,
            self.text + other.text,
            pairs,
            times,
        )


def close(tokens: Tokens, ends: np.ndarray, enc: Encoders) -> Closed:
    """The groups of tokens that end at ``ends``; the last is the end of all of them."""
    if not len(ends):
        return Closed()
    group_a, group_b = np.searchsorted(ends, tokens.a_end), np.searchsorted(ends, tokens.b_end)
    in_a, in_b = np.bincount(group_a, minlength=len(ends)), np.bincount(group_b, minlength=len(ends))
    # Each first token once for every second token of its group.
    repeats = in_b[group_a]
    n_links = int(repeats.sum())
    first_b = np.concatenate(([0], np.cumsum(in_b)))[group_a]
    within = np.arange(n_links) - np.repeat(np.cumsum(repeats) - repeats, repeats)
    linked = np.repeat(tokens.a, repeats) * enc.ids_b + tokens.b[np.repeat(first_b, repeats) + within]
    pairs, times = np.unique(linked, return_counts=True)
    # Ids in order of groups, the first tokenizer's before the second's.
    last_a, last_b = np.append(group_a[1:] != group_a[:-1], True), np.append(group_b[1:] != group_b[:-1], True)
    codes = np.concatenate((tokens.a * 3 + last_a, tokens.b * 3 + 2 * last_b))
    order = np.argsort(np.concatenate((group_a * 2, group_b * 2 + 1)), kind="stable")
    text = "".join(map(enc.texts.__getitem__, codes[order].tolist()))
    return Closed(len(tokens.a), len(tokens.b), len(ends), n_links, text, pairs, times)


@dataclass
class Fragment:
    """Open prefix, closed groups, open suffix; without a common offset all is prefix."""

    prefix: Tokens = field(default_factory=Tokens)
    closed: Closed = field(default_factory=Closed)
    suffix: Tokens = field(default_factory=Tokens)
    is_cut: bool = False
    is_valid: bool = True


def fragment(tokens: Tokens, enc: Encoders, at_start: bool = False) -> Fragment:
    """The fragment of tokens; ``at_start`` says that a group begins with them."""
    ends = tokens.common()
    if not len(ends):
        return Fragment(suffix=tokens, is_cut=True) if at_start else Fragment(prefix=tokens)
    inner, suffix = tokens.split(int(ends[-1]))
    if at_start:
        return Fragment(Tokens(), close(inner, ends, enc), suffix, True)
    prefix, middle = inner.split(int(ends[0]))
    return Fragment(prefix, close(middle, ends[1:], enc), suffix, True)


def compose(left: Fragment, right: Fragment, enc: Encoders) -> Fragment:
    """The fragment of both stretches, one after the other."""
    is_valid = left.is_valid and right.is_valid
    met = fragment((left.suffix if left.is_cut else left.prefix) + right.prefix, enc, at_start=left.is_cut)
    prefix = left.prefix if left.is_cut else met.prefix
    if not right.is_cut:
        return Fragment(prefix, left.closed + met.closed, met.suffix, left.is_cut or met.is_cut, is_valid)
    # The right prefix ends at a common offset, unless the right side begins the text.
    return Fragment(prefix, left.closed + met.closed + right.closed, right.suffix, True, is_valid)


# ---- fragments as rows ------------------------------------------------------

LISTS = ("prefix_a", "prefix_a_end", "prefix_b", "prefix_b_end", "suffix_a", "suffix_a_end", "suffix_b", "suffix_b_end")
FRAGMENT = (
    "row long, doc_id long, part long, is_cut boolean, is_valid boolean, n_a long, n_b long, n_groups long, n_links long, "
    "groups string, pairs array<long>, times array<long>, " + ", ".join(f"{name} array<long>" for name in LISTS)
)


def fragment_row(f: Fragment) -> dict:
    c, p, s = f.closed, f.prefix, f.suffix
    lists = (p.a, p.a_end, p.b, p.b_end, s.a, s.a_end, s.b, s.b_end)
    return {
        "is_cut": f.is_cut, "is_valid": f.is_valid, "n_a": c.n_a, "n_b": c.n_b, "n_groups": c.n_groups,
        "n_links": c.n_links, "groups": c.text, "pairs": c.pairs, "times": c.times, **dict(zip(LISTS, lists, strict=True)),
    }


def fragment_of(row: dict) -> Fragment:
    lists = [np.asarray(row[name], dtype=np.int64) for name in LISTS]
    closed = Closed(
        row["n_a"], row["n_b"], row["n_groups"], row["n_links"], row["groups"],
        np.asarray(row["pairs"], dtype=np.int64), np.asarray(row["times"], dtype=np.int64),
    )
    return Fragment(Tokens(*lists[:4]), closed, Tokens(*lists[4:]), row["is_cut"], row["is_valid"])


RESULT = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


def result_row(f: Fragment) -> dict:
    """Digest of a whole document; anything left open means that the bytes differ."""
    whole = f.is_valid and not len(f.prefix.a) and not len(f.prefix.b) and not len(f.suffix.a) and not len(f.suffix.b)
    c = f.closed if whole else Closed()
    digest = hashlib.sha256(c.text[:-1].encode()).hexdigest() if c.n_groups else ""
    return {
        "n_a": c.n_a, "n_b": c.n_b, "n_groups": c.n_groups, "n_links": c.n_links,
        "groups_sha256": digest, "pairs": c.pairs, "times": c.times,
    }


def columns_of(rows: list[dict]) -> dict:
    return {name: [r[name] for r in rows] for name in (rows[0] if rows else ())}


def encode_tokens(texts_a: list[str], texts_b: list[str], starts: list[tuple[int, int]], enc: Encoders) -> list[Tokens | None]:
    """Tokens of stretches of texts; None where the bytes differ.

    The first kind of stretch holds all its bytes. The second leaves out its
    first blank, which the tokenizer puts there itself.
    """
    out = []
    for a, b, text_a, text_b, (start_a, start_b) in zip(
        enc.encode_first(texts_a), enc.encode_second(texts_b), texts_a, texts_b, starts, strict=True
    ):
        if not enc.spells(a, text_a.encode(), b, b" " + text_b.encode() if text_b or b else b""):
            out.append(None)
            continue
        ids_a, ids_b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        out.append(
            Tokens(ids_a, start_a + np.cumsum(enc.size_a[ids_a]), ids_b, start_b + np.cumsum(enc.size_b[ids_b]))
        )
    return out


def in_steps(batch: pa.RecordBatch, column: str, limit: int = 1_000_000):
    """Slices of a batch with a bounded amount of text each."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    yield batch.slice(start)


# ---- Spark ------------------------------------------------------------------


def aligned_short(docs: DataFrame, first: str, second: str) -> DataFrame:
    """Results of documents that one call encodes."""
    schema = to_arrow_schema(StructType.fromDDL(RESULT))

    def align(batches):
        enc = encoders(first, second)
        for batch in batches:
            if not batch.num_rows:
                continue
            for step in in_steps(batch, "text"):
                raws = [t or "" for t in step.column("text").to_pylist()]
                tokens = encode_tokens([f" {t}" for t in raws], raws, [(0, 0)] * len(raws), enc)
                rows = [
                    result_row(fragment(t, enc, at_start=True) if t is not None and raw else Fragment(is_valid=False))
                    for raw, t in zip(raws, tokens, strict=True)
                ]
                out = {"row": step.column("row"), "doc_id": step.column("doc_id"), **columns_of(rows)}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) if isinstance(out[f.name], list) else out[f.name] for f in schema],
                    schema=schema,
                )

    return docs.mapInArrow(align, RESULT)


CHUNK = "row long, doc_id long, part long, begin_a long, text_a string, begin_b long, text_b string"


def chunks(text: str, enc: Encoders, chunk: int) -> list[tuple[int, str, int, str]]:
    """Begin and text of the stretches of a text (with a blank before it) for either tokenizer.

    Where no cut is possible within a chunk, the next chunk begins later.
    """
    cuts: list[tuple[int, int]] = []
    at = chunk
    while at < len(text):
        i = next((i for i in range(at, len(text)) if enc.cuts_first(text, i)), None)
        j = next((j for j in range(at, len(text)) if enc.cuts_second(text, j)), None)
        if i is None or j is None:
            break
        cuts.append((i, j))
        at = max(i, j) + chunk
    edges = [(-1, -1), *cuts, (len(text), len(text))]
    out, done_a, done_b = [], 0, 0
    for (i, j), (k, m) in zip(edges, edges[1:], strict=False):
        text_a = " " + text[:k] if i < 0 else text[i:k]
        text_b = text[:m] if j < 0 else text[j + 1 : m]
        out.append((done_a, text_a, done_b, text_b))
        done_a += len(text_a.encode())
        done_b += len(text_b.encode()) + 1
    return out


def aligned_long(docs: DataFrame, first: str, second: str, chunk: int, fan_in: int) -> DataFrame:
    """Results of very long documents, encoded by chunks and composed in a tree."""

    def cut(batch):
        enc, out = encoders(first, second), []
        for row, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "text")), strict=True):
            for part, (begin_a, text_a, begin_b, text_b) in enumerate(chunks(text, enc, chunk)):
                out.append(
                    {"row": row, "doc_id": doc_id, "part": part, "begin_a": begin_a, "text_a": text_a, "begin_b": begin_b, "text_b": text_b}
                )
        return columns_of(out)

    def encode(batch):
        enc, rows = encoders(first, second), []
        named = batch.to_pydict()
        starts = list(zip(named["begin_a"], named["begin_b"], strict=True))
        for tokens, part in zip(encode_tokens(named["text_a"], named["text_b"], starts, enc), named["part"], strict=True):
            found = fragment(tokens, enc, at_start=part == 0) if tokens is not None else Fragment(is_valid=False)
            rows.append(fragment_row(found))
        return {**{c: batch.column(c) for c in ("row", "doc_id", "part")}, **columns_of(rows)}

    schema = to_arrow_schema(StructType.fromDDL(FRAGMENT))

    def fold(table: pa.Table) -> pa.Table:
        enc = encoders(first, second)
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        whole = fragment_of(rows[0])
        for r in rows[1:]:
            whole = compose(whole, fragment_of(r), enc)
        out = {"row": rows[0]["row"], "doc_id": rows[0]["doc_id"], "part": rows[0]["part"] // fan_in, **fragment_row(whole)}
        return pa.Table.from_arrays([pa.array([out[f.name]], type=f.type) for f in schema], schema=schema)

    pieces = stored(arrow_map(docs, cut, CHUNK), "align-chunks")
    parts, total = pieces.agg(F.max("part"), F.coalesce(F.sum(F.octet_length("text_a")), F.lit(0))).first()
    # Each task gets about so much text, whichever documents it comes from.
    dealt = pieces.repartition(int(total // TASK_BYTES) + 1, "row", "part")
    level = arrow_map(dealt, encode, FRAGMENT)
    while parts is not None and parts > 0:
        level = level.groupBy("row", F.floor(F.col("part") / fan_in).alias("step")).applyInArrow(fold, FRAGMENT)
        parts //= fan_in

    def finish(batch):
        rows = [result_row(fragment_of(r)) for r in batch.to_pylist()]
        return {"row": batch.column("row"), "doc_id": batch.column("doc_id"), **columns_of(rows)}

    return arrow_map(level, finish, RESULT)


def align(
    docs: DataFrame,
    first: str = FIRST,
    second: str = SECOND,
    chunk: int = CHUNK_BYTES,
    fan_in: int = FAN_IN,
    head_pairs: int = HEAD_PAIRS,
) -> DataFrame:
    """Counts, digest of the groups and strength of the links of every row."""
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    narrow = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    results = aligned_short(narrow.where(size <= 2 * chunk), first, second)
    longer = aligned_long(narrow.where(size > 2 * chunk), first, second, chunk, fan_in)
    found = stored(results.unionByName(longer), "align-documents")
    n_ids_b = encoders(first, second).ids_b
    first_id = F.expr(f"pair div {n_ids_b}")

    counts = stored(
        found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs")), "align-pairs"
    )
    # One row for each id of the first vocabulary at most.
    best = counts.groupBy(first_id.alias("a")).agg(F.max("docs").alias("best"))
    least, is_complete = head_limit(counts, head_pairs)
    head = counts.where(F.col("docs") >= least).toArrow()
    order = np.argsort(head.column("pair").to_numpy())
    shared = docs.sparkSession.sparkContext.broadcast(
        (head.column("pair").to_numpy()[order], head.column("docs").to_numpy()[order], _by_id(best))
    )

    def score(batch):
        known, docs_of, best_of = shared.value
        pairs, times = batch.column("pairs").flatten().to_numpy(), batch.column("times").flatten().to_numpy()
        offsets = np.concatenate(([0], np.cumsum(np.asarray(pc.list_value_length(batch.column("pairs"))))))
        owner = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
        at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
        is_known = known[at] == pairs if len(known) else np.zeros(len(pairs), dtype=bool)
        n = np.where(is_known, docs_of[at], 0) if len(known) else np.zeros(len(pairs), dtype=np.int64)
        is_best = is_known & (n == best_of[pairs // n_ids_b])

        def add(values):
            sums = np.concatenate(([0], np.cumsum(values)))
            return sums[offsets[1:]] - sums[offsets[:-1]]

        rest = np.concatenate(([0], np.cumsum(np.bincount(owner[~is_known], minlength=batch.num_rows)))).astype(np.int32)
        lists = {
            name: pa.ListArray.from_arrays(pa.array(rest), pa.array(values[~is_known]))
            for name, values in (("rest", pairs), ("rest_times", times))
        }
        names = ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
        return {
            **{c: batch.column(c) for c in names},
            "n_best": add(times * is_best),
            "count_sum": add(times * n),
            **lists,
        }

    scored = arrow_map(
        found,
        score,
        "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "n_best long, count_sum long, rest array<long>, rest_times array<long>",
    )
    if is_complete:
        return scored.drop("row", "rest", "rest_times")
    scored = stored(scored, "align-scored")
    rest = scored.select("row", F.explode(F.arrays_zip("rest", "rest_times")).alias("x")).select(
        "row", F.col("x.rest").alias("pair"), F.col("x.rest_times").alias("times")
    )
    met = rest.join(counts, "pair").join(
        F.broadcast(best), first_id == F.col("a")
    )
    more = met.groupBy("row").agg(
        F.sum(F.when(F.col("docs") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("docs")).alias("more_sum"),
    )
    return scored.join(more, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
    )


def head_limit(counts: DataFrame, head_pairs: int) -> tuple[int, bool]:
    """The least count of the pairs that tasks hold, and whether these are all pairs.

    Counts are sorted into bins an eighth of a power of two wide; the driver
    sees one row for each bin.
    """
    bins = counts.groupBy(F.floor(F.log2("docs") * 8).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min("docs").alias("least")
    )
    rows, held, least = sorted(bins.collect(), reverse=True), 0, 1 << 62
    for r in rows:
        if held + r.n > head_pairs:
            return least, False
        held, least = held + r.n, r.least
    return least, True


def _by_id(best: DataFrame) -> np.ndarray:
    rows = best.toArrow()
    out = np.zeros(int(max(rows.column("a").to_numpy(), default=0)) + 1, dtype=np.int64)
    out[rows.column("a").to_numpy()] = rows.column("best").to_numpy()
    return out
