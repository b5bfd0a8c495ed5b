"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins and has a lookup table of log odds;
the tables are learned by boosting shallow trees over one feature after the
other, round after round. The pairs of features with the largest remaining
gain then get tables of two dimensions, boosted in the same way. A score is
the logistic of a sum of table entries, found by adding up bins in vectors.

The features come from the text alone. The model is fitted on the driver
from at most ``FIT_ROWS`` labelled rows, those with the smallest hash of the
id; features of all rows and all scores are made on the executors.

Results:

* one row for each input row, NULL and repeated ids included; a row with a
  NULL id is not held out and never learned from;
* NULL counts as the empty text and gets the score of an empty text;
* an id that is labelled more than once has the mean of its labels, rounded
  up at one half; NULL labels do not count;
* without any label, or with labels of one kind only, the score is the
  smoothed share of label 1 (one half without labels) for every text;
* an empty table gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from pulselake.llm.common import arrow_map, remainder, stored, texts

FIT_ROWS = 20_000
THRESHOLD = 0.7
FEATURES = (
    "log_bytes", "log_words", "word_length", "upper_share", "digit_share", "symbol_share", "bar_share",
    "distinct_words", "distinct_pairs", "repeated_next", "top_word", "distinct_lines", "stops_per_word",
    "lines_per_word", "marked_words",
)

UPPER_BYTES = np.zeros(256, dtype=bool)
UPPER_BYTES[0x41:0x5B] = True
LOWER_BYTES = np.zeros(256, dtype=bool)
LOWER_BYTES[0x61:0x7B] = True
DIGITS = np.zeros(256, dtype=bool)
DIGITS[0x30:0x3A] = True
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"!#$%&*+/<=>@\\^_`{|}~")] = True
MARKS = frozenset(b"!#$%&*|")


def text_features(raw: bytes) -> list[float]:
    """The features of one text in the order of ``FEATURES``."""
    if not raw:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    words = raw.split()
    n = len(words)
    upper, lower = counts[UPPER_BYTES].sum(), counts[LOWER_BYTES].sum()
    size = len(raw)
    by_word = Counter(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    pairs = len(set(zip(words, words[1:], strict=False)))
    repeated = sum(map(bytes.__eq__, words, words[1:]))
    marked = sum(word[-1] in MARKS for word in words)
    return [
        float(np.log1p(size)),
        float(np.log1p(n)),
        (size - counts[0x20]) / max(n, 1),
        upper / max(upper + lower, 1),
        counts[DIGITS].sum() / size,
        counts[SYMBOLS].sum() / size,
        counts[0x7C] / size,
        len(by_word) / max(n, 1),
        pairs / max(n - 1, 1),
        repeated / max(n - 1, 1),
        max(by_word.values(), default=0) / max(n, 1),
        len(set(lines)) / max(len(lines), 1),
        counts[0x2E] / max(n, 1),
        counts[0x0A] / max(n, 1),
        marked / max(n, 1),
    ]


@dataclass
class AdditiveModel:
    """Lookup tables by feature and by pair of features."""

    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            out += table[np.searchsorted(edges, x[:, j], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            out += table[
                np.searchsorted(self.pair_edges[a], x[:, a], side="right"),
                np.searchsorted(self.pair_edges[b], x[:, b], side="right"),
            ]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.log_odds(x), -30.0, 30.0)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Inner bin edges at quantiles, without repeats."""
    cuts = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="higher"))
    return cuts[cuts > values.min()] if len(values) else cuts


def _gain(g, h, smooth: float):
    return g * g / (h + smooth)


def _line_step(g: np.ndarray, h: np.ndarray, smooth: float) -> np.ndarray:
    """Leaf values, spread over the bins, of a tree with up to three leaves."""
    cuts: list[int] = []
    for _ in range(min(2, len(g) - 1)):
        bounds = [0, *sorted(cuts), len(g)]
        best = (1e-12, None)
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            if hi - lo < 2:
                continue
            left_g, left_h = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
            all_g, all_h = g[lo:hi].sum(), h[lo:hi].sum()
            gains = (
                _gain(left_g, left_h, smooth)
                + _gain(all_g - left_g, all_h - left_h, smooth)
                - _gain(all_g, all_h, smooth)
            )
            at = int(np.argmax(gains))
            if gains[at] > best[0]:
                best = (gains[at], lo + at + 1)
        if best[1] is None:
            break
        cuts.append(best[1])
    out = np.empty(len(g))
    bounds = [0, *sorted(cuts), len(g)]
    for lo, hi in zip(bounds, bounds[1:], strict=False):
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + smooth)
    return out


def _plane_step(g: np.ndarray, h: np.ndarray, smooth: float) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the best cross of one cut in each direction."""
    sg, sh = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    total_g, total_h = sg[-1, -1], sh[-1, -1]
    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)
    quarters = []
    for s, total in ((sg, total_g), (sh, total_h)):
        a = s[:-1, :-1]
        b = s[:-1, -1:] - a
        c = s[-1:, :-1] - a
        quarters.append((a, b, c, total - a - b - c))
    gains = sum(_gain(qg, qh, smooth) for qg, qh in zip(*quarters, strict=True)) - _gain(total_g, total_h, smooth)
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    values = [qg[i, j] / (qh[i, j] + smooth) for qg, qh in zip(*quarters, strict=True)]
    out = np.empty_like(g)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = values
    return float(gains[i, j]), out


def fit(
    x: np.ndarray,
    y: np.ndarray,
    bins: int = 32,
    pair_bins: int = 8,
    n_pairs: int = 5,
    rounds: int = 120,
    pair_rounds: int = 60,
    rate: float = 0.1,
    smooth: float = 2.0,
) -> AdditiveModel:
    """Fit the tables to 0/1 labels by cyclic boosting of the logistic loss."""
    prior = (y.sum() + 1.0) / (len(y) + 2.0)
    model = AdditiveModel(float(np.log(prior / (1 - prior))))
    if len(y) == 0 or y.min() == y.max():
        return model
    model.edges = [_edges(x[:, j], bins) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    binned = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    odds = np.full(len(y), model.intercept)
    for _ in range(rounds):
        for j, at in enumerate(binned):
            p = 1 / (1 + np.exp(-odds))
            n = len(model.tables[j])
            step = rate * _line_step(np.bincount(at, y - p, n), np.bincount(at, p * (1 - p), n), smooth)
            model.tables[j] += step
            odds += step[at]
    model.pair_edges = [_edges(x[:, j], pair_bins) for j in range(x.shape[1])]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.pair_edges)]
    shape = [len(e) + 1 for e in model.pair_edges]

    def plane(a: int, b: int) -> tuple[float, np.ndarray]:
        p = 1 / (1 + np.exp(-odds))
        at, n = coarse[a] * shape[b] + coarse[b], shape[a] * shape[b]
        g, h = np.bincount(at, y - p, n), np.bincount(at, p * (1 - p), n)
        return _plane_step(g.reshape(shape[a], shape[b]), h.reshape(shape[a], shape[b]), smooth)

    candidates = [(a, b) for a in range(len(shape)) for b in range(a + 1, len(shape))]
    gains = sorted(((plane(a, b)[0], a, b) for a, b in candidates), key=lambda c: (-c[0], c[1], c[2]))
    model.pairs = [(a, b) for gain, a, b in gains[:n_pairs] if gain > 0]
    model.pair_tables = [np.zeros((shape[a], shape[b])) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for k, (a, b) in enumerate(model.pairs):
            step = rate * plane(a, b)[1]
            model.pair_tables[k] += step
            odds += step[coarse[a], coarse[b]]
    return model


def features(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the array ``features`` of every row; no shuffle."""

    def extract(batch):
        return {"doc_id": batch.column("doc_id"), "features": [text_features(raw) for raw in texts(batch)]}

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_map(narrow, extract, "doc_id long, features array<double>")


def learn(featured: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> AdditiveModel:
    """A model from the labelled rows that are not held out, ``fit_rows`` at most."""
    marks = (
        labels.where("quality is not null and doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    )
    known = featured.join(marks, "doc_id").where(remainder(F.col("doc_id"), 4) != 2)
    # Each task sends its smallest hashes to the driver; a threshold that some
    # more rows than asked for pass keeps their sum near the limit.
    share = min(1.0, 1.2 * fit_rows / max(known.count(), 1))
    spot = F.xxhash64("doc_id")
    sample = (
        known.where(F.pmod(spot, F.lit(2**30)) < int(share * 2**30))
        .orderBy(F.pmod(spot, F.lit(2**30)), "doc_id", "features")
        .limit(fit_rows)
        .select("features", "quality")
        .toPandas()
    )
    x = np.array(sample["features"].tolist(), dtype=np.float64).reshape(-1, len(FEATURES))
    return fit(x, sample["quality"].to_numpy(dtype=np.float64))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row.

    The text is read once; features are stored in the shared folder and
    serve both the fit and the scores.
    """
    featured = stored(features(docs), "quality-features")
    model = docs.sparkSession.sparkContext.broadcast(learn(featured, labels, fit_rows))

    def score(batch):
        x = batch.column("features").flatten().to_numpy().reshape(-1, len(FEATURES))
        return {"doc_id": batch.column("doc_id"), "score": model.value.score(x)}

    return arrow_map(featured, score, "doc_id long, score double").select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def with_score(docs: DataFrame, labels: DataFrame, name: str = "quality_score", fit_rows: int = FIT_ROWS) -> DataFrame:
    """All columns of ``docs`` and the score of each row, for filters in a pipeline."""
    model = docs.sparkSession.sparkContext.broadcast(learn(features(docs), labels, fit_rows))
    docs = docs.drop(name)

    def score(batches):
        for batch in batches:
            x = np.array([text_features(raw) for raw in texts(batch)]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(model.value.score(x))], names=[*batch.schema.names, name]
            )

    return docs.mapInArrow(score, StructType([*docs.schema.fields, StructField(name, DoubleType())]))
