"""Quality of texts by a factorisation machine over hashed words, structure statistics and metadata.

Every feature has a weight and a short vector; a pair of features counts by the product of their vectors.  The sum
over all pairs is half the difference of the squared sum of vectors and the sum of their squares, so scoring takes
time in proportion to the features of a text.  Words are hashed to buckets, so the model has one size on any corpus.
"""

from __future__ import annotations

import operator
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelift.llm.common import Memo

#: Buckets of words; bins of each statistic; length of the vector of a feature.
BUCKETS, BINS, RANK = 4096, 12, 8
#: Labelled documents the machine is fitted on: with BUCKETS, the bound of what comes to the driver.
LABELLED_ROWS = 6_000
EPOCHS, BATCH, RATE, DECAY = 12, 256, 0.02, 1e-4
#: Share of the weight of a text that its words have beside its statistics.
WORDS_WEIGHT = 2.0

FOLDS = 5

SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
#: Kinds of bytes whose share of a text, or number a word, is a statistic.
UPPER, LOWER, DIGITS = slice(65, 91), slice(97, 123), slice(48, 58)

#: The statistics of ``Reader.statistics``, in order; the last two come from metadata.
STATISTICS = (
    "words", "word_bytes", "upper", "digits", "symbols", "bars", "exclamations", "stops", "commas", "other_signs", "beyond_ascii",
    "lines", "distinct_lines", "distinct_words", "top_word", "doubled_words", "stated_chars", "stated_share",
)


class Reader:
    """Features of texts: weights of word buckets, and statistics."""

    def __init__(self):
        self.bucket = Memo(lambda word: zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % BUCKETS)

    def words(self, text: str) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Buckets, the damped counts in them at a Euclidean length of one, and the words."""
        words = text.split()
        counts = np.bincount(np.fromiter(map(self.bucket.__getitem__, words), np.int64, len(words)), minlength=1)
        found = np.flatnonzero(counts)
        weights = np.log1p(counts[found])
        return found, weights / max(1.0, np.sqrt(weights @ weights)), words

    def statistics(self, text: str, words: list[str], n_chars: int | None) -> list[float]:
        """One number each of STATISTICS; those without a meaning (no words, no metadata) are NaN."""
        counts = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
        total, n = int(counts.sum()), len(words)
        stated = [np.nan, np.nan] if n_chars is None else [np.log1p(max(0, n_chars)), n_chars / (len(text) + 1)]
        if not n:
            return [0.0, *[np.nan] * (len(STATISTICS) - 3), *stated]
        upper, lower, digits = (int(counts[kind].sum()) for kind in (UPPER, LOWER, DIGITS))
        beyond = int(counts[128:].sum())
        symbols = int(counts[SYMBOLS].sum())
        white = int(counts[[9, 10, 11, 12, 13, 32]].sum())
        bars, calls, stops, commas = (int(counts[ord(c)]) for c in "|!.,")
        other = total - upper - lower - digits - beyond - symbols - white - calls - stops - commas
        lines = [line for line in text.split("\n") if line]
        distinct = set(words)
        doubled = sum(map(operator.eq, words, words[1:]))
        return [
            np.log1p(n), (total - white) / n, upper / (upper + lower + 1), digits / total, symbols / n, bars / n, calls / n, stops / n, commas / n,
            other / n, beyond / total, len(lines) / n, len(set(lines)) / len(lines), len(distinct) / n, self.top(words, distinct) / n, doubled / n, *stated,
        ]

    @staticmethod
    def top(words: list[str], distinct: set[str]) -> int:
        """How often the most frequent word occurs."""
        if len(distinct) == len(words):
            return 1
        counts: dict[str, int] = {}
        for word in words:
            counts[word] = counts.get(word, 0) + 1
        return max(counts.values())

    def read(self, text: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray, list[float]]:
        found, weights, words = self.words(text or "")
        return found, weights, self.statistics(text or "", words, n_chars)


@dataclass(frozen=True)
class Machine:
    """A factorisation machine: edges of the bins of statistics, then bias, weights and vectors of all features."""

    edges: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def bins(self, statistics: np.ndarray) -> np.ndarray:
        """The feature number of every statistic of every row; NaN has a bin of its own."""
        out = np.empty(statistics.shape, np.int64)
        for k, edges in enumerate(self.edges):
            column = statistics[:, k]
            out[:, k] = BUCKETS + k * (BINS + 1) + np.where(np.isnan(column), BINS, np.searchsorted(edges, column, side="right"))
        return out

    def score(self, found: np.ndarray, weights: np.ndarray, bins: np.ndarray, squares: np.ndarray) -> float:
        """Probability of label 1, by the sum-of-squares identity; ``squares``: the squared lengths of the vectors."""
        places = np.concatenate([found, bins])
        values = np.concatenate([weights * WORDS_WEIGHT, np.ones(len(bins))])
        spread = values @ self.vectors[places]
        z = self.bias + values @ self.weights[places] + 0.5 * (spread @ spread - (values * values) @ squares[places])
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def bin_edges(statistics: np.ndarray) -> np.ndarray:
    """Quantiles of every statistic: BINS - 1 edges each."""
    edges = np.zeros((len(STATISTICS), BINS - 1))
    for k in range(len(STATISTICS)):
        column = statistics[:, k][~np.isnan(statistics[:, k])]
        if len(column):
            edges[k] = np.quantile(column, np.arange(1, BINS) / BINS)
    return edges


def fitted(rows: list[tuple[np.ndarray, np.ndarray, list[float]]], labels: np.ndarray, seed: int = 7) -> Machine:
    """A machine by Adam on the logistic loss of (buckets, weights, statistics); without rows it scores 1/2."""
    statistics = np.array([r[2] for r in rows], float).reshape(-1, len(STATISTICS))
    size = BUCKETS + len(STATISTICS) * (BINS + 1)
    rng = np.random.default_rng(seed)
    share = (labels.sum() + 1) / (len(labels) + 2)
    start = Machine(bin_edges(statistics), float(np.log(share / (1 - share))), np.zeros(size), rng.normal(0, 0.02 if rows else 0.0, (size, RANK)))
    bins = start.bins(statistics)
    # one array: bias, weight and vector of every feature, the bias as that of a feature all rows have
    theta = np.zeros((size + 1, RANK + 1), np.float32)
    theta[0, 0] = start.bias
    theta[1:, 1:] = start.vectors
    mean, square, step = np.zeros_like(theta), np.zeros_like(theta), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for first in range(0, len(rows), BATCH):
            chosen = order[first : first + BATCH]
            x = np.zeros((len(chosen), size + 1), np.float32)
            x[:, 0] = 1
            for n, row in enumerate(chosen.tolist()):
                x[n, 1 + rows[row][0]] = rows[row][1] * WORDS_WEIGHT
                x[n, 1 + bins[row]] = 1
            weights, vectors = theta[:, 0], theta[:, 1:].copy()
            vectors[0] = 0
            spread, squared = x @ vectors, x * x
            z = x @ weights + 0.5 * ((spread**2).sum(1) - squared @ (vectors**2).sum(1))
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[chosen]) / len(chosen)
            gradient = np.empty_like(theta)
            gradient[:, 0] = x.T @ error
            gradient[:, 1:] = x.T @ (error[:, None] * spread) - vectors * (squared.T @ error)[:, None]
            gradient[1:] += DECAY * theta[1:]
            gradient[0, 1:] = 0
            step += 1
            mean += 0.1 * (gradient - mean)
            square += 0.001 * (gradient**2 - square)
            theta -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Machine(start.edges, float(theta[0, 0]), theta[1:, 0].astype(float), theta[1:, 1:].astype(float))


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo five; a null id is in no fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def read_columns(docs: DataFrame) -> list[Column]:
    n_chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), n_chars.alias("n_chars")]


def labelled_features(docs: DataFrame, labels: DataFrame, label: str, most: int) -> tuple[list, np.ndarray]:
    """Features and labels of at most ``most`` labelled documents outside fold 0, the same ones in every run.

    Documents are chosen by a hash of their id, so no task sorts all labels.  Of several labels of an id the largest holds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            rows = [reader.read(t, n) for t, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(3), batch.column(4), pa.array([r[0].astype("<u2").tobytes() for r in rows], pa.binary()),
                 pa.array([r[1].astype("<f4").tobytes() for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.list_(pa.float64()))],
                names=["y", "draw", "found", "weights", "statistics"],
            )

    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    known = known.filter(F.col("y").isin(0, 1) & (fold(F.col("doc_id")) != 0)).groupBy("doc_id").agg(F.max("y").alias("y"))
    texts = docs.select(*read_columns(docs))
    total = known.count()
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    if total > most:
        known = known.filter(draw < int((1 << 30) * most / total))
    chosen = texts.join(known, "doc_id").select("doc_id", "text", "n_chars", "y", draw.alias("draw"))
    read = chosen.mapInArrow(run, "y int, draw long, found binary, weights binary, statistics array<double>")
    # ids may repeat: the bound holds for documents
    got = read.orderBy("draw", "found", "weights", "y").limit(most).collect()
    rows = [(np.frombuffer(r["found"], "<u2").astype(np.int64), np.frombuffer(r["weights"], "<f4"), r["statistics"]) for r in got]
    return rows, np.array([r["y"] for r in got], float)


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = LABELLED_ROWS) -> Machine:
    return fitted(*labelled_features(docs, labels, label, most))


def score_documents(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, from its whole text and its stated number of characters.

    Equal texts with equal n_chars score alike, whatever their other columns.  A null or empty text has no words and scores by that;
    a null or absent n_chars is a feature of its own.  A null doc_id is held out of nothing.  An empty table gives
    no rows; without labels every document scores 1/2.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, label))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, reader = shared.value, Reader()
        squares = (machine.vectors**2).sum(1)
        for batch in batches:
            rows = [reader.read(t, n) for t, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            bins = machine.bins(np.array([r[2] for r in rows], float).reshape(-1, len(STATISTICS)))
            scores = [machine.score(found, weights, bins[n], squares) for n, (found, weights, _) in enumerate(rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = docs.select(*read_columns(docs)).mapInArrow(run, "doc_id long, score double")
    held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
