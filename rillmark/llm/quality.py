"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of whole texts are computed in numpy, many documents at a time.
The trees are grown on a bounded, balanced sample over binned statistics and
kept as flat arrays: a tree of depth D is a heap of 2^D - 1 tests, and all
documents of a batch walk down together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from rillmark.llm import arrays as A
from rillmark.llm.tables import balanced_sample, fresh

#: Labelled documents of each class in the training sample at most.
PER_CLASS = 2048
TREES, DEPTH, BINS, RATE = 60, 3, 32, 0.15
L2, LEAST_WEIGHT = 1.0, 3.0
STATISTICS = (
    "log_bytes", "log_words", "mean_word_bytes", "upper_share", "lower_share", "digit_share", "sentence_mark_share", "symbol_share", "non_ascii_share",
    "space_share", "bare_word_share", "upper_word_share", "marked_word_share", "distinct_word_share", "top_word_share", "repeat_share", "log_lines",
    "distinct_line_share", "words_per_line",
)
UPPER, LOWER, DIGIT, SENTENCE, SYMBOL, SPACE, OTHER = range(7)
CLASSES = np.full(256, OTHER, np.uint8)
CLASSES[:128] = SYMBOL
CLASSES[[*range(9), *range(14, 32), 127]] = SYMBOL
CLASSES[65:91], CLASSES[97:123], CLASSES[48:58] = UPPER, LOWER, DIGIT
CLASSES[[ord(c) for c in ".,;:!?'\"()-"]] = SENTENCE
CLASSES[A.SPACES] = SPACE
LINE_ENDS = np.zeros(256, bool)
LINE_ENDS[[10, 13]] = True


def _distinct(docs: np.ndarray, codes: np.ndarray, values: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of different codes and count of the most frequent code of each document."""
    pairs, counts = np.unique(docs * max(1, values) + codes, return_counts=True)
    owner = pairs // max(1, values)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, owner, counts)
    return np.bincount(owner, minlength=n), top


def statistics(column: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` for each text; null and empty texts are all zeros."""
    words = A.words_of(column)
    n, docs, length = len(words.counts), words.docs, words.ends - words.starts
    kinds = CLASSES[words.data]
    total = np.diff(words.offsets)
    sums = {k: np.concatenate([[0], np.cumsum(kinds == k, dtype=np.int64)]) for k in range(7)}
    share = {k: np.diff(s[words.offsets]) / np.maximum(total, 1) for k, s in sums.items()}

    def in_words(k: int) -> np.ndarray:
        return sums[k][words.ends] - sums[k][words.starts]

    def word_share(flag: np.ndarray) -> np.ndarray:
        return np.bincount(docs, weights=flag, minlength=n) / np.maximum(words.counts, 1)

    upper = in_words(UPPER)
    content = upper + in_words(LOWER) + in_words(DIGIT) + in_words(OTHER)
    last = kinds[words.ends - 1] if words.size else np.empty(0, np.uint8)
    marks = in_words(SENTENCE) + in_words(SYMBOL)
    kinds_of_words, top = _distinct(docs, words.codes, len(words.vocab), n)
    again = np.zeros(words.size, bool)
    again[1:] = (words.codes[1:] == words.codes[:-1]) & (docs[1:] == docs[:-1])
    line_starts, line_ends, lines = A.spans(words.data, words.offsets, LINE_ENDS)
    line_codes, line_vocab = A.encode_spans(words.data, line_starts, line_ends, LINE_ENDS)
    kinds_of_lines, _ = _distinct(np.repeat(np.arange(n), lines), line_codes, len(line_vocab), n)
    return np.column_stack(
        [
            np.log1p(total), np.log1p(words.counts), np.bincount(docs, weights=length, minlength=n) / np.maximum(words.counts, 1), share[UPPER], share[LOWER],
            share[DIGIT], share[SENTENCE], share[SYMBOL], share[OTHER], share[SPACE], word_share(content == 0), word_share((upper > 1) & (in_words(LOWER) == 0)),
            word_share((marks > 1) & (last != LOWER)), kinds_of_words / np.maximum(words.counts, 1), top / np.maximum(words.counts, 1), word_share(again),
            np.log1p(lines), kinds_of_lines / np.maximum(lines, 1), words.counts / np.maximum(lines, 1),
        ]
    )


@dataclass(frozen=True)
class Trees:
    """Flat trees: tests (trees, 2^depth - 1) and leaves (trees, 2^depth)."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(len(leaf)))):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - len(threshold)]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margin(x)))


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boosted trees for the log loss; without rows of both classes they are a constant."""
    inner, leaves = 2**depth - 1, 2**depth
    mean = float(np.average(y, weights=weight)) if len(y) else 0.5
    if not len(y) or not 0.0 < mean < 1.0:
        base = {0.0: -6.0, 1.0: 6.0}.get(mean, 0.0)
        return Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    base = float(np.log(mean / (1 - mean)))
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    binned = np.column_stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T, strict=True)])
    features = x.shape[1]
    flat = binned + np.arange(features) * BINS
    margin = np.full(len(y), base)
    out_f, out_t, out_l = (np.zeros((trees, k), t) for k, t in ((inner, np.int64), (inner, float), (leaves, float)))
    for tree in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        g, h = weight * (p - y), weight * p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            width, first = 2**level, 2**level - 1
            cells = (flat + (node - first)[:, None] * (features * BINS)).ravel()
            gs, hs = (np.bincount(cells, weights=np.repeat(v, features), minlength=width * features * BINS).reshape(width, features, BINS) for v in (g, h))
            gl, hl = gs.cumsum(2), hs.cumsum(2)
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl**2 / (hl + L2) + (gt - gl) ** 2 / (ht - hl + L2) - gt**2 / (ht + L2)
            gain[(hl < LEAST_WEIGHT) | (ht - hl < LEAST_WEIGHT)] = 0.0
            best = gain.reshape(width, -1).argmax(1)
            for k, b in enumerate(best):
                f, cut = divmod(int(b), BINS)
                splits = gain[k, f, cut] > 1e-9 and cut < len(edges[f])
                out_f[tree, first + k] = f if splits else 0
                out_t[tree, first + k] = edges[f][cut] if splits else np.inf
            node = 2 * node + 1 + (x[np.arange(len(y)), out_f[tree][node]] > out_t[tree][node])
        at = node - inner
        gs, hs = np.bincount(at, weights=g, minlength=leaves), np.bincount(at, weights=h, minlength=leaves)
        out_l[tree] = -RATE * gs / (hs + L2)
        margin += out_l[tree][at]
    return Trees(base, out_f, out_t, out_l)


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_class: int = PER_CLASS) -> Trees:
    """Fit on documents whose label row satisfies ``learn`` (a condition on the id).

    A document with several labels has the largest; null labels and ids are
    left out, labels other than 0 and 1 count as 1. The sample holds at most
    ``per_class`` documents of a class, drawn by a hash of the id. Class
    weights restore the label counts of all learning rows.
    """
    clean = labels.filter(learn & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    one = clean.groupBy(F.col(id_col).alias("id")).agg(F.max((F.col(label_col) != 0).cast("int")).alias("label"))
    totals = {r.label: r.n for r in one.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    # At most per_class rows of two classes: that many are sent to every task.
    drawn = F.broadcast(balanced_sample(one, "id", "label", per_class))
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(drawn, F.col("id") == F.col("key"))
    kind = "label int, salt int, stats array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in A.pieces(batches, "text"):
            made = pa.array(list(statistics(piece.column(2))), pa.list_(pa.float64()))
            yield pa.record_batch([piece.column(0), piece.column(1), made], names=["label", "salt", "stats"])

    # Of rows that repeat an id the one with the smallest hash, so that a second training draws the same.
    first = sample.groupBy("label", "salt").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    found = first.select("label", "salt", "text").mapInArrow(run, kind).collect()
    found.sort(key=lambda r: (r.label, r.salt))
    x = np.array([r.stats for r in found]).reshape(-1, len(STATISTICS))
    y = np.array([r.label for r in found], float)
    drawn_of = {c: max(1, int((y == c).sum())) for c in (0, 1)}
    weight = np.array([totals[r.label] / drawn_of[r.label] for r in found])
    return grow(x, y, weight / weight.mean() if len(weight) else weight)


def score(docs: DataFrame, model: Trees, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1, from the text alone.

    Null and empty texts get the score of zeros. Nothing is shuffled. A name
    that ``docs`` has gets underscores.
    """
    score_col = fresh(docs, score_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in A.pieces(batches, text_col):
            made = pa.array(model.scores(statistics(piece.column(piece.schema.get_field_index(text_col)))))
            yield pa.RecordBatch.from_arrays([*piece.columns, made], names=[*piece.schema.names, score_col])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(score_col, DoubleType())]))
