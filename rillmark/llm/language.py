"""Language identification: multinomial logistic regression over TF-IDF character n-grams.

Features are the 1-, 2- and 3-grams of lower-cased words with a mark at both
ends, hashed into ``FEATURES`` places; a feature's weight in a document is its
share of the document's n-grams times its inverse document frequency. Inverse
document frequencies count every learning document. The weights come from
follow-the-regularised-leader steps with L1 and L2 penalties over a bounded,
balanced sample, and one temperature is then fitted on the part of the sample
that the steps did not see.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from rillmark.llm import arrays as A
from rillmark.llm.tables import balanced_sample, fresh

FEATURES = 1 << 14
#: Documents of each language in the training sample at most.
PER_LANG = 512
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.5
#: Brings the shares of n-grams to about one.
SCALE = 64.0
CALIBRATION_PART = 5
UNDETERMINED = "und"
#: Documents whose feature marks are held at once while frequencies are counted.
COUNTED_TOGETHER = 256
FRONT, BACK = np.uint32(2), np.uint32(3)


def word_features(vocab: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of the n-grams of each word back to back, and how many each word has."""
    lower = pc.utf8_lower(A.valid_text(vocab))
    if not len(lower):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    length = pc.utf8_length(lower).to_numpy(zero_copy_only=False).astype(np.int64)
    chars = np.frombuffer("".join(lower.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
    wide = length + 2
    begin = np.cumsum(wide) - wide
    marked = np.empty(int(wide.sum()), np.uint64)
    marked[begin], marked[begin + wide - 1] = FRONT, BACK
    marked[A.ragged(begin + 1, length)] = chars
    parts, owners, places = [], [], []
    for n in (1, 2, 3):
        total = np.full(len(marked) - n + 1, n, np.uint64)
        for k in range(n):
            total = (total + marked[k : len(marked) - n + 1 + k]) * A.MULTIPLIER
        number = (total >> np.uint64(40)) % np.uint64(FEATURES)
        # One-grams leave out the marks; all stay inside their word.
        first, count = (begin + 1, length) if n == 1 else (begin, wide - n + 1)
        at = A.ragged(first, count)
        parts.append(number[at].astype(np.int64))
        owners.append(np.repeat(np.arange(len(wide)), count))
        places.append(at)
    owner = np.concatenate(owners)
    order = np.lexsort((np.concatenate(places), owner))
    return np.concatenate(parts)[order], np.bincount(owner, minlength=len(wide))


def document_counts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features and their counts of each document."""
    words = A.words_of(column)
    features, sizes = word_features(words.vocab)
    begins = np.cumsum(sizes) - sizes
    ends = np.cumsum(words.counts)
    for a, b in zip(ends - words.counts, ends, strict=True):
        codes = words.codes[a:b]
        counts = np.bincount(features[A.ragged(begins[codes], sizes[codes])], minlength=FEATURES) if b > a else np.zeros(FEATURES, np.int64)
        used = np.flatnonzero(counts)
        yield used, counts[used]


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """Documents that hold each feature, and the number of documents. Each task sends one row for each feature it saw."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(FEATURES, np.int64), 0
        for piece in A.pieces(batches, text_col):
            words = A.words_of(piece.column(0))
            features, sizes = word_features(words.vocab)
            begins = np.cumsum(sizes) - sizes
            pairs = np.unique(words.docs * max(1, len(sizes)) + words.codes)
            docs_, codes = pairs // max(1, len(sizes)), pairs % max(1, len(sizes))
            for lo in range(0, piece.num_rows, COUNTED_TOGETHER):
                part = slice(*np.searchsorted(docs_, [lo, lo + COUNTED_TOGETHER]))
                seen = np.zeros((COUNTED_TOGETHER, FEATURES), bool)
                seen.ravel()[np.repeat((docs_[part] - lo) * FEATURES, sizes[codes[part]]) + features[A.ragged(begins[codes[part]], sizes[codes[part]])]] = True
                total += seen.sum(axis=0)
            rows += piece.num_rows
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(np.append(used, -1)), pa.array(np.append(total[used], rows))], names=["feature", "n"])

    sums = docs.select(text_col).mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    frequency, rows = np.zeros(FEATURES, np.int64), 0
    for row in sums.collect():  # at most FEATURES + 1 rows
        if row.feature < 0:
            rows = row.n
        else:
            frequency[row.feature] = row.n
    return frequency, rows


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (features and a last row for the bias, classes) after ``epochs`` passes over sparse rows."""
    z, n = np.zeros((FEATURES + 1, classes)), np.zeros((FEATURES + 1, classes))

    def weights(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        shrunk = np.sign(zs) * np.maximum(np.abs(zs) - L1, 0.0)
        return -shrunk / ((BETA + np.sqrt(ns)) / ALPHA + L2)

    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            at, x = rows[i]
            w = weights(z[at], n[at])
            error = softmax(x @ w)
            error[labels[i]] -= 1.0
            g = x[:, None] * error
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(z, n)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits that makes the labels likeliest, by golden section over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        return -np.log(np.maximum(softmax(logits / np.exp(t))[np.arange(len(labels)), labels], 1e-12)).mean()

    lo, hi, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


@dataclass(frozen=True)
class LanguageModel:
    """``table`` has the calibrated weight of a feature's share for each language; ``bias`` is added."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray

    def probabilities(self, column: pa.Array) -> np.ndarray:
        words = A.words_of(column)
        features, sizes = word_features(words.vocab)
        logits = np.tile(self.bias, (len(words.counts), 1))
        if words.size:
            begins = np.cumsum(sizes) - sizes
            per_word = np.add.reduceat(self.table[features], begins, axis=0)
            docs = words.docs
            grams = np.bincount(docs, weights=sizes[words.codes], minlength=len(words.counts))
            for k in range(len(self.languages)):
                logits[:, k] += np.bincount(docs, weights=per_word[words.codes, k], minlength=len(words.counts)) / np.maximum(grams, 1)
        return softmax(logits)


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = PER_LANG) -> LanguageModel:
    """Fit on the rows where ``learn`` holds and the language is not null.

    Document frequencies cover all of these rows. The sample has at most
    ``per_lang`` documents of a language, drawn by a hash of the id; of rows
    that repeat an id one is used. Without any such row the model is empty.
    """
    rows = docs.filter(learn & F.col(lang_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    frequency, total = document_frequencies(rows, "text")
    idf = np.log((1.0 + total) / (1.0 + frequency)) + 1.0
    # A few rows for each language: that many are sent to every task.
    drawn = F.broadcast(balanced_sample(rows, "id", "lang", per_lang))
    sample = rows.join(drawn, (F.col("id") == F.col("key")) & (F.col("lang") == F.col("label")))
    # Of rows that repeat an id the one with the smallest hash, so that a second training draws the same.
    sample = sample.groupBy("label", "salt").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("text", "label", "salt")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in A.pieces(batches, "text"):
            made = [(at.astype(np.int32).tobytes(), n.astype(np.int32).tobytes()) for at, n in document_counts(piece.column(0))]
            columns = [piece.column(1), piece.column(2), pa.array([m[0] for m in made], pa.binary()), pa.array([m[1] for m in made], pa.binary())]
            yield pa.record_batch(columns, names=["label", "salt", "at", "n"])

    found = sorted(sample.mapInArrow(features, "label string, salt int, at binary, n binary").collect(), key=lambda r: (r.label, r.salt))
    languages = sorted({r.label for r in found})
    if not languages:
        return LanguageModel([], np.zeros((FEATURES, 0)), np.zeros(0))
    vectors = []
    for r in found:
        at, n = np.frombuffer(r.at, np.int32), np.frombuffer(r.n, np.int32)
        vectors.append((np.append(at, FEATURES), np.append(SCALE * n / max(1, n.sum()) * idf[at], 1.0)))
    labels = np.array([languages.index(r.label) for r in found])
    held = np.array([r.salt % CALIBRATION_PART == 0 for r in found])
    if held.all():
        held[:] = False
    weights = ftrl([v for v, h in zip(vectors, held, strict=True) if not h], labels[~held], len(languages))
    logits = np.array([x @ weights[at] for (at, x), h in zip(vectors, held, strict=True) if h]).reshape(-1, len(languages))
    t = temperature(logits, labels[held])
    return LanguageModel(languages, (weights[:-1] * idf[:, None] * SCALE / t).astype(np.float32), weights[-1] / t)


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the likeliest language and its probability.

    A null text, a text without a letter and every text under an empty model
    are ``und`` with score 0. Ties go to the first language by name. Nothing
    is shuffled; only the text is read for the decision. An output whose name
    ``docs`` has gets underscores.
    """
    lang_pred, score = fresh(docs, lang_pred), fresh(docs, score)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in A.pieces(batches, text_col):
            column = piece.column(piece.schema.get_field_index(text_col))
            known = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False) & bool(model.languages)
            if model.languages:
                p = model.probabilities(column)
                best, top = p.argmax(axis=1), p.max(axis=1)
            else:
                best, top = np.zeros(len(column), int), np.zeros(len(column))
            names = np.array([*model.languages, UNDETERMINED], object)[np.where(known, best, len(model.languages))]
            made = [pa.array(names, pa.string()), pa.array(np.where(known, top, 0.0))]
            yield pa.RecordBatch.from_arrays([*piece.columns, *made], names=[*piece.schema.names, lang_pred, score])

    kind = StructType([*docs.schema.fields, StructField(lang_pred, StringType()), StructField(score, DoubleType())])
    return docs.mapInArrow(run, kind)
