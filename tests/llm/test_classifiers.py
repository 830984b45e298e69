"""The classifiers' arithmetic against plain Python: TF-IDF, the leader's steps, the calibration, one tree by exhaustive search."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rillmark.llm import language, quality

MASK = (1 << 64) - 1
FACTOR = 0x9E3779B97F4A7C15
TEXTS = ["The cat and the CAT", "", None, "Straße, ÉTÉ!", "a", "日本 語", "the  the\tthe"]


def grams(text):
    """Feature numbers of the marked 1- to 3-grams of each word, one by one."""
    out = []
    for word in (text or "").split():
        marked = [2, *map(ord, word.lower()), 3]
        for n in (1, 2, 3):
            for i in range(len(marked) - n + 1):
                part = marked[i : i + n]
                if n == 1 and i in (0, len(marked) - 1):
                    continue
                total = n
                for c in part:
                    total = (total + c) * FACTOR & MASK
                out.append((total >> 40) % language.FEATURES)
    return out


def test_feature_counts_and_document_frequencies(spark):
    got = [dict(zip(at.tolist(), n.tolist(), strict=True)) for at, n in language.document_counts(pa.array(TEXTS, pa.string()))]
    assert got == [dict(Counter(grams(t))) for t in TEXTS]
    docs = spark.createDataFrame([(t,) for t in TEXTS], "text string").repartition(3)
    frequency, total = language.document_frequencies(docs, "text")
    want = Counter(f for t in TEXTS for f in set(grams(t)))
    assert total == len(TEXTS) and {i: int(n) for i, n in enumerate(frequency) if n} == dict(want)


def leader(rows, labels, classes, epochs):
    """Follow-the-regularised-leader with L1 and L2, a number at a time."""
    z, n = Counter(), Counter()

    def weight(f, k):
        if abs(z[f, k]) <= language.L1:
            return 0.0
        return -(z[f, k] - math.copysign(language.L1, z[f, k])) / ((language.BETA + math.sqrt(n[f, k])) / language.ALPHA + language.L2)

    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            at, x = rows[i]
            w = {(f, k): weight(f, k) for f in at for k in range(classes)}
            logits = [sum(w[f, k] * v for f, v in zip(at, x, strict=True)) for k in range(classes)]
            powers = [math.exp(v - max(logits)) for v in logits]
            for k in range(classes):
                error = powers[k] / sum(powers) - (labels[i] == k)
                for f, v in zip(at, x, strict=True):
                    g = error * v
                    sigma = (math.sqrt(n[f, k] + g * g) - math.sqrt(n[f, k])) / language.ALPHA
                    z[f, k] += g - sigma * w[f, k]
                    n[f, k] += g * g
    return {(f, k): weight(f, k) for f, k in z}


def test_leader_takes_the_same_steps():
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(25):
        at = np.sort(rng.choice(40, 6, replace=False))
        rows.append((np.append(at, language.FEATURES), np.append(rng.random(6) * 3, 1.0)))
    labels = rng.integers(0, 3, 25)
    got, want = language.ftrl(rows, labels, 3, epochs=2), leader(rows, labels, 3, 2)
    assert any(v == 0.0 for v in want.values()) and any(v != 0.0 for v in want.values())
    for (f, k), v in want.items():
        assert got[f, k] == pytest.approx(v, abs=1e-12)
    assert np.count_nonzero(got) == sum(v != 0.0 for v in want.values())


def test_temperature_is_the_best_on_a_grid():
    rng = np.random.default_rng(6)
    labels = rng.integers(0, 3, 400)
    logits = np.eye(3)[labels] * 4 + rng.normal(size=(400, 3)) * 4

    def loss(t):
        return -np.log(language.softmax(logits / t)[np.arange(400), labels]).mean()

    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 4000))
    assert language.temperature(logits, labels) == pytest.approx(min(grid, key=loss), rel=5e-3)


def test_scores_are_those_of_the_formula(spark):
    rows = [(i, ("der die das und nicht", "the and of to in", "le la les des et")[i % 3] + f" w{i}", ("de", "en", "fr")[i % 3]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs, F.lit(True))
    for r in language.predict(docs, model).collect():
        found = grams(r.text)
        logits = [float(model.bias[k]) + sum(float(model.table[f, k]) for f in found) / len(found) for k in range(3)]
        powers = [math.exp(v - max(logits)) for v in logits]
        best = max(range(3), key=lambda k: (powers[k], -k))
        assert r.lang_pred == model.languages[best] and r.score == pytest.approx(powers[best] / sum(powers), rel=1e-4)


def exhaustive(x, y, weight, depth):
    """One tree: at every node each feature and each edge is tried on the rows themselves."""
    mean = float(np.average(y, weights=weight))
    margin = np.full(len(y), math.log(mean / (1 - mean)))
    p = 1 / (1 + np.exp(-margin))
    g, h = weight * (p - y), weight * p * (1 - p)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, quality.BINS + 1)[1:-1])) for c in x.T]

    def score(rows):
        return g[rows].sum() ** 2 / (h[rows].sum() + quality.L2)

    def split(rows, level):
        if level == depth:
            margin[rows] += -quality.RATE * g[rows].sum() / (h[rows].sum() + quality.L2)
            return
        best, at = 1e-9, None
        for f in range(x.shape[1]):
            for edge in edges[f]:
                left, right = rows[x[rows, f] <= edge], rows[x[rows, f] > edge]
                if min(h[left].sum(), h[right].sum()) < quality.LEAST_WEIGHT:
                    continue
                gain = score(left) + score(right) - score(rows)
                if gain > best + 1e-12:
                    best, at = gain, (f, edge)
        if at is None:
            split(rows, level + 1)
            return
        split(rows[x[rows, at[0]] <= at[1]], level + 1)
        split(rows[x[rows, at[0]] > at[1]], level + 1)

    split(np.arange(len(y)), 0)
    return margin


@pytest.mark.parametrize("seed", range(4))
def test_a_tree_is_the_one_exhaustive_search_finds(seed):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(300, 4)), 2)
    y = ((x[:, 0] > 0.2) ^ (x[:, 2] > -0.3) ^ (rng.random(300) < 0.1)).astype(float)
    weight = rng.random(300) + 0.5
    for depth in (1, 2, 3):
        tree = quality.grow(x, y, weight, trees=1, depth=depth)
        assert tree.margin(x) == pytest.approx(exhaustive(x, y, weight, depth), abs=1e-9)
