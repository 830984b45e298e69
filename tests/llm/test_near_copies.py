"""Near copies by exact similarity of word shingles, against plain Python."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from rillmark.llm import jaccard, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text: str | None, size: int = 5) -> frozenset:
    words = (text or "").lower().split()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def similar(a: frozenset, b: frozenset, bound: float = 0.8) -> bool:
    return a == b or len(a & b) / len(a | b) >= bound


def groups(texts: dict[int, str | None]) -> dict[int, int]:
    """Smallest id of each id's group, over all pairs."""
    sets = {i: shingles(t) for i, t in texts.items()}
    label = {i: i for i in texts}
    for a in texts:
        for b in texts:
            if a < b and label[a] != label[b] and similar(sets[a], sets[b]):
                low, high = sorted((label[a], label[b]))
                label = {i: low if g == high else g for i, g in label.items()}
    return label


def edited(words: list[str], at: list[int]) -> str:
    return " ".join(f"edit{i}" if i in at else w for i, w in enumerate(words))


def copies(seed: int = 9) -> dict[int, str | None]:
    rng = random.Random(seed)
    base = [[rng.choice("abcdefgh") + str(rng.randrange(900)) for _ in range(n)] for n in (9, 60, 104, 204, 600)]
    texts: dict[int, str | None] = {1: None, 2: "", 3: "two words", 4: "TWO\nWords"}
    for k, words in enumerate(base):
        texts |= {100 * k + 10: " ".join(words), 100 * k + 11: " ".join(words).upper(), 100 * k + 12: " ".join(words) + " tail words"}
        for j in range(14):
            # Edits six words apart change five shingles each: the bound lies at about one edit in 45 words.
            n = rng.choice([1, len(words) // 60 + 1, len(words) // 45 + 1, len(words) // 30 + 1])
            texts[100 * k + 20 + j] = edited(words, rng.sample(range(0, len(words), 6), min(n, len(words) // 6 + 1)))
    return texts


@pytest.mark.parametrize("pairs_to", [1, 8, 1000])
def test_near_copies_match_brute_force(spark, monkeypatch, pairs_to):
    monkeypatch.setattr(jaccard, "PAIRS_TO", pairs_to)
    texts = copies()
    docs = spark.createDataFrame([(i, t, "en", None, 1) for i, t in texts.items()], SCHEMA).repartition(3)
    got = simhash.near_duplicates(docs, size=5, similarity=0.8)
    assert {r.doc_id: r.component_id for r in got.select("doc_id", "component_id").collect()} == groups(texts)


def test_stage_drops_edited_copies(spark, sf_dir):
    texts = copies(4)
    docs = spark.createDataFrame([(i, t, "en", None, 1) for i, t in [*texts.items(), (310, texts[310]), (310, "another text under the same id")]], SCHEMA)
    kept = corpus_pipeline.near_dedup(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids == sorted([*set(groups(texts).values()), 310])


def test_band_keys_find_the_bound():
    """Two sets at 0.8 share a key in all of many draws."""
    import numpy as np

    rng = np.random.default_rng(2)
    for n in (9, 90, 900):
        for _ in range(40):
            both, left, right = (rng.integers(0, 1 << 64, k, np.uint64) for k in (8 * n // 9, n // 9, n // 9))
            sets = [np.unique(np.concatenate([both, x])) for x in (left, right)]
            a, b = jaccard.band_keys(np.concatenate(sets), np.array([len(x) for x in sets]))
            assert (a == b).any()


def test_stage_links_what_simhash_links(spark, sf_dir):
    """Fingerprints count repeats: tails do not part texts that are one line over and over, though their sets share little."""
    line = " ".join(f"w{i}" for i in range(7))
    texts = {i: f"{line} " * 300 + " ".join(f"tail{i}x{j}" for j in range(12)) for i in (3, 5)} | {7: " ".join(f"other{j}" for j in range(40))}
    assert not similar(shingles(texts[3]), shingles(texts[5]))
    docs = spark.createDataFrame([(i, t, "en", None, 1) for i, t in texts.items()], SCHEMA)
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, sf_dir).collect()) == [3, 7]
