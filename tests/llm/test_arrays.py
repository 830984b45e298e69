"""Hashes of words and of runs, and the memory that pieces of texts leave behind."""

import numpy as np
import pyarrow as pa

from rillmark.llm import arrays as A
from rillmark.llm import jaccard, piece_codec


def test_word_hashes_call_nothing_for_each_word(monkeypatch):
    """op8: a worker spent most of its time in a call for each distinct word and seed."""
    calls = []
    digest = A.xxhash.xxh64_intdigest
    monkeypatch.setattr(A.xxhash, "xxh64_intdigest", lambda *a: calls.append(1) or digest(*a))
    text = " ".join(f"word{i}" for i in range(1000))
    hashes = A.words_of(pa.array([text, None, ""])).hashes(1)
    assert len(set(hashes.tolist())) == 1000
    assert not calls


def test_word_hashes_depend_on_the_bytes_and_the_seed_alone():
    words = [("aé\x00▁b" * 200).encode()[:n].decode("utf-8", "ignore") + end for n in [*range(40), 255, 256, 257, 600] for end in ("a", "b", "\x00")]
    words = sorted({w for w in words if w})
    alone = np.concatenate([A.words_of(pa.array([w])).hashes(2) for w in words])
    assert len(set(alone.tolist())) == len(words)
    order = np.random.default_rng(3).permutation(len(words))
    mixed = A.words_of(pa.array([" \t ".join(words[i] for i in order), None, "", words[0]]))
    assert mixed.hashes(2).tolist() == [*alone[order].tolist(), alone[0]]
    assert not (mixed.hashes(2) == mixed.hashes(3)).any()
    assert A.words_of(pa.array([], pa.string())).hashes(1).tolist() == []


def test_rolling_hashes_are_those_of_the_plain_sum():
    hashes = np.random.default_rng(4).integers(0, 1 << 63, 50).astype(np.uint64)
    for n in (0, 1, 6, 13, 50):
        for size in range(1, 20):
            want = []
            for i in range(n - size + 1):
                total = 0
                for h in hashes[i : i + size].tolist():
                    total = (total * int(A.MULTIPLIER) + h) % (1 << 64)
                want.append(total ^ (total >> 29))
            assert A.rolling(hashes[:n], size).tolist() == want


def test_arrow_memory_is_given_back_after_each_batch(monkeypatch):
    """pipeline: workers kept what Arrow had freed through all later stages."""
    released = []

    class Pool:
        def release_unused(self):
            released.append(1)

    monkeypatch.setattr(A.pa, "default_memory_pool", Pool)
    batches = [pa.record_batch([pa.array(["ab", None, "cdef"])], names=["text"])] * 2
    assert sum(p.num_rows for p in A.pieces(batches, "text", 2)) == 6
    assert len(released) == 2


def test_what_a_sentencepiece_worker_remembers_is_small():
    """pipeline: two workers beside a full heap went over an executor's memory."""
    assert piece_codec.MEMO_BYTES + 100 * (piece_codec.MEMO_PAIRS + piece_codec.MEMO_STEPS) < 80 << 20
    assert 64 * piece_codec.ENCODE_BYTES <= 64 << 20


def test_a_sentencepiece_task_leaves_nothing_with_its_worker(spark):
    """pipeline: the words and pieces of one stage stayed in the workers through the next ones."""
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string").coalesce(1)
    coded = piece_codec.encode(docs)

    def held(batches):
        for _ in batches:
            pass
        yield pa.record_batch([pa.array([piece_codec._worker_model.cache_info().currsize])], names=["n"])

    # Both functions of a task may run in one worker or in two; the later task's worker has run encode or nothing.
    assert [(r.n_pieces or 0) > 0 for r in coded.selectExpr("size(ids) as n_pieces").collect()] == [True, False]
    assert all(r.n == 0 for r in spark.range(64).repartition(8).mapInArrow(held, "n long").collect())


def test_crowds_are_compared_in_blocks_of_bounded_size(monkeypatch):
    """pipeline on a crowded table: a matrix had a column of doubles for each shingle of a chunk."""
    shapes, matrix = [], jaccard._matrix
    monkeypatch.setattr(jaccard, "_matrix", lambda sets, vocab: shapes.append(len(vocab)) or matrix(sets, vocab))
    monkeypatch.setattr(jaccard, "VOCAB_BLOCK", 7)
    rng = np.random.default_rng(5)
    sets = [np.sort(rng.choice(40, n, replace=False)).astype(np.uint64) for n in (1, 5, 20, 40)]
    got = jaccard.in_both(sets, sets[:3])
    assert got.tolist() == [[len(np.intersect1d(x, y)) for y in sets[:3]] for x in sets]
    assert max(shapes) == 7
