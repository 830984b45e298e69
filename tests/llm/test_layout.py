"""Hot keys are spread and clashing names are kept, with the same results."""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rillmark.llm import components, language, quality, repeats, token_archive
from rillmark.llm.tables import store_uri

TEXT = " ".join(f"w{i % 40}" for i in range(60))


@pytest.mark.parametrize("hub", [3, 1000])
def test_stars_and_chains_around_hubs(spark, monkeypatch, hub):
    monkeypatch.setattr(components, "HUB_LINKS", hub)
    monkeypatch.setattr(components, "HUBS", 10**9)
    links = [(0, i) for i in range(1, 4000)] + [(i, i + 1) for i in range(5000, 5040)] + [(9000, 5020), (9000, 9000)]
    found = components.components(spark.createDataFrame(links, "a long, b long").repartition(7))
    want = {i: 0 for i in range(4000)} | {i: 5000 for i in range(5000, 5041)} | {9000: 5000}
    assert {r.node: r.root for r in found.collect()} == want


def test_rows_of_one_id_fill_several_chunks(spark, monkeypatch):
    probe = repeats._probe
    rows = [(None, TEXT, i) for i in range(500)] + [(7, TEXT + f" end{i:04d}", i) for i in range(500)] + [(1, "zero " + TEXT, 0), (9, None, 1), (9, None, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row long").repartition(5)
    tasks = spark.sparkContext.accumulator(0)

    def counted(table, layout):
        tasks.add(1)
        assert table.num_rows < 600
        return probe(table, layout)

    monkeypatch.setattr(repeats, "_probe", counted)
    got = repeats.drop_repeats(docs, chunk_bytes=20_000).collect()
    # Document 1 has the passage first, so all others lose its words.
    assert sorted((r.doc_id or -1, r._row, r.n_words, r.n_removed) for r in got) == sorted(
        (d or -1, k, len((t or "").split()), 60 if t and d != 1 else 0) for d, t, k in rows
    )
    assert tasks.value >= 4


def test_clashing_names_get_underscores(spark):
    rows = [(i, ["der die das und", "the and of to"][i % 2] * 9, ["de", "en"][i % 2], 0.5, "x") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, lang_pred string")
    found = language.predict(docs, language.train(docs, F.lit(True)))
    assert found.columns == [*docs.columns, "lang_pred_", "score_"]
    assert all(r.lang_pred_ == r.lang and r.score == 0.5 for r in found.collect())
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    scored = quality.score(docs, quality.train(docs, labels, F.lit(True)))
    assert scored.columns == [*docs.columns, "score_"] and all(0 <= r.score_ <= 1 and r.score == 0.5 for r in scored.collect())


def test_last_stage_keeps_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "some text", 5, "mine", "d"), (2, None, 6, None, "d")], "doc_id long, text string, n_pieces long, ids string, decoded string")
    got = corpus_pipeline.sentencepiece(spark, docs, "")
    assert got.columns == [*docs.columns, "ids_", "n_pieces_"]
    assert [(r.ids, r.n_pieces, r.decoded, r.text) for r in got.orderBy("doc_id").collect()] == [("mine", 5, "d", "some text"), (None, 6, "d", None)]


def test_word_memo_is_bounded_by_bytes():
    encoder = token_archive.WordEncoder(public_tokenizers.path(token_archive.TOKENIZER))
    encoder.room = 2000
    words = pa.array([("x" * 300 + str(i)).encode() for i in range(20)] + [b"short", b"plain,"], pa.large_binary())
    first, again = encoder(words), encoder(words.take(pa.array(range(22))[::-1]))
    assert 0 < len(encoder.memo) < 8 and encoder.room >= 0
    for i in range(22):
        a = first[2][first[1][i] :][: first[0][i]]
        b = again[2][again[1][21 - i] :][: again[0][21 - i]]
        assert a.tolist() == b.tolist() == encoder.tokenizer.encode(words[i].as_py().decode(), add_special_tokens=False).ids


def test_folders_are_resolved_as_spark_does(spark, tmp_path):
    assert store_uri(spark, str(tmp_path)) == str(tmp_path)
    assert store_uri(spark, f"file://{tmp_path}/x") == f"file://{tmp_path}/x"


def test_samples_of_repeated_ids_do_not_depend_on_the_layout(spark):
    rows = [(i % 7, f"der die das {i} und", "de" if i % 2 else "en", i % 2) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, q int")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(7)], "doc_id long, quality int, toxic int")
    texts = spark.createDataFrame([(0, "die das und 5")], "doc_id long, text string")
    seen = set()
    for parts in (1, 5):
        mixed = docs.repartition(parts, "text")
        said = language.predict(texts, language.train(mixed, F.lit(True))).first()
        seen.add((said.lang_pred, said.score, quality.score(texts, quality.train(mixed, labels, F.lit(True))).first().score))
    assert len(seen) == 1
