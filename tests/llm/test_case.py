"""Benchmark items in other case, and with words put between."""

from __future__ import annotations

import pytest

from rillmark.llm import templates

QUESTION = "Maria bought 12 apples near Straße 7 and Peter bought 7 pears, so how many fruits did Maria and Peter carry home after 3 hours?"


@pytest.mark.parametrize("case", [str.lower, str.upper, str.title, str.swapcase])
def test_case_does_not_hide_items(spark, case):
    numbers = QUESTION.replace("12", "40").replace("7", "9").replace("3 hours", "5 days")
    texts = {1: case(QUESTION), 2: "x y. " + case(numbers) + " z", 3: case("Some other text about apples and pears that Maria bought after 3 hours.")}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame([(1, QUESTION)], "item_id long, text string")
    assert {r.doc_id: r.kind for r in templates.contaminated(docs, bench).collect()} == {1: "verbatim", 2: "reparameterised"}
    again = spark.createDataFrame([(1, case(QUESTION))], "item_id long, text string")
    assert [r.kind for r in templates.contaminated(docs.filter("doc_id = 1"), again).collect()] == ["verbatim"]


@pytest.mark.parametrize("case", [str.lower, str.upper])
def test_items_in_other_case_are_found(spark, sf_dir, case):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    docs = spark.createDataFrame([(i, case(t)) for i, t in items], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in templates.contaminated(docs, bench).collect()}
    assert {i for i, t in items if t.split()} == {d for d, i in found if d == i}


@pytest.mark.parametrize("between", [0, 5, 8, 30])
def test_inserted_words_do_not_hide_items(spark, between):
    words = [f"{w}{i}" for i in range(10) for w in ("plain", "text", "with", "words")]
    line = [f"page{i}" for i in range(between)]
    far = [f"far{i}" for i in range(60)]
    texts = {1: words[:20] + line + words[20:], 2: words[:20] + far + words[20:], 3: [*words[:20], *line, *far]}
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    rows = templates.contaminated(docs, bench).collect()
    assert [(r.doc_id, r.kind, r.matched) for r in rows] == [(1, "verbatim", 36 if not between else 32)]
