"""Every order of the filters against a plain Python audit."""

from __future__ import annotations

import re
from itertools import permutations

import pytest

from rillmark.llm import filter_audit

LONG = " ".join(f"w{i}" for i in range(250))
TEXTS = [
    LONG, LONG, LONG + "\x0b#", "same " * 300, "SAME " * 300, None, "", " \t\r\n", "$ A B", "A" * 4 + "b" * 96, "É x y", LONG.upper(), "a\x0cb\x0bb",
]


def brute(docs, labels):
    """Counts by applying the filters one after the other, for every order."""
    lowest = {}
    for i, text, _ in docs:
        if i is not None:
            lowest[text or ""] = min(i, lowest.get(text or "", i))
    parts = {}
    for i, text, lang in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and i > lowest[t],
        }
        marks = [(q, x) for j, q, x in labels if j == i and i is not None]
        good, toxic = any(q == 1 for q, _ in marks), any(x == 1 for _, x in marks)
        parts.setdefault(lang or "", []).append(({k for k, v in fails.items() if v}, good, toxic))
    out = {}
    for part, rows in parts.items():
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = rows
            for step, letter in enumerate(order, 1):
                gone = [r for r in left if letter in r[0]]
                failing = [r for r in rows if letter in r[0]]
                left = [r for r in left if letter not in r[0]]
                total[letter] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(failing) - len(gone), sum(r[0] == {letter} for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone)
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


@pytest.mark.parametrize("together", [1500, 1])
def test_filter_audit_matches_plain_python(spark, monkeypatch, together):
    monkeypatch.setattr(filter_audit, "PARTS_TOGETHER", together)
    docs = [(10 - i if i % 5 else i, t, ["en", "fr", None, ""][i % 4]) for i, t in enumerate(TEXTS)]
    docs += [(None, LONG, "en"), (None, "", None), (3, LONG, "fr"), (3, LONG, "fr"), (3, LONG, "en"), (-7, "", "de")]
    labels = [(3, 1, 0), (3, None, 1), (0, 1, None), (None, 1, 1), (9, 0, 0), (77, 1, 1)]
    table = spark.createDataFrame([(*d, 1, "m") for d in docs], "doc_id long, text string, lang string, n long, mask string")
    marks = spark.createDataFrame([(*x, 5) for x in labels], "doc_id long, quality int, toxic int, id int")
    rows = filter_audit.audit(table, marks).collect()
    got = {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in rows}
    want = brute(docs, labels)
    assert len(rows) == len(got) == 120 * 5 * 4
    assert got == want
    assert filter_audit.audit(table.filter("false"), marks).count() == 0
    unlabelled = filter_audit.audit(table, marks.filter("false")).agg({"good_lost": "sum"}).first()[0]
    assert unlabelled == 0


def test_copies_of_one_text_are_reduced_before_the_comparison(spark):
    docs = spark.range(5000).selectExpr("id as doc_id", "'one text' as text", "if(id % 2 = 0, 'en', 'fr') as lang")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    cells = {(r.part, r["mask"]): r.n for r in filter_audit.mask_cells(docs, labels).collect()}
    assert cells == {("en", 1): 1, ("en", 17): 2499, ("fr", 17): 2500}
