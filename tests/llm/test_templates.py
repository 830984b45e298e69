"""The window join against a search that compares every document with every item, both ways."""

from __future__ import annotations

import random
import re

import regex
from pyspark.sql import functions as F

from rillmark.llm import templates as T

NUMBER, NAME = re.compile(T.NUMBER_TEXT), regex.compile(T.NAME_TEXT)
EDGES = regex.compile(T.EDGES)


def words_of(text):
    """(core, type) of each word, by plain rules."""
    out = []
    for raw in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
        core = EDGES.sub("", raw)
        if regex.search(r"[\p{L}\p{N}]", core):
            kind = T.NUMBER if NUMBER.search(core) else T.NAME if NAME.search(core) else T.LITERAL
            if core.lower() in T.UNITS and out and out[-1][1] == T.NUMBER:
                kind = T.UNIT
            out.append((core.casefold(), kind))
    return out


def window(words, at, size, names):
    """Words and placeholders of a window; one with few literal words keeps its words."""
    part = words[at : at + size]
    literal = (T.LITERAL,) if names else (T.LITERAL, T.NAME)
    if sum(k in literal for _, k in part) < min(T.LEAST_LITERALS, size):
        return tuple(w for w, _ in part)
    return tuple(w if k in literal else (k,) for w, k in part)


def searched(docs, items):
    found = set()
    for item_id, item in items:
        own = words_of(item)
        if not own:
            continue
        size = min(T.WINDOW, len(own))
        total = len(own) - size + 1
        places = {}
        for names in (True, False):
            for place in range(total):
                places.setdefault((names, window(own, place, size, names)), []).append(place)
        for doc_id, text in docs:
            words = words_of(text)
            hits = {(at, p) for names in (True, False) for at in range(len(words) - size + 1) for p in places.get((names, window(words, at, size, names)), [])}
            heard = {at: [w for w, _ in words[at : at + size]] for at, _ in hits}
            best = None
            for pairs in T.occurrences(list(hits), len(own)) if hits else []:
                counted, _, verbatim = T.judge(size, [k for _, k in own], [w for w, _ in own], pairs, heard)
                if counted >= T.COVERAGE * total:
                    row = (counted, "verbatim" if verbatim else "reparameterised")
                    best = max(best or row, row)
            if best:
                found.add((doc_id, item_id, total, *best))
    return found


def test_join_finds_what_a_full_search_finds(spark, sf_dir):
    draw = random.Random(4)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()][:40]
    items += [(9001, "Anna paid 12 euros for 3 kg of plums and Otto paid 9 euros for 2 kg of pears"), (9002, "two words"), (9003, None)]
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if len(r.text or "") < 3000][:150]
    for n, (i, text) in enumerate(items):
        words = (text or "").split()
        for k in range(5):
            some = [re.sub(r"\d+", lambda m: str(draw.randrange(90)), w) if k % 2 else w for w in words]
            some = [w for w in some if draw.random() > 0.03 * k]
            at = draw.randrange(len(some) + 1)
            some[at:at] = [f"put{j}" for j in range(draw.choice([0, 2, 30]))]
            docs.append((100_000 + 10 * n + k, "Before it. " + " ".join(some).replace("Anna", "Olga") + " after"))
    table = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, key string").repartition(5)
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, row int")
    want = searched(docs, items)
    for bits in (28, 8):
        got = T.contaminated(table, bench, most_bits=bits).select("doc_id", "item_id", "n_windows", "matched", "kind").collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert len(want) > 60 and {k for *_, k in want} == {"verbatim", "reparameterised"}


def test_benchmark_larger_than_a_broadcast(tight, sf_dir):
    """Hot keys and large sides are forced: the window join is shuffled and salted."""
    docs, bench = (tight.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    tight.conf.set("rillmark.hotRows", "200")
    got = {tuple(r) for r in T.contaminated(docs, bench).collect()}
    tight.conf.unset("rillmark.broadcastRows")
    tight.conf.unset("rillmark.hotRows")
    assert got == {tuple(r) for r in T.contaminated(docs, bench).collect()} and got
    assert T.contaminated(docs.filter(F.lit(False)), bench).count() == 0
