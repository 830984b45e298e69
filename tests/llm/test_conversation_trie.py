"""The conversation trie against a walk over plain Python tuples."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from rillmark.llm import conversation_trie as ct

SCHEMA = "conv_id long, turn long, role string, text string, c long, t1 string"


def tie(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:24], len(text.encode())


def brute(rows):
    """``{path: figures}`` by walking every prefix of every rebuilt conversation."""
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, tie(role, text), (role or "", text or "")))
    own = {c: [r[3] for r in sorted(v)] for c, v in own.items()}
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        paths[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        kids = [n for n in below if len(n) == len(node) + 1]
        leaves = sum(not any(k[: len(n)] == n and len(k) == len(n) + 1 for k in members) for n in below)
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        ends = ",".join(map(str, sorted(c for c in convs if len(paths[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed):
    draw = random.Random(seed)
    rows = []
    for c in [*range(-12, 40), 10**12 + 3]:
        start = draw.choice(["a", "b"])
        for t in range(draw.choice([0, 1, 2, 5, 9, 9, 14, 23])):
            rows.append((c, draw.choice([t, t, t, None]), draw.choice(["user", "user", None]), draw.choice([start, start, start, "é", "", None, "long " * 9])))
    return [(*r, 1, "x") for r in rows]


@pytest.mark.parametrize("size", [1, 3, 8])
def test_trie_matches_plain_python(spark, size):
    rows = conversations(size) + [(None, 1, "user", "none", 1, "x"), (7, 0, "user", "a", 1, "x"), (7, 0, "user", "a", 1, "x")]
    got = ct.prefix_trie(spark.createDataFrame(rows, SCHEMA), size).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_hot_keys_are_split_without_changing_the_trie(tight):
    rows = [(5 * i, t, "user", "same", 1, "x") for i in range(30) for t in range(10)] + [(3, t, "user", f"t{t % 3}", 1, "x") for t in range(150)]
    got = ct.prefix_trie(tight.createDataFrame(rows, SCHEMA), 4).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_tables_without_conversations(spark):
    assert ct.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    # Conversation 1 gives all its turns away and conversation 0 is absent: only the root is left.
    h = zlib.crc32(b"1") % 9
    got = ct.prefix_trie(spark.createDataFrame([(1, t, "user", "x", 1, "x") for t in range(h)], SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())]


def test_ends_of_a_large_node_are_chained_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(ct, "ENDS_BYTES", 200)
    ends = spark.range(1000).select(F.lit(1).cast("long").alias("e1"), (F.col("id") % 3).alias("e2"), (F.col("id") - 400).alias("c"))
    got = {r.x2: r.ends_sha256 for r in ct._ends_digests(ends).collect()}
    want = {k: hashlib.sha256(",".join(str(i - 400) for i in range(1000) if i % 3 == k).encode()).hexdigest() for k in range(3)}
    assert got == want
