"""Keys handled a bucket at a time: few state values and calls, whatever the number of keys, and each key's own result."""

from __future__ import annotations

import random
from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_streams import NOW, feed, with_ts

from rillmark.streaming import jobs, processors, stateful, temporal

SECONDS = "id bigint, k bigint, sec bigint, v bigint"


def run(spark, tmp_path, df):
    jobs.drain(jobs.start(df, str(tmp_path / "job"), **NOW))
    state = spark.read.format("statestore").option("path", str(tmp_path / "job" / "checkpoint"))
    return spark.read.schema(df.schema).parquet(str(tmp_path / "job" / "out")).collect(), state


def test_state_values_do_not_grow_with_the_keys(spark, tmp_path):
    keys = 4 * processors.BUCKETS
    batches = [[(b * keys + k, k, b, k % 7 + b) for k in range(keys)] for b in range(2)]
    out = stateful.running_reduce(feed(spark, str(tmp_path / "in"), batches, SECONDS), ["k"], ["sec", "id"], ["id"], stateful.CountSum("v"))
    got, state = run(spark, tmp_path, out)
    assert {r.id: (r.k, r.n, r.total) for r in got} == {b * keys + k: (k, b + 1, (b + 1) * (k % 7) + b) for b in range(2) for k in range(keys)}
    assert state.option("stateVarName", "held").load().count() <= processors.BUCKETS


def test_pairs_of_many_keys(spark, tmp_path):
    keys = 4 * processors.BUCKETS
    base = 1_700_000_000
    sides = []
    for side, rows in ((temporal.LEFT, [(k, k, base + k % 5, None) for k in range(keys) if k % 3]), (temporal.RIGHT, [(k, k, base + k % 5 + k % 20, None) for k in range(keys)])):
        stream = with_ts(feed(spark, str(tmp_path / side), [rows, [(10**6, -1, base + 10**4, None)]], SECONDS))
        sides.append(temporal.tagged(stream, side, F.col("k"), "ts", F.col("id"), F.col("k").cast("string"), timedelta(seconds=1)))
    got, _ = run(spark, tmp_path, temporal.match_pairs(*sides, timedelta(seconds=10)))
    met = {k for k in range(keys) if k % 3 and k % 20 <= 10}
    want = [(k, "match", str(k), str(k)) for k in met] + [(k, "no_left", None, str(k)) for k in range(keys) if k not in met]
    want += [(k, "no_right", str(k), None) for k in range(keys) if k % 3 and k not in met]
    assert sorted((r.key, r.kind, r.left or "", r.right or "") for r in got if r.key >= 0) == sorted((k, kind, a or "", b or "") for k, kind, a, b in want)


def test_a_key_with_many_rows_is_the_work_of_many_tasks(spark, tmp_path):
    """All rows of an as-of join have one key; its parts lie in many buckets."""
    base = 1_700_000_000
    versions = with_ts(feed(spark, str(tmp_path / "v"), [[(0, 1, base, 0), (1, 1, base + 50, 1)]], SECONDS))
    rows = with_ts(feed(spark, str(tmp_path / "r"), [[(i, 1, base + i % 100, i) for i in range(500)]], SECONDS))
    second = timedelta(seconds=1)
    sides = [temporal.tagged(s, side, F.col("k"), "ts", F.col("id"), F.col("v").cast("string"), second) for s, side in ((versions, temporal.LEFT), (rows, temporal.RIGHT))]
    got, state = run(spark, tmp_path, temporal.as_of_join(*sides))
    assert all(r.version == str(int(r.pos % 100 >= 50)) for r in got)
    held = state.option("stateVarName", "waiting").load()
    assert held.count() > 10 and len(got) + held.agg(F.sum(F.size("value.at"))).first()[0] == 500


def test_a_null_key_leaves_the_keys_of_its_bucket_whole(spark, tmp_path):
    """Beside a NULL, whole numbers come as floats; the state must hold them as whole numbers."""
    rows = [[(k, None if k % 3 == 0 else k, b, 1) for k in range(600)] for b in range(3)]
    out = stateful.running_reduce(feed(spark, str(tmp_path / "in"), rows, SECONDS), ["k"], ["sec", "id"], ["id"], stateful.CountSum("v"))
    got, _ = run(spark, tmp_path, out)
    assert {(r.k, r.id, r.n) for r in got if r.k is not None} == {(k, k, b) for k in range(600) if k % 3 for b in (1, 2, 3)}
    assert sorted(r.n for r in got if r.k is None) == list(range(1, 601))


def test_stores_of_an_executor_share_bounded_memory(spark):
    from rillmark.plans.stream_queries import with_local_state
    from rillmark.session import BOUND_MB, BOUND_MB_CONF, BOUNDED_CONF

    before = {k: spark.conf.get(k, None) for k in (BOUNDED_CONF, BOUND_MB_CONF)}
    spark.conf.unset(BOUNDED_CONF)
    try:
        assert with_local_state(lambda s, d: (s.conf.get(BOUNDED_CONF), s.conf.get(BOUND_MB_CONF)))(spark, "") == ("true", BOUND_MB)
    finally:
        spark.conf.set(BOUNDED_CONF, before[BOUNDED_CONF])
    assert {k: spark.conf.get(k, None) for k in before} == before


class Product(stateful.Accumulator):
    """A user's accumulator without group methods."""

    state = output = "p bigint"

    def zero(self):
        return (1,)

    def add(self, held, rows):
        return (held[0] * int(rows["v"].fillna(1).prod()) % 1009,)

    def merge(self, a, b):
        return (a[0] * b[0] % 1009,)


@pytest.mark.parametrize("made", [stateful.CountSum("v"), stateful.Average("v"), stateful.MaxRow("v", "id"), stateful.Previous("v"), stateful.Previous("v", True), stateful.SeenBefore("v", 5), Product()])
def test_group_methods_do_as_the_single_ones(made):
    rng = random.Random(7)
    group = np.repeat([2, 0, 3], [4, 1, 6])
    for _ in range(20):
        rows = [pd.DataFrame({"id": range(11), "v": pd.Series([rng.choice([None, 1, 5, 5, 9]) for _ in range(11)], dtype="float64")}) for _ in range(2)]
        held, single = made.zeros(5), [made.zero()] * 5
        for part in rows:
            results, after = made.scan_groups(held, part, group)
            added = made.add_groups(held, part, group)
            want = []
            for g in (2, 0, 3):
                out, single[g] = made.scan(single[g], part[group == g])
                want += out
            assert stateful._tuples(results) == [tuple(None if pd.isna(v) else v for v in r) for r in want]
            assert stateful._tuples(after) == stateful._tuples(added) == [tuple(None if pd.isna(v) else v for v in h) for h in single]
            held = after
        if not isinstance(made, stateful.Previous | stateful.SeenBefore):
            merged = made.merge_groups(held.iloc[[0, 2, 3]].reset_index(drop=True), np.array([0, 0, 1]))
            assert stateful._tuples(merged) == [made.merge(single[0], single[2]), single[3]]
