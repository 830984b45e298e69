"""Stateful processors over several micro-batches, against plain Python."""

from __future__ import annotations

import random
import time
from collections import defaultdict
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from test_streams import NOW, feed, history, with_ts

from rillmark.plans import state_queries, stream_queries
from rillmark.streaming import jobs, stateful, temporal

SECONDS = "id bigint, k bigint, sec bigint, v bigint"
#: Times must lie at least the horizon after 1970.
BASE = 1_700_000_000


def collect(spark, tmp_path, df):
    jobs.drain(jobs.start(df, str(tmp_path / "job"), **NOW))
    return spark.read.schema(df.schema).parquet(str(tmp_path / "job" / "out")).collect()


def test_windows_fire_again_for_late_rows(spark, tmp_path):
    """Three late batches: two re-fire the first window, the third comes after its close."""
    batches = [
        [(1, 0, 1, 10), (2, 0, 9, 20), (3, 1, 5, 1)],
        [(4, 0, 25, 1)],  # watermark 20: windows [0, 10) fire
        [(5, 0, 3, 5), (6, 0, 2, 7)],  # two accepted late rows
        [(7, 0, 31, 1)],  # watermark 26
        [(8, 1, 9, 100), (9, 2, 4, 9)],  # accepted: one window fired before, one never held a row
        [(10, 0, 60, 1)],  # watermark 55: closed
        [(11, 0, 8, 3), (12, 1, 8, None)],
    ]
    batches = [[(i, k, s + BASE, v) for i, k, s, v in rows] for rows in batches]
    stream = with_ts(feed(spark, str(tmp_path / "in"), batches, SECONDS))
    ten = timedelta(seconds=10)
    out = stateful.refiring_windows(stream, ["k"], "ts", ["sec", "id"], ten, timedelta(seconds=5), timedelta(seconds=20), stateful.CountSum("v"))
    got = sorted((r.k, r.window_end // 1000 - BASE, r.kind, r.fire or 0, r.n, r.total) for r in collect(spark, tmp_path, out))
    assert got == [
        (0, 10, "fire", 1, 2, 30), (0, 10, "fire", 2, 3, 37), (0, 10, "fire", 3, 4, 42), (0, 10, "too_late", 0, 1, 3), (0, 30, "fire", 1, 1, 1), (0, 40, "fire", 1, 1, 1),
        (1, 10, "fire", 1, 1, 1), (1, 10, "fire", 2, 2, 101), (1, 10, "too_late", 0, 1, 0), (2, 10, "fire", 1, 1, 9),
    ]


@pytest.mark.parametrize("accumulator", ["sum", "average", "max", "previous", "first"])
def test_running_reduce_gives_a_row_for_each_row(spark, tmp_path, accumulator):
    rng = random.Random(3)
    rows = [(i, k, s, rng.choice([None, 1, 5, 9])) for i, k, s, _ in history(3)]
    made = {
        "sum": stateful.CountSum("v"), "average": stateful.Average("v"), "max": stateful.MaxRow("v", "id"),
        "previous": stateful.Previous("v"), "first": stateful.Previous("v", first=True),
    }[accumulator]
    stream = feed(spark, str(tmp_path / "in"), [rows[i : i + 30][::-1] for i in range(0, len(rows), 30)], SECONDS)
    got = {r.id: tuple(r[2:]) for r in collect(spark, tmp_path, stateful.running_reduce(stream, ["k"], ["sec", "id"], ["id"], made))}
    seen, want = defaultdict(list), {}
    for i, k, _, v in rows:
        before, known = list(seen[k]), [(x, j) for j, x in seen[k] + [(i, v)] if x is not None]
        seen[k].append((i, v))
        top = max((x for x, _ in known), default=None)
        want[i] = {
            "sum": (len(before) + 1, sum(x for x, _ in known)),
            "average": (sum(x for x, _ in known) / len(known) if known else None, len(known)),
            "max": (top, next((j for x, j in known if x == top), None)),
            "previous": (before[-1][1] if before else None,),
            "first": (before[0][1] if before else None,),
        }[accumulator]
    assert got == want


def test_accumulators_merge_as_they_add():
    import pandas as pd

    rows = pd.DataFrame({"id": range(9), "v": [3, None, 8, 8, 1, None, 2, 7, 0]}, dtype="float64")
    for made in (stateful.CountSum("v"), stateful.Average("v"), stateful.MaxRow("v", "id")):
        parts = [made.add(made.zero(), rows.iloc[a:b]) for a, b in ((0, 0), (0, 2), (2, 5), (5, 9))]
        held = made.zero()
        for part in parts:
            held = made.merge(held, part)
        assert made.result(held) == made.result(made.add(made.zero(), rows)) == made.scan(made.zero(), rows)[0][-1]


@pytest.mark.parametrize("purge", [True, False])
def test_count_triggers(spark, tmp_path, purge):
    rows = history(4)
    stream = feed(spark, str(tmp_path / "in"), [[(i, k, s, i) for i, k, s, _ in rows[a : a + 25]] for a in range(0, len(rows), 25)], SECONDS)
    out = stateful.count_windows(stream, ["k"], ["sec", "id"], 4, stateful.CountSum("v"), purge)
    got = sorted((r.k, r.fire, r.n, r.total) for r in collect(spark, tmp_path, out))
    by_key = defaultdict(list)
    for i, k, *_ in rows:
        by_key[k].append(i)
    want = []
    for k, ids in by_key.items():
        for fire in range(len(ids) // 4):
            held = ids[4 * fire if purge else 0 : 4 * fire + 4]
            want.append((k, fire, len(held), sum(held)))
    assert got == sorted(want)


def test_time_triggers_fire_what_a_window_holds(spark, tmp_path):
    """Two rows are less than a full window; a processing-time timer lets them go, and the next two later."""
    folder, job = str(tmp_path / "in"), str(tmp_path / "job")
    stream = feed(spark, folder, [[(1, 0, 1, 10), (2, 0, 2, 20)]], SECONDS)
    out = stateful.count_windows(stream, ["k"], ["sec", "id"], 10, stateful.CountSum("v"), every=timedelta(seconds=1))
    found = jobs.run_until(spark, out, job, lambda done: done.count() == 1, 120)
    assert [tuple(r) for r in found.collect()] == [(0, 0, 2, 2, 30)]
    spark.createDataFrame([(3, 0, 3, 5)], SECONDS).write.mode("append").json(folder)
    found = jobs.run_until(spark, out, job, lambda done: done.count() == 2, 120)
    assert sorted(tuple(r) for r in found.collect()) == [(0, 0, 2, 2, 30), (0, 1, 1, 1, 5)]


def test_sessions_that_grow_together_merge(spark, tmp_path):
    batches = [[(1, 0, 0, 2), (2, 0, 100, 4)], [(3, 0, 30, 6), (4, 0, 210, None)], [(5, 0, 60, 8)], [(6, 0, 5000, 1)]]
    batches = [[(i, k, s + BASE, v) for i, k, s, v in rows] for rows in batches]
    stream = with_ts(feed(spark, str(tmp_path / "in"), batches, SECONDS))
    out = stateful.session_windows(stream, ["k"], "ts", ["id"], timedelta(seconds=40), timedelta(seconds=1000), stateful.Average("v"))
    got = sorted((r.session_start // 10**6 - BASE, r.session_end // 10**6 - BASE, r.average, r.n) for r in collect(spark, tmp_path, out))
    assert got == [(0, 140, 5.0, 4), (210, 250, None, 0)]


def test_changelog_folds_to_the_table(spark, tmp_path):
    rows = history(5)
    stream = feed(spark, str(tmp_path / "in"), [[(i, k, s, i) for i, k, s, _ in rows[a : a + 25]] for a in range(0, len(rows), 25)], SECONDS)
    log = collect(spark, tmp_path, stateful.retractions(stream, ["k"], ["sec", "id"], stateful.CountSum("v")))
    standing = defaultdict(int)
    for r in sorted(log, key=lambda r: (r.version, r.change)):
        standing[r.k, r.version, r.n, r.total] += r.change
    assert all(n in (0, 1) for n in standing.values())
    totals = defaultdict(lambda: [0, 0])
    for i, k, *_ in rows:
        totals[k][0] += 1
        totals[k][1] += i
    assert {(k, n, t) for (k, _, n, t), up in standing.items() if up} == {(k, *v) for k, v in totals.items()}


def test_first_rows_without_a_time_pass_once(spark, tmp_path):
    """Three batches, each with a row without a time: one passes, as in the batch operator."""
    batches = [[(1, 0, None, 0), (2, 0, 50, 0)], [(3, 0, None, 0), (4, 0, 90000, 0)], [(5, 0, None, 0), (6, 0, 90001, 0), (7, 1, 90002, 0)]]
    stream = with_ts(feed(spark, str(tmp_path / "in"), batches, SECONDS))
    out = stateful.daily_first_rows(stream, ["k"], "ts", ["id"], timedelta(days=2))
    assert sorted(r.id for r in collect(spark, tmp_path, out)) == [1, 2, 4, 7]


def test_versions_hold_from_their_time_on(spark, tmp_path):
    """Create, update and delete between the rows of one batch; equal times count as before the row."""
    text = "k bigint, sec bigint, pos bigint, what string"
    versions = [[(0, 10, 0, "a"), (0, 20, 0, "b")], [(0, 30, 0, None), (0, 30, 1, "c"), (0, 40, 0, None)], [(9, 10_000, 0, "end")]]
    rows = [[(0, s, i, str(s)) for i, s in enumerate((5, 10, 15, 20, 29, 30, 39, 40, 99))], [(1, 50, 50, "x")], [(9, 10_000, 99, "end")]]
    sides = []
    for side, table in ((temporal.LEFT, versions), (temporal.RIGHT, rows)):
        stream = with_ts(feed(spark, str(tmp_path / side), table, text))
        sides.append(temporal.tagged(stream, side, F.col("k"), "ts", F.col("pos"), F.col("what"), timedelta(seconds=100)))
    got = {(r.key, r.payload): r.version for r in collect(spark, tmp_path, temporal.as_of_join(*sides))}
    assert got == {(0, "5"): None, (0, "10"): "a", (0, "15"): "a", (0, "20"): "b", (0, "29"): "b", (0, "30"): "c", (0, "39"): "c", (0, "40"): None, (0, "99"): None, (1, "x"): None}


def test_pairs_match_in_either_order_and_time_out(spark, tmp_path):
    text = "k bigint, sec bigint, pos bigint, what string"
    left = [[(1, 10, 1, "l1"), (2, 10, 2, "l2")], [(3, 18, 3, "l3")], [(5, 400, 5, "l5")], [(9, 9000, 9, "e")]]
    right = [[(3, 12, 30, "r3"), (1, 20, 10, "r1"), (1, 15, 11, "r1b")], [(2, 99, 20, "r2")], [(4, 100, 40, "r4")], [(9, 9000, 90, "e")]]
    sides = []
    for side, table in ((temporal.LEFT, left), (temporal.RIGHT, right)):
        stream = with_ts(feed(spark, str(tmp_path / side), table, text))
        sides.append(temporal.tagged(stream, side, F.col("k"), "ts", F.col("pos"), F.col("what"), timedelta(seconds=100)))
    got = sorted((r.key, r.kind, r.left or "", r.right or "") for r in collect(spark, tmp_path, temporal.match_pairs(*sides, timedelta(seconds=10))) if r.key != 9)
    assert got == [(1, "match", "l1", "r1"), (1, "match", "l1", "r1b"), (2, "no_left", "", "r2"), (2, "no_right", "l2", ""), (3, "match", "l3", "r3"), (4, "no_left", "", "r4"), (5, "no_right", "l5", "")]


def test_changes_follow_a_snapshot_once(spark, tmp_path):
    """The log is read again from its start, and once more from its middle; the snapshot's chunks were read at 4 and 7."""
    log = [(1, p, 4, "update", f"a{p}") for p in range(1, 9)] + [(2, 3, 7, "update", "b3"), (2, 5, 7, "delete", None), (2, 9, 7, "update", "b9"), (3, 2, 7, "update", "c2")]
    schema = "k bigint, position bigint, cut bigint, type string, image string"
    stream = feed(spark, str(tmp_path / "in"), [log[:6], log[3:9], log[6:]], schema)
    snapshot = spark.createDataFrame([(1, 4, "a4"), (3, 2, "c2")], "k bigint, position bigint, image string")
    got = sorted(tuple(r) for r in collect(spark, tmp_path, temporal.after_snapshot(stream, snapshot, "k")))
    assert got == [(1, p, "update", f"a{p - 1}", f"a{p}") for p in range(5, 9)] + [(2, 9, "update", None, "b9")]


def test_chained_joins_evict_their_state(spark, sf_dir, tmp_path):
    def query(spark, d):
        streams, build = state_queries.chained_joins(spark, d)
        progress = []
        return stream_queries.run_to_end(spark, streams, str(tmp_path / "job"), ["ts"] * 3, build, progress).count(), progress

    rows, progress = stream_queries.with_local_state(query)(spark, sf_dir)
    held = [sum(o.numRowsTotal for o in p.stateOperators) for p in progress if len(p.stateOperators) == 2]
    gone = sum(o.numRowsRemoved for p in progress for o in p.stateOperators)
    added = sum(o.numRowsUpdated for p in progress for o in p.stateOperators)
    # With the feeds' true delay most of what the joins held has gone again.
    assert rows > 0 and gone > added / 2 and held[-1] < max(held) and held[-1] < added / 4


def test_state_goes_on_after_a_stop(spark, tmp_path):
    rows = history(8)
    batches = [[(i, k, s, i) for i, k, s, _ in rows[a : a + 20]] for a in range(0, len(rows), 20)]
    stream = feed(spark, str(tmp_path / "in"), batches, SECONDS)
    out, job = stateful.running_reduce(stream, ["k"], ["sec", "id"], ["id"], stateful.CountSum("v")), str(tmp_path / "job")
    jobs.run_batches(out, job, 2)
    before = len(jobs.committed_batches(spark, job))
    assert before >= 2
    time.sleep(0.1)
    jobs.drain(jobs.start(out, job, **NOW))
    got = {r.id: r.total for r in spark.read.schema(out.schema).parquet(f"{job}/out").collect()}
    totals, want = defaultdict(int), {}
    for i, k, *_ in rows:
        totals[k] += i
        want[i] = totals[k]
    assert got == want
