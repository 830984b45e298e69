"""Keyed rules against brute force on random histories, with and without hot keys."""

from __future__ import annotations

import random
from datetime import timedelta

import brute
import pytest
from pyspark.sql import functions as F

from rillmark.operators import joins, keyed, windows

HOT = [None, 7]


def history(seed, n=600, keys=12, span=900):
    """Random rows; key 0 holds a third of them, timestamps repeat, and one instant is crowded."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if rng.random() < 0.34 else rng.randrange(1, keys)
        ts = 100 if rng.random() < 0.1 else rng.randrange(span)
        rows.append((i, key, ts, rng.random() < 0.5))
    return rows


def frame(spark, rows, value="entry boolean"):
    return spark.createDataFrame(rows, f"id bigint, k bigint, sec bigint, {value}").withColumn("ts", F.timestamp_seconds("sec"))


@pytest.mark.parametrize("hot", HOT)
@pytest.mark.parametrize("seed", [1, 2])
def test_bounces(spark, seed, hot):
    rows = history(seed)
    got = keyed.bounces(frame(spark, rows), "k", "ts", F.col("entry"), ["id"], timedelta(seconds=10), hot)
    assert sorted(r.id for r in got.collect()) == sorted(brute.bounces(rows, 10))


@pytest.mark.parametrize(
    "events,want",
    [
        ("E0", [0]), ("E0 N5", []), ("E0 N10", [0]), ("E0 E5", [0, 5]), ("E0 E5 N8", [0]), ("E0 E5 E9", [0, 5, 9]),
        ("N0 E3 N20", [3]),
    ],
)
def test_bounce_cases(spark, events, want):
    rows = [(i, 1, int(e[1:]), e[0] == "E") for i, e in enumerate(events.split())]
    got = keyed.bounces(frame(spark, rows), "k", "ts", F.col("entry"), ["id"], timedelta(seconds=10))
    assert sorted(r.sec for r in got.collect()) == want


@pytest.mark.parametrize("hot", HOT)
@pytest.mark.parametrize("seeded", [False, True])
def test_repair(spark, seeded, hot):
    rows = [(i, k, t, "1" if e else "0") for i, k, t, e in history(3)]
    got = keyed.repair_new_visitors(frame(spark, rows, "flag string"), "k", "flag", ["ts", "id"], seeded, hot)
    assert {r.id: r.flag for r in got.collect()} == brute.repaired(rows, seeded)


def test_repair_cases(spark):
    for before, after in (("1101", "1000"), ("011", "010")):
        rows = [(i, 1, i, c) for i, c in enumerate(before)]
        got = keyed.repair_new_visitors(frame(spark, rows, "flag string"), "k", "flag", ["ts", "id"])
        assert "".join(r.flag for r in sorted(got.collect(), key=lambda r: r.id)) == after


@pytest.mark.parametrize("hot", HOT)
@pytest.mark.parametrize("baseline", ["previous", "first"])
def test_deltas(spark, baseline, hot):
    rng = random.Random(5)
    rows = [(i, k, t, float(rng.randrange(40))) for i, k, t, _ in history(4)]
    got = keyed.delta_alerts(frame(spark, rows, "v double"), "k", "v", 10.0, ["ts", "id"], baseline, hot)
    assert {(r.id, r.last_value) for r in got.collect()} == brute.deltas(rows, 10, baseline)


@pytest.mark.parametrize("hot", HOT)
def test_flags_agree_with_single_operators(spark, hot):
    rows = [(i, k, t * 400, e) for i, k, t, e in history(6)]
    df = frame(spark, rows)
    within = timedelta(minutes=30)
    flags = keyed.visit_flags(df, "k", "ts", ["id"], F.col("entry"), within, hot).collect()
    daily = {r.id for r in keyed.daily_first_visits(df, "k", F.to_date("ts"), ["ts", "id"]).collect()}
    assert {r.id for r in flags if r.uv} == daily
    assert {r.id for r in flags if r.uj} == brute.bounces(rows, 1800)
    assert {r.id for r in flags if r.sv} == {r[0] for r in rows if r[3]}


@pytest.mark.parametrize("hot", HOT)
@pytest.mark.parametrize("lower,upper", [(-5, 5), (-900, 0), (3, 3)])
def test_interval_join(spark, lower, upper, hot):
    left, right = [r[:3] for r in history(7, 300)], [r[:3] for r in history(8, 300)]
    l = spark.createDataFrame(left, "a bigint, ak bigint, asec bigint").withColumn("ats", F.timestamp_seconds("asec"))
    r = spark.createDataFrame(right, "b bigint, bk bigint, bsec bigint").withColumn("bts", F.timestamp_seconds("bsec"))
    got = joins.interval_join(
        l, r, [("ak", "bk")], "ats", "bts", timedelta(seconds=lower), timedelta(seconds=upper), hot)
    pairs = [(x.a, x.b) for x in got.collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == brute.interval_pairs(left, right, lower, upper)


@pytest.mark.parametrize("hot", ["0", "5"])
def test_sessions(spark, hot):
    rows = history(9)
    if hot != "0":
        spark.conf.set("rillmark.hotRows", hot)
    try:
        got = windows.sessions(frame(spark, rows), ["k"], "ts", timedelta(seconds=6), "id").collect()
    finally:
        spark.conf.unset("rillmark.hotRows")
    found = {(r.k, int(r.session_start.timestamp()), int(r.session_end.timestamp()) - 6, r.n) for r in got}
    assert found == brute.sessions(rows, 6)


def test_null_keys_form_one_group(spark):
    rows = [(1, None, 0, True), (2, None, 20, True), (3, None, 22, False)]
    for hot in (None, 1):
        got = keyed.bounces(frame(spark, rows), "k", "ts", F.col("entry"), ["id"], timedelta(seconds=10), hot)
        assert [r.id for r in got.collect()] == [1]


@pytest.mark.parametrize("hot,small", [(None, None), (2, 1), (None, 1)])
def test_lookup_paths(spark, hot, small):
    fact = spark.createDataFrame([(i, i % 3 if i % 5 else None) for i in range(60)], "id int, f int")
    dim = spark.createDataFrame([(0, "zero"), (1, "one")], "pk int, name string")
    left = joins.lookup(fact, dim, "f", "pk", "left", max_rows=hot, max_broadcast=small)
    names = {0: "zero", 1: "one"}
    assert sorted((r.id, r.name) for r in left.collect()) == [
        (i, names.get(i % 3) if i % 5 else None) for i in range(60)]
    inner = joins.lookup(fact, dim, "f", "pk", "inner", max_rows=hot, max_broadcast=small)
    assert inner.count() == sum(1 for i in range(60) if i % 5 and i % 3 < 2)


def test_lookup_rejects_duplicates(spark):
    dim = spark.createDataFrame([(0, "a"), (0, "b")], "pk int, name string")
    with pytest.raises(ValueError):
        joins.lookup(spark.range(3), dim, "id", "pk")


def test_empty_inputs(spark):
    empty = frame(spark, [])
    assert keyed.bounces(empty, "k", "ts", F.col("entry"), ["id"], timedelta(seconds=1)).count() == 0
    assert windows.sessions(empty, ["k"], "ts", timedelta(seconds=1), "id").count() == 0


def test_hot_keys_are_found_on_a_sample(spark):
    from rillmark.operators.skew import hot_keys

    rows = spark.range(60_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    found = hot_keys(rows, [F.col("k")], 4000).collect()
    assert [r.hot_0 for r in found] == [0] and 15_000 < found[0].hot_n < 25_000
    assert hot_keys(rows, [F.col("k")], 40_000) is None


def test_hot_key_scan_on_a_sample(spark):
    """A third of the rows on one key, cut by sampled quantiles, still sums like a plain window."""
    from pyspark.sql import Window

    from rillmark.operators.aggregates import running_total

    rows = spark.range(40_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    spark.conf.set("rillmark.hotRows", "2000")
    try:
        got = running_total(rows, ["k"], F.col("id"), ["id"], "total")
        assert "_segment" in got._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("rillmark.hotRows")
    want = rows.withColumn("total", F.sum("id").over(Window.partitionBy("k").orderBy("id")))
    assert got.exceptAll(want).isEmpty() and got.count() == 40_000


def test_equal_rows_spread(spark):
    from rillmark.operators.skew import spread

    copies = spark.range(0, 800, 1, 16).select(F.lit("same").alias("v"))
    drawn = copies.select(spread(copies, 8).alias("s")).groupBy("s").count().collect()
    assert len(drawn) > 4 and sum(r["count"] for r in drawn) == 800
