"""Streams over several micro-batches: parity, late rows, restart, snapshots."""

from __future__ import annotations

import random
import time
from datetime import timedelta

import brute
import pytest
from pyspark.sql import functions as F

from rillmark.operators import cdc, joins, keyed, windows
from rillmark.sources import topics
from rillmark.streaming import jobs, processors, stateful
from rillmark.streaming.snapshot import KeyedSnapshot

NOW = {"availableNow": True}
SCHEMA = "id bigint, k bigint, sec bigint, entry boolean"


def feed(spark, folder, batches, schema=SCHEMA):
    """One file per micro-batch, in the order given."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(folder)
        time.sleep(0.05 if i + 1 < len(batches) else 0)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)


def with_ts(df):
    return df.withColumn("ts", F.timestamp_seconds("sec"))


def history(seed, n=120, disorder=0):
    rng = random.Random(seed)
    rows = [(i, rng.choice([0, 0, 1, 2, 3]), i * 2 + rng.randrange(2), rng.random() < 0.6) for i in range(n)]
    return sorted(rows, key=lambda r: r[2] + rng.uniform(0, disorder))


def chunks(rows, size=30):
    return [rows[i:i + size] for i in range(0, len(rows), size)]


def _read(spark, job, schema):
    return spark.read.schema(schema).parquet(f"{job}/out").collect()


def test_repair_in_event_order(spark, tmp_path):
    rows = history(1)
    job = str(tmp_path / "job")
    stream = with_ts(feed(spark, str(tmp_path / "in"), chunks(rows))).withColumn("flag", F.when(F.col("entry"), "1").otherwise("0"))
    out = stateful.running_reduce(stream, ["k"], ["ts", "id"], ["id", "flag"], stateful.SeenBefore("flag", "1"))
    jobs.drain(jobs.start(out, job, **NOW))
    got = {r.id: "0" if r.flag == "1" and r.seen_before else r.flag for r in _read(spark, job, out.schema)}
    assert got == brute.repaired([(i, k, s, "1" if e else "0") for i, k, s, e in rows])


def test_first_rows_of_a_day(spark, tmp_path):
    # Spark's watermark starts at 1970 and drops rows at that very time.
    rows = [(i, k, 19_000 * 86_400 + s * 900, e) for i, k, s, e in history(2)]
    job = str(tmp_path / "job")
    stream = with_ts(feed(spark, str(tmp_path / "in"), chunks(rows)))
    out = stateful.daily_first_rows(stream, ["k"], "ts", ["id"], timedelta(seconds=2))
    jobs.drain(jobs.start(out, job, **NOW))
    batch = keyed.daily_first_visits(with_ts(spark.createDataFrame(rows, SCHEMA)), "k", F.to_date("ts"), ["ts", "id"])
    got = sorted(r.id for r in _read(spark, job, out.schema))
    assert got == sorted(r.id for r in batch.collect()) and len(got) > 4


def test_interval_join_stream_with_window(spark, tmp_path):
    left, right = [(r[0], r[1], r[2]) for r in history(7)], [(r[0], r[1], r[2]) for r in history(8)]
    l = feed(spark, str(tmp_path / "l"), chunks(left), "a bigint, ak bigint, asec bigint").withColumn("ats", F.timestamp_seconds("asec"))
    r = feed(spark, str(tmp_path / "r"), chunks(right), "b bigint, bk bigint, bsec bigint").withColumn("bts", F.timestamp_seconds("bsec"))
    lower, upper = timedelta(seconds=-5), timedelta(seconds=5)
    delay = timedelta(seconds=30)
    joined = joins.interval_join(
        windows.with_event_time(l, "ats", delay), windows.with_event_time(r, "bts", delay), [("ak", "bk")], "ats", "bts", lower, upper)
    jobs.drain(jobs.start(joined, str(tmp_path / "job"), **NOW))
    got = [(x.a, x.b) for x in spark.read.parquet(str(tmp_path / "job/out")).collect()]
    assert len(got) == len(set(got)) and set(got) == brute.interval_pairs(left, right, -5, 5)


def test_restart_continues(spark, tmp_path):
    rows = history(9)
    src, job = str(tmp_path / "in"), str(tmp_path / "job")
    for part in chunks(rows, 60):
        stream = with_ts(feed(spark, src, [part])).withColumn("flag", F.when(F.col("entry"), "1").otherwise("0"))
        out = stateful.running_reduce(stream, ["k"], ["ts", "id"], ["id", "flag"], stateful.SeenBefore("flag", "1"))
        jobs.drain(jobs.start(out, job, **NOW))
    got = [(r.id, "0" if r.flag == "1" and r.seen_before else r.flag) for r in _read(spark, job, out.schema)]
    assert len(got) == len(rows)
    assert dict(got) == brute.repaired([(i, k, s, "1" if e else "0") for i, k, s, e in rows])


def test_snapshot_upserts(spark, tmp_path):
    table = KeyedSnapshot(spark, str(tmp_path / "t"), ["k"], "k bigint, a string, b string")
    schema = "k bigint, type string, v int, a string, b string"

    def put(rows, batch_id):
        table.upsert(spark.createDataFrame(rows, schema), batch_id, ["v"])
        return sorted(tuple(r) for r in table.read().collect())

    assert table.read().count() == 0
    assert put([(1, "insert", 1, "x", "y"), (2, "insert", 1, "p", "q"), (1, "update", 2, None, "z")], 0) == [(1, "x", "z"), (2, "p", "q")]
    assert put([(2, "update", 3, "P", None)], 1) == [(1, "x", "z"), (2, "P", "q")]
    assert put([(2, "update", 9, "again", None)], 1) == [(1, "x", "z"), (2, "P", "q")]
    assert put([(1, "delete", 4, None, None), (2, "delete", 4, None, None), (2, "insert", 5, "n", None)], 2) == [(2, "n", None)]
    assert put([(2, "delete", 6, None, None)], 3) == []
    assert [tuple(r) for r in table.read(below=2).orderBy("k").collect()] == [(1, "x", "z"), (2, "P", "q")]
    assert put([(3, "read", 1, "r", "s")], 4) == [(3, "r", "s")]


def test_snapshot_matches_one_pass_fold(spark, tmp_path):
    rng = random.Random(11)
    rows = [(rng.randrange(9), rng.choice(["insert", "update", "update", "delete"]), v,
             rng.choice([None, f"a{v}"]), rng.choice([None, f"b{v}"])) for v in range(120)]
    schema = "k bigint, type string, v int, a string, b string"
    table = KeyedSnapshot(spark, str(tmp_path / "t"), ["k"], "k bigint, a string, b string")
    for i, part in enumerate(chunks(rows, 40)):
        table.upsert(spark.createDataFrame(part, schema), i, ["v"])
    held = {}
    for k, kind, _, a, b in rows:
        if kind == "delete":
            held.pop(k, None)
        else:
            old = held.get(k, (None, None))
            held[k] = (old[0] if a is None else a, old[1] if b is None else b)
    assert {r.k: (r.a, r.b) for r in table.read().collect()} == held
    folded = cdc.latest_per_key(spark.createDataFrame(rows, schema), ["k"], ["v"], ["a", "b"]).filter("not deleted")
    assert {r.k: (r.a, r.b) for r in folded.collect()} == held


def test_lookup_sees_snapshot_updates(spark, tmp_path):
    """A dimension read inside each batch shows updates and deletes to the next lookup."""
    table = KeyedSnapshot(spark, str(tmp_path / "dim"), ["pk"], "pk bigint, name string")
    schema = "pk bigint, type string, v int, name string"
    facts = feed(spark, str(tmp_path / "in"), [[(i, 1, i, True)] for i in range(3)])
    steps = [[(1, "insert", 1, "old")], [(1, "update", 2, "new")], [(1, "delete", 3, None)]]

    def write(df, batch_id):
        table.upsert(spark.createDataFrame(steps[batch_id], schema), batch_id, ["v"])
        jobs.batch_writer(str(tmp_path / "out"))(joins.lookup(df, table.read(), "k", "pk"), batch_id)

    jobs.drain(jobs.start_batches(facts, str(tmp_path / "job"), write, **NOW))
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("id").collect()
    assert [r.name for r in got] == ["old", "new", None]


def test_topics_round_trip(spark, tmp_path):
    root = str(tmp_path / "topics")
    topics.append_topic(spark.createDataFrame([("a",), ("b",)], "value string"), "raw", root)
    stream = topics.topic_source(spark, "raw", root=root, per_batch=1)
    routed = stream.withColumn("sinkTable", F.when(F.col("value") == "a", "first"))
    out = str(tmp_path / "out")
    jobs.drain(topics.routed_topic_sink(routed, "rest", str(tmp_path / "cp"), root=out, **NOW))
    assert topics.topic_table(spark, "first", out, routed=True).first()[0] == "a"
    assert topics.topic_table(spark, "rest", out, routed=True).first()[0] == "b"
    again = topics.topic_source(spark, "rest", root=out, routed=True)
    jobs.drain(topics.topic_sink(again, "copy", str(tmp_path / "cp2"), root=root, **NOW))
    jobs.drain(topics.topic_sink(again, "other", str(tmp_path / "cp3"), root=root, **NOW))
    assert [topics.topic_table(spark, t, root).first()[0] for t in ("copy", "other")] == ["b", "b"]


def test_topic_positions_are_unique_and_keep_file_order(spark, tmp_path):
    """Many tasks write at the same time; each record has a position of its own, in the order of its file."""
    root = str(tmp_path / "topics")
    for start in (0, 4000):
        topics.append_topic(spark.range(start, start + 4000, 1, 32).select(F.col("id").cast("string").alias("value")), "raw", root)
    stream = topics.topic_source(spark, "raw", root=root)
    jobs.drain(jobs.start(stream.select("value", "position"), str(tmp_path / "job"), **NOW))
    rows = sorted((r.position, int(r.value)) for r in spark.read.parquet(str(tmp_path / "job/out")).collect())
    assert len({p for p, _ in rows}) == len(rows) == 8000
    by_file = {}
    for position, value in rows:
        by_file.setdefault(position[:-21], []).append(value)
    assert len(by_file) == 64 and all(v == sorted(v) for v in by_file.values())
    assert {v for _, v in rows[:4000]} == set(range(4000))


def _collect(spark, tmp_path, df):
    jobs.drain(jobs.start(df, str(tmp_path / "job"), **NOW))
    return spark.read.parquet(str(tmp_path / "job/out")).collect()


def test_repair_processor(spark, tmp_path):
    rows = history(12)
    stream = feed(spark, str(tmp_path / "in"), chunks(rows)).select("id", "k", "sec", F.when(F.col("entry"), "1").otherwise("0").alias("flag"))
    got = {r.id: r.flag for r in _collect(spark, tmp_path, processors.repair_stream(stream, "k", "flag"))}
    assert got == brute.repaired([(i, k, s, "1" if e else "0") for i, k, s, e in rows])


def test_daily_visit_processor(spark, tmp_path):
    rows = [(i, k, s * 900, e) for i, k, s, e in history(13)]
    stream = with_ts(feed(spark, str(tmp_path / "in"), chunks(rows))).select("id", "k", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    got = sorted(r.id for r in _collect(spark, tmp_path, processors.daily_visit_stream(stream, "k", "day", None)))
    batch = keyed.daily_first_visits(with_ts(spark.createDataFrame(rows, SCHEMA)), "k", F.to_date("ts"), ["ts", "id"])
    assert got == sorted(r.id for r in batch.collect())


def test_state_expires(spark, tmp_path):
    """An expired day reads as absent, so the same day passes again."""
    stream = feed(spark, str(tmp_path / "in"), [[(1, "d")]], "k bigint, day string")
    df = processors.daily_visit_stream(stream, "k", "day", timedelta(seconds=2))
    query = df.writeStream.option("checkpointLocation", str(tmp_path / "cp")).format("memory").queryName("expiring").start()
    try:
        _until(lambda: spark.table("expiring").count() == 1)
        time.sleep(4)
        spark.createDataFrame([(1, "d")], "k bigint, day string").write.mode("append").json(str(tmp_path / "in"))
        _until(lambda: spark.table("expiring").count() == 2)
    finally:
        query.stop()


def _until(condition, seconds=60):
    end = time.time() + seconds
    while not condition():
        assert time.time() < end, "condition not reached"
        time.sleep(0.5)


@pytest.mark.parametrize("baseline", ["previous", "first"])
def test_delta_processor(spark, tmp_path, baseline):
    rng = random.Random(14)
    rows = [(i, k, s, float(rng.randrange(30))) for i, k, s, _ in history(14)]
    stream = feed(spark, str(tmp_path / "in"), chunks(rows), "id bigint, k bigint, sec bigint, v double")
    got = sorted((r.last, r.current) for r in _collect(spark, tmp_path, processors.delta_stream(stream, "k", "v", 10.0, baseline)))
    by_id = {r[0]: r[3] for r in rows}
    assert got == sorted((last, by_id[i]) for i, last in brute.deltas(rows, 10, baseline))


def test_bounce_processor(spark, tmp_path):
    rows = history(15, disorder=10)
    src = str(tmp_path / "in")
    batches = [*chunks(rows), [(-1, -1, 10_000_000, False)]]
    stream = with_ts(feed(spark, src, batches))
    stream = stream.withColumn("text", F.col("id").cast("string"))
    out = processors.bounce_stream(stream, "k", "ts", "id", "entry", "text", timedelta(seconds=10), timedelta(seconds=600))
    got = [r.tie for r in _collect(spark, tmp_path, out)]
    assert len(got) == len(set(got)) and set(got) == brute.bounces(rows, 10)


def test_replays_come_in_several_batches(spark, sf_dir, tmp_path):
    from rillmark.plans.stream_queries import BATCHES, table_stream

    tops = {}

    def note(df, batch_id):
        tops[batch_id] = df.agg(F.min("ts").alias("low"), F.max("ts").alias("high"), F.count(F.lit(1)).alias("n")).first()

    jobs.drain(jobs.start_batches(table_stream(spark, sf_dir, "events"), str(tmp_path), note, availableNow=True))
    seen = [tops[i] for i in sorted(tops) if tops[i].n]
    assert len(seen) == BATCHES and sum(r.n for r in seen) == spark.read.parquet(f"{sf_dir}/events.parquet").count()
    assert all(a.high <= b.low for a, b in zip(seen, seen[1:]))


def test_queries_leave_the_session_alone(spark, sf_dir):
    from rillmark.plans.stream_queries import STREAM

    spark.conf.set("spark.sql.shuffle.partitions", "33")
    try:
        STREAM["log_topics_stream"](spark, sf_dir)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "33"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_snapshot_keeps_its_columns_and_versions(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.createDataFrame([(i, "a", "b", "insert", 1) for i in range(20)], "k bigint, a string, b string, type string, v int")
    KeyedSnapshot(spark, root, ["k"], "k bigint, a string, b string").upsert(rows, 0, ["v"])
    narrow = KeyedSnapshot(spark, root, ["k"], "k bigint, a string, c int")
    assert narrow.schema.names == ["k", "a", "b", "c"]
    changes = rows.select("k", F.lit("A").alias("a"), F.lit(7).alias("c"), F.lit("update").alias("type"), F.lit(2).alias("v"))
    narrow.upsert(changes, 1, ["v"])
    narrow.upsert(changes.withColumn("a", F.lit("again")), 1, ["v"])
    assert {tuple(r) for r in narrow.read().collect()} == {(i, "A", "b", 7) for i in range(20)}
    assert {r.a for r in narrow.read(below=1).collect()} == {"a"}
    narrow.clear(2)
    assert narrow.read().count() == 0 and narrow.read(below=2).count() == 20
    narrow.prune()
    assert narrow.version(below=2) is None and narrow.version() == 2
    with pytest.raises(ValueError):
        KeyedSnapshot(spark, root, ["k"], "k bigint, a int")


def test_snapshot_sets_null_and_orders_ties(spark, tmp_path):
    held = KeyedSnapshot(spark, str(tmp_path / "t"), ["k"], "k bigint, a string, b string")
    schema = "k bigint, type string, ts bigint, position bigint, data map<string,string>"
    sets = lambda c: F.map_contains_key("data", F.lit(c))

    def apply(number, *changes):
        rows = spark.createDataFrame(list(changes), schema).withColumns({c: F.col("data")[c] for c in ("a", "b")})
        held.upsert(rows, number, ["ts", "position"], sets)

    apply(0, (1, "insert", 5, 0, {"a": "x", "b": "y"}), (2, "insert", 5, 1, {"a": "x"}), (3, "insert", 5, 2, {"a": "zz"}), (3, "update", 5, 3, {"a": "aa"}))
    apply(1, (1, "update", 6, 4, {"a": None}), (2, "delete", 6, 5, {}), (2, "insert", 6, 6, {"b": "new"}))
    assert sorted(tuple(r) for r in held.read().collect()) == [(1, None, "y"), (2, None, "new"), (3, "aa", None)]


def test_fan_out_loses_no_rows(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "tag string, n int")
    got = {}
    keep = lambda name: lambda df, _: got.__setitem__(name, sorted(r.n for r in df.collect()))
    jobs.fan_out("tag", {"a": keep("a")}, keep("rest"))(rows, 0)
    assert got == {"a": [1], "rest": [2, 3]}
    with pytest.raises(ValueError):
        jobs.fan_out("tag", {"a": keep("a")})(rows, 0)
