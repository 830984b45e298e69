"""Rows packed for keyed processors, files and state partitions of the replays."""

from __future__ import annotations

import os
from datetime import date, datetime
from decimal import Decimal

import pandas as pd
from pyspark.sql import functions as F
from test_streams import feed

from rillmark.plans import layer_queries, stream_queries
from rillmark.streaming import jobs, processors, stateful


def test_packed_rows_are_the_rows(spark):
    """A task gives one blob a bucket, and a processor sees the values Spark would give it."""
    rows = [(i % 7, i, None if i % 5 == 0 else i, f"ä{i}", i / 3, datetime(2024, 1, 1, i % 24), date(2024, 1, 1 + i % 9), Decimal(i)) for i in range(700)]
    schema = "b int, id bigint, k bigint, s string, v double, t timestamp, d date, m decimal(9,2)"
    made = processors.packed(spark.createDataFrame(rows, schema).coalesce(1), "b").collect()
    assert sorted(r.b for r in made) == list(range(7))

    class Seen(stateful.StatefulProcessor):
        def init(self, handle):
            pass

        def handleInputRows(self, key, parts, timerValues):
            yield from parts

        def close(self):
            pass

    reader = processors.Unpacked(Seen(), "UTC")
    for r in made:
        (got,) = reader.handleInputRows((r.b,), iter([pd.DataFrame({"packed": [r.packed]})]), None)
        want = [x[1:] for x in rows if x[0] == r.b]
        assert list(got.columns) == ["id", "k", "s", "v", "t", "d", "m"] and str(got["t"].dtype).startswith("datetime64[")
        assert [tuple(None if pd.isna(v) else v for v in x) for x in got.itertuples(index=False)] == want


def test_processors_get_few_rows_for_many(spark, tmp_path):
    """The state operator reads blobs, not the rows themselves."""
    n = 8 * processors.BUCKETS
    stream = feed(spark, str(tmp_path / "in"), [[(i, i, 0, 1) for i in range(n)]], "id bigint, k bigint, sec bigint, v bigint")
    out = stateful.running_reduce(stream, ["k"], ["sec", "id"], ["id"], stateful.CountSum("v"))
    query = jobs.start(out, str(tmp_path / "job"), availableNow=True)
    jobs.drain(query)
    assert "MapInArrow" in query._jsq.explainInternal(False)
    assert spark.read.schema(out.schema).parquet(str(tmp_path / "job" / "out")).count() == n


def test_state_partitions_follow_the_cores_not_the_size():
    assert stream_queries.state_partitions(600, 12, False) == stream_queries.state_partitions(100, 12, False) == 24
    assert stream_queries.state_partitions(600, 64, False) == 64 and stream_queries.state_partitions(6, 64, False) == 6
    assert stream_queries.state_partitions(100, 8, True) == 8


def test_a_session_need_not_set_the_number_of_partitions(spark):
    """Spark has a default; what was not set before a query is not set after it, and what was is as it was."""
    key = "spark.sql.shuffle.partitions"
    before, cores = spark.conf.get(key), spark.sparkContext.defaultParallelism
    query = stream_queries.with_local_state(lambda s, d: s.conf.get(key))
    try:
        spark.conf.unset(key)
        unset = spark.conf.get(key, None)
        assert query(spark, "") == str(min(int(spark.conf.get(key)), cores))
        assert unset is None and spark.conf.get(key, None) is None
        spark.conf.set(key, "3")
        assert query(spark, "") == "3" and spark.conf.get(key) == "3"
    finally:
        spark.conf.set(key, before)


def test_slices_of_a_topic_have_files_for_their_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layer_queries, "ROWS_PER_FILE", 50)
    lines = spark.range(1000).select(F.col("id").alias("n"), F.col("id").cast("string").alias("value"))
    files = layer_queries._append_in_order(lines, "n", "t", str(tmp_path))
    assert files == 5
    assert len([f for f in os.listdir(tmp_path / "topic=t") if f.endswith(".parquet")]) == 4 * files
    assert layer_queries._append_in_order(lines.filter("n < 4"), "n", "u", str(tmp_path)) == layer_queries.FILES
