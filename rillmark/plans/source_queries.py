"""Sources and sinks over the driver tables: each writes a table's rows and reads them back."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillmark.operators import aggregates, distribution, joins, records, windows
from rillmark.plans import stand_ins as sample
from rillmark.plans.stream_queries import NOW, event_stream, with_local_state
from rillmark.session import scratch_dir
from rillmark.sources import tables, topics
from rillmark.streaming import jobs
from rillmark.streaming.snapshot import KeyedSnapshot

DAY = timedelta(days=1)
READING = "event_id bigint, user_id bigint, value double"


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return sample.events(spark, d).select(F.concat_ws(",", "event_id", "user_id", "value").alias("value"))


def text_lines_source(spark: SparkSession, d: str) -> DataFrame:
    """Rows written as lines of text and read back as typed rows."""
    path = scratch_dir(spark, "lines")
    _lines(spark, d).write.text(path)
    parts = F.split("value", ",")
    return tables.text_lines(spark, path).select(
        F.get(parts, F.lit(0)).cast("bigint").alias("event_id"), F.get(parts, F.lit(1)).cast("bigint").alias("user_id"), F.get(parts, F.lit(2)).cast("double").alias("value"))


def line_stream_source(spark: SparkSession, d: str) -> DataFrame:
    """The same lines as a stream, a file in each micro-batch."""
    path, job = scratch_dir(spark, "lines"), scratch_dir(spark, "line-stream")
    _lines(spark, d).repartition(4).write.text(path)
    parts = F.split("value", ",")
    rows = tables.line_stream(spark, path).select(F.get(parts, F.lit(0)).cast("bigint").alias("event_id"), F.get(parts, F.lit(2)).cast("double").alias("value"))
    jobs.drain(jobs.start(rows, job, **NOW))
    return spark.read.schema("event_id bigint, value double").parquet(f"{job}/out")


def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The CSV sink and the CSV source with a declared schema, queried by its view's name."""
    path = scratch_dir(spark, "csv")
    tables.write_csv(sample.events(spark, d).select("event_id", "user_id", "value"), path)
    tables.csv_table(spark, path, READING, "csv_readings")
    return tables.query_rows(spark, "select event_id, user_id, value from csv_readings")


def topic_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """A topic written by one stream and read by another from the start."""
    root = scratch_dir(spark, "topic")
    text = event_stream(spark, d).select(F.to_json(F.struct("event_id", "user_id", "value")).alias("value"))
    jobs.drain(topics.topic_sink(text, "readings", f"{root}/write", root, **NOW))
    rows = records.typed_rows(topics.topic_source(spark, "readings", root, per_batch=2), "value", READING, "position")
    jobs.drain(jobs.start(rows, f"{root}/read", **NOW))
    read = spark.read.schema(rows.schema).parquet(f"{root}/read/out")
    once = F.count(F.lit(1)).over(Window.partitionBy("position")) == 1
    return read.select("event_id", "user_id", "value", once.alias("own_position"))


def window_result_sink(spark: SparkSession, d: str) -> DataFrame:
    """Updated window counts written by window date; the newest batch of a window stands."""
    job = scratch_dir(spark, "window-dates")
    rows = windows.with_event_time(event_stream(spark, d).select("user_id", "ts"), "ts", timedelta(0))
    counted = windows.window_counts(rows, ["user_id"], windows.tumbling("ts", DAY))
    stamped = counted.select("user_id", F.unix_seconds("window_end").alias("window_end"), "n")
    write = jobs.window_date_writer(f"{job}/out", F.to_date(F.timestamp_seconds("window_end")))
    jobs.drain(jobs.start_batches(stamped, job, write, mode="update", **NOW))
    return jobs.latest_updates(spark.read.parquet(f"{job}/out").drop("dt"), ["user_id", "window_end"])


def lookup_after_update(spark: SparkSession, d: str) -> DataFrame:
    """Orders looked up in a keyed table after a second batch has changed and deleted customers."""
    held = KeyedSnapshot(spark, scratch_dir(spark, "customers"), ["c_custkey"], "c_custkey bigint, c_name string")
    customers = sample.table(spark, d, "customer").select("c_custkey", "c_name", F.lit(1).alias("v"))
    held.upsert(customers.withColumn("type", F.lit("insert")), 0, ["v"])
    kind = F.when(F.col("c_custkey") % 5 == 0, "delete").otherwise("update")
    second = customers.filter("c_custkey % 3 = 0").withColumns({"type": kind, "c_name": F.concat(F.lit("new "), "c_name"), "v": F.lit(2)})
    held.upsert(second, 1, ["v"])
    orders = sample.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return joins.lookup(orders, held.read(), "o_custkey", "c_custkey").select("o_orderkey", "c_name")


def gathered_rows(spark: SparkSession, d: str) -> DataFrame:
    """A small aggregate brought to one task, which numbers its rows."""
    small = sample.table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    one = distribution.gather(small)
    return aggregates.partition_running_counter(one, "place").agg(F.max("place").alias("rows"), F.sum("n").alias("n"))


SOURCES = {
    f.__name__: with_local_state(f)
    for f in (text_lines_source, line_stream_source, csv_round_trip, topic_round_trip, window_result_sink, lookup_after_update, gathered_rows)
}

_READINGS = "select event_id, user_id, value from events"
SOURCE_ORACLES = {
    "text_lines_source": _READINGS,
    "line_stream_source": "select event_id, value from events",
    "csv_round_trip": _READINGS,
    "topic_round_trip": "select event_id, user_id, value, true as own_position from events",
    "window_result_sink": """
select user_id, cast(epoch(cast(ts as date) + interval 1 day) as bigint) as window_end, count(*) as n from events group by all""",
    "lookup_after_update": """
select o_orderkey, case when c_custkey % 3 <> 0 then c_name when c_custkey % 5 <> 0 then 'new ' || c_name end as c_name
from orders left join customer on o_custkey = c_custkey""",
    "gathered_rows": "select count(distinct o_orderstatus) as rows, count(*) as n from orders",
}
