"""Running streams: replays to completion and per-batch sinks.

State that must survive between micro-batches is in Spark's state store (see
``processors``, ``stateful`` and ``temporal``). A sink writes a folder per
batch id, so a batch that is run again after a failure gives the same result.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from rillmark.functions.times import as_interval
from rillmark.streaming.files import children, exists
from rillmark.streaming.snapshot import KeyedSnapshot

CHECKPOINT_INTERVAL = "5 seconds"
END_OF_TIME = "2200-01-01 00:00:00"


def start(df: DataFrame, job: str, mode: str = "append", path: str | None = None, **trigger) -> StreamingQuery:
    """Append a stream to Parquet with the job's checkpoint; 5-second batches by default."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", f"{job}/checkpoint")
    writer = writer.trigger(**(trigger or {"processingTime": CHECKPOINT_INTERVAL}))
    return writer.format("parquet").start(path or f"{job}/out")


def start_batches(df: DataFrame, job: str, write: Callable[[DataFrame, int], None], mode: str = "append", **trigger):
    """Hand every micro-batch and its id to ``write``, under the job's checkpoint."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", f"{job}/checkpoint")
    return writer.trigger(**(trigger or {"processingTime": CHECKPOINT_INTERVAL})).foreachBatch(write).start()


def drain(query: StreamingQuery) -> None:
    """Wait for a query started with ``availableNow`` and raise its failure."""
    query.awaitTermination()


def replay_batches(rows: DataFrame, batch: str, folder: str, rows_per_file: int = 1_000_000) -> DataFrame:
    """A table as a file stream with one micro-batch for each number in the column ``batch``, which is dropped."""
    spark, slim = rows.sparkSession, rows.drop(batch)
    sizes = {r[0]: r[1] for r in rows.groupBy(batch).agg(F.count(F.lit(1))).collect()}  # one row a micro-batch
    files = max([1, *[-(-n // rows_per_file) for n in sizes.values()]])
    if not sizes:
        slim.write.parquet(folder)
    for number in sorted(sizes):
        rows.filter(F.col(batch) == number).drop(batch).repartition(files).write.mode("append").parquet(folder)
    return spark.readStream.schema(slim.schema).option("maxFilesPerTrigger", files).parquet(folder)


def run_until(spark: SparkSession, df: DataFrame, job: str, done: Callable[[DataFrame], bool], seconds: float = 600) -> DataFrame:
    """Run a stream with processing-time timers until ``done`` holds for its output, then stop it.

    Such a stream never runs out of work, so ``availableNow`` would not fire its timers.
    """
    query = start(df, job, processingTime="1 second")
    end = time.monotonic() + seconds
    try:
        while True:
            if query.exception():
                raise query.exception()
            found = spark.read.schema(df.schema).parquet(f"{job}/out") if exists(spark, f"{job}/out/_spark_metadata") else None
            if found is not None and done(found):
                return found
            if time.monotonic() > end:
                raise TimeoutError(f"the stream of {job} did not finish")
            time.sleep(0.5)
    finally:
        query.stop()


def run_batches(df: DataFrame, job: str, batches: int, seconds: float = 600) -> None:
    """Run a stream until it has committed so many micro-batches, then stop it; a later start goes on from there."""
    query = start(df, job, processingTime="0 seconds")
    end = time.monotonic() + seconds
    try:
        while len(committed_batches(df.sparkSession, job)) < batches:
            if query.exception():
                raise query.exception()
            if time.monotonic() > end:
                raise TimeoutError(f"the stream of {job} did not commit {batches} batches")
            time.sleep(0.2)
    finally:
        query.stop()


def committed_batches(spark: SparkSession, job: str) -> list[str]:
    return [name for name in children(spark, f"{job}/checkpoint/commits") if name.isdigit()]


def with_end_marker(df: DataFrame, folder: str) -> DataFrame:
    """Unite a stream with a marker folder, empty until ``write_end_marker``."""
    spark = df.sparkSession
    spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(folder)
    return df.unionByName(spark.readStream.schema(df.schema).parquet(folder))


def write_end_marker(spark: SparkSession, folder: str, schema: StructType, ts: str) -> None:
    """One row at the end of time, NULL elsewhere: it moves the watermark past all real rows."""
    row = spark.range(1).select(
        *[(F.lit(END_OF_TIME) if f.name == ts else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
    row.write.mode("append").parquet(folder)


def batch_writer(out: str) -> Callable[[DataFrame, int], None]:
    """Idempotent Parquet sink: one folder per batch id."""
    return lambda df, batch_id: df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")


def window_date_writer(out: str, date: Column) -> Callable[[DataFrame, int], None]:
    """Analytical result sink: folders by batch id and window date."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.withColumn("dt", date).write.mode("overwrite").partitionBy("dt").parquet(f"{out}/batch_id={batch_id}")

    return write


def fan_out(
    tag: str, outputs: dict[str, Callable[[DataFrame, int], None]], rest: Callable[[DataFrame, int], None] | None = None
) -> Callable[[DataFrame, int], None]:
    """Several sinks fed from one pass: the batch is computed once, then filtered per tag.

    Rows of any other tag go to ``rest``; without it they are an error.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        held = df.persist()
        try:
            for name, sink in outputs.items():
                sink(held.filter(F.col(tag) == name), batch_id)
            others = held.filter(~F.coalesce(F.col(tag).isin(*outputs), F.lit(False)))
            if rest:
                rest(others, batch_id)
            elif not others.isEmpty():
                raise ValueError(f"batch {batch_id} has rows whose {tag} is none of {sorted(outputs)}")
        finally:
            held.unpersist()

    return write


def latest_updates(out: DataFrame, keys: list[str]) -> DataFrame:
    """Final table of an ``update``-mode output written per batch: the newest batch of a key wins."""
    newest = F.max(F.struct("batch_id", *[c for c in out.columns if c not in (*keys, "batch_id")])).alias("_n")
    return out.groupBy(*keys).agg(newest).select(*keys, "_n.*").drop("batch_id")


def daily_first_visit_stream(df: DataFrame, key: str, ts: str, lateness: timedelta) -> DataFrame:
    """First arrival per key and day; the watermark delay covers the whole day plus disorder."""
    delay = as_interval(timedelta(days=1) + lateness)
    dated = df.withWatermark(ts, delay).withColumn("_day", F.to_date(ts))
    return dated.dropDuplicatesWithinWatermark([key, "_day"]).drop("_day")


def upsert_batches(table: KeyedSnapshot, version_cols: list[str]) -> Callable[[DataFrame, int], None]:
    """Keyed dimension sink for a change stream."""
    return lambda df, batch_id: table.upsert(df, batch_id, version_cols)
