"""Streaming twins over the driver tables, each run to completion and read back."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from rillmark.functions.times import as_interval
from rillmark.operators import aggregates, cdc, joins, records, windows
from rillmark.plans import stand_ins as sample
from rillmark.plans.batch_queries import DAY, EVENT_ORDER, HOUR, STAT_DIMS
from rillmark.plans.stand_ins import BOUNCE, entry_event
from rillmark.session import ARROW_BYTES, ARROW_BYTES_CONF, BOUND_MB, BOUND_MB_CONF, BOUNDED_CONF, PROVIDER_CONF, ROCKSDB_PROVIDER, scratch_dir
from rillmark.plans.visitor_layer import split_log_stream
from rillmark.sources.topics import DIRTY_LOG, routed_topic_sink
from rillmark.streaming import jobs, processors, stateful
from rillmark.streaming.snapshot import KeyedSnapshot

NOW = {"availableNow": True}
SECOND = timedelta(seconds=1)
DIM_SCHEMA = "pk string, o_custkey string, o_orderkey string, o_orderstatus string"


#: A file is the work of one task of a micro-batch: smaller ones keep all cores busy.
BATCHES, ROWS_PER_FILE = 4, 250_000
#: State partitions that a cluster has at least, if as many are configured.
CLUSTER_PARTITIONS = 24
#: The column whose order a table's micro-batches follow.
ORDERED_BY = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}


def state_partitions(configured: int, cores: int, local: bool) -> int:
    """Partitions of a stream's state: no more than cores, however many are configured for the size of the input.

    Every partition of every stateful operator starts a worker and commits a
    store per batch, whatever its rows. Executors may still be joining a
    cluster, so there a small number of cores is not believed.
    """
    return min(configured, cores if local else max(cores, CLUSTER_PARTITIONS))


def with_local_state(query):
    """Run with the RocksDB store in bounded memory and :func:`state_partitions`; set all back.

    The streams of a query have ended when it returns.
    """

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        key, context = "spark.sql.shuffle.partitions", spark.sparkContext
        before = {k: spark.conf.get(k, None) for k in (key, PROVIDER_CONF, BOUNDED_CONF, BOUND_MB_CONF, ARROW_BYTES_CONF)}
        configured = int(spark.conf.get(key))  # Spark's own default in a session that sets none
        spark.conf.set(key, str(state_partitions(configured, context.defaultParallelism, context.master.startswith("local"))))
        for k, v in ((PROVIDER_CONF, ROCKSDB_PROVIDER), (BOUNDED_CONF, "true"), (BOUND_MB_CONF, BOUND_MB), (ARROW_BYTES_CONF, ARROW_BYTES)):
            spark.conf.set(k, v)
        try:
            return query(spark, sf_dir)
        finally:
            for k, v in before.items():
                if v is None:
                    spark.conf.unset(k)
                else:
                    spark.conf.set(k, v)

    return run


def table_stream(spark: SparkSession, sf_dir: str, name: str, order: str | None = None) -> DataFrame:
    """A driver table as a file stream of about ``BATCHES`` micro-batches in the order of a column.

    The table is written once, slice after slice, to a scratch folder; the
    source then takes a slice's number of files with each trigger.
    """
    return replay(spark, sample.table(spark, sf_dir, name), order or ORDERED_BY[name], name)


def replay(spark: SparkSession, rows: DataFrame, column: str, name: str) -> DataFrame:
    """Any table as a stream, as :func:`table_stream`."""
    folder = scratch_dir(spark, f"replay-{name}")
    is_time = isinstance(rows.schema[column].dataType, (TimestampType, TimestampNTZType, DateType))
    number = (F.col(column).cast("timestamp") if is_time else F.col(column)).cast("double")
    shares = [i / BATCHES for i in range(1, BATCHES)]
    found = rows.agg(F.percentile_approx(number, shares).alias("cuts"), F.count(F.lit(1)).alias("n")).first()
    files = max(1, -(-found.n // (BATCHES * ROWS_PER_FILE)))
    slice_of = sum((F.coalesce(number > c, F.lit(False)).cast("int") for c in found.cuts or []), F.lit(0))
    for i in range(BATCHES):
        rows.filter(slice_of == i).repartition(files).write.mode("append").parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def replay_delay(spark: SparkSession, sf_dir: str) -> timedelta:
    """A disorder bound that covers the whole table, so file order cannot make a row late."""
    first, last = sample.events(spark, sf_dir).agg(F.min("ts"), F.max("ts")).first()
    return (last - first) + SECOND if first else SECOND


def run_to_end(spark: SparkSession, df: DataFrame | list[DataFrame], job: str, ts: str | list[str], build, progress: list | None = None) -> DataFrame:
    """Run ``build(*streams)`` in append mode, then let end markers in all of them close what is open.

    ``progress`` collects what the query reports of its micro-batches.
    """
    streams = df if isinstance(df, list) else [df]
    times = ts if isinstance(ts, list) else [ts] * len(streams)
    marked = [jobs.with_end_marker(s, f"{job}/marker{i}") for i, s in enumerate(streams)]
    first = jobs.start(build(*marked), job, **NOW)
    jobs.drain(first)
    for i, (stream, column) in enumerate(zip(streams, times, strict=True)):
        jobs.write_end_marker(spark, f"{job}/marker{i}", stream.schema, column)
    query = jobs.start(build(*marked), job, **NOW)
    jobs.drain(query)
    if progress is not None:
        progress += [*first.recentProgress, *query.recentProgress]
    return spark.read.parquet(f"{job}/out")


def _appended(spark: SparkSession, df: DataFrame, job: str) -> DataFrame:
    jobs.drain(jobs.start(df, job, **NOW))
    return spark.read.schema(df.schema).parquet(f"{job}/out")


def new_visitor_repair_stream(spark: SparkSession, d: str) -> DataFrame:
    """A claim after an earlier one of the same user, in this batch or any before, turns to '0'."""
    rows = sample.as_visits(event_stream(spark, d)).select("event_id", "user_id", "ts", "is_new")
    marked = stateful.running_reduce(rows, ["user_id"], EVENT_ORDER, ["event_id", "is_new"], stateful.SeenBefore("is_new", "1"))
    out = _appended(spark, marked, scratch_dir(spark, "repair"))
    repaired = F.when((F.col("is_new") == "1") & F.col("seen_before"), "0").otherwise(F.col("is_new"))
    return out.select("event_id", "user_id", repaired.alias("is_new"))


def _first_visits(spark: SparkSession, rows: DataFrame, job: str) -> DataFrame:
    return _appended(spark, stateful.daily_first_rows(rows, ["user_id"], "ts", ["event_id"], SECOND), job)


def daily_unique_visitor_stream(spark: SparkSession, d: str) -> DataFrame:
    """Whole first row of each user and day, in time order, with marks that expire by event time."""
    out = _first_visits(spark, event_stream(spark, d).select("event_id", "user_id", "ts"), scratch_dir(spark, "daily"))
    return out.select("event_id", "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))


def daily_unique_pairs_stream(spark: SparkSession, d: str) -> DataFrame:
    """Built-in deduplication; which row of a day survives is open, so only key and day are read."""
    rows = event_stream(spark, d).select("event_id", "user_id", "ts")
    job = scratch_dir(spark, "daily-native")
    kept = jobs.daily_first_visit_stream(rows, "user_id", "ts", replay_delay(spark, d))
    jobs.drain(jobs.start(kept, job, **NOW))
    return spark.read.parquet(f"{job}/out").select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))


def delta_alert_stream(spark: SparkSession, d: str) -> DataFrame:
    """Readings that differ from the user's one before by the threshold or more."""
    rows = event_stream(spark, d).select("event_id", "user_id", "ts", "value")
    compared = stateful.running_reduce(rows, ["user_id"], EVENT_ORDER, ["event_id", "value"], stateful.Previous("value"))
    out = _appended(spark, compared, scratch_dir(spark, "delta"))
    return out.filter(F.abs(F.col("value") - F.col("last_value")) >= 100.0).select("event_id", "user_id", "last_value", "value")


def _bounces(spark: SparkSession, rows: DataFrame, job: str) -> DataFrame:
    """Bounces by event-time timers; an end marker lets the last entries run out of time. ``value`` is the whole row."""
    whole = F.to_json(F.struct(*[c for c in rows.columns if c not in ("user_id", "ts")])).alias("value")

    def build(stream: DataFrame) -> DataFrame:
        marked = stream.select("user_id", "ts", "event_id", entry_event().alias("entry"), whole)
        return processors.bounce_stream(marked, "user_id", "ts", "event_id", "entry", "value", BOUNCE, SECOND)

    out = run_to_end(spark, rows, job, "ts", build)
    return out.select(F.col("tie").alias("event_id"), F.col("key").alias("user_id"), "value")


def bounce_detection_stream(spark: SparkSession, d: str) -> DataFrame:
    rows = event_stream(spark, d).select("event_id", "user_id", "ts", "event_type")
    return _bounces(spark, rows, scratch_dir(spark, "bounce")).select("event_id", "user_id")


def visitor_stats_stream(spark: SparkSession, d: str) -> DataFrame:
    """The whole visitor layer: two keyed jobs write their feeds, a third unites and sums them."""
    job = scratch_dir(spark, "visitors")
    kind = F.col("event_type")
    pages = sample.as_visits(event_stream(spark, d)).withColumns(
        {"vc": kind, "ch": kind, "ar": kind, "last_page_id": F.when(~entry_event(), F.lit("home"))}
    )
    slim = pages.select("event_id", "user_id", "ts", "event_type", *STAT_DIMS, "last_page_id", "during_time")
    uv = _first_visits(spark, slim.select("event_id", "user_id", "ts", *STAT_DIMS), f"{job}/uv")
    shape = "struct<" + ", ".join(f"{c}: {slim.schema[c].dataType.simpleString()}" for c in STAT_DIMS) + ">"
    dims = F.to_json(F.struct(F.unix_micros("ts").alias("at"), *STAT_DIMS)).alias("dims")
    found = _bounces(spark, slim.select("event_id", "user_id", "ts", "event_type", dims), f"{job}/uj")
    bounced = F.from_json(F.get_json_object("value", "$.dims"), shape.replace("struct<", "struct<at: bigint, ", 1)).alias("b")
    found.select(bounced).select(F.timestamp_micros("b.at").alias("ts"), *[f"b.{c}" for c in STAT_DIMS]).write.parquet(f"{job}/bounces")
    uv_stream = spark.readStream.schema(uv.schema).parquet(f"{job}/uv/out")
    uj_stream = spark.readStream.schema(spark.read.parquet(f"{job}/bounces").schema).parquet(f"{job}/bounces")
    feed = records.union_feeds(
        records.visitor_feed(slim, "page", STAT_DIMS, "ts", "last_page_id", "during_time"),
        records.visitor_feed(uv_stream, "uv", STAT_DIMS, "ts"),
        records.visitor_feed(uj_stream, "bounce", STAT_DIMS, "ts"),
    )

    def build(stream: DataFrame) -> DataFrame:
        # The feeds are read whole here while the pages come batch by batch, so the disorder is that of the table.
        timed = windows.with_event_time(stream, "ts", replay_delay(spark, d) + BOUNCE)
        return aggregates.visitor_statistics(timed, STAT_DIMS, windows.tumbling("ts", DAY))

    return run_to_end(spark, feed, f"{job}/stats", "ts", build)


def window_count_stream(spark: SparkSession, d: str) -> DataFrame:
    """Update mode: windows fire again as rows arrive, the newest result per window stands."""
    rows = windows.with_event_time(event_stream(spark, d).select("user_id", "ts"), "ts", replay_delay(spark, d))
    job = scratch_dir(spark, "window-count")
    counted = windows.window_counts(rows, ["user_id"], windows.tumbling("ts", DAY))
    jobs.drain(jobs.start_batches(counted, job, jobs.batch_writer(f"{job}/out"), mode="update", **NOW))
    final = jobs.latest_updates(spark.read.parquet(f"{job}/out"), ["user_id", "window_end"])
    return final.select("user_id", F.unix_seconds("window_end").alias("window_end"), "n")


def session_window_stream(spark: SparkSession, d: str) -> DataFrame:
    cents = F.round(F.col("value") * 100).cast("bigint")
    rows = event_stream(spark, d).select("user_id", "ts", cents.alias("cents"))
    delay = replay_delay(spark, d)

    def build(stream: DataFrame) -> DataFrame:
        timed = windows.with_event_time(stream, "ts", delay)
        grouped = timed.groupBy("user_id", F.session_window("ts", as_interval(HOUR)).alias("w"))
        return grouped.agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("total"))

    out = run_to_end(spark, rows, scratch_dir(spark, "session"), "ts", build)
    return out.select(
        "user_id", F.unix_micros("w.start").alias("session_start"), F.unix_micros("w.end").alias("session_end"), "n", "total")


def _prefixed_stream(df: DataFrame, prefix: str, ts: str, bound: timedelta) -> DataFrame:
    return windows.with_event_time(records.prefixed(df, prefix), f"{prefix}{ts}", bound)


def order_wide_interval_stream(spark: SparkSession, d: str) -> DataFrame:
    orders = records.derive_create_times(sample.order_info_of(table_stream(spark, d, "orders")))
    details = sample.order_detail_of(table_stream(spark, d, "lineitem"))
    # Slices come in the order of each side's own time, so a second of disorder is the feeds' true delay.
    bound, delay = timedelta(days=90), SECOND
    joined = joins.interval_join(
        _prefixed_stream(orders, "o_", "ts", delay), _prefixed_stream(details, "d_", "ts", delay),
        [("o_id", "d_order_id")], "o_ts", "d_ts", -bound, bound)
    job = scratch_dir(spark, "order-wide")
    jobs.drain(jobs.start(records.order_wide_columns(joined), job, **NOW))
    money = [F.col(c).cast("double").alias(c) for c in ("order_price", "total_amount", "split_total_amount")]
    return spark.read.parquet(f"{job}/out").select(
        "detail_id", "order_id", "sku_id", "sku_num", "province_id", "order_status", "user_id", *money, "create_time",
        "create_date", "create_hour")


def payment_wide_stream(spark: SparkSession, d: str) -> DataFrame:
    orders = table_stream(spark, d, "orders")
    wide = sample.order_info_of(orders).withColumnRenamed("id", "order_id")
    delay = SECOND
    joined = joins.interval_join(
        _prefixed_stream(sample.payment_info_of(orders), "p_", "ts", delay), _prefixed_stream(wide, "w_", "ts", delay),
        [("p_order_id", "w_order_id")], "p_ts", "w_ts", -timedelta(minutes=15), timedelta(0))
    job = scratch_dir(spark, "payment-wide")
    jobs.drain(jobs.start(records.payment_wide_columns(joined), job, **NOW))
    money = [F.col(c).cast("double").alias(c) for c in ("total_amount", "order_total_amount")]
    return spark.read.parquet(f"{job}/out").select(
        "payment_id", "order_id", "user_id", *money, "subject", "payment_type", "payment_create_time",
        "order_create_time", "order_status", "province_id")


def keyed_upsert_stream(spark: SparkSession, d: str) -> DataFrame:
    """Changes arrive in several batches by version; each writes the next version of the snapshot."""
    root = scratch_dir(spark, "upsert")
    held = KeyedSnapshot(spark, root, ["o_custkey"], "o_custkey bigint, status string, price double")
    changes = sample.customer_changes_of(table_stream(spark, d, "orders", "o_orderkey"))
    jobs.drain(jobs.start_batches(changes, f"{root}/job", jobs.upsert_batches(held, ["version"]), **NOW))
    return held.read()


def cdc_fan_out_stream(spark: SparkSession, d: str) -> DataFrame:
    """One pass over the change stream: dimension rows to snapshots per table, facts to their topics.

    The configuration is read in every batch before the changes are routed.
    """
    root = scratch_dir(spark, "fan-out")
    changes = cdc.drop_empty(cdc.normalise_changes(
        cdc.read_envelopes(sample.change_text_of(table_stream(spark, d, "orders")), "value", "o_orderkey")))

    def dims(df: DataFrame, batch_id: int) -> None:
        for table in [r[0] for r in sample.routes(spark).filter("lower(sinkType) = 'hbase'").select("sinkTable").distinct().collect()]:
            held = KeyedSnapshot(spark, f"{root}/dims/{table}", ["pk"], DIM_SCHEMA)
            columns = [F.col("data")[c].alias(c) for c in ("o_custkey", "o_orderkey", "o_orderstatus")]
            mine = df.filter(F.col("sinkTable") == table).select("pk", "type", "ts", "data", *columns)
            held.upsert(mine, batch_id, ["ts"], lambda c: F.map_contains_key("data", F.lit(c)))

    def facts(df: DataFrame, batch_id: int) -> None:
        text = F.to_json(F.struct("pk", "type", "data")).alias("value")
        rows = df.select(F.col("sinkTable").alias("topic"), "o_orderkey", text)
        rows.write.mode("overwrite").partitionBy("topic").parquet(f"{root}/facts/batch_id={batch_id}")

    def rest(df: DataFrame, batch_id: int) -> None:
        df.select("o_orderkey", "tag").write.mode("overwrite").parquet(f"{root}/rest/batch_id={batch_id}")

    def write(df: DataFrame, batch_id: int) -> None:
        jobs.fan_out("tag", {"dim": dims, "fact": facts}, rest)(cdc.route(df, sample.routes(spark)), batch_id)

    jobs.drain(jobs.start_batches(changes, f"{root}/job", write, **NOW))

    def rows_of(table: str) -> DataFrame:
        held = KeyedSnapshot(spark, f"{root}/dims/{table}", ["pk"], DIM_SCHEMA).read()
        return held.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.lit(table).alias("target"), "pk")

    dim_rows = reduce(DataFrame.unionByName, [rows_of(t) for t in ("dim_orders_f", "dim_orders_o", "dim_orders_p")])
    rejected = spark.read.schema("o_orderkey bigint, tag string").parquet(f"{root}/rest").select(
        "o_orderkey", F.col("tag").alias("target"), F.lit(None).cast("string").alias("pk"))
    fact_rows = spark.read.parquet(f"{root}/facts").select(
        "o_orderkey", F.col("topic").alias("target"), F.get_json_object("value", "$.pk").alias("pk"))
    return dim_rows.unionByName(fact_rows).unionByName(rejected)


def log_topics_stream(spark: SparkSession, d: str) -> DataFrame:
    """Raw log lines split to the start, page, display and dirty topics as whole records, each choosing its topic."""
    extra = F.expr("concat(substr(value, 1, length(value) - 1), ',\"actions\":[', event_id, ',\"x\"]}')")
    lines = sample.log_text_of(event_stream(spark, d)).select(F.when(F.col("event_id") % 101 > 7, extra).otherwise(F.col("value")).alias("value"))
    job = scratch_dir(spark, "topics")
    jobs.drain(routed_topic_sink(split_log_stream(lines), DIRTY_LOG, f"{job}/checkpoint", f"{job}/topics", **NOW))
    part = lambda path: F.get_json_object("value", path)
    good = F.col("topic") != DIRTY_LOG
    fields = {
        "mid": part("$.common.mid"), "is_new": part("$.common.is_new"), "ts_ms": part("$.ts").cast("bigint"),
        "action": part("$.actions[0]").cast("bigint"), "item": part("$.display.item").cast("bigint")}
    return spark.read.parquet(f"{job}/topics").select("topic", *[F.when(good, c).alias(n) for n, c in fields.items()])


def repair_processor(spark: SparkSession, d: str) -> DataFrame:
    """New-visitor repair in arrival order: each user keeps one claim; which one depends on arrival."""
    rows = sample.as_visits(event_stream(spark, d)).select("event_id", "user_id", "is_new")
    job = scratch_dir(spark, "repair-processor")
    jobs.drain(jobs.start(processors.repair_stream(rows, "user_id", "is_new"), job, **NOW))
    kept = F.count_if(F.col("is_new") == "1")
    return spark.read.parquet(f"{job}/out").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), kept.alias("claims"))


def daily_processor(spark: SparkSession, d: str) -> DataFrame:
    """Days of each user by the stored last day, rows of a batch in time order."""
    rows = event_stream(spark, d).select("event_id", "user_id", "ts", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    kept = processors.daily_visit_stream(rows, "user_id", "day", None, EVENT_ORDER)
    return _appended(spark, kept, scratch_dir(spark, "daily-processor")).select("user_id", "day")


def delta_processor(spark: SparkSession, d: str) -> DataFrame:
    """Delta alerts by the stored last reading, rows of a batch in time order."""
    rows = event_stream(spark, d).select("event_id", "user_id", "ts", "value")
    return _appended(spark, processors.delta_stream(rows, "user_id", "value", 100.0, order=EVENT_ORDER), scratch_dir(spark, "delta-processor"))


def bounce_processor(spark: SparkSession, d: str) -> DataFrame:
    """Bounces over the page type alone."""
    rows = event_stream(spark, d).select("event_id", "user_id", "ts", "event_type")

    def build(stream: DataFrame) -> DataFrame:
        marked = stream.withColumn("entry", entry_event())
        return processors.bounce_stream(marked, "user_id", "ts", "event_id", "entry", "event_type", BOUNCE, SECOND)

    out = run_to_end(spark, rows, scratch_dir(spark, "bounce-processor"), "ts", build)
    return out.select(F.col("tie").alias("event_id"), F.col("key").alias("user_id"))


STREAM = {
    f.__name__: with_local_state(f)
    for f in (
        new_visitor_repair_stream, daily_unique_visitor_stream, daily_unique_pairs_stream, delta_alert_stream,
        bounce_detection_stream, visitor_stats_stream, window_count_stream, session_window_stream,
        order_wide_interval_stream, payment_wide_stream, keyed_upsert_stream, cdc_fan_out_stream, log_topics_stream,
        repair_processor, daily_processor, delta_processor, bounce_processor,
    )
}
