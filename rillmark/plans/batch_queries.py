"""Batch queries over the driver tables, one per operator."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from rillmark.functions.text import camel_columns, is_blank, java_split, string_hash, utf16_length
from rillmark.functions.times import (
    age_on,
    datetime_to_millis,
    epoch_micros,
    event_time,
    millis_to_date,
    millis_to_datetime,
    parse_date_prefix,
    parse_datetime,
)
from rillmark.functions.udfs import average, map_with_resource, register_splitter, register_string_hash, register_string_hash_arrow
from rillmark.operators import aggregates, cdc, distribution, joins, keyed, records, windows
from rillmark.plans import stand_ins as sample
from rillmark.plans.stand_ins import ASOF, BOUNCE, entry_event, table

DAY, HOUR = timedelta(days=1), timedelta(hours=1)
EVENT_ORDER = ["ts", "event_id"]
STAT_DIMS = ["vc", "ch", "ar", "is_new"]


def _money(name: str):
    return F.col(name).cast("double").alias(name)


# --- visitors -------------------------------------------------------------


def visitor_stats(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: daily visitors, views, entries, bounces and dwell per dimension in one ordered pass."""
    flagged = keyed.visit_flags(sample.visits(spark, d), "user_id", "ts", ["event_id"], entry_event(), BOUNCE)
    feed = flagged.select(
        "ts", *STAT_DIMS, F.col("uv").alias("uv_ct"), F.lit(1).cast("bigint").alias("pv_ct"),
        F.col("sv").alias("sv_ct"), F.col("uj").alias("uj_ct"), F.col("during_time").alias("dur_sum"),
    )
    return aggregates.visitor_statistics(feed, STAT_DIMS, windows.tumbling("ts", DAY))


def visitor_stats_feeds(spark: SparkSession, d: str) -> DataFrame:
    """The same from three separate feeds, normalised and united."""
    page = sample.visits(spark, d).withColumn("last_page_id", F.when(~entry_event(), F.lit("home")))
    uv = keyed.daily_first_visits(page, "user_id", F.to_date("ts"), EVENT_ORDER)
    bounce = keyed.bounces(page, "user_id", "ts", is_blank(F.col("last_page_id")), ["event_id"], BOUNCE)
    feed = records.union_feeds(
        records.visitor_feed(page, "page", STAT_DIMS, "ts", "last_page_id", "during_time"),
        records.visitor_feed(uv, "uv", STAT_DIMS, "ts"),
        records.visitor_feed(bounce, "bounce", STAT_DIMS, "ts"),
    )
    return aggregates.visitor_statistics(feed, STAT_DIMS, windows.tumbling("ts", DAY))


def new_visitor_repair(spark: SparkSession, d: str) -> DataFrame:
    rows = sample.visits(spark, d).select("event_id", "user_id", "ts", "is_new")
    return keyed.repair_new_visitors(rows, "user_id", "is_new", EVENT_ORDER).drop("ts")


def new_visitor_repair_seeded(spark: SparkSession, d: str) -> DataFrame:
    rows = sample.visits(spark, d).select("event_id", "user_id", "ts", "is_new")
    return keyed.repair_new_visitors(rows, "user_id", "is_new", EVENT_ORDER, seed_from_old=True).drop("ts")


def daily_unique_visitor(spark: SparkSession, d: str) -> DataFrame:
    rows = sample.events(spark, d).select("event_id", "user_id", "ts")
    first = keyed.daily_first_visits(rows, "user_id", F.to_date("ts"), EVENT_ORDER)
    return first.select("event_id", "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))


def daily_unique_change(spark: SparkSession, d: str) -> DataFrame:
    """Arrival-order form over a feed that arrives in seven interleaved parts."""
    rows = sample.events(spark, d).select("event_id", "user_id", "ts", (F.col("event_id") % 7).alias("part"))
    kept = keyed.daily_first_visits(rows, "user_id", F.to_date("ts"), ["part", "event_id"], mode="change")
    return kept.select("event_id", "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))


def bounce_detection(spark: SparkSession, d: str) -> DataFrame:
    rows = sample.events(spark, d).select("event_id", "user_id", "ts", "event_type")
    return keyed.bounces(rows, "user_id", "ts", entry_event(), ["event_id"], BOUNCE).select("event_id", "user_id")


def _delta(spark: SparkSession, d: str, baseline: str) -> DataFrame:
    rows = sample.events(spark, d).select("event_id", "user_id", "ts", "value")
    alerts = keyed.delta_alerts(rows, "user_id", "value", 100.0, EVENT_ORDER, baseline)
    return alerts.select("event_id", "user_id", "last_value", "value")


def delta_alert(spark: SparkSession, d: str) -> DataFrame:
    return _delta(spark, d, "previous")


def delta_alert_first(spark: SparkSession, d: str) -> DataFrame:
    return _delta(spark, d, "first")


# --- logs -----------------------------------------------------------------


def log_parse_dirty(spark: SparkSession, d: str) -> DataFrame:
    parsed = records.parse_logs(sample.log_text(spark, d), "value")
    return records.dirty_logs(parsed).select("event_id", "reason")


def log_split(spark: SparkSession, d: str) -> DataFrame:
    logs = records.good_logs(records.parse_logs(sample.log_text(spark, d), "value"))
    return records.tag_logs(logs).select("event_id", "kind", "mid", "is_new", "ts_ms")


def display_explode(spark: SparkSession, d: str) -> DataFrame:
    logs = records.good_logs(records.parse_logs(sample.log_text(spark, d), "value"))
    shown = records.page_displays(records.tag_logs(logs), "event_id", "mid")
    return shown.select("event_id", "mid", "ts", F.variant_get("display", "$.item", "bigint").alias("item"))


def log_repair_text(spark: SparkSession, d: str) -> DataFrame:
    """Parse, repair, write the flag back into the text and read the text again."""
    logs = records.good_logs(records.parse_logs(sample.log_text(spark, d), "value"))
    fixed = keyed.repair_new_visitors(logs, "mid", "is_new", ["ts_ms", "event_id"])
    text = fixed.select("event_id", records.merged_log_text(fixed).alias("value"))
    again = records.parse_logs(text, "value")
    return again.select("event_id", "mid", "is_new", "ts_ms")


def parse_lines(spark: SparkSession, d: str) -> DataFrame:
    """Delimited lines to typed rows; lines with a field missing or not numeric are dirty."""
    n = F.col("event_id")
    value = F.when(n % 50 == 3, "warm").otherwise(F.col("value").cast("decimal(12,2)").cast("string"))
    tail = F.when(n % 50 == 4, F.lit("")).otherwise(F.concat(F.lit(","), F.unix_seconds("ts").cast("string")))
    lines = sample.events(spark, d).select("event_id", F.concat(F.col("event_type"), F.lit(","), value, tail).alias("line"))
    schema = StructType(
        [StructField("name", StringType()), StructField("temperature", DoubleType()), StructField("time", LongType())]
    )
    return records.parse_delimited(lines, "line", schema).select("event_id", "name", "temperature", "time", "dirty")


def typed_json(spark: SparkSession, d: str) -> DataFrame:
    """Row to JSON text and back to a typed row."""
    orders = sample.order_info(spark, d).select("id", "user_id", "order_status", "total_amount")
    text = records.json_rows(orders)
    schema = StructType([orders.schema["id"], orders.schema["total_amount"], StructField("absent", StringType())])
    return records.typed_rows(text, "value", schema).select("id", _money("total_amount"), "absent")


# --- orders and payments --------------------------------------------------


def _order_wide(spark: SparkSession, d: str) -> DataFrame:
    orders = records.prefixed(records.derive_create_times(sample.order_info(spark, d)), "o_")
    details = records.prefixed(sample.order_detail(spark, d), "d_")
    bound = timedelta(days=90)
    joined = joins.interval_join(orders, details, [("o_id", "d_order_id")], "o_ts", "d_ts", -bound, bound)
    return records.order_wide_columns(joined)


def order_wide_interval(spark: SparkSession, d: str) -> DataFrame:
    return _order_wide(spark, d).select(
        "detail_id", "order_id", "sku_id", _money("order_price"), "sku_num", "province_id", "order_status", "user_id",
        _money("total_amount"), _money("split_total_amount"), "create_time", "create_date", "create_hour",
    )


def order_wide_dims(spark: SparkSession, d: str) -> DataFrame:
    wide = joins.enrich_order_wide(_order_wide(spark, d), asof=ASOF, **sample.dimensions(spark, d))
    return wide.select(
        "detail_id", "order_id", "sku_id", "sku_name", "user_age", "user_gender", "province_name",
        "province_area_code", "province_iso_code", "province_3166_2_code", "spu_id", "spu_name", "tm_id", "tm_name",
        "category3_id", "category3_name", _money("order_price"),
    )


def _as_double(df: DataFrame) -> DataFrame:
    """Amounts as doubles, all other columns as they are."""
    return df.select(*[F.col(n).cast("double").alias(n) if kind.startswith("decimal") else F.col(n) for n, kind in df.dtypes])


def order_wide_full(spark: SparkSession, d: str) -> DataFrame:
    """All 35 columns of the wide order row."""
    wide = joins.enrich_order_wide(_order_wide(spark, d), asof=ASOF, **sample.dimensions(spark, d))
    return _as_double(wide)


def payment_wide_full(spark: SparkSession, d: str) -> DataFrame:
    """All 36 columns of the wide payment row, and the amount of its order; the orders are enriched wide rows, one for each detail."""
    wide = joins.enrich_order_wide(_order_wide(spark, d), asof=ASOF, **sample.dimensions(spark, d))
    timed = wide.withColumn("ts", parse_datetime(F.col("create_time")))
    joined = joins.interval_join(
        records.prefixed(sample.payment_info(spark, d), "p_"), records.prefixed(timed, "w_"), [("p_order_id", "w_order_id")],
        "p_ts", "w_ts", -timedelta(minutes=15), timedelta(0))
    return _as_double(records.payment_wide_columns(joined.drop("w_ts")))


def _rich_customers(spark: SparkSession, d: str, how: str) -> DataFrame:
    dim = table(spark, d, "customer").filter("c_acctbal > 0").select("c_custkey", "c_name")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return joins.lookup(orders, dim, "o_custkey", "c_custkey", how)


def dim_lookup_missing_left(spark: SparkSession, d: str) -> DataFrame:
    return _rich_customers(spark, d, "left")


def dim_lookup_missing_inner(spark: SparkSession, d: str) -> DataFrame:
    return _rich_customers(spark, d, "inner")


def _payment_wide(spark: SparkSession, d: str, granularity: str) -> DataFrame:
    wide = sample.order_info(spark, d).withColumnRenamed("id", "order_id")
    payments = sample.payment_info(spark, d)
    if granularity == "day":
        wide, payments = (x.withColumn("ts", F.date_trunc("day", "ts")) for x in (wide, payments))
    joined = joins.interval_join(
        records.prefixed(payments, "p_"), records.prefixed(wide, "w_"), [("p_order_id", "w_order_id")],
        "p_ts", "w_ts", -timedelta(minutes=15), timedelta(0),
    )
    return records.payment_wide_columns(joined).select(
        "payment_id", "order_id", "user_id", _money("total_amount"), _money("order_total_amount"), "subject",
        "payment_type", "payment_create_time", "order_create_time", "order_status", "province_id",
    )


def payment_wide(spark: SparkSession, d: str) -> DataFrame:
    return _payment_wide(spark, d, "second")


def payment_wide_same_day(spark: SparkSession, d: str) -> DataFrame:
    """The date-only event time: the bound then means the same day."""
    return _payment_wide(spark, d, "day")


def coalesce_merge(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    n = F.col("o_orderkey")
    one = orders.withColumns({"o_orderstatus": F.when(n % 2 == 0, F.col("o_orderstatus")), "o_custkey": F.lit(None).cast("bigint")})
    two = orders.withColumns({"o_orderstatus": F.lower("o_orderstatus"), "o_totalprice": F.lit(None).cast("double")})
    return joins.merge_rows([one, two], ["o_orderkey"])


def age_from_birthday(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    text = F.when(F.col("o_orderkey") % 11 == 0, "bad").otherwise(day.cast("string"))
    return table(spark, d, "orders").select("o_orderkey", age_on(text, F.lit("2001-03-01").cast("date")).alias("age"))


# --- change data ----------------------------------------------------------


def _changes(spark: SparkSession, d: str) -> DataFrame:
    return cdc.read_envelopes(sample.change_text(spark, d), "value", "o_orderkey")


def cdc_normalise(spark: SparkSession, d: str) -> DataFrame:
    return cdc.normalise_changes(_changes(spark, d)).select(
        "o_orderkey", "database", "table", "type", "ts", F.col("data")["o_totalprice"].alias("price"))


def cdc_normalise_both(spark: SparkSession, d: str) -> DataFrame:
    return cdc.normalise_changes(_changes(spark, d), "both").select(
        "o_orderkey", "table", "type", F.size("before_data").alias("before_fields"),
        F.col("after_data")["o_custkey"].alias("after_custkey"))


def cdc_normalise_after(spark: SparkSession, d: str) -> DataFrame:
    return cdc.normalise_changes(_changes(spark, d), "after").select(
        "o_orderkey", "table", "type", F.col("data")["o_orderstatus"].alias("status"))


def cdc_initial_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Start mode ``initial``: the rows at hand as ``read`` records, then the changes."""
    changes = cdc.drop_empty(cdc.normalise_changes(_changes(spark, d)))
    rows = changes.select("table", "type", F.col("data")["o_orderkey"].alias("key"))
    held = table(spark, d, "orders").select(
        F.concat(F.lit("orders_"), F.lower("o_orderstatus")).alias("table"), F.col("o_orderkey").cast("string").alias("key"))
    return cdc.with_snapshot(rows, held)


def _routed(spark: SparkSession, d: str) -> DataFrame:
    changes = cdc.drop_empty(cdc.normalise_changes(_changes(spark, d)))
    return cdc.route(changes, sample.routes(spark))


def _routed_rows(spark: SparkSession, d: str, tags: list[str]) -> DataFrame:
    kept = F.array_join(F.array_sort(F.map_keys("data")), ",")
    return _routed(spark, d).filter(F.col("tag").isin(tags)).select(
        "o_orderkey", "tag", "sinkTable", "pk", kept.alias("columns"))


def cdc_route_dim(spark: SparkSession, d: str) -> DataFrame:
    return _routed_rows(spark, d, ["dim"])


def cdc_route_fact(spark: SparkSession, d: str) -> DataFrame:
    return _routed_rows(spark, d, ["fact"])


def cdc_unrouted(spark: SparkSession, d: str) -> DataFrame:
    return _routed(spark, d).filter("tag in ('unrouted', 'bad_key')").select("o_orderkey", "tag")


def config_state(spark: SparkSession, d: str) -> DataFrame:
    live = cdc.config_state(sample.config_changes(spark, d), ["version"])
    return live.select("sourceTable", "operateType", "sinkType", "sinkTable")


def config_sink_tables(spark: SparkSession, d: str) -> DataFrame:
    changes = sample.config_changes(spark, d)
    return cdc.sink_tables(changes, cdc.config_state(changes, ["version"]))


def keyed_upsert(spark: SparkSession, d: str) -> DataFrame:
    latest = cdc.latest_per_key(sample.customer_changes(spark, d), ["o_custkey"], ["version"], ["status", "price"])
    return latest.filter("not deleted").select("o_custkey", "status", "price")


def keyed_upsert_nulls(spark: SparkSession, d: str) -> DataFrame:
    """Every change names both columns, so a NULL in it sets NULL."""
    changes = sample.customer_changes(spark, d)
    latest = cdc.latest_per_key(changes, ["o_custkey"], ["version"], ["status", "price"], lambda _: F.lit(True))
    return latest.filter("not deleted").select("o_custkey", "status", "price")


def keyed_upsert_same_ts(spark: SparkSession, d: str) -> DataFrame:
    """Changes of one year share their time; their position orders them, deletes included."""
    orders = table(spark, d, "orders")
    years = orders.select(F.col("o_orderkey").alias("position"), F.year("o_orderdate").alias("ts"))
    changes = sample.customer_changes_of(orders).join(years, F.col("version") == F.col("position"))
    latest = cdc.latest_per_key(changes, ["o_custkey"], ["ts", "position"], ["status", "price"])
    return latest.filter("not deleted").select("o_custkey", "status", "price")


def log_topics_full(spark: SparkSession, d: str) -> DataFrame:
    """Every record of the split with its topic, repaired flag, an unknown field and the display's item."""
    extra = F.expr("concat(substr(value, 1, length(value) - 1), ',\"actions\":[', event_id, ',\"x\"]}')")
    text = sample.log_text(spark, d).withColumn("value", F.when(F.col("event_id") % 101 > 7, extra).otherwise(F.col("value")))
    parsed = records.parse_logs(text, "value")
    dirty = records.dirty_logs(parsed).select("event_id", F.lit("dirty").alias("topic"), F.lit(None).cast("string").alias("value"))
    tagged = records.tag_logs(keyed.repair_new_visitors(records.good_logs(parsed), "mid", "is_new", ["ts_ms", "event_id"]))
    whole = tagged.select("event_id", F.col("kind").alias("topic"), records.merged_log_text(tagged).alias("value"))
    shown = records.page_displays(tagged, "event_id").select("event_id", F.lit("display").alias("topic"), F.to_json(F.struct("common", "page", "ts", "display")).alias("value"))
    part = lambda path: F.get_json_object("value", path)
    return whole.unionByName(shown).unionByName(dirty).select(
        "event_id", "topic", part("$.common.is_new").alias("is_new"), part("$.actions[0]").cast("bigint").alias("action"),
        part("$.display.item").cast("bigint").alias("item"))


# --- aggregates -----------------------------------------------------------


def _readings(spark: SparkSession, d: str) -> DataFrame:
    return sample.events(spark, d).select("event_id", "user_id", "event_type", "ts", "value")


def running_sum(spark: SparkSession, d: str) -> DataFrame:
    cents = F.round(F.col("value") * 100).cast("bigint")
    total = aggregates.running_total(_readings(spark, d), ["user_id"], cents, EVENT_ORDER, "total")
    return total.select("event_id", "user_id", "total")


def word_count(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.word_counts(table(spark, d, "part"), "p_name")


def word_pairs(spark: SparkSession, d: str) -> DataFrame:
    return records.words(table(spark, d, "part"), "p_name")


def running_max_by(spark: SparkSession, d: str) -> DataFrame:
    best = aggregates.running_best_row(_readings(spark, d), ["user_id"], "value", EVENT_ORDER, ["event_id", "value"])
    return best.select("event_id", "user_id", F.col("best.event_id").alias("best_id"), F.col("best.value").alias("best_value"))


def running_reduce_max(spark: SparkSession, d: str) -> DataFrame:
    top = aggregates.running_maximum(_readings(spark, d), ["user_id"], "value", EVENT_ORDER, "top")
    return top.select("event_id", "user_id", "top")


def running_max_field(spark: SparkSession, d: str) -> DataFrame:
    rows = aggregates.running_maximum_first_fields(_readings(spark, d), ["user_id"], "value", EVENT_ORDER, ["event_type"])
    return rows.select("event_id", "user_id", "first_event_type", "max_value")


def window_count(spark: SparkSession, d: str) -> DataFrame:
    counted = windows.window_counts(_readings(spark, d), ["user_id"], windows.tumbling("ts", DAY))
    return counted.select("user_id", F.unix_seconds("window_end").alias("window_end"), "n")


def window_min_by(spark: SparkSession, d: str) -> DataFrame:
    rows = _readings(spark, d).withColumn("w", windows.tumbling("ts", DAY)["end"])
    lowest = aggregates.first_row_per_group(rows, ["user_id", "w"], [F.col(c) for c in ("value", "ts", "event_id")])
    return lowest.select("user_id", F.unix_seconds("w").alias("window_end"), "event_id", "value")


def window_avg_count(spark: SparkSession, d: str) -> DataFrame:
    """The SQL form over a view."""
    _readings(spark, d).createOrReplaceTempView("readings")
    return spark.sql(
        "select user_id, count(value) as n, cast(avg(cast(value as decimal(18,2))) as double) as mean, "
        "unix_seconds(window.end) as window_end from readings group by user_id, window(ts, '1 day')"
    )


def sliding_window(spark: SparkSession, d: str) -> DataFrame:
    window = windows.sliding("ts", DAY, 6 * HOUR, -8 * HOUR)
    counted = windows.window_counts(_readings(spark, d), ["event_type"], window)
    return counted.select("event_type", F.unix_seconds("window_end").alias("window_end"), "n")


def offset_window(spark: SparkSession, d: str) -> DataFrame:
    """Days that begin at 16:00 UTC."""
    counted = windows.window_counts(_readings(spark, d), ["event_type"], windows.tumbling("ts", DAY, -8 * HOUR))
    return counted.select("event_type", F.unix_seconds("window_end").alias("window_end"), "n")


def arrival_window(spark: SparkSession, d: str) -> DataFrame:
    """Processing-time windows over an explicit arrival time, five minutes after the event."""
    rows = _readings(spark, d).withColumn("arrival", F.col("ts") + F.expr("interval 5 minutes"))
    counted = windows.window_counts(rows, ["event_type"], windows.processing_time_windows(rows, HOUR, "arrival"))
    return counted.select("event_type", F.unix_seconds("window_end").alias("window_end"), "n")


def session_window(spark: SparkSession, d: str) -> DataFrame:
    cents = _readings(spark, d).withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    found = windows.sessions(cents, ["user_id"], "ts", HOUR, "cents")
    return found.select(
        "user_id", F.unix_micros("session_start").alias("session_start"), F.unix_micros("session_end").alias("session_end"),
        "n", "total")


def global_window(spark: SparkSession, d: str) -> DataFrame:
    cents = F.sum(F.round(F.col("value") * 100).cast("bigint"))
    return _readings(spark, d).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), cents.alias("total"))


def count_window(spark: SparkSession, d: str) -> DataFrame:
    cents = F.round(F.col("value") * 100).cast("bigint")
    return aggregates.count_windows(_readings(spark, d), ["user_id"], EVENT_ORDER, 5, cents)


def count_window_full(spark: SparkSession, d: str) -> DataFrame:
    """Only windows that reached their size fire."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    return aggregates.count_windows(_readings(spark, d), ["user_id"], EVENT_ORDER, 5, cents, only_full=True)


def window_all(spark: SparkSession, d: str) -> DataFrame:
    counted = windows.window_counts(_readings(spark, d), [], windows.tumbling("ts", DAY))
    return counted.select(F.unix_seconds("window_end").alias("window_end"), "n")


def late_classify(spark: SparkSession, d: str) -> DataFrame:
    """A replay in batches where every tenth event comes one batch late."""
    n = F.col("event_id")
    batch = (F.floor(n / 1000) + (n % 10 == 0).cast("bigint")).cast("bigint")
    rows = sample.events(spark, d).select("event_id", "ts", batch.alias("batch_no"))
    return windows.classify_replay(rows, "ts", "batch_no", DAY, 12 * HOUR, 24 * HOUR).select("event_id", "batch_no", "tag")


# --- functions ------------------------------------------------------------


def udtf_split(spark: SparkSession, d: str) -> DataFrame:
    return joins.split_rows(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", " ").drop("p_name")


def udtf_split_sql(spark: SparkSession, d: str) -> DataFrame:
    """The registered table function, used laterally from SQL."""
    register_splitter(spark, " ")
    table(spark, d, "part").createOrReplaceTempView("part_names")
    return spark.sql("select p_partkey, word, length from part_names, lateral split_words(p_name)")


def udf_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", string_hash(F.col("c_name"), 10).alias("code"))


def udf_hash_sql(spark: SparkSession, d: str) -> DataFrame:
    """The registered scalar function with its constructor argument."""
    register_string_hash(spark, 10)
    table(spark, d, "customer").createOrReplaceTempView("customer_names")
    return spark.sql("select c_custkey, hash_code(c_name) as code from customer_names")


def udf_hash_arrow(spark: SparkSession, d: str) -> DataFrame:
    """The same function written in Python over Arrow batches."""
    register_string_hash_arrow(spark, 10)
    table(spark, d, "customer").createOrReplaceTempView("customer_names")
    return spark.sql("select c_custkey, hash_code_arrow(c_name) as code from customer_names")


def udaf_avg(spark: SparkSession, d: str) -> DataFrame:
    means = average(sample.events(spark, d), "user_id", "value")
    return means.select("user_id", F.round("average", 6).alias("mean"))


def rich_map(spark: SparkSession, d: str) -> DataFrame:
    """Open/close lifecycle around a batch map."""
    rows = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return map_with_resource(
        rows, lambda: {"factor": 2.0}, lambda r, b: b.assign(c_acctbal=b["c_acctbal"] * r["factor"]),
        lambda r: r.clear(), "c_custkey long, c_acctbal double",
    )


def key_list_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Index rows hold comma lists of nation keys; key 99 has no nation."""
    n = F.col("s_nationkey")
    index = table(spark, d, "supplier").select(F.concat_ws(",", n.cast("string"), ((n + 1) % 30).cast("string"), F.lit("99")).alias("keys"))
    nations = table(spark, d, "nation").select("n_nationkey", "n_name")
    return joins.key_list_lookup(index, "keys", nations, "n_nationkey")


def filter_prefix(spark: SparkSession, d: str) -> DataFrame:
    return records.with_prefix(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", "red")


def map_length(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "part").select("p_partkey", "p_name")
    return records.line_lengths(lines, "p_name").withColumn("units", utf16_length(F.col("p_name"))).drop("p_name")


def string_functions(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.col("p_name"), F.lit("  "))
    return table(spark, d, "part").select(
        "p_partkey",
        F.size(java_split(text, " ")).alias("parts"),
        F.upper("p_name").alias("upper_name"),
        is_blank(F.nullif(F.col("p_type"), F.lit("ECONOMY"))).alias("blank"),
        F.col("p_size").cast("string").try_cast("bigint").alias("number"),
        F.get(java_split(F.col("p_brand"), "#"), F.lit(1)).alias("brand_no"),
    )


def time_functions(spark: SparkSession, d: str) -> DataFrame:
    ms = F.unix_millis("ts")
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    broken = F.when(F.col("event_id") % 5 == 0, "?").otherwise(text)
    fallback = F.timestamp_seconds(F.lit(1700000000))
    return sample.events(spark, d).select(
        "event_id",
        millis_to_date(ms).alias("day"),
        datetime_to_millis(text).alias("ms_utc"),
        datetime_to_millis(text, "+08:00").alias("ms_east"),
        millis_to_datetime(ms, "+08:00").alias("text_east"),
        F.unix_millis(parse_date_prefix(text)).alias("midnight"),
        (epoch_micros(event_time(broken, fallback)) / 1000000).cast("bigint").alias("event_second"),
    )


def snake_to_camel(spark: SparkSession, d: str) -> DataFrame:
    return camel_columns(table(spark, d, "part").select("p_partkey", "p_brand", "p_retailprice"))


def sql_view_select(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "events").createOrReplaceTempView("user_table")
    return spark.sql("select event_id, event_type as name, value as temp from user_table")


def redistribute(spark: SparkSession, d: str) -> DataFrame:
    """Every way of spreading rows keeps the rows."""
    rows = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    spread = distribution.by_key(
        distribution.rebalance(distribution.shuffle_random(distribution.rescale(rows, 4), 8), 6), 8, "user_id", "event_type")
    pinned = distribution.pin_matching(spread, 8, F.col("event_type") == "error", ["event_id"])
    return pinned.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


def partition_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows per task, summed up because the layout is not fixed."""
    counts = aggregates.partition_counter(table(spark, d, "events").select("event_id"))
    task = next(c for c in counts.columns if c != "n")
    return counts.agg(F.sum("n").alias("n"), (F.count(F.lit(1)) == F.countDistinct(task)).alias("each_task_once"))


BATCH = {
    f.__name__: f
    for f in (
        visitor_stats, visitor_stats_feeds, new_visitor_repair, new_visitor_repair_seeded, daily_unique_visitor,
        daily_unique_change, bounce_detection, delta_alert, delta_alert_first, log_parse_dirty, log_split,
        display_explode, log_repair_text, parse_lines, typed_json, order_wide_interval, order_wide_dims,
        dim_lookup_missing_left, dim_lookup_missing_inner, payment_wide, payment_wide_same_day, coalesce_merge,
        age_from_birthday, cdc_normalise, cdc_normalise_both, cdc_normalise_after, cdc_initial_snapshot, cdc_route_dim,
        cdc_route_fact, cdc_unrouted, config_state, config_sink_tables, keyed_upsert, running_sum, word_count,
        word_pairs, running_max_by, running_reduce_max, running_max_field, window_count, window_min_by,
        window_avg_count, sliding_window, offset_window, arrival_window, session_window,
        global_window, count_window, count_window_full, window_all, late_classify, udtf_split, udtf_split_sql, udf_hash,
        udf_hash_sql, udaf_avg, rich_map, key_list_lookup, filter_prefix, map_length, string_functions, time_functions,
        snake_to_camel, sql_view_select, redistribute, partition_counts,
        udf_hash_arrow, keyed_upsert_nulls, keyed_upsert_same_ts, log_topics_full,
        order_wide_full, payment_wide_full,
    )
}
