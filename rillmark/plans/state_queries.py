"""Streams on Spark's own keyed state over the driver tables, each run to completion and read back."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillmark.functions.json import evaluate_once
from rillmark.operators import cdc, joins, records, windows
from rillmark.plans import stand_ins as sample
from rillmark.plans.batch_queries import DAY, EVENT_ORDER, HOUR
from rillmark.plans.stream_queries import NOW, event_stream, replay, replay_delay, run_to_end, table_stream, with_local_state
from rillmark.session import scratch_dir
from rillmark.streaming import jobs, stateful, temporal

LATE_BOUND, LATENESS = timedelta(hours=12), timedelta(days=6)


def cents() -> Column:
    return F.round(F.col("value") * 100).cast("bigint").alias("cents")


def readings(spark: SparkSession, d: str) -> DataFrame:
    return event_stream(spark, d).select("event_id", "user_id", "ts", "value", cents())


def _drained(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    job = scratch_dir(spark, name)
    jobs.drain(jobs.start(df, job, **NOW))
    return spark.read.schema(df.schema).parquet(f"{job}/out")


def late_replay(spark: SparkSession, d: str) -> DataFrame:
    """Events in seven micro-batches by number: a tenth comes one batch late, another tenth two."""
    rows = sample.events(spark, d).select("event_id", "user_id", "ts", cents())
    top = rows.agg(F.max("event_id")).first()[0] or 0
    n = F.col("event_id")
    late = F.when(n % 10 == 0, 1).when(n % 10 == 1, 2).otherwise(0)
    return jobs.replay_batches(rows.withColumn("batch_no", (F.floor(n * 5 / (top + 1)) + late).cast("int")), "batch_no", scratch_dir(spark, "late-replay"))


def late_refire_stream(spark: SparkSession, d: str) -> DataFrame:
    """Daily windows that fire at the watermark and again for each accepted late row; too-late rows go to their own output."""
    def build(stream: DataFrame) -> DataFrame:
        return stateful.refiring_windows(stream, ["user_id"], "ts", ["ts", "event_id"], DAY, LATE_BOUND, LATENESS, stateful.CountSum("cents"))

    out = run_to_end(spark, late_replay(spark, d), scratch_dir(spark, "late-refire"), "ts", build)
    return out.select("user_id", F.timestamp_millis("window_end").alias("w"), "kind", "fire", "n", "total").withColumn(
        "w", F.unix_seconds("w")).withColumnRenamed("w", "window_end")


def running_reduce_stream(spark: SparkSession, d: str) -> DataFrame:
    """Running count and sum, one output row for each input row, with state across the micro-batches."""
    out = stateful.running_reduce(readings(spark, d), ["user_id"], EVENT_ORDER, ["event_id"], stateful.CountSum("cents"))
    return _drained(spark, out, "running-sum")


def running_best_stream(spark: SparkSession, d: str) -> DataFrame:
    """The largest value so far and its event, one output row for each input row."""
    out = stateful.running_reduce(readings(spark, d), ["user_id"], EVENT_ORDER, ["event_id"], stateful.MaxRow("value", "event_id"))
    return _drained(spark, out, "running-best").select("event_id", "user_id", F.col("best").alias("best_id"), F.col("top").alias("best_value"))


def count_window_stream(spark: SparkSession, d: str) -> DataFrame:
    """Count windows of five rows: fired and purged by their trigger."""
    out = stateful.count_windows(readings(spark, d), ["user_id"], EVENT_ORDER, 5, stateful.CountSum("cents"))
    return _drained(spark, out, "count-window").select("user_id", F.col("fire").alias("bucket"), "n", "total")


def count_trigger_stream(spark: SparkSession, d: str) -> DataFrame:
    """A global window that is kept and fires at every tenth row with all it has seen."""
    out = stateful.count_windows(readings(spark, d), ["user_id"], EVENT_ORDER, 10, stateful.CountSum("cents"), purge=False)
    return _drained(spark, out, "count-trigger").select("user_id", "fire", "n", "total")


def session_average_stream(spark: SparkSession, d: str) -> DataFrame:
    """Average of each session by a user accumulator that merges when sessions grow together."""
    delay = replay_delay(spark, d)

    def build(stream: DataFrame) -> DataFrame:
        return stateful.session_windows(stream, ["user_id"], "ts", ["event_id"], HOUR, delay, stateful.Average("cents"))

    out = run_to_end(spark, readings(spark, d), scratch_dir(spark, "session-average"), "ts", build)
    return out.select("user_id", "session_start", "session_end", "n", F.round("average", 6).alias("average"))


def retract_counts_stream(spark: SparkSession, d: str) -> DataFrame:
    """Daily counts as a changelog; summing its changes up gives the current table."""
    rows = readings(spark, d).withColumn("window_end", F.unix_seconds(F.window("ts", "1 day")["end"]))
    out = stateful.retractions(rows, ["user_id", "window_end"], EVENT_ORDER, stateful.CountSum("cents"))
    log = _drained(spark, out, "retract").groupBy("user_id", "window_end", "version", "n", "total")
    changes = log.agg(F.sum("change").alias("standing"), F.count_if(F.col("change") < 0).alias("minus"), F.count_if(F.col("change") > 0).alias("plus"))
    # Every retracted row was put out before, once; what stands is one row a key.
    return changes.groupBy("user_id", "window_end").agg(
        F.max(F.when(F.col("standing") == 1, F.col("n"))).alias("n"), F.sum("standing").alias("standing"),
        (F.max("minus") <= 1).alias("once"), F.bool_and(F.col("plus") == 1).alias("paired"))


def arrival_window_stream(spark: SparkSession, d: str) -> DataFrame:
    """Processing-time windows of two seconds, fired by processing-time timers; their sums are those of the rows."""
    out = stateful.arrival_windows(readings(spark, d), ["user_id"], EVENT_ORDER, timedelta(seconds=2), stateful.CountSum("cents"))
    rows = sample.events(spark, d).agg(F.count(F.lit(1))).first()[0]
    job = scratch_dir(spark, "arrival")
    found = jobs.run_until(spark, out, job, lambda done: (done.agg(F.sum("n")).first()[0] or 0) >= rows)
    on_grid = F.bool_and(F.col("window_end") % 2000 == 0).alias("on_grid")
    return found.groupBy("user_id").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), on_grid)


def config_as_of_routing(spark: SparkSession, d: str) -> DataFrame:
    """Changes routed by the configuration in force at their own time, both sides being streams."""
    second, key = timedelta(seconds=1), F.concat_ws("\u0001", "table", "type")
    envelopes = cdc.read_envelopes(sample.change_text_of(table_stream(spark, d, "orders")), "value", "o_orderkey")
    changes = cdc.drop_empty(cdc.normalise_changes(envelopes)).withColumn("at", F.timestamp_millis("ts"))
    image = F.to_json(F.struct("o_orderkey", "table", "type", "data"))
    config = replay(spark, sample.yearly_routes(spark, d), "ts", "routes").withColumnRenamed("ts", "at")
    version = F.when(F.col("type") != "delete", F.to_json(F.struct("sinkType", "sinkTable", "sinkColumns", "sinkPk")))
    rows = changes.select("o_orderkey", key.alias("key"), "at", image.alias("image"))
    versions = config.select(F.concat_ws("\u0001", "sourceTable", "operateType").alias("key"), "at", version.alias("version"))

    def build(versions: DataFrame, rows: DataFrame) -> DataFrame:
        left = temporal.tagged(versions, temporal.LEFT, F.col("key"), "at", F.lit(0), F.col("version"), second)
        right = temporal.tagged(rows, temporal.RIGHT, F.col("key"), "at", F.col("o_orderkey"), F.col("image"), second)
        return temporal.as_of_join(left, right)

    joined = run_to_end(spark, [versions, rows], scratch_dir(spark, "as-of"), "at", build)
    shapes = {
        "c": F.from_json("payload", "o_orderkey bigint, table string, type string, data map<string,string>"),
        "v": F.from_json("version", "sinkType string, sinkTable string, sinkColumns string, sinkPk string"),
    }
    return cdc.route_matched(evaluate_once(joined, **shapes).select("c.*", "v.*")).select("o_orderkey", "tag", "sinkTable", "pk", F.size("data").alias("n_columns"))


def chained_joins(spark: SparkSession, d: str) -> tuple[list[DataFrame], Callable[..., DataFrame]]:
    """Payment wide rows by two interval joins in one streaming plan: its three streams, and the plan over them."""
    second = timedelta(seconds=1)
    orders = table_stream(spark, d, "orders")
    streams = [sample.order_info_of(orders), sample.order_detail_of(table_stream(spark, d, "lineitem")), sample.payment_info_of(orders)]

    def build(orders: DataFrame, details: DataFrame, payments: DataFrame) -> DataFrame:
        o, i, p = (windows.with_event_time(records.prefixed(s, x), f"{x}ts", second) for s, x in ((orders, "o_"), (details, "d_"), (payments, "p_")))
        wide = joins.interval_join(o, i, [("o_id", "d_order_id")], "o_ts", "d_ts", timedelta(0), timedelta(days=90)).drop("d_ts")
        return joins.interval_join(p, wide, [("p_order_id", "o_id")], "p_ts", "o_ts", -timedelta(minutes=15), timedelta(0))

    return streams, build


def chained_payment_stream(spark: SparkSession, d: str) -> DataFrame:
    """Payments with their order and each of its details, with the feeds' true delay."""
    streams, build = chained_joins(spark, d)
    out = run_to_end(spark, streams, scratch_dir(spark, "chained"), ["ts"] * 3, build)
    return out.select(F.col("p_id").alias("payment_id"), F.col("d_id").alias("detail_id"), F.col("d_sku_id").alias("sku_id"), F.col("o_user_id").alias("user_id"),
                      F.col("p_create_time").alias("payment_create_time"), F.col("d_split_total_amount").cast("double").alias("split_total_amount"))


def expired_state_stream(spark: SparkSession, d: str) -> DataFrame:
    """The marks that :func:`stateful.daily_first_rows` still holds, read from its state store after a stop and a restart.

    The stream is stopped between its second and third batch. Only days the
    watermark has not passed are left.
    """
    job, second = scratch_dir(spark, "expired"), timedelta(seconds=1)
    rows = event_stream(spark, d).select("event_id", "user_id", "ts")
    found = stateful.daily_first_rows(rows, ["user_id"], "ts", ["event_id"], second)
    jobs.run_batches(found, job, 2)
    jobs.drain(jobs.start(found, job, **NOW))
    reader = spark.read.format("statestore").option("path", f"{job}/checkpoint").option("stateVarName", "days")
    marks = reader.load().select(F.inline(F.arrays_zip("value.user_id", "value.day_end")))
    n = spark.read.schema(found.schema).parquet(f"{job}/out").groupBy("user_id").agg(F.count(F.lit(1)).alias("days_seen"))
    return marks.join(n, "user_id").select("user_id", F.floor(F.col("day_end") / 1000).alias("day_end"), "days_seen")


CHUNKS = 3


def snapshot_handover_stream(spark: SparkSession, d: str) -> DataFrame:
    """A snapshot read in chunks at different log positions, then the whole log from its start.

    Every change the snapshot does not hold is applied once. Per customer: the
    changes applied, whether each found the image the one before it left, and
    the final row.
    """
    log = sample.table(spark, d, "orders").select(
        "o_custkey", F.col("o_orderkey").alias("position"), F.when(F.col("o_orderkey") % 10 == 0, "delete").otherwise("update").alias("type"),
        F.to_json(F.struct(F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))).alias("image"))
    top = log.agg(F.max("position")).first()[0] or 0
    cut = F.floor((F.pmod("o_custkey", F.lit(CHUNKS)) + 1) * top / (CHUNKS + 1)).cast("bigint").alias("cut")
    latest = log.filter(F.col("position") <= cut).groupBy("o_custkey").agg(F.max_by(F.struct("position", "type", "image"), "position").alias("l"))
    snapshot = latest.filter("l.type <> 'delete'").select("o_custkey", "l.position", "l.image")
    stored = scratch_dir(spark, "snapshot")
    snapshot.write.parquet(stored)
    snapshot = spark.read.parquet(stored)
    changes = replay(spark, log, "position", "log").withColumn("cut", cut)
    applied = _drained(spark, temporal.after_snapshot(changes, snapshot, "o_custkey"), "handover")
    chain = applied.withColumn("left", F.lag("after").over(Window.partitionBy("o_custkey").orderBy("position")))
    # The first change of a key follows the snapshot's image, any other the one before.
    joined = chain.join(snapshot.withColumnRenamed("position", "at").withColumnRenamed("image", "start"), "o_custkey", "full")
    first = F.row_number().over(Window.partitionBy("o_custkey").orderBy("position")) == 1
    checked = joined.withColumn("fits", F.col("position").isNull() | F.col("before").eqNullSafe(F.when(first, F.col("start")).otherwise(F.col("left"))))
    folded = checked.groupBy("o_custkey").agg(
        F.count("position").alias("n_changes"), F.bool_and("fits").alias("chained"),
        F.max_by(F.coalesce(F.col("after"), F.when(F.col("position").isNull(), F.col("start"))), F.coalesce("position", F.lit(-1))).alias("image"))
    shape = F.from_json("image", "status string, price double")
    return evaluate_once(folded, i=shape).select("o_custkey", "n_changes", "chained", "i.status", "i.price")


def payment_match_processor(spark: SparkSession, d: str) -> DataFrame:
    """Orders and payments matched by a two-input process function; what stays alone leaves by a timer."""
    second, orders = timedelta(seconds=1), table_stream(spark, d, "orders")
    known = sample.order_info_of(orders.filter("o_orderkey % 7 <> 0")).select("id", "ts", F.to_json(F.struct("total_amount", "user_id")).alias("payload"))
    paid = sample.payment_info_of(orders).select("id", "order_id", "ts", F.to_json(F.struct("subject")).alias("payload"))

    def build(known: DataFrame, paid: DataFrame) -> DataFrame:
        left = temporal.tagged(known, temporal.LEFT, F.col("id"), "ts", F.col("id"), F.col("payload"), second)
        right = temporal.tagged(paid, temporal.RIGHT, F.col("order_id"), "ts", F.col("id"), F.col("payload"), second)
        return temporal.match_pairs(left, right, timedelta(minutes=15))

    out = run_to_end(spark, [known, paid], scratch_dir(spark, "match"), "ts", build)
    return out.select(
        F.col("key").alias("order_id"), "kind", F.get_json_object("left", "$.user_id").cast("bigint").alias("user_id"), F.get_json_object("right", "$.subject").alias("subject"))


STATE = {
    f.__name__: with_local_state(f)
    for f in (
        late_refire_stream, running_reduce_stream, running_best_stream, count_window_stream, count_trigger_stream, session_average_stream,
        retract_counts_stream, arrival_window_stream, config_as_of_routing, snapshot_handover_stream, payment_match_processor,
        chained_payment_stream, expired_state_stream,
    )
}

_CENTS = "cast(round(value * 100) as bigint)"
STATE_ORACLES = {
    "chained_payment_stream": """
select o_orderkey as payment_id, l_orderkey * 10 + l_linenumber as detail_id, l_partkey as sku_id, o_custkey as user_id,
  strftime(o_orderdate + to_minutes(cast(o_orderkey % 30 as integer)), '%Y-%m-%d %H:%M:%S') as payment_create_time, cast(l_extendedprice as double) as split_total_amount
from orders join lineitem on o_orderkey = l_orderkey
where o_orderstatus = 'F' and o_orderkey % 30 <= 15 and l_shipdate between o_orderdate and o_orderdate + interval 90 day""",
    "expired_state_stream": """
with d as (select user_id, cast(ts as date) + interval 1 day as day_end from events group by all),
n as (select user_id, count(*) as days_seen from d group by user_id)
select user_id, cast(epoch(day_end) as bigint) as day_end, days_seen from d join n using (user_id)
where day_end > (select max(ts) - interval 1 second from events)""",
    "config_as_of_routing": """
with years as (select distinct lower(o_orderstatus) as s, year(o_orderdate) as y from orders),
config as (
  select 'orders_' || s as source, op, case when y % 2 = 0 then 'dim' else 'fact' end as tag, 't_' || s || '_' || op || '_' || y as target, y % 5 = 0 as wide,
    y % 4 <> 3 as live, make_date(y, y % 12 + 1, 15) as since,
    lead(make_date(y, y % 12 + 1, 15)) over (partition by s, op order by y) as until
  from years, (values ('insert'), ('update'), ('delete')) o(op)),
changes as (
  select o_orderkey, o_custkey, 'orders_' || lower(o_orderstatus) as source, o_orderdate as at,
    case when o_orderkey % 10 = 0 then 'delete' when o_orderkey % 10 < 4 then 'update' else 'insert' end as op from orders)
select o_orderkey, case when live then tag else 'unrouted' end as tag, case when live then target end as sinkTable,
  case when live then case when wide then o_custkey || '-' || o_orderkey else o_orderkey::varchar end end as pk, case when live then 2 else 4 end as n_columns
from changes c left join config f on c.source = f.source and c.op = f.op and c.at >= f.since and (f.until is null or c.at < f.until)""",
    "snapshot_handover_stream": """
with o as (
  select o_custkey, o_orderkey as position, o_orderkey % 10 = 0 as gone, o_orderstatus as status, o_totalprice as price,
    floor((o_custkey % 3 + 1) * (max(o_orderkey) over ()) / 4) as cut from orders),
l as (select *, row_number() over (partition by o_custkey order by position desc) as k from o),
n as (select o_custkey, count(*) filter (position > cut) as n_changes, bool_or(position <= cut and held) as in_snapshot
  from (select *, position = max(position) filter (position <= cut) over (partition by o_custkey) and not gone as held from o) group by o_custkey)
select o_custkey, n_changes, true as chained, case when not gone then status end as status, case when not gone then price end as price
from n join l using (o_custkey) where k = 1 and (n_changes > 0 or in_snapshot)""",
    "payment_match_processor": """
with o as (select o_orderkey as id, o_custkey as user_id, o_orderkey % 30 as waited, o_orderpriority as subject, o_orderstatus = 'F' as paid, o_orderkey % 7 <> 0 as known from orders)
select id as order_id, 'match' as kind, user_id, subject from o where known and paid and waited <= 15
union all select id, 'no_left', null, subject from o where paid and not (known and waited <= 15)
union all select id, 'no_right', user_id, null from o where known and not (paid and waited <= 15)""",
    "late_refire_stream": f"""
with e as (
  select event_id, user_id, ts, {_CENTS} as cents, event_id * 5 // (max(event_id) over () + 1)
    + case event_id % 10 when 0 then 1 when 1 then 2 else 0 end as batch_no from events),
b as (select batch_no, max(ts) as top from e group by batch_no),
m as (select batch_no, max(top) over (order by batch_no rows between unbounded preceding and 1 preceding) - interval 12 hours as mark from b),
t as (
  select e.*, cast(ts as date) + interval 1 day as w_end, mark, case when mark is null or w_end > mark then 'on_time'
    when w_end + interval 6 days > mark then 'late' else 'too_late' end as tag from e join m using (batch_no)),
first as (select user_id, w_end, count(*) as n, sum(cents) as total from t where tag = 'on_time' group by all),
late as (
  select t.user_id, t.w_end, row_number() over w as k, sum(cents) over w as s from t where tag = 'late'
  window w as (partition by t.user_id, t.w_end order by batch_no, ts, event_id rows unbounded preceding)),
rows as (
  select user_id, w_end, 'fire' as kind, 1 as fire, n, total from first
  union all
  select l.user_id, l.w_end, 'fire', k + case when f.n is null then 0 else 1 end, k + coalesce(f.n, 0), s + coalesce(f.total, 0)
  from late l left join first f on l.user_id = f.user_id and l.w_end = f.w_end
  union all
  select user_id, w_end, 'too_late', null, 1, cents from t where tag = 'too_late')
select user_id, cast(epoch(w_end) as bigint) as window_end, kind, cast(fire as bigint) as fire, cast(n as bigint) as n, cast(total as bigint) as total
from rows""",
    "running_reduce_stream": f"""
select event_id, user_id, cast(count(*) over w as bigint) as n, cast(sum({_CENTS}) over w as bigint) as total from events
window w as (partition by user_id order by ts, event_id rows unbounded preceding)""",
    "running_best_stream": """
with b as (select event_id, user_id, ts, max(value) over (partition by user_id order by ts, event_id rows unbounded preceding) as best_value from events)
select b.event_id, b.user_id, b.best_value, (
  select arg_min(e.event_id, (e.ts, e.event_id)) from events e
  where e.user_id = b.user_id and e.value = b.best_value and (e.ts, e.event_id) <= (b.ts, b.event_id)) as best_id
from b""",
    "count_window_stream": f"""
with n as (select user_id, {_CENTS} as cents, (row_number() over (partition by user_id order by ts, event_id) - 1) // 5 as bucket from events)
select user_id, bucket, count(*) as n, cast(sum(cents) as bigint) as total from n group by all having count(*) = 5""",
    "count_trigger_stream": f"""
with n as (
  select user_id, row_number() over w as n, sum({_CENTS}) over w as total from events
  window w as (partition by user_id order by ts, event_id rows unbounded preceding))
select user_id, n // 10 - 1 as fire, n, cast(total as bigint) as total from n where n % 10 = 0""",
    "session_average_stream": f"""
with o as (select user_id, epoch_us(ts) as t, {_CENTS} as cents, lag(epoch_us(ts)) over (partition by user_id order by ts, event_id) as before from events),
s as (select *, sum(case when before is null or t - before > 3600000000 then 1 else 0 end) over (partition by user_id order by t rows unbounded preceding) as no from o)
select user_id, min(t) as session_start, max(t) + 3600000000 as session_end, count(*) as n, round(avg(cents), 6) as average from s group by user_id, no""",
    "retract_counts_stream": """
select user_id, cast(epoch(cast(ts as date) + interval 1 day) as bigint) as window_end, count(*) as n, 1 as standing, true as once, true as paired
from events group by user_id, cast(ts as date)""",
    "arrival_window_stream": f"select user_id, count(*) as n, cast(sum({_CENTS}) as bigint) as total, true as on_grid from events group by user_id",
}
