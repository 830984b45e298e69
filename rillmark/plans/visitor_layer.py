"""Log records to visitor statistics: one streaming query per layer, joined by topics."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rillmark.functions.text import is_blank
from rillmark.functions.times import millis_to_date
from rillmark.operators import aggregates, records, windows
from rillmark.sources import topics
from rillmark.sources.topics import Bus
from rillmark.streaming import jobs, processors, stateful

DIMS = ["vc", "ch", "ar", "is_new"]
PAGE = (
    "common struct<mid: string, is_new: string, vc: string, ch: string, ar: string>, "
    "page struct<last_page_id: string, during_time: bigint>, ts bigint"
)
ROUTER = "base_log"
BOUNCE_WAIT = timedelta(seconds=10)
WATERMARK = timedelta(seconds=1)


def split_log_stream(lines: DataFrame) -> DataFrame:
    """Raw lines to ``sinkTable, value``: repaired start, page and display records, and dirty lines.

    A device's records of one micro-batch are repaired in the order of their time.
    """
    parsed = records.parse_logs(lines.select("value"), "value")
    dirty = records.dirty_logs(parsed).select(F.lit(topics.DIRTY_LOG).alias("sinkTable"), "value")
    slim = records.good_logs(parsed).select("mid", "is_new", "ts_ms", "value")
    marked = stateful.running_reduce(slim, ["mid"], ["ts_ms", "value"], ["is_new", "value"], stateful.SeenBefore("is_new", "1"))
    flag = F.when((F.col("is_new") == "1") & F.col("seen_before"), "0").otherwise(F.col("is_new")).alias("flag")
    logs = records.parse_logs(marked.select(flag, "value"), "value")
    tagged = records.tag_logs(logs.withColumn("is_new", F.col("flag")))
    text = records.merged_log_text(tagged)
    whole = F.struct(
        F.when(F.col("kind") == "start", topics.START_LOG).otherwise(topics.PAGE_LOG).alias("sinkTable"), text.alias("value")
    )
    part = lambda name: F.try_variant_get("doc", f"$.{name}", "variant").alias(name)
    display = lambda d: F.struct(
        F.lit(topics.DISPLAY_LOG).alias("sinkTable"),
        F.to_json(F.struct(records.repaired_common().alias("common"), part("page"), F.col("ts_ms").alias("ts"), d.alias("display"))).alias("value"),
    )
    shown = F.coalesce(F.try_variant_get("doc", "$.displays", "array<variant>"), F.array().cast("array<variant>"))
    displays = F.when(F.col("kind") == "page", F.transform(shown, display))
    rows = tagged.select(F.inline(F.concat(F.array(whole), F.coalesce(displays, F.slice(F.array(whole), 1, 0)))))
    return rows.unionByName(dirty)


def base_log(bus: Bus, **trigger) -> StreamingQuery:
    """Raw log topic to the start, page, display and dirty topics."""
    return bus.write_routed(split_log_stream(bus.read(topics.RAW_LOG)), topics.DIRTY_LOG, ROUTER, **trigger)


def _pages(bus: Bus) -> DataFrame:
    return records.typed_rows(bus.read(topics.PAGE_LOG, ROUTER), "value", PAGE, "value", "position")


def unique_visitors(bus: Bus, ttl: timedelta | None = timedelta(days=1), **trigger) -> StreamingQuery:
    """Page topic to the daily unique visitor topic."""
    dated = _pages(bus).select(F.col("common.mid").alias("mid"), millis_to_date(F.col("ts")).alias("day"), "ts", "value")
    return bus.write(processors.daily_visit_stream(dated, "mid", "day", ttl, ["ts", "value"]), topics.UNIQUE_VISITORS, "unique_visitors", **trigger)


def bounces(bus: Bus, within: timedelta = BOUNCE_WAIT, delay: timedelta = WATERMARK, **trigger) -> StreamingQuery:
    """Page topic to the bounce topic."""
    pages = _pages(bus).select(
        F.col("common.mid").alias("mid"),
        F.timestamp_millis("ts").alias("at"),
        F.col("position").alias("tie"),
        is_blank(F.col("page.last_page_id")).alias("entry"),
        "value",
    )
    found = processors.bounce_stream(pages, "mid", "at", "tie", "entry", "value", within, delay)
    return bus.write(found, topics.BOUNCES, "bounces", **trigger)


def visitor_feeds(bus: Bus) -> DataFrame:
    """Page, unique-visitor and bounce topics as one feed of measures."""

    def rows(stream: DataFrame) -> DataFrame:
        typed = records.typed_rows(stream, "value", PAGE)
        return typed.select("common.*", "page.*", F.timestamp_millis("ts").alias("at"))

    return records.union_feeds(
        records.visitor_feed(rows(bus.read(topics.PAGE_LOG, ROUTER)), "page", DIMS, "at", "last_page_id", "during_time"),
        records.visitor_feed(rows(bus.read(topics.UNIQUE_VISITORS)), "uv", DIMS, "at"),
        records.visitor_feed(rows(bus.read(topics.BOUNCES)), "bounce", DIMS, "at"),
    )


def visitor_stats(
    bus: Bus, out: str, size: timedelta = timedelta(seconds=10), delay: timedelta = BOUNCE_WAIT + 2 * WATERMARK, **trigger
) -> StreamingQuery:
    """Window sums per dimension, written per batch and window date.

    A bounce is known ``BOUNCE_WAIT`` and a watermark after its page, so the
    watermark of the united feed has to wait longer than that.
    """
    timed = windows.with_event_time(visitor_feeds(bus), "ts", delay)
    stats = aggregates.visitor_statistics(timed, DIMS, windows.tumbling("ts", size))
    write = jobs.window_date_writer(out, F.substring("stt", 1, 10))
    return jobs.start_batches(stats, bus.job("visitor_stats"), write, mode="update", **trigger)


def visitor_table(bus: Bus, out: str) -> DataFrame:
    """The statistics as last updated, one row per window and dimension."""
    rows = bus.spark.read.parquet(out).drop("dt")
    return jobs.latest_updates(rows, ["stt", "edt", *DIMS])
