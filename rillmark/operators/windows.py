"""Time windows in batch and streams, and late-row classification over a replay."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.functions.times import as_interval, epoch_micros, micros
from rillmark.operators.joins import lookup
from rillmark.operators.scan import layout_of, max_before, previous, running_sum, scan


def with_event_time(df: DataFrame, ts: str, bound: timedelta) -> DataFrame:
    """Declare event time with a bounded disorder; ``timedelta(0)`` is the ascending case.

    Streams refuse zone-less timestamps, so the column is cast first.
    """
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, as_interval(bound))


def tumbling(ts: str, size: timedelta, offset: timedelta = timedelta(0)) -> Column:
    """Windows starting at ``ts - (ts - offset) mod size``."""
    return sliding(ts, size, size, offset)


def sliding(ts: str, size: timedelta, slide: timedelta, offset: timedelta = timedelta(0)) -> Column:
    """Overlapping windows; a row belongs to ``size / slide`` of them."""
    return F.window(ts, as_interval(size), as_interval(slide), as_interval(offset % slide))


def processing_time_windows(df: DataFrame, size: timedelta, arrival: str | None = None) -> Column:
    """Windows over arrival time: the given column, or now."""
    return tumbling(arrival, size) if arrival else F.window(F.current_timestamp(), as_interval(size))


def window_counts(df: DataFrame, keys: list[str], window: Column) -> DataFrame:
    """Rows per key and window, stamped with the window end."""
    counted = df.groupBy(*keys, window.alias("_w")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(*keys, F.col("_w.end").alias("window_end"), "n")


def sessions(df: DataFrame, keys: list[str], ts: str, gap: timedelta, value: str) -> DataFrame:
    """Session windows: rows at most ``gap`` apart, with bounds, row count and sum.

    Rows of one ``gap``-wide cell always share a session, so they are folded
    to one row per cell before the shuffle; sessions then join cells.
    """
    width = micros(gap)
    at = epoch_micros(F.col(ts))
    cells = (
        df.withColumn("_at", at)
        .groupBy(*keys, F.floor(F.col("_at") / width).alias("_cell"))
        .agg(
            F.min("_at").alias("_lo"),
            F.max("_at").alias("_hi"),
            F.count(F.lit(1)).alias("_n"),
            F.sum(value).alias("_total"),
        )
    )
    layout = layout_of(cells, keys, ["_cell"])
    linked = scan(cells, keys, ["_cell"], layout=layout, _prev=previous(F.col("_hi")))
    opens = F.col("_prev").isNull() | (F.col("_lo") - F.col("_prev") > width)
    numbered = scan(linked.withColumn("_opens", opens.cast("bigint")), keys, ["_cell"], layout=layout, _session=running_sum(F.col("_opens")))
    return (
        numbered.groupBy(*keys, "_session")
        .agg(
            F.min("_lo").alias("_lo"),
            (F.max("_hi") + width).alias("_hi"),
            F.sum("_n").alias("n"),
            F.sum("_total").alias("total"),
        )
        .select(
            *keys,
            F.timestamp_micros("_lo").alias("session_start"),
            F.timestamp_micros("_hi").alias("session_end"),
            "n",
            "total",
        )
    )


def lateness_tag(window_end: Column, watermark: Column, lateness: timedelta) -> Column:
    """``on_time``, ``late_accepted`` or ``too_late`` for a row of a window, all in microseconds."""
    return (
        F.when(watermark.isNull() | (window_end > watermark), "on_time")
        .when(window_end + micros(lateness) > watermark, "late_accepted")
        .otherwise("too_late")
    )


def window_end_micros(ts: str, size: timedelta) -> Column:
    """End of the epoch-aligned tumbling window holding a row."""
    width = micros(size)
    return (F.floor(epoch_micros(F.col(ts)) / width) + 1) * width


def classify_replay(
    df: DataFrame, ts: str, batch: str, size: timedelta, bound: timedelta, lateness: timedelta
) -> DataFrame:
    """Tag each row of a numbered replay as the stream would: the watermark at a batch is the
    largest event time of earlier batches minus ``bound``.

    Only one row per batch takes part in the ordered scan.
    """
    tops = df.groupBy(F.col(batch).alias("_b")).agg(F.max(epoch_micros(F.col(ts))).alias("_top"))
    marks = scan(tops.withColumn("_all", F.lit(0)), ["_all"], ["_b"], _seen=max_before(F.col("_top")))
    marks = marks.select("_b", (F.col("_seen") - micros(bound)).alias("_mark"))
    joined = lookup(df, marks, batch, "_b")
    tag = lateness_tag(window_end_micros(ts, size), F.col("_mark"), lateness)
    return joined.select(*df.columns, tag.alias("tag"))
