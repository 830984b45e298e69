"""Per-device analytics over an ordered history: the batch form of keyed state."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmark.functions.times import epoch_micros, micros
from rillmark.operators.scan import first_of_key, following, previous, running_count, scan


def repair_new_visitors(
    df: DataFrame,
    key: str,
    flag: str,
    order: list[str],
    seed_from_old: bool = False,
    max_rows: int | None = None,
) -> DataFrame:
    """Keep ``flag = '1'`` on the first claim of each key, turn later claims into ``'0'``.

    Rows already ``'0'`` pass through; they count as "seen before" only with
    ``seed_from_old``. Without it they need no history and skip the shuffle.
    """
    if seed_from_old:
        counted = scan(df, [key], order, max_rows, _seen=running_count())
        repaired = F.when((F.col(flag) == "1") & (F.col("_seen") > 1), "0").otherwise(F.col(flag))
        return counted.withColumn(flag, repaired).select(*df.columns)
    claims = scan(df.filter(F.col(flag) == "1"), [key], order, max_rows, _seen=running_count())
    repaired = claims.withColumn(flag, F.when(F.col("_seen") > 1, "0").otherwise("1"))
    others = df.filter(~F.col(flag).eqNullSafe("1"))
    return repaired.select(*df.columns).unionByName(others)


def daily_first_visits(
    df: DataFrame, key: str, day: Column, order: list[str], mode: str = "first", max_rows: int | None = None
) -> DataFrame:
    """One row per key and day: the earliest by ``order``.

    ``mode="change"`` is the arrival-order form: a row is kept whenever its
    day differs from the day of the key's preceding row.
    """
    dated = df.withColumn("_day", day)
    if mode == "first":
        rank = F.row_number().over(Window.partitionBy(key, "_day").orderBy(*order))
        return dated.withColumn("_rank", rank).filter("_rank = 1").drop("_rank", "_day")
    if mode != "change":
        raise ValueError(f"unknown mode {mode!r}")
    kept = scan(dated, [key], order, max_rows, _last=previous(F.col("_day")))
    return kept.filter("_last is null or _last <> _day").select(*df.columns)


def delta_alerts(
    df: DataFrame,
    key: str,
    value: str,
    threshold: float,
    order: list[str],
    baseline: str = "previous",
    max_rows: int | None = None,
) -> DataFrame:
    """Rows whose value moved by at least ``threshold`` from the previous (or the first) one."""
    if baseline == "previous":
        last = previous(F.col(value))
    elif baseline == "first":
        last = first_of_key(F.col(value))
    else:
        raise ValueError(f"unknown baseline {baseline!r}")
    compared = scan(df, [key], order, max_rows, last_value=last)
    return compared.filter(F.abs(F.col(value) - F.col("last_value")) >= threshold)


def bounces(
    df: DataFrame,
    key: str,
    ts: str,
    entry: Column,
    tie: list[str],
    within: timedelta,
    max_rows: int | None = None,
) -> DataFrame:
    """Entry rows not followed by a non-entry row of the same key inside ``within``."""
    marked = df.withColumn("_entry", entry)
    looked = scan(marked, [key], [ts, *tie], max_rows, _next=following(F.struct(F.col(ts), F.col("_entry"))))
    return looked.filter(is_bounce(F.col("_entry"), F.col(ts), F.col("_next"), ts, within)).select(*df.columns)


def is_bounce(entry: Column, ts: Column, following_row: Column, ts_field: str, within: timedelta) -> Column:
    """The bounce rule given the key's next row ``(ts, _entry)``, NULL at the end of its history."""
    gap = epoch_micros(following_row[ts_field]) - epoch_micros(ts)
    return entry & (following_row.isNull() | (gap >= micros(within)) | following_row["_entry"])


def visit_flags(
    df: DataFrame,
    key: str,
    ts: str,
    tie: list[str],
    entry: Column,
    within: timedelta,
    max_rows: int | None = None,
) -> DataFrame:
    """Add ``uv`` (first visit of the day), ``sv`` (entry) and ``uj`` (bounce) flags in one pass.

    In event-time order the first row of a day is the one whose preceding
    row has another day, so all three flags share one ordered scan by key.
    """
    marked = df.withColumns({"_entry": F.coalesce(entry, F.lit(False)), "_day": F.to_date(ts)})
    looked = scan(
        marked,
        [key],
        [ts, *tie],
        max_rows,
        _before=previous(F.col("_day")),
        _next=following(F.struct(F.col(ts), F.col("_entry"))),
    )
    bounced = is_bounce(F.col("_entry"), F.col(ts), F.col("_next"), ts, within)
    first_today = F.col("_before").isNull() | (F.col("_before") != F.col("_day"))
    flags = {"uv": first_today, "sv": F.col("_entry"), "uj": bounced}
    return looked.select(*df.columns, *[f.cast("bigint").alias(n) for n, f in flags.items()])
