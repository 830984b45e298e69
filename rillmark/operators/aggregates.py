"""Keyed aggregates: running forms give one row per input row, final forms one per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmark.functions.text import java_split
from rillmark.operators.scan import first_of_key, running_count, running_max, running_max_row, running_sum, scan

STAT_SUMS = ["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]


def running_total(df: DataFrame, keys: list[str], value: Column, order: list[str], name: str) -> DataFrame:
    """Running sum per key, one output row per input row."""
    return scan(df, keys, order, **{name: running_sum(value)})


def running_best_row(df: DataFrame, keys: list[str], by: str, order: list[str], keep: list[str]) -> DataFrame:
    """Running "row with the largest value so far": ``best`` is a struct of ``keep``."""
    best = running_max_row(F.struct(*keep), F.col(by), order)
    return scan(df, keys, order, best=best)


def running_maximum(df: DataFrame, keys: list[str], value: str, order: list[str], name: str) -> DataFrame:
    """Running maximum per key (the reduce form keeps key and maximum only)."""
    return scan(df, keys, order, **{name: running_max(F.col(value))})


def running_maximum_first_fields(
    df: DataFrame, keys: list[str], value: str, order: list[str], fields: list[str]
) -> DataFrame:
    """Running ``max``: only the field moves, the other fields stay those of the first row."""
    outputs = {f"first_{f}": first_of_key(F.col(f)) for f in fields}
    return scan(df, keys, order, **{f"max_{value}": running_max(F.col(value))}, **outputs)


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """Words by single space with their counts."""
    words = df.select(F.explode(java_split(F.col(text), " ")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def first_row_per_group(df: DataFrame, groups: list[str], order: list[Column]) -> DataFrame:
    """The first whole row of each group; map tasks send one row per group at most."""
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def partition_counter(df: DataFrame) -> DataFrame:
    """Rows per input partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("n"))


def partition_running_counter(df: DataFrame, name: str = "n") -> DataFrame:
    """Number each row within its task: 1, 2, 3, ... without a shuffle."""
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return df.withColumn(name, position + 1)


def count_windows(
    df: DataFrame, keys: list[str], order: list[str], size: int, value: Column, only_full: bool = False
) -> DataFrame:
    """Windows of ``size`` consecutive rows per key with their row count and sum."""
    numbered = scan(df.withColumn("_value", value), keys, order, _n=running_count())
    bucket = F.floor((F.col("_n") - 1) / size).cast("bigint").alias("bucket")
    grouped = numbered.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias("n"), F.sum("_value").alias("total"))
    return grouped.filter(F.col("n") == size) if only_full else grouped


def visitor_statistics(feed: DataFrame, dims: list[str], window: Column) -> DataFrame:
    """Sum the five visitor measures per dimension and window; ``stt``/``edt`` are its bounds."""
    sums = [F.sum(c).alias(c) for c in STAT_SUMS]
    bounds = [
        F.date_format("_w.start", "yyyy-MM-dd HH:mm:ss").alias("stt"),
        F.date_format("_w.end", "yyyy-MM-dd HH:mm:ss").alias("edt"),
    ]
    grouped = feed.groupBy(*dims, window.alias("_w")).agg(*sums)
    return grouped.select(*bounds, *dims, *STAT_SUMS)
