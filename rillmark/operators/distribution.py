"""Ways to spread rows over tasks. All keep the rows as they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.operators.skew import spread


def shuffle_random(df: DataFrame, n: int) -> DataFrame:
    """Spread rows without regard to any key.

    A random partitioner draws anew when a lost task is run again and could
    then lose or repeat rows, so the draw is a function of row and task.
    """
    return df.withColumn("_draw", spread(df, n)).repartitionById(n, "_draw").drop("_draw")


def rebalance(df: DataFrame, n: int) -> DataFrame:
    """Even round robin; Spark sorts rows first so that a re-run task repeats it."""
    return df.repartition(n)


def rescale(df: DataFrame, n: int) -> DataFrame:
    """Merge neighbouring partitions without a shuffle."""
    return df.coalesce(n)


def pin_matching(df: DataFrame, n: int, condition: Column, salt: list[str]) -> DataFrame:
    """Rows that match go to partition 0, all others are spread over the rest by ``salt``."""
    other = F.pmod(F.xxhash64(*salt), F.lit(max(n - 1, 1))) + min(1, n - 1)
    return df.repartitionById(n, F.when(condition, 0).otherwise(other).cast("int"))


def gather(df: DataFrame) -> DataFrame:
    """Everything in one partition; for small results only."""
    return df.coalesce(1)


def by_key(df: DataFrame, n: int, *keys: str | Column) -> DataFrame:
    """Hash partitioning by any number of key expressions."""
    return df.repartition(n, *keys)
