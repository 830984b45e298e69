"""Bounded checks that decide how a join or a keyed scan is laid out.

A key is *hot* when it holds about ``max_rows`` rows or more. There are at
most a little over ``rows / max_rows`` hot keys, which is what makes their
table safe to broadcast. Results never depend on which keys were found hot,
only the layout does, so the keys are counted on a sample. The defaults can
be changed with ``spark.conf``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.session import ensure_checkpoint_dir

HOT_ROWS_CONF = "rillmark.hotRows"
HOT_ROWS = 4_000_000
BROADCAST_ROWS_CONF = "rillmark.broadcastRows"
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
SAMPLED_ROWS = 400


def hot_rows(df: DataFrame, max_rows: int | None = None) -> int:
    return max_rows or int(df.sparkSession.conf.get(HOT_ROWS_CONF, str(HOT_ROWS)))


def broadcast_rows(df: DataFrame, max_rows: int | None = None) -> int:
    return max_rows or int(df.sparkSession.conf.get(BROADCAST_ROWS_CONF, str(BROADCAST_ROWS)))


def null_safe(left: list[Column], right: list[Column]) -> Column:
    """Conjunction of ``<=>`` over two column lists."""
    return reduce(lambda a, b: a & b, [l.eqNullSafe(r) for l, r in zip(left, right)])


def hot_keys(df: DataFrame, keys: list[Column], max_rows: int | None = None) -> DataFrame | None:
    """Checkpointed table ``(hot_0.., hot_n)`` of the hot keys, or None when there are none.

    A key at the limit is expected ``SAMPLED_ROWS`` times in the sample; three
    quarters of that make it hot, five standard deviations below. Only the
    key columns are read and almost no rows are shuffled.
    """
    ensure_checkpoint_dir(df.sparkSession)
    limit = hot_rows(df, max_rows)
    share = min(1.0, SAMPLED_ROWS / limit)
    cut = limit if share == 1.0 else 0.75 * SAMPLED_ROWS
    named = df.select(*[k.alias(f"hot_{i}") for i, k in enumerate(keys)])
    sampled = named if share == 1.0 else named.filter(F.rand(23) < share)
    counts = sampled.groupBy(*named.columns).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > cut)
    hot = counts.select(*named.columns, F.ceil(F.col("_n") / share).alias("hot_n")).checkpoint()
    return None if hot.isEmpty() else hot


def spread(df: DataFrame, parts: int) -> Column:
    """A number below ``parts`` for every row of ``df``.

    Drawn from the row and the task that reads it, so equal rows of different
    tasks spread too, and a task that is run again draws the same numbers.
    """
    drawn = F.xxhash64(*[F.col(c).cast("string") for c in df.columns]) + F.spark_partition_id().cast("bigint") * 7919
    return F.pmod(drawn, F.lit(parts)).cast("int")


def row_bytes(df: DataFrame) -> Column:
    """Approximate width of a row: text by its length, anything else nested by its JSON, the rest 8 bytes."""
    width = F.lit(0)
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            width = width + F.coalesce(F.length(F.to_json(F.struct(name))), F.lit(0))
        else:
            width = width + 8
    return width.cast("bigint")


def measure_dimensions(dims: list[tuple[DataFrame, str]], max_rows: int | None = None) -> list[tuple[bool, bool]]:
    """Per ``(dimension, key)``: does it fit a broadcast, and is the key unique (NULL keys ignored).

    All are measured by one job, each by one aggregate.
    """
    totals = []
    for i, (df, key) in enumerate(dims):
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df)).alias("bytes"))
        repeats = F.max(F.when(F.col(key).isNotNull(), F.col("n"))).alias("most")
        totals.append(per_key.agg(F.lit(i).alias("i"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), repeats))
    rows = sorted(reduce(DataFrame.unionByName, totals).collect())
    return [
        ((r.n or 0) <= broadcast_rows(df, max_rows) and (r.bytes or 0) <= BROADCAST_BYTES, (r.most or 0) <= 1)
        for r, (df, _) in zip(rows, dims)
    ]
