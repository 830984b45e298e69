"""User-function surface: the native expressions stay the fast path.

Each class is for SQL text that names a function; inside the library the
expressions of ``functions.text`` and the built-in aggregates are used.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def register_string_hash(spark: SparkSession, factor: int, name: str = "hash_code") -> None:
    """SQL scalar function with a constructor argument: ``functions.text.string_hash`` as SQL text."""
    step = (
        "(acc, c) -> (CASE WHEN ascii(c) < 65536 THEN acc * 31 + ascii(c) "
        "ELSE (acc * 31 + 55296 + shiftright(ascii(c) - 65536, 10)) * 31 + 56320 + ((ascii(c) - 65536) & 1023) END) & 4294967295"
    )
    base = f"aggregate(filter(split(t, ''), c -> c <> ''), 0L, {step})"
    times = f"(({_wrapped(base)}) * {int(factor)}L)"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(t STRING) RETURNS INT RETURN CAST({_wrapped(times)} AS INT)")


def _wrapped(number: str) -> str:
    """SQL for the signed 32-bit integer with the low bits of a BIGINT."""
    low = f"({number} & 4294967295)"
    return f"(({low} + 2147483648) & 4294967295) - 2147483648"


def register_string_hash_arrow(spark: SparkSession, factor: int, name: str = "hash_code_arrow") -> None:
    """The same as a Python function over Arrow batches: the pattern for what SQL cannot express."""

    @F.pandas_udf("int")
    def hash_code(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else _hash32(t, factor)).astype("Int32")

    spark.udf.register(name, hash_code)


def _hash32(text: str, factor: int) -> int:
    units = text.encode("utf-16-be")
    value = 0
    for high, low in zip(units[::2], units[1::2]):
        value = (value * 31 + (high << 8 | low)) & 0xFFFFFFFF
    value = (value * factor) & 0xFFFFFFFF
    return value - 2**32 if value >= 2**31 else value


def register_splitter(spark: SparkSession, cutter: str, name: str = "split_words") -> None:
    """SQL table function ``name(text) -> (word, length)`` for LATERAL use; trailing empty parts go."""
    quoted = cutter.replace("\\", "\\\\").replace("'", "\\'")
    parts = f"split(t, '{quoted}')"
    last = f"array_position(transform(reverse({parts}), e -> e <> ''), true)"
    kept = f"CASE WHEN t = '' THEN array('') WHEN {last} = 0 THEN slice({parts}, 1, 0) ELSE slice({parts}, 1, CAST(size({parts}) - {last} + 1 AS INT)) END"
    length = "CAST(length(word) + length(regexp_replace(word, '[^\\\\x{10000}-\\\\x{10FFFF}]', '')) AS INT)"
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(t STRING) RETURNS TABLE(word STRING, length INT) "
        f"RETURN SELECT word, {length} FROM (SELECT explode({kept}) AS word)"
    )


def accumulate(
    df: DataFrame,
    keys: list[str],
    partial: Callable[[pd.DataFrame], pd.DataFrame],
    merge: Callable[[pd.DataFrame], pd.DataFrame],
    result: Callable[[DataFrame], DataFrame],
    partial_schema: str,
    flush_rows: int = 200_000,
) -> DataFrame:
    """Mergeable user aggregate: create/add per partition, merge per key, then the result.

    ``partial`` turns input rows into one accumulator row per key, ``merge``
    folds accumulator rows of the same key. Each task sends at most one
    accumulator per key and flush, so a dominant key never gathers its rows.
    """

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            fresh = partial(batch)
            held = fresh if held is None else merge(pd.concat([held, fresh], ignore_index=True))
            if len(held) > flush_rows:
                yield held
                held = None
        if held is not None:
            yield held

    accumulators = df.mapInPandas(add, partial_schema)
    return result(accumulators.groupBy(*keys).applyInPandas(merge, partial_schema))


def average(df: DataFrame, key: str, value: str) -> DataFrame:
    """The ``(sum, count)`` average written against ``accumulate``; no rows give no group."""
    key_type, schema = df.schema[key].dataType.simpleString(), df.select(key, value)

    def partial(rows: pd.DataFrame) -> pd.DataFrame:
        grouped = rows.groupby(key, dropna=False)[value]
        return grouped.agg(total="sum", n="count").reset_index()

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.groupby(key, dropna=False)[["total", "n"]].sum().reset_index()

    def result(acc: DataFrame) -> DataFrame:
        return acc.select(key, F.try_divide("total", "n").alias("average"))

    return accumulate(schema, [key], partial, merge, result, f"{key} {key_type}, total double, n bigint")


def map_with_resource(
    df: DataFrame,
    open_resource: Callable[[], object],
    apply: Callable[[object, pd.DataFrame], pd.DataFrame],
    close_resource: Callable[[object], None],
    schema: str,
) -> DataFrame:
    """Rich-function lifecycle: open once per partition, map batches, close at the end."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = open_resource()
        try:
            for batch in batches:
                yield apply(resource, batch)
        finally:
            close_resource(resource)

    return df.mapInPandas(run, schema)
