"""String and flag expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def java_split(text: Column, pattern: str) -> Column:
    """Split by a regex and drop trailing empty parts; ``''`` gives one empty part."""
    parts = F.split(text, pattern)
    trailing = F.array_position(F.transform(F.reverse(parts), lambda e: e != ""), F.lit(True))
    kept = F.slice(parts, 1, (F.size(parts) - trailing + 1).cast("int"))
    none_left = F.array().cast("array<string>")
    return F.when(text == "", F.array(F.lit(""))).when(trailing == 0, none_left).otherwise(kept)


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units: characters beyond the basic plane count twice."""
    astral = F.length(F.regexp_replace(text, "[^\\x{10000}-\\x{10FFFF}]", ""))
    return F.length(text) + astral


def is_blank(text: Column) -> Column:
    """True for NULL and for the empty string."""
    return F.coalesce(text, F.lit("")) == ""


def wrap_int32(value: Column) -> Column:
    """Fold a BIGINT to the signed 32-bit integer with the same low bits."""
    low = value.bitwiseAND(F.lit(0xFFFFFFFF))
    return F.when(low >= 2**31, low - F.lit(2**32)).otherwise(low)


def string_hash(text: Column, factor: int = 1) -> Column:
    """``s[0]*31^(n-1)+...`` over UTF-16 units in 32-bit arithmetic, times ``factor``."""

    def step(acc: Column, char: Column) -> Column:
        code = F.ascii(char)
        high = F.lit(0xD800) + F.shiftright(code - 0x10000, 10)
        low = F.lit(0xDC00) + (code - 0x10000).bitwiseAND(F.lit(0x3FF))
        basic = acc * 31 + code
        pair = (acc * 31 + high) * 31 + low
        return F.when(code < 0x10000, basic).otherwise(pair).bitwiseAND(F.lit(0xFFFFFFFF))

    chars = F.filter(F.split(text, ""), lambda c: c != "")
    base = F.aggregate(chars, F.lit(0).cast("bigint"), step)
    return wrap_int32(wrap_int32(base) * F.lit(factor).cast("bigint")).cast("int")


def join_key(values: Column, separator: str = "-") -> Column:
    """Join an array into a key; NULL when any part is NULL (``array_join`` would skip it)."""
    return F.when(~F.exists(values, lambda v: v.isNull()), F.array_join(values, separator))


def snake_to_camel(name: str) -> str:
    """``order_id`` or ``ORDER_ID`` -> ``orderId``."""
    head, *rest = name.lower().split("_")
    return head + "".join(word.capitalize() for word in rest)


def camel_columns(df: DataFrame) -> DataFrame:
    """Rename every column from snake to camel case (metadata only)."""
    return df.toDF(*[snake_to_camel(c) for c in df.columns])
