"""Open JSON documents as VARIANT values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse(text: Column) -> Column:
    """JSON text -> VARIANT, NULL for bad or empty text."""
    return F.try_parse_json(text)


def evaluate_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns behind a generator.

    Filters on a plain projected column are pushed below it and repeat its
    expression for every reference; a generator's output is computed once.
    """
    one = F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))
    return df.select("*", F.inline(one))


def is_object(text: Column) -> Column:
    """True when well-formed JSON text holds an object, not a scalar or an array."""
    return F.coalesce(F.ltrim(text, F.lit(" \t\r\n")).startswith("{"), F.lit(False))


def get_string(document: Column, path: str) -> Column:
    return F.try_variant_get(document, path, "string")


def get_long(document: Column, path: str) -> Column:
    return F.try_variant_get(document, path, "bigint")


def get_array(document: Column, path: str) -> Column:
    return F.try_variant_get(document, path, "array<variant>")


def with_member(members: Column, name: str, value: Column) -> Column:
    """A variant object from a map of members with one replaced or added; a NULL value leaves it out of the change."""
    changed = F.map_concat(F.map_filter(members, lambda k, _: k != name), F.create_map(F.lit(name), value))
    return F.parse_json(F.to_json(F.when(value.isNull(), members).otherwise(changed)))


def has_value(document: Column, path: str) -> Column:
    """True when the path holds something other than a missing value, null or ``''``."""
    value = F.try_variant_get(document, path, "variant")
    empty = F.coalesce(F.try_variant_get(document, path, "string"), F.lit("?")) == ""
    return value.isNotNull() & ~F.is_variant_null(value) & ~empty
