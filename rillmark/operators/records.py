"""Record shaping: log parsing and splitting, typed rows, wide rows, visitor feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from rillmark.functions import json
from rillmark.functions.text import is_blank, java_split
from rillmark.functions.times import epoch_micros, parse_datetime


def parse_delimited(df: DataFrame, text: str, schema: StructType, separator: str = ",") -> DataFrame:
    """Delimited lines to typed columns; a line that lacks a field or does not cast is ``dirty``."""
    parts = F.split(F.col(text), f"\\Q{separator}\\E")
    typed = [
        F.get(parts, F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)
    ]
    bad = F.lit(False)
    for i, field in enumerate(schema.fields):
        bad = bad | F.get(parts, F.lit(i)).try_cast(field.dataType).isNull()
    return df.select("*", *typed, F.coalesce(bad, F.lit(True)).alias("dirty"))


def parse_logs(df: DataFrame, text: str) -> DataFrame:
    """Add ``doc`` (VARIANT), ``mid``, ``is_new``, ``ts_ms`` and ``reason`` (NULL on good records).

    ``is_new`` is a column of its own: a variant is immutable and this flag
    is repaired later.
    """
    parsed = json.evaluate_once(df, doc=json.parse(F.col(text)))
    reason = (
        F.when(F.col("doc").isNull(), "bad_json")
        .when(~json.is_object(F.col(text)), "not_an_object")
        .when(json.get_string(F.col("doc"), "$.common.mid").isNull(), "no_mid")
    )
    return parsed.withColumns(
        {
            "reason": reason,
            "mid": json.get_string(F.col("doc"), "$.common.mid"),
            "is_new": json.get_string(F.col("doc"), "$.common.is_new"),
            "ts_ms": json.get_long(F.col("doc"), "$.ts"),
        }
    )


def good_logs(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNull()).drop("reason")


def dirty_logs(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNotNull())


def tag_logs(logs: DataFrame) -> DataFrame:
    """``kind`` = ``start`` for records with a non-empty start part, else ``page``."""
    start = json.has_value(F.col("doc"), "$.start")
    return logs.withColumn("kind", F.when(start, "start").otherwise("page"))


def repaired_common() -> Column:
    """The record's ``common`` with ``is_new`` as the column says; all other members and their types stay."""
    members = F.try_variant_get("doc", "$.common", "map<string,variant>")
    return json.with_member(members, "is_new", F.variant_get(F.parse_json(F.to_json(F.struct("is_new"))), "$.is_new", "variant"))


def page_displays(tagged: DataFrame, *keep: str) -> DataFrame:
    """One row per element of a page record's ``displays``: ``common, page, ts, display``."""
    pages = tagged.filter(F.col("kind") == "page")
    doc = F.col("doc")
    return pages.select(
        *keep,
        repaired_common().alias("common"),
        F.try_variant_get(doc, "$.page", "variant").alias("page"),
        json.get_long(doc, "$.ts").alias("ts"),
        F.explode(json.get_array(doc, "$.displays")).alias("display"),
    )


def typed_rows(df: DataFrame, text: str, schema: StructType | str, *keep: str) -> DataFrame:
    """JSON text to the columns of ``schema``; unknown fields are dropped, missing ones NULL.

    Plain values are read as text and then cast, so that numbers may come quoted.
    """
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    nested = (StructType, ArrayType, MapType)
    loose = StructType([StructField(f.name, f.dataType if isinstance(f.dataType, nested) else StringType()) for f in fields])
    source = df.select(*dict.fromkeys([*keep, text]))
    parsed = json.evaluate_once(source, _row=F.from_json(text, loose))
    return parsed.select(*keep, *[F.col(f"_row.{f.name}").try_cast(f.dataType).alias(f.name) for f in fields])


def json_rows(df: DataFrame, *columns: str, name: str = "value") -> DataFrame:
    """Rows to JSON text in column ``value``."""
    return df.select(F.to_json(F.struct(*(columns or df.columns))).alias(name))


def merged_log_text(logs: DataFrame) -> Column:
    """The whole record's text with the repaired flag written back into ``common.is_new``."""
    return F.to_json(json.with_member(F.try_variant_get("doc", "$", "map<string,variant>"), "common", repaired_common()))


def derive_create_times(df: DataFrame, create_time: str = "create_time") -> DataFrame:
    """Add ``create_date``, ``create_hour`` and ``create_ts`` (epoch ms) from datetime text."""
    at = parse_datetime(F.col(create_time))
    return df.withColumns(
        {
            "create_date": F.date_format(at, "yyyy-MM-dd"),
            "create_hour": F.date_format(at, "HH"),
            "create_ts": F.unix_millis(at),
        }
    )


def order_wide_columns(joined: DataFrame, detail: str = "d_", order: str = "o_", *keep: str) -> DataFrame:
    """Pick each wide column from its side; both inputs carry a name prefix."""
    o, d = lambda c: F.col(f"{order}{c}"), lambda c: F.col(f"{detail}{c}")
    from_detail = [
        "sku_id", "order_price", "sku_num", "sku_name", "split_activity_amount", "split_coupon_amount",
        "split_total_amount",
    ]
    from_order = [
        "province_id", "order_status", "user_id", "total_amount", "activity_reduce_amount", "coupon_reduce_amount",
        "original_total_amount", "feight_fee", "expire_time", "create_time", "operate_time", "create_date",
        "create_hour",
    ]
    return joined.select(
        *keep,
        d("id").alias("detail_id"),
        o("id").alias("order_id"),
        *[d(c).alias(c) for c in from_detail],
        *[o(c).alias(c) for c in from_order],
        # No input supplies the detail's share of the freight.
        F.lit(None).cast("decimal(18,2)").alias("split_feight_fee"),
    )


PAYMENT_FIRST = ["user_id", "order_id", "total_amount", "subject", "payment_type", "callback_time"]


def payment_wide_columns(joined: DataFrame, payment: str = "p_", wide: str = "w_") -> DataFrame:
    """Order-wide columns overlaid by the payment's; the order's amount stays as ``order_total_amount``."""
    dropped = {"expire_time", "create_time", "operate_time", "create_date", "create_hour", *PAYMENT_FIRST}
    names = [c[len(wide):] for c in joined.columns if c.startswith(wide)]
    return joined.select(
        F.col(f"{payment}id").alias("payment_id"),
        *[F.col(f"{payment}{c}").alias(c) for c in PAYMENT_FIRST],
        F.col(f"{payment}create_time").alias("payment_create_time"),
        F.col(f"{wide}create_time").alias("order_create_time"),
        F.col(f"{wide}total_amount").alias("order_total_amount"),
        *[F.col(f"{wide}{c}").alias(c) for c in names if c not in dropped],
    )


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[f"{prefix}{c}" for c in df.columns])


def visitor_feed(df: DataFrame, kind: str, dims: list[str], ts: str, last_page: str | None = None,
                 during: str | None = None) -> DataFrame:
    """Normalise one feed (``page``, ``uv`` or ``bounce``) to visitor measures."""
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    measures = dict.fromkeys(["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"], zero)
    if kind == "page":
        measures["pv_ct"] = one
        measures["sv_ct"] = F.when(is_blank(F.col(last_page)), one).otherwise(zero)
        measures["dur_sum"] = F.coalesce(F.col(during), zero)
    elif kind == "uv":
        measures["uv_ct"] = one
    elif kind == "bounce":
        measures["uj_ct"] = one
    else:
        raise ValueError(f"unknown feed {kind!r}")
    return df.select(*dims, F.col(ts).alias("ts"), *[m.alias(n) for n, m in measures.items()])


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """Union of feeds by column name, duplicates kept."""
    first, *rest = feeds
    for feed in rest:
        first = first.unionByName(feed, allowMissingColumns=True)
    return first


def line_lengths(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("length", F.length(text))


def words(df: DataFrame, text: str) -> DataFrame:
    """``(word, 1)`` per word by single space."""
    return df.select(F.explode(java_split(F.col(text), " ")).alias("word"), F.lit(1).alias("n"))


def with_prefix(df: DataFrame, text: str, prefix: str) -> DataFrame:
    return df.filter(F.col(text).startswith(prefix))


def add_processing_time(df: DataFrame, name: str = "p") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def add_partition_id(df: DataFrame, name: str = "task") -> DataFrame:
    return df.withColumn(name, F.spark_partition_id())


def epoch_ms(ts: str) -> Column:
    return F.floor(epoch_micros(F.col(ts)) / 1000).cast("bigint")
