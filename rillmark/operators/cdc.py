"""Change records: normalisation, configuration state, config-driven routing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmark.functions import json
from rillmark.functions.text import is_blank, join_key
from rillmark.operators.joins import lookup

OPERATION_NAMES = {"create": "insert", "c": "insert", "d": "delete"}
ENVELOPE = "topic string, op string, ts bigint, before map<string,string>, after map<string,string>"
CONFIG_FIELDS = ["sourceTable", "operateType", "sinkType", "sinkTable", "sinkColumns", "sinkPk", "sinkExtend"]
DIMENSION_SINK, FACT_SINK = "hbase", "kafka"


def read_envelopes(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """Change-envelope JSON to ``topic, op, ts, before, after``."""
    parsed = json.evaluate_once(df.select(*keep, text), _e=F.from_json(text, ENVELOPE))
    return parsed.select(*keep, "_e.*")


def normalise_changes(df: DataFrame, images: str = "single") -> DataFrame:
    """``topic, op, ts, before, after`` to ``database, table, type, ts`` and the row image(s).

    ``single``: ``data`` is the before image of a delete, else the after image.
    ``both``: ``before_data`` and ``after_data``, empty maps when absent.
    ``after``: ``data`` is the after image (NULL on delete) and ``type`` the raw operation.
    """
    parts = F.split("topic", "\\.")
    kind = F.lower("op")
    for raw, name in OPERATION_NAMES.items():
        kind = F.when(F.lower("op") == raw, name).otherwise(kind)
    keep = [c for c in df.columns if c not in ("topic", "op", "before", "after", "ts")]
    head = [*keep, F.get(parts, F.lit(1)).alias("database"), F.get(parts, F.lit(2)).alias("table")]
    if images == "single":
        data = F.when(kind == "delete", F.col("before")).otherwise(F.col("after"))
        return df.select(*head, kind.alias("type"), "ts", data.alias("data"))
    if images == "both":
        nothing = F.create_map().cast("map<string,string>")
        return df.select(
            *head, kind.alias("type"), "ts",
            F.coalesce("before", nothing).alias("before_data"), F.coalesce("after", nothing).alias("after_data"),
        )
    if images == "after":
        return df.select(*head, F.col("op").alias("type"), "ts", F.col("after").alias("data"))
    raise ValueError(f"unknown images {images!r}")


def with_snapshot(changes: DataFrame, snapshot: DataFrame | None) -> DataFrame:
    """Start mode of a change feed: ``initial`` puts the snapshot first as ``read`` records."""
    if snapshot is None:
        return changes
    return snapshot.withColumn("type", F.lit("read")).unionByName(changes)


def drop_empty(changes: DataFrame) -> DataFrame:
    """Drop records without a row image; deletes carry theirs and stay."""
    return changes.filter(F.col("data").isNotNull())


def config_state(changes: DataFrame, order: list[str]) -> DataFrame:
    """Live configuration: the latest change per ``(sourceTable, operateType)``, deletes removed."""
    window = Window.partitionBy("sourceTable", "operateType").orderBy(*[F.col(c).desc() for c in order])
    latest = changes.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1")
    return latest.filter(F.col("type") != "delete").select(*CONFIG_FIELDS)


def sink_tables(changes: DataFrame, live: DataFrame) -> DataFrame:
    """Dimension sink tables ever configured and whether they stay (``create``) or go (``drop``)."""
    is_dim = F.lower("sinkType") == DIMENSION_SINK
    ever = changes.filter(is_dim & (F.col("type") != "delete")).select("sinkTable").distinct()
    kept = live.filter(is_dim).select(F.col("sinkTable").alias("_kept")).distinct()
    joined = ever.join(kept, F.col("sinkTable") == F.col("_kept"), "left")
    action = F.when(F.col("_kept").isNull(), "drop").otherwise("create")
    return joined.select("sinkTable", action.alias("action"))


def sink_schema(config: dict[str, str]) -> str:
    """Schema of a new dimension table: ``pk`` and the sink columns, all strings."""
    columns = [c.strip() for c in config["sinkColumns"].split(",") if c.strip()]
    return ", ".join(["pk string", *[f"`{c}` string" for c in columns if c.lower() != "pk"]])


def listed_names(listed: Column) -> Column:
    """A comma list as lower-case names."""
    return F.split(F.regexp_replace(F.lower(listed), "\\s", ""), ",")


def key_values(data: Column, names: Column) -> Column:
    """The values of the named columns of a row image, NULL where a name is missing."""
    entries = F.map_entries(data)

    def value(name: Column) -> Column:
        return F.try_element_at(F.filter(entries, lambda e: F.lower(e["key"]) == name), F.lit(1))["value"]

    return F.transform(names, value)


def row_key(data: Column, key_columns: Column) -> Column:
    """Values of the comma-listed columns joined by ``-``; NULL when one is missing."""
    return join_key(key_values(data, listed_names(key_columns)))


def keep_columns(data: Column, names: Column) -> Column:
    """Only the map entries whose key is among the lower-case names, whatever its case."""
    return F.map_filter(data, lambda k, _: F.array_contains(names, F.lower(k)))


def route(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Tag every change by its ``(table, type)`` configuration.

    ``dim`` and ``fact`` rows get ``sinkTable``, ``pk`` (taken before columns
    are filtered) and the filtered ``data``; ``bad_key`` has no usable key;
    ``unrouted`` has no configuration or another kind of sink.
    """
    route_key = F.concat_ws("\u0001", "_table", "_type")
    live = config.withColumns({"_table": F.col("sourceTable"), "_type": F.col("operateType")}).select(
        route_key.alias("_route"),
        F.lower("sinkType").alias("_sink"),
        "sinkTable",
        listed_names(F.col("sinkColumns")).alias("_columns"),
        F.when(~is_blank(F.col("sinkPk")), listed_names(F.col("sinkPk"))).alias("_pk"),
    )
    keyed = changes.withColumn("_key", F.concat_ws("\u0001", "table", "type"))
    return _tagged(lookup(keyed, live, "_key", "_route")).drop("_key")


def route_matched(changes: DataFrame) -> DataFrame:
    """As :func:`route`, for changes that carry their own configuration row (NULLs where there is none)."""
    listed = F.when(~is_blank(F.col("sinkPk")), listed_names(F.col("sinkPk")))
    known = {"_sink": F.lower("sinkType"), "_columns": listed_names(F.col("sinkColumns")), "_pk": listed}
    return _tagged(changes.withColumns(known).drop("sinkType", "sinkColumns", "sinkPk"))


def _tagged(matched: DataFrame) -> DataFrame:
    joined = json.evaluate_once(matched, _values=key_values(F.col("data"), F.col("_pk")))
    known = F.coalesce(F.col("_sink").isin(DIMENSION_SINK, FACT_SINK), F.lit(False))
    no_key = F.col("_values").isNull() | F.exists("_values", lambda v: v.isNull())
    tag = (
        F.when(~known, "unrouted")
        .when(no_key, "bad_key")
        .when(F.col("_sink") == DIMENSION_SINK, "dim")
        .otherwise("fact")
    )
    filtered = keep_columns(F.col("data"), F.col("_columns"))
    return (
        joined.withColumns({"tag": tag, "pk": join_key(F.col("_values"))})
        .withColumn("data", F.when(F.col("tag").isin("dim", "fact"), filtered).otherwise(F.col("data")))
        .drop("_sink", "_columns", "_pk", "_values")
    )


def latest_per_key(
    changes: DataFrame, keys: list[str], version: list[str], values: list[str], sets: Callable[[str], Column] | None = None
) -> DataFrame:
    """Column-partial upsert: per key the last present value of each column, ``deleted`` if last seen deleted.

    ``sets(c)`` tells whether a change sets column c, be it to NULL; without
    it a change sets what is not NULL. A value counts only when it is newer
    than the key's last delete. ``_has_<c>`` tells whether c was set at all.
    The aggregate is mergeable, so repeated keys are folded before the shuffle.
    """
    sets = sets or (lambda c: F.col(c).isNotNull())
    at = F.struct(*version)
    is_delete = F.col("type") == "delete"
    last_set = [
        F.max(F.when(~is_delete & sets(c), F.struct(at.alias("at"), F.col(c).alias("v")))).alias(f"_{c}")
        for c in values
    ]
    grouped = changes.groupBy(*keys).agg(
        F.max(F.when(is_delete, at)).alias("_gone"), F.max(F.when(~is_delete, at)).alias("_set"), *last_set
    )
    gone = F.col("_gone")
    alive = F.col("_set").isNotNull() & (gone.isNull() | (F.col("_set") > gone))
    newer = lambda c: gone.isNull() | (F.col(f"_{c}.at") > gone)
    return grouped.select(
        *keys,
        *[F.when(newer(c), F.col(f"_{c}.v")).alias(c) for c in values],
        *[F.coalesce(F.col(f"_{c}").isNotNull() & newer(c), F.lit(False)).alias(f"_has_{c}") for c in values],
        (~alive).alias("deleted"),
        gone.isNotNull().alias("reset"),
    )
