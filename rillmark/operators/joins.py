"""Time-bounded joins, dimension lookups and wide-row merging."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.functions.text import java_split
from rillmark.functions.times import age_on, epoch_micros, micros
from rillmark.operators.skew import hot_keys, hot_rows, measure_dimensions, spread
from rillmark.session import ensure_checkpoint_dir

#: Draws that a hot key's pieces are taken from.
DRAWS = 1 << 20


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: list[tuple[str, str]],
    left_ts: str,
    right_ts: str,
    lower: timedelta,
    upper: timedelta,
    max_rows: int | None = None,
) -> DataFrame:
    """Inner join where ``right_ts`` lies in ``[left_ts + lower, left_ts + upper]``, bounds included.

    Column names of the two sides must differ. Keys found to be hot are also
    split into time buckets, so that a hot key meets its neighbours in time
    and not its whole history. On streams the range itself bounds the state.
    """
    in_range = (F.col(right_ts) >= F.col(left_ts) + F.lit(lower)) & (F.col(right_ts) <= F.col(left_ts) + F.lit(upper))
    same_key = reduce(lambda a, b: a & b, [left[l] == right[r] for l, r in on])
    if left.isStreaming or right.isStreaming:
        return left.join(right, same_key & in_range)

    keys = [F.col(r) for _, r in on]
    both = right.select(*keys).unionByName(left.select(*[F.col(l).alias(r) for l, r in on]))
    hot = hot_keys(both, keys, max_rows)
    if hot is None:
        return left.join(right, same_key & in_range)

    width = max(2 * (micros(upper) - micros(lower)), 1)

    def bucketed(df: DataFrame, names: list[str], bucket: Column, suffix: str) -> DataFrame:
        marked = reduce(lambda a, b: a & b, [df[n] == hot[f"hot_{i}"] for i, n in enumerate(names)])
        joined = df.join(F.broadcast(hot), marked, "left")
        return joined.select(*[df[c] for c in df.columns], bucket.alias(f"_bucket_{suffix}"))

    def cell(ts: Column) -> Column:
        return F.floor(ts / width)

    start, end = epoch_micros(F.col(left_ts)) + micros(lower), epoch_micros(F.col(left_ts)) + micros(upper)
    is_hot = F.col("hot_n").isNotNull()
    cells = F.explode(F.when(is_hot, F.sequence(cell(start), cell(end))).otherwise(F.array(F.lit(0).cast("bigint"))))
    own = F.when(is_hot, cell(epoch_micros(F.col(right_ts)))).otherwise(F.lit(0).cast("bigint"))
    l = bucketed(left.filter(F.col(left_ts).isNotNull()), [a for a, _ in on], cells, "l")
    r = bucketed(right, [b for _, b in on], own, "r")
    matched = reduce(lambda a, b: a & b, [l[a] == r[b] for a, b in on])
    return l.join(r, matched & (l["_bucket_l"] == r["_bucket_r"]) & in_range).drop("_bucket_l", "_bucket_r")


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    how: str = "left",
    unique: bool = True,
    max_rows: int | None = None,
    max_broadcast: int | None = None,
    measured: tuple[bool, bool] | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Enrich facts with the dimension row of their key; the dimension key is dropped.

    A dimension within the row bound is broadcast. Beyond it both sides are
    shuffled, with a hot fact key spread over as many copies of its row as it
    holds times the limit. ``measured`` is the dimension's entry of
    ``measure_dimensions``, if known; hot keys are counted on ``counted``, a
    cheap source of the same keys, rather than on the facts.
    """
    small, distinct = measured or measure_dimensions([(dim, dim_key)], max_broadcast)[0]
    if unique and not distinct:
        raise ValueError(f"duplicate {dim_key} in dimension")
    if small:
        return fact.join(F.broadcast(dim), fact[fact_key] == dim[dim_key], how).drop(dim[dim_key])
    hot = None if fact.isStreaming else hot_keys(fact if counted is None else counted, [F.col(fact_key)], max_rows)
    if hot is None:
        return fact.join(dim, fact[fact_key] == dim[dim_key], how).drop(dim[dim_key])
    is_hot = F.col("hot_n").isNotNull()
    pieces = F.greatest(F.ceil(F.col("hot_n") / hot_rows(fact, max_rows)), F.lit(2)).cast("int")
    salt = spread(fact, DRAWS)
    salted = fact.withColumn("_draw", salt).join(F.broadcast(hot), fact[fact_key].eqNullSafe(hot["hot_0"]), "left").select(
        *fact.columns, F.when(is_hot, F.pmod("_draw", pieces)).otherwise(0).alias("_salt")
    )
    copies = F.when(is_hot, F.sequence(F.lit(0), pieces - 1)).otherwise(F.array(F.lit(0)))
    copied = dim.join(F.broadcast(hot), dim[dim_key] == hot["hot_0"], "left").select(
        *dim.columns, F.explode(copies).alias("_copy")
    )
    matched = (salted[fact_key] == copied[dim_key]) & (salted["_salt"] == copied["_copy"])
    return salted.join(copied, matched, how).drop(copied[dim_key]).drop("_salt", "_copy")


def user_dimension(users: DataFrame, asof: Column | date) -> DataFrame:
    """``pk, birthday, gender`` -> ``user_age, user_gender``."""
    return users.select("pk", age_on(F.col("birthday"), asof).alias("user_age"), F.col("gender").alias("user_gender"))


def province_dimension(provinces: DataFrame) -> DataFrame:
    """``pk, name, area_code, iso_code, iso_3166_2`` -> the four province columns."""
    return provinces.select(
        "pk",
        F.col("name").alias("province_name"),
        F.col("area_code").alias("province_area_code"),
        F.col("iso_code").alias("province_iso_code"),
        F.col("iso_3166_2").alias("province_3166_2_code"),
    )


def sku_dimension(skus: DataFrame) -> DataFrame:
    """``pk, sku_name, category3_id, spu_id, tm_id``: the name and the keys of the chained lookups."""
    chained = [F.col(c).try_cast("bigint").alias(c) for c in ("category3_id", "spu_id", "tm_id")]
    return skus.select("pk", F.col("sku_name").alias("_dim_name"), *chained)


def name_dimension(dim: DataFrame, name: str, output: str) -> DataFrame:
    """One named dimension (spu, trademark, category): ``pk, name`` -> ``output``."""
    return dim.select("pk", F.col(name).alias(output))


def enrich_order_wide(
    wide: DataFrame,
    users: DataFrame,
    provinces: DataFrame,
    skus: DataFrame,
    spus: DataFrame,
    trademarks: DataFrame,
    categories: DataFrame,
    asof: Column | date,
    how: str = "left",
) -> DataFrame:
    """The six lookups; spu, trademark and category use keys that the sku lookup supplies.

    ``sku_name`` is overwritten by the sku dimension's. Where a dimension is
    too large to broadcast, the rows are written once before the lookups and
    once after the sku lookup, and hot keys are counted on these copies: the
    input is computed once, however many dimensions are large.
    """
    dims = [
        ("user_id", user_dimension(users, asof)),
        ("province_id", province_dimension(provinces)),
        ("sku_id", sku_dimension(skus)),
        ("spu_id", name_dimension(spus, "spu_name", "spu_name")),
        ("tm_id", name_dimension(trademarks, "tm_name", "tm_name")),
        ("category3_id", name_dimension(categories, "name", "category3_name")),
    ]
    keyed = [(key, dim.withColumn("pk", F.col("pk").try_cast("bigint"))) for key, dim in dims]
    measures = measure_dimensions([(dim, "pk") for _, dim in keyed])
    for part in (slice(0, 3), slice(3, 6)):
        if not all(small for small, _ in measures[part]) and not wide.isStreaming:
            ensure_checkpoint_dir(wide.sparkSession)
            wide = wide.checkpoint()
        counted = wide
        for (key, dim), measured in zip(keyed[part], measures[part]):
            wide = lookup(wide, dim, key, "pk", how, measured=measured, counted=counted)
    return wide.withColumn("sku_name", F.coalesce("_dim_name", "sku_name")).drop("_dim_name")


def split_rows(df: DataFrame, text: str, pattern: str) -> DataFrame:
    """Lateral split: one ``(word, length)`` row per part; rows without parts vanish."""
    words = df.withColumn("word", F.explode(java_split(F.col(text), pattern)))
    return words.withColumn("length", F.length("word"))


def key_list_lookup(index: DataFrame, field: str, table: DataFrame, table_key: str) -> DataFrame:
    """Distinct keys of a comma list over all index rows, each with its table row or NULLs."""
    keys = index.select(F.explode(java_split(F.col(field), ",")).alias("lookup_key")).distinct()
    return lookup(keys, table.withColumn(table_key, F.col(table_key).cast("string")), "lookup_key", table_key, "left")


def merge_rows(sides: list[DataFrame], keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key with the first non-null value per column, sides in the given order.

    An aggregate over the union: a key repeated on a side adds rows, never pairs.
    """
    order = order or []
    tagged = [side.withColumn("_side", F.lit(i)) for i, side in enumerate(sides)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    rank = F.struct("_side", *order)
    values = [c for c in rows.columns if c not in keys and c != "_side"]
    return rows.groupBy(*keys).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c) for c in values])
