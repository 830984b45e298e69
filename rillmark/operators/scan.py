"""Ordered per-key scans that stay balanced when one key dominates.

Keyed state over an ordered history (running sums, previous or next row) is
a window function per key. A window puts all rows of a key in one task, so
for keys found to be hot the history is cut at sampled quantiles of the
order columns. Every segment is scanned on its own, and what crosses a cut
is carried by one small row per segment.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from rillmark.operators.skew import hot_keys, hot_rows, null_safe
from rillmark.session import ensure_checkpoint_dir

MAX_SEGMENTS = 4096
SAMPLES_PER_SEGMENT = 16
CUTS_PER_BLOCK = 64
SEG = "_segment"


@dataclass(frozen=True)
class Scan:
    """One output of a scan.

    ``local`` is the value inside a segment, ``total`` what a segment hands
    over (a mergeable aggregate), ``carry`` turns the totals of the other
    segments into the carried value, ``merge`` combines
    ``(carry, local, is_first, is_last)``, ``done`` shapes the final value.
    """

    local: Callable[[WindowSpec], Column]
    total: Callable[[list[str]], Column]
    carry: Callable[[Column, WindowSpec], Column]
    merge: Callable[[Column, Column, Column, Column], Column]
    done: Callable[[Column], Column] = lambda value: value


def _up_to_here(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _before(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def running_sum(value: Column) -> Scan:
    return Scan(
        local=lambda w: F.sum(value).over(_up_to_here(w)),
        total=lambda order: F.sum(value),
        carry=lambda total, w: F.sum(total).over(_before(w)),
        merge=lambda carry, local, first, last: F.coalesce(carry + local, local, carry),
    )


def running_count(condition: Column | None = None) -> Scan:
    one = F.lit(1) if condition is None else F.when(condition, 1).otherwise(0)
    return running_sum(one.cast("bigint"))


def running_max(value: Column) -> Scan:
    return Scan(
        local=lambda w: F.max(value).over(_up_to_here(w)),
        total=lambda order: F.max(value),
        carry=lambda total, w: F.max(total).over(_before(w)),
        merge=lambda carry, local, first, last: F.greatest(carry, local),
    )


def max_before(value: Column) -> Scan:
    """Largest value of the rows before, NULL on a key's first row."""
    return Scan(
        local=lambda w: F.max(value).over(_before(w)),
        total=lambda order: F.max(value),
        carry=lambda total, w: F.max(total).over(_before(w)),
        merge=lambda carry, local, first, last: F.greatest(carry, local),
    )


def running_max_row(row: Column, by: Column, order: list[str]) -> Scan:
    """The row holding the largest numeric ``by`` so far; the earliest of equals stays."""
    ranked = F.struct((-by).alias("rank"), *[F.col(c) for c in order], row.alias("row"))
    valued = F.when(by.isNotNull(), ranked)
    return Scan(
        local=lambda w: F.min(valued).over(_up_to_here(w)),
        total=lambda _: F.min(valued),
        carry=lambda total, w: F.min(total).over(_before(w)),
        merge=lambda carry, local, first, last: F.least(carry, local),
        done=lambda best: best["row"],
    )


def previous(value: Column) -> Scan:
    """Value of the preceding row of the key, NULL on its first row."""
    return Scan(
        local=lambda w: F.lag(value).over(w),
        total=lambda order: F.max_by(F.struct(value.alias("v")), F.struct(*order)),
        carry=lambda total, w: F.lag(total).over(w),
        merge=lambda carry, local, first, last: F.when(first, carry["v"]).otherwise(local),
    )


def following(value: Column) -> Scan:
    """Value of the next row of the key, NULL on its last row."""
    return Scan(
        local=lambda w: F.lead(value).over(w),
        total=lambda order: F.min_by(F.struct(value.alias("v")), F.struct(*order)),
        carry=lambda total, w: F.lead(total).over(w),
        merge=lambda carry, local, first, last: F.when(last, carry["v"]).otherwise(local),
    )


def first_of_key(value: Column) -> Scan:
    """Value of the key's very first row."""
    return Scan(
        local=lambda w: F.first(value).over(_up_to_here(w)),
        total=lambda order: F.min_by(F.struct(value.alias("v")), F.struct(*order)),
        carry=lambda total, w: F.first(total).over(_before(w)),
        merge=lambda carry, local, first, last: F.when(carry.isNull(), local).otherwise(carry["v"]),
    )


@dataclass(frozen=True)
class Layout:
    """Where the histories of hot keys are cut, for several scans of rows with the same keys and order."""

    cuts: DataFrame | None


def layout_of(df: DataFrame, keys: list[str], order: list[str], max_rows: int | None = None) -> Layout:
    return Layout(_cut_points(df, keys, order, max_rows))


def scan(
    df: DataFrame, keys: list[str], order: list[str], max_rows: int | None = None, layout: Layout | None = None, **outputs: Scan
) -> DataFrame:
    """Add one column per output, scanning each key in ``order`` (unique within a key)."""
    cuts = (layout or layout_of(df, keys, order, max_rows)).cuts
    if cuts is None:
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({name: s.done(s.local(window)) for name, s in outputs.items()})

    at = F.struct(*order)
    rows = df.join(
        F.broadcast(cuts), null_safe([df[k] for k in keys], [cuts[f"hot_{i}"] for i in range(len(keys))]), "left"
    ).withColumn(SEG, _segment_of(at)).select(*df.columns, SEG, F.col("hot_n").isNotNull().alias("_hot"))

    totals = (
        rows.filter("_hot")
        .groupBy(*[F.col(k).alias(f"carry_{i}") for i, k in enumerate(keys)], F.col(SEG).alias("carry_seg"))
        .agg(*[s.total(order).alias(f"_t_{name}") for name, s in outputs.items()])
    )
    across = Window.partitionBy(*[f"carry_{i}" for i in range(len(keys))]).orderBy("carry_seg")
    carries = totals.withColumns({f"_c_{n}": s.carry(F.col(f"_t_{n}"), across) for n, s in outputs.items()}).drop(
        *[f"_t_{n}" for n in outputs]
    )

    inside = Window.partitionBy(*keys, SEG).orderBy(*order)
    local = rows.withColumns(
        {
            **{f"_l_{n}": s.local(inside) for n, s in outputs.items()},
            "_first": F.row_number().over(inside) == 1,
            "_last": F.lead(F.lit(1)).over(inside).isNull(),
        }
    )
    joined = local.join(
        F.broadcast(carries),
        null_safe([local[k] for k in keys], [carries[f"carry_{i}"] for i in range(len(keys))])
        & (local[SEG] == carries["carry_seg"]),
        "left",
    )
    merged = [
        s.done(s.merge(F.col(f"_c_{n}"), F.col(f"_l_{n}"), F.col("_first"), F.col("_last"))).alias(n)
        for n, s in outputs.items()
    ]
    return joined.select(*[local[c] for c in df.columns], *merged)


def _cut_points(df: DataFrame, keys: list[str], order: list[str], max_rows: int | None) -> DataFrame | None:
    """Per hot key, ascending cut points of the order columns in blocks, with the block heads.

    Frozen by a checkpoint because sampling must give every reader the same
    cuts. Holds at most ``MAX_SEGMENTS`` cuts per hot key.
    """
    limit = hot_rows(df, max_rows)
    hot = hot_keys(df, [F.col(k) for k in keys], limit)
    if hot is None:
        return None
    pieces = F.least(F.lit(MAX_SEGMENTS), F.ceil(F.col("hot_n") / limit).cast("int"))
    sized = hot.withColumn("pieces", pieces)
    hot_cols = [f"hot_{i}" for i in range(len(keys))]
    slim = df.select(*{k: None for k in [*keys, *order]})
    sampled = (
        slim.join(F.broadcast(sized), null_safe([slim[k] for k in keys], [sized[c] for c in hot_cols]))
        .filter(F.rand(17) < F.lit(SAMPLES_PER_SEGMENT) * F.col("pieces") / F.col("hot_n"))
        .groupBy(*hot_cols, "hot_n", "pieces")
        .agg(F.sort_array(F.collect_list(F.struct(*order))).alias("sample"))
    )
    ranks = F.expr("transform(sequence(1, pieces), i -> cast(i * size(sample) div (pieces + 1) as int) + 1)")
    cuts = F.array_distinct(F.transform(ranks, lambda r: F.element_at("sample", r)))
    starts = F.expr(f"sequence(0, cast((size(cuts) - 1) div {CUTS_PER_BLOCK} as int))")
    blocked = (
        sampled.withColumn("cuts", cuts)
        .withColumn("blocks", F.transform(starts, lambda b: F.slice("cuts", b * CUTS_PER_BLOCK + 1, CUTS_PER_BLOCK)))
        .withColumn("heads", F.transform("blocks", lambda b: b[0]))
    )
    ensure_checkpoint_dir(df.sparkSession)
    frozen = blocked.select(*hot_cols, "hot_n", "blocks", "heads").checkpoint()
    return None if frozen.isEmpty() else frozen


def _segment_of(at: Column) -> Column:
    """Number of cut points at or before a row: the block by its head, then inside the block."""
    block = F.size(F.filter("heads", lambda h: h <= at))
    inside = F.size(F.filter(F.element_at("blocks", F.greatest(block, F.lit(1))), lambda c: c <= at))
    position = F.when(block == 0, 0).otherwise((block - 1) * CUTS_PER_BLOCK + inside)
    return F.when(F.col("hot_n").isNull(), 0).otherwise(position)
