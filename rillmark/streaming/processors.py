"""Keyed state processors for ``transformWithStateInPandas`` in arrival order.

A call to Python and to the state store costs far more than the work on a row,
so keys are dealt over ``BUCKETS`` buckets by their hash, and a call handles the
rows of all keys of a bucket at once. A bucket's state is a table with the keys
in its first columns (:class:`Table`). It is read and written once in a batch
that has rows or a timer of the bucket, and a bucket has one timer, the
earliest its rows need.

Spark hands rows to a processor one Python tuple each, so rows go to it packed,
a map task's rows of a bucket as one Arrow blob (:func:`packed`). Where event
time counts they cannot: Spark drops late rows one by one before the processor.

State per key is one value (seen flag, day, last reading). The bounce detector
alone keeps a key's undecided rows, those of its waiting time, and sorts them
in each batch. The RocksDB state store is needed.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from rillmark.functions.times import as_interval, epoch_micros, micros
from rillmark.session import PROVIDER_CONF, ROCKSDB_PROVIDER

#: Part of a checkpoint: a job must keep it.
BUCKETS = 256
#: A map task packs its rows whenever it holds this much.
PACK_BYTES = 16 << 20
WHOLE = ("tinyint", "smallint", "int", "bigint")


def in_order(rows: Iterator[pd.DataFrame], order: list[str] | None) -> Iterator[pd.DataFrame]:
    """A bucket's rows of one micro-batch as they arrive, or put in order, which holds them."""
    if order is None:
        yield from rows
    else:
        yield pd.concat(list(rows), ignore_index=True).sort_values(order, kind="stable", na_position="first", ignore_index=True)


def kinds(df: DataFrame, columns: list[str]) -> dict[str, str]:
    return {c: df.schema[c].dataType.simpleString() for c in columns}


def fields(ddl: str) -> dict[str, str]:
    """Names and types of a DDL column list of atomic types."""
    return {name: kind for name, kind in (part.split() for part in ddl.split(","))}


def series(values: list, kind: str) -> pd.Series:
    """Typed values, with None for NULL."""
    if kind in WHOLE:
        return pd.Series(values, dtype="Int64" if None in values else "int64")
    if kind in ("double", "float"):
        return pd.Series(values, dtype="float64")
    if kind == "boolean" and None not in values:
        return pd.Series(values, dtype="bool")
    return pd.Series(values, dtype="object")


def plain(values: pd.Series) -> list:
    """Python values, None for NULL."""
    known = values.notna()
    return values.tolist() if known.all() else values.astype(object).where(known, None).tolist()


def exact(values: pd.Series, kind: str) -> list:
    """Values of the kind's own Python type: the state store reads 96.0 as no whole number, and a column with NULLs may hold it so."""
    if kind in WHOLE or kind in ("double", "float"):
        of = int if kind in WHOLE else float
        return [None if v is None else of(v) for v in plain(values)]
    return plain(values)


def stacked(parts: list[pd.DataFrame]) -> pd.DataFrame:
    """Frames one below the other; empty ones do not decide the types."""
    some = [part for part in parts if len(part)]
    return pd.concat(some, ignore_index=True) if some else parts[0]


def numbered(keys: pd.DataFrame) -> np.ndarray:
    """A number for each row's key, in the order of their first rows; NULL is a key."""
    if keys.shape[1] == 1:
        return pd.factorize(keys.iloc[:, 0], use_na_sentinel=False)[0]
    codes = [pd.factorize(keys[c], use_na_sentinel=False)[0] for c in keys]
    whole = codes[0].astype("int64")
    for code in codes[1:]:
        whole = pd.factorize(whole * (int(code.max(initial=0)) + 1) + code)[0]
    return whole


def firsts(group: np.ndarray) -> np.ndarray:
    """Whether a row is the first of its group; a group's rows are together."""
    return np.r_[True, group[1:] != group[:-1]] if len(group) else np.zeros(0, bool)


class Table:
    """A bucket's state rows: one value of the state store, with an array for each column. No rows, no value."""

    def __init__(self, handle: StatefulProcessorHandle, name: str, columns: dict[str, str], ttl_ms: int | None = None):
        self.columns = columns
        self.state = handle.getValueState(name, ", ".join(f"`{c}` array<{kind}>" for c, kind in columns.items()), ttl_ms)

    def read(self) -> pd.DataFrame:
        held = self.state.get() or [[] for _ in self.columns]
        return pd.DataFrame({c: series(list(values), kind) for (c, kind), values in zip(self.columns.items(), held, strict=True)})

    def write(self, rows: pd.DataFrame) -> None:
        if len(rows):
            self.state.update(tuple(exact(rows[c], kind) for c, kind in self.columns.items()))
        else:
            self.state.clear()


def with_groups(held: pd.DataFrame, rows: pd.DataFrame, keys: list[str]) -> tuple[pd.DataFrame, np.ndarray]:
    """The keys of the state's rows, then those first met in ``rows``; and the position there of each row's key."""
    both = stacked([held[keys], rows[keys]])
    group = numbered(both)
    known = both.loc[firsts_of(group)].reset_index(drop=True)
    return known, group[len(held) :]


def firsts_of(group: np.ndarray) -> np.ndarray:
    """Positions of the first row of each group, groups being numbered as they come."""
    return np.unique(group, return_index=True)[1]


def set_timer(handle: StatefulProcessorHandle, due_ms: int | None) -> None:
    """The bucket's one timer."""
    for timer in list(handle.listTimers()):
        handle.deleteTimer(timer)
    if due_ms is not None:
        handle.registerTimer(int(due_ms))


class NewVisitorRepair(StatefulProcessor):
    """The first claim of a key keeps ``'1'``; later claims turn to ``'0'``. No expiry."""

    def __init__(self, keys: dict[str, str], flag: str):
        self.keys, self.flag = keys, flag

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = Table(handle, "seen", self.keys)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seen = self.seen.read()
        for batch in rows:
            claims = (batch[self.flag] == "1").to_numpy(bool)
            names, group = with_groups(seen, batch, list(self.keys))
            made = batch[self.flag].copy()
            at = np.flatnonzero(claims)
            later = (group[at] < len(seen)) | pd.Series(group[at]).duplicated().to_numpy()
            if not later.all():
                seen = names.iloc[np.r_[np.arange(len(seen)), np.sort(group[at[~later]])]].reset_index(drop=True)
                self.seen.write(seen)
            made.iloc[at[later]] = "0"
            yield batch.assign(**{self.flag: made})

    def close(self) -> None:
        pass


class DailyFirstVisit(StatefulProcessor):
    """A row passes when its day differs from the key's stored day; a key's state may expire."""

    def __init__(self, keys: dict[str, str], day: str, ttl: timedelta | None, order: list[str] | None = None):
        self.keys, self.day, self.order = keys, day, order
        self.ttl = None if ttl is None else micros(ttl) // 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = Table(handle, "last", {**self.keys, "last_day": "string", "stored_ms": "bigint"}, self.ttl)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, now = self.last.read(), 0
        if self.ttl is not None:
            now = timerValues.getCurrentProcessingTimeInMs()
            held = held[held["stored_ms"] + self.ttl > now].reset_index(drop=True)
        for batch in in_order(rows, self.order):
            names, group = with_groups(held, batch, list(self.keys))
            known = len(held)
            last = np.array([*held["last_day"], *[None] * (len(names) - known)], dtype=object)
            stored = np.r_[held["stored_ms"].to_numpy("int64"), np.full(len(names) - known, now)]
            by_key = np.argsort(group, kind="stable")
            day, at = batch[self.day].to_numpy(object)[by_key], group[by_key]
            before = np.r_[np.array([None], object), day[:-1]]
            start = firsts(at)
            before[start] = last[at[start]]
            passes = (pd.Series(day, dtype=object) != pd.Series(before, dtype=object)).to_numpy(bool)
            if passes.any():
                last[at[passes]] = day[passes]  # of several the last one stays
                stored[at[passes]] = now
                stays = np.ones(len(names), bool)
                stays[known:] = np.isin(np.arange(known, len(names)), at[passes])
                held = names.assign(last_day=last, stored_ms=stored)[stays].reset_index(drop=True)
                self.last.write(held)
                yield batch.iloc[np.sort(by_key[passes])]

    def close(self) -> None:
        pass


class DeltaAlert(StatefulProcessor):
    """``(key, last, current)`` whenever two readings in a row differ by the threshold or more."""

    def __init__(self, keys: dict[str, str], value: str, threshold: float, baseline: str = "previous", order: list[str] | None = None):
        self.keys, self.value, self.threshold, self.baseline, self.order = keys, value, threshold, baseline, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = Table(handle, "last", {**self.keys, "last_value": "double"})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.last.read()
        for batch in in_order(rows, self.order):
            names, group = with_groups(held, batch, list(self.keys))
            new = np.arange(len(names)) >= len(held)
            last = np.r_[held["last_value"].to_numpy("float64"), np.full(int(new.sum()), np.nan)]
            by_key = np.argsort(group, kind="stable")
            at, current = group[by_key], batch[self.value].to_numpy("float64", na_value=np.nan)[by_key]
            start = firsts(at)
            if self.baseline == "first":
                fresh = start & new[at]
                last[at[fresh]] = current[fresh]
                base = np.where(fresh, np.nan, last[at])
            else:
                base = np.r_[np.nan, current[:-1]]
                base[start] = last[at[start]]
                last[at] = current
            held = names.assign(last_value=last)
            self.last.write(held)
            hit = np.abs(current - base) >= self.threshold
            if hit.any():
                yield names.iloc[at[hit]].reset_index(drop=True).assign(last=base[hit], current=current[hit])

    def close(self) -> None:
        pass


class BounceDetector(StatefulProcessor):
    """Entries not followed by a non-entry within ``within``, decided by event-time timers.

    Rows wait in the state until the watermark reaches them. A timer fires
    for the earliest undecided row; rows settled by then leave the state.
    """

    def __init__(self, key: str, kind: str, at: str, tie: str, entry: str, value: str, within: timedelta, tie_type: str = "bigint"):
        self.names = [key, at, tie, entry, value]
        self.kind, self.wait, self.tie_type = kind, micros(within) // 1000, tie_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = Table(handle, "waiting", {"key": self.kind, "at": "bigint", "tie": self.tie_type, "entry": "boolean", "value": "string"})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)[self.names].set_axis(list(self.waiting.columns), axis=1)
        batch = batch[batch["tie"].notna()]
        if len(batch):
            yield from self._settle(batch.astype({"at": "int64"}), timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._settle(None, timerValues.getCurrentWatermarkInMs())

    def _settle(self, fresh: pd.DataFrame | None, watermark_ms: int) -> Iterator[pd.DataFrame]:
        mark, wait = watermark_ms * 1000, self.wait * 1000
        rows = self.waiting.read()
        if fresh is not None:
            rows = stacked([rows, fresh])
        group = numbered(rows[["key"]])
        rows = rows.assign(group=group).sort_values(["group", "at", "tie"], kind="stable", ignore_index=True)
        at, entry, group = rows["at"].to_numpy("int64"), rows["entry"].to_numpy(bool), rows["group"].to_numpy()
        follows = np.r_[group[1:] == group[:-1], False] if len(rows) else np.zeros(0, bool)
        next_at, next_entry = np.r_[at[1:], 0][: len(rows)], np.r_[entry[1:], False][: len(rows)]
        final_next = follows & (next_at <= mark)
        kept = (at > mark) | (entry & ~final_next & (mark < at + wait))
        found = ~kept & entry & (~follows | (next_at - at >= wait) | next_entry)
        self.waiting.write(rows[kept])
        set_timer(self.handle, max((int(at[kept].min()) + wait) // 1000 + 1, watermark_ms + 1) if kept.any() else None)
        if found.any():
            yield rows.loc[found, ["key", "tie", "value"]]

    def close(self) -> None:
        pass


def packed(df: DataFrame, bucket: str) -> DataFrame:
    """``bucket, packed``: rows of a bucket as Arrow streams, some of them in each; ``bucket`` is not in them."""

    def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        of = table[bucket].to_numpy()
        by_bucket = np.argsort(of, kind="stable")
        table, of = table.drop_columns([bucket]).take(by_bucket).combine_chunks(), of[by_bucket]
        starts = np.flatnonzero(firsts(of))
        blobs = []
        for a, b in zip(starts, [*starts[1:], len(of)], strict=True):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table.slice(a, b - a))
            blobs.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_pydict({bucket: pa.array(of[starts], pa.int32()), "packed": pa.array(blobs, pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            held += [batch] if batch.num_rows else []
            if sum(b.nbytes for b in held) >= PACK_BYTES:
                yield pack(held)
                held = []
        if held:
            yield pack(held)

    return df.mapInArrow(run, f"`{bucket}` int, packed binary")


class Unpacked(StatefulProcessor):
    """A processor whose rows come packed; they look as Spark gives them, times in the session's zone."""

    def __init__(self, processor: StatefulProcessor, zone: str):
        self.processor, self.zone = processor, zone

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.processor.init(handle)

    def _rows(self, blobs: pd.Series) -> pd.DataFrame:
        rows = pa.concat_tables([pa.ipc.open_stream(blob).read_all() for blob in blobs]).to_pandas(date_as_object=True)
        zoned = [c for c in rows if isinstance(rows[c].dtype, pd.DatetimeTZDtype)]
        return rows.assign(**{c: rows[c].dt.tz_convert(self.zone).dt.tz_localize(None) for c in zoned})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        yield from self.processor.handleInputRows(key, (self._rows(part["packed"]) for part in rows), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self.processor.handleExpiredTimer(key, timerValues, expiredTimerInfo)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.processor.handleInitialState(key, initialState, timerValues)

    def close(self) -> None:
        self.processor.close()


def run_processor(
    df: DataFrame, key: str | list[str], processor: StatefulProcessor, schema: StructType | str, time_mode: str = "none", initial: DataFrame | None = None
) -> DataFrame:
    """Attach a processor to a stream in append mode; a call gets the rows of all keys of a bucket.

    ``initial`` is a table whose rows the processor gets as each bucket's state
    before the first batch.
    """
    if df.sparkSession.conf.get(PROVIDER_CONF) != ROCKSDB_PROVIDER:
        raise ValueError(f"set {PROVIDER_CONF} to {ROCKSDB_PROVIDER}, as build_session does")
    keys = [key] if isinstance(key, str) else key
    name = "key_bucket"
    while name in df.columns:
        name += "_"
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    start = None if initial is None else initial.withColumn(name, bucket).groupBy(name)
    rows = df.withColumn(name, bucket)
    # Values within others would not look as Spark gives them.
    if time_mode != "EventTime" and not any(isinstance(f.dataType, ArrayType | MapType | StructType | VariantType) for f in df.schema):
        rows, processor = packed(rows, name), Unpacked(processor, df.sparkSession.conf.get("spark.sql.session.timeZone"))
    return rows.groupBy(name).transformWithStateInPandas(processor, schema, outputMode="append", timeMode=time_mode, initialState=start)


def repair_stream(df: DataFrame, key: str, flag: str) -> DataFrame:
    return run_processor(df, key, NewVisitorRepair(kinds(df, [key]), flag), df.schema)


def daily_visit_stream(df: DataFrame, key: str, day: str, ttl: timedelta | None = timedelta(days=1), order: list[str] | None = None) -> DataFrame:
    """``day`` is a date text column; a key's state lives ``ttl`` of processing time. A key's rows of a batch come in ``order``, if given.

    With an expiry the query never runs out of work, so ``availableNow``
    does not end: use a processing-time trigger, or ``ttl=None`` to replay.
    """
    made = DailyFirstVisit(kinds(df, [key]), day, ttl, order)
    return run_processor(df, key, made, df.schema, "none" if ttl is None else "ProcessingTime")


def delta_stream(df: DataFrame, key: str, value: str, threshold: float, baseline: str = "previous", order: list[str] | None = None) -> DataFrame:
    schema = f"{key} {df.schema[key].dataType.simpleString()}, last double, current double"
    return run_processor(df, key, DeltaAlert(kinds(df, [key]), value, threshold, baseline, order), schema)


def bounce_stream(
    df: DataFrame, key: str, ts: str, tie: str, entry: str, value: str, within: timedelta, delay: timedelta
) -> DataFrame:
    """``key, tie, value`` of every bounce: ``tie`` a unique BIGINT or STRING, ``entry`` a BOOLEAN, ``value`` the record's text.

    Rows without a ``tie`` only move the watermark.
    """
    known = F.coalesce(F.col(entry), F.lit(False)).alias(entry)
    at = epoch_micros(F.col(ts)).alias("at_us")
    timed = df.select(key, ts, at, tie, known, value).withWatermark(ts, as_interval(delay))
    of_key, of_tie = (df.schema[c].dataType.simpleString() for c in (key, tie))
    made = BounceDetector(key, of_key, "at_us", tie, entry, value, within, of_tie)
    return run_processor(timed, key, made, f"key {of_key}, tie {of_tie}, value string", "EventTime")
