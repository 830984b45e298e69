"""Running aggregates, windows and sessions on keyed state with user accumulators.

An :class:`Accumulator` is what a user writes: ``zero``, ``add`` over a frame
of rows, ``merge`` of two accumulators and a ``result``. The processors here
keep accumulators in the state store of ``transformWithStateInPandas``, one
for each key, window or session, and decide when a result leaves.

A processor handles the keys of a bucket at once (see ``processors``) and has
an accumulator's ``*_groups`` methods do so for many accumulators. By default
these call the user's methods for one after the other; the accumulators here
have them in numpy.

A key's rows of one micro-batch are put in the given order before they are
added (arrival order inside a batch is open), so a batch holds a bucket's rows
of that batch in memory; the source's limits for a trigger bound them.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rillmark.functions.times import as_interval, epoch_micros, micros
from rillmark.streaming.processors import Table, fields, firsts, firsts_of, in_order, kinds, numbered, plain, run_processor, series, set_timer, stacked, with_groups

#: How far behind the newest row a row may be and still reach the processor, to be accepted or sent to the too-late output.
HORIZON = timedelta(days=7300)


def _typed(rows: list[tuple], ddl: str) -> pd.DataFrame:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields(ddl))
    return pd.DataFrame({c: series([None if pd.isna(v) else v for v in values], kind) for (c, kind), values in zip(fields(ddl).items(), columns, strict=True)})


def _tuples(frame: pd.DataFrame) -> list[tuple]:
    return list(zip(*(plain(frame[c]) for c in frame), strict=True))


def _runs(group: np.ndarray) -> list[tuple[int, int, int]]:
    """``(group, from, to)`` of rows whose groups are together."""
    starts = np.flatnonzero(firsts(group))
    return list(zip(group[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(group)], strict=True))


def _sums(values: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    """Sum of each of ``n`` groups; a group's rows are together."""
    made, starts = np.zeros(n, values.dtype), np.flatnonzero(firsts(group))
    if len(starts):
        made[group[starts]] = np.add.reduceat(values, starts)
    return made


def _places(group: np.ndarray) -> np.ndarray:
    """The position of each row in its group, whose rows are together."""
    first = firsts(group)
    return np.arange(len(group)) - np.flatnonzero(first)[np.cumsum(first) - 1] if len(group) else np.zeros(0, np.int64)


def _totals(values: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Running sum within each group."""
    run = np.cumsum(values)
    return run - (run - values)[np.arange(len(group)) - _places(group)]


class Accumulator:
    """What a user aggregate is made of; ``state`` and ``output`` are DDL column lists."""

    state: str
    output: str

    def zero(self) -> tuple:
        raise NotImplementedError

    def add(self, held: tuple, rows: pd.DataFrame) -> tuple:
        raise NotImplementedError

    def merge(self, a: tuple, b: tuple) -> tuple:
        raise NotImplementedError

    def result(self, held: tuple) -> tuple:
        return held

    def scan(self, held: tuple, rows: pd.DataFrame) -> tuple[list[tuple], tuple]:
        """The result after each row, and the accumulator after the last."""
        out = []
        for i in range(len(rows)):
            held = self.add(held, rows.iloc[i : i + 1])
            out.append(self.result(held))
        return out, held

    def zeros(self, n: int) -> pd.DataFrame:
        """``n`` new accumulators."""
        return pd.DataFrame({c: series([v] * n, kind) for (c, kind), v in zip(fields(self.state).items(), self.zero(), strict=True)})

    def add_groups(self, held: pd.DataFrame, rows: pd.DataFrame, group: np.ndarray) -> pd.DataFrame:
        """Accumulators after their rows; ``group`` names each row's accumulator, whose rows are together and in order."""
        made = _tuples(held)
        for g, a, b in _runs(group):
            made[g] = self.add(made[g], rows.iloc[a:b])
        return _typed(made, self.state)

    def scan_groups(self, held: pd.DataFrame, rows: pd.DataFrame, group: np.ndarray) -> tuple[pd.DataFrame, pd.DataFrame]:
        """The result after each row, and the accumulators after their last."""
        made, out = _tuples(held), []
        for g, a, b in _runs(group):
            results, made[g] = self.scan(made[g], rows.iloc[a:b])
            out += results
        return _typed(out, self.output), _typed(made, self.state)

    def merge_groups(self, held: pd.DataFrame, group: np.ndarray) -> pd.DataFrame:
        """One accumulator of each group's, which are together and in order; groups are numbered from 0."""
        parts, made = _tuples(held), []
        for _, a, b in _runs(group):
            whole = parts[a]
            for part in parts[a + 1 : b]:
                whole = self.merge(whole, part)
            made.append(whole)
        return _typed(made, self.state)

    def results(self, held: pd.DataFrame) -> pd.DataFrame:
        return _typed([self.result(h) for h in _tuples(held)], self.output)


def _whole(rows: pd.DataFrame, column: str) -> np.ndarray:
    return rows[column].fillna(0).to_numpy("int64")


class CountSum(Accumulator):
    """Number of rows and sum of a whole-number column; NULLs count as rows and add nothing."""

    state = output = "n bigint, total bigint"

    def __init__(self, value: str):
        self.value = value

    def zero(self) -> tuple:
        return (0, 0)

    def add(self, held: tuple, rows: pd.DataFrame) -> tuple:
        return (held[0] + len(rows), held[1] + int(rows[self.value].fillna(0).sum()))

    def merge(self, a: tuple, b: tuple) -> tuple:
        return (a[0] + b[0], a[1] + b[1])

    def scan(self, held: tuple, rows: pd.DataFrame) -> tuple[list[tuple], tuple]:
        totals = held[1] + rows[self.value].fillna(0).astype("int64").cumsum()
        out = list(zip(range(held[0] + 1, held[0] + 1 + len(rows)), totals.tolist(), strict=True))
        return out, out[-1] if out else held

    def add_groups(self, held: pd.DataFrame, rows: pd.DataFrame, group: np.ndarray) -> pd.DataFrame:
        n = len(held)
        return pd.DataFrame({"n": held["n"] + np.bincount(group, minlength=n), "total": held["total"] + _sums(_whole(rows, self.value), group, n)})

    def scan_groups(self, held: pd.DataFrame, rows: pd.DataFrame, group: np.ndarray) -> tuple[pd.DataFrame, pd.DataFrame]:
        n = held["n"].to_numpy()[group] + _places(group) + 1
        total = held["total"].to_numpy()[group] + _totals(_whole(rows, self.value), group)
        return pd.DataFrame({"n": n, "total": total}), self.add_groups(held, rows, group)

    def merge_groups(self, held: pd.DataFrame, group: np.ndarray) -> pd.DataFrame:
        return held.groupby(group).sum()

    def results(self, held: pd.DataFrame) -> pd.DataFrame:
        return held


class Average(Accumulator):
    """The ``(sum, count)`` average of the values that are not NULL; none give NULL."""

    state, output = "total double, n bigint", "average double, n bigint"

    def __init__(self, value: str):
        self.value = value

    def zero(self) -> tuple:
        return (0.0, 0)

    def add(self, held: tuple, rows: pd.DataFrame) -> tuple:
        values = rows[self.value].dropna()
        return (held[0] + float(values.sum()), held[1] + len(values))

    def merge(self, a: tuple, b: tuple) -> tuple:
        return (a[0] + b[0], a[1] + b[1])

    def result(self, held: tuple) -> tuple:
        return (held[0] / held[1] if held[1] else None, held[1])

    def add_groups(self, held: pd.DataFrame, rows: pd.DataFrame, group: np.ndarray) -> pd.DataFrame:
        values = rows[self.value].to_numpy("float64", na_value=np.nan)
        known, n = ~np.isnan(values), len(held)
        return pd.DataFrame({"total": held["total"] + _sums(np.where(known, values, 0.0), group, n), "n": held["n"] + _sums(known.astype("int64"), group, n)})

    def merge_groups(self, held: pd.DataFrame, group: np.ndarray) -> pd.DataFrame:
        return held.groupby(group).sum()

    def results(self, held: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"average": (held["total"] / held["n"].where(held["n"] > 0)).astype("float64"), "n": held["n"]})


class MaxRow(Accumulator):
    """The largest value so far with the field of its row; the earliest of equals stays and NULLs are no values."""

    def __init__(self, value: str, field: str, field_type: str = "bigint"):
        self.value, self.field = value, field
        self.state = self.output = f"top double, best {field_type}"

    def zero(self) -> tuple:
        return (None, None)

    def add(self, held: tuple, rows: pd.DataFrame) -> tuple:
        known = rows[rows[self.value].notna()]
        if not len(known):
            return held
        at = int(np.argmax(known[self.value].to_numpy()))
        best = (float(known[self.value].iloc[at]), known[self.field].iloc[at].item())
        return best if held[0] is None or best[0] > held[0] else held

    def merge(self, a: tuple, b: tuple) -> tuple:
        return b if a[0] is None or b[0] is not None and b[0] > a[0] else a

    def scan_groups(self, held: pd.DataFrame, rows: pd.DataFrame, group: np.ndarray) -> tuple[pd.DataFrame, pd.DataFrame]:
        values = rows[self.value].to_numpy("float64", na_value=np.nan)
        known, first = ~np.isnan(values), firsts(group)
        top = held["top"].to_numpy("float64", na_value=np.nan)
        low = np.where(known, values, -np.inf)
        best = pd.Series(low).groupby(group).cummax().to_numpy()
        seen = _totals(known.astype("int64"), group) - known
        # What a row has to exceed: the largest before it in the batch, and the one held.
        before = np.where(first, -np.inf, np.r_[-np.inf, best[:-1]][: len(best)])
        beats = known & ((seen == 0) | (values > before)) & (np.isnan(top[group]) | (values > top[group]))
        start = np.arange(len(group)) - _places(group)
        newest = np.maximum.accumulate(np.where(beats, np.arange(len(group)), -1)) if len(group) else np.zeros(0, np.int64)
        fresh = newest >= start
        result = held.iloc[group].reset_index(drop=True)
        source = newest[fresh]
        top_after, best_after = result["top"].to_numpy("float64", na_value=np.nan).copy(), np.array(plain(result["best"]), dtype=object)
        top_after[fresh] = values[source]
        best_after[fresh] = np.array(plain(rows[self.field]), dtype=object)[source]
        result = self._frame(top_after, best_after)
        last = np.flatnonzero(np.r_[first[1:], True]) if len(group) else np.zeros(0, np.int64)
        tops, bests = top.copy(), np.array(plain(held["best"]), dtype=object)
        tops[group[last]], bests[group[last]] = top_after[last], best_after[last]
        return result, self._frame(tops, bests)

    def _frame(self, top: np.ndarray, best: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"top": top, "best": series(best.tolist(), fields(self.state)["best"])})

    def add_groups(self, held: pd.DataFrame, rows: pd.DataFrame, group: np.ndarray) -> pd.DataFrame:
        return self.scan_groups(held, rows, group)[1]

    def results(self, held: pd.DataFrame) -> pd.DataFrame:
        return held


class Previous(Accumulator):
    """The value of the row before, NULL at a key's first row; with ``first`` that of the key's first row."""

    def __init__(self, value: str, first: bool = False):
        self.value, self.first = value, first
        self.state, self.output = "base double, seen boolean", "last_value double"

    def zero(self) -> tuple:
        return (None, False)

    def add(self, held: tuple, rows: pd.DataFrame) -> tuple:
        return self.scan(held, rows)[1]

    def scan(self, held: tuple, rows: pd.DataFrame) -> tuple[list[tuple], tuple]:
        values = [None if pd.isna(v) else float(v) for v in rows[self.value]]
        if not values:
            return [], held
        if self.first:
            base = held[0] if held[1] else values[0]
            out = [(base if held[1] or i else None,) for i in range(len(values))]
            return out, (base, True)
        return [(v,) for v in [held[0], *values[:-1]]], (values[-1], True)

    def scan_groups(self, held: pd.DataFrame, rows: pd.DataFrame, group: np.ndarray) -> tuple[pd.DataFrame, pd.DataFrame]:
        values = rows[self.value].to_numpy("float64", na_value=np.nan)
        base, seen = held["base"].to_numpy("float64").copy(), held["seen"].to_numpy(bool).copy()
        first = firsts(group)
        if self.first:
            new = first & ~seen[group]
            base[group[new]] = values[new]
            out = np.where(new, np.nan, base[group])
        else:
            out = np.where(first, base[group], np.r_[np.nan, values[:-1]][: len(values)])
            base[group] = values  # of several the last one stays
        seen[group] = True
        return pd.DataFrame({"last_value": out}), pd.DataFrame({"base": base, "seen": seen})

    def add_groups(self, held: pd.DataFrame, rows: pd.DataFrame, group: np.ndarray) -> pd.DataFrame:
        return self.scan_groups(held, rows, group)[1]


class SeenBefore(Accumulator):
    """Whether a row of the key before this one had ``column = value``."""

    state, output = "seen boolean", "seen_before boolean"

    def __init__(self, column: str, value: str):
        self.column, self.value = column, value

    def zero(self) -> tuple:
        return (False,)

    def add(self, held: tuple, rows: pd.DataFrame) -> tuple:
        return (held[0] or bool((rows[self.column] == self.value).any()),)

    def scan(self, held: tuple, rows: pd.DataFrame) -> tuple[list[tuple], tuple]:
        seen = (rows[self.column] == self.value).cummax().tolist()
        before = [held[0], *(held[0] or s for s in seen[:-1])]
        return [(b,) for b in before[: len(rows)]], self.add(held, rows)

    def scan_groups(self, held: pd.DataFrame, rows: pd.DataFrame, group: np.ndarray) -> tuple[pd.DataFrame, pd.DataFrame]:
        hits = (rows[self.column] == self.value).fillna(False).to_numpy(bool).astype("int64")
        seen = held["seen"].to_numpy(bool).copy()
        before = seen[group] | (_totals(hits, group) > hits)
        seen[group[hits > 0]] = True
        return pd.DataFrame({"seen_before": before}), pd.DataFrame({"seen": seen})

    def add_groups(self, held: pd.DataFrame, rows: pd.DataFrame, group: np.ndarray) -> pd.DataFrame:
        return self.scan_groups(held, rows, group)[1]


def _sorted(rows: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    return next(in_order(rows, order))


def _together(rows: pd.DataFrame, group: np.ndarray) -> tuple[pd.DataFrame, np.ndarray]:
    """Rows with each group's together, in the order they had."""
    by_group = np.argsort(group, kind="stable")
    return rows.iloc[by_group].reset_index(drop=True), group[by_group]


def _beside(*frames: pd.DataFrame) -> pd.DataFrame:
    return pd.concat([f.reset_index(drop=True) for f in frames], axis=1)


class _Processor(StatefulProcessor):
    """Keeps accumulators in a table of ``keys``, ``place`` and the accumulator's columns."""

    def __init__(self, keys: dict[str, str], accumulator: Accumulator, place: str = ""):
        self.keys, self.names, self.accumulator = keys, list(keys), accumulator
        self.place, self.state, self.output = fields(place) if place else {}, list(fields(accumulator.state)), list(fields(accumulator.output))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # State columns have a prefix, so that they may be called like keys.
        self.table = Table(handle, "held", {**self.keys, **self.place, **{f"acc_{c}": kind for c, kind in fields(self.accumulator.state).items()}})

    def read(self) -> tuple[pd.DataFrame, pd.DataFrame]:
        """The keys and places of the bucket's accumulators, and these."""
        rows = self.table.read()
        return rows[[*self.names, *self.place]], rows[[f"acc_{c}" for c in self.state]].set_axis(self.state, axis=1)

    def write(self, where: pd.DataFrame, held: pd.DataFrame) -> None:
        self.table.write(_beside(where, held[self.state].add_prefix("acc_")))

    def grown(self, held: pd.DataFrame, n: int) -> pd.DataFrame:
        """``n`` accumulators, the first of which are ``held``."""
        return stacked([held, self.accumulator.zeros(n - len(held))])

    def close(self) -> None:
        pass


class RunningReduce(_Processor):
    """One output row for each input row: its ``keep`` columns and the accumulator's result up to it."""

    def __init__(self, keys: dict[str, str], order: list[str], keep: list[str], accumulator: Accumulator):
        super().__init__(keys, accumulator)
        self.order, self.keep = order, keep

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch, (where, held) = _sorted(rows, self.order), self.read()
        where, group = with_groups(where, batch, self.names)
        batch, group = _together(batch, group)
        results, held = self.accumulator.scan_groups(self.grown(held, len(where)), batch, group)
        self.write(where, held)
        yield _beside(batch[[*self.names, *self.keep]], results)


class CountWindows(_Processor):
    """Global windows with triggers: a window fires when it has ``size`` rows.

    ``purge`` empties it then; otherwise it grows on and fires again at every
    further ``size`` rows. With ``every`` set it also fires, with what it
    holds, when that much processing time has passed since its first row.
    """

    def __init__(self, keys: dict[str, str], order: list[str], size: int, accumulator: Accumulator, purge: bool = True, every: timedelta | None = None):
        super().__init__(keys, accumulator, "fires bigint, rows_held bigint, due_ms bigint")
        self.order, self.size, self.purge = order, size, purge
        self.every = None if every is None else micros(every) // 1000

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch, (where, held) = _sorted(rows, self.order), self.read()
        names, group = with_groups(where, batch, self.names)
        n = len(names)
        fires, count, due = (np.r_[where[c].fillna(-1).to_numpy("int64"), np.full(n - len(where), new)] for c, new in (("fires", 0), ("rows_held", 0), ("due_ms", -1)))
        held = self.grown(held, n)
        batch, group = _together(batch, group)
        if self.every is not None:
            some = np.unique(group)
            due[some[count[some] % self.size == 0]] = timerValues.getCurrentProcessingTimeInMs() + self.every
        total = count[group] + _places(group) + 1
        added = np.bincount(group, minlength=n)
        if self.purge:
            # One accumulator for each window that gets rows; a key's first window goes on from the one held.
            filled = (total - 1) // self.size
            part = np.cumsum(firsts(group) | (total % self.size == 1 % self.size)) - 1
            start = np.flatnonzero(firsts(part))
            first = firsts(group)[start]
            base = stacked([held, self.accumulator.zeros(1)]).iloc[np.where(first, group[start], n)].reset_index(drop=True)
            parts = self.accumulator.add_groups(base, batch, part)
            end = np.r_[start[1:], len(group)] - 1
            full = total[end] % self.size == 0
            at, last = group[end][full], np.r_[group[end][1:] != group[end][:-1], True]
            results, number = self.accumulator.results(parts[full].reset_index(drop=True)), fires[at] + filled[end][full]
            shown = np.full(len(at), self.size)
            # The last window of a key stays, empty if it has fired.
            stays = np.arange(n)
            stays[group[end][last]] = n + np.where(full[last], len(parts), np.flatnonzero(last))
            held = stacked([held, parts, self.accumulator.zeros(1)]).iloc[stays].reset_index(drop=True)
        else:
            results, held = self.accumulator.scan_groups(held, batch, group)
            full = total % self.size == 0
            at, results, shown = group[full], results[full], total[full]
            number = fires[at] + (total[full] // self.size - count[at] // self.size) - 1
        fired = (count + added) // self.size - count // self.size
        count = (count + added) % self.size if self.purge else count + added
        self._store(names, fires + fired, count, due, held)
        if len(at):
            yield _beside(names.iloc[at], pd.DataFrame({"fire": number, "rows": shown}), results)

    def _store(self, names: pd.DataFrame, fires: np.ndarray, count: np.ndarray, due: np.ndarray, held: pd.DataFrame) -> None:
        self.write(names.assign(fires=fires, rows_held=count, due_ms=due), held)
        if self.every is not None:
            set_timer(self.handle, due[due >= 0].min() if (due >= 0).any() else None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        where, held = self.read()
        names, fires, count, due = where[self.names], *(where[c].to_numpy("int64").copy() for c in ("fires", "rows_held", "due_ms"))
        over = (due >= 0) & (due <= expiredTimerInfo.getExpiryTimeInMs())
        shown = np.flatnonzero(over & (count > 0))
        out = _beside(names.iloc[shown], pd.DataFrame({"fire": fires[shown], "rows": count[shown]}), self.accumulator.results(held.iloc[shown].reset_index(drop=True)))
        fires[shown] += 1
        due[over] = -1
        if self.purge:
            count[shown] = 0
            held = stacked([held, self.accumulator.zeros(1)]).iloc[np.where(np.isin(np.arange(len(held)), shown), len(held), np.arange(len(held)))]
        self._store(names, fires, count, due, held.reset_index(drop=True))
        if len(out):
            yield out


class RefiringWindows(_Processor):
    """Tumbling event-time windows that fire at the watermark and again for each accepted late row.

    A window first fires when the watermark (newest time less ``bound``)
    reaches its end. Until ``lateness`` after it, every further row fires it
    again; then its state goes and rows of it are ``too_late``.

    Spark itself would drop late rows before they arrive here, so its own
    watermark is declared ``HORIZON`` behind and the processor adds the
    difference back. Timers are set that much earlier, and state is dropped by
    them, not by Spark's watermark. Spark's watermark starts at 1970, so the
    times must lie at least the horizon after it.
    """

    def __init__(self, keys: dict[str, str], at: str, order: list[str], size: timedelta, bound: timedelta, lateness: timedelta, accumulator: Accumulator):
        super().__init__(keys, accumulator, "window_end bigint, fires bigint")
        self.at, self.order = at, order
        self.size, self.lateness = micros(size) // 1000, micros(lateness) // 1000
        self.ahead = micros(HORIZON) // 1000 - micros(bound) // 1000

    def _due(self, timerValues) -> tuple[int | None, pd.DataFrame, pd.DataFrame, list[pd.DataFrame]]:
        """Watermark (ms, None before the first), the windows it has not closed, and the first firings of those it has passed."""
        spark_mark = timerValues.getCurrentWatermarkInMs()
        where, held = self.read()
        if spark_mark <= 0:
            return None, where, held, []
        mark = spark_mark + self.ahead
        end, fires = (where[c].to_numpy("int64") for c in ("window_end", "fires"))
        first = (end <= mark) & (fires == 0)
        out = [self._rows(where[first], "fire", np.ones(int(first.sum()), "int64"), self.accumulator.results(held[first].reset_index(drop=True)))] if first.any() else []
        stays = end + self.lateness > mark
        return mark, where.assign(fires=np.where(first, 1, fires))[stays].reset_index(drop=True), held[stays].reset_index(drop=True), out

    def _rows(self, where: pd.DataFrame, kind: str, fire: np.ndarray | None, results: pd.DataFrame) -> pd.DataFrame:
        made = where[[*self.names, "window_end"]].assign(kind=kind, fire=pd.NA if fire is None else fire)
        return _beside(made.astype({"fire": "Int64"}), results)

    def _store(self, where: pd.DataFrame, held: pd.DataFrame) -> None:
        self.write(where, held)
        due = where["window_end"] + np.where(where["fires"] > 0, self.lateness, 0) - self.ahead
        set_timer(self.handle, due.min() if len(due) else None)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        mark, where, held, out = self._due(timerValues)
        batch = _sorted(rows, self.order)
        batch = batch[batch[self.at].notna()].reset_index(drop=True)
        if len(batch):
            ends = (batch[self.at].astype("int64") // 1000 // self.size + 1) * self.size
            batch = batch.assign(window_end=ends)
            closed = (ends + self.lateness <= mark).to_numpy(bool) if mark is not None else np.zeros(len(batch), bool)
            if closed.any():
                late = batch[closed].reset_index(drop=True)
                alone = self.accumulator.scan_groups(self.accumulator.zeros(len(late)), late, np.arange(len(late)))[0]
                out.append(self._rows(late, "too_late", None, alone))
                batch = batch[~closed].reset_index(drop=True)
        if len(batch):
            names, group = with_groups(where, batch, [*self.names, "window_end"])
            fires = np.r_[where["fires"].to_numpy("int64"), np.zeros(len(names) - len(where), "int64")]
            held = self.grown(held, len(names))
            batch, group = _together(batch, group)
            passed = (batch["window_end"] <= mark).to_numpy(bool) if mark is not None else np.zeros(len(batch), bool)
            if passed.any():
                again, at = batch[passed].reset_index(drop=True), group[passed]
                results, held = self.accumulator.scan_groups(held, again, at)
                out.append(self._rows(again, "fire", fires[at] + _places(at) + 1, results))
                fires += np.bincount(at, minlength=len(fires))
            if not passed.all():
                held = self.accumulator.add_groups(held, batch[~passed].reset_index(drop=True), group[~passed])
            where = names.assign(fires=fires)
        self._store(where, held)
        yield from out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        _, where, held, out = self._due(timerValues)
        self._store(where, held)
        yield from out


class SessionWindows(_Processor):
    """Event-time sessions with an accumulator each; sessions that grow together merge theirs.

    Rows at most ``gap`` apart share a session, which leaves when the
    watermark passes its last row by the gap. Rows of a session that has left
    open a new one only if Spark's watermark still lets them through.
    """

    def __init__(self, keys: dict[str, str], at: str, order: list[str], gap: timedelta, accumulator: Accumulator):
        super().__init__(keys, accumulator, "session_start bigint, session_last bigint")
        self.at, self.order, self.gap = at, order, micros(gap)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = _sorted(rows, [self.at, *self.order])
        batch = batch[batch[self.at].notna()].reset_index(drop=True)
        if batch.empty:
            return
        where, held = self.read()
        batch, group = _together(batch, numbered(batch[self.names]))
        at = batch[self.at].to_numpy("int64")
        opens = firsts(group) | np.r_[True, np.diff(at) > self.gap]
        part, start = np.cumsum(opens) - 1, np.flatnonzero(opens)
        fresh = batch[self.names].iloc[start].reset_index(drop=True).assign(session_start=at[start], session_last=at[np.r_[start[1:], len(at)] - 1])
        parts = self.accumulator.add_groups(self.accumulator.zeros(len(start)), batch, part)
        where, held = stacked([where, fresh]), stacked([held, parts])
        # Sessions that overlap or are at most the gap apart are one.
        group = numbered(where[self.names])
        first, last = where["session_start"].to_numpy("int64"), where["session_last"].to_numpy("int64")
        order = np.lexsort((last, first, group))
        group, first, last = group[order], first[order], last[order]
        reached = pd.Series(last).groupby(group).cummax().to_numpy()
        opens = firsts(group) | np.r_[True, first[1:] - reached[:-1] > self.gap]
        merged, start = np.cumsum(opens) - 1, np.flatnonzero(opens)
        held = self.accumulator.merge_groups(held.iloc[order].reset_index(drop=True), merged).reset_index(drop=True)
        where = where.iloc[order[start]].reset_index(drop=True).assign(session_start=first[start], session_last=np.maximum.reduceat(last, start))
        yield from self._leave(where, held, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._leave(*self.read(), timerValues)

    def _leave(self, where: pd.DataFrame, held: pd.DataFrame, timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        end = where["session_last"] + self.gap
        done = (end <= mark * 1000).to_numpy(bool)
        self.write(where[~done], held[~done])
        set_timer(self.handle, None if done.all() else max(-(-int(end[~done].min()) // 1000), mark + 1))
        if done.any():
            left = where[[*self.names, "session_start"]].assign(session_end=end)[done]
            yield _beside(left, self.accumulator.results(held[done].reset_index(drop=True)))


class ArrivalWindows(_Processor):
    """Tumbling windows over the time a row is processed; a processing-time timer at the end fires and clears one."""

    def __init__(self, keys: dict[str, str], order: list[str], size: timedelta, accumulator: Accumulator):
        super().__init__(keys, accumulator, "window_end bigint")
        self.order, self.size = order, micros(size) // 1000

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        end = (timerValues.getCurrentProcessingTimeInMs() // self.size + 1) * self.size
        batch, (where, held) = _sorted(rows, self.order).assign(window_end=end), self.read()
        where, group = with_groups(where, batch, [*self.names, "window_end"])
        batch, group = _together(batch, group)
        yield from self._fire(where, self.accumulator.add_groups(self.grown(held, len(where)), batch, group), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._fire(*self.read(), timerValues)

    def _fire(self, where: pd.DataFrame, held: pd.DataFrame, timerValues) -> Iterator[pd.DataFrame]:
        done = (where["window_end"] <= timerValues.getCurrentProcessingTimeInMs()).to_numpy(bool)
        self.write(where[~done], held[~done])
        set_timer(self.handle, None if done.all() else where["window_end"][~done].min())
        if done.any():
            yield _beside(where[done], self.accumulator.results(held[done].reset_index(drop=True)))


class DailyFirst(StatefulProcessor):
    """The first row of each key and day; a day's mark goes when the watermark passes its end.

    Rows without a time have no day of their own: the key's first of them
    passes, once.
    """

    NO_DAY = -1

    def __init__(self, keys: dict[str, str], at: str, order: list[str]):
        self.keys, self.at, self.order = keys, at, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = Table(handle, "days", {**self.keys, "day_end": "bigint"})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = _sorted(rows, [self.at, *self.order])
        width = micros(timedelta(days=1))
        ends = ((batch[self.at].fillna(-1).astype("int64") // width + 1) * (width // 1000)).where(batch[self.at].notna(), self.NO_DAY)
        marks = self.days.read()
        known, group = with_groups(marks, batch.assign(day_end=ends), [*self.keys, "day_end"])
        first = np.sort(firsts_of(np.r_[np.arange(len(marks)), group]))[len(marks) :] - len(marks)
        self._expire(known, timerValues)
        if len(first):
            yield batch.iloc[first].drop(columns=self.at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._expire(self.days.read(), timerValues)
        yield from ()

    def _expire(self, marks: pd.DataFrame, timerValues) -> None:
        end = marks["day_end"]
        held = marks[(end == self.NO_DAY) | (end > timerValues.getCurrentWatermarkInMs())]
        self.days.write(held)
        dated = held["day_end"][held["day_end"] != self.NO_DAY]
        set_timer(self.handle, dated.min() if len(dated) else None)

    def close(self) -> None:
        pass


class Changelog(_Processor):
    """Retract output: for each changed result of a batch, the old row with -1 and the new row with +1."""

    def __init__(self, keys: dict[str, str], order: list[str], accumulator: Accumulator):
        super().__init__(keys, accumulator, "version bigint")
        self.order = order

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch, (where, held) = _sorted(rows, self.order), self.read()
        names, group = with_groups(where, batch, self.names)
        version = np.r_[where["version"].to_numpy("int64"), np.zeros(len(names) - len(where), "int64")]
        batch, group = _together(batch, group)
        held = self.grown(held, len(names))
        old, held = self.accumulator.results(held), self.accumulator.add_groups(held, batch, group)
        new = self.accumulator.results(held)
        alike = ((old == new) | (old.isna() & new.isna())).fillna(False).all(axis=1).to_numpy(bool)
        changed = (version == 0) | ~alike
        self.write(names.assign(version=version + changed), held)
        minus, plus = changed & (version > 0), changed
        if changed.any():
            out = [_beside(names[rows], pd.DataFrame({"version": (version + step)[rows], "change": np.full(int(rows.sum()), sign, "int32")}), results[rows])
                   for rows, step, sign, results in ((minus, 0, -1, old), (plus, 1, 1, new))]
            yield stacked(out[::-1])


def _schema(df: DataFrame, columns: list[str], rest: str) -> str:
    return ", ".join([*[f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns], rest])


def running_reduce(df: DataFrame, keys: list[str], order: list[str], keep: list[str], accumulator: Accumulator) -> DataFrame:
    """``keys, keep``, then the running result, for each row of a stream."""
    return run_processor(df, keys, RunningReduce(kinds(df, keys), order, keep, accumulator), _schema(df, [*keys, *keep], accumulator.output))


def count_windows(
    df: DataFrame, keys: list[str], order: list[str], size: int, accumulator: Accumulator, purge: bool = True, every: timedelta | None = None
) -> DataFrame:
    """``keys, fire, rows``, then the result, for each firing of a key's global window."""
    made = CountWindows(kinds(df, keys), order, size, accumulator, purge, every)
    return run_processor(df, keys, made, _schema(df, keys, f"fire bigint, rows bigint, {accumulator.output}"), "none" if every is None else "ProcessingTime")


def refiring_windows(
    df: DataFrame, keys: list[str], ts: str, order: list[str], size: timedelta, bound: timedelta, lateness: timedelta, accumulator: Accumulator
) -> DataFrame:
    """``keys, window_end`` (ms), ``kind`` (fire, too_late), ``fire`` (from 1), then the result.

    A ``too_late`` row has the result of that row alone. Rows without a time
    are in no window. Rows more than ``HORIZON`` behind are dropped by Spark.
    """
    timed = df.withColumn("at_us", epoch_micros(F.col(ts))).withWatermark(ts, as_interval(HORIZON))
    made = RefiringWindows(kinds(df, keys), "at_us", order, size, bound, lateness, accumulator)
    return run_processor(timed, keys, made, _schema(df, keys, f"window_end bigint, kind string, fire bigint, {accumulator.output}"), "EventTime")


def session_windows(df: DataFrame, keys: list[str], ts: str, order: list[str], gap: timedelta, bound: timedelta, accumulator: Accumulator) -> DataFrame:
    """``keys, session_start, session_end`` (microseconds), then the result, for each session the watermark has passed."""
    timed = df.withColumn("at_us", epoch_micros(F.col(ts))).withWatermark(ts, as_interval(bound))
    made = SessionWindows(kinds(df, keys), "at_us", order, gap, accumulator)
    return run_processor(timed, keys, made, _schema(df, keys, f"session_start bigint, session_end bigint, {accumulator.output}"), "EventTime")


def daily_first_rows(df: DataFrame, keys: list[str], ts: str, order: list[str], bound: timedelta) -> DataFrame:
    """Whole first row of each key and day of ``ts``, days being UTC; rows later than ``bound`` are dropped."""
    timed = df.withColumn("at_us", epoch_micros(F.col(ts))).withWatermark(ts, as_interval(bound))
    return run_processor(timed, keys, DailyFirst(kinds(df, keys), "at_us", order), df.schema, "EventTime")


def arrival_windows(df: DataFrame, keys: list[str], order: list[str], size: timedelta, accumulator: Accumulator) -> DataFrame:
    """``keys, window_end`` (ms), then the result, for each window of processing time."""
    made = ArrivalWindows(kinds(df, keys), order, size, accumulator)
    return run_processor(df, keys, made, _schema(df, keys, f"window_end bigint, {accumulator.output}"), "ProcessingTime")


def retractions(df: DataFrame, keys: list[str], order: list[str], accumulator: Accumulator) -> DataFrame:
    """``keys, version, change`` (-1, 1), then the result: an append-only changelog that sums up to the current table."""
    return run_processor(df, keys, Changelog(kinds(df, keys), order, accumulator), _schema(df, keys, f"version bigint, change int, {accumulator.output}"))
