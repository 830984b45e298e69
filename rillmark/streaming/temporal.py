"""Processors over two inputs: as-of joins, snapshot hand-over, matching with time-outs.

Two streams with a watermark each are united into rows ``(keys, side, at_us,
pos, payload)``; the watermark of the union is the lesser of both, so what it
has passed is complete on either side. Payloads are JSON text.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rillmark.functions.times import as_interval, epoch_micros, micros
from rillmark.streaming.processors import Table, firsts, kinds, numbered, plain, run_processor, set_timer, stacked, with_groups

LEFT, RIGHT = "left", "right"


def tagged(df: DataFrame, side: str, key: Column, ts: str, pos: Column, payload: Column, bound: timedelta) -> DataFrame:
    """A stream's rows as one side of a two-input processor, with its own watermark."""
    at = epoch_micros(F.col(ts)).alias("at_us")
    timed = df.withWatermark(ts, as_interval(bound))
    return timed.select(key.alias("key"), F.lit(side).alias("side"), F.col(ts).alias("ts"), at, pos.cast("bigint").alias("pos"), payload.alias("payload"))


class _TwoInputs(StatefulProcessor):
    def __init__(self, keys: dict[str, str]):
        self.names = list(keys)
        self.columns = {**keys, "at": "bigint", "pos": "bigint", "payload": "string"}

    def _added(self, held: pd.DataFrame, batch: pd.DataFrame, side: str) -> pd.DataFrame:
        """Held rows and the batch's of one side."""
        part = batch[(batch["side"] == side) & batch["at_us"].notna() & batch["pos"].notna()]
        named = part.rename(columns={"at_us": "at"})[list(self.columns)].astype({"at": "int64", "pos": "int64"})
        return stacked([held, named])

    def _due(self, at: int | None, timerValues) -> None:
        """The timer, for the first time (in microseconds) that something is to be decided."""
        set_timer(self.handle, None if at is None else max(-(-int(at) // 1000), timerValues.getCurrentWatermarkInMs() + 1))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        yield from self._settle(pd.concat(list(rows), ignore_index=True), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._settle(None, timerValues)

    def close(self) -> None:
        pass


class AsOfJoin(_TwoInputs):
    """Each right row with the payload of the newest left row of its key at or before its time.

    Left rows are versions; a version without payload ends the one before it.
    Versions of one time follow their ``pos``. A right row waits until the
    watermark passes it; versions older than the one then in force are dropped.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.versions, self.waiting = Table(handle, "versions", self.columns), Table(handle, "waiting", self.columns)

    def _settle(self, batch: pd.DataFrame | None, timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        versions, waiting = self.versions.read(), self.waiting.read()
        if batch is not None:
            versions, waiting = self._added(versions, batch, LEFT), self._added(waiting, batch, RIGHT)
        group = numbered(stacked([versions, waiting])[self.names])
        versions = versions.assign(group=group[: len(versions)]).sort_values(["at", "pos"], kind="stable", ignore_index=True)
        waiting = waiting.assign(group=group[len(versions) :]).sort_values(["at", "pos"], kind="stable", ignore_index=True)
        done = int((waiting["at"] <= mark).sum())
        if done:
            decided = waiting.iloc[:done]
            found = np.full(done, -1)
            if len(versions):
                place = versions[["group", "at"]].assign(place=np.arange(len(versions)))
                found = pd.merge_asof(decided[["group", "at"]], place, on="at", by="group")["place"].fillna(-1).to_numpy("int64")
            payloads = np.array([*plain(versions["payload"]), None], dtype=object)
            yield decided[[*self.names, "pos", "payload"]].assign(version=payloads[found])
        passed = versions["at"] <= mark
        newest = ~versions["group"].where(passed, -1).duplicated(keep="last")
        self.versions.write(versions[~passed | newest])
        self.waiting.write(waiting.iloc[done:])
        self._due(waiting["at"].iloc[done] if done < len(waiting) else None, timerValues)


class PairMatcher(_TwoInputs):
    """Right rows matched with the left row of their key, in either order of arrival, at most ``wait`` apart in time.

    A key has one left row; the earliest of several counts. Rows that find no
    partner until the watermark passes their time by ``wait`` leave as
    ``no_left`` or ``no_right``.
    """

    def __init__(self, keys: dict[str, str], wait: timedelta):
        super().__init__(keys)
        self.wait = micros(wait)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.left, self.right = Table(handle, "left", {**self.columns, "matched": "boolean"}), Table(handle, "right", self.columns)

    def _settle(self, batch: pd.DataFrame | None, timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        left, right = self.left.read(), self.right.read()
        if batch is not None:
            left, right = self._added(left, batch, LEFT), self._added(right, batch, RIGHT)
        group = numbered(stacked([left, right])[self.names])
        matched = np.zeros(int(group.max(initial=-1)) + 1, bool)
        met = left["matched"].eq(True) if "matched" in left else np.zeros(len(left), bool)
        matched[group[: len(left)][np.asarray(met)]] = True
        left, right = left.assign(group=group[: len(left)]), right.assign(group=group[len(left) :])
        left = left.sort_values(["at", "pos"], kind="stable").drop_duplicates("group").reset_index(drop=True)
        right = right.sort_values(["at", "pos"], kind="stable", ignore_index=True)
        partner = np.full(len(matched), -1)
        partner[left["group"]] = np.arange(len(left))
        found, at = partner[right["group"].to_numpy()], right["at"].to_numpy("int64")
        times = np.r_[left["at"].to_numpy("int64"), 0]
        pair = (found >= 0) & (np.abs(at - times[found]) <= self.wait)
        alone = ~pair & (at + self.wait < mark)
        matched[right["group"][pair]] = True
        over = (left["at"] + self.wait < mark).to_numpy(bool)
        met = matched[left["group"]]
        self.left.write(left.assign(matched=met)[~over])
        self.right.write(right[~pair & ~alone])
        held = np.r_[times[:-1][~over], at[~pair & ~alone]]
        self._due(held.min() + self.wait + 1 if len(held) else None, timerValues)
        payloads = np.array([*plain(left["payload"]), None], dtype=object)
        yield from self._rows("match", right[pair], payloads[found[pair]], right["payload"][pair])
        yield from self._rows("no_left", right[alone], None, right["payload"][alone])
        yield from self._rows("no_right", left[over & ~met], left["payload"][over & ~met], None)

    def _rows(self, kind: str, rows: pd.DataFrame, left, right) -> Iterator[pd.DataFrame]:
        if len(rows):
            made = rows[[*self.names, "pos"]].assign(kind=kind)
            yield made.assign(left=left, right=right).astype({"left": object, "right": object})


class SnapshotHandover(StatefulProcessor):
    """Changes that follow a snapshot, each once, with the row image before and after.

    The snapshot is the initial state: each key's image as its chunk was read.
    A change carries its log position and the position ``cut`` at which its
    key's chunk was read; what the snapshot already holds (up to the cut) and
    what came before (a log read again) is dropped.
    """

    def __init__(self, keys: dict[str, str]):
        self.keys, self.names = keys, list(keys)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = Table(handle, "held", {**self.keys, "position": "bigint", "image": "string"})

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        rows = stacked([self.held.read(), initialState[list(self.held.columns)]]).sort_values("position", kind="stable")
        self.held.write(rows.drop_duplicates(self.names, keep="last"))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values("position", kind="stable", ignore_index=True)
        batch = batch[~(batch["position"] <= batch["cut"])]
        held = self.held.read()
        names, group = with_groups(held, batch, self.names)
        new = len(names) - len(held)
        last = np.r_[held["position"].to_numpy("int64"), np.full(new, np.iinfo("int64").min)]
        image = np.array([*plain(held["image"]), *[None] * new], dtype=object)
        position = batch["position"].to_numpy("int64")
        fresh = (position > last[group]) & ~pd.DataFrame({"group": group, "position": position}).duplicated().to_numpy()
        by_key = np.flatnonzero(fresh)[np.argsort(group[fresh], kind="stable")]
        if not len(by_key):
            return
        batch, group, position = batch.iloc[by_key].reset_index(drop=True), group[by_key], position[by_key]
        after = np.array(plain(batch["image"].where(batch["type"] != "delete")), dtype=object)
        before = np.where(firsts(group), image[group], np.r_[np.array([None], object), after[:-1]])
        last[group], image[group] = position, after  # of several the last one stays
        self.held.write(names.assign(position=last, image=image))
        yield batch[[*self.names, "position", "type"]].assign(before=before, after=after)

    def close(self) -> None:
        pass


#: Copies that :func:`as_of_join` makes of each version, so that a key's rows are the work of as many tasks.
SPREAD = 64


def _both(left: DataFrame, right: DataFrame, keys: list[str], processor: StatefulProcessor, schema: str) -> DataFrame:
    return run_processor(left.unionByName(right), keys, processor, f"key {left.schema['key'].dataType.simpleString()}, {schema}", "EventTime")


def as_of_join(versions: DataFrame, rows: DataFrame, spread: int = SPREAD) -> DataFrame:
    """``(key, pos, payload, version)`` of tagged streams; ``version`` is NULL where none was in force.

    Rows do not depend on each other, so a key's are dealt by their ``pos``
    over ``spread`` parts, each of which has all of the key's versions.
    """
    copies = versions.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("pos"), F.lit(spread)).cast("int"))
    keys = ["key", "part"]
    return _both(copies, dealt, keys, AsOfJoin(kinds(copies, keys)), "pos bigint, payload string, version string")


def match_pairs(left: DataFrame, right: DataFrame, wait: timedelta) -> DataFrame:
    """``(key, kind, pos, left, right)`` of tagged streams, ``kind`` being match, no_left or no_right."""
    return _both(left, right, ["key"], PairMatcher(kinds(left, ["key"]), wait), "kind string, pos bigint, left string, right string")


def after_snapshot(changes: DataFrame, snapshot: DataFrame, key: str) -> DataFrame:
    """Changes ``(key, position, cut, type, image)`` that ``snapshot`` (key, position, image) does not hold, with their images.

    A snapshot without rows is one that found no rows: the cuts still hold.
    """
    kind = changes.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, position bigint, type string, before string, after string"
    return run_processor(changes, key, SnapshotHandover(kinds(changes, [key])), schema, initial=snapshot)
