"""As-of lookup between two streams.

Probes wait in their key's state until the watermark has passed their time; by then every version they may need
has arrived. A version is kept while it is still the latest one before the watermark.

Keys share state by buckets of their hash, as a state group costs many round trips however few rows it has. State is a map of
blocks in the state store, each a run of at most ``block`` rows in order of key and time, under a small directory of their bounds. A
timer at the earliest waiting probe resolves what the watermark has passed, one block of probes at a time against the blocks of
versions that can hold its answers. So a task holds a few blocks and one version of each of a bucket's keys, however many rows a
key has, and a micro-batch rewrites only the blocks it touches.

The Python side only compares keys and times. What a probe or version carries travels as one JSON text that is written and
read by Spark, so a group costs four columns however wide the rows are.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Rows of a block, which are read and written together.
BLOCK = 2048
#: State groups that keys are dealt to. It is part of the state's layout, so a checkpoint keeps the number it began with.
BUCKETS = 1024
#: Blocks of versions that a task keeps while it resolves a bucket.
_KEPT = 16
_ROWS = "keys ARRAY<STRING>, times ARRAY<BIGINT>, rows ARRAY<STRING>"
_DIRECTORY = (
    "ids ARRAY<BIGINT>, lows ARRAY<STRING>, highs ARRAY<STRING>, firsts ARRAY<BIGINT>, lasts ARRAY<BIGINT>,"
    " sizes ARRAY<BIGINT>, settled ARRAY<BOOLEAN>, upcoming BIGINT"
)


@dataclass(frozen=True)
class _Rows:
    """Rows of a block in order of key and time; of equal ones, in order of arrival."""

    keys: np.ndarray
    times: np.ndarray
    rows: np.ndarray

    def __len__(self) -> int:
        return len(self.times)

    def __getitem__(self, some) -> _Rows:
        return _Rows(self.keys[some], self.times[some], self.rows[some])

    def and_later(self, more: _Rows) -> _Rows:
        both = (self.keys, more.keys), (self.times, more.times), (self.rows, more.rows)
        return _Rows(*[np.concatenate(pair) for pair in both]).ordered()

    def ordered(self) -> _Rows:
        codes, _ = pd.factorize(self.keys, sort=True)
        return self[np.lexsort((self.times, codes))]

    def latest(self) -> _Rows:
        """The last row of each key."""
        return self[np.append(self.keys[1:] != self.keys[:-1], True)] if len(self) else self


def _no_rows() -> _Rows:
    return _Rows(np.zeros(0, object), np.zeros(0, np.int64), np.zeros(0, object))


@dataclass(frozen=True)
class _Bounds:
    low: str
    high: str
    first: int
    last: int
    size: int
    #: One version of each key, left by ``_drop_settled``.
    settled: bool


class _Blocks:
    """Rows of one kind under the current bucket: blocks by number, and their bounds."""

    def __init__(self, handle: StatefulProcessorHandle, name: str, size: int):
        self.size = size
        self._blocks = handle.getMapState(name, "block BIGINT", _ROWS)
        self._directory = handle.getValueState(f"{name}_directory", _DIRECTORY)

    def open(self) -> _Blocks:
        """Read the current bucket's directory."""
        *columns, self.upcoming = self._directory.get() or ([[]] * 7 + [0])
        self.bounds = {i: _Bounds(*rest) for i, *rest in zip(*columns)}
        self.changed = False
        self._read: OrderedDict[int, _Rows] = OrderedDict()
        return self

    def close(self) -> None:
        self._read.clear()
        if self.changed and self.bounds:
            values = self.bounds.values()
            columns = [[getattr(b, f.name) for b in values] for f in fields(_Bounds)]
            self._directory.update((list(self.bounds), *columns, self.upcoming))
        elif self.changed:
            self._directory.clear()

    def add(self, rows: _Rows, settled: bool = False) -> None:
        """Add rows in their order. Few of them go to the last block while it has room, so that trickles don't scatter."""
        if not len(rows):
            return
        last = self.upcoming - 1
        if not settled and len(rows) < self.size // 4 and last in self.bounds and self.bounds[last].size + len(rows) <= self.size:
            self.put(last, self.read(last).and_later(rows))
            return
        for start in range(0, len(rows), self.size):
            self.put(self.upcoming, rows[start : start + self.size], settled)
            self.upcoming += 1

    def read(self, block: int) -> _Rows:
        if block not in self._read:
            keys, times, rows = self._blocks.getValue((block,))
            self._read[block] = _Rows(np.array(keys, object), np.array(times, np.int64), np.array(rows, object))
        self._read.move_to_end(block)
        if len(self._read) > _KEPT:
            self._read.popitem(last=False)
        return self._read[block]

    def put(self, block: int, rows: _Rows, settled: bool = False) -> None:
        self.changed = True
        self._read.pop(block, None)
        if len(rows):
            self._blocks.updateValue((block,), (rows.keys.tolist(), rows.times.tolist(), rows.rows.tolist()))
            times = rows.times
            self.bounds[block] = _Bounds(rows.keys[0], rows.keys[-1], int(times.min()), int(times.max()), len(rows), settled)
        else:
            self._blocks.removeKey((block,))
            self.bounds.pop(block)


class _AsOf(StatefulProcessor):
    def __init__(self, inclusive: bool, block: int):
        self.inclusive, self.block = inclusive, block

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.versions, self.probes = _Blocks(handle, "versions", self.block), _Blocks(handle, "probes", self.block)
        self.timer = handle.getValueState("timer", "at BIGINT")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        versions, probes = self.versions.open(), self.probes.open()
        for chunk in rows:
            is_version = chunk["is_version"].to_numpy(bool)
            found = _Rows(chunk["key"].to_numpy(object), chunk["t"].to_numpy(np.int64), chunk["row"].to_numpy(object))
            versions.add(found[is_version].ordered())
            probes.add(found[~is_version].ordered())
        watermark = timerValues.getCurrentWatermarkInMs()
        if not probes.bounds:
            self._drop_settled(watermark)  # buckets that nobody asks for keep one version of a key too
        self._set_timer(watermark)
        versions.close()
        probes.close()
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        versions, probes = self.versions.open(), self.probes.open()
        # Blocks of neighbouring keys ask for the same blocks of versions.
        for block in sorted((b for b, at in probes.bounds.items() if at.first <= watermark), key=lambda b: probes.bounds[b].low):
            waiting = probes.read(block)
            ready = waiting.times <= watermark
            asked = waiting[ready]
            yield pd.DataFrame({"t": asked.times, "probe": asked.rows, "version": self._found(asked)})
            probes.put(block, waiting[~ready])
        self._drop_settled(watermark)
        self.timer.clear()
        self._set_timer(watermark)
        versions.close()
        probes.close()

    def _found(self, asked: _Rows) -> np.ndarray:
        """The version of each key and time asked for, in order. Of versions at one time the one that arrived last wins."""
        best, origin, found = np.full(len(asked), np.iinfo(np.int64).min), np.full(len(asked), -1), np.full(len(asked), None, object)
        low, high, latest, bounds = asked.keys[0], asked.keys[-1], asked.times.max(), self.versions.bounds
        candidates = [b for b, at in bounds.items() if at.first <= latest and at.low <= high and at.high >= low]
        for block in sorted(candidates, key=lambda b: bounds[b].last, reverse=True):
            if (origin >= 0).all() and bounds[block].last < best.min():
                break
            versions = self.versions.read(block)
            past = self._places(versions, asked)
            at = versions.times[past]
            better = (past >= 0) & ((at > best) | ((at == best) & (block > origin)))
            best[better], origin[better], found[better] = at[better], block, versions.rows[past[better]]
        return found

    def _places(self, versions: _Rows, asked: _Rows) -> np.ndarray:
        """Where the version of each row asked for lies in a block, or -1."""
        codes, known = pd.factorize(versions.keys)
        wanted = pd.Index(known).get_indexer(asked.keys)
        times = np.unique(versions.times)
        # Keys and times as one number in the order of the block.
        placed = codes * (len(times) + 1) + np.searchsorted(times, versions.times) + 1
        asked_at = np.searchsorted(times, asked.times, "right" if self.inclusive else "left")
        past = np.searchsorted(placed, wanted * (len(times) + 1) + asked_at, "right") - 1
        return np.where((wanted >= 0) & (past >= 0) & (codes[past] == wanted), past, -1)

    def _drop_settled(self, watermark: int) -> None:
        """Forget versions that a later one of their key before the watermark has replaced. Versions that are left from before are
        read again once as many have come since, so that a micro-batch costs what it brings."""
        bounds = self.versions.bounds
        past = sorted(b for b, at in bounds.items() if at.last < watermark)
        new = sum(bounds[b].size for b in past if not bounds[b].settled)
        if not new or new < sum(bounds[b].size for b in past if bounds[b].settled):
            return
        left = _no_rows()
        for block in past:  # in order of arrival
            left = left.and_later(self.versions.read(block)).latest()
            self.versions.put(block, _no_rows())
        self.versions.add(left, settled=True)

    def _set_timer(self, watermark: int) -> None:
        """One timer, at the earliest waiting probe."""
        if not self.probes.bounds:
            return
        earliest = max(min(at.first for at in self.probes.bounds.values()), watermark + 1)
        if self.timer.exists():
            (at,) = self.timer.get()
            if at <= earliest:
                return
            self.handle.deleteTimer(at)
        self.handle.registerTimer(earliest)
        self.timer.update((earliest,))

    def close(self) -> None:
        pass


def _packed(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def _schema(df: DataFrame, columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, df.schema[c].dataType) for c in columns])


def stream_asof_join(
    probes: DataFrame,
    versions: DataFrame,
    key: str,
    probe_time: str,
    version_time: str,
    values: Sequence[str],
    *,
    inclusive: bool = True,
    deleted: str | None = None,
    heavy_keys: Sequence[str] = (),
    lanes: int = 16,
    block: int = BLOCK,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Streaming counterpart of ``asof_join``. Both inputs carry a watermark; probes without a match get nulls, and
    rows without a time are left out.

    A version whose ``deleted`` column is true ends the key's validity from its time on. A key of any weight takes bounded memory;
    to spread its work as well, the probes of ``heavy_keys`` (and those without a key) go to ``lanes`` state groups, each of
    which gets that key's versions.
    """
    carried = [c for c in probes.columns if c != probe_time]
    heavy = F.coalesce(F.col(key).isin(*heavy_keys), F.lit(False)) if heavy_keys else F.lit(False)
    spread = F.pmod(F.xxhash64(probe_time, *carried), F.lit(lanes)).cast("int")
    copies = F.when(heavy, F.sequence(F.lit(0), F.lit(lanes - 1))).otherwise(F.array(F.lit(0)))
    gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
    # Keys as text with a mark, so that probes without one meet no version.
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")
    text = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")).alias("key")

    # The time columns stay in the rows because they carry the watermarks.
    left = probes.select(
        bucket, text, F.when(heavy | F.col(key).isNull(), spread).otherwise(0).alias("lane"), F.lit(False).alias("is_version"),
        F.unix_millis(probe_time).alias("t"), _packed(carried).alias("row"), F.col(probe_time).alias("time"),
    )
    right = versions.where(F.col(key).isNotNull()).select(
        bucket, text, F.explode(copies).alias("lane"), F.lit(True).alias("is_version"),
        F.unix_millis(version_time).alias("t"), F.when(~gone, _packed(values)).alias("row"), F.col(version_time).alias("time"),
    )
    resolved = left.unionByName(right).where("t IS NOT NULL").groupBy("bucket", "lane").transformWithStateInPandas(
        statefulProcessor=_AsOf(inclusive, block),
        outputStructType="t BIGINT, probe STRING, version STRING",
        outputMode="Append",
        timeMode="EventTime",
    )
    unpacked = resolved.select(
        F.timestamp_millis("t").alias(probe_time),
        F.from_json("probe", _schema(probes, carried)).alias("p"),
        F.from_json("version", _schema(versions, values)).alias("v"),
    )
    own = [F.col(c) if c == probe_time else F.col(f"p.{c}").alias(c) for c in probes.columns]
    return unpacked.select(*own, *[F.col(f"v.{c}").alias(c) for c in values])
