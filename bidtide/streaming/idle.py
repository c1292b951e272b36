"""Keeping joins moving while some of their inputs are quiet.

A query's watermark is the minimum over its inputs, so an input without events holds back every unmatched row of the others.
``with_heartbeats`` lends a quiet input the times of a busy one inside the query. ``IdleInputs`` knows each input's progress and
the clock: an input that has brought nothing for a while of processing time gets beats, whichever it is.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

HEARTBEAT_PREFIX = "__beat_"


def _latest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The latest time of a task's rows."""
    latest = None
    for batch in batches:
        found = pc.max(batch.column("ms")).as_py()
        latest = found if latest is None or found is not None and found > latest else latest
    if latest is not None:
        yield pa.RecordBatch.from_pydict({"ms": pa.array([latest], pa.int64())})


def _beat_rows(beats: DataFrame, key: str, time: str) -> DataFrame:
    """Beats (ms) as rows under keys that match nothing. The keys are not null: null keys would be filtered below the
    watermark and have no effect."""
    return beats.select(F.concat(F.lit(HEARTBEAT_PREFIX), F.col("ms")).alias(key), F.timestamp_millis("ms").alias(time))


def with_heartbeats(quiet: DataFrame, busy: DataFrame, key: str = "request_id", time: str = "ts") -> DataFrame:
    """Add to ``quiet`` the latest event time of every task of every micro-batch of ``busy``. Call this before setting the
    watermark."""
    beats = busy.select(F.unix_millis(time).alias("ms")).mapInArrow(_latest, "ms long")
    return quiet.unionByName(_beat_rows(beats, key, time), allowMissingColumns=True)


@dataclass
class _Input:
    latest: int | None = None  # event time, ms
    heard: float = 0.0  # processing time of its last rows
    beat: int | None = None  # the last beat


class IdleInputs(StreamingQueryListener):
    """Beats for the inputs of one query that have been quiet for ``timeout`` seconds of processing time.

    ``watched`` adds an input's beats to it; what the input itself brings is observed in every micro-batch. Once an input is idle,
    its beat is the least event time that the inputs still active have reached, so that they alone decide the watermark;
    when all are idle, it is the greatest that any has reached. An input that brings rows again counts as active at once.
    Beats travel through a folder of small files, a topic of their own, so they are replayed with the rest after a restart.

    Register with ``spark.streams.addListener`` before the query starts; ``close`` removes it."""

    def __init__(self, spark: SparkSession, folder: str, timeout: float = 5.0, clock: Callable[[], float] = time.monotonic):
        self.spark, self.folder, self.timeout, self.clock = spark, folder, timeout, clock
        self.inputs: dict[str, _Input] = {}
        self.query: str | None = None
        self._lock = threading.Lock()

    def watched(self, name: str, rows: DataFrame, key: str = "request_id", time: str = "ts") -> DataFrame:
        """``rows`` with the beats of the input ``name``. Call this before setting the watermark."""
        self.inputs[name] = _Input(heard=self.clock())
        path = f"{self.folder}/{name}"
        files, folder = self._hadoop(path)
        files.mkdirs(folder)
        beats = self.spark.readStream.schema("ms BIGINT").json(path)
        seen = rows.observe(name, F.max(F.unix_millis(time)).alias("latest"), F.count(F.lit(1)).alias("n"))
        return seen.unionByName(_beat_rows(beats, key, time), allowMissingColumns=True)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics
        if self.inputs.keys() <= seen.keys():
            self.query = str(event.progress.id)
            self.progressed({name: (seen[name]["n"], seen[name]["latest"]) for name in self.inputs})

    def onQueryIdle(self, event) -> None:
        if str(event.id) == self.query:
            self.check()

    def progressed(self, seen: dict[str, tuple[int, int | None]]) -> None:
        """Take note of a micro-batch: rows and latest event time by input."""
        with self._lock:
            for name, (n, latest) in seen.items():
                at = self.inputs[name]
                if n:
                    at.heard = self.clock()
                if latest is not None:
                    at.latest = max(latest, at.latest if at.latest is not None else latest)
        self.check()

    def due(self) -> dict[str, int]:
        """The beats to send now, by input."""
        now = self.clock()
        reached = {name: max(x for x in (at.latest, at.beat) if x is not None) for name, at in self.inputs.items() if (at.latest, at.beat) != (None, None)}
        idle = {name for name, at in self.inputs.items() if now - at.heard >= self.timeout}
        active = self.inputs.keys() - idle
        if not idle or not reached or not active <= reached.keys():
            return {}
        beat = min(reached[name] for name in active) if active else max(reached.values())
        return {name: beat for name in idle if name not in reached or reached[name] < beat}

    def check(self) -> None:
        """Send beats where they are due."""
        with self._lock:
            for name, beat in self.due().items():
                self.inputs[name].beat = beat
                self._write(name, beat)

    def _hadoop(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _write(self, name: str, beat: int) -> None:
        """One beat in a file that appears whole: hidden first, then renamed."""
        files, hidden = self._hadoop(f"{self.folder}/{name}/_{uuid.uuid4().hex}.json")
        out = files.create(hidden, False)
        out.write(bytearray(json.dumps({"ms": beat}).encode() + b"\n"))
        out.close()
        files.rename(hidden, self._hadoop(f"{self.folder}/{name}/beat-{beat:015d}.json")[1])
