"""Ordered scans over keys of any weight.

A window partitioned by user puts all rows of one user in one task. When a single key may hold a large share
of the data that task never ends, so such data is cut into segments of a bounded number of rows:

1. ``find_heavy_keys`` counts the rows of the heaviest key: one narrow scan with map-side counts.
2. ``segmented`` range-partitions the rows by key and order into as many partitions as the rows need. A row's segment is
   its partition, so a key of any weight is spread over consecutive segments, and light keys share one.
3. The scan runs per (key, segment); what earlier segments contribute is one small row per segment of the keys that
   span several, at most two per partition.

Without a heavy key the ordinary window plan with one shuffle is taken. Results don't depend on the choice.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from bidtide.session import written

SEGMENT = "__segment"


@dataclass(frozen=True)
class SkewPolicy:
    """``rows_per_task`` bounds the rows one task should hold of a key, however many rows there are in all."""

    rows_per_task: int = 1_000_000
    #: Segments up to which their totals (at most two rows each) are broadcast; beyond, they are shuffled.
    broadcast_segments: int = 100_000


DEFAULT_POLICY = SkewPolicy()


@dataclass(frozen=True)
class HeavyKeys:
    """Rows in all and of the heaviest key of one column (``None``: the whole frame is one key).

    They may be found once on one dataset and used for others with the same key and about as many rows at most.
    """

    column: str | None
    total: int = 0
    heaviest: int = 0
    policy: SkewPolicy = DEFAULT_POLICY

    def __bool__(self) -> bool:
        return self.heaviest > self.policy.rows_per_task

    @property
    def keys(self) -> list[str]:
        return [] if self.column is None else [self.column]

    @property
    def pieces(self) -> int:
        """Partitions, twice as many as needed since sampled bounds are not exact."""
        return max(2, math.ceil(2 * self.total / self.policy.rows_per_task))

    def bounded(self, totals: DataFrame) -> DataFrame:
        """A table of a few rows per segment, to be broadcast while that is small."""
        return F.broadcast(totals) if self.pieces <= self.policy.broadcast_segments else totals


def find_heavy_keys(df: DataFrame, column: str | None, policy: SkewPolicy = DEFAULT_POLICY) -> HeavyKeys:
    """The exact weight of the heaviest key, the null key included."""
    if column is None:
        total = df.count()
        return HeavyKeys(None, total, total, policy)
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    got = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.coalesce(F.max("n"), F.lit(0)).alias("heaviest")).first()
    return HeavyKeys(column, got["total"], got["heaviest"], policy)


def segmented(df: DataFrame, heavy: HeavyKeys, order: Sequence[str]) -> DataFrame:
    """``df`` with the segment number of every row, written once. Rows equal in key and ``order`` share a segment, and segments of a
    key follow its order."""
    if not heavy:
        return df.withColumn(SEGMENT, F.lit(0))
    ranged = df.repartitionByRange(heavy.pieces, *heavy.keys, *order)
    return written(ranged.withColumn(SEGMENT, F.spark_partition_id()), "segments")


def with_earlier_segments(
    rows: DataFrame, heavy: HeavyKeys, segment_totals: DataFrame, carry: Mapping[str, Column]
) -> DataFrame:
    """Join to each row what earlier segments of its key contribute. ``segment_totals`` has one row per key and segment; keys in a
    single segment have nothing to carry and drop out."""
    keys = [*heavy.keys, SEGMENT]
    by_key = Window.partitionBy(*heavy.keys).orderBy(SEGMENT)
    before = by_key.rowsBetween(Window.unboundedPreceding, -1)
    carried = segment_totals.select(
        *[F.col(k).alias("__c_" + k) for k in keys],
        F.row_number().over(by_key).alias("__nth"),
        *[c.over(before).alias(n) for n, c in carry.items()],
    )
    carried = carried.where("__nth > 1").drop("__nth")
    same = F.col(SEGMENT) == F.col("__c_" + SEGMENT)
    for k in heavy.keys:
        same = same & F.col(k).eqNullSafe(F.col("__c_" + k))
    return rows.join(heavy.bounded(carried), same, "left").drop(*["__c_" + k for k in keys])


def _window(heavy: HeavyKeys) -> WindowSpec:
    return Window.partitionBy(*heavy.keys, *([SEGMENT] if heavy else []))


def running_sums(
    df: DataFrame,
    key: str | None,
    order: Sequence[str],
    sums: Mapping[str, Column],
    *,
    include_current: bool = True,
    peers: bool = False,
    heavy: HeavyKeys | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Add a running total per key for each expression in ``sums``.

    ``include_current=False`` totals only rows before the current one; ``peers=True`` also counts all rows
    equal to the current one in ``order``.
    """
    heavy = find_heavy_keys(df, key, policy) if heavy is None else heavy
    rows = segmented(df, heavy, order) if heavy else df
    w = _window(heavy).orderBy(*order)
    if peers:
        frame = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    else:
        frame = w.rowsBetween(Window.unboundedPreceding, 0 if include_current else -1)
    zero = F.lit(0)
    local = rows.withColumns({name: F.coalesce(F.sum(expr).over(frame), zero) for name, expr in sums.items()})
    if not heavy:
        return local
    totals = rows.groupBy(*heavy.keys, SEGMENT).agg(*[F.sum(e).alias(n) for n, e in sums.items()])
    carry = {"__before_" + n: F.sum(n) for n in sums}
    out = with_earlier_segments(local, heavy, totals, carry)
    out = out.withColumns({n: F.col(n) + F.coalesce(F.col("__before_" + n), zero) for n in sums})
    return out.drop(SEGMENT, *carry)
