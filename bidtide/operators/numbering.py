"""Consecutive numbers over a whole table, without a window that gathers it."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidtide.session import written


def numbered(df: DataFrame, order: Sequence[str], name: str = "number") -> DataFrame:
    """Add the position of each row, from 0, in the order of the columns ``order``; equal rows in any order.

    Rows are range-partitioned and counted where they lie. What reaches the driver is one count for each partition, and what
    is broadcast one offset."""
    place, part = "__numbered_place", "__numbered_part"
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = written(ranged.withColumns({place: F.monotonically_increasing_id(), part: F.spark_partition_id()}), "numbered")
    counts = sorted((r[part], r["n"]) for r in rows.groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect())
    offsets = [0, *accumulate(n for _, n in counts)]
    before = df.sparkSession.createDataFrame([(p, offset) for (p, _), offset in zip(counts, offsets)], f"{part} INT, __numbered_before LONG")
    position = F.col("__numbered_before") + F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(F.broadcast(before), part).withColumn(name, position).drop(place, part, "__numbered_before")
