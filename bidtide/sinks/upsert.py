"""Upsert tables: snapshots of the current rows, and the changed rows of every micro-batch since.

``batch_id=N`` folders hold changes as they come. ``compact`` folds all batches up to one into a snapshot, and
``drop_folded`` removes what newer snapshots have replaced. Readers merge the newest snapshot with the batches after it, so a
read costs the live keys and the recent changes, not the history.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from bidtide.operators.asof import latest_versions
from bidtide.sinks import commits
from bidtide.sources.tables import changelog_schema, read_changelog, read_table

_BATCH = "batch_id="


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Store one micro-batch as ``batch_id=N``, replacing an earlier attempt at the same batch."""
    out = rows if "deleted" in rows.columns else rows.withColumn("deleted", F.lit(False))
    out.write.mode("overwrite").parquet(f"{path}/{_BATCH}{batch_id}")


def upsert_to(path: str, fold: Callable[[SparkSession, int], None] | None = None) -> Callable[[DataFrame, int], None]:
    def write(rows: DataFrame, batch_id: int) -> None:
        write_batch(rows, path, batch_id)
        if fold:
            fold(rows.sparkSession, batch_id)

    return write


def to_upsert_table(
    rows: DataFrame, path: str, checkpoint: str, once: bool = False, mode: str = "update", trigger: str | None = None,
    *, compact_every: int | None = None, key: str | None = None, order: str = "batch_id",
) -> DataStreamWriter:
    """Write changed rows to an upsert table. With ``compact_every`` it is folded by ``key`` after every so many batches."""
    fold = None
    if compact_every:
        schema = T.StructType([f for f in rows.schema.fields if f.name != "deleted"])

        def fold(spark: SparkSession, batch_id: int) -> None:
            if batch_id % compact_every == compact_every - 1:
                # The batch itself may be repeated after a failure, so only those before it are folded.
                compact(spark, path, schema, key, order, through=batch_id - 1)
                drop_folded(spark, path)

    writer = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(upsert_to(path, fold))
    if once:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger) if trigger else writer


def _snapshots(spark: SparkSession, path: str) -> dict[int, str]:
    """Committed snapshots by the last batch they include."""
    return {int(name): folder for name, folder in commits.committed(spark, f"{path}/_snapshots").items()}


def _merged(
    spark: SparkSession, path: str, schema: T.StructType, key: str, order: str, through: int | None = None
) -> tuple[DataFrame, int]:
    """The last change of each key up to a batch, deletes included, and the batch of the snapshot it rests on (-1: none)."""
    usable = [n for n in _snapshots(spark, path) if through is None or n <= through]
    base = max(usable, default=-1)
    full = schema if order in (*schema.names, "batch_id") else T.StructType([*schema.fields, T.StructField(order, T.LongType())])
    tail = read_changelog(spark, path, full).where(F.col("batch_id") > base)
    if through is not None:
        tail = tail.where(F.col("batch_id") <= through)
    if base >= 0:
        folded = read_table(spark, _snapshots(spark, path)[base], full).select("*", F.lit(False).alias("deleted"), F.lit(base).cast("long").alias("batch_id"))
        tail = folded.unionByName(tail)
    if order == "batch_id":
        return latest_versions(tail, key, sequence="batch_id"), base
    # Changes of a later batch are later, whatever they carry.
    ranked = tail.withColumn("__order", F.struct("batch_id", order))
    return latest_versions(ranked, key, sequence="__order").drop("__order"), base


def current_rows(
    spark: SparkSession, path: str, schema: T.StructType, key: str, order: str = "batch_id", through: int | None = None
) -> DataFrame:
    """The latest row of each key; keys whose last change was a delete are gone. ``order`` is a column that grows
    with each change of a key inside a batch; it may be left out where a batch holds at most one row per key. ``through`` looks
    at the table as of a batch."""
    latest, _ = _merged(spark, path, schema, key, order, through)
    return latest.where(~F.coalesce("deleted", F.lit(False))).select(*schema.names)


def batches(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the stored batches."""
    return sorted(int(name.removeprefix(_BATCH)) for name in commits.subfolders(spark, path) if name.startswith(_BATCH))


def compact(
    spark: SparkSession, path: str, schema: T.StructType, key: str, order: str = "batch_id", through: int | None = None
) -> int | None:
    """Fold all batches (up to ``through``) into a snapshot of the live rows; the batch it includes, or None without any."""
    known = [n for n in batches(spark, path) if through is None or n <= through]
    done = max(_snapshots(spark, path), default=-1)
    if not known or known[-1] <= done:
        return done if done >= 0 else None
    latest, _ = _merged(spark, path, schema, key, order, known[-1])
    live = latest.where(~F.coalesce("deleted", F.lit(False))).drop("deleted", "batch_id")
    commits.commit(live, f"{path}/_snapshots", f"{known[-1]:012d}")
    return known[-1]


def drop_folded(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove snapshots but the newest ``keep``, and the batches that the oldest one kept includes. Readers of these can
    go on as long as theirs is among the kept."""
    numbers = sorted(_snapshots(spark, path))
    for number in numbers[:-keep]:
        commits.forget(spark, f"{path}/_snapshots", f"{number:012d}")
    if len(numbers) >= keep:
        for batch in batches(spark, path):
            if batch <= numbers[-keep]:
                commits.remove(spark, f"{path}/{_BATCH}{batch}")


__all__ = ["batches", "changelog_schema", "compact", "current_rows", "drop_folded", "to_upsert_table", "upsert_to", "write_batch"]
