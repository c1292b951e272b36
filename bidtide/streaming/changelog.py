"""Every version of every profile, as a stream.

An update-mode aggregation emits one row per user and micro-batch. Readers that look profiles up as of an event
time need the versions in between. A micro-batch is therefore summed like a batch: prefix sums over its own events, which cut
a user of any weight over tasks, on top of the totals that earlier micro-batches have left in an upsert table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from bidtide.operators.asof import latest_versions
from bidtide.operators.profiles import profile_changelog
from bidtide.operators.skew import DEFAULT_POLICY, SkewPolicy
from bidtide.schemas import IMPRESSIONS_FOR_PROFILES, PROFILE_COUNTERS, PROFILES
from bidtide.session import written
from bidtide.sinks.upsert import compact, current_rows, drop_folded, write_batch

#: Totals carry the user as text with a mark, so that rows without a user have a total as well.
_TOTALS = T.StructType([T.StructField("__user", T.StringType()), *PROFILES.fields])
#: Micro-batches after which the totals are folded into a snapshot.
COMPACT_EVERY = 20


def _user() -> Column:
    return F.coalesce(F.concat(F.lit("="), "user_id"), F.lit(""))


def changelog_batch(impressions: DataFrame, before: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Profile versions of one micro-batch on top of the totals ``before`` it.

    ``update_time`` is the latest event time so far: an event that comes in a later micro-batch than younger ones counts from
    the time already reached. Of versions with equal time the one with more ``total_views`` is the later."""
    carried = before.select("__user", *[F.col(c).alias(f"__{c}") for c in PROFILE_COUNTERS], F.col("update_time").alias("__reached"))
    # One row for each user and instant meets the totals, however many events there are.
    marked = impressions.where(F.col("event_time").isNotNull()).withColumn("__user", _user())
    reached = carried.select("__user", "__reached")
    clipped = marked.join(reached, "__user", "left").withColumn("event_time", F.greatest("event_time", "__reached"))
    versions = profile_changelog(clipped.select(*IMPRESSIONS_FOR_PROFILES.names), policy=policy).withColumn("__user", _user())
    joined = versions.join(carried.drop("__reached"), "__user", "left")
    sums = {c: F.col(c) + F.coalesce(f"__{c}", F.lit(0)) for c in PROFILE_COUNTERS}
    return joined.withColumns(sums).select("__user", *PROFILES.names)


def changelog_writer(path: str, totals: str, policy: SkewPolicy = DEFAULT_POLICY) -> Callable[[DataFrame, int], None]:
    """The work of a micro-batch: versions to ``path``, and the totals that it leaves to ``totals``. Repeating a micro-batch
    gives the same, as it starts from the totals of those before it."""

    def write(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        events = written(rows.select(*IMPRESSIONS_FOR_PROFILES.names), "changelog_events")
        before = current_rows(spark, totals, _TOTALS, "__user", through=batch_id - 1)
        # The users of the micro-batch only; a user's total is read once.
        there = events.select(_user().alias("__user")).distinct()
        versions = written(changelog_batch(events, before.join(there, "__user", "left_semi"), policy), "changelog_versions")
        write_batch(versions.drop("__user"), path, batch_id)
        write_batch(latest_versions(versions, "__user", sequence="total_views"), totals, batch_id)
        if batch_id % COMPACT_EVERY == COMPACT_EVERY - 1:
            compact(spark, totals, _TOTALS, "__user", through=batch_id - 1)
            drop_folded(spark, totals)

    return write


def changelog_stream(
    impressions: DataFrame, path: str, checkpoint: str, once: bool = False, policy: SkewPolicy = DEFAULT_POLICY
) -> DataStreamWriter:
    """Keep every version of every profile of a stream of impressions below ``path``."""
    # Totals lie beside the checkpoint: they belong to the query's progress, not to its readers.
    work = changelog_writer(path, f"{checkpoint}/totals", policy)
    writer = impressions.writeStream.outputMode("append").option("checkpointLocation", f"{checkpoint}/progress").foreachBatch(work)
    return writer.trigger(availableNow=True) if once else writer
