"""Per-user behaviour profiles, current and as a history of versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidtide.functions.rules import count_when, sum_when
from bidtide.operators.skew import DEFAULT_POLICY, HeavyKeys, SkewPolicy, find_heavy_keys, running_sums
from bidtide.schemas import PROFILE_COUNTERS, PROFILES

# The two site categories a profile counts.
TECH, LIFESTYLE = "Tech", "Lifestyle"


def _counters() -> dict[str, Column]:
    category = F.col("site_category")
    return {
        "total_views": F.count(F.lit(1)),
        "tech_views": count_when(category == TECH),
        "tech_clicks": sum_when(category == TECH, "is_clicked"),
        "lifestyle_views": count_when(category == LIFESTYLE),
        "lifestyle_clicks": sum_when(category == LIFESTYLE, "is_clicked"),
    }


def _aggregates() -> list[Column]:
    return [expr.cast("long").alias(name) for name, expr in _counters().items()]


def user_profiles(impressions: DataFrame) -> DataFrame:
    """The current profile of each user; on a stream, the running one (update mode)."""
    return impressions.groupBy("user_id").agg(*_aggregates(), F.max("event_time").alias("update_time")).select(
        *PROFILES.names
    )


def profile_changelog(
    impressions: DataFrame, *, heavy: HeavyKeys | None = None, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Every version of every profile: one row per user and event time, counting all events up to then.

    Without heavy users one shuffle by user serves both the per-time totals and the running sum. With heavy
    users the totals are combined map-side first, so events at one instant collapse before they move.
    """
    heavy = find_heavy_keys(impressions, "user_id", policy) if heavy is None else heavy
    rows = impressions.select("user_id", "site_category", "is_clicked", "event_time")
    if not heavy:
        rows = rows.repartition("user_id")
    steps = rows.groupBy("user_id", "event_time").agg(*_aggregates())
    sums = {name: F.col(name) for name in PROFILE_COUNTERS}
    running = running_sums(steps, "user_id", ["event_time"], sums, heavy=heavy)
    return running.withColumnRenamed("event_time", "update_time").select(*PROFILES.names)
