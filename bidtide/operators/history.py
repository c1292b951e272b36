"""What was known about a user before each impression."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidtide.functions.rules import training_share
from bidtide.operators.profiles import LIFESTYLE, TECH
from bidtide.operators.skew import DEFAULT_POLICY, HeavyKeys, SkewPolicy, running_sums


def user_history(
    impressions: DataFrame, *, heavy: HeavyKeys | None = None, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Counts of the user's earlier views (all, Tech, Lifestyle), excluding the current one, and their shares.

    History runs by event time; equal times are ordered by request id to make the result repeatable.
    """
    category = F.col("site_category")
    sums = {
        "user_total_views": F.lit(1),
        "user_tech_views": F.when(category == TECH, 1).otherwise(0),
        "user_lifestyle_views": F.when(category == LIFESTYLE, 1).otherwise(0),
    }
    counted = running_sums(
        impressions, "user_id", ["event_time", "request_id"], sums, include_current=False, heavy=heavy, policy=policy
    )
    total = F.col("user_total_views")
    return counted.withColumns(
        {
            "frac_tech": training_share(F.col("user_tech_views"), total),
            "frac_lifestyle": training_share(F.col("user_lifestyle_views"), total),
        }
    )
