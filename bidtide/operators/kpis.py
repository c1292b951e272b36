"""Campaign reports over impressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ctr() -> Column:
    return F.try_divide(F.sum("is_clicked"), F.count(F.lit(1)))


def impression_kpis(impressions: DataFrame) -> DataFrame:
    """Impressions, clicks, click rate and mean win price; rates are null on an empty table."""
    return impressions.agg(
        F.count(F.lit(1)).alias("impressions"),
        F.sum("is_clicked").alias("clicks"),
        _ctr().alias("ctr"),
        F.avg("win_price").alias("avg_cpm"),
    )


def ctr_by_category(impressions: DataFrame) -> DataFrame:
    """Click rate per site category, best first. All categories are returned."""
    return impressions.groupBy("site_category").agg(_ctr().alias("ctr")).orderBy(F.desc("ctr"), "site_category")


def recent_impressions(impressions: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` latest impressions; equal times are ordered by request id and click flag."""
    return (
        impressions.orderBy(F.desc("event_time"), "request_id", F.desc("is_clicked"))
        .limit(n)
        .select("event_time", "user_id", "site_category", "win_price", "is_clicked")
    )
