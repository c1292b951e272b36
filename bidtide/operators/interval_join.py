"""Requests, wins and clicks joined into enriched impressions.

Both joins are equi-joins on ``(request_id, slice)`` with the exact interval as a residual condition. The slice
is a fixed stretch of event time: a win lies in one slice, and a request or click is copied to each slice in
which a partner may lie (for one-minute slices about 1.1 copies). One request id that holds a large share of the
rows is therefore spread over its slices instead of landing in one task, and because wins keep a
single slice in both joins they are shuffled once. The same functions serve batch and streaming inputs; with
streaming inputs every ``ts`` must carry a watermark, from which Spark derives how long state is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidtide.functions.rules import click_flag
from bidtide.functions.times import milliseconds, slice_start

# A win counts up to 5 s after its request, a click up to 11 s after its win, bounds included.
WIN_WINDOW_MS = 5_000
CLICK_WINDOW_MS = 11_000
SLICE_MS = 60_000


def _slices(first: Column, last: Column, slice_ms: int) -> Column:
    width = F.lit(slice_ms).cast("long")
    return F.explode(F.sequence(slice_start(first, slice_ms), slice_start(last, slice_ms), width))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_time: str,
    right_time: str,
    earliest_ms: int,
    latest_ms: int,
    how: str = "inner",
    slice_ms: int = SLICE_MS,
) -> DataFrame:
    """Pairs with equal keys and ``right_time`` in ``[left_time + earliest_ms, left_time + latest_ms]``.

    ``left`` keeps one slice per row, so ``how="left"`` is exact: each left row is in one place only.
    Column names of the two sides must not overlap.
    """
    l_t, r_t = F.col(left_time), F.col(right_time)
    sliced_left = left if "__slice" in left.columns else left.withColumn("__slice", slice_start(l_t, slice_ms))
    sliced_right = right.withColumn(
        "__r_slice", _slices(r_t - milliseconds(latest_ms), r_t - milliseconds(earliest_ms), slice_ms)
    )
    condition = (
        (F.col(left_key) == F.col(right_key))
        & (F.col("__slice") == F.col("__r_slice"))
        & (r_t >= l_t + milliseconds(earliest_ms))
        & (r_t <= l_t + milliseconds(latest_ms))
    )
    return sliced_left.join(sliced_right, condition, how).drop("__r_slice")


def match_wins(
    requests: DataFrame, wins: DataFrame, win_window_ms: int = WIN_WINDOW_MS, slice_ms: int = SLICE_MS
) -> DataFrame:
    """Wins with the request they answer: ``r.ts <= w.ts <= r.ts + window``."""
    w = wins.select("request_id", "campaign_id", "win_price", F.col("ts").alias("event_time"))
    r = requests.select(
        F.col("request_id").alias("r_request_id"), "user_id", "os", "site_category", F.col("ts").alias("r_ts")
    )
    return interval_join(
        w, r, "request_id", "r_request_id", "event_time", "r_ts", -win_window_ms, 0, "inner", slice_ms
    ).drop("r_request_id")


def attach_clicks(
    matched: DataFrame, clicks: DataFrame, click_window_ms: int = CLICK_WINDOW_MS, slice_ms: int = SLICE_MS
) -> DataFrame:
    """Left join of clicks within the window after the win. Every click gives its own row."""
    c = clicks.select(F.col("request_id").alias("c_request_id"), "user_action", F.col("ts").alias("c_ts"))
    return interval_join(
        matched, c, "request_id", "c_request_id", "event_time", "c_ts", 0, click_window_ms, "left", slice_ms
    ).drop("c_request_id")


def enrich(
    requests: DataFrame,
    wins: DataFrame,
    clicks: DataFrame,
    win_window_ms: int = WIN_WINDOW_MS,
    click_window_ms: int = CLICK_WINDOW_MS,
    slice_ms: int = SLICE_MS,
) -> DataFrame:
    """Enriched impressions from the three event streams, one row per (win, request, click) match."""
    joined = attach_clicks(match_wins(requests, wins, win_window_ms, slice_ms), clicks, click_window_ms, slice_ms)
    return joined.select(
        "request_id",
        "user_id",
        "os",
        "site_category",
        "campaign_id",
        "win_price",
        click_flag("user_action").alias("is_clicked"),
        "event_time",
    )
