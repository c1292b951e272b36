"""Column layouts of every dataset the jobs read or write."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_S, _L, _I, _D, _TS = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.TimestampType()

REQUESTS = _struct(
    request_id=_S, timestamp_ts=_L, user_id=_S, ip_address=_S, os=_S,
    site_domain=_S, site_category=_S, publisher_id=_S,
)
# The scorer reads a narrower view of the same topic.
REQUESTS_FOR_SCORING = _struct(request_id=_S, timestamp_ts=_L, user_id=_S, os=_S, site_category=_S)

WINS = _struct(
    request_id=_S, auction_id=_S, timestamp_ts=_L, campaign_id=_S,
    creative_id=_S, bid_price=_D, win_price=_D,
)
CLICKS = _struct(request_id=_S, timestamp_ts=_L, user_action=_S)

IMPRESSIONS = _struct(
    request_id=_S, user_id=_S, os=_S, site_category=_S, campaign_id=_S,
    win_price=_D, is_clicked=_I, event_time=_TS,
)
IMPRESSIONS_FOR_LEARNING = _struct(user_id=_S, os=_S, site_category=_S, is_clicked=_I, event_time=_TS)
IMPRESSIONS_FOR_PROFILES = _struct(user_id=_S, site_category=_S, is_clicked=_I, event_time=_TS)

PROFILES = _struct(
    user_id=_S, total_views=_L, tech_views=_L, tech_clicks=_L,
    lifestyle_views=_L, lifestyle_clicks=_L, update_time=_TS,
)
PROFILE_COUNTERS = ["total_views", "tech_views", "tech_clicks", "lifestyle_views", "lifestyle_clicks"]
# What the as-of readers need from a profile version.
PROFILE_FEATURES = ["total_views", "tech_views", "lifestyle_views"]

SCORED_REQUESTS = _struct(request_id=_S, ctr_score=_D)
MODEL_UPDATES = _struct(status=_S)

RIDES = _struct(ride_id=_I, pickup=_S, fare=_D)
RIDES_SERVING = _struct(ride_id=_S, pickup=_S, fare_category=_S, fare=_D, ingestion_time=_L)
FARE_TOTALS = _struct(pickup=_S, total=_D)

MODEL_WEIGHTS = _struct(
    version=_L, source=_S, position=_I, feature=_S, weight=_D, n_features=_I, examples=_L,
)
