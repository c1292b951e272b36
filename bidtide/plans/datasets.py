"""Requests, wins, clicks and rides derived from the provided ``events`` table.

Every function is a narrow projection of ``events``, so it reads only the columns it needs and works the same
on a batch frame and on a stream of the table's files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidtide.functions.times import SERVING_TIME_FORMAT, from_millis

EVENTS = (
    T.StructType()
    .add("event_id", T.LongType())
    .add("ts", T.TimestampNTZType())
    .add("user_id", T.LongType())
    .add("event_type", T.StringType())
    .add("value", T.DoubleType())
    .add("props", T.StringType())
)

#: Sample operating systems by user number.
SYSTEMS = ["Windows", "Linux", "Android", "ChromeOS"]
#: Sample sites by event number: id, domain, category. Profiles count the categories Tech and Lifestyle.
SITES = [
    ("site-a", "slow-kitchen.example", "Lifestyle"),
    ("site-b", "byte-garden.example", "Tech"),
    ("site-c", "night-records.example", "Music"),
    ("site-d", "circuit-letters.example", "Tech"),
    ("site-e", "trail-and-tent.example", "Outdoors"),
]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a stream, whether it is one file or a folder of part files; a missing table is an error."""
    # A pattern, as a stream's plain path must be a folder.
    return spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/events.parque[t]")


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _millis() -> Column:
    return F.unix_millis(F.col("ts").cast("timestamp"))


def _text_id() -> Column:
    return F.col("event_id").cast("string")


def requests(events: DataFrame) -> DataFrame:
    event, user = F.col("event_id"), F.col("user_id")
    return events.select(
        _text_id().alias("request_id"),
        _millis().alias("timestamp_ts"),
        F.concat(F.lit("u_"), user).alias("user_id"),
        F.concat(F.lit("10.7."), user % 200, F.lit("."), user % 250 + 1).alias("ip_address"),
        _pick(SYSTEMS, user % 4).alias("os"),
        _pick([s[1] for s in SITES], event % len(SITES)).alias("site_domain"),
        _pick([s[2] for s in SITES], event % len(SITES)).alias("site_category"),
        _pick([s[0] for s in SITES], event % len(SITES)).alias("publisher_id"),
    ).withColumn("ts", from_millis("timestamp_ts"))


def _win_millis() -> Column:
    return _millis() + F.col("event_id") * 37 % 6000


def wins(events: DataFrame) -> DataFrame:
    event = F.col("event_id")
    return events.where(event % 10 < 6).select(
        _text_id().alias("request_id"),
        F.concat(F.lit("a_"), event).alias("auction_id"),
        _win_millis().alias("timestamp_ts"),
        F.concat(F.lit("camp_"), event % 7).alias("campaign_id"),
        F.concat(F.lit("creat_"), event % 11).alias("creative_id"),
        F.col("value").alias("bid_price"),
        F.col("value").alias("win_price"),
    ).withColumn("ts", from_millis("timestamp_ts"))


def clicks(events: DataFrame) -> DataFrame:
    """A click per third win, and a second one a millisecond later per thirtieth."""
    event = F.col("event_id")
    extra = F.when(event % 30 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return events.where((event % 10 < 6) & (event % 3 == 0)).select(
        _text_id().alias("request_id"),
        (_win_millis() + event * 53 % 13000).alias("__at"),
        F.explode(extra).alias("__extra"),
    ).select(
        "request_id",
        (F.col("__at") + F.col("__extra")).alias("timestamp_ts"),
        F.lit("click").alias("user_action"),
    ).withColumn("ts", from_millis("timestamp_ts"))


def rides(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").cast("int").alias("ride_id"), F.col("event_type").alias("pickup"), F.col("value").alias("fare")
    )


def ride_bytes(events: DataFrame) -> DataFrame:
    """Ride messages as bytes, every fiftieth of them with one that is not UTF-8."""
    text = _ride_text().cast("binary")
    broken = F.concat(text, F.unhex(F.lit("FF")))
    return events.select(F.when(F.col("event_id") % 50 == 5, broken).otherwise(text).alias("value"))


def ride_messages(events: DataFrame) -> DataFrame:
    return events.select(_ride_text().alias("value"))


def _ride_text() -> Column:
    """Ride JSON as text, some of it broken, with a null, missing or textual fare, or with an extra key."""
    kind = F.col("event_id") % 50
    head = F.concat(F.lit('{"ride_id":'), F.col("event_id"), F.lit(',"pickup":"'), F.col("event_type"), F.lit('"'))
    fare = F.concat(F.lit(',"fare":'), F.col("value"))
    tail = (
        F.when(kind == 0, fare)
        .when(kind == 1, F.lit(',"fare":null}'))
        .when(kind == 2, F.lit("}"))
        .when(kind == 3, F.concat(F.lit(',"fare":"'), F.col("value"), F.lit('"}')))
        .when(kind == 4, F.concat(fare, F.lit(',"note":{"k":[1,"x"]}}')))
        .otherwise(F.concat(fare, F.lit("}")))
    )
    return F.concat(head, tail)


def profile_upserts(events: DataFrame) -> DataFrame:
    """An upsert topic of profiles, keyed by user: every third event inserts or replaces its user's profile, and every twelfth
    deletes it. Columns key, value, timestamp and offset."""
    event = F.col("event_id")
    when = from_millis("timestamp_ts")
    rows = events.where(event % 3 == 0).select(
        F.concat(F.lit("u_"), "user_id").alias("user_id"), event.alias("total_views"), (event % 7).alias("tech_views"),
        (event % 5).alias("lifestyle_views"), event.alias("offset"), (event % 12 == 9).alias("deleted"), _millis().alias("timestamp_ts"),
    ).withColumn("update_time", when)
    value = F.to_json(F.struct("total_views", "tech_views", "lifestyle_views", "update_time"), {"timestampFormat": SERVING_TIME_FORMAT})
    return rows.select(
        F.to_json(F.struct("user_id")).alias("key"), F.when(~F.col("deleted"), value).alias("value"), F.col("update_time").alias("timestamp"), "offset"
    )
