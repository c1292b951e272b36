"""Batch queries over the provided tables: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Event times leave as time-zone-free timestamps and computed fractions are rounded, so that results can be
compared with another engine's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidtide.functions.encode import feature_index, feature_names, feature_table, fit_categories, one_hot, vocabulary
from bidtide.functions.rules import fare_category
from bidtide.functions.score import CATEGORICAL, LinearModel, ctr_score, serving_features
from bidtide.functions.times import serving_text
from bidtide.operators import kpis, rides
from bidtide.operators.asof import asof_join, latest_versions
from bidtide.operators.history import user_history
from bidtide.operators.interval_join import attach_clicks, enrich, interval_join, match_wins
from bidtide.operators.metrics import classification_report, roc_auc
from bidtide.operators.profiles import profile_changelog, user_profiles
from bidtide.operators.skew import HeavyKeys, find_heavy_keys
from bidtide.operators.training import (
    HISTORY_FEATURES,
    class_weights,
    coefficient_table,
    collapsed,
    dataset_summary,
    in_training_split,
    train_ctr,
    training_rows,
)
from bidtide.plans import datasets
from bidtide.schemas import PROFILE_FEATURES
from bidtide.session import prepare
from bidtide.sinks.topics import as_messages

# A fixed model for queries about scoring, so that their results can be written as SQL.
FIXED_MODEL = LinearModel(
    ["frac_tech", "frac_lifestyle", "os_ChromeOS", "os_Linux", "os_Windows",
     "site_category_Music", "site_category_Outdoors", "site_category_Tech"],
    [1.5, -0.75, 0.2, -0.1, 0.35, -0.4, 0.15, 0.6],
    -1.25,
)
HOUR_MS = 3_600_000
INGESTED_AT = 1_704_067_200_000


def _naive(time: str) -> Column:
    return F.col(time).cast("timestamp_ntz").alias(time)


def naive_times(df: DataFrame) -> DataFrame:
    return df.select(*[_naive(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes])


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


class Inputs:
    """The derived event streams of one scale factor, with the weight of its users looked up once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.events = datasets.events(spark, sf_dir)
        self.requests = datasets.requests(self.events)
        self.wins = datasets.wins(self.events)
        self.clicks = datasets.clicks(self.events)
        self.rides = datasets.rides(self.events)
        self.messages = datasets.ride_messages(self.events)

    def impressions(self) -> DataFrame:
        return enrich(self.requests, self.wins, self.clicks)

    def heavy_users(self) -> HeavyKeys:
        """Heavy users by requests. This reads one column; every other dataset has at most these rows per user."""
        return find_heavy_keys(self.requests, "user_id")


def win_request_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = Inputs(spark, sf_dir)
    return naive_times(
        match_wins(at.requests, at.wins).select(
            "request_id", "user_id", "os", "site_category", "campaign_id", "win_price", "event_time"
        )
    )


def win_click_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wins with their clicks, whether or not a request is known."""
    at = Inputs(spark, sf_dir)
    wins = at.wins.select("request_id", "campaign_id", "win_price", F.col("ts").alias("event_time"))
    joined = attach_clicks(wins, at.clicks)
    return naive_times(joined.select("request_id", "campaign_id", "event_time", "user_action", F.col("c_ts").alias("click_time")))


def enriched_impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive_times(Inputs(spark, sf_dir).impressions())


def impression_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(kpis.impression_kpis(Inputs(spark, sf_dir).impressions()), 6, "ctr", "avg_cpm")


def ctr_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(kpis.ctr_by_category(Inputs(spark, sf_dir).impressions()), 6, "ctr")


def recent_impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive_times(kpis.recent_impressions(Inputs(spark, sf_dir).impressions()))


def impression_serving_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Impressions in the serving layout, with the event time as text."""
    return Inputs(spark, sf_dir).impressions().withColumn("event_time", serving_text("event_time"))


def impression_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields read back from the JSON messages an append topic would carry."""
    value = as_messages(Inputs(spark, sf_dir).impressions()).select(F.from_json("value", "map<string,string>").alias("m"))
    names = ["request_id", "user_id", "campaign_id", "is_clicked", "event_time"]
    return value.select(*[F.col("m").getItem(n).alias(n) for n in names])


def events_view_click_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks up to an hour after a view by the same user."""
    events = Inputs(spark, sf_dir).events.withColumn("ts", F.col("ts").cast("timestamp"))
    views = events.where("event_type = 'view'").select(F.col("event_id").alias("view_id"), "user_id", F.col("ts").alias("view_ts"))
    clicks = events.where("event_type = 'click'").select(
        F.col("event_id").alias("click_id"), F.col("user_id").alias("click_user"), F.col("ts").alias("click_ts")
    )
    joined = interval_join(views, clicks, "user_id", "click_user", "view_ts", "click_ts", 0, HOUR_MS, slice_ms=HOUR_MS)
    return joined.select("view_id", "click_id", "user_id")


def ride_fare_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rides.categorised(Inputs(spark, sf_dir).rides)


def ride_fare_category_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strict message job over rides serialised as JSON."""
    at = Inputs(spark, sf_dir)
    return _ride_fields(rides.categorise_strict(as_messages(at.rides)))


def _ride_fields(messages: DataFrame) -> DataFrame:
    fields = "ride_id BIGINT, pickup STRING, fare DOUBLE, fare_category STRING, note STRUCT<k: ARRAY<STRING>>"
    ride = messages.select(F.from_json("value", fields).alias("r")).select("r.*")
    return ride.select("ride_id", "pickup", "fare", "fare_category", F.get("note.k", 1).alias("note_entry"))


def ride_fare_category_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = rides.categorise_tolerant(Inputs(spark, sf_dir).messages)
    return _ride_fields(good)


def ride_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = rides.categorise_tolerant(Inputs(spark, sf_dir).messages)
    return bad


def ride_bytes_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many byte messages end up in each fare category or are set aside for each reason."""
    good, bad = rides.categorise_tolerant(datasets.ride_bytes(Inputs(spark, sf_dir).events))
    category = F.from_json("value", "fare_category STRING")["fare_category"].alias("outcome")
    return good.select(category).unionByName(bad.select(F.col("reason").alias("outcome"))).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def ride_serving_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = rides.categorise_tolerant(Inputs(spark, sf_dir).messages)
    return rides.serving_rows(good, F.lit(INGESTED_AT))


def ride_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).rides.orderBy("ride_id").limit(5)


def ride_category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = Inputs(spark, sf_dir)
    return at.rides.groupBy(fare_category("fare").alias("fare_category")).agg(F.count(F.lit(1)).alias("n_rides"))


def fare_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rides.fare_totals(Inputs(spark, sf_dir).rides), 4, "total")


def fare_grand_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = rides.fare_totals(Inputs(spark, sf_dir).rides)
    return rounded(rides.grand_totals(totals), 4, "grand_total")


def current_user_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive_times(user_profiles(Inputs(spark, sf_dir).impressions()))


def _changelog(at: Inputs, heavy: HeavyKeys) -> DataFrame:
    return profile_changelog(at.impressions(), heavy=heavy)


def user_profile_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = Inputs(spark, sf_dir)
    return naive_times(_changelog(at, at.heavy_users()))


def latest_profile_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last version of each profile, read from the version history."""
    at = Inputs(spark, sf_dir)
    return naive_times(latest_versions(_changelog(at, at.heavy_users()), "user_id", "update_time"))


def _request_lookup(at: Inputs, inclusive: bool = True) -> DataFrame:
    heavy = at.heavy_users()
    probes = at.requests.select("request_id", "user_id", *CATEGORICAL, "ts")
    return asof_join(
        probes, _changelog(at, heavy), "user_id", "ts", "update_time", PROFILE_FEATURES,
        inclusive=inclusive, versions_by_key=True, heavy=heavy,
    )


def asof_requests_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive_times(_request_lookup(Inputs(spark, sf_dir)))


def _impression_lookup(at: Inputs, inclusive: bool) -> DataFrame:
    heavy = at.heavy_users()
    probes = at.impressions().select("request_id", "user_id", *CATEGORICAL, "is_clicked", "event_time")
    return asof_join(
        probes, _changelog(at, heavy), "user_id", "event_time", "update_time", PROFILE_FEATURES,
        inclusive=inclusive, versions_by_key=True, heavy=heavy,
    )


def asof_impressions_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive_times(_impression_lookup(Inputs(spark, sf_dir), True))


def asof_impressions_profiles_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive_times(_impression_lookup(Inputs(spark, sf_dir), False))


def user_history_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = Inputs(spark, sf_dir)
    history = user_history(at.impressions(), heavy=at.heavy_users())
    out = history.select(
        "request_id", "user_id", "event_time", "is_clicked",
        *[F.col(c).cast("long").alias(c) for c in ("user_total_views", "user_tech_views", "user_lifestyle_views")],
        "frac_tech", "frac_lifestyle",
    )
    return naive_times(rounded(out, 9, "frac_tech", "frac_lifestyle"))


def onehot_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary(Inputs(spark, sf_dir).requests, CATEGORICAL)


def onehot_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded training features of every impression; the vocabulary comes from the data."""
    at = Inputs(spark, sf_dir)
    impressions = at.impressions()
    features = feature_names(fit_categories(at.requests, CATEGORICAL))
    return impressions.select("request_id", "is_clicked", *one_hot(features, CATEGORICAL))


def serving_feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded features of every request against a frozen feature list."""
    looked_up = _request_lookup(Inputs(spark, sf_dir)).withColumns(serving_features())
    out = looked_up.select("request_id", *one_hot(FIXED_MODEL.features, CATEGORICAL))
    return rounded(out, 9, "frac_tech", "frac_lifestyle")


def _scored_requests(at: Inputs) -> DataFrame:
    looked_up = _request_lookup(at).withColumns(serving_features())
    return looked_up.select("request_id", ctr_score(FIXED_MODEL).alias("ctr_score"))


def scored_requests_fixed_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_scored_requests(Inputs(spark, sf_dir)), 9, "ctr_score")


def _scored_impressions(at: Inputs) -> DataFrame:
    """Labelled impressions of the held-out side, scored by the fixed model from earlier history only."""
    history = user_history(at.impressions(), heavy=at.heavy_users())
    held_out = history.where(~in_training_split("request_id"))
    score = F.round(ctr_score(FIXED_MODEL), 9)
    return held_out.select(
        F.col("is_clicked").alias("label"), score.alias("score"), F.when(score > 0.5, 1).otherwise(0).alias("prediction")
    )


def roc_auc_fixed_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(roc_auc(_scored_impressions(Inputs(spark, sf_dir))), 9, "roc_auc")


def classification_report_fixed_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = classification_report(_scored_impressions(Inputs(spark, sf_dir)))
    return rounded(report, 9, "precision", "recall", "f1_score")


def training_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(dataset_summary(Inputs(spark, sf_dir).impressions()), 9, "click_rate")


def impression_class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(class_weights(Inputs(spark, sf_dir).impressions()), 9, "class_weight")


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = Inputs(spark, sf_dir)
    side = F.when(in_training_split("request_id"), "train").otherwise("test").alias("side")
    return at.impressions().groupBy(side, "is_clicked").agg(F.count(F.lit(1)).alias("n_rows"))


def training_matrix_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the first model is fitted and tested on: counts per split side, features and label."""
    return collapsed(training_rows(Inputs(spark, sf_dir).impressions(), False))


def training_matrix_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = Inputs(spark, sf_dir)
    matrix = collapsed(training_rows(at.impressions(), True, heavy=at.heavy_users()))
    return rounded(matrix, 9, "frac_tech", "frac_lifestyle")


def model_feature_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ordered feature list of the second model."""
    return feature_table(feature_index(Inputs(spark, sf_dir).requests, CATEGORICAL, HISTORY_FEATURES), HISTORY_FEATURES)


def _model(spark: SparkSession, sf_dir: str, history: bool):
    at = Inputs(spark, sf_dir)
    return train_ctr(at.impressions(), history, heavy=at.heavy_users() if history else None)


def ctr_model_v1_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(coefficient_table(spark, _model(spark, sf_dir, False).model), 5, "coefficient")


def ctr_model_v2_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(coefficient_table(spark, _model(spark, sf_dir, True).model), 5, "coefficient")


def ctr_model_v1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_model(spark, sf_dir, False).report(), 9, "precision", "recall", "f1_score")


def ctr_model_v2_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicted = _model(spark, sf_dir, True).predictions()
    return rounded(roc_auc(rounded(predicted, 6, "score"), weight="n"), 4, "roc_auc")


QUERIES = {
    "enriched_impressions": enriched_impressions,
    "win_request_matches": win_request_matches,
    "win_click_matches": win_click_matches,
    "impression_kpis": impression_kpis,
    "ctr_by_category": ctr_by_category,
    "recent_impressions": recent_impressions,
    "impression_serving_rows": impression_serving_rows,
    "impression_messages": impression_messages,
    "events_view_click_interval": events_view_click_interval,
    "ride_fare_category": ride_fare_category,
    "ride_fare_category_strict": ride_fare_category_strict,
    "ride_fare_category_tolerant": ride_fare_category_tolerant,
    "ride_rejects": ride_rejects,
    "ride_bytes_outcomes": ride_bytes_outcomes,
    "ride_serving_rows": ride_serving_rows,
    "ride_sample": ride_sample,
    "ride_category_counts": ride_category_counts,
    "fare_totals": fare_totals,
    "fare_grand_totals": fare_grand_totals,
    "user_profiles": current_user_profiles,
    "user_profile_changelog": user_profile_changelog,
    "latest_profile_versions": latest_profile_versions,
    "asof_requests_profiles": asof_requests_profiles,
    "asof_impressions_profiles": asof_impressions_profiles,
    "asof_impressions_profiles_before": asof_impressions_profiles_before,
    "user_history_features": user_history_features,
    "onehot_vocabulary": onehot_vocabulary,
    "onehot_features": onehot_features,
    "serving_features": serving_feature_rows,
    "scored_requests_fixed_weights": scored_requests_fixed_weights,
    "roc_auc": roc_auc_fixed_weights,
    "classification_report": classification_report_fixed_weights,
    "training_guards": training_guards,
    "class_weights": impression_class_weights,
    "split_counts": split_counts,
    "training_matrix_v1": training_matrix_v1,
    "training_matrix_v2": training_matrix_v2,
    "model_feature_columns": model_feature_columns,
    "ctr_model_v1_coefficients": ctr_model_v1_coefficients,
    "ctr_model_v2_coefficients": ctr_model_v2_coefficients,
    "ctr_model_v1_report": ctr_model_v1_report,
    "ctr_model_v2_auc": ctr_model_v2_auc,
}
