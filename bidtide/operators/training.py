"""Batch training of the CTR models.

A logistic fit depends on the data only through how often each combination of features and label occurs, so
the impressions are first collapsed to one weighted row per combination and split side. That takes
one map-side combined aggregation; the many passes of the optimiser and of the evaluation then run over the
collapsed table, which for purely categorical features has a few dozen rows whatever the input size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bidtide.functions.encode import feature_names, fit_categories, sparse_features, split_feature
from bidtide.functions.score import CATEGORICAL, LinearModel
from bidtide.operators.history import user_history
from bidtide.operators.metrics import classification_report, roc_auc
from bidtide.operators.skew import DEFAULT_POLICY, HeavyKeys, SkewPolicy
from bidtide.session import written

# 70/30 split with seed 42, inverse regularisation 1, at most 1000 iterations.
TRAIN_TENTHS = 7
SPLIT_SEED = 42
INVERSE_REGULARISATION = 1.0
MAX_ITERATIONS = 1000

HISTORY_FEATURES = ("frac_tech", "frac_lifestyle")


class NotEnoughData(ValueError):
    """The training data is empty or holds one class only."""


def in_training_split(request_id: Column | str, tenths: int = TRAIN_TENTHS, seed: int = SPLIT_SEED) -> Column:
    """Whether a request falls on the training side: a hash of its id, so independent of partitioning."""
    request_id = F.col(request_id) if isinstance(request_id, str) else request_id
    digest = F.md5(F.concat(request_id, F.lit(f":{seed}")))
    return F.pmod(F.conv(F.substr(digest, F.lit(1), F.lit(8)), 16, 10).cast("long"), F.lit(10)) < tenths


def dataset_summary(impressions: DataFrame) -> DataFrame:
    """Rows, clicks and click rate: what the guards look at before training."""
    return impressions.agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("is_clicked").alias("clicks"), F.avg("is_clicked").alias("click_rate")
    )


def class_weights(rows: DataFrame, label: str = "is_clicked", weight: str | None = None) -> DataFrame:
    """Balanced class weights: all rows divided by (number of classes times rows of the class)."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = rows.groupBy(F.col(label).alias("label")).agg(n.alias("n_rows"))
    # A window over one row per class.
    classes = Window.partitionBy()
    share = F.sum("n_rows").over(classes) / (F.count(F.lit(1)).over(classes) * F.col("n_rows"))
    return counts.select("label", "n_rows", share.alias("class_weight"))


def training_rows(
    impressions: DataFrame,
    history: bool,
    *,
    max_rows: int | None = None,
    heavy: HeavyKeys | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Label, categorical features and, with ``history``, the shares of earlier views. ``max_rows`` keeps the
    first impressions by time; by default all are used."""
    rows = impressions
    if max_rows is not None:
        rows = rows.orderBy("event_time", "request_id").limit(max_rows)
    if history:
        rows = user_history(rows, heavy=heavy, policy=policy)
    return rows.select("request_id", *CATEGORICAL, *(HISTORY_FEATURES if history else ()), F.col("is_clicked").alias("label"))


def collapsed(rows: DataFrame) -> DataFrame:
    """One row per split side, feature combination and label, with its count ``n``."""
    features = [c for c in rows.columns if c != "request_id"]
    return rows.groupBy(in_training_split("request_id").alias("train"), *features).agg(F.count(F.lit(1)).alias("n"))


@dataclass
class TrainedModel:
    model: LinearModel
    test_rows: DataFrame

    def predictions(self) -> DataFrame:
        """The held-out combinations with click probability and predicted label."""
        score = self.model.probability()
        return self.test_rows.withColumn("score", score).withColumn(
            "prediction", F.when(F.col("score") > 0.5, 1).otherwise(0)
        )

    def auc(self) -> DataFrame:
        return roc_auc(self.predictions(), weight="n")

    def report(self) -> DataFrame:
        return classification_report(self.predictions(), weight="n")


def fit_logistic(
    weighted_rows: DataFrame,
    features: Sequence[str],
    *,
    inverse_regularisation: float = INVERSE_REGULARISATION,
    max_iterations: int = MAX_ITERATIONS,
) -> LinearModel:
    """L2-regularised logistic regression with balanced classes on rows (features, ``label``, ``n``).

    Balanced weights sum to the row count, so Spark's averaged objective matches the summed one with
    ``regParam = 1 / (C * rows)``. The intercept is not penalised.
    """
    counts = {r["label"]: r for r in class_weights(weighted_rows, "label", "n").collect()}
    if set(counts) != {0, 1}:
        raise NotEnoughData("training needs rows of both classes")
    examples = sum(r["n_rows"] for r in counts.values())
    balance = F.when(F.col("label") == 1, counts[1]["class_weight"]).otherwise(counts[0]["class_weight"])
    rows = weighted_rows.withColumns({"label": F.col("label").cast("double"), "weight": F.col("n") * balance})
    pairs = [split_feature(f, CATEGORICAL) for f in features]
    numeric = [f for f, pair in zip(features, pairs) if pair is None]
    # Places by column, as the vectors have them; weights are put back in the order of ``features``.
    ordered = sorted((pair for pair in pairs if pair), key=lambda pair: CATEGORICAL.index(pair[0]))
    places = [(column, value, len(numeric) + i) for i, (column, value) in enumerate(ordered)]
    index = rows.sparkSession.createDataFrame(places, "column_name STRING, value STRING, position INT")
    vectors = sparse_features(rows, index, CATEGORICAL, numeric)
    fitted = LogisticRegression(
        weightCol="weight", regParam=1.0 / (inverse_regularisation * examples), elasticNetParam=0.0,
        standardization=False, maxIter=max_iterations, tol=1e-9,
    ).fit(vectors.select("label", "weight", "features"))
    names = [*numeric, *["_".join(pair) for pair in ordered]]
    weights = dict(zip(names, (float(w) for w in fitted.coefficients)))
    return LinearModel(list(features), [weights[f] for f in features], float(fitted.intercept), examples=examples)


def train_ctr(
    impressions: DataFrame,
    history: bool = True,
    *,
    max_rows: int | None = None,
    heavy: HeavyKeys | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> TrainedModel:
    """Fit a CTR model: on OS and site category, with ``history`` also on the user's shares of earlier views."""
    rows = written(
        collapsed(training_rows(impressions, history, max_rows=max_rows, heavy=heavy, policy=policy)), "training"
    )
    found = rows.agg(F.sum("n").alias("n"), F.sum(F.col("label") * F.col("n")).alias("clicks")).first()
    if not found["n"] or not found["clicks"]:
        raise NotEnoughData("no impressions with clicks to train on")
    features = feature_names(fit_categories(rows, CATEGORICAL), HISTORY_FEATURES if history else ())
    model = fit_logistic(rows.where("train"), features)
    return TrainedModel(model, rows.where("not train"))


def coefficient_table(spark: SparkSession, model: LinearModel) -> DataFrame:
    """Features with their coefficients, largest first."""
    return spark.createDataFrame(
        list(zip(model.features, model.weights)), "feature STRING, coefficient DOUBLE"
    ).orderBy(F.desc("coefficient"), "feature")
