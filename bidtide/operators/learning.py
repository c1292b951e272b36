"""Online logistic regression: a model that is updated by mini-batches of a fixed number of examples, in order of time.

Examples are numbered where they lie, and mini-batches cut from the numbers, so weights don't depend on how a stream was cut
into micro-batches: what doesn't fill a mini-batch waits for the next micro-batch.

The step of a large mini-batch is one distributed aggregation that returns the gradient as a single row; those of small ones run
in a row in one task over a bounded number of rows. The driver holds nothing but the weight vector. The gradient depends on a
mini-batch only through its feature combinations and their counts, so it is collapsed to these first.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidtide.functions.encode import split_feature
from bidtide.functions.score import CATEGORICAL, LinearModel, serving_features, text_sql
from bidtide.operators.numbering import numbered
from bidtide.session import written


@dataclass(frozen=True)
class LearningRate:
    """Step size ``eta0 / (1 + alpha * eta0 * t)`` with L2 strength ``alpha``; ``t`` counts steps."""

    # Fixed value: the L2 strength of the online learner.
    alpha: float = 1e-4
    eta0: float = 1.0
    steps_per_batch: int = 5

    def at(self, step: int) -> float:
        return self.eta0 / (1.0 + self.alpha * self.eta0 * step)


def new_model(features: Sequence[str]) -> LinearModel:
    return LinearModel(list(features), [0.0] * len(features), 0.0, source="online")


#: Examples whose steps one task takes in a row.
IN_TASK = 500_000
#: What an example is learnt from; with the time these put examples in order, and ties are equal in all of them.
EXAMPLE = (*CATEGORICAL, "frac_tech", "frac_lifestyle", "label")
ORDER = ("event_time", "user_id", *EXAMPLE)


def examples(impressions: DataFrame) -> DataFrame:
    """Impressions with profile counters as examples in their order, and whether each can be learnt from."""
    rows = impressions.withColumns(serving_features()).withColumn("label", F.col("is_clicked"))
    usable = F.col("frac_tech").isNotNull() & F.col("frac_lifestyle").isNotNull() & F.col("label").isNotNull()
    return rows.select(*ORDER, usable.alias("usable"))


def mini_batches(new: DataFrame, waiting: DataFrame | None, per_step: int) -> tuple[DataFrame, DataFrame, int]:
    """Whole mini-batches as (step, features, label, n), the examples that are left over, and the number of steps.

    ``new`` follows ``waiting`` in time, as what a micro-batch releases is later than what earlier ones did."""
    rows = new.select(*ORDER) if waiting is None else waiting.select(*ORDER).unionByName(new.select(*ORDER))
    placed = written(numbered(rows, ORDER, "step").withColumn("step", F.expr(f"step div {per_step}")), "mini_batches")
    steps = placed.count() // per_step
    whole = placed.where(F.col("step") < steps).groupBy("step", *EXAMPLE).agg(F.count(F.lit(1)).alias("n"))
    return whole, placed.where(F.col("step") >= steps).drop("step"), steps


def _steps_in_task(model: LinearModel, rows: DataFrame, first: int, last: int, done: int, rate: LearningRate) -> LinearModel:
    """The steps of mini-batches ``first`` to ``last`` (excluded), one after the other in one task over at most ``IN_TASK`` rows."""
    pairs = [split_feature(f, CATEGORICAL) for f in model.features]
    start = [model.intercept, *model.weights]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("step", kind="stable")
        columns = [np.ones(len(frame))]
        for feature, pair in zip(model.features, pairs):
            columns.append((frame[pair[0]] == pair[1] if pair else frame[feature]).to_numpy(float))
        x, y, n = np.column_stack(columns), frame["label"].to_numpy(float), frame["n"].to_numpy(float)
        bounds = np.searchsorted(frame["step"].to_numpy(), np.arange(first, last + 1))
        w = np.array(start)
        for step, low, high in zip(range(first, last), bounds[:-1], bounds[1:]):
            for i in range(rate.steps_per_batch):
                eta = rate.at((done + step) * rate.steps_per_batch + i)
                with np.errstate(over="ignore"):
                    error = (1 / (1 + np.exp(-x[low:high] @ w)) - y[low:high]) * n[low:high]
                slope = x[low:high].T @ error / n[low:high].sum()
                w[1:] *= 1 - eta * rate.alpha
                w -= eta * slope
        return pd.DataFrame({"w": [w.tolist()]})

    some = rows.where((F.col("step") >= first) & (F.col("step") < last))
    w = some.groupBy(F.lit(0).alias("all")).applyInPandas(run, "w array<double>").first()["w"]
    return replace(model, intercept=w[0], weights=w[1:])


def learn_in_order(model: LinearModel, whole: DataFrame, steps: int, per_step: int, rate: LearningRate = LearningRate()) -> LinearModel:
    """Update the model with mini-batches, each in turn.

    Small ones are taken many at a time: their steps depend on each other, so one task does those of up to ``IN_TASK`` examples.
    The gradient of a larger one is a distributed sum."""
    if not steps:
        return model
    done, at_once = model.examples // per_step, IN_TASK // per_step
    collapsed = written(whole.repartitionByRange("step"), "mini_batch_rows")
    for first in range(0, steps, max(1, at_once)):
        if at_once > 1:
            model = _steps_in_task(model, collapsed, first, min(first + at_once, steps), done, rate)
        else:
            for i in range(rate.steps_per_batch):
                model = gradient_step(model, collapsed.where(F.col("step") == first), rate, (done + first) * rate.steps_per_batch + i)
    return replace(model, examples=model.examples + steps * per_step)


def learnable(impressions: DataFrame) -> DataFrame:
    """Impressions with profile counters, as (features, label, n) and whether each can be learnt from."""
    rows = impressions.withColumns(serving_features())
    usable = F.col("frac_tech").isNotNull() & F.col("frac_lifestyle").isNotNull() & F.col("is_clicked").isNotNull()
    return (
        rows.select(*CATEGORICAL, "frac_tech", "frac_lifestyle", F.col("is_clicked").alias("label"), usable.alias("usable"))
        .groupBy(*CATEGORICAL, "frac_tech", "frac_lifestyle", "label", "usable")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def gradient_step(model: LinearModel, rows: DataFrame, rate: LearningRate, step: int) -> LinearModel:
    """One step along the mean gradient of the log loss over ``rows``; the intercept is not shrunk."""
    # SQL text rather than column objects: a step is planned often, and text is one call to the JVM.
    sums = ["sum(n) AS n", "sum(e) AS e"]
    for i, feature in enumerate(model.features):
        pair = split_feature(feature, CATEGORICAL)
        part = f"e * `{feature}`" if pair is None else f"CASE WHEN `{pair[0]}` = {text_sql(pair[1])} THEN e ELSE 0.0D END"
        sums.append(f"sum({part}) AS x{i}")
    got = rows.selectExpr("*", f"({model.probability_sql()} - label) * n AS e").selectExpr(*sums).first()
    if not got["n"]:
        return model
    eta = rate.at(step)
    weights = [w * (1 - eta * rate.alpha) - eta * got[f"x{i}"] / got["n"] for i, w in enumerate(model.weights)]
    return replace(model, weights=weights, intercept=model.intercept - eta * got["e"] / got["n"])


def learn_batch(model: LinearModel, impressions: DataFrame, rate: LearningRate = LearningRate()) -> tuple[LinearModel, int, int]:
    """Update the model with one batch. Returns it with the numbers of learnt and of unusable impressions."""
    rows = learnable(impressions).persist()
    try:
        counts = rows.agg(
            F.coalesce(F.sum(F.when(F.col("usable"), F.col("n"))), F.lit(0)).alias("learnt"),
            F.coalesce(F.sum(F.when(~F.col("usable"), F.col("n"))), F.lit(0)).alias("failed"),
        ).first()
        usable = rows.where("usable")
        for i in range(rate.steps_per_batch if counts["learnt"] else 0):
            model = gradient_step(model, usable, rate, model.version * rate.steps_per_batch + i)
        return (
            replace(model, version=model.version + 1, examples=model.examples + counts["learnt"]),
            counts["learnt"],
            counts["failed"],
        )
    finally:
        rows.unpersist()
