"""Linear CTR models as column expressions: scoring never leaves the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from bidtide.functions.encode import split_feature
from bidtide.functions.rules import serving_share

CATEGORICAL = ("os", "site_category")


@dataclass(frozen=True)
class LinearModel:
    """A fitted logistic model: ordered feature names, their weights and the intercept."""

    features: Sequence[str]
    weights: Sequence[float]
    intercept: float = 0.0
    source: str = "batch"
    version: int = 0
    examples: int = 0
    categorical: Sequence[str] = field(default=CATEGORICAL)

    def margin_sql(self) -> str:
        """Intercept plus weighted features, over the raw categorical and numeric columns.

        All values of one categorical column share a single CASE, so the cost per row does not grow with
        the number of encoded features that do not apply.
        """
        terms = [double_sql(self.intercept)]
        cases: dict[str, list[str]] = {}
        for feature, weight in zip(self.features, self.weights):
            pair = split_feature(feature, self.categorical)
            if pair is None:
                terms.append(f"`{feature}` * {double_sql(weight)}")
            else:
                column, value = pair
                cases.setdefault(column, []).append(f"WHEN {text_sql(value)} THEN {double_sql(weight)}")
        terms += [f"CASE `{column}` {' '.join(whens)} ELSE 0.0D END" for column, whens in cases.items()]
        return " + ".join(terms)

    def probability_sql(self) -> str:
        return f"1.0D / (1.0D + exp(-({self.margin_sql()})))"

    def probability(self) -> Column:
        return F.expr(self.probability_sql())

    def at_version(self, version: int) -> LinearModel:
        return replace(self, version=version)


def double_sql(value: float) -> str:
    return f"{float(value)!r}D"


def text_sql(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def serving_features() -> dict[str, Column]:
    """The two history shares at scoring time, from the looked-up profile counters."""
    total = F.col("total_views")
    return {
        "frac_tech": serving_share(F.col("tech_views"), total),
        "frac_lifestyle": serving_share(F.col("lifestyle_views"), total),
    }


def ctr_score(model: LinearModel | None) -> Column:
    """Click probability over rows that carry ``serving_features``; 0.0 without a model or where a history
    counter is missing although views were counted."""
    if model is None:
        return F.lit(0.0)
    broken = F.col("frac_tech").isNull() | F.col("frac_lifestyle").isNull()
    return F.when(broken, 0.0).otherwise(F.coalesce(model.probability(), F.lit(0.0)))
