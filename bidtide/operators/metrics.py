"""Exact quality measures of a binary classifier, over rows that may carry a weight (a row count)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidtide.operators.skew import DEFAULT_POLICY, SkewPolicy, running_sums
from bidtide.session import written


def _weight(weight: str | None) -> Column:
    return F.lit(1) if weight is None else F.col(weight)


def roc_auc(
    scored: DataFrame,
    label: str = "label",
    score: str = "score",
    weight: str | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Area under the ROC curve with ties counted half; null when only one class is present.

    Rows collapse to one per distinct score, and every score needs the number of negatives below it. That
    table is written once; while it is small a single ordered pass finishes the job, beyond the
    policy's bound the pass is cut into segments.
    """
    w = _weight(weight)
    by_score = scored.groupBy(F.col(score).alias("score")).agg(
        F.sum(F.when(F.col(label) == 1, w).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(w)).alias("neg"),
    )
    ranked = running_sums(
        written(by_score, "scores"), None, ["score"], {"below": F.col("neg")}, include_current=False, policy=policy
    )
    pos, neg = F.sum("pos").cast("double"), F.sum("neg").cast("double")
    wins = F.sum(F.col("pos").cast("double") * (F.col("below") + F.col("neg") / 2))
    return ranked.agg(
        F.when((pos > 0) & (neg > 0), wins / (pos * neg)).alias("roc_auc"),
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
    )


def _ratio(part: Column, total: Column) -> Column:
    return F.when(total == 0, 0.0).otherwise(part / total)


def classification_report(
    predicted: DataFrame, label: str = "label", prediction: str = "prediction", weight: str | None = None
) -> DataFrame:
    """Precision, recall, F1 and support per class, plus accuracy, macro and weighted averages.

    The accuracy row carries its value as ``f1_score``. Undefined ratios are 0.
    """
    w = _weight(weight).cast("double")
    is_pos, said_pos = F.col(label) == 1, F.col(prediction) == 1

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, w)), F.lit(0.0))

    cells = predicted.agg(
        total(is_pos & said_pos).alias("tp"),
        total(~is_pos & said_pos).alias("fp"),
        total(is_pos & ~said_pos).alias("fn"),
        total(~is_pos & ~said_pos).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n0, n1 = tn + fp, tp + fn
    cells = cells.select(
        "*",
        _ratio(tn, tn + fn).alias("p0"), _ratio(tn, n0).alias("r0"), n0.alias("n0"),
        _ratio(tp, tp + fp).alias("p1"), _ratio(tp, n1).alias("r1"), n1.alias("n1"),
    )
    cells = cells.withColumns(
        {f"f{k}": _ratio(2 * F.col(f"p{k}") * F.col(f"r{k}"), F.col(f"p{k}") + F.col(f"r{k}")) for k in (0, 1)}
    )
    n = F.col("n0") + F.col("n1")

    def line(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("label"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1_score"), support.cast("long").alias("support"),
        )

    def macro(m: str) -> Column:
        return (F.col(m + "0") + F.col(m + "1")) / 2

    def weighted(m: str) -> Column:
        return _ratio(F.col(m + "0") * F.col("n0") + F.col(m + "1") * F.col("n1"), n)

    none = F.lit(None).cast("double")
    lines = [
        line("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("n0")),
        line("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("n1")),
        line("accuracy", none, none, _ratio(F.col("tp") + F.col("tn"), n), n),
        line("macro avg", macro("p"), macro("r"), macro("f"), n),
        line("weighted avg", weighted("p"), weighted("r"), weighted("f"), n),
    ]
    return cells.select(F.inline(F.array(*lines)))
