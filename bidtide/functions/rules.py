"""Business rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fares below the first bound are cheap, below the second medium, all others expensive.
CHEAP_BELOW = 10.0
MEDIUM_BELOW = 15.0


def fare_category(fare: Column | str, cheap_below: float = CHEAP_BELOW, medium_below: float = MEDIUM_BELOW) -> Column:
    fare = F.col(fare) if isinstance(fare, str) else fare
    return F.when(fare < cheap_below, "cheap").when(fare < medium_below, "medium").otherwise("expensive")


def click_flag(user_action: Column | str) -> Column:
    """1 only where an action was recorded: a click row without one is not a click."""
    user_action = F.col(user_action) if isinstance(user_action, str) else user_action
    return F.when(user_action.isNotNull(), 1).otherwise(0).cast("int")


def count_when(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def sum_when(condition: Column, measure: Column | str) -> Column:
    measure = F.col(measure) if isinstance(measure, str) else measure
    return F.sum(F.when(condition, measure).otherwise(0))


def serving_share(part: Column, total: Column) -> Column:
    """Share of views used when scoring: no history counts as 0."""
    return F.when(total.isNull() | (total == 0), 0.0).otherwise(part.cast("double") / total.cast("double"))


def training_share(part: Column, total: Column) -> Column:
    """Share of views used when training: an empty history divides by 1."""
    return part.cast("double") / F.when(total == 0, 1).otherwise(total).cast("double")
