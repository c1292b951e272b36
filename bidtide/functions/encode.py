"""One-hot features against a frozen, ordered feature list.

A feature is named ``<column>_<value>``. The first value (in sort order) of every column is the base: it has
no feature of its own, and neither has a null or a value unseen at fitting time, so all of them encode to zeros.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidtide.operators.numbering import numbered

def _part(columns: Sequence[str]) -> Column:
    return F.create_map(*[F.lit(v) for i, c in enumerate(columns) for v in (c, i)])[F.col("column_name")]


def _numbered_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """part (the column's place), column_name, value, number (over all columns), first (the number of the column's first value) and
    nth (of the columns that have values)."""
    named = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    values = df.select(F.explode(named).alias("p")).select("p.*").where(F.col("value").isNotNull()).distinct()
    placed = numbered(values.select(_part(columns).alias("part"), "column_name", "value"), ["part", "value"])
    starts = placed.groupBy("part").agg(F.min("number").alias("first"))  # one row for each column
    ordered = F.array_sort(F.collect_list(F.struct("first", "part")))
    nth = starts.agg(ordered.alias("s")).select(F.posexplode("s").alias("nth", "s")).select("nth", "s.first", "s.part")
    return placed.join(F.broadcast(nth), "part")


def vocabulary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column_name, value, position: the distinct non-null values of each column in order, from one pass over ``df``.

    Values are numbered where they lie after one range partitioning, so a column may have any number of them."""
    position = (F.col("number") - F.col("first")).cast("int").alias("position")
    return _numbered_values(df, columns).select("column_name", "value", position)


def feature_index(df: DataFrame, columns: Sequence[str], numeric: Sequence[str] = ()) -> DataFrame:
    """column_name, value, position: the place of every value but each column's first in the ordered feature list."""
    position = (F.lit(len(numeric)) + F.col("number") - F.col("nth") - 1).cast("int").alias("position")
    return _numbered_values(df, columns).where(F.col("number") > F.col("first")).select("column_name", "value", position)


def feature_table(index: DataFrame, numeric: Sequence[str] = ()) -> DataFrame:
    """position, feature: the ordered feature list behind a ``feature_index``, as a plan."""
    encoded = index.select("position", F.concat_ws("_", "column_name", "value").alias("feature"))
    if not numeric:
        return encoded
    first = index.sparkSession.createDataFrame(list(enumerate(numeric)), "position INT, feature STRING")
    return first.unionByName(encoded)


def sparse_features(rows: DataFrame, index: DataFrame, columns: Sequence[str], numeric: Sequence[str] = (), output: str = "features") -> DataFrame:
    """``rows`` with a sparse vector ``output`` of all features: numeric ones first, then each column's values in ``index``.

    A row takes room for its own values, not for the vocabulary. Each column's index is joined by value, which Spark broadcasts
    where it is small; a base, unseen or null value has no place and adds nothing."""
    ranges = index.groupBy("column_name").agg(F.min("position").alias("first"), F.count(F.lit(1)).alias("n")).collect()
    sizes = {r["column_name"]: (r["first"], r["n"]) for r in ranges}
    encoded = [c for c in columns if c in sizes]
    places, vectors = [f"__{c}_place" for c in encoded], [f"__{c}_vector" for c in encoded]
    out = rows
    for c, place in zip(encoded, places):
        first, n = sizes[c]
        own = index.where(F.col("column_name") == c).select(F.col("value").alias("__value"), (F.col("position") - first).alias(place))
        out = out.join(own, F.col(c).cast("string") == F.col("__value"), "left").drop("__value")
        # The encoder drops the last category: it stands for every value without a place.
        out = out.withColumn(place, F.coalesce(place, F.lit(n)).cast("double"))
    if encoded:
        widest = rows.sparkSession.createDataFrame([tuple(float(sizes[c][1]) for c in encoded)], ", ".join(f"`{p}` DOUBLE" for p in places))
        out = OneHotEncoder(inputCols=places, outputCols=vectors, dropLast=True).fit(widest).transform(out)
    return VectorAssembler(inputCols=[*numeric, *vectors], outputCol=output).transform(out).drop(*places, *vectors)


def fit_categories(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """The vocabulary on the driver, where the fitted weights are: one name for each weight."""
    values: dict[str, list[str]] = {c: [] for c in columns}
    for row in sorted(vocabulary(df, columns).collect(), key=lambda r: r["position"]):
        values[row["column_name"]].append(row["value"])
    return values


def feature_names(categories: dict[str, list[str]], numeric: Sequence[str] = ()) -> list[str]:
    """Numeric features first, then the encoded columns without their base value."""
    return [*numeric, *[f"{c}_{v}" for c, values in categories.items() for v in values[1:]]]


def split_feature(feature: str, columns: Sequence[str]) -> tuple[str, str] | None:
    """The ``(column, value)`` an encoded feature stands for, or None for a numeric one."""
    for column in columns:
        if feature.startswith(column + "_"):
            return column, feature[len(column) + 1:]
    return None


def one_hot(features: Sequence[str], columns: Sequence[str]) -> list[Column]:
    """One 0/1 double column per feature; numeric features pass through."""
    out = []
    for feature in features:
        pair = split_feature(feature, columns)
        if pair is None:
            out.append(F.col(feature).cast("double").alias(feature))
        else:
            column, value = pair
            out.append(F.when(F.col(column) == value, 1.0).otherwise(0.0).alias(feature))
    return out
