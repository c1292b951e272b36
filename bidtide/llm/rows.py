"""Rows that can't be told apart by doc_id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidtide.operators.numbering import numbered
from bidtide.session import written


def with_row_ids(docs: DataFrame) -> tuple[DataFrame, str] | None:
    """None if every row has a doc_id of its own. Else the rows, written once, with a unique long column that ascends with doc_id
    (rows without one come last), and its name."""
    n, ids = docs.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if n == ids:
        return None
    rows = written(docs.withColumn("__at_row", F.monotonically_increasing_id()), "rows")
    keys = rows.select("__at_row", F.col("doc_id").isNull().alias("__last"), F.col("doc_id").alias("__id"))
    placed = numbered(keys, ["__last", "__id", "__at_row"], "__row").select(F.col("__at_row"), "__row")
    return rows.join(placed, "__at_row").drop("__at_row"), "__row"
