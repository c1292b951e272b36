"""Serving tables fed by a topic: every micro-batch is committed once, whole, whatever is delivered again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from bidtide.sinks import commits


def ingest_to(path: str, schema: T.StructType, rows_of: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """The work of a micro-batch: its messages as rows of ``schema``, committed under the number of the batch."""

    def write(messages: DataFrame, batch_id: int) -> None:
        rows = rows_of(messages)
        commits.commit(rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in schema.fields]), path, f"{batch_id:012d}")

    return write


def serving_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The committed rows; empty while there are none."""
    folders = list(commits.committed(spark, path).values())
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
