"""Stored tables: the serving tables and the versioned profile table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from bidtide.schemas import PROFILES


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table; empty while nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def report(spark: SparkSession, path: str, schema: T.StructType, name: str, sql: str) -> DataFrame:
    """Run an analytical statement over a stored table known as ``name``."""
    read_table(spark, path, schema).createOrReplaceTempView(name)
    return spark.sql(sql)


def changelog_schema(schema: T.StructType = PROFILES) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("deleted", T.BooleanType()), T.StructField("batch_id", T.LongType())])


def read_changelog(spark: SparkSession, path: str, schema: T.StructType = PROFILES) -> DataFrame:
    """All versions written by the upsert sink, with the batch that wrote them."""
    return read_table(spark, path, changelog_schema(schema))
