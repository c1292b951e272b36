"""Ride records: fare categories, malformed input, totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidtide.functions.rules import fare_category
from bidtide.schemas import RIDES_SERVING


def categorised(rides: DataFrame) -> DataFrame:
    """Typed rides with their fare category. A null fare is an error, as in the strict message job."""
    fare = F.coalesce(F.col("fare"), F.raise_error(F.lit("ride without a fare")).cast("double"))
    return rides.withColumn("fare_category", fare_category(fare))


# Fixed value: the white space JSON allows between tokens.
_BLANKS = " \t\r\n"


def _once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Compute columns exactly once per row. As generator output they are not repeated in each expression
    and filter that uses them, which matters for parsed JSON."""
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _parsed(messages: DataFrame) -> DataFrame:
    """Add the record of each message: its fields if it is an object, and what kind of value the fare is.

    Spark's JSON reader stops after the first value. Parsing the text as the first of two elements, with a
    number derived from the text as the second, exposes anything left over.
    """
    is_binary = dict(messages.dtypes)["value"] == "binary"
    text = F.try_validate_utf8(F.col("value").cast("string")) if is_binary else F.col("value")
    check = F.xxhash64("__text")
    doc = F.from_json(
        F.concat(F.lit("["), F.col("__text"), F.lit(","), check, F.lit("]")),
        "array<variant>",
        {"allowSingleQuotes": "false"},
    )
    complete = (F.size("__doc") == 2) & (F.try_variant_get(F.get("__doc", 1), "$", "bigint") == check)
    documents = _once(messages.withColumn("__text", text), __doc=doc)
    records = _once(documents, __ride=F.when(complete, F.get("__doc", 0)))
    return _once(records, __fare=F.expr("try_variant_get(__ride, '$.fare', 'variant')")).withColumn(
        "__kind", F.schema_of_variant("__fare")
    )


def _is_object() -> Column:
    """A text that is one JSON value is an object if it opens with a brace."""
    return F.col("__ride").isNotNull() & F.ltrim(F.col("__text"), F.lit(_BLANKS)).startswith("{")


def _missing() -> Column:
    """The record has no ``fare`` key at all; a JSON null fare has the kind VOID."""
    return F.col("__kind").isNull()


def _number() -> Column:
    """The fare as a number; booleans count as 1 and 0, everything not numeric is null."""
    kind = F.col("__kind")
    numeric = kind.isin("BIGINT", "DOUBLE", "FLOAT", "BOOLEAN") | kind.startswith("DECIMAL")
    return F.when(numeric, F.try_variant_get("__fare", "$", "double"))


def _blank() -> Column:
    """Missing, null, empty text, empty array or empty object."""
    kind = F.col("__kind")
    empty = F.try_variant_get("__fare", "$", "string").isin("", "[]", "{}")
    return _missing() | (kind == "VOID") | F.coalesce(empty, F.lit(False))


def _with_category(rides: DataFrame, fare: Column) -> DataFrame:
    """The records as JSON text with ``fare_category`` set; all other keys are kept as they are.

    The entry is appended to the text itself. Only a record that already has the key is rebuilt without it.
    """
    rows = _once(
        rides,
        __entry=F.concat(F.lit('"fare_category":"'), fare_category(fare), F.lit('"}')),
        __old=F.expr("try_variant_get(__ride, '$.fare_category', 'variant')"),
    )
    others = F.map_filter(F.expr("try_variant_get(__ride, '$', 'map<string,variant>')"), lambda k, _: k != "fare_category")
    rebuilt = F.to_json(others, {"ignoreNullFields": "false"})
    record = F.when(F.col("__old").isNull(), F.rtrim(F.col("__text"), F.lit(_BLANKS))).otherwise(rebuilt)
    rows = _once(rows, __record=record)
    opened = F.substr("__record", F.lit(1), F.length("__record") - 1)
    empty = F.regexp_like("__record", F.lit(r"^\s*\{\s*\}$"))
    return rows.select(F.concat(opened, F.when(empty, "").otherwise(","), "__entry").alias("value"))


def categorise_tolerant(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Categorise ride messages (column ``value``), setting aside what cannot be read.

    Returns the enriched messages and the rejected ones with the reason. A null, missing or otherwise empty
    fare counts as 0. Rejected are nulls, invalid UTF-8, text that is not one JSON object, and fares
    that are not numbers.
    """
    fare = F.when(_blank(), 0.0).otherwise(_number())
    parsed = _once(_parsed(messages), __number=fare)
    reason = (
        F.when(F.col("__text").isNull(), "not text")
        .when(F.col("__ride").isNull(), "not JSON")
        .when(~_is_object(), "not an object")
        .when(F.col("__number").isNull(), "fare is not a number")
    )
    good = _with_category(parsed.where(reason.isNull()), F.col("__number"))
    bad = parsed.where(reason.isNotNull()).select("value", reason.alias("reason"))
    return good, bad


def categorise_strict(messages: DataFrame) -> DataFrame:
    """Categorise ride messages; only a missing fare counts as 0, any other defect fails the job."""
    parsed = _parsed(messages)
    fail = F.raise_error(F.concat(F.lit("unusable ride: "), F.coalesce("__text", F.lit("null")))).cast("double")
    fare = F.when(_is_object() & _missing(), 0.0).otherwise(F.coalesce(F.when(_is_object(), _number()), fail))
    return _with_category(parsed, fare)


def serving_rows(enriched: DataFrame, ingestion_time: Column | None = None) -> DataFrame:
    """Enriched messages in the serving layout. The messages carry no time, so ingestion stamps them."""
    stamp = F.unix_millis(F.current_timestamp()) if ingestion_time is None else ingestion_time
    ride = F.from_json("value", "ride_id STRING, pickup STRING, fare_category STRING, fare DOUBLE")
    return (
        enriched.select(ride.alias("r"))
        .select("r.*")
        .withColumn("ingestion_time", stamp.cast("long"))
        .select(*RIDES_SERVING.names)
    )


def fare_totals(rides: DataFrame) -> DataFrame:
    """Total fare per pickup; on a stream, the running total (update mode)."""
    return rides.groupBy("pickup").agg(F.sum("fare").alias("total"))


def grand_totals(latest_totals: DataFrame) -> DataFrame:
    """Totals per pickup, largest first, over the latest total of each pickup."""
    return (
        latest_totals.groupBy("pickup")
        .agg(F.sum("total").alias("grand_total"))
        .orderBy(F.desc("grand_total"), "pickup")
    )
