import json

import pytest
from pyspark.sql import functions as F

from bidtide.operators import rides


def tolerant(spark, *messages):
    df = spark.createDataFrame([(m,) for m in messages], "value STRING")
    good, bad = rides.categorise_tolerant(df)
    return [json.loads(r.value) for r in good.collect()], {r.value: r.reason for r in bad.collect()}


def one(spark, message):
    good, bad = tolerant(spark, message)
    return good[0]["fare_category"] if good else next(iter(bad.values()))


@pytest.mark.parametrize(
    "fare,category",
    [(9.99, "cheap"), (10, "medium"), (10.0, "medium"), (14.99, "medium"), (15, "expensive"), (-3, "cheap"), (1e30, "expensive")],
)
def test_fare_bounds(spark, fare, category):
    assert one(spark, json.dumps({"ride_id": 1, "fare": fare})) == category
    df = spark.createDataFrame([(1, "x", float(fare))], "ride_id INT, pickup STRING, fare DOUBLE")
    assert rides.categorised(df).first().fare_category == category


@pytest.mark.parametrize("fare", ["null", "false", '""', "[]", "{}", "0", "true"])
def test_empty_fares_are_cheap(spark, fare):
    assert one(spark, '{"fare":%s}' % fare) == "cheap"


def test_missing_fare_is_cheap_and_not_added(spark):
    good, _ = tolerant(spark, '{"ride_id":7}')
    assert good == [{"ride_id": 7, "fare_category": "cheap"}]


@pytest.mark.parametrize(
    "message,reason",
    [
        ('{"fare":"12"}', "fare is not a number"), ('{"fare":[1]}', "fare is not a number"),
        ('{"fare":[null]}', "fare is not a number"), ('{"fare":{"a":1}}', "fare is not a number"),
        ("[1]", "not an object"), ("null", "not an object"), ('"x"', "not an object"), ("3", "not an object"),
        ("nonsense", "not JSON"), ("", "not JSON"), ('{"fare":5} x', "not JSON"), ('{"fare":5}{"fare":6}', "not JSON"),
        ('{"fare":5},{"fare":6}', "not JSON"), ('{"fare":5}]', "not JSON"), ("{'fare':3}", "not JSON"), ('{"fare":007}', "not JSON"),
        (None, "not text"),
    ],
)
def test_unusable_messages_are_set_aside(spark, message, reason):
    good, bad = tolerant(spark, message)
    assert good == [] and bad == {message: reason}


def test_other_keys_survive_and_category_is_replaced(spark):
    message = {"fare_category": "old", "fare": 11, "x": {"a": [1, 2.5, "s", None]}, "y": None, "quote": 'say "hi"}', "é": "ü"}
    good, _ = tolerant(spark, json.dumps(message))
    assert good == [message | {"fare_category": "medium"}]


def test_repeated_keys_keep_the_last_value(spark):
    good, _ = tolerant(spark, '{"a":1,"a":2,"fare":30,"fare":3}')
    assert good == [{"a": 2, "fare": 3, "fare_category": "cheap"}]


def test_binary_messages(spark):
    df = spark.createDataFrame([(bytearray(b'{"fare":12}'),), (bytearray(b"\xff\xfe"),)], "value BINARY")
    good, bad = rides.categorise_tolerant(df)
    assert [json.loads(r.value)["fare_category"] for r in good.collect()] == ["medium"]
    assert [r.reason for r in bad.collect()] == ["not text"]


@pytest.mark.parametrize("message", ['{"fare":null}', "nonsense", '{"fare":"12"}', "[1]"])
def test_strict_job_fails_on_unusable_messages(spark, message):
    df = spark.createDataFrame([(message,)], "value STRING")
    with pytest.raises(Exception, match="unusable ride"):
        rides.categorise_strict(df).collect()


def test_strict_job_accepts_a_missing_fare(spark):
    df = spark.createDataFrame([('{"ride_id":1}',), ('{"fare":15.0,"k":"v"}',)], "value STRING")
    out = [json.loads(r.value) for r in rides.categorise_strict(df).collect()]
    assert {"ride_id": 1, "fare_category": "cheap"} in out and {"fare": 15, "k": "v", "fare_category": "expensive"} in out


def test_typed_rides_fail_without_a_fare(spark):
    df = spark.createDataFrame([(1, "x", None)], "ride_id INT, pickup STRING, fare DOUBLE")
    with pytest.raises(Exception, match="without a fare"):
        rides.categorised(df).collect()


def test_serving_rows(spark):
    df = spark.createDataFrame([('{"ride_id":1,"pickup":"Queens","fare":15.0,"fare_category":"expensive"}',)], "value STRING")
    row = rides.serving_rows(df).first()
    assert (row.ride_id, row.pickup, row.fare_category, row.fare) == ("1", "Queens", "expensive", 15.0)
    assert row.ingestion_time > 1_700_000_000_000


def test_totals(spark):
    df = spark.createDataFrame([("a", 1.5), ("b", 9.0), ("a", 2.0), ("c", None)], "pickup STRING, fare DOUBLE")
    totals = rides.fare_totals(df)
    assert {r.pickup: r.total for r in totals.collect()} == {"a": 3.5, "b": 9.0, "c": None}
    assert [r.pickup for r in rides.grand_totals(totals.where(F.col("total").isNotNull())).collect()] == ["b", "a"]
