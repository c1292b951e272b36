"""Small constructors for hand-made rows."""

import json
import os
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

EPOCH = datetime(2024, 5, 1, tzinfo=timezone.utc)


def at(ms):
    """``ms`` milliseconds after a fixed instant."""
    return EPOCH + timedelta(milliseconds=ms)


def requests(spark, *rows):
    """(request_id, ms) or (request_id, ms, user_id, os, category)."""
    full = [(r[0], at(r[1]), *(r[2:] or ("u1", "iOS", "Tech"))) for r in rows]
    return spark.createDataFrame(full, "request_id STRING, ts TIMESTAMP, user_id STRING, os STRING, site_category STRING")


def wins(spark, *rows):
    return spark.createDataFrame(
        [(r[0], at(r[1]), "camp", 1.0) for r in rows], "request_id STRING, ts TIMESTAMP, campaign_id STRING, win_price DOUBLE"
    )


def clicks(spark, *rows):
    full = [(r[0], at(r[1]), r[2] if len(r) > 2 else "click") for r in rows]
    return spark.createDataFrame(full, "request_id STRING, ts TIMESTAMP, user_action STRING")


def impressions(spark, *rows):
    """(request_id, user_id, category, is_clicked, ms)."""
    full = [(r[0], r[1], "iOS", r[2], "camp", 1.0, r[3], at(r[4])) for r in rows]
    return spark.createDataFrame(
        full,
        "request_id STRING, user_id STRING, os STRING, site_category STRING, campaign_id STRING, win_price DOUBLE,"
        " is_clicked INT, event_time TIMESTAMP",
    )


def same_rows(a, b):
    columns = sorted(b.columns)
    assert sorted(a.columns) == columns
    left, right = ([tuple(r) for r in df.select(*columns).collect()] for df in (a, b))
    assert sorted(map(repr, left)) == sorted(map(repr, right))


def topic_file(folder, number, *messages):
    """Add a file of messages; its modification time follows ``number`` because streams read oldest first."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"part-{number:04d}.txt")
    with open(path, "w", encoding="utf-8") as out:
        out.writelines((m if isinstance(m, str) else json.dumps(m)) + "\n" for m in messages)
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def millis(ms):
    return int(at(ms).timestamp() * 1000)


def offsets(df, column):
    """The rows with ``column`` as milliseconds after the fixed instant."""
    base = millis(0)
    return df.withColumn(column, F.unix_millis(column) - base)


def run(*writers):
    for query in [w.start() for w in writers]:
        query.awaitTermination()
