"""The continuous jobs. Each takes its decoded input streams and returns a writer that is ready to start.

Jobs meet only in tables and topics, so each has its own checkpoint and restarts by itself.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from bidtide.functions.score import CATEGORICAL, LinearModel, ctr_score, serving_features
from bidtide.operators.interval_join import enrich
from bidtide.operators.learning import LearningRate, examples, learn_in_order, mini_batches, new_model
from bidtide.operators.profiles import user_profiles
from bidtide.operators.registry import current_model, load_latest, save_model
from bidtide.operators.rides import categorise_strict, categorise_tolerant, fare_totals
from bidtide.operators.skew import DEFAULT_POLICY, SkewPolicy
from bidtide.schemas import PROFILE_FEATURES
from bidtide.session import written
from bidtide.sinks.serving import ingest_to
from bidtide.sinks.topics import as_messages, to_files, to_table
from bidtide.sinks.upsert import batches, to_upsert_table
from bidtide.sources.topics import OUT_OF_ORDER, decode
from bidtide.streaming.asof import stream_asof_join
from bidtide.streaming.changelog import changelog_stream
from bidtide.streaming.idle import IdleInputs, with_heartbeats


def stream_enrich(
    requests: DataFrame, wins: DataFrame, clicks: DataFrame, delay: str = OUT_OF_ORDER, idle: IdleInputs | None = None
) -> DataFrame:
    """Enriched impressions from three streams with a ``ts`` column; a quiet click stream does not hold them back, and with
    ``idle`` none of the three does."""
    inputs = {"requests": requests, "wins": wins, "clicks": clicks}
    if idle:
        inputs = {name: idle.watched(name, rows) for name, rows in inputs.items()}
    else:
        inputs["clicks"] = with_heartbeats(clicks, wins)
    return enrich(*[rows.withWatermark("ts", delay) for rows in inputs.values()])


def await_watermark(query: StreamingQuery, millis: int, timeout: float) -> None:
    """Wait until a micro-batch has run under a watermark of ``millis`` (epoch) or later."""
    end = time.monotonic() + timeout
    while time.monotonic() < end:
        if not query.isActive:
            raise query.exception() or RuntimeError("the query has ended")
        progress = query.lastProgress
        text = progress and progress["eventTime"].get("watermark")
        if text and datetime.fromisoformat(text.replace("Z", "+00:00")).timestamp() * 1000 >= millis:
            return
        time.sleep(0.1)
    raise TimeoutError(f"the watermark has not reached {millis} in {timeout} s")


def enrichment_job(
    requests: DataFrame, wins: DataFrame, clicks: DataFrame, path: str, checkpoint: str, once: bool = False,
    idle: IdleInputs | None = None, trigger: str | None = None,
) -> DataStreamWriter:
    """Append impressions to a table partitioned by event date."""
    rows = stream_enrich(requests, wins, clicks, idle=idle).withColumn("event_date", F.to_date("event_time"))
    return to_table(rows, path, checkpoint, ["event_date"], once, trigger)


def profile_job(
    impressions: DataFrame, path: str, checkpoint: str, once: bool = False, compact_every: int = 20
) -> DataStreamWriter:
    """Keep the current profile of every user in an upsert table, folded every ``compact_every`` micro-batches."""
    return to_upsert_table(user_profiles(impressions), path, checkpoint, once, compact_every=compact_every, key="user_id")


def changelog_job(
    impressions: DataFrame, path: str, checkpoint: str, once: bool = False, policy: SkewPolicy = DEFAULT_POLICY
) -> DataStreamWriter:
    """Keep every version of every profile, for readers that look profiles up by time."""
    return changelog_stream(impressions, path, checkpoint, once, policy)


def fare_totals_job(
    rides: DataFrame, path: str, checkpoint: str, once: bool = False, compact_every: int = 20
) -> DataStreamWriter:
    return to_upsert_table(fare_totals(rides), path, checkpoint, once, compact_every=compact_every, key="pickup")


def ride_job(messages: DataFrame, path: str, checkpoint: str, once: bool = False) -> DataStreamWriter:
    """Categorise rides, failing on the first unusable message."""
    return to_files(categorise_strict(messages), path, checkpoint, once)


def tolerant_ride_job(
    messages: DataFrame, path: str, rejects_path: str, checkpoint: str, once: bool = False
) -> tuple[DataStreamWriter, DataStreamWriter]:
    """Categorise rides and set unusable messages aside with the reason."""
    good, bad = categorise_tolerant(messages)
    return (
        to_files(good, path, checkpoint + "/rides", once),
        to_table(bad, rejects_path, checkpoint + "/rejects", once=once),
    )


def looked_up(probes: DataFrame, profiles: DataFrame, at: str, heavy_users: Sequence[str] = ()) -> DataFrame:
    """Probes with the profile of their user at their time; where ``profiles`` has a ``deleted`` column, deletes end a profile."""
    deleted = "deleted" if "deleted" in profiles.columns else None
    return stream_asof_join(probes, profiles, "user_id", at, "update_time", PROFILE_FEATURES, deleted=deleted, heavy_keys=heavy_users)


def static_scoring_job(
    requests: DataFrame,
    profiles: DataFrame,
    model: LinearModel,
    path: str,
    checkpoint: str,
    once: bool = False,
    heavy_users: Sequence[str] = (),
) -> DataStreamWriter:
    """Score requests with one fixed model and append the scores as JSON messages."""
    probes = requests.select("request_id", "user_id", *CATEGORICAL, "ts")
    joined = looked_up(probes, profiles, "ts", heavy_users)
    scored = joined.withColumns(serving_features()).select("request_id", ctr_score(model).alias("ctr_score"))
    return to_files(as_messages(scored), path, checkpoint, once)


def scoring_job(
    requests: DataFrame,
    profiles: DataFrame,
    models: str,
    path: str,
    checkpoint: str,
    once: bool = False,
    reload_every: str = "10 seconds",
    heavy_users: Sequence[str] = (),
    as_json: bool = False,
) -> DataStreamWriter:
    """Score requests with the profile current at their time. Every micro-batch uses the newest model, an
    online one if there is any; without a model scores are 0. Scores go to a Parquet table, or as JSON messages to text files."""
    probes = requests.select("request_id", "user_id", *CATEGORICAL, "ts")
    joined = looked_up(probes, profiles, "ts", heavy_users)

    def score(rows: DataFrame, batch_id: int) -> None:
        model = current_model(rows.sparkSession, models)
        scored = rows.withColumns(serving_features()).select("request_id", ctr_score(model).alias("ctr_score"))
        out = (as_messages(scored) if as_json else scored).write.mode("overwrite")
        out.format("text" if as_json else "parquet").save(f"{path}/batch_id={batch_id}")

    writer = joined.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(score)
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=reload_every)


def learning_job(
    impressions: DataFrame,
    profiles: DataFrame,
    models: str,
    log_path: str,
    checkpoint: str,
    once: bool = False,
    features: Sequence[str] | None = None,
    rate: LearningRate = LearningRate(),
    heavy_users: Sequence[str] = (),
    per_step: int = 1000,
) -> DataStreamWriter:
    """Update the online model with every ``per_step`` examples in order of time, and log one status row per batch and outcome.

    The feature list comes from the batch model unless given. Batch ``N`` reads versions up to ``N`` and the examples that
    earlier batches left waiting, and writes version ``N + 1`` and what it leaves, so repeating a batch gives the same version."""
    probes = impressions.select("user_id", *CATEGORICAL, "is_clicked", "event_time")
    joined = looked_up(probes, profiles, "event_time", heavy_users)
    left_over = f"{checkpoint}/waiting"

    def learn(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        model = load_latest(spark, models, "online", below=batch_id + 1)
        if model is None:
            batch = load_latest(spark, models, "batch")
            names = features or (batch.features if batch else None)
            if names is None:
                raise RuntimeError("no feature list: train the batch model first or pass features")
            model = new_model(names)
        found = written(examples(rows), "examples")
        before = [n for n in batches(spark, left_over) if n < batch_id]
        waiting = spark.read.schema(found.schema).parquet(f"{left_over}/batch_id={before[-1]}") if before else None
        whole, rest, steps = mini_batches(found.where("usable"), waiting, per_step)
        updated = learn_in_order(model, whole, steps, per_step, rate)
        if steps:
            save_model(spark, updated.at_version(batch_id + 1), models)
        rest.write.mode("overwrite").parquet(f"{left_over}/batch_id={batch_id}")
        status = spark.createDataFrame(
            [("Updated", steps * per_step), ("Error", found.where("NOT usable").count())], "status STRING, examples BIGINT"
        ).where("examples > 0")
        status.coalesce(1).write.mode("overwrite").parquet(f"{log_path}/batch_id={batch_id}")

    writer = joined.writeStream.outputMode("append").option("checkpointLocation", f"{checkpoint}/progress").foreachBatch(learn)
    return writer.trigger(availableNow=True) if once else writer


def ingest_job(
    messages: DataFrame, schema: T.StructType, path: str, checkpoint: str, once: bool = False, rows_of: Callable[[DataFrame], DataFrame] | None = None
) -> DataStreamWriter:
    """Feed a serving table of ``schema`` from a topic of JSON messages. ``rows_of`` turns a batch of messages into rows; by default
    they are decoded by the schema."""
    work = ingest_to(path, schema, rows_of or (lambda batch: decode(batch, schema)))
    writer = messages.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(work)
    return writer.trigger(availableNow=True) if once else writer
