"""Streaming queries over the provided tables: the continuous jobs run over everything available, then stop.

Sources are streams of the ``events`` files. An end marker far in the future is added to each derived stream so that
the last rows are released, and removed from the results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from bidtide.operators.interval_join import enrich
from bidtide.operators.learning import LearningRate
from bidtide.operators.profiles import profile_changelog
from bidtide.operators.registry import models, save_model
from bidtide.operators.rides import fare_totals
from bidtide.plans import datasets
from bidtide.plans.batch import FIXED_MODEL, Inputs, _ride_fields, naive_times, rounded
from bidtide.schemas import CLICKS, FARE_TOTALS, IMPRESSIONS, PROFILE_FEATURES, PROFILES, REQUESTS, REQUESTS_FOR_SCORING, RIDES, SCORED_REQUESTS, WINS
from bidtide.session import fresh_path, prepare, stream_session
from bidtide.sinks.serving import ingest_to, serving_table
from bidtide.sinks.topics import as_messages, to_table
from bidtide.sinks.upsert import compact, current_rows, drop_folded, to_upsert_table, upsert_to
from bidtide.sources import topics
from bidtide.sources.tables import read_changelog, read_table
from bidtide.sources.topics import OUT_OF_ORDER, OUT_OF_ORDER_MS, decode, file_messages, with_event_time
from bidtide.streaming import jobs
from bidtide.streaming.idle import IdleInputs
from bidtide.streaming.late import late_rows_job
from bidtide.streaming.restart import run_with_restarts

END = "__end"
_FAR = "2200-01-01 00:00:00"


def _run(*writers: DataStreamWriter) -> None:
    for query in [w.start() for w in writers]:
        query.awaitTermination()


def _with_end(stream: DataFrame, table: DataFrame, keys: list[str], time: str) -> DataFrame:
    """Add the end marker to the row with the lowest first key."""
    first = table.agg(F.min(keys[0])).first()[0]
    copies = F.when(F.col(keys[0]) == first, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    marked = stream.withColumn("__last", F.explode(copies))
    ended = {k: F.when(F.col("__last"), END).otherwise(F.col(k)).alias(k) for k in keys}
    ended[time] = F.when(F.col("__last"), F.lit(_FAR).cast("timestamp")).otherwise(F.col(time)).alias(time)
    return marked.withColumns(ended).drop("__last")


class Streams:
    def __init__(self, spark: SparkSession, sf_dir: str, name: str):
        self.spark, self.sf_dir = prepare(spark), sf_dir
        self.session = stream_session(spark)
        self.table = datasets.events(spark, sf_dir)
        self.work = fresh_path(spark, name)

    def events(self) -> DataFrame:
        return datasets.events_stream(self.session, self.sf_dir)

    def path(self, name: str) -> str:
        return f"{self.work}/{name}"

    def derived(self, dataset, keys: list[str], end: bool = True) -> DataFrame:
        stream = dataset(self.events())
        return _with_end(stream, dataset(self.table), keys, "ts") if end else stream

    def staged_impressions(self) -> str:
        """Impressions as a table for the jobs downstream of the enrichment job."""
        path = self.path("impressions")
        at = self.table
        enrich(datasets.requests(at), datasets.wins(at), datasets.clicks(at)).write.parquet(path)
        return path

    def stream_of(self, path: str, schema) -> DataFrame:
        return self.session.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(path)

    def publish(self, name: str, dataset, keys: list[str]) -> None:
        """Write a derived dataset as a topic of JSON messages, end marker included."""
        rows = dataset(self.table)
        ended = _with_end(rows, rows, keys, "ts").withColumn("timestamp_ts", F.unix_millis("ts"))
        as_messages(ended.drop("ts")).write.text(self.path(name))

    def topic(self, name: str, schema, files: int | None = None) -> DataFrame:
        """A JSON topic, decoded, with its event time and no watermark yet."""
        return with_event_time(decode(file_messages(self.session, self.path(name), files), schema), delay=None)


def stream_enriched_impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = Streams(spark, sf_dir, "enrich")
    rows = jobs.stream_enrich(
        at.derived(datasets.requests, ["request_id", "user_id"]),
        at.derived(datasets.wins, ["request_id"]),
        at.derived(datasets.clicks, ["request_id"]),
    )
    _run(to_table(rows, at.path("out"), at.path("ckpt"), once=True))
    out = spark.read.schema(IMPRESSIONS).parquet(at.path("out"))
    return naive_times(out.where(F.col("request_id") != END))


def _enrich_topics(at: Streams) -> str:
    """Publish the three JSON topics and run the enrichment job on them; the path of its table."""
    at.publish("requests", datasets.requests, ["request_id", "user_id"])
    at.publish("wins", datasets.wins, ["request_id"])
    at.publish("clicks", datasets.clicks, ["request_id"])
    inputs = at.topic("requests", REQUESTS), at.topic("wins", WINS), at.topic("clicks", CLICKS)
    _run(jobs.enrichment_job(*inputs, at.path("impressions"), at.path("impressions_ckpt"), once=True))
    return at.path("impressions")


def topic_enriched_impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enrichment job from JSON topics to its table."""
    at = Streams(spark, sf_dir, "topic_enrich")
    out = spark.read.schema(IMPRESSIONS).option("recursiveFileLookup", "true").parquet(_enrich_topics(at))
    return naive_times(out.where(F.col("request_id") != END))


def chain_scored_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrichment, version history and scoring, each fed by what the job before has written.

    The marker of the first topic passes through all of them, and its version releases the scores."""
    at = Streams(spark, sf_dir, "chain")
    impressions = at.stream_of(_enrich_topics(at), IMPRESSIONS)
    _run(jobs.changelog_job(impressions, at.path("versions"), at.path("versions_ckpt"), once=True))
    versions = at.stream_of(at.path("versions"), PROFILES).withWatermark("update_time", OUT_OF_ORDER)
    requests = at.topic("requests", REQUESTS_FOR_SCORING).withWatermark("ts", OUT_OF_ORDER)
    save_model(spark, FIXED_MODEL, at.path("models"))
    _run(jobs.scoring_job(requests, versions, at.path("models"), at.path("out"), at.path("ckpt"), once=True))
    scored = spark.read.schema(SCORED_REQUESTS).option("recursiveFileLookup", "true").parquet(at.path("out"))
    return rounded(scored.where(F.col("request_id") != END), 9, "ctr_score")


def stream_user_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = Streams(spark, sf_dir, "profiles")
    impressions = at.stream_of(at.staged_impressions(), IMPRESSIONS)
    _run(jobs.profile_job(impressions, at.path("out"), at.path("ckpt"), once=True))
    return naive_times(current_rows(spark, at.path("out"), PROFILES, "user_id"))


def stream_profile_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = Streams(spark, sf_dir, "changelog")
    impressions = at.stream_of(at.staged_impressions(), IMPRESSIONS)
    _run(jobs.changelog_job(impressions, at.path("out"), at.path("ckpt"), once=True))
    return naive_times(read_changelog(spark, at.path("out")).select(*PROFILES.names))


def stream_fare_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = Streams(spark, sf_dir, "fares")
    _run(jobs.fare_totals_job(datasets.rides(at.events()), at.path("out"), at.path("ckpt"), once=True))
    return rounded(current_rows(spark, at.path("out"), FARE_TOTALS, "pickup"), 4, "total")


def stream_ride_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = Streams(spark, sf_dir, "rides")
    messages = datasets.ride_messages(at.events())
    _run(*jobs.tolerant_ride_job(messages, at.path("out"), at.path("rejects"), at.path("ckpt"), once=True))
    return _ride_fields(spark.read.text(at.path("out")))


def _staged_changelog(at: Streams, impressions: DataFrame | None = None) -> DataFrame:
    """A stream of profile versions with its end marker and watermark."""
    path = at.path("versions")
    derived = Inputs(at.spark, at.sf_dir)
    impressions = derived.impressions() if impressions is None else impressions
    profile_changelog(impressions, heavy=derived.heavy_users()).write.parquet(path)
    table = at.spark.read.schema(PROFILES).parquet(path)
    stream = _with_end(at.stream_of(path, PROFILES), table, ["user_id"], "update_time")
    # The marker may copy a row of any user with that id; only its time matters.
    return stream.withWatermark("update_time", OUT_OF_ORDER)


def stream_asof_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = Streams(spark, sf_dir, "scores")
    save_model(spark, FIXED_MODEL, at.path("models"))
    requests = at.derived(datasets.requests, ["request_id", "user_id"]).withWatermark("ts", OUT_OF_ORDER)
    writer = jobs.scoring_job(requests, _staged_changelog(at), at.path("models"), at.path("out"), at.path("ckpt"), once=True)
    _run(writer)
    scored = spark.read.schema(SCORED_REQUESTS).option("recursiveFileLookup", "true").parquet(at.path("out"))
    return rounded(scored.where(F.col("request_id") != END), 9, "ctr_score")


#: Examples of a step of the learner.
PER_STEP = 1000


def _learn(spark: SparkSession, sf_dir: str) -> Streams:
    """Run the learner over all impressions in order, with one gradient step for every mini-batch."""
    at = Streams(spark, sf_dir, "learn")
    path = at.staged_impressions()
    table = spark.read.schema(IMPRESSIONS).parquet(path)
    stream = _with_end(at.stream_of(path, IMPRESSIONS), table, ["user_id"], "event_time")
    _run(
        jobs.learning_job(
            stream.withWatermark("event_time", OUT_OF_ORDER), _staged_changelog(at, table), at.path("models"),
            at.path("out"), at.path("ckpt"), once=True, features=FIXED_MODEL.features,
            rate=LearningRate(steps_per_batch=1), per_step=PER_STEP,
        )
    )
    return at


def online_learner_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = _learn(spark, sf_dir)
    log = spark.read.schema("status STRING, examples BIGINT, batch_id BIGINT").parquet(at.path("out"))
    return log.groupBy("status").agg(F.sum("examples").alias("examples"))


def _weights(at: Streams) -> DataFrame:
    weights = models(at.spark, at.path("models"), "online").select("position", "feature", "weight", "examples")
    return rounded(weights, 9, "weight")


def online_model_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weights(_learn(spark, sf_dir))


def chain_learned_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrichment, version history and learner, each fed by what the job before has written."""
    at = Streams(spark, sf_dir, "learned_chain")
    impressions = at.stream_of(_enrich_topics(at), IMPRESSIONS)
    _run(jobs.changelog_job(impressions, at.path("versions"), at.path("versions_ckpt"), once=True))
    versions = at.stream_of(at.path("versions"), PROFILES).withWatermark("update_time", OUT_OF_ORDER)
    shown = impressions.withWatermark("event_time", OUT_OF_ORDER)
    _run(jobs.learning_job(shown, versions, at.path("models"), at.path("log"), at.path("ckpt"), once=True,
                           features=FIXED_MODEL.features, rate=LearningRate(steps_per_batch=1), per_step=PER_STEP))
    return _weights(at)


def serving_table_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign figures by SQL over a serving table that a topic has fed, with one of its batches delivered twice."""
    at = Streams(spark, sf_dir, "serving")
    rows = spark.read.schema(IMPRESSIONS).parquet(at.staged_impressions())
    for week in range(0, 31, 8):
        some = rows.where(F.dayofmonth("event_time").between(week + 1, week + 8))
        as_messages(some).coalesce(1).write.mode("append").text(at.path("topic"))
    _run(jobs.ingest_job(file_messages(at.session, at.path("topic"), 1), IMPRESSIONS, at.path("table"), at.path("ckpt"), once=True))
    ingest_to(at.path("table"), IMPRESSIONS, lambda batch: decode(batch, IMPRESSIONS))(spark.read.text(at.path("topic")), 1)
    serving_table(spark, at.path("table"), IMPRESSIONS).createOrReplaceTempView("impressions_served")
    return spark.sql(
        "SELECT COUNT(*) AS impressions, SUM(is_clicked) AS clicks, ROUND(try_divide(SUM(is_clicked), COUNT(*)), 6) AS ctr,"
        " ROUND(AVG(win_price), 6) AS avg_cpm FROM impressions_served")


def _failing_after(write, batch: int, times: int):
    """A writer that fails, after its work, the first ``times`` it meets one batch."""
    left = [times]

    def wrapped(rows: DataFrame, batch_id: int) -> None:
        write(rows, batch_id)
        if batch_id == batch and left[0]:
            left[0] -= 1
            raise RuntimeError("stopped in the middle of a batch")

    return wrapped


def recovered_fare_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fare totals of a job that was stopped twice in one micro-batch and started again from its checkpoint."""
    at = Streams(spark, sf_dir, "recovered")
    for part in range(3):
        datasets.rides(at.table.where(F.col("event_id") % 3 == part)).coalesce(1).write.mode("append").parquet(at.path("rides"))
    write = _failing_after(upsert_to(at.path("out")), 1, 2)

    def writer() -> DataStreamWriter:
        rides = at.session.readStream.schema(RIDES).option("maxFilesPerTrigger", 1).parquet(at.path("rides"))
        totals = fare_totals(rides).writeStream.outputMode("update").option("checkpointLocation", at.path("ckpt"))
        return totals.foreachBatch(write).trigger(availableNow=True)

    run_with_restarts(writer, attempts=3, delay_seconds=0.1)
    return rounded(current_rows(spark, at.path("out"), FARE_TOTALS, "pickup"), 4, "total")


def late_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests that the watermark drops of a topic that brings every twentieth request two files late."""
    at = Streams(spark, sf_dir, "late")
    part = F.least(F.floor((F.dayofmonth("ts") - 1) / 8) + F.when(F.col("request_id").cast("long") % 20 == 0, 2).otherwise(0), F.lit(3))
    rows = datasets.requests(at.table).withColumn("part", part)
    for n in range(4):
        rows.where(F.col("part") == n).drop("part").coalesce(1).write.mode("append").parquet(at.path("requests"))
    schema = spark.read.parquet(at.path("requests")).schema
    stream = at.session.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(at.path("requests"))
    _run(late_rows_job(stream, at.path("late"), at.path("ckpt"), once=True))
    out = read_table(spark, at.path("late"), T.StructType([*schema.fields, T.StructField("late_ms", T.LongType()), T.StructField("batch_id", T.LongType())]))
    return out.select("request_id", "late_ms", "batch_id")


UPSERTS = T.StructType(
    [T.StructField("user_id", T.StringType()), *[T.StructField(c, T.LongType()) for c in PROFILE_FEATURES], T.StructField("update_time", T.TimestampType())]
)


def _upsert_topic(at: Streams, parts: int = 4) -> str:
    """Publish the profile topic in several files, oldest changes first."""
    messages = datasets.profile_upserts(at.table)
    for part in range(parts):
        days = F.least(F.floor((F.dayofmonth("timestamp") - 1) * parts / 31), F.lit(parts - 1))
        topics.as_upsert_lines(messages.where(days == part)).coalesce(1).write.mode("append").text(at.path("profile_topic"))
    return at.path("profile_topic")


def upsert_topic_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests with the profile that an upsert topic of inserts, replacements and deletes gave their user at that time."""
    at = Streams(spark, sf_dir, "upserts")
    versions = topics.profile_versions(topics.file_upserts(at.session, _upsert_topic(at)), UPSERTS, "user_id", "update_time")
    table = topics.profile_versions(datasets.profile_upserts(at.table), UPSERTS, "user_id", "update_time")
    ended = _with_end(versions, table, ["user_id"], "update_time").withWatermark("update_time", OUT_OF_ORDER)
    requests = at.derived(datasets.requests, ["request_id", "user_id"]).select("request_id", "user_id", "ts").withWatermark("ts", OUT_OF_ORDER)
    _run(to_table(jobs.looked_up(requests, ended, "ts"), at.path("out"), at.path("ckpt"), once=True))
    out = spark.read.parquet(at.path("out")).where(F.col("request_id") != END)
    return naive_times(out)


def upsert_topic_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live rows of that topic from an upsert table that has been folded while it was written, and once more at the end."""
    at = Streams(spark, sf_dir, "upsert_table")
    versions = topics.profile_versions(topics.file_upserts(at.session, _upsert_topic(at), 1), UPSERTS, "user_id", "update_time")
    _run(to_upsert_table(versions, at.path("out"), at.path("ckpt"), once=True, mode="append", compact_every=2, key="user_id", order="offset"))
    compact(spark, at.path("out"), UPSERTS, "user_id", "offset")
    drop_folded(spark, at.path("out"), keep=1)
    return naive_times(current_rows(spark, at.path("out"), UPSERTS, "user_id", "offset"))


#: Days of January that each input of the quiet join brings events for, and its layout.
_QUIET = {"requests": (datasets.requests, 31, REQUESTS), "wins": (datasets.wins, 15, WINS), "clicks": (datasets.clicks, 23, CLICKS)}


#: Messages of a topic's file, at least, where eight days have several files.
PER_FILE = 100_000


def _publish_weekly(at: Streams, name: str, dataset, days: int) -> int:
    """Write the first days of a dataset as a topic of JSON messages, eight days after eight days; the files of each.

    Rows are dealt out one by one, so none of that many files is empty and a micro-batch of them holds eight days exactly."""
    rows = dataset(at.table).where(F.dayofmonth("ts") <= days).withColumn("timestamp_ts", F.unix_millis("ts"))
    week = F.expr("(dayofmonth(ts) - 1) div 8")
    found = {r["week"]: r["n"] for r in rows.groupBy(week.alias("week")).agg(F.count(F.lit(1)).alias("n")).collect()}
    weeks = range(0, -(-days // 8))
    files = max(1, min(found.get(n, 0) for n in weeks) // PER_FILE)
    for n in weeks:
        as_messages(rows.where(week == n).drop("ts")).repartition(files).write.mode("append").text(at.path(name))
    return files


def quiet_inputs_impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enrichment job over wins that go quiet first, then clicks, then requests, without any marker at their ends.

    A topic has equally many files for each eight days, and a micro-batch reads those of the next eight days of every topic that has any."""
    at = Streams(spark, sf_dir, "quiet")
    files = {name: _publish_weekly(at, name, dataset, days) for name, (dataset, days, _) in _QUIET.items()}
    idle = IdleInputs(at.session, at.path("beats"), timeout=1.0)
    at.session.streams.addListener(idle)
    try:
        inputs = [at.topic(name, schema, files[name]) for name, (_, _, schema) in _QUIET.items()]
        query = jobs.enrichment_job(*inputs, at.path("out"), at.path("ckpt"), idle=idle, trigger="100 milliseconds").start()
        last = at.table.agg(F.max(F.unix_millis(F.col("ts").cast("timestamp")))).first()[0]
        jobs.await_watermark(query, last - OUT_OF_ORDER_MS, timeout=900)
        query.stop()
    finally:
        at.session.streams.removeListener(idle)
    out = spark.read.schema(IMPRESSIONS).option("recursiveFileLookup", "true").parquet(at.path("out"))
    return naive_times(out)


STREAMS = {
    "chain_learned_model": chain_learned_model,
    "serving_table_kpis": serving_table_kpis,
    "recovered_fare_totals": recovered_fare_totals,
    "late_requests": late_requests,
    "upsert_topic_profiles": upsert_topic_profiles,
    "upsert_topic_current": upsert_topic_current,
    "quiet_inputs_impressions": quiet_inputs_impressions,
    "stream_enriched_impressions": stream_enriched_impressions,
    "topic_enriched_impressions": topic_enriched_impressions,
    "chain_scored_requests": chain_scored_requests,
    "stream_user_profiles": stream_user_profiles,
    "stream_profile_changelog": stream_profile_changelog,
    "stream_fare_totals": stream_fare_totals,
    "stream_ride_categories": stream_ride_categories,
    "stream_asof_scores": stream_asof_scores,
    "online_learner_status": online_learner_status,
    "online_model_weights": online_model_weights,
}
