import json
import random
import time
from pathlib import Path

import numpy as np
import pytest
from helpers import at, impressions, millis, offsets, requests, run, same_rows, topic_file, wins
from pyspark.sql import functions as F

from bidtide import schemas
from bidtide.functions.score import LinearModel
from bidtide.operators.asof import asof_join
from bidtide.operators.interval_join import enrich
from bidtide.operators import learning
from bidtide.operators.learning import LearningRate
from bidtide.operators.profiles import profile_changelog, user_profiles
from bidtide.operators.registry import load_latest, save_model
from bidtide.operators.skew import SkewPolicy
from bidtide.sinks.serving import ingest_to, serving_table
from bidtide.sinks.topics import as_messages, to_files, to_table
from bidtide.sinks.upsert import batches, compact, current_rows, drop_folded, write_batch
from bidtide.sources import topics
from bidtide.sources.tables import read_changelog, read_table, report
from bidtide.streaming import jobs
from bidtide.streaming.asof import stream_asof_join
from bidtide.streaming.changelog import changelog_writer
from bidtide.streaming.idle import IdleInputs
from bidtide.streaming.late import late_rows_job
from bidtide.streaming.restart import run_with_restarts

FAR = 10**9


def stream(session, path, schema, per_trigger=1, time="ts", **kw):
    return topics.with_event_time(topics.decode(topics.file_messages(session, str(path), per_trigger), schema), time, **kw)


def request(rid, ms, user="u1"):
    return {"request_id": rid, "timestamp_ts": millis(ms), "user_id": user, "os": "iOS", "site_category": "Tech"}


def win(rid, ms):
    return {"request_id": rid, "timestamp_ts": millis(ms), "campaign_id": "c", "win_price": 1.5}


def click(rid, ms, action="click"):
    return {"request_id": rid, "timestamp_ts": millis(ms), "user_action": action}


def impression(user, category, clicked, ms):
    text = at(ms).strftime("%Y-%m-%d %H:%M:%S.") + f"{ms % 1000:03d}"
    return {"request_id": f"r{ms}", "user_id": user, "os": "iOS", "site_category": category, "is_clicked": clicked, "event_time": text}


def enrichment(session, tmp_path, out="out"):
    sources = [stream(session, tmp_path / n, s, delay=None) for n, s in
               (("r", schemas.REQUESTS), ("w", schemas.WINS), ("c", schemas.CLICKS))]
    return to_table(jobs.stream_enrich(*sources), str(tmp_path / out), str(tmp_path / f"ckpt_{out}"), once=True)


def test_enrichment_over_several_batches_equals_batch(spark, streaming, tmp_path):
    for n in range(4):
        ids = [f"r{n}_{i}" for i in range(30)]
        topic_file(tmp_path / "r", n, *[request(r, n * 20_000 + i * 500) for i, r in enumerate(ids)])
        topic_file(tmp_path / "w", n, *[win(r, n * 20_000 + i * 500 + i * 400 % 6000) for i, r in enumerate(ids) if i % 3])
        topic_file(tmp_path / "c", n, *[click(r, n * 20_000 + i * 500 + i * 400 % 6000 + i * 900 % 13000) for i, r in enumerate(ids) if i % 2])
    for folder, message in (("r", request), ("w", win), ("c", click)):
        topic_file(tmp_path / folder, 9, message("end", FAR))
    run(enrichment(streaming, tmp_path))
    got = spark.read.parquet(str(tmp_path / "out")).where("request_id <> 'end'")

    def table(folder, schema):
        return topics.with_event_time(topics.decode(spark.read.text(str(tmp_path / folder)), schema), delay=None)

    expected = enrich(table("r", schemas.REQUESTS), table("w", schemas.WINS), table("c", schemas.CLICKS))
    same_rows(got, expected.where("request_id <> 'end'"))
    assert got.where("is_clicked = 1").count() > 5


def test_quiet_clicks_do_not_hold_back_impressions(spark, streaming, tmp_path):
    ids = [f"r{i}" for i in range(400)]
    topic_file(tmp_path / "r", 0, *[request(r, i * 1000) for i, r in enumerate(ids)])
    topic_file(tmp_path / "w", 0, *[win(r, i * 1000 + 10) for i, r in enumerate(ids)])
    topic_file(tmp_path / "c", 0, click("r0", 20))
    run(enrichment(streaming, tmp_path))
    got = {r.request_id: r.is_clicked for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    # Only the click at the very start advances the click stream by itself; heartbeats release the rest.
    assert got["r0"] == 1 and len(got) > 200 and sum(got.values()) == 1


def test_restart_from_checkpoint_neither_loses_nor_repeats(spark, streaming, tmp_path):
    topic_file(tmp_path / "r", 0, request("a", 0), request("b", 1000))
    topic_file(tmp_path / "w", 0, win("a", 100))
    topic_file(tmp_path / "c", 0, click("zzz", 0))
    run(enrichment(streaming, tmp_path))
    topic_file(tmp_path / "w", 1, win("b", 1100), win("end", FAR))
    topic_file(tmp_path / "r", 1, request("end", FAR))
    topic_file(tmp_path / "c", 1, click("a", 200), click("end", FAR))
    run(enrichment(streaming, tmp_path))
    run(enrichment(streaming, tmp_path))
    rows = spark.read.parquet(str(tmp_path / "out")).where("request_id <> 'end'").collect()
    assert sorted((r.request_id, r.is_clicked) for r in rows) == [("a", 1), ("b", 0)]


@pytest.fixture()
def impression_topic(tmp_path):
    batches = [
        [("u1", "Tech", 1, 10), ("u1", "News", 0, 20), ("u2", "Lifestyle", 1, 15)],
        [("u1", "Tech", 0, 30), ("u1", "Lifestyle", 1, 40), ("u2", "Tech", 1, 50)],
    ]
    for n, rows in enumerate(batches):
        topic_file(tmp_path / "imp", n, *[impression(*r) for r in rows])
    return [r for rows in batches for r in rows]


def test_profiles_keep_the_latest_row_per_user(spark, streaming, tmp_path, impression_topic):
    rows = stream(streaming, tmp_path / "imp", schemas.IMPRESSIONS_FOR_PROFILES, time="event_time")
    out = str(tmp_path / "profiles")
    run(jobs.profile_job(rows, out, str(tmp_path / "ckpt"), once=True))
    flat = impressions(spark, *[("r", u, c, k, t) for u, c, k, t in impression_topic])
    current = current_rows(spark, out, schemas.PROFILES, "user_id")
    same_rows(current, user_profiles(flat))
    assert read_changelog(spark, out).count() == 4
    assert compact(spark, out, schemas.PROFILES, "user_id") == max(batches(spark, out))
    same_rows(current_rows(spark, out, schemas.PROFILES, "user_id"), user_profiles(flat))


def test_changelog_has_every_version(spark, streaming, tmp_path, impression_topic):
    rows = stream(streaming, tmp_path / "imp", schemas.IMPRESSIONS_FOR_PROFILES, time="event_time")
    out = str(tmp_path / "log")
    run(jobs.changelog_job(rows, out, str(tmp_path / "ckpt"), once=True))
    flat = impressions(spark, *[("r", u, c, k, t) for u, c, k, t in impression_topic])
    same_rows(read_changelog(spark, out).select(*schemas.PROFILES.names), profile_changelog(flat))
    same_rows(current_rows(spark, out, schemas.PROFILES, "user_id", order="total_views"), user_profiles(flat))


@pytest.mark.parametrize("records", [100, 10_000])
def test_changelog_orders_whole_micro_batches(spark, streaming, tmp_path, records):
    """One user, 30,000 events in no order in one micro-batch, whatever the transfer's batch size."""
    order = [i * 7919 % 30_000 for i in range(30_000)]
    topic_file(tmp_path / "imp", 0, *[impression("u", "Tech" if i % 3 else "Lifestyle", i % 2, i) for i in order])
    rows = stream(streaming, tmp_path / "imp", schemas.IMPRESSIONS_FOR_PROFILES, time="event_time")
    out, was = str(tmp_path / "log"), streaming.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    streaming.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(records))
    try:
        run(jobs.changelog_job(rows, out, str(tmp_path / "ckpt"), once=True))
    finally:
        streaming.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    flat = impressions(spark, *[("r", "u", "Tech" if i % 3 else "Lifestyle", i % 2, i) for i in order])
    got, want = read_changelog(spark, out).select(*schemas.PROFILES.names), profile_changelog(flat)
    assert got.count() == 30_000 and got.exceptAll(want).count() == 0


def test_changelog_times_never_go_back(spark, streaming, tmp_path):
    topic_file(tmp_path / "imp", 0, impression("u", "Tech", 0, 1000))
    topic_file(tmp_path / "imp", 1, impression("u", "News", 0, 400))
    rows = stream(streaming, tmp_path / "imp", schemas.IMPRESSIONS_FOR_PROFILES, time="event_time", delay=None)
    out = str(tmp_path / "log")
    run(jobs.changelog_job(rows, out, str(tmp_path / "ckpt"), once=True))
    got = offsets(read_changelog(spark, out), "update_time").orderBy("total_views").collect()
    assert [(r.total_views, r.update_time) for r in got] == [(1, 1000), (2, 1000)]


def test_changelog_cuts_a_heavy_user_over_tasks(spark, streaming, tmp_path):
    """A million events of one user in one micro-batch, after one that left totals; equal to batch, in bounded pieces."""
    def events(first, last):
        when = F.timestamp_millis(F.lit(millis(0)) + F.col("id") * 7919 % 1_000_000)
        return spark.range(first, last).select(
            F.lit("u").alias("user_id"), F.when(F.col("id") % 3 == 0, "Tech").otherwise("Lifestyle").alias("site_category"),
            (F.col("id") % 2).cast("int").alias("is_clicked"), when.alias("event_time"))

    earlier = events(0, 10).withColumn("event_time", F.timestamp_millis(F.lit(millis(-100))))
    policy, out, ckpt = SkewPolicy(rows_per_task=100_000), str(tmp_path / "log"), str(tmp_path / "ckpt")
    for n, rows in enumerate((earlier, events(0, 1_000_000))):
        rows.coalesce(2).write.parquet(str(tmp_path / "imp" / f"part={n}"))
        source = streaming.readStream.schema(schemas.IMPRESSIONS_FOR_PROFILES).option("recursiveFileLookup", "true").parquet(str(tmp_path / "imp"))
        run(jobs.changelog_job(source, out, ckpt, once=True, policy=policy))
    got, want = read_changelog(spark, out).select(*schemas.PROFILES.names), profile_changelog(earlier.unionByName(events(0, 1_000_000)))
    assert got.count() == 1_000_001 and got.exceptAll(want).count() == 0


def test_a_repeated_micro_batch_of_versions_gives_the_same(spark, tmp_path):
    work = changelog_writer(str(tmp_path / "log"), str(tmp_path / "totals"))
    batches = [impressions(spark, ("r", "u", "Tech", 1, 5), ("r", None, "Tech", 0, 7)), impressions(spark, ("r", "u", "Lifestyle", 1, 6), ("r", None, "Tech", 1, 9))]
    for n in (0, 0, 1, 1):
        work(batches[n], n)
    got = offsets(read_changelog(spark, str(tmp_path / "log")), "update_time").orderBy("batch_id", F.col("user_id").asc_nulls_first()).collect()
    assert [tuple(r)[:7] for r in got] == [(None, 1, 1, 0, 0, 0, 7), ("u", 1, 1, 1, 0, 0, 5), (None, 2, 2, 1, 0, 0, 9), ("u", 2, 1, 1, 1, 1, 6)]


def versions_topic(folder, *batches):
    for n, rows in enumerate(batches):
        topic_file(folder, n, *[{"user_id": u, "timestamp_ts": millis(t), "v": v} for u, t, v in rows])


VERSION_SCHEMA = "user_id STRING, timestamp_ts BIGINT, v BIGINT"


@pytest.mark.parametrize("inclusive,heavy", [(True, []), (False, []), (True, ["k"])])
def test_streaming_asof_equals_batch(spark, streaming, tmp_path, inclusive, heavy):
    log = [[("k", t, t * 10) for t in range(0, 5000, 400)], [("k", t, t * 10) for t in range(5200, 20000, 700)], [("end", FAR, 0)]]
    versions_topic(tmp_path / "v", *log)
    asked = [[("k", t) for t in range(0, 6000, 100)], [("k", t) for t in range(6000, 21000, 350)] + [("nobody", 9000), (None, 9000)], [("end", FAR)]]
    for n, rows in enumerate(asked):
        topic_file(tmp_path / "p", n, *[request(f"{u}{t}", t, u) for u, t in rows])
    probes = stream(streaming, tmp_path / "p", schemas.REQUESTS_FOR_SCORING).select("request_id", "user_id", "ts")
    from pyspark.sql import types as T

    fields = T.StructType().add("user_id", T.StringType()).add("timestamp_ts", T.LongType()).add("v", T.LongType())
    versions = stream(streaming, tmp_path / "v", fields)
    joined = stream_asof_join(probes, versions, "user_id", "ts", "ts", ["v"], inclusive=inclusive, heavy_keys=heavy, lanes=3)
    run(to_table(joined, str(tmp_path / "out"), str(tmp_path / "ckpt"), once=True))
    got = spark.read.parquet(str(tmp_path / "out")).where("request_id NOT LIKE 'end%'")
    flat_probes = requests(spark, *[(f"{u}{t}", t, u, "", "") for rows in asked for u, t in rows]).select("request_id", "user_id", "ts")
    flat_versions = spark.createDataFrame([(u, at(t), v) for rows in log for u, t, v in rows], "user_id STRING, vt TIMESTAMP, v LONG")
    expected = asof_join(flat_probes, flat_versions, "user_id", "ts", "vt", ["v"], inclusive=inclusive)
    same_rows(got, expected.where("request_id NOT LIKE 'end%'"))


@pytest.mark.parametrize("inclusive", [True, False])
def test_asof_state_is_cut_into_blocks(spark, streaming, tmp_path, inclusive):
    """One user with nearly all rows, in no order, over several micro-batches and many blocks of 16 rows; versions of one time
    replace each other, also from a later micro-batch."""
    from pyspark.sql import types as T

    rng = random.Random(3)
    fields = T.StructType().add("user_id", T.StringType()).add("timestamp_ts", T.LongType()).add("v", T.LongType())
    log, asked = [], []
    for n in range(3):
        times = [n * 2000 + rng.randrange(2600) for _ in range(400)]
        log.append([("hot", t, n * 10_000 + i) for i, t in enumerate(times)] + [("cold", n * 2000, n)])
        asked.append([("hot", n * 2000 + rng.randrange(2600)) for _ in range(500)] + [("cold", n * 2000 + 5)])
    log.append([("end", FAR, 0)])
    asked.append([("end", FAR)])
    versions_topic(tmp_path / "v", *log)
    for n, rows in enumerate(asked):
        topic_file(tmp_path / "p", n, *[request(f"{n}_{i}_{u}", t, u) for i, (u, t) in enumerate(rows)])
    probes = stream(streaming, tmp_path / "p", schemas.REQUESTS_FOR_SCORING).select("request_id", "user_id", "ts")
    joined = stream_asof_join(probes, stream(streaming, tmp_path / "v", fields), "user_id", "ts", "ts", ["v"], inclusive=inclusive, block=16)
    run(to_table(joined, str(tmp_path / "out"), str(tmp_path / "ckpt"), once=True))
    got = {r.request_id: r.v for r in spark.read.parquet(str(tmp_path / "out")).where("user_id <> 'end'").collect()}
    latest = {}
    for rows in log:
        latest.update({(u, t): v for u, t, v in rows})  # the last to arrive
    want = {}
    for n, rows in enumerate(asked[:-1]):
        for i, (u, t) in enumerate(rows):
            past = [vt for vu, vt in latest if vu == u and (vt <= t if inclusive else vt < t)]
            want[f"{n}_{i}_{u}"] = latest[u, max(past)] if past else None
    assert got == want


def test_deletes_end_a_profile_in_streams(spark, streaming, tmp_path):
    from pyspark.sql import types as T

    table = T.StructType().add("user_id", T.StringType()).add("total_views", T.LongType()).add("update_time", T.TimestampType())
    time_text = lambda ms: at(ms).strftime("%Y-%m-%d %H:%M:%S.") + f"{ms % 1000:03d}"
    changes = [("a", 100, 1), ("a", 200, None), ("a", 300, 3), ("b", 150, None), ("b", 160, 5), (None, 170, 7)]
    topic_file(tmp_path / "v", 0, *[
        {"key": None if u is None else json.dumps({"user_id": u}), "value": None if v is None else json.dumps({"total_views": v, "update_time": time_text(t)}),
         "timestamp": millis(t), "offset": n} for n, (u, t, v) in enumerate([*changes, ("end", FAR, 0)])])
    topic_file(tmp_path / "p", 0, *[request(f"{u}{t}", t, u) for u in "ab" for t in (99, 100, 155, 199, 200, 299, 300)], request("end", FAR, "end"))
    versions = topics.profile_versions(topics.file_upserts(streaming, str(tmp_path / "v")), table, "user_id", "update_time")
    probes = stream(streaming, tmp_path / "p", schemas.REQUESTS_FOR_SCORING).select("request_id", "user_id", "ts")
    joined = stream_asof_join(probes, versions.withWatermark("update_time", "5 seconds"), "user_id", "ts", "update_time", ["total_views"], deleted="deleted")
    run(to_table(joined, str(tmp_path / "out"), str(tmp_path / "ckpt"), once=True))
    got = {r.request_id: r.total_views for r in spark.read.parquet(str(tmp_path / "out")).where("user_id <> 'end'").collect()}
    assert got == {"a99": None, "a100": 1, "a155": 1, "a199": 1, "a200": None, "a299": None, "a300": 3,
                   "b99": None, "b100": None, "b155": None, "b199": 5, "b200": 5, "b299": 5, "b300": 5}


def test_idle_inputs_get_beats(spark, streaming, tmp_path):
    now = [0.0]
    idle = IdleInputs(streaming, str(tmp_path / "beats"), timeout=5, clock=lambda: now[0])
    topic_file(tmp_path / "r", 0, request("a", 0))
    for name in ("requests", "wins", "clicks"):
        idle.watched(name, stream(streaming, tmp_path / "r", schemas.REQUESTS, delay=None))
    sent = lambda: {n: sorted(json.loads(p.read_text())["ms"] for p in (tmp_path / "beats" / n).glob("beat-*")) for n in idle.inputs}
    idle.progressed({"requests": (3, 100), "wins": (2, 90), "clicks": (0, None)})
    assert sent() == {"requests": [], "wins": [], "clicks": []}
    now[0] = 6
    idle.progressed({"requests": (3, 200), "wins": (1, 150), "clicks": (0, None)})
    # Clicks never came; the slower of the active inputs is what they are carried to.
    assert sent() == {"requests": [], "wins": [], "clicks": [150]}
    now[0] = 12
    idle.progressed({"requests": (1, 300), "wins": (0, None), "clicks": (0, None)})
    assert sent() == {"requests": [], "wins": [300], "clicks": [150, 300]}
    idle.progressed({"requests": (1, 250), "wins": (1, 160), "clicks": (0, None)})
    now[0] = 30
    idle.check()  # all are quiet: the furthest counts, and nobody is behind it
    assert sent() == {"requests": [], "wins": [300], "clicks": [150, 300]}
    idle.progressed({"requests": (0, None), "wins": (0, None), "clicks": (1, 900)})
    now[0] = 40
    idle.check()
    assert sent() == {"requests": [900], "wins": [300, 900], "clicks": [150, 300]}


def test_an_input_that_never_comes_is_waited_for_until_it_is_idle(streaming, tmp_path):
    now = [0.0]
    idle = IdleInputs(streaming, str(tmp_path / "beats"), timeout=5, clock=lambda: now[0])
    topic_file(tmp_path / "r", 0, request("a", 0))
    for name in "ab":
        idle.watched(name, stream(streaming, tmp_path / "r", schemas.REQUESTS, delay=None))
    now[0] = 3
    assert idle.due() == {}
    idle.progressed({"a": (1, 70), "b": (0, None)})
    assert idle.due() == {}
    now[0] = 6
    assert idle.due() == {"b": 70}


def test_scoring_reloads_the_model_for_every_batch(spark, streaming, tmp_path):
    models, out, ckpt = (str(tmp_path / n) for n in ("models", "out", "ckpt"))
    from pyspark.sql import types as T

    fields = T.StructType().add("user_id", T.StringType()).add("timestamp_ts", T.LongType())
    for name in schemas.PROFILE_FEATURES:
        fields = fields.add(name, T.LongType())

    def score():
        asked = stream(streaming, tmp_path / "p", schemas.REQUESTS_FOR_SCORING, per_trigger=None)
        profiles = stream(streaming, tmp_path / "v", fields, per_trigger=None)
        profiles = profiles.withColumnRenamed("ts", "update_time")
        run(jobs.scoring_job(asked, profiles, models, out, ckpt, once=True))

    def feed(n, ms):
        topic_file(tmp_path / "p", n, request(f"q{n}", ms), request(f"end{n}", ms + 60_000, "end"))
        topic_file(tmp_path / "v", n, {"user_id": "u1", "timestamp_ts": millis(ms), "total_views": 4, "tech_views": 2, "lifestyle_views": 1},
                   {"user_id": "end", "timestamp_ts": millis(ms + 60_000)})

    for n, model in enumerate([None, LinearModel(["frac_tech"], [2.0], -1.0), LinearModel(["os_iOS"], [0.0], 40.0, "online", 1)]):
        if model:
            save_model(spark, model, models)
        feed(n, n * 100_000)
        score()
    scored = spark.read.option("recursiveFileLookup", "true").parquet(out)
    got = {r.request_id: r.ctr_score for r in scored.where("request_id LIKE 'q%'").collect()}
    assert got["q0"] == 0.0 and got["q1"] == pytest.approx(0.5) and got["q2"] == pytest.approx(1.0)


def test_static_scores_are_json_messages(spark, streaming, tmp_path):
    versions_topic(tmp_path / "v", [("u1", 0, 1), ("end", 60_000, 0)])
    topic_file(tmp_path / "p", 0, request("a", 5), request("b", 7, "new"), request("end", 60_000, "end"))
    asked = stream(streaming, tmp_path / "p", schemas.REQUESTS_FOR_SCORING)
    from pyspark.sql import types as T

    fields = T.StructType().add("user_id", T.StringType()).add("timestamp_ts", T.LongType()).add("v", T.LongType())
    profiles = stream(streaming, tmp_path / "v", fields).withColumnRenamed("ts", "update_time")
    profiles = profiles.withColumns({"total_views": F.lit(2) * F.col("v"), "tech_views": F.col("v"), "lifestyle_views": F.lit(0) * F.col("v")})
    model = LinearModel(["frac_tech"], [3.0], -1.5)
    run(jobs.static_scoring_job(asked, profiles, model, str(tmp_path / "o"), str(tmp_path / "c"), once=True))
    got = {r.request_id: r.ctr_score for r in spark.read.json(str(tmp_path / "o")).collect()}
    assert got["a"] == pytest.approx(0.5) and got["b"] == pytest.approx(0.18242552380635635)


def test_upsert_topic_round_trip(spark):
    from pyspark.sql import types as T

    table = T.StructType().add("user_id", T.StringType()).add("total_views", T.LongType()).add("update_time", T.TimestampType())
    rows = spark.createDataFrame([("a", 3, at(5)), ("b", None, at(6))], table)
    messages = as_messages(rows, key=["user_id"]).withColumn("offset", F.lit(1))
    deleted = spark.createDataFrame([('{"user_id":"a"}', None, 2)], "key STRING, value STRING, offset INT")
    back = topics.decode_upserts(messages.unionByName(deleted), table, "user_id")
    same_rows(back.where("not deleted").select(*table.names), rows)
    assert [(r.user_id, r.offset) for r in back.where("deleted").collect()] == [("a", 2)]


def test_learning_writes_versions_and_status(spark, streaming, tmp_path):
    models, log, ckpt = (str(tmp_path / n) for n in ("models", "log", "ckpt"))
    from pyspark.sql import types as T

    fields = T.StructType().add("user_id", T.StringType()).add("timestamp_ts", T.LongType())
    for name in schemas.PROFILE_FEATURES:
        fields = fields.add(name, T.LongType())

    def learn():
        rows = stream(streaming, tmp_path / "imp", schemas.IMPRESSIONS_FOR_LEARNING, None, time="event_time")
        profiles = stream(streaming, tmp_path / "v", fields, None).withColumnRenamed("ts", "update_time")
        run(jobs.learning_job(rows, profiles, models, log, ckpt, once=True, per_step=9))

    topic_file(tmp_path / "imp", 0, *[impression("u1", "Tech", i % 2, i) for i in range(20)], impression("broken", "Tech", 1, 5),
               impression("end", "Tech", 0, 60_000))
    topic_file(tmp_path / "v", 0, {"user_id": "u1", "timestamp_ts": millis(0), "total_views": 4, "tech_views": 2, "lifestyle_views": 1},
               {"user_id": "broken", "timestamp_ts": millis(0), "total_views": 4}, {"user_id": "end", "timestamp_ts": millis(60_000)})
    with pytest.raises(Exception, match="no feature list"):
        learn()
    save_model(spark, LinearModel(["frac_tech", "site_category_Tech"], [0.0, 0.0]), models)
    learn()
    status = {r.status: r.examples for r in spark.read.parquet(log).groupBy("status").agg(F.sum("examples").alias("examples")).collect()}
    # Two of the twenty wait for a third mini-batch.
    assert status == {"Updated": 18, "Error": 1}
    assert load_latest(spark, models, "online").examples == 18


@pytest.mark.parametrize("in_task", [20, 90])
def test_weights_are_those_of_mini_batches_in_order(monkeypatch, spark, streaming, tmp_path, in_task):
    """One micro-batch or several, steps as sums or several in a task: the same weights, those of plain steps over the examples
    in order of time."""
    monkeypatch.setattr(learning, "IN_TASK", in_task)
    from pyspark.sql import types as T

    fields = T.StructType().add("user_id", T.StringType()).add("timestamp_ts", T.LongType())
    for name in schemas.PROFILE_FEATURES:
        fields = fields.add(name, T.LongType())
    rng = random.Random(5)
    shown = [(f"u{rng.randrange(4)}", rng.choice(["Tech", "News"]), rng.randrange(2), 60 * i + rng.randrange(50)) for i in range(203)]
    names, per_step, rate = ["frac_tech", "site_category_Tech"], 20, LearningRate(steps_per_batch=2)
    weights = np.zeros(3)
    for step in range(len(shown) // per_step):
        part = sorted(shown, key=lambda r: r[3])[step * per_step : (step + 1) * per_step]
        x = np.array([[1.0, int(u[1]) / 10, float(c == "Tech")] for u, c, _, _ in part])
        for i in range(2):
            error = 1 / (1 + np.exp(-x @ weights)) - [k for _, _, k, _ in part]
            eta = rate.at(step * 2 + i)
            weights = weights * [1, 1 - eta * rate.alpha, 1 - eta * rate.alpha] - eta * x.T @ error / per_step
    for cuts in (1, 5):
        base = tmp_path / str(cuts)
        topic_file(base / "v", 0, *[{"user_id": f"u{i}", "timestamp_ts": millis(-1000), "total_views": 10, "tech_views": i, "lifestyle_views": 1} for i in range(4)],
                   {"user_id": "end", "timestamp_ts": millis(FAR)})
        arrived = sorted(shown, key=lambda r: r[3] + rng.randrange(100))  # a little out of order, across files too
        for n in range(cuts):
            part = [r for i, r in enumerate(arrived) if i * cuts // len(shown) == n]
            topic_file(base / "imp", n, *[impression(*r) for r in rng.sample(part, len(part))])
        topic_file(base / "imp", cuts, impression("end", "Tech", 0, FAR))
        rows = stream(streaming, base / "imp", schemas.IMPRESSIONS_FOR_LEARNING, time="event_time")
        profiles = stream(streaming, base / "v", fields, None).withColumnRenamed("ts", "update_time")
        run(jobs.learning_job(rows, profiles, str(base / "models"), str(base / "log"), str(base / "ckpt"), once=True, features=names, rate=rate, per_step=per_step))
        model = load_latest(spark, str(base / "models"), "online")
        assert model.examples == 200 and [model.intercept, *model.weights] == pytest.approx(weights.tolist(), abs=1e-9)


def test_late_rows_are_those_the_watermark_drops(spark, streaming, tmp_path):
    batches_of = [[0, 9000, 20_000], [1000, 40_000], [14_999, 15_000, 15_001, 60_000], [34_999, 36_000, 100]]
    for n, times in enumerate(batches_of):
        topic_file(tmp_path / "r", n, *[request(f"{n}_{t}", t) for t in times])
    rows = stream(streaming, tmp_path / "r", schemas.REQUESTS_FOR_SCORING, delay=None)
    run(late_rows_job(rows, str(tmp_path / "late"), str(tmp_path / "ckpt"), once=True))
    got = {(r.request_id, r.late_ms) for r in spark.read.parquet(str(tmp_path / "late")).collect()}
    assert got == {("2_14999", 1), ("2_15000", 0), ("3_34999", 1), ("3_100", 34_900)}
    counted = rows.withWatermark("ts", "5 seconds").groupBy("request_id", "ts").count().writeStream.outputMode("append")
    query = counted.format("noop").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]) == 4


def test_serving_batches_are_committed_once(spark, streaming, tmp_path):
    path = str(tmp_path / "serving")
    assert serving_table(spark, path, schemas.RIDES).count() == 0
    for n in range(3):
        topic_file(tmp_path / "t", n, {"ride_id": n, "pickup": "x", "fare": 1.5, "more": True})
    job = jobs.ingest_job(topics.file_messages(streaming, str(tmp_path / "t"), 1), schemas.RIDES, path, str(tmp_path / "c"), once=True)
    run(job)
    again = spark.createDataFrame([('{"ride_id": 7, "pickup": "y"}',)], "value STRING")
    ingest_to(path, schemas.RIDES, lambda m: topics.decode(m, schemas.RIDES))(again, 1)
    assert sorted(r.ride_id for r in serving_table(spark, path, schemas.RIDES).collect()) == [0, 1, 2]


def test_fare_totals_and_ride_jobs(spark, streaming, tmp_path):
    good = [{"ride_id": 1, "pickup": "Manhattan", "fare": 12.5}, {"ride_id": 2, "pickup": "Brooklyn", "fare": 8.0}]
    topic_file(tmp_path / "rides", 0, *good)
    topic_file(tmp_path / "rides", 1, {"ride_id": 3, "pickup": "Brooklyn", "fare": 15.0})
    typed = topics.decode(topics.file_messages(streaming, str(tmp_path / "rides"), 1), schemas.RIDES)
    out = str(tmp_path / "totals")
    run(jobs.fare_totals_job(typed, out, str(tmp_path / "c1"), once=True))
    assert {r.pickup: r.total for r in current_rows(spark, out, schemas.FARE_TOTALS, "pickup").collect()} == {"Manhattan": 12.5, "Brooklyn": 23.0}

    run(jobs.ride_job(topics.file_messages(streaming, str(tmp_path / "rides")), str(tmp_path / "strict"), str(tmp_path / "c2"), once=True))
    assert spark.read.json(str(tmp_path / "strict")).where("fare_category = 'expensive'").first().ride_id == 3

    topic_file(tmp_path / "rides", 2, "broken", '{"fare":"12"}')
    messages = topics.file_messages(streaming, str(tmp_path / "rides"))
    run(*jobs.tolerant_ride_job(messages, str(tmp_path / "ok"), str(tmp_path / "bad"), str(tmp_path / "c3"), once=True))
    assert spark.read.json(str(tmp_path / "ok")).count() == 3
    assert {r.reason for r in spark.read.parquet(str(tmp_path / "bad")).collect()} == {"not JSON", "fare is not a number"}


def test_malformed_topic_messages(spark, streaming, tmp_path):
    topic_file(tmp_path / "t", 0, click("a", 1), "broken")
    with pytest.raises(Exception, match="malformed message"):
        topics.decode(spark.read.text(str(tmp_path / "t")), schemas.CLICKS).select("request_id").collect()
    kept = topics.decode(spark.read.text(str(tmp_path / "t")), schemas.CLICKS, on_error="drop")
    assert [r.request_id for r in kept.collect()] == ["a"]


def test_messages_carry_nulls_and_millisecond_times(spark, streaming, tmp_path):
    rows = impressions(spark, ("a", None, "Tech", 1, 123))
    message = as_messages(rows.select("request_id", "user_id", "event_time"), key=["request_id"]).first()
    assert message.key == '{"request_id":"a"}'
    assert message.value == '{"request_id":"a","user_id":null,"event_time":"2024-05-01 00:00:00.123"}'
    as_messages(rows).write.text(str(tmp_path / "m"))
    back = topics.decode(topics.file_messages(streaming, str(tmp_path / "m")), schemas.IMPRESSIONS)
    run(to_files(as_messages(back), str(tmp_path / "o"), str(tmp_path / "c"), once=True))
    assert spark.read.text(str(tmp_path / "o")).first().value == as_messages(rows).first().value


def test_upserts_are_idempotent_and_deletes_remove(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "user_id STRING, total LONG, deleted BOOLEAN"
    from pyspark.sql import types as T

    table = T.StructType().add("user_id", T.StringType()).add("total", T.LongType())
    assert current_rows(spark, path, table, "user_id").count() == 0
    for _ in range(2):
        write_batch(spark.createDataFrame([("a", 1, False), ("b", 1, False)], schema), path, 0)
    write_batch(spark.createDataFrame([("a", 2, False), ("b", None, True)], schema), path, 1)
    assert [tuple(r) for r in current_rows(spark, path, table, "user_id").collect()] == [("a", 2)]


def test_snapshots_replace_old_batches(spark, tmp_path):
    """Reads merge one snapshot and the batches after it, whatever has been folded or dropped."""
    from pyspark.sql import types as T

    path, table = str(tmp_path / "t"), T.StructType().add("k", T.StringType()).add("v", T.LongType())
    live, rng = {}, random.Random(7)
    history = []
    for n in range(9):
        changes = {f"k{rng.randrange(12)}": rng.choice([None, n * 100 + i]) for i in range(5)}
        write_batch(spark.createDataFrame([(k, v, v is None) for k, v in changes.items()], "k STRING, v LONG, deleted BOOLEAN"), path, n)
        live = {k: v for k, v in {**live, **changes}.items() if v is not None}
        history.append(dict(live))
        if n in (2, 5, 7):
            # The batch at hand may be repeated, so it is not folded.
            assert compact(spark, path, table, "k", through=n - 1) == n - 1
            drop_folded(spark, path)
        assert {r.k: r.v for r in current_rows(spark, path, table, "k").collect()} == live
    assert batches(spark, path) == [5, 6, 7, 8]  # the two newest snapshots hold batches up to 4 and 6
    assert {r.k: r.v for r in current_rows(spark, path, table, "k", through=6).collect()} == history[6]
    merged = current_rows(spark, path, table, "k")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    # One scan of the newest snapshot, and one whose partitions are pruned to newer batches.
    assert plan.count("FileScan parquet") == 2 and "PartitionFilters: [isnotnull(batch_id" in plan and "> 6)" in plan
    assert {f.split("_snapshots/")[1][:12] for f in merged.inputFiles() if "_snapshots/" in f} == {"000000000006"}
    assert compact(spark, path, table, "k") == 8 and compact(spark, path, table, "k") == 8
    drop_folded(spark, path, keep=1)
    assert batches(spark, path) == [] and {r.k: r.v for r in current_rows(spark, path, table, "k").collect()} == live


def test_changes_inside_a_batch_follow_their_order(spark, tmp_path):
    from pyspark.sql import types as T

    path, table = str(tmp_path / "t"), T.StructType().add("k", T.StringType()).add("v", T.LongType())
    changes = "k STRING, v LONG, deleted BOOLEAN, offset LONG"
    write_batch(spark.createDataFrame([("a", 1, False, 10), ("a", 2, False, 11), ("b", 3, False, 12), ("b", None, True, 13)], changes), path, 0)
    compact(spark, path, table, "k", "offset")
    # Offsets of another partition may be lower; later batches are later all the same.
    write_batch(spark.createDataFrame([("a", 5, False, 3), ("b", 6, False, 4), ("b", 7, False, 5)], changes), path, 1)
    for _ in range(2):
        assert sorted(map(tuple, current_rows(spark, path, table, "k", "offset").collect())) == [("a", 5), ("b", 7)]
        compact(spark, path, table, "k", "offset")
        drop_folded(spark, path, keep=1)


def test_upsert_streams_fold_as_they_go(spark, streaming, tmp_path, impression_topic):
    for n in range(2, 7):
        topic_file(tmp_path / "imp", n, impression(f"u{n % 3}", "Tech", n % 2, 100 + n))
    rows = stream(streaming, tmp_path / "imp", schemas.IMPRESSIONS_FOR_PROFILES, time="event_time")
    out = str(tmp_path / "profiles")
    run(jobs.profile_job(rows, out, str(tmp_path / "ckpt"), once=True, compact_every=2))
    assert min(batches(spark, out)) > 1
    flat = [("r", u, c, k, t) for u, c, k, t in impression_topic] + [("r", f"u{n % 3}", "Tech", n % 2, 100 + n) for n in range(2, 7)]
    same_rows(current_rows(spark, out, schemas.PROFILES, "user_id"), user_profiles(impressions(spark, *flat)))


def test_reports_over_stored_tables(spark, tmp_path):
    path = str(tmp_path / "rides")
    assert read_table(spark, path, schemas.RIDES).count() == 0
    spark.createDataFrame([(i, "x", 1.0) for i in range(9)], schemas.RIDES).write.parquet(path)
    assert report(spark, path, schemas.RIDES, "taxi_rides", "SELECT * FROM taxi_rides LIMIT 5").count() == 5


def test_kafka_needs_its_connector(spark):
    with pytest.raises(topics.KafkaUnavailable):
        topics.kafka_messages(spark, "broker:9092", "wins", "earliest")
    with pytest.raises(ValueError):
        topics.kafka_messages(spark, "broker:9092", "wins", "middle")


def test_failed_queries_are_restarted(spark, streaming, tmp_path):
    topic_file(tmp_path / "t", 0, "x")
    tries = []

    def handle(rows, batch_id):
        tries.append(batch_id)
        if len(tries) < 3:
            raise RuntimeError("flaky")

    def writer():
        rows = topics.file_messages(streaming, str(tmp_path / "t"))
        return rows.writeStream.foreachBatch(handle).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)

    started = time.time()
    run_with_restarts(writer, attempts=5, delay_seconds=0.1)
    assert tries == [0, 0, 0] and time.time() - started > 0.2
    tries.clear()
    topic_file(tmp_path / "t", 1, "y")
    with pytest.raises(Exception, match="flaky"):
        run_with_restarts(writer, attempts=1, delay_seconds=0)


def test_asof_keys_share_state_groups(spark, streaming, tmp_path):
    """Many users in few state groups, over several micro-batches and blocks of many users; a user without a name is not one without a key."""
    from pyspark.sql import types as T

    rng = random.Random(5)
    users = ["", *[f"u{i}" for i in range(300)]]
    fields = T.StructType().add("user_id", T.StringType()).add("timestamp_ts", T.LongType()).add("v", T.LongType())
    log = [[(rng.choice(users), n * 2000 + rng.randrange(2400), n * 10_000 + i) for i in range(700)] for n in range(3)] + [[("end", FAR, 0)]]
    asked = [[(rng.choice([None, *users]), n * 2000 + rng.randrange(2400)) for _ in range(500)] for n in range(3)] + [[("end", FAR)]]
    versions_topic(tmp_path / "v", *log)
    for n, rows in enumerate(asked):
        topic_file(tmp_path / "p", n, *[request(f"{n}_{i}", t, u) for i, (u, t) in enumerate(rows)])
    probes = stream(streaming, tmp_path / "p", schemas.REQUESTS_FOR_SCORING).select("request_id", "user_id", "ts")
    joined = stream_asof_join(probes, stream(streaming, tmp_path / "v", fields), "user_id", "ts", "ts", ["v"], lanes=2, block=64, buckets=3)
    query = to_table(joined, str(tmp_path / "out"), str(tmp_path / "ckpt"), once=True).start()
    query.awaitTermination()
    got = {r.request_id: r.v for r in spark.read.parquet(str(tmp_path / "out")).where("user_id IS NULL OR user_id <> 'end'").collect()}
    latest = {(u, t): v for rows in log for u, t, v in rows}
    want = {}
    for n, rows in enumerate(asked[:-1]):
        for i, (u, t) in enumerate(rows):
            past = [vt for vu, vt in latest if vu == u and vt <= t]
            want[f"{n}_{i}"] = latest[u, max(past)] if past else None
    assert got == want
    assert max(s["numRowsUpdated"] for p in query.recentProgress for s in p["stateOperators"]) < len(users)


def test_eight_days_of_a_topic_are_equally_many_files(spark, tmp_path, monkeypatch):
    from bidtide.plans import datasets, streams

    ts = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 3600).cast("timestamp_ntz")  # an event an hour from 2024-01-01
    events = spark.range(24 * 30).select(F.col("id").alias("event_id"), ts.alias("ts"), (F.col("id") % 9).alias("user_id"),
                                         F.lit("view").alias("event_type"), F.lit(1.5).alias("value"), F.lit("{}").alias("props"))
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(streams, "PER_FILE", 40)
    at = streams.Streams(spark, str(tmp_path), "weekly")
    files = streams._publish_weekly(at, "requests", datasets.requests, 15)
    assert files == 24 * 7 // 40
    found = sorted(Path(at.path("requests").removeprefix("file://")).glob("*.txt"), key=lambda p: p.stat().st_mtime_ns)
    days = [[(json.loads(line)["timestamp_ts"] - 1_704_067_200_000) // 86_400_000 for line in p.read_text().splitlines()] for p in found]
    assert [{day // 8 for day in some} for some in days] == [{0}] * files + [{1}] * files
    assert sorted(day for some in days for day in some) == [day for day in range(15) for _ in range(24)]
