import bisect

from helpers import at, impressions, millis, offsets, same_rows
from pyspark.sql import functions as F

from bidtide.operators.asof import asof_join, latest_versions
from bidtide.operators.history import user_history
from bidtide.operators.profiles import profile_changelog, user_profiles

ROWS = [
    ("a", "u1", "Tech", 1, 10), ("b", "u1", "News", 1, 20), ("c", "u1", "Tech", 0, 30), ("d", "u1", "Lifestyle", 1, 30),
    ("e", "u2", "Lifestyle", 0, 15), ("f", None, "Tech", 1, 5),
]


def versions(spark, *rows):
    return spark.createDataFrame(
        [(k, at(t), v, d) for k, t, v, d in rows], "user_id STRING, update_time TIMESTAMP, v INT, deleted BOOLEAN"
    )


def test_profile_counts(spark):
    rows = {r.user_id: r for r in offsets(user_profiles(impressions(spark, *ROWS)), "update_time").collect()}
    assert tuple(rows["u1"]) == ("u1", 4, 2, 1, 1, 1, 30)
    assert tuple(rows["u2"]) == ("u2", 1, 0, 0, 1, 0, 15)


def test_changelog_has_one_version_per_instant(spark):
    log = offsets(profile_changelog(impressions(spark, *ROWS)), "update_time")
    got = sorted((r.update_time, r.total_views, r.tech_views, r.tech_clicks) for r in log.where("user_id = 'u1'").collect())
    assert got == [(10, 1, 1, 1), (20, 2, 1, 1), (30, 4, 2, 1)]


def test_last_version_is_the_profile(spark):
    data = impressions(spark, *ROWS)
    same_rows(latest_versions(profile_changelog(data), "user_id", "update_time"), user_profiles(data))


def test_asof_bounds(spark):
    probes = spark.createDataFrame([(i, "k", at(t)) for i, t in enumerate([9, 10, 11, 20])], "id INT, user_id STRING, ts TIMESTAMP")
    vs = versions(spark, ("k", 10, 1, None), ("k", 20, 2, None))
    found = {
        inclusive: [r.v for r in asof_join(probes, vs, "user_id", "ts", "update_time", ["v"], inclusive=inclusive).orderBy("id").collect()]
        for inclusive in (True, False)
    }
    assert found == {True: [None, 1, 1, 2], False: [None, None, 1, 1]}


def test_asof_keeps_unmatched_and_null_keys(spark):
    probes = spark.createDataFrame([(1, None, at(5)), (2, "x", at(5))], "id INT, user_id STRING, ts TIMESTAMP")
    vs = versions(spark, (None, 1, 9, None), ("y", 1, 8, None))
    out = asof_join(probes, vs, "user_id", "ts", "update_time", ["v"]).orderBy("id").collect()
    assert [(r.id, r.v) for r in out] == [(1, None), (2, None)]


def test_asof_honours_deletes(spark):
    probes = spark.createDataFrame([(t, "k", at(t)) for t in (5, 15, 25)], "id INT, user_id STRING, ts TIMESTAMP")
    vs = versions(spark, ("k", 1, 1, False), ("k", 10, None, True), ("k", 20, 3, False))
    out = asof_join(probes, vs, "user_id", "ts", "update_time", ["v"], deleted="deleted").orderBy("id").collect()
    assert [r.v for r in out] == [1, None, 3]


def test_asof_against_brute_force(spark):
    log = {f"k{k}": sorted({(i * 37 * (k + 1)) % 500 for i in range(30)}) for k in range(5)}
    asked = [(i, f"k{i % 6}", (i * 53) % 520) for i in range(400)]
    vs = versions(spark, *[(k, t, t * 10, None) for k, ts in log.items() for t in ts])
    probes = spark.createDataFrame([(i, k, at(t)) for i, k, t in asked], "id INT, user_id STRING, ts TIMESTAMP")
    got = {r.id: r.v for r in asof_join(probes, vs, "user_id", "ts", "update_time", ["v"]).collect()}
    for i, k, t in asked:
        ts = log.get(k, [])
        n = bisect.bisect_right(ts, t)
        assert got[i] == (ts[n - 1] * 10 if n else None)


def test_same_time_versions_resolve_by_sequence(spark):
    log = spark.createDataFrame([("k", 1, 5, 0), ("k", 1, 6, 1)], "k STRING, t INT, v INT, seq INT")
    assert latest_versions(log, "k", "seq", "t").first().v == 6


def test_history_excludes_the_current_row(spark):
    rows = [("1", "u", "Tech", 0, 1), ("2", "u", "X", 0, 2), ("3", "u", "Tech", 0, 3), ("4", "u", "Lifestyle", 0, 4)]
    out = user_history(impressions(spark, *rows)).orderBy("request_id").collect()
    assert [(r.user_total_views, r.user_tech_views, r.user_lifestyle_views) for r in out] == [(0, 0, 0), (1, 1, 0), (2, 1, 0), (3, 2, 0)]
    assert [r.frac_tech for r in out] == [0.0, 1.0, 0.5, 2 / 3]


def test_times_survive(spark):
    out = profile_changelog(impressions(spark, *ROWS)).agg(F.max(F.unix_millis("update_time"))).first()[0]
    assert out == millis(30)
