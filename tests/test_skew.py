import pytest
from helpers import same_rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from bidtide.operators.asof import asof_join
from bidtide.operators.history import user_history
from bidtide.operators.metrics import roc_auc
from bidtide.operators.profiles import profile_changelog
from bidtide.operators.skew import SEGMENT, HeavyKeys, SkewPolicy, find_heavy_keys, running_sums, segmented

SMALL = SkewPolicy(rows_per_task=300)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows belong to one user, a third to no user, and many share one instant."""
    i = F.col("id")
    user = F.when(i % 3 == 0, "hot").when(i % 3 == 1, None).otherwise(F.concat(F.lit("u"), i % 40))
    ms = F.when(i % 6 == 0, 500).otherwise(i * 7919 % 2000)
    return spark.range(3000).select(
        user.alias("user_id"), F.timestamp_millis(ms).alias("event_time"), i.cast("string").alias("request_id"),
        F.lit("iOS").alias("os"), F.when(i % 2 == 0, "Tech").when(i % 5 == 0, "Lifestyle").otherwise("News").alias("site_category"),
        (i % 7 == 0).cast("int").alias("is_clicked"),
    )


def test_heavy_keys_are_found(spark, skewed):
    heavy = find_heavy_keys(skewed, "user_id", SMALL)
    assert heavy and (heavy.total, heavy.heaviest) == (3000, 1000)
    assert not find_heavy_keys(skewed, "user_id")


def test_segments_bound_the_group_size_and_keep_ties_together(spark, skewed):
    heavy = find_heavy_keys(skewed, "user_id", SMALL)
    sizes = segmented(skewed, heavy, ["event_time", "request_id"]).groupBy("user_id", SEGMENT).count()
    assert sizes.agg(F.max("count")).first()[0] < 300
    by_time = segmented(skewed, heavy, ["event_time"])
    assert by_time.groupBy("user_id", "event_time").agg(F.countDistinct(SEGMENT).alias("n")).where("n > 1").count() == 0


@pytest.mark.parametrize("key", ["user_id", None])
@pytest.mark.parametrize("options", [{"include_current": False}, {"include_current": True}, {"peers": True}])
def test_running_sums_do_not_depend_on_segments(spark, skewed, key, options):
    sums = {"n": F.lit(1), "clicks": F.col("is_clicked")}
    order = ["event_time"] if options.get("peers") else ["event_time", "request_id"]
    same_rows(
        running_sums(skewed, key, order, sums, policy=SMALL, **options), running_sums(skewed, key, order, sums, **options)
    )


def test_changelog_and_history_do_not_depend_on_segments(spark, skewed):
    same_rows(profile_changelog(skewed, policy=SMALL), profile_changelog(skewed))
    same_rows(user_history(skewed, policy=SMALL), user_history(skewed))


@pytest.mark.parametrize("inclusive", [True, False])
def test_asof_does_not_depend_on_segments(spark, skewed, inclusive):
    versions = profile_changelog(skewed.where("cast(request_id as int) % 4 = 0"))
    probes = skewed.select("request_id", "user_id", "event_time")
    args = (probes, versions, "user_id", "event_time", "update_time", ["total_views", "tech_views"])
    same_rows(asof_join(*args, inclusive=inclusive, policy=SMALL), asof_join(*args, inclusive=inclusive))


def test_estimates_from_another_dataset_only_steer_the_plan(spark, skewed):
    for total in (1, 500, 10_000):
        same_rows(user_history(skewed, heavy=HeavyKeys("user_id", total, 10**9, SMALL)), user_history(skewed))


@pytest.mark.parametrize("n", [1_500, 15_000])
def test_groups_stay_under_the_bound_at_any_size(spark, n):
    i = F.col("id")
    rows = spark.range(n).select(F.when(i % 3 > 0, "hot").otherwise(F.concat(F.lit("u"), i % 40)).alias("k"), (i * 7919 % n).alias("t"))
    parts = segmented(rows, find_heavy_keys(rows, "k", SMALL), ["t"]).groupBy("k", SEGMENT).count()
    assert parts.agg(F.max("count"), F.sum("count")).first()[1] == n
    assert parts.agg(F.max("count")).first()[0] <= SMALL.rows_per_task
    by_key = Window.partitionBy("k").orderBy("t")
    same_rows(running_sums(rows, "k", ["t"], {"s": F.col("t")}, policy=SMALL), rows.withColumn("s", F.sum("t").over(by_key)))
    shuffled = SkewPolicy(rows_per_task=300, broadcast_segments=0)
    same_rows(running_sums(rows, "k", ["t"], {"s": F.col("t")}, policy=shuffled), rows.withColumn("s", F.sum("t").over(by_key)))


def test_probes_at_one_instant_are_split(spark, skewed):
    one = skewed.where("user_id = 'hot'").select("request_id", "user_id", F.timestamp_millis(F.lit(5)).alias("ts"))
    versions = spark.createDataFrame([("hot", 1), ("hot", 9)], "user_id STRING, v INT").withColumn("vt", F.timestamp_millis("v"))
    out = asof_join(one, versions, "user_id", "ts", "vt", ["v"], policy=SMALL)
    assert [tuple(r) for r in out.groupBy("v").count().collect()] == [(1, 1000)]
    rows = one.select("user_id", F.lit(5).alias("t"), F.xxhash64("request_id").alias("tie"))
    sizes = segmented(rows, find_heavy_keys(rows, "user_id", SMALL), ["t", "tie"]).groupBy(SEGMENT).count()
    assert sizes.agg(F.max("count")).first()[0] < 300


def test_auc_does_not_depend_on_segments(spark, skewed):
    scored = skewed.select(F.col("is_clicked").alias("label"), (F.col("request_id").cast("int") * 31 % 977 / 977).alias("score"))
    a, b = roc_auc(scored, policy=SMALL).first(), roc_auc(scored).first()
    assert a.roc_auc == pytest.approx(b.roc_auc, abs=1e-12) and a.positives == b.positives
