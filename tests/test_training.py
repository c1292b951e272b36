import math
import random
import threading
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from helpers import at
from pyspark.sql import functions as F

from bidtide.functions.encode import feature_index, feature_names, feature_table, fit_categories, one_hot, sparse_features, vocabulary
from bidtide.functions.rules import serving_share, training_share
from bidtide.functions.score import CATEGORICAL, LinearModel, ctr_score, serving_features, text_sql
from bidtide.operators import training
from bidtide.operators.learning import LearningRate, learn_batch, learnable, new_model
from bidtide.operators.metrics import classification_report, roc_auc
from bidtide.operators.numbering import numbered
from bidtide.operators.registry import current_model, load_latest, model_rows, models, publish, save_model

SYSTEMS, CATEGORIES = ["iOS", "Android", "Windows"], ["Tech", "News", "Sports"]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(5)
    rows = []
    for i in range(1500):
        os, category = rng.choice(SYSTEMS), rng.choice(CATEGORIES)
        p = 1 / (1 + math.exp(1.5 - 1.2 * (category == "Tech") + 0.6 * (os == "iOS")))
        rows.append((f"r{i}", f"u{rng.randrange(60)}", os, category, int(rng.random() < p), at(i * 1000)))
    return spark.createDataFrame(
        rows, "request_id STRING, user_id STRING, os STRING, site_category STRING, is_clicked INT, event_time TIMESTAMP"
    )


def test_shares(spark):
    df = spark.createDataFrame([(None, None), (0, 3), (4, 1), (4, None)], "total LONG, part LONG")
    serving = [r[0] for r in df.select(serving_share(F.col("part"), F.col("total"))).collect()]
    assert serving == [0.0, 0.0, 0.25, None]
    assert [r[0] for r in df.select(training_share(F.col("part"), F.col("total"))).collect()] == [None, 3.0, 0.25, None]


def test_one_hot(spark):
    df = spark.createDataFrame([("iOS", "b"), ("Android", "a"), (None, "c"), ("new", None)], "os STRING, site_category STRING")
    fitted = fit_categories(df.where("os IS NULL OR os <> 'new'"), CATEGORICAL)
    assert fitted == {"os": ["Android", "iOS"], "site_category": ["a", "b", "c"]}
    names = feature_names(fitted)
    assert names == ["os_iOS", "site_category_b", "site_category_c"]
    assert [tuple(r) for r in df.select(one_hot(names, CATEGORICAL)).collect()] == [(1, 1, 0), (0, 0, 0), (0, 0, 1), (0, 0, 0)]


def test_scores(spark):
    model = LinearModel(["frac_tech", "frac_lifestyle", "os_i'OS", "site_category_Te\\ch"], [2.0, -1.0, 0.5, 0.25], -0.75)
    rows = [("i'OS", "Te\\ch", 4, 2, 1), ("x", None, None, None, None), ("x", "y", 0, None, None), ("x", "y", 3, None, 1)]
    df = spark.createDataFrame(rows, "os STRING, site_category STRING, total_views LONG, tech_views LONG, lifestyle_views LONG")
    scored = df.withColumns(serving_features()).select(ctr_score(model).alias("s"), ctr_score(None).alias("none")).collect()
    expected = [1 / (1 + math.exp(-(-0.75 + 1.0 - 0.25 + 0.5 + 0.25))), 1 / (1 + math.exp(0.75)), 1 / (1 + math.exp(0.75)), 0.0]
    assert [r.s for r in scored] == pytest.approx(expected) and {r.none for r in scored} == {0.0}
    assert text_sql("a'b") == "'a\\'b'"


def test_split_is_stable_and_near_seventy_percent(spark):
    ids = spark.range(20000).select(F.col("id").cast("string").alias("request_id"))
    train = ids.where(training.in_training_split("request_id"))
    again = ids.repartition(7).where(training.in_training_split("request_id"))
    assert train.exceptAll(again).count() == 0
    assert train.count() / 20000 == pytest.approx(0.7, abs=0.02)


def newton(x, y, penalty):
    """Minimise half the squared weights plus the balanced log loss, with a free intercept."""
    n, w = len(y), np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (n0 := len(y) - y.sum())))
    assert n and n0
    x1, beta = np.c_[x, np.ones(len(y))], np.zeros(x.shape[1] + 1)
    ridge = np.diag([penalty] * x.shape[1] + [0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x1 @ beta))
        gradient = x1.T @ (w * (p - y)) + ridge @ beta
        beta -= np.linalg.solve((x1 * (w * p * (1 - p))[:, None]).T @ x1 + ridge, gradient)
    return beta


@pytest.mark.parametrize("history", [False, True])
def test_training_matches_newton(spark, data, history):
    trained = training.train_ctr(data, history)
    rows = training.training_rows(data, history).where(training.in_training_split("request_id"))
    pdf = rows.select("label", *one_hot(trained.model.features, CATEGORICAL)).toPandas()
    beta = newton(pdf[list(trained.model.features)].to_numpy(), pdf["label"].to_numpy(), 1.0)
    assert [*trained.model.weights, trained.model.intercept] == pytest.approx(beta, abs=1e-5)
    assert trained.model.features[:2] == (["frac_tech", "frac_lifestyle"] if history else ["os_Windows", "os_iOS"])
    assert 0.55 < trained.auc().first().roc_auc < 0.9
    report = {r.label: r for r in trained.report().collect()}
    assert report["0"].support + report["1"].support == 1500 - len(pdf)
    table = training.coefficient_table(spark, trained.model).collect()
    assert [r.coefficient for r in table] == sorted(trained.model.weights, reverse=True)


def test_training_refuses_poor_data(spark, data):
    for poor in (data.limit(0), data.where("is_clicked = 0"), data.where("is_clicked = 1")):
        with pytest.raises(training.NotEnoughData):
            training.train_ctr(poor, False)


def test_row_cap_keeps_the_earliest(spark, data):
    capped = training.training_rows(data, False, max_rows=10)
    assert sorted(r.request_id for r in capped.collect()) == sorted(f"r{i}" for i in range(10))


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "is_clicked INT")
    assert {r.label: r.class_weight for r in training.class_weights(df).collect()} == {0: 8 / 12, 1: 2.0}


def test_auc_against_pair_count(spark):
    rng = random.Random(3)
    rows = [(int(rng.random() < 0.3), rng.randrange(12) / 12, rng.randrange(1, 4)) for _ in range(300)]
    pos = [(s, n) for y, s, n in rows if y]
    neg = [(s, n) for y, s, n in rows if not y]
    wins = sum(a * b * (1.0 if s > t else 0.5 if s == t else 0.0) for s, a in pos for t, b in neg)
    total = sum(a for _, a in pos) * sum(b for _, b in neg)
    df = spark.createDataFrame(rows, "label INT, score DOUBLE, n INT")
    assert roc_auc(df, weight="n").first().roc_auc == pytest.approx(wins / total, abs=1e-12)
    assert roc_auc(df.where("label = 1")).first().roc_auc is None


def test_report(spark):
    rows = [(1, 1)] * 3 + [(1, 0)] + [(0, 1)] * 2 + [(0, 0)] * 4
    report = {r.label: r for r in classification_report(spark.createDataFrame(rows, "label INT, prediction INT")).collect()}
    assert report["1"][1:] == pytest.approx((0.6, 0.75, 2 / 3, 4))
    assert report["0"][1:] == pytest.approx((0.8, 2 / 3, 8 / 11, 6))
    assert report["accuracy"].f1_score == pytest.approx(0.7) and report["accuracy"].support == 10
    assert report["weighted avg"].precision == pytest.approx(0.8 * 0.6 + 0.6 * 0.4)
    never = spark.createDataFrame([(1, 0), (0, 0)], "label INT, prediction INT")
    assert {r.label: r for r in classification_report(never).collect()}["1"].precision == 0.0


def with_profiles(data):
    return data.select("os", "site_category", "is_clicked", F.lit(4).cast("long").alias("total_views"),
                       F.lit(1).cast("long").alias("tech_views"), F.lit(2).cast("long").alias("lifestyle_views"))


def test_learner_approaches_the_unweighted_fit(spark, data):
    features = ["os_Windows", "os_iOS", "site_category_Sports", "site_category_Tech"]
    rows = with_profiles(data)
    model, losses = new_model(features), []
    for _ in range(6):
        model, learnt, failed = learn_batch(model, rows, LearningRate(eta0=2.0, steps_per_batch=15))
        assert (learnt, failed) == (1500, 0)
        p = F.expr(model.probability_sql())
        loss = F.avg(-F.when(F.col("is_clicked") == 1, F.log(p)).otherwise(F.log(1 - p)))
        losses.append(rows.select(loss).first()[0])
    assert losses == sorted(losses, reverse=True) and model.version == 6 and model.examples == 9000
    pdf = data.select("is_clicked", *one_hot(features, CATEGORICAL)).toPandas()
    x, y = np.c_[pdf[features].to_numpy(), np.ones(len(pdf))], pdf["is_clicked"].to_numpy()
    beta = np.zeros(5)
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ beta))
        beta -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x, x.T @ (p - y))
    assert [*model.weights, model.intercept] == pytest.approx(beta, abs=0.15)


def test_learner_skips_unusable_rows(spark, data):
    rows = with_profiles(data).withColumn("tech_views", F.when(F.rand(1) < 0.5, F.col("tech_views")))
    bad = rows.where("tech_views IS NULL")
    assert learnable(bad).where("usable").count() == 0
    model, learnt, failed = learn_batch(new_model(["os_iOS"]), bad)
    assert (model.weights, learnt, failed) == ([0.0], 0, bad.count())


def test_registry(spark, tmp_path):
    root = str(tmp_path / "models")
    assert current_model(spark, root) is None
    batch = LinearModel(["a", "b"], [0.1, -2.5], 0.3, examples=7)
    save_model(spark, batch, root)
    assert current_model(spark, root) == batch
    for version in (1, 2, 10):
        save_model(spark, LinearModel(["a"], [float(version)], 0.0, "online", version), root)
    assert current_model(spark, root).weights == [10.0]
    assert load_latest(spark, root, "online", below=10).version == 2
    # An attempt without its marker does not count.
    path = f"{root}/online/{11:012d}-{'0' * 32}"
    model_rows(spark, LinearModel(["a"], [1.0], 0.0, "online", 11)).write.parquet(path)
    assert current_model(spark, root).version == 10
    # What is committed stays as it is.
    save_model(spark, LinearModel(["a"], [99.0], 0.0, "online", 10), root)
    assert current_model(spark, root).weights == [10.0]
    assert publish(spark, batch, root).version == 1 and load_latest(spark, root, "batch").version == 1
    assert publish(spark, LinearModel(["a"], [5.0], 0.0, "online"), root).version == 11
    assert models(spark, root, "online").select("version").distinct().count() == 4
    assert models(spark, root, "nobody").count() == 0


def test_readers_go_on_while_others_publish(spark, tmp_path):
    """Publishers that race take different numbers, and a reader meets a whole model every time."""
    root = str(tmp_path / "models")
    publish(spark, LinearModel(["a", "b"], [0.0, 0.0], 0.0, "online"), root)
    seen, done, taken = [], threading.Event(), []

    def read():
        while not done.is_set():
            seen.append(current_model(spark, root))

    def write(start):
        for i in range(start, start + 4):
            taken.append(publish(spark, LinearModel(["a", "b"], [float(i), float(-i)], 0.0, "online"), root).version)

    with ThreadPoolExecutor(4) as pool:
        reader = pool.submit(read)
        writers = [pool.submit(write, start) for start in (10, 20, 30)]
        for writer in writers:
            writer.result()
        done.set()
        reader.result()
    assert sorted(taken) == list(range(1, 13))
    assert seen and all(m.weights[0] == -m.weights[1] for m in seen)
    assert [m.version for m in seen] == sorted(m.version for m in seen)


@pytest.mark.parametrize("n,parts", [(0, 3), (1, 3), (1000, 7)])
def test_numbers_are_consecutive(spark, n, parts):
    df = spark.range(n).select((F.col("id") * 7919 % 500).alias("k"), F.col("id").alias("v")).repartition(parts)
    got = [(r.k, r.number) for r in numbered(df, ["k"]).collect()]
    assert sorted(x for _, x in got) == list(range(n)) and [k for k, _ in sorted(got, key=lambda r: r[1])] == sorted(k for k, _ in got)


def test_vocabulary_is_numbered_without_a_window(spark):
    df = spark.range(3000).select(F.concat(F.lit("o"), F.col("id") % 900).alias("os"), F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("site_category"))
    words = vocabulary(df, CATEGORICAL)
    for plan in (words, feature_index(df, CATEGORICAL, ["n"])):
        assert "Window" not in plan._jdf.queryExecution().executedPlan().toString()
    values = {c: sorted({r[c] for r in df.collect()} - {None}) for c in CATEGORICAL}
    assert sorted(map(tuple, words.collect())) == sorted((c, v, i) for c in CATEGORICAL for i, v in enumerate(values[c]))
    table = feature_table(feature_index(df, CATEGORICAL, ["n"]), ["n"])
    assert [tuple(r) for r in table.orderBy("position").collect()] == list(enumerate(feature_names(values, ["n"])))


def test_sparse_vectors_hold_the_one_hot_features(spark):
    rows = [("b", "y", 0.5), ("a", None, 0.0), ("c", "x", 1.0), (None, "z", 2.0), ("unseen", "y", -1.0)]
    df = spark.createDataFrame(rows, "os STRING, site_category STRING, n DOUBLE")
    seen = df.where("os IS NULL OR os <> 'unseen'")
    names = feature_names(fit_categories(seen, CATEGORICAL), ["n"])
    vectors = sparse_features(df, feature_index(seen, CATEGORICAL, ["n"]), CATEGORICAL, ["n"])
    got = {(r.os, r.site_category): r.features.toArray().tolist() for r in vectors.collect()}
    assert got == {(r.os, r.site_category): [r[f] for f in names] for r in df.select("os", "site_category", *[c.alias(f"{f}") for f, c in zip(names, one_hot(names, CATEGORICAL))]).collect()}
    wide = spark.range(5000).select(F.col("id").cast("string").alias("os"), F.lit("x").alias("site_category"))
    one = sparse_features(wide.limit(1), feature_index(wide, CATEGORICAL), CATEGORICAL).first().features
    assert one.size == 4999 and len(one.indices) <= 1


def test_vocabulary_as_a_plan(spark):
    df = spark.createDataFrame([("b", "y"), ("a", None), ("b", "x"), (None, "z")], "os STRING, site_category STRING")
    features = feature_table(feature_index(df, CATEGORICAL, ["n"]), ["n"]).orderBy("position").collect()
    assert [tuple(r) for r in features] == [(0, "n"), (1, "os_b"), (2, "site_category_y"), (3, "site_category_z")]
    assert [r.feature for r in feature_table(feature_index(df.limit(0), CATEGORICAL, ["n"]), ["n"]).collect()] == ["n"]
