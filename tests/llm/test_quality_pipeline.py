"""The language model against a plain re-statement; the classifier on held-out labels; the pipeline end to end."""
import math
from collections import Counter

import pytest

from bidtide.llm import decontaminate, quality


def plain_model(texts, order=quality.ORDER):
    """log P(byte | bytes before) by the textbook recursion."""
    clean = [bytes(order - 1) + bytes(32 if b < 32 else b for b in t.encode()) for t in texts]
    counts = {order: Counter(t[i : i + order] for t in clean for i in range(len(t) - order + 1))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    discounts = {}
    for k, c in counts.items():
        n = Counter(c.values())
        n1, n2, n3, n4 = (max(n[i], 1) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        discounts[k] = [min(max(v, 0.1), i - 0.1) for i, v in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3))]
    followers = {k: {} for k in counts}
    for k, c in counts.items():
        for g, n in c.items():
            followers[k].setdefault(g[:-1], []).append(n)

    def p(g):
        if not g:
            return 1 / 256
        k, own = len(g), followers[len(g)].get(g[:-1])
        if own is None:
            return p(g[1:])
        d = lambda n: discounts[k][min(n, 3) - 1]
        n = counts[k].get(g, 0)
        return ((n - d(n) if n else 0) + sum(map(d, own)) * p(g[1:])) / sum(own)

    def surprise(text):
        t = bytes(order - 1) + bytes(32 if b < 32 else b for b in text.encode())
        return -sum(math.log(p(t[i : i + order])) for i in range(len(t) - order + 1))

    return surprise


@pytest.mark.parametrize("shard_rows", [quality.SHARD_ROWS, 100])
def test_surprise_equals_the_recursion(spark, shard_rows):
    trusted = ["the cat sat on the mat", "the dog sat on the log\n", "é à la carte", ""]
    others = ["the cat", "zzz###", "", "été\tthe", "the mat sat on a very long dog " * 20]
    model = quality.train(spark.createDataFrame([(t,) for t in trusted], "text string"))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*others, *trusted, None])], "doc_id long, text string")
    want = plain_model(trusted)
    for row in quality.surprise(docs, model, shard_rows).collect():
        text = [*others, *trusted, ""][row.doc.doc_id]
        assert row.n == len(text.encode()) and abs(row.surprise - want(text)) < 1e-6 * (1 + row.surprise)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality.judged(docs, labels).selectExpr("doc.doc_id", "kept").join(labels.where("toxic = 0"), "doc_id").where("pmod(xxhash64(doc_id), 5) = 0").collect()
    right = [r.kept == (r.quality == 1) for r in rows]
    assert len(right) > 50 and sum(right) / len(right) > 0.97 and all(r.kept for r in rows if r.quality == 1)


def test_awkward_documents(spark, docs):
    labels = spark.createDataFrame([(6, 1, 0), (7, 1, None), (4, 0, 0), (99, 1, 0), (None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    kept = quality.good_documents(docs, labels)
    assert kept.columns == docs.columns and kept.where("text is null or text = ''").count() == 2
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.good_documents(docs, none).count() == docs.count()
    assert quality.good_documents(docs.limit(0), labels).count() == 0


def test_pipeline_stages_take_effect(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before, kept = docs, {}
    for name, stage in pipeline.STAGES[:-1]:
        after = pipeline.written(stage(spark, before, sf), name)
        assert after.columns == docs.columns and after.count() <= before.count()
        before, kept[name] = after, {r.doc_id: r.text for r in after.collect()}
    assert sum(len(t) for t in kept["line_dedup"].values()) < sum(len(t) for t in kept["quality"].values())
    assert len(kept["near_duplicates"]) < len(kept["line_dedup"]) and len(kept["decontamination"]) < len(kept["near_duplicates"])
    pieces = pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in pieces} == set(kept["decontamination"])
    assert sum(r.length for r in pieces) == sum(r.doc_tokens for r in pieces if r.start == 0)


def test_pipeline_on_awkward_and_empty_tables(spark, docs, table, tmp_path):
    """Every stage and the whole on rows without ids, repeated ids with other texts, empty and long texts; and on no rows."""
    pipeline = pytest.importorskip("corpus_pipeline")
    words = [" ".join(f"{c}{i}" for i in range(12)) for c in "abcdefg"]
    more = spark.createDataFrame([(None, words[0]), (None, words[1]), (50, words[2]), (50, words[3]), (None, words[1]), (None, None), (None, "")], "doc_id long, text string")
    tables = {"full": docs.unionByName(more, allowMissingColumns=True), "none": docs.limit(0)}
    for name, frame in tables.items():
        folder = tmp_path / name
        frame.write.parquet(f"{folder}/documents.parquet")
        for other in ("labels", "benchmark"):
            table(other).write.parquet(f"{folder}/{other}.parquet")
        at = spark.read.parquet(f"{folder}/documents.parquet")
        before, texts = at, []
        for stage_name, stage in pipeline.STAGES[:-1]:
            at = pipeline.written(stage(spark, at, str(folder)), stage_name)
            assert at.columns == before.columns
            texts.append([(r.doc_id, r.text) for r in at.collect()])
        pieces = pipeline.run(spark, str(folder)).collect()
        assert sorted({r.doc_id for r in pieces}, key=str) == sorted({i for i, _ in texts[-1]}, key=str)
        assert sum(r.length for r in pieces) == sum(r.doc_tokens for r in pieces if r.start == 0)
        if name == "none":
            assert not pieces and not any(texts)
        else:  # whatever their ids, rows that are no copies stay with their texts
            assert {(None, words[0]), (None, words[1]), (50, words[2]), (50, words[3]), (None, None), (2, None)} <= set(texts[-1])
            assert texts[-1].count((None, words[1])) == 1


def test_language_without_trusted_text_and_toxic_words(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    spanish = docs.where("lang = 'es'").select("doc_id")
    rows = quality.judged(docs, labels.join(spanish, "doc_id", "left_anti")).selectExpr("doc.doc_id", "doc.lang", "kept").join(labels, "doc_id").collect()
    assert {r.kept for r in rows if r.lang == "es" and r.quality == 1 and r.toxic == 0} == {True}
    assert {r.kept for r in rows if r.lang == "es" and r.quality == 0} == {False}
    toxic = [r.kept for r in rows if r.lang == "en" and r.quality == 1 and r.toxic == 1]
    assert len(toxic) > 20 and sum(toxic) <= 0.1 * len(toxic)


def test_toxic_words_in_shards_equal_one_pass(spark):
    rows = [(i, f"plain words number {i}" + (" you Scum!" if i % 3 == 0 else " you rotter" if i % 3 == 1 else ""), i % 3 < 2) for i in range(90)]
    texts = spark.createDataFrame(rows, "doc_id long, text string, toxic boolean")
    words = quality.toxic_words(texts)
    assert {bytes(r.word) for r in words.collect()} == {b"scum", b"rotter", b"you"}
    docs = spark.createDataFrame([(1, "ScUm."), (2, "scummy"), (3, None), (4, "a rotter")], "doc_id long, text string")
    one, many = ({r.doc_id: r.w for r in quality.with_toxicity(docs, words, "w", n).collect()} for n in (10, 1))
    assert one == many and one[1] > 0 and one[4] > 0 and one[2] == one[3] == 0


def test_decontamination_sends_a_text_once(spark, monkeypatch):
    """The text is no part of the row that goes through Python with it; null texts, other columns and their order stay."""
    sent = []
    contamination = decontaminate.contamination
    monkeypatch.setattr(decontaminate, "contamination", lambda docs, *more: sent.append(docs.schema) or contamination(docs, *more))
    item = " ".join(f"w{i}" for i in range(12))
    rows = [("a", 1, None, 5), ("b", 1, "", 6), (None, None, "Fine \u00e9 text", None), ("c", 2, f"so {item} it", 7), ("a", 1, None, 5)]
    docs = spark.createDataFrame(rows, "source string, doc_id long, text string, n_chars int")
    kept = decontaminate.without_contaminated(docs, spark.createDataFrame([("i", item)], "item_id string, text string"))
    assert kept.columns == docs.columns and [f.dataType for f in kept.schema] == [f.dataType for f in docs.schema]
    assert sorted(map(tuple, kept.collect()), key=str) == sorted((r for r in rows if r[0] != "c"), key=str)
    assert "text" not in sent[0]["doc_id"].dataType.names
