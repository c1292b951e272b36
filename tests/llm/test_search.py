import collections
import math
import random
import re

import pytest

from bidtide.llm import search

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def expected(docs, items, top):
    found = [(doc_id, collections.Counter(words(text))) for doc_id, text in docs]
    n_docs, total = sum(bool(c) for _, c in found), sum(c.total() for _, c in found)
    df = collections.Counter(t for _, c in found for t in c)
    terms = collections.defaultdict(set)
    for item_id, text in items:
        terms[item_id].update(words(text))
    out = collections.Counter()
    for item_id, wanted in terms.items():
        scored = []
        for doc_id, count in found:
            score = 0
            for t in wanted & count.keys():
                m = 100 - 50 + (50 * count.total() * n_docs) // total
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * count[t]) // (1000 * count[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id, score))
        best = sorted(scored, key=lambda x: x[:3])[:top]
        out.update((item_id, rank, x[3], x[4]) for rank, x in enumerate(best, 1))
    return out


def some(n, seed):
    rng = random.Random(seed)
    known = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(300)]
    text = lambda k: rng.choice(["", " ,."]) + " ".join(known[min(299, int(rng.expovariate(1 / 50)))] for _ in range(k))
    docs = [(None if rng.random() < 0.03 else i, rng.choice([None, ""]) if rng.random() < 0.05 else text(rng.randint(1, 60))) for i in range(n)]
    items = [(i // 2 if i < 6 else i, text(rng.randint(1, 30))) for i in range(16)]
    return docs + docs[5:6] * 40, [*items, (None, text(5)), (99, None), (98, "zzz")]


def ranked(spark, docs, items, top):
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS term", "2 AS slice").repartition(3)
    found = search.search(frame, spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS number"), top)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return collections.Counter(map(tuple, found.collect()))


@pytest.mark.parametrize("size,group,batch,n,top", [(8192, 256, 500_000, 300, 50), (40, 4, 60, 300, 5), (64, 4, 10**6, 1500, 3)])
def test_brute_force_finds_the_same(monkeypatch, spark, size, group, batch, n, top):
    """One slice or many, one bundle of items or several, one batch or several; ties, copies, null ids and texts."""
    monkeypatch.setattr(search, "SLICE", size)
    monkeypatch.setattr(search, "GROUP_ITEMS", group)
    monkeypatch.setattr(search, "BATCH_TERMS", batch)
    docs, items = some(n, n + size)
    assert ranked(spark, docs, items, top) == expected(docs, items, top)


def test_a_long_text_closes_its_slice(monkeypatch, spark):
    monkeypatch.setattr(search, "SLICE_POSTINGS", 20)
    docs, items = some(60, 4)
    assert ranked(spark, docs, items, 7) == expected(docs, items, 7)


def test_empty_tables(spark):
    docs, items = some(20, 1)
    for some_docs, some_items in (([], items), (docs, []), ([(1, None)], items), (docs, [(1, None)])):
        assert not ranked(spark, some_docs, some_items, 5)


def test_awkward_documents(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(1, "the QUICK brown fox"), (2, "word é" + "é" * 2999), (3, "1 2 3 b")]
    got = search.search(docs, spark.createDataFrame(items, "item_id long, text string"), 4)
    assert collections.Counter(map(tuple, got.collect())) == expected(rows, items, 4)
