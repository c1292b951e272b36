import collections
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from bidtide.llm import langid

LONG = "Der schnelle Fuchs, ÄRGER über 3 Dinge\n" * 40


def grams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    count = collections.Counter()
    for word in words:
        padded = f" {word} "
        count.update(word)
        count.update(padded[i : i + 2] for i in range(len(padded) - 1))
        count.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return count


def number(gram):
    out = 0
    for c in gram:
        out = out << 21 | (1 if c == " " else ord(c))
    return out


def ranks(count):
    return [g for g, _ in sorted(count.items(), key=lambda x: (-x[1], number(x[0])))][: langid.PROFILE]


@pytest.mark.parametrize("text", ["", " ", "a", "ab", "é1 b", "  Ab  cd-ef ", "日本語 の", "Straßé x" * 9, LONG])
@pytest.mark.parametrize("piece", [1, 2, 3, 7, 400_000])
def test_counts_of_pieces_are_those_of_the_whole_text(monkeypatch, text, piece):
    monkeypatch.setattr(langid, "PIECE", piece)
    found, counts = langid.counted(text)
    assert dict(zip(found.tolist(), counts.tolist())) == {number(g): n for g, n in grams(text).items()}


def judged(docs):
    learnt = collections.defaultdict(collections.Counter)
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 5 == 0
    for r in docs:
        if not held(r["doc_id"]) and r["lang"] is not None and r["text"]:
            learnt[r["lang"]].update(grams(r["text"]))
    profiles = {lang: {g: i for i, g in enumerate(ranks(count))} for lang, count in sorted(learnt.items()) if count}
    out = []
    for r in docs:
        own = ranks(grams(r["text"] or ""))
        apart = [(sum(abs(p[g] - i) if g in p else langid.PROFILE for i, g in enumerate(own)) / (len(own) * langid.PROFILE), lang) for lang, p in profiles.items()] if own else []
        far, lang = min(apart) if apart else (1.0, "und")
        out.append((r["doc_id"], held(r["doc_id"]), lang, round(1 - far, 12)))
    return collections.Counter(out)


@pytest.mark.parametrize("block", [1, 3, 500])
def test_the_nearest_profile_wins(monkeypatch, spark, docs, table, block):
    """On real documents and the awkward ones, for one block of languages and several; brute force counts on strings."""
    monkeypatch.setattr(langid, "BLOCK", block)
    frame = docs.select("doc_id", "text", "lang").unionByName(table("documents").where("doc_id < 60").select("doc_id", "text", "lang"))
    got = langid.judged(frame.repartition(3)).withColumn("score", F.round("score", 12))
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    assert collections.Counter(map(tuple, got.collect())) == judged([r.asDict() for r in frame.collect()])


def test_tasks_hand_counts_on_before_they_hold_too_many(monkeypatch, spark, table):
    whole = {r["lang"]: r["grams"] for r in langid.profiles(table("documents"), ~langid.held_out()).collect()}
    monkeypatch.setattr(langid, "HELD", 100)
    monkeypatch.setattr(langid, "PIECE", 1000)
    assert {r["lang"]: r["grams"] for r in langid.profiles(table("documents"), ~langid.held_out()).collect()} == whole


def test_held_out_documents_are_told_apart(table):
    found = langid.judged(table("documents")).join(table("documents").select("doc_id", "lang"), "doc_id").where("held_out")
    n, right = found.agg(F.count(F.lit(1)), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 20 and right >= 0.97 * n


def test_labels_and_ids_of_held_out_documents_change_nothing(table):
    docs = table("documents")
    other = docs.withColumn("lang", F.when(langid.held_out(), "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    assert sorted(langid.judged(docs).collect()) == sorted(langid.judged(other).collect())


def test_nothing_learnt_and_empty_tables(spark, docs):
    assert langid.judged(docs.limit(0)).count() == 0
    unlabelled = langid.judged(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in unlabelled} == {("und", 0.0)}
    # Labelled texts without letters teach a language nothing.
    assert {r["lang_pred"] for r in langid.judged(spark.createDataFrame([(1, "1 2", "en"), (2, "abc", "en")], "doc_id long, text string, lang string")).collect()} <= {"und", "en"}


def test_distance_of_a_profile_to_itself_is_none():
    own = np.array([5, 9, 7], np.uint64)
    langs, known, places = langid._table([("a", [5, 9, 7]), ("b", [7, 9])])
    assert langs == ["a", "b"] and langid.distances(own, known, places).tolist() == [0, langid.PROFILE + 0 + 2]
