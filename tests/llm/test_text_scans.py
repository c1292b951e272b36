"""Decontamination and license scans against plain re-statements of their definitions."""
import re

from pyspark.sql import functions as F

from bidtide.llm import decontaminate, licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window=10):
    own, hit, found = words(text), set(), set()
    for item, body in items:
        theirs = words(body)
        for i in range(max(1, len(theirs) - window + 1) if theirs else 0):
            piece = theirs[i : i + window]
            for j in range(len(own) - len(piece) + 1):
                if own[j] == piece[0] and own[j : j + len(piece)] == piece:
                    hit |= set(range(j, j + len(piece)))
                    found.add(str(item))
    return len(own), len(hit), sorted(found)


def result(frame):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n, list(r["items"])) for r in frame.select("doc_id", "n_words", decontaminate.n_hit().alias("n"), "items").collect())


def test_contamination_equals_brute_force_in_one_and_many_passes(spark, table, docs):
    benchmark = table("benchmark").unionByName(spark.createDataFrame([(900, "word"), (901, None), (902, ""), (None, "word"), (903, "word")], "item_id long, text string"))
    texts = table("documents").where("n_chars < 6000").select("doc_id", "text").unionByName(docs.select("doc_id", "text"))
    items = [(r.item_id, r.text) for r in benchmark.collect() if r.item_id is not None]
    wanted = sorted((r.doc_id if r.doc_id is not None else -1, *brute(r.text, items)) for r in texts.collect())
    assert result(decontaminate.contamination(texts, benchmark)) == wanted
    assert result(decontaminate.contamination(texts, benchmark, pass_words=300)) == wanted
    assert any(n for _, _, n, _ in wanted)


def test_spans_lie_in_the_original_text(spark):
    benchmark = spark.createDataFrame([(1, "Éa b c d e f g h i j")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "ééé -- Éa, B c  d e\nf g h i (J) k")], "doc_id long, text string")
    row = decontaminate.contamination(docs, benchmark).first()
    (a, b), = row.spans
    assert "ééé -- Éa, B c  d e\nf g h i (J) k"[a:b] == "Éa, B c  d e\nf g h i (J"


def test_filter_keeps_rows_as_they_are(spark, docs):
    benchmark = spark.createDataFrame([(1, "word")], "item_id long, text string")
    kept = decontaminate.without_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 1
    assert decontaminate.without_contaminated(docs, benchmark.limit(0)).count() == docs.count()
    assert decontaminate.without_contaminated(docs.limit(0), benchmark).count() == 0


def test_license_base_counts(spark, docs, table):
    texts = table("documents").select("doc_id", "text").where("doc_id > 8").unionByName(docs.select("doc_id", "text"))
    for r in licenses.license_labels(texts).join(texts, "doc_id").where("doc_id > 1").collect():
        own, places, labels = words(r.text), [], set()
        for phrase, label in licenses.BASE.items():
            p = phrase.split()
            at = [i for i in range(len(own)) if own[i : i + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(own), len(places), min(places, default=None), max(places, default=None))
        assert r.base_labels == sorted(labels) and labels <= set(r.labels) and 0 <= r.score <= 1


def test_template_accepts_only_exact_mandatory_wording():
    machine = licenses.compile_template("x", "[[copyright {{3}}]] you may use [[and sell]] this {{2}} freely")
    ok = lambda text: any(machine.furthest(text.encode().split(), i)[0] for i in range(len(text.split())))
    assert ok("you may use this freely") and ok("copyright 2020 some one you may use and sell this fine work freely")
    assert not ok("you may not use this freely") and not ok("you may use and this freely") and not ok("you may use this a b c freely")
    assert machine.furthest(b"you may use that".split(), 0) == (False, 3)


def test_method_labels(spark):
    rows = [(1, "This work is licensed under the GNU General Public License, version 3."), (2, "Released under the MIT License."), (3, "Licensed under CC BY-NC 4.0."), (4, "permission is hereby granted, free of charge, to any person"), (5, "nothing")]
    found = {r.doc_id: r for r in licenses.license_labels(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[i].labels for i in range(1, 6)] == [["gpl-3"], ["mit"], ["cc-by-nc", "cc-by-nc-4"], [], []]
    assert found[5].score == 0 and found[1].score == 1


def plain(template, words):
    """A licence's text: optional regions left out, replaceable ones filled."""
    text = re.sub(r"\[\[[^\]]*\]\]", "", template)
    return re.sub(r"\{\{\d+\}\}", words, text)


def test_whole_licences(spark):
    mit, two, three = licenses._MIT, f"{licenses._BSD_2} {licenses._BSD_DISCLAIMER}", f"{licenses._BSD_2} {licenses._BSD_3} {licenses._BSD_DISCLAIMER}"
    texts = {
        "mit": "The MIT Licence, copyright (c) 2020 Somebody. " + plain(mit, "Software").title() + " And more text.",
        "json": plain(mit, "software").replace("all copies or", "all copies used for good not evil or"), "bare": plain(mit.split("the above copyright")[0], "software") + "shall be used for good, not evil",
        "bsd-2": plain(two, "the owners"), "bsd-3": "x " + plain(three, "the owners").upper(), "word": plain(two, "us").replace("source code", "source files"),
        "isc": plain(licenses._ISC, "the author"), "long": plain(mit, " ".join("abcdefghi")),
    }
    frame = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    found = {r.doc_id: (r.labels, r.score) for r in licenses.license_labels(frame).collect()}
    assert {k: v for k, v in found.items() if v[0]} == {k: ([k], 1.0) for k in ("mit", "bsd-2", "bsd-3", "isc")}
    assert all(0.1 < found[k][1] < 1 for k in ("json", "bare", "word", "long"))


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    assert licenses.license_labels(none).count() == 0 and licenses.license_labels(docs).count() == docs.count()
    assert decontaminate.contamination(none, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert decontaminate.contamination(docs, spark.createDataFrame([], "item_id long, text string")).where(F.size("items") > 0).count() == 0
