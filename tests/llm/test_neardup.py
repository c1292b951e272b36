"""MinHash near-duplicates against all pairs."""
import random
import re

import pytest

from bidtide.llm import neardup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, size, percent=80):
    sets = {}
    for doc_id, text in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc_id] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    component = {i: i for i in sets}
    ids = sorted(sets)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if sets[a] and min(len(sets[a]), len(sets[b])) * 100 >= percent * max(len(sets[a]), len(sets[b])) and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(component[a], component[b])
            changed |= component[a] != low or component[b] != low
            component[a] = component[b] = low
    return {i: (len(sets[i]), component[i], component[i] == i) for i in ids}


@pytest.mark.parametrize("size", [2, 5])
def test_components_equal_all_pairs(spark, table, docs, size):
    random.seed(4)
    base = [random.choice("abcdefghijklmnop") + str(random.randrange(900)) for _ in range(220)]
    edited = []
    for i in range(160):  # a chain of drifting copies, near and beyond the threshold
        words = list(base)
        for at in random.sample(range(len(base)), random.randrange(1, 16 if size == 2 else 7)):
            words[at] = f"new{i}x{at}"
        edited.append((5000 - i, " ".join(words)))
    rows = [(r.doc_id, r.text) for r in table("documents").select("doc_id", "text").collect()] + edited
    rows += [(7000 + i, "Same text Again\tand again") for i in range(30)] + [(8000, None), (8001, ""), (8002, " \n"), (8003, ""), (8004, "one"), (8005, "ONE"), (8006, "one two")]
    random.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as comp", "3 as key", "4 as component_id").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(frame, size).collect()}
    want = brute(rows, size)
    assert got.keys() == want.keys() and {k: (got[k], want[k]) for k in want if got[k] != want[k]} == {}


def test_awkward_documents(docs):
    found = neardup.near_duplicates(docs).collect()
    assert len(found) == docs.count() and all(r.kept for r in found)
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 1
    assert neardup.near_duplicates(docs.limit(0)).count() == 0 and neardup.one_of_each(docs.limit(0)).count() == 0


def test_rows_that_share_an_id_or_have_none_stay(spark):
    other = [" ".join(f"{c}{i}" for i in range(9)) for c in "abcdefg"]
    rows = [(None, t) for t in other[:5]] + [(7, other[5]), (7, other[6]), (7, other[6]), (9, other[6]), (None, other[0]), (None, None), (8, ""), (8, "")]
    got = [tuple(r) for r in neardup.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    want = [(None, t) for t in other[:5]] + [(7, other[5]), (7, other[6]), (None, None), (8, ""), (8, "")]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_small_sets_at_the_threshold_lose_no_link(spark):
    """Texts of 4 to 20 shingles with a copy of a quarter more: 0.8 exactly, 120 pairs of each size, and as many below."""
    rows, linked = [], []
    for n in (4, 8, 12, 16, 20):
        for k in range(120):
            words = [f"p{n}_{k}_{i}" for i in range(n + n // 4 + 2)]
            base = len(rows)
            rows += [(base, " ".join(words[: n + 1])), (base + 1, " ".join(words[: n + n // 4 + 1]))]
            linked.append((base, base + 1))
            apart = [f"q{n}_{k}_{i}" for i in range(n + n // 4 + 2)]
            rows += [(base + 2, " ".join(apart[: n + 1])), (base + 3, " ".join(apart))]
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()}
    assert got == {i: i for i, _ in rows} | {b: a for a, b in linked}


def test_a_crowd_makes_no_row_for_a_pair(monkeypatch, spark):
    """Texts around the threshold to each other: every link that joins components is found however buckets are cut, and what
    the last step hands on are links between components, not pairs."""
    rng = random.Random(8)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = list(base)
        for at in rng.sample(range(60), rng.randrange(1, 9)):
            words[at] = f"c{rng.randrange(40)}"
        rows.append((i, " ".join(words)))
    want = brute(rows, 2)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    written, made = neardup.written, {}

    def counted(df, name):
        out = written(df, name)
        made.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(neardup, "written", counted)
    monkeypatch.setattr(neardup, "STARS", 1)
    for block in (7, 2048):
        made.clear()
        monkeypatch.setattr(neardup, "BLOCK_ROWS", block, raising=False)
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(frame, size=2).collect()}
        assert got == want
        assert max(made["candidates"]) <= len(rows) and made["near_buckets"][0] <= made["mixed_buckets"][0]
        assert block < 2048 or 0 < made["joining_links"][0] <= made["near_buckets"][0]
