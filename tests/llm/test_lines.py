"""Line dedup against all pairs of lines."""
import random
import re

from bidtide.llm import lines

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(rows, percent=80, least=1):
    seen, out = [], {}
    for doc_id, text in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: r[0]):
        for number, line in enumerate(text.split("\n")):
            s = set(WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), line)))
            if len(s) < least:
                continue
            if any(100 * len(s & t) >= percent * len(s | t) for t in seen):
                out.setdefault(doc_id, []).append(number)
            seen.append(s)
    return out


def test_removed_lines_equal_all_pairs(spark):
    random.seed(9)
    vocabulary = [f"w{i}" for i in range(60)]
    base = random.sample([f"b{i}" for i in range(400)], 30)
    rows = []
    for i in range(120):
        text = [" ".join(random.choices(vocabulary, k=random.randrange(1, 9))) for _ in range(random.randrange(1, 6))]
        copy = list(base)
        for at in random.sample(range(30), random.randrange(0, 6)):
            copy[at] = f"c{random.randrange(900)}"
        rows.append((int(i * 37 % 1000), "\n".join([*text, " ".join(copy), "Common line, here!", "two words", ""])))
    rows += [(2000, None), (2001, ""), (None, "Common line, here!"), (2002, "é é É x y"), (2003, "É é x-y")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as line", "2 as size", "3 as token").repartition(4)
    got = {r.doc_id: list(r.lines) for r in lines.removed_lines(frame).collect()}
    assert got == brute(rows)
    kept = {r.doc_id: r.text for r in lines.without_repeats(frame).where("doc_id is not null").collect()}
    for doc_id, text in rows:
        if doc_id is not None:
            wanted = text if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in got.get(doc_id, []))
            assert kept[doc_id] == wanted


def test_awkward_documents(docs):
    out = lines.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert lines.removed_lines(docs.limit(0)).count() == 0 and lines.without_repeats(docs.limit(0)).count() == 0


def test_short_lines_and_lines_without_blanks(spark):
    chinese = "这是一个没有空格的很长的句子" * 15
    rows = [(i, f"Read more\nalles klar\n{chinese}\n}}\nline number {i} stands alone here") for i in range(5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in lines.without_repeats(frame).collect()}
    assert got == {0: rows[0][1]} | {i: f"}}\nline number {i} stands alone here" for i in range(1, 5)}


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    rows = [(1, "alpha beta gamma delta"), (2, "alpha beta gamma delta epsilon"), (2, "a wholly unique sentence stands here"), (None, "no id but words of its own"),
            (None, "alpha beta gamma delta\nlast words")]
    got = [(r.doc_id, r.text) for r in lines.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    want = [(1, "alpha beta gamma delta"), (2, ""), (2, "a wholly unique sentence stands here"), (None, "no id but words of its own"), (None, "last words")]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_crowd_of_near_copies_makes_no_row_for_a_pair(spark, monkeypatch):
    random.seed(4)
    base = [f"b{i}" for i in range(40)]
    rows = []
    for i in range(240):  # two lines with three other words each are just under the threshold
        copy = list(base)
        for at in random.sample(range(40), 1 if i % 20 == 7 else 3):
            copy[at] = f"c{i}x{at}"
        rows.append((i, " ".join(copy)))
    held = []
    monkeypatch.setattr(lines, "written", lambda df, name, write=lines.written: held.append((name, write(df, name))) or held[-1][1])
    got = {r.doc_id: list(r.lines) for r in lines.removed_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == brute(rows)
    assert max(frame.count() for _, frame in held) <= 240 * 9  # postings: 40 - 32 + 1 a line


def test_long_words_and_equal_starts(spark):
    stems = ["a" * 7, "a" * 8, "a" * 9, "a" * 16, "a" * 17, "a" * 40, "a" * 16 + "b", "é" * 4, "é" * 8, "é" * 9]
    rows = [(0, " ".join(stems)), (1, " ".join(reversed(stems))), (2, " ".join([*stems[:8], "x", "y"])), (3, " ".join([*stems[:9], "z"])), (4, "a" * 8), (5, "a" * 16), (6, "A" * 17), (7, "a" * 17)]
    got = {r.doc_id: list(r.lines) for r in lines.removed_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows) == {1: [0], 3: [0], 7: [0]}


def test_crowd_on_a_token_of_similar_lines_is_not_kept(spark, monkeypatch):
    random.seed(6)
    pool = [f"p{i}" for i in range(24)]
    rows = [(i, " ".join([f"topic{i % 3}", *random.sample(pool, 9)])) for i in range(300)]  # nearly all are alike in the topic only
    for i in (30, 31, 32):
        rows.append((1000 + i, rows[i][1] + " more"))
    joins = []
    join = type(spark.range(0)).join

    def noted(self, other, on=None, how=None):
        joins.append((how, join(self, other, on, how)))
        return joins[-1][1]

    monkeypatch.setattr(type(spark.range(0)), "join", noted)
    got = {r.doc_id: list(r.lines) for r in lines.removed_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    monkeypatch.undo()
    assert got == brute(rows) and set(got) >= {1030, 1031, 1032}
    similar = len(got) * 2  # lines with a match and, at most, as many matched ones
    assert max(frame.count() for how, frame in joins if how == "left_semi") <= 3 * similar  # postings: 10 - 8 + 1 a line, 11 - 9 + 1
