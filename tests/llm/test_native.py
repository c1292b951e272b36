"""Personal data and URL filters against plain Python."""
import re

import numpy as np
from pyspark.sql import functions as F

from bidtide.llm import pii, urls

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    d = [int(c) for c in reversed(digits)]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def brute(text):
    out = {}
    for kind, pattern in PATTERNS.items():
        out[kind] = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) < 256 for x in m[0].split(".")), "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out[kind].append((m.start(), m.end()))
    return out


def test_base_spans_equal_plain_matching(spark, table, docs):
    hard = ["a@b.c_d@e.f@g.h", "x@y..z", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255", "4111 1111-1111 1111", "4111  111111111111 41111111111111112222222 4111111111111111",
            "+1 (988) 555-2485+49 30 1234567", "é𝒳 a.b@c-d.org é 4111111111111111é +123456789", "-a@b.c- 5 4111111111111111", "4111111111111111-", "1 4111111111111111"]
    rng = np.random.default_rng(5)
    hard += ["".join(rng.choice(list("a@.1 -+(é4"), 60)) for _ in range(1500)]
    texts = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(hard)], "doc_id long, text string").unionByName(table("documents").select("doc_id", "text").where("doc_id between 9 and 999"))
    texts = texts.unionByName(docs.select("doc_id", "text").where("doc_id > 1"))
    rows = pii.personal_data(texts).collect()
    source = {r.doc_id: r.text for r in texts.collect()}
    assert len(rows) == len(source)
    for row in rows:
        got = {k: [(s.start, s.end) for s in row[k]] for k in PATTERNS}
        assert got == brute(source[row.doc_id]), source[row.doc_id][:200]


def test_added_kinds_need_checksum_or_context(spark):
    rows = [(1, "IBAN DE89 3704 0044 0532 0130 00 x"), (2, "DE88 3704 0044 0532 0130 00"), (3, "My SSN is 123-45-6789."), (4, "code 123-45-6789"), (5, "ssn 666-45-6789")]
    found = {r.doc_id: (len(r.iban), len(r.ssn)) for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: (1, 0), 2: (0, 0), 3: (0, 1), 4: (0, 0), 5: (0, 0)}
    whole = pii.redacted(spark.createDataFrame([(1, "a x@y.z b"), (2, None)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.redacted for r in whole] == ["a <email> b", ""]


def test_awkward_documents(docs):
    assert pii.personal_data(docs).count() == docs.count() and pii.personal_data(docs.limit(0)).count() == 0
    plan = pii.personal_data(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def ranked(edges, seeds, damping=0.85, steps=20):
    hosts = sorted({h for e in edges for h in e[:2]} | set(seeds))
    at = {h: i for i, h in enumerate(hosts)}
    flow = np.zeros((len(hosts), len(hosts)))
    for a, b, n in edges:
        flow[at[b], at[a]] += n
    flow = flow / np.where(flow.sum(axis=0) == 0, 1, flow.sum(axis=0))
    seed = np.array([seeds.get(h, 0) for h in hosts]) / sum(seeds.values())
    score = seed
    for _ in range(steps):
        came = damping * flow @ score
        score = came + seed * (1 - came.sum())
    return dict(zip(hosts, score))


def test_propagation_equals_matrix_iteration(spark):
    def page(i, host, path, *links):
        return i, f"http://{host}{path}", "".join(f'<a href="https://{x}/q">' for x in links) + '<a href="/own">'
    pages = spark.createDataFrame([
        page(1, "Good.org", "/a", "net1.net", "net1.net", "net2.net"), page(2, "bad.com", "/de/1", "net2.net"), page(3, "spam.net", "/x", "bad.com", "BAD.com", "net1.net"),
        page(4, "net1.net", "/x", "net2.net"), page(5, "www.example.org", "/es/1"), page(6, "a.example.org", "/en/12?x"), page(7, "nothing", ""), (8, None, None), (9, "no scheme", ""), (9, "no scheme", ""),
    ], "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("trust", F.lit("clash"))
    rows = {r.page_id: r for r in urls.judged_pages(pages).collect()}
    edges = [("good.org", "net1.net", 2), ("good.org", "net2.net", 1), ("bad.com", "net2.net", 1), ("spam.net", "bad.com", 2), ("spam.net", "net1.net", 1), ("net1.net", "net2.net", 1)]
    trust = ranked(edges, {"good.org": 1})
    distrust = ranked([(b, a, n) for a, b, n in edges], {"bad.com": 1, "www.example.org": 1, "a.example.org": 1})
    for r in rows.values():
        assert abs(r.trust - trust.get(r.host, 0)) < 1e-9 and abs(r.distrust - distrust.get(r.host, 0)) < 1e-9
    assert {i: (r.rule, r.verdict) for i, r in rows.items()} == {
        1: ("org/", "allow"), 2: ("com/de/", "block"), 3: (None, "block"), 4: (None, "allow"), 5: ("example.org/es/", "block"),
        6: ("example.org/en/1", "block"), 7: (None, "allow"), 8: (None, "allow"), 9: (None, "allow")}
    assert (rows[6].host, rows[6].path) == ("a.example.org", "/en/12") and (rows[9].host, rows[9].path) == ("", "")
    assert urls.judged_pages(pages).count() == 10 and urls.judged_pages(pages.limit(0)).count() == 0


def test_verdicts_are_free_of_the_tables_size(spark):
    pages = spark.createDataFrame([(1, "http://bad.com/de/1", ""), (2, "http://bad.com/x", ""), (3, "http://spam.net/", '<a href="//bad.com/">')], "page_id long, url string, html string")
    more = spark.range(20_000).selectExpr("id + 10 as page_id", "concat('http://h', id, '.com/de/') as url", "'' as html")
    small, large = ({r.page_id: r.verdict for r in urls.judged_pages(frame, steps=5).where("page_id < 10").collect()} for frame in (pages, pages.unionByName(more)))
    assert small == large == {1: "block", 2: "block", 3: "block"}
