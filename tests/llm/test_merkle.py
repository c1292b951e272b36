import hashlib
import random
import zlib

import pytest

from bidtide.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    named = [*(row[c] for c in ("doc_id", "source", "lang", "n_chars")), text]
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in named))


def climbed(nodes):
    """The root over some digests, and every digest's siblings by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, path in enumerate(paths):
            start = at[i] - at[i] % 16
            path.append((nodes[start : at[i]], nodes[at[i] + 1 : start + 16]))
            at[i] //= 16
        nodes = [digest("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def expected(rows):
    sources = {}
    for row in rows:
        sources.setdefault(row["source"], []).append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        own = sorted(sources[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees.append((own, *climbed([leaf(r, r["text"]) for r in own])))
    out = []
    root, above = climbed([t[1] for t in trees]) if trees else ("", [])
    for (own, subroot, paths), top in zip(trees, above):
        for row, path in zip(own, paths):
            folded = first = leaf(row, row["text"])
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0 and row["text"] is not None:
                folded = leaf(row, "".join(c.lower() if c.isascii() else c for c in row["text"]))
            for left, right in path + top:
                folded = digest("".join([*left, folded, *right]))
            siblings = "".join("".join(left + right) for left, right in path + top)
            out.append((row["doc_id"], row["source"], first, subroot, root, digest(siblings), folded, folded == root))
    return sorted(out, key=str)


def some(n, seed):
    rng = random.Random(seed)
    sources = [None, "", "a", "é", *["hot"] * 4, *[f"s{i}" for i in range(n // 20)]]
    rows = [
        {"doc_id": rng.randrange(n) if rng.random() < 0.1 else None if rng.random() < 0.05 else i, "source": rng.choice(sources), "lang": rng.choice(["en", None]),
         "n_chars": rng.choice([None, 5]), "text": rng.choice([None, "", "Abc É", "abc", f"X{i}" * 50])} for i in range(n)]
    return rows + rows[: n // 3]  # and repeated rows


def audited(spark, rows, parts=3):
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA).repartition(parts)
    return merkle.audited(frame, *merkle.audit_columns())


@pytest.mark.parametrize("n,part", [(0, 9), (1, 9), (17, 3), (300, 7), (300, 100), (3000, 333)])
def test_proofs_over_parts_of_any_size(monkeypatch, spark, n, part):
    """Parts cut sources, runs and repeated rows anywhere; each derives what it can and fetches the rest."""
    monkeypatch.setattr(merkle, "PART_ROWS", part)
    rows = some(n, n + part)
    assert sorted(map(tuple, audited(spark, rows).collect()), key=str) == expected(rows)


def test_rows_repeated_many_times_are_spread(monkeypatch, spark):
    monkeypatch.setattr(merkle, "PART_ROWS", 50)
    rows = [{"doc_id": 5, "source": "a", "lang": "en", "n_chars": 1, "text": "Same"}] * 700
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    leaves = frame.selectExpr("doc_id", "'=a' AS tree", "sha2(text, 256) AS digest")
    sizes = [r["count"] for r in merkle._ranged(leaves, ["doc_id"]).groupBy("part").count().collect()]
    assert len(sizes) > 7 and max(sizes) < 200
    assert sorted(map(tuple, audited(spark, rows).collect()), key=str) == expected(rows)


def test_parts_fetch_the_minimal_union(monkeypatch, spark):
    """A part in the middle of one large source needs at most 15 nodes on either side of each level."""
    monkeypatch.setattr(merkle, "PART_ROWS", 500)
    rows = [{"doc_id": i, "source": "a", "lang": None, "n_chars": None, "text": str(i)} for i in range(5000)]
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    ordered, given = merkle._manifest(frame, {})
    wanted = given.where("level >= 0").groupBy("part", "level").count().collect()
    assert ordered.select("part").distinct().count() >= 8
    assert wanted and max(r["count"] for r in wanted) <= 30


def test_whole_proofs_lead_to_the_root(spark, docs):
    for row in merkle.proofs(docs).collect():
        at = row["leaf"]
        for left, right in row["path"]:
            at = digest(left + at + right)
        assert at == row["root"]


def test_awkward_documents(spark, docs):
    rows = [r.asDict() for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = merkle.audited(docs, *merkle.audit_columns())
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)
