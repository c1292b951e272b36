"""Near vectors against all pairs."""
import numpy as np

from bidtide.llm.components import components
from bidtide.llm.embeddings import near_vectors, passes_for


def brute(rows, cosine=0.93):
    ok = lambda r: r[1] is not None and r[2] is not None and len(r[1]) and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1])
    n, component = {r[0]: 0 for r in rows}, {r[0]: r[0] for r in rows}
    good = [r for r in rows if ok(r)]
    unit = [np.array(np.float32(r[1]), float) for r in good]
    unit = [u / np.linalg.norm(u) for u in unit]
    pairs = [(good[i][0], good[j][0]) for i in range(len(good)) for j in range(i) if good[i][2] == good[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine]
    for a, b in pairs:
        n[a] += 1
        n[b] += 1
    for _ in range(len(pairs)):
        changed = False
        for a, b in pairs:
            low = min(component[a], component[b])
            changed |= component[a] != low or component[b] != low
            component[a] = component[b] = low
        if not changed:
            break
    return {i: (n[i], component[i], component[i] == i) for i in n}


def test_links_and_components_equal_all_pairs(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(16).tolist(), int(i % 3)) for i in range(150)]
    centre = rng.standard_normal(16)
    rows += [(200 + i, (centre + 0.16 * rng.standard_normal(16)).tolist(), 1) for i in range(700)]
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(40)]
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [float("nan")] + [1.0] * 15, 1), (2003, rows[5][1], None), (2004, [1.0] * 4, 1), (2005, [1.0, 1.0, 1.0, 1.1], 1), (2006, [None] + [1.0] * 15, 1), (2007, [], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "5 as component", "6 as id", "7 as n")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(frame).collect()}
    want = brute(rows)
    assert got.keys() == want.keys() and {k: (got[k], want[k]) for k in want if got[k] != want[k]} == {}
    assert near_vectors(frame.limit(0)).count() == 0


def test_given_table(spark, table):
    rows = [(r.vec_id, r.embedding, r.label) for r in table("embeddings").collect()]
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(table("embeddings")).collect()} == brute(rows)


def test_passes_grow_slowly_with_size():
    assert passes_for(10, 0.93, 64, 1e-4) == 1 < passes_for(5_000, 0.93, 64, 1e-4) < passes_for(5_000_000, 0.93, 64, 1e-4) < 150


def test_components_of_chains_stars_and_rings(spark):
    rng = np.random.default_rng(1)
    chain, ids = [(i, i + 1) for i in range(100, 160)], rng.permutation(300) + 1000
    links = chain + [(int(ids[i]), int(ids[(i + 1) % 300])) for i in range(300)] + [(5, i) for i in range(6, 40)] + [(7, 7), (2, 1), (1, 2)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 100 for i in range(101, 161)}, **{i: int(ids.min()) for i in ids.tolist() if i != ids.min()}, **{i: 5 for i in range(6, 40)}, 2: 1}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
