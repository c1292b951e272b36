"""Ranked lexical search by pipelined term partitioning.

The terms of all items are dealt to a few owners, the rarest terms to the first. A bundle stands for some items and one
slice of the documents. It carries sparse accumulators, (item, document, score), from owner to owner; at each one it is
cogrouped with that owner's postings of its slice, whose integer contributions are added. An accumulator is left behind only
when the terms still to come can't lift it to the ``top`` best of its slice, so results are exact. The last owner hands on
at most ``top`` documents for each item and slice, and the best of all slices are selected.

Nothing is gathered by item or by term: the unit of work is a slice of at most ``SLICE`` documents. Items are run in batches
of at most ``BATCH_TERMS`` terms (or one item), which bounds what is broadcast.

Defined results: a null or empty text has no terms; rows that share an item_id are one item with the terms of all; an item
without terms finds nothing, a null item_id is an item; rows that repeat a doc_id are documents of their own and rank next to
each other; a null doc_id (doc_id is a long) comes after others of equal score; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bidtide.llm.text import alnum_words, per_batch, utf8
from bidtide.operators.skew import running_sums
from bidtide.session import written

SLICE, SLICE_POSTINGS = 8192, 2_000_000
BATCH_TERMS = 500_000
GROUP_ITEMS = 256
OWNERS = 4
_ACC = ("acc_items", "acc_docs", "acc_scores")
_BUNDLE = "slice long, items int, doc_ids array<long>, m array<long>, acc_items array<int>, acc_docs array<int>, acc_scores array<long>"
_INDEX = "slice long, term int, docs array<int>, tfs array<int>, doc_ids array<long>, ns array<long>"


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, terms (distinct), number from 0 and batch, of the items that have terms."""

    def rows(batch: pa.RecordBatch) -> dict:
        words = [sorted({w.decode() for w in alnum_words(t)}) for t in batch.column("text").to_pylist()]
        return {"item_id": batch.column("item_id"), "terms": words}

    kind = items.schema["item_id"].dataType.simpleString()
    found = per_batch(items.select("item_id", utf8().alias("text")), f"item_id {kind}, terms array<string>", rows)
    whole = found.groupBy("item_id").agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms")).where(F.size("terms") > 0)
    placed = running_sums(whole, None, ["item_id"], {"number": F.lit(1), "before": F.size("terms")}, include_current=False)
    return written(placed.withColumn("batch", F.expr(f"before div {BATCH_TERMS}")).drop("before"), "search_items")


def _index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Posting lists by slice and term, and for each slice (term null) the ids and lengths of its documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())

    def lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))

    def block(number: int, ids: list, ns: list, terms: list, where: list, tfs: list) -> Iterator[pa.RecordBatch]:
        place = (TaskContext.get().partitionId() << 32) + number
        yield pa.RecordBatch.from_arrays(
            [pa.array([place]), pa.nulls(1, pa.int32()), pa.nulls(1, ints), pa.nulls(1, ints), pa.array([ids], longs), pa.array([ns], longs)],
            names=["slice", "term", "docs", "tfs", "doc_ids", "ns"])
        if terms:
            all_terms = np.asarray(terms, np.int32)
            order = np.argsort(all_terms, kind="stable")
            sorted_terms = all_terms[order]
            starts = np.flatnonzero(np.diff(sorted_terms, prepend=-1))
            bounds = np.append(starts, len(order))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(starts), place)), pa.array(sorted_terms[starts]), lists(np.asarray(where, np.int32)[order], bounds), lists(np.asarray(tfs, np.int32)[order], bounds), pa.nulls(len(starts), longs), pa.nulls(len(starts), longs)],
                names=["slice", "term", "docs", "tfs", "doc_ids", "ns"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = shared.value, 0
        ids, ns, terms, where, tfs = [], [], [], [], []
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = alnum_words(text.as_py())
                hits = Counter(map(known.get, words))
                hits.pop(None, None)
                where += [len(ids)] * len(hits)
                terms += hits.keys()
                tfs += hits.values()
                ids.append(doc_id)
                ns.append(len(words))
                if len(ids) >= SLICE or len(terms) >= SLICE_POSTINGS:
                    yield from block(number, ids, ns, terms, where, tfs)
                    ids, ns, terms, where, tfs, number = [], [], [], [], [], number + 1
        if ids:
            yield from block(number, ids, ns, terms, where, tfs)

    return written(docs.select("doc_id", utf8().alias("text")).mapInArrow(run, _INDEX), "search_index")


def _dealt(dfs: dict[int, int]) -> dict[int, int]:
    """The owner of each term: terms by rising frequency, cut so that owners have about equally many postings."""
    share, seen, owner = sum(dfs.values()) / OWNERS, 0, {}
    for term in sorted(dfs, key=lambda t: (dfs[t], t)):
        owner[term] = min(OWNERS - 1, int(seen / share))
        seen += dfs[term]
    return owner


def _best(scores: np.ndarray, ids: list, top: int) -> np.ndarray:
    """Positions of the ``top`` highest scores, equal ones by id, null ids last."""
    if len(scores) > top:
        least = np.partition(scores, len(scores) - top)[len(scores) - top]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return np.array(sorted(at.tolist(), key=lambda i: (-int(scores[i]), ids[i] is None, ids[i] or 0))[:top], np.int64)


def _flat(table: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column and the bounds of its rows."""
    lists = table.column(column).combine_chunks()
    lists = lists if isinstance(lists, pa.ListArray) else pa.concat_arrays(lists.chunks)
    sizes = np.asarray(lists.value_lengths().fill_null(0))
    return lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _stage(bundle: pa.Table, postings: pa.Table, plan: dict[int, list[tuple[int, int]]], limits: dict[int, tuple[int, int]], top: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Add an owner's contributions to one bundle: (item, documents, scores) of every item with accumulators.

    ``plan`` has (term, weight) of this owner by item; ``limits`` what an item's terms can add at most, before and after it."""
    m = _flat(bundle, "m")[0]
    docs, bounds = _flat(postings, "docs")
    tfs = _flat(postings, "tfs")[0].astype(np.int64)
    impact = (1_000_000_000 * tfs) // (1000 * tfs + 20 * m[docs]) if len(docs) else tfs
    rows = {t: i for i, t in enumerate(postings.column("term").to_pylist())}
    items, at, scores = (_flat(bundle, c)[0] for c in _ACC)
    edges = {int(i): (int(a), int(b)) for i, a, b in zip(*_edges(items))}
    out = []
    for item, (before, after) in limits.items():
        a, b = edges.get(item, (0, 0))
        dense = np.zeros(len(m), np.int64)
        dense[at[a:b]] = scores[a:b]
        closed = b - a >= top and before < np.partition(scores[a:b], b - a - top)[b - a - top]  # too late for other documents
        for term, weight in plan.get(item, ()):
            if (i := rows.get(term)) is not None:
                dense[docs[bounds[i] : bounds[i + 1]]] += weight * impact[bounds[i] : bounds[i + 1]]
        found = at[a:b] if closed else np.flatnonzero(dense)
        values = dense[found]
        if len(values) > top:
            live = values + after >= np.partition(values, len(values) - top)[len(values) - top]
            found, values = found[live], values[live]
        if len(found):
            out.append((item, found, values))
    return out


def _edges(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of equal values: value, start and end."""
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return values[starts], starts, np.append(starts[1:], len(values))


def _batch(docs: DataFrame, items: DataFrame, top: int) -> DataFrame | None:
    """number, doc_id, score: the best documents of every slice for the items of one batch."""
    spark = docs.sparkSession
    wanted = {r["number"]: r["terms"] for r in items.collect()}  # at most BATCH_TERMS terms, or one item
    vocabulary = {w.encode(): i for i, w in enumerate(sorted({w for terms in wanted.values() for w in terms}))}
    index = _index(docs, vocabulary)
    stats = index.where("term is null").agg(
        F.sum(F.size(F.filter("ns", lambda n: n > 0))).alias("n"), F.sum(F.aggregate("ns", F.lit(0).cast("long"), lambda a, n: a + n)).alias("l")).first()
    if not stats["n"]:
        return None
    n_docs, n_terms = int(stats["n"]), int(stats["l"])
    dfs = {r["term"]: int(r["df"]) for r in index.where("term is not null").groupBy("term").agg(F.sum(F.size("docs")).alias("df")).collect()}  # the batch's terms
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for t, df in dfs.items()}
    owner = _dealt({t: df for t, df in dfs.items() if weight[t] > 0})
    least = min(wanted)
    plans: list[dict[int, dict[int, list[tuple[int, int]]]]] = [{} for _ in range(OWNERS)]
    sums: dict[int, list[int]] = {}
    for number, terms in wanted.items():
        group, added = (number - least) // GROUP_ITEMS, [0] * OWNERS
        for w in terms:
            if (term := vocabulary[w.encode()]) in owner:
                plans[owner[term]].setdefault(group, {}).setdefault(number - least, []).append((term, weight[term]))
                added[owner[term]] += 1_000_000 * weight[term]  # a term adds less than this times its weight
        sums[number - least] = added
    groups = 1 + max(i // GROUP_ITEMS for i in sums)
    bundles = index.where("term is null").select(
        "slice", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("items"), "doc_ids",
        F.expr(f"transform(ns, n -> 100 - 50 + (50 * n * {n_docs}L) div {n_terms}L)").alias("m"),
        *[F.array().cast(f"array<{k}>").alias(c) for c, k in zip(_ACC, ("int", "int", "bigint"))])
    for k in range(OWNERS):
        owned = [(term, group) for group, plan in plans[k].items() for term in {t for terms in plan.values() for t, _ in terms}]
        asked = spark.createDataFrame(owned, "term int, items int")
        postings = index.where("term is not null").join(F.broadcast(asked), "term").select(F.col("slice").alias("of_slice"), F.col("items").alias("of_items"), "term", "docs", "tfs")
        limits = {i: (sum(added[k:]), sum(added[k + 1 :])) for i, added in sums.items()}
        bundles = _at_owner(bundles, postings, spark.sparkContext.broadcast((plans[k], limits)), top, last=k == OWNERS - 1)
    return bundles.withColumn("number", F.col("number") + least)


def _at_owner(bundles: DataFrame, postings: DataFrame, shared, top: int, last: bool) -> DataFrame:
    def run(bundle: pa.Table, lists: pa.Table) -> pa.Table:
        plans, limits = shared.value
        group = bundle.column("items")[0].as_py()
        own = {i: x for i, x in limits.items() if i // GROUP_ITEMS == group}
        found = _stage(bundle, lists, plans.get(group, {}), own, top)
        if not last:
            parts = [np.concatenate(x) if found else np.zeros(0, np.int64) for x in zip(*[(np.full(len(d), i), d, s) for i, d, s in found])] or [np.zeros(0, np.int64)] * 3
            kept = bundle.select(["slice", "items", "doc_ids", "m"])
            for name, values, kind in zip(_ACC, parts, (pa.int32(), pa.int32(), pa.int64())):
                kept = kept.append_column(name, pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values.astype(kind.to_pandas_dtype()))))
            return kept
        ids = bundle.column("doc_ids")[0].as_py()
        numbers, doc_ids, scores = [], [], []
        for item, docs, values in found:
            docs, values = docs[values > 0], values[values > 0]
            names = [ids[d] for d in docs.tolist()]
            best = _best(values, names, top)
            numbers += [item] * len(best)
            doc_ids += [names[i] for i in best.tolist()]
            scores += values[best].tolist()
        return pa.table({"number": pa.array(numbers, pa.int64()), "doc_id": pa.array(doc_ids, pa.int64()), "score": pa.array(scores, pa.int64())})

    schema = "number long, doc_id long, score long" if last else _BUNDLE
    return bundles.groupBy("slice", "items").cogroup(postings.groupBy("of_slice", "of_items")).applyInArrow(run, schema)


def search(docs: DataFrame, items: DataFrame, top: int = 50) -> DataFrame:
    """item_id, rank, doc_id, score: every item's ``top`` documents with the highest scores above 0."""
    numbered = item_terms(items)
    last = numbered.agg(F.max("batch")).first()[0]
    results = [] if last is None else [_batch(docs, numbered.where(F.col("batch") == b), top) for b in range(last + 1)]
    empty = docs.sparkSession.createDataFrame([], "number long, doc_id long, score long")
    found = empty
    for result in results:
        found = found if result is None else found.unionByName(result)
    order = Window.partitionBy("number").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(numbered.select("number", "item_id"), "number").select("item_id", "rank", "doc_id", "score")
