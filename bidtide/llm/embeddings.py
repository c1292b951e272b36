"""Near-duplicate vectors by sorted projection passes.

Each pass hashes a vector to the signs of random projections, concatenated; vectors of a label are sorted by it and
compared with their next ``window`` neighbours in that order. Pairs that verify are joined over all passes. A sort order is cut
into blocks of equal size by rank and each block gets the first rows of the next one, so a pass is a range sort and
bounded groups, whatever labels or vectors are frequent.

The number of passes follows from the table's size: near vectors share each bit with probability 1 - angle / pi and meet in a
pass when they share enough leading bits to lie within the window, so passes are added until a pair at the threshold is
missed with probability ``miss`` at most.

Windows alone would miss links inside groups larger than a window. So components of the links found are then compared
in full, in pairs of blocks of ``BLOCK`` vectors, which yields every link inside a component without listing pairs.

Equal vectors of a label are one class, compared once and counted as many times as they occur. Vectors without a usable label
or value (null, zero, null or non-finite components, other lengths than their partner's) link with nothing. Repeated
vec_ids are treated as rows of their own where they differ. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidtide.llm.components import components
from bidtide.session import written

BLOCK = 512
BITS = 32
#: Passes sorted in one job.
TOGETHER = 8


def passes_for(rows: int, cosine: float, window: int, miss: float) -> int:
    """Passes after which a pair at the threshold is missed with probability ``miss`` at most."""
    share = 1 - math.acos(cosine) / math.pi
    depth = max(0.0, math.log2(max(rows, 1) / (window / 2)))
    met = share**depth
    return 1 if met >= 1 else max(1, math.ceil(math.log(miss) / math.log(1 - met)))


def _units(vectors: list) -> np.ndarray:
    x = np.array(vectors, np.float64)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _usable() -> Column:
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.col("label").isNotNull() & x.isNotNull() & (F.size(x) > 0) & finite & F.exists(x, lambda v: v != 0)


def _ranked(frame: DataFrame, name: str, *order: str) -> DataFrame:
    """``frame`` in a global order with its row numbers, without any task seeing more than a range of it."""
    fields = frame.schema.simpleString()[7:-1]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * n, pa.int32()), pa.array(np.arange(at, at + n))], [*batch.schema.names, "part", "at"])
            at += n

    sizes_of = written(frame.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(number, f"{fields},part int,at long"), name)
    sizes, before, total = sizes_of.groupBy("part").count().orderBy("part").collect(), [], 0  # a row per partition
    for part, n in sizes:
        before.append((part, total))
        total += n
    starts = frame.sparkSession.createDataFrame(before, "part int, base long")
    return sizes_of.join(F.broadcast(starts), "part").withColumn("rank", F.col("base") + F.col("at")).drop("part", "at", "base")


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> list[int]:
    """Of every place its root when the pairs are joined; bounded by a block's pairs."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
    return [find(x) for x in range(n)]


def _passes(classes: DataFrame, numbers: range, cosine: float, window: int, seed: int) -> DataFrame:
    """Links a, b of some passes: in each block as many as join what its verified neighbours join."""
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding").to_pylist()
            sizes = [(size, [i for i, v in enumerate(vectors) if len(v) == size]) for size in {len(v) for v in vectors}]
            units = [(size, mine, _units([vectors[i] for i in mine])) for size, mine in sizes]
            for number in numbers:
                keys = np.zeros(batch.num_rows, np.int64)
                for size, mine, x in units:
                    planes = np.random.default_rng([seed, number, size]).standard_normal((size, BITS))
                    keys[mine] = (x @ planes > 0) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([number] * batch.num_rows, pa.int32()), pa.array(keys)], [*batch.schema.names, "pass", "key"])

    kind = dict(classes.dtypes)
    rows = classes.select("id", "label", "embedding").mapInArrow(keyed, f"id long, label {kind['label']}, embedding {kind['embedding']}, pass int, key long")
    rows = _ranked(rows, "order", "pass", "label", "key", "id")
    length = max(BLOCK, window)
    block = F.floor(F.col("rank") / length)
    ahead = F.col("rank") % length < window
    rows = rows.withColumn("block", F.explode(F.when(ahead & (block > 0), F.array(block, block - 1)).otherwise(F.array(block))))

    def compared(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("rank")
        vectors, ids = list(group["embedding"]), group["id"].to_numpy()
        apart = group["label"].to_numpy(), group["pass"].to_numpy()
        pairs = [np.zeros((2, 0), np.int64)]
        for size in {len(v) for v in vectors}:
            mine = np.array([i for i, v in enumerate(vectors) if len(v) == size])
            units = _units([vectors[i] for i in mine])
            a, b = np.nonzero(np.triu(units @ units.T >= cosine, 1))
            a, b = mine[a], mine[b]
            good = (b - a <= window) & (apart[0][a] == apart[0][b]) & (apart[1][a] == apart[1][b])
            pairs.append(np.stack([a[good], b[good]]))
        root = np.array(_forest(len(ids), *np.concatenate(pairs, axis=1)))
        own = root != np.arange(len(ids))
        return pd.DataFrame({"a": ids[own], "b": ids[root[own]]})

    return rows.groupBy("block").applyInPandas(compared, "a long, b long").distinct()


def near_vectors(vectors: DataFrame, cosine: float = 0.93, window: int = 64, miss: float = 1e-4, seed: int = 7) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept. ``vectors`` needs vec_id, embedding and label."""
    base = vectors.select("vec_id", "embedding", "label")
    usable = base.where(_usable())
    classes = written(usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")), "classes")
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    links = None
    passes = passes_for(largest, cosine, window, miss)
    for start in range(0, passes, TOGETHER):
        found = written(_passes(classes, range(start, min(start + TOGETHER, passes)), cosine, window, seed), "links")
        links = found if links is None else links.unionByName(found)
    labels = written(components(links), "vector_components")
    members = classes.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    linked = members.join(written(members.groupBy("component").count().where("count > 1"), "sizes"), "component")
    counted = _link_counts(linked, cosine).withColumnRenamed("id", "of")
    judged = written(members.join(counted, F.col("id") == F.col("of"), "left").select(
        "label", "embedding", "component", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "judged")
    # Back to the rows: a class is the same label and vector, both never null here.
    rows = usable.alias("v").join(judged.alias("j"), (F.col("v.label") == F.col("j.label")) & (F.col("v.embedding") == F.col("j.embedding")))
    linked_rows = rows.select("vec_id", "n_links", F.col("component").alias("component_id"))
    alone = base.where(~F.coalesce(_usable(), F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked_rows.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _link_counts(linked: DataFrame, cosine: float) -> DataFrame:
    """id, n: copies of other classes of the component within reach, from all pairs of its blocks."""
    placed = _ranked(linked.select("component", "id", "copies", "embedding"), "members", "component", "id")
    first = placed.groupBy("component").agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
    placed = placed.join(first, "component").withColumn("part", F.floor((F.col("rank") - F.col("first")) / BLOCK))
    parts = F.floor((F.col("last") - F.col("first")) / BLOCK)
    # A block meets itself and every other block of its component once: as the lower or the upper of a pair.
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts)))
    pairs = pairs.select("component", "id", "copies", "embedding", "part", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"))

    def counted(group: pd.DataFrame) -> pd.DataFrame:
        vectors, copies, part = list(group["embedding"]), group["copies"].to_numpy(), group["part"].to_numpy()
        total = np.zeros(len(group), np.int64)
        same = int(group["low"].iloc[0]) == int(group["high"].iloc[0])
        for size in {len(v) for v in vectors}:
            mine = np.array([i for i, v in enumerate(vectors) if len(v) == size])
            units = _units([vectors[i] for i in mine])
            close = units @ units.T >= cosine
            np.fill_diagonal(close, False)
            if not same:
                close &= part[mine][:, None] != part[mine][None, :]
            total[mine] += close @ copies[mine]
        return pd.DataFrame({"id": group["id"], "n": total})

    return pairs.groupBy("component", "low", "high").applyInPandas(counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
