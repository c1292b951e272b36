"""Merkle manifest of a table of documents, with proofs for every row.

Each source has a tree over its documents in ascending doc_id; the subroots, ordered by source, carry a tree of their own.
A node is the SHA-256 of its up to 16 children's digests as hex text.

Proofs follow Octopus multiproofs. Leaves are cut into partitions of neighbours. From its range of positions alone a
partition knows the minimal union of nodes that its proofs need and that it can't derive: at most 15 on either side and
level. It gets these once, derives the interiors its leaves share, and expands the individual proofs where the leaves are.
Trees are built from each partition's maximal complete subtrees, level by level, so a source of any size is spread over tasks
and only leaf digests move, never texts.

Defined results: a null doc_id comes first in its source, a null source is a source of its own and comes first; a lone
leaf is its own subroot and has no siblings; rows that repeat a doc_id follow each other by leaf digest, and identical rows
are interchangeable; an empty table has no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bidtide.session import written

ARITY = 16
#: Leaves in one partition, about.
PART_ROWS = 50_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value as text."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(text: Column) -> Column:
    """The leaf digest of a document whose text is ``text``."""
    return F.sha2(F.concat(*[field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], field(text)), 256)


def lowered(text: Column) -> Column:
    """The tampering of the audit: A-Z in lower case."""
    return F.translate(text, _UPPER, _LOWER)


def _hash(parts: str) -> str:
    return hashlib.sha256(parts.encode()).hexdigest()


def _ranged(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` (tree, digest and more) with ``part``, a range of neighbours, and ``row``, ascending inside it. Equal rows
    are spread as well."""
    parts = max(1, math.ceil(leaves.count() / PART_ROWS))
    salted = leaves.withColumn("salt", F.monotonically_increasing_id())
    keys = ["tree", *order, "digest", "salt"]
    ranged = salted.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    return written(ranged.drop("salt").withColumns({"part": F.spark_partition_id(), "row": F.monotonically_increasing_id()}), "merkle_leaves")


def _segments(rows: DataFrame) -> DataFrame:
    """part, tree, at (its first row), first (position in the tree), n, total: the leaves of one tree in one part."""
    counts = rows.groupBy("part", "tree").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("at"))
    by_tree = Window.partitionBy("tree")
    before = by_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.select("part", "tree", "at", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.sum("n").over(by_tree).alias("total"))
    return written(placed, "merkle_segments")


def _pieces(rows: pd.DataFrame, segments: pd.DataFrame) -> Iterator[tuple[pd.Series, pd.DataFrame]]:
    """Each segment of a part with its rows in order."""
    rows = rows.sort_values("row")
    start = 0
    for segment in segments.sort_values("at").itertuples():
        yield segment, rows.iloc[start : start + segment.n]
        start += segment.n


def _frontier(rows: pd.DataFrame, segments: pd.DataFrame) -> pd.DataFrame:
    """Roots of the maximal complete subtrees of every segment: tree, level, idx, digest, and the nodes on that level."""
    out = []
    for segment, piece in _pieces(rows, segments):
        tree, nodes, level, a, n = segment.tree, piece["digest"].tolist(), 0, int(segment.first), int(segment.total)
        while nodes:
            b = a + len(nodes)
            low = -(-a // ARITY)
            high = -(-b // ARITY) if b == n else b // ARITY
            if n == 1 or high <= low:
                low = high = None
            left, right = (b, b) if low is None else (low * ARITY, min(high * ARITY, n))
            out += [(tree, level, i, nodes[i - a], n) for i in (*range(a, left), *range(right, b))]
            if low is None:
                break
            nodes = [_hash("".join(nodes[i - a : min(i + ARITY, n) - a])) for i in range(left, right, ARITY)]
            level, a, n = level + 1, low, -(-n // ARITY)
    return pd.DataFrame(out, columns=["tree", "level", "idx", "digest", "n"])


def _missing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Coordinates that a segment's proofs need and that its own leaves don't give."""
    for segments in batches:
        out = []
        for s in segments.itertuples():
            a, z, n, level = s.first, s.first + s.n - 1, s.total, 0
            while n > 1:
                run, end = a - a % ARITY, min(n, z - z % ARITY + ARITY)
                out += [(s.part, s.tree, level, i) for i in (*range(run, a), *range(z + 1, end))]
                a, z, n, level = a // ARITY, z // ARITY, -(-n // ARITY), level + 1
        yield pd.DataFrame(out, columns=["part", "tree", "level", "idx"])


def _node_table(rows: DataFrame, segments: DataFrame) -> DataFrame:
    """tree, level, idx, digest, n: frontiers of all segments and every node above them."""
    schema = "tree string, level int, idx long, digest string, n long"
    leaves = rows.select("part", "row", "digest").groupBy("part")
    frontier = written(leaves.cogroup(segments.groupBy("part")).applyInPandas(lambda x, y: _frontier(x, y), schema), "merkle_frontier")
    top = segments.agg(F.max("total")).first()[0] or 0
    levels, above, level = [], None, 0
    while top:
        here = frontier.where(F.col("level") == level)
        here = written(here if above is None else here.unionByName(above), "merkle_level")
        levels.append(here)
        children = F.array_sort(F.collect_list(F.struct("idx", "digest")))
        grouped = here.where("n > 1").groupBy("tree", (F.expr(f"idx div {ARITY}")).alias("idx"), F.ceil(F.col("n") / ARITY).alias("n")).agg(children.alias("c"))
        above = grouped.select("tree", F.lit(level + 1).alias("level"), "idx", F.sha2(F.concat_ws("", "c.digest"), 256).alias("digest"), "n")
        level, top = level + 1, 0 if top == 1 else -(-top // ARITY)
    nodes = frontier.limit(0)
    for here in levels:
        nodes = nodes.unionByName(here)
    return nodes


def _paths(digests: list[str], first: int, total: int, fetched: dict[tuple[int, int], str]) -> tuple[list[list[tuple[str, str]]], str]:
    """For every leaf of a segment its (left, right) siblings level by level, and the root of its tree."""
    levels = []
    a, nodes, n, level = first, digests, total, 0
    while n > 1:
        z = a + len(nodes) - 1
        run, end = a - a % ARITY, min(n, z - z % ARITY + ARITY)
        nodes = [fetched[level, i] for i in range(run, a)] + nodes + [fetched[level, i] for i in range(z + 1, end)]
        levels.append((a, z, run, nodes))
        nodes = [_hash("".join(nodes[i : i + ARITY])) for i in range(0, len(nodes), ARITY)]
        a, n, level = a // ARITY, -(-n // ARITY), level + 1
    root = nodes[0]
    above: list[list[tuple[str, str]]] = [[]]
    for a, z, run, nodes in reversed(levels):
        here, parent = [], a // ARITY
        for i in range(a, z + 1):
            start = i - i % ARITY - run
            pair = "".join(nodes[start : i - run]), "".join(nodes[i - run + 1 : start + ARITY])
            here.append([pair, *above[i // ARITY - parent]])
        above = here
    return above, root


def _folded(digest: str, path: list[tuple[str, str]]) -> str:
    for left, right in path:
        digest = _hash(left + digest + right)
    return digest


def _given(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What the parts need besides their leaves, as (part, tree, level, idx, digest, at, n, total): their segments (level -1, idx the
    position of the first leaf) and the missing nodes, each once; and the roots of all trees."""
    segments = _segments(rows)
    nodes = _node_table(rows, segments)
    wanted = segments.select("part", "tree", "first", "n", "total").mapInPandas(_missing, "part int, tree string, level int, idx long")
    found = wanted.join(nodes.drop("n"), ["tree", "level", "idx"])
    zero = F.lit(0).cast("long")
    fetched = found.select("part", "tree", "level", "idx", "digest", zero.alias("at"), zero.alias("n"), zero.alias("total"))
    own = segments.select("part", "tree", F.lit(-1).alias("level"), F.col("first").alias("idx"), F.lit("").alias("digest"), "at", "n", "total")
    return own.unionByName(fetched), nodes.where("n = 1").select("tree", "digest")


def _expanded(rows: DataFrame, given: DataFrame, schema: str, expand) -> DataFrame:
    """``expand(segment, leaves, paths, root)`` for every segment of every part, where its leaves are."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(leaves: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
        nodes, segments = parts[parts["level"] >= 0], parts[parts["level"] < 0]
        fetched: dict[str, dict[tuple[int, int], str]] = {}
        for tree, level, idx, digest in zip(nodes["tree"], nodes["level"], nodes["idx"], nodes["digest"]):
            fetched.setdefault(tree, {})[level, idx] = digest
        out: list[tuple] = []
        for segment, piece in _pieces(leaves, segments):
            paths, root = _paths(piece["digest"].tolist(), int(segment.idx), int(segment.total), fetched.get(segment.tree, {}))
            out += expand(segment, piece, paths, root)
        return pd.DataFrame(out, columns=names)

    return rows.groupBy("part").cogroup(given.groupBy("part")).applyInPandas(run, schema)


def _top_paths(subroots: DataFrame) -> DataFrame:
    """tree, path, root: the siblings on each subroot's way to the root."""
    rows = _ranged(subroots.select(F.lit("").alias("tree"), "digest", F.col("tree").alias("key")), ["key"])
    given, _ = _given(rows)

    def expand(segment, piece: pd.DataFrame, paths: list, root: str) -> list[tuple]:
        return [(key, [{"left": x, "right": y} for x, y in path], root) for key, path in zip(piece["key"], paths)]

    return _expanded(rows, given, f"tree string, path {_PATH}, root string", expand)


def _manifest(docs: DataFrame, columns: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """The ordered leaves with ``columns``, and what their parts need, the way above each subroot included."""
    named = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source"))
    leaves = docs.select("doc_id", named.alias("tree"), leaf_of(F.col("text")).alias("digest"), *[c.alias(n) for n, c in columns.items()])
    rows = _ranged(written(leaves, "merkle_digests"), ["doc_id"])
    given, subroots = _given(rows)
    top = _top_paths(subroots).withColumn("level", F.lit(-1))
    return rows, given.join(top, ["tree", "level"], "left")


def _top(segment) -> list[tuple[str, str]]:
    return [(pair["left"], pair["right"]) for pair in segment.path]


def audited(docs: DataFrame, changed: Column, shown: Column) -> DataFrame:
    """Each document's proof, and whether it holds for the text that somebody shows: doc_id, source, leaf, subroot, root,
    proof_sha256 (the digest of all siblings from leaf to root), folded_root (from the leaf of ``shown`` where ``changed``, else
    from the leaf itself) and verified."""
    rows, given = _manifest(docs, {"shown": F.when(changed, leaf_of(shown))})

    def expand(segment, piece: pd.DataFrame, paths: list, subroot: str) -> list[tuple]:
        top, source = _top(segment), segment.tree[1:] if segment.tree else None
        rest = "".join(left + right for left, right in top)
        out = []
        for doc_id, leaf, shown, path in zip(piece["doc_id"], piece["digest"], piece["shown"], paths):
            proof = _hash("".join([left + right for left, right in path]) + rest)
            folded = _folded(_folded(leaf if shown is None else shown, path), top)
            out.append((None if pd.isna(doc_id) else int(doc_id), source, leaf, subroot, segment.root, proof, folded, folded == segment.root))
        return out

    schema = "doc_id long, source string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return _expanded(rows, given, schema, expand)


def proofs(docs: DataFrame) -> DataFrame:
    """Each document's leaf, the root, and its whole proof: path, the (left, right) siblings from leaf to root."""
    rows, given = _manifest(docs, {})

    def expand(segment, piece: pd.DataFrame, paths: list, subroot: str) -> list[tuple]:
        whole = [[{"left": x, "right": y} for x, y in [*path, *_top(segment)]] for path in paths]
        ids = [None if pd.isna(i) else int(i) for i in piece["doc_id"]]
        return list(zip(ids, piece["digest"], whole, [segment.root] * len(ids)))

    return _expanded(rows, given, f"doc_id long, leaf string, path {_PATH}, root string", expand)


def audit_columns() -> tuple[Column, Column]:
    """The audit of the registered query: of every fifth document, by checksum of its id, the lower-cased text is shown."""
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0, lowered(F.col("text"))
