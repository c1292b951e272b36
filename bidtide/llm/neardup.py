"""b-bit MinHash near-duplicates: bands of whole minima propose pairs, packed low bits estimate their similarity, full
shingle sets confirm them.

1. Every text becomes the set of hashes of its word shingles; documents with equal sets are one class (its smallest
   doc_id), so exact copies never form pairs.
2. ``HASHES`` minima of permuted hashes; ``ROWS`` consecutive ones of the first make a band key, and ``KEEP_BITS`` bits of each, mixed, are
   packed into a signature. Two signatures agree in a lane by chance with probability 2^-bits, which the estimate corrects for.
3. Rounds of stars: in each band bucket every class is paired with one class of the bucket drawn by a hash, another one
   in each round, and of its partners in all its buckets only the best by estimate is confirmed. Copies of one text mostly join
   here, with one pair for each copy and round.
4. The rest, exactly: classes of a bucket that are still in different components are all compared by signature. A semi join
   keeps those with a partner whose estimate is within reach, and their full sets are sent to tasks that confirm every such
   pair and hand on only links that join components. Many small buckets share a task's group; a large one is cut into
   blocks of bounded rows and bytes, and blocks meet in pairs. No row is made for a pair.

A pair at the threshold misses all bands with probability (1 - s^ROWS)^BANDS = 5e-8 at 0.8, and its estimate falls below the
cut (six standard deviations under the threshold) with probability 1e-8, for sets of any size.

Defined results: null, empty and blank texts have no shingles and link with nothing; a text with fewer words than a shingle
is one shingle of all its words; repeated doc_ids are treated as one document each time they have equal sets, and
their rows all appear; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidtide.llm.components import components
from bidtide.llm.rows import with_row_ids
from bidtide.llm.text import WordHashes, mixed, per_batch, shingles, small_batches, spaced_words, utf8
from bidtide.session import written

HASHES, ROWS, BANDS, KEEP_BITS = 256, 4, 32, 2
_LANES = 64 // KEEP_BITS
_RANDOM = np.random.default_rng(20_240_601)
_FACTORS = _RANDOM.integers(0, 1 << 32, HASHES, np.uint32) | np.uint32(1)
_TERMS = _RANDOM.integers(0, 1 << 32, HASHES, np.uint32)
_SEEDS = np.arange(1, HASHES + 1, dtype=np.uint64) << np.uint64(32)
_ODD_LANES = int("01" * 32, 2)
_CHUNK = 4096
#: Rows, and bytes of their sets, that make a block of a bucket or a group of small buckets.
BLOCK_ROWS, BLOCK_BYTES = 2048, 16 << 20
#: Rounds of stars.
STARS = 3
#: Ids up to which the table of documents to confirm is sent to the tasks (8 bytes each); beyond, texts are shuffled.
BROADCAST_IDS = 1_000_000


def _minima(values: np.ndarray) -> np.ndarray:
    """Smallest permuted 32-bit hash for each permutation."""
    short = (values >> np.uint64(32)).astype(np.uint32)
    best = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), _CHUNK):
        np.minimum(best, (short[at : at + _CHUNK] * _FACTORS[:, None] + _TERMS[:, None]).min(axis=1), out=best)
    return best


def _band_keys(minima: np.ndarray) -> np.ndarray:
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in minima[: BANDS * ROWS].reshape(BANDS, ROWS).T:
        keys = mixed(keys + column)
    return keys


def _packed(minima: np.ndarray) -> list[int]:
    # The permutations are affine, so whether two hashes agree in their own low bits is the same in every lane. Mixed, lanes are independent.
    lanes = (mixed(minima.astype(np.uint64) + _SEEDS) >> np.uint64(64 - KEEP_BITS)).reshape(-1, _LANES)
    return (lanes << (np.arange(_LANES, dtype=np.uint64) * np.uint64(KEEP_BITS))).sum(axis=1, dtype=np.uint64).view(np.int64).tolist()


def signed(docs: DataFrame, size: int) -> DataFrame:
    """Per document: doc_id, n (shingles), set_key, signature words w0.., bands. The last three are null for empty sets."""
    small_batches(docs, "2m")
    hashes = WordHashes()

    def rows(batch: pa.RecordBatch) -> dict:
        counts, keys, bands, packs = [], [], [], []
        for text in batch.column("text").to_pylist():
            values = shingles(hashes.of(spaced_words(text)), size)
            counts.append(len(values))
            if not len(values):
                keys.append(None), bands.append(None), packs.append([None] * (HASHES // _LANES))
                continue
            minima = _minima(values)
            keys.append(xxhash.xxh3_128_digest(values.tobytes()))
            bands.append(_band_keys(minima).view(np.int64))
            packs.append(_packed(minima))
        columns = {"doc_id": batch.column("doc_id"), "n": pa.array(counts, pa.int64()), "set_key": pa.array(keys, pa.binary()), "bands": pa.array(bands, pa.list_(pa.int64()))}
        return columns | {f"w{i}": pa.array(w, pa.int64()) for i, w in enumerate(zip(*packs))}

    words = ", ".join(f"w{i} long" for i in range(HASHES // _LANES))
    return per_batch(docs.select("doc_id", utf8().alias("text")), f"doc_id long, n long, set_key binary, bands array<long>, {words}", rows)


def estimate(left: str, right: str) -> Column:
    """Similarity by the share of agreeing lanes, corrected for agreement by chance."""
    apart = F.lit(0)
    for i in range(HASHES // _LANES):
        x = F.col(f"{left}.w{i}").bitwiseXOR(F.col(f"{right}.w{i}"))
        apart = apart + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(_ODD_LANES)))
    chance = 0.5**KEEP_BITS
    return (1 - apart / HASHES - chance) / (1 - chance)


def estimate_cut(threshold: float) -> float:
    chance = 0.5**KEEP_BITS
    agree = threshold + (1 - threshold) * chance
    return threshold - 6 * math.sqrt(agree * (1 - agree) / HASHES) / (1 - chance)


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """Written id, set (sorted 64-bit shingle hashes as bytes) of the documents in ``wanted`` (doc_id)."""
    wanted = written(wanted.distinct(), "wanted")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    hashes = WordHashes()

    def sets_of(batch: pa.RecordBatch) -> dict:
        return {"id": batch.column("doc_id"), "set": pa.array([shingles(hashes.of(spaced_words(t)), size).tobytes() for t in batch.column("text").to_pylist()], pa.binary())}

    texts = docs.select("doc_id", utf8().alias("text")).join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return written(per_batch(texts, "id long, set binary", sets_of), "sets")


def _confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    pairs = written(pairs, "candidates")
    sets = _sets(docs, pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))), size)

    def verdict(batch: pa.RecordBatch) -> dict:
        a, b = [], []
        for first, second, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "x", "y"))):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            small, large = (x, y) if len(x) <= len(y) else (y, x)
            at = np.searchsorted(large, small)
            both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
            if 100 * both >= percent * (len(x) + len(y) - both):
                a.append(first), b.append(second)
        return {"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())}

    filled = pairs.join(sets.select(F.col("id").alias("b"), F.col("set").alias("y")), "b").join(sets.select(F.col("id").alias("a"), F.col("set").alias("x")), "a")
    return written(per_batch(filled.select("a", "b", "x", "y"), "a long, b long", verdict), "links")


def _with_component(rows: DataFrame, links: DataFrame | None) -> DataFrame:
    if links is None:
        return rows.withColumn("comp", F.col("id"))
    return rows.join(components(links).select(F.col("node").alias("id"), F.col("component").alias("comp")), "id", "left").withColumn("comp", F.coalesce("comp", "id"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    signs = written(signed(docs, size), "signatures")
    one_each = signs.where("set_key is not null and doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("id"))
    classes = written(one_each, "classes")
    words = [f"w{i}" for i in range(HASHES // _LANES)]
    own = signs.join(classes, "set_key").where("doc_id = id").dropDuplicates(["id"]).select("id", *words, "bands")
    own = written(own, "class_signatures")
    keyed = own.select("id", F.explode("bands").alias("key"))
    # One order of classes for all buckets: those that share many members mostly share the hub, and a class makes few pairs.
    drawn = [F.min(F.struct(F.xxhash64("id", F.lit(r)), F.col("id"))).alias(f"hub{r}") for r in range(STARS)]
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members"), *drawn).where("members > 1").select("key", *[F.col(f"hub{r}.id").alias(f"hub{r}") for r in range(STARS)])
    buckets = written(keyed.join(shared, "key"), "buckets")
    signature = own.select("id", *words)
    cut, links = F.lit(estimate_cut(percent / 100)), None

    def compared(pairs: DataFrame) -> DataFrame:
        pairs = pairs.distinct().join(signature.select(F.col("id").alias("a"), F.struct(*words).alias("l")), "a").join(signature.select(F.col("id").alias("b"), F.struct(*words).alias("r")), "b")
        return pairs.select("a", "b", estimate("l", "r").alias("estimate")).where(F.col("estimate") >= cut)

    for hub in (f"hub{r}" for r in range(STARS)):
        known = _with_component(buckets, links)
        at = known.select(F.col("key"), F.col("id").alias("b"), F.col("comp").alias("b_comp"), F.col(hub).alias("a")).where("a <> b")
        if links is not None:
            hubs = _with_component(buckets.select(F.col(hub).alias("id")).distinct(), links).select(F.col("id").alias("a"), F.col("comp").alias("a_comp"))
            at = at.join(hubs, "a").where("a_comp <> b_comp")
        best = compared(at.select("a", "b")).groupBy("b").agg(F.max_by("a", F.struct("estimate", "a")).alias("a")).select("a", "b")
        found = _confirmed(best, docs, size, percent)
        links = found if links is None else links.unionByName(found)
    links = links.unionByName(_rest(buckets, own, links, docs, size, percent))
    labels = components(links).select(F.col("node").alias("id"), "component")
    named = classes.join(labels, "id", "left").select(F.col("set_key"), F.coalesce("component", "id").alias("component_id"))
    out = signs.select("doc_id", F.col("n").alias("n_shingles"), "set_key").join(named, "set_key", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _joining(rows: pa.Table, percent: int, cut: float) -> Iterator[tuple[int, int]]:
    """Links of one bucket's rows that join different components, confirmed on full sets. Rows of two blocks meet crosswise, those of one
    all; a pair is left to the bucket with the smallest key that both are in."""
    key, low, high = (rows.column(c)[0].as_py() for c in ("key", "low", "high"))
    block, ids, comps = (rows.column(c).to_numpy() for c in ("block", "id", "comp"))
    words = np.stack([rows.column(f"w{i}").to_numpy() for i in range(HASHES // _LANES)], axis=1).view(np.uint64)
    bands = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
    sets = [np.frombuffer(x, np.uint64) for x in rows.column("set").to_pylist()]
    sizes = np.array([len(x) for x in sets])
    distinct, codes = np.unique(np.concatenate(sets), return_inverse=True)
    sets = np.split(codes, np.cumsum(sizes)[:-1])
    marked, chance, odd, one = np.zeros(len(distinct), bool), 0.5**KEEP_BITS, np.uint64(_ODD_LANES), np.uint64(1)
    labels = np.unique(comps, return_inverse=True)[1]  # of what is joined so far
    for x in range(len(ids) - 1):
        at = np.flatnonzero((labels[x + 1 :] != labels[x]) & ((block[x + 1 :] != block[x]) | (low == high))) + x + 1
        at = at[100 * np.minimum(sizes[at], sizes[x]) >= percent * np.maximum(sizes[at], sizes[x])]
        apart = words[at] ^ words[x]
        near = (1 - np.bitwise_count((apart | (apart >> one)) & odd).sum(axis=1, dtype=np.int64) / HASHES - chance) / (1 - chance)
        at = at[near >= cut]
        if len(at):
            at = at[np.where(bands[at] == bands[x], bands[at], np.iinfo(np.int64).max).min(axis=1) == key]
        marked[sets[x]] = True
        for y in at.tolist():
            if labels[x] != labels[y]:
                both = int(np.count_nonzero(marked[sets[y]]))
                if 100 * both >= percent * (sizes[x] + sizes[y] - both):
                    labels[labels == labels[y]] = labels[x]
                    yield int(ids[x]), int(ids[y])
        marked[sets[x]] = False


def _rest(buckets: DataFrame, signature: DataFrame, links: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between different components, in the buckets that hold several.

    A pair of two components stands in each bucket that it shares, as all of these hold more than one component; it is
    compared in the one with the smallest key."""
    known = written(_with_component(buckets.select("key", "id"), links), "bucket_components")
    comps = known.groupBy("key").agg(F.min("comp").alias("first"), F.max("comp").alias("last")).where("first <> last")
    mixed_rows = written(known.join(comps.select("key"), "key", "left_semi").join(signature, "id"), "mixed_buckets")
    cut = estimate_cut(percent / 100)
    x, y = mixed_rows.alias("x"), mixed_rows.alias("y")
    apart = (F.col("x.key") == F.col("y.key")) & (F.col("x.comp") != F.col("y.comp"))
    here = F.array_min(F.array_intersect("x.bands", "y.bands")) == F.col("x.key")
    near = written(x.join(y, apart & (estimate("x", "y") >= F.lit(cut)) & here, "left_semi"), "near_buckets")
    sets = _sets(docs, near.select(F.col("id").alias("doc_id")), size)
    whole = written(near.join(sets, "id"), "near_sets")
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum(F.length("set")) / BLOCK_BYTES), F.lit(1).cast("long"))
    groups = whole.agg(blocks).first()[0]
    cuts = whole.groupBy("key").agg(blocks.alias("blocks"))
    placed = whole.join(cuts, "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    shared = F.when(F.col("blocks") > 1, F.col("key")).otherwise(F.pmod(F.xxhash64("key"), F.lit(groups)))
    words = [f"w{i}" for i in range(HASHES // _LANES)]
    pieces = met.select(
        (F.col("blocks") > 1).alias("large"), shared.alias("group"), F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "key", "block", "id", "comp", "bands", "set", *words)

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("key")
        keys = rows.column("key").to_numpy()
        edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        found = [link for i, j in zip(edges, edges[1:]) for link in _joining(rows.slice(i, j - i), percent, cut)]
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return written(pieces.groupBy("large", "group", "low", "high").applyInArrow(run, "a long, b long"), "joining_links")


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents that are the first of their group, unchanged. Rows that share a doc_id, or have none, are documents of their
    own: they go only if their text is a near-duplicate of another row's. Rows without shingles all stay."""
    numbered_rows = with_row_ids(docs)
    rows, key = numbered_rows or (docs, "doc_id")
    judged = near_duplicates(rows.select(F.col(key).alias("doc_id"), "text"), size, percent)
    kept = judged.where("kept").select(F.col("doc_id").alias("__kept"))
    return rows.join(kept, F.col(key) == F.col("__kept"), "left_semi").select(*docs.columns)
