"""Line dedup: an exact set-similarity join of lines, after which every line that an earlier one matches is removed.

A line's tokens are its distinct words. Lines of at least ``min_tokens`` tokens (one, unless asked otherwise) whose Jaccard similarity
with any earlier line (by doc_id, then line number) is at least ``percent`` are removed; lines without tokens always stay. Sets of few
tokens, such as a line without blanks, are similar only if they are equal.

1. Rarity: occurrences of all tokens of all lines, counted in ``SKETCH`` hashed counters (a table of fixed size, which is
   what is sent round). Tokens are ordered by their counter, up to 65,535, then by hash: one order for all lines, so the filters are
   exact whatever the counters hold.
2. Lines with equal token sets are one class, represented by its first line; all others are removed at once.
3. Prefix filter: similar lines share one of the first ``size - ceil(t * size) + 1`` tokens of the larger and the first
   ``size - ceil(2t / (1 + t) * size) + 1`` of the smaller. Tokens that occur once leave no posting, as no two lines share them. Pairs on
   a shared token must pass the length filter, the positional filter (tokens after the shared one suffice for the overlap)
   and the number of odd bits in which their parity bitmaps differ (each differing token flips one), all inside the join.
4. Only whether a line has an earlier match is asked, so all joins on tokens are semi joins: the postings with a partner on either side,
   of these the ones with an earlier partner, then the partners of those. No join makes a row for a pair, however many lines are alike,
   and none keeps a posting because its token alone occurs in a similar line: such rows grow faster than the input.
5. Full token sets decide inside semi joins as well: first on each line's rarest token with a partner, which settles most
   lines, then for lines without a match so far on all their other tokens.

Defined results: a null text has no lines and stays null; an empty text is one empty line; doc_id is a long. ``removed_lines`` names
lines by doc_id, so it wants ids that are unique, and leaves rows without one alone; ``without_repeats`` takes any rows: those that
share a doc_id or have none are documents of their own, in order of doc_id, rows without one last. An empty table gives an empty result;
extra columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidtide.llm.rows import with_row_ids
from bidtide.llm.text import _ALNUM, mixed, per_batch, release, small_batches, utf8
from bidtide.session import written

SKETCH = 1 << 22
_BLOCK = 1 << 14
#: Ids up to which the table of documents to verify is sent to the tasks (8 bytes each); beyond, texts are shuffled.
BROADCAST_IDS = 1_000_000
_LOW = 0xFFFFFFFF
#: Words of a line's parity bitmap.
_BITS = ("bits0", "bits1")
_SALT = np.uint64(0xA5A5A5A5A5A5A5A5)
#: As ``_ALNUM``, but ends of lines stay.
_LINES = bytes(10 if b == 10 else _ALNUM[b] for b in range(256))
#: Masks of the first bytes of eight.
_FIRST = np.array([256**n - 1 for n in range(9)], np.uint64)


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all lines of some texts: text number, line number; of their words in order: line (counted on), hash.

    Up to eight bytes, words that differ have hashes that differ."""
    raw = b"\n".join(texts).translate(_LINES) + bytes(16)
    flat = np.frombuffer(raw, np.uint8)
    ends_of_lines = np.flatnonzero(flat == 10)
    per_text = np.array([text.count(b"\n") + 1 for text in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), per_text)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    inside = np.concatenate([[False], flat > 32])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))  # the eight bytes at every place
    token = mixed(mixed(eight[starts] & _FIRST[np.minimum(sizes, 8)]))
    more = np.flatnonzero(sizes > 8)
    token[more] = mixed(token[more] + mixed((eight[starts[more] + 8] & _FIRST[np.minimum(sizes[more] - 8, 8)]) ^ _SALT))
    for i in np.flatnonzero(sizes > 16):
        token[i] = xxhash.xxh3_64_intdigest(raw[starts[i] : starts[i] + sizes[i]])
    return owner, number.astype(np.int32), np.searchsorted(ends_of_lines, starts), token


def _distinct(line: np.ndarray, token: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct tokens of each line, by line, rank (below 2^16), then token."""
    spare = 48 - int(line.max() if len(line) else 0).bit_length()
    key = (line.astype(np.uint64) << np.uint64(16) | rank.astype(np.uint64)) << np.uint64(spare) | token >> np.uint64(64 - spare)
    order = np.argsort(key)
    same = (key[order][1:] == key[order][:-1]) & (token[order][1:] != token[order][:-1])
    if same.any():  # the key doesn't tell some tokens apart
        order = np.lexsort((token, rank, line))
    line, token, rank = line[order], token[order], rank[order]
    fresh = np.ones(len(token), bool)
    fresh[1:] = (token[1:] != token[:-1]) | (line[1:] != line[:-1])
    return line[fresh], token[fresh], rank[fresh]


def _counters(docs: DataFrame) -> np.ndarray:
    """Occurrences of tokens by hashed counter. Tasks sum the counters of a block, and blocks come back as bytes: 16 MB."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        held = np.zeros(SKETCH, np.uint32)
        for batch in batches:
            counter, n = np.unique((_words(batch.column("text").to_pylist())[3] % np.uint64(SKETCH)).astype(np.int32), return_counts=True)
            held[counter] += n.astype(np.uint32)
        for block in range(0, SKETCH, _BLOCK):
            if len(counter := np.flatnonzero(held[block : block + _BLOCK])):
                yield pa.RecordBatch.from_pydict({"counter": pa.array((counter + block).astype(np.int32)), "n": pa.array(held[block + counter].astype(np.int64))})

    def blocks(group: pd.DataFrame) -> pd.DataFrame:
        held = np.zeros(_BLOCK, np.uint32)
        held[group["counter"] % _BLOCK] = np.minimum(group["n"], 2**32 - 1)
        return pd.DataFrame({"block": [int(group["counter"].iloc[0]) // _BLOCK], "counts": [held.tobytes()]})

    found = docs.select(utf8().alias("text")).mapInArrow(run, "counter int, n long").groupBy("counter").agg(F.sum("n").alias("n"))
    counters = np.zeros(SKETCH, np.uint32)
    for block, counts in found.groupBy(F.floor(F.col("counter") / _BLOCK)).applyInPandas(blocks, "block int, counts binary").collect():
        counters[block * _BLOCK : (block + 1) * _BLOCK] = np.frombuffer(counts, np.uint32)
    return counters


def _starts(line: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else np.zeros(0, np.int64)


def _line_table(docs: DataFrame, counters: np.ndarray, min_tokens: int, percent: int) -> DataFrame:
    """Per line with enough tokens: doc_id, line, size, k1, k2 (of its set), parity bitmap, prefix (by rarity: place and token in one number)."""
    shared = docs.sparkSession.sparkContext.broadcast(np.minimum(counters, 2**16 - 1).astype(np.uint16))

    def rows(batch: pa.RecordBatch) -> dict:
        owner, number, line, token = _words(batch.column("text").to_pylist())
        line, token, seen = _distinct(line, token, shared.value[(token % np.uint64(SKETCH)).astype(np.int64)])
        sizes = np.bincount(line, minlength=len(owner))
        enough = sizes[line] >= min_tokens
        line, token, seen = line[enough], token[enough], seen[enough]
        starts = _starts(line)
        at = line[starts]
        size = sizes[at]
        prefix = size - -(-size * percent // 100) + 1
        place = np.arange(len(line)) - np.repeat(starts, size)
        # A token that occurs once in all lines is shared by no two.
        first = (place < np.repeat(prefix, size)) & (seen > 1)
        word, bit = token >> np.uint64(63), np.uint64(1) << ((token >> np.uint64(57)) & np.uint64(63))
        fold = lambda ufunc, v: ufunc.reduceat(v, starts).view(np.int64) if len(starts) else np.zeros(0, np.int64)
        offsets = np.concatenate([[0], np.cumsum(first)])[np.append(starts, len(first))].astype(np.int32)
        return {
            "doc_id": batch.column("doc_id").take(pa.array(owner[at])), "line": pa.array(number[at]), "size": pa.array(size.astype(np.int32)),
            "k1": pa.array(fold(np.add, mixed(token))), "k2": pa.array(fold(np.add, mixed(token ^ _SALT))),
            **{name: pa.array(fold(np.bitwise_xor, np.where(word == w, bit, np.uint64(0)))) for w, name in enumerate(_BITS)},
            "prefix": pa.ListArray.from_arrays(pa.array(offsets), pa.array((place[first] << 32) | ((token[first] >> np.uint64(16)) & np.uint64(0xFFFFFFFF)).view(np.int64))),
        }

    bits = ", ".join(f"{name} long" for name in _BITS)
    return per_batch(docs.select("doc_id", utf8().alias("text")), f"doc_id long, line int, size int, k1 long, k2 long, {bits}, prefix array<long>", rows)


def _overlap(percent: int, *sizes: Column) -> Column:
    """Fewest common tokens of sets of these sizes at the threshold."""
    total = sum(sizes[1:], sizes[0])
    return F.ceil(F.lit(percent) * total / F.lit(100 + percent))


def _match(a: str, b: str, percent: int, either: bool = False) -> Column:
    """Postings on one token, ``a`` of an earlier line (of any other one, if ``either``), that pass the length, prefix, positional and bitmap
    filters."""
    c = lambda side, name: F.col(f"{side}.{name}")
    size_a, size_b = (c(x, "line_size").bitwiseAND(_LOW) for x in (a, b))
    place_a, place_b = (F.shiftright(c(x, "place_token"), 32) for x in (a, b))
    if either:
        earlier = (c(a, "doc_id") != c(b, "doc_id")) | (c(a, "line_size") != c(b, "line_size"))
    else:
        earlier = (c(a, "doc_id") < c(b, "doc_id")) | (c(a, "doc_id") == c(b, "doc_id")) & (c(a, "line_size") < c(b, "line_size"))
    low, high = F.least(size_a, size_b), F.greatest(size_a, size_b)
    need = _overlap(percent, size_a, size_b)
    # The smaller set's postings end earlier. Of equal sizes, the positional filter holds both places to this, so the order of a and b is only in ``earlier``.
    short = F.when(size_a <= size_b, place_a).otherwise(place_b) <= low - _overlap(percent, low, low)
    differing = sum((F.bit_count(c(a, w).bitwiseXOR(c(b, w))) for w in _BITS), F.lit(0))
    same = c(a, "place_token").bitwiseAND(_LOW) == c(b, "place_token").bitwiseAND(_LOW)
    return same & earlier & (low * 100 >= high * percent) & (F.least(size_a - place_a, size_b - place_b) >= need) & short & (differing <= size_a + size_b - 2 * need)


def _settled(late: DataFrame, early: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Lines of ``late`` postings that are similar to the line of an earlier posting on one token, by their full sets."""
    at = ["doc_id", "line"]
    partners = early.alias("a").join(late.alias("b"), _match("a", "b", percent), "left_semi").join(sets, at)
    both = F.size(F.array_intersect("a.set", "b.set"))
    similar = both * 100 >= F.lit(percent) * (F.size("a.set") + F.size("b.set") - both)
    found = late.join(sets, at).alias("b").join(partners.alias("a"), _match("a", "b", percent) & similar, "left_semi")
    return found.select(*at).distinct()


def _sets(lines: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id, line, set (hashes of the distinct tokens) of some lines, from their texts."""
    wanted = written(lines.groupBy("doc_id").agg(F.collect_list("line").alias("lines")), "wanted_lines")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)

    def rows(batch: pa.RecordBatch) -> dict:
        ids, numbers, found = [], [], []
        for doc_id, text, some in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "lines"))):
            split = text.split(b"\n")
            for number in some:
                if number < len(split):
                    ids.append(doc_id), numbers.append(number), found.append(split[number])
        _, _, line, token = _words(found)
        line, token, _ = _distinct(line, token, np.zeros(len(line), np.int64))
        ends = np.concatenate([[0], np.cumsum(np.bincount(line, minlength=len(ids)))]).astype(np.int32)
        return {"doc_id": pa.array(ids, pa.int64()), "line": pa.array(numbers, pa.int32()), "set": pa.ListArray.from_arrays(pa.array(ends), pa.array(token.view(np.int64)))}

    texts = docs.select("doc_id", utf8().alias("text")).join(wanted, "doc_id")
    return written(per_batch(texts, "doc_id long, line int, set array<long>", rows), "line_sets")


def _similar_to_earlier(classes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, line of classes whose set is similar to that of an earlier class."""
    # Two numbers to a column: these rows are most of what is shuffled.
    line_size = F.shiftleft(F.col("line").cast("long"), 32).bitwiseOR(F.col("size").cast("long")).alias("line_size")
    postings = classes.select("doc_id", line_size, *_BITS, F.explode("prefix").alias("place_token"))
    line = F.shiftright("line_size", 32).cast("int").alias("line")
    # Postings with a partner on either side first: all later joins are between these, and the only one of all postings deals them out once.
    paired = written(postings.alias("b").join(postings.alias("a"), _match("a", "b", percent, either=True), "left_semi"), "paired_postings")
    late = written(paired.alias("b").join(paired.alias("a"), _match("a", "b", percent), "left_semi"), "late_postings")
    early = written(paired.alias("a").join(late.alias("b"), _match("a", "b", percent), "left_semi"), "early_postings")
    late, early, at = late.withColumn("line", line), early.withColumn("line", line), ["doc_id", "line"]
    sets = _sets(late.select(*at).unionByName(early.select(*at)).distinct(), docs)
    rarest = late.groupBy(*at).agg(F.min("place_token").alias("place_token"))
    found = written(_settled(late.join(rarest, [*at, "place_token"], "left_semi"), early, sets, percent), "settled")
    settled = F.broadcast(found) if found.count() <= BROADCAST_IDS else found
    more = late.join(rarest, [*at, "place_token"], "left_anti").join(settled, at, "left_anti")
    return found.unionByName(_settled(more, early, sets, percent))


def removed_lines(docs: DataFrame, percent: int = 80, min_tokens: int = 1) -> DataFrame:
    """doc_id, lines: of every document that loses some, the numbers of the lines to remove, ascending."""
    small_batches(docs, "1m")
    named = docs.where("doc_id is not null and text is not null")
    lines = written(_line_table(named, _counters(named), min_tokens, percent), "lines")
    first = F.min(F.struct("doc_id", "line", "size", *_BITS, "prefix")).alias("f")
    classes = written(lines.groupBy("k1", "k2").agg(first).select("f.*"), "line_classes")
    # Different sets are similar from this size on only: one token less in a set of k leaves (k - 1) / k of it.
    least = -(-percent // (100 - percent)) if percent < 100 else 2**31 - 1
    matched = _similar_to_earlier(classes.where(F.col("size") >= least), named, percent)
    kept = classes.select("doc_id", "line").join(matched, ["doc_id", "line"], "left_anti")
    gone = lines.select("doc_id", "line").join(kept, ["doc_id", "line"], "left_anti").distinct()
    return gone.groupBy("doc_id").agg(F.array_sort(F.collect_list("line")).alias("lines"))


def without_repeats(docs: DataFrame, percent: int = 80, min_tokens: int = 1) -> DataFrame:
    """The documents with all their columns, texts without the removed lines."""
    numbered_rows = with_row_ids(docs)
    rows, key = numbered_rows or (docs, "doc_id")
    gone = removed_lines(rows.select(F.col(key).alias("doc_id"), "text"), percent, min_tokens).select(F.col("doc_id").alias("__of"), F.col("lines").alias("__gone"))
    split = F.split("text", "\n", -1)
    kept = F.transform(F.filter(F.transform(split, lambda line, i: F.struct(line.alias("l"), i.alias("i"))), lambda s: ~F.array_contains("__gone", s["i"])), lambda s: s["l"])
    joined = rows.join(gone, F.col(key) == F.col("__of"), "left")
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return joined.withColumn("text", text).select(*docs.columns)
