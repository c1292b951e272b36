"""Language identification by rank-order profiles.

A language's profile is its ``PROFILE`` most frequent n-grams of one to three characters, by rank, counted over all labelled
documents that are learnt from. A text's own most frequent n-grams are ranked alike, and the language with the smallest
out-of-place distance wins: the sum over the text's n-grams of how far their rank is from the profile's, ``PROFILE`` where
the profile lacks them.

N-grams lie in lower-cased words of letters with a blank on either side. Each is one 64-bit number (21 bits a character), so
counting is sorting numbers; texts of any length are taken in pieces of ``PIECE`` characters.

Defined results: the language is ``und`` with score 0 for a null text, one without letters, and where nothing was learnt; a
null lang teaches nothing; a row with a null doc_id counts as held out; equal counts rank by the n-gram's number,
equal distances go to the first language in byte order; rows that repeat a doc_id are judged (and learnt from) each; an empty
table has no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bidtide.operators.skew import running_sums
from bidtide.session import written

PROFILE = 400
UNKNOWN = "und"
#: Characters taken at once; text that a task gathers before it counts.
PIECE = 400_000
#: Distinct n-grams that a task holds before it hands its counts on.
HELD = 1_000_000
#: Languages whose profiles are broadcast together: at most PROFILE numbers each.
BLOCK = 500
_BLANK, _BITS = 1, np.uint64(21)


class _Letters:
    """Whether a code point is a letter, looked up once per code point and worker."""

    def __init__(self) -> None:
        self.known = np.full(0x110000, -1, np.int8)

    def of(self, points: np.ndarray) -> np.ndarray:
        found = self.known[points]
        if (found < 0).any():
            for point in np.unique(points[found < 0]).tolist():
                self.known[point] = chr(point).isalpha()
            found = self.known[points]
        return found > 0


_LETTERS = _Letters()


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-grams and their counts from several such pairs."""
    if len(parts) == 1:
        return parts[0]
    grams, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return grams, np.bincount(at, np.concatenate([n for _, n in parts]), len(grams)).astype(np.int64)


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a text, sorted and distinct, and their counts."""
    parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    before = np.array([_BLANK], np.uint64)
    for start in range(0, len(text) + 1, PIECE):
        last = start + PIECE > len(text)
        points = np.frombuffer(text[start : start + PIECE].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols = np.where(_LETTERS.of(points), points, _BLANK).astype(np.uint64)
        if last:
            symbols = np.append(symbols, np.uint64(_BLANK))
        line = np.concatenate([before, symbols])
        # One blank between words; symbols already counted are the first of the line.
        keep = np.concatenate([np.ones(len(before), bool), (line[len(before) :] != _BLANK) | (line[len(before) - 1 : -1] != _BLANK)])
        line, done = line[keep], len(before)
        ones = line[done:][line[done:] != _BLANK]
        twos = ((line[:-1] << _BITS) | line[1:])[done - 1 :]
        threes = ((line[:-2] << (_BITS + _BITS)) | (line[1:-1] << _BITS) | line[2:])[line[1:-1] != _BLANK]  # three symbols reach into new ones
        grams = np.concatenate([ones, twos, threes])
        if len(grams):
            parts.append(np.unique(grams, return_counts=True))
            if len(parts) > 8:
                parts = [_merged(parts)]
        before = line[-2:]
    return _merged(parts)


def ranked(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The most frequent n-grams, best first."""
    return grams[np.lexsort((grams, -counts))[:PROFILE]]


def held_out() -> Column:
    """A fifth of the documents, by checksum of the id; so are rows without an id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))


def _counts(texts: DataFrame) -> DataFrame:
    """lang, gram, n: counts of tasks, to be summed. A task joins texts of one language by blanks, which adds no n-gram."""

    def rows(held: dict[str, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for lang, (grams, counts) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(counts)], names=["lang", "gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        waiting: dict[str, list[str]] = {}
        size = 0

        def count() -> None:
            for lang, parts in waiting.items():
                new = counted(" ".join(parts))
                held[lang] = _merged([held[lang], new]) if lang in held else new
            waiting.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                waiting.setdefault(lang, []).append(text.as_py())
                size += len(waiting[lang][-1])
                if size >= PIECE:
                    count()
                    size = 0
                    if sum(len(grams) for grams, _ in held.values()) > HELD:
                        yield from rows(held)
                        held.clear()
        count()
        yield from rows(held)

    return texts.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")


def profiles(docs: DataFrame, learnt: Column) -> DataFrame:
    """lang, number (in order of lang), grams: each language's most frequent n-grams over the documents ``learnt`` from, by rank."""
    texts = docs.where(learnt & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = _counts(texts).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    best = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PROFILE)
    listed = best.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("rank", "gram")))["gram"].alias("grams"))
    return written(running_sums(written(listed, "language_profiles"), None, ["lang"], {"number": F.lit(1)}, include_current=False), "numbered_profiles")


def _table(known: list[tuple[str, list[int]]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, all n-grams of their profiles sorted, and the rank of each n-gram (row) by language; -1 where it is lacking."""
    grams = np.unique(np.concatenate([np.asarray(g, np.uint64) for _, g in known]))
    ranks = np.full((len(grams), len(known)), -1, np.int64)
    for i, (_, g) in enumerate(known):
        ranks[np.searchsorted(grams, np.asarray(g, np.uint64)), i] = np.arange(len(g))
    return [lang for lang, _ in known], grams, ranks


def distances(own: np.ndarray, grams: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The out-of-place distance of ranked n-grams to each language."""
    at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
    there = ranks[at]
    there[grams[at] != own] = -1
    return np.where(there < 0, PROFILE, np.abs(there - np.arange(len(own))[:, None])).sum(axis=0)


def identified(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``docs`` (text) with lang_pred and score, the share of the largest distance that is not taken."""
    spark = docs.sparkSession
    top = known.agg(F.max("number")).first()[0]
    rest = [f for f in docs.schema.fieldNames() if f != "text"]
    found = docs.select(*rest, F.coalesce("text", F.lit("")).alias("text"), F.lit(None).cast("string").alias("__lang"), F.lit(None).cast("double").alias("__far"))
    for first in range(0, 0 if top is None else top + 1, BLOCK):
        block = known.where((F.col("number") >= first) & (F.col("number") < first + BLOCK)).orderBy("number").collect()
        shared = spark.sparkContext.broadcast(_table([(r["lang"], r["grams"]) for r in block]))
        found = _nearer(found, shared)
    return found.select(*rest, F.coalesce("__lang", F.lit(UNKNOWN)).alias("lang_pred"), F.coalesce(1 - F.col("__far"), F.lit(0.0)).alias("score"))


def _nearer(texts: DataFrame, shared) -> DataFrame:
    """Replace __lang where a language of the block is nearer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, grams, ranks = shared.value
        for batch in batches:
            best, far = batch.column("__lang").to_pylist(), batch.column("__far").to_pylist()
            for i, text in enumerate(batch.column("text")):
                own = ranked(*counted(text.as_py()))
                if len(own):
                    apart = distances(own, grams, ranks) / (len(own) * PROFILE)
                    k = int(apart.argmin())
                    if far[i] is None or apart[k] < far[i]:
                        best[i], far[i] = langs[k], float(apart[k])
            columns = {c: batch.column(c) for c in batch.schema.names} | {"__lang": pa.array(best, pa.string()), "__far": pa.array(far, pa.float64())}
            yield pa.RecordBatch.from_pydict(columns)

    return texts.mapInArrow(run, texts.schema)


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document; what is held out is not learnt from."""
    known = profiles(docs, ~held_out())
    return identified(docs.select("doc_id", held_out().alias("held_out"), "text"), known)
