"""Words of a text, on its UTF-8 bytes, and the Arrow plumbing around per-document Python code.

Every operator here sees the whole text. A null text counts as an empty one. All helpers hold one Arrow batch
(at most ``spark.sql.execution.arrow.maxBytesPerBatch``) and one document's arrays at a time.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Lower-cases A-Z and blanks every ASCII character that is neither a digit nor a letter. UTF-8 bytes from 0x80 up
# belong to characters beyond ASCII and stay.
_ALNUM = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else b + 32 if 65 <= b < 91 else 32 for b in range(256))


def alnum_words(text: bytes) -> list[bytes]:
    """Runs of ASCII digits, ASCII letters (lower-cased) and characters beyond ASCII."""
    return text.translate(_ALNUM).split()


def spaced_words(text: bytes) -> list[bytes]:
    """Runs without ASCII white space, A-Z lower-cased."""
    return text.lower().split()


class WordHashes(dict):
    """64-bit hashes of words, remembered for the words seen lately."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.LIMIT:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    values = (values ^ (values >> _SHIFT)) * _MIX
    return values ^ (values >> _SHIFT)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of ``size`` consecutive words. Fewer words count as one shingle, none give none."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(size, n)
    out = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        out = mixed(out + hashes[i : n - width + 1 + i])
    return np.unique(out)


def utf8(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


_HELD: list[dict] = []


def worker_cache() -> dict:
    """A dictionary that a Python worker keeps between tasks of one operator."""
    _HELD.append({})
    return _HELD[-1]


def release() -> None:
    """Empty what tasks of other operators have left in this worker, the free memory of Arrow and of the C library included."""
    for cache in _HELD:
        cache.clear()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def per_batch(df: DataFrame, schema: str, rows: Callable[[pa.RecordBatch], dict[str, list | np.ndarray | pa.Array]]) -> DataFrame:
    """Apply ``rows`` to every Arrow batch; it returns columns by name, in the order of ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(dict(rows(batch)))

    return df.mapInArrow(run, schema)


def small_batches(df: DataFrame, batch_bytes: str = "8m") -> None:
    """Bound what one Python worker holds: texts reach it in batches of about this size, or one text."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", batch_bytes)
