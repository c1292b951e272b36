"""Benchmark decontamination: one Aho-Corasick automaton over the benchmark's word windows scans every text once.

Windows are ``window`` consecutive words of an item (an item of fewer words is one window). The automaton's patterns
are windows as blank-separated words; a text is scanned in the same form, so one pass finds all windows, and word
numbers are mapped back to character offsets of the original for the texts that have hits.

Defined results: a null or empty text has no words and no hits; an item without words or without an id is never found;
items with the same window are both found; documents given twice are judged twice, items given twice count once; an
empty benchmark leaves every document clean; other columns of either table are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidtide.llm.text import alnum_words, per_batch, small_batches, utf8
from bidtide.session import written

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Words of benchmark text behind one automaton (some 100 MB of memory); a larger benchmark takes several passes.
PASS_WORDS = 200_000
_RANGES = pa.list_(pa.list_(pa.int64()))


def _patterns(items: Iterable[tuple[object, str | None]], window: int) -> dict[str, list[str]]:
    found: dict[str, list[str]] = {}
    for item_id, text in items:
        words = alnum_words((text or "").encode())
        if item_id is None or not words:
            continue
        for start in range(max(1, len(words) - window + 1)):
            owners = found.setdefault(f" {b' '.join(words[start : start + window]).decode('latin-1')} ", [])
            if str(item_id) not in owners:
                owners.append(str(item_id))
    return found


def _runs(hit: np.ndarray) -> list[list[int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]])))
    return edges.reshape(-1, 2).tolist()


def _characters(text: bytes, runs: list[list[int]]) -> list[list[int]]:
    """Character ranges in the original of runs of words."""
    bounds = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    chars = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [[int(chars[bounds[a][0]]), int(chars[bounds[b - 1][1]])] for a, b in runs]


def _scan(frame: DataFrame, patterns: dict[str, list[str]]) -> DataFrame:
    """Add one automaton's hits to what earlier passes found."""
    shared = frame.sparkSession.sparkContext.broadcast(patterns)
    built: list[ahocorasick.Automaton] = []

    def automaton() -> ahocorasick.Automaton:
        if not built:
            machine = ahocorasick.Automaton()
            for key, owners in shared.value.items():
                machine.add_word(key, (key.count(" ") - 1, owners))
            machine.make_automaton()
            built.append(machine)
        return built[0]

    def rows(batch: pa.RecordBatch) -> dict:
        machine = automaton() if shared.value else None
        out = {"n_words": [], "word_spans": [], "spans": [], "items": []}
        before = zip(*(batch.column(c).to_pylist() for c in ("text", "word_spans", "items")))
        for text, runs, items in before:
            words = alnum_words(text)
            joined = f" {b' '.join(words).decode('latin-1')} "
            ends = list(machine.iter(joined)) if machine and words else []
            if ends:
                number = np.cumsum(np.frombuffer(joined.encode("latin-1"), np.uint8) == 32)
                change, owners = np.zeros(len(words) + 1, np.int64), set(items)
                for a, b in runs:
                    change[a] += 1
                    change[b] -= 1
                for at, (length, names) in ends:
                    last = number[at] - 1
                    change[last - length] += 1
                    change[last] -= 1
                    owners.update(names)
                runs, items = _runs((np.cumsum(change[:-1]) > 0).astype(np.int8)), sorted(owners)
            out["n_words"].append(len(words))
            out["word_spans"].append(runs)
            out["spans"].append(_characters(text, runs) if runs else [])
            out["items"].append(items)
        return {
            "doc_id": batch.column("doc_id"), "text": batch.column("text"), "n_words": pa.array(out["n_words"], pa.int64()),
            "word_spans": pa.array(out["word_spans"], _RANGES), "spans": pa.array(out["spans"], _RANGES), "items": pa.array(out["items"], pa.list_(pa.string())),
        }

    return per_batch(frame, f"doc_id {_id_type(frame)}, text binary, n_words long, word_spans array<array<long>>, spans array<array<long>>, items array<string>", rows)


def _id_type(frame: DataFrame) -> str:
    return frame.schema["doc_id"].dataType.simpleString()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, pass_words: int = PASS_WORDS) -> DataFrame:
    """Per document: doc_id, text (UTF-8), n_words, word_spans and spans (runs of hit words, in word numbers and in
    characters, ends exclusive) and items (found item ids as sorted strings).

    A benchmark of more than ``pass_words`` words is split by a hash of its items; each pass reads what the one
    before has written, so no task ever holds more than one automaton of bounded size.
    """
    small_batches(docs, "2m")
    words = F.size(F.split(F.coalesce("text", F.lit("")), r"\s+"))
    passes = max(1, -(-int(benchmark.agg(F.sum(words)).first()[0] or 0) // pass_words))
    items = benchmark.select("item_id", "text", F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)).alias("pass"))
    frame = docs.select("doc_id", utf8().alias("text"), F.lit(None).cast("array<array<long>>").alias("word_spans"), F.lit(None).cast("array<string>").alias("items"))
    frame = frame.withColumns({c: F.coalesce(c, F.array().cast(t)) for c, t in (("word_spans", "array<array<long>>"), ("items", "array<string>"))})
    for number in range(passes):
        found = _patterns(((r.item_id, r.text) for r in items.where(F.col("pass") == number).toLocalIterator()), window)
        frame = _scan(frame.select("doc_id", "text", "word_spans", "items"), found)
        frame = written(frame, "contamination") if number + 1 < passes else frame
    return frame


def n_hit() -> Column:
    """Number of hit words of a row of ``contamination``."""
    return F.aggregate("word_spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])


def without_contaminated(docs: DataFrame, benchmark: DataFrame, share: float = 0.0, window: int = 10) -> DataFrame:
    """The documents of which at most ``share`` of the words are hit, with all their columns and unchanged texts."""
    # The text goes to Python and back once, and not a second time among the columns.
    others = [F.col(c) for c in docs.columns if c != "text"]
    keyed = docs.select(F.struct(*others, F.col("text").isNull().alias("__no_text")).alias("doc_id"), "text")
    found = contamination(keyed, benchmark, window)
    kept = found.where(n_hit() <= share * F.col("n_words"))
    text = F.when(~F.col("doc_id.__no_text"), F.col("text").cast("string")).alias("text")
    return kept.select(*[text if c == "text" else F.col("doc_id").getField(c).alias(c) for c in docs.columns])
