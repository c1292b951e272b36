"""Mixture-controlled packing: deficit round-robin over source queues, window by window.

Every source is a queue of its documents' ids. Each window of ``width`` ids serves the queues in turn; a queue's credit
grows by its share of the window and what rounding withholds (or grants early) is its deficit, carried into the next
window. Served ids of a queue after any number of windows are thus the nearest whole numbers to its due share: the
first ``seats`` ids when all ids are ordered by (k + 1/2) / n for the k-th of n ids of a queue, ties in queue order. That
form of the round-robin can be taken up at any window without the ones before, so deficits carry across partitions at
no cost: with the queues' totals known, each task places the documents it holds. No ids are shuffled.

Without ``weights`` the target is the queues' own shares, and every window holds it to the end. With weights, windows
hold those until the first queue is empty; the others go on in proportion, and so forth, so that all ids are packed.

All windows are full but the last, which is cut into sequences of powers of two: no sequence is padded.

Defined results: a null or empty text is its end id; a null source is a queue; repeated rows are packed as often as
they occur; an empty table gives no rows; extra columns are ignored. Queues are kept apart up to ``max_queues``; with
more sources than that (more than a window has ids), sources share queues by a hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bidtide.llm.text import per_batch, small_batches
from bidtide.llm.tokens import MEMORY, PieceIds
from bidtide.session import written

WIDTH = 1024
#: Rows of the table of queues in partitions up to which it is sent to the tasks; beyond, ids are shuffled.
BROADCAST_ROWS = 200_000


def _shared_out(totals: np.ndarray, seats: np.ndarray) -> np.ndarray:
    """Ids served to each queue (columns) when ``seats`` (rows) ids are served in all."""
    total = int(totals.sum())
    if not total:
        return np.zeros((len(seats), len(totals)), np.int64)
    with np.errstate(divide="ignore", invalid="ignore"):
        n = totals.astype(float)
        due = lambda k: np.where((k >= 0) & (k < totals), (k + 0.5) / n, np.nan)
        counts = np.minimum(np.floor(n * (seats / total)[:, None] + 0.5).astype(np.int64), totals)
        rows = np.arange(len(seats))
        while True:
            over = counts.sum(axis=1) - seats
            last, following = due(counts - 1), due(counts)
            last, following = np.where(np.isnan(last), -np.inf, last), np.where(np.isnan(following), np.inf, following)
            worst = len(totals) - 1 - np.argmax(last[:, ::-1], axis=1)  # of equal ones the later queue gives way
            best = np.argmin(following, axis=1)
            a, b = last[rows, worst], following[rows, best]
            swap = (a > b) | (a == b) & (worst > best)
            drop, take = (over > 0) | (over == 0) & swap, (over < 0) | (over == 0) & swap
            if not (drop | take).any():
                return counts
            counts[rows[drop], worst[drop]] -= 1
            counts[rows[take], best[take]] += 1


class Schedule:
    """Phases of the round-robin: in each, fixed totals are served in proportion."""

    def __init__(self, totals: list[int], weights: list[float] | None):
        left = np.array(totals, np.int64)
        self.total = int(left.sum())
        phases = []
        if weights is not None:
            share = np.array(weights, float)
            if (share < 0).any():
                raise ValueError("weights must not be negative")
            while True:
                live = (left > 0) & (share > 0)
                if not live.any():
                    break
                lasts = np.where(live, left / np.where(live, share, 1), np.inf)
                served = np.where(live, np.minimum(np.round(np.minimum(share * lasts.min(), self.total)).astype(np.int64), left), 0)
                served[np.argmin(lasts)] = left[np.argmin(lasts)]
                phases.append(served)
                left = left - served
        if left.any() or not phases:
            phases.append(left)
        self.phases = np.array(phases)
        self.before = np.concatenate([np.zeros((1, len(totals)), np.int64), np.cumsum(self.phases, axis=0)])
        self.seats = self.before.sum(axis=1)

    def served(self, seats: np.ndarray) -> np.ndarray:
        """Ids taken from each queue by the first ``seats`` ids of the output."""
        out = np.empty((len(seats), self.phases.shape[1]), np.int64)
        phase = np.clip(np.searchsorted(self.seats, seats, "right") - 1, 0, len(self.phases) - 1)
        for p in np.unique(phase):
            rows = phase == p
            out[rows] = self.before[p] + _shared_out(self.phases[p], seats[rows] - self.seats[p])
        return out

    def near(self, queue: int, ids: np.ndarray) -> np.ndarray:
        """About the output place of a queue's ids."""
        phase = np.clip(np.searchsorted(self.before[:, queue], ids, "right") - 1, 0, len(self.phases) - 1)
        share = (ids - self.before[phase, queue]) / np.maximum(self.phases[phase, queue], 1)
        return self.seats[phase] + share * (self.seats[phase + 1] - self.seats[phase])


def _queues(docs: DataFrame, tokenizer: str, end_id: int, max_queues: int, remembered: int) -> DataFrame:
    """Written ids of all documents with their place among their queue's ids in their partition."""
    source = F.col("source").cast("string")
    many = docs.select(source.alias("s")).distinct().limit(max_queues + 1).count() > max_queues
    queue = F.concat(F.lit("#"), F.pmod(F.xxhash64(source), F.lit(max_queues)).cast("string")) if many else source
    kind = docs.schema["doc_id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seen = PieceIds.of(tokenizer, remembered), TaskContext.get().partitionId(), {}
        narrow = encoder.vocabulary() <= 1 << 16 and end_id < 1 << 16
        for batch in batches:
            at, sizes, packed = [], [], []
            for name, ids in zip(batch.column("queue").to_pylist(), encoder.encode(batch.column("text").to_pylist())):
                at.append(seen.get(name, 0))
                sizes.append(len(ids) // 4 + 1)
                seen[name] = at[-1] + sizes[-1]
                packed.append(np.frombuffer(ids + end, "<u4").astype("<u2").tobytes() if narrow else ids + end)
            columns = [pa.array([part] * len(at), pa.int32()), batch.column("queue"), batch.column("doc_id"), pa.array(at, pa.int64()), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "queue", "doc_id", "at", "n", "ids"])

    texts = docs.select("doc_id", queue.alias("queue"), F.coalesce("text", F.lit("")).alias("text"))
    return written(texts.mapInArrow(run, f"part int, queue string, doc_id {kind}, at long, n long, ids binary"), "queues")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, width: int = WIDTH, weights: dict[str, float] | None = None, max_queues: int = 1000,
         remembered: int = MEMORY) -> DataFrame:
    """Pieces: doc_id, queue, start (ids of its document before), length, ids (32-bit little-endian), doc_tokens,
    sequence_id, offset. ``docs`` needs doc_id, source and text.

    Gathered to the driver and sent round: one total for each of at most ``max_queues`` queues, and up to ``BROADCAST_ROWS`` rows of the
    queues' totals in partitions. ``remembered`` bounds the pieces
    whose ids a Python worker keeps; results don't depend on it.
    """
    small_batches(docs)
    queued = _queues(docs, tokenizer, end_id, max_queues, remembered)
    parts = queued.groupBy("queue", "part").agg(F.sum("n").alias("n"))
    totals = sorted(parts.groupBy("queue").agg(F.sum("n")).collect(), key=lambda r: (r[0] is not None, r[0]))
    names = [r[0] for r in totals]
    shares = None if weights is None or not names else [float(weights.get(name, 0.0)) for name in names]
    plan = Schedule([r[1] for r in totals], shares)
    number = {name: i for i, name in enumerate(names)}
    full, rest = divmod(plan.total, width)
    ends = [rest >> b << b for b in range(rest.bit_length(), -1, -1)]  # of the last window's sequences
    ends = sorted({e for e in ends if e})
    before = parts.select("queue", "part", (F.sum("n").over(Window.partitionBy("queue").orderBy("part")) - F.col("n")).alias("base"))
    # Few rows, unless queues are many: then the ids needn't be dealt out.
    before = written(before, "before")
    before = F.broadcast(before) if before.count() <= BROADCAST_ROWS else before
    placed = queued.alias("q").join(before.alias("b"), F.col("q.queue").eqNullSafe(F.col("b.queue")) & (F.col("q.part") == F.col("b.part")))
    placed = placed.select("q.doc_id", "q.queue", (F.col("base") + F.col("at")).alias("first"), "q.n", "q.ids")

    def rows(batch: pa.RecordBatch) -> dict:
        queue = np.array([number[name] for name in batch.column("queue").to_pylist()])
        first, n = batch.column("first").to_numpy(), batch.column("n").to_numpy()
        low, high = np.empty(len(n), np.int64), np.empty(len(n), np.int64)
        for q in np.unique(queue):
            mine = queue == q
            low[mine] = plan.near(q, first[mine]) // width - 2
            high[mine] = plan.near(q, first[mine] + n[mine]) // width + 3
        low, high = np.clip(low, 0, full), np.clip(high, 1, full + 1)
        change = np.zeros(int(high.max() - low.min()) + 2, np.int64)
        np.add.at(change, low - low.min(), 1)
        np.add.at(change, high - low.min() + 1, -1)
        windows = np.flatnonzero(np.cumsum(change) > 0) + low.min()  # those that any of these documents may touch
        served = plan.served(np.minimum(windows * width, plan.total))
        out: dict[str, list[np.ndarray]] = {k: [] for k in ("row", "start", "length", "sequence_id", "offset")}
        ids = []
        for i, (q, begin, size, packed) in enumerate(zip(queue.tolist(), first.tolist(), n.tolist(), batch.column("ids").to_pylist())):
            lo, hi = np.searchsorted(windows, (low[i], high[i]))
            bounds = served[lo : hi + 1, q]
            a, b = np.searchsorted(bounds, begin, "right") - 1, np.searchsorted(bounds, begin + size)
            cuts = np.clip(bounds[a : b + 1], begin, begin + size)
            w = windows[lo + a : lo + b]
            inside = served[lo + a + 1 : lo + b + 1, :q].sum(axis=1) - served[lo + a : lo + b, :q].sum(axis=1)
            pieces = cuts[:-1] - begin, np.diff(cuts), w, inside + cuts[:-1] - bounds[a:b]
            if len(w) and w[-1] == full:
                last = _cut_last(*(int(column[-1]) for column in (pieces[0], pieces[1], pieces[3])), full, ends)
                pieces = tuple(np.concatenate([column[:-1], np.array(rest, np.int64)]) for column, rest in zip(pieces, zip(*last) if last else [()] * 4))
            some = pieces[1] > 0
            for name, column in zip(("start", "length", "sequence_id", "offset"), pieces):
                out[name].append(column[some])
            out["row"].append(np.full(int(some.sum()), i))
            ids.append(np.frombuffer(packed, "<u2" if len(packed) == 2 * size else "<u4"))
        columns = {name: np.concatenate(parts).astype(np.int64) for name, parts in out.items()}
        row = pa.array(columns.pop("row"))
        # A document's pieces follow each other and hold all its ids, so the ids of all pieces lie end to end.
        edges = np.concatenate([[0], np.cumsum(4 * columns["length"])])
        if edges[-1] >= 1 << 31:
            raise ValueError("a document has too many ids for one batch")
        ids = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(np.concatenate(ids).astype("<u4"))])
        return {
            "doc_id": batch.column("doc_id").take(row), "queue": batch.column("queue").take(row), "start": pa.array(columns["start"]), "length": pa.array(columns["length"]),
            "ids": ids, "doc_tokens": batch.column("n").take(row), "sequence_id": pa.array(columns["sequence_id"]), "offset": pa.array(columns["offset"]),
        }

    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(placed, f"doc_id {kind}, queue string, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long", rows)


def _cut_last(start: int, length: int, offset: int, window: int, ends: list[int]) -> list[tuple[int, int, int, int]]:
    """A piece of the last window, cut at its sequences' ends; sequences are numbered on from the full windows."""
    out, begin = [], 0
    for i, end in enumerate(ends):
        a, b = max(offset, begin), min(offset + length, end)
        if a < b:
            out.append((start + a - offset, b - a, window + i, a - begin))
        begin = end
    return out


def sequences(pieces: DataFrame, width: int = WIDTH) -> DataFrame:
    """The packed sequences: sequence_id, ids (32-bit little-endian bytes of a whole sequence). At most ``width``
    pieces meet in a group."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(ordered, F.lit(b"").cast("binary"), lambda done, piece: F.concat(done, piece["ids"]))
    return pieces.groupBy("sequence_id").agg(joined.alias("ids"))


