"""Quality classifier: an interpolated modified Kneser-Ney model of bytes, trained on trusted texts, gives every document a
perplexity; language-specific quantiles set the thresholds.

Training. All ``ORDER``-grams of all trusted texts are counted (in each Arrow batch first, then by Spark). Lower orders
count distinct left neighbours. Discounts come from the counts of counts of each order; sums by context and lower-order
probabilities are joined on contexts and suffixes, all partitioned by the n-gram. The model is a written table of n-grams with
log-probabilities and of contexts with log back-off weights, and grows with the corpus.

Scoring. The model is cut into shards by the byte before the predicted one, so each position of a text needs one shard.
Shards of at most ``SHARD_ROWS`` rows are sent to the tasks one after another; each pass adds its positions' log-probabilities to
what the pass before has written. A model below that size takes one pass and no shuffle at all.

Thresholds. A fifth of the trusted documents (by a hash of doc_id) are kept out of training. A score is the mean surprise of a
byte in nats, drawn towards the language's trusted median by ``PRIOR`` bytes so that a few words decide nothing. The threshold
lies halfway between the ``HIGH`` quantile of the held-out trusted documents and the ``LOW`` quantile of the distrusted ones, or
at the former where they overlap. Languages with fewer than ``FEWEST`` held-out trusted documents take the threshold of all.

Defined results: null, empty texts score as the median and are kept; a null language is one of its own; without trusted
documents no document is too surprising and nothing has a threshold; without toxic labels none is toxic; repeated rows are judged alike; labels of unknown
documents and null labels count for nothing, a document with any label of 0 or toxic is not trusted; extra columns are
ignored (filter: stay as they are).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidtide.llm.text import alnum_words, per_batch, small_batches, utf8
from bidtide.session import written

ORDER = 5
SHARD_ROWS = 3_000_000
PRIOR, HIGH, LOW, FEWEST = 64, 0.995, 0.05, 20
REACH, DOUBT = 3, 2.58
#: Weighted words sent to the tasks at a time.
SHARD_WORDS = 500_000
#: Labelled documents up to which their marks are sent to the tasks (some 16 bytes each); beyond, texts are shuffled.
BROADCAST_LABELS = 1_000_000
#: Control bytes count as blanks; byte 0 stands before a text.
_CLEAN = bytes(32 if b < 32 else b for b in range(256))
_WORKER: dict[int, tuple] = {}


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the ``ORDER``-gram that ends at every byte of some texts, and the text of each."""
    pad = b"\0" * (ORDER - 1)
    data = np.frombuffer(b"".join(pad + t.translate(_CLEAN) for t in texts) or pad, np.uint8)
    codes = np.zeros(len(data) - ORDER + 1, np.int64)
    for i in range(ORDER):
        codes = codes << 8 | data[i : len(data) - ORDER + 1 + i]
    sizes = np.array([len(t) for t in texts], np.int64)
    real = data[ORDER - 1 :] != 0
    return codes[real], np.repeat(np.arange(len(texts)), sizes)


def _counted(texts: DataFrame) -> DataFrame:
    def rows(batch: pa.RecordBatch) -> dict:
        gram, n = np.unique(_grams(batch.column("text").to_pylist())[0], return_counts=True)
        return {"gram": pa.array(gram), "n": pa.array(n)}

    return per_batch(texts, "gram long, n long", rows).groupBy("gram").agg(F.sum("n").alias("n"))


def train(texts: DataFrame) -> DataFrame:
    """Written model: order, gram, value. Orders 1 to ORDER hold log P of n-grams, -1 to -(ORDER - 1) log back-off weights
    of contexts of that length."""
    small_batches(texts, "4m")
    level, levels = written(_counted(texts.select(utf8().alias("text"))), "grams"), {}
    for order in range(ORDER, 0, -1):
        levels[order] = level
        if order > 1:
            suffix = F.col("gram").bitwiseAND(F.lit((1 << 8 * (order - 1)) - 1)).alias("gram")
            level = written(level.groupBy(suffix).agg(F.count(F.lit(1)).alias("n")), "grams")
    out, lower = None, None
    for order in range(1, ORDER + 1):
        counts = levels[order]
        seen = dict(counts.where("n <= 4").groupBy("n").count().collect())  # at most four rows
        n1, n2, n3, n4 = (max(seen.get(i, 0), 1) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        d1, d2, d3 = (min(max(v, 0.1), k - 0.1) for k, v in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3)))
        discount = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        rows = counts.select("gram", "n", discount.alias("d"), F.shiftright("gram", 8).alias("context"))
        contexts = rows.groupBy("context").agg(F.sum("n").alias("total"), (F.sum("d") / F.sum("n")).alias("gamma"))
        joined = rows.join(contexts, "context")
        if lower is None:
            below = joined.withColumn("below", F.lit(1 / 256))
        else:
            suffix = F.col("gram").bitwiseAND(F.lit((1 << 8 * (order - 1)) - 1))
            below = joined.join(lower.select(F.col("gram").alias("suffix"), F.col("p").alias("below")), suffix == F.col("suffix"))
        level = written(below.select("gram", ((F.col("n") - F.col("d")) / F.col("total") + F.col("gamma") * F.col("below")).alias("p"), "context", "gamma"), "probabilities")
        part = level.select(F.lit(order).alias("order"), "gram", F.log("p").alias("value"))
        weights = contexts.select(F.lit(1 - order).alias("order"), F.col("context").alias("gram"), F.log("gamma").alias("value"))
        part = part.unionByName(weights)
        out, lower = part if out is None else out.unionByName(part), level
    return written(out, "model")


def _before(order: str = "order", gram: str = "gram"):
    """Byte before the predicted one; a context's last byte."""
    return F.when(F.col(order) > 1, F.shiftright(gram, 8)).otherwise(F.col(gram)).bitwiseAND(F.lit(255))


def _score_pass(frame: DataFrame, model: DataFrame, first_bytes: list[int]) -> DataFrame:
    everywhere = (F.col("order") == 1) | (F.col("order") == 0)
    rows = model.where(everywhere | _before().isin(first_bytes)).toArrow()
    orders, grams, values = (rows[c].to_numpy() for c in ("order", "gram", "value"))
    tables = {int(o): (grams[orders == o], values[orders == o]) for o in np.unique(orders)}
    shared = frame.sparkSession.sparkContext.broadcast(tables)
    del rows, orders, grams, values, tables
    number = shared._jbroadcast.id()
    here = np.zeros(256, bool)
    here[first_bytes] = True

    def indexes() -> tuple:
        if number not in _WORKER:
            _WORKER.clear()
            _WORKER[number] = {o: (pd.Index(k), v) for o, (k, v) in shared.value.items()}
        return _WORKER[number]

    def found(table: tuple | None, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys the table has, and the values of those."""
        if table is None:
            return np.zeros(len(keys), bool), np.zeros(0)
        at = table[0].get_indexer(keys)
        return at >= 0, table[1][at[at >= 0]]

    def rows_of(batch: pa.RecordBatch) -> dict:
        tables = indexes()
        texts = batch.column("text").to_pylist()
        codes, owner = _grams(texts)
        mine = here[codes >> 8 & 255]
        codes, owner = codes[mine], owner[mine]
        log_p, open_ = np.zeros(len(codes)), np.arange(len(codes))
        for order in range(ORDER, 0, -1):
            gram = codes[open_] & ((1 << 8 * order) - 1)
            has, values = found(tables.get(order), gram)
            log_p[open_[has]] += values
            open_, gram = open_[~has], gram[~has]
            weighted, weights = found(tables.get(1 - order), gram >> 8)
            log_p[open_[weighted]] += weights
        log_p[open_] += math.log(1 / 256)
        total = np.bincount(owner, -log_p, minlength=len(texts))
        return {
            "doc": batch.column("doc"), "text": batch.column("text"), "n": pa.array([len(t) for t in texts], pa.int64()),
            "surprise": pa.array(np.asarray(batch.column("surprise")) + total),
        }

    kind = frame.schema["doc"].dataType.simpleString()
    return per_batch(frame, f"doc {kind}, text binary, n long, surprise double", rows_of)


def surprise(docs: DataFrame, model: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """doc (a struct of the document's columns but text), n (bytes), surprise (nats of the whole text)."""
    small_batches(docs, "4m")
    sizes = dict(model.where("order <> 1 and order <> 0").groupBy(_before().alias("byte")).count().collect())  # at most 256 rows
    shards, held = [[]], 0
    for byte in range(256):
        size = sizes.get(byte, 0)
        if shards[-1] and held + size > shard_rows:
            shards.append([])
            held = 0
        shards[-1].append(byte)
        held += size
    others = [c for c in docs.columns if c != "text"]
    frame = docs.select(F.struct(*others).alias("doc"), utf8().alias("text"), F.lit(0.0).alias("surprise"))
    for i, shard in enumerate(shards):
        frame = _score_pass(frame.select("doc", "text", "surprise"), model, shard)
        frame = written(frame, "surprise") if i + 1 < len(shards) else frame
    return frame.select("doc", "n", "surprise")


def _thresholds(scored: DataFrame) -> DataFrame:
    """lang, median, threshold (a row with ``overall`` for all languages) from held-out trusted and distrusted documents."""
    used = scored.where("n > 0 and (trusted and held_out or distrusted)").select("lang", "trusted", "n", "surprise", F.lit(False).alias("overall"))
    both = written(used.unionByName(used.withColumns({"lang": F.lit(None).cast("string"), "overall": F.lit(True)})), "labelled_scores")
    rate = F.col("surprise") / F.col("n")
    medians = both.where("trusted").groupBy("overall", "lang").agg(F.percentile_approx(rate, 0.5, 10_000).alias("median"), F.count(F.lit(1)).alias("trusted_docs"))
    same = F.col("b.lang").eqNullSafe(F.col("m.lang")) & (F.col("b.overall") == F.col("m.overall"))
    at = both.alias("b").join(medians.alias("m"), same).select("b.overall", "b.lang", "trusted", "median", "trusted_docs", ((F.col("surprise") + PRIOR * F.col("median")) / (F.col("n") + PRIOR)).alias("score"))
    quantile = lambda flag, q: F.percentile_approx(F.when(flag, F.col("score")), q, 10_000)
    ends = at.groupBy("overall", "lang", "median", "trusted_docs").agg(quantile(F.col("trusted"), HIGH).alias("high"), quantile(~F.col("trusted"), LOW).alias("low"))
    threshold = _limit(F.col("high"), F.col("low"))
    return written(ends.select("overall", "lang", "median", "trusted_docs", threshold.alias("threshold")), "thresholds")


def _limit(high, low):
    """Between the good documents' ``HIGH`` and the bad ones' ``LOW`` quantile, or at the former where they overlap."""
    return F.when(low > high, (low + high) / 2).otherwise(high)


def _unlearned(scored: DataFrame, learned: DataFrame, gap: float | None) -> DataFrame:
    """of, m, t: of languages that aren't in ``learned`` the median of all their documents and the threshold, null for few."""
    same = F.col("lang").eqNullSafe(F.col("of"))
    rest = scored.where("n > 0").join(learned.select("of"), same, "left_anti").select("lang", "n", "surprise")
    medians = rest.groupBy(F.col("lang").alias("of")).agg(F.percentile_approx(F.col("surprise") / F.col("n"), 0.5, 10_000).alias("m"))
    score = (F.col("surprise") + PRIOR * F.col("m")) / (F.col("n") + PRIOR)
    ends = rest.join(medians, same).groupBy("of", "m").agg(F.percentile_approx(score, LOW, 10_000).alias("low"), F.count(F.lit(1)).alias("docs"))
    reach = F.col("m") + F.greatest(REACH * (F.col("m") - F.col("low")), F.lit(gap).cast("double"))
    return written(ends.select("of", "m", F.when((F.col("docs") >= FEWEST) & F.lit(gap is not None), reach).alias("t")), "own_limits")


def toxic_words(texts: DataFrame) -> DataFrame:
    """Written: word, weight (above 0) of texts with a flag ``toxic``."""
    def rows(batch: pa.RecordBatch) -> dict:
        words, flags = [], []
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            found = set(alnum_words(text))
            words += found
            flags += [toxic] * len(found)
        return {"word": pa.array(words, pa.binary()), "toxic": pa.array(flags, pa.bool_())}

    one = F.when(F.col("toxic"), 1).otherwise(0)
    sizes = texts.agg(F.sum(one).alias("bad"), F.sum(1 - one).alias("good")).first()
    bad, good = sizes.bad or 0, sizes.good or 0
    found = per_batch(texts.select(utf8().alias("text"), "toxic"), "word binary, toxic boolean", rows)
    counts = found.groupBy("word").agg(F.sum(one).alias("a"), F.sum(1 - one).alias("b")).where("a > 0")
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (bad + 1 - a)) - F.log(b / (good + 1 - b))
    weight = odds - DOUBT * F.sqrt(1 / a + 1 / b + 1 / (bad + 1 - a) + 1 / (good + 1 - b))
    return written(counts.select("word", weight.alias("weight")).where("weight > 0"), "toxic_words")


def with_toxicity(docs: DataFrame, words: DataFrame, column: str, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` with the largest weight of a document's words, 0 without any; words are sent round ``shard_words`` at a time."""
    shards = max(1, -(-words.count() // shard_words))
    others = [c for c in docs.columns if c != "text"]
    frame = docs.select(F.struct(*others).alias("doc"), "text", F.lit(0.0).alias("worst"))
    kind = frame.schema["doc"].dataType.simpleString()
    for shard in range(shards):
        rows = words.where(F.pmod(F.xxhash64("word"), F.lit(shards)) == shard).toArrow()
        shared = docs.sparkSession.sparkContext.broadcast(dict(zip(rows["word"].to_pylist(), rows["weight"].to_pylist())))

        def worst(batch: pa.RecordBatch, shared=shared) -> dict:
            weights = shared.value
            texts = (t or "" for t in batch.column("text").to_pylist())
            found = [max((weights[w] for w in weights.keys() & set(alnum_words(t.encode()))), default=0.0) for t in texts]
            return {"doc": batch.column("doc"), "text": batch.column("text"), "worst": pa.array(np.maximum(batch.column("worst").to_numpy(), found), pa.float64())}

        frame = per_batch(frame, f"doc {kind}, text string, worst double", worst)
        frame = written(frame, "toxicity") if shard + 1 < shards else frame
    return frame.select("doc.*", "text", F.col("worst").alias(column))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc (a struct of the document's columns but text), n, score, threshold, perplexity, toxicity, kept. ``docs`` needs doc_id,
    text and lang; ``labels`` doc_id, quality and toxic."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.coalesce(F.min(F.when(F.col("quality").isNotNull(), ~bad)), F.lit(False)).alias("trusted"), F.coalesce(F.max(F.col("quality") == 0), F.lit(False)).alias("distrusted"),
        F.max(F.col("toxic") == 1).alias("toxic"))
    marks = written(marks, "marks").withColumnRenamed("doc_id", "__id")
    if marks.count() <= BROADCAST_LABELS:
        marks = F.broadcast(marks)
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    texts = docs.select("doc_id", "text").join(marks.where("trusted"), F.col("doc_id") == F.col("__id"), "left_semi")
    model = train(texts.where(~held_out))
    flagged = docs.select("doc_id", "text").join(marks.where("toxic is not null"), F.col("doc_id") == F.col("__id"))
    words = toxic_words(flagged.where(~held_out).select("text", "toxic"))
    scores = surprise(with_toxicity(docs, words, "__toxicity"), model).withColumnRenamed("doc", "d")
    scored = written(scores.join(marks, F.col("d.doc_id") == F.col("__id"), "left").select(
        F.col("d").dropFields("__toxicity").alias("d"), F.col("d.__toxicity").alias("toxicity"), "toxic", F.col("d.lang").cast("string").alias("lang"), "n", "surprise", F.coalesce("trusted", F.lit(False)).alias("trusted"),
        F.coalesce("distrusted", F.lit(False)).alias("distrusted"), (F.pmod(F.xxhash64("d.doc_id"), F.lit(5)) == 0).alias("held_out")), "scored")
    limits = _thresholds(scored)
    own = limits.where(~F.col("overall") & (F.col("trusted_docs") >= FEWEST)).select(F.col("lang").alias("of"), F.col("median").alias("m"), F.col("threshold").alias("t"))
    tail = lambda flag, q: F.percentile_approx(F.when(flag, F.col("toxicity")), q, 10_000)
    bounds = scored.where("n > 0 and held_out and toxic is not null").agg(tail(~F.col("toxic"), HIGH).alias("high"), tail(F.col("toxic"), LOW).alias("low"))
    most = bounds.select(_limit(F.col("high"), F.col("low"))).first()[0]
    overall = limits.where("overall").select(F.col("median").alias("m0"), F.col("threshold").alias("t0"))
    every = overall.first()  # one row at most
    m0, t0 = (every.m0, every.t0) if every else (None, None)
    own = own.unionByName(_unlearned(scored, own, t0 - m0 if every else None))
    joined = scored.join(own, F.col("lang").eqNullSafe(F.col("of")), "left")
    median, threshold = F.coalesce("m", F.lit(m0).cast("double")), F.col("t")
    score = (F.col("surprise") + PRIOR * median) / (F.col("n") + PRIOR)
    out = joined.select(F.col("d").alias("doc"), "n", score.alias("score"), threshold.alias("threshold"), F.exp(F.col("surprise") / F.greatest("n", F.lit(1))).alias("perplexity"), "toxicity")
    fluent = F.coalesce(F.col("score") <= F.col("threshold"), F.lit(True))
    return out.withColumn("kept", fluent & F.coalesce(F.col("toxicity") <= F.lit(most).cast("double"), F.lit(True)))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier keeps, unchanged with all their columns."""
    at, text = "__all", "text"
    carried = docs.select("doc_id", text, "lang", F.struct(*docs.columns).alias(at))
    return judged(carried, labels).where("kept").select(f"doc.{at}.*")
