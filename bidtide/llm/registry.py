"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidtide.llm import decontaminate, embeddings, langid, licenses, lines, merkle, neardup, packing, pii, quality, search, sql, tokens, urls


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", decontaminate.n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("word_spans") > 0).alias("contaminated"), "spans")


def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokens.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return tokens.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), size=2)


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.license_labels(table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.concat_ws(",", c) for c in ("base_labels", "labels")})


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    found = quality.judged(docs, table(spark, sf_dir, "labels"))
    return found.select("doc.doc_id", "doc.lang", "n", "perplexity", "score", "threshold", "kept")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.removed_lines(table(spark, sf_dir, "documents")).select("doc_id", F.size("lines").cast("long").alias("n_removed"), F.concat_ws(",", "lines").alias("removed_lines"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged_pages(table(spark, sf_dir, "pages")).drop("trust", "distrust")


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    counts = [F.size(k.name).cast("long").alias(f"n_{k.name}") for k in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(pii.listed(pii.BASE), 256).alias("base_sha256"), pii.listed(pii.BASE + pii.ADDED).alias("spans"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audited(table(spark, sf_dir, "documents"), *merkle.audit_columns()).drop("source")


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.judged(table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_embedding_dedup, op3_url_filter, op4_decontamination, op5_token_ids, op6_near_duplicates, op7_licenses, op8_quality, op9_packing, op10_personal_data, op11_merkle_manifest, op12_language_id, op13_ranked_search)}
ORACLE: dict[str, str] = {"op1_line_dedup": sql.line_dedup(), "op3_url_filter": sql.url_filter(), "op10_personal_data": sql.personal_data(),
    "op11_merkle_manifest": sql.merkle_audit(), "op13_ranked_search": sql.ranked_search()}
