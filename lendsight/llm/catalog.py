"""The queries of this subpackage and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lendsight.llm import (
    bpe, ctw, embedding_dedup, html_text, jaccard_join, merkle, mixing, oracles, privacy, quality, sharding, token_files, toxicity, vector_codes,
)
from lendsight.session import materialise

Query = Callable[[SparkSession, str], DataFrame]

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2
MIX = mixing.Targets(
    lang={"en": 0.5, "fr": 0.2, "de": 0.15, "es": 0.1},
    topic={"prose": 0.5, "long": 0.3, "short": 0.08, "table": 0.06, "symbols": 0.04},
)


#: Whole texts are large rows, so an Arrow batch takes fewer of them than Spark's default.
ROWS_IN_BATCH = 1000


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_IN_BATCH)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def near_duplicate_vectors_query(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(_table(spark, folder, "embeddings"))


def token_files_query(spark: SparkSession, folder: str) -> DataFrame:
    files = token_files.write_token_files(_table(spark, folder, "documents"), "doc_id", "text", TOKENIZER, END_ID)
    return token_files.read_token_files(files).withColumnRenamed("key", "doc_id")


def mixed_sources_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "source", "lang", "text")
    docs = docs.withColumn("n_tokens", mixing.token_count(F.col("text")))
    docs = docs.withColumn("topic", mixing.text_form(F.col("text"), F.col("n_tokens"))).drop("text")
    mixed = mixing.mixed_documents(materialise(docs, "attributes"), MIX)
    return mixed.select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "sampled")


def toxicity_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    index = toxicity.fit(docs, _table(spark, folder, "labels"))
    judged = docs.select("doc_id", toxicity.toxicity(F.col("text"), index, spark).alias("judged"))
    return judged.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("judged.score").alias("score"),
        F.when(F.col("judged.score") >= 0.7, 1).otherwise(0).alias("predicted"), F.col("judged.evidence").alias("evidence"),
    )


def context_tree_query(spark: SparkSession, folder: str) -> DataFrame:
    return ctw.score_documents(_table(spark, folder, "documents")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"
    )


def balanced_shards_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    items = docs.select(
        "doc_id", sharding.byte_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = sharding.balanced_shards(items, ["doc_id", "text_crc32", "size"], "size", 8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def main_text_query(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url", html_text.extract_text(F.col("html")).alias("text"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


def bpe_round_trip_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    made = docs.select("doc_id", bpe.round_trip(F.col("text"), RANKS, public_tokenizers.PATTERN).alias("made"))
    return made.select(
        "doc_id", (F.octet_length("made.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("made.ids", 256).alias("ids_sha256"), F.sha2(F.col("made.text").cast("binary"), 256).alias("decoded_sha256"),
    )


def quality_rules_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    measured = materialise(docs.select("doc_id", "source", quality.measures(F.col("text")).alias("m")), "measures")
    verdicts = materialise(quality.host_verdicts(measured, "source", "m"), "verdicts")
    judged = quality.with_verdicts(measured, verdicts, "source", "m", rates=tuple(quality.RULES))
    rates = [F.round(f"rate_{rule}", 9).alias(f"rate_{rule}") for rule in quality.RULES]
    return judged.select("doc_id", "m.*", "base_failed", "kept", *rates)


def jaccard_join_query(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.similar_documents(_table(spark, folder, "documents"))


def private_spans_query(spark: SparkSession, folder: str) -> DataFrame:
    return privacy.found_in_documents(_table(spark, folder, "documents"))


def vector_codes_query(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    books = vector_codes.train(vectors, "vec_id", "embedding")
    coded = materialise(vector_codes.encode(vectors, "embedding", books), "coded")
    return vector_codes.with_label_error(coded, "label").select(
        "vec_id", "code", "error", "label_error", F.lit(vector_codes.books_digest(books)).alias("codebooks_sha256")
    )


def documents_manifest_query(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.documents_manifest(_table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    "op1_near_duplicate_vectors": near_duplicate_vectors_query,
    "op2_token_files": token_files_query,
    "op3_mixed_sources": mixed_sources_query,
    "op4_toxicity": toxicity_query,
    "op5_context_tree": context_tree_query,
    "op6_balanced_shards": balanced_shards_query,
    "op7_main_text": main_text_query,
    "op8_bpe_round_trip": bpe_round_trip_query,
    "op9_quality_rules": quality_rules_query,
    "op10_jaccard_join": jaccard_join_query,
    "op11_private_spans": private_spans_query,
    "op12_vector_codes": vector_codes_query,
    "op13_merkle_manifest": documents_manifest_query,
}

ORACLE_SQL: dict[str, str] = {
    "op3_mixed_sources": oracles.mixing_sql(MIX),
    "op9_quality_rules": oracles.quality_sql(),
    "op11_private_spans": oracles.privacy_sql(privacy.THRESHOLD),
    "op12_vector_codes": oracles.vector_codes_sql(vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS),
    "op13_merkle_manifest": oracles.manifest_sql(merkle.FANOUT, levels=8),
}
