"""From raw documents to token ids: rules, toxicity, near copies, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result to the shared scratch folder and reads it back, so a lost executor
costs no more than a stage. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lendsight.llm import bpe, jaccard_join, mixing, quality, toxicity
from lendsight.llm.catalog import MIX, RANKS, ROWS_IN_BATCH
from lendsight.session import materialise


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_IN_BATCH)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule, or come from a host that mostly does, go."""
    _small_batches(spark)
    return quality.quality_documents(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity of 0.7 or more go; labels of documents that are left teach the score."""
    _small_batches(spark)
    return toxicity.clean_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least id."""
    _small_batches(spark)
    return jaccard_join.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with the wanted shares of sources, languages and forms."""
    return mixing.sampled_documents(docs, MIX)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and the digest of what they decode to."""
    _small_batches(spark)
    made = docs.withColumn("_made", bpe.round_trip(F.col("text"), RANKS, public_tokenizers.PATTERN))
    return made.select(
        "doc_id", "lang", "source", (F.octet_length("_made.ids") / 4).cast("long").alias("n_tokens"),
        F.col("_made.ids").alias("ids"), F.sha2(F.col("_made.text").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("jaccard_join", near_copies_stage),
    ("mixing", mixing_stage),
    ("bpe", encoding_stage),
]

#: The votes of nearest examples and the merges of bytes are beyond SQL; the tests hold the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
