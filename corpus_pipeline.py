"""A cleaning pipeline over documents: five stages, each an operator of docledger.llm over all that its predecessor kept.

Stages 1 to 4 return the columns of documents, the last one adds tokens:

1. toxicity       documents that the compression-distance classifier rejects go
2. near_duplicates  of documents that a Jaccard similarity of 0.8 or more links (5-word shingles) the one with the smallest id stays
3. decontaminate  documents that hold eight words in a row of a benchmark item, or two whole items that are shorter, go
4. pii            personal data is replaced by its kind, n_chars follows
5. bpe            n_tokens, the ids and the text that they decode to
"""

from __future__ import annotations

import uuid

import public_tokenizers
from docledger.lineage import shared_dir
from docledger.llm import bpe, decontaminate, pii, similar, toxicity
from docledger.llm.common import table
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_ordinary(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return similar.keep_one(docs)


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"), alone=True)


def stage_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def stage_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", stage_toxicity), ("near_duplicates", stage_near_duplicates), ("decontaminate", stage_decontaminate), ("pii", stage_pii), ("bpe", stage_bpe)]

#: SQL can express neither the classifier nor the tokenizer; the stages are tested against plain versions of themselves.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES applied to documents, each result written to the shared folder and read again; then the digests of the last."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
