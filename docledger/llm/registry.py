"""Queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from docledger.llm import bpe, decontaminate, neighbours, passages, pii, simhash, substrings, token_counts, toxicity, warc
from docledger.llm.common import table


def op1_decontaminate(spark, sf_dir):
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_token_counts(spark, sf_dir, tokenizer: str | None = None):
    return token_counts.digest(table(spark, sf_dir, "documents"), tokenizer or public_tokenizers.path("word_bpe_49k.json"))


def op3_pii(spark, sf_dir):
    return pii.digest(table(spark, sf_dir, "documents"))


def op4_simhash(spark, sf_dir):
    return simhash.digest(table(spark, sf_dir, "documents"))


def op5_substrings(spark, sf_dir):
    return substrings.digest(table(spark, sf_dir, "documents"))


def op6_warc(spark, sf_dir):
    return warc.digest(table(spark, sf_dir, "pages"))


def op7_toxicity(spark, sf_dir):
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_bpe(spark, sf_dir, tokenizer: str | None = None):
    rows = bpe.encode(table(spark, sf_dir, "documents"), tokenizer or public_tokenizers.path("word_bpe_49k.json"))
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_passages(spark, sf_dir):
    return passages.digest(table(spark, sf_dir, "documents"))


def op10_neighbours(spark, sf_dir):
    return neighbours.digest(table(spark, sf_dir, "embeddings"))


def queries() -> dict:
    return {"op1_decontaminate": op1_decontaminate, "op2_token_counts": op2_token_counts, "op3_pii": op3_pii, "op4_simhash": op4_simhash, "op5_substrings": op5_substrings, "op6_warc": op6_warc, "op7_toxicity": op7_toxicity, "op8_bpe": op8_bpe, "op9_passages": op9_passages, "op10_neighbours": op10_neighbours, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict:
    return {"op1_decontaminate": decontaminate.ORACLE}
