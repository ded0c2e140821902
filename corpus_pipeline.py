"""Corpus pipeline: five stages from raw documents to token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.llm import bpe, decontam, near_dup, quality, secret_scan
from tremor.llm.common import table
from tremor.session import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the weak-label classifier, fitted on them, finds good."""
    return quality.keep_good(docs)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each near-duplicate group; rows that repeat an id and text count once."""
    return near_dup.keep_first(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold too much of a benchmark."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep every document, its secrets masked."""
    return secret_scan.redact_documents(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text that they decode to.

    Of ``doc_id``, ``lang``, ``source`` and ``n_chars`` those that there are go along.
    """
    kept = tuple(c for c in ("doc_id", "lang", "source", "n_chars") if c in docs.columns)
    coded = bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"), keep=kept)
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [("quality", quality_stage), ("near_dup", near_dup_stage),
          ("decontamination", decontamination_stage), ("secrets", secret_stage), ("bpe", bpe_stage)]

#: The classifier, the similarity join and the tokenizer have no SQL equal; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, "corpus_pipeline", name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
