"""One thin query per operator: production parameters over the whole intended table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.llm import (bpe, conversation, decontam, fingerprint, licenses, manifest, near_dup,
                        quality, secret_scan, sharding, token_count, toxicity, url_filter)
from tremor.llm.common import table


def _sha(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url by rule, or by its redirect and canonical aliases."""
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak-label quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.fit(docs))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of every document's ids and decoded text."""
    coded = bpe.encode_decode(table(spark, sf_dir, "documents"),
                              public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        _sha(F.array_join(F.col("ids").cast("array<string>"), " "))
                        .alias("ids_sha256"), _sha(F.col("decoded")).alias("decoded_sha256"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that each document's sentences add up to."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("sentences").cast("long").alias("n_sentences"),
                        F.array_join("sentences", ",").alias("sentences"),
                        F.array_join("licenses", ",").alias("licenses"), "unmatched")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        _sha(secret_scan.joined(F.col("spans"), ("assign", "access", "hex"))).alias("base_sha256"),
        secret_scan.joined(F.col("spans")).alias("spans"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram piece count and best score of every document."""
    pieces = token_count.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    return token_count.count_tokens(table(spark, sf_dir, "documents"), pieces)


def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; shard counts differ by one row at most."""
    return sharding.shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and their likeness."""
    made = fingerprint.with_next_edit(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n_chars", _sha(F.col("edited")).alias("edited_sha256"),
        fingerprint.packed(F.col("digits")).alias("fingerprint"),
        fingerprint.packed(F.col("edited_digits")).alias("edited_fingerprint"),
        fingerprint.likeness(F.col("digits"), F.col("edited_digits")).alias("near_edited"),
        fingerprint.likeness(F.col("digits"), F.col("next_digits")).alias("near_next"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document, and whether they make it contaminated."""
    found = decontam.contamination(table(spark, sf_dir, "documents"),
                                   table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.col("items").cast("array<string>"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        _sha(F.array_join(ids, ",")).alias("items_sha256"),
                        decontam.contaminated().alias("contaminated"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every damaged conversation."""
    given = table(spark, sf_dir, "conversations")
    rows = conversation.damage(given)
    return conversation.with_digest(rows, conversation.plan(rows, given))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle leaf, proof and root of every document; some proofs start at a tampered leaf."""
    docs = table(spark, sf_dir, "documents")
    chosen = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    tampered = F.when(chosen, manifest.leaf_hash(n_chars=F.col("n_chars") + 1))
    made = manifest.manifest(docs, tampered)
    start = F.coalesce("changed_leaf", "leaf")
    return made.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.array_join(F.transform("path", lambda p: p["sibling"]), ""), 256).alias("proof_sha256"),
        manifest.fold(start, F.col("path")).alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline's five stages over ``documents``."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_url_filter, op2_quality, op3_bpe, op4_licenses, op5_secrets, op6_token_counts,
    op7_near_dup, op8_sharding, op9_fingerprints, op10_decontamination, op11_conversations,
    op12_manifest, op13_toxicity, pipeline)}
