"""Registered queries of the subpackage: one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playerledger.llm import embedding_dedup, hard_negatives, license_scan, line_dedup, lm_score, minhash_dedup, mixing, packing, quality_classifier, quality_rules, suffix_dedup, token_alignment, token_counts
from playerledger.llm.common import documents, tokenizer_file


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = embedding_dedup.label_components(documents(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "n_links", "component_id", "kept")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "n_lines", "n_failed_lines", "kept")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.draw(documents(spark, sf_dir))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).alias("taken"),
                      F.size("draws").alias("copies"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_boilerplate(documents(spark, sf_dir), host="source")
    return out.select("doc_id", "source", "n_lines", "n_dropped", F.md5("clean_text").alias("clean_md5"))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = minhash_dedup.label(documents(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id",
                      (F.col("id") == F.col("component_id")).alias("kept"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return lm_score.score(docs, *lm_score.train(docs))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licenses(documents(spark, sf_dir))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.without_repeats(documents(spark, sf_dir), with_bytes=False)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_words")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_alignment.alignment(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality_classifier.classify(docs, quality_classifier.train(docs, documents(spark, sf_dir, "labels")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(documents(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


QUERIES = {f.__name__: f for f in (
    op1_embedding_dedup, op2_quality_rules, op3_best_fit_packing, op4_mixing, op5_token_counts, op6_line_dedup, op7_lm_score, op8_license_scan,
    op9_suffix_dedup, op10_minhash_dedup, op11_token_alignment, op12_quality_classifier, op13_hard_negatives)}
