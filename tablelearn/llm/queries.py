"""Registered queries of this folder: ``(spark, sf_dir) -> DataFrame`` each,
over whole tables, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablelearn.llm import (
    compression_quality,
    embedding_dedup,
    fill_in_middle,
    html_text,
    jaccard_join,
    line_dedup,
    lz_fingerprint,
    mixing,
    packing,
    quality_rules,
    suffix_dedup,
    token_alignment,
    toxicity,
)
from tablelearn.llm.common import table


def op1_mix_sources(spark, sf_dir):
    return mixing.mix_report(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op2_compression_quality(spark, sf_dir):
    return compression_quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_toxicity(spark, sf_dir):
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_html_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_pack_documents(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_jaccard_join(spark, sf_dir):
    return jaccard_join.similarity_classes(table(spark, sf_dir, "documents"), size=4, num=85, den=100).selectExpr(
        "id as doc_id", "n as n_shingles", "component_id")


def op5_quality_rules(spark, sf_dir):
    return quality_rules.judge_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_line_dedup(spark, sf_dir):
    return line_dedup.dedup_report(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark, sf_dir):
    return suffix_dedup.repeats_report(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark, sf_dir):
    return token_alignment.alignment_report(table(spark, sf_dir, "documents"))


def op12_lz_fingerprint(spark, sf_dir):
    return lz_fingerprint.compare_with_next(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark, sf_dir):
    made = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_mix_sources, op2_compression_quality, op3_html_text, op4_jaccard_join, op5_quality_rules, op6_toxicity,
    op7_pack_documents, op8_embedding_dedup, op9_suffix_dedup, op10_line_dedup, op11_token_alignment,
    op12_lz_fingerprint, op13_fill_in_middle)}
