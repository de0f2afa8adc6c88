"""The registered queries: each applies its operator, with production parameters, to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (conversation_repair, decontaminate, exact_dedup, langid, packing, pii, prefix_trie, recurrent_lm,
               sentence_spans, simhash, suffix_dedup, token_binary, token_counts)
from .tokens import public_path

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *(count(k) for k in pii.BASE), F.sha2(pii.joined_spans(base), 256).alias("base_sha256"),
        pii.joined_spans(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: F.format_number(s["score"], 2)), ",").alias("scores"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), public_path(WORD_BPE))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.detect_languages(read(spark, sf_dir, "documents"))
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def _span_rows(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_sentences", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"),
        F.sha2("removed_text", 256).alias("removed_sha256"))


def op6_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_rows(sentence_spans.remove_repeated_spans(read(spark, sf_dir, "documents")))


def op6_content_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_rows(sentence_spans.remove_repeated_spans(
        read(spark, sf_dir, "documents"), cut=sentence_spans.content_sentences))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    histogram = token_counts.length_histogram(read(spark, sf_dir, "documents"), public_path(BYTE_BPE))
    return token_counts.suffix_sums(histogram)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_binary.token_file_documents(read(spark, sf_dir, "documents"), public_path(BYTE_BPE))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_repair.damaged(read(spark, sf_dir, "conversations"))
    return conversation_repair.repair_summary(turns, present="present")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read(spark, sf_dir, "conversations"))


def op13_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.score_documents(read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_pii, op2_simhash, op3_packing, op4_decontamination, op5_language_id, op6_sentence_spans, op6_content_spans,
    op7_token_counts, op8_exact_dedup, op9_suffix_dedup, op10_token_binary, op11_conversation_repair,
    op12_prefix_trie, op13_recurrent_lm, pipeline)}
