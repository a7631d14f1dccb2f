"""Registered queries of these operators over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    decontamination,
    fill_in_middle,
    language_id,
    licenses,
    lm_scoring,
    ngram_join,
    packing,
    page_template,
    pii,
    prefix_trie,
    quality,
    sql,
    suffix_dedup,
    token_counts,
)
from .common import crc_bucket
from .stages import stage_folder, stored
from .tokens import vocabulary

# Of the examples only; a production key comes from a secret store.
EXAMPLE_KEY = b"example key, replace in production"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_pack_documents(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))


def op2_benchmark_matches(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.benchmark_matches(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    )


def op3_token_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents inserted; later copies deleted; symbols taken out of the rest.

    Each batch is committed, the second one twice.
    """
    docs = _table(spark, folder, "documents").select("doc_id", "source", "lang", "text")
    rollup = token_counts.TokenRollup(
        spark,
        f"{stage_folder(spark)}/llm/{uuid.uuid4().hex}-rollup",
        {"words-1": token_counts.word_count, "characters-1": token_counts.character_count},
    )
    rollup.commit(1, docs.withColumn("kind", F.lit("insert")))
    marked = docs.withColumn("digest", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    firsts = marked.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    copies = marked.select("doc_id", "digest").join(firsts.filter("n > 1"), "digest").filter("doc_id > first")
    gone = copies.select(F.lit("delete").alias("kind"), "doc_id", *(F.lit(None).cast("string").alias(c) for c in ("source", "lang", "text")))
    rollup.commit(2, gone)
    rollup.commit(2, gone)
    symbols = "#*$%&|<>"
    kept = docs.filter(F.length("text") != F.length(F.translate("text", symbols, "")))
    kept = kept.join(gone.select("doc_id"), "doc_id", "left_anti")
    revised = kept.withColumn("text", F.translate("text", symbols, ""))
    rollup.commit(3, revised.withColumn("kind", F.lit("revise")))
    return rollup.totals()


def op4_quality_ledger(spark: SparkSession, folder: str) -> DataFrame:
    ledger = quality.apply_policy(quality.rule_ledger(_table(spark, folder, "documents")), 2)
    base = F.col("fail_bits").bitwiseAND(F.lit(quality.BASE).cast("bigint")) != 0
    return ledger.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), "kept", "fail_bits",
    )


def op5_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held_out = crc_bucket(F.col("doc_id"), 10) == 0
    return lm_scoring.scores(docs.withColumn("held_out", held_out), held_out_col="held_out")


def op6_license_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_paragraphs(_table(spark, folder, "documents"))


def op7_similar_components(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_components(_table(spark, folder, "documents"))


def op8_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the bytes left, and these as text: a parted character shows as U+FFFD."""
    found = suffix_dedup.remove_repeats(_table(spark, folder, "documents"), with_text=True)
    text = F.make_valid_utf8(F.col("kept").cast("string"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", text.alias("text"))


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    bucket = crc_bucket(F.col("doc_id"), 4)
    model = language_id.train(docs.filter(bucket != 2), vocabulary("piece_bpe_32k.model"))
    found = language_id.identify(docs, model)
    return found.select(
        "doc_id", (bucket == 2).alias("held_out"), "lang_pred", "score", "nats_per_letter"
    )


def op10_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.pseudonymize(_table(spark, folder, "documents"), EXAMPLE_KEY)
    return found.select("doc_id", "text", "n_replaced", F.array_distinct("spans.kind").alias("kinds"))


def op11_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return page_template.main_text(_table(spark, folder, "pages"))


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Frames are stored once; outputs are read by their digests only."""
    store = stored(fill_in_middle.write_frames(_table(spark, folder, "documents")), "frames")
    outputs = fill_in_middle.fill_in_middle(fill_in_middle.with_cuts(store))
    return fill_in_middle.output_digests(outputs)


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    own = stored(prefix_trie.turn_sequences(_table(spark, folder, "conversations")), "turns")
    return prefix_trie.prefix_trie(prefix_trie.with_shared_openings(own))


def queries() -> dict:
    listed = [
        op1_pack_documents, op2_benchmark_matches, op3_token_rollup, op4_quality_ledger,
        op5_lm_scores, op6_license_paragraphs,
        op7_similar_components, op8_repeated_bytes, op9_language_id, op10_pseudonyms,
        op11_main_text, op12_fill_in_middle, op13_prefix_trie,
    ]
    return {query.__name__: query for query in listed}


def oracle_sql() -> dict[str, str]:
    return sql.all_queries()
