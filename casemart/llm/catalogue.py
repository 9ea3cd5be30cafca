"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemart.llm import decontamination, filter_audit, jaccard_join, language_id, line_dedup, packing, passage_dedup, pii, prefix_trie, quality, secret_scan, token_counts, warc
from casemart.llm.common import table
from casemart.llm.token_counts import tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_dedup.passages(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))
    return language_id.predict(docs, language_id.fit(docs.filter(~held_out)), held_out)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_links(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.quality(docs, quality.fit_rules(docs, table(spark, sf_dir, "labels")))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


def all_queries() -> dict[str, Query]:
    every = [
        op1_passage_dedup,
        op2_language_id,
        op3_best_fit_packing,
        op4_warc,
        op5_token_counts,
        op6_benchmark_decontamination,
        op7_ngram_jaccard_join,
        op8_quality_rules,
        op9_pii,
        op10_secret_scans,
        op11_prefix_trie,
        op12_filter_audit,
        op13_line_dedup,
    ]
    return {query.__name__: query for query in every}
