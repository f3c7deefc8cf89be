"""The registered queries of this folder: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    conversation_repair, decontamination, fill_in_middle, html_extraction, language_model, ngram_join, packing, quality, sharding, token_counts,
    toxicity, url_filter, warc,
)
from .common import prepare
from .sql import SQL

BYTE_BPE = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = BYTE_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(table(spark, sf_dir, "documents"), ngram_join.Similarity(words=4, percent=85))


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# The rules of the query.
URL_RULES = (
    url_filter.rule("allow", "org/"),
    url_filter.rule("block", "example.org/es/"),
    url_filter.rule("block", "example.org/en/1"),
    url_filter.rule("allow", "com/fr/"),
    url_filter.rule("block", "com/de/"),
)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 24)


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract_pages(table(spark, sf_dir, "pages"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.transform_documents(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_conversations(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_ngram_join": op2_ngram_join,
    "op3_language_model": op3_language_model,
    "op4_decontamination": op4_decontamination,
    "op5_url_filter": op5_url_filter,
    "op6_warc": op6_warc,
    "op9_toxicity": op9_toxicity,
    "op7_quality": op7_quality,
    "op8_token_counts": op8_token_counts,
    "op10_sharding": op10_sharding,
    "op11_html_extraction": op11_html_extraction,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_conversation_repair": op13_conversation_repair,
}
