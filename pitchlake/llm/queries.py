"""The registered queries of the corpus operators: each applies one operator,
with its production parameters, to its whole table."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pitchlake.llm import byte_bpe, chat_format, decontaminate, katz, license_scan, near_dup, quality, spelling, token_counts, toxicity, turn_repair, url_filter, vector_dedup
from pitchlake.llm.common import table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("word_bpe_49k.json")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), Path(PIECES).read_bytes())


def op2_katz_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.scored(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), Path(RANKS).read_bytes(), public_tokenizers.PATTERN)


def op4_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.link(table(spark, sf_dir, "embeddings"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.digests(chat_format.with_tricky(table(spark, sf_dir, "conversations")))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(table(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repaired(table(spark, sf_dir, "conversations"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_katz_score, op3_byte_bpe, op4_vector_dedup, op5_quality, op6_url_filter, op7_license_scan, op8_chat_format, op9_decontaminate,
        op10_near_dup, op11_toxicity, op12_turn_repair, op13_spelling,
    )
}
ORACLE: dict[str, str] = {
    "op4_vector_dedup": vector_dedup.ORACLE,
    "op6_url_filter": url_filter.oracle(),
    "op7_license_scan": license_scan.oracle(),
    "op8_chat_format": chat_format.ORACLE,
}
