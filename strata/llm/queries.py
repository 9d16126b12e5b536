"""The driver's queries of the operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, decontaminate, fuzzy, hard_negatives, language_id, minhash_forest, mixing, substring_dedup, suffix_dedup, token_store,
               url_filter, warc, whitening)
from .common import table
from .oracles import SQL as SQL


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op2_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_forest.components(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op6_piecewise_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy.compare_in_order(table(spark, sf_dir, "documents"))


def op7_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(table(spark, sf_dir, "pages"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("string").alias("text"))
    return decontaminate.judge(docs, table(spark, sf_dir, "benchmark")).drop("text", "spans")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_and_read(table(spark, sf_dir, "documents"), added=True)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine_embeddings(table(spark, sf_dir, "embeddings"))


def op12_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_url_filter, op2_minhash_forest, op3_suffix_dedup, op4_substring_dedup, op5_byte_bpe, op6_piecewise_hash,
                            op7_warc_archives, op8_decontaminate, op9_language_id, op10_token_files, op11_hard_negatives, op12_source_mixture, op13_whitening)
}
