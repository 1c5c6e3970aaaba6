"""Registered queries over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkgate.llm import bpe, bytebpe, counts, exact, langid, lemp, licences, near, packing, quality, runs, secrets, warc
from sparkgate.llm.tables import private_folder, table


def op1_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"))


def op4_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licences(table(spark, sf_dir, "documents"), path=licences.document_path())


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def op6_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op7_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"), private_folder(spark, "archives"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scanned(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(table(spark, sf_dir, "documents"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.digests(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lemp.mined(table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_forest": op1_quality_forest,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_near_dedup": op3_near_dedup,
    "op4_licence_scan": op4_licence_scan,
    "op5_language_id": op5_language_id,
    "op6_word_bpe": op6_word_bpe,
    "op7_warc_zstd": op7_warc_zstd,
    "op8_secret_scan": op8_secret_scan,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_token_counts": op10_token_counts,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_periodic_runs": op13_periodic_runs,
}

# The others learn, hash or pack: tests/llm holds them against brute force and held-out rows.
ORACLE_SQL = {
    "op2_exact_dedup": exact.ORACLE_SQL,
    "op4_licence_scan": licences.ORACLE_SQL,
    "op7_warc_zstd": warc.ORACLE_SQL,
    "op8_secret_scan": secrets.ORACLE_SQL,
    "op12_hard_negatives": lemp.ORACLE_SQL,
}
