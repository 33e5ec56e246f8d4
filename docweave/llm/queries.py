"""Queries of the operators over the test tables, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docweave.llm import (
    bitpack, bottom_k, exact_dedup, hard_negatives, mixing, ngram_join, pieces, pitman_yor, quality, repair, secrets_crf,
    suffix_dedup, warc,
)
from docweave.llm.shared import documents


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.digests(documents(spark, folder), pieces.default_model())


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.dedup(documents(spark, folder))


def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets_crf.scan(documents(spark, folder))


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(documents(spark, folder)).drop("mark")


def op5_warc_audit(spark: SparkSession, folder: str) -> DataFrame:
    return warc.audited(spark.read.parquet(f"{folder}/pages.parquet"))


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return bitpack.written_and_read(documents(spark, folder), bitpack.default_vocabulary())


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(documents(spark, folder).select("doc_id", "text", "lang")).drop("lang")


def op8_pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    return pitman_yor.score(documents(spark, folder))


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.groups(documents(spark, folder))


def op10_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.join(documents(spark, folder))


def op11_bottom_k(spark: SparkSession, folder: str) -> DataFrame:
    return bottom_k.near_duplicates(documents(spark, folder))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mine(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op13_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repair(spark.read.parquet(f"{folder}/conversations.parquet"))


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_secret_scan": op3_secret_scan,
    "op4_mixing": op4_mixing,
    "op5_warc_audit": op5_warc_audit,
    "op6_token_files": op6_token_files,
    "op7_quality_rules": op7_quality_rules,
    "op8_pitman_yor": op8_pitman_yor,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_ngram_join": op10_ngram_join,
    "op11_bottom_k": op11_bottom_k,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_repair": op13_repair,
}

SQL = {
    "op2_suffix_dedup": suffix_dedup.SQL,
    "op5_warc_audit": warc.SQL,
    "op9_exact_dedup": exact_dedup.SQL,
    "op10_ngram_join": ngram_join.SQL,
    "op11_bottom_k": bottom_k.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
    "op13_repair": repair.SQL,
}
