"""The registered query of each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marlstone.llm import (
    chat,
    decontamination,
    language,
    neardup,
    packing,
    pii,
    quality,
    runs,
    secret_scan,
    sharding,
    sql,
    substrings,
    trie,
    urls,
)

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(_documents(spark, folder))


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.report(_documents(spark, folder))


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.report(_documents(spark, folder))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.report(_documents(spark, folder))


def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.report(_documents(spark, folder))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.report(_documents(spark, folder))


def op7_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.report(_documents(spark, folder))


def op8_urls(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(spark.read.parquet(f"{folder}/pages.parquet"))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    return decontamination.report(_documents(spark, folder), items)


def op10_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.report(_documents(spark, folder))


def op11_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.report(_documents(spark, folder))


def _conversations(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/conversations.parquet")


def op12_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.report(_conversations(spark, folder))


def op13_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.report(_conversations(spark, folder))


QUERIES: dict[str, Query] = {
    "op1_pii": op1_pii,
    "op2_language": op2_language,
    "op3_sharding": op3_sharding,
    "op4_quality": op4_quality,
    "op5_secrets": op5_secrets,
    "op6_packing": op6_packing,
    "op7_substrings": op7_substrings,
    "op8_urls": op8_urls,
    "op9_decontamination": op9_decontamination,
    "op10_neardup": op10_neardup,
    "op11_runs": op11_runs,
    "op12_trie": op12_trie,
    "op13_chat": op13_chat,
}

SQL: dict[str, str] = {
    "op4_quality": sql.QUALITY,
    "op8_urls": sql.URLS,
    "op10_neardup": sql.NEAR_DUPLICATES,
    "op12_trie": sql.TRIE,
    "op13_chat": sql.CHAT,
}
