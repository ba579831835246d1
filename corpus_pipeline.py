"""From raw documents to packed training sequences.

Each stage takes the documents that the one before it kept and returns those it keeps, with the columns
of the input; the last returns pieces of packed sequences with their token ids.

Rows are judged one by one. A null or empty text fails the quality rules; where a stage meets one it stays.
Of rows that are equal, or share a text, near_duplicates leaves one; a null doc_id is an id like others. Ties
go to the lowest doc_id. Empty tables give empty ones. Further columns stay as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import decontamination, neardup, packing, quality, secret_scan
from marlstone.llm.folders import emptied, released, shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.cascade(docs).filter("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that with the lowest doc_id, of each group of near duplicates.

    Rows are judged one by one: two texts under one doc_id, or under none, are two documents.
    """
    return neardup.deduplicated(docs, words=5, threshold=80)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.decontaminate(docs, items)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret replaced by its kind and n_chars brought up to date."""
    clean = secret_scan.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    length = F.coalesce(F.char_length("text").cast("bigint"), F.col("n_chars"))
    return clean.withColumn("n_chars", length).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2,048 token ids."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("secrets", secrets),
    ("packing", packed),
]

#: Sketches, models and token ids are not for SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each one's rows written to the shared folder before the next.

    What a stage has read or kept is emptied once its rows are written, so that at any time the folder
    holds the rows of two stages, and the tables of one.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        path = shared_folder(spark)
        with released(spark):
            rows = stage(spark, docs, sf_dir)
            rows.write.parquet(path)
        if before:
            emptied(spark, before)
        docs, before = spark.read.schema(rows.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
