"""Delimited-text output."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Tab-separated text with a header, one file per task; an existing path is an error by default."""
    df.write.csv(path, sep="\t", header=True, mode=mode)
