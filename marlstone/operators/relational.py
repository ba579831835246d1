"""Filters, look-ups, set work and order that need more than one DataFrame call."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.operators.skew import skewed_lookup, with_group_stats


def explode_words(df: DataFrame, text: Column, split) -> DataFrame:
    """One row per part of ``text``, in a column ``word``."""
    return df.select(F.explode(split(text)).alias("word"))


def at_least_group_mean(
    df: DataFrame, keys: Sequence[str], value: str, mean: str | None = None
) -> DataFrame:
    """Rows whose value is at least the mean of their own key; ``mean`` names a column to keep it in."""
    name = mean or "__mean"
    stats = with_group_stats(df, keys, {name: F.avg(value)})
    kept = [*df.columns, name] if mean else df.columns
    return stats.where(F.col(value) >= F.col(name)).select(*kept)


def lookup(
    df: DataFrame, table: DataFrame, on: Sequence[str], value: str, strict: bool = False
) -> DataFrame:
    """Add ``value`` from ``table``, which has one row per key.

    Rows without a partner drop out, or stop the query when ``strict``. No broadcast is asked for:
    Spark broadcasts the table when its size permits, and splits skewed partitions when not, also where
    the table is an aggregate on the same key.
    """
    table = table.select(*on, value).dropna(subset=list(on))
    rest = [c for c in df.columns if c not in on]
    if not strict:
        return skewed_lookup(df, table, on).select(*on, *rest, value)
    names = [f"__on_{i}" for i in range(len(on))]
    found = table.select(*[F.col(k).alias(n) for k, n in zip(on, names)], value).withColumn("__found", F.lit(True))
    missing = F.raise_error(F.concat_ws(" ", F.lit(f"no {value} for"), *[F.col(k).cast("string") for k in on]))
    checked = F.when(F.col("__found").isNull(), missing.cast(table.schema[value].dataType))
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(on, names)]
    return df.join(found, same, "left").select(*df.columns, checked.otherwise(F.col(value)).alias(value))


def not_in(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``."""
    return df.join(other.select(*on), list(on), "left_anti")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given ascending order, combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__first"))
    return first.select(*[F.col(c) if c in keys else F.col(f"__first.{c}") for c in df.columns])
