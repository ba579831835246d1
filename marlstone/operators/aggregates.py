"""Aggregates that combine before the shuffle, and measures built on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.maths import population_sd
from marlstone.operators.skew import group_members


def combine_by_key(
    df: DataFrame, keys: Sequence[str], states: Mapping[str, Column], finish: Mapping[str, Column]
) -> DataFrame:
    """Aggregate ``states`` per key, then compute ``finish`` from them.

    The states are ordinary aggregate columns, so creating, adding and merging them is Spark's
    partial and final aggregation.
    """
    combined = df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in states.items()])
    return combined.select(*keys, *[column.alias(name) for name, column in finish.items()])


def moments(value: str, on_grid: bool = False) -> dict[str, Column]:
    """Aggregates ``mean`` and ``sd`` (population) of a column.

    The deviation is Spark's own, which is safe for any reals. ``on_grid`` uses plain sums instead, which
    are exact for small whole and half steps and add up to the same in any order.
    """
    x, n = F.col(value).cast("double"), F.count(value).cast("double")
    sd = population_sd(F.sum(x), F.sum(x * x), n) if on_grid else F.stddev_pop(x)
    return {"mean": F.sum(x) / n, "sd": sd}


def mean_and_sd(df: DataFrame, keys: Sequence[str], value: str, on_grid: bool = False) -> DataFrame:
    stats = moments(value, on_grid)
    return df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in stats.items()])


def count_by_value(df: DataFrame, *columns: str) -> DataFrame:
    """How often each combination of ``columns`` (all by default) occurs, as ``n``."""
    return df.groupBy(*(columns or df.columns)).agg(F.count(F.lit(1)).alias("n"))


def reduce_sum(df: DataFrame, value: str, strict: bool = False) -> DataFrame:
    """The total of a column: null for no rows, or an error when ``strict``."""
    total = F.sum(value)
    if strict:
        failure = F.raise_error(F.lit("reduce of an empty collection"))
        total = F.when(F.count(F.lit(1)) == 0, failure.cast("double")).otherwise(total)
    return df.agg(total.alias("total"))


def fold_sum(df: DataFrame, value: str, zero: float) -> DataFrame:
    """``zero`` plus the total of a column; the zero counts once, however the rows are partitioned."""
    return df.agg((F.lit(zero) + F.coalesce(F.sum(value), F.lit(0))).alias("total"))


def dense_counts(
    df: DataFrame, keys: Sequence[str], category: Column, categories: Sequence[str]
) -> DataFrame:
    """One count column per listed category, zero where the key has none of it.

    One conditional sum per category needs neither a key-by-category scaffold nor a second join.
    """
    counts = [
        F.count(F.when(category == F.lit(name), 1)).alias(name) for name in categories
    ]
    return df.groupBy(*keys).agg(*counts)


def count_maps(df: DataFrame, keys: Sequence[str], value: str, max_entries: int = 10_000) -> DataFrame:
    """Value-to-count maps per key, in maps of about ``max_entries`` entries numbered by ``part``."""
    parts = group_members(df, keys, F.col(value), max_entries)
    return parts.select(*keys, "part", F.map_from_entries("members").alias("counts"))


#: A target profile of up to so many categories is looked up within the row; a larger one is joined.
MAX_CATEGORIES = 100_000


def profile_products(
    profiles: DataFrame, target: DataFrame, key: str, category: str, weight: str
) -> DataFrame:
    """``key, dot, shared, length`` of each key's profile beside one target profile, both in long form.

    ``dot`` is the inner product, ``shared`` the number of categories both have, ``length`` the profile's
    own. The target has one row per category (a second one is an error; null categories match nothing).
    As one map it comes to every row, so rows meet only by their key: categories, of which there may be a
    handful, deal nothing out. A target beyond MAX_CATEGORIES is joined, its hot categories split.
    """
    mine = F.col(weight).cast("double")
    known = target.where(F.col(category).isNotNull()).select(category, mine.alias("__target"))
    if known.limit(MAX_CATEGORIES + 1).count() <= MAX_CATEGORIES:
        entries = F.map_from_entries(F.collect_list(F.struct(category, "__target")))
        other = known.agg(entries.alias("weights")).scalar()
        looked_up = F.when(F.col(category).isNotNull(), F.try_element_at(other, F.col(category)))
        joined = profiles.withColumn("__target", looked_up)
    else:
        named = known.select(F.col(category).alias("__category"), "__target")
        joined = profiles.join(named, F.col(category).eqNullSafe(F.col("__category")), "left")
    return joined.groupBy(key).agg(
        F.sum(mine * F.coalesce(F.col("__target"), F.lit(0.0))).alias("dot"),
        F.count("__target").alias("shared"),
        F.sqrt(F.sum(mine * mine)).alias("length"),
    )


def cosine(
    profiles: DataFrame, target: DataFrame, key: str, category: str, weight: str
) -> DataFrame:
    """Cosine between each key's profile and one target profile, both in long form.

    Keys that share no category with the target come out as zero, keys with an all-zero profile as null.
    """
    mine = F.col(weight).cast("double")
    length = target.agg(F.sqrt(F.sum(mine * mine)).alias("length")).scalar()
    products = profile_products(profiles, target, key, category, weight)
    return products.select(key, F.try_divide("dot", length * F.col("length")).alias("sim"))


def mean_squared_error(
    truth: DataFrame, predicted: DataFrame, keys: Sequence[str], value: str, prediction: str
) -> DataFrame:
    """Mean squared difference over the keys both sides have, with the number of pairs."""
    error = F.col(value) - F.col(prediction)
    pairs = truth.join(predicted.select(*keys, prediction), list(keys))
    return pairs.agg(
        F.count(F.lit(1)).alias("n_pairs"), F.avg(error * error).alias("mse")
    )


def arg_min(df: DataFrame, keys: Sequence[str], payload: str, order: Sequence[str]) -> DataFrame:
    """The payload with the least order per key; later entries of ``order`` break ties."""
    usable = df.where(F.col(order[0]).isNotNull() & ~F.isnan(F.col(order[0]).cast("double")))
    return usable.groupBy(*keys).agg(F.min_by(payload, F.struct(*order)).alias(payload))


def hit_fraction(df: DataFrame, x: Column, y: Column) -> DataFrame:
    """Four times the share of points inside the unit circle, an estimate of pi for uniform draws."""
    draws = df.select(x.alias("x"), y.alias("y"))
    hits = draws.select((F.col("x") * F.col("x") + F.col("y") * F.col("y") < 1).alias("hit"))
    return hits.agg(
        F.count(F.lit(1)).alias("n"), (4 * F.avg(F.col("hit").cast("double"))).alias("estimate")
    )
