"""Per-key results for keys of any size.

A window over a key sorts that key's rows in one task, and a list per key holds them in one row. Both
fail when one key has a third of all rows, so neither is used; the operators here stand in.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_group_stats(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Every row of ``df`` with its key's aggregates, as ``agg over (partition by keys)`` gives them.

    The aggregates are combined before the shuffle and joined back null-safely. Such a join shuffles
    both of its sides for itself, so adaptive execution can split the rows of a hot key over tasks.
    ``df`` is read twice, once for the aggregates and once for the rows, so it must not draw random
    numbers of its own.
    """
    key_names, same_key = _keys(keys)
    stats = df.groupBy(*[F.col(k).alias(name) for k, name in zip(keys, key_names)]).agg(
        *[agg.alias(name) for name, agg in aggs.items()]
    )
    return df.join(stats, same_key).select(*df.columns, *aggs)


def skewed_lookup(df: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the columns of ``table``, which has one row per key; unmatched rows drop out.

    For tables that are themselves the result of an aggregation or a join on the key. A plain join would
    take their partitioning over, and Spark splits skewed partitions only where both sides come straight
    from a shuffle. The null-safe join gives the table a shuffle of its own; null keys match nothing.
    """
    key_names, same_key = _keys(keys)
    values = [c for c in table.columns if c not in keys]
    renamed = table.select(*[F.col(k).alias(name) for k, name in zip(keys, key_names)], *values)
    return df.dropna(subset=list(keys)).join(renamed, same_key).select(*df.columns, *values)


def _keys(keys: Sequence[str]) -> tuple[list[str], list[Column]]:
    """Names for the key columns of the other side, and the null-safe equalities with them."""
    names = [f"__key_{i}" for i in range(len(keys))]
    return names, [F.col(k).eqNullSafe(F.col(name)) for k, name in zip(keys, names)]


def group_members(
    df: DataFrame,
    keys: Sequence[str],
    member: Column,
    max_members: int = 10_000,
    spread: Column | None = None,
) -> DataFrame:
    """All members of each key, in sorted lists of about ``max_members`` entries.

    Equal members are counted first, so copies cost one entry: ``members`` is an array of
    ``(member, copies)``. A key with more members than fit gets several rows, numbered by ``part``;
    ``spread`` (a whole number made from ``member``, by default its hash) chooses the part.
    """
    counted = df.groupBy(*keys, member.alias("member")).agg(F.count(F.lit(1)).alias("copies"))
    # Counted by way of ``copies``, so that the sizes and the members read one shuffle of ``counted``.
    sized = with_group_stats(counted, keys, {"__members": F.count_if(F.col("copies") > 0)})
    parts = F.ceil(F.col("__members") / max_members)
    part = F.pmod(F.xxhash64("member") if spread is None else spread, parts)
    return sized.groupBy(*keys, part.cast("int").alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("member", "copies"))).alias("members")
    )


def spread_evenly(df: DataFrame, rows_per_part: int = 100_000) -> DataFrame:
    """``df`` in equal parts, whatever its files and keys look like.

    One count and one shuffle, for data that is then kept and passed over many times, as in iterative
    fitting. There are at least as many parts as cores; the parts do not grow with the data.
    """
    wanted = math.ceil(df.count() / rows_per_part)
    return df.repartition(max(wanted, df.sparkSession.sparkContext.defaultParallelism))
