"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

The rows lie in blocks. How many rows go from each block to each shard is drawn as in a uniform
permutation (multivariate hypergeometric), so that shard sizes are exact. Then each block is permuted
and cut by its row of the matrix, the rows move, and each shard is permuted again.

Built-in functions only; the driver draws the matrix from the block counts, at most MAX_BLOCKS of
them. Every random choice is a hash of the key, so a task that is run again chooses the same.
"""

from __future__ import annotations

import math
import random
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.spans import numbers

BLOCK_ROWS = 50_000
MIN_BLOCKS, MAX_BLOCKS = 64, 4096


def hypergeometric(rng: random.Random, good: int, bad: int, drawn: int) -> int:
    """How many of `drawn` from `good + bad` are good: exact inversion, outward from the mode."""
    low, high = max(0, drawn - bad), min(drawn, good)
    if low == high:
        return low
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (good + bad + 2)))

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    at_mode = math.exp(
        log_choose(good, mode)
        + log_choose(bad, drawn - mode)
        - log_choose(good + bad, drawn)
    )
    u = rng.random() - at_mode
    up = down = mode
    p_up = p_down = at_mode
    while u > 0:
        if up == high and down == low:
            return mode  # what rounding left over
        if up < high:
            p_up *= (good - up) * (drawn - up) / ((up + 1) * (bad - drawn + up + 1))
            up += 1
            u -= p_up
            if u <= 0:
                return up
        if down > low:
            p_down *= down * (bad - drawn + down) / ((good - down + 1) * (drawn - down + 1))
            down -= 1
            u -= p_down
            if u <= 0:
                return down
    return mode


def communication_matrix(blocks: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Rows from each block (row) to each shard (column), with the given sums."""
    rng = random.Random(seed)
    left = list(shards)
    matrix = []
    for rows in blocks:
        row, rest = [], sum(left)
        for k, room in enumerate(left):
            rest -= room
            taken = hypergeometric(rng, room, rest, rows)
            row.append(taken)
            left[k] -= taken
            rows -= taken
        matrix.append(row)
    return matrix


def _hash(seed: int, salt: str, *cols: Column) -> Column:
    return F.xxhash64(F.lit(f"{salt}{seed}"), *cols)


def shard(
    docs: DataFrame,
    shards: int = 16,
    seed: int = 17,
    key_col: str = "doc_id",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add `shard` (from 0) and `slot` (gapless from 0 in its shard), a uniform random order.

    Shards' row counts differ by at most one. Order and blocks depend on the row's hash, so rows that share
    a key, a null key too, are dealt out like others; fully equal rows are interchangeable. Columns of the input named like the results are replaced. An empty table gives an
    empty one.
    """
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    key = F.col(f"`{key_col}`")
    n = docs.select(key).count()
    blocks = max(MIN_BLOCKS, min(MAX_BLOCKS, math.ceil(n / block_rows)))
    others = [F.col(f"`{c}`") for c in docs.columns if c != key_col]
    tied = F.xxhash64(*others) if others else F.lit(0)
    block = F.pmod(_hash(seed, "block", key, tied), F.lit(blocks)).cast("int")
    counts = {
        r["block"]: r["count"] for r in docs.groupBy(block.alias("block")).count().collect()
    }
    sizes = [counts.get(b, 0) for b in range(blocks)]
    matrix = communication_matrix(sizes, [(n + shards - 1 - s) // shards for s in range(shards)], seed)
    # for each block, the rank at which each shard's rows end
    ends = [end for row in matrix for end in accumulate(row)]
    own_ends = F.slice(numbers(ends, "bigint"), F.col("block") * shards + 1, shards)

    local = Window.partitionBy("block").orderBy(_hash(seed, "local", key), key, tied)
    placed = docs.select(*[F.col(f"`{c}`") for c in kept], block.alias("block"), tied.alias("tied"))
    placed = placed.withColumn("rank", F.row_number().over(local)).withColumn("ends", own_ends)
    placed = placed.withColumn(
        "shard", F.size(F.filter("ends", lambda end: end < F.col("rank")))
    ).drop("ends", "rank", "block")

    # within a shard the second permutation is by hash again, in parts that tasks share out
    part = F.pmod(_hash(seed, "part", key, F.col("tied")), F.lit(blocks)).cast("int")
    moved = placed.withColumn("part", part).repartition("shard", "part")
    totals = moved.groupBy("shard", "part").count()
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset")
    )
    within = Window.partitionBy("shard", "part").orderBy(_hash(seed, "final", key), key, "tied")
    ranked = moved.withColumn("__rn", F.row_number().over(within))
    return ranked.join(F.broadcast(offsets), ["shard", "part"]).select(
        *[F.col(f"`{c}`") for c in kept],
        "shard",
        (F.col("offset") + F.col("__rn") - 1).cast("bigint").alias("slot"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = 17) -> None:
    """Write each shard's rows into a folder of its own, with their slots."""
    shard(docs, shards, seed).write.partitionBy("shard").mode("overwrite").parquet(path)


def report(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Size, checksum, shard and slot of each document; the law is that of row counts."""
    text = F.col("text")
    digest = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
    )
    return shard(digest, shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
