"""Running fingerprints of turn sequences, composed across partitions.

A sequence of turns has an element of a monoid: its number of turns, its bytes, and in each of four lanes
the sum of x * B**place modulo a prime, where x is taken from the turn's reference. Two elements compose
without their texts: numbers and bytes add, and the second sum is moved by B**(turns of the first). So a
conversation's prefixes come from one pass over sorted rows: each task starts its first conversation from
nothing, and what the tasks before hold of that conversation is put in front afterwards. The driver
composes one element for each partition; no task holds a conversation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.folders import kept

PRIME = (1 << 31) - 1
#: One for each lane; their seeds change when two different turns or prefixes look alike.
LANES = 4
_POWERS = 1 << 12
#: Above so many partitions what lies before them is joined without a broadcast.
BROADCAST_PARTITIONS = 1_000_000


def bases(seed: int) -> list[int]:
    rng = np.random.default_rng(seed)
    return [int(b) for b in rng.integers(1 << 16, PRIME - 1, LANES)]


class _Powers:
    """base**n for an array of numbers, modulo the prime."""

    def __init__(self, base: int):
        self.base = base
        table = np.ones(1, np.int64)
        while len(table) < _POWERS:
            table = np.concatenate([table, table * pow(base, len(table), PRIME) % PRIME])
        self.table = table

    def __call__(self, n: np.ndarray) -> np.ndarray:
        whole, rest = np.divmod(n, _POWERS)
        steps, at = np.unique(whole, return_inverse=True)
        giant = np.array([pow(self.base, int(s) * _POWERS, PRIME) for s in steps], np.int64)
        return giant[at] * self.table[rest] % PRIME


def _lanes(one: np.ndarray, two: np.ndarray) -> list[np.ndarray]:
    """Four numbers below the prime from two of 64 bits."""
    out = []
    for x in (one.view(np.uint64), two.view(np.uint64)):
        out += [(x >> np.uint64(33)).astype(np.int64) % PRIME, (x & np.uint64(PRIME)).astype(np.int64) % PRIME]
    return out


def packed(lanes: list) -> tuple:
    """Two numbers from four lanes."""
    return (lanes[0] << 31) | lanes[1], (lanes[2] << 31) | lanes[3]


def unpacked(one: Column, two: Column) -> list[Column]:
    return [x for f in (one, two) for x in (F.shiftright(f, 31), f.bitwiseAND(PRIME))]


def packed_columns(lanes: list[Column]) -> tuple[Column, Column]:
    high = (F.shiftleft(lanes[0], 31), F.shiftleft(lanes[2], 31))
    return high[0].bitwiseOR(lanes[1]), high[1].bitwiseOR(lanes[3])


def _runs(column: pa.Array) -> np.ndarray:
    """Where a value begins that differs from the one before; nulls are equal."""
    code = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))


def _local(rows: DataFrame, seed: int) -> DataFrame:
    """part, lead (of the partition's first conversation), id, place, f1, f2, bytes, d1, d2, size; running
    values count from the conversation's first row in the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = [_Powers(b) for b in bases(seed)]
        part = TaskContext.get().partitionId()
        first = last = None
        started = False
        before = [0] * (2 + LANES)  # turns, bytes and lanes of the conversation that is open
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ids = batch.column(0)
            one, two, size = (batch.column(k).to_numpy() for k in (1, 2, 3))
            edges = _runs(ids)
            opening = ids[0].as_py()
            if not started:
                first, started = opening, True
            elif opening != last:
                before = [0] * (2 + LANES)
            lengths = np.diff(np.r_[edges, n])
            start = np.repeat(edges, lengths)
            open_ = start == 0
            place = np.arange(n) - start + 1 + np.where(open_, before[0], 0)
            sums = [np.cumsum(size.astype(np.int64))]
            sums += [np.cumsum(x * p(place) % PRIME) for x, p in zip(_lanes(one, two), power, strict=True)]
            running = []
            for k, total in enumerate(sums):
                base = np.where(edges > 0, total[np.maximum(edges - 1, 0)], 0)
                own = total - np.repeat(base, lengths) + np.where(open_, before[1 + k], 0)
                running.append(own % PRIME if k else own)
            before = [int(place[-1]), *[int(r[-1]) for r in running]]
            last = ids[n - 1].as_py()
            leads = open_ if opening == first else np.zeros(n, bool)
            f1, f2 = packed(running[1:])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, part, np.int32)),
                    pa.array(leads),
                    ids,
                    *[pa.array(x) for x in (place, f1, f2, running[0])],
                    *batch.columns[1:3],
                    batch.column(3).cast(pa.int64()),
                ],
                ["part", "lead", "id", "place", "f1", "f2", "bytes", "d1", "d2", "size"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "d1", "d2", "size").mapInArrow(
        run,
        f"part int, lead boolean, id {kind}, place bigint, f1 bigint, f2 bigint, bytes bigint, "
        "d1 bigint, d2 bigint, size bigint",
    )


def _split(one: int, two: int) -> list[int]:
    return [x for f in (one, two) for x in (f >> 31, f & PRIME)]


def running(rows: DataFrame, order: list[str], seed: int) -> DataFrame:
    """id, place (from 1), f1, f2, bytes (of the conversation up to the row), d1, d2, size.

    `rows` holds id, d1, d2 (the turn's reference), size (its bytes) and the columns of `order`, by which
    turns follow each other within an id. A null id is an id like others.
    """
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, "id", *order).sortWithinPartitions("id", *order)
    table = kept(_local(ranged, seed))
    end = F.max(F.struct("id", "place", "bytes", "f1", "f2"))
    lead = F.max(F.when(F.col("lead"), F.struct("place", "bytes", "f1", "f2", "id")))
    parts = table.groupBy("part").agg(end.alias("end"), lead.alias("lead")).orderBy("part").collect()
    power = bases(seed)
    carries, open_id, held = [], None, None
    for r in parts:
        if held is None or r["lead"]["id"] != open_id:
            held = (0, 0, [0] * LANES)
        carries.append((r["part"], held[0], held[1], *held[2], *[pow(b, held[0], PRIME) for b in power]))
        own = r["end"] if r["end"]["id"] != r["lead"]["id"] else r["lead"]
        lanes = _split(own["f1"], own["f2"])
        if r["end"]["id"] == r["lead"]["id"]:
            moved = [(a + pow(b, held[0], PRIME) * x) % PRIME for a, b, x in zip(held[2], power, lanes, strict=True)]
            held = (held[0] + own["place"], held[1] + own["bytes"], moved)
        else:
            held = (own["place"], own["bytes"], lanes)
        open_id = r["end"]["id"]
    names = ["turns", "held", *[f"a{k}" for k in range(LANES)], *[f"b{k}" for k in range(LANES)]]
    carry = spark.createDataFrame(carries, "part int, " + ", ".join(f"{c} bigint" for c in names))
    if len(carries) <= BROADCAST_PARTITIONS:
        carry = F.broadcast(carry)
    lanes = unpacked(F.col("f1"), F.col("f2"))
    moved = [
        F.when(F.col("lead"), (F.col(f"a{k}") + F.col(f"b{k}") * x) % PRIME).otherwise(x)
        for k, x in enumerate(lanes)
    ]
    f1, f2 = packed_columns(moved)

    def more(column: str) -> Column:
        return F.when(F.col("lead"), F.col(column)).otherwise(0)

    return table.join(carry, "part").select(
        "id",
        (F.col("place") + more("turns")).alias("place"),
        f1.alias("f1"),
        f2.alias("f2"),
        (F.col("bytes") + more("held")).alias("bytes"),
        "d1",
        "d2",
        "size",
    )
