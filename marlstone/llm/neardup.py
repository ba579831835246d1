"""Near duplicates by word shingles: fast similarity sketching, banding, exact verification.

A document is its set of shingles. A sketch has some hundred numbers: in each round every shingle is
hashed to a bin and a value, a bin keeps the smallest value of the first round that reaches it, and
after as many rounds as bins the remaining ones are filled one by one. Two sketches agree in each
coordinate with the probability of the sets' Jaccard similarity, and what the bins hold is concentrated
as with independent hashing, at the cost of few rounds over a large set.

Bands of coordinates, laid out for the threshold, make buckets. Sets that are equal meet first and count as one. In a bucket
every member is compared with a centre, the one that meets most others; links are confirmed on the full sets and joined to
components. What meets the same centre but lies in different components is then compared too, block
against block, so that what comes out does not depend on the choice of centres. A pair of similarity 0.8 shares no bucket with a
probability of 5e-6.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.components import components
from marlstone.llm.folders import kept

#: A pair at the threshold shares no bucket with this probability at most.
MISSED = 5.3e-6
#: Bands have as many rows as fit so many bands, at most MOST_ROWS.
MOST_BANDS, MOST_ROWS = 60, 6


def layout(threshold: int) -> tuple[int, int]:
    """Bands and rows for a threshold in percent: 40 of 6 at 80, 45 of 4 at 70, 43 of 2 at 50."""
    for rows in range(MOST_ROWS, 0, -1):
        bands = math.ceil(math.log(MISSED) / math.log(1 - min(0.999, threshold / 100) ** rows))
        if bands <= MOST_BANDS:
            return bands, rows
    raise ValueError(f"no layout of bands for a threshold of {threshold}")


#: The most coordinates of a layout.
COORDINATES = MOST_BANDS * MOST_ROWS
#: Members of a group are compared in blocks of about so many shingles.
BLOCK = 1 << 16

_ROUND_BITS = 10
_PIECE = 4 << 20
#: The hashes of so many words are remembered in a task, and of no longer ones.
_REMEMBERED, _LONGEST = 100_000, 64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SEEDS = _mix(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= _LONGEST:
            if len(self) >= _REMEMBERED:
                self.clear()
            self[word] = value
        return value


def shingles(text: bytes, words: int, known: _Hashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; those of the whole sequence if it is shorter."""
    parts, at = [], 0
    while at < len(text):
        end = at + _PIECE
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        found = text[at:end].lower().split()
        parts.append(np.fromiter(map(known.__getitem__, found), np.uint64, len(found)))
        at = end
    h = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    n = len(h)
    if not n:
        return h
    width = min(words, n)
    code = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        code = _mix(code * np.uint64(0x9E3779B97F4A7C15) + h[k : n - width + 1 + k])
    return np.unique(code)


def sketch(items: np.ndarray, t: int) -> np.ndarray:
    """The values of t bins for a set of hashes that is not empty."""
    bins = np.full(t, np.iinfo(np.uint64).max, np.uint64)
    rounds, done = max(1, round(t * (np.log(t) + 3) / len(items))), 0
    while done < t and (bins == np.iinfo(np.uint64).max).any():
        # later rounds cannot change a bin that is filled, so several may run at once
        which = np.arange(done, min(t, done + rounds))
        h = _mix(items[None, :] ^ _SEEDS[which, None])
        value = (which[:, None].astype(np.uint64) << np.uint64(64 - _ROUND_BITS)) | (
            h >> np.uint64(_ROUND_BITS)
        )
        np.minimum.at(bins, (_mix(h) % np.uint64(t)).astype(np.int64).ravel(), value.ravel())
        done += len(which)
    for k in np.flatnonzero(bins == np.iinfo(np.uint64).max):
        bins[k] = (_mix(items ^ _SEEDS[t + k]) >> np.uint64(1)).min() | np.uint64(1 << 63)
    return bins


def band_keys(bins: np.ndarray, bands: int) -> np.ndarray:
    key = np.arange(bands, dtype=np.uint64)
    for column in bins.reshape(bands, -1).T:
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


def sketches(docs: DataFrame, words: int, threshold: int, key_col: str, text_col: str) -> DataFrame:
    """id, n (shingles), same (digest of the set), bands; the last two are null without words."""
    n_bands, n_rows = layout(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            n, same, bands = [], [], []
            for text in batch.column(1).cast(pa.binary()):
                items = shingles(text.as_py() or b"", words, known)
                n.append(len(items))
                bins = sketch(items, n_bands * n_rows) if len(items) else None
                some = bins is not None
                same.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest() if some else None)
                bands.append(band_keys(bins, n_bands) if some else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(same, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["id", "n", "same", "bands"],
            )

    kind = docs.schema[key_col].dataType.simpleString()
    rows = docs.selectExpr(f"`{key_col}` AS id", f"`{text_col}` AS text")
    return rows.mapInArrow(run, f"id {kind}, n bigint, same binary, bands array<bigint>")


def confirmed(
    pairs: DataFrame, docs: DataFrame, words: int, threshold: int, key_col: str, text_col: str
) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= threshold * union."""
    texts = docs.selectExpr(f"`{key_col}` AS id", f"`{text_col}` AS text")
    kind = docs.schema[key_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        last: tuple[bytes | None, np.ndarray | None] = (None, None)
        for batch in batches:
            keep = []
            left, right = (batch.column(k).cast(pa.binary()) for k in (2, 3))
            for x, y in zip(left, right, strict=True):
                x, y = x.as_py() or b"", y.as_py() or b""
                if x != last[0]:
                    last = (x, shingles(x, words, known))
                one, two = last[1], shingles(y, words, known)
                shared = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(shared > 0 and 100 * shared >= threshold * (len(one) + len(two) - shared))
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(keep, pa.bool_())) for c in (batch.column(0), batch.column(1))],
                ["a", "b"],
            )

    right = texts.select(F.col("id").alias("b"), F.col("text").alias("y"))
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("x"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y")
    return both.mapInArrow(run, f"a {kind}, b {kind}")


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    threshold: int = 80,
    key_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """For each document: key, n_shingles, component_id (its component's smallest key), kept.

    `threshold` is a percentage of Jaccard similarity, 50 or more. Words are separated by ASCII blanks
    and A to Z count as a to z. A text that is null or has no words has no shingles, is linked with
    nothing and is kept. Rows that share a key count as one document; a null key is linked with nothing
    and has no component. An empty table gives an empty one.
    """
    if threshold < 50:
        raise ValueError("bands are laid out for thresholds from 50")
    every = kept(sketches(docs, words, threshold, key_col, text_col))
    # copies first: one for each set
    usable = every.filter("same IS NOT NULL AND id IS NOT NULL")
    sets = kept(
        usable.groupBy("same").agg(
            F.min("id").alias("id"),
            F.first("n").alias("n"),
            F.first("bands").alias("bands"),
        )
    )
    buckets = sets.select(F.explode("bands").alias("key"), "id", "n")
    shared = kept(buckets.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1"))
    inside = kept(buckets.join(shared, "key"))
    # the member that meets most others makes the centre of its buckets
    weight = kept(inside.groupBy(F.col("id").alias("id2")).agg(F.sum("m").alias("w")))
    inside = kept(inside.join(weight, F.col("id") == F.col("id2")).select("key", "id", "n", "w"))
    best = F.max(F.struct("w", F.col("id").alias("a"), F.col("n").alias("n2"))).alias("c")
    centres = kept(inside.groupBy("key").agg(best).select("key", "c.a", "c.n2"))
    near = _possible(
        inside.withColumnRenamed("id", "b").join(centres, "key").filter("a <> b"), threshold
    )
    tried = kept(near)
    links = kept(confirmed(tried, docs, words, threshold, key_col, text_col))
    labels = components(links)

    # what meets a centre in a bucket but is not of one component
    groups = inside.join(centres, "key").select("a", "id", "n").distinct()
    groups = groups.join(labels, F.col("id") == F.col("node"), "left")
    groups = kept(groups.select("a", "id", "n", F.coalesce("label", "id").alias("label")))
    blocks = _blocks(groups)
    if not blocks.isEmpty():
        more = _across(blocks, docs, words, threshold, key_col, text_col)
        labels = components(links.union(more))

    named = sets.select("same", "id").join(labels, F.col("id") == F.col("node"), "left")
    named = kept(named.select("same", F.coalesce("label", "id").alias("label")))
    named = named.withColumnRenamed("same", "same2")
    out = every.join(named, (F.col("same") == F.col("same2")) & F.col("id").isNotNull(), "left")
    component = F.coalesce("label", "id")
    return out.select(
        F.col("id").alias(key_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def deduplicated(
    docs: DataFrame,
    words: int = 5,
    threshold: int = 80,
    key_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row of `docs` for each group of near duplicates, that with the lowest key; all columns stay.

    Every row is a document of its own, whatever its key: rows that share a key, or have none, are told
    apart, and equal rows are copies of which one stays. A key that is null comes after the others; on
    equal keys the first row stays. Rows without words are nobody's copies and stay. An empty table gives
    an empty one. The rows are numbered and written once, so that all steps see the same numbers.
    """
    whole = docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row"))
    rows = kept(whole)
    texts = rows.select("row", F.col(f"doc.`{text_col}`").alias("text"))
    found = near_duplicates(texts, words, threshold, "row", "text").select("row", "component_id")
    key = F.col(f"doc.`{key_col}`")
    named = found.join(rows.select("row", key.alias("key")), "row")
    order = F.struct(F.col("key").isNull().alias("none"), "key", "row")
    first = named.groupBy("component_id").agg(F.min(order).alias("first")).select("first.row")
    left = rows.join(first, "row", "left_semi")
    return left.select(*[F.col(f"doc.`{c}`") for c in docs.columns])


def _blocks(groups: DataFrame) -> DataFrame:
    """group, id, label and block of the members of groups that hold several labels.

    A block has about BLOCK shingles, or one member. Members of a label that fills blocks have blocks of
    their own (`own` is the label, elsewhere null), so that most blocks of a large component need not be
    compared with each other.
    """
    sizes = groups.groupBy("a", "label").agg(F.sum("n").alias("size"))
    mixed = sizes.groupBy(F.col("a").alias("a2")).agg(
        F.count("*").alias("labels"),
        F.sum(F.when(F.col("size") < BLOCK, F.col("size"))).alias("rest"),
    )
    mixed = kept(mixed.filter("labels > 1"))
    sizes = kept(sizes.join(mixed, F.col("a") == F.col("a2")).select("a", "label", "size", "rest"))
    sizes = sizes.withColumnsRenamed({"a": "a2", "label": "label2"})
    rows = groups.join(sizes, (F.col("a") == F.col("a2")) & (F.col("label") == F.col("label2")))
    full = F.col("size") >= BLOCK
    parts = F.ceil(F.when(full, F.col("size")).otherwise(F.col("rest")) / BLOCK)
    return kept(
        rows.select(
            F.col("a").alias("group"),
            "id",
            "label",
            F.when(full, F.col("label")).alias("own"),
            F.pmod(F.xxhash64(F.when(full, F.col("id")).otherwise(F.col("label"))), parts).alias("part"),
        )
    )


def _across(
    blocks: DataFrame, docs: DataFrame, words: int, threshold: int, key_col: str, text_col: str
) -> DataFrame:
    """A link (a, b) for every two labels that have one, from comparing blocks of members whole."""
    kind = docs.schema[key_col].dataType.simpleString()

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            items = [shingles(t.as_py() or b"", words, known).tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(items, pa.binary())], ["id2", "items"]
            )

    wanted = blocks.select("id").distinct()
    texts = docs.selectExpr(f"`{key_col}` AS id", f"`{text_col}` AS text").join(wanted, "id")
    sets = texts.select("id", "text").mapInArrow(sets_of, f"id2 {kind}, items binary")
    members = blocks.join(sets, F.col("id") == F.col("id2"))
    packed = kept(
        members.groupBy("group", "own", "part").agg(
            F.collect_list(F.struct("id", "label", "items")).alias("members")
        )
    )
    names = packed.select("group", F.struct("own", "part").alias("block"))
    pairs = names.withColumnRenamed("block", "one").join(
        names.withColumnRenamed("block", "two"), "group"
    )
    differ = ~F.coalesce(F.col("one.own") == F.col("two.own"), F.lit(False))
    pairs = pairs.filter("one <= two").filter(differ)

    def side(name: str) -> DataFrame:
        return packed.select(
            F.col("group").alias(f"{name}_group"),
            F.struct("own", "part").alias(f"{name}_block"),
            F.col("members").alias(f"{name}_members"),
        )

    for name in ("one", "two"):
        same = (F.col("group") == F.col(f"{name}_group")) & F.col(name).eqNullSafe(
            F.col(f"{name}_block")
        )
        pairs = pairs.join(side(name), same)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, two in zip(batch.column(0), batch.column(1), strict=True):
                left, right = one.as_py(), two.as_py()
                found = _links_between(left, right, threshold)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([left[i]["id"] for i, _ in found], batch.column(0).type.value_type[0].type),
                        pa.array([right[k]["id"] for _, k in found], batch.column(0).type.value_type[0].type),
                    ],
                    ["a", "b"],
                )

    return kept(
        pairs.select("one_members", "two_members").mapInArrow(compare, f"a {kind}, b {kind}")
    )


def _links_between(left: list[dict], right: list[dict], threshold: int) -> list[tuple[int, int]]:
    """Places of a linked pair for every two labels, one on each side, that have one."""
    ones = [np.frombuffer(m["items"], np.uint64) for m in left]
    twos = [np.frombuffer(m["items"], np.uint64) for m in right]
    _, code = np.unique(np.concatenate(ones + twos), return_inverse=True)
    sizes = np.array([len(x) for x in twos])
    split = np.cumsum([len(x) for x in ones])
    own, other = np.split(code[: split[-1]], split[:-1]), code[split[-1] :]
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    labels = np.array([m["label"] for m in right])
    mark = np.zeros(int(code.max()) + 1, np.int64)
    found = {}
    for i, mine in enumerate(own):
        mark[mine] = 1
        shared = np.add.reduceat(mark[other], starts)
        mark[mine] = 0
        linked = 100 * shared >= threshold * (len(mine) + sizes - shared)
        for k in np.flatnonzero(linked & (labels != left[i]["label"])):
            found.setdefault((left[i]["label"], right[k]["label"]), (i, int(k)))
    return list(found.values())


def _possible(pairs: DataFrame, threshold: int) -> DataFrame:
    """Distinct pairs that the sets' sizes do not rule out."""
    small, large = F.least("n", "n2"), F.greatest("n", "n2")
    return pairs.filter(100 * small >= threshold * large).select("a", "b").distinct()


def report(docs: DataFrame) -> DataFrame:
    """Components of documents by two-word shingles and a similarity of 0.8, by doc_id."""
    return near_duplicates(docs, words=2, threshold=80)
