"""The trie of conversation prefixes, without building the conversations.

A rebuilt conversation is the head of a base conversation and the rest of its own. Its prefixes are
never written out: the fingerprint of each is composed of the base's head product and its own suffix
product (see `prefixes`). Members of a node have one fingerprint; that their prefixes are equal follows
from the references of their last turns, which must be equal too, from the root down. A reference stands
for one stored turn, which is checked against the turns themselves. Should a check fail, everything is
computed again with other seeds, so that results do not hang on chance.

Subtree totals need no walk over levels. A conversation owns the nodes of which it is the smallest
member: those of its path from one depth on. What a subtree saves is, summed over the members of its top,
the bytes of each from there to the first node it owns; its leaves are the members that own one. So two
aggregates over (conversation, depth) rows give all of them, however deep or wide the trie is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.folders import kept
from marlstone.llm.prefixes import PRIME, bases, packed_columns, running, unpacked
from marlstone.operators.skew import skewed_lookup

#: Conversations are rebuilt on every fifth one, with up to eight of its turns.
GROUP, HEADS = 5, 9
#: Ids of conversations that end at a node are written together in lists of so many.
IDS = 4096
ATTEMPTS = 5

NODE = ["depth", "f1", "f2"]


def base_of(c: Column) -> Column:
    return c - F.pmod(c, F.lit(GROUP))


def head_of(c: Column) -> Column:
    return (F.crc32(c.cast("string")) % HEADS).cast("int")


class _Alike(Exception):
    """Two different turns or prefixes look alike under the seeds."""


def stored_turns(conversations: DataFrame, seed: int) -> DataFrame:
    """id, turn, role, text, d1 and d2 (the turn's reference), size (bytes of the text)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    return conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("id"),
        "turn",
        role.alias("role"),
        text.alias("text"),
        F.xxhash64(F.lit(2 * seed), role, text).alias("d1"),
        F.xxhash64(F.lit(2 * seed + 1), text, role).alias("d2"),
        F.octet_length(text).alias("size"),
    )


def _rebuilt(
    places: DataFrame, seed: int, base: Callable[[Column], Column], head: Callable[[Column], Column]
) -> tuple[DataFrame, DataFrame]:
    """Conversations (id, length, bytes) and their prefixes: id, length, depth, f1, f2, bytes, d1, d2,
    size, bytes up to the prefix's end; depth 0 is the root."""
    top = HEADS - 1
    mark = F.struct("place", "f1", "f2", "bytes", "d1", "d2", "size")
    convs = places.groupBy("id").agg(
        F.max("place").alias("n"),
        F.max("bytes").alias("total"),
        F.array_sort(F.collect_list(F.when(F.col("place") <= top, mark))).alias("marks"),
    )
    convs = kept(convs.select("*", base(F.col("id")).alias("base"), head(F.col("id")).alias("h")))
    stems = convs.select(F.col("id").alias("base"), F.col("marks").alias("stem"))
    joined = convs.join(stems, "base", "left")
    k = F.least(F.col("h"), F.when(F.col("stem").isNull(), 0).otherwise(F.size("stem")))
    rest = F.greatest(F.col("n") - F.col("h"), F.lit(0))
    none = F.lit(0).cast("bigint")

    def at(marks: str, place: str, field: str) -> Column:
        return F.coalesce(F.get(F.col(marks), F.col(place) - 1)[field], none)

    joined = joined.withColumns({"k": k, "length": k + rest})
    joined = joined.select(
        "id",
        "h",
        "k",
        "length",
        F.slice("stem", F.lit(1), F.col("k")).alias("stem"),
        *[at("stem", "k", c).alias(f"base_{c}") for c in ("f1", "f2", "bytes")],
        *[at("marks", "h", c).alias(f"own_{c}") for c in ("f1", "f2", "bytes")],
        F.when(F.col("n") > F.col("h"), at("stem", "k", "bytes") + F.col("total") - at("marks", "h", "bytes"))
        .otherwise(at("stem", "k", "bytes"))
        .alias("total"),
    )
    joined = kept(joined)
    heads = joined.select("id", "length", F.explode("stem").alias("m")).select(
        "id", "length", F.col("m.place").alias("depth"), *[F.col(f"m.{c}") for c in ("f1", "f2", "bytes", "d1", "d2", "size")]
    )
    # own suffix: (prefix - prefix at h), moved from place h to place k and put behind the base's head
    tails = places.join(joined.drop("stem", "total"), "id").filter("place > h")
    lanes = []
    all_lanes = (unpacked(F.col(f"{x}f1"), F.col(f"{x}f2")) for x in ("", "own_", "base_"))
    for b, x, own, stem in zip(bases(seed), *all_lanes, strict=True):
        back = F.array(*[F.lit(pow(b, -j, PRIME)).cast("bigint") for j in range(HEADS)])
        moved = F.get(back, F.col("h") - F.col("k")) * ((x - own + PRIME) % PRIME)
        lanes.append((stem + moved) % PRIME)
    f1, f2 = packed_columns(lanes)
    tails = tails.select(
        "id",
        "length",
        (F.col("place") - F.col("h") + F.col("k")).alias("depth"),
        f1.alias("f1"),
        f2.alias("f2"),
        (F.col("base_bytes") + F.col("bytes") - F.col("own_bytes")).alias("bytes"),
        "d1",
        "d2",
        "size",
    )
    zeros = [none.alias(c) for c in ("depth", "f1", "f2", "bytes", "d1", "d2", "size")]
    roots = joined.select("id", "length", *zeros)
    return joined.select("id", "length", "total"), kept(heads.union(tails).union(roots))


def _nodes(members: DataFrame) -> DataFrame:
    """depth, f1, f2, owner (smallest member), n_convs, deepest, bytes, size of each node."""

    def span(c: str) -> list[Column]:
        return [F.min(c).alias(f"least_{c}"), F.max(c).alias(f"most_{c}")]

    nodes = members.groupBy(*NODE).agg(
        F.min("id").alias("owner"),
        F.count("*").alias("n_convs"),
        F.max("length").alias("deepest"),
        F.min("bytes").alias("bytes"),
        F.min("size").alias("size"),
        *span("d1"),
        *span("d2"),
    )
    nodes = kept(nodes)
    if not nodes.filter("least_d1 <> most_d1 OR least_d2 <> most_d2").isEmpty():
        raise _Alike
    return nodes.drop("least_d1", "most_d1", "least_d2", "most_d2")


def _trie(conversations: DataFrame, seed: int, base, head) -> tuple[DataFrame, DataFrame]:
    turns = stored_turns(conversations, seed)
    texts = turns.select("d1", "d2", "role", "text").distinct().groupBy("d1", "d2").count()
    if not texts.filter("count > 1").isEmpty():
        raise _Alike
    places = running(turns.drop("role", "text"), ["turn", "d1", "d2"], seed)
    convs, members = _rebuilt(places, seed, base, head)
    nodes = _nodes(members)

    # a conversation owns its path from depth `since` on; `before` are the bytes down to there
    since = F.min(F.struct("depth", (F.col("bytes") - F.col("size")).alias("before"))).alias("since")
    leaf = F.max((F.col("depth") == F.col("deepest")).cast("int")).alias("leaf")
    owned = nodes.groupBy(F.col("owner").alias("id")).agg(since, leaf)
    facts = kept(
        convs.join(owned, "id", "left").select(
            "id",
            F.coalesce("since.depth", F.col("length") + 1).alias("since"),
            F.coalesce("since.before", "total").alias("before"),
            F.coalesce("leaf", F.lit(0)).alias("leaf"),
        )
    )
    shared = members.join(facts, "id").filter("depth < since").select(
        *NODE,
        "id",
        (F.col("before") - F.col("bytes") + F.col("size")).alias("saved"),
        "leaf",
        ((F.col("depth") == F.col("since") - 1) & (F.col("since") <= F.col("length"))).alias("branch"),
    )
    shared = kept(shared)
    sums = shared.groupBy(*NODE).agg(
        F.sum("saved").alias("saved"),
        F.sum("leaf").alias("leaves"),
        F.count_if("branch").alias("branches"),
    )
    nodes = kept(nodes.join(sums, NODE, "left"))
    parents = shared.filter("branch").select(*NODE, F.col("id").alias("child")).join(
        nodes.select(*NODE, F.col("owner").alias("parent")), NODE
    )
    facts = facts.select(F.col("id").alias("owner"), "since", "leaf").join(
        convs.select(F.col("id").alias("owner"), "length"), "owner"
    )
    facts = facts.join(parents.select(F.col("child").alias("owner"), "parent"), "owner", "left")
    zero = F.lit(0).cast("bigint")
    # one conversation may own a large share of the nodes
    whole = skewed_lookup(nodes, facts, ["owner"]).select(
        *NODE,
        F.col("owner").alias("conv_id"),
        F.when(F.col("depth") == 0, None)
        .when(F.col("depth") == F.col("since"), F.col("parent"))
        .otherwise(F.col("owner"))
        .alias("parent_conv_id"),
        "n_convs",
        ((F.col("length") > F.col("depth")).cast("bigint") + F.coalesce("branches", zero)).alias("n_children"),
        (F.col("leaf") + F.coalesce("leaves", zero)).alias("n_leaves"),
        F.coalesce("saved", zero).alias("saved_tokens"),
    )
    return whole, members.filter("depth = length").select(*NODE, "id")


def prefix_trie(
    conversations: DataFrame,
    base: Callable[[Column], Column] = base_of,
    head: Callable[[Column], Column] = head_of,
) -> tuple[DataFrame, DataFrame]:
    """The nodes of the trie of rebuilt conversations, and which conversations end at each.

    Conversation c becomes the first head(c) turns of conversation base(c) (at most HEADS - 1) and its own
    turns behind its first head(c). A node is a distinct sequence of the first turns (role and text) of
    some; the first table has depth, f1, f2 (its fingerprint), conv_id (the smallest member),
    parent_conv_id (null at the root), n_convs, n_children, n_leaves (of the subtree) and saved_tokens
    (bytes of repeated turns in the subtree). The second has depth, f1, f2 and id.

    Turns follow each other by `turn`, null first; equal ones by reference, so that the result does not
    hang on the order of rows; repeated rows are turns like others. A null role or text is empty. Rows
    without a conv_id belong to no conversation and are left out. An empty table gives no nodes. Other
    columns are not looked at. Texts may have any length: they are hashed, and compared once per
    reference. No task holds a conversation or a node's members, however large.
    """
    for attempt in range(ATTEMPTS):
        try:
            return _trie(conversations, 1 + attempt, base, head)
        except _Alike:
            continue
    raise RuntimeError(f"different turns look alike under each of {ATTEMPTS} seeds")


def _lists(rows: DataFrame) -> DataFrame:
    """depth, f1, f2, first and ids (sorted, comma-joined), from sorted rows: IDS at most in a list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []
        for batch in batches:
            out = []
            for *key, c in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if ids and (key != node or len(ids) == IDS):
                    out.append((*node, ids[0], ",".join(map(str, ids))))
                    ids = []
                node = key
                ids.append(c)
            yield _rows(out, 4)
        if ids:
            yield _rows([(*node, ids[0], ",".join(map(str, ids)))], 4)

    return rows.mapInArrow(run, "depth bigint, f1 bigint, f2 bigint, first bigint, ids string")


def _rows(rows: list[tuple], numbers: int) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * (numbers + 1)
    names = [*NODE, "first"][:numbers] + ["ids"]
    types = [*[pa.int64()] * numbers, pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def digests(ends: DataFrame) -> DataFrame:
    """depth, f1, f2 and ids (the digest of all ids, ascending and comma-joined) of nodes with ends.

    Lists are made in tasks that share a node's ids by ranges; the digest of a node reads them one after
    the other and holds one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            out = []
            for *key, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 4)), strict=True):
                if key != node:
                    if node:
                        out.append((*node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _rows(out, 3)
        if node:
            yield _rows([(*node, digest.hexdigest())], 3)

    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ends.select(*NODE, "id").repartitionByRange(n, *NODE, "id").sortWithinPartitions(*NODE, "id")
    lists = _lists(ranged).repartition(n, *NODE).sortWithinPartitions(*NODE, "first")
    return lists.mapInArrow(run, "depth bigint, f1 bigint, f2 bigint, ids string")


def report(conversations: DataFrame) -> DataFrame:
    """The nodes of all conversations, with a digest of the ids that end there."""
    nodes, ends = prefix_trie(conversations)
    whole = nodes.join(digests(ends), NODE, "left")
    return whole.select(
        "conv_id",
        F.col("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ids", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
