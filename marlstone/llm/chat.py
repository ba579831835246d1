"""Conversations as training text, from a template that is a black box.

A template is a function from a list of turns to text. Nothing is assumed of what it writes: successive
prefixes of the conversation are rendered, and what one output has beyond the output before is the span
of the turn. Where the output before is not what the next begins with, the template rewrites history;
the span tells how many characters went. A turn's own text is located by rendering two probes in its
place, which differ in one character: what is equal before and behind it frames the text.

Every prefix begins with the conversation, however far back a template looks, so a conversation takes time
in proportion to the sum of its prefixes. Turns are sorted by ranges. A task renders the conversations that
it holds whole; of one that reaches over its edge, or is long, it hands on the turns, which are dealt out in
blocks, each with all turns before it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.folders import kept

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

#: Turns of a block of a long conversation; a task that holds so many characters of one hands it on.
BLOCK, HELD = 256, 4 << 20
#: Texts of these roles are under the loss mask.
LOSS = ("assistant",)
#: Two texts that differ in one character, for finding where a template puts them.
PROBES = ("A", "B")
EMIT = 4 << 20

_CONTROL = re.compile(r"[\\<>]")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<turn ((?:[^\\<>]|\\.)*)>\n((?:[^\\<>]|\\.)*)</turn>\n", re.S)


def escape(text: str) -> str:
    """The text with a backslash before each backslash and each character that begins or ends a mark."""
    return _CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def marked(turns: list[Turn]) -> str:
    """<turn role>, the text and </turn>, a line each; what texts and roles hold of such marks is escaped."""
    return "".join([f"<turn {escape(role)}>\n{escape(text)}</turn>\n" for role, text in turns])


def read_back(formatted: str) -> list[Turn]:
    """The turns of a text that `marked` wrote."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


def _common(one: str, two: str) -> int:
    """Length of the longest common prefix."""
    if two.startswith(one):
        return len(one)
    low, high = 0, min(len(one), len(two))
    while low < high:
        middle = (low + high + 1) // 2
        if one[low:middle] == two[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def span(template: Template, prefix: list[Turn], loss: tuple[str, ...], before: str) -> tuple[str, tuple]:
    """The output for a prefix, and what its last turn adds to the output before: piece, rewritten, start, end.

    `rewritten` counts the characters at the end of the output before that the piece replaces. start and
    end frame the turn's own text within the piece if its role is under the loss mask and the template
    writes it in one place, as a function of the text alone; else they are null.
    """
    now = template(prefix)
    shared = _common(before, now)
    start = end = None
    role = prefix[-1][0]
    if role in loss:
        one, two = (template([*prefix[:-1], (role, probe)]) for probe in PROBES)
        head = _common(one, two)
        if len(one) == len(two) > head and one[head + 1 :] == two[head + 1 :]:
            tail = one[head + 1 :]
            fits = len(now) >= head + len(tail) and head >= shared
            if fits and now.startswith(one[:head]) and now.endswith(tail):
                start, end = head - shared, len(now) - len(tail) - shared
    return now, (now[shared:], len(before) - shared, start, end)


def apply(pieces: list[tuple[str, int]]) -> str:
    """The whole text from (piece, rewritten) of all turns in order."""
    out = ""
    for piece, rewritten in pieces:
        out = out[: len(out) - rewritten] + piece
    return out


class Digest:
    """What is read back from the pieces of one conversation, in order."""

    FIELDS = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted = 0

    def add(self, piece: str, rewritten: int, start: int | None, end: int | None) -> None:
        if rewritten:
            raise ValueError("a text that was rewritten cannot be read piece by piece")
        for role, text in read_back(piece):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        self.formatted += len(piece)
        if start is not None:
            own = unescape(piece[start:end])
            self.loss_chars += len(own)
            self.loss.update(own.encode())

    def row(self) -> tuple:
        return (self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted)


_OPEN = "part int, number bigint, role string, text string"
_PIECE = "place bigint, piece string, rewritten bigint, start bigint, end bigint"
_KINDS = {
    "int": pa.int32(),
    "bigint": pa.int64(),
    "string": pa.string(),
}


def _schema(text: str, id_kind: pa.DataType) -> pa.Schema:
    fields = [pa.field("id", id_kind)]
    for part in text.split(", "):
        name, kind = part.split(" ")
        fields.append(pa.field(name, _KINDS[kind]))
    return pa.schema(fields)


def _batches(rows: Iterator[tuple], schema: list) -> Iterator[pa.RecordBatch]:
    """Rows (cells, bytes) as batches of about EMIT bytes; the schema is known with the first row."""
    held: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, schema[0], strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema[0])

    for row, weight in rows:
        held.append(row)
        size += 100 + weight
        if size >= EMIT:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _cells(batches: Iterator[pa.RecordBatch], schema: list, text: str) -> Iterator[tuple]:
    """The rows of the batches in plain Python, a thousand at a time."""
    for batch in batches:
        schema[:] = [_schema(text, batch.column(0).type)]
        for at in range(0, batch.num_rows, 1024):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, 1024).columns), strict=True)


def _pieces(template: Template, turns: list[Turn], loss: tuple[str, ...]) -> Iterator[tuple]:
    before = template([])
    for k in range(len(turns)):
        before, piece = span(template, turns[: k + 1], loss, before)
        yield (k + 1, *piece)


def _whole(template: Template, loss: tuple[str, ...], digest: bool):
    """Pieces or a digest of conversations that lie within a partition; the turns of the others."""
    fields = Digest.FIELDS if digest else _PIECE
    n_fields = fields.count(",") + 1
    n_open = _OPEN.count(",") + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def rows(schema: list) -> Iterator[tuple]:
            def turned(c, number: int, role: str, text: str) -> tuple:
                return (c, *[None] * n_fields, part, number, role, text), len(role) + len(text)

            held: list[Turn] = []
            weight = number = 0
            own, handed, started = None, True, False
            for c, role, text in _cells(batches, schema, f"{fields}, {_OPEN}"):
                if not started or c != own:
                    if started and not handed:
                        yield from settle(own, held)
                    # the first one may have begun in the partition before
                    handed, held, weight, number = not started, [], 0, 0
                    own, started = c, True
                number += 1
                if handed:
                    yield turned(c, number, role, text)
                    continue
                held.append((role, text))
                weight += 16 + len(role) + len(text)
                if weight > HELD:
                    for k, turn in enumerate(held):
                        yield turned(c, k + 1, *turn)
                    handed, held = True, []
            for k, turn in enumerate(held):  # the last one may go on in the next partition
                yield turned(own, k + 1, *turn)

        def settle(c, turns: list[Turn]) -> Iterator[tuple]:
            none = [None] * n_open
            if digest:
                total = Digest()
                for piece in _pieces(template, turns, loss):
                    total.add(*piece[1:])
                yield (c, *total.row(), *none), 200
            else:
                for piece in _pieces(template, turns, loss):
                    yield (c, *piece, *none), len(piece[1])

        schema: list = []
        yield from _batches(rows(schema), schema)

    return run, f"{fields}, {_OPEN}"


def _blocks(template: Template, loss: tuple[str, ...]):
    """Pieces of the turns of blocks, from rows (id, block, place, role, text) that are sorted so.

    A block's rows begin with the conversation and end with the block's own turns.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(schema: list) -> Iterator[tuple]:
            own, prefix, before = None, [], None
            for c, block, place, role, text in _cells(batches, schema, _PIECE):
                if (c, block) != own:
                    own, prefix, before = (c, block), [], None
                prefix.append((role, text))
                if (place - 1) // BLOCK == block:
                    before = template(prefix[:-1]) if before is None else before
                    before, piece = span(template, list(prefix), loss, before)
                    yield (c, place, *piece), len(piece[0])

        schema: list = []
        yield from _batches(rows(schema), schema)

    return run


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest of each id from its pieces in order."""

    def rows(schema: list) -> Iterator[tuple]:
        own, total = None, None
        for c, _, *piece in _cells(batches, schema, Digest.FIELDS):
            if total is None or c != own:
                if total:
                    yield (own, *total.row()), 200
                own, total = c, Digest()
            total.add(*piece)
        if total:
            yield (own, *total.row()), 200

    schema: list = []
    yield from _batches(rows(schema), schema)


def _formatted(conversations: DataFrame, template: Template, loss: tuple[str, ...], digest: bool) -> DataFrame:
    spark = conversations.sparkSession
    kind = conversations.schema["conv_id"].dataType.simpleString()
    role, text = (F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text"))
    rows = conversations.select(F.col("conv_id").alias("id"), "turn", role, text)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["id", "turn", "role", "text"]
    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("id", "role", "text")
    run, fields = _whole(template, loss, digest)
    table = kept(ranged.mapInArrow(run, f"id {kind}, {fields}"))
    names = [f.split(" ")[0] for f in (Digest.FIELDS if digest else _PIECE).split(", ")]
    whole = table.filter("part IS NULL").select("id", *names)

    # turns that were handed on: their places follow from what the partitions before hold of the id
    turns = table.filter("part IS NOT NULL").select("id", "part", "number", "role", "text")
    counts = turns.groupBy("id", "part").agg(F.max("number").alias("here"))
    totals = counts.groupBy(F.col("part")).agg(F.collect_list(F.struct("id", "here")).alias("own")).collect()
    before, rest = {}, []
    for r in sorted(totals, key=lambda r: r["part"]):
        # at most a few: the first and last of the partition, and long ones
        for c, here in ((x["id"], x["here"]) for x in r["own"]):
            if c in before:
                rest.append((r["part"], c, before[c]))
        before = {x["id"]: x["here"] + before.get(x["id"], 0) for x in r["own"]}
    shifts = F.broadcast(spark.createDataFrame(rest, f"part2 int, id2 {kind}, shift bigint"))
    same = (F.col("part") == F.col("part2")) & F.col("id").eqNullSafe(F.col("id2"))
    placed = turns.join(shifts, same, "left").select(
        "id", (F.col("number") + F.coalesce("shift", F.lit(0))).alias("place"), "role", "text"
    )
    block = F.floor((F.col("place") - 1) / BLOCK)
    last = placed.groupBy(F.col("id").alias("id2")).agg(F.max(block).alias("last"))
    placed = placed.join(last, F.col("id").eqNullSafe(F.col("id2")))
    placed = placed.select("id", F.explode(F.sequence(block, "last")).alias("block"), "place", "role", "text")
    dealt = placed.repartition(n, "id", "block").sortWithinPartitions("id", "block", "place")
    pieces = dealt.mapInArrow(_blocks(template, loss), f"id {kind}, {_PIECE}")
    if digest:
        pieces = pieces.repartition(n, "id").sortWithinPartitions("id", "place")
        pieces = pieces.mapInArrow(_digested, f"id {kind}, {Digest.FIELDS}")
    return whole.union(pieces).withColumnRenamed("id", "conv_id")


def format_conversations(
    conversations: DataFrame, template: Template = marked, loss: tuple[str, ...] = LOSS
) -> DataFrame:
    """One row for each turn: conv_id, place (from 1), piece, rewritten, start, end.

    A conversation's text is its pieces in order, each behind what is left of the text before when its
    last `rewritten` characters are gone (none, but for templates that rewrite history). start and end
    frame the turn's text within the piece where it is under the loss mask; they are null for other
    roles and where the template does not simply insert the text.

    Turns follow each other by `turn`, null first, then by role and text; repeated rows are turns like
    others. A null role or text is empty; rows with a null conv_id are one conversation. Other columns are
    not looked at. An empty table gives no rows. Texts may have any length; a task holds one prefix of a
    conversation and the outputs for it. All prefixes are rendered, so the time grows with the square of a
    conversation's turns, and long ones are spread over tasks by blocks of turns.
    """
    return _formatted(conversations, template, loss, digest=False)


def report(conversations: DataFrame) -> DataFrame:
    """What is read back from the text of all conversations and one that looks like a template itself."""
    spark = conversations.sparkSession
    tricky = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame(
        [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id bigint, turn int, role string, text string"
    )
    rows = conversations.select("conv_id", "turn", "role", "text").union(own)
    return _formatted(rows, marked, LOSS, digest=True)
