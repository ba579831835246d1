"""Pack documents into sequences: concatenate all token ids and cut at fixed lengths.

Pass one tokenizes each partition and keeps, with each document's ids, how many ids of the partition
come before it. Sums over the partitions' totals give every partition its global offset. Pass two then
knows each document's global place and cuts it at the multiples of the sequence length, without any
shuffle; the documents at a cut yield one record on each side of it. All sequences are full but the
last.

A null text counts as empty and is its closing id alone. Repeated rows are packed like any others. An
empty table gives no pieces.
"""

from __future__ import annotations

import re
import sys
import unicodedata
import zlib
from array import array
from codecs import charmap_decode
from collections.abc import Callable, Iterator
from itertools import accumulate
from types import ModuleType

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.folders import kept

VOCABULARY = "word_bpe_49k.json"
LENGTH = 2048
CLOSING_ID = 1
#: So many bytes of words and ids are remembered in a worker, and once more as many; no longer words.
REMEMBERED, LONGEST = 16 << 20, 64
#: What an entry takes besides.
ENTRY = 150
#: How special tokens begin, and marks that end a word for the vocabulary.
SPECIAL, MARKS = b"<|", b".,;:!?&%$#*"
#: Marks behind an ASCII letter or digit, at the end of a word.
BEHIND = re.compile(rb"(?<=[A-Za-z0-9])[" + re.escape(MARKS) + rb"]+(?=[ \t\n\x0b\x0c\r]|\Z)")
#: Bytes of characters below U+0240, among which there are no combining signs.
PLAIN = bytes(range(0xC9))
#: Letters below this have no rules of their own for lower case.
LATIN_END = "\u0250"
#: Byte-level vocabularies write a byte that is no visible Latin-1 character as one from U+0100 on.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LETTERS = "".join(
    chr(b) if b in _VISIBLE else chr(256 + sorted(set(range(256)) - _VISIBLE).index(b)) for b in range(256)
)
#: Rows leave a task in batches of about so many bytes.
EMIT = 4 << 20
#: Above so many partitions their offsets are joined without a broadcast.
BROADCAST_PARTITIONS = 1_000_000


class _Memo(dict):
    """Ids of words; `find` gives those that are not there."""

    find: Callable[[bytes], bytes]

    def __missing__(self, word: bytes) -> bytes:
        return self.find(word)


class WordTokenizer:
    """Ids of texts, by the tokenizer's ids of each word.

    The vocabulary drops white space and case and merges within runs of letters or of marks only. So a
    text's ids are those of the pieces between ASCII blanks, and marks behind a word can be cut off if
    the word, normalised and in lower case, ends with a letter or number. Ids are little-endian numbers of
    16 bits. Words of up to LONGEST bytes are remembered, REMEMBERED bytes of them and as many from
    before; those that were not used meanwhile are forgotten.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.encode, self.model = tokenizer.encode, tokenizer.model
        self.older: dict[bytes, bytes] = {}
        self.recent = self._fresh_memo()

    def _fresh_memo(self) -> dict[bytes, bytes]:
        self.bytes = 0
        memo = _Memo()
        memo.find = self.find
        return memo

    def find(self, word: bytes) -> bytes:
        """The ids of a word that was not used lately, which is remembered from now on."""
        ids = self.older.get(word)
        if ids is None:
            ids = self.compute(word)
        size = len(word)
        if size <= LONGEST:
            self.recent[word] = ids
            self.bytes += ENTRY + size + len(ids)
            if self.bytes > REMEMBERED:
                self.older = self.recent
                self.recent = self._fresh_memo()
        return ids

    def compute(self, word: bytes) -> bytes:
        if word.isascii():
            core = word.lower()
            if core.isalpha():
                return self._run(core)
            core = core.rstrip(MARKS)
            ends = core[-1:].isalnum()
        else:
            # capitals stay: a letter and the sign on it compose differently in lower case
            core = word.rstrip(MARKS)
            text = core.decode("utf-8")
            if core.translate(None, PLAIN):
                text = unicodedata.normalize("NFC", text)
            text = text.lower()
            if len(core) == len(word) and text.isalpha() and max(text) < LATIN_END:
                return self._run(text.encode("utf-8"))
            ends = text[-1:].isalnum()
        if ends and core != word and SPECIAL not in word:
            ids = self.recent[core]
            return ids + self.recent[word[len(core) :]] if len(core) < len(word) else ids
        return array("H", self.encode(word.decode("utf-8"), add_special_tokens=False).ids).tobytes()

    def _run(self, word: bytes) -> bytes:
        """Ids of one run of small letters, as the model itself takes it: a character for each byte."""
        return array("H", [t.id for t in self.model.tokenize(charmap_decode(word, "strict", BYTE_LETTERS)[0])]).tobytes()

    def ids(self, text: bytes) -> bytes:
        if SPECIAL not in text:
            if not text.translate(None, PLAIN):
                # no sign that a small letter could compose with: fewer words to remember
                text = text.decode("utf-8").lower().encode("utf-8")
            text = BEHIND.sub(rb" \g<0>", text)
        return b"".join(map(self.recent.__getitem__, text.split()))


def _tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for all tasks of a Python worker, with the words it remembers."""
    held = sys.modules.setdefault("marlstone_tokenizers", ModuleType("marlstone_tokenizers")).__dict__
    if path not in held:
        held[path] = WordTokenizer(path)
    return held[path]


def _held(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """The rows in lists of about EMIT bytes; a row's last field tells its bytes."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += 100 + row[-1]
        if size >= EMIT:
            yield held
            held, size = [], 0
    if held:
        yield held


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*[row[: len(names)] for row in rows], strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
    )


def tokenized(
    docs: DataFrame, path: str, key_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """key, ids (little-endian, 16 bits each), partition, and the partition's ids before the document.

    Each document's ids end with the closing id. A vocabulary has at most 65,536 ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        partition = TaskContext.get().partitionId()
        closing = np.array([CLOSING_ID], "<u2").tobytes()

        def rows(kind: list) -> Iterator[tuple]:
            before = 0
            for batch in batches:
                kind[:] = [batch.column(0).type]
                texts = batch.column(1).cast(pa.binary())
                for key, text in zip(batch.column(0), texts, strict=True):
                    ids = tokenizer.ids(text.as_py() or b"") + closing
                    yield key.as_py(), ids, partition, before, len(ids)
                    before += len(ids) // 2

        kind = [pa.null()]
        for held in _held(rows(kind)):
            types = [kind[0], pa.binary(), pa.int32(), pa.int64()]
            yield _batch(held, ["key", "ids", "partition", "before"], types)

    kind = docs.schema[key_col].dataType.simpleString()
    rows = docs.selectExpr(f"`{key_col}` AS key", f"`{text_col}` AS text")
    return rows.mapInArrow(run, f"key {kind}, ids binary, partition int, before bigint")


def pack(
    docs: DataFrame,
    length: int = LENGTH,
    path: str | None = None,
    key_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """One row for each piece of a document.

    Its columns are key, start (the document's ids before the piece), length, ids_crc32 (of the ids as
    little-endian 32-bit numbers), doc_tokens, sequence_id, offset (the sequence's ids before the piece)
    and, `with_ids`, ids.
    """
    table = kept(tokenized(docs, path or public_tokenizers.path(VOCABULARY), key_col, text_col))
    size = (F.octet_length("ids") / 2).cast("bigint")
    totals = table.groupBy("partition").agg(F.max(F.col("before") + size).alias("total"))
    rows = sorted((r["partition"], r["total"]) for r in totals.collect())
    bases = [0, *accumulate(total for _, total in rows)]
    offsets = docs.sparkSession.createDataFrame(
        [(p, base) for (p, _), base in zip(rows, bases, strict=False)], "partition int, base bigint"
    )
    if len(rows) <= BROADCAST_PARTITIONS:
        offsets = F.broadcast(offsets)
    placed = table.join(offsets, "partition").select(
        "key", "ids", (F.col("base") + F.col("before")).alias("first")
    )
    kind = docs.schema[key_col].dataType.simpleString()
    schema = (
        f"`{key_col}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, `offset` bigint" + (", ids array<int>" if with_ids else "")
    )
    names = [key_col, *"start length ids_crc32 doc_tokens sequence_id offset".split()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces(kind: list) -> Iterator[tuple]:
            for batch in batches:
                kind[:] = [batch.column(0).type]
                for key, raw, first in zip(*batch.columns, strict=True):
                    ids, first = np.frombuffer(raw.as_py(), "<u2").astype("<u4"), first.as_py()
                    for number in range(first // length, (first + len(ids) - 1) // length + 1):
                        start = max(number * length - first, 0)
                        own = ids[start : (number + 1) * length - first]
                        offset = first + start - number * length
                        crc = zlib.crc32(own.tobytes())
                        row = (key.as_py(), start, len(own), crc, len(ids), number, offset)
                        yield (*row, own.view(np.int32), 4 * len(own)) if with_ids else (*row, 0)

        kind = [pa.null()]
        for held in _held(pieces(kind)):
            types = [kind[0], *[pa.int64()] * 6, *[pa.list_(pa.int32())] * with_ids]
            yield _batch(held, names + ["ids"] * with_ids, types)

    return placed.mapInArrow(cut, schema)


def sequences(pieces: DataFrame, length: int = LENGTH, padding: int = 0) -> DataFrame:
    """Whole sequences from the pieces: sequence_id, ids padded to `length`, n_ids without padding."""
    parts = pieces.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts")
    )
    ids = parts.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))
    n = F.size("ids")
    return ids.select(
        "sequence_id",
        F.concat("ids", F.array_repeat(F.lit(padding), F.lit(length) - n)).alias("ids"),
        n.alias("n_ids"),
    )


def report(docs: DataFrame) -> DataFrame:
    """The pieces of all documents, with checksums in place of ids, by doc_id."""
    return pack(docs.select("doc_id", "text"), with_ids=False)
