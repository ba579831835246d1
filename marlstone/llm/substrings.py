"""Remove bytes that repeat a string of LENGTH bytes of an earlier document.

Equal strings are found with a collection Burrows-Wheeler transform that grows by columns. A string of
LENGTH bytes is looked up by its anchor, the gram of GRAM bytes with the lowest hash in it, so equal
strings have equal anchors at equal places. Strings that follow each other and share an anchor make one
segment. Then:

1. Every document's anchors are dealt out by their hash; those that only one document has are dropped.
2. The segments of the others are dealt out by the same hash. A part of them is a collection of short
   strings: bytes, with the anchor as one symbol. Round after round one symbol of every segment, from the
   last to the first, is inserted into the collection's transform and its order of suffixes; neighbours
   that have a whole string in common make a class, and the class knows its smallest document.
3. What a smaller document has goes, and each document is put together from what stays.

Parts are sized by the data, so a task's arrays have a bound. Within a batch of documents equal segments
are settled on the spot but for the smallest document's, so that a passage of very many documents sends
one record for each batch.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.folders import freed, kept

LENGTH, GRAM = 50, 20
_WIDTH = LENGTH - GRAM + 1  # grams in a string; symbols in one, with the anchor as one symbol
_HALF = (LENGTH - GRAM) // 2

#: Documents are taken together until they have so many bytes.
BATCH = 16 << 20
#: Bytes of text for each part of the anchors, and bytes of segments for each part of those.
ANCHOR_PART, SEGMENT_PART = 32 << 20, 8 << 20
#: At most so many different anchors meet in one transform, so that symbols fit 16 bits.
_ANCHORS = 60_000

_PIECE = 1 << 19  # strings whose anchors are found at once
_PLACE = np.uint64((1 << 20) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _gram_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each place."""
    n = len(raw) - GRAM + 1
    eight = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
    return _hashed(eight[:n], eight[8 : 8 + n], eight[GRAM - 8 : GRAM - 8 + n])


def _gram_hashes_at(raw: bytes, at: np.ndarray) -> np.ndarray:
    """The same hash from the given places alone."""
    eight = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
    return _hashed(eight[at], eight[at + 8], eight[at + GRAM - 8])


def _hashed(one: np.ndarray, two: np.ndarray, three: np.ndarray) -> np.ndarray:
    x = _mix(one * np.uint64(0x9E3779B97F4A7C15) + two)
    return _mix(x * np.uint64(0xC2B2AE3D27D4EB4F) + three)


def anchors(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """hash, place, first and last start of the strings that an anchor stands for."""
    parts = []
    for at in range(0, len(raw) - LENGTH + 1, _PIECE):
        h = _gram_hashes(raw[at : at + _PIECE + LENGTH - 1])
        low = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        for step in (1, 2, 4, 8):
            low = np.minimum(low[:-step], low[step:])
        rest = _WIDTH - 16
        low = np.minimum(low[:-rest], low[rest:])
        place = (low & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        last = np.r_[first[1:], len(place)] - 1
        own = place[first]
        parts.append((h[own], own + at, first + at, last + at))
    if not parts:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def _part(h: np.ndarray, parts: int) -> np.ndarray:
    return ((h >> np.uint64(1)) % np.uint64(parts)).astype(np.int64)


def _rows_by_part(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(part, kind="stable")
    edges = np.flatnonzero(np.r_[True, np.diff(part[order]) != 0])
    for own in np.split(order, edges[1:]):
        if len(own):
            yield int(part[own[0]]), own


_ANCHOR_FIELDS = ("h", "rid", "place", "before", "after")


def _anchor_rows(docs: DataFrame, parts: int) -> DataFrame:
    """part, and arrays of the anchors of a batch of documents: hash, document, place, extent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def emit() -> pa.RecordBatch:
            h, place, first, last = (np.concatenate([x[k] for x in held]) for k in range(4))
            rid = np.repeat([x[4] for x in held], [len(x[0]) for x in held]).astype(np.int64)
            columns = (
                h,
                rid,
                place.astype(np.uint32),
                (place - first).astype(np.uint8),
                (place - last).astype(np.uint8),
            )
            rows = [
                (part, *[c[own].tobytes() for c in columns])
                for part, own in _rows_by_part(_part(h, parts))
            ]
            types = [pa.int32(), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                ["part", *_ANCHOR_FIELDS],
            )

        for batch in batches:
            for rid, text in zip(batch.column(0), batch.column(1).cast(pa.binary()), strict=True):
                raw = text.as_py()
                if len(raw) < LENGTH:
                    continue
                held.append((*anchors(raw), rid.as_py()))
                size += len(raw)
                if size >= BATCH:
                    yield emit()
                    held, size = [], 0
        if held:
            yield emit()

    return docs.select("rid", "text").mapInArrow(
        run, "part int, " + ", ".join(f"{f} binary" for f in _ANCHOR_FIELDS)
    )


def _joined(table: pa.Table, column: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), kind)


def _spans(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Spans within a segment as one number each."""
    return (start.astype(np.int64) << 16) | (end - start).astype(np.int64)


def _packed(place: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """An anchor's place and extent as one number."""
    return (place.astype(np.int64) << 16) | (before.astype(np.int64) << 8) | after.astype(np.int64)


def _shared(table: pa.Table) -> pa.Table:
    """The anchors of a part that stand in more than one document: document and entry, a row for each."""
    h, rid = _joined(table, "h", "<u8"), _joined(table, "rid", "<i8")
    entry = _packed(*(_joined(table, f, k) for f, k in (("place", "<u4"), ("before", "u1"), ("after", "u1"))))
    order = np.argsort(h)
    h, rid, entry = h[order], rid[order], entry[order]
    edges = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    several = np.minimum.reduceat(rid, edges) != np.maximum.reduceat(rid, edges)
    some = np.repeat(several, np.diff(np.r_[edges, len(h)]))
    rid, entry = rid[some], entry[some]
    order = np.argsort(rid, kind="stable")  # a document's rows together: they are collected next
    return pa.table({"rid": rid[order], "entry": entry[order]})


def _pack(*fields: np.ndarray) -> bytes:
    """Arrays as one compressed record: their lengths in bytes, then their bytes."""
    sizes = np.array([f.nbytes for f in fields], np.int64)
    return zlib.compress(b"".join([sizes.tobytes(), *[f.tobytes() for f in fields]]), 1)


def _unpack(record: bytes, kinds: tuple[str, ...]) -> list[np.ndarray]:
    raw = zlib.decompress(record)
    sizes = np.frombuffer(raw, np.int64, len(kinds))
    ends = (sizes.nbytes + np.cumsum(sizes)).tolist()
    return [np.frombuffer(raw[end - size : end], kind) for kind, end, size in zip(kinds, ends, sizes.tolist())]


#: Of each document hash, key and number of places; of each place its segment and start; of each different
#: segment its length and the bytes before the anchor; the bytes of all segments.
_SEGMENT_KINDS = ("<i8", "<i8", "<u4", "<u4", "<u4", "u1", "u1", "u1")


def _segment_rows(docs: DataFrame, parts: int) -> DataFrame:
    """Segments of the shared anchors: a record for each part and batch, and, as part -1 with rid and
    settled, the spans of a document that are settled within the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        facts: list[np.ndarray] = []
        size = 0

        def emit() -> pa.RecordBatch:
            which, rid, doc, start, left = (np.concatenate([x[k] for x in facts]) for k in range(5))
            contents = list(known)
            lengths = np.array([len(c) for c in contents], np.int64)
            least = np.full(len(contents), np.iinfo(np.int64).max)
            np.minimum.at(least, which, doc)
            again = doc > least[which]
            spans = _spans(start[again], (start + lengths[which])[again])
            owner = rid[again]
            edges = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1], True]) if len(owner) else owner
            rows = [
                (-1, int(owner[a]), spans[a:b], None)
                for a, b in zip(edges[:-1], edges[1:], strict=True)
            ]
            # Equal segments have the same anchor, so each lies in one part: all is put in the order of the
            # parts once, and a record is a slice of it, however many parts there are.
            lefts = np.empty(len(contents), np.uint8)
            lefts[which] = left
            part = _part(_gram_hashes_at(b"".join(contents), np.cumsum(lengths) - lengths + lefts), parts)
            order = np.argsort(part, kind="stable")
            used, first = np.unique(part[order], return_index=True)
            inner = np.empty(len(order), np.int64)
            inner[order] = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
            open_ = np.flatnonzero(~again)
            open_ = open_[np.argsort(part[which[open_]], kind="stable")]
            which, rid, doc, start = which[open_], rid[open_], doc[open_], start[open_]
            place_part = part[which]
            changes = np.flatnonzero(np.r_[True, (place_part[1:] != place_part[:-1]) | (rid[1:] != rid[:-1])])
            places = np.diff(np.r_[changes, len(rid)]).astype(np.uint32)
            inside, start = inner[which].astype(np.uint32), start.astype(np.uint32)
            sizes, lefts = lengths[order].astype(np.uint8), lefts[order]
            segment_at = np.r_[first, len(order)]
            place_at = np.r_[np.searchsorted(place_part, used), len(rid)]
            doc_at = np.searchsorted(changes, place_at)
            rids, docs_ = rid[changes], doc[changes]
            ordered = [contents[k] for k in order.tolist()]
            for k, own in enumerate(used.tolist()):
                s, p, d = (slice(x[k], x[k + 1]) for x in (segment_at, place_at, doc_at))
                text = np.frombuffer(b"".join(ordered[s]), np.uint8)
                packed = _pack(rids[d], docs_[d], places[d], inside[p], start[p], sizes[s], lefts[s], text)
                rows.append((own, None, None, packed))
            types = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                ["part", "own_rid", "settled", "packed"],
            )

        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for rid, doc, text, lists in zip(batch.column(0), batch.column(1), texts, batch.column(3), strict=True):
                raw = text.as_py()
                entry = lists.values.to_numpy()
                place = entry >> 16
                start = place - (entry >> 8 & 255)
                end = place - (entry & 255) + LENGTH
                which = np.fromiter(
                    (
                        known.setdefault(raw[a:b], len(known))
                        for a, b in zip(start.tolist(), end.tolist(), strict=True)
                    ),
                    np.int64,
                    len(start),
                )
                n = len(start)
                facts.append((which, np.full(n, rid.as_py()), np.full(n, doc.as_py()), start, place - start))
                size += int((end - start).sum()) + 40 * n
            if size >= BATCH:
                yield emit()
                known, facts, size = {}, [], 0
        if facts:
            yield emit()

    return docs.mapInArrow(run, "part int, own_rid bigint, settled array<bigint>, packed binary")


_ROW_BITS = 40
_ROWS = (1 << _ROW_BITS) - 1


def suffix_order(strings: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(string, length) of every suffix, sorted, by column-wise insertion.

    strings: a row of symbols (positive numbers of 16 bits) for each string, from its first. `row` is
    each string's place in the transform, where its next symbol goes. Inserting a symbol there tells where
    the longer suffix belongs: behind all suffixes that start with a smaller symbol, and among its own in
    the order of what follows. `key` has both of each row, its first symbol and the row of what follows, and
    so is sorted: a round looks its own symbols up in it and moves the other rows, without sorting them.
    """
    n = len(strings)
    key, row = np.arange(n), np.arange(n)
    for j in range(1, int(sizes.max()) + 1):
        active = np.flatnonzero(sizes >= j)
        symbol = strings[active, sizes[active] - j].astype(np.int64) << _ROW_BITS
        wanted = symbol | row[active]
        order = np.argsort(wanted)
        fresh = np.searchsorted(key, wanted[order]) + np.arange(len(order))
        old = np.ones(len(key) + len(order), bool)
        old[fresh] = False
        moved = np.flatnonzero(old)
        grown = np.empty(len(old), np.int64)
        follows = moved[key & _ROWS]
        key &= ~_ROWS
        key |= follows
        grown[moved] = key
        grown[fresh] = (symbol | moved[row[active]])[order]
        row[active[order]] = fresh
        key = grown
    before = np.full(len(key), -1)
    whole = np.flatnonzero(key >> _ROW_BITS)  # symbols are positive: these are no empty suffixes
    before[key[whole] & _ROWS] = whole
    owner, length = np.empty(len(key), np.int32), np.zeros(len(key), np.uint8)
    at, own = np.flatnonzero(key >> _ROW_BITS == 0), np.arange(n)
    owner[at] = own
    for j in range(1, int(sizes.max()) + 1):
        at = before[at]
        own, at = own[at >= 0], at[at >= 0]
        owner[at], length[at] = own, j
    return owner, length


def _class_minima(strings: np.ndarray, sizes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each string and start, the smallest document of those whose string of _WIDTH symbols equals."""
    owner, length = suffix_order(strings, sizes)
    whole = length >= _WIDTH
    owner, start = owner[whole], sizes[owner[whole]] - length[whole]
    same = np.zeros(max(0, len(owner) - 1), bool)
    flat, at = strings.ravel(), owner.astype(np.int64) * strings.shape[1] + start
    alive = np.arange(len(same))
    for k in range(_WIDTH):
        alive = alive[flat[at[alive] + k] == flat[at[alive + 1] + k]]
    same[alive] = True
    edges = np.flatnonzero(np.r_[True, ~same])
    least = np.minimum.reduceat(docs[owner], edges)
    minima = np.full((len(strings), strings.shape[1] - _WIDTH + 1), np.iinfo(np.int64).max)
    minima[owner, start] = np.repeat(least, np.diff(np.r_[edges, len(owner)]))
    return minima


def _comparable(contents: list[bytes], left: list[int]) -> np.ndarray:
    """Segments that may have a whole string in common with another one.

    Such a string reaches _HALF bytes or more beyond the anchor on one side, so the anchor with so many
    bytes of that side is the other's too.
    """
    sides = [
        (text[at - _HALF : at + GRAM] if at >= _HALF else None, text[at : at + GRAM + _HALF])
        for text, at in zip(contents, left, strict=True)
    ]
    before, after = (Counter(side) for side in zip(*sides, strict=True))
    some = [
        k
        for k, (one, two) in enumerate(sides)
        if (one is not None and before[one] > 1) or (len(two) == GRAM + _HALF and after[two] > 1)
    ]
    return np.array(some, np.int64)


def _settled(table: pa.Table) -> pa.Table:
    """Spans of the documents in a part that smaller documents have too, a row for each."""
    known: dict[bytes, int] = {}
    left: list[int] = []
    which, rid, doc, start = [], [], [], []
    for record in table.column("packed"):
        rids, docs, places, inside, starts, sizes, lefts, text = _unpack(record.as_py(), _SEGMENT_KINDS)
        raw, ids, a = text.tobytes(), [], 0
        for b, at in zip(np.cumsum(sizes, dtype=np.int64).tolist(), lefts.tolist(), strict=True):
            k = known.setdefault(raw[a:b], len(known))
            if k == len(left):
                left.append(at)
            ids.append(k)
            a = b
        which.append(np.array(ids)[inside])
        rid.append(np.repeat(rids, places))
        doc.append(np.repeat(docs, places))
        start.append(starts.astype(np.int64))
    which, rid, doc, start = (np.concatenate(x) for x in (which, rid, doc, start))
    contents = list(known)
    lengths = np.array([len(c) for c in contents])
    least = np.full(len(contents), np.iinfo(np.int64).max)
    np.minimum.at(least, which, doc)
    n_strings = lengths - LENGTH + 1
    minima = np.repeat(least[:, None], int(n_strings.max()), axis=1)

    own = _comparable(contents, left)
    grams = [contents[k][left[k] : left[k] + GRAM] for k in own.tolist()]
    symbol: dict[bytes, int] = {}
    anchor = np.array([symbol.setdefault(gram, len(symbol)) for gram in grams], np.int64)
    for low in range(0, len(symbol), _ANCHORS):
        met = (anchor >= low) & (anchor < low + _ANCHORS)
        some, symbols = own[met], anchor[met] - low + 257
        sizes, at = lengths[some] - GRAM + 1, np.array(left)[some][:, None]
        text = np.frombuffer(b"".join([contents[k] for k in some.tolist()]), np.uint8)
        first = (np.cumsum(lengths[some]) - lengths[some])[:, None]
        column = np.arange(int(sizes.max()))
        source = np.minimum(first + column + np.where(column > at, GRAM - 1, 0), len(text) - 1)
        strings = text[source].astype(np.uint16) + np.uint16(1)
        np.put_along_axis(strings, at, symbols[:, None].astype(np.uint16), axis=1)
        strings[column >= sizes[:, None]] = 0
        found = _class_minima(strings, sizes, least[some])
        width = found.shape[1]
        real = np.arange(width) < n_strings[some][:, None]
        part = minima[some, :width]
        part[real] = found[real]
        minima[some, :width] = part

    gone = (minima[which] < doc[:, None]) & (np.arange(minima.shape[1]) < n_strings[which][:, None])
    edge = np.diff(np.pad(gone.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    one, first = np.nonzero(edge == 1)
    _, last = np.nonzero(edge == -1)
    spans = _spans(start[one] + first, start[one] + last + LENGTH - 1)
    order = np.argsort(rid[one], kind="stable")
    return pa.table({"rid": rid[one][order], "span": spans[order]})


def _keep(docs: DataFrame, kind: str) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept (bytes) from key, text and lists of spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, lists in zip(batch.column(1).cast(pa.binary()), batch.column(2), strict=True):
                raw = text.as_py() or b""
                spans = np.sort(lists.values.to_numpy()) if lists.is_valid else np.zeros(0, np.int64)
                starts, ends = spans >> 16, (spans >> 16) + (spans & 0xFFFF)
                pieces, at, removed, runs, until = [], 0, 0, 0, -1
                for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                    if a > until:
                        runs += 1
                        pieces.append(raw[at:a])
                        removed += b - a
                    elif b > until:
                        removed += b - until
                    until = max(until, b)
                    at = until
                pieces.append(raw[at:])
                rows.append((len(raw), removed, runs, b"".join(pieces)))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                ["key", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return docs.mapInArrow(
        run, f"key {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    )


def remove_repeats(
    docs: DataFrame, key_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each document: key, n_bytes, n_removed, n_spans, kept (the bytes that stay).

    A byte goes if a string of LENGTH bytes of the text covers it that also starts in a document with a
    smaller key. Strings are judged on the input. The key is a whole number; a null text counts as
    empty; a document with a null key is not compared and keeps all. Rows with the same key are the same
    document and do not repeat each other.
    """
    kind = docs.schema[key_col].dataType.simpleString()
    key, text = F.col(f"`{key_col}`"), F.col(f"`{text_col}`")
    rows = docs.select(key.alias("key"), text.alias("text"), F.xxhash64(key, text).alias("rid"))
    comparable = rows.filter((F.octet_length("text") >= LENGTH) & F.col("key").isNotNull())
    total = comparable.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    # copies of a row are compared once
    anchor = _anchor_rows(comparable.select("rid", "text"), max(1, -(-total // ANCHOR_PART)))
    found = anchor.groupBy("part").applyInArrow(_shared, "rid bigint, entry bigint")
    shared = freed(kept(found))
    parts = max(1, -(-shared.count() * (LENGTH + _WIDTH // 2) // SEGMENT_PART))
    lists = shared.groupBy("rid").agg(F.collect_list("entry").alias("lists"))
    marked = comparable.join(lists, "rid").select(
        "rid", F.col("key").cast("bigint").alias("key"), "text", "lists"
    )
    segments = freed(kept(_segment_rows(marked, parts)))
    across = segments.filter("part >= 0").groupBy("part")
    spans = segments.filter("part < 0").select(F.col("own_rid").alias("rid"), F.explode("settled").alias("span"))
    spans = spans.union(across.applyInArrow(_settled, "rid bigint, span bigint"))
    spans = freed(kept(spans)).groupBy("rid").agg(F.collect_list("span").alias("lists"))
    spans = spans.withColumnRenamed("rid", "rid2")
    same = (F.col("rid") == F.col("rid2")) & F.col("key").isNotNull()
    whole = rows.join(spans, same, "left").select("key", "text", "lists")
    return _keep(whole, kind).withColumnRenamed("key", key_col)


def report(docs: DataFrame) -> DataFrame:
    """What is removed from each document, by doc_id, with a digest of the bytes that stay."""
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
