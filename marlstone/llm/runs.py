"""Periodic runs of words, found with string synchronising sets.

A run is a stretch of words that repeats with a period, three times at least, and that no neighbour
extends. Periods are looked for scale by scale. At scale t (4, 8, 16, ...) a place is chosen if the
smallest hash of the t + 1 windows of t words from there on is that of the first or the last. The choice
hangs on the 2 t words behind the place and on nothing else, so where text repeats with a period from
2 t to 4 t, places with equal contexts lie a period apart: such pairs propose the period. Windows that
are themselves highly periodic (t / 3 or less) have no part in the choice. They lie in runs of smaller
periods, which the scales before have found, and those of the first scale in the runs of periods below
SMALL, which are detected by comparing each word with the one a period behind.

Every run of a period from 2 t to 4 t is proposed: were no place of its first 2 q - 2 t + 1 chosen, they
would all be highly periodic, and so would the run. Proposals are checked word by word, so hashes decide
nothing. In expectation a scale chooses 2 / (t + 1) of the places, and a context lies at most a dozen
times within 4 t words, so proposals grow with the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Runs have at least so many words, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: The first scale; periods below twice as much are detected directly.
SCALE = 4
SMALL = 2 * SCALE
#: Texts are taken together until they have so many words.
WORDS = 1 << 18

_NEVER = np.iinfo(np.uint64).max
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _ahead(x: np.ndarray, by: int) -> np.ndarray:
    """x moved by so many places; what comes after its end equals nothing."""
    return np.concatenate([x[by:], _mix(np.arange(1, min(by, len(x)) + 1, dtype=np.uint64) * _ODD)])


def _stretches(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 of the stretches of at least so many true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).astype(np.int8)))
    first, last = edges[::2], edges[1::2]
    long = last - first >= least
    return first[long], last[long]


def _extent(codes: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The stretch around a place in which words are equal to those a period behind."""
    last, step = at, 64
    top = len(codes) - period
    while last < top:
        until = min(top, last + step)
        same = codes[last:until] == codes[last + period : until + period]
        if not same.all():
            last += int(same.argmin())
            break
        last, step = until, 2 * step
    first, step = at, 64
    while first > 0:
        until = max(0, first - step)
        same = codes[until:first] == codes[until + period : first + period]
        if not same.all():
            first -= int(same[::-1].argmin())
            break
        first, step = until, 2 * step
    return first, last


def synchronising(h: np.ndarray, periodic: np.ndarray, scale: int) -> np.ndarray:
    """The chosen places, from the hashes of the windows of `scale` words and which are periodic."""
    ids = np.where(periodic, _NEVER, h)
    low, step = ids, 1
    while step < scale:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    low = np.minimum(low[:-1], low[1:])  # of scale + 1 windows
    n = len(low)
    return np.flatnonzero((low != _NEVER) & ((low == ids[:n]) | (low == ids[scale : scale + n])))


def proposals(places: np.ndarray, context: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of pairs of places with equal contexts, from 2 to 4 scales apart."""
    own = context[places]
    order = np.argsort(own, kind="stable")
    own, at = own[order], places[order]
    found = []
    for step in range(1, len(at)):
        apart = at[step:] - at[:-step]
        near = (own[step:] == own[:-step]) & (apart < 4 * scale)
        if not near.any():
            break
        pair = np.flatnonzero(near & (apart >= 2 * scale))
        found.append((at[pair], apart[pair]))
    if not found:
        return at[:0], at[:0]
    place, period = (np.concatenate(x) for x in zip(*found, strict=True))
    # a run has a whole period before or behind the place: two overlapping windows on either side
    wide, n = 2 * scale, len(context)

    def equal(start: np.ndarray) -> np.ndarray:
        fits = (start >= 0) & (start + period < n)
        start = np.where(fits, start, 0)
        return fits & (context[start] == context[np.minimum(start + period, n - 1)])

    behind = equal(place + period - wide)
    before = equal(place - period) & equal(place - wide)
    some = behind | before
    return place[some], period[some]


def find_runs(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, end and smallest period of all stretches of three periods at least, by start and period.

    `codes` holds texts one behind the other, each followed by a number that stands nowhere else; `sizes`
    are their lengths without it.
    """
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(first: np.ndarray, last: np.ndarray, period: int) -> None:
        found.append((first, last + period, np.full(len(first), period)))

    for period in range(1, min(SMALL, len(codes))):
        add(*_stretches(codes[period:] == codes[:-period], (LEAST_PERIODS - 1) * period), period)
    place = np.arange(len(codes))  # of what is left at a scale
    starts = np.cumsum(sizes + 1) - sizes - 1
    own, here = codes, np.arange(len(sizes))
    h = _mix(codes.view(np.uint64) * _ODD)
    for step in range(SCALE.bit_length() - 1):
        h = _mix(h * _ODD + _ahead(h, 1 << step))
    scale = SCALE
    while True:
        enough = sizes[here] >= max(LEAST_WORDS, 2 * LEAST_PERIODS * scale)
        if not enough.any():
            break
        if not enough.all():
            left = np.repeat(enough, sizes[here] + 1)
            own, place, h, here = own[left], place[left], h[left], here[enough]
        # windows within runs of a third of the scale
        change = np.zeros(len(codes) + 1, np.int64)
        for first, last, period in found:
            inside = (3 * period <= scale) & (last - first >= scale)
            np.add.at(change, first[inside], 1)
            np.add.at(change, last[inside] - scale + 1, -1)
        periodic = (np.cumsum(change[:-1]) > 0)[place]
        context = _mix(h * _ODD + _ahead(h, scale))
        at, period = proposals(synchronising(h, periodic, scale), context, scale)
        order = np.lexsort((at, period))
        until = (0, -1)
        rows = []
        for i, q in zip(at[order].tolist(), period[order].tolist(), strict=True):
            if q == until[0] and i < until[1]:
                continue
            first, last = _extent(own, i, q)
            until = (q, last)
            if last - first >= (LEAST_PERIODS - 1) * q:
                rows.append((place[first], place[first] + last - first + q, q))
        if rows:
            found.append(tuple(np.array(x) for x in zip(*rows, strict=True)))
        h, scale = context, 2 * scale
    if not found:
        return starts[:0], starts[:0], starts[:0]
    first, last, period = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((period, last, first))
    first, last, period = first[order], last[order], period[order]
    # of the periods of one stretch the smallest divides the others
    new = np.concatenate([[True], (np.diff(first) != 0) | (np.diff(last) != 0)]) if len(first) else []
    new = np.array(new, bool)
    first, last, period = first[new], last[new], period[new]
    order = np.lexsort((period, first))
    return first[order], last[order], period[order]


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)])


def _settled(texts: list[list[bytes]], least: int) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of each text's runs."""
    known: dict[bytes, int] = {}
    sizes = np.array([len(words) for words in texts])
    codes = np.empty(int(sizes.sum()) + len(texts), np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    for k, (words, start) in enumerate(zip(texts, starts.tolist(), strict=True)):
        codes[start : start + len(words)] = [known.setdefault(w, len(known)) for w in words]
        codes[start + len(words)] = -1 - k
    first, last, period = find_runs(codes, sizes)
    long = last - first >= least
    first, last, period = first[long], last[long], period[long]
    owner = np.searchsorted(starts, first, side="right") - 1
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, s, e, q in zip(owner.tolist(), first.tolist(), last.tolist(), period.tolist(), strict=True):
        out[k].append((s - int(starts[k]), e - s, q))
    return out


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def periodic_runs(
    docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", least: int = LEAST_WORDS
) -> DataFrame:
    """One row for each document: key, n_words, runs, strongest, collapsed.

    Words are what ASCII blanks separate. `runs` holds (start, length, period) of all runs of at least
    `least` words and three of their smallest period, by start and period; `strongest` is that with the
    most periods (the first, then the shortest period on ties), null if there is none; `collapsed` is
    the text with one blank between words and only the first period of each run.

    A null or empty text, or one of blanks, has no words and no runs and collapses to the empty text.
    Keys may be null and may repeat: each row gets its own result. Other columns are not looked at,
    whatever their names. An empty table gives an empty one. Texts are taken whole, however long: a task
    holds WORDS words, or those of one text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.null()
        keys: list = []
        texts: list[list[bytes]] = []
        held = 0

        def emit() -> pa.RecordBatch:
            runs = _settled(texts, least)
            strongest = [
                max(own, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if own else None for own in runs
            ]
            rows = [_collapsed(words, own) for words, own in zip(texts, runs, strict=True)]

            def named(r: tuple[int, int, int] | None) -> dict | None:
                return r and dict(zip(("start", "length", "period"), r, strict=True))

            return pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, kind),
                    pa.array([len(words) for words in texts], pa.int64()),
                    pa.array([[named(r) for r in own] for own in runs], pa.list_(_RUN)),
                    pa.array([named(r) for r in strongest], _RUN),
                    pa.array(rows, pa.binary()).cast(pa.string()),
                ],
                ["key", "n_words", "runs", "strongest", "collapsed"],
            )

        for batch in batches:
            kind = batch.column(0).type
            for key, text in zip(batch.column(0), batch.column(1).cast(pa.binary()), strict=True):
                words = (text.as_py() or b"").split()
                keys.append(key.as_py())
                texts.append(words)
                held += len(words) + 1
                if held >= WORDS:
                    yield emit()
                    keys, texts, held = [], [], 0
        if keys:
            yield emit()

    kind = docs.schema[key_col].dataType.simpleString()
    rows = docs.selectExpr(f"`{key_col}` AS key", f"`{text_col}` AS text")
    schema = f"key {kind}, n_words bigint, runs array<{RUN}>, strongest {RUN}, collapsed string"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key_col)


def repeated_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text; in a tenth of the documents the words from one on repeat the first few of them.

    With h the CRC of the doc_id and g its tenth: where h ends in 0, word i from a = g mod n on becomes
    word a + (i - a) mod p, p = 1 + (n - a) / (3 + g mod 8). A document without words or id stays.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    g = F.floor(F.col("h") / 10)
    n = F.size("words")
    a = F.pmod(g, F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    rows = rows.select("doc_id", "text", "words", n.alias("n"), a.alias("a"), p.alias("p"))
    many = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), many))
    tail = F.slice(tail, F.lit(1), F.col("n") - F.col("a"))
    planted = F.concat_ws(" ", F.slice("words", F.lit(1), F.col("a")), tail)
    some: Column = F.col("words").isNotNull() & (F.col("n") > 0)
    return rows.select("doc_id", F.when(some, planted).otherwise(F.col("text")).alias("text"))


def report(docs: DataFrame) -> DataFrame:
    """Digests of the runs of all documents with repeated tails, by doc_id."""
    found = periodic_runs(repeated_tails(docs))
    written = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", written), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
