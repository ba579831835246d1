"""Benchmark decontamination by templates: numbers, names and units become typed placeholders.

Documents and benchmark items turn into template tokens. Windows of WINDOW tokens are hashed; those of
documents first pass a bitmap of the benchmark's hashes (it may let others through) and
then a hash join with its windows. What lines up at one distance between document and item is judged
together: enough windows must match, and each slot's value in the item must go with one value in the
document. So a question is found with other numbers or names too, and text that only looks alike is
not.

Windows that are mostly placeholders count like others, but cannot make a leak on their own unless their
values are equal too: an item without any other window is found by its own words and numbers only.

A capitalised word at the start of a sentence may be a name or not. There are two templates: in one such
words stay, in the other they are names. In items of fewer than LEAST_WINDOWS windows, those that neither
stand as a name elsewhere nor begin several sentences must be equal in the second one too.

Built-in functions only. A null text counts as empty; texts and items of fewer than WINDOW tokens match
nothing; repeated rows each get their own result; a null doc_id is a value like others. With an empty
benchmark nothing matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.folders import kept
from marlstone.llm.spans import numbers, once

WINDOW = 8
#: So many matching windows make a leak, or all of an item that has fewer: thirteen tokens.
LEAST_WINDOWS = 6
#: Windows with more placeholders than this say little: all others of the item, or LEAST_WINDOWS, must match.
MOST_SLOTS = 4
#: Share of an item's slots whose values must map consistently.
LEAST_CONSISTENT = 0.8

#: The bitmap has so many bits for each window of the benchmark, within bounds (powers of two) that let it
#: be part of the plan: 32 to 512 KB, in words of 64 bits. Each window sets two, by its hash shifted so.
BITS_PER_WINDOW, LEAST_BITS, MOST_BITS, WORD_BITS = 64, 18, 22, 6
PROBES = (0, 32)
#: A benchmark of up to so many windows (about 100 MB) is broadcast, a larger one is shuffled.
BROADCAST_WINDOWS = 500_000

#: Words that are units behind a number.
UNITS = (
    "%|°|km|m|cm|mm|mi|miles|mile|ft|feet|inches|inch|kg|g|mg|lb|lbs|pounds|oz|l|ml|liters|litres"
    "|s|sec|seconds|second|min|minutes|minute|h|hours|hour|days|day|weeks|week|months|month|years"
    "|year|kmh|mph|dollars|dollar|cents|euros|euro|usd|eur|percent|degrees|watts|volts"
)
NUMBER, UNIT, NAME = "<n>", "<u>", "<p>"
#: Marks capitalised words at the start of sentences; no token holds it.
FIRST = "^"


def _text(rows: Column, steps: list[tuple[str, str]]) -> Column:
    for pattern, by in steps:
        rows = F.regexp_replace(rows, pattern, by)
    return rows


#: Steps from a text to words with one blank before each. Marks go, but for those that end sentences,
#: and those too where no word stands before them.
_WORDS = [
    (r"[^\p{L}\p{N}%$€£°.!?\x20\x09-\x0D]++", ""),
    # a blank that is alone between words is left as it is
    (
        r"(?:[\x09-\x0D]|\x20(?=[\x20\x09-\x0D.!?]))[\x20\x09-\x0D]*+"
        r"(?:[.!?]++(?:[\x20\x09-\x0D]++|$))*+",
        " ",
    ),
]
#: Steps from those words to the template. Each looks at the words before as the text has them: marks
#: at the end of units and of words at the start of sentences stay for the steps behind.
_SLOTS = [
    (rf"( [$€£]?[0-9][^ ]*+) (?i:{UNITS})(?=[.!?]*+(?: |$))", rf"$1 {UNIT}"),
    (r"([.!?]) (?=\p{Lu}\p{Ll})", rf"$1 \{FIRST}"),
    (r" (?<=[^.!? ] )\p{Lu}\p{Ll}[^ ]*+", f" {NAME}"),
    (r" [$€£]?[0-9][^ ]*+", f" {NUMBER}"),
]


def _plain(text: Column) -> Column:
    """The words of a text; a full stop stands for what comes before."""
    words = F.trim(_text(F.concat(F.lit(" "), F.coalesce(text, F.lit(""))), _WORDS))
    return F.concat(F.lit(". "), words)


def _bare(plain: Column) -> Column:
    """The words behind the first full stop in lower case, without marks at the end."""
    return F.rtrim(F.lower(F.substring(plain, 3, 1 << 30)), F.lit(".!?"))


def _tokens(bare: str) -> Column:
    """The words without marks at their ends."""
    words = F.split(F.regexp_replace(bare, "[.!?]++ ", " "), " ")
    return F.when(F.col(bare) == "", F.array().cast("array<string>")).otherwise(words)


#: What a token is in either template.
_LITERAL = f"IF(startswith(t, '{FIRST}'), substr(t, 2), t)"
_NAMED = f"IF(startswith(t, '{FIRST}'), '{NAME}', t)"


def templates(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """Replace the text by `raw`, its tokens in lower case, and `tmpl`, with placeholders for slots.

    A token that starts like a number is a number, a unit word behind one is a unit, and a capitalised
    word within a sentence is a name. In `names` one at the start of a sentence is a name too; `marked`
    has it with FIRST before it.
    """
    rest = [c for c in rows.columns if c != text_col]
    words = rows.select(*rest, once(_plain(F.col(text_col))).alias("plain"))
    words = words.select(
        *rest,
        once(_bare(F.col("plain"))).alias("raw"),
        once(_bare(_text(F.col("plain"), _SLOTS))).alias("marked"),
    )
    words = words.select(*rest, once(_tokens("raw")).alias("raw"), once(_tokens("marked")).alias("marked"))
    return words.select(
        *rest,
        "raw",
        "marked",
        once(F.expr(f"transform(marked, t -> {_LITERAL})")).alias("tmpl"),
        once(F.expr(f"transform(marked, t -> {_NAMED})")).alias("names"),
    )


def _with_hashes(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """`rows` with the hashes of each window, by its place, from an array expression for each column.

    A token is hashed once; windows of two, four and eight follow from two halves each.
    """
    rest = rows.columns
    step = rows.select(*rest, *[once(F.expr(tokens)).alias(name) for name, tokens in columns.items()])
    width = 1
    while width < WINDOW:
        step = step.select(*rest, *[
            once(F.expr(
                f"""CASE WHEN size({name}) > {width} THEN zip_with(slice({name}, 1, size({name}) - {width}),
                    slice({name}, {width + 1}, size({name}) - {width}), (a, b) -> xxhash64(a, b)) END"""
            )).alias(name)
            for name in columns
        ])
        width *= 2
    return step


def _slots(at: str, tmpl: str = "tmpl", of: str = "raw") -> str:
    """What an array has at the places of the placeholders in the window at an index."""
    return f"""filter(transform(slice({tmpl}, {at} + 1, {WINDOW}),
        (t, k) -> named_struct('t', t, 'value', get({of}, {at} + k))),
        x -> x.t IN ('{NUMBER}', '{UNIT}', '{NAME}')).value"""


def _key(values: str, at: str, h: str) -> str:
    """What windows are joined on: the template's hash, or that of the tokens if all are placeholders."""
    return f"IF(size({values}) = {WINDOW}, xxhash64(slice(raw, {at} + 1, {WINDOW})), {h})"


def _firm() -> str:
    """Which of an item's tokens begin a sentence without being taken for names."""
    named = "array_contains(filter(raw, (r, k) -> get(tmpl, k) = '{}'), ltrim('{}', t))".format(NAME, FIRST)
    several = "size(filter(marked, o -> o = t)) > 1"
    return f"""transform(marked, t -> startswith(t, '{FIRST}')
        AND size(marked) < {WINDOW + LEAST_WINDOWS - 1} AND NOT {several} AND NOT {named})"""


def benchmark_windows(items: DataFrame, key_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item, v (the template), at, h, key and slots of each window, and how many of a kind its item has.

    n counts all windows, n_words those with a word, n_plain those with at most MOST_SLOTS placeholders.
    Slots that are `firm` must be equal and do not count as placeholders there.
    """
    rows = items.selectExpr(f"`{key_col}` AS item", f"`{text_col}` AS text")
    tokens = templates(rows.dropDuplicates())
    first = tokens.selectExpr("item", "raw", "tmpl", "transform(raw, r -> false) AS firm", "1 AS v")
    second = tokens.filter(f"exists(marked, t -> startswith(t, '{FIRST}'))")
    second = second.selectExpr("item", "raw", "names AS tmpl", f"{_firm()} AS firm", "2 AS v")
    tokens = _with_hashes(first.union(second), {"hashes": "transform(tmpl, t -> xxhash64(t))"})
    every = tokens.select("item", "v", "raw", "tmpl", "firm", F.posexplode("hashes").alias("at", "h"))
    every = every.selectExpr(
        "*",
        f"{_slots('at')} AS slots",
        f"{_slots('at', of='firm')} AS firm_slots",
        "xxhash64(raw) AS own",
    )
    every = every.selectExpr(
        "item",
        "v",
        "at",
        "h",
        f"{_key('slots', 'at', 'h')} AS key",
        "slots",
        "firm_slots AS firm",
        f"size(filter(firm_slots, f -> NOT f)) <= {MOST_SLOTS} AS plain",
        "own",
    )
    n = every.groupBy(F.col("item").alias("item2"), F.col("own").alias("own2"), F.col("v").alias("v2"))
    n = n.agg(
        F.count("*").alias("n"),
        F.count_if(F.size("slots") < WINDOW).alias("n_words"),
        F.count_if("plain").alias("n_plain"),
    )
    same = F.col("item").eqNullSafe(F.col("item2")) & (F.col("own") == F.col("own2"))
    return every.join(n, same & (F.col("v") == F.col("v2"))).drop("own", "item2", "own2", "v2")


def _bitmap(windows: DataFrame, n: int) -> tuple[Column, int]:
    """An array of words with two bits set for each window's hash, and how many bits it has."""
    bits = min(MOST_BITS, max(LEAST_BITS, (BITS_PER_WINDOW * n).bit_length()))
    bit = [F.expr(_place("h", shift, bits)) for shift in PROBES]
    words = windows.select(F.explode(F.array(*bit)).alias("p")).select(
        F.shiftright("p", WORD_BITS).cast("int").alias("w"),
        F.expr(f"shiftleft(1L, int(p & {(1 << WORD_BITS) - 1}))").alias("b"),
    )
    full = [0] * (1 << (bits - WORD_BITS))
    for r in words.groupBy("w").agg(F.bit_or("b").alias("b")).collect():
        full[r["w"]] = r["b"]
    return numbers(full, "bigint"), bits


def _place(h: str, shift: int, bits: int) -> str:
    return f"(shiftright({h}, {shift}) & {(1 << bits) - 1}L)"


def _hits(hashes: str, bitmap: Column, bits: int, also: Callable[[Column], Column] | None = None) -> Column:
    """Places of the windows that pass the bitmap."""

    def passes(i: Column) -> Column:
        found = F.lit(True) if also is None else also(i)
        for shift in PROBES:
            place = F.shiftright(F.get(hashes, i), shift).bitwiseAND((1 << bits) - 1)
            word = F.get(bitmap, F.shiftright(place, WORD_BITS).cast("int"))
            bit = F.call_function("shiftright", word, place.bitwiseAND((1 << WORD_BITS) - 1).cast("int"))
            found = found & (bit.bitwiseAND(1) == 1)
        return found

    return F.when(F.size(hashes) > 0, F.filter(F.sequence(F.lit(0), F.size(hashes) - 1), passes))


def leaks(
    docs: DataFrame, items: DataFrame, key_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, text (hash of the document's text), item and windows of each item found in a document."""
    bench = kept(benchmark_windows(items))
    n_windows = bench.count()
    bitmap, bits = _bitmap(bench, n_windows)
    bench = F.broadcast(bench) if n_windows <= BROADCAST_WINDOWS else bench
    rows = docs.select(
        F.col(f"`{key_col}`").alias("id"),
        F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("own"),
        F.col(f"`{text_col}`").alias("text"),
    )
    tokens = rows.select("id", "own", once(_plain(F.col("text"))).alias("plain"))
    slotted = once(_bare(_text(F.col("plain"), _SLOTS)))
    tokens = tokens.select("id", "own", "plain", slotted.alias("marked"))
    tokens = tokens.select("id", "own", "plain", once(_tokens("marked")).alias("marked"))
    tokens = _with_hashes(tokens, {
        "hashes1": f"transform(marked, t -> xxhash64({_LITERAL}))",
        "hashes2": f"transform(marked, t -> xxhash64({_NAMED}))",
    })
    # a window without a word that begins a sentence is the same in both templates
    def differ(i: Column) -> Column:
        return F.get("hashes1", i) != F.get("hashes2", i)

    marked = tokens.select(
        "id",
        "own",
        "plain",
        "marked",
        "hashes1",
        "hashes2",
        once(_hits("hashes1", bitmap, bits)).alias("hits1"),
        once(_hits("hashes2", bitmap, bits, differ)).alias("hits2"),
    )
    # few documents get here
    marked = marked.filter("size(hits1) > 0 OR size(hits2) > 0")
    marked = marked.withColumn("plain", once(_bare(F.col("plain")))).select(
        "*",
        once(_tokens("plain")).alias("raw"),
        once(F.expr(f"transform(marked, t -> {_LITERAL})")).alias("tmpl"),
        once(F.expr(f"transform(marked, t -> {_NAMED})")).alias("names"),
    )
    same_in_both = "get(hashes1, i) = get(hashes2, i)"
    values = [
        f"""transform(hits1, i -> named_struct('v', IF({same_in_both}, 0, 1),
            'h', get(hashes1, i), 'at', i, 'values', {_slots('i', 'tmpl')}))""",
        f"""transform(hits2, i -> named_struct('v', 2,
            'h', get(hashes2, i), 'at', i, 'values', {_slots('i', 'names')}))""",
    ]
    both = F.expr(f"concat({', '.join(f'coalesce({v}, array())' for v in values)})")
    valued = marked.select("id", "own", "raw", once(both).alias("hits"))
    keyed = f"""transform(hits, x -> named_struct('v', x.v,
        'key', {_key('x.values', 'x.at', 'x.h')}, 'at', x.at, 'values', x.values))"""
    valued = valued.select("id", "own", once(F.expr(keyed)).alias("hits"))
    found = valued.select("id", "own", F.explode("hits").alias("d"))
    counts = ("v", "n", "n_words", "n_plain")
    same = (F.col("d.key") == F.col("key")) & F.col("d.v").isin(0, F.col("v"))
    matched = found.join(bench, same).select(
        "id",
        "own",
        "item",
        *counts,
        (F.col("d.at") - F.col("at")).alias("shift"),
        "at",
        "plain",
        (F.col("slots") == F.col("d.values")).alias("equal"),
        F.arrays_zip(
            F.col("slots").alias("i"), F.col("d.values").alias("d"), F.col("firm").alias("firm")
        ).alias("pairs"),
    )
    matched = matched.filter("forall(pairs, p -> NOT p.firm OR p.i = p.d)")
    free = F.expr("filter(pairs, p -> NOT p.firm)")
    lined = matched.groupBy("id", "own", "item", *counts, "shift").agg(
        F.size(F.collect_set("at")).alias("windows"),
        F.size(F.collect_set(F.when(F.col("plain"), F.col("at")))).alias("plain"),
        F.size(F.collect_set(F.when(F.col("equal"), F.col("at")))).alias("equal"),
        F.array_distinct(F.flatten(F.collect_list(free))).alias("pairs"),
    )
    distinct = F.size(F.array_distinct(F.col("pairs.i")))
    consistent = distinct >= LEAST_CONSISTENT * F.size("pairs")

    def enough(windows: str, n: str) -> Column:
        return F.col(windows) >= F.least(F.lit(LEAST_WINDOWS), F.col(n))

    template = (F.col("n_plain") > 0) & enough("plain", "n_plain") & enough("windows", "n_words")
    return (
        lined.filter((template & consistent) | enough("equal", "n"))
        .groupBy("id", "own", "item")
        .agg(F.max("windows").alias("windows"))
    )


def contaminated(
    docs: DataFrame, items: DataFrame, key_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each document with a leak: key, item_ids (sorted), n_windows of the longest."""
    return (
        leaks(docs, items, key_col, text_col)
        .groupBy("id")
        .agg(
            F.array_sort(F.collect_set("item")).alias("item_ids"),
            F.max("windows").alias("n_windows"),
        )
        .withColumnRenamed("id", key_col)
    )


def decontaminate(
    docs: DataFrame, items: DataFrame, key_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents without a leak, all columns as they are."""
    bad = leaks(docs, items, key_col, text_col).select("id", "own").distinct()
    row = docs.select(F.struct("*").alias("row"))
    own = F.xxhash64(F.coalesce(F.col(f"row.`{text_col}`"), F.lit("")))
    same = F.col(f"row.`{key_col}`").eqNullSafe(bad["id"]) & (own == bad["own"])
    clean = row.join(bad, same, "left_anti")
    return clean.select(*[F.col(f"row.`{c}`") for c in docs.columns])


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The contaminated documents with the items found in them."""
    return contaminated(docs, items)
