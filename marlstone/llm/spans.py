"""Places of pattern matches in texts, with built-in functions only.

Built-in functions return matches but not their places. A place follows from the pieces between the
matches: a match starts where the pieces and matches before it end.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sums run over blocks of so many numbers, so that growing an array costs little however long it is.
BLOCK = 128
#: So many characters on each side of a match are looked through for context words.
CONTEXT = 40

SPAN = "array<struct<start:bigint,end:bigint,value:string,before:string,after:string>>"


def numbers(values: Sequence[float], kind: str) -> Column:
    """A constant array of numbers."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def once(column: Column) -> Column:
    """The column as it is, for the optimizer to leave where it stands.

    It copies what a filter, an explode or a lambda refers to into that place, where a costly array would
    be built again, in a lambda for every element. It does not copy what looks random. The cost is that
    filters on such a column stay behind it, and that it is computed where only other columns are wanted.
    """
    return F.when(F.rand(0) + 1 > 0, column)


def running_sums(numbers: Column) -> Column:
    """Inclusive running sums of an array of numbers, as an array of longs."""
    return _running(numbers, lambda total, x: total + x)


def running_maxima(numbers: Column) -> Column:
    """The greatest of an array's numbers (none below zero) up to each, as an array of longs."""
    return _running(numbers, lambda total, x: F.greatest(total, x))


def _running(numbers: Column, combine: Callable[[Column, Column], Column]) -> Column:
    def scan(part: Column, first: Column) -> Column:
        zero = F.struct(first.alias("total"), F.array().cast("array<bigint>").alias("sums"))

        def step(state: Column, x: Column) -> Column:
            total = combine(state["total"], x)
            return F.struct(
                total.alias("total"), F.concat(state["sums"], F.array(total)).alias("sums")
            )

        return F.aggregate(part, zero, step, lambda state: state["sums"])

    def block(b: Column) -> Column:
        return F.slice(numbers, b * BLOCK + 1, BLOCK)

    zero = F.lit(0).cast("bigint")
    blocks = F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / BLOCK).cast("int"))
    totals = F.transform(blocks, lambda b: F.aggregate(block(b), zero, combine))
    before = F.concat(F.array(zero), scan(totals, zero))
    many = F.flatten(
        F.transform(F.arrays_zip(blocks.alias("b"), F.slice(before, 1, F.size(blocks)).alias("s")),
                    lambda z: scan(block(z["b"]), z["s"]))
    )
    empty = F.array().cast("array<bigint>")
    return (
        F.when(F.size(numbers) == 0, empty)
        .when(F.size(numbers) <= BLOCK, scan(numbers, zero))
        .otherwise(many)
    )


def locate(
    docs: DataFrame, text: str, patterns: dict[str, str], guards: dict[str, Column] | None = None
) -> DataFrame:
    """Replace `text` by one column of spans for each pattern, named after it.

    Matches are leftmost and do not overlap. start and end count code points, end is exclusive;
    before and after hold up to CONTEXT characters on either side, not beyond the next match. Where a
    guard is false, no match can be there and none is looked for. The text must not be null, and the
    pattern must not match the empty string.
    """
    guards = guards or {}
    rest = [c for c in docs.columns if c != text]
    t = F.col(text)

    def found(name: str) -> Column:
        matches = F.regexp_extract_all(t, F.lit(patterns[name]), F.lit(0))
        none = F.array().cast("array<string>")
        return F.when(guards[name], matches).otherwise(none) if name in guards else matches

    def gaps(name: str) -> Column:
        none = F.array().cast("array<string>")
        return F.when(F.size(f"__{name}_m") > 0, F.split(t, patterns[name], -1)).otherwise(none)

    def lengths(name: str) -> Column:
        m, g = F.col(f"__{name}_m"), F.col(f"__{name}_g")
        return F.transform(
            m,
            lambda v, i: F.char_length(F.get(g, i))
            + F.when(i == 0, 0).otherwise(F.coalesce(F.char_length(F.get(m, i - 1)), F.lit(0))),
        )

    def spans(name: str) -> Column:
        m, g, s = (F.col(f"__{name}_{x}") for x in "mgs")
        return F.transform(
            m,
            lambda v, i: F.struct(
                F.get(s, i).alias("start"),
                (F.get(s, i) + F.char_length(v)).alias("end"),
                v.alias("value"),
                F.right(F.get(g, i), F.lit(CONTEXT)).alias("before"),
                F.left(F.get(g, i + 1), F.lit(CONTEXT)).alias("after"),
            ),
        ).cast(SPAN)

    names = list(patterns)
    step = docs.select(*rest, text, *[found(n).alias(f"__{n}_m") for n in names])
    step = step.select("*", *[gaps(n).alias(f"__{n}_g") for n in names]).drop(text)
    step = step.select("*", *[once(lengths(n)).alias(f"__{n}_l") for n in names])
    step = step.select("*", *[once(running_sums(F.col(f"__{n}_l"))).alias(f"__{n}_s") for n in names])
    return step.select(*rest, *[spans(n).alias(n) for n in names])


def _written(kind: str, spans: Column) -> Column:
    def one(s: Column) -> Column:
        return F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string"))

    return F.transform(spans, one)


def written(kinds: Sequence[str]) -> list[Column]:
    """kind:start:end of each span, one array for each of the columns that are named."""
    return [_written(kind, F.col(kind)) for kind in kinds]


def _ranked(kind: str, rank: int) -> Column:
    def one(s: Column) -> Column:
        return F.struct(
            s["start"].alias("start"),
            F.lit(rank).alias("rank"),
            s["end"].alias("end"),
            F.lit(kind).alias("kind"),
        )

    return F.transform(kind, one)


def in_order(kinds: Sequence[str]) -> Column:
    """(start, rank, end, kind) of all spans of the named columns, by start and then as listed."""
    return F.array_sort(F.flatten(F.array(*[_ranked(k, i) for i, k in enumerate(kinds)])))


def cut(docs: DataFrame, text: str, spans: str) -> DataFrame:
    """The text with sorted (start, end, kind) spans replaced by their kinds in brackets.

    Overlapping spans become one, of the first one's kind. Other columns stay; `spans` goes. A piece is
    cut out of the part of the text that its block of spans takes, and these out of the text: with n
    spans there are about the root of n of either, so that n spans cost the root of n readings.
    """
    rest = [c for c in docs.columns if c not in (text, spans)]
    ends = F.transform(spans, lambda s: s["end"])
    step = docs.select(*rest, text, spans, once(ends).alias("__ends"))
    step = step.select(*rest, text, spans, once(running_maxima(F.col("__ends"))).alias("__ends"))

    def head(s: Column, i: Column) -> Column:
        at = F.coalesce(F.get(F.col("__ends"), i - 1), F.lit(0))
        return F.struct(at.alias("at"), s["start"].alias("start"), s["kind"].alias("kind"))

    heads = F.filter(F.transform(spans, head), lambda x: x["start"] >= x["at"])
    until = F.coalesce(F.get(F.col("__ends"), F.size("__ends") - 1), F.lit(0))
    step = step.select(*rest, text, once(heads).alias("__heads"), until.alias("__until"))
    width = F.greatest(F.ceil(F.sqrt(F.size("__heads"))).cast("int"), F.lit(1))
    step = step.select("*", once(width).alias("__width"))

    def block(g: Column) -> Column:
        own = F.slice("__heads", g * F.col("__width") + 1, F.col("__width"))
        return F.struct(own.alias("own"), F.get("__heads", g * F.col("__width"))["at"].alias("at"))

    blocks = F.sequence(F.lit(0), F.floor((F.size("__heads") - 1) / F.col("__width")).cast("int"))
    none = F.array().cast("array<struct<own:array<struct<at:bigint,start:bigint,kind:string>>,at:bigint>>")
    blocks = F.when(F.size("__heads") > 0, F.transform(blocks, block)).otherwise(none)
    step = step.select(*rest, text, "__until", once(blocks).alias("__blocks"))

    def part(b: Column) -> Column:
        last = F.get(b["own"], F.size(b["own"]) - 1)["start"]
        own = F.substr(F.col(text), (b["at"] + 1).cast("int"), (last - b["at"]).cast("int"))
        return F.struct(b["own"].alias("own"), b["at"].alias("at"), own.alias("text"))

    step = step.select(*rest, text, "__until", once(F.transform("__blocks", part)).alias("__blocks"))

    def pieces(b: Column) -> Column:
        def piece(x: Column) -> Column:
            gap = F.substr(b["text"], (x["at"] - b["at"] + 1).cast("int"), (x["start"] - x["at"]).cast("int"))
            return F.concat(gap, F.lit("["), x["kind"], F.lit("]"))

        return F.concat_ws("", F.transform(b["own"], piece))

    tail = F.substr(F.col(text), (F.col("__until") + 1).cast("int"), F.char_length(F.col(text)))
    whole = F.concat_ws("", F.transform("__blocks", pieces), F.array(tail))
    return step.select(*rest, F.when(F.size("__blocks") > 0, whole).otherwise(F.col(text)).alias(text))
