"""Secrets: fixed patterns, and two character Markov models compared by log-likelihood ratio.

One model is learned from the values of secrets that the patterns label, the other from the words
around them. A long token is reported where its characters follow each other as in the former.
Built-in functions only; the driver sees the two tables of counts, one number for each pair of the
alphabet. A null text counts as empty; repeated rows each get their own result; columns of the input
stay, except one that is named like a result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.spans import cut, in_order, locate, numbers, once, running_maxima

#: The base patterns.
PATTERNS = {
    "assign": r"(?i:password|passwd|secret|token|api_?key)[\"']?+\x20*+[:=]\x20*+[\"']?+"
    r"[A-Za-z0-9+/_.=-]++",
    "access": r"AKIA[A-Z0-9]{12,}+",
    "hex": r"[0-9a-f]{32,}+",
}
BASE = ("assign", "access", "hex")
ADDED = ("random",)
KINDS = BASE + ADDED
_HEAD = r"^(?i:password|passwd|secret|token|api_?key)[\"']?+\x20*+[:=]\x20*+[\"']?+"
_LONG_VALUE = _HEAD + r"[A-Za-z0-9+/_.=-]{8}"

ALPHABET = "".join(map(chr, [*range(48, 58), *range(65, 91), *range(97, 123)])) + "+/_-="
#: Tokens that the models judge.
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}+={0,2}+"
#: The models learn from at most so many different texts that hold a secret, and as many that hold none.
SAMPLE = 1024
#: A token is random if its log-likelihood ratio is at least this, in all and for each pair.
LEAST, LEAST_EACH = 8.0, 0.35


def _sample(docs: DataFrame, size: int) -> DataFrame:
    """Up to `size` different texts with a base match, and as many without.

    Of either, the one with the lowest hash in each of `size` cells.
    """
    h = F.xxhash64("text")
    hit = F.col("text").rlike("|".join(PATTERNS.values()))
    rows = docs.select(h.alias("h"), hit.alias("hit"))
    cells = rows.groupBy("hit", F.pmod("h", F.lit(size)).alias("cell"))
    chosen = cells.agg(F.min("h").alias("h")).select("h")
    found = docs.select(h.alias("h"), "text").join(F.broadcast(chosen), "h")
    return found.dropDuplicates(["h"]).select("text")


def learn(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> list[float]:
    """Log ratio of P(next character | character) in secrets and in words, for each pair.

    Labels come from the base patterns. Every pair is counted once more than seen, so that a model
    without samples is uniform. The result has a number for each pair, in the order of ALPHABET.
    """
    texts = docs.select(F.col(text_col).alias("text")).filter("text is not null")
    texts = _sample(texts, sample)
    secret = F.flatten(
        F.array(*[F.regexp_extract_all("text", F.lit(p), F.lit(0)) for p in PATTERNS.values()])
    )
    plain = F.col("text")
    for pattern in PATTERNS.values():
        plain = F.regexp_replace(plain, pattern, " ")
    words = F.array_distinct(F.regexp_extract_all(plain, F.lit(r"[A-Za-z0-9+/_=-]{3,}+"), F.lit(0)))
    labelled = texts.select(
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("y"), secret.alias("words")),
                F.struct(F.lit(0).alias("y"), words.alias("words")),
            )
        ).alias("c")
    ).select("c.y", F.explode("c.words").alias("w"))
    labelled = labelled.select(
        "y", F.split(F.when(F.col("y") == 1, F.regexp_replace("w", _HEAD, "")).otherwise(F.col("w")), "").alias("ch")
    )
    pairs = labelled.select(
        "y",
        F.explode(
            F.transform(
                F.slice("ch", 2, F.greatest(F.size("ch") - 1, F.lit(0))),
                lambda b, i: F.struct(F.get("ch", i).alias("a"), b.alias("b")),
            )
        ).alias("p"),
    )
    counts = pairs.groupBy("y", "p.a", "p.b").count()
    counts = counts.filter(F.col("a").isin(*ALPHABET) & F.col("b").isin(*ALPHABET))
    seen = {(r["y"], r["a"], r["b"]): r["count"] for r in counts.collect()}
    table = []
    for a in ALPHABET:
        total = {y: sum(seen.get((y, a, b), 0) + 1 for b in ALPHABET) for y in (0, 1)}
        table += [
            math.log((seen.get((1, a, b), 0) + 1) / total[1])
            - math.log((seen.get((0, a, b), 0) + 1) / total[0])
            for b in ALPHABET
        ]
    return [round(x, 4) for x in table]


def log_ratio(token: Column, table: Column) -> Column:
    """Sum of the table's numbers over the pairs of neighbours in the token."""
    codes = F.transform(F.split(token, ""), lambda ch: F.position(ch, F.lit(ALPHABET)) - 1)
    zero = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))

    def step(state: Column, code: Column) -> Column:
        x = F.get(table, state["last"] * len(ALPHABET) + code)
        return F.struct(
            code.alias("last"),
            F.when(state["last"] < 0, state["sum"]).otherwise(state["sum"] + x).alias("sum"),
        )

    return F.aggregate(codes, zero, step, lambda state: state["sum"])


def _apart(rows: DataFrame, tokens: str, kinds: tuple[str, ...]) -> DataFrame:
    """`rows` with `__free`: the tokens that touch no span of the kinds, in one pass over all by start.

    Tokens do not overlap each other, nor do spans of a kind. So what touches a token from before is the
    span with the greatest end among those that start earlier, and from behind what starts next.
    """

    def each(column: str, own: int) -> Column:
        return F.transform(
            column,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(own).alias("own"), s["end"].alias("end"), s.alias("span")
            ),
        )

    every = F.array_sort(F.concat(each(tokens, 1), *[each(k, 0) for k in kinds]))
    step = rows.select("*", once(every).alias("__every"))
    taken = F.transform("__every", lambda x: F.when(x["own"] == 0, x["end"]).otherwise(F.lit(0)))
    step = step.select("*", once(taken).alias("__taken"))
    step = step.select("*", once(running_maxima(F.col("__taken"))).alias("__ends"))

    def free(x: Column, i: Column) -> Column:
        before = F.coalesce(F.get("__ends", i - 1), F.lit(0))
        behind = F.coalesce(F.get("__every", i + 1)["start"], x["end"])
        return (x["own"] == 1) & (before <= x["start"]) & (behind >= x["end"])

    found = F.transform(F.filter("__every", free), lambda x: x["span"])
    return step.select(*rows.columns, once(found).alias("__free"))


def find_secrets(
    docs: DataFrame, text_col: str = "text", table: list[float] | None = None
) -> DataFrame:
    """Add one array of (start, end, value) for each of KINDS, sorted by start.

    Base kinds are all matches of the patterns, an assigned value having 8 characters or more. Added
    are tokens with a letter and a digit that the models find random and that touch no base span.
    `table` is what `learn` returns; if it is not given, it is learned from the documents.
    """
    if table is None:
        table = learn(docs, text_col)
    row = docs.select(
        F.struct("*").alias("__row"), F.coalesce(F.col(text_col), F.lit("")).alias("__text")
    )
    guards = {"access": F.contains(F.col("__text"), F.lit("AKIA"))}
    found = locate(row, "__text", PATTERNS | {"random": TOKEN}, guards)

    def is_random(s: Column) -> Column:
        ratio = log_ratio(s["value"], F.col("__table"))
        likely = (ratio >= LEAST) & (ratio >= LEAST_EACH * F.char_length(s["value"]))
        return s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]") & likely

    kept = found.select(
        "__row",
        F.filter("assign", lambda s: s["value"].rlike(_LONG_VALUE)).alias("assign"),
        "access",
        "hex",
        "random",
        numbers(table, "double").alias("__table"),
    )
    kept = _apart(kept, "random", BASE)
    kept = kept.select("__row", *BASE, F.filter("__free", is_random).alias("random"))
    bare = [
        F.transform(
            k,
            lambda s: F.struct(
                s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")
            ),
        ).alias(k)
        for k in KINDS
    ]
    return kept.select(*[F.col(f"__row.`{c}`") for c in docs.columns if c not in KINDS], *bare)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with every secret replaced by its kind in brackets; overlapping ones become one.

    All columns stay, whatever their names; a null text stays null. Rows are independent of each other.
    """
    packed = docs.select(F.struct("*").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    spans = find_secrets(packed).select("doc", "text", once(in_order(KINDS)).alias("spans"))
    clean = cut(spans, "text", "spans")
    return clean.select(
        *[F.col(f"doc.`{c}`") if c != text_col else F.col("text").alias(text_col) for c in docs.columns]
    )


def report(docs: DataFrame) -> DataFrame:
    """Counts, digest and places of the secrets of each document, by doc_id."""
    found = find_secrets(docs.select("doc_id", "text"))

    def listed(kinds: tuple[str, ...]) -> Column:
        return F.concat_ws(
            ",",
            F.transform(
                in_order(kinds),
                lambda s: F.concat_ws(
                    ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
                ),
            ),
        )

    return found.select(
        "doc_id",
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in BASE],
        F.sha2(listed(BASE), 256).alias("base_sha256"),
        listed(KINDS).alias("spans"),
        F.size("random").cast("bigint").alias("n_random"),
    )
