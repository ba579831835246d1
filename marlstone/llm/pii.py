"""Personal data: patterns propose spans, checksums confirm them, context words move the score.

Built-in functions only. A null text counts as empty and has no spans; repeated rows each get their
own result; an empty table gives an empty one. All columns of the input stay, except one that is
named like a result, which the result replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.spans import cut, in_order, locate, once, written

#: A start that can only be the first of its run, or right behind the match before. Without it each
#: character of a long run would be tried in turn.
_RUN = r"(?:(?<![{0}])|\G)"
_LOCAL = r"A-Za-z0-9._%+-"

#: The base patterns. Runs are possessive, so that long ones need no recursion; card
#: runs outside 13 to 19 digits are passed over whole.
PATTERNS = {
    "email": _RUN.format(_LOCAL) + rf"[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _RUN.format("0-9") + r"[0-9]++(?:\.[0-9]++){3}+",
    "digits": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}+"
    r"|(?:\x20[A-Z0-9]{4}){2,7}+(?:\x20[A-Z0-9]{1,3})?+)(?![A-Za-z0-9])",
}
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "card_short")
KINDS = BASE + ADDED

_OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_OCTETS = rf"^(?:{_OCTET.replace('0*+', '0*')}\.){{3}}{_OCTET.replace('0*+', '0*')}$"

#: Score of a confirmed span without context; a context word of the kind adds, a counter-word takes.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "card_short": 0.4}
STEP = 0.2
#: Added kinds are reported from this score on; base kinds always.
LEAST = 0.5
CONTEXT_WORDS = {
    "email": "e-?mail|contact|kontakt|correo|courriel",
    "ip": r"ip|address|adresse|host|server|serveur|servidor",
    "card": "card|visa|credit|karte|carte|tarjeta|payment",
    "phone": "phone|tel|call|mobile|telefon|telefono",
    "iban": "iban|account|konto|compte|cuenta|bank",
    "card_short": "card|visa|amex|credit|karte|carte|tarjeta|payment",
}
COUNTER_WORDS = {
    "email": "example only",
    "ip": "version|release|section",
    "card": "order|isbn|serial|tracking",
    "phone": "isbn|serial|tracking",
    "iban": "serial|tracking",
    "card_short": "order|isbn|serial|tracking",
}


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def step(total: Column, i: Column) -> Column:
        d = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        doubled = F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, doubled).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number without blanks has remainder 1 when its parts are swapped."""
    turned = F.concat(F.substr(iban, F.lit(5)), F.left(iban, F.lit(4)))

    def step(rest: Column, ch: Column) -> Column:
        code = F.ascii(ch)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise(
            (rest * 10 + code - 48) % 97
        )

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _scored(kind: str, spans: Column) -> Column:
    def near(words: str, s: Column) -> Column:
        pattern = rf"(?i)\b(?:{words})\b"
        return s["before"].rlike(pattern) | s["after"].rlike(pattern)

    def score(s: Column) -> Column:
        up = F.when(near(CONTEXT_WORDS[kind], s), STEP).otherwise(0.0)
        down = F.when(near(COUNTER_WORDS[kind], s), STEP).otherwise(0.0)
        return F.round(F.least(F.lit(1.0), F.lit(PRIOR[kind]) + up - down), 3)

    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            s["value"].alias("value"),
            score(s).alias("score"),
        ),
    )


def find_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add one array of (start, end, value, score) for each of KINDS, sorted by start.

    Base kinds are all matches that pass their check (parts up to 255, 16 to 19 digits with Luhn, 8 to
    15 digits). Added are account numbers that pass mod-97 and shorter card numbers (13 to 15 digits,
    Luhn) that stand near a context word.
    """
    row = docs.select(
        F.struct("*").alias("__row"), F.coalesce(F.col(text_col), F.lit("")).alias("__text")
    )
    row = row.select("*", F.col("__text").rlike("[0-9]").alias("__digit"))
    digit = F.col("__digit")
    guards = {
        "email": F.contains(F.col("__text"), F.lit("@")),
        "phone": F.contains(F.col("__text"), F.lit("+")),
        "ip": digit,
        "digits": digit,
        "iban": digit,
    }
    found = locate(row, "__text", PATTERNS, guards)
    n = F.length
    kept = {
        "email": F.col("email"),
        "ip": F.filter("ip", lambda s: s["value"].rlike(_OCTETS)),
        "card": F.filter(
            "digits",
            lambda s: (n(_digits(s["value"])) >= 16) & luhn(_digits(s["value"])),
        ),
        "phone": F.filter("phone", lambda s: n(_digits(s["value"])).between(8, 15)),
        "iban": F.filter("iban", lambda s: mod97(F.replace(s["value"], F.lit(" "), F.lit("")))),
        "card_short": F.filter(
            "digits",
            lambda s: (n(_digits(s["value"])) < 16) & luhn(_digits(s["value"])),
        ),
    }
    kept_docs = found.select("__row", *[kept[k].alias(k) for k in KINDS])
    scored = kept_docs.select("__row", *[_scored(k, F.col(k)).alias(k) for k in KINDS])
    sure = [
        F.filter(k, lambda s: s["score"] >= LEAST).alias(k) if k in ADDED else F.col(k)
        for k in KINDS
    ]
    return scored.select(*[F.col(f"__row.`{c}`") for c in docs.columns if c not in KINDS], *sure)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in brackets; overlapping spans become one."""
    packed = docs.select(F.struct("*").alias("doc"), F.col(text_col).alias("text"))
    spans = find_pii(packed).select("doc", "text", once(in_order(KINDS)).alias("spans"))
    clean = cut(spans, "text", "spans")
    return clean.select(
        *[F.col(f"doc.`{c}`") if c != text_col else F.col("text").alias(text_col) for c in docs.columns]
    )


def report(docs: DataFrame) -> DataFrame:
    """Counts, digest and places of the spans of each document, by doc_id."""
    found = find_pii(docs.select("doc_id", "text"))
    lists = dict(zip(KINDS, written(KINDS), strict=True))
    scores = F.flatten(F.array(*[F.transform(k, lambda s: s["score"]) for k in KINDS]))
    named = found.select(
        "doc_id",
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.concat_ws(",", *[lists[k] for k in BASE]).alias("base"),
        F.concat_ws(",", *[lists[k] for k in KINDS]).alias("spans"),
        F.concat_ws(",", F.transform(scores, lambda x: x.cast("string"))).alias("scores"),
    )
    return named.select(
        "doc_id",
        *[f"n_{k}" for k in BASE],
        F.sha2("base", 256).alias("base_sha256"),
        "spans",
        *[f"n_{k}" for k in ADDED],
        "scores",
    )
