"""Quality rules as a short-circuit cascade, ordered by what a sample tells of their cost.

A rule looks at a text and says whether to reject it. On a sample of the texts each rule's cost and
rejections are measured; the rules then run in the order of rejections per cost, and a text leaves the
cascade at the first that rejects it. A verdict is the same in any order; the order saves work only.

A null text counts as empty and has no words. Repeated rows each get their own result.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What separates words, symbols, and the base rules' numbers.
BLANKS = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20

#: Texts are split into words in pieces of about so many bytes.
PIECE = 4 << 20
#: Rules are measured on at most so many texts.
SAMPLE = 256


class Text:
    """A text with what the rules count, each counted once and only when asked for."""

    def __init__(self, text: str | None):
        self.raw = (text or "").encode("utf-8", "surrogatepass")

    def __getattr__(self, name: str):
        value = getattr(type(self), f"count_{name}")(self)
        setattr(self, name, value)
        return value

    def words(self) -> Iterator[list[bytes]]:
        raw, at = self.raw, 0
        while at < len(raw):
            end = at + PIECE
            while end < len(raw) and raw[end] not in BLANKS:
                end += 1
            yield raw[at:end].split()
            at = end

    def count_word_ids(self) -> np.ndarray:
        ids: dict[bytes, int] = {}
        parts = [
            np.fromiter((ids.setdefault(w, len(ids)) for w in piece), np.int64, len(piece))
            for piece in self.words()
        ]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def count_n_words(self) -> int:
        return len(self.word_ids)

    def count_solid(self) -> bytes:
        return self.raw.translate(None, BLANKS)

    def count_word_chars(self) -> int:
        b = np.frombuffer(self.solid, np.uint8)
        return int(np.count_nonzero((b & 0xC0) != 0x80))

    def count_n_symbols(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, SYMBOLS))

    def count_lines(self) -> list[bytes]:
        return [line for line in self.raw.split(b"\n") if line.strip(BLANKS)]

    def count_n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    def count_n_repeat_words(self) -> int:
        ids = self.word_ids
        if len(ids) <= WINDOW:
            return 0
        # a number for each window, made from numbers of shorter ones that fit 64 bits
        code, width = ids, 1
        for more in (1, 2, 1):
            other = ids if more == 1 else code
            code = code[: len(ids) - width - more + 1] * (int(other.max()) + 1) + other[width:]
            width += more
            _, code = np.unique(code, return_inverse=True)
        repeated = np.flatnonzero(np.bincount(code)[code] > 1)
        edges = np.zeros(len(ids) + 1, np.int64)
        edges[repeated] += 1
        edges[repeated + WINDOW] -= 1
        return int(np.count_nonzero(np.cumsum(edges)))

    def count_letters(self) -> tuple[int, int]:
        """Letters, and upper-case letters among them, of ASCII."""
        b = np.frombuffer(self.solid, np.uint8)
        upper = int(np.count_nonzero((b >= 65) & (b <= 90)))
        return upper + int(np.count_nonzero((b >= 97) & (b <= 122))), upper

    def count_n_bare_words(self) -> int:
        """Words without a letter or a character beyond ASCII."""
        keep = bytes(c for c in range(256) if c >= 128 or chr(c).isalpha())
        drop = bytes(c for c in range(256) if c not in keep)
        return sum(not w.translate(None, drop) for piece in self.words() for w in piece)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


BASE_RULES = (
    Rule("few_words", lambda t: t.n_words < MIN_WORDS),
    Rule("repeats", lambda t: 100 * t.n_repeat_words > MAX_REPEAT_PERCENT * t.n_words),
)
MORE_RULES = (
    Rule("symbols", lambda t: t.n_symbols > 0.1 * t.n_words),
    Rule("dup_lines", lambda t: t.n_dup_lines > 0.4 * len(t.lines)),
    Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 15 * t.n_words),
    Rule("capitals", lambda t: t.letters[1] > 0.5 * t.letters[0]),
    Rule("bare_words", lambda t: t.n_bare_words > 0.3 * t.n_words),
)
RULES = BASE_RULES + MORE_RULES


def measure(texts: Sequence[str | None], rules: Sequence[Rule]) -> list[tuple[Rule, float, float]]:
    """(rule, seconds for a text, share of texts rejected), each rule on its own."""
    found = []
    for rule in rules:
        start = time.perf_counter()
        rejected = sum(rule.rejects(Text(t)) for t in texts)
        n = max(1, len(texts))
        found.append((rule, (time.perf_counter() - start) / n, rejected / n))
    return found


def plan(texts: Sequence[str | None], rules: Sequence[Rule] = RULES) -> list[Rule]:
    """The rules by falling rejections per second."""
    measured = measure(texts, rules)
    return [m[0] for m in sorted(measured, key=lambda m: -m[2] / max(m[1], 1e-9))]


def sample(docs: DataFrame, text_col: str = "text", size: int = SAMPLE) -> list[str | None]:
    """Up to `size` different texts: the one with the lowest hash in each of as many cells."""
    texts = docs.select(F.col(f"`{text_col}`").alias("text"))
    h = F.xxhash64("text")
    cells = texts.select(h.alias("h")).groupBy(F.pmod("h", F.lit(size)).alias("cell"))
    chosen = F.broadcast(cells.agg(F.min("h").alias("h")).select("h"))
    found = texts.select(h.alias("h"), "text").join(chosen, "h").dropDuplicates(["h"])
    return [r["text"] for r in found.collect()]


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def cascade(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    text_col: str = "text",
    counts: bool = False,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add `kept` and `rejected_by`, the first rule in the chosen order that rejects the text.

    With `counts`, also COUNTS, which then are counted for rejected texts too. `keep` names the input
    columns to carry, all by default; those named like results are replaced.
    """
    order = plan(sample(docs, text_col), rules)
    added = {"kept": "boolean", "rejected_by": "string"}
    added |= dict.fromkeys(COUNTS, "bigint") if counts else {}
    carried = [c for c in (docs.columns if keep is None else keep) if c not in added]
    row = docs.select(F.struct("*").alias("row"), F.col(f"`{text_col}`").alias("text"))
    carried_row = F.struct(*[F.col(f"row.`{c}`").alias(c) for c in carried])
    row = row.select(carried_row.alias("row"), "text")

    def judge(text: str | None) -> tuple:
        t = Text(text)
        by = next((r.name for r in order if r.rejects(t)), None)
        return (by is None, by, *([getattr(t, c) for c in COUNTS] if counts else ()))

    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([judge(t) for t in texts], columns=list(added))

    returns = ", ".join(f"{name} {kind}" for name, kind in added.items())
    judged = row.select("row", F.pandas_udf(run, returns)("text").alias("v"))
    return judged.select(
        *[F.col(f"row.`{c}`") for c in carried], *[F.col(f"v.`{c}`") for c in added]
    )


def report(docs: DataFrame) -> DataFrame:
    """The counts, the base verdict and the cascade's verdict of each document, by doc_id."""
    judged = cascade(docs, counts=True, keep=["doc_id"])
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return judged.select(
        "doc_id",
        *COUNTS,
        failed.alias("base_failed"),
        (F.col("kept") & ~failed).alias("kept"),
    )
