"""Language identification by string kernels.

The kernel of two texts is the number of n-grams (n = 1 to SPECTRUM) present in both, divided by the root
of the product of their own numbers: a blended spectrum of presence bits. Landmarks stand for all texts
(Nyström): a text is known by its kernel with each of them. On that, one kernel ridge regression for each
language against the rest is fitted in closed form, on a bounded sample. Batches of texts are scored by
two matrix products: n-gram presence with the landmarks' presence, and that with the weights.

A text that is null or has no letter gets `und` and score 0. Repeated rows each get their own result. If
nothing can be learned, every text gets `und`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPECTRUM = 3
#: For each language at most so many texts are learned from, and so many are landmarks.
SAMPLE, LANDMARKS = 256, 32
#: Longer texts are learned from only in cells of the sample without shorter ones.
LONG = 20_000
RIDGE = 1e-3
UNKNOWN = "und"

#: Texts are cut into n-grams in pieces of so many characters.
_PIECE = 1 << 20
#: N-grams of a batch that are looked up at once.
_AT_ONCE = 1 << 18


def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


class Grams:
    """Distinct n-grams of texts as numbers. Anything but letters counts as one blank."""

    def __init__(self) -> None:
        self.letter = _letters()

    def of(self, text: str | None) -> np.ndarray:
        """Sorted; empty without a letter."""
        text = (text or "").lower()
        found = [
            self._piece(text[at : at + _PIECE + SPECTRUM - 1]) for at in range(0, len(text), _PIECE)
        ]
        found = [f for f in found if len(f)]
        if not found:
            return np.zeros(0, np.uint64)
        return np.unique(np.concatenate(found)) if len(found) > 1 else found[0]

    def _piece(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = self.letter[codes]
        if not letter.any():
            return np.zeros(0, np.uint64)
        codes = np.where(letter, codes, 32).astype(np.uint64)
        first = np.concatenate([[True], letter[1:] | letter[:-1]])
        codes = np.concatenate([[np.uint64(32)], codes[first], [np.uint64(32)]])
        # 21 bits hold a character
        grams, parts = codes, [codes]
        for n in range(2, SPECTRUM + 1):
            grams = (grams[:-1] << np.uint64(21)) | codes[n - 1 :]
            parts.append(grams)
        return np.unique(np.concatenate(parts))


@dataclass(frozen=True)
class Model:
    languages: list[str]
    vocabulary: np.ndarray  # the landmarks' n-grams, sorted
    presence: np.ndarray  # n-grams x landmarks, divided by the root of the landmark's number
    weights: np.ndarray  # landmarks x languages

    def kernels(self, texts: list[np.ndarray]) -> np.ndarray:
        """Texts x landmarks."""
        out = np.zeros((len(texts), self.presence.shape[1]), np.float32)
        start = 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and (end == start or size + len(texts[end]) <= _AT_ONCE):
                size += len(texts[end])
                end += 1
            grams = np.concatenate(texts[start:end])
            owner = np.repeat(np.arange(end - start), [len(t) for t in texts[start:end]])
            place = np.minimum(np.searchsorted(self.vocabulary, grams), len(self.vocabulary) - 1)
            known = self.vocabulary[place] == grams
            # the product of a sparse and a dense matrix: sum the rows of each text
            place, owner = place[known], owner[known]
            if len(place):
                edges = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                rows = [self.presence[part] for part in np.split(place, edges[1:])]
                out[start + owner[edges]] = [r.sum(axis=0) for r in rows]
            start = end
        norms = np.sqrt([max(1, len(t)) for t in texts]).astype(np.float32)
        return out / norms[:, None]

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        return self.kernels(texts) @ self.weights


def sample(rows: DataFrame, size: int = SAMPLE) -> list[tuple[str, str]]:
    """(lang, text) of up to `size` different texts of each language, from rows of lang and text.

    Texts are dealt into cells by their hash; from each cell the one with the lowest hash is taken, of
    the longer ones only if there is no shorter one. The number of languages is taken to be bounded.
    """
    long = F.char_length("text") > LONG
    h = F.xxhash64("text")
    hashed = rows.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text", long.alias("l"), h.alias("h"))
    cells = hashed.groupBy("lang", F.pmod("h", F.lit(size)).alias("cell"))
    chosen = cells.agg(
        F.min(F.when(~F.col("l"), F.col("h"))).alias("short"), F.min("h").alias("any")
    ).select(F.col("lang").alias("lang2"), F.coalesce("short", "any").alias("h2"))
    same = (F.col("lang") == F.col("lang2")) & (F.col("h") == F.col("h2"))
    found = hashed.join(F.broadcast(chosen), same).dropDuplicates(["lang", "h"])
    return sorted((r["lang"], r["text"]) for r in found.select("lang", "text").collect())


def fit(samples: list[tuple[str, str]], landmarks: int = LANDMARKS) -> Model | None:
    """The model of labelled texts; None if none has a letter."""
    grams = Grams()
    labelled = [(lang, g) for lang, text in samples if len(g := grams.of(text))]
    if not labelled:
        return None
    languages = sorted({lang for lang, _ in labelled})
    marks: list[np.ndarray] = []
    for language in languages:
        own = [g for lang, g in labelled if lang == language]
        # spread over the sorted sizes, so that short and long texts are among them
        own.sort(key=len)
        step = max(1, len(own) // landmarks)
        marks += own[::step][:landmarks]
    vocabulary = np.unique(np.concatenate(marks))
    presence = np.zeros((len(vocabulary), len(marks)), np.float32)
    for k, mark in enumerate(marks):
        presence[np.searchsorted(vocabulary, mark), k] = 1 / np.sqrt(len(mark))
    bare = Model(languages, vocabulary, presence, np.zeros((len(marks), 0), np.float32))
    among = bare.kernels(marks).astype(np.float64)
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])  # K^(-1/2), so that features have the kernel
    features = bare.kernels([g for _, g in labelled]) @ root
    wanted = np.array([[lang == language for language in languages] for lang, _ in labelled], float)
    # every language counts alike, however many samples it has
    counts = wanted.sum(axis=0)
    weight = 1 / counts[wanted.argmax(axis=1)]
    left = features.T @ (features * weight[:, None])
    ridge = RIDGE * np.trace(left) / len(left) * np.eye(len(left))
    solved = np.linalg.solve(left + ridge, features.T @ (wanted * weight[:, None]))
    return Model(languages, vocabulary, presence, (root @ solved).astype(np.float32))


def identify(
    docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Add lang_pred and score, from 0 to 1: the regression's value for the language, cut to that.

    `keep` names the input columns to carry, all by default; those named like results are replaced.
    """
    carried = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    # a broadcast carries plain arrays, so that executors need not know this class beforehand
    parts = model and (model.languages, model.vocabulary, model.presence, model.weights)
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        grams, model = Grams(), shared.value and Model(*shared.value)
        for batch in batches:
            texts = [grams.of(t) for t in batch]
            some = np.array([model is not None and len(t) > 0 for t in texts], bool)
            names = np.full(len(texts), UNKNOWN, object)
            best = np.zeros(len(texts))
            if some.any():
                scores = model.scores([t for t, s in zip(texts, some, strict=True) if s])
                names[some] = np.array(model.languages, object)[scores.argmax(axis=1)]
                best[some] = np.clip(scores.max(axis=1), 0, 1)
            yield pd.DataFrame({"lang_pred": names, "score": best})

    predict = F.pandas_udf(run, "lang_pred string, score double")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"), predict(F.col(f"`{text_col}`")).alias("v")
    )
    return rows.select(*[F.col(f"row.`{c}`") for c in carried], "v.lang_pred", "v.score")


def held_out(key: str = "doc_id") -> Column:
    """Whether a document is kept from learning: CRC-32 of its id as text has remainder 1 by 3."""
    crc = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")))
    return crc % 3 == 1


def report(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out, and predict the language of all."""
    rows = docs.select("doc_id", held_out().alias("held_out"), "text", "lang")
    model = fit(sample(rows.filter(~F.col("held_out")).select("lang", "text")))
    return identify(rows, model, keep=["doc_id", "held_out"])
