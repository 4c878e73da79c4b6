"""Quality: a regularised quadratic discriminant over statistics of whole texts.

Each text becomes the transformed statistics in ``STATISTICS``: logarithms of counts, log odds
of shares. Either class has a mean and a covariance shrunk toward the pooled
one and toward its diagonal; their Cholesky factors are computed once and go with the model. The score is the
logistic of the difference of the classes' log densities (from the Mahalanobis distances) and
log priors: the probability of label 1.

Null texts are empty texts; an empty text has the statistics of no words and is scored like
any other. Equal texts score equal. With one class only, every text scores that class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from oreworks.llm import samples, texts

MAX_DOCUMENTS = 20_000  # labelled documents to fit on, at most
TOWARD_POOLED, TOWARD_DIAGONAL, FLOOR = 0.2, 0.05, 1e-3

STATISTICS = (
    "words", "word_bytes", "upper", "digits", "marks", "stops", "other_signs", "bars", "marked_words", "upper_words",
    "different_words", "repeats_next", "commonest", "line_words", "repeated_lines", "different_bytes",
)

# Kinds of bytes; all bytes outside ASCII belong to letters.
BLANK, LETTER, UPPER, DIGIT, STOP, BAR, SIGN = range(7)


def _kinds() -> np.ndarray:
    kind = np.full(256, LETTER, np.uint8)
    for byte in range(128):
        sign = chr(byte)
        if sign in " \t\n\r\x0b\x0c":
            kind[byte] = BLANK
        elif sign.isupper():
            kind[byte] = UPPER
        elif sign.isdigit():
            kind[byte] = DIGIT
        elif sign in ".,":
            kind[byte] = STOP
        elif sign in "|<>":
            kind[byte] = BAR
        elif not sign.isalpha():
            kind[byte] = SIGN
    return kind


KINDS = _kinds()


def _odds(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    part = np.clip(part, 0, whole)
    return np.log((part + 0.5) / (whole - part + 0.5 + 0.01 * whole))


def _different(text: np.ndarray, which: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """How many different things each text has, and how often its commonest occurs."""
    kinds = int(which.max(initial=0)) + 1
    pairs, often = np.unique(text * kinds + which, return_counts=True)
    owner = pairs // kinds
    most = np.zeros(n)
    np.maximum.at(most, owner, often)
    return np.bincount(owner, minlength=n).astype(float), most


def statistics(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The transformed statistics of each text, a row each."""
    data, at = texts.spaced(data, at, 0x0A)
    n, kind = len(at) - 1, KINDS[data]
    size = (np.diff(at) - 1).astype(float)
    total = {k: np.diff(np.concatenate(([0], np.cumsum(kind == k)))[at]).astype(float) for k in (LETTER, UPPER, DIGIT, STOP, BAR, SIGN)}
    letters = total[LETTER] + total[UPPER]

    starts, ends, found = texts.words(data, kind != BLANK)
    first = texts.per_text(starts, at)
    text = np.repeat(np.arange(n), np.diff(first))
    words = np.diff(first).astype(float)
    sign_at = np.concatenate(([0], np.cumsum(kind == SIGN)))
    upper_at = np.concatenate(([0], np.cumsum(kind == UPPER)))
    lower_at = np.concatenate(([0], np.cumsum((kind == LETTER) & (data < 0x80))))
    marked = sign_at[ends] > sign_at[starts]
    shouted = (upper_at[ends] - upper_at[starts] >= 1) & (lower_at[ends] == lower_at[starts])
    _, which = texts.distinct(found)
    different, commonest = _different(text, which, n)
    same = np.concatenate((which[1:] == which[:-1], [False])) if len(which) else np.zeros(0, bool)
    if len(first) > 2:
        lasts = first[1:-1] - 1
        same[lasts[lasts >= 0]] = False

    line_starts, _, found = texts.words(data, data != 0x0A)
    line_first = texts.per_text(line_starts, at)
    lines = np.diff(line_first).astype(float)
    _, line = texts.distinct(found)
    different_lines, _ = _different(np.repeat(np.arange(n), np.diff(line_first)), line, n)
    used = np.zeros((n, 256), bool)
    used[np.repeat(np.arange(n), np.diff(at)), data] = True

    return np.column_stack((
        np.log1p(words), np.log1p(size / np.maximum(words, 1)), _odds(total[UPPER], letters), _odds(total[DIGIT], size),
        _odds(total[SIGN], size), _odds(total[STOP], size), _odds(size - letters - total[DIGIT] - total[STOP] - words, size),
        _odds(total[BAR], size), _odds(texts.sums(marked, first), words), _odds(texts.sums(shouted, first), words),
        np.log((different + 1) / (np.sqrt(words) + 1)), _odds(texts.sums(same, first), words), _odds(commonest, words),
        np.log1p(words / np.maximum(lines, 1)), _odds(lines - different_lines, lines), np.log1p(used.sum(axis=1)),
    ))


def all_statistics(column: pa.Array) -> np.ndarray:
    found = [statistics(data, at) for data, at in texts.pieces(column)]
    return np.concatenate(found) if found else np.zeros((0, len(STATISTICS)))


@dataclass(frozen=True)
class Model:
    """Per class: mean, the inverse of the Cholesky factor, log of prior over root of determinant."""

    mean: np.ndarray
    inverse: np.ndarray
    level: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        density = [
            level - 0.5 * np.square((x - mean) @ inverse.T).sum(axis=1)
            for mean, inverse, level in zip(self.mean, self.inverse, self.level, strict=True)
        ]
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0], -500, 500)))

    def score(self, text: Column) -> Column:
        model = self

        @F.arrow_udf("double")
        def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for column in columns:
                yield pa.array(model.probabilities(all_statistics(column)), pa.float64())

        return score(text)


def discriminant(x: np.ndarray, label: np.ndarray) -> Model:
    """Fit on statistics and labels. Priors are the classes' shares; a class without rows has prior 0."""
    k = x.shape[1]
    groups = [x[label == c] for c in (0, 1)]
    scatter = [(g - g.mean(axis=0)).T @ (g - g.mean(axis=0)) if len(g) else np.zeros((k, k)) for g in groups]
    pooled = sum(scatter) / max(len(x) - 2, 1)
    mean, inverse, level = [], [], []
    for g, s in zip(groups, scatter, strict=True):
        # Few rows lean further on the pooled covariance.
        lean = max(TOWARD_POOLED, k / (k + len(g)))
        c = (1 - lean) * s / max(len(g) - 1, 1) + lean * pooled
        c = (1 - TOWARD_DIAGONAL) * c + TOWARD_DIAGONAL * np.diag(np.diag(c)) + FLOOR * np.eye(k)
        factor = np.linalg.cholesky(c)
        mean.append(g.mean(axis=0) if len(g) else np.zeros(k))
        inverse.append(np.linalg.inv(factor))
        prior = len(g) / len(x) if len(x) else 0.5
        level.append((np.log(prior) if prior else -1e6) - np.log(np.diag(factor)).sum())
    return Model(np.array(mean), np.array(inverse), np.array(level))


def fit(documents: DataFrame, labels: DataFrame, max_documents: int = MAX_DOCUMENTS) -> Model:
    """Learn from at most ``max_documents`` labelled documents outside the held-out fold; the driver
    gets a short row of numbers for each."""

    @F.arrow_udf("array<double>")
    def measured(column: pa.Array) -> pa.Array:
        found = all_statistics(column)
        return pa.array(list(found), pa.list_(pa.float64()))

    sample = samples.labelled(documents, labels, "quality", max_documents)
    seen = sample.select(measured("text").alias("x"), "label").toPandas()
    x = np.array(seen["x"].tolist(), float).reshape(len(seen), len(STATISTICS))
    return discriminant(x, seen["label"].to_numpy())


def score(documents: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``documents`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Columns of these names are replaced; all others stay as they are.
    """
    scored = documents.withColumn("score", model.score(F.col("text")))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
