"""Toxicity: a support vector machine over gappy subsequences of words, with Nyström landmarks.

A word, with a mark at either end, is compared to another by the subsequences of three
symbols they share, each weighed by ``DECAY`` to the power of the span it takes, up to
``SPAN`` symbols. So ``idXiot`` still shares most of ``idiot``. The kernel between two
words is normalised by what a word of that length without repeats would give with itself.

Training takes the sentences of labelled documents (``fit``): words that stand almost only
in sentences of toxic documents are witnesses, each with some spellings in which a symbol is
inserted; words of clean sentences are the other class. Both are mapped through Nyström
landmarks and a linear machine with squared hinge loss is trained there; clean words that it
takes for insults are added as further examples. There are two such machines. The first is
linear in the kernel, hence in the subsequences: it folds into one weight for each, so that it
costs the same for any number of landmarks. It sieves: what lies below all witnesses and all their
spellings with one symbol inserted, by ``SLACK`` and more, has the least margin. The second uses the radial kernel of the same space on the words
left. A document's margin is the largest of its words' margins; its score a logistic of that.

Letters are taken without case and in their plain form (full-width, mathematical, circled ones), common look-alikes, digits and signs as well as Greek and
Cyrillic letters, as the letters they stand for; letters beyond the first two planes are one symbol; other signs inside a word are dropped, and letters set apart by blanks
(three or more single ones) are one word. Null and empty texts, and texts without words,
have the smallest score the calibration gives. Whole texts are read; equal texts score equal.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from oreworks.llm import samples, texts

SPAN = 5  # symbols that a subsequence of three may stretch over
DECAY = 0.7
SYMBOLS = 64
BLANK, DROPPED, MARK = 0, 255, 63
MAX_DOCUMENTS = 20_000  # labelled documents to fit on, at most
LANDMARKS = 256
WITNESSES, CLEAN_WORDS, HARD_WORDS = 600, 12_000, 2_000  # words that the driver gets, at most
HARMLESS = -1.0  # least margin, that of a text without words too
WIDTH = 4.0  # of the radial kernel
PENALTY = 1e-4
SLACK = 0.1  # of the first machine's margin, below the lowest of all witnesses and spellings
VARIANTS = 3  # spellings with one symbol inserted that each witness is trained with

LETTERS = [bytes([i]) for i in range(1, 27)]  # as symbols
# Look-alike signs and the letters they stand for (fixed values).
LOOK_ALIKES = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h",
    "α": "a", "ο": "o", "ρ": "p", "υ": "u", "ι": "i", "ν": "v",
}
POINTS = 1 << 17  # code points with a symbol of their own


def _symbol_table() -> np.ndarray:
    """The symbol of each code point of the first two planes, and in the last place that of all others: 1 to 26 letters, 27 to 62
    others, 0 blank, 255 dropped."""
    table = np.full(POINTS + 1, DROPPED, np.uint8)
    for point in range(POINTS):
        sign = chr(point)
        plain = unicodedata.normalize("NFKC", sign) if point >= 0x80 else sign
        lower = (plain if len(plain) == 1 else sign).lower()[0]
        lower = LOOK_ALIKES.get(lower, lower)
        if sign.isspace():
            table[point] = BLANK
        elif "a" <= lower <= "z":
            table[point] = ord(lower) - ord("a") + 1
        elif sign.isalnum():
            table[point] = 27 + ord(lower) % 36
    table[0] = BLANK
    table[POINTS] = 27
    return table


def words_of(data: np.ndarray, at: np.ndarray, table: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts as strings of symbols, and the first word of each text."""
    data, at = texts.spaced(data, at)
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    # Where a text begins, counted in code points.
    heads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[at]
    symbols = table[np.minimum(points, POINTS)]
    kept = symbols != DROPPED
    heads = np.concatenate(([0], np.cumsum(kept)))[heads]
    symbols = symbols[kept]
    starts, ends = texts.runs(symbols != BLANK)
    single = ends - starts == 1
    if single.any():
        # Runs of three or more single letters in one text become one word.
        text = np.searchsorted(heads, starts, "right")
        first, last = texts.runs(np.concatenate((single[1:] & single[:-1] & (text[1:] == text[:-1]), [False])))
        first, last = first[last - first >= 2], last[last - first >= 2]
        if len(first):
            gone = np.zeros(len(symbols), bool)
            inner = np.zeros(len(starts) + 1, np.int64)
            np.add.at(inner, first, 1)
            np.add.at(inner, last, -1)
            joined = np.flatnonzero(np.cumsum(inner)[:-1] > 0)
            gaps = starts[joined + 1] - ends[joined]
            gone[texts.spans(ends[joined], gaps)] = True
            heads = heads - np.concatenate(([0], np.cumsum(gone)))[heads]
            symbols = symbols[~gone]
    starts, _, found = texts.words(symbols, symbols != BLANK)
    return found, texts.per_text(starts, heads)


def subsequences(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each pair of offsets: the words, the subsequences' codes and their weight."""
    data, at = texts.utf8(words)
    data, at = texts.spaced(data, at, MARK)
    word = np.repeat(np.arange(len(at) - 1), np.diff(at))
    end = at[1:][word]
    symbols = data.astype(np.int64)
    for far in range(2, SPAN):
        # The end mark is one position behind the last symbol.
        fits = np.flatnonzero(np.arange(len(data)) + far <= end)
        behind = np.minimum(fits + far, len(data) - 1)
        third = np.where(fits + far == end[fits], MARK, symbols[behind])
        for near in range(1, far):
            yield word[fits], (symbols[fits] * SYMBOLS + symbols[fits + near]) * SYMBOLS + third, DECAY ** (far + 1)


def lengths(words: pa.Array) -> np.ndarray:
    """The root of the kernel of a word with itself, were no subsequence repeated: a matter of its length alone."""
    _, at = texts.utf8(words)
    length = np.diff(at) + 2
    total = np.zeros(len(length))
    for far in range(2, SPAN):
        total += np.maximum(length - far, 0) * (far - 1) * DECAY ** (2 * (far + 1))
    return np.sqrt(np.maximum(total, 1e-12))


def itself(words: pa.Array) -> np.ndarray:
    """The root of the kernel of a word with itself."""
    parts = list(subsequences(words))
    key = np.concatenate([word * SYMBOLS**3 + code for word, code, _ in parts])
    value = np.concatenate([np.full(len(word), weight) for word, _, weight in parts])
    different, which = np.unique(key, return_inverse=True)
    total = np.bincount(which, value, len(different))
    return np.sqrt(np.maximum(np.bincount(different // SYMBOLS**3, total * total, len(words)), 1e-12))


class Landmarks:
    """Words that others are compared to."""

    def __init__(self, words: pa.Array):
        self.parts = list(subsequences(words))
        codes = np.unique(np.concatenate([code for _, code, _ in self.parts]))
        self.row = np.full(SYMBOLS**3, len(codes), np.int32)
        self.row[codes] = np.arange(len(codes))
        self.table = np.zeros((len(codes) + 1, len(words)))
        for word, code, weight in self.parts:
            np.add.at(self.table, (self.row[code], word), weight)
        self.table[-1] = 0
        self.table = self.table.astype(np.float32)
        self.lengths, self.itself = lengths(words), itself(words)

    def shared(self, words: pa.Array, block: int = 256) -> np.ndarray:
        """The weight of what each word shares with each landmark."""
        out = np.zeros((len(words), self.table.shape[1]))
        for first in range(0, len(words), block):
            some = words.slice(first, block)
            parts = list(subsequences(some))
            cell = np.concatenate([word * len(self.table) + self.row[code] for word, code, _ in parts])
            value = np.concatenate([np.full(len(word), weight) for word, _, weight in parts])
            dense = np.bincount(cell, value, len(some) * len(self.table)).astype(np.float32)
            out[first : first + len(some)] = dense.reshape(len(some), -1) @ self.table
        return out

    def linear(self, words: pa.Array) -> np.ndarray:
        return self.shared(words) / lengths(words)[:, None] / self.lengths

    def radial(self, words: pa.Array) -> np.ndarray:
        """exp of minus the squared distance of the normalised words in subsequence space, times ``WIDTH / 2``."""
        cosine = self.shared(words) / itself(words)[:, None] / self.itself
        return np.exp(WIDTH * (cosine - 1))


def whitened(kernel: np.ndarray) -> np.ndarray:
    """What maps kernels with the landmarks to Nyström features."""
    values, vectors = np.linalg.eigh((kernel + kernel.T) / 2)
    lead = values > 1e-6 * values.max()
    return vectors[:, lead] / np.sqrt(values[lead])


def machine(features: np.ndarray, sign: np.ndarray, weight: np.ndarray, penalty: float, rounds: int = 40) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton's method; the last coefficient is the offset."""
    x = np.column_stack((features, np.ones(len(features))))
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-9
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        on = 1 - sign * (x @ w) > 0
        h = (x[on] * weight[on, None]).T @ x[on] + np.diag(ridge)
        new = np.linalg.solve(h, (x[on] * weight[on, None]).T @ sign[on])
        if np.abs(new - w).max() < 1e-7:
            break
        w = new
    return w[:-1], float(w[-1])


@dataclass(frozen=True)
class Model:
    symbol_table: np.ndarray
    weights: np.ndarray  # of the first machine, by subsequence
    offset: float
    gate: float  # margin of the first machine from which the second one is asked
    landmarks: Landmarks | None = None
    coefficients: np.ndarray | None = None
    second_offset: float = 0.0
    slope: float = 1.0
    intercept: float = 0.0

    def first_margins(self, words: pa.Array) -> np.ndarray:
        total = np.zeros(len(words))
        for word, code, weight in subsequences(words):
            total += weight * np.bincount(word, self.weights[code], len(words))
        return total / lengths(words) + self.offset

    def word_margins(self, words: pa.Array) -> np.ndarray:
        passed = np.flatnonzero(self.first_margins(words) >= self.gate)
        out = np.full(len(words), HARMLESS)
        if self.landmarks is not None and len(passed):
            close = self.landmarks.radial(words.take(pa.array(passed)))
            out[passed] = np.maximum(close @ self.coefficients + self.second_offset, HARMLESS)
        return out

    def margins(self, column: pa.Array) -> np.ndarray:
        out = []
        for data, at in texts.pieces(column):
            words, first = words_of(data, at, self.symbol_table)
            different, which = texts.distinct(words)
            out.append(texts.largest(self.word_margins(different)[which], first, HARMLESS))
        return np.concatenate(out) if out else np.zeros(0)

    def probabilities(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.intercept, -40, 40)))

    def score(self, text: Column) -> Column:
        """The score of each text, as a column."""
        model = self

        @F.arrow_udf("double")
        def score(column: pa.Array) -> pa.Array:
            return pa.array(model.probabilities(model.margins(column)), pa.float64())

        return score(text)


def _sentence_words(table: np.ndarray) -> Callable:
    @F.arrow_udf("array<binary>")
    def words(column: pa.Array) -> pa.Array:
        values, at, count = [], [np.zeros(1, np.int64)], 0
        for data, offsets in texts.pieces(column):
            found, first = words_of(data, offsets, table)
            values.append(found.cast(pa.binary()))
            at.append(first[1:] + count)
            count += len(found)
        flat = pa.concat_arrays(values) if values else pa.array([], pa.binary())
        return pa.ListArray.from_arrays(pa.array(np.concatenate(at), pa.int32()), flat)

    return words


def _word_counts(sample: DataFrame, table: np.ndarray) -> DataFrame:
    """In how many different sentences of toxic and of clean documents each word stands."""
    sentences = (
        sample.select(F.explode(F.split(F.coalesce("text", F.lit("")), r"[.!?\n]+")).alias("sentence"), "label")
        .groupBy("sentence")
        .agg(F.min("label").alias("label"))
    )
    words = sentences.select(F.explode(F.array_distinct(_sentence_words(table)("sentence"))).alias("word"), "label")
    return words.groupBy("word").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))


def _calibrate(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on the margin, with a little ridge, by Newton's method."""
    x = np.column_stack((margin, np.ones(len(margin))))
    b = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -40, 40)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (label - p) - 1e-2 * (b - [1.0, 0.0]))
        b = b + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(b[0], 1e-3)), float(b[1])


def _binary(rows: list) -> pa.Array:
    return pa.array([bytes(r[0]) for r in rows], pa.large_binary())


def _with_variants(witnesses: list) -> tuple[pa.Array, np.ndarray]:
    """The witnesses and spellings of them with one symbol inserted, and what each weighs."""
    random = np.random.default_rng(7)
    words, weight = [bytes(r[0]) for r in witnesses], [np.sqrt(r[1]) for r in witnesses]
    for word, w in list(zip(words, weight, strict=True)):
        for _ in range(VARIANTS if len(word) > 1 else 0):
            cut = int(random.integers(1, len(word)))
            words.append(word[:cut] + bytes([int(random.integers(1, 27))]) + word[cut:])
            weight.append(w / VARIANTS)
    return pa.array(words, pa.large_binary()), np.array(weight)


def _inserted(words: pa.Array) -> pa.Array:
    """The words and all spellings of them with one letter inserted."""
    given = [w for w in words.to_pylist() if w]
    return pa.array(sorted({w[:cut] + letter + w[cut:] for w in given for cut in range(1, len(w)) for letter in LETTERS} | set(given)), pa.large_binary())


def _machines(table: np.ndarray, witnesses: list, frequent: pa.Array, others: pa.Array, clean_words: DataFrame) -> Model:
    """The first machine, linear in the string kernel and so folded into one weight per subsequence, sieves; the
    second, on the radial kernel of the same space, decides on what passes."""
    toxic, toxic_weight = _with_variants(witnesses)
    half = LANDMARKS // 2

    def trained(mapped: Callable, clean: pa.Array, hard: list[pa.Array], penalty: float) -> tuple[np.ndarray, float]:
        """Either class weighs the same; of the clean one, each set of hard words as much as all others."""
        sets = [clean, *[h for h in hard if len(h)]]
        features = np.vstack([mapped(x) for x in (toxic, *sets)])
        sign = np.concatenate((np.ones(len(toxic)), -np.ones(sum(map(len, sets)))))
        shares = [np.full(len(x), 0.5 / len(sets) / len(x)) for x in sets]
        return machine(features, sign, np.concatenate((toxic_weight / toxic_weight.sum() / 2, *shares)), penalty)

    def hardest(model: Model, margins: Callable, limit: int = HARD_WORDS) -> pa.Array:
        @F.arrow_udf("double")
        def margin(words: pa.Array) -> pa.Array:
            return pa.array(margins(model, words.cast(pa.large_binary())), pa.float64())

        ranked = clean_words.withColumn("margin", margin("word")).where(F.col("margin") >= model.gate)
        return _binary(ranked.orderBy(F.desc("margin"), "word").limit(limit).collect())

    words = pa.concat_arrays([toxic.slice(0, min(half, len(witnesses))), frequent.slice(0, half)])
    landmarks = Landmarks(words)
    white = whitened(landmarks.linear(words))
    clean = pa.concat_arrays([frequent, others]).unique()
    w, offset = trained(lambda x: landmarks.linear(x) @ white, clean, [], 1e-4)
    alpha = (white @ w) / landmarks.lengths
    weights = np.zeros(SYMBOLS**3)
    for word, code, part in landmarks.parts:
        np.add.at(weights, code, alpha[word] * part)
    first = Model(table, weights.astype(np.float32), offset, -np.inf)
    gate = float(first.first_margins(_inserted(toxic.slice(0, len(witnesses)))).min()) - SLACK
    first = replace(first, gate=gate)

    hard = hardest(first, Model.first_margins)
    words = pa.concat_arrays([toxic.slice(0, min(half, len(witnesses))), (hard if len(hard) else frequent).slice(0, half)])
    landmarks = Landmarks(words)
    white = whitened(landmarks.radial(words))
    model, found = first, [hard]
    for last in (False, False, True):
        w, offset = trained(lambda x: landmarks.radial(x) @ white, clean, found, PENALTY)
        model = replace(first, landmarks=landmarks, coefficients=white @ w, second_offset=offset)
        if not last:
            found.append(hardest(model, Model.word_margins, 100))
    return model


def fit(documents: DataFrame, labels: DataFrame, max_documents: int = MAX_DOCUMENTS) -> Model:
    """Learn from at most ``max_documents`` labelled documents outside the held-out fold.

    The driver gets a bounded number of words and one margin and label per sampled
    document. Without toxic or without clean examples every text scores 0.
    """
    table = _symbol_table()
    never = Model(table, np.zeros(SYMBOLS**3, np.float32), 0.0, 1.0, slope=0.0, intercept=-40.0)
    sample = samples.labelled(documents, labels, "toxic", max_documents)
    counts = _word_counts(sample, table).persist()
    try:
        share, n = counts.agg(F.sum("toxic") / F.sum(F.col("toxic") + F.col("clean")), F.count("*")).first()
        if not share or share >= 1:
            return never
        # Words whose sentences are toxic so often that chance explains none of them.
        evidence = F.col("toxic") * -np.log(share) + F.col("clean") * 4 * np.log(share)
        is_clean = F.expr("clean > 0 and toxic <= 4 * clean")
        witnesses = counts.where(evidence >= np.log(n) + 1).orderBy(evidence.desc(), "word").limit(WITNESSES).select("word", evidence).collect()
        frequent = counts.where(is_clean).orderBy(F.desc("clean"), "word").limit(CLEAN_WORDS // 4).collect()
        others = counts.where(is_clean).orderBy(F.xxhash64("word"), "word").limit(CLEAN_WORDS).collect()
        if not witnesses or not frequent:
            return never
        model = _machines(table, witnesses, _binary(frequent), _binary(others), counts.where(is_clean))
    finally:
        counts.unpersist()

    @F.arrow_udf("double")
    def margins(column: pa.Array) -> pa.Array:
        return pa.array(model.margins(column), pa.float64())

    seen = sample.select(margins("text").alias("margin"), "label").toPandas()
    slope, intercept = _calibrate(seen["margin"].to_numpy(), seen["label"].to_numpy().astype(float))
    return replace(model, slope=slope, intercept=intercept)


def score(documents: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``documents`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Columns of these names are replaced; all others stay as they are.
    """
    scored = documents.withColumn("score", model.score(F.col("text")))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
