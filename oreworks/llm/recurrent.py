"""Language-model scoring by a gated recurrent network with a class-factored softmax.

Words are lower-cased (A-Z) runs of anything but white space; a text ends with one end token, which is a token
like any other. The distribution covers the types of the training documents and one more type, which stands
for every word they do not hold, so it sums to one over the same types as the add-one unigram base beside it.

Training counts every word of every training document (words combined in each task, then by Spark, then written).
The words are then factored by frequency: the most frequent ``HEAD_WORDS`` fall into classes of ``CLASS_WORDS`` with a
softmax each, other words of the lexicon into classes by the power of two of their count, all remaining words
into one class, and the end is a class of its own. The network tells the class from its state, and a head word within its
class; within the other classes words go by their counts plus one. The lexicon holds at most ``LEXICON_WORDS``
words (above the least count that leaves so few) and is the only thing broadcast; words beyond it are looked up in a join.

The network learns from all training documents, each once, by truncated backpropagation over windows of ``WINDOW`` tokens
whose state is carried from one window to the next, for ``SEGMENT`` tokens at most. Rounds take a share of the documents each: every task
starts from the same weights and steps through its own documents, and the weights are averaged by tokens in a
tree of fixed order. Scoring carries the state through whole documents, of any length; documents lie side by side in
lanes that advance together. Memory is bounded by a batch of texts or the longest text.

A null or empty text is its end token alone. Documents without id are scored and not learned from, and count as held out. Ids may
repeat: every row is scored by itself, and equal texts score alike but for rounding. Without training documents every
token is the unseen type, and both scores are 0. Other columns of the documents are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from oreworks import scratch
from oreworks.llm import texts

LEXICON_WORDS = 1 << 18
HEAD_WORDS, CLASS_WORDS = 512, 64
HIDDEN = 12
WINDOW, LANES = 32, 256
ROUNDS = 2
SEGMENT = 2048  # tokens after which learning, and only that, begins anew within a document
STEP, DECAY = 0.05, 0.5  # of Adam: the first round's, and the factor from round to round
TREE = 16  # models averaged at a time
PIECE = 8 << 20  # bytes of text in work at a time
LONG = 16 << 10  # bytes; longer texts wait for one another, as a lane is no shorter than its longest text
LOG10 = np.log(10)


def remainder(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 7


def held_out(doc_id):
    """Whether a document is kept from training. A null id is."""
    return F.coalesce(remainder(doc_id) == 2, F.lit(True))


# --- words ---


def word_counts(documents: DataFrame) -> DataFrame:
    """``word`` and ``n`` over all texts; the end token is the null word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, at in texts.pieces(batch.column(0), PIECE):
                counted = texts.white_words(data, at, lower=True)[0].value_counts()
                words, n = counted.field(0).cast(pa.binary()), counted.field(1)
                words = pa.concat_arrays([words, pa.nulls(1, pa.binary())])
                n = pa.concat_arrays([n, pa.array([len(at) - 1], pa.int64())])
                yield pa.record_batch([words, n], ["word", "n"])

    counted = documents.select("text").mapInArrow(count, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Lexicon:
    """The frequent words, and how the vocabulary falls into classes.

    Words come by falling count, ties by their bytes. ``scale`` holds for each class but those of head words the
    sum of counts plus one. Classes: those of head words, then those by count, the remaining words, the end.
    """

    words: pa.Array
    counts: np.ndarray
    tokens: int  # N
    types: int  # V
    ends: int
    rest: int  # sum of counts plus one of the remaining words and of the unseen type

    @property
    def heads(self) -> int:
        return min(HEAD_WORDS, len(self.counts))

    @property
    def head_classes(self) -> int:
        return -(-self.heads // CLASS_WORDS)

    def classes(self) -> tuple[np.ndarray, np.ndarray]:
        """The class of each lexicon word, and the mass (counts plus one) of every class."""
        powers = np.floor(np.log2(self.counts[self.heads :])).astype(np.int64)
        bins, which = np.unique(powers, return_inverse=True)
        found = np.concatenate((np.arange(self.heads) // CLASS_WORDS, self.head_classes + which))
        mass = np.bincount(found, self.counts + 1.0, minlength=self.head_classes + len(bins))
        return found, np.concatenate((mass, [self.rest, self.ends + 1.0 if self.ends else 0.0]))


def lexicon(counts: DataFrame, limit: int) -> Lexicon:
    """``counts`` is read three times and better a written table. At most ``limit`` words reach the driver."""
    eighth = F.floor(F.log2("n") * 8)
    steps = counts.where("word is not null").groupBy(eighth.alias("step")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect()
    ends = counts.where("word is null").agg(F.sum("n")).first()[0] or 0
    least, held = None, 0
    for row in sorted(steps, key=lambda r: -r["step"]):
        held += row["words"]
        if held > limit:
            break
        least = row["step"]
    types, total = sum(r["words"] for r in steps), sum(r["n"] for r in steps)
    frequent = counts.where(F.col("word").isNotNull() & (eighth >= least)).toPandas() if least is not None else None
    words = [] if frequent is None else list(map(bytes, frequent["word"]))
    n = np.zeros(0, np.int64) if frequent is None else frequent["n"].to_numpy(np.int64)
    order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
    n = n[order]
    rest = int(total - n.sum()) + types - len(words) + 1
    return Lexicon(pa.array([words[i] for i in order], pa.large_binary()), n, int(total) + ends, types + bool(ends), ends, rest)


# --- the network ---


@dataclass(frozen=True)
class Network:
    """Weights; the input of a token is a row of gates, as embedding and input weights only ever appear as their product."""

    gates: np.ndarray  # of each input token: update, reset, candidate
    state: np.ndarray  # from the state to the three gates
    offset: np.ndarray  # of the state's part in the candidate
    classes: np.ndarray
    class_bias: np.ndarray
    words: np.ndarray  # of each head word
    word_bias: np.ndarray

    NAMES = ("gates", "state", "offset", "classes", "class_bias", "words", "word_bias")

    @classmethod
    def start(cls, lex: Lexicon, hidden: int = HIDDEN) -> Network:
        """The unigram model: biases are the logarithms of the counts."""
        random = np.random.default_rng(11)
        _, mass = lex.classes()
        filled = lex.head_classes * CLASS_WORDS
        bias = np.full(filled, -np.inf)
        bias[: lex.heads] = np.log(lex.counts[: lex.heads] + 1.0)
        with np.errstate(divide="ignore"):
            class_bias = np.log(mass)
        parts = (
            random.normal(0, 0.3, (filled + len(mass), 3 * hidden)),
            random.normal(0, hidden**-0.5, (hidden, 3 * hidden)),
            np.zeros(hidden),
            random.normal(0, 0.05, (hidden, len(mass))),
            class_bias - class_bias.max(),
            random.normal(0, 0.05, (filled, hidden)),
            bias,
        )
        # Classes and words that do not occur get no probability, in finite numbers.
        return cls(*(np.nan_to_num(x, neginf=-1e4).astype(np.float32) for x in parts))

    def arrays(self) -> list[np.ndarray]:
        return [getattr(self, name) for name in self.NAMES]

    def vector(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.arrays()])

    def like(self, vector: np.ndarray) -> Network:
        at = np.cumsum([0] + [x.size for x in self.arrays()])
        shaped = [vector[a:b].reshape(x.shape).astype(np.float32) for a, b, x in zip(at, at[1:], self.arrays(), strict=False)]
        return Network(*shaped)

    def zeros(self, lanes: int) -> np.ndarray:
        return np.zeros((lanes, len(self.offset)), np.float32)

    def forward(self, window: Window, h: np.ndarray, back: bool = False) -> tuple[np.ndarray, list, list]:
        """The last states, those after each token of the window, and what the way back needs."""
        size, kept, states = len(self.offset), [], []
        half, one = self.offset.dtype.type(0.5), self.offset.dtype.type(1)
        h = h if window.order is None else h[window.order]
        for inputs, first in zip(window.inputs, window.first, strict=True):
            h = h[: len(inputs)]
            if first.any():
                h = np.where(first[:, None], np.float32(0), h)
            x = self.gates[inputs]
            a = h @ self.state
            zr = x[:, : 2 * size]
            zr += a[:, : 2 * size]
            zr *= half
            np.tanh(zr, out=zr)
            zr += one
            zr *= half
            z, r = zr[:, :size], zr[:, size:]
            inner = a[:, 2 * size :]
            inner += self.offset
            n = x[:, 2 * size :]
            n += r * inner
            np.tanh(n, out=n)
            new = h - n
            new *= z
            new += n
            if back:
                kept.append((h, z, r, inner, n))
            states.append(new)
            h = new
        return h, states, kept

    def losses(self, window: Window, flat: np.ndarray, back: bool = False):
        """Natural log probabilities of the window's targets, given the states before them; with ``back``
        also the gradients of the mean loss by the states and the output weights."""
        scores = flat @ self.classes + self.class_bias
        log_p, share = _log_softmax(scores, window.classes, back)
        grads = {}
        if back:
            share[np.arange(len(share)), window.classes] -= 1
            share /= len(share)
            grads["classes"], grads["class_bias"] = flat.T @ share, share.sum(axis=0)
            d_flat = share @ self.classes.T
            grads["words"], grads["word_bias"] = np.zeros_like(self.words), np.zeros_like(self.word_bias)
        order = np.argsort(window.classes, kind="stable")
        ends = np.searchsorted(window.classes[order], np.arange(len(self.words) // CLASS_WORDS + 1))
        for c, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
            if a == b:
                continue
            rows, own = order[a:b], slice(c * CLASS_WORDS, (c + 1) * CLASS_WORDS)
            some = flat[rows]
            found, share = _log_softmax(some @ self.words[own].T + self.word_bias[own], window.within[rows], back)
            log_p[rows] += found
            if back:
                share[np.arange(b - a), window.within[rows]] -= 1
                share /= len(flat)
                grads["words"][own], grads["word_bias"][own] = share.T @ some, share.sum(axis=0)
                d_flat[rows] += share @ self.words[own]
        return (log_p, d_flat, grads) if back else log_p

    def gradients(self, window: Window, h: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray], float]:
        """The state after the window, the gradients of its mean loss, truncated at its start, and that loss."""
        h, states, kept = self.forward(window, h, back=True)
        log_p, d, grads = self.losses(window, np.concatenate(states), back=True)
        before, z, r, inner, n = (np.concatenate(x) for x in zip(*kept, strict=True))
        # How a change of the state after a token changes its gates, before the state itself passes it on.
        by_n = (1 - z) * (1 - n * n)
        by_z, by_r = (before - n) * z * (1 - z), inner * r * (1 - r)
        size, at = len(self.offset), len(d)
        d_a, d_n, passed = np.empty((at, 3 * size), d.dtype), np.empty_like(d), None
        back = np.ascontiguousarray(self.state.T)
        for state, first in zip(reversed(states), reversed(window.first), strict=True):
            own = slice(at - len(state), at)
            at -= len(state)
            d_t = d[own]
            if passed is not None:
                d_t[: len(passed)] += passed
            a, d_nt = d_a[own], d_n[own]
            np.multiply(d_t, by_n[own], out=d_nt)
            np.multiply(d_t, by_z[own], out=a[:, :size])
            np.multiply(d_nt, by_r[own], out=a[:, size : 2 * size])
            np.multiply(d_nt, r[own], out=a[:, 2 * size :])
            passed = a @ back
            passed += d_t * z[own]
            if first.any():
                passed[first] = 0
        grads["state"], grads["offset"] = before.T @ d_a, d_a[:, 2 * size :].sum(axis=0)
        d_a[:, 2 * size :] = d_n
        grads["gates"] = np.zeros_like(self.gates)
        _add_rows(grads["gates"], np.concatenate(window.inputs), d_a)
        return h, grads, -float(log_p.mean())


def _log_softmax(scores: np.ndarray, chosen: np.ndarray, shares: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Log probability of the chosen column of each row, and the probabilities of all. Works in place."""
    if scores.max() > 60 or scores.min() < -80:  # else no exponential is too large, nor a row of them too small
        scores -= scores.max(axis=1, keepdims=True)
    log_p = scores[np.arange(len(scores)), chosen].astype(np.float64)
    np.exp(scores, out=scores)
    total = scores @ np.ones(scores.shape[1], np.float32)
    log_p -= np.log(total.astype(np.float64))
    if shares:
        scores /= total[:, None]
    return log_p, scores if shares else None


def _add_rows(out: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Add each value to its row, rows repeating."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    out[rows[first]] += np.add.reduceat(values[order], first, axis=0)


@dataclass(frozen=True)
class Coded:
    """Texts as tokens: lexicon number of each (-1 for other words, -2 for ends) and the factors of the vocabulary."""

    words: pa.Array  # the different words
    which: np.ndarray  # of each token, -1 for ends
    number: np.ndarray
    classes: np.ndarray
    within: np.ndarray
    inputs: np.ndarray  # what stands before each token: the end, before a document's first
    first: np.ndarray
    at: np.ndarray  # where documents begin


@dataclass(frozen=True)
class Window:
    """Tokens of all lanes over some steps; lanes end one by one, the last ones first."""

    inputs: list[np.ndarray]
    first: list[np.ndarray]
    classes: np.ndarray
    within: np.ndarray
    at: np.ndarray  # where in the documents' tokens each target stands
    order: np.ndarray | None = None  # what lanes are to be before this window


def windows(documents: Iterable[Coded], lanes: int, steps: int = WINDOW) -> Iterator[Window]:
    """Documents dealt to lanes, the longest of a batch first, each to the lane that has least to read.

    Lanes read on while all of them have something to read; what is left waits for the next batch, so
    a long document does not hold up others. After the last batch the lanes run out one by one.
    """
    pool, waiting = None, [np.zeros(0, np.int64)] * lanes
    for coded in documents:
        # What still waits moves to the front of the pool.
        sizes = [len(x) for x in waiting]
        kept = np.concatenate(waiting)
        new = (coded.inputs, coded.classes, coded.within, coded.first)
        pool = new if pool is None else tuple(np.concatenate((a[kept], b)) for a, b in zip(pool, new, strict=True))
        base, lengths, starts = len(kept), np.diff(coded.at), coded.at[:-1]
        load, dealt = [(n, lane) for lane, n in enumerate(sizes)], [[] for _ in range(lanes)]
        heapq.heapify(load)
        for doc in np.argsort(-lengths, kind="stable").tolist():
            most, lane = load[0]
            dealt[lane].append(doc)
            heapq.heapreplace(load, (most + int(lengths[doc]), lane))
        moved = np.split(np.arange(base), np.cumsum(sizes)[:-1])
        for lane, docs in enumerate(dealt):
            docs = np.array(docs, np.int64)
            waiting[lane] = np.concatenate((moved[lane], base + texts.spans(starts[docs], lengths[docs])))
        full = min(map(len, waiting)) // steps * steps
        if full:
            yield from _cut(pool, np.stack([x[:full] for x in waiting], axis=1), steps)
            waiting = [x[full:] for x in waiting]
    order = np.array(sorted(range(lanes), key=lambda lane: -len(waiting[lane])))
    where = np.full((len(waiting[order[0]]), lanes), -1, np.int64)
    for column, lane in enumerate(order):
        where[: len(waiting[lane]), column] = waiting[lane]
    for n, window in enumerate(_cut(pool, where, steps)):
        yield window if n else replace(window, order=order)


def segmented(coded: Coded) -> Coded:
    """Long documents as several, each token after the one before it still, but with a state of its own."""
    lengths = np.diff(coded.at)
    parts = -(-lengths // SEGMENT)
    at = np.append(texts.spans(np.zeros(len(parts), np.int64), parts) * SEGMENT + np.repeat(coded.at[:-1], parts), coded.at[-1])
    first = coded.first.copy()
    first[at[:-1]] = True
    return replace(coded, first=first, at=at)


def lanes_for(lengths: np.ndarray) -> int:
    """No more lanes than shorten the longest one."""
    return int(max(1, min(LANES, len(lengths), lengths.sum() // max(1, lengths.max(initial=1)) + 1)))


def _cut(pool: tuple[np.ndarray, ...], where: np.ndarray, steps: int) -> Iterator[Window]:
    inputs, classes, within, first = pool or (np.zeros(0, np.int32),) * 4
    active, t = (where >= 0).sum(axis=1), 0
    while t < len(where):
        # Where few lanes are left, windows are longer: each costs the same whatever it holds.
        own = min(16 * steps, where.shape[1] * steps // int(active[t]))
        rows = [where[s, : active[s]] for s in range(t, min(t + own, len(where)))]
        t += own
        flat = np.concatenate(rows)
        yield Window([inputs[r] for r in rows], [first[r] for r in rows], classes[flat], within[flat], flat)


class Adam:
    def __init__(self, network: Network, step: float):
        self.network, self.step, self.times = network, step, 0
        self.mean = {n: np.zeros_like(x) for n, x in zip(network.NAMES, network.arrays(), strict=True)}
        self.square = {n: np.zeros_like(x) for n, x in self.mean.items()}

    def update(self, grads: dict[str, np.ndarray], share: float = 1.0) -> None:
        """``share``: of the tokens of a full window; a smaller one takes a smaller step."""
        self.times += 1
        norm = np.sqrt(sum(float(np.vdot(g, g)) for g in grads.values()))
        scale, new = min(1.0, 1.0 / max(norm, 1e-12)), {}
        step = self.step * share * np.sqrt(1 - 0.99**self.times) / (1 - 0.9**self.times)
        for name, g in grads.items():
            g *= np.float32(scale)
            mean, square = self.mean[name], self.square[name]
            mean += np.float32(0.1) * (g - mean)
            g *= g
            g -= square
            g *= np.float32(0.01)
            square += g
            change = np.sqrt(square)
            change += np.float32(1e-6)
            np.divide(mean, change, out=change)
            change *= np.float32(step)
            new[name] = getattr(self.network, name) - change
        self.network = replace(self.network, **new)


# --- a model and its use in Spark ---


def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, texts of like length together: of every batch first those up to ``LONG`` bytes, longer ones
    when there are ``PIECE`` bytes of them, or at the end. Rows change their order."""

    def held() -> pa.RecordBatch:
        return pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]

    waiting, size = [], 0
    for batch in batches:
        length = pc.binary_length(batch.column("text")).fill_null(0)
        longer = pc.greater(length, LONG)
        yield batch.filter(pc.invert(longer))
        if some := pc.sum(length.filter(longer)).as_py():
            waiting.append(batch.filter(longer))
            size += some
        if size >= PIECE:
            yield held()
            waiting, size = [], 0
    if waiting:
        yield held()


def _keys(words: pa.Array) -> np.ndarray:
    """A hash of each word."""
    data, at = texts.utf8(words)
    powers = np.cumprod(np.full(int(np.diff(at).max(initial=0)) + 1, 0x9E3779B97F4A7C15, np.uint64))
    within = np.arange(len(data)) - np.repeat(at[:-1], np.diff(at))
    return texts.sums(((data.astype(np.uint64) + np.uint64(1)) * powers[within]).view(np.int64), at).view(np.uint64)


def _narrow(of_words: np.ndarray, others: Iterable[int]) -> np.ndarray:
    return np.append(of_words, others).astype(np.int32)


class Coder:
    """Turns texts into tokens of the lexicon."""

    def __init__(self, lex: Lexicon):
        self.lex = lex
        keys = _keys(lex.words)
        order = np.argsort(keys, kind="stable")
        self.keys, self.order, self.sorted = keys[order], order, lex.words.take(pa.array(order))
        found, mass = lex.classes()
        end = len(mass) - 1 if lex.ends else len(mass) - 2  # without training documents the end is unseen, too
        self.classes = _narrow(found, [end, len(mass) - 2])  # of numbers -2 and -1
        head = np.arange(len(found)) < lex.heads
        filled = lex.head_classes * CLASS_WORDS
        self.inputs = _narrow(np.where(head, np.arange(len(found)), filled + found), filled + self.classes[-2:])
        self.within = _narrow(np.where(head, np.arange(len(found)) % CLASS_WORDS, 0), [0, 0])
        # Of a word in its class: nothing for head words, which the network tells apart, and for the end.
        plain = np.log(lex.counts + 1.0) - np.log(mass[found]) if len(found) else np.zeros(0)
        self.plain = np.append(np.where(head, 0.0, plain), [0.0 if lex.ends else -np.log(lex.rest), -np.log(lex.rest)])

    def numbers(self, words: pa.Array) -> np.ndarray:
        """The lexicon's number of each word, -1 without one: hashes find it, bytes decide."""
        out = np.full(len(words), -1, np.int64)
        if len(self.keys) and len(words):
            keys = _keys(words)
            at = np.searchsorted(self.keys, keys)
            open_ = np.flatnonzero(at < len(self.keys))
            while len(open_ := open_[self.keys[at[open_]] == keys[open_]]):
                same = pc.equal(words.take(pa.array(open_)), self.sorted.take(pa.array(at[open_]))).to_numpy(zero_copy_only=False)
                out[open_[same]] = self.order[at[open_[same]]]
                open_ = open_[~same]  # two words of one hash: the next
                at[open_] += 1
                open_ = open_[at[open_] < len(self.keys)]
        return out

    def code(self, data: np.ndarray, at: np.ndarray) -> Coded:
        words, first = texts.white_words(data, at, lower=True)
        different, which = texts.distinct(words)
        known = self.numbers(different)
        n = len(first) - 1
        begins = first + np.arange(n + 1)
        inside = np.ones(begins[-1], bool)
        inside[begins[1:] - 1] = False
        all_which = np.full(begins[-1], -1, np.int64)
        all_which[inside] = which
        number = np.full(begins[-1], -2, np.int64)
        number[inside] = known[which]
        first_token = np.zeros(begins[-1], bool)
        first_token[begins[:-1]] = True
        inputs = np.empty(begins[-1], np.int32)
        inputs[1:] = self.inputs[number[:-1]]
        inputs[begins[:-1]] = self.inputs[-2]
        return Coded(different, all_which, number, self.classes[number], self.within[number], inputs, first_token, begins)


def _trained(documents: DataFrame, model, network: Network, step: float) -> Network:
    """One round: every task steps through its documents; the weights are averaged."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, adam, seen, h = Coder(model.value), Adam(network, step), 0, network.zeros(LANES)
        coded = (segmented(coder.code(*piece)) for batch in batches for piece in texts.pieces(batch.column(0), PIECE))
        for window in windows(coded, LANES):
            h, grads, _ = adam.network.gradients(window, h)
            adam.update(grads, len(window.at) / (LANES * WINDOW))
            seen += len(window.at)
        if seen:
            part = TaskContext.get().partitionId()
            yield pa.record_batch([pa.array([part]), pa.array([float(seen)]), pa.array([adam.network.vector().astype(np.float64).tobytes()], pa.binary())], ["part", "weight", "vector"])

    def average(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        weights, total = table["weight"].to_numpy(), 0
        for w, v in zip(weights, table["vector"], strict=True):
            total = total + w * np.frombuffer(v.as_py(), np.float64)
        part = table["part"][0].as_py() // TREE
        return pa.table({"part": pa.array([part]), "weight": [weights.sum()], "vector": pa.array([(total / weights.sum()).tobytes()], pa.binary())})

    schema, spark = "part long, weight double, vector binary", documents.sparkSession
    path = scratch.new_path(spark, "recurrent-weights")
    models = scratch.stage(documents.mapInArrow(learn, schema), path)
    last = models.agg(F.max("part")).first()[0]
    if last is not None:
        levels = 1
        while last >= TREE**levels:
            levels += 1
        for _ in range(levels):
            models = models.groupBy((F.col("part") / TREE).cast("long").alias("group")).applyInArrow(average, schema)
        network = network.like(np.frombuffer(models.first()["vector"], np.float64))
    scratch.discard(spark, path)
    return network


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    network: Network
    counts: DataFrame  # of all words of the training documents

    def _partial(self, documents: DataFrame) -> DataFrame:
        spark = documents.sparkSession
        held = spark.sparkContext.broadcast((self.lexicon, self.network))

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lex, network = held.value
            coder, done = Coder(lex), TaskContext.get().partitionId() << 36
            counted = np.append(np.log10(lex.counts + 1.0), [np.log10(lex.ends + 1.0), 0.0])
            known = np.append(np.ones(len(lex.counts), np.int64), [lex.ends > 0, 0])
            for batch in alike(batches):
                at_row = 0
                for data, at in texts.pieces(batch.column("text"), PIECE):
                    coded = coder.code(data, at)
                    rows, n = len(at) - 1, np.diff(coded.at)
                    log_p, lanes = np.empty(len(coded.inputs)), lanes_for(n)
                    h = network.zeros(lanes)
                    for window in windows([coded], lanes, 2 * WINDOW):
                        h, states, _ = network.forward(window, h)
                        log_p[window.at] = network.losses(window, np.concatenate(states))
                    log_p += coder.plain[coded.number]
                    other = np.flatnonzero(coded.number == -1)
                    owner = np.repeat(np.arange(rows), n)[other]
                    pairs, times = np.unique(owner * max(1, len(coded.words)) + coded.which[other], return_counts=True)
                    owner, word = np.divmod(pairs, max(1, len(coded.words)))
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.searchsorted(owner, np.arange(rows + 1)), pa.int32()),
                        pa.StructArray.from_arrays([coded.words.take(pa.array(word)).cast(pa.binary()), pa.array(times, pa.int64())], ["word", "n"]),
                    )
                    yield pa.record_batch(
                        [
                            pa.array(done + np.arange(rows)),
                            *(batch.column(c).slice(at_row, rows) for c in ("doc_id", "held_out")),
                            pa.array(n),
                            pa.array(texts.sums(known[coded.number], coded.at)),
                            pa.array(texts.sums(counted[coded.number], coded.at)),
                            pa.array(texts.sums(log_p, coded.at) / LOG10),
                            lists,
                        ],
                        ["row", "doc_id", "held_out", "n_tokens", "n_known", "counted", "told", "others"],
                    )
                    at_row += rows
                    done += rows

        kind = documents.schema["doc_id"].dataType.simpleString()
        schema = f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, counted double, told double, others array<struct<word:binary,n:bigint>>"
        given = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
        return given.mapInArrow(score, schema)

    def score(self, documents: DataFrame) -> DataFrame:
        """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; one row per row of ``documents``.

        What the lexicon does not hold is joined with the counts of all words, once per document and word."""
        spark, lex = documents.sparkSession, self.lexicon
        partial = scratch.stage(self._partial(documents), scratch.new_path(spark, "recurrent-scored"))
        others = partial.select("row", F.explode("others").alias("o")).select("row", "o.word", F.col("o.n").alias("times"))
        found = others.join(self.counts.where("word is not null"), "word")
        found = found.groupBy("row").agg(F.sum("times").alias("found"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"))
        whole = partial.drop("others").join(found, "row", "left").na.fill(0, ["found", "more"])
        scale = float(np.log10(lex.tokens + lex.types + 1))
        return whole.select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.col("found")).alias("n_known"),
            F.lit(lex.tokens).cast("long").alias("train_tokens"),
            (F.col("counted") + F.col("more") - F.col("n_tokens") * F.lit(scale)).alias("base_score"),
            (F.col("told") + F.col("more")).alias("score"),
        )


def fit(documents: DataFrame, limit: int = LEXICON_WORDS) -> Model:
    """Count and learn from all documents that are not held out."""
    spark = documents.sparkSession
    training = documents.where(~held_out(F.col("doc_id")))
    counts = scratch.stage(word_counts(training), scratch.new_path(spark, "recurrent-counts"))
    lex = lexicon(counts, limit)
    network = Network.start(lex)
    if lex.tokens:
        held = spark.sparkContext.broadcast(lex)
        for r in range(ROUNDS):
            share = training.where(F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS)) == r).select("text")
            network = _trained(share, held, network, STEP * DECAY**r)
    return Model(lex, network, counts)
