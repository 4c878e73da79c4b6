"""SentencePiece encoding and decoding: batched numpy Viterbi over the pieces of a public model file.

A text gets a blank in front, blanks become the piece mark, and the pieces chosen are those whose scores
add up to the most; of equal sums the one with the longer last piece wins. A character that no
piece covers costs the least score of any piece less 10 and becomes one piece per byte.
No piece has the mark behind another sign, so a text falls into words (blanks and what follows
them) that are best on their own: the different words of a batch are encoded once each.

Words of equal length advance together: prefix hashes give the hash of every substring up to the longest
piece, sorted piece keys are probed for all of them, and one vectorised maximum per position over the piece
lengths stores the back-pointers. Memory is bounded by the batch of texts, or by the longest word.

The model's own segmentation may follow merges instead of sums (its file says BPE); ids can then
differ from the merge order, while decoding gives the same text. As in the library, a
piece mark written in a text decodes as a blank; all else comes back exactly. Null and empty
texts have no pieces and decode to the empty text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from oreworks.llm import texts

MARK = "▁"
UNKNOWN_PENALTY = 10.0
FACTOR = np.uint64(0x9E3779B97F4A7C15)  # odd, so that hashes of different strings seldom meet
SIEVE_SHIFT = np.uint64(43)
STEPS = 1 << 17  # substrings that are looked up at a time


@dataclass(frozen=True)
class Pieces:
    """The pieces of a model: text, score and kind by id."""

    text: list[str]
    score: np.ndarray
    normal: np.ndarray  # bool: may be chosen by text
    byte_ids: np.ndarray  # id of the piece of each byte
    unknown: int

    @staticmethod
    def read(path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        text = [model.id_to_piece(i) for i in ids]
        special = np.array([model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in ids])
        byte_ids = np.full(256, model.unk_id(), np.int32)
        for i in ids:
            if model.is_byte(i):
                byte_ids[int(text[i][3:-1], 16)] = i
        return Pieces(text, np.array([model.get_score(i) for i in ids]), ~special, byte_ids, model.unk_id())

    @cached_property
    def longest(self) -> int:
        return max(len(t) for t, n in zip(self.text, self.normal, strict=True) if n)

    @cached_property
    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted hashes of the normal pieces, with their ids and scores."""
        ids = np.flatnonzero(self.normal)
        hashes = np.zeros(len(ids), np.uint64)
        for n, i in enumerate(ids):
            h = 0
            for sign in self.text[i]:
                h = (h * int(FACTOR) + ord(sign) + 1) & 0xFFFFFFFFFFFFFFFF
            hashes[n] = h
        order = np.argsort(hashes)
        return hashes[order], ids[order].astype(np.int32), self.score[ids[order]]

    @cached_property
    def sieve(self) -> np.ndarray:
        """Which leading bits any key has: most substrings that are no piece go without a search."""
        held = np.zeros(1 << (64 - int(SIEVE_SHIFT)), bool)
        held[self.keys[0] >> SIEVE_SHIFT] = True
        return held

    @cached_property
    def unknown_score(self) -> float:
        return float(self.score[self.normal].min()) - UNKNOWN_PENALTY

    @cached_property
    def spelled(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes that pieces stand for, one piece after the other, and where each begins."""
        spelled = [t.replace(MARK, " ").encode() if n else b"" for t, n in zip(self.text, self.normal, strict=True)]
        for byte, i in enumerate(self.byte_ids):
            if i != self.unknown:
                spelled[i] = bytes([byte])
        at = np.concatenate(([0], np.cumsum([len(x) for x in spelled])))
        return np.frombuffer(b"".join(spelled), np.uint8), at

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id and score of the piece with each hash; -1 and minus infinity without one."""
        keys, ids, scores = self.keys
        likely = np.flatnonzero(self.sieve[hashes >> SIEVE_SHIFT])
        some = hashes[likely]
        at = np.minimum(np.searchsorted(keys, some), len(keys) - 1)
        found = keys[at] == some
        likely, at = likely[found], at[found]
        out_ids, out_scores = np.full(len(hashes), -1, np.int32), np.full(len(hashes), -np.inf)
        out_ids[likely], out_scores[likely] = ids[at], scores[at]
        return out_ids, out_scores

    def viterbi(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best pieces of words of equal length (a row of code points each): ids in order, -1 for an unknown
        character, and how many signs each takes; rows are padded with length 0."""
        n, size = points.shape
        prefix = np.zeros((n, size + 1), np.uint64)
        power = (np.full(self.longest + 1, FACTOR) ** np.arange(self.longest + 1, dtype=np.uint64)).astype(np.uint64)
        for i in range(size):
            prefix[:, i + 1] = prefix[:, i] * FACTOR + points[:, i].astype(np.uint64) + np.uint64(1)
        best = np.full((n, size + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros((n, size + 1), np.int16)
        piece = np.full((n, size + 1), -1, np.int32)
        rows = np.arange(n)
        wide = max(1, STEPS // (n * self.longest))
        for first in range(1, size + 1, wide):
            ends = range(first, min(first + wide, size + 1))
            spans = [(end, k) for end in ends for k in range(min(self.longest, end), 0, -1)]
            hashes = np.stack([prefix[:, end] - prefix[:, end - k] * power[k] for end, k in spans], axis=1)
            ids, scores = self.lookup(hashes.ravel())
            ids, scores = ids.reshape(n, -1), scores.reshape(n, -1)
            at = 0
            for end in ends:
                most = min(self.longest, end)
                sums = best[:, end - most : end] + scores[:, at : at + most]  # longest piece first
                alone = scores[:, at + most - 1] == -np.inf
                if alone.any():
                    sums[alone, -1] = best[alone, end - 1] + self.unknown_score
                choice = sums.argmax(axis=1)
                best[:, end] = sums[rows, choice]
                back[:, end] = most - choice
                piece[:, end] = ids[rows, at + choice]
                at += most
        # Walk the back-pointers of all rows at once, from the last piece to the first.
        at, chosen, taken = np.full(n, size), [], []
        while at.any():
            length = np.where(at > 0, back[rows, at], 0)
            chosen.append(piece[rows, at])
            taken.append(length)
            at = at - length
        return np.stack(chosen[::-1], axis=1), np.stack(taken[::-1], axis=1)

    def encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after the other, and where each word begins."""
        data, at = texts.utf8(words)
        whole = data.tobytes().decode("utf-8", "replace")
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        heads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[at]
        size = np.diff(heads)
        points = np.where(points == 0x20, ord(MARK), points)
        order, ids, counts = [], [], np.zeros(len(words), np.int64)
        for length in np.unique(size[size > 0]):
            group = np.flatnonzero(size == length)
            step = max(1, (1 << 22) // int(length))
            for some in (group[i : i + step] for i in range(0, len(group), step)):
                rows = points[heads[some][:, None] + np.arange(length)]
                chosen, taken = self.viterbi(rows)
                used = taken > 0
                flat, owner = chosen[used], np.repeat(some, used.sum(axis=1))
                odd = np.flatnonzero(flat == -1)
                if len(odd):
                    sign = (np.cumsum(taken, axis=1) - 1)[used][odd]
                    start = heads[owner[odd]] + sign
                    flat, owner = self._spell(flat, owner, odd, points[start])
                counts[some] = np.bincount(owner, minlength=len(words))[some]
                ids.append(flat)
                order.append(some)
        out = np.concatenate(([0], np.cumsum(counts)))
        flat = np.zeros(int(out[-1]), np.int32)
        for some, part in zip(order, ids, strict=True):
            flat[texts.spans(out[some], counts[some])] = part
        return flat, out

    def _spell(self, flat: np.ndarray, owner: np.ndarray, odd: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replace unknown characters by the pieces of their bytes."""
        spelled = [chr(p).encode("utf-8", "replace") for p in points.tolist()]
        times = np.ones(len(flat), np.int64)
        times[odd] = [len(x) for x in spelled]
        at = np.cumsum(times) - times
        out, owner = np.repeat(flat, times), np.repeat(owner, times)
        out[texts.spans(at[odd], times[odd])] = self.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
        return out, owner

    def encode(self, column: pa.Array) -> pa.Array:
        """A list of ids for each text."""
        ids, at, total = [], [np.zeros(1, np.int64)], 0
        for data, offsets in texts.pieces(column):
            empty = np.diff(offsets) == 0
            data, offsets = texts.spaced(data, offsets)
            data, offsets = _marks_to_blanks(data, offsets)
            blank = data == 0x20
            head = blank.copy()
            head[1:] &= ~blank[:-1]
            head[offsets[:-1][offsets[:-1] < len(data)]] = True
            starts = np.flatnonzero(head)
            words, which = texts.distinct(texts.strings(data, np.append(starts, len(data))))
            flat, begins = self.encode_words(words)
            count = np.diff(begins)
            first = texts.per_text(starts, offsets)
            # An empty text has its leading blank only, which stands for nothing.
            alone = first[:-1][empty]
            lengths = count[which]
            lengths[alone] = 0
            ids.append(flat[texts.spans(begins[which], lengths)])
            ends = np.concatenate(([0], np.cumsum(lengths)))[first[1:]]
            at.append(ends + total)
            total += int(lengths.sum())
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(np.concatenate(at), pa.int32()), pa.array(flat, pa.int32()))

    def decode(self, column: pa.Array) -> pa.Array:
        """The text of each list of ids; null lists are empty. Control and unknown pieces stand for nothing."""
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        ids, at = column.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(lengths)))
        found, first = [], 0
        while first < len(lengths):
            # As many texts at a time as have a bounded number of ids, or one.
            last = max(first + 1, int(np.searchsorted(at, at[first] + STEPS, "right")) - 1)
            found.append(self._decoded(ids[at[first] : at[last]], lengths[first:last]))
            first = last
        return pa.concat_arrays(found) if found else pa.array([], pa.large_string())

    def _decoded(self, ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
        spelled, begins = self.spelled
        size = begins[ids + 1] - begins[ids] if len(ids) else np.zeros(0, np.int64)
        data = spelled[texts.spans(begins[ids], size)] if len(ids) else np.zeros(0, np.uint8)
        ends = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(lengths)))]
        # The blank that encoding put in front goes.
        heads = ends[:-1][ends[:-1] < ends[1:]]
        kept = np.ones(len(data), bool)
        kept[heads[data[heads] == 0x20]] = False
        found = texts.strings(data[kept], np.concatenate(([0], np.cumsum(kept)))[ends])
        try:
            return found.cast(pa.large_string())
        except pa.ArrowInvalid:
            return pa.array([x.as_py().decode("utf-8", "replace") for x in found], pa.large_string())


def _marks_to_blanks(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece marks in the texts become blanks."""
    mark = MARK.encode()
    found = np.flatnonzero((data[:-2] == mark[0]) & (data[1:-1] == mark[1]) & (data[2:] == mark[2])) if len(data) > 2 else []
    if not len(found):
        return data, at
    data, keep = data.copy(), np.ones(len(data), bool)
    data[found] = 0x20
    keep[found + 1] = keep[found + 2] = False
    return data[keep], np.concatenate(([0], np.cumsum(keep)))[at]


def _loaded(path: str) -> Callable[[], Pieces]:
    held: list[Pieces] = []

    def get() -> Pieces:
        if not held:
            held.append(Pieces.read(path))
        return held[0]

    return get


def default_model() -> str:
    """The public model file installed beside the libraries."""
    return str(Path("/opt/tokenizers/piece_bpe_32k.model"))


def encode(text: Column, model: str | None = None) -> Column:
    """The piece ids of each text. Every executor reads the model file at the given path."""
    pieces = _loaded(model or default_model())

    @F.arrow_udf("array<int>")
    def encode(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pieces().encode(column)

    return encode(text)


def decode(ids: Column, model: str | None = None) -> Column:
    """The text that piece ids stand for."""
    pieces = _loaded(model or default_model())

    @F.arrow_udf("string")
    def decode(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pieces().decode(column).cast(pa.string())

    return decode(ids)
