"""How the tokens of two tokenizers lie on the bytes of the same texts.

A is a byte-level BPE, B a piece model with byte fallback; both read a blank and the text (B adds the blank itself). Bytes at which
tokens of both end cut them into groups; an A and a B token are linked where their byte ranges overlap. The count of a
pair of ids is how often it is linked in the whole corpus.

Groups of consecutive byte ranges form a monoid. The fragment of a range holds the tokens that end in it: an open prefix up
to the first byte where tokens of both end, closed groups, and an open suffix after the last such byte, or nothing but open tokens.
Putting two fragments together closes the group of the first one's suffix and the second one's prefix; this is associative,
so texts beyond ``LONG`` bytes are cut into ranges of ``RANGE`` bytes, encoded in as many tasks, and reduced in a tree. A range is
encoded from the last place before it to the first place after it where neither tokenizer ever joins two tokens: a
single blank between signs. Ranges without such a place are one. Shorter texts fall into the segments between
such places, and the different segments of a task are encoded and aligned once.

Counts of id pairs are summed in each task, then by Spark. The most frequent ones (``HEAD`` at most, by count) and the highest count
of every B id are broadcast, both bounded by their number; rarer pairs are joined.

A text that is null or empty, or whose tokens do not give back its bytes (it holds a piece mark), has no tokens: zeros and no
groups, and none of its links count. Special tokens written in a text are plain text. Ids may be null or repeat; every row is
answered by itself and counts by itself. Other columns are not read. An empty table gives no rows. Memory is bounded by a batch
of texts, by ``BOOK`` segments and ``BOOK_BYTES``, or by one text. Every executor reads the model files at the given paths.
"""

from __future__ import annotations

import gc
import json
import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cached_property
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from oreworks import scratch
from oreworks.llm import texts

MARK = "▁"
# The pattern by which byte-level BPE splits texts (fixed value), and where its signs end that every table of them has.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OLD_SIGNS = "\u0500"
PIECE = 256 << 10
BATCH_BYTES = 2 << 20
ROW_GROUP = 8 << 20  # bytes of pieces that are read at once, about
JOINED = 2 << 10  # bytes of segments that are encoded as one text
BOOK, BOOK_BYTES = 1 << 16, 16 << 20  # segments without blanks may be long
LONG, RANGE = 64 << 10, 16 << 10
HEAD = 1 << 18
FAN = 8  # fragments put together at a time


# --- tokens ---


def _byte_of_sign() -> dict[str, int]:
    """Byte-level BPE writes bytes as printable signs: those that are printable as themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


@dataclass(frozen=True)
class Pair:
    """Two tokenizers: ids of many strings one after the other with the number of each, and the bytes of every id."""

    path_a: str
    path_b: str

    @cached_property
    def _a(self):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path_a)
        tokenizer.encode_special_tokens = True
        return tokenizer

    @cached_property
    def _file_a(self) -> dict:
        return json.loads(Path(self.path_a).read_text())

    @cached_property
    def _ranked(self):
        """The same BPE in a faster library, for files that hold nothing but merges in the order of their ids; else None."""
        import tiktoken

        held = self._file_a
        model, before = held["model"], held["pre_tokenizer"]
        ids = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        plain = model["type"] == "BPE" and before["type"] == "ByteLevel" and not before["add_prefix_space"] and before.get("use_regex", True)
        if not plain or held["normalizer"] or model.get("dropout") or ids != sorted(ids):
            return None
        byte, added = _byte_of_sign(), {t["content"] for t in held["added_tokens"]}
        ranks = {bytes(map(byte.__getitem__, t)): i for t, i in model["vocab"].items() if t not in added}
        return tiktoken.Encoding("a", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def _b(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=self.path_b)

    @cached_property
    def bytes_a(self) -> tuple[np.ndarray, np.ndarray]:
        held, byte = self._file_a, _byte_of_sign()
        vocabulary = held["model"]["vocab"] | {t["content"]: t["id"] for t in held["added_tokens"]}
        spelled = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            spelled[i] = bytes(map(byte.__getitem__, token)) if all(s in byte for s in token) else token.encode()
        return _spelled(spelled)

    @cached_property
    def bytes_b(self) -> tuple[np.ndarray, np.ndarray]:
        spelled = []
        for i in range(self._b.get_piece_size()):
            piece = self._b.id_to_piece(i)
            if self._b.is_byte(i):
                spelled.append(bytes([int(piece[3:-1], 16)]))
            else:
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {piece!r} reaches across a blank")
                spelled.append(b"" if self._b.is_control(i) or self._b.is_unknown(i) else piece.replace(MARK, " ").encode())
        return _spelled(spelled)

    @property
    def size_b(self) -> int:
        return len(self.bytes_b[1]) - 1

    def lengths(self, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.diff(self.bytes_a[1])[ids_a], np.diff(self.bytes_b[1])[ids_b]

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and numbers of A, ids and numbers of B, of the segments that begin where ``at`` says (and the last ends).

        Segments begin with a blank, which B adds itself. Consecutive ones that may stand in one text are encoded as one.
        """
        starts = at[:-1]
        apart = ~np.isin(starts, cuts(data, np.array([0, len(data)])))
        apart[:1] = True
        apart[1:] |= starts[1:] // JOINED != starts[:-1] // JOINED
        first = np.append(np.flatnonzero(apart), len(starts))
        joined = [data[at[i] : at[j]].tobytes().decode() for i, j in zip(first, first[1:], strict=False)]
        out = []
        for encode, (spelled, begins) in ((self._encode_a, self.bytes_a), (self._encode_b, self.bytes_b)):
            ids, counts = [], []
            for i, j, text, found in zip(first, first[1:], joined, encode(joined), strict=False):
                size = begins[found + 1] - begins[found]
                own = data[at[i] : at[j]]
                if size.sum() == len(own) and np.array_equal(spelled[texts.spans(begins[found], size)], own):
                    counts.append(np.diff(np.searchsorted(np.cumsum(size), at[i : j + 1] - at[i], "right")))
                    ids.append(found)
                elif j - i == 1:
                    counts.append(np.array([len(found)]))
                    ids.append(found)
                else:  # some segment does not come back; the others do
                    alone = encode([data[at[k] : at[k + 1]].tobytes().decode() for k in range(i, j)])
                    counts.append(np.array([len(x) for x in alone]))
                    ids += alone
            empty = [np.zeros(0, np.int64)]
            out += [np.concatenate(ids + empty), np.concatenate(counts + empty)]
        return tuple(out)

    def _encode_a(self, strings: list[str]) -> list[np.ndarray]:
        # The libraries agree on what a letter is as far as their tables of signs are old enough.
        return [
            np.array(self._ranked.encode_ordinary(x) if self._ranked and max(x) < OLD_SIGNS else self._a.encode(x, add_special_tokens=False).ids, np.int64)
            for x in strings
        ]

    def _encode_b(self, strings: list[str]) -> list[np.ndarray]:
        return [np.array(self._b.encode(x[1:]), np.int64) for x in strings]


def _spelled(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(tokens), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in tokens])))


def _pair(path_a: str, path_b: str) -> Callable[[], Pair]:
    held: list[Pair] = []

    def get() -> Pair:
        if not held:
            gc.collect()  # what earlier tasks of this worker have read
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            pair = Pair(path_a, path_b)
            _ = pair._ranked, pair.bytes_a
            pair.__dict__.pop("_file_a")
            held.append(pair)
        return held[0]

    return get


def default_models() -> tuple[str, str]:
    """The public model files installed beside the libraries."""
    return tuple(str(Path("/opt/tokenizers") / name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


# --- where texts may be cut ---

# Lead bytes of white space beyond ASCII and the bytes that follow them; a few signs more than need be.
WIDE_SPACE = {0xC2: (0x85, 0xA0), 0xE1: (0x9A,), 0xE2: (0x80, 0x81), 0xE3: (0x80,)}


def cuts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where segments begin: every text, and every single blank between signs that are no white space.

    A's pattern lets a blank begin a token and never end one there, and no piece of B has its mark behind another sign.
    """
    plain = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D)) | ((data >= 0x1C) & (data <= 0x1F))
    found = np.flatnonzero(data == 0x20)
    last = np.zeros(len(data) + 1, bool)
    last[at] = True
    found = found[~last[found] & ~last[found + 1]]
    found = found[~plain[found - 1] & ~plain[found + 1]]
    padded = np.concatenate((np.zeros(3, np.uint8), data, np.zeros(3, np.uint8)))
    odd = np.zeros(len(found), bool)
    i = found + 3
    for lead, seconds in WIDE_SPACE.items():
        after = padded[i + 1] == lead
        before = (padded[i - 2] if lead == 0xC2 else padded[i - 3]) == lead
        follows = padded[i - 1] if lead == 0xC2 else padded[i - 2]
        odd |= after & np.isin(padded[i + 2], seconds) | before & np.isin(follows, seconds)
    return np.sort(np.concatenate((at[:-1], found[~odd])))


# --- groups and links ---


def _joined(ids: np.ndarray, at: np.ndarray, by: str) -> pa.Array:
    """The ids of each list in decimal, joined."""
    lists = pa.LargeListArray.from_arrays(pa.array(at), pa.array(ids).cast(pa.large_string()))
    return pc.binary_join(lists, pa.scalar(by, pa.large_string()))


def _lists(strings: pa.Array, at: np.ndarray, by: str) -> pa.Array:
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(at), strings), pa.scalar(by, pa.large_string()))


def _held(some: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Which numbers are among the ascending ones."""
    at = np.searchsorted(ascending, some)
    return (at < len(ascending)) & (ascending[np.minimum(at, len(ascending) - 1)] == some) if len(ascending) else np.zeros(len(some), bool)


def grouped(ids_a: np.ndarray, ends_a: np.ndarray, ids_b: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Where groups end, the last at the end of both, and how each reads (``a1,a2|b1``)."""
    ends = ends_a[_held(ends_a, ends_b)]
    at_a = np.concatenate(([0], np.searchsorted(ends_a, ends, "right")))
    at_b = np.concatenate(([0], np.searchsorted(ends_b, ends, "right")))
    return ends, pc.binary_join_element_wise(_joined(ids_a, at_a, ","), _joined(ids_b, at_b, ","), pa.scalar("|", pa.large_string()))


def linked(ids_a: np.ndarray, ends_a: np.ndarray, ids_b: np.ndarray, ends_b: np.ndarray, size_b: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each link ends, and its pair of ids as one number. Between two bytes where any token ends there is one link."""
    ends = np.concatenate((ends_a, ends_b[~_held(ends_b, ends_a)]))
    ends.sort(kind="stable")
    return ends, ids_a[np.searchsorted(ends_a, ends)] * size_b + ids_b[np.searchsorted(ends_b, ends)]


class Book:
    """Segments that were met, encoded and aligned once."""

    def __init__(self, pair: Pair):
        self.pair, self.version = pair, 0
        self.clear()

    def clear(self) -> None:
        self.version += 1
        self.segments = pa.array([], pa.large_binary())
        self.good = np.zeros(0, bool)
        self.counts = np.zeros((0, 4), np.int64)  # tokens of A, of B, groups, links
        self.groups = pa.array([], pa.large_string())
        self.links = np.zeros(0, np.int64)
        self.links_at = np.zeros(1, np.int64)

    def __len__(self) -> int:
        return len(self.segments)

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for x in (self.segments, self.good, self.counts, self.groups, self.links, self.links_at))

    def numbers(self, segments: pa.Array) -> np.ndarray:
        found = pc.index_in(segments, self.segments)
        new = found.is_null().to_numpy(zero_copy_only=False)
        numbers = found.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        if new.any():
            numbers[new] = len(self) + np.arange(new.sum())
            self._add(segments.filter(pa.array(new)))
        return numbers

    def _add(self, new: pa.Array) -> None:
        data, at = texts.utf8(new)
        ids_a, n_a, ids_b, n_b = self.pair.encode(data, at)
        length_a, length_b = self.pair.lengths(ids_a, ids_b)
        good = np.ones(len(new), bool)
        for ids, n, length, (spelled, begins) in ((ids_a, n_a, length_a, self.pair.bytes_a), (ids_b, n_b, length_b, self.pair.bytes_b)):
            first = np.concatenate(([0], np.cumsum(n)))
            good &= (texts.sums(length, first) == np.diff(at)) & (n > 0)
            # Of the segments that are as long as their tokens, the bytes.
            mine = np.repeat(good, n)
            same = spelled[texts.spans(begins[ids[mine]], length[mine])] == data[texts.spans(at[:-1][good], np.diff(at)[good])]
            ends = np.concatenate(([0], np.cumsum(np.diff(at)[good])))
            good[np.flatnonzero(good)[texts.sums(~same, ends) > 0]] = False
        kept_a, kept_b = np.repeat(good, n_a), np.repeat(good, n_b)
        ids_a, ids_b = ids_a[kept_a], ids_b[kept_b]
        ends_a, ends_b = np.cumsum(length_a[kept_a]), np.cumsum(length_b[kept_b])
        size = np.where(good, np.diff(at), 0)
        border = np.concatenate(([0], np.cumsum(size)))
        ends, strings = grouped(ids_a, ends_a, ids_b, ends_b)
        groups_at = np.searchsorted(ends, border, "right")
        link_ends, links = linked(ids_a, ends_a, ids_b, ends_b, self.pair.size_b)
        links_at = np.searchsorted(link_ends, border, "right")
        self.version += 1
        self.segments = pa.concat_arrays([self.segments, new])
        self.good = np.concatenate((self.good, good))
        counts = np.stack((np.where(good, n_a, 0), np.where(good, n_b, 0), np.diff(groups_at), np.diff(links_at)), axis=1)
        self.counts = np.concatenate((self.counts, counts))
        self.groups = pa.concat_arrays([self.groups, _lists(strings, groups_at, ";")])
        self.links_at = np.concatenate((self.links_at, len(self.links) + links_at[1:]))
        self.links = np.concatenate((self.links, links))

    def read(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of each segment of the texts, the first segment of each text, and whether a text's tokens give it back."""
        if len(self) > BOOK or self.nbytes > BOOK_BYTES:
            self.clear()
        data, at = texts.spaced(data, at)
        starts = cuts(data, at)
        segments, which = texts.distinct(texts.strings(data, np.append(starts, len(data))))
        which = self.numbers(segments)[which]
        first = texts.per_text(starts, at)
        return which, first, texts.sums(~self.good[which], first) == 0

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sums of a value per link, by segment."""
        return texts.sums(values, self.links_at)


# --- fragments of byte ranges ---

Ids = tuple[np.ndarray, np.ndarray]


@dataclass(frozen=True)
class Fragment:
    """The tokens that end in a byte range. Without a ``cut`` they are all in ``prefix``."""

    prefix: Ids
    cut: bool
    groups: list[str]
    links: list[np.ndarray]  # pairs of the closed groups
    suffix: Ids
    n_a: int
    n_b: int
    n_groups: int


# Of an empty range, and in place of ranges whose tokens do not give back their bytes.
NOTHING = Fragment((np.zeros(0, np.int64),) * 2, False, [], [], (np.zeros(0, np.int64),) * 2, 0, 0, 0)


def _put(a: Ids, b: Ids) -> Ids:
    return np.concatenate((a[0], b[0])), np.concatenate((a[1], b[1]))


def _closed(pair: Pair, ids: Ids) -> tuple[list[str], list[np.ndarray], int]:
    """Ids that begin and end at the same bytes, as groups and links."""
    length_a, length_b = pair.lengths(*ids)
    ends_a, ends_b = np.cumsum(length_a), np.cumsum(length_b)
    ends, strings = grouped(ids[0], ends_a, ids[1], ends_b)
    text = ";".join(strings.to_pylist())
    return [text] if text else [], [linked(ids[0], ends_a, ids[1], ends_b, pair.size_b)[1]], len(ends)


def fragment(pair: Pair, ids_a: np.ndarray, ends_a: np.ndarray, ids_b: np.ndarray, ends_b: np.ndarray) -> Fragment:
    """The fragment of tokens that end where they say, all within one range."""
    nothing = (ids_a[:0], ids_b[:0])
    common = ends_a[_held(ends_a, ends_b)]
    if not len(common):
        return Fragment((ids_a, ids_b), False, [], [], nothing, len(ids_a), len(ids_b), 0)
    (a0, a1), (b0, b1) = (np.searchsorted(e, common[[0, -1]], "right") for e in (ends_a, ends_b))
    groups, links, n = _closed(pair, (ids_a[a0:a1], ids_b[b0:b1]))
    return Fragment((ids_a[:a0], ids_b[:b0]), True, groups, links, (ids_a[a1:], ids_b[b1:]), len(ids_a), len(ids_b), n)


def compose(pair: Pair, x: Fragment, y: Fragment) -> Fragment:
    """The fragment of two ranges, one behind the other."""
    n_a, n_b = x.n_a + y.n_a, x.n_b + y.n_b
    if not x.cut:
        return Fragment(_put(x.prefix, y.prefix), y.cut, y.groups, y.links, y.suffix, n_a, n_b, y.n_groups)
    open_ = _put(x.suffix, y.prefix)
    if not y.cut:
        return Fragment(x.prefix, True, x.groups, x.links, open_, n_a, n_b, x.n_groups)
    groups, links, n = _closed(pair, open_)
    return Fragment(x.prefix, True, x.groups + groups + y.groups, x.links + links + y.links, y.suffix, n_a, n_b, x.n_groups + n + y.n_groups)


FRAGMENT = (
    "digest string, node long, good boolean, n_a long, n_b long, n_groups long, cut boolean, prefix_a binary, prefix_b binary, "
    "groups string, links binary, suffix_a binary, suffix_b binary"
)
NAMES = [part.split()[0] for part in FRAGMENT.split(", ")]


def _row(digest: str, node: int, good: bool, f: Fragment) -> dict:
    ids = dict(zip(("prefix_a", "prefix_b", "suffix_a", "suffix_b"), (x.astype(np.int32).tobytes() for x in (*f.prefix, *f.suffix)), strict=True))
    links = np.concatenate([np.zeros(0, np.int64), *f.links])
    return ids | {"digest": digest, "node": node, "good": good, "n_a": f.n_a, "n_b": f.n_b, "n_groups": f.n_groups, "cut": f.cut, "groups": ";".join(f.groups), "links": links.tobytes()}


def _fragment(row: dict) -> Fragment:
    a, b, c, d = (np.frombuffer(row[n], np.int32).astype(np.int64) for n in ("prefix_a", "prefix_b", "suffix_a", "suffix_b"))
    groups = [row["groups"]] if row["groups"] else []
    return Fragment((a, b), row["cut"], groups, [np.frombuffer(row["links"], np.int64)], (c, d), row["n_a"], row["n_b"], row["n_groups"])


def _table(rows: list[dict]) -> pa.Table:
    schema = pa.schema(
        [(n, {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}[k]) for n, k in (p.split() for p in FRAGMENT.split(", "))]
    )
    return pa.Table.from_pylist(rows, schema)


def ranges(data: np.ndarray, size: int) -> Iterator[tuple[int, int, int, int]]:
    """Byte ranges of a text with its blank: where each begins and ends, and from where to where it is to be encoded."""
    safe = np.append(cuts(data, np.array([0, len(data)])), len(data))
    borders = np.arange(0, len(data), size)
    before = safe[np.searchsorted(safe, borders, "right") - 1]
    # Two borders of one stretch without a safe place would have it encoded twice.
    borders = borders[np.concatenate(([True], before[1:] != before[:-1]))]
    for begin, end in zip(borders, np.append(borders[1:], len(data)), strict=True):
        yield int(begin), int(end), int(safe[np.searchsorted(safe, begin, "right") - 1]), int(safe[np.searchsorted(safe, end)])


def _long(rows: DataFrame, get: Callable[[], Pair], size: int, path: str) -> DataFrame:
    """One fragment for every different text of ``rows`` (digest, text). Those of the ranges are written to ``path``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digest, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data, at = texts.spaced(*texts.utf8(pa.array([text.as_py()], pa.large_string())))
                for node, (begin, end, start, stop) in enumerate(ranges(data, size)):
                    part = data[start:stop].tobytes()
                    yield pa.record_batch([pa.array([x]) for x in (digest, node, begin - start, end - start, part)], ["digest", "node", "begin", "end", "part"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = get()
        for batch in batches:
            for row in batch.to_pylist():
                data = np.frombuffer(row["part"], np.uint8)
                starts = np.append(cuts(data, np.array([0, len(data)])), len(data))
                ids_a, _, ids_b, _ = pair.encode(data, starts)
                good = all(
                    np.array_equal(spelled[texts.spans(begins[ids], begins[ids + 1] - begins[ids])], data)
                    for ids, (spelled, begins) in ((ids_a, pair.bytes_a), (ids_b, pair.bytes_b))
                )
                found = NOTHING
                if good:
                    kept = []
                    for ids, length in zip((ids_a, ids_b), pair.lengths(ids_a, ids_b), strict=True):
                        ends = np.cumsum(length)
                        mine = (ends > row["begin"]) & (ends <= row["end"])
                        kept += [ids[mine], ends[mine]]
                    found = fragment(pair, *kept)
                yield from _table([_row(row["digest"], row["node"], good, found)]).to_batches()

    def reduce(table: pa.Table) -> pa.Table:
        pair, rows = get(), table.sort_by("node").to_pylist()
        good, whole = all(r["good"] for r in rows), NOTHING
        for row in rows if good else []:
            whole = compose(pair, whole, _fragment(row))
        return _table([_row(rows[0]["digest"], rows[0]["node"] // FAN, good, whole)])

    different = rows.groupBy("digest").agg(F.first("text").alias("text"))
    parts = different.mapInArrow(cut, "digest string, node long, begin long, end long, part binary").repartition("digest", "node")
    fragments = scratch.stage(parts.mapInArrow(encode, FRAGMENT), path)
    last = fragments.agg(F.max("node")).first()[0] or 0
    while last:
        fragments = fragments.groupBy("digest", (F.col("node") / FAN).cast("long").alias("parent")).applyInArrow(reduce, FRAGMENT)
        last //= FAN
    return fragments


def _finished(fragments: DataFrame, get: Callable[[], Pair], kept: Callable[[pa.Array], pa.Array]) -> DataFrame:
    """Whole texts: the prefix begins with the text and the last group ends with it."""
    schema = "digest string, n_a long, n_b long, n_groups long, n_links long, groups string, links array<struct<pair:bigint,n:bigint>>"

    def finish(table: pa.Table) -> pa.Table:
        pair, (row,) = get(), table.to_pylist()
        found = _fragment(row)
        groups, links, n = _closed(pair, found.prefix) if row["good"] else ([], [], 0)
        links = np.concatenate([np.zeros(0, np.int64), *links, *found.links])
        pairs, times = np.unique(links, return_counts=True)
        text = kept(pa.array([";".join(groups + found.groups)], pa.large_string())).cast(pa.string())
        structs = pa.StructArray.from_arrays([pa.array(pairs), pa.array(times, pa.int64())], ["pair", "n"])
        lists = pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), structs)
        numbers = (row["digest"], found.n_a, found.n_b, n + found.n_groups, len(links))
        return pa.table([*(pa.array([x]) for x in numbers), text, lists], ["digest", "n_a", "n_b", "n_groups", "n_links", "groups", "links"])

    # A stage of its own: with a second worker for each task, executors would keep twice as many.
    return fragments.groupBy("digest").applyInArrow(finish, schema)


# --- whole corpora ---


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Meanwhile rows pass to Python in batches of ``BATCH_BYTES``: executors keep the memory of the largest ones outside their heap."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    given = spark.conf.get(key)
    held = given.rstrip("b")
    if not held.isdigit() or not 0 < int(held) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(key, given)


def _packed(numbers: np.ndarray) -> pa.Array:
    return pa.array([pa.compress(numbers.astype(np.int32).tobytes(), codec="zstd", asbytes=True)], pa.binary())


def _unpacked(held: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(held, 4 * size, codec="zstd", asbytes=True), np.int32).astype(np.int64)


def _read(short: DataFrame, kind, get: Callable[[], Pair], kept: Callable[[pa.Array], pa.Array]) -> DataFrame:
    """A row for every piece of a batch: what is known of its texts without the counts, and their links by segment, packed."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, done = Book(get()), TaskContext.get().partitionId() << 36
        for batch in batches:
            at_row = 0
            for data, at in texts.pieces(batch.column("text"), PIECE):
                which, first, good = book.read(data, at)
                rows = len(at) - 1
                of_text = [np.where(good, texts.sums(v[which], first), 0) for v in book.counts.T]
                strings = _lists(book.groups.take(pa.array(which)), first, ";")
                strings = kept(pc.if_else(pa.array(good), strings, pa.scalar("", pa.large_string()))).cast(pa.string())
                used, place = np.unique(which, return_inverse=True)
                lengths = np.diff(book.links_at)[used]
                links = book.links[texts.spans(book.links_at[used], lengths)]
                sizes = pa.array([[rows + 1, len(which), len(used) + 1, len(links)]], pa.list_(pa.int64()))
                packed = [good, first, place, np.concatenate(([0], np.cumsum(lengths))), links]
                one = [0, rows]
                yield pa.record_batch(
                    [
                        pa.array([done]),
                        pa.ListArray.from_arrays(pa.array(one, pa.int32()), batch.column("doc_id").slice(at_row, rows)),
                        *(pa.ListArray.from_arrays(pa.array(one, pa.int32()), x) for x in (*map(pa.array, of_text), strings)),
                        sizes,
                        *map(_packed, packed),
                    ],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "sizes", "good", "first", "which", "links_at", "links"],
                )
                at_row += rows
                done += rows
            pa.default_memory_pool().release_unused()  # else it keeps the most that any batch took
        del book
        gc.collect()
        pa.default_memory_pool().release_unused()  # workers stay

    lists = ", ".join(f"{c} array<bigint>" for c in ("n_a", "n_b", "n_groups", "n_links"))
    packed = ", ".join(f"{c} binary" for c in PACKED)
    return short.mapInArrow(read, f"row long, doc_id array<{kind.simpleString()}>, {lists}, groups array<string>, sizes array<bigint>, {packed}")


PACKED = ("good", "first", "which", "links_at", "links")


def _links_of(batch: pa.RecordBatch, i: int) -> list[np.ndarray]:
    """Of a piece: which texts are good, their first segments, the segments, and the links of each segment."""
    rows, which, used, links = batch.column("sizes")[i].as_py()
    sizes = (rows - 1, rows, which, used, links)
    return [_unpacked(batch.column(c)[i].as_py(), n) for c, n in zip(PACKED, sizes, strict=True)]


def _counted(pieces: DataFrame) -> DataFrame:
    """``pair`` and ``n``, the sums of each batch."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                good, first, which, links_at, links = _links_of(batch, i)
                times = np.bincount(which[np.repeat(good > 0, np.diff(first))], minlength=len(links_at) - 1)
                pairs, place = np.unique(links, return_inverse=True)
                n = np.bincount(place, np.repeat(times, np.diff(links_at)), len(pairs)).astype(np.int64)
                yield pa.record_batch([pa.array(pairs[n > 0]), pa.array(n[n > 0])], ["pair", "n"])

    return pieces.select("sizes", *PACKED).mapInArrow(count, "pair long, n long")


@dataclass(frozen=True)
class Counts:
    """How often every pair of ids is linked; ``head`` holds the most frequent pairs, ``best`` the highest count of each B id."""

    table: DataFrame
    head: tuple[np.ndarray, np.ndarray]
    best: np.ndarray


def _counts(table: DataFrame, size_b: int, limit: int) -> Counts:
    """``table`` is read three times and better a written one."""
    eighth = F.floor(F.log2("n") * 8)
    least, held = None, 0
    for row in sorted(table.groupBy(eighth.alias("step")).count().collect(), key=lambda r: -r["step"]):
        held += row["count"]
        if held > limit:
            break
        least = row["step"]
    head = (np.zeros(0, np.int64),) * 2
    if least is not None:
        rows = table.where(eighth >= least).toPandas().sort_values("pair")
        head = rows["pair"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    best = np.zeros(size_b, np.int64)
    for row in table.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("n").alias("n")).collect():
        best[row["b"]] = row["n"]
    return Counts(table, head, best)


def align(
    documents: DataFrame,
    models: tuple[str, str] | None = None,
    kept: Callable[[pa.Array], pa.Array] = lambda groups: groups,
    long: int = LONG,
    size: int = RANGE,
    limit: int = HEAD,
) -> DataFrame:
    """A row per row of ``documents``: doc_id, n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2,b3``), n_best (links
    whose pair has the highest count of its B id, ties included) and count_sum (of the counts of all links).

    Rows are written before the counts are known, with the links packed by segment; ``kept`` makes of the groups, which are several times as
    long as the texts, what is to be kept of them.
    """
    spark, paths = documents.sparkSession, models or default_models()
    get, size_b = _pair(*paths), Pair(*paths).size_b
    is_long = F.coalesce(F.octet_length("text") > long, F.lit(False))
    given = documents.select("doc_id", "text")
    short, rows = given.where(~is_long), given.where(is_long).withColumn("digest", F.sha2("text", 256))
    held = {name: scratch.new_path(spark, f"alignment-{name}") for name in ("fragments", "long", "pieces", "counts", "told")}
    with _small_batches(spark):  # all that passes to Python is written in here
        finished = scratch.stage(_finished(_long(rows, get, size, held["fragments"]), get, kept), held["long"])
        scratch.discard(spark, held["fragments"])
        rows = rows.select("doc_id", "digest")

        times = rows.groupBy("digest").agg(F.count("*").alias("times"))
        links = finished.select("digest", F.explode("links").alias("link")).select("digest", "link.pair", "link.n")
        of_long = links.join(times, "digest").select("pair", (F.col("n") * F.col("times")).alias("n"))
        kind = documents.schema["doc_id"].dataType
        pieces = _read(short, kind, get, kept)
        pieces.write.option("parquet.block.size", ROW_GROUP).parquet(held["pieces"])
        pieces = spark.read.schema(pieces.schema).parquet(held["pieces"])
        table = _counted(pieces).unionByName(of_long).groupBy("pair").agg(F.sum("n").alias("n"))
        counts = _counts(scratch.stage(table, held["counts"]), size_b, limit)

        told = scratch.stage(_told(pieces, kind, counts), held["told"])
        scratch.discard(spark, held["pieces"])
    best = spark.createDataFrame([(i, n) for i, n in enumerate(counts.best.tolist()) if n], "b int, best long")

    def looked_up(rare: DataFrame, key: str) -> DataFrame:
        """Sums over links that are in no head, of which ``rare`` has key, pair and times."""
        found = rare.join(counts.table, "pair").withColumn("b", (F.col("pair") % size_b).cast("int")).join(F.broadcast(best), "b")
        high = F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0))
        return found.groupBy(key).agg(high.alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))

    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"]
    rare = told.select("row", F.explode("rare").alias("r")).select("row", "r.pair", F.col("r.n").alias("times"))
    whole = told.drop("rare").join(looked_up(rare, "row"), "row", "left").na.fill(0, ["more_best", "more_sum"])
    whole = whole.select(*columns, (F.col("n_best") + F.col("more_best")).alias("n_best"), (F.col("count_sum") + F.col("more_sum")).alias("count_sum"))
    sums = looked_up(links.withColumnRenamed("n", "times"), "digest")
    of_long = rows.join(finished.drop("links").join(sums, "digest", "left"), "digest")
    of_long = of_long.select(*columns, F.coalesce("more_best", F.lit(0)).alias("n_best"), F.coalesce("more_sum", F.lit(0)).alias("count_sum"))
    return whole.unionByName(of_long)


def _told(pieces: DataFrame, kind, counts: Counts) -> DataFrame:
    """Texts of the pieces, their sums over frequent pairs, and the other pairs with how often they occur."""
    held, size_b = pieces.sparkSession.sparkContext.broadcast((*counts.head, counts.best)), len(counts.best)
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = held.value
        for batch in batches:
            for i in range(len(batch)):
                good, first, which, links_at, links = _links_of(batch, i)
                rows = len(good)
                frequent, value = np.zeros(len(links), bool), np.zeros(len(links), np.int64)
                if len(pairs):
                    place = np.minimum(np.searchsorted(pairs, links), len(pairs) - 1)
                    frequent = pairs[place] == links
                    value = np.where(frequent, n[place], 0)
                sums = texts.sums(value, links_at)
                high = texts.sums(frequent & (value == best[links % size_b]), links_at)
                of_text = [np.where(good > 0, texts.sums(v[which], first), 0) for v in (high, sums)]
                # The rare pairs of each text.
                links, links_at = links[~frequent], np.concatenate(([0], np.cumsum(~frequent)))[links_at]
                lengths = np.where(np.repeat(good > 0, np.diff(first)), np.diff(links_at)[which], 0)
                owner = np.repeat(np.repeat(np.arange(rows), np.diff(first)), lengths)
                keys, times = np.unique(owner << 40 | links[texts.spans(links_at[which], lengths)], return_counts=True)
                structs = pa.StructArray.from_arrays([pa.array(keys & ((1 << 40) - 1)), pa.array(times, pa.int64())], ["pair", "n"])
                rare = pa.ListArray.from_arrays(pa.array(np.searchsorted(keys >> 40, np.arange(rows + 1)), pa.int32()), structs)
                yield pa.record_batch(
                    [pa.array(batch.column("row")[i].as_py() + np.arange(rows)), *(batch.column(c).slice(i, 1).flatten() for c in columns), *map(pa.array, of_text), rare],
                    ["row", *columns, "n_best", "count_sum", "rare"],
                )

    numbers = ", ".join(f"{c} long" for c in ("n_a", "n_b", "n_groups", "n_links"))
    schema = f"row long, doc_id {kind.simpleString()}, {numbers}, groups string, n_best long, count_sum long, rare array<struct<pair:bigint,n:bigint>>"
    return pieces.mapInArrow(tell, schema)
