"""Whole texts as flat numpy arrays, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

PIECE_BYTES = 1 << 20
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Have this session pass rows to Python in small batches: texts are long, and a worker
    holds a batch and what it makes of it. Smaller settings stay."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        given = spark.conf.get(key).rstrip("b")
        if not given.isdigit() or not 0 < int(given) <= most:
            spark.conf.set(key, str(most))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and where each begins (and the last ends).
    A null is an empty text."""
    column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_binary())
    column = column.fill_null(b"") if column.null_count else column
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8), at - at[0]


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``utf8`` of consecutive rows, cut so that a piece holds at most ``limit`` bytes
    unless a single text is longer."""
    data, at = utf8(column)
    first = 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def spaced(data: np.ndarray, at: np.ndarray, filler: int = 0x20) -> tuple[np.ndarray, np.ndarray]:
    """The same texts with one ``filler`` byte before each, so that no word runs from one text into the next."""
    n = len(at) - 1
    out = np.full(len(data) + n, filler, np.uint8)
    keep = np.ones(len(out), bool)
    starts = at[:-1] + np.arange(n)
    keep[starts] = False
    out[keep] = data
    return out, at + np.arange(n + 1)


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of True begin and end."""
    edges = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def strings(data: np.ndarray, at: np.ndarray) -> pa.Array:
    """The byte strings that follow one another in ``data``, each beginning where ``at`` says, as an Arrow array."""
    buffers = [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, buffers)


def words(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Where the runs of bytes that are ``inside`` begin and end, and these byte strings."""
    starts, ends = runs(inside)
    return starts, ends, strings(data[inside], np.concatenate(([0], np.cumsum(ends - starts))))


WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
LOWERED = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def white_words(data: np.ndarray, at: np.ndarray, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """The words between white space (or ends of texts) of all texts, with A-Z in lower case if asked for, and the
    first word of each text (and the number of all)."""
    inside = ~WHITE[data]
    begin, last = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = at[:-1][at[1:] > at[:-1]]
    begin[filled] = inside[filled]
    last[filled[1:] - 1] = inside[filled[1:] - 1]
    starts = np.flatnonzero(begin)
    held = data[inside]
    offsets = np.concatenate(([0], np.cumsum(np.flatnonzero(last) + 1 - starts)))
    return strings(LOWERED[held] if lower else held, offsets), per_text(starts, at)


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of each span, one span after the other."""
    at = np.cumsum(lengths) - lengths
    return np.repeat(starts - at, lengths) + np.arange(int(lengths.sum()))


def distinct(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The different words, and for each word which of them it is."""
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def per_text(starts: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of the ascending ``starts`` fall into each text, as first index of each and total."""
    return np.searchsorted(starts, at)


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the values of each text; ``first`` as ``per_text`` gives it."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)))
    return total[first[1:]] - total[first[:-1]]


def largest(values: np.ndarray, first: np.ndarray, empty: float) -> np.ndarray:
    """The largest value of each text, ``empty`` where it has none."""
    out = np.full(len(first) - 1, empty, np.float64)
    some = first[1:] > first[:-1]
    if some.any():
        out[some] = np.maximum.reduceat(values, first[:-1][some])
    return out
