"""Runs: stretches of consecutive words that repeat with a period, found in scale-tiled documents.

A run has a smallest period q, a length of at least ``max(SHORTEST, 3 * q)`` words, and cannot be made longer on either
side. Words are runs of anything but white space, compared as they are written.

Periods fall into octaves [P, 2P), of which the first holds 1 to 15. A run of an octave matches itself, q words on, over two P
words or more, so over a whole block of P words that begins at a multiple of P. A document is exploded into overlapping tiles
per octave. Within a tile, names of all windows of P words (built by doubling) tell at which
distances a block comes again. At those the boundary Z-functions are evaluated word by word: how far the text after
the block's first word, and before it, agrees with the text one period on. So names only ever suggest; words decide. A distance whose block is
a power of something shorter is left to the octave of the shorter one.

A tile knows a run as far as it reaches. A tile overlaps the next so far that the fragments of a run meet; they are
shuffled by document and period and stitched. Texts of up to ``WHOLE_BYTES`` are one tile for all octaves, solved where
they are read, many at a time. Longer ones are dealt out by tiles to all tasks, equal texts once.

A null or empty text has no words and no runs. Ids play no part and may be null or repeat: every row is answered by itself, and
equal texts alike. Columns other than the text are passed on, whatever they are called. An empty table gives no rows. Memory is
bounded by a batch of texts; a tile of a long period is up to as long as its document, and two numbers per word are held.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from oreworks.llm import texts

SHORTEST = 24
FIRST = 8  # block of the first octave, which holds the periods below twice as many
TILE = 8192  # words that a tile of a long document answers for, or four blocks
WHOLE_BYTES = 64 << 10
PIECE = 2 << 20
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


# --- tiles ---


def octaves(words: int) -> list[int]:
    """The blocks of all octaves that a text of so many words can have runs of."""
    out, block = [], FIRST
    while out and 3 * block <= words or not out and words >= SHORTEST:
        out.append(block)
        block *= 2
    return out


def _names(codes: np.ndarray) -> np.ndarray:
    """A number for each word."""
    x = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(31))


def _doubled(names: np.ndarray, width: int) -> np.ndarray:
    """Names of windows of twice the width."""
    if len(names) <= width:
        return names[:0]
    x = names[:-width] * np.uint64(0xBF58476D1CE4E5B9) + (names[width:] ^ (names[width:] >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """How many words the two begin with in common: one value of a Z-function."""
    n, i, step = min(len(a), len(b)), 0, 64
    while i < n:
        unlike = a[i : min(i + step, n)] != b[i : min(i + step, n)]
        j = int(unlike.argmax())
        if unlike[j]:
            return i + j
        i, step = i + len(unlike), 4 * step
    return n


def _shortened(codes: np.ndarray, half: np.ndarray, names: np.ndarray, block: int, m: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Which of the candidates are powers: their block of p words consists of copies of one of p / r words."""
    claimed = np.zeros(len(m), np.int64)
    for r in _divisors(block, p):
        some = np.flatnonzero(p % r == 0)
        q = p[some] // r
        length = p[some] - q
        alike = np.ones(len(some), bool)
        for width, windows in ((block // 2, half), (block, names)):
            own = np.flatnonzero((length < block) if width < block else (length >= block))
            x, y, n = m[some[own]], m[some[own]] + q[own], length[own]
            last = n - width
            alike[own] = (windows[x] == windows[y]) & (windows[x + last] == windows[y + last])
        claimed[some[alike]] = q[alike]
    # The words decide. What holds for a period as far as the text keeps it also holds for its multiples.
    out = np.zeros(len(m), bool)
    rest = np.flatnonzero(claimed)
    while len(rest):
        order = rest[np.lexsort((claimed[rest], m[rest]))]
        heads = order[np.concatenate(([True], m[order][1:] != m[order][:-1]))]
        far = np.array([_agree(codes[i : i + 2 * block], codes[i + d : i + 2 * block + d]) + d for i, d in zip(m[heads], claimed[heads], strict=True)])
        mine = np.searchsorted(m[heads], m[order])
        base = claimed[heads][mine]
        settled = (claimed[order] % base == 0) & (p[order] <= far[mine])
        out[order[settled]] = True
        failed = np.isin(order, heads) & ~settled
        rest = order[~settled & ~failed]
    return out


def _divisors(block: int, p: np.ndarray) -> list[int]:
    """The primes that divide any of the periods."""
    found, left = [], np.unique(p)
    r = 2
    while len(left) and r * r <= left.max():
        hit = left % r == 0
        if hit.any():
            found.append(r)
            while (left[hit] % r == 0).any():
                left = np.where(left % r == 0, left // r, left)
                hit = left % r == 0
            left = np.unique(left)
        r += 1
    return found + [int(x) for x in left if x > 1]


def _shortened_first(codes: np.ndarray, m: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The same for the first octave, word by word."""
    out = np.zeros(len(m), bool)
    for r in (2, 3, 5, 7, 11, 13):
        some = np.flatnonzero(p % r == 0)
        q = p[some] // r
        alike = np.ones(len(some), bool)
        for j in range(2 * FIRST - 1):
            x = np.minimum(m[some] + j, len(codes) - 1 - q)  # beyond the end only where j is of no more interest
            alike &= (j >= p[some] - q) | (codes[x] == codes[x + q])
        out[some] |= alike
    return out


def fragments(codes: np.ndarray, blocks: list[int], core: tuple[int, int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs as far as the sequence holds them: first word, end, period. Only blocks that begin in the ``core`` are looked
    at. A sequence of several texts needs a code of its own between any two."""
    found: list[tuple[int, int, int]] = []
    names, width = _names(codes), 1
    first, last = core or (0, len(codes))
    for block in blocks:
        half = names
        while width < block:
            half, names, width = names, _doubled(names, width), 2 * width
        if block == FIRST:
            periods = np.arange(1, 2 * FIRST)
        else:
            periods = np.arange(block, 2 * block)
        at = np.arange(-(-first // block) * block, min(last, len(names)), block)
        at = at[at + periods[0] < len(names)]
        if not len(at):
            continue
        if block == FIRST:
            hits = [(at[(at + q < len(names))][names[at[at + q < len(names)]] == names[at[at + q < len(names)] + q]], q) for q in periods.tolist()]
            m = np.concatenate([x for x, _ in hits])
            p = np.concatenate([np.full(len(x), q) for x, q in hits])
            power = _shortened_first(codes, m, p)
        else:
            head = at[0] + block
            padded = names[head : head + len(at) * block]
            rows = len(padded) // block
            b, d = np.nonzero(padded[: rows * block].reshape(rows, block) == names[at[:rows], None])
            m, p = at[b], block + d
            tail = padded[rows * block :]
            if rows < len(at) and len(tail):
                d = np.flatnonzero(tail == names[at[rows]])
                m, p = np.concatenate((m, np.full(len(d), at[rows]))), np.concatenate((p, block + d))
            power = _shortened(codes, half, names, block, m, p) if len(m) else np.zeros(0, bool)
        m, p = m[~power], p[~power]
        order = np.lexsort((m, p))
        m, p = m[order], p[order]
        ends = np.searchsorted(p, np.unique(p), "right")
        i = 0
        for end in ends.tolist():
            while i < end:
                at_m, q = int(m[i]), int(p[i])
                e = at_m + _agree(codes[at_m:], codes[at_m + q :])
                s = at_m - _agree(codes[:at_m][::-1], codes[: at_m + q][::-1])
                found.append((s, e + q, q))
                i = max(i + 1, i + int(np.searchsorted(m[i:end], e)))  # blocks further on in the same run
    if not found:
        return (np.zeros(0, np.int64),) * 3
    s, e, q = np.array(found, np.int64).T
    return s, e, q


def long_enough(length, period):
    return (length >= SHORTEST) & (length >= 3 * period)


# --- whole texts at a time ---


def _separated(which: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts with a code of its own after each, and where each text begins among them."""
    texts_ = len(first) - 1
    begins = first + np.arange(texts_ + 1)
    out = np.empty(begins[-1], np.int64)
    inside = np.ones(len(out), bool)
    inside[begins[1:] - 1] = False
    out[inside] = which
    out[begins[1:] - 1] = -1 - np.arange(texts_)
    return out, begins


def runs_of(words: pa.Array, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All runs of the texts, by text, start and period: text, start, length, period."""
    codes, begins = _separated(texts.distinct(words)[1], first)
    s, e, q = fragments(codes, octaves(int(np.diff(first).max(initial=0))))
    kept = long_enough(e - s, q)
    s, e, q = s[kept], e[kept], q[kept]
    order = np.lexsort((q, s))
    s, e, q = s[order], e[order], q[order]
    once = np.ones(len(s), bool)
    once[1:] = (s[1:] != s[:-1]) | (q[1:] != q[:-1])
    s, e, q = s[once], e[once], q[once]
    owner = np.searchsorted(begins, s, "right") - 1
    return owner, s - begins[owner], e - s, q


def collapsed(words: pa.Array, first: np.ndarray, owner: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> pa.Array:
    """The texts without the words that a run has after its first period, joined by blanks."""
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, first[owner] + start + period, 1)
    np.add.at(step, first[owner] + start + length, -1)
    kept = np.cumsum(step[:-1]) == 0
    at = np.concatenate(([0], np.cumsum(kept)))[first]
    lists = pa.LargeListArray.from_arrays(pa.array(at), words.filter(pa.array(kept)))
    return pc.binary_join(lists, pa.scalar(b" ", pa.large_binary())).cast(pa.large_string())


def _listed(rows: int, owner: np.ndarray, *columns: np.ndarray) -> pa.Array:
    structs = pa.StructArray.from_arrays([pa.array(c) for c in columns], ["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(rows + 1)), pa.int32()), structs)


def _answered(rows: pa.RecordBatch, texts_: pa.Array, runs: pa.Array | None, kept: Callable[[pa.Array], pa.Array]) -> Iterator[pa.RecordBatch]:
    """``rows`` with the runs of their texts, found here or given, and what is left of the texts."""
    at_row = 0
    for data, at in texts.pieces(texts_, PIECE):
        words, first = texts.white_words(data, at)
        n = len(at) - 1
        if runs is None:
            owner, *columns = runs_of(words, first)
        else:
            own = runs.slice(at_row, n)
            owner = np.repeat(np.arange(n), own.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            flat = own.flatten()
            columns = [flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("start", "length", "period")]
        left = kept(collapsed(words, first, owner, *columns)).cast(pa.string())
        yield pa.record_batch([*rows.slice(at_row, n).columns, _listed(n, owner, *columns), left], [*rows.schema.names, "runs", "collapsed"])
        at_row += n


# --- long texts, by tiles ---

TILES = "digest string, octave_from long, octave_to long, base long, core_from long, core_to long, codes binary"


def tiles(codes: np.ndarray, tile: int) -> Iterator[tuple[int, int, int, int, int, np.ndarray]]:
    """The tiles of a text: first and last block, place of its first word, where its core begins and ends, and its codes.
    Octaves whose blocks are short against a tile share one."""
    blocks = octaves(len(codes))
    shared = [b for b in blocks if 4 * b <= tile]
    for group in ([shared] if shared else []) + [[b] for b in blocks if 4 * b > tile]:
        widest = group[-1]
        size = max(tile, 4 * widest)
        for core in range(0, len(codes), size):
            base = max(0, core - widest)
            yield group[0], widest, base, core - base, core - base + size, codes[base : core + size + 3 * widest]


def _stitched(pieces: DataFrame) -> DataFrame:
    """Fragments of a document and a period that meet are one run. Of columns digest, start, end, period."""
    by = Window.partitionBy("digest", "period").orderBy("start", "end")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    # Words that match the word one period on: up to a period before the end.
    apart = F.coalesce(F.col("start") + F.col("period") > F.max("end").over(before), F.lit(True))
    islands = pieces.withColumn("island", apart.cast("int")).withColumn("island", F.sum("island").over(by))
    runs = islands.groupBy("digest", "period", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    runs = runs.withColumn("length", F.col("end") - F.col("start"))
    return runs.where(long_enough(F.col("length"), F.col("period"))).select("digest", "start", "length", "period")


def _long(rows: DataFrame, text: str, digest: str, tile: int) -> DataFrame:
    """``rows`` with a column ``digest``: the runs of every different text, by tiles."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in TILES.split(", ")]
        for batch in batches:
            for name, words in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data, at = texts.utf8(pa.array([words.as_py()], pa.large_string()))
                codes = texts.distinct(texts.white_words(data, at)[0])[1].astype(np.int32)
                for *numbers, part in tiles(codes, tile):
                    yield pa.record_batch([pa.array([x]) for x in (name, *numbers)] + [pa.array([part.tobytes()], pa.binary())], names)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes = np.frombuffer(row["codes"], np.int32).astype(np.int64)
                blocks = [row["octave_from"] << k for k in range(64) if row["octave_from"] << k <= row["octave_to"]]
                s, e, q = fragments(codes, blocks, (row["core_from"], row["core_to"]))
                open_ = (s == 0) | (e == len(codes)) | long_enough(e - s, q)
                s, e, q = s[open_], e[open_], q[open_]
                if len(s):
                    columns = [pa.array([row["digest"]] * len(s)), pa.array(s + row["base"]), pa.array(e + row["base"]), pa.array(q)]
                    yield pa.record_batch(columns, ["digest", "start", "end", "period"])

    different = rows.groupBy(F.col(digest).alias("digest")).agg(F.first(text).alias("text"))
    cut_ = different.mapInArrow(cut, TILES).repartition("digest", "octave_to", "base")
    return _stitched(cut_.mapInArrow(solve, "digest string, start long, end long, period long"))


def scan(
    documents: DataFrame,
    text: str = "text",
    prepare: Callable[[pa.RecordBatch], pa.Array] | None = None,
    kept: Callable[[pa.Array], pa.Array] = lambda collapsed: collapsed,
    whole_bytes: int = WHOLE_BYTES,
    tile: int = TILE,
) -> DataFrame:
    """The other columns of ``documents``, ``runs`` (start, length and period, by start, then period) and ``collapsed``, the
    words that no run holds after its first period, joined by blanks; a row per row of ``documents``.

    Columns of the documents called runs or collapsed are left out. ``prepare`` makes the texts to be scanned of the rows
    (all their columns, those left out excepted), and ``kept`` of the collapsed texts what is returned, both in the tasks that scan.
    """
    if tile % FIRST or tile < 4 * FIRST or tile & (tile - 1):
        raise ValueError("a tile is a power of two and holds four blocks of the first octave")
    others = [c for c in documents.columns if c not in (text, "runs", "collapsed")]
    inner = [f"c{i}" for i in range(len(others))]
    given = documents.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(others, inner, strict=True)], F.col(f"`{text}`").alias("text"))
    kinds = [T.StructField(n, documents.schema[c].dataType) for c, n in zip(others, inner, strict=True)]
    schema = T.StructType([*kinds, *T.StructType.fromDDL(f"runs {RUNS}, collapsed string").fields])

    def prepared(batch: pa.RecordBatch) -> pa.Array:
        return prepare(batch.rename_columns([*others, text])) if prepare else batch.column("text")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _answered(batch.select(inner), prepared(batch), None, kept)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.set_column(len(inner), "text", prepared(batch).cast(pa.string()))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _answered(batch.select(inner), batch.column("text"), batch.column("runs"), kept)

    is_long = F.coalesce(F.octet_length("text") > whole_bytes, F.lit(False))
    short = given.where(~is_long).mapInArrow(whole, schema)
    rows = given.where(is_long)
    rows = (rows.mapInArrow(made, rows.schema) if prepare else rows).withColumn("digest", F.sha2("text", 256))
    found = _long(rows, "text", "digest", tile).groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    found = found.withColumn("runs", F.transform("runs", lambda r: F.struct(r["start"], r["length"], r["period"])).cast(RUNS))
    long = rows.join(found, "digest", "left").select(*inner, "text", "runs").mapInArrow(told, schema)
    return short.unionByName(long).select(*[F.col(n).alias(c) for c, n in zip(others, inner, strict=True)], "runs", "collapsed")
