"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has 64 bits: of the XXH64 (seed 42) of all word shingles of a text, repeats
included, a bit is 1 if it is set in over half of them. Texts are taken whole and with A-Z in lower
case; words are separated by ASCII white space. A text of fewer words than a shingle is one
shingle; null, empty and wordless texts have fingerprint 0 and are linked like any other.

Fingerprints link at ``radius`` or fewer differing bits. Every bit gets a vector of
``radius + 1`` bits, and every nonzero vector v a table whose mask holds the bits whose vectors
are odd against v. At most ``radius`` differing bits span less than all dimensions, so some
v is even against all of them: in that table the two fingerprints agree on all masked bits and meet.
Only different fingerprints are looked up; equal ones are one class from the start. In a
table, rows that agree under the mask come to one task, sorted, as numbers of 8 bytes. There
each row joins the tree of the first row that reaches it (``tree``), so that k
rows give at most k - 1 links, never all pairs, yet the same components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from oreworks import scratch
from oreworks.llm import texts
from oreworks.llm.components import components

WORDS, RADIUS, SEED = 3, 3, 42
BITS = 64
SPLIT = 2048  # rows that meet in one table from which on they are told apart further


def fingerprint_of(text: bytes, words: int = WORDS) -> int:
    """The fingerprint of one text, in the order of its bits."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    reach = min(words, len(tokens)) - 1
    shingles = [joined[a:b] for a, b in zip(starts[: len(tokens) - reach].tolist(), ends[reach:].tolist(), strict=True)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(x, SEED) for x in shingles), np.uint64, len(shingles))
    return int(majority(hashes))


def majority(hashes: np.ndarray) -> np.uint64:
    """The bits set in over half of the hashes."""
    ones = np.zeros(BITS, np.int64)
    for first in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[first : first + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0]


@F.arrow_udf(T.LongType())
def fingerprint(column: pa.Array) -> pa.Array:
    """The fingerprint of each text as a signed long."""
    data, at = texts.utf8(column)
    whole = data.tobytes()
    found = [fingerprint_of(whole[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    return pa.array(np.array(found, np.uint64).view(np.int64))


def masks(radius: int = RADIUS, bits: int = BITS, seed: int = 1) -> list[int]:
    """The 2^(radius + 1) - 1 masks of the covering family, as signed longs. Every vector is used about equally often."""
    vectors = np.random.default_rng(seed).permutation(np.arange(bits) % (1 << (radius + 1)))
    found = []
    for v in range(1, 1 << (radius + 1)):
        odd = np.bitwise_count(vectors & v) % 2 == 1
        found.append(int(np.packbits(odd, bitorder="little").view(np.int64)[0]))
    return found


def tree(rows: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same rows (uint64, all different) as all pairs within the radius would."""
    if len(rows) > SPLIT:
        return _tree_of_parts(rows, radius)
    parents, children, rest = [], [], rows
    while len(rest) > 1:
        frontier, rest = rest[:1], rest[1:]
        while len(frontier) and len(rest):
            near = np.bitwise_count(rest[:, None] ^ frontier[None, :]) <= radius
            reached = near.any(axis=1)
            parents.append(frontier[near[reached].argmax(axis=1)])
            frontier, rest = rest[reached], rest[~reached]
            children.append(frontier)
    if not parents:
        return rows[:0], rows[:0]
    return np.concatenate(parents), np.concatenate(children)


def _tree_of_parts(rows: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows within the radius agree on one of ``radius + 1`` parts of their bits: each part groups them anew."""
    a, b = [], []
    width = -(-BITS // (radius + 1))
    for shift in range(0, BITS, width):
        part = (rows >> np.uint64(shift)) & np.uint64((1 << width) - 1)
        order = np.argsort(part, kind="stable")
        bounds = np.flatnonzero(np.diff(part[order])) + 1
        for group in np.split(rows[order], bounds):
            if len(group) > 1:
                x, y = _blocked(group, radius) if len(group) > SPLIT else tree(group, radius)
                a.append(x)
                b.append(y)
    return (np.concatenate(a), np.concatenate(b)) if a else (rows[:0], rows[:0])


def _blocked(rows: np.ndarray, radius: int, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """``tree`` with the frontier in blocks, in memory in proportion to the rows."""
    parents, children, rest = [], [], rows
    while len(rest) > 1:
        waiting, rest = [rest[:1]], rest[1:]
        while waiting and len(rest):
            frontier = waiting.pop()
            frontier, later = frontier[:block], frontier[block:]
            if len(later):
                waiting.append(later)
            near = np.bitwise_count(rest[:, None] ^ frontier[None, :]) <= radius
            reached = near.any(axis=1)
            if reached.any():
                parents.append(frontier[near[reached].argmax(axis=1)])
                children.append(rest[reached])
                waiting.append(rest[reached])
                rest = rest[~reached]
    return (np.concatenate(parents), np.concatenate(children)) if parents else (rows[:0], rows[:0])


def links(fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between the different values of column ``fingerprint`` that connect what the radius connects."""
    tables = F.array(*[F.lit(m) for m in masks(radius)])
    keyed = fingerprints.select("fingerprint").distinct().select("fingerprint", F.posexplode(tables).alias("table", "mask"))
    keyed = keyed.select("table", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("key"), "fingerprint")
    dealt = keyed.repartition("table", "key").sortWithinPartitions("table", "key", "fingerprint")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def of(parts: list[pa.RecordBatch], last: bool) -> tuple[list, list[pa.RecordBatch]]:
            """The links of all groups that have ended, and what must wait."""
            whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            table, key, row = (whole.column(i).to_numpy() for i in range(3))
            bounds = np.concatenate(([0], np.flatnonzero((table[1:] != table[:-1]) | (key[1:] != key[:-1])) + 1, [len(row)]))
            ended = bounds if last else bounds[:-1]
            size, row = np.diff(ended), row.view(np.uint64)
            out = []
            two = ended[:-1][size == 2]
            near = np.bitwise_count(row[two] ^ row[two + 1]) <= radius
            out.append((row[two][near], row[two + 1][near]))
            for i in np.flatnonzero(size > 2):
                out.append(tree(row[ended[i] : ended[i + 1]], radius))
            return out, [] if last else [whole.slice(int(ended[-1]))]

        def batch(found: list) -> pa.RecordBatch:
            a, b = (np.concatenate([x[i] for x in found]).view(np.int64) for i in range(2))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        rows = 0
        for part in batches:
            if not part.num_rows:
                continue
            held.append(part)
            rows += part.num_rows
            # A group that goes on and on is put together only when it has doubled.
            if rows >= 2 * (len(held[0]) if len(held) > 1 else 0):
                found, held = of(held, False)
                rows = sum(x.num_rows for x in held)
                yield batch(found)
        if rows:
            yield batch(of(held, True)[0])

    return dealt.mapInArrow(meet, "a long, b long")


def groups(fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fingerprint`` and ``root``: equal for fingerprints that links connect. For every fingerprint."""
    distinct = fingerprints.select("fingerprint").distinct()
    linked = components(links(fingerprints, radius), "simhash").withColumnRenamed("node", "fingerprint")
    return distinct.join(linked, "fingerprint", "left").select("fingerprint", F.coalesce("root", "fingerprint").alias("root"))


def near_duplicates(documents: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable, itself included).

    Rows that repeat a doc_id stay rows. A null doc_id is larger than any other: a component of
    such rows only has component_id null. An empty table gives no rows.
    """
    spark = documents.sparkSession
    marked = scratch.stage(
        documents.select("doc_id", fingerprint("text").alias("fingerprint")), scratch.new_path(spark, "fingerprints")
    )
    classes = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    classes = scratch.stage(classes, scratch.new_path(spark, "classes"))
    rooted = scratch.stage(groups(classes, radius).join(classes, "fingerprint"), scratch.new_path(spark, "groups"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(smallest, "root").select("fingerprint", "component_id")
    return marked.join(named, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(documents: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``documents`` with one row of each component: the smallest doc_id (null last), and of rows that
    share it the one that was written first. All columns stay."""
    spark = documents.sparkSession
    taken = [c.lower() for c in documents.columns]
    row, mark = (next(n for n in (stem + "_" * i for i in range(len(taken) + 1)) if n not in taken) for stem in ("row", "mark"))
    staged = scratch.stage(documents.withColumn(mark, fingerprint("text")).withColumn(row, F.monotonically_increasing_id()), scratch.new_path(spark, "marked"))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(row))
    classes = staged.groupBy(F.col(mark).alias("fingerprint")).agg(F.min(order).alias("first"))
    classes = scratch.stage(classes, scratch.new_path(spark, "classes"))
    kept = groups(classes, radius).join(classes, "fingerprint").groupBy("root").agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first").getField(row).alias(row))
    return staged.join(kept, row, "left_semi").select(*documents.columns)
