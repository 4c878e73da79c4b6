"""MinHash fingerprints over word shingles, and near-duplicates by bands of them.

Words are what ASCII white space separates, A-Z in lower case. A shingle is five words; a text of fewer
is one shingle, null and empty texts have none. Each of ``SIZE`` universal hash functions
(multiply, add, shift on 64 bits) orders all shingles, and a signature holds 16 bits of the smallest value of
each. Two signatures agree in a position about as often as the texts' shingle sets overlap (Jaccard). A
text without shingles has zeros throughout; it is like any other such text and like no other.

Texts are taken whole, signatures as 4 hex digits per position. Equal texts have equal signatures.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from oreworks import scratch
from oreworks.llm import texts
from oreworks.llm.components import components

SHINGLE, SIZE, SEED = 5, 128, 11
BANDS = 32
SIMILAR = 0.8
PART_ROWS = 2048  # documents of one run of neighbours, about
PIECE = 1 << 20

_random = np.random.default_rng(SEED)
FACTORS = _random.integers(0, 1 << 63, SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _random.integers(0, 1 << 63, SIZE, dtype=np.uint64)
PLACES = _random.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BLANK_BYTES = np.zeros(256, bool)
BLANK_BYTES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def shingle_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all shingles, repeats included, and the first of each text."""
    data, at = texts.spaced(LOWER[data], at)
    starts, _, found = texts.words(data, ~BLANK_BYTES[data])
    first = texts.per_text(starts, at)
    different, which = texts.distinct(found)
    digest = xxhash.xxh64_intdigest
    word = np.fromiter((digest(w.as_buffer()) for w in different), np.uint64, len(different))[which]
    words = np.diff(first)
    count = np.where(words > 0, np.maximum(words - SHINGLE + 1, 1), 0)
    heads = np.concatenate(([0], np.cumsum(count)))
    place = texts.spans(first[:-1], count)
    left = np.repeat(first[1:], count) - place  # words from here to the end of the text
    padded = np.concatenate((word, np.zeros(SHINGLE, np.uint64)))
    hashes = np.zeros(len(place), np.uint64)
    for k in range(SHINGLE):
        hashes += np.where(left > k, padded[place + k] * PLACES[k], np.uint64(k))
    hashes ^= hashes >> np.uint64(29)
    hashes *= FACTORS[0]
    return hashes ^ (hashes >> np.uint64(32)), heads


def signatures(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of ``SIZE`` numbers of 16 bits per text."""
    hashes, first = shingle_hashes(data, at)
    out = np.zeros((len(at) - 1, SIZE), np.uint16)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        heads, work = first[:-1][some], np.empty_like(hashes)
        for k in range(SIZE):
            np.multiply(hashes, FACTORS[k], out=work)
            np.add(work, OFFSETS[k], out=work)
            # The order is that of the leading bits; 16 bits below them are kept.
            out[some, k] = (np.minimum.reduceat(work, heads) >> np.uint64(24)) & np.uint64(0xFFFF)
    return out


def all_signatures(column: pa.Array) -> np.ndarray:
    found = [signatures(data, at) for data, at in texts.pieces(column, PIECE)]
    return np.concatenate(found) if found else np.zeros((0, SIZE), np.uint16)


def _hex(found: np.ndarray) -> list[str]:
    whole, width = found.astype(">u2").tobytes().hex(), 4 * SIZE
    return [whole[i : i + width] for i in range(0, len(whole), width)]


@F.arrow_udf(T.StringType())
def fingerprint(column: pa.Array) -> pa.Array:
    """The signature of each text, as hex digits."""
    return pa.array(_hex(all_signatures(column)), pa.string())


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of positions in which rows of signatures agree."""
    return (a == b).mean(axis=1)


def _with_neighbours(documents: DataFrame) -> DataFrame:
    """Rows (part, tail, id, text), dealt and sorted so that within a part each row is followed by the next document
    in ascending doc_id (null last, ties by a hash of the text). The row after a part's last is a copy, marked tail,
    of the first of the next part, or of all after the last part.

    Parts are cut at quantiles of doc_id; the driver holds one id per part.
    """
    rows = documents.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = -(-documents.select("doc_id").count() // PART_ROWS)
    steps = [i / parts for i in range(1, parts)]
    cuts = np.unique(np.array(rows.approxQuantile("id", steps, 1 / (4 * parts)) if steps else [], float).astype(np.int64))

    @F.arrow_udf("long")
    def part_of(ids: pa.Array) -> pa.Array:
        found = np.searchsorted(cuts, ids.fill_null(0).to_numpy(zero_copy_only=False), "right")
        found[ids.is_null().to_numpy(zero_copy_only=False)] = len(cuts)
        return pa.array(found.astype(np.int64))

    rows = rows.withColumn("part", part_of("id"))
    lone = F.struct(F.col("id").isNull().alias("lacks"), "id")
    firsts = rows.groupBy("part").agg(F.min(lone).alias("first")).orderBy("part").collect()
    # The first id of a part, and the part before it, in whose end it is needed.
    before = [(r["first"]["id"], firsts[i - 1]["part"]) for i, r in enumerate(firsts)]
    ids = [i for i, _ in before if i is not None]
    order = np.argsort(ids, kind="stable")
    known, previous = np.array(ids, np.int64)[order], np.array([p for i, p in before if i is not None], np.int64)[order]
    of_null = next((p for i, p in before if i is None), -1)

    @F.arrow_udf("long")
    def part_before(column: pa.Array) -> pa.Array:
        lacks = column.is_null().to_numpy(zero_copy_only=False)
        values = column.fill_null(0).to_numpy(zero_copy_only=False)
        if not len(known):
            return pa.array(np.where(lacks, of_null, -1))
        at = np.minimum(np.searchsorted(known, values), len(known) - 1)
        return pa.array(np.where(lacks, of_null, np.where(known[at] == values, previous[at], -1)))

    also = part_before("id")
    own = F.struct(F.col("part").alias("part"), F.lit(False).alias("tail"))
    places = F.when(F.col("also") >= 0, F.array(own, F.struct(F.col("also").alias("part"), F.lit(True).alias("tail")))).otherwise(F.array(own))
    dealt = rows.withColumn("also", also).select(F.explode(places).alias("at"), "id", "text").select("at.part", "at.tail", "id", "text")
    return dealt.repartition("part").sortWithinPartitions("part", "tail", F.col("id").asc_nulls_last(), F.xxhash64("text"))


def fingerprints(documents: DataFrame) -> DataFrame:
    """Per document doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last quarter (rounded down) replaced by as many first characters of the
    next document, or all it has. The next is in ascending doc_id (null last, ties by a hash of the
    text); after the last comes the first. A single document follows itself. An empty table gives no rows.
    """

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            first = 0
            while first < batch.num_rows:
                # A bounded number of bytes at a time, and one row more to look at.
                at = texts.utf8(batch["text"])[1]
                last = max(first + 1, int(np.searchsorted(at, at[first] + PIECE * 4, "right")) - 1)
                part = pa.Table.from_batches([batch.slice(first, last - first)])
                rows = pa.concat_tables([held, part]).combine_chunks() if held is not None else part
                if rows.num_rows > 1:
                    yield described(rows)
                held, first = rows.slice(rows.num_rows - 1), last

    def described(rows: pa.Table) -> pa.RecordBatch:
        """All rows but the last, and but the tails."""
        text, part = rows["text"].combine_chunks(), rows["part"].to_numpy()
        tail = rows["tail"].to_numpy()
        kept = np.flatnonzero(~tail[:-1] & (part[:-1] == part[1:]))
        signs, whole = all_signatures(text), text.to_pylist()
        edited = []
        for i in kept.tolist():
            cut = len(whole[i]) // 4
            edited.append(whole[i][: len(whole[i]) - cut] + whole[i + 1][:cut])
        edited_signs = all_signatures(pa.array(edited, pa.large_string()))
        own = signs[kept]
        return pa.RecordBatch.from_arrays(
            [
                rows["id"].combine_chunks().take(pa.array(kept)),
                pa.array([len(whole[i]) for i in kept.tolist()], pa.int64()),
                pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
                pa.array(_hex(own), pa.string()),
                pa.array(_hex(edited_signs), pa.string()),
                pa.array(likeness(own, edited_signs)),
                pa.array(likeness(own, signs[kept + 1])),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    return _with_neighbours(documents).mapInArrow(
        marked,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )


def _shingles(text: Column) -> Column:
    """The different shingles of a text, as hashes."""

    @F.arrow_udf("array<long>")
    def shingles(column: pa.Array) -> pa.Array:
        out = []
        for data, at in texts.pieces(column, PIECE):
            hashes, first = shingle_hashes(data, at)
            out += [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(first[:-1], first[1:], strict=True)]
        return pa.array(out, pa.list_(pa.int64()))

    return shingles(text)


def _classes(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of documents with an id: their class (smallest doc_id of equal shingle sets); per class with shingles
    its signature and set; and these classes' bands. All written, as they are read several times."""
    spark = documents.sparkSession
    rows = documents.where("doc_id is not null").select("doc_id", fingerprint("text").alias("mark"), _shingles(F.col("text")).alias("set"))
    rows = scratch.stage(rows.withColumn("same", F.sha2(F.col("set").cast("string"), 256)), scratch.new_path(spark, "shingles"))
    least = rows.groupBy("same").agg(F.min("doc_id").alias("class_id"))
    classes = rows.select("doc_id", "same").join(least, "same").select("doc_id", "class_id")
    one = rows.join(least, "same").where("doc_id = class_id and size(set) > 0").select("class_id", "mark", "set").dropDuplicates(["class_id"])
    one = scratch.stage(one, scratch.new_path(spark, "classes"))
    width = 4 * SIZE // BANDS
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.substring(F.col("mark"), i * width + 1, F.lit(width)))
    banded = one.select("class_id", F.size("set").alias("n"), bands.alias("bands"))
    return classes, one, banded.select("class_id", "n", "bands", F.posexplode("bands").alias("band", "value"))


def _met(banded: DataFrame, similar: float) -> DataFrame:
    """Pairs a < b that share a band and whose sets are of a size that allows ``similar``, each under the first band
    it shares. ``banded`` may have a column root; then only pairs of different roots."""
    # Sizes by a factor of at most 1 / similar apart are on the same step of this ladder or on the next.
    step = F.floor(F.log("n") / -np.log(similar) + 1e-9) if similar < 1 else F.col("n")
    rows = banded if "root" in banded.columns else banded.withColumn("root", F.col("class_id"))
    left = rows.select("band", "value", step.alias("step"), F.struct(F.col("class_id").alias("id"), "n", "bands", "root").alias("x"))
    near = F.explode(F.array(step - 1, step, step + 1)) if similar < 1 else step
    right = rows.select("band", "value", near.alias("step"), F.struct(F.col("class_id").alias("id"), "n", "bands", "root").alias("y"))
    alike = F.least("x.n", "y.n") >= similar * F.greatest("x.n", "y.n") - 1e-6
    shared = F.array_position(F.transform(F.arrays_zip(F.col("x.bands").alias("p"), F.col("y.bands").alias("q")), lambda z: z["p"] == z["q"]), True)
    met = left.join(right, ["band", "value", "step"]).where((F.col("x.id") < F.col("y.id")) & (F.col("x.root") != F.col("y.root")) & alike)
    return met.where(shared == F.col("band") + 1).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def _verified(met: DataFrame, one: DataFrame, similar: float) -> DataFrame:
    """Of pairs (a, b) of classes those whose sets overlap by ``similar`` or more, with their Jaccard similarity."""
    sets = one.select("class_id", "set")
    met = met.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    both = F.size(F.array_intersect("set_a", "set_b"))
    jaccard = both / (F.size("set_a") + F.size("set_b") - both)
    return met.select("a", "b", jaccard.alias("jaccard")).where(F.col("jaccard") >= similar)


def near_pairs(documents: DataFrame, similar: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """``(classes, pairs)``: doc_id and class_id (smallest doc_id of equal shingle sets) of each document, and pairs
    (a, b, jaccard) of classes whose shingle sets overlap by ``similar`` or more, found by equal bands of the signatures
    and verified on the sets. Documents without shingles form one class and are in no pair. Null ids are left out.

    A pair is looked at only under the first band it shares, so no pair is verified twice, and sets are fetched
    for pairs, not carried through the bands. Copies are one row, so a group of them makes no pairs; k different
    texts that are all alike do, as each such pair is a row of the result. ``near_duplicates`` has no such rows.
    """
    classes, one, banded = _classes(documents)
    return classes, _verified(_met(banded, similar), one, similar)


def near_duplicates(documents: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """doc_id and component_id (smallest doc_id reachable by near pairs, itself included) of each document with an id.

    The components are those of ``near_pairs``, without all its pairs. First every class of a band is verified
    against the smallest class of that band, its hub: k near copies of a text make at most k - 1 pairs
    a band. Only classes of a band that this left in different components are then verified against each other. Documents
    without shingles are one component. Rows that repeat a doc_id stay rows. An empty table gives no rows.
    """
    spark = documents.sparkSession
    classes, one, banded = _classes(documents)
    hubs = banded.groupBy("band", "value").agg(F.min("class_id").alias("hub"), F.max("class_id").alias("last")).where("hub < last")
    stars = banded.join(hubs, ["band", "value"]).where("class_id > hub").select(F.col("hub").alias("a"), F.col("class_id").alias("b")).distinct()
    links = scratch.stage(_verified(stars, one, similar).select("a", "b"), scratch.new_path(spark, "stars"))
    known = components(links, "minhash").withColumnRenamed("node", "class_id")
    rooted = banded.join(known, "class_id", "left").withColumn("root", F.coalesce("root", "class_id"))
    apart = rooted.groupBy("band", "value").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most")
    rest = _verified(_met(rooted.join(apart.select("band", "value"), ["band", "value"], "left_semi"), similar), one, similar)
    linked = components(links.unionByName(rest.select("a", "b")), "minhash").withColumnRenamed("node", "class_id")
    return classes.join(linked, "class_id", "left").select("doc_id", F.coalesce("root", "class_id").alias("component_id"))
