"""WARC archives: a writer that stores equal payloads once, and a splittable reader.

Writing (``write``). Each page is one gzip member that holds one record: a response with the payload, or a revisit
that names the response with the same payload. Of the pages with equal payloads of at least
``least_bytes``, the one with the smallest page_id is the response; smaller payloads are all responses. Rows that repeat that
page_id with that payload are responses too, rows with a null page_id revisit a known one and are responses if there is none.
A task writes its own files, named anew at each attempt, and returns their names and sizes as rows; those rows are
written to the shared folder, so what a failed attempt left is never read.

Reading (``read``). Files are cut into byte ranges. A task looks for the gzip magic from the start of its range on, takes a
candidate as a member if it inflates to its end (so its checksum holds), begins with a WARC version line, and is
followed by the end of the file or another member that does; from there it goes from member to member and owns
those that start inside its range. Where the chain breaks, it looks for the magic again. So compressed
bytes or payloads that look like a member don't mislead it, and memory holds one record.

Null html is an empty payload, null urls give no target. Payloads are UTF-8. Tables without rows give archives without records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from oreworks import scratch

FILE_BYTES = 256 << 20  # a file is closed once it is this long
SPLIT_BYTES = 32 << 20
MOST_TASKS = 100_000  # that read; beyond it a task reads several ranges
DATE = "2024-01-01T00:00:00Z"  # pages carry no time of their own
MAGIC = b"\x1f\x8b\x08"
NAME = "urn:page:"
WINDOW, STEP = 4 << 20, 16 << 10


def digest(payload: bytes) -> str:
    """SHA-1 in base32, as archives write it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes | None, size: int, sha1: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One record, uncompressed. Without a payload it is a revisit; ``size`` is then that of the full payload."""
    revisit = payload is None
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{NAME}{'' if page_id is None else page_id}>"]
    if url is not None:
        # Signs that would end the line are percent-encoded.
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x1f\x7f\x85  ]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url))
    head += [f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{sha1}"]
    if revisit:
        head += [f"WARC-Refers-To: <{NAME}{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + (payload or b"")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def write(pages: DataFrame, folder: str, least_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write page_id, url and html of ``pages`` as archives under ``folder``, a uri that all executors reach.

    Returns the files as rows (path, bytes). Equal payloads meet by their SHA-1: grouped minima, combined in each task, then a
    join, of which Spark splits skewed keys.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("sha1"))
    first = rows.select("page_id", "sha1", F.length("payload").alias("n")).where(F.col("n") >= least_bytes)
    first = first.groupBy("sha1").agg(F.min("page_id").alias("first"))
    told = rows.join(first, "sha1", "left").withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))
    revisit = F.col("refers_to").isNotNull()
    told = told.select(
        "page_id", "url", "sha1", F.length("payload").cast("long").alias("size"), "refers_to", F.when(~revisit, F.col("payload")).alias("payload")
    )

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _opened(folder)
        system.create_dir(base, recursive=True)
        out, path, size, done = None, "", 0, []
        for batch in batches:
            for row in batch.to_pylist():
                sha1 = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
                whole = record(row["page_id"], row["url"], row["payload"], row["size"], sha1, row["refers_to"])
                packer = zlib.compressobj(4, zlib.DEFLATED, 31)
                member = packer.compress(whole) + packer.flush()
                if out is None:
                    path, size = f"part-{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{base}/{path}", compression=None)
                out.write(member)
                size += len(member)
                if size >= file_bytes:
                    out.close()
                    done.append((path, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, size))
        names = [f"{folder}/{p}" for p, _ in done]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([n for _, n in done], pa.int64())], ["path", "bytes"])

    return scratch.stage(told.mapInArrow(written, "path string, bytes long"), scratch.new_path(spark, "archives"))


class Members:
    """Gzip members of a file, by where they start."""

    def __init__(self, file: pa.NativeFile, size: int):
        self.file, self.size, self.base, self.held = file, size, 0, b""

    def get(self, at: int, n: int) -> bytes:
        """Up to ``n`` bytes from ``at`` on, through a window that moves along the file."""
        if at < self.base or at + n > self.base + len(self.held) and self.base + len(self.held) < self.size:
            self.file.seek(at)
            self.base, self.held = at, self.file.read(max(n, min(WINDOW, self.size - at)))
        return self.held[at - self.base : at - self.base + n]

    def begins(self, at: int) -> bool:
        """Whether a member that starts here begins as a record does."""
        start = self.get(at, STEP)
        if not start.startswith(MAGIC):
            return False
        try:
            return zlib.decompressobj(31).decompress(start, 5) == b"WARC/"
        except zlib.error:
            return False

    def inflate(self, at: int) -> tuple[bytes, int] | None:
        """The member that starts here and where it ends; None if it is not whole."""
        unpack, parts, end = zlib.decompressobj(31), [], at
        try:
            while not unpack.eof:
                step = self.get(end, STEP)
                if not step:
                    return None
                parts.append(unpack.decompress(step))
                end += len(step)
        except zlib.error:
            return None
        return b"".join(parts), end - len(unpack.unused_data)

    def find(self, at: int, end: int) -> int | None:
        """Where the first candidate from ``at`` on and before ``end`` starts."""
        while at < end:
            step = self.get(at, min(WINDOW, end + len(MAGIC) - 1 - at))
            found = step.find(MAGIC)
            if found >= 0:
                return at + found if at + found < end else None
            if len(step) < len(MAGIC):
                return None
            at += len(step) - len(MAGIC) + 1
        return None

    def starting_in(self, start: int, end: int) -> Iterator[bytes]:
        """The records of the members that start in [start, end)."""
        at, chained = start, False
        while at < end:
            if not chained:
                found = self.find(at, end)
                if found is None:
                    return
                at = found
            whole = self.inflate(at) if self.begins(at) else None
            follows = whole is not None and (whole[1] >= self.size or self.begins(whole[1]))
            if whole is None or not (chained or follows):
                at, chained = at + 1, False
                continue
            yield whole[0]
            at, chained = whole[1], follows


def parsed(whole: bytes) -> dict | None:
    """The fields of one record; None for records of other types."""
    head, _, block = whole.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    block = block[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = re.search(rb"(?i)\ncontent-length:\s*(\d+)", http)

    def page(name: str) -> int | None:
        number = fields.get(name, "").strip("<>").removeprefix(NAME)
        return int(number) if number else None

    stored = fields.get("warc-payload-digest", "").partition(":")[2]
    return {
        "page_id": page("warc-record-id"),
        "url": fields.get("warc-target-uri"),
        "payload_bytes": len(payload) if kind == "response" else int(length[1]) if length else 0,
        "payload_digest": digest(payload) if kind == "response" else stored,
        "record_type": kind,
        "refers_to": page("warc-refers-to"),
        "payload": payload if kind == "response" else None,
        "intact": kind == "revisit" or digest(payload) == stored,
    }


KINDS = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("intact", pa.bool_()),
])
FIELDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary, intact boolean"


def read(files: DataFrame, split_bytes: int = SPLIT_BYTES, payloads: bool = True) -> DataFrame:
    """The responses and revisits of the archives in ``files`` (path, bytes), with the fields of ``FIELDS``.

    ``intact`` says whether a payload has the digest its record states. Without ``payloads`` that column is null.
    Every range is a row of its own, dealt evenly over as many tasks as there are ranges.
    """
    starts = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))
    ranges = files.where("bytes > 0").select("path", "bytes", F.explode(starts).alias("start"))
    # A number of tasks of its own: by the few bytes of these rows AQE would read all archives in one task.
    found = ranges.agg(F.count("*").alias("n")).first()["n"]
    ranges = ranges.repartition(max(1, min(found, MOST_TASKS)))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = _opened(row["path"])
                held, size = [], 0
                with system.open_input_file(path) as file:
                    for whole in Members(file, row["bytes"]).starting_in(row["start"], min(row["start"] + split_bytes, row["bytes"])):
                        found = parsed(whole)
                        if found is None:
                            continue
                        if not payloads:
                            found["payload"] = None
                        held.append(found)
                        size += len(whole) if payloads else 256
                        if size >= WINDOW:
                            yield pa.RecordBatch.from_pylist(held, schema=KINDS)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=KINDS)

    return ranges.mapInArrow(records, FIELDS)
