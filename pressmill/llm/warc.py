"""WARC writer with a shared Zstandard dictionary.

Every file starts with a skippable frame (magic 0x184D2A5D) that embeds the dictionary; each record is one frame
compressed with it. The dictionary is trained on a bounded sample of the records to be archived (SAMPLES different payloads
of smallest hash, the first SAMPLE_BYTES of each, which is more than a dictionary can hold). Of records with equal payloads that with the smallest page_id is a
response, the others are revisits that name it; payloads below `least_bytes` are always responses.

Files are written by Spark's committer, in pieces of about PIECE_BYTES, a row each: the line feed that it puts behind a row
is the content of a skippable frame, so each file is a plain Zstandard stream. Every file has the same number of rows;
those left over when it is full are such frames alone. Read back, a file reaches Python in parts of PART_BYTES and is
taken as a stream, so Arrow and Python hold no whole file; the JVM's heap still does, as binaryFile reads it whole. The smallest page_id of each digest comes from partial
aggregates and is a table of its own with digests of several records only, so adaptive joins can split a hot payload.

Edge cases: null html is an empty payload; a null page_id is never referred to and stays null; rows that repeat the
smallest page_id of a payload are all responses; a null url gives a record without a target; control characters in urls
are percent-encoded; a very long payload is one record, held whole while it is written; an empty table gives no record; extra
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
from collections.abc import Iterable, Iterator
from itertools import groupby, pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

DICT_MAGIC = 0x184D2A5D
PAD_MAGIC = 0x184D2A50
DICT_BYTES = 112_640
SAMPLES, SAMPLE_BYTES = 400, 65_536
FILE_BYTES = 24 << 20
PIECE_BYTES = 1 << 18  # of an archive, in a row on its way to the writer
PART_BYTES = 1 << 10  # of an archive, in a row on its way from the reader: Spark's 10,000 rows a batch are 10 MB then
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC/1.1 record; a revisit if refers_to is given."""
    digest = base32_sha1(payload)
    name = lambda i: f"<urn:page:{'null' if i is None else i}>"
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-X-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(refers_to)}"]
    body = HTTP + payload if refers_to is None else HTTP
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def skippable(magic: int, body: bytes) -> bytes:
    return struct.pack("<II", magic, len(body)) + body


def train_dictionary(samples: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A trained dictionary, or the samples themselves as raw content where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def open_dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    if not raw:
        return None
    trained = raw[:4] == struct.pack("<I", 0xEC30A437)
    return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)


class _Parts(io.RawIOBase):
    """A stream over consecutive parts of a file, one held at a time."""

    def __init__(self, parts: Iterable[memoryview]) -> None:
        self.parts, self.part = iter(parts), memoryview(b"")

    def readable(self) -> bool:
        return True

    def readinto(self, into: memoryview) -> int:
        while not self.part:
            part = next(self.parts, None)
            if part is None:
                return 0
            self.part = part
        n = min(len(into), len(self.part))
        into[:n], self.part = self.part[:n], self.part[n:]
        return n


def read_archive(data: bytes | io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive: its bytes or a stream of them."""
    source = data if isinstance(data, io.BufferedIOBase) else io.BytesIO(data)
    magic, size = struct.unpack("<II", source.read(8))
    if magic != DICT_MAGIC:
        raise ValueError("the archive does not start with a dictionary frame")
    shared = open_dictionary(source.read(size))
    plain = zstandard.ZstdDecompressor(dict_data=shared) if shared else zstandard.ZstdDecompressor()
    with plain.stream_reader(source, read_across_frames=True, closefd=False) as raw:
        stream = io.BufferedReader(raw, 1 << 18)
        while line := stream.readline():
            if line.strip() != b"WARC/1.1":
                raise ValueError(f"no record at {line[:40]!r}")
            head: dict[str, str] = {}
            while (line := stream.readline().rstrip(b"\r\n")) != b"":
                k, _, v = line.decode().partition(": ")
                head[k] = v
            block = stream.read(int(head["Content-Length"]))
            stream.read(4)
            yield head, block


def _first_of_digest(pages: DataFrame, least_bytes: int) -> DataFrame:
    slim = pages.select("page_id", F.unhex(F.sha1(F.col("payload"))).alias("digest"), F.octet_length("payload").alias("n")).where(F.col("n") >= least_bytes)
    firsts = slim.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("many")).where("many > 1 and first is not null")
    return C.materialize(firsts.select("digest", "first"), "firsts")


def write(pages: DataFrame, path: str, least_bytes: int = 0, file_bytes: int = FILE_BYTES) -> None:
    """Archive all pages in files under `path`."""
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"))
    firsts = _first_of_digest(source, least_bytes)
    ids = C.smallest_by_hash(source.select(F.xxhash64("payload").alias("h")), ["h"], SAMPLES)
    sample = source.withColumn("h", F.xxhash64("payload")).join(F.broadcast(ids), "h").groupBy("h").agg(F.min(F.substring("payload", 1, SAMPLE_BYTES)).alias("payload"))
    raw = train_dictionary([record(None, None, bytes(r.payload), None) for r in sorted(sample.collect(), key=lambda r: (r.h, bytes(r.payload)))])
    shared = pages.sparkSession.sparkContext.broadcast(raw)  # at most DICT_BYTES

    rows = max(1, -(-file_bytes // PIECE_BYTES))  # of a file

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = open_dictionary(shared.value)
        if known:
            known.precompute_compress(level=LEVEL)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=known) if known else zstandard.ZstdCompressor(level=LEVEL)
        lead = skippable(DICT_MAGIC, shared.value)
        end = struct.pack("<II", PAD_MAGIC, 1)  # the writer's line feed follows
        piece = lambda frames: pa.RecordBatch.from_arrays([pa.array([b"".join([*frames, end])], pa.binary())], ["body"])
        held, waiting, size, written = [lead], 0, 0, 0
        for batch in batches:
            ids, urls, firsts_ = (batch.column(k).to_pylist() for k in (0, 1, 3))
            for at, payload in enumerate(batch.column(2)):
                refers = firsts_[at] if firsts_[at] is not None and firsts_[at] != ids[at] else None
                frame = packer.compress(record(ids[at], urls[at], payload.as_buffer().to_pybytes(), refers))
                held.append(frame)
                waiting += len(frame)
                size += len(frame)
                if waiting >= PIECE_BYTES or size >= file_bytes:
                    yield piece(held)
                    held, waiting, written = [], 0, written + 1
                if size >= file_bytes:
                    if written < rows:
                        yield pa.RecordBatch.from_arrays([pa.array([end] * (rows - written), pa.binary())], ["body"])
                    held, size, written = [lead], 0, 0
        if waiting:
            yield piece(held)

    marked = source.withColumn("digest", F.unhex(F.sha1("payload"))).join(firsts, "digest", "left")
    marked = marked.select("page_id", "url", "payload", F.when(F.octet_length("payload") >= least_bytes, F.col("first")).alias("first"))
    marked.mapInArrow(files, "body binary").select(F.col("body").cast("string").alias("value")).write.option("maxRecordsPerFile", rows).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row of RESULT for each record in the archives; a response whose payload has another digest than it says is an error."""

    def number(name: str) -> int | None:
        part = name.rpartition(":")[2].rstrip(">")
        return None if part == "null" else int(part)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, memoryview]]:
        """(number of the file, bytes) of the rows of one file that a batch holds."""
        n = 0
        for batch in batches:
            at, body = batch.column(0).to_numpy(), batch.column(1)
            for i, j in pairwise([*sorted({0, *np.flatnonzero(at == 1).tolist()}), len(at)]):
                if i < j:
                    n += int(at[i] == 1)
                    yield n, memoryview(C.utf8(body.slice(i, j - i))[0])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []

        def taken() -> pa.RecordBatch:
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], [x.split()[0] for x in RESULT.split(", ")])

        for _, file in groupby(parts(batches), key=lambda x: x[0]):
            for head, block in read_archive(io.BufferedReader(_Parts(part for _, part in file))):
                digest, size = head["WARC-Payload-Digest"].removeprefix("sha1:"), int(head["WARC-X-Payload-Length"])
                if head["WARC-Type"] == "response":
                    payload = block[len(HTTP) :]
                    if len(payload) != size or base32_sha1(payload) != digest:
                        raise ValueError(f"record {head['WARC-Record-ID']} is damaged")
                refers = number(head["WARC-Refers-To"]) if "WARC-Refers-To" in head else None
                rows.append((number(head["WARC-Record-ID"]), size, digest, head["WARC-Type"], refers))
                if len(rows) >= C.CHUNK_ROWS:
                    yield taken()
                    rows = []
        if rows:
            yield taken()

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0").select("content")
    places = files.select("content", F.explode(F.sequence(F.lit(1), F.octet_length("content"), F.lit(PART_BYTES))).alias("at"))
    return places.select("at", F.substring("content", F.col("at"), F.lit(PART_BYTES)).alias("part")).mapInArrow(parse, RESULT)


def archive(pages: DataFrame, path: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Write the pages and read the archives back."""
    path = path or C.scratch_path(pages.sparkSession, "warc")
    write(pages, path, least_bytes)
    return read(pages.sparkSession, path)


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, upper(sha1(payload)) AS hex FROM p),
e AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first_id FROM d),
-- base 32: the i-th of 32 groups of five bits, from the two hex digits that hold it
f AS (SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
  ((((position(substr(hex, CAST((5 * i) // 4 AS INTEGER) + 1, 1) IN '0123456789ABCDEF') - 1) * 16
    + position(substr(hex || '0', CAST((5 * i) // 4 AS INTEGER) + 2, 1) IN '0123456789ABCDEF') - 1) // CAST(pow(2, 3 - (5 * i) % 4) AS INTEGER)) % 32) AS INTEGER) + 1, 1)), '') AS b32 FROM e)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, b32 AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM f
"""
