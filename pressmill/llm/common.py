"""Shared parts of the training-data operators: scratch tables and vectorised views of Arrow text columns.

The text kernels work on the UTF-8 bytes of a whole Arrow batch at once. They never build Python strings; memory is
bounded by cutting batches into row ranges of about CHUNK bytes and at most CHUNK_ROWS rows (a longer text makes a range of
its own).
"""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK, CHUNK_ROWS = 1 << 19, 1 << 11
WORD = r"[^\x20\x09-\x0D]+"

_own_scratch: str | None = None


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder under spark.checkpoint.dir; under a temporary one where that is unset (local sessions, tests)."""
    global _own_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        _own_scratch = _own_scratch or tempfile.mkdtemp(prefix="pressmill-")
        base = f"file://{_own_scratch}"
    return f"{base.rstrip('/')}/pressmill/{tag}-{uuid.uuid4().hex}"


class Scratch:
    """Tables of one operator run, in one shared folder: written as Parquet and read back, which cuts lineage and survives lost executors. What is no longer read can be dropped."""

    def __init__(self, spark: SparkSession, tag: str) -> None:
        self.spark, self.base = spark, scratch_path(spark, tag)
        self.paths: dict[int, tuple[DataFrame, str]] = {}
        self.count = 0

    def table(self, df: DataFrame, tag: str) -> DataFrame:
        self.count += 1
        path = f"{self.base}/{self.count:03d}-{tag}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        """Delete tables of this scratch folder (others are left alone)."""
        for t in tables:
            if id(t) in self.paths:
                delete(self.spark, self.paths.pop(id(t))[1])

    def drop_all_but(self, *tables: DataFrame) -> None:
        keep = {id(t) for t in tables}
        self.drop(*[t for k, (t, _) in list(self.paths.items()) if k not in keep])


def delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """One table in a scratch folder of its own."""
    return Scratch(df.sparkSession, tag).table(df, tag)


BUCKETS = 1 << 16


def smallest_by_hash(df: DataFrame, columns: list[str], n: int) -> DataFrame:
    """The n distinct rows (of df's columns `columns`) of smallest hash, as a local table; columns that repeat count once.

    A histogram of hash prefixes (at most BUCKETS rows) says below which prefix the first n rows lie, so tasks send those
    rows only; where repeats fill the prefixes, further ones are taken until n distinct rows are found or none are left.
    """
    spark, key = df.sparkSession, F.xxhash64(*columns)
    prefix = F.shiftrightunsigned(key, 48)
    counts = sorted((r["p"], r["count"]) for r in df.groupBy(prefix.alias("p")).count().collect())
    want, rows = n, []
    while True:
        upto, seen = -1, 0
        for place, count in counts:
            upto, seen = place, seen + count
            if seen >= want:
                break
        rows = df.where(prefix <= upto).select(*columns).distinct().orderBy(F.shiftrightunsigned(F.xxhash64(*columns), 1), *columns).limit(n).collect()
        if len(rows) >= n or seen < want or not counts or upto == counts[-1][0]:
            return spark.createDataFrame(rows, df.select(*columns).schema)
        want *= 4


def training_texts(documents: DataFrame, known: DataFrame, n: int, most_bytes: int) -> DataFrame:
    """A bounded sample of labelled texts: rows of documents (its columns and those of known) with at most n different pairs
    of doc_id and text and most_bytes of text in all, whole texts only.

    known: doc_id and further columns, distinct. The n doc_ids of smallest hash are looked up; rows that repeat one with
    the same text count once, and of more than n rows, those of smallest hash stay. A text that would exceed the bytes is passed over.
    """
    spark = documents.sparkSession
    few = smallest_by_hash(known, known.columns, n)
    other = [c for c in [*documents.columns, *known.columns[1:]] if c not in ("doc_id", "text")]
    found = documents.where("text is not null").join(F.broadcast(few), "doc_id").groupBy("doc_id", *other, F.xxhash64("text").alias("text_key")).agg(F.min("text").alias("text"))
    found = materialize(found.withColumn("text_bytes", F.octet_length("text").cast("long")), "sample")
    held, chosen = 0, []
    for r in smallest_by_hash(found, ["doc_id", "text_key", "text_bytes"], n).collect():
        if held + r["text_bytes"] <= most_bytes:
            held += r["text_bytes"]
            chosen.append((r["doc_id"], r["text_key"]))
    picked = spark.createDataFrame(chosen, "doc_id long, text_key long")
    return found.join(F.broadcast(picked), ["doc_id", "text_key"]).select(*other, "text")


def free_name(name: str, taken: list[str]) -> str:
    """A column name that is not taken (case doesn't matter)."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name


def crc_mod(key: Column | str, n: int) -> Column:
    """crc32 of the key written as text, modulo n."""
    return F.crc32(F.col(key).cast("string").cast("binary") if isinstance(key, str) else key.cast("string").cast("binary")) % n


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    n = len(column)
    if n == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    d = np.frombuffer(data, np.uint8)[o[0] : o[-1]] if data is not None else np.zeros(0, np.uint8)
    return d, o - o[0]


def row_ranges(offsets: np.ndarray, limit: int = CHUNK, rows: int = CHUNK_ROWS) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most limit bytes and rows each, a longer row alone."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, n, i + rows)
        yield i, j
        i = j


def text_chunks(batches: Iterator[pa.RecordBatch], name: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row ranges of the batches with the bytes and offsets of their text column."""
    for batch in batches:
        data, offs = utf8(batch.column(batch.schema.get_field_index(name)))
        for i, j in row_ranges(offs):
            yield batch.slice(i, j - i), data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def spans_of(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of true bytes that don't cross rows: starts, ends (exclusive) and the number of runs in each row."""
    n = len(inside)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets) - 1, np.int64)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = offsets[:-1][offsets[:-1] < n]
    first[edge] = inside[edge]
    edge = offsets[1:][offsets[1:] > 0] - 1
    last[edge] = inside[edge]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


_MULT = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(20260101).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers[kind]
    if len(have) < n:
        step = np.full(max(n, 2 * CHUNK), _MULT if kind == "up" else _INV, np.uint64)
        step[0] = 1
        have = _powers[kind] = np.multiply.accumulate(step)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, the same wherever the bytes stand."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power("up", len(data)), out=total[1:])
    return mix((total[ends] - total[starts]) * _power("down", len(data))[starts] + (ends - starts).astype(np.uint64))


def rank_in_group(order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """For rows sorted by `order`, with `new` marking each group's first sorted row: the place in its group of each original row."""
    at = np.arange(len(order))
    first = np.maximum.accumulate(np.where(new, at, 0))
    out = np.empty(len(order), np.int64)
    out[order] = at - first
    return out


def crc32_of(key: object) -> int:
    return zlib.crc32(str(key).encode())
