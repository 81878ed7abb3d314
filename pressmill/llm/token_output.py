"""Token-ID / binary output in patched frame-of-reference blocks.

Texts are encoded with a given tokenizer file, an end id is appended to each, and the ids are written in ascending
doc_id order as binary files of segments. A segment holds whole documents (about SEGMENT_TOKENS ids):

    magic 'PFR1' | u32 block size, u32 blocks, u64 ids, u64 documents, u32 task, u32 number in the task, u64 exceptions
    i64 doc_id and u8 has-an-id of each document | u64 length of each document
    u32 minimum, u8 width, u32 exceptions of each block | u64 start of each block's packed bits
    u16 place and u32 value of each exception, block after block | u64 size of the packed bits, the packed bits

Each block of BLOCK ids has its minimum subtracted; the width is the PERCENTILE of the bit lengths left, the low bits
are packed at this width (big-endian) and ids that need more are listed whole as exceptions. Block starts are indexed,
so any block can be read alone. The last block is filled with its own minimum. All numbers are little-endian.

Files are written by Spark's own committer (each segment ends in one line feed, which is not part of it), so they work
on any file system that Spark knows and survive lost executors. A text is encoded by its white-space runs, which the
tokenizer's rules never join, each distinct run once in each worker while it is remembered.

Edge cases: null and empty texts give the end id only; a null doc_id comes before all others; repeated doc_ids stand
together in the order of their text's hash; a long text makes a segment of its own; an empty table gives no document;
extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

BLOCK, BLOCKS = 256, 256  # ids of a block; blocks whose bits are laid out at once
PERCENTILE = 0.98  # an exception takes 48 bits, so a bit of width pays when over 1 in 48 ids need it
SEGMENT_TOKENS = 1 << 20
SEGMENTS_PER_FILE = 32
END_ID = 1
REMEMBERED, REMEMBERED_BYTES = 300_000, 1 << 25
AT_ONCE = 1 << 16  # runs that are looked up at once

_HEAD = struct.Struct("<4sIIQQIIQ")


# ---- block format


def _by_width(width: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Widths above 0 and at most BLOCKS blocks that have them."""
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        for i in range(0, len(rows), BLOCKS):
            yield w, rows[i : i + BLOCKS]


def pack(ids: np.ndarray, doc_ids: list[int | None], lengths: np.ndarray, task: int = 0, number: int = 0) -> bytes:
    """One segment."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    x = np.zeros(blocks * BLOCK, np.uint32)
    x[:n] = ids
    if n % BLOCK:
        x[n:] = x[(blocks - 1) * BLOCK : n].min()
    x = x.reshape(blocks, BLOCK)
    low = x.min(1) if blocks else np.zeros(0, np.uint32)
    x -= low[:, None]
    bits = np.empty(x.shape, np.uint8)
    for i in range(0, blocks, BLOCKS):
        bits[i : i + BLOCKS] = np.frexp(x[i : i + BLOCKS].astype(np.float64))[1]
    at = min(BLOCK - 1, int(np.ceil(PERCENTILE * BLOCK)) - 1)
    width = np.partition(bits, at, 1)[:, at].astype(np.int64) if blocks else np.zeros(0, np.int64)
    over = bits > width[:, None]
    where, place = np.nonzero(over)
    starts = np.concatenate(([0], np.cumsum(width * (BLOCK // 8))))
    packed = np.zeros(starts[-1], np.uint8)
    for w, rows in _by_width(width):
        kind, size = (">u2", 16) if w <= 16 else (">u4", 32)
        raw = np.unpackbits((x[rows] & ((1 << w) - 1)).astype(kind).view(np.uint8).reshape(len(rows), BLOCK, size // 8), axis=2)
        body = np.packbits(raw[:, :, size - w :].reshape(len(rows), -1), axis=1)
        packed[(starts[rows][:, None] + np.arange(body.shape[1])).reshape(-1)] = body.reshape(-1)
    head = _HEAD.pack(b"PFR1", BLOCK, blocks, n, len(doc_ids), task, number, len(place))
    parts = [
        np.array([d or 0 for d in doc_ids], "<i8"), np.array([d is not None for d in doc_ids], "u1"), lengths.astype("<u8"),
        low.astype("<u4"), width.astype("u1"), over.sum(1).astype("<u4"), starts[:-1].astype("<u8"),
        place.astype("<u2"), x[where, place].astype("<u4"), np.array([len(packed)], "<u8"), packed,
    ]
    return head + b"".join(p.tobytes() for p in parts)


def unpack(data: bytes | memoryview, at: int = 0) -> tuple[dict, int]:
    """The segment that starts at `at` (ids, doc_ids, lengths, task, number), and where it ends."""
    magic, block, blocks, n, docs, task, number, exceptions = _HEAD.unpack_from(data, at)
    if magic != b"PFR1":
        raise ValueError(f"no segment at byte {at}")
    at += _HEAD.size

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, count, at)
        at += out.nbytes
        return out

    doc_ids, known, lengths = take("<i8", docs), take("u1", docs), take("<u8", docs)
    low, width, many, starts = take("<u4", blocks), take("u1", blocks), take("<u4", blocks), take("<u8", blocks)
    place, value = take("<u2", exceptions), take("<u4", exceptions)
    packed = take("u1", int(take("<u8", 1)[0]))
    x = np.zeros((blocks, block), np.uint32)
    for w, rows in _by_width(width):
        kind, size = (">u2", 16) if w <= 16 else (">u4", 32)
        body = packed[starts[rows].astype(np.int64)[:, None] + np.arange(block * w // 8)]
        raw = np.zeros((len(rows), block, size), np.uint8)
        raw[:, :, size - w :] = np.unpackbits(body, axis=1).reshape(len(rows), block, w)
        x[rows] = np.packbits(raw.reshape(len(rows), -1), axis=1).view(kind).reshape(len(rows), block)
    x[np.repeat(np.arange(blocks), many), place] = value
    x += low[:, None]
    ids = [int(d) if k else None for d, k in zip(doc_ids, known, strict=True)]
    return {"ids": x.reshape(-1)[:n].astype("<u4"), "doc_ids": ids, "lengths": lengths.astype(np.int64), "task": task, "number": number}, at


# ---- encoding


def _letter_bytes() -> tuple[np.ndarray, np.ndarray]:
    """For (byte before, byte) of UTF-8: is this a byte of a letter below U+0130, and the byte that it has in lower case.

    Lower case changes the last byte of these letters only."""
    letter, lower = np.zeros((256, 256), bool), np.tile(np.arange(256, dtype=np.uint8), (256, 1))
    for c in map(chr, range(0x130)):
        if c.isalpha():
            *lead, last = c.encode()
            letter[lead or slice(None), last] = True
            lower[lead or slice(None), last] = c.lower().encode()[-1]
            letter[:, lead] = True
    return letter.reshape(-1), lower.reshape(-1)


def _with_room(a: np.ndarray, n: int) -> np.ndarray:
    """a with place for n; what is not used yet takes no memory."""
    if n <= len(a):
        return a
    out = np.empty(max(n, 2 * len(a)), a.dtype)
    out[: len(a)] = a
    return out


class Runs:
    """Runs of bytes in an array, as keys that hold all bytes and the length of a run of up to WIDEST."""

    WIDEST = 15
    _mask = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF, 0xFFFFFFFFFF, 0xFFFFFFFFFFFF, 0xFFFFFFFFFFFFFF, 0xFFFFFFFFFFFFFFFF], np.uint64)

    def __init__(self, data: np.ndarray) -> None:
        self.data = np.concatenate((data, np.zeros(24, np.uint8)))
        self.eight = np.ndarray(len(data) + 17, "<u8", self.data, strides=(1,))

    def keys(self, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = self.eight[starts] & self._mask[np.minimum(sizes, 8)]
        return low, self.eight[starts + 8] & self._mask[np.maximum(sizes - 8, 0)] | sizes.astype(np.uint64) << np.uint64(56)


class Known:
    """Ids of runs by their keys: a hash table with open addressing whose steps are taken for all rows at once. Knows how often each was used."""

    def __init__(self, room: int) -> None:
        """room: how many keys are expected at most. Arrays are made once, as memory that is taken and freed again stays with the worker."""
        self.n = self.used = 0
        self.low, self.high, self.uses = np.empty(room, np.uint64), np.empty(room, np.uint64), np.empty(room, np.int64)
        self.begin, self.size, self.flat = np.empty(room, np.int32), np.empty(room, np.int32), np.empty(8 * room, np.uint32)
        self._slots((2 * room).bit_length())

    def _slots(self, bits: int) -> None:
        self.bits, self.slots = bits, np.full(1 << bits, -1, np.int32)

    def _first_slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (C.mix(low ^ C.mix(high)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _enter(self, low: np.ndarray, high: np.ndarray, at: np.ndarray) -> None:
        slot, last = self._first_slot(low, high), (1 << self.bits) - 1
        while len(at):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = at[free]
            left = np.flatnonzero(self.slots[slot] != at)
            at, slot = at[left], slot[left] + 1 & last

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The place of each key, -1 for new ones."""
        slot, last = self._first_slot(low, high), (1 << self.bits) - 1
        found = self.slots[slot].astype(np.int64)
        todo = np.flatnonzero((found >= 0) & ((self.high[found] != high) | (self.low[found] != low)))
        while len(todo):
            slot[todo] = at = slot[todo] + 1 & last
            found[todo] = there = self.slots[at]
            todo = todo[(there >= 0) & ((self.high[there] != high[todo]) | (self.low[there] != low[todo]))]
        return found

    def add(self, low: np.ndarray, high: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """New keys, none twice, with their ids end to end; their places."""
        a, b, used = self.n, self.n + len(low), self.used + len(ids)
        self.low, self.high, self.begin, self.size, self.uses = (_with_room(x, b) for x in (self.low, self.high, self.begin, self.size, self.uses))
        self.flat = _with_room(self.flat, used)
        self.low[a:b], self.high[a:b], self.size[a:b], self.uses[a:b] = low, high, sizes, 0
        self.begin[a:b] = self.used + np.cumsum(sizes) - sizes
        self.flat[self.used : used] = ids
        self.n, self.used, at = b, used, np.arange(a, b)
        if 2 * b > 1 << self.bits:
            self._slots((2 * b).bit_length())
            self._enter(self.low[:b], self.high[:b], np.arange(b))
        else:
            self._enter(low, high, at)
        return at

    def use(self, index: np.ndarray) -> None:
        self.uses[: self.n] += np.bincount(index, minlength=self.n)

    def shrink(self, most: int) -> None:
        """Beyond `most` keys, keep half as many: the ones used most, the later of equals."""
        if self.n > most:
            keep = np.sort(np.argsort(self.uses[: self.n], kind="stable")[self.n - most // 2 :])
            ids, n = _taken(self.flat, self.begin[keep], self.size[keep]), len(keep)
            for a in (self.low, self.high, self.size, self.uses):
                a[:n] = a[keep]
            self.uses[:n] //= 2
            self.begin[:n] = np.cumsum(self.size[:n]) - self.size[:n]
            self.flat[: len(ids)] = ids
            self.n, self.used = n, len(ids)
            self.slots.fill(-1)
            self._enter(self.low[:n], self.high[:n], np.arange(n))


def _taken(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """flat[b : b + n] of all b and n, end to end; places beyond its end give its last."""
    ends = np.cumsum(size)
    return flat.take(np.repeat(begin - ends + size, size) + np.arange(ends[-1] if len(ends) else 0), mode="clip")


def _distinct(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows with the first of each key, and which of these each row has."""
    order = np.lexsort((low, high))
    first = np.ones(len(order), bool)
    first[1:] = (low[order[1:]] != low[order[:-1]]) | (high[order[1:]] != high[order[:-1]])
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(first) - 1
    return order[first], which


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.fromiter(chain.from_iterable(lists), np.uint32), np.fromiter(map(len, lists), np.int64, len(lists))


class Encoder:
    """Ids of texts, by runs between ASCII white space.

    Runs of up to Runs.WIDEST bytes are looked up AT_ONCE by their bytes; about REMEMBERED of them and of their units are
    remembered, the ones used most when it gets too many. Longer runs are remembered up to REMEMBERED_BYTES.
    """

    _kept: dict[str, Encoder] = {}
    _marks = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'")
    _is_mark = np.isin(np.arange(256), list(_marks.encode()))
    _letter, _lower = _letter_bytes()

    @classmethod
    def of(cls, path: str) -> Encoder:
        """One for each worker process and file."""
        if path not in cls._kept:
            cls._kept[path] = cls(path)
        return cls._kept[path]

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.bytes_of = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters: dict[int, str] = {ord("\n"): "\n"}
        # letters followed by marks are two units of this pre-tokenizer only if it has its usual rule
        self._forget()
        self.splits = self._probe()
        if not self.splits:
            self._forget()

    def _forget(self) -> None:
        self.known, self.units = Known(REMEMBERED + AT_ONCE), Known(REMEMBERED + 2 * AT_ONCE)
        self.long: dict[bytes, array] = {}
        self.older: dict[bytes, array] = {}
        self.long_bytes = 0

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _probe(self) -> bool:
        """Does the short way give the tokenizer's own ids on letters with marks behind them?"""
        words = ["Word", "straße,", "Él***", "the.", "ñandú!!", "A", "x$$$", "ÇA).", "Überraschungsgäste..."]
        self.splits = True
        try:
            ids, counts = self.encode(words)
            return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [self.whole(w) for w in words]
        except Exception:
            return False

    def _units(self, parts: list[str]) -> list[list[int]]:
        """Ids of parts of words, each not empty."""
        text = "\n".join(parts)
        for c in set(text):
            if ord(c) not in self.letters:
                self.letters[ord(c)] = "".join(x for x, _ in self.bytes_of.pre_tokenize_str(c))
        tokenize = self.model.tokenize
        return [[t.id for t in tokenize(p)] for p in text.translate(self.letters).split("\n")]

    def _learn(self, runs: Runs, starts: np.ndarray, sizes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Adds new short runs, none twice; their places."""
        column = np.arange(16)
        text = runs.data[starts[:, None] + column]
        inside = column < sizes[:, None]
        solid = inside & ~self._is_mark[text]
        core = np.where(solid.any(1), 16 - solid[:, ::-1].argmax(1), 0)
        inside = column < core[:, None]
        pairs = text.astype(np.uint16)
        pairs[:, 1:] |= pairs[:, :-1] << 8
        plain = np.flatnonzero((core > 0) & (self._letter[pairs] | ~inside).all(1) & self.splits)
        at = np.full(len(starts), -1, np.int64)
        if len(plain):
            core, tail = core[plain], sizes[plain] - core[plain]
            lower = Runs(np.where(inside[plain], self._lower[pairs[plain]], 0).reshape(-1))
            two = np.flatnonzero(tail)
            unit_low, unit_high = lower.keys(16 * np.arange(len(plain)), core)
            tail_low, tail_high = runs.keys((starts[plain] + core)[two], tail[two])
            unit_low, unit_high = np.concatenate((unit_low, tail_low)), np.concatenate((unit_high, tail_high))
            found = self.units.find(unit_low, unit_high)
            new = np.flatnonzero(found < 0)
            if len(new):
                first, which = _distinct(unit_low[new], unit_high[new])
                some = new[first]
                body = np.stack((unit_low[some], unit_high[some]), 1).astype("<u8").tobytes()
                parts = [body[16 * i : 16 * i + body[16 * i + 15]].decode() for i in range(len(some))]
                found[new] = self.units.add(unit_low[some], unit_high[some], *_flat(self._units(parts)))[which]
            self.units.use(found)
            begin, size = np.zeros((len(plain), 2), np.int64), np.zeros((len(plain), 2), np.int64)
            begin[:, 0], size[:, 0] = self.units.begin[found[: len(plain)]], self.units.size[found[: len(plain)]]
            begin[two, 1], size[two, 1] = self.units.begin[found[len(plain) :]], self.units.size[found[len(plain) :]]
            at[plain] = self.known.add(low[plain], high[plain], _taken(self.units.flat, begin.reshape(-1), size.reshape(-1)), size.sum(1))
        other = np.flatnonzero(at < 0)
        if len(other):
            words = [runs.data[a : a + n].tobytes().decode() for a, n in zip(starts[other].tolist(), sizes[other].tolist(), strict=True)]
            at[other] = self.known.add(low[other], high[other], *_flat([self.whole(w) for w in words]))
        return at

    def _long(self, run: bytes) -> array:
        """Ids of a run of more than Runs.WIDEST bytes."""
        ids = self.long.get(run)
        if ids is None:
            ids = self.older.get(run)
            if ids is None:
                word = run.decode()
                core = word.rstrip(self._marks)
                if self.splits and core.isalpha() and (core.isascii() or max(core) < "İ"):
                    ids = array("I", chain.from_iterable(self._units([p for p in (core.lower(), word[len(core) :]) if p])))
                else:
                    ids = array("I", self.whole(word))
            weight = len(run) + 4 * len(ids) + 250
            if self.long_bytes + weight > REMEMBERED_BYTES // 2:
                self.older, self.long, self.long_bytes = self.long, {}, 0
            if weight <= REMEMBERED_BYTES // 2:
                self.long[run] = ids
                self.long_bytes += weight
        return ids

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end (no end ids), and how many each has."""
        return self.encode_bytes(*C.utf8(pa.array(texts, pa.large_string())))

    def encode_bytes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """encode() of the texts that lie between the offsets."""
        starts, ends, in_row = C.spans_of(~C.SPACE[data], offsets)
        runs = Runs(data)
        parts = [self._encode_runs(runs, starts[i : i + AT_ONCE], ends[i : i + AT_ONCE]) for i in range(0, max(1, len(starts)), AT_ONCE)]
        total = np.concatenate(([0], np.cumsum(np.concatenate([p[1] for p in parts]))))
        return np.concatenate([p[0] for p in parts]), np.diff(total[np.concatenate(([0], np.cumsum(in_row)))])

    def _encode_runs(self, runs: Runs, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all runs end to end, and how many each has."""
        self.known.shrink(REMEMBERED)
        self.units.shrink(REMEMBERED)
        sizes = ends - starts
        begin, count = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        long, short = np.flatnonzero(sizes > Runs.WIDEST), np.flatnonzero(sizes <= Runs.WIDEST)
        s, n = starts[short], sizes[short]
        low, high = runs.keys(s, n)
        index = self.known.find(low, high)
        new = np.flatnonzero(index < 0)
        if len(new):
            first, which = _distinct(low[new], high[new])
            some = new[first]
            index[new] = self._learn(runs, s[some], n[some], low[some], high[some])[which]
        self.known.use(index)
        begin[short], count[short] = self.known.begin[index], self.known.size[index]
        got = [self._long(runs.data[a:b].tobytes()) for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)]
        count[long] = [len(g) for g in got]
        ids, after = _taken(self.known.flat, begin, count), np.cumsum(count)
        for i, g in zip(after[long].tolist(), got, strict=True):
            ids[i - len(g) : i] = g
        return ids, count


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file on this machine; workers look it up themselves."""
    import public_tokenizers

    return public_tokenizers.path(name)


# ---- files


def write(documents: DataFrame, tokenizer: str, path: str, end_id: int = END_ID) -> None:
    """Encode and write all documents to the folder `path`; tokenizer: a file's path, or 'public:' and a name."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder.of(tokenizer_path(tokenizer[7:]) if tokenizer.startswith("public:") else tokenizer)
        task, number = TaskContext.get().partitionId(), 0
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        tokens = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, tokens, number
            body = pack(np.concatenate([h[1] for h in held]), [d for h in held for d in h[0]], np.concatenate([h[2] for h in held]), task, number)
            held, tokens, number = [], 0, number + 1
            return pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], ["body"])

        for batch, data, offsets in C.text_chunks(batches):
            ids, counts = coder.encode_bytes(data, offsets)
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, end_id)
            held.append((batch.column(0).to_pylist(), ids, counts + 1))
            tokens += len(ids)
            if tokens >= SEGMENT_TOKENS:
                yield flush()
        if held:
            yield flush()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_key")).repartitionByRange("doc_id", "_key").sortWithinPartitions("doc_id", "_key")
    body = rows.select("doc_id", "text").mapInArrow(segments, "body binary")
    body.select(F.col("body").cast("string").alias("value")).write.option("maxRecordsPerFile", SEGMENTS_PER_FILE).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(task, number, place, doc_id, n_tokens, ids_crc32, first) of each document in the files; first: ids before it in its segment."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                data, at = memoryview(content.as_buffer()), 0
                while at < len(data):
                    s, at = unpack(data, at)
                    at += 1
                    raw, ends = memoryview(s["ids"].tobytes()), np.cumsum(s["lengths"])
                    first = ends - s["lengths"]
                    crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
                    n = len(crc)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, s["task"], np.int64)), pa.array(np.full(n, s["number"], np.int64)), pa.array(np.arange(n)), pa.array(s["doc_ids"], pa.int64()), pa.array(s["lengths"]), pa.array(crc, pa.int64()), pa.array(first)],
                        ["task", "number", "place", "doc_id", "n_tokens", "ids_crc32", "first"],
                    )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(decode, "task long, number long, place long, doc_id long, n_tokens long, ids_crc32 long, first long")


def documents_of(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files at `path`. Segments are summed by task first, so the running sum over all data has one row per task."""
    scratch = C.Scratch(spark, "tokens")
    rows = scratch.table(read(spark, path), "decoded")
    segments = rows.groupBy("task", "number").agg(F.sum("n_tokens").alias("ids"))
    within = Window.partitionBy("task").orderBy("number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tasks = segments.groupBy("task").agg(F.sum("ids").alias("all_ids"))
    before = tasks.withColumn("base", F.sum("all_ids").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("all_ids"))
    starts = segments.withColumn("lead_in", F.sum("ids").over(within) - F.col("ids")).join(before, "task").select("task", "number", (F.col("lead_in") + F.col("base")).alias("begin"))
    return rows.join(scratch.table(starts, "starts"), ["task", "number"]).select("doc_id", (F.col("begin") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def encode_documents(documents: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Write the documents' ids and return documents_of() the files."""
    path = path or C.scratch_path(documents.sparkSession, "tokens")
    write(documents, tokenizer, path)
    return documents_of(documents.sparkSession, path)
