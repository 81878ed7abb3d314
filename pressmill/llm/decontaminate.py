"""Benchmark decontamination by spaced-seed hashing.

Tokens are runs of ASCII letters and digits or non-ASCII bytes of the lower-cased text. A mask looks at
its set positions only, so a replaced word at an unset position does not hide a match. The hashes of every mask at every
benchmark position are joined with those of the documents; each hit fixes a diagonal (document position minus item
position), along which the tokens are compared one by one. A run of aligned tokens counts as a leak when it holds a hit,
at least needed(item length) tokens agree and at least AGREE of its tokens agree: MIN_TOKENS, or AGREE of an item of SHORT
to MIN_TOKENS tokens.

A hit whose left neighbour is a hit too is passed over, the diagonals that are left are collected in portions of a fixed size,
and of each row and item those that agree most are tested first, until no other can win. So windows that are frequent in
the benchmark or a text (a stretch that repeats, a word a thousand times) take bounded memory, and none is dropped.

The benchmark side is used in blocks of at most `block_hashes` hashes, each of which is broadcast and given up before the
next but one: a block has a fixed size however large the benchmark is, and all blocks see all documents. The last of MASKS leaves one of four neighbours
free at every place, so that a passage with every fourth word replaced has hits. Items of SHORT to MIN_TOKENS tokens use
SHORT_MASKS, which together hit every substitution that the rule allows them; shorter ones must agree in all tokens and
use one mask of their own length; items of fewer than MIN_ITEM tokens identify nothing and are left out, unless a smaller
`least` asks for them.

Edge cases: null and empty texts and items have no tokens and never match; a very long text is searched whole; repeated rows give repeated results, but
repeated items with one item_id give one row per document; ties between equally good diagonals go to the first in the
document; an empty table on either side gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

MASKS = ("110100110101", "101101011001", "111001010011", "111011101")
SHORT_MASKS = ("1111", "110011", "11000011")
SHORT = 8
MIN_TOKENS = 13
AGREE = 0.75
BLOCK_HASHES = 1_000_000
MIN_ITEM = 5

RESULT = "doc_id long, item_id long, n_aligned long, n_agree long, doc_token long, item_token long, item_tokens long"

_TOKEN = np.zeros(256, bool)
_TOKEN[[*range(ord("a"), ord("z") + 1), *range(ord("0"), ord("9") + 1), *range(0x80, 0x100)]] = True
_FACTORS = np.random.default_rng(11).integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BITS = 24
PAIRS = 1 << 20  # pairs of places, and diagonals, looked at together
CELLS = 1 << 21  # cells of a matrix of diagonals
NARROW = 200  # items of more tokens are tested diagonal by diagonal


def needed(length: int) -> int:
    """The least number of agreeing tokens for an item of this length."""
    return length if length < SHORT else math.ceil(AGREE * length) if length <= MIN_TOKENS else MIN_TOKENS


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all rows end to end, and the number of each row."""
    data, offs = C.utf8(pc.utf8_lower(column))
    starts, ends, count = C.spans_of(_TOKEN[data], offs)
    return C.span_hashes(data, starts, ends), count


def masked(h: np.ndarray, places: list[int], salt: int) -> np.ndarray:
    """Hash of the chosen places of the window that starts at each token (the last windows are left out)."""
    n = len(h) - places[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, salt, np.uint64)
    for j in places:
        out += h[j : j + n] * _FACTORS[j]
    return out ^ (out >> np.uint64(29))


@dataclass
class Windows:
    """The windows of one mask over the items that use it: each distinct hash once, with its run of item positions.

    A run is sorted by the window one place before (its number in `hashes`, -1 at an item's start), so that the positions that
    only continue a match are one stretch of it.
    """

    places: list[int]
    hashes: np.ndarray  # distinct, ascending
    begin: np.ndarray  # of each hash's run, and the end of the last
    before: np.ndarray  # number of the hash * (hashes + 1) + number of the hash before + 1, ascending
    item: np.ndarray
    at: np.ndarray


@dataclass
class Block:
    """Some benchmark items, as their token hashes and the windows of each mask."""

    items: list[tuple[int, np.ndarray]]
    masks: list[Windows]

    def __post_init__(self) -> None:
        self.filters = [self._filter(x.hashes) for x in self.masks]
        self.size = np.array([len(h) for _, h in self.items])
        self.first = np.cumsum(self.size) - self.size
        self.flat = np.concatenate([h for _, h in self.items])

    @staticmethod
    def _filter(hashes: np.ndarray) -> np.ndarray:
        bits = np.zeros(1 << _BITS >> 3, np.uint8)
        at = hashes >> np.uint64(64 - _BITS)
        np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), (1 << (at & np.uint64(7))).astype(np.uint8))
        return bits

    def __reduce__(self) -> tuple:
        return Block, (self.items, self.masks)


def masks_of(length: int) -> tuple[str, ...]:
    """The masks that items of this length use."""
    return MASKS if length > MIN_TOKENS else SHORT_MASKS if length >= SHORT else ("1" * length,)


def build(items: list[tuple[int, np.ndarray]]) -> Block:
    groups: dict[tuple[str, ...], list[int]] = {}
    for at, (_, h) in enumerate(items):
        groups.setdefault(masks_of(len(h)), []).append(at)
    masks = []
    for names, members in groups.items():
        for name in names:
            places = [j for j, c in enumerate(name) if c == "1"]
            each = [masked(items[at][1], places, _salt(places)) for at in members]
            hashes, number = np.unique(np.concatenate(each), return_inverse=True)
            item = np.repeat(members, [len(x) for x in each]).astype(np.int32)
            at = np.concatenate([np.arange(len(x)) for x in each]).astype(np.int32)
            left = np.where(at > 0, np.roll(number, 1), -1)
            before = number * (len(hashes) + 1) + left + 1
            order = np.argsort(before, kind="stable")
            begin = np.concatenate(([0], np.cumsum(np.bincount(number, minlength=len(hashes)))))
            masks.append(Windows(places, hashes, begin, before[order], item[order], at[order]))
    return Block(items, masks)


def _salt(places: list[int]) -> int:
    return len(places) * 1000 + places[-1]


def _best_run(agree: np.ndarray, hits: np.ndarray | int) -> tuple[int, int]:
    """The run [a, b) holding a hit that has most agreeing tokens of those of which at least AGREE agree, the first if several; it starts and ends with agreement."""
    score = np.concatenate([[0.0], np.cumsum(np.where(agree, 1 - AGREE, -AGREE))])
    same = np.concatenate([[0], np.cumsum(agree)])
    marks = np.zeros(len(agree), np.int64)
    marks[hits] = 1
    before = np.concatenate([[0], np.cumsum(marks)])
    # for each start the last end at which the score is no lower: the running maximum from the right never rises
    highest = np.maximum.accumulate(score[::-1])
    ends = len(agree) - np.searchsorted(highest, score, "left")
    held = before[ends] > before
    a = int(np.where(held, same[ends] - same, -1).argmax())
    inside = np.flatnonzero(agree[a : ends[a]])
    return a + int(inside[0]), a + int(inside[-1]) + 1


def _diagonals(h: np.ndarray, counts: np.ndarray, block: Block) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, item index, diagonal) with hits, in portions that hold each diagonal once; one may come again in a later portion.

    A hit whose left neighbour on the diagonal is a hit of the same mask adds no diagonal and is passed over without being
    looked at. What is left is spread over at most PAIRS pairs of places at a time.
    """
    ends = np.cumsum(counts)
    longest = int(block.size.max())
    width = len(h) + 2 * longest + 1
    held: list[np.ndarray] = []
    waiting = 0

    def portion() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        code = np.unique(np.concatenate(held))
        pair, diagonal = code // width, code % width - longest
        return pair // len(block.items), pair % len(block.items), diagonal

    for windows, bits in zip(block.masks, block.filters, strict=True):
        got = masked(h, windows.places, _salt(windows.places))
        if not len(got):
            continue
        top = got >> np.uint64(64 - _BITS)
        at = np.flatnonzero(bits[(top >> np.uint64(3)).astype(np.int64)] >> (top & np.uint64(7)).astype(np.uint8) & np.uint8(1))
        number = np.minimum(np.searchsorted(windows.hashes, got[at]), len(windows.hashes) - 1)
        row = np.searchsorted(ends, at, "right")
        inside = (windows.hashes[number] == got[at]) & (at + windows.places[-1] < ends[row])
        at, number, row = at[inside], number[inside], row[inside]
        if not len(at):
            continue
        goes_on = np.zeros(len(at), bool)
        goes_on[1:] = (np.diff(at) == 1) & (np.diff(row) == 0)
        key = number * (len(windows.hashes) + 1) + np.where(goes_on, np.roll(number, 1), -1) + 1
        low, high = windows.begin[number], windows.begin[number + 1]
        skip, rest = np.searchsorted(windows.before, key, "left"), np.searchsorted(windows.before, key, "right")
        skip, rest = np.where(goes_on, skip, high), np.where(goes_on, rest, high)
        ahead = skip - low
        many = ahead + high - rest
        upto = np.cumsum(many)
        a = 0
        while a < len(at):
            b = max(a + 1, int(np.searchsorted(upto, upto[a] - many[a] + PAIRS, "right")))
            n = many[a:b]
            who = np.repeat(np.arange(a, b), n)
            k = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
            k = np.where(k < ahead[who], low[who] + k, rest[who] + k - ahead[who])
            item, q = windows.item[k].astype(np.int64), windows.at[k]
            held.append(np.unique((row[who] * len(block.items) + item) * width + at[who] - q + longest))
            waiting += len(held[-1])
            if waiting >= PAIRS:
                yield portion()
                held, waiting = [], 0
            a = b
    if held:
        yield portion()


def _best_runs(agree: np.ndarray, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """_best_run of each row of two matrices (every row has a hit)."""
    n, k = agree.shape[1], np.arange(len(agree))
    lead = lambda x: np.concatenate([np.zeros((len(x), 1), x.dtype), np.cumsum(x, axis=1, dtype=x.dtype)], axis=1)
    score, same, before = lead(np.where(agree, 1 - AGREE, -AGREE)), lead(agree.astype(np.int32)), lead(hits.astype(np.int32))
    ends = n - (score[:, None, ::-1] >= score[:, :, None]).argmax(2)  # of each start the last end at which the score is no lower
    take = lambda x: np.take_along_axis(x, ends, 1)
    a = np.where(take(before) > before, take(same) - same, -1).argmax(1)
    b = ends[k, a]
    place = np.arange(n)
    inside = agree & (place >= a[:, None]) & (place < b[:, None])
    return inside.argmax(1), n - inside[:, ::-1].argmax(1)


def _agreement(h: np.ndarray, ends: np.ndarray, counts: np.ndarray, block: Block, n: int, r: np.ndarray, i: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Which tokens of items of n tokens agree along diagonals: one row for each."""
    at = d[:, None] + np.arange(n)
    inside = (at >= (ends - counts)[r][:, None]) & (at < ends[r][:, None])
    return inside & (h[np.clip(at, 0, len(h) - 1)] == block.flat[block.first[i][:, None] + np.arange(n)])


def _tested(h: np.ndarray, ends: np.ndarray, counts: np.ndarray, block: Block, n: int, r: np.ndarray, i: np.ndarray, d: np.ndarray) -> np.ndarray:
    """(row, item index, aligned, agreeing, document token, item token, item tokens) of those of the diagonals that meet the rule."""
    agree = _agreement(h, ends, counts, block, n, r, i, d)
    hits = np.zeros_like(agree)
    for name in masks_of(n):
        span = max(n - len(name) + 1, 0)
        whole = np.ones((len(d), span), bool)
        for j, mark in enumerate(name):
            if mark == "1":
                whole &= agree[:, j : j + span]
        hits[:, :span] |= whole
    some = hits.any(1)
    if not some.any():
        return np.zeros((0, 7), np.int64)
    agree, hits, r, i, d = agree[some], hits[some], r[some], i[some], d[some]
    if n > NARROW:
        x, y = np.array([_best_run(g, np.flatnonzero(k)) for g, k in zip(agree, hits, strict=True)]).T
    else:
        x, y = _best_runs(agree, hits)
    place = np.arange(n)
    same = (agree & (place >= x[:, None]) & (place < y[:, None])).sum(1)
    leak = (same >= needed(n)) & (same >= AGREE * (y - x))
    return np.stack([r, i, y - x, same, d + x - (ends - counts)[r], x, np.full(len(r), n)], axis=1)[leak]


def _best_of(rows: np.ndarray) -> np.ndarray:
    """The row of most agreeing tokens, then of the first place in the document, of each row and item."""
    rows = rows[np.lexsort((rows[:, 5], rows[:, 4], -rows[:, 3], rows[:, 1], rows[:, 0]))]
    return rows[np.concatenate([[True], (np.diff(rows[:, 0]) != 0) | (np.diff(rows[:, 1]) != 0)])[: len(rows)]]


def _best_diagonals(h: np.ndarray, ends: np.ndarray, counts: np.ndarray, block: Block, n: int, r: np.ndarray, i: np.ndarray, d: np.ndarray) -> np.ndarray:
    """The best of the diagonals of each row with each item of n tokens. Those that agree most come first, so that most of the others can't win any more and are left untested."""
    step = max(1, CELLS // n)
    total, lead = np.zeros(len(d), np.int64), np.zeros(len(d), np.int64)
    for c in range(0, len(d), step):
        agree = _agreement(h, ends, counts, block, n, r[c : c + step], i[c : c + step], d[c : c + step])
        total[c : c + step], lead[c : c + step] = agree.sum(1), agree.argmax(1)
    pair, earliest = r * len(block.items) + i, d + lead - (ends - counts)[r]
    order = np.lexsort((earliest, -total, pair))
    order = order[total[order] >= needed(n)]
    best, turn = np.zeros((0, 7), np.int64), 1
    step = max(1, CELLS // (n if n > NARROW else (n + 1) ** 2))
    while len(order):
        p = pair[order]
        new = np.concatenate([[True], p[1:] != p[:-1]])
        nth = np.arange(len(p)) - np.maximum.accumulate(np.where(new, np.arange(len(p)), 0))
        now, order = order[nth < turn], order[nth >= turn]
        for c in range(0, len(now), step):
            x = now[c : c + step]
            best = np.concatenate([best, _tested(h, ends, counts, block, n, r[x], i[x], d[x])])
        best = _best_of(best)
        if len(best) and len(order):
            code = best[:, 0] * len(block.items) + best[:, 1]
            k = np.minimum(np.searchsorted(code, pair[order]), len(code) - 1)
            known = code[k] == pair[order]
            worse = (total[order] < best[k, 3]) | ((total[order] == best[k, 3]) & (earliest[order] >= best[k, 4]))
            order = order[~(known & worse)]
        turn *= 8
    return best


def find(h: np.ndarray, counts: np.ndarray, block: Block) -> list[tuple[int, int, int, int, int, int, int]]:
    """(row, item index, aligned, agreeing, document token, item token, item tokens): the best diagonal of each row and item. Memory is bounded by PAIRS and CELLS besides the tokens and the result."""
    ends = np.cumsum(counts)
    best = np.zeros((0, 7), np.int64)
    for row, item, diagonal in _diagonals(h, counts, block):
        size = block.size[item]
        for n in np.unique(size).tolist():
            x = size == n
            best = np.concatenate([best, _best_diagonals(h, ends, counts, block, n, row[x], item[x], diagonal[x])])
        best = _best_of(best)
    return [tuple(x) for x in best.tolist()]


def blocks(benchmark: DataFrame, block_hashes: int = BLOCK_HASHES, least: int = MIN_ITEM) -> Iterator[Block]:
    """The benchmark in blocks of a fixed number of hashes, read one after another; its tokens are hashed in tasks. least: the tokens of the shortest item that is used."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _ in C.text_chunks(batches):
            h, counts = tokens(batch.column(1))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(h.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["item_id", "words"])

    items = benchmark.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(hashed, "item_id long, words array<long>")
    held: list[tuple[int, np.ndarray]] = []
    room = block_hashes
    for r in items.where(F.size("words") >= max(least, 1)).toLocalIterator():
        h = np.array(r.words, np.int64).view(np.uint64)
        if held and room < len(h) * len(MASKS):
            yield build(held)
            held, room = [], block_hashes
        held.append((r.item_id, h))
        room -= len(h) * len(MASKS)
    if held:
        yield build(held)


def leaks(documents: DataFrame, benchmark: DataFrame, block_hashes: int = BLOCK_HASHES, least: int = MIN_ITEM) -> DataFrame:
    """One row of RESULT for each document row and benchmark item that it contains."""
    spark = documents.sparkSession
    source = documents.select(F.col("doc_id").cast("long"), "text")

    def against(shared: Broadcast) -> DataFrame:
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = shared.value
            for batch, _, _ in C.text_chunks(batches):
                h, counts = tokens(batch.column(1))
                rows: dict[tuple[int, int], tuple] = {}
                for r in find(h, counts, held):  # equal item_ids count once
                    key = (r[0], held.items[r[1]][0])
                    if key not in rows or (-r[3], r[4]) < (-rows[key][3], rows[key][4]):
                        rows[key] = r
                if rows:
                    ids = batch.column(0).to_pylist()
                    out = [(ids[row], item, *r[2:]) for (row, item), r in rows.items()]
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*out, strict=True)], [x.split()[0] for x in RESULT.split(", ")])

        return source.mapInArrow(scan, RESULT)

    return _by_blocks(benchmark, block_hashes, least, against) or spark.createDataFrame([], RESULT)


def _by_blocks(benchmark: DataFrame, block_hashes: int, least: int, against: Callable[[Broadcast], DataFrame]) -> DataFrame | None:
    """What a job gives for the benchmark's blocks, together. The last block's job is left to the caller; those before are written, and their broadcasts given up, so that two blocks at most are held at once."""
    context, done, shared = benchmark.sparkSession.sparkContext, None, None
    for block in blocks(benchmark, block_hashes, least):
        if shared is not None:
            part = C.materialize(against(shared), "block")
            shared.destroy()
            done = part if done is None else done.union(part)
        shared = context.broadcast(block)
    if shared is None:
        return None
    return against(shared) if done is None else done.union(against(shared))


def without_leaks(documents: DataFrame, benchmark: DataFrame, block_hashes: int = BLOCK_HASHES, least: int = MIN_ITEM) -> DataFrame:
    """The rows of documents that contain no benchmark item, with all their columns."""
    at, schema = documents.columns.index("text"), documents.schema
    left = [documents]

    def against(shared: Broadcast) -> DataFrame:
        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, offs = C.utf8(batch.column(at))
                for i, j in C.row_ranges(offs):
                    part = batch.slice(i, j - i)
                    h, counts = tokens(part.column(at))
                    bad = np.zeros(j - i, bool)
                    bad[[r[0] for r in find(h, counts, shared.value)]] = True
                    yield part.filter(pa.array(~bad)) if bad.any() else part

        return left[0].mapInArrow(clean, schema)

    context, shared = documents.sparkSession.sparkContext, None
    for block in blocks(benchmark, block_hashes, least):
        if shared is not None:  # the rows that the block before leaves are written, and its broadcast is given up
            left[0] = C.materialize(against(shared), "clean")
            shared.destroy()
        shared = context.broadcast(block)
    return documents if shared is None else against(shared)
