"""SimHash near-dedup with anchor-point covering.

A text's fingerprint has a bit set where more than half of the XXH64 values of its three-word shingles (repeats included)
have it set. Fingerprints link at LIMIT or fewer differing bits, and linked ones form components.

Anchors are the pairs of code words of the perfect binary Golay code of length 23 over the fingerprint's bits 0-22 and
23-45. Every word of 23 bits has exactly one code word within the covering radius RADIUS, so every fingerprint has one
home anchor. A fingerprint is replicated to every anchor within the covering radius plus the threshold: in each block at
most RADIUS bits plus what is left of LIMIT may differ. Whoever links with a fingerprint therefore meets it at that one's
home anchor. There the replicas are compared, on all 64 bits, with the fingerprints at home.

An anchor that is home to more than HOMES fingerprints is crowded. Its replicas are not compared with each other: each goes
to its 65 neighbours of up to one bit instead. Two fingerprints share a neighbour exactly if two bits differ at most, and a
neighbour has 65 visitors at most, all linked, so one of them is linked with the others. So no group has more than 65 rows
or 2 * HOMES times its replicas, no pair is lost and nothing is capped. Equal fingerprints are collapsed before all this.

Edge cases: a null text and one without words have the fingerprint zero and link like any other; a text of one or two
words has one shingle; a very long text is hashed in pieces; a row without doc_id takes part, the component's id is the
smallest doc_id that is there (null if there is none); repeated rows give repeated results; ties between shingles that set
a bit and those that don't leave it 0; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .near_dedup import components

SHINGLE = 3
SEED = 42
LIMIT = 2
BLOCK, RADIUS = 23, 3
GENERATOR = 0b110001110101  # of the Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
CHECKS = GENERATOR.bit_length() - 1
HOMES = 16
PIECE = 1 << 16

RESULT = "doc_id long, fingerprint string, component_id long"

_LOW = np.uint64((1 << BLOCK) - 1)


def shingle_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The words of all rows in lower case, one blank behind each; starts and ends of the shingles in them, and each row's number of shingles."""
    starts, ends, words = C.spans_of(~C.SPACE[data], offsets)
    size = ends - starts
    low = np.where((data >= ord("A")) & (data <= ord("Z")), data | 0x20, data)[~C.SPACE[data]]
    joined = np.full(int(size.sum()) + len(size), 0x20, np.uint8)
    joined[np.arange(len(low)) + np.repeat(np.arange(len(size)), size)] = low
    at = np.cumsum(size + 1) - (size + 1)
    many = np.where(words >= SHINGLE, words - SHINGLE + 1, (words > 0).astype(np.int64))
    row = np.repeat(np.arange(len(many)), many)
    before, first_of_row = np.cumsum(many) - many, np.cumsum(words) - words
    first = first_of_row[row] + np.arange(len(row)) - before[row]
    last = np.minimum(first + SHINGLE, (first_of_row + words)[row]) - 1
    return joined.tobytes(), at[first], at[last] + size[last], many


def fingerprints_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The fingerprint of each row, as uint64."""
    text, starts, ends, many = shingle_spans(data, offsets)
    row = np.repeat(np.arange(len(many)), many)
    counts, digest = np.zeros((len(many), 64), np.int64), xxhash.xxh64_intdigest
    for a in range(0, len(starts), PIECE):
        b = min(a + PIECE, len(starts))
        h = np.fromiter((digest(text[i:j], SEED) for i, j in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)), np.uint64, b - a)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        new = np.flatnonzero(np.diff(row[a:b], prepend=-1))
        counts[row[a:b][new]] += np.add.reduceat(bits, new, axis=0, dtype=np.int64)
    return np.packbits(2 * counts > many[:, None], axis=1, bitorder="little").view("<u8").reshape(-1).astype(np.uint64)


def fingerprints(documents: DataFrame) -> DataFrame:
    """(doc_id, fp) of each document row, fp as a signed number of the same bits."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offs in C.text_chunks(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprints_of(data, offs).view(np.int64))], ["doc_id", "fp"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(sign, "doc_id long, fp long")


def _remainder(words: np.ndarray) -> np.ndarray:
    """Of polynomials of at most BLOCK bits, divided by GENERATOR: the syndrome."""
    for k in range(BLOCK - 1, CHECKS - 1, -1):
        words = np.where(words >> np.uint64(k) & np.uint64(1), words ^ np.uint64(GENERATOR << (k - CHECKS)), words)
    return words


@cache
def cosets() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Error patterns of up to RADIUS + LIMIT bits by syndrome, fewest bits first; where each syndrome's begin; how many of them have up to RADIUS + 0, 1 .. LIMIT bits."""
    bits = [sum(1 << k for k in places) for n in range(RADIUS + LIMIT + 1) for places in combinations(range(BLOCK), n)]
    pattern = np.array(bits, np.uint64)
    syndrome, weight = _remainder(pattern).astype(np.int64), np.bitwise_count(pattern).astype(np.int64)
    order = np.lexsort((weight, syndrome))
    up_to = np.stack([np.bincount(syndrome[weight <= RADIUS + k], minlength=1 << CHECKS) for k in range(LIMIT + 1)], axis=1)
    return pattern[order], np.cumsum(up_to[:, -1]) - up_to[:, -1], up_to


def homes_of(fp: np.ndarray) -> np.ndarray:
    """The home anchor of each fingerprint."""
    pattern, begin, _ = cosets()
    one, two = fp & _LOW, fp >> np.uint64(BLOCK) & _LOW
    near = lambda x: x ^ pattern[begin[_remainder(x).astype(np.int64)]]
    return near(one) | near(two) << np.uint64(BLOCK)


def replicas_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, index of the fingerprint) for every anchor within the covering radius plus the threshold."""
    pattern, begin, up_to = cosets()
    one, two = fp & _LOW, fp >> np.uint64(BLOCK) & _LOW
    s, t = _remainder(one).astype(np.int64), _remainder(two).astype(np.int64)
    anchors, who = [], []
    for more in range(LIMIT + 1):  # bits beyond RADIUS in the first block; the second may have the others
        skip = up_to[s, more - 1] if more else np.zeros(len(fp), np.int64)
        left, right = up_to[s, more] - skip, up_to[t, LIMIT - more]
        many = left * right
        row = np.repeat(np.arange(len(fp)), many)
        k = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        i, j = begin[s[row]] + skip[row] + k // right[row], begin[t[row]] + k % right[row]
        anchors.append((one[row] ^ pattern[i]) | (two[row] ^ pattern[j]) << np.uint64(BLOCK))
        who.append(row)
    return np.concatenate(anchors), np.concatenate(who)


def _mapped(fps: DataFrame, replicate: bool) -> DataFrame:
    """(anchor, fp): the homes of fingerprints, or all their replicas."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = np.asarray(batch.column(0)).view(np.uint64)
            for a in range(0, len(held), C.CHUNK_ROWS):
                part = held[a : a + C.CHUNK_ROWS]
                anchor, who = replicas_of(part) if replicate else (homes_of(part), np.arange(len(part)))
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(part[who].view(np.int64))], ["anchor", "fp"])

    return fps.select("fp").mapInArrow(place, "anchor long, fp long")


def links(fps: DataFrame, scratch: C.Scratch, homes: int = HOMES) -> DataFrame:
    """(u, v) of linked fingerprints: enough of them to connect what links. fps: distinct fingerprints."""
    at_home = scratch.table(_mapped(fps, False), "homes")
    crowd = scratch.table(at_home.groupBy("anchor").agg(F.count("*").alias("n")), "crowd")
    few = at_home.join(crowd.where(F.col("n") <= homes).hint("merge"), "anchor").groupBy("anchor").agg(F.collect_list("fp").alias("here"))
    anchors = scratch.table(few.unionByName(crowd.where(F.col("n") > homes).select("anchor", F.lit(None).cast("array<long>").alias("here"))), "anchors")
    met = _mapped(fps, True).join(anchors.hint("merge"), "anchor")
    close = F.filter("here", lambda h: (h != F.col("fp")) & (F.bit_count(h.bitwiseXOR(F.col("fp"))) <= LIMIT))
    met = met.select(F.col("fp").alias("u"), F.when(F.col("here").isNull(), F.array(F.lit(None).cast("long"))).otherwise(close).alias("near")).where("size(near) > 0")
    met = scratch.table(met.select("u", F.explode("near").alias("v")), "met")  # v is null at a crowded anchor
    crowded = met.where("v is null").select(F.col("u").alias("fp")).distinct()
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(1 << k if k < 63 else -(1 << 63))) for k in range(64)])
    visitors = crowded.select("fp", F.explode(flips).alias("spot")).groupBy("spot").agg(F.array_sort(F.collect_list("fp")).alias("all")).where("size(all) > 1")
    stars = visitors.select(F.get("all", F.lit(0)).alias("u"), F.explode(F.slice("all", F.lit(2), F.size("all"))).alias("v"))
    return met.where("v is not null").union(stars)


def near_duplicates(documents: DataFrame, homes: int = HOMES) -> DataFrame:
    """One row of RESULT for each document row."""
    scratch = C.Scratch(documents.sparkSession, "simhash")
    signed = scratch.table(fingerprints(documents), "signed")
    firsts = scratch.table(signed.groupBy("fp").agg(F.min("doc_id").alias("first")), "firsts")
    edges = scratch.table(links(firsts, scratch, homes), "edges")
    nodes = scratch.table(edges.select(F.col("u").alias("id")).union(edges.select(F.col("v").alias("id"))).distinct(), "nodes")
    labels = components(nodes, edges, scratch)
    placed = firsts.join(labels.select(F.col("id").alias("fp"), "label").hint("merge"), "fp", "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    placed = scratch.table(placed, "placed")
    groups = scratch.table(placed.groupBy("label").agg(F.min("first").alias("component_id")), "groups")
    named = scratch.table(placed.select("fp", "label").join(groups.hint("merge"), "label").select("fp", "component_id"), "named")
    out = signed.join(named.hint("merge"), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
    out = scratch.table(out, "result")
    scratch.drop_all_but(out)
    return out
