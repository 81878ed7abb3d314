"""MinHash near-dedup: DartMinHash signatures, banded joining, exact check, connected classes.

A text is the weighted set of its five-word shingles (runs of bytes other than ASCII white space are words), a shingle
weighing as often as it occurs; a text of fewer words is one shingle. Each unit of weight is a region on which darts
arrive as a Poisson process seeded by the region alone: the n-th gap is -ln(u) for u hashed from (region, n), and the
dart carries a coordinate in 0..K-1. The earliest dart of each coordinate is the signature, so two texts agree at a
coordinate with probability equal to their weighted Jaccard similarity. Darts are thrown up to a time at which the K
coordinates are expected to be full (K ln K + 2K darts over the total weight); texts with an empty coordinate go on.

Links: texts that agree on all ROWS values of one of BANDS bands share a bucket. Each is compared with the first of all
its buckets' first texts (estimate from signatures, then the exact similarity from both texts). Linked texts become one
class. Buckets that still hold several classes get other heads, round by round (_more_stars). The buckets of several classes
that are then left are joined once more, but only between members of different classes and only where a link is possible. Shingles
that at most RARE of the texts there have are looked at by themselves: texts that share one are compared, and for all
others none of these shingles is shared, which bounds the similarity from the weights alone. So no candidate pair is
lost: each one is compared, already in one class, or shown to be no link. Nothing is capped.

Joins on texts, signatures and bands are sort-merge joins at every size: their sides grow with the corpus, and adaptive
execution splits the skewed ones.

Edge cases: byte-equal texts are exact copies and share one class, whatever their length (a text without words has no
near copies); a null text is a class of its own; the class id is the smallest doc_id in the class. Rows without doc_id
get a null class. Repeated rows are exact copies. A very long text is signed and compared whole. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 20, 5
K = BANDS * ROWS
RARE = 4
ESTIMATE = 0.6  # five standard errors of K coordinates below SIMILAR

RESULT = "doc_id long, class_id long, class_size long"

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)
_FACTORS = np.random.default_rng(5).integers(1, 1 << 62, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes row by row, the row of each, and the number of each row."""
    n = len(offsets) - 1
    starts, ends, words = C.spans_of(~C.SPACE[data], offsets)
    h = C.span_hashes(data, starts, ends)
    many = np.where(words >= size, words - size + 1, (words > 0).astype(np.int64))
    row = np.repeat(np.arange(n), many)
    if not len(row):
        return np.zeros(0, np.uint64), row, many
    first = np.concatenate(([0], np.cumsum(words)))[:-1]
    at = np.repeat(first - np.concatenate(([0], np.cumsum(many)))[:-1], many) + np.arange(len(row))
    h = np.concatenate((h, np.zeros(size, np.uint64)))
    short = words[row] < size if (many != words - size + 1).any() else None
    out = np.zeros(len(row), np.uint64)
    for j, factor in enumerate(_FACTORS[:size]):
        term = h[at + j] if j else h[at]
        if short is not None:
            term = np.where(short & (j >= words[row]), np.uint64(0), term)
        out += term * factor
    out = C.mix(out)
    return out, row, many


def _unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def signatures(data: np.ndarray, offsets: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """DartMinHash values (rows, k) as int32 and the total weight of each row; rows of weight 0 are all zero."""
    h, row, weight = shingles(data, offsets)
    n = len(weight)
    sig = np.zeros((n, k), np.int32)
    if not len(h):
        return sig, weight
    key = C.mix(h ^ C.mix(row.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    new = np.ones(len(h), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    region = C.mix(h + C.rank_in_group(order, new).astype(np.uint64) * _GOLD)  # one for each unit of weight
    darts = k * np.log(k) + 2 * k
    until = np.where(weight > 0, darts / np.maximum(weight, 1), 0.0)
    step, when = np.zeros(len(h), np.uint64), -np.log(_unit(C.mix(region + np.uint64(1))))
    flat, best = sig.reshape(-1), np.full(n * k, np.inf)
    todo = np.arange(len(h))
    while len(todo):
        thrown: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        late = until[row[todo]]
        live = when[todo] < late
        now, late = todo[live], late[live]
        base, seed, nth, at = row[now] * k, region[now], step[now], when[now]
        while len(now):
            dart = C.mix(seed ^ C.mix((nth + np.uint64(1)) * _GOLD))
            thrown.append((base + ((dart & _LOW) * np.uint64(k) >> np.uint64(32)).astype(np.int64), at, dart))
            nth = nth + np.uint64(1)
            at = at - np.log(_unit(C.mix(seed + (nth + np.uint64(1)) * np.uint64(2) - np.uint64(1))))
            over = at >= late
            if over.any():
                gone = now[over]
                step[gone], when[gone] = nth[over], at[over]
                live = ~over
                now, late, base, seed, nth, at = now[live], late[live], base[live], seed[live], nth[live], at[live]
        if thrown:
            cell, time, dart = (np.concatenate(x) for x in zip(*thrown, strict=True))
            np.minimum.at(best, cell, time)
            won = time == best[cell]
            flat[cell[won]] = (dart[won] >> np.uint64(32)).astype(np.uint32).view(np.int32)
        empty = np.isinf(best).reshape(n, k).any(1) & (weight > 0)
        until[empty] *= 2
        todo = todo[empty[row[todo]]]
    return sig, weight


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two (sorted distinct shingles, counts)."""
    total = int(a[1].sum() + b[1].sum())
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / (total - both) if total > both else 1.0


def _signed(documents: DataFrame) -> DataFrame:
    """(doc_id, digest, weight, sig) of each row; digest: of the text's bytes, null for a null text."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offs in C.text_chunks(batches):
            sig, weight = signatures(data, offs)
            values = pa.ListArray.from_arrays(pa.array(np.arange(0, sig.size + 1, K, dtype=np.int32)), pa.array(sig.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(weight.astype(np.int64)), values], ["doc_id", "digest", "weight", "sig"])

    return documents.select(F.col("doc_id").cast("long"), "text", F.unhex(F.sha1("text")).alias("digest")).mapInArrow(sign, "doc_id long, digest binary, weight long, sig array<int>")


def _agree(a: str, b: str) -> F.Column:
    """Share of equal coordinates, on the JVM."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x) / F.lit(float(K))


def _checked(pairs: DataFrame, texts: DataFrame, similar: float) -> DataFrame:
    """The pairs (u, v) whose exact similarity is at least `similar`. Both sides are plain tables, so adaptive joins can split a frequent id."""

    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in frames:
            keep = np.zeros(len(part), bool)
            last: tuple[object, object] = (None, None)
            for at, (v, a, b) in enumerate(zip(part.v, part.a, part.b, strict=True)):
                if last[0] != v:
                    last = (v, _bag(b))
                keep[at] = weighted_jaccard(_bag(a), last[1]) >= similar
            yield part.loc[keep, ["u", "v"]]

    left = pairs.join(texts.select(F.col("id").alias("u"), F.col("text").alias("a")).hint("merge"), "u")
    return left.join(texts.select(F.col("id").alias("v"), F.col("text").alias("b")).hint("merge"), "v").select("u", "v", "a", "b").mapInPandas(check, "u long, v long")


def _likely(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """The pairs (u, v) whose signatures agree on a share of at least ESTIMATE."""
    both = pairs.join(sigs.select(F.col("id").alias("u"), F.col("sig").alias("a")).hint("merge"), "u").join(sigs.select(F.col("id").alias("v"), F.col("sig").alias("b")).hint("merge"), "v")
    return both.where(_agree("a", "b") >= ESTIMATE).select("u", "v")


def _spread(texts: DataFrame) -> DataFrame:
    """(shingle, id, n): each text's distinct shingles and their weights."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offs in C.text_chunks(batches):
            h, row, _ = shingles(data, offs)
            order = np.lexsort((h, row))
            h, row = h[order], row[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
            first = np.flatnonzero(new)
            ids = np.asarray(batch.column(0))[row[first]]
            yield pa.RecordBatch.from_arrays([pa.array(h[first].view(np.int64)), pa.array(ids), pa.array(np.diff(np.append(first, len(h))))], ["shingle", "id", "n"])

    return texts.select("id", "text").mapInArrow(spread, "shingle long, id long, n long")


def _same_band(a: str, b: str) -> F.Column:
    """The first band in which two signatures agree, from 0."""
    part = lambda c, k: F.slice(c, k * ROWS + 1, ROWS)
    return F.array_position(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: part(a, k) == part(b, k)), True) - 1


def _bound(mine: str, other: str | F.Column, own: str) -> F.Column:
    """The highest similarity of a text of weight `mine` with one of weight `other` that has none of a part of weight `own` of its shingles."""
    theirs = F.col(other) if isinstance(other, str) else other
    common = F.least(F.col(mine) - F.col(own), theirs)
    return common / (F.col(mine) + theirs - common)


def _bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(text.encode(), np.uint8)
    return np.unique(shingles(raw, np.array([0, len(raw)]))[0], return_counts=True)


def components(nodes: DataFrame, edges: DataFrame, scratch: C.Scratch) -> DataFrame:
    """(id, label): the smallest id of each node's component. Labels go along the edges, then jump to their label's label; every round is a written table."""
    both = scratch.table(edges.select(F.col("u").alias("s"), F.col("v").alias("d")).union(edges.select(F.col("v").alias("s"), F.col("u").alias("d"))), "edges")
    labels = scratch.table(nodes.select("id", F.col("id").alias("label"), F.col("id").alias("was")), "labels")
    while True:
        told = both.join(labels.select("id", "label"), both.s == labels.id).groupBy("d").agg(F.min("label").alias("heard"))
        near = labels.join(told, labels.id == told.d, "left").select("id", F.col("label").alias("was"), F.least("label", F.coalesce("heard", "label")).alias("label"))
        near = scratch.table(near, "near")
        far = near.select(F.col("id").alias("label"), F.col("label").alias("further"))
        after = scratch.table(near.join(far, "label").select("id", F.least("label", "further").alias("label"), "was"), "labels")
        scratch.drop(labels, near)
        labels = after
        if not labels.where("label != was").limit(1).count():
            scratch.drop(both)
            return labels


def _mixed(placed: DataFrame) -> DataFrame:
    """The keys of the buckets that hold several classes."""
    return placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("key")


def _between(links: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs of different classes (u, v) that links between texts join."""
    place = lambda e: labels.select(F.col("id").alias(e), F.col("label").alias(f"label_{e}"))
    pairs = links.join(place("u"), "u").join(place("v"), "v").where("label_u != label_v")
    return pairs.select(F.least("label_u", "label_v").alias("u"), F.greatest("label_u", "label_v").alias("v")).distinct()


def _contracted(classes: DataFrame, between: DataFrame, scratch: C.Scratch) -> DataFrame:
    """(was, label): the class that each class (label) belongs to once the pairs are joined."""
    return components(classes.select(F.col("label").alias("id")), between, scratch).select(F.col("id").alias("was"), "label")


def _moved(labels: DataFrame, moved: DataFrame, scratch: C.Scratch) -> DataFrame:
    """labels, with the classes that `moved` names replaced."""
    named = labels.select("id", F.col("label").alias("was")).join(moved.select("was", F.col("label").alias("now")), "was", "left")
    return scratch.table(named.select("id", F.coalesce("now", "was").alias("label")), "labels")


def _lead(turn: int) -> list[F.Column]:
    """What makes a text the head of its bucket in a round: its reach; then, in turn, chance, and chance by class and the class's reach."""
    if turn == 0:
        return [F.col("reach"), F.xxhash64("id", "key")]
    return [F.xxhash64("id", "key", F.lit(turn))] if turn % 2 else [F.xxhash64("label", "key", F.lit(turn)), F.col("reach")]


def _more_stars(rest: DataFrame, sigs: DataFrame, texts: DataFrame, similar: float, scratch: C.Scratch) -> DataFrame:
    """(was, label) of each class of `rest` (key, id, label, reach), after rounds of comparisons with new heads.

    In a round every bucket of several classes has one head, and each text of another class is compared with the head of one of
    its buckets; classes with a link become one. So a round has at most as many pairs as there are texts, and a group whose
    first head was a bad centre is one class after a few rounds, instead of a link for each of its pairs. Rounds go on while
    they join a tenth of the classes that are left; what they leave is compared in full by the caller.
    """
    moved = scratch.table(rest.select(F.col("label").alias("was")).distinct().withColumn("label", F.col("was")), "moved")
    turn = 0
    while True:
        placed = rest.select("key", "id", "reach", F.col("label").alias("was")).join(moved, "was").select("key", "id", "reach", "label")
        live = scratch.table(placed.join(scratch.table(_mixed(placed), "mixed"), "key"), "live")
        heads = live.groupBy("key").agg(F.max_by(F.struct("id", "label"), F.struct(*_lead(turn), "id")).alias("head"))
        met = live.join(scratch.table(heads, "heads").hint("merge"), "key").where("label != head.label")
        pairs = met.groupBy("id").agg(F.max_by("head.id", F.xxhash64("id", "key", F.lit(turn))).alias("v"))
        likely = scratch.table(_likely(scratch.table(pairs.select(F.col("id").alias("u"), "v"), "pairs"), sigs), "likely")
        links = scratch.table(_checked(likely, texts, similar), "links")
        between = scratch.table(_between(links, scratch.table(live.select("id", "label").distinct(), "apart")), "between")
        classes = scratch.table(live.select("label").distinct(), "classes")
        left, linked = classes.count(), between.limit(1).count()
        if linked:
            joined = _contracted(classes, between, scratch).select(F.col("was").alias("label"), F.col("label").alias("now"))
            fewer = joined.where("now != label").count()
            moved = scratch.table(moved.join(joined, "label", "left").select("was", F.coalesce("now", "label").alias("label")), "moved")
        if not linked or 10 * fewer < left:
            return moved
        turn += 1


def near_duplicates(documents: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """One row of RESULT per document row."""
    return _classified(documents, similar).drop("digest")


def _classified(documents: DataFrame, similar: float) -> DataFrame:
    """RESULT and the digest of the text."""
    scratch = C.Scratch(documents.sparkSession, "near_dedup")
    signed = scratch.table(_signed(documents), "signed")
    known = signed.where("doc_id is not null and digest is not null")
    # each distinct text gets an id of its own; `first` is the smallest doc_id that has it
    distinct = known.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    distinct = scratch.table(distinct.withColumn("id", F.monotonically_increasing_id()), "distinct")
    sigs = known.where("weight > 0").select("digest", "sig", "weight", "doc_id").join(distinct.hint("merge"), "digest").where("doc_id = first").dropDuplicates(["id"]).select("id", "first", "sig", "weight")
    sigs = scratch.table(sigs, "signatures")
    # buckets of two and more, each with its member of smallest doc_id, the head; a text is compared with its first head
    keys = F.posexplode(F.array(*[F.xxhash64(F.slice("sig", b * ROWS + 1, ROWS), F.lit(b)) for b in range(BANDS)])).alias("band", "key")
    bands = sigs.select("id", "first", keys)
    heads = bands.groupBy("key").agg(F.min(F.struct("first", "id")).alias("head"), F.count("*").alias("n")).where("n > 1")
    heads = scratch.table(heads, "heads")
    members = scratch.table(bands.select("id", "band", "key").join(heads.hint("merge"), "key"), "members")
    # reach: how many texts a text meets in its buckets
    told = members.groupBy("id").agg(F.sum("n").alias("reach"), F.min(F.when(F.col("id") != F.col("head.id"), F.col("head"))).alias("head"))
    some = scratch.table(told.select("id", "reach", F.col("head.id").alias("v")), "ids")
    likely = scratch.table(_likely(some.where("v is not null").select(F.col("id").alias("u"), "v"), sigs), "likely")
    # the texts of all bucket members, once
    wanted = scratch.table(some.join(distinct, "id").select("id", F.col("first").alias("doc_id"), "digest"), "wanted")
    source = documents.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = source.join(wanted.hint("merge"), "doc_id").where(F.unhex(F.sha1("text")) == F.col("digest")).select("id", "text").dropDuplicates(["id"])
    texts = scratch.table(texts, "texts")
    edges = scratch.table(_checked(likely, texts, similar), "links")
    labels = components(some, edges, scratch)
    scratch.drop(heads, likely, wanted)
    # buckets that still hold several classes
    placed = members.select("key", "band", "id").join(labels.select("id", "label").hint("merge"), "id")
    rest = scratch.table(placed.join(scratch.table(_mixed(placed), "mixed"), "key"), "rest")
    rest_ids = scratch.table(rest.select("id").distinct(), "rest_ids")
    rest_sigs = scratch.table(sigs.select("id", "sig", "weight").join(rest_ids.hint("merge"), "id"), "rest_sigs")
    rest_texts = scratch.table(texts.join(rest_ids.hint("merge"), "id"), "rest_texts")
    scratch.drop(texts, members)
    met = scratch.table(rest.join(some.select("id", "reach"), "id"), "met")
    moved = _more_stars(met, rest_sigs, rest_texts, similar, scratch)
    rest = rest.withColumnRenamed("label", "was").join(moved.withColumnRenamed("label", "now"), "was").select("key", "band", "id", F.col("now").alias("label"))
    labels = _moved(labels, moved, scratch)
    # what is left to compare are pairs across classes, of texts that can have a link at all
    rest = scratch.table(rest.join(scratch.table(_mixed(rest), "mixed"), "key"), "rest")
    rest_texts = scratch.table(rest_texts.join(scratch.table(rest.select("id").distinct(), "rest_ids").hint("merge"), "id"), "rest_texts")
    counts = scratch.table(_spread(rest_texts).groupBy("shingle").agg(F.count("*").alias("texts")).where(F.col("texts") <= RARE), "rare")
    rare = scratch.table(_spread(rest_texts).join(counts.hint("merge"), "shingle"), "rare_in")
    own = scratch.table(rare.groupBy("id").agg(F.sum("n").alias("own")), "own")
    rest = rest.join(rest_sigs.select("id", "weight"), "id").join(own, "id", "left").select("key", "band", "id", "label", "weight", F.coalesce("own", F.lit(0)).alias("own"))
    rest = scratch.table(rest, "rest_weighed")
    least = scratch.table(rest.groupBy("key").agg(F.min("weight").alias("least")), "least")
    able = rest.join(least, "key").where(_bound("weight", F.greatest("least", F.col("weight") * similar), "own") >= similar - 1e-9).drop("least")
    able = scratch.table(able, "able")
    able = scratch.table(able.join(scratch.table(_mixed(able), "mixed"), "key").join(rest_sigs.select("id", "sig"), "id"), "able_signed")
    other = able.select("key", F.col("id").alias("v"), F.col("sig").alias("b"), F.col("label").alias("label_v"), F.col("weight").alias("weight_v"), F.col("own").alias("own_v"))
    can = (_bound("weight", "weight_v", "own") >= similar - 1e-9) & (_bound("weight_v", "weight", "own_v") >= similar - 1e-9)
    across = able.join(other, (able.key == other.key) & (able.label < other.label_v) & can & (_agree("sig", "b") >= ESTIMATE) & (_same_band("sig", "b") == able.band)).select(F.col("id").alias("u"), "v")
    shared = rare.where("texts > 1").select("shingle", F.col("id").alias("u"))
    beside = shared.join(shared.select("shingle", F.col("u").alias("v")), "shingle").where("u < v").select("u", "v").distinct()
    apart = labels.select(F.col("id").alias("u"), F.col("label").alias("label_u"))
    beside = beside.join(apart, "u").join(labels.select(F.col("id").alias("v"), F.col("label").alias("label_v")), "v").where("label_u != label_v").select("u", "v")
    beside = _likely(scratch.table(beside, "beside"), rest_sigs)
    across = scratch.table(across.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).union(beside).distinct(), "across")
    more = scratch.table(_checked(across, rest_texts, similar), "links")
    between = scratch.table(_between(more, labels), "between")
    if between.limit(1).count():
        labels = _moved(labels, _contracted(labels.select("label").distinct(), between, scratch), scratch)
    named = scratch.table(distinct.join(labels.select("id", "label"), "id", "left").select("digest", "first", "copies", F.coalesce("label", "id").alias("label")), "named")
    groups = scratch.table(named.groupBy("label").agg(F.min("first").alias("class_id"), F.sum("copies").alias("class_size")), "groups")
    classes = scratch.table(named.join(groups, "label").select("digest", "class_id", "class_size"), "classes")
    found = signed.select("doc_id", "digest").join(classes, "digest", "left")
    alone = F.col("class_id").isNull() | F.col("doc_id").isNull()  # a null text; a row without an id, even if its text has a class
    out = found.select("doc_id", "digest", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.when(alone & F.col("doc_id").isNotNull(), F.lit(1)).when(F.col("doc_id").isNotNull(), F.col("class_size")).cast("long").alias("class_size"))
    out = scratch.table(out, "result")
    scratch.drop_all_but(out)
    return out


def first_of_each(documents: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """The rows of documents with one row left of each class (that of smallest doc_id), with all their columns; null texts and null ids stay."""
    found = _classified(documents, similar)
    cols = documents.columns
    key, gone_id, gone_digest = (C.free_name(n, cols) for n in ("digest", "gone_id", "gone_digest"))
    known = found.where("doc_id is not null and digest is not null")
    # a class's first doc_id may have texts of its own in other classes, so rows are told apart by both
    gone = C.materialize(known.where("class_id != doc_id").select(F.col("doc_id").alias(gone_id), F.col("digest").alias(gone_digest)).distinct(), "gone")
    keyed = documents.withColumn(key, F.unhex(F.sha1("text")))
    kept = keyed.join(gone.hint("merge"), (F.col("doc_id") == F.col(gone_id)) & (F.col(key) == F.col(gone_digest)), "left_anti")
    twice = C.materialize(known.groupBy("doc_id", "digest").count().where("count > 1").select(F.col("doc_id").alias(gone_id), F.col("digest").alias(gone_digest)), "twice")
    if twice.limit(1).count():
        same = (F.col("doc_id") == F.col(gone_id)) & (F.col(key) == F.col(gone_digest))
        kept = kept.join(twice, same, "left_anti").unionByName(kept.join(twice, same, "left_semi").dropDuplicates(["doc_id", key]))
    return kept.select(*[F.col(f"`{c}`") for c in cols])
