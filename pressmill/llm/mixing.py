"""Mixing sources to target weights by Sainte-Lague apportionment.

Sources in code point order (null last) weigh 1, 2, 3, 1, ... and share the words of the whole corpus; a target stops at
`cap` times its source's words and the excess is shared again by weight. The target is cut into equal blocks of
`block_words` words, and blocks go to the sources by highest quotients target / (2 n + 1). Each source's rows are dealt
by hash into shards of about `shard_rows` rows, and the source's blocks go to its shards by the same rule over the
shards' words. A shard lays its documents end to end in a seeded order and cuts this stream into blocks; a quota of q
blocks out of B takes every block q div B times and q mod B blocks, from a seeded block on, once more.

The two apportionments run on the driver over one small row per source and per shard; a shard holds shard_rows documents,
or more where there would be over MAX_SHARDS shards. Everything else is windows and joins on (source, shard).

Edge cases: a null text has size 0; rows of size 0 take nothing; null is a source of its own; null doc_ids take part;
repeated rows are separate rows that spread over the shards, equal ones interchangeable; a very long text is one row like
any other; of equal quotients the earlier source or shard is served first; a source of no words gets no block; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

BLOCK_WORDS = 16
SHARD_ROWS, MAX_SHARDS = 4_000, 200_000
CAP = 3
SEED = 20260101


def targets(sizes: dict[str | None, int], cap: int = CAP) -> dict[str | None, float]:
    """Each source's target in words."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-8", "surrogatepass")))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    out: dict[str | None, float] = {}
    left, open_ones = float(sum(sizes.values())), list(order)
    while open_ones:
        total = sum(weight[s] for s in open_ones)
        full = [s for s in open_ones if left * weight[s] / total > cap * sizes[s]]
        if not full:
            out |= {s: left * weight[s] / total for s in open_ones}
            break
        for s in full:
            out[s] = float(cap * sizes[s])
            left -= out[s]
        open_ones = [s for s in open_ones if s not in full]
    return {s: out.get(s, 0.0) for s in order}


def sainte_lague(votes: list[float], seats: int, limits: list[int] | None = None) -> list[int]:
    """Seats by highest quotients votes / (2 n + 1), the earlier party first on ties; limits: the most seats each can hold.

    The quotients above a price p are counted in closed form, ceil((v / p - 1) / 2); bisection finds the price at which
    just under `seats` are above, and the few seats left are dealt one by one.
    """
    limits = limits or [seats] * len(votes)
    seats = min(seats, sum(m for v, m in zip(votes, limits, strict=True) if v > 0))
    if seats <= 0:
        return [0] * len(votes)
    count = lambda p: [min(m, max(0, math.ceil((v / p - 1) / 2))) if v > 0 else 0 for v, m in zip(votes, limits, strict=True)]
    low, high = 0.0, max(votes)
    for _ in range(200):
        mid = (low + high) / 2
        if mid in (low, high):
            break
        if sum(count(mid)) > seats:
            low = mid
        else:
            high = mid
    out = count(high)
    while (left := seats - sum(out)) > 0:
        at = max((i for i in range(len(votes)) if votes[i] > 0 and out[i] < limits[i]), key=lambda i: (votes[i] / (2 * out[i] + 1), -i))
        out[at] += min(1, left)
    return out


def plan(shards: list[tuple[str | None, int, int]], block_words: int = BLOCK_WORDS, cap: int = CAP, seed: int = SEED) -> list[tuple]:
    """(source, shard, source words, target, every, rest, first, blocks) from (source, shard, words): each shard's quota."""
    sizes: dict[str | None, int] = {}
    for s, _, words in shards:
        sizes[s] = sizes.get(s, 0) + words
    goal = targets(sizes, cap)
    order = list(goal)
    parts: dict[str | None, list[tuple[int, int]]] = {s: [] for s in order}
    for s, shard, words in sorted(shards, key=lambda x: x[1]):
        parts[s].append((shard, words))
    blocks = lambda words: -(-words // block_words)
    most = [cap * sum(blocks(w) for _, w in parts[s]) for s in order]
    quotas = sainte_lague([goal[s] for s in order], round(sum(goal.values()) / block_words), most)
    out = []
    for s, quota in zip(order, quotas, strict=True):
        dealt = sainte_lague([float(w) for _, w in parts[s]], quota, [cap * blocks(w) for _, w in parts[s]])
        for (shard, words), q in zip(parts[s], dealt, strict=True):
            b = max(1, blocks(words))
            out.append((s, shard, sizes[s], goal[s], q // b, q % b, C.crc32_of(f"{seed}:{s}:{shard}") % b, b))
    return out


def _places(rows: DataFrame, keys: list[str], piece: str, row: str, out: str) -> DataFrame:
    """rows with `out`: how many rows with the same keys stand before, counted within each piece and then over the pieces, so that a hot key is no single task."""
    inside = F.row_number().over(Window.partitionBy(*keys, piece).orderBy(row)) - 1
    names = {k: f"_{n}_of_piece" for n, k in enumerate([*keys, piece])}
    pieces = rows.groupBy(*[F.col(f"`{k}`").alias(v) for k, v in names.items()]).agg(F.count("*").alias("_rows_of_piece"))
    lead = Window.partitionBy(*[names[k] for k in keys]).orderBy(names[piece]).rowsBetween(Window.unboundedPreceding, -1)
    pieces = C.materialize(pieces.withColumn("_lead_of_piece", F.coalesce(F.sum("_rows_of_piece").over(lead), F.lit(0))), "pieces")
    same = None
    for k, v in names.items():
        equal = F.col(f"`{k}`").eqNullSafe(F.col(v))
        same = equal if same is None else same & equal
    return rows.withColumn(out, inside).join(pieces, same).withColumn(out, F.col(out) + F.col("_lead_of_piece")).drop(*names.values(), "_rows_of_piece", "_lead_of_piece")


def _numbered(sized: DataFrame) -> DataFrame:
    """sized (a table) with nth: 0 for the first of equal rows, 1 for the next, so that repeats spread over the shards."""
    keys = ["doc_id", "source", "text_key"]
    twice = C.materialize(sized.groupBy(*keys).count().where("count > 1").select(*[F.col(k).alias(f"_{k}") for k in keys]), "twice")
    if not twice.limit(1).count():
        return sized.withColumn("nth", F.lit(0).cast("long"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("source").eqNullSafe(F.col("_source")) & F.col("text_key").eqNullSafe(F.col("_text_key"))
    once = sized.join(twice, same, "left_anti").withColumn("nth", F.lit(0).cast("long"))
    again = sized.join(twice, same, "left_semi").withColumn("piece", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id())
    again = _places(C.materialize(again, "repeats"), keys, "piece", "row", "nth").select(*sized.columns, F.col("nth").cast("long").alias("nth"))
    return C.materialize(once.unionByName(again), "numbered")


def mix(documents: DataFrame, block_words: int = BLOCK_WORDS, shard_rows: int = SHARD_ROWS, seed: int = SEED) -> DataFrame:
    """One row per document row: doc_id, source, size, source_size, target, taken, and text_key (a hash that tells rows of one doc_id apart)."""
    spark = documents.sparkSession
    sized = documents.select("doc_id", F.col("source").cast("string").alias("source"), F.when(F.col("text").isNull(), 0).otherwise(F.regexp_count("text", F.lit(C.WORD))).cast("long").alias("size"), F.xxhash64("text").alias("text_key"))
    sized = _numbered(C.materialize(sized, "sized"))
    rows = sized.groupBy("source").count().collect()
    shard_rows = max(shard_rows, sum(r["count"] for r in rows) // MAX_SHARDS)
    deal = {r["source"]: max(1, -(-r["count"] // shard_rows)) for r in rows}
    if not deal:
        return sized.select("doc_id", "source", "size", F.col("size").alias("source_size"), F.lit(0.0).alias("target"), F.col("size").alias("taken"), "text_key")
    # the number of shards and later the quotas are tables of one row per source or shard, joined null-safe
    many = spark.createDataFrame([(s, n) for s, n in deal.items()], "s string, n long")
    place = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text_key"), F.col("size"), F.col("nth"))
    dealt = sized.join(many, F.col("source").eqNullSafe(F.col("s"))).select("doc_id", "source", "size", "text_key", place.alias("place"), F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "text_key", "nth"), "n").alias("shard"))
    shards = [(r["source"], r["shard"], r["words"]) for r in dealt.groupBy("source", "shard").agg(F.sum("size").alias("words")).collect()]
    quota = spark.createDataFrame(plan(shards, block_words, CAP, seed), "s string, h long, source_size long, target double, every long, rest long, first long, blocks long")
    order = Window.partitionBy("source", "shard").orderBy("place", "doc_id", "text_key", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    laid = dealt.withColumn("stop", F.sum("size").over(order)).withColumn("start", F.expr("stop - size"))
    both = laid.join(quota, F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("h")))
    # blocks first .. first + rest - 1 (cyclic) once more: one stretch of words up to the end, and one from the beginning
    high = F.expr(f"least(first + rest, blocks) * {block_words}L")
    low = F.expr(f"greatest(first + rest - blocks, 0) * {block_words}L")
    overlap = lambda a, b: F.greatest(F.lit(0), F.least("stop", b) - F.greatest("start", a))
    extra = overlap(F.expr(f"first * {block_words}L"), high) + overlap(F.lit(0), low)
    return both.select("doc_id", "source", "size", "source_size", "target", (F.col("every") * F.col("size") + extra).cast("long").alias("taken"), "text_key")


def apply_mix(documents: DataFrame, **options: int) -> DataFrame:
    """The rows of documents as often as the mix takes them: taken / size, rounded half up, so a row cut by a block's edge is whole or left out.

    Rows that repeat doc_id, text and source are alike to the mix, whatever their other columns: their copies are added up and
    dealt to them evenly.
    """
    taken = mix(documents, **options)
    times = taken.select("doc_id", "text_key", F.col("source").alias("s"), F.when(F.expr("2 * taken >= size and taken > 0"), F.expr("(2 * taken + size) div (2 * size)")).otherwise(F.lit(0)).alias("times"))
    times = times.groupBy("doc_id", "text_key", "s").agg(F.sum("times").alias("times"), F.count("*").alias("n")).where("times > 0")
    times = C.materialize(times, "copies")
    cols = documents.columns
    new = {n: C.free_name(n, cols) for n in ("key", "owner", "id", "k", "o", "times", "n", "slice", "row", "before", "copy")}
    keyed = documents.withColumn(new["key"], F.xxhash64("text")).withColumn(new["owner"], F.col("source").cast("string"))
    t = times.select(F.col("doc_id").alias(new["id"]), F.col("text_key").alias(new["k"]), F.col("s").alias(new["o"]), F.col("times").alias(new["times"]), F.col("n").alias(new["n"]))
    on = F.col("doc_id").eqNullSafe(F.col(new["id"])) & F.col(new["key"]).eqNullSafe(F.col(new["k"])) & F.col(new["owner"]).eqNullSafe(F.col(new["o"]))
    chosen = keyed.join(t.hint("merge"), on)
    if times.where("n > 1").limit(1).count():
        again = C.materialize(chosen.where(F.col(new["n"]) > 1).withColumn(new["slice"], F.spark_partition_id()).withColumn(new["row"], F.monotonically_increasing_id()), "repeats")
        again = _places(again, [new["id"], new["k"], new["o"]], new["slice"], new["row"], new["before"])
        share = F.expr(f"`{new['times']}` div `{new['n']}`") + F.when(F.col(new["before"]) < F.expr(f"`{new['times']}` % `{new['n']}`"), 1).otherwise(0)
        again = again.withColumn(new["times"], share).where(F.col(new["times"]) > 0).select(*chosen.columns)
        chosen = chosen.where(F.col(new["n"]) == 1).unionByName(again)
    return chosen.withColumn(new["copy"], F.explode(F.sequence(F.lit(1), F.col(new["times"]).cast("int")))).select(*[F.col(f"`{c}`") for c in cols])
