"""Two token streams aligned as joins: anchors, their longest chain, and fuzzy work only in the gaps between them.

An anchor is a stretch of GRAM tokens that each side has once. Anchors are an equi-join on (key, stretch), so a frequent
word joins nothing. The pairs of tokens that anchors give are thinned to the longest chain that rises on both sides; what
lies between two pairs of the chain is a gap, a row of its own, and only gaps with tokens on both sides are compared.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .align import CELLS, fuzzy_pairs
from .pages import by_group

GRAM = 3
_BETWEEN = "\x1f"


def unique_grams(texts: DataFrame, keys: list[str], tokens: str, n: int = GRAM) -> DataFrame:
    """keys, gram, at: the stretches of n tokens that a row's ARRAY has once. One row for each of `keys`."""
    places = F.when(F.size(tokens) >= n, F.sequence(F.lit(0), F.size(tokens) - n)).otherwise(F.slice(F.array(F.lit(0)), 1, 0))
    grams = texts.select(*keys, F.posexplode(F.transform(places, lambda i: F.array_join(F.slice(tokens, i + 1, n), _BETWEEN))).alias("at", "gram"))
    return grams.groupBy(*keys, "gram").agg(F.min("at").alias("at"), F.count("*").alias("_n")).where("_n = 1").drop("_n")


def anchors(texts: DataFrame, keys: list[str], left: str = "left", right: str = "right", n: int = GRAM) -> DataFrame:
    """keys, left_at, right_at: where the stretches begin that both sides have once."""
    a, b = unique_grams(texts, keys, left, n).withColumnRenamed("at", "left_at"), unique_grams(texts, keys, right, n).withColumnRenamed("at", "right_at")
    return a.join(b, [*keys, "gram"]).select(*keys, "left_at", "right_at")


def rising(right: list[int]) -> list[int]:
    """Places of a longest strictly rising subsequence, by piles: a pile's last number is the least that ends a chain of its length."""
    ends: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for i, r in enumerate(right):
        k = bisect_left(ends, r)
        before.append(at[k - 1] if k else -1)
        if k == len(ends):
            ends.append(r)
            at.append(i)
        else:
            ends[k], at[k] = r, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def longest_chain(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """keys, left_at, right_at: of the pairs of each key a longest chain that rises on both sides."""

    def step(part: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        right, kept = part["_down"].to_numpy(), []
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(part)], strict=True):
            kept += [a + i for i in rising((-right[a:b]).tolist())]
        out = part.iloc[kept]
        return out[keys].assign(left_at=out["left_at"], right_at=-out["_down"])

    types = dict(pairs.dtypes)
    schema = ", ".join([*[f"{k} {types[k]}" for k in keys], "left_at int", "right_at int"])
    # of equal left places the last right one comes first, so that a chain takes one of them
    return by_group(pairs.select(*keys, "left_at", (-F.col("right_at")).alias("_down")), keys, ["left_at", "_down"], step, schema)


def _slice(tokens: Column, low: Column, high: Column) -> Column:
    return F.slice(tokens, low + 1, F.greatest(high - low, F.lit(0)))


def align_streams(texts: DataFrame, keys: list[str], left: str = "left", right: str = "right", n: int = GRAM, similar: float = 0.6) -> DataFrame:
    """keys, left_at, right_at, similarity (1 for pairs of the chain), wide: the aligned tokens, rising on both sides.

    A gap of over CELLS pairs gets no fuzzy pairs; it is told by one row with wide true and the places where it begins.
    texts: one row for each of `keys` with two ARRAYs of tokens.
    """
    spread = anchors(texts, keys, left, right, n).select(*keys, F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_k"), "left_at", "right_at")
    pairs = spread.select(*keys, (F.col("left_at") + F.col("_k")).alias("left_at"), (F.col("right_at") + F.col("_k")).alias("right_at")).distinct()
    chain = longest_chain(pairs, keys)
    ends = texts.select(*keys, F.size(left).alias("left_at"), F.size(right).alias("right_at"))
    order = Window.partitionBy(*keys).orderBy("left_at")
    steps = chain.select(*keys, "left_at", "right_at", F.lit(True).alias("pair")).union(ends.select(*keys, "left_at", "right_at", F.lit(False)))
    steps = steps.withColumns({f"{s}_from": F.coalesce(F.lag(f"{s}_at").over(order) + 1, F.lit(0)) for s in ("left", "right")})
    some = steps.where("left_at > left_from and right_at > right_from")
    gaps = some.join(texts.select(*keys, left, right), keys)
    gaps = gaps.select(*keys, "left_from", "right_from", _slice(F.col(left), F.col("left_from"), F.col("left_at")).alias("a"), _slice(F.col(right), F.col("right_from"), F.col("right_at")).alias("b"))
    types = dict(texts.dtypes)

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in frames:
            rows = []
            for *key, low, lower, a, b in part.itertuples(index=False):
                if len(a) * len(b) > CELLS:
                    rows.append((*key, low, lower, 0.0, True))
                rows += [(*key, low + i, lower + j, s, False) for i, j, s in fuzzy_pairs(list(a), list(b), similar)]
            yield pd.DataFrame(rows, columns=[*keys, "left_at", "right_at", "similarity", "wide"])

    schema = ", ".join([*[f"{k} {types[k]}" for k in keys], "left_at int", "right_at int", "similarity double", "wide boolean"])
    fuzzy = gaps.mapInPandas(compare, schema)
    return chain.select(*keys, "left_at", "right_at", F.lit(1.0).alias("similarity"), F.lit(False).alias("wide")).union(fuzzy)


def free_runs(texts: DataFrame, aligned: DataFrame, keys: list[str], side: str, least: int = 3) -> DataFrame:
    """keys, first, size: the stretches of `least` or more tokens of one side that no pair holds."""
    every = texts.select(*keys, F.explode(F.sequence(F.lit(0), F.size(side) - 1)).alias("at")).where("at >= 0")
    free = every.join(aligned.where("not wide").select(*keys, F.col(f"{side}_at").alias("at")), [*keys, "at"], "left_anti")
    island = F.col("at") - F.row_number().over(Window.partitionBy(*keys).orderBy("at"))
    return free.withColumn("_island", island).groupBy(*keys, "_island").agg(F.min("at").alias("first"), F.count("*").alias("size")).where(F.col("size") >= least).drop("_island")
