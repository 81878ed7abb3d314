"""Corpus statistics: monthly counts, extremes per group, normalised rows, similarity matrices, clustering, text aggregates."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import cosine
from .ordering import numbered


def monthly_counts(df: DataFrame, group: str, day: Column) -> DataFrame:
    """Rows per group and month, months without rows between a group's first and last one as 0."""
    counts = df.select(group, F.trunc(day, "month").alias("month")).where("month is not null").groupBy(group, "month").agg(F.count("*").alias("n"))
    spine = counts.groupBy(group).agg(F.explode(F.sequence(F.min("month"), F.max("month"), F.expr("interval 1 month"))).alias("month"))
    return spine.join(counts, [group, "month"], "left").select(group, "month", F.date_format("month", "MMMM").alias("month_name"), F.coalesce("n", F.lit(0)).alias("n"))


def extremes(df: DataFrame, group: str, label: str, value: str, k: int = 3) -> DataFrame:
    """Labels of the k largest and k smallest values of each group, joined by commas; ties by label."""
    top, low = Window.partitionBy(group).orderBy(F.desc(value), label), Window.partitionBy(group).orderBy(value, label)
    ranked = df.withColumns({"_top": F.row_number().over(top), "_low": F.row_number().over(low)})
    names = lambda r: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col(r) <= k, F.struct(r, label)))), lambda s: s[label]), ", ")
    return ranked.where(f"_top <= {k} or _low <= {k}").groupBy(group).agg(names("_top").alias("highest"), names("_low").alias("lowest"))


def normalise_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each of the columns over their sum in the row."""
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in columns), F.lit(0))
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)) / total for c in columns})


def similarity_matrix(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Cosine similarity and distance of every ordered pair; for small tables of class vectors."""
    a, b = df.select(F.col(key).alias("a"), F.col(vector).alias("va")), df.select(F.col(key).alias("b"), F.col(vector).alias("vb"))
    return a.crossJoin(F.broadcast(b)).select("a", "b", cosine(F.col("va"), F.col("vb")).alias("similarity")).withColumn("distance", 1 - F.col("similarity"))


def centroids(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Mean vector of each key, by position."""
    at = df.select(key, F.posexplode(vector).alias("at", "v"))
    means = at.groupBy(key, "at").agg(F.avg(F.col("v").cast("double")).alias("v"))
    return means.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda s: s["v"]).alias(vector))


def ward_order(points: np.ndarray) -> tuple[list[tuple[int, int, float, int]], list[int]]:
    """Merges (left, right, height, size) of Ward's clustering by Lance-Williams updates, and the leaves in tree order."""
    n = len(points)
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    d[np.arange(n), np.arange(n)] = np.inf
    size, name, leaves = {i: 1 for i in range(n)}, {i: i for i in range(n)}, {i: [i] for i in range(n)}
    merges = []
    for step in range(n - 1):
        live = sorted(size)
        sub = d[np.ix_(live, live)]
        i, j = (live[k] for k in np.unravel_index(sub.argmin(), sub.shape))
        i, j = min(i, j), max(i, j)
        merges.append((*sorted((name[i], name[j])), float(d[i, j]), size[i] + size[j]))
        leaves[i] = leaves[i] + leaves[j] if name[i] <= name[j] else leaves[j] + leaves[i]
        for k in live:
            if k not in (i, j):
                total = size[i] + size[j] + size[k]
                new = ((size[i] + size[k]) * d[i, k] ** 2 + (size[j] + size[k]) * d[j, k] ** 2 - size[k] * d[i, j] ** 2) / total
                d[i, k] = d[k, i] = np.sqrt(max(new, 0.0))
        size[i] += size.pop(j)
        name[i] = n + step
    return merges, leaves[min(size)] if n else []


def dendrogram(df: DataFrame, key: str, vector: str) -> DataFrame:
    """place of each key in the order of a Ward dendrogram; for small tables, in one task."""

    def one(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(key).reset_index(drop=True)
        _, order = ward_order(np.stack(part[vector].map(np.asarray)))
        return pd.DataFrame({key: part[key].iloc[order].to_numpy(), "place": np.arange(1, len(order) + 1)})

    return df.select(key, vector).groupBy().applyInPandas(one, f"{key} {dict(df.dtypes)[key]}, place long")


def _hash(key: str, seed: int) -> F.Column:
    """32 bits of the md5 of seed and key, as other engines have it too."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string"))), 1, 8), 16, 10).cast("long")


def sample_by_hash(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows, the same for the same seed whatever the partitioning."""
    return df.orderBy(_hash(key, seed), key).limit(n)


def split_by_hash(df: DataFrame, key: str, share: float, seed: int) -> DataFrame:
    """is_train: a share of the keys by hash; all rows of a key on one side."""
    return df.withColumn("is_train", _hash(key, seed) % 1000 < int(share * 1000))


def batch_numbers(df: DataFrame, group: str | None, order: list[str], size: int = 100) -> DataFrame:
    """batch, from 1: `size` rows each in order, over all rows or in each group."""
    return numbered(df, order, [group] if group else [], "_place").withColumn("batch", F.floor(F.col("_place") / size) + 1).drop("_place")


def one_hot(df: DataFrame, key: str, labels: str, classes: list) -> DataFrame:
    return df.select(key, *[F.array_contains(labels, c).cast("int").alias(f"class_{c}") for c in classes])


def shared_words(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """How many words two texts have in common, counting repeats; a and b have one row per (key, word, n)."""
    both = a.join(b.withColumnRenamed("n", "_n"), [key, "word"])
    return both.groupBy(key).agg(F.sum(F.least("n", "_n")).alias("shared"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows replace old ones with the same keys."""
    return old.join(new, keys, "left_anti").unionByName(new, allowMissingColumns=True)


def not_done(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return work.join(done, keys, "left_anti")


def score_texts(df: DataFrame, key: str, text: str, model: Callable[[], Callable[[list[str]], np.ndarray]], classes: int, multi: bool = False, threshold: float = 0.5) -> DataFrame:
    """Class chances by a text model that is loaded once in each task; `model` returns a function from texts to logits."""
    schema = f"{key} {dict(df.dtypes)[key]}, " + ", ".join(f"class_{i}_probability double" for i in range(classes)) + (", " + ", ".join(f"class_{i} int" for i in range(classes)) if multi else ", predicted_class int")

    def run(frames):
        score = model()
        for part in frames:
            z = np.asarray(score(part[text].fillna("").tolist()), float).reshape(len(part), classes)
            p = 1 / (1 + np.exp(-z)) if multi else np.exp(z - z.max(1, keepdims=True)) / np.exp(z - z.max(1, keepdims=True)).sum(1, keepdims=True)
            out = {key: part[key]} | {f"class_{i}_probability": p[:, i] for i in range(classes)}
            out |= {f"class_{i}": (p[:, i] >= threshold).astype(int) for i in range(classes)} if multi else {"predicted_class": p.argmax(1)}
            yield pd.DataFrame(out)

    return df.select(key, text).mapInPandas(run, schema)
