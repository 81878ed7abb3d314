"""Readings of crops: word boxes by a model, several readings of one figure, folders of images to texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.models import WordBoxModel

# Page modes and scales in which the text of a figure is read, in this order (without the usual reading, the
# first), and the score that is good enough to stop at.
MODES = (3, 11, 6)
SCALES = (1.0, 0.75, 0.5, 0.35, 0.25, 0.15)
READINGS = [(mode, scale) for mode in MODES for scale in SCALES][1:]
GOOD_ENOUGH = 0.8

WORDS = "array<struct<text string, conf double, line int, x1 double, y1 double, x2 double, y2 double>>"


def word_boxes(crops: DataFrame, factory: Callable[[], WordBoxModel], key: str = "region_id") -> DataFrame:
    """key and `words` (WORDS) of crops (key, image): what the model reads, in its order; an image that can't be read gives no words and an `error`."""
    names = ("text", "conf", "line", "x1", "y1", "x2", "y2")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for part in frames:
            rows = []
            for k, image in zip(part[key], part["image"], strict=True):
                try:
                    rows.append((k, [{n: w[n] for n in names} for w in model.words(bytes(image))], None))
                except Exception as e:  # one broken image must not end the run; it is told in the row
                    rows.append((k, [], f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=[key, "words", "error"])

    return crops.select(key, "image").mapInPandas(run, f"{key} {dict(crops.dtypes)[key]}, words {WORDS}, error string")


def text_of_words(words: Column) -> Column:
    """Words as text: those of a line with spaces, lines under each other in the order of their numbers."""
    lines = F.array_sort(F.array_distinct(F.transform(words, lambda w: w["line"])))
    line = lambda n: F.array_join(F.transform(F.filter(words, lambda w: w["line"] == n), lambda w: w["text"]), " ")
    return F.array_join(F.transform(lines, line), "\n")


def texts_of_images(images: DataFrame, factory: Callable[[], WordBoxModel], done: DataFrame | None = None) -> DataFrame:
    """file_name, text and error of images (file_name, image) that are not in `done` (file_name)."""
    todo = images if done is None else images.join(done.select("file_name"), "file_name", "left_anti")
    return word_boxes(todo, factory, "file_name").select("file_name", text_of_words(F.col("words")).alias("text"), "error")


def best_reading(readings: DataFrame, key: list[str], score: str = "score", place: str = "place", good: float = GOOD_ENOUGH) -> DataFrame:
    """One of several readings: the first that is good enough, else the best one, of equal ones the first. One aggregation, no window."""
    whole = F.struct(*[F.col(f"`{c}`") for c in readings.columns])
    enough = F.coalesce(F.col(score) >= good, F.lit(False))
    rank = F.struct((~enough).alias("a"), F.when(enough, F.lit(0.0)).otherwise(F.coalesce(-F.col(score).cast("double"), F.lit(float("inf")))).alias("b"), F.col(place).alias("c"))
    return readings.groupBy(*key).agg(F.min_by(whole, rank).alias("_best")).select("_best.*")
