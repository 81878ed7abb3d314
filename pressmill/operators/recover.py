"""Text that no detection covers, recovered from the ink: uncovered ink becomes words, words lines and blocks.

Ink and boxes are tables of the mask's pixels (see ink.py). Uncovered ink is grown a little, and what then hangs together is
a word; specks go. Words and lines are joined round by round: all pairs that may join are found by a tile join, the pieces
that they form become one box each, and the next round starts from those boxes, until none may join. A join never covers a
known box; where a piece of several boxes would, only pairs that choose each other are joined in that round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import dropped, written
from . import ink
from .spatial import SIDES, connected, islands, tile_join, uncovered

# Sizes in pixels of the mask, and shares of the smaller box's height or width.
GROW_X, GROW_Y = 2, 1
WORD_INK, MARK_INK, BLOCK_INK, LEAST_HEIGHT = 12, 3, 150, 4
SIZES_APART, LEVEL, NEAR, FAR, GUTTER_REACH, OVER, BELOW = 2.5, 0.5, 0.8, 2.5, 5, 0.6, 0.8


def _rows(df: DataFrame, key: str, up: int = 0) -> DataFrame:
    return df.where("y1 < y2 and x1 < x2").select(key, F.explode(F.sequence(F.col("y1") - up, F.col("y2") - 1 + up)).alias("y"), "x1", "x2")


def _bars(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(key, "x1", F.col("y").alias("y1"), "x2", (F.col("y") + 1).alias("y2"))


def words_of_ink(left: DataFrame, boxes: DataFrame, key: str) -> DataFrame:
    """key, x1, y1, x2, y2 of the words that uncovered ink (bars of height 1) forms.

    A word that wraps around a known box is broken into its separate marks.
    """
    wide = _rows(left, key, GROW_Y).select(key, "y", F.greatest(F.lit(0), F.col("x1") - GROW_X).alias("x1"), (F.col("x2") + GROW_X).alias("x2")).where("y >= 0")
    grown = _bars(uncovered(islands(wide, [key, "y"], "x1", "x2"), _rows(boxes, key), [key, "y"], "x1", "x2"), key)
    pieced = written(ink.pieces(grown, key), "grown")
    held = left.alias("i").join(pieced.alias("p"), (F.col(f"i.{key}") == F.col(f"p.{key}")) & (F.col("i.y1") == F.col("p.y1")) & (F.col("i.x1") >= F.col("p.x1")) & (F.col("i.x2") <= F.col("p.x2")))
    held = written(held.select(f"i.{key}", *[f"i.{s}" for s in SIDES], F.col("p.piece").alias("word")), "held")
    shapes = pieced.select(key, F.col("piece").alias("word"), F.col("left").alias("x1"), F.col("top").alias("y1"), F.col("right").alias("x2"), F.col("bottom").alias("y2")).distinct()
    wrapping = written(tile_join(shapes, boxes.select(key, *SIDES), [key]).select(F.col("a.word").alias("word")).distinct(), "wrapping")
    inked = held.groupBy("word").agg(F.sum(F.col("x2") - F.col("x1")).alias("ink")).where(F.col("ink") >= WORD_INK)
    whole = shapes.join(inked, "word").join(wrapping, "word", "left_anti").select(key, *SIDES)
    broken = ink.pieces(held.join(wrapping, "word").select("word", *SIDES), "word").where(F.col("area") >= MARK_INK)
    marks = broken.select("word", "piece", F.col("left").alias("x1"), F.col("top").alias("y1"), F.col("right").alias("x2"), F.col("bottom").alias("y2")).distinct()
    return whole.union(marks.join(held.select("word", key).distinct(), "word").select(key, *SIDES))


def _either(fn: object, side: str) -> Column:
    return fn(F.col(f"a.{side}"), F.col(f"b.{side}"))


def _may_join(boxes: DataFrame, bars: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """a, b (ids), away: the pairs of boxes (key, id, sides) that belong to one line or block."""
    high = F.col("y2") - F.col("y1")
    near = boxes.select(key, "id", *[F.col(s).alias(f"own_{s}") for s in SIDES], F.floor(F.col("x1") - FAR * high).alias("x1"), F.floor(F.col("y1") - BELOW * high).alias("y1"), F.ceil(F.col("x2") + FAR * high).alias("x2"), F.ceil(F.col("y2") + BELOW * high).alias("y2"))
    # both boxes look around themselves, so each pair is met from its larger side at least
    other = boxes.select(key, "id", *SIDES)
    met = tile_join(near, other, [key]).where("a.id != b.id").select(key, F.struct("a.id", *[F.col(f"a.own_{s}").alias(s) for s in SIDES]).alias("p"), "b")
    met = met.select(key, F.when(F.col("p.id") < F.col("b.id"), F.col("p")).otherwise(F.struct(*[F.col(f"b.{c}") for c in ("id", *SIDES)])).alias("a"), F.when(F.col("p.id") < F.col("b.id"), F.struct(*[F.col(f"b.{c}") for c in ("id", *SIDES)])).otherwise(F.col("p")).alias("b")).distinct()
    heights = [F.col(f"{n}.y2") - F.col(f"{n}.y1") for n in "ab"]
    small, tall = F.least(*heights), F.greatest(*heights)
    over_y, over_x = _either(F.least, "y2") - _either(F.greatest, "y1"), _either(F.least, "x2") - _either(F.greatest, "x1")
    level = (tall <= SIZES_APART * small) & (over_y >= LEVEL * small)
    stacked = (over_x >= OVER * F.least(F.col("a.x2") - F.col("a.x1"), F.col("b.x2") - F.col("b.x1"))) & (-over_y <= BELOW * small)
    sure = stacked | (level & (-over_x <= NEAR * small))
    maybe = level & (-over_x <= FAR * small)
    union = [_either(F.least, "x1").alias("x1"), _either(F.least, "y1").alias("y1"), _either(F.greatest, "x2").alias("x2"), _either(F.greatest, "y2").alias("y2")]
    space = F.struct(_either(F.least, "x2").alias("x1"), (_either(F.greatest, "y1") - GUTTER_REACH * over_y).alias("y1"), _either(F.greatest, "x1").alias("x2"), (_either(F.least, "y2") + GUTTER_REACH * over_y).alias("y2"))
    pairs = met.where(sure | maybe).select(key, F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"), sure.alias("sure"), *union, space.alias("space"), F.struct(F.abs(over_y), F.abs(over_x)).alias("away"))
    pairs = written(pairs, "pairs")
    # a strip without ink far above and below is a gutter between columns, not a space between words
    strips = pairs.where("not sure").select(key, "a_id", "b_id", "space.*")
    inked = tile_join(strips, bars, [key]).select(key, F.col("a.a_id").alias("a_id"), F.col("a.b_id").alias("b_id")).distinct().withColumn("inked", F.lit(True))
    joinable = pairs.join(inked, [key, "a_id", "b_id"], "left").where("sure or inked")
    blocked = tile_join(joinable.select(key, "a_id", "b_id", *SIDES), known, [key]).select(key, F.col("a.a_id").alias("a_id"), F.col("a.b_id").alias("b_id")).distinct()
    return joinable.join(blocked, [key, "a_id", "b_id"], "left_anti").select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), "away")


def joined_boxes(found: DataFrame, bars: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """The boxes with those of one line or block as one."""
    boxes = written(found.select(key, *SIDES).withColumn("id", F.monotonically_increasing_id()), "boxes")
    while True:
        edges = written(_may_join(boxes, bars, known, key), "edges")
        if not edges.limit(1).count():
            return boxes.select(key, *SIDES)
        labels = written(connected(boxes.select("id"), edges.select("a", "b")), "labels")
        unions = boxes.join(labels, "id").groupBy(key, "label").agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"), F.count("*").alias("n"))
        over = tile_join(unions.where("n > 2").select(key, "label", *SIDES), known, [key]).select(F.col("a.label").alias("label")).distinct()
        over = written(over, "over")
        # in pieces that would cover a known box, pairs that are each other's nearest
        inside = edges.join(labels.select(F.col("id").alias("a"), "label"), "a").join(over, "label")
        ends = inside.select(F.col("a").alias("id"), "a", "b", "away").union(inside.select(F.col("b").alias("id"), "a", "b", "away"))
        nearest = ends.groupBy("id").agg(F.min(F.struct("away", "a", "b")).alias("best")).groupBy("best.a", "best.b").count().where("count = 2")
        pairs = nearest.select(F.col("a").alias("id"), F.col("a").alias("pair")).union(nearest.select(F.col("b").alias("id"), F.col("a").alias("pair")))
        kept = labels.join(over.withColumn("cut", F.lit(True)), "label", "left").join(pairs, "id", "left")
        kept = kept.select("id", F.when(F.col("cut").isNull(), F.col("label")).otherwise(F.coalesce("pair", "id")).alias("label"))
        after = boxes.join(kept, "id").groupBy(key, "label").agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"))
        after = written(after.select(key, *SIDES, F.col("label").alias("id")), "boxes")
        for t in (boxes, edges, labels, over):
            dropped(t)
        boxes = after


def recovered_boxes(bars: DataFrame, boxes: DataFrame, key: str = "page_id") -> DataFrame:
    """key, x1, y1, x2, y2 of blocks of text that no box covers, in pixels of the mask. bars: ink without rules; boxes: known regions."""
    known = boxes.select(key, *[F.col(s).cast("long").alias(s) for s in SIDES])
    dark = bars.select(key, *[F.col(s).cast("long").alias(s) for s in SIDES])
    left = written(ink.uncovered_ink(dark, known, key), "uncovered")
    blocks = joined_boxes(words_of_ink(left, known, key), dark, known, key)
    blocks = blocks.where((F.col("y2") - F.col("y1") >= LEAST_HEIGHT) & (F.col("x2") - F.col("x1") >= 2 * LEAST_HEIGHT)).withColumn("id", F.monotonically_increasing_id())
    blocks = written(blocks, "blocks")
    common = F.least("a.x2", "b.x2") - F.greatest("a.x1", "b.x1")
    inked = tile_join(blocks, left, [key]).groupBy(F.col("a.id").alias("id")).agg(F.sum(common).alias("ink")).where(F.col("ink") >= BLOCK_INK)
    return blocks.join(inked, "id").select(key, *SIDES)


def as_detections(found: DataFrame, sizes: DataFrame, scale: int = 4, key: str = "page_id") -> DataFrame:
    """Recovered boxes as text detections of the page, a pixel of the mask wider on each side. sizes: key, page_width, page_height."""
    low, high = lambda s: F.greatest(F.lit(0), (F.col(s) - 1) * scale).cast("double"), lambda s, most: F.least(F.col(most), (F.col(s) + 1) * scale).cast("double")
    return found.join(sizes, key).select(key, F.lit("text").alias("class"), F.lit(0.0).alias("confidence"), low("x1").alias("x1"), low("y1").alias("y1"), high("x2", "page_width").alias("x2"), high("y2", "page_height").alias("y2"), "page_width", "page_height", F.lit(True).alias("recovered"))
