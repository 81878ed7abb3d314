"""Layout boxes as tables: page measures, columns, blocks, reading order, edges, gaps, merging, coverage.

Windows are always partitioned by page. The names center_x and center_y are kept for the right and bottom edge, which the
orders below depend on.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .pages import by_group

# What the detector calls a box, and the class of the region that it becomes.
CLASSES = {
    "plain text": "text",
    "text": "text",
    "title": "title",
    "figure": "figure",
    "table": "table",
    "figure_caption": "text",
    "table_caption": "text",
    "table_footnote": "text",
    "isolate_formula": "text",
    "formula_caption": "text",
}
KEPT_CLASSES = ("figure", "table", "text", "abandon")


def page() -> Window:
    return Window.partitionBy("page_id")


def plain_text_class(c: Column) -> Column:
    return F.when(c == "plain text", "text").otherwise(c)


def map_class(df: DataFrame) -> DataFrame:
    """Detector classes to region classes; unknown ones (such as 'abandon') go."""
    table = F.create_map(*[F.lit(x) for kv in CLASSES.items() for x in kv])
    return df.withColumn("class", table[F.col("class")]).where("class is not null")


def title_class(c: Column) -> Column:
    return F.when(~c.isin(*KEPT_CLASSES), "title").otherwise(c)


def clamp(df: DataFrame, width: Column, height: Column, least: int = 2) -> DataFrame:
    """Boxes inside the page; those that are narrower or lower than `least` go."""
    inside = df.withColumns({"x1": F.greatest(F.lit(0.0), "x1"), "y1": F.greatest(F.lit(0.0), "y1"), "x2": F.least(width, F.col("x2")), "y2": F.least(height, F.col("y2"))})
    return inside.where((F.col("x2") - F.col("x1") >= least) & (F.col("y2") - F.col("y1") >= least))


def box_metrics(df: DataFrame, key: list[str] | None = None) -> DataFrame:
    """width, height, ratio, center_x, center_y, median_box_width (of text boxes), print area and column counts.

    With a key the boxes of a page are sorted by bottom edge and key at once, which page_blocks needs, and not by page first.
    """
    df = df.withColumns({"width": F.expr("x2 - x1"), "height": F.expr("y2 - y1")}).withColumns({"ratio": F.expr("height / width"), "center_x": F.expr("width + x1"), "center_y": F.expr("height + y1")})
    if key:
        df = df.repartition("page_id").sortWithinPartitions("page_id", "center_y", *key)
    df = print_area(df.withColumn("median_box_width", F.median(F.when(F.col("class") == "text", F.col("width"))).over(page())))
    return df.withColumn("column_counts", F.coalesce(F.floor(F.col("print_width") / F.col("median_box_width")), F.lit(1))).withColumn("column_width", F.col("print_width") / F.col("column_counts"))


def print_area(df: DataFrame) -> DataFrame:
    w = page()
    df = df.withColumns({"print_x1": F.min("x1").over(w), "print_y1": F.min("y1").over(w), "print_x2": F.max("x2").over(w), "print_y2": F.max("y2").over(w)})
    return df.withColumns({"print_height": F.expr("cast(print_y2 - print_y1 as int)"), "print_width": F.expr("cast(print_x2 - print_x1 as int)")}).withColumn("print_area", F.expr("print_height * print_width"))


def abandon_line(df: DataFrame, top: float = 0.1) -> DataFrame:
    """The lowest edge of 'abandon' boxes that begin in the top share of the page; null without one."""
    at_top = (F.col("class") == "abandon") & (F.col("y1") <= F.col("print_y1") + top * F.col("print_height"))
    return df.withColumn("abandon_line", F.max(F.when(at_top, F.col("y2"))).over(page()))


def assign_columns(df: DataFrame, share: float = 0.1) -> DataFrame:
    """column_number, c1, c2: the only column that holds at least `share` of the box's width; 0 and the print area if none or several do."""
    left = F.col("print_x1").cast("double")
    step = (F.col("print_x2") + 0.001 - F.col("print_x1")) / F.col("column_counts")
    edge = lambda k: left + step * k
    common = lambda k: F.least(F.col("x2").cast("double"), edge(k)) - F.greatest(F.col("x1").cast("double"), edge(k - 1))
    count = F.col("column_counts").cast("int")
    all_columns = F.when(count >= 1, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    hit = F.filter(all_columns, lambda k: (common(k) > 0) & (common(k) >= (F.col("x2") - F.col("x1")) * share))
    df = df.withColumn("_in", hit)
    one = F.size("_in") == 1
    number = F.when(one, F.col("_in")[0]).otherwise(F.lit(0))
    return df.withColumn("column_number", number).withColumns({"c1": F.when(one, edge(F.col("column_number") - 1)).otherwise(left), "c2": F.when(one, edge(F.col("column_number"))).otherwise(F.col("print_x2").cast("double"))}).drop("_in")


def page_blocks(df: DataFrame, key: list[str]) -> DataFrame:
    """page_block: spanning titles (column 0), numbered by bottom edge, start blocks; a box is in the last one that begins at or above its top (0: none).

    As an as-of join in one pass: titles and boxes of a page are one sorted stream, and the highest number so far holds.
    """
    opens = (F.col("class") == "title") & (F.col("column_number") == 0)
    order = Window.partitionBy("page_id").orderBy("center_y", *key)
    number = F.when(opens, F.sum(opens.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    above = F.max("_number").over(Window.partitionBy("page_id").orderBy("y1").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    found = F.when(F.col("y1").isNull(), F.col("_number")).otherwise(above)
    return df.withColumn("_number", number).withColumn("page_block", F.coalesce(found, F.lit(0)).cast("int")).drop("_number")


def reading_order(df: DataFrame, key: list[str]) -> DataFrame:
    """Exact duplicates in one (page, block, column) go, the most confident stays; then the page's boxes are numbered."""
    copies = Window.partitionBy("page_id", "page_block", "column_number", "x1", "y1", "x2", "y2").orderBy(F.desc("confidence"), *key)
    order = Window.partitionBy("page_id").orderBy("page_block", "column_number", "y1", "center_y", *key)
    df = df.withColumn("_copy", F.row_number().over(copies)).where("_copy = 1").drop("_copy")
    return df.withColumn("reading_order", F.row_number().over(order)).withColumn("box_page_id", F.concat(F.lit("B"), "page_block", F.lit("C"), "column_number", F.lit("R"), "reading_order"))


def adjust_bottoms(df: DataFrame, key: list[str]) -> DataFrame:
    """y2 becomes the y1 of the next box in the (page, block, column); the last box keeps its own."""
    order = Window.partitionBy("page_id", "page_block", "column_number").orderBy("y1", *key)
    return df.withColumn("y2", F.coalesce(F.lead("y1").over(order), F.col("y2")))


def adjust_sides(df: DataFrame) -> DataFrame:
    """Boxes other than figures reach their column's edges at least."""
    figure = F.col("class") == "figure"
    return df.withColumns({"x1": F.when(figure, F.col("x1")).otherwise(F.least("x1", "c1")), "x2": F.when(figure, F.col("x2")).otherwise(F.greatest("x2", "c2"))})


def fill_column_gaps(df: DataFrame) -> DataFrame:
    """On pages of several columns and one block: text boxes above a column's first and below its last box; reading_order -1 marks them.

    Boxes that begin or end a column with a gap are told twice or three times over, so the boxes are worked out once.
    """
    return _told_with_gaps(_gaps(df), F.array_insert("_gaps", 1, F.lit("box")), df.columns)


def column_gaps(df: DataFrame) -> DataFrame:
    """The boxes that fill_column_gaps adds, alone."""
    return _told_with_gaps(_gaps(df, alone=True), F.col("_gaps"), df.columns)


def _gaps(df: DataFrame, alone: bool = False) -> DataFrame:
    """_top and _bottom of a box's page, and _gaps: 'above' and 'below' where a text box fits between them and the box. alone: only boxes that may have gaps."""
    w, column = page(), Window.partitionBy("page_id", "column_number").orderBy("reading_order")
    df = df.withColumns({"_cols": F.max("column_number").over(w), "_low": F.min("page_block").over(w), "_high": F.max("page_block").over(w), "_top": F.min("y1").over(w), "_bottom": F.max("y2").over(w)})
    may = (F.col("_cols") > 1) & (F.col("_low") == F.col("_high")) & (F.col("column_number") > 0)
    df = (df.where(may) if alone else df.withColumn("_may", may)).drop("_cols", "_low", "_high")
    may = F.lit(True) if alone else F.col("_may")
    ends = {"above": F.lag(F.lit(1)).over(column).isNull() & (F.col("y1") > F.col("_top")), "below": F.lead(F.lit(1)).over(column).isNull() & (F.col("y2") < F.col("_bottom"))}
    return df.withColumn("_gaps", F.array_compact(F.array(*[F.when(may & at_end, side) for side, at_end in ends.items()])))


def _told_with_gaps(df: DataFrame, told: Column, columns: list[str]) -> DataFrame:
    """A row for each entry of `told`: the box itself, or a text box above or below it."""
    df = df.withColumn("_told", F.explode(told))
    own, above = F.col("_told") == "box", F.col("_told") == "above"
    new = {"class": F.lit("text"), "y1": F.when(above, F.col("_top")).otherwise(F.col("y2")), "y2": F.when(above, F.col("y1")).otherwise(F.col("_bottom")), "reading_order": F.lit(-1)}
    new |= {c: F.col(c) for c in ("page_id", "column_number", "x1", "x2", "page_block", "c1", "c2")}
    return df.select(*[F.when(own, F.col(c)).otherwise(new.get(c)).alias(c) for c in columns])


def merge_column_boxes(df: DataFrame, multiplier: float = 1.5) -> DataFrame:
    """Neighbours of one class in a column grow together while the result is at most column_width * multiplier high; figures, tables and column 0 stay.

    The height test looks at the box merged so far, so a page's column is folded in order (pages hold tens of boxes).
    """

    def fold(part: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        kind, column, limit = part["class"].tolist(), part["column_number"].tolist(), (part["column_width"].astype(float) * multiplier).tolist()
        x1, y1, x2, y2 = (part[c].tolist() for c in ("x1", "y1", "x2", "y2"))
        kept, grown, into, begins = [], set(), None, set(starts.tolist())
        for i in range(len(part)):
            if i in begins:
                into = None
            if kind[i] in ("figure", "table"):
                into = None
            elif column[i] != 0:
                if into is not None and kind[into] == kind[i] and max(y2[into], y2[i]) - min(y1[into], y1[i]) <= limit[i]:
                    x1[into], y1[into] = min(x1[into], x1[i]), min(y1[into], y1[i])
                    x2[into], y2[into] = max(x2[into], x2[i]), max(y2[into], y2[i])
                    grown.add(into)
                    continue
                into = i
            kept.append(i)
        out = _kept(part, kept, {"x1": x1, "y1": y1, "x2": x2, "y2": y2})
        new = np.array([i in grown for i in kept], bool)
        for middle, low, high in (("center_x", "x1", "x2"), ("center_y", "y1", "y2")):
            out[middle] = np.where(new, (out[low].astype(float) + out[high].astype(float)) / 2, out[middle].astype(float))
        return out

    return by_group(df, ["page_id", "column_number"], ["reading_order"], fold, df.schema)


def _kept(part: pd.DataFrame, rows: list[int], new: dict[str, list]) -> pd.DataFrame:
    """The chosen rows of part with new values in some columns."""
    out = part.iloc[rows].reset_index(drop=True)
    for column, values in new.items():
        out[column] = [values[i] for i in rows]
    return out


def merge_overlapping(df: DataFrame, share: float = 0.5) -> DataFrame:
    """Neighbours in reading order that share at least half of the smaller height become one box."""

    def fold(part: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        kind = part["class"].tolist()
        x1, y1, x2, y2 = (part[c].tolist() for c in ("x1", "y1", "x2", "y2"))
        kept, begins = [], set(starts.tolist())
        for i in range(len(part)):
            if i not in begins:
                k = kept[-1]
                least = min(y2[k] - y1[k], y2[i] - y1[i])
                if kind[k] == kind[i] and least > 0 and min(y2[k], y2[i]) - max(y1[k], y1[i]) >= share * least:
                    x1[k], y1[k] = min(x1[k], x1[i]), min(y1[k], y1[i])
                    x2[k], y2[k] = max(x2[k], x2[i]), max(y2[k], y2[i])
                    continue
            kept.append(i)
        return _kept(part, kept, {"x1": x1, "y1": y1, "x2": x2, "y2": y2})

    return by_group(df, ["page_id", "column_number"], ["reading_order"], fold, df.schema)


COVERAGE = "page_id long, text_coverage_pixels long, text_overlap_pixels long, text_image_overlap long, total_covered_pixels long, total_overlap long, maximum_print_area long, perc_print_area_overlap double, perc_print_area_coverage double"


def page_coverage(df: DataFrame) -> DataFrame:
    """How many pixels text boxes, figures and both cover, by a grid of the distinct edges instead of pixels. Needs the print area columns."""

    def measure(part: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        inside = lambda e, low, size: np.clip(np.trunc(part[e].to_numpy(float) - part[low].to_numpy(float)), 0, part[size].to_numpy(float)).astype(np.int64)
        x1, x2 = (inside(e, "print_x1", "print_width") for e in ("x1", "x2"))
        y1, y2 = (inside(e, "print_y1", "print_height") for e in ("y1", "y2"))
        figure, pages, areas = (part["class"] == "figure").to_numpy(), part["page_id"].tolist(), part["print_area"].tolist()
        rows = []
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(part)], strict=True):
            xs, ys = np.unique(np.concatenate((x1[a:b], x2[a:b]))), np.unique(np.concatenate((y1[a:b], y2[a:b])))
            # counts of boxes in each cell of the grid of edges, as a product of what each box covers along both sides
            along_x = (xs[None, :-1] >= x1[a:b, None]) & (xs[None, :-1] < x2[a:b, None])
            along_y = (ys[None, :-1] >= y1[a:b, None]) & (ys[None, :-1] < y2[a:b, None])
            size, image = np.outer(np.diff(ys), np.diff(xs)), figure[a:b]
            texts = along_y[~image].T.astype(np.float32) @ along_x[~image].astype(np.float32)
            images = along_y[image].T.astype(np.float32) @ along_x[image].astype(np.float32)
            total = lambda flag: int(size[flag].sum())  # noqa: B023, E731
            over, covered, whole = total(texts + images > 1), total(texts + images > 0), int(areas[a])
            shares = (round(over / whole, 2), round(covered / whole, 2)) if whole else (0.0, 0.0)
            rows.append((pages[a], total(texts > 0), total(texts > 1), total((texts > 0) & (images > 0)), covered, over, whole, *shares))
        return pd.DataFrame(rows, columns=[x.split()[0] for x in COVERAGE.split(", ")])

    return by_group(df, ["page_id"], [], measure, COVERAGE)


def interval_clusters(df: DataFrame, group: str, start: str, stop: str, key: list[str]) -> DataFrame:
    """cluster (from 1) of each interval in its group: an interval that starts before the furthest end so far joins the cluster."""
    order = Window.partitionBy(group).orderBy(start, stop, *key)
    so_far = F.max(stop).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(so_far.isNull() | (F.col(start) >= so_far), 1).otherwise(0)
    return df.withColumn("_new", fresh).withColumn("cluster", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_new")


def postprocess(df: DataFrame, key: list[str], min_height: float = 10, multiplier: float = 1.5, drop_abandon: bool = True, fill: bool = True) -> DataFrame:
    """The whole chain from raw detections to numbered boxes. Column counts come from the print area with 'abandon' boxes, column bins from the one without."""
    df = box_metrics(df, key)
    df = abandon_line(df)
    if drop_abandon:
        df = df.where("class != 'abandon'")
    df = assign_columns(print_area(df)).withColumn("class", title_class(F.col("class")))
    df = reading_order(page_blocks(df, key), key)
    df = adjust_sides(adjust_bottoms(df, key))
    if fill:
        filled = fill_column_gaps(df)
        df = filled.withColumns({k: F.coalesce(F.col(k), F.lit(0).cast(dict(df.dtypes)[k])) for k in key}).withColumn("confidence", F.coalesce("confidence", F.lit(1.0)))
        df = df.withColumn("center_y", F.coalesce("center_y", "y2")).withColumn("column_width", F.max("column_width").over(page()))
    df = df.withColumn("height", F.expr("y2 - y1")).where(F.col("height") >= min_height)
    df = reading_order(df, key)
    df = merge_column_boxes(df, multiplier)
    return reading_order(adjust_bottoms(df, key), key)


def column_regions(detections: DataFrame, key: list[str]) -> DataFrame:
    """Regions by columns, the older way to make them from raw detections (with page_width and page_height), held inside the page."""
    size = detections.groupBy("page_id").agg(F.max("page_width").alias("_width"), F.max("page_height").alias("_height"))
    kind = F.when(F.col("class") == "plain text", "text").otherwise(F.col("class"))
    rows = postprocess(detections.withColumn("class", kind), key).join(size, "page_id")
    return clamp(rows, F.col("_width"), F.col("_height")).drop("_width", "_height").withColumn("recovered", F.lit(False))


def figures_with_own_text(regions: DataFrame, share: float = 0.8) -> DataFrame:
    """Figures whose text no other region covers: not mostly inside another region, not holding most of a text region, not mostly inside an earlier figure."""
    a, b = regions.alias("a"), regions.alias("b")
    edge = lambda f, e: f(F.col(f"a.{e}"), F.col(f"b.{e}"))
    common = F.greatest(edge(F.least, "x2") - edge(F.greatest, "x1"), F.lit(0)) * F.greatest(edge(F.least, "y2") - edge(F.greatest, "y1"), F.lit(0))
    size = lambda n: F.greatest(F.col(f"{n}.x2") - F.col(f"{n}.x1"), F.lit(0)) * F.greatest(F.col(f"{n}.y2") - F.col(f"{n}.y1"), F.lit(0))
    covered = common >= share * size("a")
    rule = F.when(F.col("b.class") == "figure", covered & (F.col("b.reading_order") < F.col("a.reading_order"))).otherwise(covered | (common >= share * size("b")))
    clash = (F.col("a.page_id") == F.col("b.page_id")) & (F.col("a.reading_order") != F.col("b.reading_order")) & (common > 0) & rule
    return a.where(F.col("a.class") == "figure").join(b, clash, "left_anti")
