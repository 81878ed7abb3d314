"""Layout box queries over boxes derived from lineitem, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import boxes as B
from ..operators import iiif, layout, quality, readings
from ..sources.io import table

KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
K = ", ".join(KEY)


def boxes(spark: SparkSession, d: str) -> DataFrame:
    """Boxes with exact arithmetic: ten orders make a page, the row key of lineitem breaks ties."""
    li = table(spark, d, "lineitem")
    first = li.select(*KEY, F.expr("l_orderkey div 10").alias("page_id"), F.expr("case l_returnflag when 'A' then 'title' when 'N' then 'text' else 'figure' end").alias("class"), F.col("l_discount").alias("confidence"), F.expr("cast((l_linenumber % 4) * 250 + (l_partkey % 30) as double)").alias("x1"), F.expr("cast((l_suppkey * 37 + l_linenumber * 113) % 1200 as double)").alias("y1"), F.expr("2 * floor(l_quantity)").alias("q"))
    return first.select(*KEY, "page_id", "class", "confidence", "x1", "y1", F.expr("cast(x1 + 180 + q as double)").alias("x2"), F.expr("cast(y1 + 20 + (l_partkey % 90) as double)").alias("y2"))


BOXES = f"""boxes AS (SELECT *, x1 + 180 + 2 * floor(l_quantity) AS x2, y1 + 20 + (l_partkey % 90) AS y2 FROM (
  SELECT {K}, l_quantity, l_orderkey // 10 AS page_id, CASE l_returnflag WHEN 'A' THEN 'title' WHEN 'N' THEN 'text' ELSE 'figure' END AS class, l_discount AS confidence,
   CAST((l_linenumber % 4) * 250 + (l_partkey % 30) AS DOUBLE) AS x1, CAST((l_suppkey * 37 + l_linenumber * 113) % 1200 AS DOUBLE) AS y1 FROM lineitem))"""
METRICS = f"""{BOXES}, metrics AS (SELECT *, CAST(trunc(print_x2 - print_x1) AS INTEGER) AS print_width, CAST(trunc(print_y2 - print_y1) AS INTEGER) AS print_height FROM (
  SELECT *, x2 - x1 AS width, y2 - y1 AS height, (y2 - y1) / (x2 - x1) AS ratio, x2 AS center_x, y2 AS center_y, median(CASE WHEN class = 'text' THEN x2 - x1 END) OVER p AS median_box_width,
   min(x1) OVER p AS print_x1, min(y1) OVER p AS print_y1, max(x2) OVER p AS print_x2, max(y2) OVER p AS print_y2 FROM boxes WINDOW p AS (PARTITION BY page_id))),
counted AS (SELECT *, CAST(coalesce(floor(print_width / median_box_width), 1) AS BIGINT) AS column_counts FROM metrics)"""
COLUMNS = f"""{METRICS}, hits AS (SELECT *, (print_x2 + 0.001 - print_x1) / column_counts AS step, list_filter(range(1, column_counts + 1), lambda k:
   least(x2, print_x1 + (print_x2 + 0.001 - print_x1) / column_counts * k) - greatest(x1, print_x1 + (print_x2 + 0.001 - print_x1) / column_counts * (k - 1)) > 0
   AND least(x2, print_x1 + (print_x2 + 0.001 - print_x1) / column_counts * k) - greatest(x1, print_x1 + (print_x2 + 0.001 - print_x1) / column_counts * (k - 1)) >= (x2 - x1) * 0.1) AS within FROM counted),
columned AS (SELECT *, CAST(CASE WHEN len(within) = 1 THEN within[1] ELSE 0 END AS INTEGER) AS column_number, CASE WHEN len(within) = 1 THEN print_x1 + step * (within[1] - 1) ELSE print_x1 END AS c1, CASE WHEN len(within) = 1 THEN print_x1 + step * within[1] ELSE print_x2 END AS c2 FROM hits)"""
BLOCKS = f"""{COLUMNS}, seps AS (SELECT page_id, {K}, y1 AS sep_from, row_number() OVER o AS i, lead(y1) OVER o AS sep_to FROM columned WHERE class = 'title' AND column_number = 0 WINDOW o AS (PARTITION BY page_id ORDER BY center_y, {K})),
blocked AS (SELECT c.*, CAST(coalesce((SELECT max(i) FROM seps s WHERE s.page_id = c.page_id AND (({" AND ".join(f"s.{k} = c.{k}" for k in KEY)}) OR (c.y1 >= s.sep_from AND (s.sep_to IS NULL OR c.y1 < s.sep_to)))), 0) AS INTEGER) AS page_block FROM columned c)"""
ORDERED = f"""{BLOCKS}, ordered AS (SELECT *, CAST(row_number() OVER (PARTITION BY page_id ORDER BY page_block, column_number, y1, center_y, {K}) AS INTEGER) AS reading_order FROM (
  SELECT * FROM blocked QUALIFY row_number() OVER (PARTITION BY page_id, page_block, column_number, x1, y1, x2, y2 ORDER BY confidence DESC, {K}) = 1))"""
ADJUSTED = f"""{ORDERED}, lowered AS (SELECT * EXCLUDE (y2), coalesce(lead(y1) OVER (PARTITION BY page_id, page_block, column_number ORDER BY y1, {K}), y2) AS y2 FROM ordered),
adjusted AS (SELECT * EXCLUDE (x1, x2), CASE WHEN class = 'figure' THEN x1 ELSE least(x1, c1) END AS x1, CASE WHEN class = 'figure' THEN x2 ELSE greatest(x2, c2) END AS x2 FROM lowered)"""


def _columns(spark, d):
    return B.assign_columns(B.box_metrics(boxes(spark, d), KEY))


def _ordered(spark, d):
    return B.reading_order(B.page_blocks(_columns(spark, d), KEY), KEY)


def _adjusted(spark, d):
    return B.adjust_sides(B.adjust_bottoms(_ordered(spark, d), KEY))


def _near(*names):
    return [F.round(n, 6).alias(n) for n in names]


def class_remap(spark, d):
    raw = F.expr("case l_partkey % 6 when 0 then 'plain text' when 1 then 'figure_caption' when 2 then 'abandon' when 3 then 'table' when 4 then 'header' else class end")
    df = boxes(spark, d).withColumn("raw", raw)
    mapped = B.map_class(df.withColumn("class", F.col("raw"))).select(*KEY, F.col("class").alias("mapped"))
    return df.select(*KEY, B.title_class(B.plain_text_class(F.col("raw"))).alias("class")).join(mapped, KEY, "left")


CLASS_REMAP = f"""WITH {BOXES}, r AS (SELECT {K}, CASE l_partkey % 6 WHEN 0 THEN 'plain text' WHEN 1 THEN 'figure_caption' WHEN 2 THEN 'abandon' WHEN 3 THEN 'table' WHEN 4 THEN 'header' ELSE class END AS raw FROM boxes)
SELECT {K}, CASE WHEN raw = 'plain text' THEN 'text' WHEN raw NOT IN ('figure', 'table', 'text', 'abandon') THEN 'title' ELSE raw END AS class,
 CASE WHEN raw IN ('plain text', 'text', 'figure_caption') THEN 'text' WHEN raw IN ('title', 'figure', 'table') THEN raw END AS mapped FROM r"""


def box_metrics(spark, d):
    return B.box_metrics(boxes(spark, d)).select(*KEY, "page_id", "width", "height", "center_x", "center_y", "median_box_width", "print_width", "print_height", F.col("column_counts").cast("long").alias("column_counts"), *_near("ratio", "column_width"))


BOX_METRICS = f"WITH {METRICS} SELECT {K}, page_id, width, height, center_x, center_y, median_box_width, print_width, print_height, column_counts, round(ratio, 6) AS ratio, round(print_width::DOUBLE / column_counts, 6) AS column_width FROM counted"


def abandon_reclass(spark, d):
    df = B.box_metrics(boxes(spark, d)).withColumn("class", F.when(F.col("class") == "figure", "abandon").otherwise(F.col("class")))
    return B.abandon_line(df).select(*KEY, "page_id", "class", "abandon_line")


ABANDON_RECLASS = f"WITH {METRICS} SELECT {K}, page_id, CASE WHEN class = 'figure' THEN 'abandon' ELSE class END AS class, max(CASE WHEN class = 'figure' AND y1 <= print_y1 + 0.1 * print_height THEN y2 END) OVER (PARTITION BY page_id) AS abandon_line FROM metrics"


def assign_columns(spark, d):
    return _columns(spark, d).select(*KEY, "page_id", "column_number", *_near("c1", "c2"))


ASSIGN_COLUMNS = f"WITH {COLUMNS} SELECT {K}, page_id, column_number, round(c1, 6) AS c1, round(c2, 6) AS c2 FROM columned"


def page_blocks(spark, d):
    return B.page_blocks(_columns(spark, d), KEY).select(*KEY, "page_id", "page_block")


PAGE_BLOCKS = f"WITH {BLOCKS} SELECT {K}, page_id, page_block FROM blocked"


def reading_order(spark, d):
    return _ordered(spark, d).select(*KEY, "page_id", "reading_order", "box_page_id")


READING_ORDER = f"WITH {ORDERED} SELECT {K}, page_id, reading_order, 'B' || page_block || 'C' || column_number || 'R' || reading_order AS box_page_id FROM ordered"


def adjust_edges(spark, d):
    return _adjusted(spark, d).select(*KEY, "page_id", *_near("x1", "x2", "y2"))


ADJUST_EDGES = f"WITH {ADJUSTED} SELECT {K}, page_id, round(x1, 6) AS x1, round(x2, 6) AS x2, round(y2, 6) AS y2 FROM adjusted"


def fill_column_gaps(spark, d):
    some = _adjusted(spark, d).where("not (class = 'title' and column_number = 0)").withColumn("page_block", F.lit(0))
    return B.column_gaps(some).select("page_id", "column_number", "class", *_near("x1", "y1", "x2", "y2"))


FILL_COLUMN_GAPS = f"""WITH {ADJUSTED}, part AS (SELECT *, max(column_number) OVER (PARTITION BY page_id) AS cols, min(y1) OVER (PARTITION BY page_id) AS top, max(y2) OVER (PARTITION BY page_id) AS bottom FROM adjusted WHERE NOT (class = 'title' AND column_number = 0)),
ends AS (SELECT page_id, column_number, top, bottom, arg_min(y1, reading_order) AS a_y1, arg_min(x1, reading_order) AS a_x1, arg_min(x2, reading_order) AS a_x2, arg_max(y2, reading_order) AS z_y2, arg_max(x1, reading_order) AS z_x1, arg_max(x2, reading_order) AS z_x2 FROM part WHERE cols > 1 AND column_number > 0 GROUP BY ALL)
SELECT page_id, column_number, 'text' AS class, round(a_x1, 6) AS x1, round(top, 6) AS y1, round(a_x2, 6) AS x2, round(a_y1, 6) AS y2 FROM ends WHERE a_y1 > top
UNION ALL SELECT page_id, column_number, 'text', round(z_x1, 6), round(z_y2, 6), round(z_x2, 6), round(bottom, 6) FROM ends WHERE z_y2 < bottom"""


def merge_column_boxes(spark, d):
    return B.merge_column_boxes(_adjusted(spark, d)).select("page_id", "column_number", "class", "reading_order", *_near("x1", "y1", "x2", "y2"))


def merge_overlapping_boxes(spark, d):
    return B.merge_overlapping(_ordered(spark, d)).select("page_id", "column_number", "class", "reading_order", *_near("x1", "y1", "x2", "y2"))


def _folded(source, fits, grows):
    """Boxes of a page's column folded in order: state holds the open box, a step takes the next row and starts a group where it doesn't fit."""
    return f"""rows AS (SELECT *, row_number() OVER (PARTITION BY page_id, column_number ORDER BY reading_order) AS n FROM {source}),
folded AS (
  SELECT page_id, column_number, n, reading_order AS lead_order, class, x1, y1, x2, y2 FROM rows WHERE n = 1
  UNION ALL
  SELECT r.page_id, r.column_number, r.n, CASE WHEN {fits} THEN f.lead_order ELSE r.reading_order END, r.class,
    CASE WHEN {fits} THEN least(f.x1, r.x1) ELSE r.x1 END, CASE WHEN {fits} THEN least(f.y1, r.y1) ELSE r.y1 END,
    CASE WHEN {fits} THEN greatest(f.x2, r.x2) ELSE r.x2 END, CASE WHEN {fits} THEN greatest(f.y2, r.y2) ELSE r.y2 END
  FROM folded f JOIN rows r ON r.page_id = f.page_id AND r.column_number = f.column_number AND r.n = f.n + 1
)
SELECT page_id, column_number, class, lead_order AS reading_order, {grows} FROM folded QUALIFY row_number() OVER (PARTITION BY page_id, column_number, lead_order ORDER BY n DESC) = 1"""


_SIDES = ", ".join(f"round({c}, 6) AS {c}" for c in ("x1", "y1", "x2", "y2"))
MERGE_COLUMN_BOXES = "WITH RECURSIVE " + ADJUSTED + ", sized AS (SELECT *, print_width::DOUBLE / column_counts AS column_width FROM adjusted), " + _folded(
    "sized", "r.column_number <> 0 AND r.class NOT IN ('figure', 'table') AND f.class = r.class AND greatest(f.y2, r.y2) - least(f.y1, r.y1) <= r.column_width * 1.5", _SIDES
)
MERGE_OVERLAPPING_BOXES = "WITH RECURSIVE " + ORDERED + ", " + _folded(
    "ordered", "f.class = r.class AND least(f.y2 - f.y1, r.y2 - r.y1) > 0 AND least(f.y2, r.y2) - greatest(f.y1, r.y1) >= 0.5 * least(f.y2 - f.y1, r.y2 - r.y1)", _SIDES
)


def postprocess_boxes(spark, d):
    return B.postprocess(boxes(spark, d), KEY).select("page_id", "box_page_id", "class", "reading_order", *_near("x1", "y1", "x2", "y2"))


def page_coverage(spark, d):
    return B.page_coverage(B.print_area(boxes(spark, d)))


# strips between neighbouring edges of a page; in each, running counts over the lower and upper edges of the boxes that cross it
PAGE_COVERAGE = f"""WITH {METRICS}, cut AS (SELECT page_id, class = 'figure' AS image, print_width * print_height AS whole,
  least(greatest(trunc(x1 - print_x1), 0), print_width) AS a, least(greatest(trunc(x2 - print_x1), 0), print_width) AS b, least(greatest(trunc(y1 - print_y1), 0), print_height) AS c, least(greatest(trunc(y2 - print_y1), 0), print_height) AS d FROM metrics),
edges AS (SELECT DISTINCT page_id, unnest([a, b]) AS x FROM cut), strips AS (SELECT page_id, x, lead(x) OVER (PARTITION BY page_id ORDER BY x) AS x_next FROM edges),
events AS (SELECT s.page_id, s.x, s.x_next - s.x AS wide, unnest([k.c, k.d]) AS y, unnest([1, -1]) * CASE WHEN k.image THEN 0 ELSE 1 END AS t, unnest([1, -1]) * CASE WHEN k.image THEN 1 ELSE 0 END AS i
  FROM strips s JOIN cut k ON k.page_id = s.page_id AND k.a <= s.x AND k.b > s.x WHERE s.x_next IS NOT NULL),
summed AS (SELECT page_id, x, wide, y, sum(t) AS t, sum(i) AS i FROM events GROUP BY ALL),
state AS (SELECT page_id, wide * (lead(y) OVER o - y) AS area, sum(t) OVER o AS t, sum(i) OVER o AS i FROM summed WINDOW o AS (PARTITION BY page_id, x ORDER BY y)),
total AS (SELECT page_id, sum(area) FILTER (WHERE t > 0) AS text, sum(area) FILTER (WHERE t > 1) AS twice, sum(area) FILTER (WHERE t > 0 AND i > 0) AS shared, sum(area) FILTER (WHERE t + i > 0) AS covered, sum(area) FILTER (WHERE t + i > 1) AS multi FROM state GROUP BY page_id),
pages AS (SELECT DISTINCT page_id, whole FROM cut), full_total AS (SELECT page_id, whole, coalesce(text, 0) AS text, coalesce(twice, 0) AS twice, coalesce(shared, 0) AS shared, coalesce(covered, 0) AS covered, coalesce(multi, 0) AS multi FROM pages LEFT JOIN total USING (page_id))
SELECT page_id, CAST(text AS BIGINT) AS text_coverage_pixels, CAST(twice AS BIGINT) AS text_overlap_pixels, CAST(shared AS BIGINT) AS text_image_overlap, CAST(covered AS BIGINT) AS total_covered_pixels, CAST(multi AS BIGINT) AS total_overlap, CAST(whole AS BIGINT) AS maximum_print_area,
 CASE WHEN whole = 0 THEN 0.0 ELSE round_even(multi / whole, 2) END AS perc_print_area_overlap, CASE WHEN whole = 0 THEN 0.0 ELSE round_even(covered / whole, 2) END AS perc_print_area_coverage FROM full_total"""


def _keyed(spark, d):
    return boxes(spark, d).withColumn("box_key", F.row_number().over(Window.partitionBy("page_id").orderBy(*KEY)).cast("long")).select("page_id", "class", "confidence", "x1", "y1", "x2", "y2", "box_key")


def xy_cut_order(spark, d):
    return layout.xy_order(_keyed(spark, d))


def remove_nested(spark, d):
    return layout.without_nested(_keyed(spark, d))


def split_overlaps(spark, d):
    return layout.without_overlaps(layout.without_nested(_keyed(spark, d)))


def build_regions(spark, d):
    return layout.build_regions(_keyed(spark, d).withColumns({"page_width": F.lit(1300.0), "page_height": F.lit(1300.0)}))


def _regions(spark, d):
    return _keyed(spark, d).withColumn("reading_order", F.row_number().over(Window.partitionBy("page_id").orderBy("y1", "x1", "box_key")))


def figures_with_own_text(spark, d):
    small = _regions(spark, d).withColumns({"x2": F.expr("x1 + (x2 - x1) / 4"), "y2": F.expr("y1 + (y2 - y1) / 2")})
    return B.figures_with_own_text(small).select("page_id", "box_key", "reading_order")


REGIONS = f"""{BOXES}, keyed AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY {K}) AS box_key FROM boxes),
small AS (SELECT page_id, class, confidence, x1, y1, x1 + (x2 - x1) / 4 AS x2, y1 + (y2 - y1) / 2 AS y2, box_key, CAST(row_number() OVER (PARTITION BY page_id ORDER BY y1, x1, box_key) AS INTEGER) AS reading_order FROM keyed)"""
# figures alone are compared with the page's boxes, and only pairs that have something in common go on
FIGURES_WITH_OWN_TEXT = f"""WITH {REGIONS}, held AS MATERIALIZED (SELECT page_id, class, x1, y1, x2, y2, box_key, reading_order AS r FROM small), figures AS MATERIALIZED (SELECT * FROM held WHERE class = 'figure'),
pairs AS MATERIALIZED (SELECT a.page_id, a.r, b.class AS other, b.r AS o, (least(a.x2, b.x2) - greatest(a.x1, b.x1)) * (least(a.y2, b.y2) - greatest(a.y1, b.y1)) AS common, (a.x2 - a.x1) * (a.y2 - a.y1) AS mine, (b.x2 - b.x1) * (b.y2 - b.y1) AS theirs
  FROM figures a JOIN held b ON a.page_id = b.page_id WHERE a.r <> b.r AND b.x1 < a.x2 AND a.x1 < b.x2 AND b.y1 < a.y2 AND a.y1 < b.y2),
clash AS (SELECT DISTINCT page_id, r FROM pairs WHERE CASE WHEN other = 'figure' THEN common >= 0.8 * mine AND o < r ELSE common >= 0.8 * mine OR common >= 0.8 * theirs END)
SELECT f.page_id, f.box_key, f.r AS reading_order FROM figures f LEFT JOIN clash c ON c.page_id = f.page_id AND c.r = f.r WHERE c.r IS NULL"""


def interval_clusters(spark, d):
    return B.interval_clusters(boxes(spark, d), "page_id", "y1", "y2", KEY).select(*KEY, "page_id", "cluster")


INTERVAL_CLUSTERS = f"""WITH {BOXES}, f AS (SELECT *, max(y2) OVER (PARTITION BY page_id ORDER BY y1, y2, {K} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS so_far FROM boxes)
SELECT {K}, page_id, CAST(sum(CASE WHEN so_far IS NULL OR y1 >= so_far THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY y1, y2, {K}) AS BIGINT) AS cluster FROM f"""


def box_to_original(spark, d):
    matrix = G.compose(G.crop_matrix(120, 40), [0.5, 0.0, 0.0, 0.0, 0.5, 0.0])
    inverse = G.invert(F.array(*[F.lit(float(v)) for v in matrix]))
    box = G.box_to_original(inverse, F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), F.lit(2000), F.lit(2200))
    return boxes(spark, d).select(*KEY, box.alias("b")).select(*KEY, "b.x", "b.y", "b.w", "b.h")


BOX_TO_ORIGINAL = f"""WITH {BOXES}, m AS (SELECT {K}, floor(x1 * 2 + 120) AS l, floor(y1 * 2 + 40) AS t, ceil(x2 * 2 + 120) AS r, ceil(y2 * 2 + 40) AS b FROM boxes),
c AS (SELECT {K}, greatest(0, least(l, 1999)) AS x, greatest(0, least(t, 2199)) AS y, r, b FROM m)
SELECT {K}, CAST(x AS INTEGER) AS x, CAST(y AS INTEGER) AS y, CAST(greatest(x + 1, least(r, 2000)) - x AS INTEGER) AS w, CAST(greatest(y + 1, least(b, 2200)) - y AS INTEGER) AS h FROM c"""


def split_offsets(spark, d):
    part = G.split_offsets(F.expr("cast((y2 - y1) * 9 as int)"), F.expr("cast((x2 - x1) / 2 as int)"))
    return boxes(spark, d).select(*KEY, F.posexplode(part).alias("segment", "s")).select(*KEY, "segment", "s.y_start", "s.y_end")


SPLIT_OFFSETS = f"""WITH {BOXES}, h AS (SELECT {K}, CAST((y2 - y1) * 9 AS INTEGER) AS h, CAST(floor(CAST(floor((x2 - x1) / 2) AS INTEGER) * 1.5) AS INTEGER) AS size FROM boxes),
p AS (SELECT *, CAST(floor(size * 0.8) AS INTEGER) AS step, CAST(CASE WHEN h <= size THEN 0 ELSE ceil((h - size)::DOUBLE / floor(size * 0.8)) END AS INTEGER) AS last FROM h),
e AS (SELECT *, unnest(range(0, last + 1)) AS k FROM p)
SELECT {K}, CAST(k AS INTEGER) AS segment, CAST(CASE WHEN h <= size THEN 0 WHEN k = last THEN h - size ELSE k * step END AS INTEGER) AS y_start, CAST(CASE WHEN h <= size OR k = last THEN h ELSE k * step + size END AS INTEGER) AS y_end FROM e"""


def token_cap(spark, d):
    return boxes(spark, d).select(*KEY, G.token_cap(F.col("class"), F.expr("(x2 - x1) * 4"), F.expr("(y2 - y1) * 6")).alias("cap"), F.round(G.text_width(F.col("class")), 2).alias("char_width"))


TOKEN_CAP = f"WITH {BOXES} SELECT {K}, CASE WHEN class = 'figure' THEN 512 ELSE CAST(floor(least(8192, greatest(256, 6.0 * (x2 - x1) * 4 * (y2 - y1) * 6 / 2000))) AS INTEGER) END AS cap, CASE class WHEN 'title' THEN 5.0 WHEN 'text' THEN 4.0 ELSE 6.0 END AS char_width FROM boxes"


def page_report(spark, d):
    n = F.col("box_key").cast("int")
    df = _keyed(spark, d).select("page_id", n.alias("n_chandra_tokens"), (n - n % 3).alias("n_matched"), (n % 3).alias("n_estimated"), (n + 1).alias("n_tesseract_words"), F.when(n % 5 == 0, "x").otherwise("").alias("suspect"), (n % 4 == 0).alias("recovered"))
    return quality.page_report(df)


PAGE_REPORT = f"""WITH {BOXES}, n AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY {K}) AS n FROM boxes)
SELECT page_id, count(*) AS regions, CAST(sum(n) AS BIGINT) AS tokens, CAST(sum(n + 1) AS BIGINT) AS words, count(*) FILTER (WHERE n % 5 = 0) AS suspects, count(*) FILTER (WHERE n % 4 = 0) AS recovered,
 round(sum(n - n % 3)::DOUBLE / sum(n), 4) AS alignment_score, round(sum(n)::DOUBLE / sum(n), 4) AS coverage FROM n GROUP BY page_id"""


def row_measures(spark, d):
    word = F.struct(F.col("class").alias("text"), "x1", "y1", "x2", "y2")
    rows = boxes(spark, d).groupBy("page_id").agg(G.row_measures(F.collect_list(word)).alias("m"))
    return rows.select("page_id", "m.*").select("page_id", "y1", "y2", *_near("height", "char_width", "gap", "split", "stop"))


ROW_MEASURES = f"""WITH {BOXES}, w AS (SELECT *, CASE class WHEN 'title' THEN 5.0::DOUBLE WHEN 'text' THEN 4.0::DOUBLE ELSE 6.0::DOUBLE END AS chars, lead(x1) OVER (PARTITION BY page_id ORDER BY x1, y1, x2, y2) - x2 AS step FROM boxes),
m AS (SELECT page_id, CAST(trunc(quantile_cont(y1, 0.25)) AS INTEGER) AS y1, CAST(trunc(quantile_cont(y2, 0.75)) AS INTEGER) AS y2, median(y2 - y1) AS height, median((x2 - x1) / chars) AS char_width,
 coalesce(median(step) FILTER (WHERE step > 0), 0.35::DOUBLE * median(y2 - y1)) AS gap FROM w GROUP BY page_id)
SELECT page_id, y1, y2, round(height, 6) AS height, round(char_width, 6) AS char_width, round(gap, 6) AS gap, round(greatest(0.12::DOUBLE * height, 0.45::DOUBLE * gap), 6) AS split, round(greatest(2.5::DOUBLE * gap, 1.2::DOUBLE * height), 6) AS stop FROM m"""


def best_reading(spark, d):
    score = (F.col("confidence").cast("double") * 10).alias("score")
    return readings.best_reading(_keyed(spark, d).select("page_id", F.col("box_key").alias("place"), score), ["page_id"])


BEST_READING = f"""WITH {BOXES}, n AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY {K}) AS place, CAST(confidence AS DOUBLE) * 10 AS score FROM boxes)
SELECT page_id, place, score FROM n QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY score < 0.8, CASE WHEN score >= 0.8 THEN 0 ELSE -score END, place) = 1"""


def iiif_documents(spark, d):
    df = _regions(spark, d)
    box = F.struct(F.col("x1").cast("int").alias("x"), F.col("y1").cast("int").alias("y"), F.expr("cast(x2 - x1 as int)").alias("w"), F.expr("cast(y2 - y1 as int)").alias("h"))
    df = df.select("page_id", F.concat(F.lit("scans/p "), "page_id", F.lit(".tif")).alias("source_relpath"), F.lit(1300).alias("page_width"), F.lit(1300).alias("page_height"), F.concat(F.lit("B0C0R"), "reading_order").alias("box_page_id"), "class", "reading_order", F.concat(F.lit("text "), "box_key").alias("text"), F.when(F.col("box_key") % 9 == 0, "suspect").alias("suspect"), box.alias("box"))
    df = df.withColumns({"lines": F.array(F.struct("text", "box")), "words": F.array(F.struct("text", "box", F.lit("exact").alias("match")), F.struct(F.lit("b").alias("text"), F.col("box"), F.lit("estimated").alias("match")))})
    return iiif.page_documents(df, "http://localhost:8080/manifests", "http://localhost:8182/iiif/3")


NAMES = [
    "class_remap", "box_metrics", "abandon_reclass", "assign_columns", "page_blocks", "reading_order", "adjust_edges", "fill_column_gaps", "merge_column_boxes", "merge_overlapping_boxes", "postprocess_boxes", "page_coverage",
    "xy_cut_order", "remove_nested", "split_overlaps", "build_regions", "figures_with_own_text", "interval_clusters", "box_to_original", "split_offsets", "token_cap", "page_report", "row_measures",
    "best_reading", "iiif_documents",
]
QUERIES = {n: globals()[n] for n in NAMES}
ORACLE_SQL = {n: globals()[n.upper()] for n in NAMES if n.upper() in globals()}
