"""Text recovered from uncovered ink: drawn pages, columns, specks, known boxes that stay clear."""

import numpy as np
from pyspark.sql import functions as F

from pressmill.operators import layout, recover

BAR = "page_id long, x1 long, y1 long, x2 long, y2 long"


def lines(x1, y1, x2, y2, seed, step=9):
    """Bars like words of body text, 4 high, in rows `step` apart."""
    r = np.random.default_rng(seed)
    out = []
    for y in range(y1, y2 - 4, step):
        x = x1
        while x < x2 - 15:
            w = int(r.integers(6, 22))
            out.append((x, y, min(x + w, x2), y + 4))
            x += w + int(r.integers(3, 5))
    return out


def pages(spark, *of):
    bars = [(page, *b) for page, (drawn, _) in enumerate(of) for b in drawn]
    known = [(page, *b) for page, (_, boxes) in enumerate(of) for b in boxes]
    return spark.createDataFrame(bars, BAR), spark.createDataFrame(known, BAR)


def found(spark, *of):
    out = {page: [] for page in range(len(of))}
    for r in recover.recovered_boxes(*pages(spark, *of)).collect():
        out[r.page_id].append((r.x1, r.y1, r.x2, r.y2))
    return [sorted(out[p]) for p in range(len(of))]


def inside(box, outer):
    return outer[0] <= box[0] and outer[1] <= box[1] and box[2] <= outer[2] and box[3] <= outer[3]


def test_missed_blocks_and_nothing_else(spark):
    seen, missed = lines(25, 25, 275, 225, 1), lines(375, 300, 625, 375, 2)
    specks = [(700, 50 + 20 * k, 702, 52 + 20 * k) for k in range(10)]
    columns = lines(20, 20, 120, 26, 3) + lines(134, 20, 250, 26, 4)
    beside = lines(20, 20, 120, 80, 5)
    got = found(
        spark,
        (seen + missed + specks, [(22, 22, 278, 228)]),
        (columns, [(500, 500, 510, 510)]),  # a gutter keeps headings apart
        (beside + lines(20, 100, 120, 160, 6), [(10, 84, 200, 96)]),  # a known box between two blocks
        (seen, [(0, 0, 400, 400)]),
        ([(10, 10, 14, 14)], [(50, 50, 60, 60)]),
    )
    assert len(got[0]) == 1 and inside(got[0][0], (370, 296, 630, 380)) and got[0][0][0] <= 376 and got[0][0][2] >= 600 and got[0][0][3] >= 365
    assert len(got[1]) == 2 and got[1][0][2] < 134 <= got[1][1][0] + 3
    assert len(got[2]) == 2 and got[2][0][3] <= 85 and got[2][1][1] >= 95
    assert got[3] == [] and got[4] == []


def test_joining_goes_on_until_nothing_may_join_and_never_over_a_known_box(spark):
    r = np.random.default_rng(7)
    drawn = [(int(x), int(y), int(x + r.integers(5, 30)), int(y + r.integers(3, 9))) for x, y in r.integers(0, 300, (120, 2))]
    apart = []
    for b in drawn:
        if not any(b[0] < o[2] and o[0] < b[2] and b[1] < o[3] and o[1] < b[3] for o in apart):
            apart.append(b)
    known = [(100, 100, 160, 180), (220, 20, 240, 290)]
    bars, boxes = pages(spark, (apart, known))
    words = recover.words_of_ink(recover.ink.uncovered_ink(bars, boxes, "page_id"), boxes, "page_id")
    joined = recover.joined_boxes(words, bars, boxes, "page_id")
    out = sorted((x.x1, x.y1, x.x2, x.y2) for x in joined.collect())
    assert 1 < len(out) < words.count()
    assert not any(a[0] < k[2] and k[0] < a[2] and a[1] < k[3] and k[1] < a[3] for a in out for k in known if a not in {(w.x1, w.y1, w.x2, w.y2) for w in words.collect()})
    numbered = joined.withColumn("id", F.monotonically_increasing_id())
    assert recover._may_join(numbered, bars, boxes, "page_id").count() == 0


def test_regions_get_what_was_recovered(spark):
    drawn = lines(25, 25, 275, 225, 1) + lines(25, 260, 275, 300, 2)
    bars, known = pages(spark, (drawn, [(22, 22, 278, 228)]))
    sizes = spark.createDataFrame([(0, 1200.0, 1400.0)], "page_id long, page_width double, page_height double")
    detections = known.select("page_id", F.lit("plain text").alias("class"), F.lit(0.9).alias("confidence"), *[(F.col(s) * 4).cast("double").alias(s) for s in ("x1", "y1", "x2", "y2")]).join(sizes, "page_id")
    extra = recover.as_detections(recover.recovered_boxes(bars, known), sizes)
    rows = sorted(layout.build_regions(detections, extra).collect(), key=lambda r: r.reading_order)
    assert [(r["class"], r.recovered) for r in rows] == [("text", False), ("text", True)] and rows[1].y1 >= rows[0].y2 and rows[1].y1 <= 4 * 260
    assert layout.build_regions(detections).count() == 1
