"""Alignment by anchors: chains by brute force, gaps, free runs, and a second reading of every turn."""

import itertools
import os
import random

import pytest

from pressmill.operators import anchors

D = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def longest(right):
    n = len(right)
    best = 0
    for k in range(n, 0, -1):
        if any(all(a < b for a, b in itertools.pairwise(c)) for c in itertools.combinations(right, k)):
            best = k
            break
    return best


def test_rising_chains_are_longest():
    r = random.Random(1)
    for _ in range(300):
        right = [r.randint(0, 9) for _ in range(r.randint(0, 9))]
        got = anchors.rising(right)
        assert len(got) == longest(right) and all(right[a] < right[b] and a < b for a, b in itertools.pairwise(got))


def test_anchors_chain_and_gaps(spark):
    left = "one two three four five six seven eight nine ten eleven twelve".split()
    rows = [
        (1, left, left),
        (2, left, "one two three fuor five six seven eight ten eleven twelve".split()),
        (3, left, left[6:] + left[:6]),
        (4, ["a"] * 6, ["a"] * 6),
        (5, left, []),
        (6, [], left),
        (7, left[:2], left[:2]),
    ]
    texts = spark.createDataFrame(rows, "key long, left array<string>, right array<string>")
    got = {}
    for r in anchors.align_streams(texts, ["key"]).collect():
        assert not r.wide
        got.setdefault(r.key, {})[r.left_at] = (r.right_at, round(r.similarity, 2))
    assert got[1] == {i: (i, 1.0) for i in range(12)}
    assert got[2][3] == (3, 0.75) and got[2][9] == (8, 1.0) and 8 not in got[2]
    assert len(got[3]) == 6 and 5 not in got and 6 not in got and got[7] == {0: (0, 1.0), 1: (1, 1.0)}
    assert got[4] == {i: (i, 1.0) for i in range(6)}  # no anchors: one gap
    free = {(r.key, r.first, r["size"]) for r in anchors.free_runs(texts, anchors.align_streams(texts, ["key"]), ["key"], "left").collect()}
    assert {(5, 0, 12)} <= free and any(k == 3 and n == 6 for k, _, n in free) and not any(k in (1, 4, 7) for k, _, _ in free)


def test_wide_gaps_are_told(spark, monkeypatch):
    monkeypatch.setattr(anchors, "CELLS", 100)
    texts = spark.createDataFrame([(1, [f"a{i}" for i in range(20)], [f"b{i}" for i in range(20)])], "key long, left array<string>, right array<string>")
    assert [(r.left_at, r.right_at, r.wide) for r in anchors.align_streams(texts, ["key"]).collect() if r.wide] == [(0, 0, True)]


@pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")
def test_second_readings_are_aligned_with_the_first(spark):
    from pressmill.plans import text_queries

    texts = text_queries._two_readings(spark, D)
    sides = {(r.conv_id, r.turn): (r.left, r.right) for r in texts.collect()}
    found = {}
    for r in text_queries.token_alignment(spark, D).collect():
        found.setdefault((r.conv_id, r.turn), []).append((r.left_at, r.right_at, r.similarity))
    hit = total = 0
    for key, (left, right) in sides.items():
        pairs = sorted(found.get(key, []))
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in itertools.pairwise(pairs))
        assert all(left[i] == right[j] for i, j, s in pairs if s == 1.0)
        if key[1] % 3 != 2:
            true = [i for i, w in enumerate(left) if i % 11 != 10 or i % 7 == 3 and len(w) > 3]
            place = {i: j for j, i in enumerate(true)}
            hit += sum(place.get(i) == j for i, j, _ in pairs)
            total += len(true)
    assert hit > 0.97 * total
