"""Running numbers and exact quantiles against plain Python: hot groups, ties, nulls, empty tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressmill.operators import corpus, ordering


def rows_of(seed, n=3000):
    r = random.Random(seed)
    return [(r.choice(["hot"] * 6 + ["a", "b", None]), r.choice([None, float("nan"), 5.0, 5.0, r.gauss(0, 1), r.random() * 1e-9, 1e300 * r.random(), -1e300, float(r.randint(-3, 3))]), k) for k in range(n)]


@pytest.mark.parametrize("keys", [[], ["g"]])
def test_numbers_run_through_all_ranges(spark, keys):
    rows = rows_of(1)
    frame = spark.createDataFrame(rows, "g string, v double, k long").repartition(7)
    got = {r.k: r.number for r in ordering.numbered(frame, ["k"], keys).collect()}
    want, seen = {}, {}
    for g, _, k in sorted(rows, key=lambda r: r[2]):
        group = g if keys else 0
        want[k] = seen.get(group, 0)
        seen[group] = want[k] + 1
    assert got == want
    assert ordering.numbered(frame.limit(0), ["k"], keys).count() == 0


def test_ties_get_different_numbers(spark):
    frame = spark.createDataFrame([("same", 1)] * 500 + [("same", 2)] * 100, "g string, k long").repartition(5)
    rows = ordering.numbered(frame, ["k"]).collect()
    assert sorted(r.number for r in rows) == list(range(600)) and {r.number >= 500 for r in rows if r.k == 2} == {True}
    batches = corpus.batch_numbers(frame, None, ["k"], 100).groupBy("batch").count().collect()
    assert sorted((r.batch, r["count"]) for r in batches) == [(k, 100) for k in range(1, 7)]


@pytest.mark.parametrize("keys", [[], ["g"]])
def test_quantiles_are_exact(spark, keys, monkeypatch):
    monkeypatch.setattr(ordering, "BUCKETS", 8)  # several rounds of narrowing
    rows = rows_of(2)
    frame = spark.createDataFrame(rows, "g string, v double, k long").repartition(6)
    shares = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r.g if keys else 0): r for r in ordering.order_statistics(frame, keys, "v", shares).collect()}
    values = {}
    for g, v, _ in rows:
        if v is not None and not np.isnan(v):
            values.setdefault(g if keys else 0, []).append(v)
    assert set(got) == set(values)
    for g, v in values.items():
        assert got[g].n == len(v)
        np.testing.assert_allclose([got[g][f"q{k}"] for k in range(len(shares))], np.quantile(v, shares), rtol=1e-12)
    assert ordering.order_statistics(frame.limit(0), keys, F.col("v"), [0.5]).count() == 0


def test_no_task_sees_all_values_of_a_group(spark):
    frame = spark.range(0, 200_000, 1, 8).select(F.lit("one").alias("g"), (F.col("id") % 99_991).cast("double").alias("v"))
    row = ordering.order_statistics(frame, ["g"], "v", [0.5]).first()
    assert row.q0 == float(np.median(np.arange(200_000) % 99_991))


def test_values_that_change_when_computed_again(spark):
    """As sums of doubles do that are added in the order in which they arrive."""
    shaken = F.udf(lambda k: k + random.random() / 2, "double").asNondeterministic()
    frame = spark.range(0, 2001, 1, 4).select((F.col("id") % 2).alias("g"), shaken(F.col("id").cast("double")).alias("v"))
    rows = ordering.order_statistics(frame, ["g"], "v", [0.0, 0.5, 1.0]).collect()
    assert sorted((r.g, r.n, int(r.q0), int(r.q1), int(r.q2)) for r in rows) == [(0, 1001, 0, 1000, 2000), (1, 1000, 1, 1000, 1999)]
