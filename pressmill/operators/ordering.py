"""Numbers and order statistics over tables of any size: no window over all rows, no task that holds a group's values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import dropped, written

BUCKETS = 1 << 14


def numbered(df: DataFrame, order: list[str], keys: list[str] = [], name: str = "number") -> DataFrame:  # noqa: B006
    """The rows with their place (from 0) in the order of the columns `order`, over all rows or in each group of `keys`.

    Rows are dealt to sorted ranges of (keys, order), so a large group spans several; a row's place is its place in the range
    plus the counts of the ranges before, of which there is one row for each range and group.
    """
    sides = [*keys, *order]
    dealt = df.repartitionByRange(*sides).sortWithinPartitions(*sides).withColumn("_at", F.monotonically_increasing_id())
    rows = written(dealt, "ranges").withColumn("_range", F.shiftright("_at", 33))
    group = [F.coalesce(F.col(k).cast("string"), F.lit("")).alias(f"_k{i}") for i, k in enumerate(keys)]
    null = [F.col(k).isNull().alias(f"_n{i}") for i, k in enumerate(keys)]
    names = [f"_{c}{i}" for i in range(len(keys)) for c in "kn"]
    named = rows.select("*", *group, *null)
    counts = named.groupBy("_range", *names).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*(names or [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", *names, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return named.join(starts, ["_range", *names]).withColumn(name, F.col("_before") + F.col("_at") - F.col("_first")).select(*df.columns, name)


def order_statistics(df: DataFrame, keys: list[str], value: str | Column, shares: list[float]) -> DataFrame:
    """keys, n and q0, q1, ...: exact quantiles of each group at `shares`, linear between neighbours; nulls and NaN don't count.

    A rank is found by narrowing: values between the bounds known so far are counted in BUCKETS buckets (partial sums in
    each task), and the bucket that holds the rank gives the next bounds, its least and largest value, until both are equal.
    What is shuffled are the counts. Groups without values are left out. The values are a written table: sums of doubles
    may come out otherwise when they are computed again, and then the bounds of one pass would miss the values of the next.
    """
    source = written(df.select(*keys, (F.col(value) if isinstance(value, str) else value).cast("double").alias("_v")).where("_v is not null and not isnan(_v)"), "values")
    known = source.groupBy(*keys).agg(F.count("*").alias("n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")).where("n > 0")
    at = F.array(*[F.lit(float(s)) for s in shares])
    ranks = F.array_distinct(F.flatten(F.transform(at, lambda s: F.array(F.floor(s * (F.col("n") - 1)), F.ceil(s * (F.col("n") - 1))))))
    sizes = written(known.select(*keys, "n", F.explode(ranks).alias("_rank"), F.lit(0).cast("long").alias("_below"), "_low", "_high"), "ranks")
    open_ = sizes
    same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
    while open_.where("_low < _high").limit(1).count():
        bounds = open_.where("_low < _high").select(*keys, "_low", "_high").distinct()
        on = [*same("v", "b"), F.col("_v").between(F.col("_low"), F.col("_high"))]
        met = source.alias("v").join(bounds.alias("b"), on) if keys else source.alias("v").join(F.broadcast(bounds.alias("b")), on)  # without keys: two rows for each share at most
        width = F.col("_high") / BUCKETS - F.col("_low") / BUCKETS
        bucket = F.least(F.floor((F.col("_v") / BUCKETS - F.col("_low") / BUCKETS) / width * BUCKETS), F.lit(BUCKETS - 1))
        told = met.select(*[F.col(f"v.{k}").alias(k) for k in keys], "_low", "_high", "_v", F.when(F.col("_v") == F.col("_high"), BUCKETS).otherwise(bucket).alias("_bucket"))
        counts = told.groupBy(*keys, "_low", "_high", "_bucket").agg(F.count("*").alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
        upto = Window.partitionBy(*keys, "_low", "_high").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counts = counts.withColumn("_upto", F.sum("_n").over(upto))
        pick = [*same("o", "c"), F.col("o._low") == F.col("c._low"), F.col("o._high") == F.col("c._high"), F.col("_rank") - F.col("_below") < F.col("_upto"), F.col("_rank") - F.col("_below") >= F.col("_upto") - F.col("_n")]
        found = open_.where("_low < _high").alias("o").join(counts.alias("c"), pick)
        found = found.select(*[F.col(f"o.{k}").alias(k) for k in keys], "n", "_rank", (F.col("_below") + F.col("_upto") - F.col("_n")).alias("_below"), F.col("_least").alias("_low"), F.col("_most").alias("_high"))
        after = written(found.union(open_.where("_low = _high")), "ranks")
        if open_ is not sizes:
            dropped(open_)
        open_ = after
    dropped(source)
    of = F.map_from_entries(F.collect_list(F.struct("_rank", "_low")))
    groups = open_.groupBy(*keys).agg(F.first("n").alias("n"), of.alias("_of")).where("n is not null")

    def quantile(s: float) -> Column:
        place = F.lit(float(s)) * (F.col("n") - 1)
        low, high = F.col("_of")[F.floor(place)], F.col("_of")[F.ceil(place)]
        return low + (high - low) * (place - F.floor(place))

    return groups.select(*keys, "n", *[quantile(s).alias(f"q{i}") for i, s in enumerate(shares)])


def joined_by(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """left and right (one row for each group) by keys that may be null; without keys, right is one row."""
    if not keys:
        return left.join(F.broadcast(right), how=how) if how != "left" else left.join(F.broadcast(right), F.lit(True), "left")
    named = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(named, on, how).drop(*[f"_r_{k}" for k in keys])
