"""Evaluation: pivots, error rates, absolute percentage errors, ranks, classification reports. All aggregates or windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import joined_by, order_statistics

_AGGREGATES = {"mean": F.avg, "median": F.median, "std": F.stddev_samp}


def metric_pivot(df: DataFrame, index: str, columns: str, value: str, how: str = "mean", names: list | None = None, places: int = 2) -> DataFrame:
    """One row per index value, one column per value of `columns`, rounded; how: mean, median or std."""
    if how not in _AGGREGATES:
        raise ValueError(f"how must be one of {sorted(_AGGREGATES)}, not {how!r}")
    if how == "median":
        middles = order_statistics(df, [index, columns], value, [0.5]).select(index, columns, F.col("q0").alias(value))
        every = df.select(index).distinct()  # also those without values
        return joined_by(every, middles.groupBy(index).pivot(columns, names).agg(F.round(F.first(value), places)), [index])
    return df.groupBy(index).pivot(columns, names).agg(F.round(_AGGREGATES[how](value), places))


def mean_median(df: DataFrame, keys: list[str], value: str, places: int = 2) -> DataFrame:
    means = df.groupBy(*keys).agg(F.round(F.avg(value), places).alias(f"{value}_mean"))
    return joined_by(means, order_statistics(df, keys, value, [0.5]).select(*keys, F.round("q0", places).alias(f"{value}_median")), keys)


def percentage_errors(df: DataFrame, keys: list[str], truth: Column, guess: Column, places: int = 2) -> DataFrame:
    """Mean and median absolute percentage error; the divisor is at least the machine epsilon."""
    ape = F.abs(truth - guess) / F.greatest(F.abs(truth), F.lit(2.220446049250313e-16))
    means = df.groupBy(*keys).agg(F.round(F.avg(ape) * 100, places).alias("mape"))
    return joined_by(means, order_statistics(df, keys, ape, [0.5]).select(*keys, F.round(F.col("q0") * 100, places).alias("median_ape")), keys)


def share_below(value: Column, limit: float) -> Column:
    return F.avg((value < limit).cast("double"))


def describe(df: DataFrame, value: str, keys: list[str] = []) -> DataFrame:  # noqa: B006
    parts = [F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("least"), F.max(value).alias("most")]
    quartiles = order_statistics(df, keys, value, [0.25, 0.5, 0.75]).select(*keys, *[F.col(f"q{k}").alias(f"q{25 * (k + 1)}") for k in range(3)])
    return joined_by(df.groupBy(*keys).agg(*parts), quartiles, keys).select(*keys, "n", "mean", "std", "least", "q25", "q50", "q75", "most")


def rank_in(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Smallest first, equal values share the lowest rank; with the group's median of the value."""
    w = Window.partitionBy(*keys)
    return df.withColumns({"rank": F.rank().over(w.orderBy(value)), "group_median": F.median(value).over(w)})


def micro_error_rates(df: DataFrame, keys: list[str], errors: str, length: str) -> DataFrame:
    """Sum of errors over sum of lengths, and the median of the single rates."""
    return df.groupBy(*keys).agg((F.sum(errors) / F.sum(length)).alias("micro_rate"), F.median(F.col(errors) / F.col(length)).alias("median_rate"))


def confusion(df: DataFrame, truth: str, guess: str, classes: list) -> DataFrame:
    return df.groupBy(truth).pivot(guess, classes).count().na.fill(0)


def classification_report(df: DataFrame, truth: str, guess: str, classes: list) -> DataFrame:
    """Per class: precision, recall, F1 (0 where undefined) and support; one pass over the data."""
    hit = lambda c: F.count(F.when(c, 1))
    flat = df.agg(*[x for k in classes for x in (hit((F.col(truth) == k) & (F.col(guess) == k)).alias(f"tp_{k}"), hit(F.col(truth) == k).alias(f"true_{k}"), hit(F.col(guess) == k).alias(f"said_{k}"))])
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("class"), F.col(f"tp_{k}").alias("tp"), F.col(f"true_{k}").alias("support"), F.col(f"said_{k}").alias("said")) for k in classes])).alias("r")
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    out = flat.select(rows).select("r.*").withColumns({"precision": zero(F.try_divide("tp", "said")), "recall": zero(F.try_divide("tp", "support"))})
    return out.withColumn("f1", zero(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))).select("class", "precision", "recall", "f1", "support")


def weighted_average(report: DataFrame) -> DataFrame:
    total = F.sum("support")
    return report.agg(*[(F.sum(F.col(c) * F.col("support")) / total).alias(c) for c in ("precision", "recall", "f1")], total.alias("support"))


def macro_average(report: DataFrame) -> DataFrame:
    return report.agg(*[F.avg(c).alias(c) for c in ("precision", "recall", "f1")], F.sum("support").alias("support"))


def bold_extremes(df: DataFrame, columns: list[str], lowest: bool = True) -> DataFrame:
    """The columns as text with the extreme value of each set in bold LaTeX; the extremes are a one-row aggregate, not an unpartitioned window."""
    pick = F.min if lowest else F.max
    ends = df.agg(*[pick(c).alias(f"_end_{c}") for c in columns])
    both = df.crossJoin(F.broadcast(ends))
    bold = lambda c: F.when(F.col(c) == F.col(f"_end_{c}"), F.concat(F.lit("\\textbf{"), F.col(c).cast("string"), F.lit("}"))).otherwise(F.col(c).cast("string"))
    return both.select(*[bold(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def latex_table(df: DataFrame, columns: list[str], lowest: bool = True) -> str:
    """A small result as a LaTeX tabular (driver side)."""
    rows = bold_extremes(df, columns, lowest).collect()
    body = [" & ".join("" if v is None else str(v) for v in r) + r" \\" for r in rows]
    return "\n".join([r"\begin{tabular}{" + "l" * len(df.columns) + "}", " & ".join(df.columns) + r" \\", r"\hline", *body, r"\end{tabular}"])
