"""Steps in order over small groups (pages, columns), many groups to an Arrow batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def group_starts(part: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Where a new group begins in rows sorted by the keys; nulls are equal."""
    new = np.zeros(len(part), bool)
    if len(part):
        new[0] = True
        for k in keys:
            codes = pd.factorize(part[k], use_na_sentinel=False)[0]
            new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def by_group(df: DataFrame, keys: list[str], order: list[str], step: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame], schema: str | object) -> DataFrame:
    """step(rows, starts) over whole groups of `keys`, sorted by `order` inside: one shuffle, no grouping in Python.

    A task gets its groups batch by batch; a group that a batch cuts off waits for the next one, so memory holds one batch
    and one group.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for part in frames:
            if not len(part):
                continue
            part = part if held is None else pd.concat([held, part], ignore_index=True)
            starts = group_starts(part, keys)
            whole = int(starts[-1])
            if whole:
                yield step(part.iloc[:whole].reset_index(drop=True), starts[:-1])
            held = part.iloc[whole:].reset_index(drop=True)
        if held is not None:
            yield step(held, np.zeros(1, np.int64))

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)
