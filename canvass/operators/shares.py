"""Attach a per-group total to every row (``sum(x) OVER (PARTITION BY k)``)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_group_total(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Add ``out`` = sum of ``value`` over the rows sharing ``keys``.

    Null keys form their own group, as in a window partition. Written as a
    partial aggregate joined back on the keys (null-safe) rather than a
    window, so a group holding a third of the rows is never gathered into one
    task: the totals are combined map-side and the join is broadcast or
    skew-split by AQE.
    """
    renamed = {k: f"_gk_{i}" for i, k in enumerate(keys)}
    tot = df.groupBy(*keys).agg(F.sum(value).alias(out)).withColumnsRenamed(renamed)
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(renamed[k])) for k in keys])
    return df.join(tot, cond, "inner").drop(*renamed.values())
