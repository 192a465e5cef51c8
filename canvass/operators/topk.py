"""Top-1 row per group (the leading candidate of a province)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top1_per_group(
    df: DataFrame,
    group: Sequence[str],
    by_desc: str,
    tie_asc: str,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Per ``group``, the row with the largest ``by_desc``; ties go to the
    smallest numeric ``tie_asc``.

    ``max(struct(by_desc, -tie_asc, ...))`` is an aggregate with a partial
    step, so a hot group is pre-reduced in every task before the shuffle.
    Nulls in ``by_desc`` rank below every value.
    """
    extra = [c for c in carry if c not in (by_desc, tie_asc)]
    s = F.struct(
        F.col(by_desc).alias("_v"),
        (-F.col(tie_asc)).alias("_t"),
        F.col(tie_asc).alias(tie_asc),
        *[F.col(c) for c in extra],
    )
    m = df.groupBy(*group).agg(F.max(s).alias("_top"))
    return m.select(
        *group,
        F.col("_top")["_v"].alias(by_desc),
        F.col("_top")[tie_asc].alias(tie_asc),
        *[F.col("_top")[c].alias(c) for c in extra],
    )
