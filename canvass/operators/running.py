"""Running totals and row numbers over a global order, as a distributed
prefix sum: rows are dealt out by ranges of the order, every range is summed,
the ranges' sums give each range its start, and inside a range a window runs.
No task sees more than one range, whatever the values of the order column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canvass.session import stored

# Ranges whose sums one task adds up; their groups (ranges / RANGES_AT_ONCE)
# are one array.
RANGES_AT_ONCE = 256


def _starts(sums: DataFrame) -> DataFrame:
    """``_range, _start`` from ``_range, _sum`` (one row a range): the sum of
    all ranges before. Two levels: a window inside groups of
    ``RANGES_AT_ONCE`` ranges, and the groups' own sums as one short array."""
    s = sums.withColumn("_group", F.floor(F.col("_range") / RANGES_AT_ONCE))
    earlier = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    inside = s.select("_range", "_group", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_inside"))
    groups = s.groupBy("_group").agg(F.sum("_sum").alias("_sum"))
    every = groups.agg(F.collect_list(F.struct("_group", "_sum")).alias("_all"))

    def before(g: Column) -> Column:
        smaller = F.filter("_all", lambda y: y["_group"] < g["_group"])
        return F.aggregate(smaller, F.lit(0).cast("bigint"), lambda n, y: n + y["_sum"])

    each = F.transform("_all", lambda g: F.struct(g["_group"].alias("_g"), before(g).alias("_before")))
    starts = every.select(F.inline(each))
    joined = inside.join(starts, F.col("_group") == F.col("_g"))
    return joined.select("_range", (F.col("_inside") + F.col("_before")).alias("_start"))


def _prefix(df: DataFrame, order: Sequence[Column], value: Column, out: str) -> DataFrame:
    # the ranges come from a sample of the rows, so they are written once:
    # the sums and the rows must be those of the same ranges
    dealt = df.withColumn("_v", F.coalesce(value, F.lit(0)).cast("bigint"))
    ranged = stored(dealt.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    starts = _starts(ranged.groupBy("_range").agg(F.sum("_v").alias("_sum")))
    upto = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = ranged.withColumn("_run", F.sum("_v").over(upto)).join(starts, "_range")
    return run.select(*[F.col(c) for c in df.columns], (F.col("_start") + F.col("_run")).alias(out))


def running_total(df: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """``out`` = sum of ``value`` over all rows with ``order`` <= this row's.

    ``df`` must hold distinct ``order`` values (aggregate first), which also
    lets the ranges be cut anywhere; nulls sort first. Empty input gives an
    empty result; a null ``value`` adds nothing."""
    return _prefix(df, [F.col(order).asc_nulls_first()], F.col(value), out)


def row_positions(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """``out`` = 1, 2, 3, ... in the order of ``order``, without gaps, over
    all rows. Rows equal in ``order`` are told apart by a hash of all their
    columns, so that many of them still spread over ranges; rows equal in
    everything stand in any order."""
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    return _prefix(df, [*order, tie.asc()], F.lit(1), out)
