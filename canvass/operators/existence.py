"""Existence of a key in another table, as a flag or as semi / anti joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reported_precincts(results: DataFrame) -> DataFrame:
    """Distinct PRECINCT_CODE values that appear in the results."""
    return results.select("PRECINCT_CODE").distinct()


def with_existence_flag(left: DataFrame, left_key: str, keys: DataFrame, key: str, out: str) -> DataFrame:
    """Add boolean ``out``: does ``left_key`` occur in ``keys[key]``?

    true / false, and null when ``left_key`` is null. ``keys`` is reduced to
    distinct values (partial aggregate) and left-joined, so every left row
    keeps exactly one output row; the key set never reaches the driver.
    """
    hits = keys.select(F.col(key).alias("_hit_key")).where(F.col("_hit_key").isNotNull()).distinct()
    hits = hits.withColumn("_hit", F.lit(True))
    j = left.join(hits, F.col(left_key) == F.col("_hit_key"), "left")
    flag = F.when(F.col(left_key).isNull(), F.lit(None).cast("boolean")).otherwise(F.col("_hit").isNotNull())
    return j.withColumn(out, flag).drop("_hit_key", "_hit")
