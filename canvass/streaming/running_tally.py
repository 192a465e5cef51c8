"""Running vote tally over an append-only feed of result rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def running_tally(results: DataFrame) -> DataFrame:
    """Votes by (CONTEST_CODE, CANDIDATE_CODE) so far. On a stream this is a
    stateful aggregate (complete or update mode); state holds one row per
    contest x candidate, so it does not grow with the feed."""
    return results.groupBy("CONTEST_CODE", "CANDIDATE_CODE").agg(
        F.coalesce(F.sum("VOTES_AMOUNT"), F.lit(0)).cast("bigint").alias("VOTES_AMOUNT")
    )
