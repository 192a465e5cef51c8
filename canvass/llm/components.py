"""Connected components of an edge table by alternating large-star and
small-star steps. Every step is a partial minimum per node and a join back,
so a hub's edges are never gathered in one place; each result is written to
the shared folder. Ends when a round changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.llm.common import materialise


def _state(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (u, v) that is not itself
    the smallest of its component; ``root`` is that smallest node. Loops,
    repeated edges and edges with a null end are ignored; no edges, no rows."""
    e = edges.select("u", "v").where(F.col("u") != F.col("v"))
    e = materialise(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(large.where(F.col("u") != F.col("v")).distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
        e = materialise(small.where(F.col("u") != F.col("v")).distinct(), "small-star")
        before, state = state, _state(e)
        if state == before:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
