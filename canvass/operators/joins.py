"""Fact-to-dimension equi-join that stays balanced when one key is hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# One shuffle task's worth of fact rows (~100-200 MB of a narrow projection);
# the session setting below overrides it.
DEFAULT_ROWS_PER_TASK = 2_000_000
ROWS_PER_TASK_CONF = "spark.canvass.skew.rowsPerTask"


def catalyst_broadcasts(dim: DataFrame, limit: int | None = None) -> bool:
    """Catalyst's own size estimate of ``dim`` is within its broadcast
    threshold (``limit`` replaces the threshold), so a plain join needs no
    shuffle. Nothing is forced: the planner decides again when the join is
    planned. False where the estimate is not available (Spark Connect)."""
    jdf = getattr(dim, "_jdf", None)
    if jdf is None:
        return False
    if limit is None:
        limit = dim.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    how: str = "left",
    broadcast_bytes: int | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """``fact JOIN dim ON fact[fact_key] = dim[dim_key]`` (``how`` = left or
    inner), same rows as the plain join, planned for a hot fact key.

    1. If Catalyst would broadcast the dimension (its own estimate against
       the session's threshold), a plain join: no shuffle, no skew.
    2. Otherwise the fact rows go three ways. Rows with a null key match
       nothing and pass by the join (left) or drop out (inner). Rows of keys
       with at most ``rows_per_task`` fact rows (default: session setting
       ``spark.canvass.skew.rowsPerTask``, else 2,000,000) take a plain join.
       Rows of hotter keys are first collapsed, map-side, to distinct rows
       with a count, the counts cut into chunks of at most ``rows_per_task``,
       and the chunks of a row dealt to successive salts, as many as the key needs;
       its dimension rows are repeated once per salt, and the chunks are
       expanded after the join. So neither distinct nor identical rows of a
       hot key gather in one task, and a rerun task deals its rows as before.

    The hot keys are found with a partial aggregate over the key column;
    there are at most fact rows / ``rows_per_task`` of them, which bounds the
    list that is broadcast. The price of the second way is a scan of the fact
    for that list and for each branch.
    """
    if how not in ("left", "inner"):
        raise ValueError("join_dimension supports left and inner joins")
    if rows_per_task is None:
        rows_per_task = int(fact.sparkSession.conf.get(ROWS_PER_TASK_CONF, str(DEFAULT_ROWS_PER_TASK)))
    cond = F.col(fact_key) == F.col(dim_key)
    if catalyst_broadcasts(dim, broadcast_bytes):
        return fact.join(dim, cond, how)

    hot = (
        fact.where(F.col(fact_key).isNotNull())
        .groupBy(F.col(fact_key).alias("_hot_key"))
        .agg(F.count(F.lit(1)).alias("_hot_rows"))
        .where(F.col("_hot_rows") > rows_per_task)
        .select("_hot_key", F.ceil(F.col("_hot_rows") / rows_per_task).cast("int").alias("_salts"))
    )
    hot = F.broadcast(hot)
    keyed = fact.where(F.col(fact_key).isNotNull())
    plain = keyed.join(hot, F.col(fact_key) == F.col("_hot_key"), "left_anti").join(dim, cond, how)

    rows = [F.col(c) for c in fact.columns]
    last = F.floor((F.col("_n") - 1) / F.lit(rows_per_task))
    salt: Column = F.pmod(F.pmod(F.xxhash64(*rows), F.col("_salts")) + F.col("_chunk"), F.col("_salts"))
    h = (
        keyed.join(hot, F.col(fact_key) == F.col("_hot_key"))
        .groupBy(*rows, "_salts")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .withColumn("_fsalt", salt)
        .repartition(F.col(fact_key), F.col("_fsalt"))  # also where the join turns out to need no shuffle
    )
    d = (
        dim.join(hot.withColumnRenamed("_salts", "_dsalts"), F.col(dim_key) == F.col("_hot_key"))
        .withColumn("_dsalt", F.explode(F.sequence(F.lit(0), F.col("_dsalts") - 1)))
        .drop("_hot_key", "_dsalts")
    )
    copies = F.least(F.col("_n") - F.col("_chunk") * rows_per_task, F.lit(rows_per_task).cast("long"))
    spread = (
        h.join(d, cond & (F.col("_fsalt") == F.col("_dsalt")), how)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
        .drop("_salts", "_n", "_chunk", "_fsalt", "_dsalt", "_copy")
    )
    out = plain.unionByName(spread.select(*plain.columns))
    if how == "left":
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in dim.schema.fields]
        out = out.unionByName(fact.where(F.col(fact_key).isNull()).select("*", *missing))
    return out
