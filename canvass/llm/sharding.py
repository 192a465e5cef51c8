"""Rendezvous (highest random weight) sharding of records by a stable key.

Every shard draws a score from (key, shard number) and the record goes to
the shard with the highest score, so adding a shard moves only the records
that the new shard wins, and removing one moves only its own. Weights scale
the score as ``-w / ln(u)``, which gives each shard a share of keys in
proportion to its weight. Plain Catalyst expressions: no shuffle, no state.

Edge cases: a null key scores as a value of its own, so all null keys share
one shard; equal keys always share one; a shard of weight 0 takes nothing;
equal scores go to the lower shard; rows equal in all they are numbered by
take slots in any order; an empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from canvass.llm.common import id_hash, materialise

ROWS_PER_CHUNK = 100_000


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """Shard number (int, position in ``weights``) of a record key.

    Ties between scores go to the lower shard number. Raises ValueError when
    no weight is positive or one is negative."""
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must be non-negative with one above zero")
    name = F.coalesce(key.cast("string"), F.lit("\x00null"))
    scored = []
    for shard, w in enumerate(weights):
        if w == 0:
            continue
        bits = F.shiftrightunsigned(F.xxhash64(name, F.lit(shard)), 11).cast("double")
        u = (bits + F.lit(0.5)) * F.lit(2.0**-53)
        scored.append(F.struct((F.lit(-float(w)) / F.ln(u)).alias("s"), F.lit(-shard).alias("n")))
    best = scored[0] if len(scored) == 1 else F.greatest(*scored)
    return (-best["n"]).cast("int")


def with_slots(rows: DataFrame, shard: str, order: Sequence[str], buckets: int) -> DataFrame:
    """One row per input row with ``slot``: gapless from 0 within ``shard``.

    ``rows`` holds only the columns to number by (``shard`` and ``order``);
    rows equal in all of them are interchangeable. Numbering needs no task
    that sees a whole shard: equal rows are counted first (map-side), the
    counts are summed per (shard, bucket of the ``order`` columns), offsets
    are running sums over ``buckets`` rows per shard, and each bucket numbers
    its own groups. A group of repeated rows is expanded in chunks that are
    dealt out again. Empty input gives an empty result."""
    cols = [shard, *order]
    groups = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    groups = groups.withColumn("_b", F.pmod(id_hash(*[F.col(c) for c in order]), F.lit(buckets)).cast("int"))
    groups = materialise(groups, "slot-groups")
    sizes = groups.groupBy(shard, "_b").agg(F.sum("_n").alias("_size"))
    before = Window.partitionBy(shard).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col(shard).alias("_shard"),
        F.col("_b").alias("_bucket"),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
    )
    within = Window.partitionBy(shard, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    numbered = groups.withColumn("_first", F.coalesce(F.sum("_n").over(within), F.lit(0)))
    numbered = numbered.join(
        offsets, F.col(shard).eqNullSafe(F.col("_shard")) & (F.col("_b") == F.col("_bucket"))
    ).withColumn("_first", F.col("_first") + F.col("_offset"))
    last_chunk = F.floor((F.col("_n") - 1) / F.lit(ROWS_PER_CHUNK))
    dealt = numbered.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)))
    dealt = dealt.repartition(*order, "_chunk")
    start = F.col("_chunk") * F.lit(ROWS_PER_CHUNK)
    stop = F.least(start + F.lit(ROWS_PER_CHUNK), F.col("_n")) - 1
    return dealt.withColumn("_i", F.explode(F.sequence(start, stop))).select(
        *cols, (F.col("_first") + F.col("_i")).cast("long").alias("slot")
    )


def shard_documents(docs: DataFrame, shards: int, grown_weights: Sequence[float] | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for the
    rows of ``docs`` over ``shards`` equal shards; ``grown_shard`` is the
    place with one more shard (or under ``grown_weights``). A null text has
    no bytes (size 1, checksum of the empty string)."""
    weights = [1.0] * shards
    grown = list(grown_weights) if grown_weights is not None else [1.0] * (shards + 1)
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        rendezvous_shard(F.col("doc_id"), weights).alias("shard"),
    )
    buckets = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    out = with_slots(narrow, "shard", ["doc_id", "size", "text_crc32"], buckets)
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        rendezvous_shard(F.col("doc_id"), grown).cast(T.IntegerType()).alias("grown_shard"),
    )
