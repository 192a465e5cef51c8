"""Running a streaming plan to completion into a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canvass.session import discard, hadoop_path


def overwrite_table(path: str, prepare: Callable[[DataFrame], DataFrame] | None = None):
    """foreachBatch function: replace the table at ``path`` with the batch
    (the complete-mode result); idempotent, so a replayed epoch is harmless."""

    def _write(batch: DataFrame, epoch_id: int) -> None:
        out = prepare(batch) if prepare else batch
        out.write.mode("overwrite").parquet(path)

    return _write


def append_table(path: str, prepare: Callable[[DataFrame], DataFrame] | None = None):
    """foreachBatch function for append / update output: each epoch goes to
    its own ``epoch_id=<n>`` folder, written with overwrite, so a replayed
    epoch replaces itself instead of duplicating rows. Read the table back
    with :func:`read_appended`."""

    def _write(batch: DataFrame, epoch_id: int) -> None:
        out = prepare(batch) if prepare else batch
        out.write.mode("overwrite").parquet(f"{path.rstrip('/')}/epoch_id={epoch_id}")

    return _write


def read_appended(spark, path: str, schema) -> DataFrame:
    """All epochs written by :func:`append_table` (schema of the rows)."""
    full = T.StructType([*schema.fields, T.StructField("epoch_id", T.LongType())])
    return spark.read.schema(full).parquet(path).drop("epoch_id")


COMPACT_EVERY = 10


def _epochs(spark: SparkSession, path: str) -> list[int]:
    """Epochs with a whole folder below ``path``, ascending."""
    fs, root = hadoop_path(spark, path)
    if not fs.exists(root):
        return []
    found = [s.getPath() for s in fs.listStatus(root) if s.isDirectory() and s.getPath().getName().startswith("epoch_id=")]
    done = [p for p in found if fs.exists(hadoop_path(spark, f"{p}/_SUCCESS")[1])]
    return sorted(int(p.getName().split("=", 1)[1]) for p in done)


def _since(spark: SparkSession, path: str, upto: int | None = None) -> tuple[str | None, list[str], list[str]]:
    """(newest merged folder, folders appended after it, folders before it
    that the merged one holds) among epochs up to ``upto``."""
    path = path.rstrip("/")
    merged = [e for e in _epochs(spark, f"{path}/merged") if upto is None or e <= upto]
    base = merged[-1] if merged else -1
    appended = [e for e in _epochs(spark, f"{path}/appended") if upto is None or e <= upto]
    old = [f"{path}/merged/epoch_id={e}" for e in merged[:-1]] + [f"{path}/appended/epoch_id={e}" for e in appended if e <= base]
    return f"{path}/merged/epoch_id={base}" if merged else None, [f"{path}/appended/epoch_id={e}" for e in appended if e > base], old


def least_table(path: str, key: str, value: str, every: int = COMPACT_EVERY):
    """foreachBatch function for update output whose ``value`` only falls:
    a table of the least ``value`` per ``key`` that stays as large as its keys.
    Each epoch is appended as a folder of its own; every ``every`` epochs the
    merged folder before and the epochs since become the next merged folder,
    and what it holds is deleted one merge later (readers may still be at it).
    A replayed epoch writes the same folders again and a minimum takes rows
    twice without harm, so replays change nothing. Read with
    :func:`read_least`."""
    root = path.rstrip("/")

    def _write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        batch.select(key, value).write.mode("overwrite").parquet(f"{root}/appended/epoch_id={epoch_id}")
        if (epoch_id + 1) % every:
            return
        old = _since(spark, root, epoch_id - 1)[2]
        base, appended, _ = _since(spark, root, epoch_id)
        if base == f"{root}/merged/epoch_id={epoch_id}":  # a replay: merged before
            return
        schema = batch.select(key, value).schema
        rows = spark.read.schema(schema).parquet(*([base] if base else []), *appended)
        rows.groupBy(key).agg(F.min(value).alias(value)).write.mode("overwrite").parquet(f"{root}/merged/epoch_id={epoch_id}")
        for folder in old:
            discard(spark, folder)

    return _write


def read_least(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row per key from a :func:`least_table` (``schema``: key, value)."""
    base, appended, _ = _since(spark, path)
    folders = [*([base] if base else []), *appended]
    rows = spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
    key, value = schema.names
    return rows.groupBy(key).agg(F.min(value).alias(value))


def run_available(stream: DataFrame, sink, checkpoint: str, output_mode: str = "complete", every: float | None = None) -> None:
    """Process everything available now, then stop (``availableNow``); with
    ``every``, go on looking for more each ``every`` seconds until stopped."""
    trigger = {"availableNow": True} if every is None else {"processingTime": f"{every} seconds"}
    q = (
        stream.writeStream.outputMode(output_mode)
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
