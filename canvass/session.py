"""Session construction and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Defaults for the batch job. The broadcast threshold is the size check
# behind every dimension join: Catalyst broadcasts a side only when its
# estimated size is below it and falls back to a shuffle join otherwise;
# AQE re-checks with runtime sizes and splits skewed join partitions.
JOB_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
}
# Static setting for a batch job: no web UI.
STATIC_CONF: dict[str, str] = {"spark.ui.enabled": "false"}


def get_spark(app: str = "canvass", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """Session for the job. The SQL defaults in ``JOB_CONF`` are set at
    runtime only where the submitter left them unset (``spark-submit --conf``
    and spark-defaults.conf win); ``conf`` given here overrides both."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**STATIC_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    try:
        submitted = spark.sparkContext.getConf()
    except Exception:  # Spark Connect: no SparkContext, nothing to compare with
        submitted = None
    for k, v in JOB_CONF.items():
        if conf and k in conf:
            continue
        if submitted is None or not submitted.contains(k):
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only a local-mode session without one (tests) gets
    a private folder set here. On a cluster the setting is required, since a
    machine-local folder is not visible to other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect sessions expose no SparkContext
        sc = None
    if sc is not None:
        root = sc.getCheckpointDir()
        if root:
            return root.rstrip("/")
        if sc.master.startswith("local"):
            root = tempfile.mkdtemp(prefix="canvass-ckpt-")
            sc.setCheckpointDir(root)
            return root
    raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")


def hadoop_path(spark: SparkSession, uri: str) -> tuple:
    """(file system, path) of a URI, as Spark itself resolves it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def discard(spark: SparkSession, uri: str) -> None:
    """Delete a folder that the caller made (none there: nothing happens)."""
    fs, path = hadoop_path(spark, uri)
    fs.delete(path, True)


def count_files(spark: SparkSession, uri: str, suffix: str) -> int:
    """Files below ``uri`` whose names end in ``suffix``."""
    fs, path = hadoop_path(spark, uri)
    found, n = fs.listFiles(path, True), 0
    while found.hasNext():
        n += found.next().getPath().getName().endswith(suffix)
    return n


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the checkpoint root."""
    path = f"{checkpoint_root(spark)}/canvass/{name}-{uuid.uuid4().hex}"
    for made in _scopes[-1:]:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Folders that :func:`scratch_path` names inside are deleted at the end;
    results that are read later must stand elsewhere by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            discard(spark, path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read from there:
    its lineage is cut, and every reader sees the same rows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
