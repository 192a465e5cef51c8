"""Snapshot drops: each arriving folder is a complete copy of the tables.

Layout: ``{drops}/{stamp}/{results,candidates,contests,parties,precincts}.csv``
with ``stamp`` formatted ``MM-dd-yy--HH-mm`` (the arrival time). One small
table of each drop (``precincts.csv`` by default; the producer writes it
last) is read as a file stream and serves as the arrival signal, so the
large results files are parsed only once, by the report. Every micro-batch
keeps only the newest drop it contains (stamps are parsed to timestamps: as
text they do not sort across years), re-runs the report on the whole of
that drop (results and dimensions read from its folder) into a fresh folder,
which one row in a log then makes the published one. A drop older than that
is ignored. The root published before stays for its readers, older ones go.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass import schema as S
from canvass.session import discard
from canvass.sources.bundle import Election
from canvass.sources.delimited import read_table
from canvass.streaming.common import run_available

# Fixed value: drop folders are named by arrival time in this layout.
STAMP_FORMAT = "MM-dd-yy--HH-mm"
SIGNAL_TABLE = "precincts"
KEEP = 2  # published roots that stay, the current one among them
PUBLISHED = "DROP_STAMP string, DROP_TS timestamp, ROOT string"


def _stamp_of_path(path_col, table: str = SIGNAL_TABLE) -> F.Column:
    return F.regexp_extract(path_col, rf"([^/]+)/{table}\.csv(/[^/]*)?$", 1)


def arrival_stream(spark: SparkSession, drops: str, table: str = SIGNAL_TABLE) -> DataFrame:
    """Arrival signal: DROP_STAMP / DROP_TS for every row of ``table`` in
    each new drop folder."""
    raw = (
        spark.readStream.schema(S.TABLES[table])
        .option("header", True)
        .option("sep", "|")
        .option("mode", "FAILFAST")
        .csv(f"{drops.rstrip('/')}/*/{table}.csv")
    )
    stamp = _stamp_of_path(F.col("_metadata.file_path"), table)
    return raw.select(stamp.alias("DROP_STAMP")).withColumn(
        "DROP_TS", F.try_to_timestamp(F.col("DROP_STAMP"), F.lit(STAMP_FORMAT))
    )


def election_of_drop(spark: SparkSession, drops: str, stamp: str, results: DataFrame) -> Election:
    root = f"{drops.rstrip('/')}/{stamp}"
    return Election(
        results=results,
        candidates=read_table(spark, f"{root}/candidates.csv", "candidates"),
        precincts=read_table(spark, f"{root}/precincts.csv", "precincts").select(*S.PRECINCT_COLUMNS),
        contests=read_table(spark, f"{root}/contests.csv", "contests").select(*S.CONTEST_COLUMNS),
        parties=read_table(spark, f"{root}/parties.csv", "parties"),
    )


def published(spark: SparkSession, out: str) -> tuple | None:
    """(DROP_TS, root) of the newest published drop under ``out``, None when
    there is none yet. Any failure but a missing log is raised."""
    try:
        log = spark.read.schema(PUBLISHED).parquet(f"{out.rstrip('/')}/published")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    row = log.agg(F.max(F.struct("DROP_TS", "ROOT")).alias("last")).first()
    return None if row.last is None else (row.last.DROP_TS, row.last.ROOT)


def trim(spark: SparkSession, out: str, keep: int = KEEP) -> list[str]:
    """Delete the published roots before the newest ``keep`` and their rows of
    the log, of which each is a file (run after every publication, so there
    are ``keep`` + 1 of them). Returns the deleted roots."""
    log = spark.read.schema(PUBLISHED).parquet(f"{out.rstrip('/')}/published")
    rows = log.select("DROP_TS", "ROOT", F.input_file_name().alias("file")).orderBy(F.desc("DROP_TS"), F.desc("ROOT")).collect()
    for r in rows[keep:]:
        discard(spark, r.ROOT)  # first: a row without its root is deleted the next time
        discard(spark, r.file)
    return [r.ROOT for r in rows[keep:]]


def snapshot_sink(spark: SparkSession, drops: str, out: str, write: Callable[[Election, str], None]):
    """foreachBatch function: ``write(election, root)`` puts the outputs of
    the newest drop under a fresh ``root`` below ``out``; when it has ended,
    one row in the log ``out/published`` makes that root the current one. A
    run that dies before leaves the published one as it was, and the same or
    an older drop is not published again."""

    def _sink(batch: DataFrame, epoch_id: int) -> None:
        newest = (
            batch.where(F.col("DROP_TS").isNotNull())
            .agg(F.max_by("DROP_STAMP", "DROP_TS").alias("stamp"), F.max("DROP_TS").alias("ts"))
            .first()
        )
        if newest is None or newest["ts"] is None:
            return
        done = published(spark, out)
        if done is not None and newest["ts"] <= done[0]:
            return
        source = f"{drops.rstrip('/')}/{newest['stamp']}"
        root = f"{out.rstrip('/')}/{newest['stamp']}-{uuid.uuid4().hex}"
        write(election_of_drop(spark, drops, newest["stamp"], read_table(spark, f"{source}/results.csv", "results")), root)
        row = spark.createDataFrame([(newest["stamp"], newest["ts"], root)], PUBLISHED)
        row.coalesce(1).write.mode("append").parquet(f"{out.rstrip('/')}/published")
        trim(spark, out)

    return _sink


def publish_newest_drop(
    spark: SparkSession, drops: str, out: str, checkpoint: str, report: Callable[[Election], DataFrame]
) -> DataFrame:
    """Run the drop stream over everything present with one report; returns
    the published one."""
    sink = snapshot_sink(spark, drops, out, lambda e, root: report(e).write.parquet(root))
    run_available(arrival_stream(spark, drops), sink, checkpoint, "append")
    return spark.read.parquet(published(spark, out)[1])


def publish_all_reports(
    spark: SparkSession,
    drops: str,
    out: str,
    checkpoint: str,
    cmds: tuple[str, ...] = ("all",),
    every: float | None = None,
    static: str | None = None,
) -> str | None:
    """Run the drop stream; every newer drop runs the named reports of the
    batch job into a root of its own, published only if all of them ended
    well. Without ``every`` it ends with the drops that are there; with it,
    new drops are looked for each ``every`` seconds until the stream is
    stopped. ``static`` also takes the flat export of each published drop.
    Returns the published root (None: no drop yet)."""
    from canvass import job
    from canvass.sinks import export_flat

    def write(e: Election, root: str) -> None:
        failed = [name for name, sec in job.run(spark, e, root, list(cmds)).items() if sec is None]
        if failed:
            raise RuntimeError(f"reports failed, drop not published: {', '.join(failed)}")
        if static:
            export_flat(root, static)

    run_available(arrival_stream(spark, drops), snapshot_sink(spark, drops, out, write), checkpoint, "append", every)
    last = published(spark, out)
    return last and last[1]
