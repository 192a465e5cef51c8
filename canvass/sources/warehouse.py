"""Columnar copy of the election tables (the ingest step).

The delimited drop is parsed once and stored as Parquet, so every later
report gets a splittable, column-pruned, predicate-pushed scan instead of a
CSV parse. Results are laid out by contest: one folder per CONTEST_CODE, rows
sorted by PRECINCT_CODE in each file. A filter on contests then reads only
their folders, and row groups cover narrow ranges of precinct codes.

Every ingest writes new folders below ``{root}/data``; one file added to the
log ``{root}/versions`` then makes all its tables the current ones in one
step. A reader that began before keeps reading what it opened, an ingest that
fails leaves everything as it was, and the versions before the last
``KEEP`` of a table are deleted after the swap.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass import schema as S
from canvass.session import discard
from canvass.sources.bundle import Election

TABLE_NAMES = ("results", "candidates", "contests", "parties", "precincts")
CLUSTERED_BY = "CONTEST_CODE"
SORTED_BY = ("CONTEST_CODE", "PRECINCT_CODE")
KEEP = 2
VERSIONS = "TABLE_NAME string, VERSION bigint, FOLDER string"


def _versions(spark: SparkSession, root: str) -> dict[str, list[tuple[int, str]]]:
    """(version, folder) of each table, the newest first (a row per table and
    ingest)."""
    try:
        log = spark.read.schema(VERSIONS).parquet(f"{root}/versions").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    out: dict[str, list[tuple[int, str]]] = {}
    for r in log:
        out.setdefault(r.TABLE_NAME, []).append((r.VERSION, r.FOLDER))
    return {name: sorted(found, reverse=True) for name, found in out.items()}


def _write(df: DataFrame, path: str, name: str, spread: int | None) -> None:
    if name != "results":
        df.write.parquet(path)
        return
    # REBALANCE deals rows out by contest, splits a contest above the advisory
    # size over several tasks and puts small ones together
    dealt = df.repartition(spread, "PRECINCT_CODE") if spread else df
    dealt = dealt.hint("rebalance", F.col(CLUSTERED_BY)).sortWithinPartitions(*SORTED_BY)
    dealt.write.partitionBy(CLUSTERED_BY).parquet(path)


def ingest(tables: dict[str, DataFrame], root: str, spread: int | None = None) -> None:
    """Store the given tables under ``root`` and make them current in one
    step; tables not given stay at their version.

    ``spread``: for a fact that arrives as one unsplittable piece (a single
    compressed file, a one-row-group Parquet file), spread it over this many
    tasks first, so that the rows are computed in parallel."""
    root = root.rstrip("/")
    names = [n for n in TABLE_NAMES if n in tables]
    if not names:
        return
    spark = tables[names[0]].sparkSession
    before = _versions(spark, root)
    tag = uuid.uuid4().hex
    folders = {n: f"data/{n}-{tag}" for n in names}
    for n in names:
        _write(tables[n], f"{root}/{folders[n]}", n, spread)
    version = 1 + max((v for found in before.values() for v, _ in found), default=0)
    rows = [(n, version, folders[n]) for n in names]
    spark.createDataFrame(rows, VERSIONS).coalesce(1).write.mode("append").parquet(f"{root}/versions")
    for n in names:
        for _, old in before.get(n, [])[KEEP - 1 :]:
            discard(spark, f"{root}/{old}")


def warehouse_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The current version of one table, all its columns."""
    root = root.rstrip("/")
    found = _versions(spark, root).get(name)
    return spark.read.schema(S.TABLES[name]).parquet(f"{root}/{found[0][1] if found else name}").select(*S.TABLES[name].names)


def load_warehouse(spark: SparkSession, root: str) -> Election:
    """The tables that are current now (a folder of plain Parquet tables by
    name is read as it is)."""

    def read(name: str) -> DataFrame:
        return warehouse_table(spark, root, name)

    return Election(
        results=read("results"),
        candidates=read("candidates"),
        precincts=read("precincts").select(*S.PRECINCT_COLUMNS),
        contests=read("contests").select(*S.CONTEST_COLUMNS),
        parties=read("parties"),
    )
