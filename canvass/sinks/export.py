"""The job's outputs under the original flat file names.

The job writes one dataset per report (``contest/CONTEST_CODE=<code>/part-*``
...). Consumers of the original layout read flat files:

  contest/CONTEST_CODE=<c>/             -> <c>.csv
  map/CONTEST_CODE=<c>/                 -> map-<c>.csv
  province/CONTEST_CODE=<c>/PRV_KEY=<p> -> <p>_<c>.csv
  map_stats_document.json/              -> map_stats.json
  other reports                         -> see FLAT_CSV and FLAT_JSON

Spark tasks write the bytes: one file per key of a dataset, in the row order
of the source, below a folder of its own in the destination. The driver only
lists and renames those files (Spark's file system API, so any place and
credentials that Spark itself uses). A report without keys is one file and
so one task's work; these hold a row per precinct, province or minute.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from canvass.session import discard, hadoop_path
from canvass.sinks.writers import AS_IS, LINE_ORDER, with_line_order

# Flat file names of the original output layout.
FLAT_CSV = {
    "vcm_received": "vcm_received.csv",
    "voter_turnout_by_precinct": "voter_turnout_by_precinct.csv",
    "spoiled_ballots_analysis": "spoiled_ballots_analysis.csv",
    "candidate_performance_by_region": "candidate_performance_by_region.csv",
    "vcm_reception_rate": "vcm_reception_rate.csv",
}
FLAT_JSON = {
    "map_stats_document.json": "map_stats.json",
    "voter_stats.json": "voter_stats.json",
    "turnout_spoiled_correlation.json": "turnout_spoiled_correlation.json",
}
# Trees by key, and the flat name of a key.
FLAT_BY_KEY = {
    "contest": (["CONTEST_CODE"], "{0}.csv"),
    "map": (["CONTEST_CODE"], "map-{0}.csv"),
    "province": (["CONTEST_CODE", "PRV_KEY"], "{1}_{0}.csv"),
}


def _files(spark: SparkSession, folder: str, depth: int = 0) -> list[tuple[tuple[str, ...], object]]:
    """(key values, path) of the part files ``depth`` key folders down."""
    fs, path = hadoop_path(spark, folder)
    found: list[tuple[tuple[str, ...], object]] = []
    todo = [((), path)] if fs.exists(path) else []
    while todo:
        keys, at = todo.pop()
        for s in fs.listStatus(at):
            name = s.getPath().getName()
            if s.isDirectory() and len(keys) < depth and "=" in name:
                todo.append(((*keys, unquote(name.split("=", 1)[1])), s.getPath()))
            elif not s.isDirectory() and len(keys) == depth and name.startswith("part-"):
                found.append((keys, s.getPath()))
    return sorted(found, key=lambda f: (f[0], str(f[1])))


def _read_strings(spark: SparkSession, path: str) -> DataFrame:
    names = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    return spark.read.schema(schema).option("header", True).csv(path)


def _one_file_per_key(df: DataFrame, keys: Sequence[str], path: str) -> None:
    rows = with_line_order(df)
    rows = rows.repartition(*keys) if keys else rows.repartition(1)
    rows = rows.sortWithinPartitions(*keys, *LINE_ORDER).drop(*LINE_ORDER)
    out = rows.write.options(header=True, maxRecordsPerFile=0, **AS_IS)
    (out.partitionBy(*keys) if keys else out).csv(path)


def export_flat(out_root: str, dest: str, spark: SparkSession | None = None) -> list[str]:
    """Write the flat files for every job output present under ``out_root``
    into ``dest``, replacing files of the same name; returns the names."""
    spark = spark or SparkSession.active()
    root, dest = out_root.rstrip("/"), dest.rstrip("/")
    work = f"{dest}/_export-{uuid.uuid4().hex}"
    fs, base = hadoop_path(spark, dest)
    if fs.getUri().getScheme() == "file":
        fs = fs.getRaw()  # local files without checksum files beside them
    fs.mkdirs(base)
    names: list[str] = []

    def publish(folder: str, depth: int, name: str) -> None:
        for keys, path in _files(spark, folder, depth):
            _, target = hadoop_path(spark, f"{dest}/{name.format(*keys)}")
            fs.delete(target, False)
            if not fs.rename(path, target):
                raise OSError(f"could not write {target}")
            names.append(target.getName())

    try:
        for tree, (keys, name) in FLAT_BY_KEY.items():
            if _files(spark, f"{root}/{tree}", len(keys)):
                _one_file_per_key(_read_strings(spark, f"{root}/{tree}"), keys, f"{work}/{tree}")
                publish(f"{work}/{tree}", len(keys), name)
        for report, name in FLAT_CSV.items():
            if _files(spark, f"{root}/{report}"):
                _one_file_per_key(_read_strings(spark, f"{root}/{report}"), [], f"{work}/{report}")
                publish(f"{work}/{report}", 0, name)
        for report, name in FLAT_JSON.items():
            if _files(spark, f"{root}/{report}"):
                spark.read.text(f"{root}/{report}").repartition(1).write.text(f"{work}/{report}")
                publish(f"{work}/{report}", 0, name)
    finally:
        discard(spark, work)
    return names
