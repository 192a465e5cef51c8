"""Readers for the pipe-delimited election tables.

Columns are found by their name in the header: a file may hold them in any
order and among others. Every known column has an explicit type (codes as
bigint, so zero padded codes such as ``00199000`` parse to 199000), further
columns are dropped, a missing one is an error, and every file of a folder
must have the header of the first. ``header=true``, ``sep='|'``, FAILFAST: a
row with too few or too many fields is an error whichever columns a report
reads (rows are always parsed whole); a value that does not fit its type is
an error in the columns that are read, so in any column at ``ingest``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from canvass import schema as S
from canvass.sources.bundle import Election


def _reader(spark: SparkSession):
    return spark.read.option("header", True).option("sep", "|").option("mode", "FAILFAST").option("quote", '"')


def file_schema(header: list[str], table: str) -> T.StructType:
    """Schema of a file with this header; raises ValueError when a column of
    the table is missing or stands in it twice."""
    known = {f.name: f for f in S.TABLES[table].fields}
    absent = [c for c in known if c not in header]
    if absent:  # a doubled name reaches us with numbers added to it
        raise ValueError(f"{table}: no single column {', '.join(absent)} in header {'|'.join(header)}")
    return T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in header])


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    header = _reader(spark).option("inferSchema", False).csv(path).columns
    names = [f.name for f in S.TABLES[table].fields]
    r = _reader(spark).schema(file_schema(header, table)).option("enforceSchema", False).option("columnPruning", False)
    return r.csv(path).select(*names)


def _path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}.csv"


def read_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All five tables with every source column (e.g. for ``ingest``)."""
    return {name: read_table(spark, _path(root, name), name) for name in S.TABLES}


def load_election(spark: SparkSession, root: str) -> Election:
    """Read ``{root}/{candidates,contests,parties,precincts,results}.csv``.

    Each ``.csv`` may be a single file or a folder of part files.
    """
    t = read_tables(spark, root)
    return Election(
        results=t["results"],
        candidates=t["candidates"],
        precincts=t["precincts"].select(*S.PRECINCT_COLUMNS),
        contests=t["contests"].select(*S.CONTEST_COLUMNS),
        parties=t["parties"],
    )
