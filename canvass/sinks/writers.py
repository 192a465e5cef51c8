"""Writers for report outputs and for pipe-delimited election tables.

Per-contest / per-province outputs are ONE dataset written with
``partitionBy``: a file per key without a driver-side loop. Rows are
clustered by the partition keys and sorted inside each task, so each output
folder is written in report order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


# Spark's writer drops outer spaces unless told not to.
AS_IS = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headered, comma separated CSV; values keep their outer spaces."""
    df.write.mode(mode).options(header=True, **AS_IS).csv(path)


def write_partitioned_csv(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[Column | str] = (),
    mode: str = "overwrite",
) -> None:
    """One folder per key value (``KEY=value/part-*.csv``), rows sorted by
    ``order`` inside each file. Spaces in values are kept in folder names
    and a null value becomes ``__HIVE_DEFAULT_PARTITION__``. Overwrite
    replaces the whole tree, so a key that ``df`` no longer holds is gone;
    a second report (local after national) goes into the tree with
    ``mode="append"``.

    Meant for report-sized data (the tallies: one row per candidate per
    contest / province): rows are clustered by key, so each key's rows are
    written by one task, which yields one sorted file per folder.
    """
    out = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    (
        out.write.mode(mode)
        .option("partitionOverwriteMode", "static")
        .partitionBy(*keys)
        .options(header=True, **AS_IS)
        .csv(path)
    )


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read back a headered CSV output with an explicit schema (partition
    columns included in ``schema`` get their declared types)."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


LINE_ORDER = ("_file", "_block", "_line")


def with_line_order(df: DataFrame) -> DataFrame:
    """A frame just read from files, with columns that sort its rows as they
    stand there: files by name, then by place in the file."""
    file = F.col("_metadata.file_name")
    named = F.struct(F.length(file).alias("n"), file.alias("name"))
    place = (named, F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return df.select("*", *(c.alias(n) for c, n in zip(place, LINE_ORDER)))


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One line per row of a single string column (JSON lines)."""
    df.write.mode(mode).text(path)


def write_delimited_tables(tables: dict[str, DataFrame], root: str, mode: str = "overwrite") -> None:
    """Write election tables as ``{root}/{name}.csv`` folders, ``|``
    separated with a header: the layout ``sources.load_election`` reads."""
    for name, df in tables.items():
        df.write.mode(mode).options(header=True, sep="|", **AS_IS).csv(f"{root.rstrip('/')}/{name}.csv")
