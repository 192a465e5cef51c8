"""Live reception rate: machines first heard from, per clock minute.

The stream keeps one row of state per machine, its earliest reception time,
and emits a machine whenever that time falls (update mode). A minimum only
falls, so the count per minute over the minima of all emitted rows is exact
in any arrival order and under replays; no row is ever too late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canvass.schema import RECEPTION_FORMAT

EARLIEST = T.StructType([T.StructField("PRECINCT_CODE", T.LongType()), T.StructField("RECEPTION_TS", T.TimestampType())])


def earliest_reception(results: DataFrame) -> DataFrame:
    """PRECINCT_CODE, RECEPTION_TS: the earliest parsed reception time of each
    machine. Rows whose RECEPTION_DATE does not parse are ignored."""
    ts = F.try_to_timestamp(F.col("RECEPTION_DATE"), F.lit(RECEPTION_FORMAT))
    s = results.select("PRECINCT_CODE", ts.alias("RECEPTION_TS")).where(F.col("RECEPTION_TS").isNotNull())
    return s.groupBy("PRECINCT_CODE").agg(F.min("RECEPTION_TS").alias("RECEPTION_TS"))


def machines_per_minute(emitted: DataFrame) -> DataFrame:
    """RECEPTION_MINUTE, VCM_COUNT from all rows the stream has emitted."""
    first = emitted.groupBy("PRECINCT_CODE").agg(F.min("RECEPTION_TS").alias("RECEPTION_TS"))
    minute = F.date_format(F.date_trunc("minute", F.col("RECEPTION_TS")), "yyyy-MM-dd HH:mm")
    return first.groupBy(minute.alias("RECEPTION_MINUTE")).agg(F.count(F.lit(1)).alias("VCM_COUNT"))
