import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from canvass import schema as S  # noqa: E402
from canvass.session import checkpoint_root  # noqa: E402
from canvass.sources.bundle import Election  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]")
        .appName("canvass-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)
    yield s


RESULT_COLS = [f.name for f in S.RESULTS.fields]


def result_row(precinct, contest, candidate, votes, nv=100, under=0, over=0, date="05/09/2022 - 07:08:48 PM"):
    return (precinct, contest, candidate, 1, votes, 1, nv, under, over, date)


def make_election(spark, results, precincts, candidates=None, contests=None):
    """Tiny hand-written bundle. ``precincts`` rows: (CLUSTERED_PREC,
    REG_NAME, PRV_NAME, REGISTERED_VOTERS)."""
    res = spark.createDataFrame(results, S.RESULTS)
    pre = spark.createDataFrame(
        [(10000 + (p[0] or 0), p[1], p[2], p[0], p[3]) for p in precincts],
        "VCM_ID bigint, REG_NAME string, PRV_NAME string, CLUSTERED_PREC bigint, REGISTERED_VOTERS bigint",
    )
    if candidates is None:
        codes = sorted({(r[1], r[2]) for r in results if r[2] is not None}, key=repr)
        candidates = [(c, k, f"CAND {k}") for c, k in codes]
    cand = spark.createDataFrame(candidates, S.CANDIDATES)
    con = spark.createDataFrame([(c,) for c in (contests or sorted({r[1] for r in results if r[1] is not None}))], "CONTEST_CODE bigint")
    par = spark.createDataFrame([(1, "INDEPENDENT", "IND")], S.PARTIES)
    return Election(results=res, candidates=cand, precincts=pre, contests=con, parties=par)


def rows(df, *cols):
    """Sorted list of tuples of ``cols`` (all columns when none given)."""
    cols = cols or tuple(df.columns)
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=repr)
