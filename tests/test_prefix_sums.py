"""Running totals and row numbers over a global order."""

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from canvass.operators import row_positions, running_total
from canvass.operators import running as module
from canvass.plans import stats
from tests.conftest import make_election, result_row, rows


def unpartitioned_windows(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return re.findall(r"windowspecdefinition\([^,()]+ (?:ASC|DESC)", plan)


def texts(n):
    return [None, "", *(f"bad {(i * 7919) % n:05d} é{i % 3}" for i in range(n))]


def test_as_many_malformed_dates_as_rows(spark):
    df = spark.createDataFrame([(t, i % 5) for i, t in enumerate(texts(4000))], "t string, n bigint").repartition(9)
    got = running_total(df, "t", "n", "run")
    assert not unpartitioned_windows(got)
    run = 0
    have = {r.t: r.run for r in got.collect()}
    for r in sorted(df.collect(), key=lambda r: (r.t is not None, (r.t or "").encode())):
        run += r.n
        assert have[r.t] == run


def test_received_report_with_malformed_dates(spark):
    results = [result_row(i % 7, 199000, 19900001, 3, date=t) for i, t in enumerate(texts(300))]
    e = make_election(spark, results, [(1, "R", "P", 5), (2, "R", "P", 5), (2, "R", "P", 5)])
    got = stats.vcm_received(e)
    w = Window.orderBy(F.col("RECEPTION_DATE").asc_nulls_first())
    want = stats.reception_counts(e).withColumn("VCM_RECEIVED", F.sum("VCM_COUNT").over(w))
    assert rows(got) == rows(want, "RECEPTION_DATE", "VCM_RECEIVED")
    for df in (got, stats.vcm_received_by_time(e)):
        assert not unpartitioned_windows(df)


def test_many_ranges_in_groups(spark, monkeypatch):
    monkeypatch.setattr(module, "RANGES_AT_ONCE", 3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "17")
        df = spark.range(500).select((F.col("id") * 37 % 500).alias("k"), F.lit(2).alias("n"))
        assert all(r.run == 2 * (r.k + 1) for r in running_total(df, "k", "n", "run").collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_positions_with_ties_repeats_and_nulls(spark):
    data = [(i % 2 or None, "same") for i in range(900)] + [(5, str(i)) for i in range(300)]
    df = spark.createDataFrame(data, "a bigint, b string")
    got = sorted(row_positions(df, [F.col("a").desc_nulls_last()], "POSITION").collect(), key=lambda r: r.POSITION)
    assert [r.POSITION for r in got] == list(range(1, 1201))
    assert [r.a for r in got] == sorted((r.a for r in got), key=lambda a: -(a or 0))


def test_empty_and_null_values(spark):
    empty = spark.createDataFrame([], "k bigint, n bigint")
    assert running_total(empty, "k", "n", "run").collect() == []
    df = spark.createDataFrame([(1, None), (2, 3), (None, 4)], "k bigint, n bigint")
    assert rows(running_total(df, "k", "n", "run"), "k", "run") == [(1, 4), (2, 7), (None, 4)]
