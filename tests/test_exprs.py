import math

from pyspark.sql import functions as F

from canvass.functions import is_finite, n_unique, nan_to_zero, pct_guarded, pearson, ratio, sum0


def test_ratio_ieee_semantics(spark):
    df = spark.createDataFrame([(0, 0), (5, 0), (-5, 0), (5, None), (None, 3), (5, 10)], "n bigint, d bigint")
    out = [r[0] for r in df.select(ratio("n", "d")).collect()]
    assert math.isnan(out[0])
    assert out[1] == float("inf") and out[2] == float("-inf")
    assert out[3] is None and out[4] is None
    assert out[5] == 0.5


def test_turnout_fixture_zero_division(spark):
    # (NUMBER_VOTERS, REGISTERED_VOTERS) = (0,0), (5,0), (5,null), (5,10) -> 0, inf, null, 50
    df = spark.createDataFrame([(0, 0), (5, 0), (5, None), (5, 10)], "n bigint, d bigint")
    out = [r[0] for r in df.select(nan_to_zero(ratio("n", "d") * 100)).collect()]
    assert out == [0.0, float("inf"), None, 50.0]


def test_pct_guarded(spark):
    df = spark.createDataFrame([(3, 4), (3, 0), (3, None)], "n bigint, d bigint")
    assert [r[0] for r in df.select(pct_guarded("n", "d")).collect()] == [75.0, 0.0, 0.0]


def test_sum0_and_n_unique(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3)], "k bigint, v bigint")
    got = {r["k"]: r["s"] for r in df.groupBy("k").agg(sum0("v").alias("s")).collect()}
    assert got == {1: 0, 2: 3}
    u = spark.createDataFrame([(1,), (1,), (None,), (2,)], "x bigint").agg(n_unique("x")).first()[0]
    assert u == 3


def test_pearson_degenerate_and_nan(spark):
    const = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert const.agg(pearson("x", "y")).first()[0] is None  # zero variance: null, no exception
    single = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    assert single.agg(pearson("x", "y")).first()[0] is None
    inf = spark.createDataFrame([(1.0, 2.0), (2.0, float("inf")), (3.0, 1.0)], "x double, y double")
    assert math.isnan(inf.agg(pearson("x", "y")).first()[0])
    line = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)], "x double, y double")
    assert abs(line.agg(pearson("x", "y")).first()[0] - 1.0) < 1e-12


def test_is_finite(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (None,)], "x double")
    assert [r[0] for r in df.select(is_finite(F.col("x"))).collect()] == [True, False, False, False]
