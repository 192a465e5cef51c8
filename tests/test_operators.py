from pyspark.sql import Window
from pyspark.sql import functions as F

from canvass.operators import (
    first_row_per_key,
    row_positions,
    running_total,
    top1_per_group,
    with_existence_flag,
    with_group_total,
)
from tests.conftest import rows


def test_first_row_per_key_lexicographic(spark):
    df = spark.createDataFrame(
        [(1, 5, 2, "a"), (1, 3, 9, "b"), (1, 3, 1, "c"), (2, None, 7, "d"), (2, 1, 0, "e")],
        "k bigint, o1 bigint, o2 bigint, v string",
    )
    out = first_row_per_key(df, "k", ["o1", "o2"], ["v"])
    assert out.columns == ["k", "o1", "o2", "v"]
    assert rows(out) == [(1, 3, 1, "c"), (2, None, 7, "d")]  # nulls first


def test_first_row_per_key_hot_key_matches_window(spark):
    # one key holds most rows: result equals row_number() = 1
    data = [(0 if i % 3 else i, (i * 7919) % 101, i) for i in range(3000)]
    df = spark.createDataFrame(data, "k bigint, o bigint, v bigint")
    w = Window.partitionBy("k").orderBy("o", "v")
    ref = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert rows(first_row_per_key(df, "k", ["o"], ["v"])) == rows(ref, "k", "o", "v")


def test_top1_ties_to_lowest_code(spark):
    df = spark.createDataFrame(
        [("A", 11, 50), ("A", 10, 50), ("A", 12, 20), ("B", 30, 5), (None, 40, 1)],
        "g string, code bigint, votes bigint",
    )
    out = top1_per_group(df, ["g"], "votes", "code")
    assert rows(out, "g", "code", "votes") == [("A", 10, 50), ("B", 30, 5), (None, 40, 1)]


def test_with_group_total_null_key_is_a_group(spark):
    df = spark.createDataFrame([("r", 1), ("r", 2), (None, 5), (None, 6)], "k string, v bigint")
    out = with_group_total(df, ["k"], "v", "t")
    assert rows(out, "k", "v", "t") == [("r", 1, 3), ("r", 2, 3), (None, 5, 11), (None, 6, 11)]


def test_running_total_equals_global_window(spark):
    keys = [f"{d:02d}/x - {s:05d}" for d in range(1, 6) for s in range(0, 400, 7)] + [None]
    df = spark.createDataFrame([(k, (i % 13) + 1) for i, k in enumerate(keys)], "key string, n bigint")
    w = Window.orderBy(F.col("key").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("run", F.sum("n").over(w))
    got = running_total(df, "key", "n", "run")
    assert rows(got, "key", "run") == rows(ref, "key", "run")


def test_existence_flag_true_false_null(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "p bigint")
    keys = spark.createDataFrame([(1,), (1,), (None,)], "q bigint")
    out = with_existence_flag(left, "p", keys, "q", "hit")
    assert rows(out) == [(1, True), (2, False), (None, None)]


def test_join_dimension_equals_plain_join_on_both_paths(spark):
    from canvass.operators import join_dimension

    # key 7 is hot (a third of the rows), dimension has a duplicate key and a null
    fact = spark.createDataFrame(
        [(7 if i % 3 == 0 else i % 50, i % 5, i) for i in range(600)] + [(None, 1, 999)],
        "p bigint, c bigint, v bigint",
    )
    dim = spark.createDataFrame(
        [(k, f"R{k % 4}") for k in range(0, 40)] + [(7, "DUP"), (None, "NULLKEY")], "pk bigint, reg string"
    )
    for how in ("left", "inner"):
        plain = rows(fact.join(dim, F.col("p") == F.col("pk"), how))
        small = rows(join_dimension(fact, dim, "p", "pk", how))  # broadcast path
        salted = rows(join_dimension(fact, dim, "p", "pk", how, broadcast_bytes=-1, rows_per_task=20))
        assert small == plain
        assert salted == plain


def _largest_output_task(df):
    from pyspark.sql import functions as F

    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_join_dimension_spreads_null_identical_and_distinct_hot_rows(spark):
    from pyspark.sql import functions as F

    from canvass.operators import join_dimension

    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dim = spark.range(1000).select(F.col("id").alias("pk"), (F.col("id") * 2).alias("v"))
        ids = spark.range(0, 100_000, 1, 20)
        hot = F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 1000)
        for key, value in (
            (F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id") % 1000), F.col("id")),  # half null
            (hot, F.lit(1)),  # half identical rows
            (hot, F.col("id")),  # half distinct rows of one key
        ):
            fact = ids.select(key.cast("long").alias("p"), value.alias("x"))
            for how in ("left", "inner"):
                got = join_dimension(fact, dim, "p", "pk", how, broadcast_bytes=-1, rows_per_task=5000)
                want = fact.join(dim, F.col("p") == F.col("pk"), how)
                assert got.columns == want.columns
                assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
                assert _largest_output_task(got) <= 20_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
