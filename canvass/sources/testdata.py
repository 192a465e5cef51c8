"""Derive the five election tables from the driver's TPC-H style tables.

This only produces stand-in rows in the election schemas; no report logic
lives here. Mapping (fixed by the test fixtures):

precincts  = customer x nation x region, customers with
             ``c_custkey % 50 = 13`` left out (their results stay unmatched);
             ``c_custkey % 100 = 52`` repeats the code of the customer before.
results    = lineitem x orders, orders with ``o_custkey % 10 = 7`` left out
             (their customers become precincts that did not transmit).
candidates = distinct (contest, candidate) of results; local candidates
             whose code ends in 9 are left out (unknown-candidate case).
contests   = distinct contest codes of results; parties = ``l_suppkey % 7``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass import schema as S
from canvass.session import stored
from canvass.sources.bundle import Election


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(c: Column) -> Column:
    return c.cast("string")


def precincts_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.col("c_custkey")
    return (
        c.where(k % 50 != 13)
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            (k + 10000000).cast("bigint").alias("VCM_ID"),
            F.col("r_name").alias("REG_NAME"),
            F.col("n_name").alias("PRV_NAME"),
            F.col("c_mktsegment").alias("MUN_NAME"),
            F.col("c_name").alias("BRGY_NAME"),
            F.concat(F.lit("SCHOOL "), _text(k)).alias("POLLPLACE"),
            F.when(k % 100 == 52, k - 1).otherwise(k).cast("bigint").alias("CLUSTERED_PREC"),
            F.when(k % 97 == 0, F.lit(0)).otherwise(600 + k % 300).cast("bigint").alias("REGISTERED_VOTERS"),
        )
    )


def results_raw(spark: SparkSession, sf_dir: str, spread: int | None = None) -> DataFrame:
    """``spread``: hash-partition the lineitem scan by order key over this
    many tasks before the per-row work (the test files hold a single row
    group, which Spark cannot split; split inputs should leave this None)."""
    lineitem = _read(spark, sf_dir, "lineitem")
    if spread:
        lineitem = lineitem.repartition(spread, "l_orderkey")
    return results_from(lineitem, _read(spark, sf_dir, "orders"))


def results_from(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Result rows from lineitem (batch or stream) joined to orders."""
    li = lineitem.select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity")
    o = orders.select("o_orderkey", "o_custkey")
    k = F.col("o_custkey")
    line = F.col("l_linenumber")
    contest = (
        F.when(line == 1, F.lit(199000))
        .when(line == 2, F.lit(299000))
        .when(line == 3, F.lit(399000))
        .when(line == 4, F.lit(1199000))
        .when(line == 5, 2000000 + k % 25)
        .otherwise(3000000 + k % 25)
        .cast("bigint")
    )
    reception = F.concat(
        F.when(k % 2 == 0, F.lit("05/09/2022")).otherwise(F.lit("05/10/2022")),
        F.lit(" - "),
        F.lpad(_text(1 + k % 12), 2, "0"),
        F.lit(":"),
        F.lpad(_text(k % 60), 2, "0"),
        F.lit(":00 "),
        F.when(k % 3 == 0, F.lit("AM")).otherwise(F.lit("PM")),
    )
    joined = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).where(k % 10 != 7)
    return joined.select(
        k.cast("bigint").alias("PRECINCT_CODE"),
        contest.alias("CONTEST_CODE"),
        (contest * 100 + F.col("l_suppkey") % 10).cast("bigint").alias("CANDIDATE_CODE"),
        (F.col("l_suppkey") % 7).cast("bigint").alias("PARTY_CODE"),
        F.col("l_quantity").cast("bigint").alias("VOTES_AMOUNT"),
        line.cast("bigint").alias("TOTALIZATION_ORDER"),
        F.when(k % 194 == 0, F.lit(0))
        .when(k % 97 == 0, F.lit(5))
        .otherwise(300 + (k * 7) % 300)
        .cast("bigint")
        .alias("NUMBER_VOTERS"),
        ((k * 3 + line) % 40).cast("bigint").alias("UNDERVOTE"),
        ((k * 5 + line) % 10).cast("bigint").alias("OVERVOTE"),
        reception.alias("RECEPTION_DATE"),
    )


def candidates_from(results: DataFrame) -> DataFrame:
    code = F.col("CANDIDATE_CODE")
    local = ~F.col("CONTEST_CODE").isin(*S.NATIONAL_CONTESTS)
    return (
        results.select("CONTEST_CODE", "CANDIDATE_CODE")
        .distinct()
        .where(~(local & (code % 10 == 9)))
        .select("CONTEST_CODE", "CANDIDATE_CODE", F.concat(F.lit("CANDIDATE "), _text(code)).alias("CANDIDATE_NAME"))
    )


def contests_from(results: DataFrame) -> DataFrame:
    return (
        results.select("CONTEST_CODE")
        .distinct()
        .select("CONTEST_CODE", F.concat(F.lit("CONTEST "), _text(F.col("CONTEST_CODE"))).alias("CONTEST_NAME"))
    )


def parties_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = (F.col("l_suppkey") % 7).cast("bigint")
    return (
        _read(spark, sf_dir, "lineitem")
        .select(code.alias("PARTIES_CODE"))
        .distinct()
        .select(
            "PARTIES_CODE",
            F.concat(F.lit("PARTY "), _text(F.col("PARTIES_CODE"))).alias("PARTIES_NAME"),
            F.concat(F.lit("P"), _text(F.col("PARTIES_CODE"))).alias("PARTIES_ALIAS"),
        )
    )


def full_tables(
    spark: SparkSession, sf_dir: str, results: DataFrame | None = None, spread: int | None = None
) -> dict[str, DataFrame]:
    """All five tables with every source column (as they would sit on disk).

    ``results``: an already stored copy of the results table to derive the
    candidates / contests from (instead of re-deriving the fact).
    """
    res = results_raw(spark, sf_dir, spread) if results is None else results
    return {
        "results": res,
        "candidates": candidates_from(res),
        "contests": contests_from(res),
        "parties": parties_full(spark, sf_dir),
        "precincts": precincts_full(spark, sf_dir),
    }


def derived_tables(spark: SparkSession, sf_dir: str, results: DataFrame) -> dict[str, DataFrame]:
    """The four tables beside a stored copy of the results. Candidates and
    contests come from its distinct code pairs, read from it once."""
    pairs = stored(results.select("CONTEST_CODE", "CANDIDATE_CODE").distinct(), "contest-candidates")
    tables = full_tables(spark, sf_dir, pairs)
    del tables["results"]
    return tables


COPY_SHIFT = 10_000_000


def copies_of(results: DataFrame, precincts: DataFrame, copies: int) -> tuple[DataFrame, DataFrame]:
    """(results, precincts) ``copies`` times over, for measurements: copy k
    (column ``_k``) has its precinct codes shifted by k * ``COPY_SHIFT``, so
    precincts multiply and contests, candidates and provinces stay."""
    k = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_k")
    shift = F.col("_k").cast("bigint") * COPY_SHIFT
    res = results.select("*", k).withColumn("PRECINCT_CODE", F.col("PRECINCT_CODE") + shift)
    pre = precincts.select("*", k)
    for c in ("CLUSTERED_PREC", "VCM_ID"):
        pre = pre.withColumn(c, F.col(c) + shift)
    return res, pre


def election_from_testdata(spark: SparkSession, sf_dir: str) -> Election:
    t = full_tables(spark, sf_dir)
    return Election(
        results=t["results"],
        candidates=t["candidates"],
        precincts=t["precincts"].select(*S.PRECINCT_COLUMNS),
        contests=t["contests"].select(*S.CONTEST_COLUMNS),
        parties=t["parties"],
    )
