"""The bases from one scan of the fact against those computed one by one."""

import random

import pytest
from pyspark.sql import functions as F

from canvass.operators import first_row_per_key, pack, unpack
from canvass.plans import base, tallies
from canvass.session import stored
from tests.conftest import make_election, result_row, rows


def election(spark, wide=False, seed=1):
    rng = random.Random(seed)
    results = []
    for _ in range(400):
        c = rng.choice([199000, 399000, 2000001, None])
        k = rng.choice([None, 1, 2, 3])
        nv = rng.choice([None, 0, 100, 1 << 20 if wide else 7])
        date = rng.choice([None, "x", "05/09/2022 - 07:08:48 PM", "05/10/2022 - 07:08:48 AM"])
        precinct = rng.choice([None, 1, 1, 1, 2, 3, 4, 77])
        row = result_row(precinct, c, k, rng.choice([None, 5, 9]), nv, rng.choice([None, 0, 2]), rng.choice([0, 1]), date)
        results.append(row)
    if wide:
        results.append(result_row(2, -5, 1 << 40, 1))
        results.append(result_row(3, 1 << 30, 3, 1))
    precincts = [(1, "R", "P", 5), (2, "R", "P", 5), (2, "R", "P", 6), (2, "S", "Q", 5), (3, None, "Q", None), (5, "T", "U", 1), (None, "T", "V", 2)]
    return make_election(spark, results, precincts, candidates=[(199000, 1, "A"), (399000, 2, "B"), (2000001, 3, "C")], contests=[199000])


@pytest.mark.parametrize("mapside", [True, False])
@pytest.mark.parametrize("wide", [False, True])
def test_one_pass_equals_the_single_bases(spark, mapside, wide):
    e = election(spark, wide)
    merged = e.results.join(e.precincts, F.col("PRECINCT_CODE") == F.col("CLUSTERED_PREC"), "left")
    keys = ["CONTEST_CODE", "CANDIDATE_CODE", "REG_NAME", "PRV_NAME"]
    want_votes = rows(merged.groupBy(*keys).agg(F.sum("VOTES_AMOUNT").alias("v")))
    order = [*base.RESULT_ORDER, *base.PRECINCT_ORDER]
    first = first_row_per_key(merged, "PRECINCT_CODE", order)
    columns = base.precinct_base(e).columns
    b = stored(base.fact_bases(e, mapside=mapside), "t-bases")
    votes = base.votes_from(e, b)
    assert rows(votes.groupBy(*keys).agg(F.sum("VOTES_AMOUNT").alias("v"))) == want_votes
    assert rows(votes) == rows(base.vote_base(e), *votes.columns)
    assert rows(base.summed_votes(e, mapside=mapside).groupBy(*keys).agg(F.sum("VOTES_AMOUNT").alias("v"))) == want_votes
    assert rows(base.precincts_from(e, b)) == rows(first, *columns) == rows(base.precinct_base(e))
    counts = base.reception_counts(e, base.receptions_from(e, b))
    assert rows(counts) == rows(merged.groupBy("RECEPTION_DATE").count()) == rows(base.reception_counts(e))
    assert rows(base.reception_times(e, base.receptions_from(e, b))) == rows(base.reception_times(e))
    some = stored(base.fact_bases(e, ("precincts", "receptions"), mapside), "t-some")
    assert rows(base.reception_counts(e, base.receptions_from(e, some))) == rows(counts)
    assert rows(base.precincts_from(e, some)) == rows(first, *columns)


def test_regions_count_duplicated_codes_twice_on_both_paths(spark):
    e = election(spark)
    places = e.precincts.select("CLUSTERED_PREC", "REG_NAME")
    merged = e.results.join(e.precincts, F.col("PRECINCT_CODE") == F.col("CLUSTERED_PREC")).select("PRECINCT_CODE", "CONTEST_CODE", "CANDIDATE_CODE", "VOTES_AMOUNT")
    twice = merged.where(F.col("CONTEST_CODE").isin(199000, 399000)).join(places, F.col("PRECINCT_CODE") == F.col("CLUSTERED_PREC"))
    twice = twice.join(e.candidates.select("CANDIDATE_CODE", "CANDIDATE_NAME"), "CANDIDATE_CODE")
    want = rows(twice.groupBy("REG_NAME", "CANDIDATE_CODE").agg(F.sum("VOTES_AMOUNT").alias("v")))
    for mapside in (True, False):
        votes = base.votes_from(e, stored(base.fact_bases(e, mapside=mapside), "t-region"))
        assert rows(tallies.candidate_by_region(e, votes), "REG_NAME", "CANDIDATE_CODE", "VOTES_AMOUNT") == want


def test_hot_precinct_needs_no_salt_beyond_the_broadcast(spark):
    """Votes are summed by precinct, contest and candidate before the join."""
    e = election(spark)
    plan = base.summed_votes(e, mapside=False)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("sum(VOTES_AMOUNT") and "_fsalt" not in plan


def test_packing_keeps_order_and_values(spark):
    order = ["a", "b", "c", "d", "e"]
    rng = random.Random(3)
    tops = [(1 << 28) - 2, (1 << 34) - 2, (1 << 20) - 2, (1 << 20) - 2, (1 << 20) - 2]
    data = [tuple(rng.choice([None, 0, 1, t]) for t in tops) for _ in range(400)]
    out = [(tops[0] + 1, 0, 0, 0, 0), (-1, 0, 0, 0, 0), (0, 0, 0, tops[3] + 1, 0), (None, 1 << 62, None, None, None)]
    df = spark.createDataFrame(data + out, ", ".join(f"{c} bigint" for c in order))
    fits, packed = pack(order)
    found = df.select(*order, fits.alias("fits"), packed.alias("p")).select("*", F.struct(*unpack(F.col("p"), order)).alias("u")).collect()
    inside = sorted((r for r in found if r.fits), key=lambda r: r.p)
    assert len(inside) == len(data) and all(tuple(r.u) == tuple(r)[:5] for r in inside)
    keys = [tuple((v is not None, v or 0) for v in tuple(r)[:5]) for r in inside]
    assert keys == sorted(keys)
    assert all(r.p is None for r in found if not r.fits)
