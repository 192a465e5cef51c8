"""Cross-report invariants on the sf0.001 driver tables, and property tests
of the operators against brute force on random inputs."""

import math
import os
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from canvass.operators import first_row_per_key, running_total, top1_per_group
from canvass.plans import base, stats, tallies
from canvass.sources.testdata import election_from_testdata

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def e(spark):
    if not os.path.isdir(SF):
        pytest.skip("driver test tables not present")
    return election_from_testdata(spark, SF)


def test_national_votes_split_into_provinces_plus_unmatched(e):
    nat = {r["CONTEST_CODE"]: r["v"] for r in tallies.tally_national(e).groupBy("CONTEST_CODE").agg(F.sum("VOTES_AMOUNT").alias("v")).collect()}
    prv = defaultdict(int)
    for r in tallies.votes_by_province_candidate(e).collect():
        prv[r["CONTEST_CODE"]] += r["VOTES_AMOUNT"]
    named = {r["CANDIDATE_CODE"] for r in e.candidates.collect()}
    by_cand = tallies.votes_by_province_candidate(e).where(F.col("CANDIDATE_CODE").isin(*named))
    total = defaultdict(int)
    for r in by_cand.collect():
        total[r["CONTEST_CODE"]] += r["VOTES_AMOUNT"]
    assert nat == dict(total)  # province rows incl. the null province add up to the national tally
    assert sum(prv.values()) >= sum(nat.values())


def test_transmitted_plus_missing_is_total(e):
    for r in stats.transmission_by_province(e).collect():
        assert r["vcm_transmitted"] + r["vcm_not_transmitted"] == r["total_clustered_precincts"]


def test_running_total_ends_at_row_count(e):
    last = stats.vcm_received(e).agg(F.max("VCM_RECEIVED")).first()[0]
    assert last == base.merged_votes(e).count()
    machines = stats.vcm_received_by_time(e).agg(F.max("VCM_RECEIVED")).first()[0]
    assert machines == stats.reception_rate_by_minute(e).agg(F.sum("VCM_COUNT")).first()[0]


def test_region_percentages_sum_to_100(e):
    for r in tallies.candidate_by_region(e).groupBy("REG_NAME").agg(F.sum("PERCENTAGE").alias("p")).collect():
        assert math.isclose(r["p"], 100.0, rel_tol=1e-9)


def test_local_percentages_at_most_100(e):
    for r in tallies.tally_local(e).groupBy("CONTEST_CODE").agg(F.sum("PERCENTAGE").alias("p")).collect():
        assert r["p"] <= 100.0 + 1e-9


small_ints = st.integers(min_value=-3, max_value=3)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), small_ints), small_ints), min_size=1, max_size=40))
def test_first_row_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "k bigint, a bigint, b bigint")
    got = {r["k"]: (r["a"], r["b"]) for r in first_row_per_key(df, "k", ["a", "b"]).collect()}
    want = {}
    for k, a, b in data:
        key = (a is not None, a if a is not None else 0, b)  # nulls first
        if k not in want or key < want[k][0]:
            want[k] = (key, (a, b))
    assert got == {k: v for k, (_, v) in want.items()}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.integers(1, 9), st.integers(0, 5)), min_size=1, max_size=40))
def test_top1_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "g string, code bigint, v bigint")
    got = {r["g"]: (r["code"], r["v"]) for r in top1_per_group(df, ["g"], "v", "code").collect()}
    want = {}
    for g, code, v in data:
        if g not in want or (v, -code) > (want[g][1], -want[g][0]):
            want[g] = (code, v)
    assert got == want


@settings(max_examples=8, deadline=None)
@given(st.sets(st.integers(0, 500), min_size=1, max_size=60))
def test_running_total_matches_brute_force(spark, keys):
    data = [(k, (k % 7) + 1) for k in keys]
    df = spark.createDataFrame(data, "t bigint, n bigint")
    got = {r["t"]: r["run"] for r in running_total(df, "t", "n", "run").collect()}
    run, want = 0, {}
    for k, n in sorted(data):
        run += n
        want[k] = run
    assert got == want
