"""Random small elections: every report equals its DuckDB oracle statement.

The oracle SQL is the same text the driver check uses, with the mapping from
the driver tables swapped for the random input tables. Generated data covers
null codes and names, duplicated CLUSTERED_PREC, a candidate code listed
under two contests, unknown candidates, zero / null voters, ties, and
unparseable reception text.
"""

import math

import duckdb
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from canvass import schema as S
from canvass.catalog import ELECTION_QUERIES
from canvass.oracle import all_sql, over_tables
from canvass.sources.bundle import Election

KEYS = [
    "merged_results",
    "one_row_per_precinct",
    "transmission_flag",
    "precinct_count",
    "votes_by_contest_candidate",
    "split_by_contest",
    "tally_national",
    "tally_local",
    "tally_national_province",
    "leading_candidate_province",
    "candidate_by_region",
    "candidate_by_region_once",
    "transmission_by_province",
    "voter_stats_by_province",
    "map_stats",
    "voter_stats",
    "vcm_received",
    "reception_rate_text",
    "turnout_by_precinct",
    "spoiled_ballots",
    "join_turnout_spoiled",
    "vcm_received_by_time",
    "reception_rate_by_minute",
]

INPUT_TABLES = """results AS (SELECT * FROM r_in),
precincts AS (SELECT * FROM p_in),
candidates AS (SELECT * FROM c_in),
contests AS (SELECT * FROM k_in),
parties AS (SELECT * FROM pa_in)"""

CANDIDATES = [
    (199000, 19900001, "A"),
    (199000, 19900002, "B"),
    (299000, 29900001, "V"),
    (2000001, 200000101, "L1"),
    (2000002, 200000101, "L1 OTHER CONTEST"),
]
CONTEST_OF = {19900001: 199000, 19900002: 199000, 29900001: 299000, 200000101: 2000001, 200000109: 2000001}
TIMES = [None, "05/09/2022 - 01:00:00 AM", "05/09/2022 - 12:30:00 AM", "05/10/2022 - 01:00:00 PM", "bad text"]

small = st.one_of(st.none(), st.integers(0, 9))
result_row = st.tuples(
    st.one_of(st.none(), st.integers(1, 7)),  # precinct
    st.sampled_from([None, 19900001, 19900002, 29900001, 200000101, 200000109]),  # candidate
    small,  # votes
    st.sampled_from([None, 0, 5, 10]),  # voters
    st.one_of(st.none(), st.integers(0, 3)),  # under
    st.one_of(st.none(), st.integers(0, 2)),  # over
    st.sampled_from(TIMES),
    st.booleans(),  # second local contest for code 200000101
)
precinct_row = st.tuples(
    st.one_of(st.none(), st.integers(1, 6)),
    st.sampled_from([None, "R1", "R2"]),
    st.sampled_from([None, "P A", "P B", "P C"]),
    st.sampled_from([None, 0, 50, 100]),
)


def _frames(results, precincts):
    res = []
    for p, k, v, nv, u, o, d, alt in results:
        contest = None if k is None else CONTEST_OF[k]
        if k == 200000101 and alt:
            contest = 2000002
        res.append((p, contest, k, 1, v, 1, nv, u, o, d))
    pre = [(None if c is None else 10000 + c, r, p, c, rv) for c, r, p, rv in precincts]
    return res, pre


@pytest.fixture(scope="module")
def duck():
    return duckdb.connect()


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(result_row, min_size=1, max_size=25), st.lists(precinct_row, min_size=1, max_size=8))
def test_reports_equal_oracle_on_random_elections(spark, duck, results, precincts):
    res, pre = _frames(results, precincts)
    pre_schema = "VCM_ID bigint, REG_NAME string, PRV_NAME string, CLUSTERED_PREC bigint, REGISTERED_VOTERS bigint"
    e = Election(
        results=spark.createDataFrame(res, S.RESULTS),
        candidates=spark.createDataFrame(CANDIDATES, S.CANDIDATES),
        precincts=spark.createDataFrame(pre, pre_schema),
        contests=spark.createDataFrame([(c,) for c in {c for c, _, _ in CANDIDATES}], "CONTEST_CODE bigint"),
        parties=spark.createDataFrame([(1, "INDEPENDENT", "IND")], S.PARTIES),
    )
    res_cols = [f.name for f in S.RESULTS.fields]
    r_in = pd.DataFrame(res, columns=res_cols)
    for c in res_cols[:-1]:
        r_in[c] = r_in[c].astype("Int64")
    r_in["RECEPTION_DATE"] = r_in["RECEPTION_DATE"].astype("string")
    p_in = pd.DataFrame(pre, columns=["VCM_ID", "REG_NAME", "PRV_NAME", "CLUSTERED_PREC", "REGISTERED_VOTERS"])
    for c in ("VCM_ID", "CLUSTERED_PREC", "REGISTERED_VOTERS"):
        p_in[c] = p_in[c].astype("Int64")
    for c in ("REG_NAME", "PRV_NAME"):
        p_in[c] = p_in[c].astype("string")
    c_in = pd.DataFrame(CANDIDATES, columns=["CONTEST_CODE", "CANDIDATE_CODE", "CANDIDATE_NAME"])
    k_in = pd.DataFrame({"CONTEST_CODE": sorted({c for c, _, _ in CANDIDATES})})
    pa_in = pd.DataFrame({"PARTIES_CODE": [1], "PARTIES_NAME": ["INDEPENDENT"], "PARTIES_ALIAS": ["IND"]})
    for name, frame in {"r_in": r_in, "p_in": p_in, "c_in": c_in, "k_in": k_in, "pa_in": pa_in}.items():
        duck.register(name, frame)
    sql = all_sql()
    for key in KEYS:
        df = ELECTION_QUERIES[key](e)
        got = _canon(df.columns, [tuple(r) for r in df.collect()])
        rel = duck.sql(over_tables(sql[key], INPUT_TABLES))
        want = _canon(rel.columns, rel.fetchall())
        assert got == want, key


def _norm(v):
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else ("f", v)
    return ("n",) if v is None else ("v", v)


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)
