"""Hand-written edge fixtures (zero division, unmatched / untransmitted /
null-key precincts, unknown candidates, ties, fan-out, 12-hour text)."""

import math

import pytest

from canvass.plans import stats, tallies
from canvass.plans.base import vote_base
from tests.conftest import make_election, result_row, rows

PRES, LOCAL = 199000, 2000001
A, B, L1, L_UNKNOWN = 19900001, 19900002, 200000101, 200000109


@pytest.fixture(scope="module")
def e(spark):
    results = [
        result_row(1, PRES, A, 60, nv=100, under=2, over=1),
        result_row(1, PRES, B, 40, nv=100, under=2, over=1),
        result_row(1, LOCAL, L1, 30, nv=100, under=2, over=1),
        result_row(1, LOCAL, L_UNKNOWN, 10, nv=100, under=2, over=1),
        result_row(2, PRES, A, 5, nv=10),
        result_row(2, PRES, B, 5, nv=10),
        result_row(9, PRES, B, 7, nv=0, under=1),  # precinct 9 is not in the precinct table
    ]
    precincts = [
        (1, "R1", "HIGH COAST", 200),
        (2, "R1", "ABRA", 0),
        (3, "R2", "CEBU", 100),  # never transmitted
        (None, "R2", "CEBU", 50),  # null key: neither transmitted nor not
    ]
    candidates = [(PRES, A, "A"), (PRES, B, "B"), (LOCAL, L1, "L1")]
    return make_election(spark, results, precincts, candidates)


def test_tally_national_denominator_is_all_reporting_voters(e):
    got = rows(tallies.tally_national(e))
    assert got == [(PRES, "A", 65, 100 * 65 / 110), (PRES, "B", 52, 100 * 52 / 110)]


def test_tally_local_unknown_candidate_stays_in_denominator(e):
    assert rows(tallies.tally_local(e)) == [(LOCAL, "L1", 30, 75.0)]


def test_tally_national_province_drops_unmatched(e):
    got = rows(tallies.tally_national_province(e))
    assert got == [
        (PRES, "ABRA", "A", 5, 50.0),
        (PRES, "ABRA", "B", 5, 50.0),
        (PRES, "HIGH COAST", "A", 60, 60.0),
        (PRES, "HIGH COAST", "B", 40, 40.0),
    ]


def test_leader_tie_lowest_code_and_null_province_kept(e):
    got = rows(tallies.leading_candidate_province(e))
    assert got == [(PRES, "ABRA", "A", 5), (PRES, "HIGH COAST", "A", 60), (PRES, None, "B", 7)]


def test_leader_without_candidate_row_is_absent(spark):
    e = make_election(
        spark,
        [result_row(1, PRES, A, 9), result_row(1, PRES, B, 3)],
        [(1, "R", "P", 10)],
        candidates=[(PRES, B, "B")],
    )
    assert rows(tallies.leading_candidate_province(e)) == []


def test_candidate_by_region_matched_only(e):
    got = rows(tallies.candidate_by_region(e))
    assert got == [("R1", A, "A", 65, 65 / 110 * 100), ("R1", B, "B", 45, 45 / 110 * 100)]


def test_region_votes_of_a_repeated_precinct_code(spark):
    twice = make_election(spark, [result_row(1, PRES, A, 5), result_row(2, PRES, A, 1)], [(1, "R", "P", 10), (1, "S", "Q", 10), (2, "R", "P", 10)])
    votes = lambda df: {r.REG_NAME: r.VOTES_AMOUNT for r in df.collect()}
    assert votes(tallies.candidate_by_region(twice)) == {"R": 11, "S": 10}
    assert votes(tallies.candidate_by_region_once(twice)) == {"R": 6, "S": 5}
    assert votes(tallies.candidate_by_region_once(twice, vote_base(twice))) == {"R": 6, "S": 5}


def test_transmission_by_province(e):
    got = {r["PRV_NAME"]: r.asDict() for r in stats.transmission_by_province(e).collect()}
    assert got["CEBU"]["total_clustered_precincts"] == 1
    assert got["CEBU"]["vcm_transmitted"] == 0 and got["CEBU"]["vcm_not_transmitted"] == 1
    assert got["CEBU"]["number_of_voters_not_transmitted"] == 100
    assert got["CEBU"]["vcm_transmitted_percentile"] == 0.0
    assert got["ABRA"]["vcm_transmitted_percentile"] == 100.0


def test_map_stats_full_join_and_json_skips_null_province(e):
    m = {r["PRV_NAME"]: r.asDict() for r in stats.map_stats(e).collect()}
    assert set(m) == {"HIGH COAST", "ABRA", "CEBU", None}
    assert m[None]["total_clustered_precincts"] == 0 and m[None]["total_undervotes"] == 1
    assert m["HIGH COAST"]["voter_turnout"] == 50.0
    assert m["CEBU"]["total_voters"] == 0  # filled
    js = stats.map_stats_json(e).collect()
    assert {r["PRV_NAME"] for r in js} == {"HIGH COAST", "ABRA", "CEBU"}
    assert all(r["STATS_JSON"].startswith('{"number_of_voters_not_transmitted":') for r in js)


def test_voter_stats(e):
    r = stats.voter_stats(e).first().asDict()
    assert r == {
        "total_number_of_overvotes": 1,
        "total_number_of_precincts": 4,  # 1, 2, 3 and null
        "total_number_of_registered_voters": 200,
        "total_number_of_reporting_precincts": 3,
        "total_number_of_undervotes": 3,
        "total_number_of_voters": 110,
    }


def test_turnout_and_spoiled_zero_division(e):
    t = {r["PRECINCT_CODE"]: r["VOTER_TURNOUT"] for r in stats.turnout_by_precinct(e).collect()}
    assert t == {1: 50.0, 2: float("inf"), 9: None}
    s = {r["PRECINCT_CODE"]: r["SPOILED_PERCENTAGE"] for r in stats.spoiled_ballots(e).collect()}
    assert s == {1: 3.0, 2: 0.0, 9: float("inf")}


def test_spoiled_nan_not_filled(spark):
    e = make_election(spark, [result_row(1, PRES, A, 1, nv=0)], [(1, "R", "P", 10)])
    assert math.isnan(stats.spoiled_ballots(e).first()["SPOILED_PERCENTAGE"])


def test_correlation_nan_then_finite_null(e):
    assert math.isnan(stats.turnout_spoiled_correlation(e).first()[0])
    assert stats.turnout_spoiled_correlation_finite(e).first()[0] is None  # one finite pair


def test_duplicate_precinct_and_candidate_fan_out(spark):
    e = make_election(
        spark,
        [result_row(1, PRES, A, 10), result_row(1, LOCAL, A, 4)],
        [(1, "R", "P", 10), (1, "R", "Q", 20)],
        candidates=[(PRES, A, "A"), (LOCAL, A, "A2")],
    )
    # merged fact doubles every row of precinct 1; the candidate code fans out twice
    assert rows(tallies.votes_by_contest_candidate(e)) == [(PRES, A, 20), (LOCAL, A, 8)]
    assert {r["CANDIDATE_NAME"] for r in tallies.tally_national(e).collect()} == {"A", "A2"}
    assert stats.one_row_per_precinct(e).count() == 1
    assert rows(stats.vcm_received(e), "VCM_RECEIVED") == [(4,)]


def test_null_contest_in_neither_tally(spark):
    e = make_election(spark, [result_row(1, None, A, 5), result_row(1, LOCAL, L1, 1)], [(1, "R", "P", 10)])
    assert rows(tallies.tally_local(e), "CONTEST_CODE") == [(LOCAL,)]
    assert tallies.tally_national(e).count() == 0  # absent national contests give no rows


TIMES = [
    "05/09/2022 - 01:00:00 AM",
    "05/09/2022 - 12:30:00 AM",
    "05/09/2022 - 01:00:00 PM",
    "05/09/2022 - 11:59:00 PM",
    "05/10/2022 - 01:00:00 AM",
]


@pytest.fixture(scope="module")
def clock(spark):
    res = [result_row(i + 1, PRES, A, 1, date=d) for i, d in enumerate(TIMES)]
    res.append(result_row(1, PRES, B, 1, date=TIMES[0]))  # second row of precinct 1
    return make_election(spark, res, [(i + 1, "R", "P", 10) for i in range(5)])


def test_vcm_received_is_text_ordered_row_count(clock):
    got = sorted((r["VCM_RECEIVED"], r["RECEPTION_DATE"]) for r in stats.vcm_received(clock).collect())
    assert [d for _, d in got] == [TIMES[0], TIMES[2], TIMES[3], TIMES[1], TIMES[4]]
    assert [n for n, _ in got] == [2, 3, 4, 5, 6]


def test_vcm_received_by_time_counts_machines_in_time_order(clock):
    got = sorted(tuple(r) for r in stats.vcm_received_by_time(clock).collect())
    assert got == [
        ("2022-05-09 00:30:00", 1),
        ("2022-05-09 01:00:00", 2),
        ("2022-05-09 13:00:00", 3),
        ("2022-05-09 23:59:00", 4),
        ("2022-05-10 01:00:00", 5),
    ]


def test_reception_rate_text_slices(clock):
    got = rows(stats.reception_rate_text(clock))
    assert ("05/09/2022", "- ", "1:", 4) in got  # 01:00 AM (2 rows), 01:00 PM, 11:59 PM
    assert ("05/09/2022", "- ", "2:", 1) in got


def test_reception_rate_by_minute(clock):
    got = rows(stats.reception_rate_by_minute(clock))
    assert got[0] == ("2022-05-09 00:30", 1) and len(got) == 5


def test_shared_bases_give_the_same_reports(e):
    """The job feeds pre-aggregated bases; standalone reports read the fact."""
    from canvass.plans.base import precinct_base, vote_base

    votes, pb = vote_base(e), precinct_base(e)
    assert rows(tallies.tally_national(e, votes, pb)) == rows(tallies.tally_national(e))
    assert rows(tallies.tally_local(e, votes)) == rows(tallies.tally_local(e))
    assert rows(tallies.tally_national_province(e, votes, pb)) == rows(tallies.tally_national_province(e))
    assert rows(tallies.leading_candidate_province(e, votes)) == rows(tallies.leading_candidate_province(e))
    assert rows(tallies.candidate_by_region(e, votes)) == rows(tallies.candidate_by_region(e))
    assert rows(stats.map_stats(e, pb)) == rows(stats.map_stats(e))


def test_views_allow_plain_sql(spark, e):
    e.register_views("t_")
    got = spark.sql(
        "SELECT CONTEST_CODE, CANDIDATE_CODE, sum(VOTES_AMOUNT) AS VOTES_AMOUNT "
        "FROM t_merged_results WHERE CONTEST_CODE = 199000 GROUP BY 1, 2"
    )
    assert rows(got) == rows(tallies.votes_by_contest_candidate(e).where("CONTEST_CODE = 199000"))
