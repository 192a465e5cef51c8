"""Vote tallies: national, local, national per province, leaders, regions.

Each report accepts the shared bases (``votes`` = :func:`vote_base`,
``precincts`` = :func:`precinct_base`) so the job computes them once. When
``votes`` is omitted the report aggregates the narrow merged fact
(:func:`summed_votes`) directly: every report only filters on and sums
over columns both frames share, so either input gives the same result, and
a standalone report saves one shuffle. The contest / province split of
the output files is a column here and a ``partitionBy`` at write time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from canvass.functions import is_national, nan_to_zero, ratio, sum0
from canvass.operators import top1_per_group, with_group_total
from canvass.plans.base import precinct_base, summed_votes
from canvass.sources.bundle import Election

V = "VOTES_AMOUNT"


def _named(df: DataFrame, candidates: DataFrame) -> DataFrame:
    """Inner join on CANDIDATE_CODE only (not on contest): unknown codes
    drop out, a code listed under several contests fans out."""
    return df.join(candidates.select("CANDIDATE_CODE", "CANDIDATE_NAME"), "CANDIDATE_CODE", "inner")


def votes_by_contest_candidate(e: Election, votes: DataFrame | None = None) -> DataFrame:
    votes = summed_votes(e) if votes is None else votes
    return votes.groupBy("CONTEST_CODE", "CANDIDATE_CODE").agg(sum0(V).alias(V))


def votes_by_province_candidate(e: Election, votes: DataFrame | None = None) -> DataFrame:
    """National votes by (CONTEST_CODE, PRV_NAME, CANDIDATE_CODE); the
    null-province group of unmatched precincts is kept."""
    votes = summed_votes(e) if votes is None else votes
    return (
        votes.where(is_national())
        .groupBy("CONTEST_CODE", "PRV_NAME", "CANDIDATE_CODE")
        .agg(sum0(V).alias(V))
    )


def total_voters(precincts: DataFrame):
    """Sum of NUMBER_VOTERS over one row per precinct, as a scalar subquery."""
    return precincts.agg(sum0("NUMBER_VOTERS")).scalar()


def tally_national(e: Election, votes: DataFrame | None = None, precincts: DataFrame | None = None) -> DataFrame:
    """Per national contest: CANDIDATE_NAME, VOTES_AMOUNT and PERCENTAGE =
    100 * votes / voters of every reporting precinct (multi-seat contests
    therefore add up to more than 100). Names are attached after the
    percentage, so unknown candidates vanish without changing it."""
    votes = summed_votes(e) if votes is None else votes
    precincts = precinct_base(e) if precincts is None else precincts
    nat = (
        votes.where(is_national())
        .groupBy("CONTEST_CODE", "CANDIDATE_CODE")
        .agg(sum0(V).alias(V))
        .withColumn("_voters", total_voters(precincts))
        .withColumn("PERCENTAGE", ratio(F.col(V) * 100, F.col("_voters")))
    )
    return _named(nat, e.candidates).select("CONTEST_CODE", "CANDIDATE_NAME", V, "PERCENTAGE")


def tally_local(e: Election, votes: DataFrame | None = None) -> DataFrame:
    """Per local contest (every code that is not national): PERCENTAGE =
    100 * votes / all votes of the contest, fixed before names are joined
    (unknown candidates stay in the denominator)."""
    votes = summed_votes(e) if votes is None else votes
    loc = votes.where(~is_national()).groupBy("CONTEST_CODE", "CANDIDATE_CODE").agg(sum0(V).alias(V))
    # one row per candidate by now: a window, so the fact is scanned once
    loc = loc.withColumn("_contest_votes", F.sum(V).over(Window.partitionBy("CONTEST_CODE")))
    loc = loc.withColumn("PERCENTAGE", ratio(F.col(V) * 100, F.col("_contest_votes")))
    return _named(loc, e.candidates).select("CONTEST_CODE", "CANDIDATE_NAME", V, "PERCENTAGE")


def voters_by_province(e: Election, precincts: DataFrame | None = None) -> DataFrame:
    precincts = precinct_base(e) if precincts is None else precincts
    return precincts.groupBy("PRV_NAME").agg(sum0("NUMBER_VOTERS").alias("NUMBER_VOTERS"))


def tally_national_province(
    e: Election, votes: DataFrame | None = None, precincts: DataFrame | None = None
) -> DataFrame:
    """National contests per province: PERCENTAGE = 100 * votes / voters of
    the province. Rows of unmatched precincts (null province) drop out at
    the inner join with the province denominators."""
    nat = votes_by_province_candidate(e, votes)
    den = voters_by_province(e, precincts).withColumnRenamed("NUMBER_VOTERS", "_prv_voters")
    t = nat.join(den, "PRV_NAME", "inner").withColumn("PERCENTAGE", ratio(F.col(V) * 100, F.col("_prv_voters")))
    return _named(t, e.candidates).select("CONTEST_CODE", "PRV_NAME", "CANDIDATE_NAME", V, "PERCENTAGE")


def leading_candidate_province(e: Election, votes: DataFrame | None = None) -> DataFrame:
    """Leading national candidate per (contest, province); ties go to the
    lowest CANDIDATE_CODE. The leader is picked before names are joined, so
    a province whose leader is not in ``candidates`` has no row."""
    nat = votes_by_province_candidate(e, votes)
    lead = top1_per_group(nat, ["CONTEST_CODE", "PRV_NAME"], V, "CANDIDATE_CODE")
    return _named(lead, e.candidates).select("CONTEST_CODE", "PRV_NAME", "CANDIDATE_NAME", V)


def candidate_by_region(e: Election, votes: DataFrame | None = None) -> DataFrame:
    """National votes by (REG_NAME, CANDIDATE_CODE, CANDIDATE_NAME) over
    precincts that match the precinct table; PERCENTAGE = votes / all
    national votes of the region * 100 (NaN -> 0). Unknown candidates are
    dropped before the denominator is taken. As in the original, the merged
    rows meet the precinct table a second time: a code with k precinct rows
    counts each of them k times (``candidate_by_region_once`` does not)."""
    votes = summed_votes(e) if votes is None else votes
    return _by_region(e, votes, F.col(V) * F.col("COPIES"))


def candidate_by_region_once(e: Election, votes: DataFrame | None = None) -> DataFrame:
    """The same with the precinct table joined once, as in every other report."""
    return _by_region(e, summed_votes(e) if votes is None else votes, F.col(V))


def _by_region(e: Election, votes: DataFrame, amount: Column) -> DataFrame:
    reg = (
        votes.where(is_national() & F.col("MATCHED"))
        .groupBy("REG_NAME", "CANDIDATE_CODE")
        .agg(F.sum(amount).alias(V))
    )
    g = _named(reg, e.candidates).groupBy("REG_NAME", "CANDIDATE_CODE", "CANDIDATE_NAME").agg(sum0(V).alias(V))
    g = with_group_total(g, ["REG_NAME"], V, "_reg_votes")
    pct = nan_to_zero(ratio(F.col(V), F.col("_reg_votes")) * 100)
    return g.select("REG_NAME", "CANDIDATE_CODE", "CANDIDATE_NAME", V, pct.alias("PERCENTAGE"))
