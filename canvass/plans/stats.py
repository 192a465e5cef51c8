"""Transmission, turnout, spoiled-ballot, correlation and reception reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.functions import is_finite, json_number, n_unique, nan_to_zero, pct_guarded, pearson, ratio, sum0
from canvass.operators import reported_precincts, running_total, with_existence_flag
from canvass.plans.base import precinct_base, reception_counts, reception_times
from canvass.sources.bundle import Election

# Field names of the province statistics and of the overall
# voter statistics documents, in their (sorted) output order.
MAP_STATS_FIELDS = (
    "number_of_voters_not_transmitted",
    "total_clustered_precincts",
    "total_overvotes",
    "total_registered_voters",
    "total_undervotes",
    "total_voters",
    "vcm_not_transmitted",
    "vcm_transmitted",
    "vcm_transmitted_percentile",
    "voter_turnout",
)
VOTER_STATS_FIELDS = (
    "total_number_of_overvotes",
    "total_number_of_precincts",
    "total_number_of_registered_voters",
    "total_number_of_reporting_precincts",
    "total_number_of_undervotes",
    "total_number_of_voters",
)


def _pb(e: Election, precincts: DataFrame | None) -> DataFrame:
    return precinct_base(e) if precincts is None else precincts


# ---------------------------------------------------------------- transmission


def transmission_flag(e: Election, reported: DataFrame | None = None) -> DataFrame:
    """Precincts (CLUSTERED_PREC, PRV_NAME, REGISTERED_VOTERS) with
    TRANSMITTED: does the precinct appear in the results (null key -> null).

    ``reported``: any frame with a PRECINCT_CODE column covering the codes
    in the results (e.g. the precinct base), to avoid another fact scan.
    """
    p = e.precincts.select("CLUSTERED_PREC", "PRV_NAME", "REGISTERED_VOTERS")
    keys = e.results if reported is None else reported
    return with_existence_flag(p, "CLUSTERED_PREC", keys, "PRECINCT_CODE", "TRANSMITTED")


def precincts_reported(e: Election) -> DataFrame:
    rep = reported_precincts(e.results)
    return e.precincts.join(rep, F.col("CLUSTERED_PREC") == F.col("PRECINCT_CODE"), "left_semi")


def precincts_missing(e: Election) -> DataFrame:
    rep = reported_precincts(e.results)
    return e.precincts.join(rep, F.col("CLUSTERED_PREC") == F.col("PRECINCT_CODE"), "left_anti")


def transmission_by_province(e: Election, reported: DataFrame | None = None) -> DataFrame:
    t = F.col("TRANSMITTED")
    key = F.col("CLUSTERED_PREC")
    return (
        transmission_flag(e, reported)
        .groupBy("PRV_NAME")
        .agg(
            F.count(key).alias("total_clustered_precincts"),
            F.count(F.when(t, key)).alias("vcm_transmitted"),
            F.count(F.when(~t, key)).alias("vcm_not_transmitted"),
            sum0(F.when(~t, F.col("REGISTERED_VOTERS"))).alias("number_of_voters_not_transmitted"),
        )
        .withColumn("vcm_transmitted_percentile", pct_guarded("vcm_transmitted", "total_clustered_precincts"))
    )


# ------------------------------------------------------------------ voter stats


def one_row_per_precinct(e: Election, precincts: DataFrame | None = None) -> DataFrame:
    return _pb(e, precincts).select(
        "PRECINCT_CODE", "PRV_NAME", "UNDERVOTE", "OVERVOTE", "NUMBER_VOTERS", "REGISTERED_VOTERS"
    )


def voter_stats_by_province(e: Election, precincts: DataFrame | None = None) -> DataFrame:
    return (
        _pb(e, precincts)
        .groupBy("PRV_NAME")
        .agg(
            sum0("UNDERVOTE").alias("total_undervotes"),
            sum0("OVERVOTE").alias("total_overvotes"),
            sum0("NUMBER_VOTERS").alias("total_voters"),
            sum0("REGISTERED_VOTERS").alias("total_registered_voters"),
        )
        .withColumn("voter_turnout", pct_guarded("total_voters", "total_registered_voters"))
    )


def map_stats(e: Election, precincts: DataFrame | None = None) -> DataFrame:
    """Transmission and voter statistics per province (full outer join on
    PRV_NAME, missing numbers -> 0). A null-province row (results of
    precincts absent from the precinct table) is kept here."""
    reported = None if precincts is None else precincts.select("PRECINCT_CODE")
    j = transmission_by_province(e, reported).join(voter_stats_by_province(e, precincts), "PRV_NAME", "full").fillna(0)
    return j.select("PRV_NAME", *MAP_STATS_FIELDS)


def map_stats_json(e: Election, precincts: DataFrame | None = None) -> DataFrame:
    """One JSON object per province with the ten metrics in sorted key
    order; the null province cannot be a JSON key and is left out."""
    m = map_stats(e, precincts).where(F.col("PRV_NAME").isNotNull())
    return m.select("PRV_NAME", F.to_json(F.struct(*MAP_STATS_FIELDS)).alias("STATS_JSON"))


def map_stats_document(provinces: DataFrame) -> DataFrame:
    """The rows of :func:`map_stats` with a province as one JSON document,
    keys sorted. It gathers a row per province (the report itself, whatever
    the size of the results)."""
    entry = F.struct(F.col("PRV_NAME").alias("key"), F.struct(*MAP_STATS_FIELDS).alias("value"))
    named = provinces.where(F.col("PRV_NAME").isNotNull())
    return named.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("value"))


def precinct_count(e: Election) -> DataFrame:
    return e.precincts.agg(n_unique("CLUSTERED_PREC").alias("total_number_of_precincts"))


def voter_stats(e: Election, precincts: DataFrame | None = None) -> DataFrame:
    """Six national totals in one row. The precinct count is a scalar
    subquery over the precinct table (no cross join)."""
    pb = _pb(e, precincts)
    return (
        pb.agg(
            sum0("OVERVOTE").alias("total_number_of_overvotes"),
            sum0("REGISTERED_VOTERS").alias("total_number_of_registered_voters"),
            F.count(F.lit(1)).alias("total_number_of_reporting_precincts"),
            sum0("UNDERVOTE").alias("total_number_of_undervotes"),
            sum0("NUMBER_VOTERS").alias("total_number_of_voters"),
        )
        .withColumn("total_number_of_precincts", precinct_count(e).scalar())
        .select(*VOTER_STATS_FIELDS)
    )


def voter_stats_json(e: Election, precincts: DataFrame | None = None) -> DataFrame:
    return voter_stats(e, precincts).select(F.to_json(F.struct(*VOTER_STATS_FIELDS)).alias("VOTER_STATS_JSON"))


# ------------------------------------------------------------ turnout / spoiled


def _turnout(pb: DataFrame):
    return nan_to_zero(ratio("NUMBER_VOTERS", "REGISTERED_VOTERS") * 100)


def _spoiled_cols():
    u = F.coalesce(F.col("UNDERVOTE"), F.lit(0)).cast("bigint")
    o = F.coalesce(F.col("OVERVOTE"), F.lit(0)).cast("bigint")
    nv = F.coalesce(F.col("NUMBER_VOTERS"), F.lit(0)).cast("bigint")
    return u, o, nv, ratio(u + o, nv) * 100


def turnout_by_precinct(e: Election, precincts: DataFrame | None = None) -> DataFrame:
    """VOTER_TURNOUT = NUMBER_VOTERS / REGISTERED_VOTERS * 100, NaN -> 0
    (n/0 stays +inf, unknown REGISTERED_VOTERS stays null)."""
    pb = _pb(e, precincts)
    return pb.select("PRECINCT_CODE", "NUMBER_VOTERS", "REGISTERED_VOTERS", _turnout(pb).alias("VOTER_TURNOUT"))


def spoiled_ballots(e: Election, precincts: DataFrame | None = None) -> DataFrame:
    """Per precinct: under/over votes (null -> 0), TOTAL_SPOILED and
    SPOILED_PERCENTAGE = spoiled / voters * 100 with no NaN replacement."""
    u, o, nv, pct = _spoiled_cols()
    return _pb(e, precincts).select(
        "PRV_NAME",
        "PRECINCT_CODE",
        u.alias("UNDERVOTE"),
        o.alias("OVERVOTE"),
        nv.alias("NUMBER_VOTERS"),
        (u + o).alias("TOTAL_SPOILED"),
        pct.alias("SPOILED_PERCENTAGE"),
    )


def join_turnout_spoiled(e: Election, precincts: DataFrame | None = None) -> DataFrame:
    """Turnout and spoiled percentage side by side per precinct code. Both
    come from the same representative row, so no join is needed; a null
    precinct code (which an equi-join would drop) is left out."""
    pb = _pb(e, precincts).where(F.col("PRECINCT_CODE").isNotNull())
    *_, pct = _spoiled_cols()
    return pb.select("PRECINCT_CODE", _turnout(pb).alias("VOTER_TURNOUT"), pct.alias("SPOILED_PERCENTAGE"))


def _correlation(pairs: DataFrame) -> DataFrame:
    x, y = F.col("VOTER_TURNOUT"), F.col("SPOILED_PERCENTAGE")
    return pairs.where(x.isNotNull() & y.isNotNull()).agg(pearson(x, y).alias("correlation"))


def turnout_spoiled_correlation(e: Election, precincts: DataFrame | None = None) -> DataFrame:
    """Pearson r of turnout vs spoiled percentage (NaN when any input is
    inf or NaN, null when degenerate)."""
    return _correlation(join_turnout_spoiled(e, precincts))


def turnout_spoiled_correlation_finite(e: Election, precincts: DataFrame | None = None) -> DataFrame:
    """Same, over precincts whose two values are both finite."""
    p = join_turnout_spoiled(e, precincts)
    return _correlation(p.where(is_finite(F.col("VOTER_TURNOUT")) & is_finite(F.col("SPOILED_PERCENTAGE"))))


def correlation_json(correlation: DataFrame) -> DataFrame:
    """``{"correlation": r}``; NaN / inf (not valid JSON) and a degenerate
    input are written as null."""
    doc = F.struct(json_number("correlation").alias("correlation"))
    return correlation.select(F.to_json(doc, {"ignoreNullFields": "false"}).alias("value"))


# --------------------------------------------------------------------- reception


def vcm_received(e: Election, counts: DataFrame | None = None) -> DataFrame:
    """Cumulative result rows over RECEPTION_DATE sorted as text (nulls
    first), whatever the text is."""
    rc = reception_counts(e) if counts is None else counts
    run = running_total(rc, "RECEPTION_DATE", "VCM_COUNT", "VCM_RECEIVED")
    return run.select("RECEPTION_DATE", "VCM_RECEIVED")


def reception_rate_text(e: Election, counts: DataFrame | None = None) -> DataFrame:
    """Result rows per fixed-offset slices of the text: characters 1-10,
    12-13 and 15-16 (on the documented layout the last two land on "- "
    and on the hour's second digit plus ':')."""
    rc = reception_counts(e) if counts is None else counts
    d = F.col("RECEPTION_DATE")
    return rc.groupBy(
        F.substring(d, 1, 10).alias("RECEPTION_DATE_ONLY"),
        F.substring(d, 12, 2).alias("RECEPTION_HOUR"),
        F.substring(d, 15, 2).alias("RECEPTION_MINUTE"),
    ).agg(sum0("VCM_COUNT").alias("VCM_COUNT"))


def vcm_received_by_time(e: Election, times: DataFrame | None = None) -> DataFrame:
    """Cumulative count of machines (precinct codes) by their earliest
    parsed reception time, in time order. Precincts without a parseable
    time are left out. RECEPTION_TIME is ``yyyy-MM-dd HH:mm:ss``."""
    rt = reception_times(e) if times is None else times
    counts = rt.where(F.col("RECEPTION_TS").isNotNull()).groupBy("RECEPTION_TS").agg(F.count(F.lit(1)).alias("VCM_COUNT"))
    run = running_total(counts, "RECEPTION_TS", "VCM_COUNT", "VCM_RECEIVED")
    return run.select(F.date_format("RECEPTION_TS", "yyyy-MM-dd HH:mm:ss").alias("RECEPTION_TIME"), "VCM_RECEIVED")


def reception_rate_by_minute(e: Election, times: DataFrame | None = None) -> DataFrame:
    """Machines first received per clock minute (``yyyy-MM-dd HH:mm``)."""
    rt = reception_times(e) if times is None else times
    minute = F.date_format(F.date_trunc("minute", F.col("RECEPTION_TS")), "yyyy-MM-dd HH:mm")
    return (
        rt.where(F.col("RECEPTION_TS").isNotNull())
        .groupBy(minute.alias("RECEPTION_MINUTE"))
        .agg(F.count(F.lit(1)).alias("VCM_COUNT"))
    )
