"""Named queries over a folder of driver test tables.

Every entry takes ``(spark, sf_dir)`` and returns a DataFrame computed from
the tables in ``sf_dir`` (through the stand-in mapping of
``sources.testdata``). Source, sink and streaming entries first write the
derived election tables / report outputs under the shared checkpoint
folder, then read them back through the library's readers.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from canvass import job
from canvass import schema as S
from canvass.functions import is_national
from canvass.operators import reported_precincts, row_positions
from canvass.plans import base, stats, tallies
from canvass.session import count_files, scratch_path
from canvass.sinks import LINE_ORDER, read_csv, with_line_order, write_csv, write_delimited_tables, write_partitioned_csv, write_text
from canvass.sources.bundle import Election, merged_results
from canvass.sources.delimited import load_election, read_table
from canvass.sources.testdata import derived_tables, election_from_testdata, results_from, results_raw
from canvass.streaming import reception as live
from canvass.streaming.common import least_table, overwrite_table, read_least, run_available
from canvass.streaming.running_tally import running_tally
from canvass.streaming.snapshot import publish_newest_drop

Query = Callable[[SparkSession, str], DataFrame]


def _rounded(correlation: DataFrame) -> DataFrame:
    return correlation.select(F.round("correlation", 9).alias("correlation"))


# Reports and operators that only need the election bundle.
ELECTION_QUERIES: dict[str, Callable[[Election], DataFrame]] = {
    "merged_results": merged_results,
    "project_columns": lambda e: merged_results(e).select(
        "PRECINCT_CODE", "PRV_NAME", "UNDERVOTE", "OVERVOTE", "NUMBER_VOTERS", "REGISTERED_VOTERS"
    ),
    "filter_national": lambda e: merged_results(e)
    .where(is_national())
    .select("PRV_NAME", "CONTEST_CODE", "CANDIDATE_CODE", "VOTES_AMOUNT"),
    "filter_local": lambda e: merged_results(e)
    .where(~is_national())
    .select("CONTEST_CODE", "CANDIDATE_CODE", "VOTES_AMOUNT"),
    "transmission_flag": stats.transmission_flag,
    "precincts_reported": stats.precincts_reported,
    "precincts_missing": stats.precincts_missing,
    "join_turnout_spoiled": stats.join_turnout_spoiled,
    "distinct_reporting": lambda e: reported_precincts(e.results),
    "one_row_per_precinct": stats.one_row_per_precinct,
    "precinct_count": stats.precinct_count,
    "voters_by_province": tallies.voters_by_province,
    "votes_by_contest_candidate": tallies.votes_by_contest_candidate,
    "votes_by_province_candidate": tallies.votes_by_province_candidate,
    "split_by_contest": lambda e: base.merged_votes(e)
    .groupBy("CONTEST_CODE")
    .agg(F.count(F.lit(1)).alias("RESULT_ROWS")),
    "tally_national": tallies.tally_national,
    "tally_local": tallies.tally_local,
    "tally_national_province": tallies.tally_national_province,
    "leading_candidate_province": tallies.leading_candidate_province,
    "candidate_by_region": tallies.candidate_by_region,
    "candidate_by_region_once": tallies.candidate_by_region_once,
    "transmission_by_province": stats.transmission_by_province,
    "voter_stats_by_province": stats.voter_stats_by_province,
    "map_stats": stats.map_stats,
    "map_stats_json": stats.map_stats_json,
    "voter_stats": stats.voter_stats,
    "voter_stats_json": stats.voter_stats_json,
    "vcm_received": stats.vcm_received,
    "reception_rate_text": stats.reception_rate_text,
    "turnout_by_precinct": stats.turnout_by_precinct,
    "spoiled_ballots": stats.spoiled_ballots,
    # rounded here only: sums in another order differ in the last digits
    "turnout_spoiled_correlation": lambda e: _rounded(stats.turnout_spoiled_correlation(e)),
    "turnout_spoiled_correlation_finite": lambda e: _rounded(stats.turnout_spoiled_correlation_finite(e)),
    "vcm_received_by_time": stats.vcm_received_by_time,
    "reception_rate_by_minute": stats.reception_rate_by_minute,
}

FEED_BATCHES = 6  # micro-batches of the reception feed

_EXPORTS: dict[tuple[str, str], str] = {}


def exported_tables(spark: SparkSession, sf_dir: str) -> str:
    """Write the five election tables derived from ``sf_dir`` as
    pipe-delimited CSV (once per application) and return their folder. The
    fact is derived once: the others come from the file written of it."""
    key = (spark.conf.get("spark.app.id", ""), sf_dir)
    if key not in _EXPORTS:
        root = scratch_path(spark, "tables")
        _write_drop(spark, sf_dir, root)
        _EXPORTS[key] = root
    return _EXPORTS[key]


def _write_drop(spark: SparkSession, sf_dir: str, root: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Write the five tables below ``root``; returns the results as read from
    there and the other four."""
    write_delimited_tables({"results": results_raw(spark, sf_dir)}, root)
    results = read_table(spark, f"{root}/results.csv", "results")
    others = derived_tables(spark, sf_dir, results)
    write_delimited_tables(others, root)
    return results, others


def _scan(table: str, cols: tuple[str, ...] | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = read_table(spark, f"{exported_tables(spark, sf_dir)}/{table}.csv", table)
        return df.select(*cols) if cols else df

    return run


def sink_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spoiled-ballot report (null, inf and NaN cells) -> CSV -> read back."""
    df = stats.spoiled_ballots(election_from_testdata(spark, sf_dir))
    path = scratch_path(spark, "spoiled_ballots")
    write_csv(df, path)
    return read_csv(spark, path, df.schema)


_TALLY_FILE = T.StructType(
    [
        T.StructField("CANDIDATE_NAME", T.StringType()),
        T.StructField("VOTES_AMOUNT", T.LongType()),
        T.StructField("PERCENTAGE", T.DoubleType()),
    ]
)


def sink_by_contest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """National and local tallies written as one file set per contest
    (``CONTEST_CODE=<code>/``, rows by votes descending), read back."""
    e = election_from_testdata(spark, sf_dir)
    df = tallies.tally_national(e).unionByName(tallies.tally_local(e))
    path = scratch_path(spark, "tally_by_contest")
    write_partitioned_csv(df, path, ["CONTEST_CODE"], [F.col("VOTES_AMOUNT").desc()])
    schema = T.StructType([*_TALLY_FILE.fields, T.StructField("CONTEST_CODE", T.LongType())])
    return read_csv(spark, path, schema)


def _province_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-province national tallies, one file set per contest x province
    (spaces in the province become '_', rows by votes descending), read back."""
    df = tallies.tally_national_province(election_from_testdata(spark, sf_dir)).select(
        "CANDIDATE_NAME",
        "VOTES_AMOUNT",
        "PERCENTAGE",
        "CONTEST_CODE",
        F.translate(F.col("PRV_NAME"), " ", "_").alias("PRV_KEY"),
    )
    path = scratch_path(spark, "tally_by_province")
    write_partitioned_csv(df, path, ["CONTEST_CODE", "PRV_KEY"], [F.col("VOTES_AMOUNT").desc()])
    schema = T.StructType(
        [*_TALLY_FILE.fields, T.StructField("CONTEST_CODE", T.LongType()), T.StructField("PRV_KEY", T.StringType())]
    )
    return read_csv(spark, path, schema)


def sink_by_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _province_files(spark, sf_dir)


def sink_province_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order of the rows in the per-province files: the votes at each place
    (equal votes may stand in any order)."""
    place = Window.partitionBy("CONTEST_CODE", "PRV_KEY").orderBy(*LINE_ORDER)
    rows = with_line_order(_province_files(spark, sf_dir)).withColumn("POSITION", F.row_number().over(place))
    return rows.select("CONTEST_CODE", "PRV_KEY", "POSITION", "VOTES_AMOUNT")


def sink_reception_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order of the rows in the cumulative reception file: each row's place
    among the rows of its date."""
    df = stats.vcm_received(election_from_testdata(spark, sf_dir))
    path = scratch_path(spark, "reception-file")
    write_csv(df.orderBy(F.col("RECEPTION_DATE").asc_nulls_first()), path)
    place = Window.partitionBy(F.substring("RECEPTION_DATE", 1, 10)).orderBy(*LINE_ORDER)
    rows = with_line_order(read_csv(spark, path, df.schema)).withColumn("POSITION", F.row_number().over(place))
    return rows.select("RECEPTION_DATE", "VCM_RECEIVED", "POSITION")


def sink_reception_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cumulative reception file with the place of every row among all
    rows of the file, without gaps."""
    df = stats.vcm_received(election_from_testdata(spark, sf_dir))
    path = scratch_path(spark, "reception-positions")
    write_csv(df.orderBy(F.col("RECEPTION_DATE").asc_nulls_first()), path)
    lines = with_line_order(read_csv(spark, path, df.schema))
    return row_positions(lines, [F.col(c).asc() for c in LINE_ORDER], "POSITION").select(*df.columns, "POSITION")


def job_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job itself: every report over a delimited drop of the tables, and
    the rows of its outputs read back (KEY and NAME say whose AMOUNT and
    SHARE they are)."""
    out = scratch_path(spark, "job-outputs")
    done = job.run(spark, load_election(spark, exported_tables(spark, sf_dir)), out, ["all"], log=lambda *_: None)
    failed = [name for name, sec in done.items() if sec is None]
    if failed:
        raise RuntimeError(f"reports failed: {', '.join(failed)}")

    def csv(name: str, schema: str) -> DataFrame:
        return read_csv(spark, f"{out}/{name}", T.StructType.fromDDL(schema))

    def rows(df: DataFrame, output: str, key: str, name: str, amount: str, share: str) -> DataFrame:
        cells = ((key, "KEY", "string"), (name, "NAME", "string"), (amount, "AMOUNT", "bigint"), (share, "SHARE", "double"))
        return df.select(F.lit(output).alias("OUTPUT"), *[F.expr(f"CAST({c} AS {t}) AS {n}") for c, n, t in cells])

    tally = "CANDIDATE_NAME string, VOTES_AMOUNT bigint, PERCENTAGE double, CONTEST_CODE bigint"
    documents = spark.read.text(f"{out}/map_stats.json")
    per_province = F.from_json("value", "map<string,struct<total_voters:bigint,voter_turnout:double>>")
    totals = F.from_json("value", "map<string,bigint>")
    parts = [
        rows(csv("contest", tally), "contest", "CONTEST_CODE", "CANDIDATE_NAME", "VOTES_AMOUNT", "PERCENTAGE"),
        rows(csv("province", f"{tally}, PRV_KEY string"), "province", "concat_ws('_', PRV_KEY, CONTEST_CODE)", "CANDIDATE_NAME", "VOTES_AMOUNT", "PERCENTAGE"),
        rows(
            csv("map", "PRV_NAME string, CANDIDATE_NAME string, VOTES_AMOUNT bigint, CONTEST_CODE bigint"),
            "map", "concat_ws('_', PRV_NAME, CONTEST_CODE)", "CANDIDATE_NAME", "VOTES_AMOUNT", "NULL",
        ),
        rows(
            csv("candidate_performance_by_region", "REG_NAME string, CANDIDATE_CODE bigint, CANDIDATE_NAME string, VOTES_AMOUNT bigint, PERCENTAGE double"),
            "region", "REG_NAME", "CANDIDATE_NAME", "VOTES_AMOUNT", "PERCENTAGE",
        ),
        rows(csv("vcm_received", "RECEPTION_DATE string, VCM_RECEIVED bigint"), "received", "RECEPTION_DATE", "NULL", "VCM_RECEIVED", "NULL"),
        rows(
            csv("vcm_reception_rate", "RECEPTION_DATE_ONLY string, RECEPTION_HOUR string, RECEPTION_MINUTE string, VCM_COUNT bigint"),
            "rate", "concat_ws('|', RECEPTION_DATE_ONLY, RECEPTION_HOUR, RECEPTION_MINUTE)", "NULL", "VCM_COUNT", "NULL",
        ),
        rows(
            csv("voter_turnout_by_precinct", "PRECINCT_CODE bigint, NUMBER_VOTERS bigint, REGISTERED_VOTERS bigint, VOTER_TURNOUT double"),
            "turnout", "PRECINCT_CODE", "NULL", "NUMBER_VOTERS", "VOTER_TURNOUT",
        ),
        rows(
            csv(
                "spoiled_ballots_analysis",
                "PRV_NAME string, PRECINCT_CODE bigint, UNDERVOTE bigint, OVERVOTE bigint, NUMBER_VOTERS bigint, TOTAL_SPOILED bigint, SPOILED_PERCENTAGE double",
            ),
            "spoiled", "PRECINCT_CODE", "PRV_NAME", "TOTAL_SPOILED", "SPOILED_PERCENTAGE",
        ),
        rows(documents.select(F.explode(per_province).alias("k", "v")), "map_stats", "k", "NULL", "v.total_voters", "v.voter_turnout"),
        rows(spark.read.text(f"{out}/voter_stats.json").select(F.explode(totals).alias("k", "v")), "voter_stats", "k", "NULL", "v", "NULL"),
    ]
    return reduce(DataFrame.unionByName, parts)


def sink_map_leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leading candidates, one file set per contest, read back."""
    df = tallies.leading_candidate_province(election_from_testdata(spark, sf_dir))
    path = scratch_path(spark, "map-leaders")
    write_partitioned_csv(df, path, ["CONTEST_CODE"], ["PRV_NAME"])
    return read_csv(spark, path, df.select("PRV_NAME", "CANDIDATE_NAME", "VOTES_AMOUNT", "CONTEST_CODE").schema)


def sink_correlation_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The correlation document, written and parsed back."""
    path = scratch_path(spark, "correlation-json")
    write_text(stats.correlation_json(stats.turnout_spoiled_correlation_finite(election_from_testdata(spark, sf_dir))), path)
    doc = F.from_json("value", "correlation double")
    return _rounded(spark.read.text(path).select(doc.alias("d")).select("d.correlation"))


def sink_map_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one document of all provinces, written and parsed back: POSITION
    is the place of the province among the document's keys."""
    path = scratch_path(spark, "map-document")
    write_text(stats.map_stats_document(stats.map_stats(election_from_testdata(spark, sf_dir))), path)
    doc = spark.read.text(path).select(F.from_json("value", "map<string,string>").alias("d"))
    return doc.select(F.posexplode("d").alias("POSITION", "PRV_NAME", "STATS_JSON"))


def _results_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The results table as a stream: lineitem is read as a file stream and
    joined to the static orders table (stream-static join)."""
    d = sf_dir.rstrip("/")
    li_schema = spark.read.parquet(f"{d}/lineitem.parquet").schema
    lineitem = spark.readStream.schema(li_schema).option("pathGlobFilter", "lineitem.parquet").parquet(d)
    return results_from(lineitem, spark.read.parquet(f"{d}/orders.parquet"))


def stream_running_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2: the results feed aggregated statefully (complete mode) into votes
    by contest and candidate; run to completion, the table equals the batch
    sum over the results table."""
    out = scratch_path(spark, "running_tally")
    run_available(running_tally(_results_feed(spark, sf_dir)), overwrite_table(out), scratch_path(spark, "ckpt"))
    return spark.read.parquet(out)


def stream_reception_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3: the results table arrives in ``FEED_BATCHES`` micro-batches whose
    rows are in no time order. Every task that derives the table writes its
    rows as ``FEED_BATCHES`` files, dealt by hash, so files and tasks stay of
    one size as the table grows, and a micro-batch takes as many files as
    there were tasks. The stream keeps each
    machine's earliest reception time, writes every change per epoch and
    merges the epochs to one row a machine on the way; the result counts machines per minute of their earliest time, as the batch
    report does."""
    feed, out = scratch_path(spark, "reception-feed"), scratch_path(spark, "reception-rate")
    results = results_raw(spark, sf_dir)
    part = F.pmod(F.xxhash64("PRECINCT_CODE", "CANDIDATE_CODE", "RECEPTION_DATE"), F.lit(FEED_BATCHES))
    results.withColumn("ARRIVAL", part).write.partitionBy("ARRIVAL").parquet(feed)
    files = max(1, -(-count_files(spark, feed, ".parquet") // FEED_BATCHES))
    arriving = T.StructType([*results.schema.fields, T.StructField("ARRIVAL", T.LongType())])
    stream = spark.readStream.schema(arriving).option("maxFilesPerTrigger", files).parquet(feed)
    sink = least_table(out, "PRECINCT_CODE", "RECEPTION_TS", every=FEED_BATCHES // 2)
    run_available(live.earliest_reception(stream), sink, scratch_path(spark, "ckpt"), "update")
    return live.machines_per_minute(read_least(spark, out, live.EARLIEST))


def stream_snapshot_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshot drops land, the older one with only the even precincts'
    results; the drop stream publishes the national tally of the newer."""
    drops = scratch_path(spark, "drops")
    results, others = _write_drop(spark, sf_dir, f"{drops}/01-02-22--08-00")
    older = {"results": results.where(F.col("PRECINCT_CODE") % 2 == 0), **others}
    write_delimited_tables(older, f"{drops}/12-31-21--23-59")
    out = scratch_path(spark, "snapshot_tally")
    return publish_newest_drop(spark, drops, out, scratch_path(spark, "ckpt"), tallies.tally_national)


def _on_election(fn: Callable[[Election], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(election_from_testdata(spark, sf_dir))


def all_queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "scan_candidates": _scan("candidates"),
        "scan_contests": _scan("contests", S.CONTEST_COLUMNS),
        "scan_parties": _scan("parties"),
        "scan_precincts": _scan("precincts", S.PRECINCT_COLUMNS),
        "scan_results": _scan("results"),
    }
    q.update({name: _on_election(fn) for name, fn in ELECTION_QUERIES.items()})
    q.update(
        {
            "sink_csv_roundtrip": sink_csv_roundtrip,
            "sink_by_contest": sink_by_contest,
            "sink_by_province": sink_by_province,
            "sink_province_order": sink_province_order,
            "sink_reception_order": sink_reception_order,
            "sink_reception_positions": sink_reception_positions,
            "job_outputs": job_outputs,
            "sink_map_leaders": sink_map_leaders,
            "sink_correlation_json": sink_correlation_json,
            "sink_map_document": sink_map_document,
            "stream_snapshot_tally": stream_snapshot_tally,
            "stream_running_tally": stream_running_tally,
            "stream_reception_rate": stream_reception_rate,
        }
    )
    return q
