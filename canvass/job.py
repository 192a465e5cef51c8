"""Named-report batch job.

    python -m canvass.job --input URI [--input-format csv|parquet]
                          [--ingest-to URI] --output URI [--export-flat URI]
                          REPORT [REPORT ...]
    python -m canvass.job --drops URI [--every SECONDS] --output URI
                          [--export-flat URI] REPORT [REPORT ...]

REPORT is one of tally-national, tally-local, leading-candidate-province,
tally-national-province, stats, corrected, read-results or all. With
``--ingest-to`` a delimited drop is parsed once into a Parquet copy at that
URI (``sources.warehouse``) and every report reads the copy (column-pruned, predicate-pushed scans
instead of one CSV parse per pass over the fact). The tables are loaded
once; the shared bases (votes by contest / candidate / province,
one row per precinct, reception counts / times) come from one scan of the
fact, only those that the named reports need, and are written as Parquet tables under the shared ``spark.checkpoint.dir``, which
cuts their lineage (a lost executor does not replay the fact scan) and
gives every report a column-pruned scan of a small table; they are deleted
when the run ends. Each report runs
even if another failed; the exit status is 1 when any report failed.

With ``--drops`` the job follows a folder that complete drops arrive in: the
reports run on each newer drop into a root of its own under ``--output``, and
a row in ``published`` makes it the current one when all have ended well. It
ends with the drops that are there, or goes on with ``--every``.

Output layout under ``--output`` (with ``--drops``: under each root) (one dataset per report, CSV with header
unless noted):

  contest/CONTEST_CODE=<code>/            national and local tallies
  province/CONTEST_CODE=<c>/PRV_KEY=<p>/  national tallies per province
  map/CONTEST_CODE=<code>/                leading candidate per province
  map_stats.json/                         JSON lines {"<province>": {...}}
  map_stats_document.json/                the same as one document, sorted keys
  map_stats_unassigned.json/              {"unassigned": {...}} for results whose
                                          precinct is not in the precinct table
  voter_stats.json/                       one JSON object
  vcm_received/, voter_turnout_by_precinct/, spoiled_ballots_analysis/,
  candidate_performance_by_region/, vcm_reception_rate/,
  turnout_spoiled_correlation.json/
  corrected/vcm_received_by_time/, corrected/reception_rate_by_minute/,
  corrected/turnout_spoiled_correlation.json/,
  corrected/candidate_performance_by_region/
"""

from __future__ import annotations

import argparse
import sys
import time
import traceback
from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.plans import base, stats, tallies
from canvass.session import checkpoint_root, get_spark, scratch_scope, stored
from canvass.sinks import export_flat, write_csv, write_partitioned_csv, write_text
from canvass.sources.bundle import Election
from canvass.sources.delimited import load_election, read_tables
from canvass.sources.warehouse import ingest, load_warehouse

COMMANDS = (
    "tally-national",
    "tally-local",
    "leading-candidate-province",
    "tally-national-province",
    "stats",
    "corrected",
    "read-results",
    "all",
)


class Run:
    """One job run: the bundle, lazily materialised bases, the output root."""

    def __init__(self, spark: SparkSession, e: Election, out: str, wanted: Sequence[str] = base.BASES):
        self.spark = spark
        self.e = e
        self.out = out.rstrip("/")
        self.wanted = wanted
        self._begun: set[str] = set()

    def by_key(self, df: DataFrame, name: str, keys: list[str], order: list) -> None:
        """Write ``df`` split by ``keys`` into output tree ``name``. The first
        report of the run replaces the tree of an earlier run, further ones
        add to it (their keys are disjoint)."""
        mode = "append" if name in self._begun else "overwrite"
        write_partitioned_csv(df, self.path(name), keys, order, mode)
        self._begun.add(name)

    @cached_property
    def fact(self) -> DataFrame:
        """Every base that the named reports need, from one scan of the fact."""
        return stored(base.fact_bases(self.e, self.wanted), "bases")

    @cached_property
    def votes(self) -> DataFrame:
        return stored(base.votes_from(self.e, self.fact), "base-votes")

    @cached_property
    def precincts(self) -> DataFrame:
        return stored(base.precincts_from(self.e, self.fact), "base-precincts")

    @cached_property
    def receptions(self) -> DataFrame:
        return base.receptions_from(self.e, self.fact)

    @cached_property
    def counts(self) -> DataFrame:
        return stored(base.reception_counts(self.e, self.receptions), "reception-counts")

    @cached_property
    def times(self) -> DataFrame:
        return stored(base.reception_times(self.e, self.receptions), "reception-times")

    def path(self, name: str) -> str:
        return f"{self.out}/{name}"


def _tally_file(df: DataFrame) -> DataFrame:
    return df.select("CONTEST_CODE", "CANDIDATE_NAME", "VOTES_AMOUNT", "PERCENTAGE")


def tally_national(r: Run) -> None:
    df = _tally_file(tallies.tally_national(r.e, r.votes, r.precincts))
    r.by_key(df, "contest", ["CONTEST_CODE"], [F.col("VOTES_AMOUNT").desc()])


def tally_local(r: Run) -> None:
    df = _tally_file(tallies.tally_local(r.e, r.votes))
    r.by_key(df, "contest", ["CONTEST_CODE"], [F.col("VOTES_AMOUNT").desc()])


def tally_national_province(r: Run) -> None:
    df = tallies.tally_national_province(r.e, r.votes, r.precincts).select(
        "CONTEST_CODE",
        F.translate(F.col("PRV_NAME"), " ", "_").alias("PRV_KEY"),
        "CANDIDATE_NAME",
        "VOTES_AMOUNT",
        "PERCENTAGE",
    )
    r.by_key(df, "province", ["CONTEST_CODE", "PRV_KEY"], [F.col("VOTES_AMOUNT").desc()])


def leading_candidate_province(r: Run) -> None:
    df = tallies.leading_candidate_province(r.e, r.votes)
    r.by_key(df, "map", ["CONTEST_CODE"], ["PRV_NAME"])


def run_stats(r: Run) -> None:
    e, pb = r.e, r.precincts
    ms = stats.map_stats(e, pb).cache()  # one row per province, read by two outputs
    doc = F.to_json(F.create_map(F.col("PRV_NAME"), F.struct(*stats.MAP_STATS_FIELDS)))
    write_text(ms.where(F.col("PRV_NAME").isNotNull()).select(doc.alias("value")), r.path("map_stats.json"))
    # results of precincts missing from the precinct table have no province:
    # not a valid JSON key, so they are reported on their own
    side = F.to_json(F.struct(F.struct(*stats.MAP_STATS_FIELDS).alias("unassigned")))
    write_text(ms.where(F.col("PRV_NAME").isNull()).select(side.alias("value")), r.path("map_stats_unassigned.json"))
    # the same provinces as ONE JSON document with sorted keys; its input is
    # the per-province table (one row per province), not the fact
    write_text(stats.map_stats_document(ms), r.path("map_stats_document.json"))
    ms.unpersist()
    write_text(stats.voter_stats_json(e, pb).toDF("value"), r.path("voter_stats.json"))
    write_csv(stats.vcm_received(e, r.counts).orderBy(F.col("RECEPTION_DATE").asc_nulls_first()), r.path("vcm_received"))
    write_csv(stats.turnout_by_precinct(e, pb), r.path("voter_turnout_by_precinct"))
    write_csv(stats.spoiled_ballots(e, pb), r.path("spoiled_ballots_analysis"))
    write_csv(tallies.candidate_by_region(e, r.votes), r.path("candidate_performance_by_region"))
    write_text(stats.correlation_json(stats.turnout_spoiled_correlation(e, pb)), r.path("turnout_spoiled_correlation.json"))
    rate = stats.reception_rate_text(e, r.counts).orderBy(
        "RECEPTION_DATE_ONLY", "RECEPTION_HOUR", "RECEPTION_MINUTE"
    )
    write_csv(rate, r.path("vcm_reception_rate"))


def run_corrected(r: Run) -> None:
    e = r.e
    write_csv(stats.vcm_received_by_time(e, r.times).orderBy("RECEPTION_TIME"), r.path("corrected/vcm_received_by_time"))
    write_csv(stats.reception_rate_by_minute(e, r.times), r.path("corrected/reception_rate_by_minute"))
    write_csv(tallies.candidate_by_region_once(e, r.votes), r.path("corrected/candidate_performance_by_region"))
    corr = stats.correlation_json(stats.turnout_spoiled_correlation_finite(e, r.precincts))
    write_text(corr, r.path("corrected/turnout_spoiled_correlation.json"))


def read_results(r: Run) -> None:
    r.votes, r.precincts  # noqa: B018 - materialise the bases only


REPORTS: dict[str, Callable[[Run], None]] = {
    "tally-national": tally_national,
    "tally-local": tally_local,
    "leading-candidate-province": leading_candidate_province,
    "tally-national-province": tally_national_province,
    "stats": run_stats,
    "corrected": run_corrected,
    "read-results": read_results,
}

# Bases of the fact that each report reads (see plans.base).
NEEDS: dict[str, tuple[str, ...]] = {
    "tally-national": ("votes", "precincts"),
    "tally-local": ("votes",),
    "leading-candidate-province": ("votes",),
    "tally-national-province": ("votes", "precincts"),
    "stats": base.BASES,
    "corrected": base.BASES,
    "read-results": ("votes", "precincts"),
}


def run(spark: SparkSession, e: Election, out: str, cmds: list[str], log=print) -> dict[str, float | None]:
    """Run the named reports; returns seconds per report (None = failed)."""
    unknown = [c for c in cmds if c not in COMMANDS]
    if unknown:
        raise ValueError(f"unknown report(s) {unknown}; available: {', '.join(COMMANDS)}")
    if "all" in cmds:
        cmds = [c for c in COMMANDS if c not in ("all", "read-results")]
    checkpoint_root(spark)  # make sure bases have a shared place to land
    r = Run(spark, e, out, [b for b in base.BASES if any(b in NEEDS[c] for c in cmds)])
    done: dict[str, float | None] = {}
    with scratch_scope(spark):  # outputs do not depend on the bases
        for c in cmds:
            t0 = time.perf_counter()
            try:
                REPORTS[c](r)
                done[c] = round(time.perf_counter() - t0, 3)
                log(f"{c} took {done[c]:.3f} seconds")
            except Exception:  # noqa: BLE001 - one failing report must not stop the others
                done[c] = None
                log(f"{c} failed:\n{traceback.format_exc()}")
    return done


def _follow(spark: SparkSession, a: argparse.Namespace) -> int:
    """``--drops``: the reports of every newer drop, published under
    ``--output`` (see streaming.snapshot); progress stands in
    ``{output}/_checkpoint``, so a restarted job goes on where it ended."""
    from canvass.streaming.snapshot import publish_all_reports

    out = a.output.rstrip("/")
    root = publish_all_reports(spark, a.drops, out, f"{out}/_checkpoint", tuple(a.reports), a.every, a.export_flat)
    print(f"published: {root}" if root else "no drop yet")
    return 0


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    source = ap.add_mutually_exclusive_group(required=True)
    source.add_argument("--input", help="folder of the five tables")
    source.add_argument("--drops", help="folder that complete drops arrive in, each in a folder named MM-dd-yy--HH-mm")
    ap.add_argument("--every", type=float, help="with --drops: look for new drops each so many seconds, until stopped")
    ap.add_argument("--input-format", choices=("csv", "parquet"), default="csv")
    ap.add_argument("--ingest-to", help="write a Parquet copy of a csv input here first and read from it")
    ap.add_argument("--output", required=True)
    ap.add_argument("--export-flat", help="also copy the outputs to the original flat file names here")
    ap.add_argument("reports", nargs="+")
    a = ap.parse_args(argv)
    unknown = [c for c in a.reports if c not in COMMANDS]
    if unknown:
        print(f"unknown report(s) {unknown}; available: {', '.join(COMMANDS)}", file=sys.stderr)
        return 2
    spark = get_spark("canvass-job")
    if a.drops:
        return _follow(spark, a)
    if a.input_format == "csv" and a.ingest_to:
        ingest(read_tables(spark, a.input), a.ingest_to)
        e = load_warehouse(spark, a.ingest_to)
    elif a.input_format == "csv":
        e = load_election(spark, a.input)
    else:
        e = load_warehouse(spark, a.input)
    done = run(spark, e, a.output, a.reports)
    if a.export_flat:
        export_flat(a.output, a.export_flat)
    return 1 if any(v is None for v in done.values()) else 0


if __name__ == "__main__":
    raise SystemExit(main())
