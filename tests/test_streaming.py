"""Streaming variants against their batch equivalents."""

import os

from canvass.plans import tallies
from canvass.session import scratch_path
from canvass.sinks import write_delimited_tables
from canvass.streaming.common import overwrite_table, run_available
from canvass.streaming.running_tally import running_tally
from canvass.streaming.snapshot import publish_newest_drop
from canvass.schema import RESULTS
from tests.conftest import make_election, result_row, rows

PRES, A, B = 199000, 19900001, 19900002


def _tables(e):
    pre = e.precincts.selectExpr(
        "VCM_ID", "REG_NAME", "PRV_NAME", "'M' AS MUN_NAME", "'B' AS BRGY_NAME", "'S' AS POLLPLACE",
        "CLUSTERED_PREC", "REGISTERED_VOTERS",
    )
    con = e.contests.selectExpr("CONTEST_CODE", "'C' AS CONTEST_NAME")
    return {"results": e.results, "candidates": e.candidates, "contests": con, "parties": e.parties, "precincts": pre}


def test_snapshot_newest_drop_replaces_older(spark):
    big = make_election(spark, [result_row(1, PRES, A, 10), result_row(1, PRES, B, 20)], [(1, "R", "P", 5)])
    small = make_election(spark, [result_row(1, PRES, A, 3)], [(1, "R", "P", 5)])
    drops = scratch_path(spark, "t-drops")
    # stamps that sort the wrong way as text: 12-31-21 is older than 01-02-22
    write_delimited_tables(_tables(big), f"{drops}/12-31-21--23-59")
    write_delimited_tables(_tables(small), f"{drops}/01-02-22--08-00")
    out = scratch_path(spark, "t-snap-out")
    got = publish_newest_drop(spark, drops, out, scratch_path(spark, "t-ckpt"), tallies.tally_national)
    assert rows(got, "CANDIDATE_NAME", "VOTES_AMOUNT") == [(f"CAND {A}", 3)]


def test_running_tally_stream_equals_batch(spark):
    e = make_election(
        spark, [result_row(p, PRES, c, v) for p, c, v in [(1, A, 5), (2, A, 7), (2, B, 1), (3, B, None)]], []
    )
    src = scratch_path(spark, "t-feed")
    e.results.coalesce(1).write.parquet(f"{src}/a")
    stream = spark.readStream.schema(RESULTS).parquet(f"{src}/a")
    out = scratch_path(spark, "t-tally")
    run_available(running_tally(stream), overwrite_table(out), scratch_path(spark, "t-ckpt"))
    assert rows(spark.read.parquet(out)) == rows(running_tally(e.results))
    assert os.path.basename(out).startswith("t-tally")


def test_late_older_drop_is_ignored(spark):
    newer = make_election(spark, [result_row(1, PRES, A, 3)], [(1, "R", "P", 5)])
    older = make_election(spark, [result_row(1, PRES, B, 99)], [(1, "R", "P", 5)])
    drops = scratch_path(spark, "t-drops-late")
    out, ckpt = scratch_path(spark, "t-late-out"), scratch_path(spark, "t-late-ckpt")
    write_delimited_tables(_tables(newer), f"{drops}/05-10-22--09-00")
    publish_newest_drop(spark, drops, out, ckpt, tallies.tally_national)
    # an older drop lands afterwards; the restarted stream sees only it
    write_delimited_tables(_tables(older), f"{drops}/05-09-22--09-00")
    got = publish_newest_drop(spark, drops, out, ckpt, tallies.tally_national)
    assert rows(got, "CANDIDATE_NAME", "VOTES_AMOUNT") == [(f"CAND {A}", 3)]


def _reception(spark, batches):
    """The feed as one file per batch, one micro-batch each, in this order."""
    from canvass.streaming import reception as live
    from canvass.streaming.common import append_table, read_appended

    src, ckpt, out = scratch_path(spark, "t-rate-feed"), scratch_path(spark, "t-ckpt"), scratch_path(spark, "t-rate")
    for b in batches:
        make_election(spark, b, []).results.coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(RESULTS).parquet(src)
        run_available(live.earliest_reception(stream), append_table(out), ckpt, "update")
    return rows(live.machines_per_minute(read_appended(spark, out, live.EARLIEST)))


def test_every_report_is_republished_for_a_newer_drop(spark):
    from canvass.streaming.snapshot import publish_all_reports, published

    first = make_election(spark, [result_row(1, PRES, A, 3), result_row(1, 5501, B, 2)], [(1, "R", "P", 5)])
    second = make_election(spark, [result_row(1, PRES, A, 8)], [(1, "R", "P", 5)], candidates=[(PRES, A, "ANN")])
    drops, out, ckpt = scratch_path(spark, "t-all"), scratch_path(spark, "t-all-out"), scratch_path(spark, "t-ckpt")
    write_delimited_tables(_tables(first), f"{drops}/05-09-22--09-00")
    one = publish_all_reports(spark, drops, out, ckpt)
    assert spark.read.csv(f"{one}/contest", header=True).count() == 2
    write_delimited_tables(_tables(second), f"{drops}/05-09-22--10-00")
    two = publish_all_reports(spark, drops, out, ckpt)
    assert published(spark, out)[1] == two != one
    got = spark.read.csv(f"{two}/contest", header=True).collect()
    assert [(r.CANDIDATE_NAME, r.VOTES_AMOUNT, int(r.CONTEST_CODE)) for r in got] == [("ANN", "8", PRES)]
    for name in ("map_stats.json", "voter_stats.json", "vcm_received", "voter_turnout_by_precinct", "corrected/vcm_received_by_time"):
        assert spark.read.text(f"{two}/{name}").count() > 0


def _drop_files(results):
    from tests.test_io import FILES

    header = FILES["results.csv"].splitlines()[0]
    return {**FILES, "results.csv": "\n".join([header, *results]) + "\n"}


def test_job_follows_drops_and_trims_old_roots(spark, tmp_path):
    """Three drops, one run of the job after each: what is published equals a
    full run on the newest drop, and two roots stay."""
    import os

    from canvass import job
    from canvass.session import hadoop_path
    from canvass.streaming.snapshot import published
    from tests.test_io import _write

    drops, out, flat = tmp_path / "drops", str(tmp_path / "out"), tmp_path / "flat"
    drops.mkdir()
    assert job.main(["--drops", str(drops), "--output", out, "no-such-report"]) == 2
    assert job.main(["--drops", str(drops), "--output", out, "all"]) == 0 and published(spark, out) is None
    lines = [
        "00000007|00199000|0019900001|0|9|1|100|3|1|05/09/2022 - 08:07:08 PM",
        "00000007|00299000|0029900001|0|4|1|100|3|1|05/09/2022 - 08:07:08 PM",
        "00000099|00199000|0019900001|0|5|1|60|0|1|05/10/2022 - 01:00:00 AM",
    ]
    roots = []
    for i, stamp in enumerate(("12-31-21--23-59", "01-02-22--08-00", "01-02-22--09-30")):
        _write(str(drops / stamp), _drop_files(lines[: i + 1]))
        assert job.main(["--drops", str(drops), "--output", out, "--export-flat", str(flat), "all"]) == 0
        roots.append(published(spark, out)[1])
    assert len(set(roots)) == 3 and "01-02-22--09-30" in roots[-1]
    stay = [hadoop_path(spark, r)[0].exists(hadoop_path(spark, r)[1]) for r in roots]
    assert stay == [False, True, True]
    assert spark.read.parquet(f"{out}/published").count() == 2
    job.main(["--drops", str(drops), "--output", out, "all"])  # nothing new: nothing happens
    assert published(spark, out)[1] == roots[-1]

    whole, again = str(tmp_path / "whole"), str(tmp_path / "whole-flat")
    assert job.main(["--input", str(drops / "01-02-22--09-30"), "--output", whole, "--export-flat", again, "all"]) == 0
    assert sorted(os.listdir(flat)) == sorted(os.listdir(again))
    for name in os.listdir(again):
        if not name.startswith((".", "_")):
            assert sorted((flat / name).read_text().splitlines()) == sorted(open(f"{again}/{name}").read().splitlines()), name


def test_drops_are_followed_until_stopped(spark, tmp_path):
    import threading
    import time

    from canvass.streaming.snapshot import publish_all_reports, published
    from tests.test_io import FILES, _write

    drops, out = tmp_path / "drops", str(tmp_path / "out")
    drops.mkdir()
    args = (spark, str(drops), out, str(tmp_path / "ckpt"), ("tally-national",), 0.5)
    follower = threading.Thread(target=publish_all_reports, args=args)
    follower.start()
    try:
        _write(str(drops / "01-02-22--08-00"), FILES)
        until = time.time() + 60
        while published(spark, out) is None and time.time() < until:
            time.sleep(0.5)
        assert "01-02-22--08-00" in published(spark, out)[1]
    finally:
        for q in spark.streams.active:
            q.stop()
        follower.join(60)
    assert not follower.is_alive()


def test_marker_failures_are_raised(spark, tmp_path):
    import pytest

    from canvass.streaming.snapshot import published

    assert published(spark, str(tmp_path / "none")) is None
    (tmp_path / "bad" / "published").mkdir(parents=True)
    (tmp_path / "bad" / "published" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):  # noqa: B017 - whatever the reader raises must come through
        published(spark, str(tmp_path / "bad"))


def test_reception_rate_stream_equals_batch_in_any_order(spark):
    """Machines report again hours apart, earlier times arrive in later
    micro-batches, and text that does not parse is ignored."""
    from canvass.plans import stats

    def row(p, d):
        return result_row(p, PRES, A, 1, date=f"05/09/2022 - {d}")

    batches = [
        [row(1, "07:00:10 PM"), row(9, "bad text")],
        [row(2, "06:00:00 PM"), row(1, "08:00:00 PM"), row(1, "08:00:00 PM")],
        [row(3, "06:05:00 PM"), row(1, "09:00:00 PM"), row(2, "11:00:00 PM")],
        [row(1, "12:01:00 AM"), row(4, "09:00:30 PM")],
    ]
    got = _reception(spark, batches)
    assert got == rows(stats.reception_rate_by_minute(make_election(spark, [r for b in batches for r in b], [])))
    assert got == [("2022-05-09 00:01", 1), ("2022-05-09 18:00", 1), ("2022-05-09 18:05", 1), ("2022-05-09 21:00", 1)]


def test_least_table_stays_as_large_as_its_keys(spark):
    """Fifty epochs of the same machines, some replayed: rows on disk stay
    within the machines and the epochs since two merges."""
    import random
    from datetime import datetime, timedelta

    from canvass.streaming import reception as live
    from canvass.streaming.common import _epochs, least_table, read_least

    out, every, machines = scratch_path(spark, "t-least"), 5, 40
    sink = least_table(out, "PRECINCT_CODE", "RECEPTION_TS", every)
    rng, start, want, sizes = random.Random(1), datetime(2022, 5, 9, 12), {}, []
    assert read_least(spark, out, live.EARLIEST).count() == 0
    for epoch in range(50):
        rows = [(m, start + timedelta(seconds=rng.randint(0, 9999))) for m in rng.sample(range(machines), 10)]
        batch = spark.createDataFrame(rows, live.EARLIEST).coalesce(1)
        for _ in range(2 if epoch % 7 == 4 else 1):  # epochs 4 and 39 are replayed after their merge
            sink(batch, epoch)
        for m, t in rows:
            want[m] = min(want.get(m, t), t)
        if epoch % every == every - 1:
            stored = spark.read.schema(live.EARLIEST).option("recursiveFileLookup", True).parquet(f"{out}/merged", f"{out}/appended")
            sizes.append(stored.count())
            assert {r.PRECINCT_CODE: r.RECEPTION_TS for r in read_least(spark, out, live.EARLIEST).collect()} == want
    assert max(sizes[2:]) <= 2 * machines + 2 * every * 10
    assert len(_epochs(spark, f"{out}/merged")) <= 2 and len(_epochs(spark, f"{out}/appended")) <= 2 * every
    sink(spark.createDataFrame([(0, start - timedelta(days=1))], live.EARLIEST), 50)
    assert {r.PRECINCT_CODE: r.RECEPTION_TS for r in read_least(spark, out, live.EARLIEST).collect()}[0] == start - timedelta(days=1)


def _derived(spark, folder, orders=400):
    """lineitem, orders and the dimensions below ``folder``, three lines an order."""
    from pyspark.sql import functions as F

    o = spark.range(orders).select(F.col("id").alias("o_orderkey"), (F.col("id") % 150).alias("o_custkey"))
    line = F.explode(F.sequence(F.lit(1), F.lit(3)))
    li = o.select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 10).alias("l_suppkey"), line.alias("l_linenumber"), F.lit(7.0).alias("l_quantity"))
    c = spark.range(150).select(F.col("id").alias("c_custkey"), F.lit("C").alias("c_name"), F.lit(1).alias("c_nationkey"), F.lit("M").alias("c_mktsegment"))
    n = spark.createDataFrame([(1, "N", 2)], "n_nationkey int, n_name string, n_regionkey int")
    r = spark.createDataFrame([(2, "R")], "r_regionkey int, r_name string")
    for name, df in {"orders": o, "lineitem": li, "customer": c, "nation": n, "region": r}.items():
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def test_reception_feed_has_more_files_where_more_tasks_write_it(spark, tmp_path, monkeypatch):
    """Six micro-batches however many files there are, so no task reads a
    fixed share of the table."""
    from canvass import catalog
    from canvass.plans import stats
    from canvass.sources.testdata import election_from_testdata

    _derived(spark, str(tmp_path / "in"))
    monkeypatch.setattr(catalog, "scratch_path", lambda _, name: str(tmp_path / name))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = rows(catalog.stream_reception_rate(spark, str(tmp_path / "in")))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(list((tmp_path / "reception-feed").rglob("*.parquet"))) > 6
    assert len(list((tmp_path / "ckpt" / "commits").glob("[0-9]*"))) == 6
    assert sum(n for _, n in got) == 135 and stats.reception_rate_by_minute(election_from_testdata(spark, str(tmp_path / "in"))).count() > 0


def test_tables_beside_the_results_do_not_derive_the_fact_again(spark, tmp_path, monkeypatch):
    """Candidates, contests and the older drop come from the file written of
    the results, not from another join of lineitem and orders."""
    from canvass import catalog

    _derived(spark, str(tmp_path / "in"))
    written, write = [], catalog.write_delimited_tables

    def watched(tables, root):
        written.extend((root, name, df.inputFiles()) for name, df in tables.items())
        write(tables, root)

    monkeypatch.setattr(catalog, "write_delimited_tables", watched)
    assert catalog.all_queries()["scan_results"](spark, str(tmp_path / "in")).count() == 1080
    assert catalog.stream_snapshot_tally(spark, str(tmp_path / "in")).count() == 27  # nine candidates in each of three contests
    assert len(written) == 15
    joined = [(root.rsplit("/", 1)[1], name) for root, name, files in written if any("/orders.parquet" in f for f in files)]
    assert [name for _, name in joined] == ["results", "results"]
