"""Layout and versions of the ingested copy."""

from canvass import schema as S
from canvass.functions import is_national
from canvass.plans import tallies
from canvass.session import scratch_path
from canvass.sources import warehouse
from canvass.sources.bundle import merged_results
from canvass.sources.warehouse import ingest, load_warehouse, warehouse_table
from tests.conftest import make_election, result_row, rows


def tables(spark, votes=3):
    results = [result_row(i % 9, c, 100 * c + i % 3, votes) for c in (199000, 399000, 2000001, 2000002) for i in range(30)]
    e = make_election(spark, [*results, result_row(1, None, None, 1)], [(i, "R", f"P{i % 2}", 9) for i in range(9)], contests=[199000])
    pre = e.precincts.selectExpr("*", "'m' MUN_NAME", "'b' BRGY_NAME", "'s' POLLPLACE").select(*S.TABLES["precincts"].names)
    con = e.contests.selectExpr("CONTEST_CODE", "'c' CONTEST_NAME")
    return {"results": e.results, "candidates": e.candidates, "precincts": pre, "contests": con, "parties": e.parties}


def test_national_filter_reads_only_national_folders(spark):
    t, root = tables(spark), scratch_path(spark, "t-layout")
    ingest(t, root)
    e = load_warehouse(spark, root)
    assert rows(e.results) == rows(t["results"])
    national = merged_results(e).where(is_national()).select("PRV_NAME", "CONTEST_CODE", "CANDIDATE_CODE", "VOTES_AMOUNT")
    plan = national._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [CONTEST_CODE" in plan and "199000" in plan
    read = e.results.where(is_national())
    assert read.count() == 60
    folders = {f.split("CONTEST_CODE=")[1].split("/")[0] for f in e.results.inputFiles()}
    assert folders == {"199000", "399000", "2000001", "2000002", "__HIVE_DEFAULT_PARTITION__"}


def test_rows_are_sorted_by_precinct_in_each_file(spark):
    root = scratch_path(spark, "t-sorted")
    ingest({"results": tables(spark)["results"]}, root, spread=3)
    for f in warehouse_table(spark, root, "results").inputFiles():
        codes = [r.PRECINCT_CODE for r in spark.read.parquet(f).collect()]
        assert codes == sorted(codes)


def test_a_reader_keeps_the_old_copy_during_a_second_ingest(spark, monkeypatch):
    root = scratch_path(spark, "t-versions")
    ingest(tables(spark, votes=3), root)
    before = load_warehouse(spark, root)
    total = lambda e: rows(tallies.votes_by_contest_candidate(e))
    old = total(before)
    seen = []
    write = warehouse._write

    def watched(df, path, name, spread):
        write(df, path, name, spread)
        seen.append(total(load_warehouse(spark, root)) == old)  # not one table is swapped before all are written

    monkeypatch.setattr(warehouse, "_write", watched)
    ingest(tables(spark, votes=4), root)
    assert seen == [True] * 5
    assert total(before) == old  # the folders it opened are still there
    assert total(load_warehouse(spark, root)) != old


def test_a_failed_ingest_leaves_the_current_copy(spark, monkeypatch):
    root = scratch_path(spark, "t-failed")
    ingest(tables(spark), root)
    old = rows(load_warehouse(spark, root).results)
    bad = {**tables(spark), "precincts": spark.range(1).selectExpr("raise_error('no') AS x")}
    try:
        ingest(bad, root)
    except Exception as e:  # noqa: BLE001
        assert "no" in str(e)
    else:
        raise AssertionError("expected the ingest to fail")
    assert rows(load_warehouse(spark, root).results) == old


def test_versions_before_the_last_two_are_deleted(spark):
    from canvass.session import hadoop_path

    root = scratch_path(spark, "t-trim")
    for votes in (1, 2, 3, 4):
        ingest({"results": tables(spark, votes)["results"]}, root)
    fs, p = hadoop_path(spark, f"{root}/data")
    assert len(fs.listStatus(p)) == 2
    assert load_warehouse_results(spark, root) == 4


def load_warehouse_results(spark, root):
    return warehouse_table(spark, root, "results").agg({"VOTES_AMOUNT": "max"}).first()[0]


def test_empty_results_and_plain_folders(spark):
    root = scratch_path(spark, "t-empty")
    ingest({"results": tables(spark)["results"].limit(0)}, root)
    assert warehouse_table(spark, root, "results").count() == 0
    plain = scratch_path(spark, "t-plain")
    tables(spark)["candidates"].write.parquet(f"{plain}/candidates")
    assert warehouse_table(spark, plain, "candidates").count() > 0
