"""Delimited sources (explicit schema, zero-padded codes, FAILFAST) and sinks."""

import os

import pytest
from pyspark.sql import functions as F

from canvass.session import scratch_path
from canvass.sinks import read_csv, write_csv, write_partitioned_csv
from canvass.sources import load_election, merged_results

FILES = {
    "candidates.csv": "CONTEST_CODE|CANDIDATE_CODE|CANDIDATE_NAME\n00199000|0019900001|\"MIRA SOLT (XYZ)\"\n",
    "contests.csv": "CONTEST_CODE|CONTEST_NAME\n00199000|FIRST OFFICE\n",
    "parties.csv": "PARTIES_CODE|PARTIES_NAME|PARTIES_ALIAS\n009|GREY LIST|GRL\n",
    "precincts.csv": (
        "VCM_ID|REG_NAME|PRV_NAME|MUN_NAME|BRGY_NAME|POLLPLACE|CLUSTERED_PREC|REGISTERED_VOTERS\n"
        "00000031|EAST WING|HIGH COAST|LOWTOWN|QUAY SIDE|HALL 4|00000007|120\n"
    ),
    "results.csv": (
        "PRECINCT_CODE|CONTEST_CODE|CANDIDATE_CODE|PARTY_CODE|VOTES_AMOUNT|TOTALIZATION_ORDER|NUMBER_VOTERS"
        "|UNDERVOTE|OVERVOTE|RECEPTION_DATE\n"
        "00000007|00199000|0019900001|0000000009|9|2|100|3|1|05/09/2022 - 09:41:30 PM\n"
    ),
}


def _write(root, files):
    os.makedirs(root, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(root, name), "w") as f:
            f.write(text)


def test_load_election_reads_padded_codes_and_prunes(spark, tmp_path):
    _write(str(tmp_path), FILES)
    e = load_election(spark, str(tmp_path))
    assert e.candidates.first().asDict() == {
        "CONTEST_CODE": 199000,
        "CANDIDATE_CODE": 19900001,
        "CANDIDATE_NAME": "MIRA SOLT (XYZ)",
    }
    assert e.precincts.columns == ["VCM_ID", "REG_NAME", "PRV_NAME", "CLUSTERED_PREC", "REGISTERED_VOTERS"]
    assert e.contests.columns == ["CONTEST_CODE"]
    m = merged_results(e).first()
    assert (m["PRV_NAME"], m["REGISTERED_VOTERS"], m["VOTES_AMOUNT"]) == ("HIGH COAST", 120, 9)
    plan = e.precincts.select("PRV_NAME")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<PRV_NAME:string>" in plan


def test_malformed_row_fails_fast(spark, tmp_path):
    bad = dict(FILES)
    bad["results.csv"] = FILES["results.csv"].replace("|9|2|", "|x|2|")
    _write(str(tmp_path), bad)
    with pytest.raises(Exception):
        load_election(spark, str(tmp_path)).results.collect()


def test_csv_keeps_outer_spaces(spark):
    """The hour of the text slices is "- " on the documented layout."""
    df = spark.createDataFrame([("- ", " x", 1)], "h string, p string, k bigint")
    path = scratch_path(spark, "t-spaces")
    write_csv(df, path)
    assert read_csv(spark, path, df.schema).collect() == df.collect()
    write_partitioned_csv(df, path, ["k"])
    assert read_csv(spark, path, df.schema).collect() == df.collect()


def test_csv_roundtrip_keeps_inf_nan_null(spark):
    df = spark.createDataFrame([(1, 1.5), (2, float("inf")), (3, float("nan")), (4, None)], "k bigint, v double")
    path = scratch_path(spark, "t-roundtrip")
    write_csv(df, path)
    back = {r["k"]: r["v"] for r in read_csv(spark, path, df.schema).collect()}
    assert back[1] == 1.5 and back[2] == float("inf") and back[3] != back[3] and back[4] is None


def test_partitioned_write_one_folder_per_key_sorted(spark):
    df = spark.createDataFrame(
        [(199000, "HIGH COAST", "A", 5), (199000, "HIGH COAST", "B", 9), (299000, None, "C", 1)],
        "CONTEST_CODE bigint, PRV_KEY string, CANDIDATE_NAME string, VOTES_AMOUNT bigint",
    )
    path = scratch_path(spark, "t-part")
    write_partitioned_csv(df, path, ["CONTEST_CODE", "PRV_KEY"], [F.col("VOTES_AMOUNT").desc()])
    local = path.replace("file:", "")
    def ls(d):
        return sorted(f for f in os.listdir(d) if not f.startswith("."))

    assert [f for f in ls(local) if f != "_SUCCESS"] == ["CONTEST_CODE=199000", "CONTEST_CODE=299000"]
    assert ls(f"{local}/CONTEST_CODE=299000") == ["PRV_KEY=__HIVE_DEFAULT_PARTITION__"]
    folder = f"{local}/CONTEST_CODE=199000/PRV_KEY=HIGH COAST"
    part = [f for f in os.listdir(folder) if f.endswith(".csv")]
    assert len(part) == 1
    with open(f"{folder}/{part[0]}") as fh:
        assert fh.read().splitlines() == ["CANDIDATE_NAME,VOTES_AMOUNT", "B,9", "A,5"]


def test_ingest_to_parquet_gives_the_same_reports(spark):
    from canvass.plans import stats, tallies
    from canvass.sources.testdata import election_from_testdata, full_tables
    from canvass.sources.warehouse import ingest, load_warehouse
    from tests.conftest import rows

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver test tables not present")
    wh = scratch_path(spark, "t-wh")
    ingest(full_tables(spark, sf), wh, spread=4)
    stored, direct = load_warehouse(spark, wh), election_from_testdata(spark, sf)
    assert stored.results.count() == direct.results.count()
    for report in (tallies.tally_national_province, tallies.tally_local, stats.map_stats, stats.vcm_received):
        assert rows(report(stored)) == rows(report(direct))


def test_export_flat_unescapes_partition_values(spark, tmp_path):
    from canvass.sinks import export_flat

    df = spark.createDataFrame(
        [(199000, "SUR: NORTH", "A", 3, 30.0)],
        "CONTEST_CODE bigint, PRV_KEY string, CANDIDATE_NAME string, VOTES_AMOUNT bigint, PERCENTAGE double",
    )
    out = scratch_path(spark, "t-escape")
    write_partitioned_csv(df, f"{out}/province", ["CONTEST_CODE", "PRV_KEY"], [F.col("VOTES_AMOUNT").desc()])
    local = out.replace("file:", "")
    assert os.listdir(f"{local}/province/CONTEST_CODE=199000")[0].startswith("PRV_KEY=SUR%3A")
    names = export_flat(out, str(tmp_path / "flat"))
    assert names == ["SUR: NORTH_199000.csv"]
    with open(tmp_path / "flat" / "SUR: NORTH_199000.csv") as fh:
        assert fh.read().splitlines() == ["CANDIDATE_NAME,VOTES_AMOUNT,PERCENTAGE", "A,3,30.0"]


@pytest.mark.parametrize(
    "header, row, error",
    [
        ("CANDIDATE_CODE|NOTE|CANDIDATE_NAME|CONTEST_CODE", "5|x|ANN|0019", None),
        ("CANDIDATE_CODE|CANDIDATE_NAME", "5|ANN", "no single column CONTEST_CODE"),
        ("CONTEST_CODE|CANDIDATE_CODE|CANDIDATE_NAME|CONTEST_CODE", "1|5|ANN|2", "no single column CONTEST_CODE"),
    ],
)
def test_columns_are_found_by_header_name(spark, tmp_path, header, row, error):
    from canvass.sources.delimited import read_table

    path = tmp_path / "candidates.csv"
    path.write_text(f"{header}\n{row}\n")
    if error:
        with pytest.raises(ValueError, match=error):
            read_table(spark, str(path), "candidates")
    else:
        assert read_table(spark, str(path), "candidates").collect() == [(19, 5, "ANN")]


@pytest.mark.parametrize("bad", ["1|5", "1|5|ANN|more"])
def test_ragged_rows_fail_whichever_column_is_read(spark, tmp_path, bad):
    from canvass.sources.delimited import read_table

    path = tmp_path / "candidates.csv"
    path.write_text(f"CONTEST_CODE|CANDIDATE_CODE|CANDIDATE_NAME\n1|4|BOB\n{bad}\n")
    for cols in (["CONTEST_CODE"], ["CANDIDATE_NAME", "CANDIDATE_CODE"]):
        with pytest.raises(Exception, match="MALFORMED|Malformed"):
            read_table(spark, str(path), "candidates").select(*cols).collect()
