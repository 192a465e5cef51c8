"""Scale measurement: the sf tables replicated N times, then the full job.

usage: python tools/scale_run.py [sf_dir] [copies] [cpus] [skew] [nobroadcast]

Copy k shifts every precinct code by k * 10,000,000 (results and
precincts alike), so the fact grows N-fold with N-fold distinct precincts
while contests / candidates / provinces stay the same. Copies are made with
a generator (explode of a sequence), not a cross join. With skew=1, a third
of all result rows (chosen by a hash of the row) is moved to ONE precinct
code, the hot-key case the plans are designed for. With nobroadcast=1 the
broadcast thresholds are set to -1, so every join takes the shuffle path
(the path used when the precinct table is too large to broadcast) and AQE's
skew-join split has to handle the hot precinct.

Spark's event log is written to the scratch folder; the output JSON line
reports seconds per step and, per job step, the worst stage's longest and
median task time (a hot key that lands in one task shows up as a large
ratio).
"""

from __future__ import annotations

import glob
import json
import statistics
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, ".")

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from canvass import job  # noqa: E402
from canvass.session import get_spark, scratch_path  # noqa: E402
from canvass.sources.testdata import copies_of, full_tables  # noqa: E402
from canvass.sources.warehouse import ingest, load_warehouse, warehouse_table  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 60
    cpus = int(sys.argv[3]) if len(sys.argv) > 3 else 8
    skew = len(sys.argv) > 4 and sys.argv[4] == "1"
    nobroadcast = len(sys.argv) > 5 and sys.argv[5] == "1"
    from canvass.session import checkpoint_root

    log_dir = tempfile.mkdtemp(prefix="canvass-eventlog-")
    conf = {
        "spark.sql.shuffle.partitions": str(4 * cpus),
        "spark.driver.memory": "16g",
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": log_dir,
        # small-data stand-ins: AQE splits a skewed partition into pieces of
        # the advisory size (64 MB by default), and at this scale the hot
        # precinct's shuffle block is only tens of MB (at 100 TB it is TBs)
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(16 << 20),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(8 << 20),
        # one task's worth of rows at this scale (16M rows over 32 tasks)
        "spark.canvass.skew.rowsPerTask": "500000",
    }
    if nobroadcast:
        conf["spark.sql.autoBroadcastJoinThreshold"] = "-1"
        conf["spark.sql.adaptive.autoBroadcastJoinThreshold"] = "-1"
    spark = get_spark("canvass-scale", f"local[{cpus}]", conf)
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    out: dict[str, object] = {"sf_dir": sf_dir, "copies": copies, "skew": skew, "nobroadcast": nobroadcast}
    sc = spark.sparkContext
    sc.setJobDescription("base-ingest")
    t0 = time.perf_counter()
    base_wh = scratch_path(spark, "scale-base")
    src = full_tables(spark, sf_dir, spread=cpus)
    ingest({"results": src["results"]}, base_wh)
    stored = warehouse_table(spark, base_wh, "results")
    dims = full_tables(spark, sf_dir, results=stored)
    ingest({n: d for n, d in dims.items() if n != "results"}, base_wh)
    out["base_ingest_sec"] = round(time.perf_counter() - t0, 2)

    base = load_warehouse(spark, base_wh)
    res, pre = copies_of(base.results, warehouse_table(spark, base_wh, "precincts"), copies)
    if skew:
        hot = F.abs(F.xxhash64("PRECINCT_CODE", "CONTEST_CODE", "CANDIDATE_CODE", "_k")) % 3 == 0
        res = res.withColumn("PRECINCT_CODE", F.when(hot, F.lit(7)).otherwise(F.col("PRECINCT_CODE")))
    res = res.drop("_k")
    pre = pre.drop("_k")
    wh = scratch_path(spark, "scale-wh")
    sc.setJobDescription("replicate")
    t0 = time.perf_counter()
    ingest(
        {
            "results": res,
            "precincts": pre,
            "candidates": warehouse_table(spark, base_wh, "candidates"),
            "contests": warehouse_table(spark, base_wh, "contests"),
            "parties": warehouse_table(spark, base_wh, "parties"),
        },
        wh,
    )
    out["replicate_sec"] = round(time.perf_counter() - t0, 2)
    e = load_warehouse(spark, wh)
    out["result_rows"] = e.results.count()
    sc.setJobDescription("job")
    t0 = time.perf_counter()
    out["job_reports_sec"] = job.run(spark, e, scratch_path(spark, "scale-out"), ["all"], log=lambda *_: None)
    out["job_all_sec"] = round(time.perf_counter() - t0, 2)
    sc.setJobDescription(None)
    if skew:
        out["hot_precinct_rows"] = e.results.where(F.col("PRECINCT_CODE") == 7).count()
    spark.stop()
    out["stage_tasks"] = stage_task_times(log_dir)
    print(json.dumps(out))


def stage_task_times(log_dir: str) -> dict[str, object]:
    """Per step (job description), the three stages with the longest task:
    task count, longest and median task time in ms."""
    import io

    import zstandard

    tasks: dict[int, list[int]] = defaultdict(list)
    step_of: dict[int, str] = {}
    for path in glob.glob(f"{log_dir}/**/events_*", recursive=True):
        raw = open(path, "rb")
        if path.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(raw)
        with io.TextIOWrapper(raw, encoding="utf-8") as fh:
            for line in fh:
                if '"SparkListenerJobStart"' in line:
                    ev = json.loads(line)
                    step = (ev.get("Properties") or {}).get("spark.job.description") or "other"
                    for sid in ev["Stage IDs"]:
                        step_of[sid] = step
                    continue
                if '"SparkListenerTaskEnd"' not in line:
                    continue
                ev = json.loads(line)
                info = ev["Task Info"]
                tasks[ev["Stage ID"]].append(info["Finish Time"] - info["Launch Time"])
    report: dict[str, object] = {}
    for step in sorted(set(step_of.values())):
        mine = [(sid, d) for sid, d in tasks.items() if step_of.get(sid) == step]
        worst = sorted(mine, key=lambda kv: -max(kv[1]))[:3]
        report[step] = {
            f"stage {sid}": {"tasks": len(d), "max_ms": max(d), "median_ms": int(statistics.median(d))}
            for sid, d in worst
        }
    return report


if __name__ == "__main__":
    main()
