"""The jobs' command line, in a process whose workers only get what the job ships."""

from __future__ import annotations

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(tmp_path, code):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    # only the driver's own path knows the package
    head = (f"import sys; sys.path.insert(0, {ROOT!r})\n"
            "from wayfare.session import build_session\n"
            "spark = build_session('job', 'local[2]', **{'spark.ui.enabled': 'false', "
            f"'spark.sql.shuffle.partitions': '2', 'spark.sql.warehouse.dir': {str(tmp_path / 'warehouse')!r}}})\n")
    done = subprocess.run([sys.executable, "-c", head + textwrap.dedent(code)], cwd=tmp_path, env=env,
                          capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    return done.stdout


def test_workers_get_the_package(tmp_path):
    out = run(tmp_path, """
        from wayfare.operators import matching
        pings = spark.createDataFrame([("X", 1, 1, 1372636853, 33.6, -7.6, 1.0, "AVAILABLE")], "city string, taxi_id int, "
            "zone_id int, event_time bigint, latitude double, longitude double, speed double, status string")
        requests = spark.createDataFrame([("X", "t", 5, 1, None, 1372636854000, "A")], "city string, trip_id string, "
            "rider_id int, origin_zone int, destination_zone int, requested_at bigint, call_type string")
        print([tuple(r) for r in matching.match_replay(pings, requests).select("trip_id", "status").collect()])
        """)
    assert "[('t', 'MATCHED_EXACT')]" in out


def test_curate_kpis_train_and_score(tmp_path):
    out = run(tmp_path, """
        from wayfare import jobs, schemas
        from wayfare.sources import files, serving_tables
        line = "[[-8.63, 41.17], [-8.62, 41.15], [-8.63, 41.16]]"
        history = spark.createDataFrame([(str(i), "A", None, None, i % 9, 1372636853 + i * 2400, "A", False, line)
                                         for i in range(2000)], schemas.TRIP_HISTORY)
        files.export_csv(history, "raw")
        jobs.main(["curate", "history=raw", "into=trips"])
        jobs.main(["kpis", "trips=trips", "table=demand", "city=X"])
        jobs.main(["train", "trips=trips", "features=matrix", "into=model"])
        spark.createDataFrame([(1, "2013-08-01T10:00:00"), (1, "never")], "zone_id int, datetime string").write.parquet("ask")
        jobs.main(["score", "requests=ask", "trips=trips", "model=model", "into=out"])
        print("WEEKS", serving_tables.read_serving(spark, "demand", "demand_zones").count() > 3)
        print("ANSWERS", sorted((r.predicted_demand is not None, r.reason) for r in spark.read.parquet("out").collect()))
        """)
    assert "WEEKS True" in out and "ANSWERS [(False, 'unreadable:datetime'), (True, None)]" in out


def test_unknown_job_explains(tmp_path):
    done = subprocess.run([sys.executable, "-m", "wayfare.jobs", "nothing"], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode != 0 and "wayfare demand" in done.stderr
