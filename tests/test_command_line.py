"""The jobs as separate processes over the same folder."""

import os
import subprocess
import sys

from conftest import ROOT
from tripflow.session import scratch
from tripflow.sources.events import raw_trips


def test_jobs_one_after_another(spark, events, folder):
    raw_trips(events).drop("event_id").repartition(2).write.parquet(f"{folder}/raw")
    place = scratch(spark, "cli")

    def run(*words):
        command = [sys.executable, "-m", "tripflow", "--location", place, *words]
        env = {**os.environ, "PYSPARK_SUBMIT_ARGS": "--conf spark.ui.enabled=false pyspark-shell"}
        done = subprocess.run(
            command, cwd=ROOT, env=env, capture_output=True, text=True, timeout=240, check=True
        )
        return done.stdout

    assert "7890" in run("ingest", f"{folder}/raw")
    counts = run("aggregate")
    assert "7890" in counts and "720" in counts and "146" in counts
    assert "7890" in run("sql", "SELECT sum(total_trips) AS n FROM taxi_hourly_agg")
    assert len(run("sql", "SELECT * FROM taxi_hourly_agg").splitlines()) == 721
    run("sql", "SELECT * FROM taxi_hourly_agg", "--out", f"{folder}/out")
    assert spark.read.parquet(f"{folder}/out").count() == 720
