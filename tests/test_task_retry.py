"""A task that fails on its first attempt (as when an executor is lost) is
retried; the silver write and its observed metrics stay exact.  Runs in its
own process because task retries need a ``local[n, maxFailures]`` master."""

import json
import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r'''
import json, sys, tempfile
sys.path.insert(0, sys.argv[1])
sys.path.insert(0, sys.argv[1] + "/tests")
from pyspark import TaskContext
from pyspark.sql import functions as F
from lodgeflow.session import get_session
from lodgeflow.plans.silver import run_bronze_to_silver
from conftest import BOOKING_COLS, booking_row

spark = get_session("local[2,4]", app_name="retry", shuffle_partitions=4)
spark.sparkContext.setLogLevel("WARN")  # task failures are logged at WARN

@F.udf("string")
def flaky(v):  # test-only fault injection: the first attempt of partition 0 dies
    ctx = TaskContext.get()
    if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
        raise RuntimeError("simulated executor loss")
    return v

rows = [booking_row(booking_id=f"B{i % 400}", hotel_name=f"h {i % 7}") for i in range(1000)]
raw = spark.createDataFrame([tuple(r[c] for c in BOOKING_COLS) for r in rows],
                            ", ".join(f"{c} string" for c in BOOKING_COLS)).repartition(4)
raw = raw.withColumn("hotel_name", flaky("hotel_name"))
target = tempfile.mkdtemp(prefix="retry-") + "/silver"
m = run_bronze_to_silver(raw, target)
print(json.dumps({"rows": spark.read.parquet(target).count(), "metrics": m["dedup"]}))
'''


def test_silver_job_survives_a_failed_task():
    with tempfile.NamedTemporaryFile("w", suffix=".py", delete=False) as f:
        f.write(SCRIPT)
    out = subprocess.run([sys.executable, f.name, ROOT], capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "simulated executor loss" in out.stderr  # the fault did fire and was retried
    result = json.loads(out.stdout.strip().splitlines()[-1])
    assert result["rows"] == 400
    assert result["metrics"]["rows_before"] == 1000 and result["metrics"]["rows_after"] == 400


def test_submitter_settings_win_over_defaults():
    script = (
        "import sys; sys.path.insert(0, sys.argv[1])\n"
        "from lodgeflow.session import get_session\n"
        "s = get_session('local[1]', cluster=True)\n"
        "print(s.conf.get('spark.sql.ansi.enabled'), s.conf.get('spark.sql.shuffle.partitions'),"
        " s.conf.get('spark.ui.enabled'))\n")
    env = dict(os.environ, PYSPARK_SUBMIT_ARGS="--conf spark.sql.ansi.enabled=false "
                                               "--conf spark.sql.shuffle.partitions=7 pyspark-shell")
    out = subprocess.run([sys.executable, "-c", script, ROOT], capture_output=True, text=True,
                         timeout=300, env=env)
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.split() == ["false", "7", "false"]  # submitter's values kept; UI default filled in
