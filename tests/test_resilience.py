"""Failed tasks are retried and the result stays exact.

Executor loss cannot be staged in local mode (there is one executor), but
what Spark does after it, re-running the lost tasks from lineage, can: here
the first attempt of every lineitem scan task fails. The query keeps no
state outside Spark and sums exactly, so the retried run must equal the
oracle bit for bit. It runs in its own process, because a task may only be
retried when the master is ``local[N,maxFailures]``.
"""

import json
import subprocess
import sys
from pathlib import Path

from conftest import TESTDATA

ROOT = Path(__file__).resolve().parents[1]

SCRIPT = r"""
import json, sys
sys.path[:0] = [sys.argv[1], sys.argv[1] + "/tests"]
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from conftest import duck, rows_of, sorted_rows
from strata.plans.revenue import oracle_sql, revenue_by_region
from strata.sources import read_table

spark = (SparkSession.builder.master("local[4,4]")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.autoBroadcastJoinThreshold", "-1")
         .getOrCreate())
spark.sparkContext.setLogLevel("OFF")

@F.udf("boolean")
def first_attempt_fails(_):
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return True

root = sys.argv[2]
tables = {n: read_table(spark, root, n) for n in ("lineitem", "orders", "customer", "nation", "region")}
tables["lineitem"] = tables["lineitem"].where(first_attempt_fails("l_orderkey"))
sc = spark.sparkContext
sc.setJobGroup("resilience", "query with failing tasks")
got = rows_of(revenue_by_region(**tables))
st = sc.statusTracker()
failed = sum(
    st.getStageInfo(s).numFailedTasks
    for j in st.getJobIdsForGroup("resilience")
    for s in st.getJobInfo(j).stageIds
    if st.getStageInfo(s)
)
expected = sorted_rows(duck(root).execute(oracle_sql()).fetchall())
print(json.dumps({"equal": got == expected, "rows": len(got), "failed_tasks": failed}))
"""


def test_query_survives_failed_tasks(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(SCRIPT)
    proc = subprocess.run(
        [sys.executable, str(script), str(ROOT), str(TESTDATA / "sf0.01")],
        capture_output=True,
        text=True,
        timeout=600,
    )
    assert proc.returncode == 0, proc.stderr[-3000:]
    result = json.loads(proc.stdout.strip().splitlines()[-1])
    assert result["failed_tasks"] >= 1
    assert result["equal"] and result["rows"] == 25
