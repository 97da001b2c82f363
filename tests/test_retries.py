"""Tasks that fail and run again change neither rows nor counts."""

import json
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import json, sys
sys.path.insert(0, sys.argv[1])
from pyspark import TaskContext
from pyspark.sql import functions as F
from tablesync import anti_join, flag_restricted, load_table, local_session, read_target

spark = local_session("4,4", **{"spark.checkpoint.dir": sys.argv[2] + "/shared"})
spark.sparkContext.setLogLevel("OFF")

def flaky(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() % 2 == 0:
        raise RuntimeError("task lost")

source = spark.range(0, 20000, 1, 6).selectExpr("id", "if(id % 3 = 0, 7, if(id % 3 = 1, id, null)) AS k")
source = source.mapInPandas(flaky, source.schema)
listed = spark.range(0, 20000, 2, 4).selectExpr("id AS rk")
out = {}
for name, limit in (("broadcast", 1 << 30), ("shuffled", 0)):
    target = f"{sys.argv[2]}/{name}"
    result = load_table(anti_join(source, listed, "k", "rk", limit=limit), target)
    held = read_target(spark, target)
    out[name] = [result.rows_written, held.count(), held.select("id").distinct().count()]
flags = flag_restricted(source, listed, "k", "rk", normalise="plain", limit=0)
out["flagged"] = [flags.count(), flags.where("is_restricted").count()]
print("RESULT " + json.dumps(out))
"""


def test_retried_tasks(tmp_path):
    root = str(Path(__file__).resolve().parent.parent)
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT, root, str(tmp_path)], capture_output=True, text=True, timeout=300, cwd=tmp_path
    )
    lines = [line for line in run.stdout.splitlines() if "RESULT " in line]
    assert lines, run.stderr[-3000:]
    out = json.loads(lines[0].split("RESULT ", 1)[1])
    restricted = sum(1 for i in range(20000) if i % 3 == 1 and i % 2 == 0)
    kept = 20000 - restricted
    assert out == {"broadcast": [kept] * 3, "shuffled": [kept] * 3, "flagged": [20000, restricted]}
