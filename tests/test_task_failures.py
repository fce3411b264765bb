"""Exports and row numbers stay exact when tasks fail half-way and run again."""

import json
import subprocess
import sys

SCRIPT = """
import json, sys
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, sys.argv[1])
from lakequery.operators.numbering import with_batch_id
from lakequery.sinks.dataset import write_dataset

spark = (
    SparkSession.builder.master("local[4,4]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4")
    .config("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    .config("spark.checkpoint.dir", sys.argv[2] + "/scratch")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")


def flaky(batches):
    task, rows = TaskContext.get(), 0
    for batch in batches:
        yield batch
        rows += batch.num_rows
        if task.attemptNumber() == 0 and task.partitionId() % 2 == 0 and rows > 1000:
            raise RuntimeError("lost")


ids = spark.range(0, 16_000, 1, 8).mapInArrow(flaky, "id long")
found = {}
for name in ("parquet", "xlsx"):
    found[name] = write_dataset(ids, name, sys.argv[2] + "/" + name).row_count
found["read"] = spark.read.parquet(sys.argv[2] + "/parquet").agg(F.count("id"), F.countDistinct("id")).first()
numbered = with_batch_id(ids, 200, ["id"])
found["in order"] = numbered.where("id = row_ord").count()
print(json.dumps(found))
"""


def test_rerun_tasks(tmp_path):
    root = __file__.rsplit("/tests/", 1)[0]
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, root, str(tmp_path)], capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert json.loads(done.stdout.strip().splitlines()[-1]) == {
        "parquet": 16_000,
        "xlsx": 16_000,
        "read": [16_000, 16_000],
        "in order": 16_000,
    }
    assert len(list((tmp_path / "xlsx").glob("*.xlsx"))) == 8
