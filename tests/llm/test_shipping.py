"""The registered queries and the pipeline run where the executors do not have this package."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
FOLDER = "/root/testdata/sf0.001"
SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
import __spark_entry__ as entry
spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
for name, query in entry.queries().items():
    if name.startswith("op") or name == "pipeline":
        try:
            print("ran", name, query(spark, {FOLDER!r}).count() > 0)
        except Exception as error:
            print("failed", name, str(error)[-300:])
"""


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver's tables")
def test_tasks_do_not_import_the_package(tmp_path):
    from tallyspan.llm import queries

    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    said = [line for line in done.stdout.splitlines() if line.startswith(("ran", "failed"))]
    assert said == [f"ran {name} True" for name in [*queries.queries(), "pipeline"]], done.stderr[-1000:]
