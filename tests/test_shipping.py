"""Jobs run where the executors do not have this package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
import tallyspan as ts
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
rows = [(i, [float(i), float(i % 3)]) for i in range(20)]
points = ts.points_from_table(spark.createDataFrame(rows, "point_id bigint, features array<double>"))
print("solution", len(ts.diversity_max(points, 4, 2).collect()))
"""


def test_tasks_do_not_import_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "solution 4" in done.stdout, done.stderr[-2000:]
