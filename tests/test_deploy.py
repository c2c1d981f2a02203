"""Python stages must find this package on the workers even when the driver does not run
from the repository directory (the package is shipped with addPyFile)."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
import __spark_entry__ as e
print("ROWS", e.queries()["q21_messages"](spark, "/root/testdata/sf0.001").count())
spark.stop()
"""


def test_python_stage_from_other_directory(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=str(tmp_path), env=env, capture_output=True,
                         text=True, timeout=600)
    assert "ROWS 2" in out.stdout, out.stderr[-3000:]
