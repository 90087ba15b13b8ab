"""Run queries the way an outside driver does: a fresh process, another
working directory, a default SparkSession.  Catches code that only works
when Python workers can import the package from the repo root."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as E
assert E.entry(spark).count() > 0
for name in ("vcf_samples", "vcf_to_calls"):
    assert E.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("DRIVER-OK")
"""


def test_queries_from_foreign_cwd():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tempfile.mkdtemp(), env=env,
                       capture_output=True, text=True, timeout=600)
    assert "DRIVER-OK" in r.stdout, r.stderr[-3000:]
