"""Python workers import the package wherever the driver process was started."""

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
q = E.queries()
assert q["page_text"](spark, "/root/testdata/sf0.001").count() > 0          # pandas UDF
assert q["kmeans_topics"](spark, "/root/testdata/sf0.001").count() > 0      # mapInPandas
print("WORKERS-OK")
"""


def test_workers_import_package_from_any_directory():
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tempfile.mkdtemp(prefix="tl-elsewhere-"), capture_output=True, text=True, timeout=600
    )
    assert "WORKERS-OK" in out.stdout, out.stderr[-2000:]
