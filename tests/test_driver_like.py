"""The driver imports __spark_entry__ by path from another working
directory: executors must not need to import the package."""

import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util, json
spec = importlib.util.spec_from_file_location("entry_mod", {os.path.join(REPO, "__spark_entry__.py")!r})
E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
out = {{"entry": len(E.entry(spark).collect()),
        "footer_bytes": len(E.queries()["footer_bytes"](spark, "/root/testdata/sf0.001").collect())}}
print(json.dumps(out))
spark.stop()
"""


def test_entry_from_another_directory(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    res = subprocess.run([sys.executable, "-c", SCRIPT], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=600)
    assert res.returncode == 0, res.stderr[-2000:]
    assert json.loads(res.stdout.strip().splitlines()[-1]) == {"entry": 5, "footer_bytes": 14}
