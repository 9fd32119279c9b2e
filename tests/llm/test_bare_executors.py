"""Executors need no copy of the package: every query runs from another folder, without PYTHONPATH."""

import os
import subprocess
import sys
from pathlib import Path

REPO = str(Path(__file__).resolve().parents[2])
SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})  # the driver's only; workers are started without it
from tallyframe.session import build_session
import tallyframe.llm.queries as llm
spark = build_session("bare", "local[4]", spark__ui__enabled="false", spark__sql__shuffle__partitions="4")
spark.sparkContext.setLogLevel("ERROR")
try:
    spark.range(1).rdd.map(lambda r: __import__("tallyframe")).count()
except Exception:
    print("BARE")
for name, query in llm.QUERIES.items():
    query(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    print("RAN", name, flush=True)
"""


def test_all_queries_run_on_executors_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    ran = [line.split()[1] for line in done.stdout.splitlines() if line.startswith("RAN")]
    assert "BARE" in done.stdout and len(ran) == 14, done.stderr[-3000:]
