"""Every training-data query and the pipeline on workers that cannot import the package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})  # the driver's path alone: workers start from the environment and the working folder
import __spark_entry__ as entry
from basketry.session import build_session

spark = build_session("local[4]", shuffle_partitions=4, extra_conf={{"spark.ui.showConsoleProgress": "false"}})
spark.sparkContext.setLogLevel("ERROR")


def importable(batches):
    import importlib.util

    import pyarrow as pa
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("basketry") is not None] * b.num_rows)], names=["found"])


assert not any(r.found for r in spark.range(4).mapInArrow(importable, "found boolean").collect())
names = [n for n in entry.queries() if n == "pipeline" or n.startswith("op")]
for n in names:
    assert entry.queries()[n](spark, "/root/testdata/sf0.001").count() > 0, n
print("ran", len(names))
"""


def test_queries_run_on_workers_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    env["PYSPARK_PYTHON"] = sys.executable
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    assert "ran 14" in done.stdout or "ran 11" in done.stdout
