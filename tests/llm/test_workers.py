"""All corpus queries where only the driver has the package."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
from tidemark.session import local_session

spark = local_session(4, partitions=4, memory="4g")

def importable(batches):
    import importlib.util
    import pyarrow as pa
    for _ in batches:
        yield pa.RecordBatch.from_pydict({"found": [importlib.util.find_spec("tidemark") is not None]})

assert not spark.range(1).mapInArrow(importable, "found boolean").head()[0], "the workers have the package"
for name, query in entry.queries().items():
    if name.startswith("op") or name == "pipeline":
        query(spark, sys.argv[2]).write.format("noop").mode("overwrite").save()
        print("ran", name, flush=True)
"""


def test_queries_run_where_workers_lack_the_package(sf, tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT, repo, os.path.abspath(sf)], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.count("ran op") == 13 and "ran pipeline" in done.stdout
