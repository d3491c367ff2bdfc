"""The registered queries where only the driver has the package."""

import os
import subprocess
import sys

import stowage

PROGRAM = """
import sys
sys.path.insert(0, sys.argv[1])
from stowage.session import local_session
import __spark_entry__ as entry
spark = local_session(4, 4, "bare")
spark.sparkContext.setLogLevel("ERROR")
from stowage.llm.queries import QUERIES
for name in QUERIES:
    QUERIES[name](spark, sys.argv[2]).write.format("noop").mode("overwrite").save()
    print("ran", name, flush=True)
"""


def test_executors_need_no_package(spark, sf_dir, tmp_path):
    """Python workers start in another folder and without a path to the package; functions reach them by value."""
    repository = os.path.dirname(os.path.dirname(os.path.abspath(stowage.__file__)))
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONDONTWRITEBYTECODE": "1"}
    done = subprocess.run([sys.executable, "-c", PROGRAM, repository, sf_dir], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=900)
    from stowage.llm.queries import QUERIES

    assert [line.split()[1] for line in done.stdout.splitlines() if line.startswith("ran ")] == list(QUERIES), done.stderr[-3000:]
