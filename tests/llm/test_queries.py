"""Which queries there are, which have SQL, and that tasks run without this package."""

import os
import subprocess
import sys
from pathlib import Path

from replicheck.llm.oracle import WITHOUT_SQL, oracle_sql
from replicheck.llm.queries import QUERIES


def test_every_query_has_sql_or_is_named_as_being_without():
    assert set(QUERIES) == set(oracle_sql()) | WITHOUT_SQL
    assert not set(oracle_sql()) & WITHOUT_SQL
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))

ELSEWHERE = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from replicheck.llm.queries import QUERIES
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {work!r}).getOrCreate())
for name in sorted(QUERIES):
    print(name, QUERIES[name](spark, "/root/testdata/sf0.001").count())
"""


def test_tasks_do_not_need_the_package(tmp_path):
    """Executors have the libraries, but neither this package nor its folder."""
    root = str(Path(__file__).resolve().parents[2])
    code = ELSEWHERE.format(root=root, work=str(tmp_path))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
    assert len(done.stdout.split()) == 2 * len(QUERIES)
