"""The driver's contract, also from another working folder."""

import os
import subprocess
import sys

import __spark_entry__

CODE = """
import sys; sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
import __spark_entry__
print("ROWS", len(__spark_entry__.entry(spark).collect()))
"""


def test_registered_queries_have_sql():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    from geoweave import queries

    assert set(queries.queries()) == set(queries.oracle_sql())


def test_entry_from_another_folder(tmp_path):
    root = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE.format(root=root)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in done.stdout and int(done.stdout.split("ROWS")[1]) > 0, done.stderr[-2000:]
