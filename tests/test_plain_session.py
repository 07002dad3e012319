"""Stateful streaming queries in a session that a caller made without this library's settings, run from elsewhere."""

import os
import subprocess
import sys

import duckdb
import pandas as pd
import pytest
from test_registry import TABLES, rows

from spanlight.plans.registry import oracle

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
root, data, name, work = sys.argv[1:]
sys.path.insert(0, root)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config(map={
    "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC",
    "spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": work + "/shared"}).getOrCreate()
import __spark_entry__ as entry
store = "spark.sql.streaming.stateStore.providerClass"
before = spark.conf.get(store, None)
entry.queries()[name](spark, data).toPandas().to_parquet(work + "/got.parquet")
assert spark.conf.get(store, None) == before, "the session's own setting has changed"
"""


@pytest.mark.parametrize("name", ["stream_budget_state", "stream_alert_life"])
def test_state_needs_no_setting_of_the_session(name, data_dir, tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", SCRIPT, ROOT, data_dir, name, str(tmp_path)], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    assert run.returncode == 0, run.stderr[-3000:]
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data_dir}/{t}.parquet'")
    assert rows(pd.read_parquet(tmp_path / "got.parquet")) == rows(con.sql(oracle(name)).df())
