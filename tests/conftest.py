from __future__ import annotations

import os
import sys
import tempfile

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from rollstate import session  # noqa: E402
from shared import SF_SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session.builder("local[8]", 4).config("spark.driver.memory", "4g").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rollstate-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    return session.scratch_dir(spark, "test")


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in ("events", "lineitem", "customer", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
