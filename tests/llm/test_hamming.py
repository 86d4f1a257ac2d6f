from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from rollstate.llm import hamming, queries


def test_query_is_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    want = sorted(con.execute(queries.ORACLE_SQL["op9_exact_topk"]).fetchall())
    assert sorted(tuple(r) for r in queries.op9_exact_topk(spark, sf).collect()) == want


@pytest.mark.parametrize("size", [5, 40])
def test_against_brute_force(spark, size):
    rng = random.Random(size)
    rows = [(i, [rng.choice((-1.0, 1.0)) for _ in range(size)]) for i in range(120)]
    rows += [(200 + i, rows[0][1]) for i in range(30)]  # a hot code
    rows += [(300, None), (301, []), (302, [None, float("nan"), 1.0]), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x"))

    def bits(v):
        v = v or []
        return [int(i < len(v) and v[i] is not None and v[i] == v[i] and v[i] > 0) for i in range(size)]

    want = []
    for q, v in rows:
        if q % 20 == 0:
            near = sorted((sum(a != b for a, b in zip(bits(v), bits(w))), i) for i, w in rows)[:6]
            want += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    got = [tuple(r) for r in hamming.search(df, F.col("vec_id") % 20 == 0, 6).collect()]
    assert sorted(got) == sorted(want)


def test_small_and_empty_tables(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [-1.0]), (None, [1.0])], "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in hamming.search(df, F.col("vec_id") == 1, 10).collect())
    assert got == [(1, 1, 1, 0), (1, 2, 2, 1)]
    assert hamming.search(df.limit(0), F.lit(True), 3).count() == 0
