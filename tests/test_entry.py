"""The driver contract: entry smoke check and query/oracle registration."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import __spark_entry__ as entry
from rollstate import catalog


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["user_id", "ts", "value"]


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(catalog.QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_match_oracles_small(spark):
    """Every registered query against its SQL oracle at sf0.001 (the driver checks sf0.01)."""
    import duckdb

    from shared import SF_SMALL, as_set

    con = duckdb.connect()
    for t in ("events", "lineitem", "customer", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    oracles = entry.oracle_sql()
    queries = entry.queries()

    def run(name):
        df = queries[name](spark, SF_SMALL)
        return df.columns, as_set(df.collect())

    # Small jobs mostly wait for their own planning, so several queries share the session.
    with ThreadPoolExecutor(4) as pool:
        results = dict(zip(catalog.QUERIES, pool.map(run, catalog.QUERIES)))
    for name, (s_cols, got) in results.items():
        rel = con.sql(oracles[name])
        o_cols = rel.columns
        assert sorted(s_cols) == sorted(o_cols), name
        order = [o_cols.index(c) for c in s_cols]
        want = [tuple(r[i] for i in order) for r in rel.fetchall()]
        assert got == as_set(want), name
