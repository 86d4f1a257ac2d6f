from __future__ import annotations

import itertools

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollstate.llm import line_dedup, packing, queries

SF = "/root/testdata/sf0.001"


def test_line_query_is_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = sorted(con.execute(queries.ORACLE_SQL["op4_line_dedup"]).fetchall())
    got = sorted((r.doc_id, r.source, r.text, r.n_dropped) for r in queries.op4_line_dedup(spark, SF).collect())
    assert got == want


def test_boilerplate_by_site(spark):
    rows = [(i, f"Menu \nstory {i}\n\nshared" if i < 6 else f"story {i}\nshared", "a") for i in range(60)]
    rows += [(100 + i, f"Menu\nother {i}", "b") for i in range(4)]  # too few pages
    rows += [(200 + i, "only copies\nof one page", "c") for i in range(50)]  # one distinct page
    rows += [(300, "Menu\nshared", None), (301, None, "a"), (302, "", "a"), (303, "Menu", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("N_Dropped", F.lit("x"))
    out = {r.doc_id: (r.text, r.n_dropped) for r in line_dedup.drop_lines(df, ratio=0.1, min_pages=5).collect()}
    assert out[0] == ("story 0\n", 2) and out[30] == ("story 30", 1)  # 7 of 62 pages have Menu
    assert out[100] == ("Menu\nother 0", 0) and out[200] == ("only copies\nof one page", 0)
    assert out[300] == ("Menu\nshared", 0) and out[301] == (None, 0) and out[302] == ("", 0) and out[303] == ("", 1)
    assert line_dedup.drop_lines(df.limit(0)).count() == 0


def test_long_lines_go_at_small_shares(spark):
    footer, passage = "This work is licensed under version 3 of the licence.", "planted words of a passage " * 12
    story = lambda i: "\n".join(f"line {j} of story {i} is told here and nowhere else" for j in range(4))
    rows = [(i, story(i) + ("\n" + footer if i < 4 else "") + (f"\n{passage}" if 10 <= i < 13 else ""), "hot") for i in range(2_000)]
    rows += [(5_000 + i, f"{story(5_000 + i)}\n{footer}", "small") for i in range(3)]
    rows += [(6_000 + i, story(6_000 + i) + "\nWell." * (i < 4), "hot") for i in range(10)]  # short and rare
    rows += [(7_000 + i, story(7_000) + f"\nedited {i}", "hot") for i in range(6)]  # near copies
    df = spark.createDataFrame(rows + [(8_000, None, "hot"), (8_001, footer, None)], "doc_id long, text string, source string")
    out = {r.doc_id: (r.text, r.n_dropped) for r in line_dedup.drop_lines(df).collect()}
    planted = [*range(4), *range(10, 13), 5_000, 5_001, 5_002]
    assert all(out[i] == (story(i), 1) for i in planted)
    assert all(out[i] == (t, 0) for i, t, _ in rows if i not in planted)
    assert out[8_000] == (None, 0) and out[8_001] == (footer, 0) and len(out) == len(rows) + 2
    assert line_dedup.drop_lines(df.limit(0)).count() == 0


def test_line_edge_rows(edge_docs):
    out = line_dedup.drop_lines(edge_docs, min_pages=1, ratio=0.9)
    assert out.count() == edge_docs.count() and out.filter("n_dropped > 0").count() == 0


def test_no_python_in_native_plans(spark):
    for query in (queries.op2_document_fingerprints, queries.op4_line_dedup):
        plan = query(spark, SF)._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 9), min_size=1, max_size=8), st.integers(1, 4))
def test_borders_have_least_padding(histogram, k):
    lengths = sorted(histogram)
    counts = [histogram[n] for n in lengths]

    def padding(borders):
        return sum((next(b for b in sorted(borders) if b >= n) - n) * c for n, c in histogram.items())

    best = min(padding(s) for s in itertools.combinations(lengths, min(k, len(lengths))) if max(s) == lengths[-1])
    got = packing.best_borders(lengths, counts, k)
    assert got.padding == best == padding(got.borders) and len(got.borders) <= k


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_batches(spark, buckets):
    df = spark.range(500).select((F.col("id") % 400).alias("doc_id"), ((F.col("id") * 37) % 211).alias("n"), F.lit(1).alias("batch_id"))
    rows = packing.pack(df, "doc_id", F.col("n"), buckets, budget=1_000).collect()
    assert len(rows) == 500 and len({r.bucket_len for r in rows}) <= buckets
    batches: dict = {}
    for r in rows:
        assert r.length <= r.bucket_len and r.padding == r.bucket_len - max(r.length, 1)
        batches.setdefault((r.bucket_len, r.batch_id), []).append(r.slot)
    short = {}
    for (size, _), slots in batches.items():
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= max(1, 1_000 // size)
        short[size] = short.get(size, 0) + (len(slots) < max(1, 1_000 // size))
    assert all(n <= 1 for n in short.values())  # only a bucket's last batch is not full


def test_packing_edge_rows(spark, edge_docs, no_docs):
    rows = packing.pack(edge_docs, "doc_id", queries.word_count()).collect()
    assert len(rows) == edge_docs.count()
    nulls = spark.createDataFrame([(1, None), (2, 10**9), (None, 3)], "doc_id long, n long")
    got = {r.doc_id: (r.length, r.bucket_len) for r in packing.pack(nulls, "doc_id", F.col("n"), 2).collect()}
    assert got[1][0] == 0 and got[2][1] >= 10**9 and got[None][0] == 3
    assert packing.pack(no_docs, "doc_id", queries.word_count()).count() == 0


def test_rounding_bounds_the_histogram(spark):
    df = spark.range(1, 200_000).select("id", packing.rounded(F.col("id")).alias("r"))
    worst = df.agg(F.max((F.col("r") - F.col("id")) / F.col("id")), F.countDistinct("r"), F.min(F.col("r") - F.col("id"))).first()
    assert worst[0] <= 1 / packing.EXACT and worst[1] <= packing.EXACT * 8 and worst[2] == 0
