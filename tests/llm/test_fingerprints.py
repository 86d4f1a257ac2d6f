from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from rollstate.llm import queries, spotsigs


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    got = {r.doc_id: r for r in queries.op2_document_fingerprints(spark, sf).collect()}
    assert len(got) == len(texts)
    prints = {i: set(r.fingerprint.split()) for i, r in got.items()}
    for n, (i, text) in enumerate(texts):
        after, following = texts[(n + 1) % len(texts)]
        k = len(text) // 4
        edited = text[: len(text) - k] + following[:k]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        a, b, c = prints[i], set(r.edited_fingerprint.split()), prints[after]
        for near, other in ((r.near_edited, b), (r.near_next, c)):
            exact = len(a & other) / len(a | other) if a | other else 1.0
            assert abs(near - exact) < 1e-9 or (near == 0 and exact < spotsigs.PRUNE_BELOW)


def test_chains_follow_anchors_over_other_common_words(spark):
    df = spark.createDataFrame([("The cat of the house sat by a door",)], "text string")
    n = spotsigs.signatures(df, "text", "s", anchors=["the", "of", "by", "a"]).select(F.size("s")).first()[0]
    # the(cat house) of(house sat) the(house sat); by and a have one word left each
    assert n == 3


def test_edge_rows(edge_docs, no_docs):
    rows = spotsigs.edited_likeness(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by_text = {}
    for r in spotsigs.signatures(edge_docs, "text", "source").collect():
        by_text.setdefault(r.text or "", set()).add(tuple(r.source))
    assert all(len(v) == 1 for v in by_text.values())  # equal texts, equal fingerprints
    assert by_text[""] == {()} and all(by_text[t] != {()} for t in by_text if t)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert spotsigs.edited_likeness(no_docs).count() == 0
    single = edge_docs.filter("doc_id = 5")
    assert spotsigs.edited_likeness(single).first().near_next == 1.0


def test_next_row_over_all_ranges(spark):
    ids = [None, -5, 0, 1, 1, 7, *range(100, 400, 3), 10**12]
    df = spark.createDataFrame([(i, f"text {n} of the word{n} here now") for n, i in enumerate(ids)], "doc_id long, text string")
    rows = {(r.doc_id, r.n_chars): r for r in spotsigs.edited_likeness(df).collect()}
    assert sum(1 for _ in rows) <= len(ids)
    texts = [r.text for r in df.orderBy(F.col("doc_id").asc_nulls_first(), "text").collect()]
    want = sorted(t[: len(t) - len(t) // 4] + texts[(i + 1) % len(texts)][: len(t) // 4] for i, t in enumerate(texts))
    assert sorted(r.edited for r in spotsigs.edited_likeness(df).collect()) == want
