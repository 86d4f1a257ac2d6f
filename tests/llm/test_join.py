from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from rollstate.llm import ngram_join, queries
from rollstate.llm.components import components


def brute_force(texts: dict[int, str]):
    """Class, links and copies of each id, by comparing all pairs."""
    sets = {}
    for i, t in texts.items():
        w = (t or "").lower().split()
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    groups = defaultdict(list)
    for i, s in sets.items():
        groups[s].append(i)
    rep = {s: min(v) for s, v in groups.items()}
    parent = {r: r for r in rep.values()}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = Counter()
    distinct = list(groups)
    for n, a in enumerate(distinct):
        for b in distinct[n + 1 :]:
            if a and b and len(a & b) / len(a | b) >= 0.8:
                links[rep[a]] += 1
                links[rep[b]] += 1
                x, y = find(rep[a]), find(rep[b])
                parent[max(x, y)] = min(x, y)
    return {i: (find(rep[s]), links[rep[s]], len(groups[s])) for i, s in sets.items()}


def as_dict(df):
    return {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in df.collect()}


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert as_dict(queries.op5_ngram_jaccard_join(spark, sf)) == brute_force(texts)


@pytest.mark.parametrize("block", [4, 512])
def test_large_group_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", block)
    rng = random.Random(3)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(120)]
    texts = {}
    for i in range(40):  # a chain of edits: neighbours alike, ends not
        w = list(base)
        for k in range(i // 4):
            w[3 * k] = f"edit{k}"
        w[i % 4 + 100] = "other"
        texts[i] = " ".join(w)
    texts |= {100 + i: " ".join(f"u{rng.randint(0, 9999)}" for _ in range(80)) for i in range(20)}
    texts |= {200: texts[0], 201: texts[0].upper(), 202: "two words", 203: "two  words", 204: "", 205: None}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = brute_force(texts)
    assert sum(1 for c, n, k in want.values() if n > 3) > 10, want
    assert as_dict(ngram_join.similarity_classes(df)) == want


def test_edge_rows(edge_docs, no_docs):
    rows = ngram_join.similarity_classes(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    empty = [r for r in rows if r.doc_id in (0, 1, 2)]
    assert {(r.class_id, r.n_links, r.n_copies) for r in empty} == {(0, 0, 3)}
    assert [(r.class_id, r.n_copies) for r in rows if r.doc_id == 4 or r.doc_id is None] == [(4, 3)] * 3
    assert ngram_join.similarity_classes(no_docs).count() == 0


def test_rows_that_share_an_id_or_have_none(spark):
    rng = random.Random(9)
    a, b, u = (" ".join(f"w{rng.randint(0, 9999)}" for _ in range(60)) for _ in range(3))
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (None, u), (None, u + " z"), (None, a), (4, "alone here"), (1, b)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.class_id or 0, r.n_links, r.n_copies) for r in ngram_join.similarity_classes(df).collect()))
    assert got == sorted([(1, 1, 1, 2), (1, 1, 1, 2), (1, 1, 1, 2), (2, 1, 1, 1), (3, 1, 1, 1), (0, 0, 1, 1), (0, 0, 1, 1), (0, 1, 1, 2), (4, 4, 0, 1)])
    later = {(r._id, r._row) for r in ngram_join.later_members(df).collect()}
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    last = max((u, u + " z"), key=md5)
    assert later == {(2, md5(a + " x")), (3, md5(b + " y")), (None, md5(a)), (None, md5(last))}


def test_prefix_is_shortened_to_the_target_recall():
    depth = ngram_join.prefix_depth(0.8)
    assert ngram_join.recall(depth, 0.8, ngram_join.TREES) >= ngram_join.TARGET_RECALL
    assert ngram_join.recall(depth + 1, 0.8, ngram_join.TREES) < ngram_join.TARGET_RECALL


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7), (5, 4), (5, 4)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(50)}
    assert components(df.limit(0)).count() == 0
