from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollstate.llm import queries, spelling

SF = "/root/testdata/sf0.001"


def neighbours(words: set[str]) -> dict[str, set[str]]:
    """Words one edit away, by leaving out letters: two such words share a form with a letter left out."""
    by_gap: dict[tuple[int, str], set[str]] = {}
    near: dict[str, set[str]] = {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            short = w[:i] + w[i + 1 :]
            if short in words:
                near[w].add(short)
                near[short].add(w)
            by_gap.setdefault((i, short), set()).add(w)
    for group in by_gap.values():
        for w in group:
            near[w] |= group - {w}
    return near


def brute_force(n: dict[str, int], ratio: float = 2.0) -> dict[str, tuple]:
    near, form = neighbours(set(n)), {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (n[w], form[w], root, len(near[w]), n[form[w]] if form[w] is not None else None)
    return out


def words_of(rows) -> Counter:
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return found


def result(df) -> dict[str, tuple]:
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.n, r.form, r.root, r.n_near, r.form_n) for r in rows}


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    n = {w: c for w, c in words_of(docs).items() if len(w) >= 5 and c >= 3}
    assert result(queries.op12_spelling_variants(spark, SF)) == brute_force(n)


def test_split_trees_lose_no_neighbour(spark, monkeypatch):
    monkeypatch.setattr(spelling, "CELL", 40)
    monkeypatch.setattr(spelling, "BLOCK", 70)
    rng = random.Random(3)
    n: dict[str, int] = {}
    while len(n) < 4000:
        w = "".join(rng.choice("abcdeé÷") for _ in range(rng.choice((4, 5, 5, 6, 6))))
        n[w] = int(rng.paretovariate(0.5)) + 3
    n |= {"x" * 4000: 9, "x" * 3999 + "y": 9, "x" * 4001: 40, "ÿ" * 70: 5, "ÿ" * 71: 11}
    df = spark.createDataFrame(list(n.items()), "word string, n long").withColumn("root", F.lit("clash"))
    assert len(list(spelling._leaves(spelling.fit_tops(df)[6]))) > 8
    assert result(spelling.group_variants(df)) == brute_force(n)


def test_tree_search_is_the_box_range():
    rng = np.random.default_rng(1)
    codes = rng.integers(97, 103, (600, 6)).astype(np.uint32)
    x = spelling.counts(codes)
    tree = spelling.build(x, np.arange(600), 4)
    for up, down in ((1, 1), (1, 0), (0, 1), (0, 0)):
        got = {(int(q), int(p)) for who, points in spelling.search(tree, x, up, down) for q in who for p in points}
        d = x[None, :, :] - x[:, None, :]
        want = (np.maximum(d, 0).sum(2) <= up) & (np.maximum(-d, 0).sum(2) <= down)
        assert {(int(q), int(p)) for q, p in np.argwhere(want)} <= got
        assert len(got) < 600 * 600 / 4


def test_edge_rows(spark, edge_docs, edge_texts, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    n = {w: c for w, c in words_of(rows).items() if len(w) >= 1 and c >= 1}
    assert result(spelling.spelling_variants(edge_docs, min_letters=1, min_count=1)) == brute_force(n)
    assert spelling.spelling_variants(no_docs).collect() == []


def test_ties_go_to_the_smaller_word(spark):
    n = {"abcde": 3, "abcdf": 6, "abcdé": 6, "abcd": 6, "bcde": 5}
    got = result(spelling.group_variants(spark.createDataFrame(list(n.items()), "word string, n long")))
    assert got["abcde"] == (3, "abcd", "abcd", 4, 6) and got == brute_force(n)
