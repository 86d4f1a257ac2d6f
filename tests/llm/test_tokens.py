from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rollstate.llm import bpe, chunks, queries, token_counts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MERGES = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
TEXTS = st.text(alphabet=st.sampled_from("abertslv'd  \n\t é日½12!?_-　\x1c=<|"), max_size=40)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def counting():
    return Tokenizer.from_file(MERGES)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_chunks_cut_where_no_match_crosses(text):
    find = chunks.Pieces(PATTERN)
    parts = chunks.cut(text)
    assert (parts[0] + "".join(" " + p for p in parts[1:])) == text
    assert [p for i, c in enumerate(parts) for p in find(" " + c if i else c)] == find(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(TEXTS, max_size=6))
def test_bpe_is_the_library_s_and_round_trips(library, texts):
    b = bpe.worker(RANKS, PATTERN)
    ids, lengths = b.encode(texts)
    assert [int(n) for n in lengths] == [len(library.encode_ordinary(t)) for t in texts]
    assert ids.tolist() == [i for t in texts for i in library.encode_ordinary(t)]
    assert b.decode(ids, lengths) == [t.encode() for t in texts]


def test_bpe_long_words_and_restarts(library, monkeypatch):
    monkeypatch.setattr(bpe, "STATE_ROWS", 2_000)  # every query stops early and goes on
    b = bpe.DuckBPE(RANKS, PATTERN)
    texts = ["a" * 900, "=" * 500, " " * 300 + "x", "ab" * 200, "日本語" * 60, "qwzx" * 90]
    ids, _ = b.encode(texts)
    assert ids.tolist() == [i for t in texts for i in library.encode_ordinary(t)]


def test_bpe_operator_on_edge_rows(edge_docs, no_docs, library):
    out = bpe.encode(edge_docs, RANKS, PATTERN, decoded="n_tokens")
    assert out.columns == ["doc_id", "source", "SCORE", "ids", "n_tokens"]  # the clashing column is replaced
    rows = edge_docs.select("doc_id", "text").collect()
    got = sorted((r.doc_id or -1, list(r.ids), bytes(r.n_tokens)) for r in out.collect())
    want = sorted((r.doc_id or -1, library.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in rows)
    assert got == want
    back = bpe.decode(out.select("doc_id", "ids"), RANKS, PATTERN)
    assert sorted(bytes(r.decoded) for r in back.collect()) == sorted(w[2] for w in want)
    assert bpe.encode(no_docs, RANKS, PATTERN).count() == 0


def test_decode_unknown_and_null_ids(spark):
    df = spark.createDataFrame([(1, None), (2, [10**6, None]), (3, [])], "k int, ids array<int>")
    assert [bytes(r.decoded) for r in bpe.decode(df, RANKS, PATTERN).collect()] == [b"", b"", b""]


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_prefix_counts_are_the_library_s_at_every_prefix(counting, text):
    c = token_counts.counter(MERGES, PATTERN)
    n = lambda t: len(counting.encode(t, add_special_tokens=False).ids)
    assert c.total(text) == n(text)
    if "<|endoftext|>" not in text:
        want = [n(text[:i]) for i in range(len(text) + 1)]
        assert c.prefixes(text).tolist() == want
        for budget in (0, 1, 3, 8):
            assert c.fit(c.chunked(text), budget) == next((i - 1 for i, v in enumerate(want) if v > budget), len(text))


def test_count_operator_on_edge_rows(edge_docs, no_docs, counting):
    out = token_counts.count_tokens(edge_docs, MERGES, PATTERN, 8)
    assert out.columns == ["doc_id", "source", "SCORE", "n_bytes", "n_tokens", "fit_chars"]
    want = sorted(
        (len((r.text or "").encode()), len(counting.encode(r.text or "", add_special_tokens=False).ids)) for r in edge_docs.collect()
    )
    assert sorted((r.n_bytes, r.n_tokens) for r in out.collect()) == want
    assert token_counts.count_tokens(no_docs, MERGES, PATTERN, 8).count() == 0


def test_queries_match_the_libraries(spark, library, counting):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op1_byte_level_bpe(spark, sf).collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    for r in queries.op10_token_counts(spark, sf).collect():
        n = len(counting.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_tokens, r.over_limit, r.n_bytes) == (n, n > 1024, len(texts[r.doc_id].encode()))
