from __future__ import annotations

import math
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rollstate.llm import lm, quality, queries
from rollstate.llm.common import held_out

SF = "/root/testdata/sf0.01"


def test_sum_of_squares_is_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    d = len(quality.STRUCTURE)
    n = quality.WORD_BUCKETS + d
    m = quality.Machine(0.3, rng.normal(size=n), rng.normal(size=(n, quality.RANK)), np.zeros(d), np.ones(d))
    words, dense = np.array([3, 9, 77]), rng.normal(size=(1, d))
    index = [*words, *range(quality.WORD_BUCKETS, n)]
    x = [1 / math.sqrt(3)] * 3 + list(np.clip(dense[0], -4, 4).astype(np.float32))
    pairs = sum(m.vector[i] @ m.vector[j] * a * b for p, (i, a) in enumerate(zip(index, x)) for j, b in list(zip(index, x))[p + 1 :])
    want = 0.3 + sum(m.weight[i] * a for i, a in zip(index, x)) + pairs
    assert abs(m.raw(words, np.array([3]), dense)[0][0] - want) < 1e-4


def test_quality_on_held_out_labels(spark):
    scored = {r.doc_id: r for r in queries.op6_quality_classifier(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in scored.items())
    test = [(scored[r.doc_id], r.quality) for r in labels if scored[r.doc_id].held_out]
    assert np.mean([s.predicted == q for s, q in test]) > 0.95
    assert all(s.predicted == int(s.score >= 0.7) for s in scored.values())


def test_quality_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(0, 1), (4, 0), (4, 1), (5, None), (None, 1), (6, 1)], "doc_id long, quality int")
    machine = quality.fit(edge_docs, labels, ~held_out(F.col("doc_id"), 4, 2))
    out = quality.score(edge_docs, machine, 0.7)
    assert out.columns == ["doc_id", "source", "n_tokens", "score", "predicted"]
    assert all(0 <= r.score <= 1 for r in out.collect()) and out.count() == edge_docs.count()
    assert quality.score(no_docs, machine, 0.7).count() == 0
    none = quality.fit(edge_docs, labels.limit(0), F.lit(True))
    assert {r.score for r in quality.score(edge_docs, none, 0.7).collect()} == {0.5}


def test_lm_base_and_model(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    counts = Counter(w for i, t in texts.items() if not out[i] for w in [*lm.tokens(t), lm.END])
    total, distinct = sum(counts.values()), len(counts)
    better = 0
    rows = queries.op7_lm_scoring(spark, SF).collect()
    for r in rows:
        words = [*lm.tokens(texts[r.doc_id]), lm.END]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (out[r.doc_id], len(words), total)
        assert r.n_known == sum(counts[w] > 0 for w in words) and abs(r.base_score - base) < 1e-6 * abs(base)
        better += r.held_out and r.score > r.base_score
    assert len(rows) == len(texts) and better > 0.9 * sum(out.values())


def test_lm_probabilities_are_normalised():
    rng = np.random.default_rng(1)
    noise = rng.dirichlet(np.ones(lm.HEAD + 1 + lm.CLASSES))
    model, n = lm.Model.start(noise), len(noise)
    trainer = lm.Trainer(model, noise, 0)
    for _ in range(5):
        trainer.step(*(rng.integers(0, n, 200) for _ in range(3)))
    logs = trainer.m.log_probabilities(np.arange(n), np.full(n, 3), np.full(n, 8))
    assert abs(np.exp(logs).sum() - 1) < 1e-4


def test_lm_normalisers_are_products():
    """Tables by symbol give what the sum over all symbols does, also where products underflow."""
    rng, n = np.random.default_rng(2), 40
    model = lm.Model.start(rng.dirichlet(np.ones(n)))
    for scale in (1, 3000):
        model.context[:] = rng.normal(0, 1, model.context.shape) * scale
        symbols, before, earlier = rng.integers(0, n, (3, 500))
        ahead = (model.context[before] * model.near + model.context[earlier] * model.far).astype(np.float64)
        z = ahead @ model.target.T + model.bias
        top = z.max(axis=1, keepdims=True)
        want = z[np.arange(500), symbols] - (top[:, 0] + np.log(np.exp(z - top).sum(axis=1)))
        got = model.scorer().log_probabilities(symbols, before, earlier)
        assert np.allclose(got, want, rtol=1e-5, atol=1e-4 * scale)


def test_lm_words_are_shuffled_once(spark, monkeypatch):
    """Words of a group that come more than once need no aggregation before their counts are joined."""
    df = spark.createDataFrame([(i, f"word{i % 7} again {i % 3} and again") for i in range(60)], "doc_id long, text string")

    def scored():
        return lm.score_texts(df, F.lit(False))

    plan = scored()._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan
    rows = []
    for held, emitted in ((50_000, 300_000), (1, 1)):
        monkeypatch.setattr(lm, "HELD_WORDS", held)
        monkeypatch.setattr(lm, "HEAD", 2)
        monkeypatch.setattr(lm, "COUNTER_WORDS", emitted)
        rows.append({r.doc_id: (r.n_tokens, r.n_known, round(r.base_score, 9)) for r in scored().collect()})
    assert rows[0] == rows[1] and len(rows[0]) == 60


def test_lm_vocabulary_grows_and_counts_the_end(spark, monkeypatch):
    assert lm.symbol_numbers(1000) == (lm.HEAD, lm.CLASSES)
    assert [lm.symbol_numbers(n)[0] for n in (10**7, 10**8, 10**9)] == sorted({lm.symbol_numbers(n)[0] for n in (10**7, 10**8, 10**9)})
    monkeypatch.setattr(lm, "HELD_WORDS", 500)
    monkeypatch.setattr(lm, "HEAD", 300)
    often = " ".join(f"w{i}" for i in range(2000))  # more words above the number of texts than are held
    rows = lm.score_texts(spark.createDataFrame([(1, f"{often} {often}"), (None, f"{often} {often}")], "doc_id long, text string"), F.lit(False)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in rows] == [(4001, 4001, 8002)] * 2
    base = 4000 * math.log10(4.5 / (8002 + 0.5 * 2002)) + math.log10(2.5 / (8002 + 0.5 * 2002))
    assert all(abs(r.base_score - base) < 1e-6 for r in rows)


def test_lm_held_out_texts_teach_nothing(spark):
    """The same training rows give the same scores whatever the held-out rows are."""
    train = [(i, f"a b c a b {i % 3} c d", False) for i in range(40)]
    for extra in ([], [(100, "z z z z a a a", True)] * 20):
        df = spark.createDataFrame(train + extra + [(200, "a b c", True)], "doc_id long, text string, out boolean").coalesce(1)
        got = {r.doc_id: r.score for r in lm.score_texts(df, F.col("out")).collect()}
        first = got[200] if not extra else first
        assert got[200] == pytest.approx(first, abs=0.2)


def test_lm_rows_of_one_id_are_dealt_apart(spark, monkeypatch):
    monkeypatch.setattr(lm, "GROUP_BYTES", 2000)
    df = spark.createDataFrame([(None, f"word{i % 7} again and again") for i in range(600)], "doc_id long, text string")
    rows = lm.score_texts(df, F.lit(False)).collect()
    assert len(rows) == 600 and len({round(r.base_score, 9) for r in rows}) <= 7 and all(math.isfinite(r.score) for r in rows)


def test_lm_edge_rows(spark, edge_docs, no_docs):
    rows = lm.score_texts(edge_docs, held_out(F.col("doc_id"), 5, 1)).collect()
    assert len(rows) == edge_docs.count()
    assert all(r.n_tokens >= 1 and math.isfinite(r.score) and r.score <= 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (0, 1, 2)} == {1}
    assert lm.score_texts(no_docs, F.lit(False)).count() == 0
    nothing = lm.score_texts(edge_docs, F.lit(True)).collect()  # nothing to learn from
    assert {(r.n_known, r.train_tokens) for r in nothing} == {(0, 0)}


def test_tokens_split_at_ascii_white_space_only():
    assert lm.tokens("A B\x0bÉ\x1cZ\n") == ["a b".encode(), "É\x1cz".encode()] and lm.tokens(None) == []


def test_lm_batches_of_texts_have_the_tokens_of_each(edge_texts):
    texts = [*edge_texts, "A B\x0bÉ\x1cZ\n", " a b \x85 İſ ", "\x00 x\x00", "a  b\r\n\x0c c ", None, ""]
    for rows in (texts, [None], [""], ["x"], []):
        words, places, lengths = lm.numbered(pa.array(rows, pa.string()))
        assert len(set(words)) == len(words)
        assert [words[i] for i in places] == [w for t in rows for w in lm.tokens(t)] and lengths.tolist() == [len(lm.tokens(t)) for t in rows]
    columns = pa.chunked_array([pa.array(texts[:5]), pa.array(texts[5:])])
    for size in (1, 40, 1 << 30):
        assert [t for piece in lm.pieces(columns, size) for t in piece.to_pylist()] == texts
    symbols, before, earlier = lm.sequences(np.array([1, 2, 3, 4]), np.array([0, 3, 0, 1]), 9)
    assert symbols.tolist() == [9, 1, 2, 3, 9, 9, 4, 9]
    assert before.tolist() == [9, 9, 1, 2, 3, 9, 9, 4] and earlier.tolist() == [9, 9, 9, 1, 2, 9, 9, 9]


def test_lm_steps_of_small_models_touch_only_rows_that_occur():
    """The sums over all rows move what the sums over rows that occur do."""
    rng, n = np.random.default_rng(4), 60
    noise = rng.dirichlet(np.ones(n))
    symbols, before, earlier = rng.integers(0, 20, (3, 300))
    every, some = (lm.Trainer(lm.Model.start(noise), noise, 0) for _ in range(2))
    sums = lm.Trainer._sums

    def of_many(rows, values, n):  # as of a model with more symbols than rows
        there, total = sums(rows, values, len(rows) + 1)
        return there, total

    some._sums = of_many
    for _ in range(5):
        every.step(symbols, before, earlier)
        some.step(symbols, before, earlier)
    assert all(np.array_equal(a, b) for a, b in zip(every.m.parts(), some.m.parts(), strict=True))
    unseen = np.setdiff1d(np.arange(n), np.concatenate([before, earlier]))
    assert len(unseen) and np.array_equal(every.m.context[unseen], lm.Model.start(noise).context[unseen])


def test_lm_words_of_a_batch_are_looked_up_together(edge_texts):
    """Symbols and counts are those of each word, for at most half of the CPU time of lookups one by one."""
    texts = pa.array([*edge_texts, "a \u00e9 b", None, "", *(f"w{i} x{i}y Z{i % 7}" for i in range(40_000))], pa.string())
    own, classes = [lm.END, b"a", b"w5", b"z3"], 128
    counts = {w: i + 1 for i, w in enumerate([lm.END, b"b", *(b"w%d" % i for i in range(20_000))])}
    words, places, lengths = lm.coded(texts)
    assert [words[i].as_py() for i in places] == [w for t in texts.to_pylist() for w in lm.tokens(t)] and int(lengths.sum()) == len(places)
    head, known, numbers = pa.array(own, pa.binary()), pa.array(list(counts), pa.binary()), np.array(list(counts.values()))
    twice = pa.concat_arrays([known, known]), np.concatenate([numbers, numbers])  # as where two tasks read texts of a group
    every = lm.with_end(words)
    assert lm.known_counts(every, *twice).tolist() == [counts.get(w, 0) for w in every.to_pylist()]
    place = {w: i for i, w in enumerate(own)}
    assert lm.word_symbols(every, head, classes).tolist() == [place.get(w, len(own) + zlib.crc32(w[-2:]) % classes) for w in every.to_pylist()]
    none = lm.coded(pa.array([None, ""], pa.string()))[0]
    assert not len(lm.word_symbols(none, head, classes)) and not len(lm.known_counts(none, known, numbers))

    def together():
        found = lm.coded(texts)[0]
        return lm.word_symbols(found, head, classes), lm.known_counts(found, known, numbers)

    def one_by_one():
        found = {w for t in texts.to_pylist() for w in lm.tokens(t)}
        return [place.get(w, len(own) + lm.ending(w, classes)) for w in found], [counts.get(w, 0) for w in found]

    def seconds(run):
        taken = []
        for _ in range(5):
            at = time.process_time()
            run()
            taken.append(time.process_time() - at)
        return min(taken)

    assert seconds(together) < 0.5 * seconds(one_by_one)


def test_lm_counts_of_many_batches(spark, tmp_root, monkeypatch):
    texts = [f"a B{i % 3} w{i} a" for i in range(300)] + ["", "  ", "\u00e9 a"]
    want = Counter(w for t in texts for w in [*lm.tokens(t), lm.END])
    for emitted in (300_000, 1):
        monkeypatch.setattr(lm, "COUNTER_WORDS", emitted)
        monkeypatch.setattr(lm, "bound_batches", lambda spark: spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7"))
        df = spark.createDataFrame([(t,) for t in texts], "_text string").repartition(3)
        counts, stats = lm.count(df, f"{tmp_root}/{emitted}")
        assert {bytes(r._word): r._n for r in counts.collect()} == want == stats.held
        assert (stats.total, stats.distinct) == (sum(want.values()), len(want))
    monkeypatch.undo()
    lm.bound_batches(spark)
    tables = [pa.table({"_word": pa.array([b"x"] * k, pa.binary())}) for k in (1, 2, 3, 0, 4)]
    assert [len(t) for t in lm.gathered(tables, 1)] == [3, 3, 4] and not list(lm.gathered([], 1))


def test_lm_step_follows_its_gradients():
    """One step of a model without history moves every parameter as plain sums over the tokens do."""
    rng, n, size = np.random.default_rng(6), 50, 40
    noise = rng.dirichlet(np.ones(n))
    symbols, before, earlier = rng.integers(0, n, (3, size))
    trainer = lm.Trainer(lm.Model.start(noise), noise, 0)
    drawn = np.minimum(np.searchsorted(trainer.cumulative, np.random.default_rng(0).random(lm.NOISE)), n - 1)
    m = lm.Model(*[p.astype(np.float64) for p in lm.Model.start(noise).parts()])
    grads = [np.zeros(p.shape) for p in m.parts()]
    for s, b, e in zip(symbols, before, earlier, strict=True):
        ahead = m.predicted(b, e)
        for t, label in [(s, 1), *((d, 0) for d in drawn)]:
            push = (1 / (1 + math.exp(-(ahead @ m.target[t] + m.bias[t] - math.log(lm.NOISE * noise[t])))) - label) / size
            to_ahead = push * m.target[t]
            grads[0][b] += to_ahead * m.near
            grads[0][e] += to_ahead * m.far
            grads[1] += to_ahead * m.context[b]
            grads[2] += to_ahead * m.context[e]
            grads[3][t] += push * ahead
            grads[4][t] += push
    trainer.step(symbols, before, earlier)
    for got, was, grad in zip(trainer.m.parts(), m.parts(), grads, strict=True):
        assert np.allclose(got, was - lm.RATE * grad / np.sqrt(lm.CALM + grad * grad), atol=1e-4)
