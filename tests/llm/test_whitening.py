from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from rollstate.llm import queries, whitening

SF = "/root/testdata/sf0.001"


def symmetric(values, seed=0):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    v = (q * np.asarray(values, float)) @ q.T
    return (v + v.T) / 2


SPECTRA = {
    "falling": np.linspace(1, 100, 50),
    "geometric": 2.0 ** -np.arange(40),
    "equal": np.ones(30),
    "pairs": np.repeat(np.arange(1, 21), 2),
    "low rank": np.r_[np.zeros(20), [1.0, 2.0, 5.0]],
    "far apart": np.r_[np.full(30, 1e-9), 1e6, 1.0, 0.5],
    "one": [3.0],
    "two": [1.0, 1e-3],
    "large": 1e12 + np.arange(80),
    "many": np.linspace(1, 2, 200),
}


@pytest.mark.parametrize("name", SPECTRA)
@pytest.mark.parametrize("k", [1, 5, 16, 60])
def test_contour_integration_against_full_decomposition(name, k):
    v = symmetric(SPECTRA[name])
    values, vectors = whitening.largest(v, k)
    want = np.linalg.eigvalsh(v)[::-1]
    want = want[want > 4 * len(v) * whitening.EPS * np.abs(v).sum(axis=1).max()][:k]
    assert len(values) == len(want)
    assert np.allclose(values, want, rtol=1e-10, atol=1e-14 * len(v) * abs(want[0]))
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-10
    assert np.abs(v @ vectors - vectors * values).max() < 1e-11 * abs(want[0])


@pytest.mark.parametrize("name", SPECTRA)
def test_inertia_counts(name):
    v = symmetric(SPECTRA[name])
    true = np.linalg.eigvalsh(v)
    inertia = whitening.Inertia(v)
    for shift in [*(true[1:] + true[:-1]) / 2, true[0] - 1, true[-1] + 1]:
        if np.abs(true - shift).min() > 1e-12 * np.abs(true).max():
            assert inertia.above(shift) == (true > shift).sum()


def brute_force(vectors: dict, components: int):
    """Everything by exact fractions and a full decomposition."""
    kept = {i: [math.floor(64 * float(c)) + 1_000_000 for c in v] for i, v in vectors.items() if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    fit = sorted({tuple(x) for x in kept.values()})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums)] for x in fit])
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    k = min(components, int((e > 1e-10 * e[0]).sum()))
    out = {}
    for i, x in kept.items():
        dev = [n * a - s for a, s in zip(x, sums)]
        for c in range(k):
            out[i, c + 1] = (n, sum(d * d for d in dev), float(np.array(dev) / n @ u[:, c]) / math.sqrt(e[c]), e[c] / np.trace(v))
    return out


def compare(rows, want):
    got = {(r.vec_id, r.component): r for r in rows}
    assert len(got) == len(rows) and got.keys() == want.keys()
    for c in {c for _, c in want}:
        mine = np.array([got[i, c].whitened for i, k in want if k == c])
        other = np.array([want[i, k][2] for i, k in want if k == c])
        sign = 1 if mine @ other > 0 else -1
        assert np.allclose(mine, sign * other, atol=1e-7)
    for key, (n, dev, _, explained) in want.items():
        r = got[key]
        assert (r.n, r.deviation) == (n, dev) and abs(r.explained / explained - 1) < 1e-9 and r.identity_error < 1e-9


def test_query_matches_full_decomposition(spark):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    rows = queries.op13_embedding_whitening(spark, SF).collect()
    compare(rows, brute_force(vectors, 16))
    assert rows[0].asDict().keys() == {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}


def test_incomplete_repeated_and_odd_vectors(spark):
    rng = np.random.default_rng(4)
    good = [[float(x) for x in row] for row in rng.standard_normal((40, 6)).astype(np.float32)]
    odd = [None, [], [1.0] * 5, [1.0, None, 1.0, 1.0, 1.0, 1.0], [math.nan] + [1.0] * 5, [math.inf] * 6, [-math.inf] + [0.0] * 5]
    rows = [(i, v, -1, 0.5) for i, v in enumerate(good + odd + good[:7])]
    rows[3] = (None, *rows[3][1:])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, component int, X double")
    got = whitening.whiten(df, components=16).collect()
    want = brute_force({r[0]: r[1] for r in rows if r[1] is None or len(r[1]) == 6}, 16)
    compare(got, want)
    assert {r.component for r in got} == set(range(1, 7)) and len(got) == 47 * 6


def test_tables_without_components(spark):
    schema = "vec_id long, embedding array<double>"
    for rows in ([], [(1, None)], [(1, [])], [(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (2, [0.5, 0.25])]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).collect() == []
    two = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25]), (2, [1.5, 0.25])], schema)).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation, abs(round(r.whitened, 9)), round(r.explained, 9)) for r in two) == [(1, 1, 2, 4096, 1.0, 1.0), (2, 1, 2, 4096, 1.0, 1.0)]


@pytest.mark.parametrize("rows", [[(i, [float(10 ** (i % 10)), float(i)]) for i in range(50)] + [(99, [3e38, -3e38])], [(i, [float(i), float(i % 7)]) for i in range(50)] + [(99, [2e7, 1.0])]])
def test_deviations_beyond_64_bits(spark, rows):
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    by_id = {r.vec_id: r.deviation for r in got}
    n = got[0].n
    x = {i: [math.floor(min(max(64 * c, -whitening.LARGEST), whitening.LARGEST)) + 1_000_000 for c in v] for i, v in rows}
    sums = [sum(c) for c in zip(*{tuple(v) for v in x.values()})]
    for i, v in x.items():
        want = sum((n * a - s) ** 2 for a, s in zip(v, sums))
        assert by_id[i] == (want if want < 2**63 else None)
    assert by_id[99] is None and n == 51 and {r.component for r in got} == {1, 2}
    assert all(r.whitened is not None for r in got)
