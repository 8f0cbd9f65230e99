import numpy as np
import pytest

from lendframe.llm import whitening as W


def numbers(v):
    return [int(np.floor(64 * float(c))) + 1_000_000 for c in v]


def brute(rows):
    """{(vec_id, component): row} of one dimension, by numpy's dense eigenvectors of the whole covariance, without ties or repeats."""
    ids, x = [i for i, _ in rows], [numbers(v) for _, v in rows]
    n = len(x)
    sums = [sum(c) for c in zip(*x)]
    exact = [[n * c - s for c, s in zip(v, sums)] for v in x]
    d = np.array(exact, float) / n
    values, vectors = np.linalg.eigh(d.T @ d / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = int((values[:32] > 1e-10 * values[0]).sum())
    white = d @ vectors[:, :k] / np.sqrt(values[:k])
    return {(i, j + 1): (n, sum(c * c for c in exact[r]), white[r, j], values[j] / values.sum()) for r, i in enumerate(ids) for j in range(k)}


def check(got, want, close=1e-9):
    got = {(r.vec_id, r.component): r for r in got}
    assert set(got) == set(want)
    sign = {}
    for (i, j), (n, deviation, white, explained) in want.items():
        r = got[i, j]
        assert (r.n, r.deviation) == (n, deviation)
        assert r.explained == pytest.approx(explained, rel=1e-9)
        assert r.identity_error <= 1e-8
        if abs(white) > 1e-3:
            sign.setdefault(j, np.sign(r.whitened / white))
        assert r.whitened == pytest.approx(white * sign.get(j, 1), abs=close)


def test_whole_table_matches_dense_eigenvectors(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(W.op13_whitening(spark, sf_dir).collect(), brute(rows))


def test_messy(spark):
    rng = np.random.default_rng(0)
    wide = [(i, rng.normal(size=90).tolist()) for i in range(200)]
    small = [(1000 + i, rng.normal(size=3).tolist()) for i in range(30)] + [(1100, [1.0, 2.0, 3.0]), (None, [0.5, 0.25, 9.0])]
    out = [(2000, None), (2001, []), (2002, [1.0, None, 2.0]), (2003, [float("nan")] * 3), (2004, [float("inf"), 1.0, 2.0]), (2005, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in wide + small + out], "vec_id long, embedding array<double>, x int, component string").repartition(5)
    got = W.whiten(W.scaled(df)).collect()
    check([r for r in got if r.vec_id is not None and r.vec_id < 1000], brute(wide))
    check([r for r in got if r.vec_id is None or 1000 <= r.vec_id < 2000], brute(small))
    assert not [r for r in got if r.vec_id is not None and r.vec_id >= 2000]


def test_repeated_rows_empty_and_huge(spark):
    kind = "vec_id long, embedding array<float>"
    same = spark.createDataFrame([(7, [1.0, 2.0])] * 5, kind)
    assert W.whiten(W.scaled(same)).count() == 0  # no variance
    assert W.whiten(W.scaled(same.where("false"))).count() == 0
    rows = [(7, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [3.0, 2.0])]
    got = W.whiten(W.scaled(spark.createDataFrame(rows, kind))).collect()
    assert sorted((r.vec_id, r.component, r.deviation) for r in got) == [(7, 1, 128**2), (7, 1, 128**2), (8, 1, 256**2)]
    huge = W.whiten(W.scaled(spark.createDataFrame([(1, [3e38, 0.0]), (2, [0.0, 1.0]), (3, [-3e38, 2.0])], kind))).collect()
    assert {r.deviation for r in huge} >= {None} and all(np.isfinite(r.whitened) for r in huge)


@pytest.mark.parametrize("spectrum", ["flat", "steep", "clusters", "few"])
def test_spectra(spectrum):
    """Eigenpairs of given spectra, from a plain product: residuals at rounding, none missed."""
    rng = np.random.default_rng(4)
    d = 120
    e = {"flat": np.linspace(1, 0.99, d), "steep": 10.0 ** -np.arange(d), "clusters": np.repeat([5.0, 3.0, 1.0], 40), "few": np.r_[np.ones(3), np.zeros(d - 3)]}[spectrum]
    q = np.linalg.qr(rng.normal(size=(d, d)))[0]
    v = (q * e) @ q.T
    values, vectors = W.leading(lambda x: v @ x, d, 32)
    want = np.sort(e)[::-1][:32]
    want = want[want > 1e-10 * want[0]]
    assert len(values) == pytest.approx(len(want), abs=1 if spectrum == "steep" else 0)
    assert np.allclose(values, want[: len(values)], rtol=1e-6, atol=1e-12)
    assert np.abs(v @ vectors - vectors * values).max() < 1e-10
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12


def test_filter_shrinks_the_interval():
    e = np.linspace(0, 2, 21)
    out = W.filtered(lambda x: e[:, None] * x, np.ones((21, 1)), 0.0, 1.0, 2.0, 6).ravel()
    t = np.polynomial.chebyshev.Chebyshev.basis(6)
    assert np.allclose(out, t(2 * e - 1) / t(3), atol=1e-12)
