"""Whitening against dense linear algebra; the qd solver on hard bidiagonals."""
import numpy as np
import pytest

from ledgerscope.llm import whitening as w

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v string, component string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "a", "b", "c") for i, v in vectors], SCHEMA).repartition(5)


def ints(rows):
    return np.array([[int(np.floor(1024 * float(np.float32(c)))) + 100000 for c in r] for r in rows])


def check(got, rows, k=8):
    """got rows against the exact covariance of rows [(id, vector)]."""
    x = ints([v for _, v in rows])
    n, d = x.shape
    s = x.sum(0)
    dev = ((n * x.astype(object) - s) ** 2).sum(1)
    centred = (n * x - s) / n
    e, q = np.linalg.eigh(centred.T @ centred / n)
    e, q = e[::-1], q[:, ::-1]
    c = min(k, d)
    assert len(got) == n * c
    at = {i: j for j, (i, _) in enumerate(rows)}
    y = np.zeros((n, c))
    for r in got:
        j = at[r["vec_id"]]
        assert r["n"] == n and r["deviation"] == dev[j] and r["identity_error"] <= 1e-9
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / e.sum(), rel=1e-9)
        y[j, r["component"] - 1] = r["whitened"]
    for i in range(c):
        want = centred @ q[:, i] / np.sqrt(e[i])
        assert min(np.abs(y[:, i] - want).max(), np.abs(y[:, i] + want).max()) < 1e-7
    return y


def test_whiten(spark, monkeypatch):
    monkeypatch.setattr(w, "MERGE", 2)
    rng = np.random.default_rng(1)
    rows = [(i, (rng.standard_normal(12) * np.linspace(0.1, 1, 12)).tolist()) for i in range(300)]
    bad = [(900, None), (901, [None] + [0.0] * 11), (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11)]
    check(w.whiten(frame(spark, rows + bad)).collect(), rows)


def test_few_dimensions_and_short_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(3).tolist()) for i in range(40)]
    rows[3], rows[4] = (3, rows[3][1][:2]), (4, [])
    full = [(i, v + [0.0] * (3 - len(v))) for i, v in rows]
    check(w.whiten(frame(spark, rows)).collect(), full)


def test_no_variance(spark):
    for rows in ([(1, [0.5, 0.25])], [(i, [0.5, 0.25]) for i in range(6)]):
        got = w.whiten(frame(spark, rows)).collect()
        assert len(got) == 2 * len(rows)
        assert {(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in got} == {(0, 0.0, 0.0, 0.0)}
    flat = w.whiten(frame(spark, [(i, [float(i), 1.0, 2.0 * i]) for i in range(9)])).collect()
    assert {r["component"]: round(r["explained"], 9) for r in flat} == {1: 1.0, 2: 0.0, 3: 0.0}


def test_empty(spark):
    got = w.whiten(frame(spark, []))
    assert got.count() == 0 and got.columns[0] == "vec_id"
    assert w.whiten(frame(spark, [(1, None)])).count() == 0


def test_ties_of_variance(spark):
    rows = [(i, v) for i, v in enumerate([[1.0, 0.0, 0.0], [-1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, -1.0, 0.0], [0.0, 0.0, 0.5], [0.0, 0.0, -0.5]])]
    got = w.whiten(frame(spark, rows)).collect()
    assert max(r["identity_error"] for r in got) < 1e-9


@pytest.mark.parametrize("name", ["random", "graded", "wilkinson", "equal", "zeros", "clusters"])
def test_solver(name):
    rng = np.random.default_rng(5)
    d = 40
    r = {"random": rng.standard_normal((60, d)),
         "graded": rng.standard_normal((60, d)) * 10.0 ** -np.arange(d),
         "wilkinson": np.linalg.cholesky(np.diag(np.abs(np.arange(-20, 20)) + 3.0) + np.diag(np.ones(d - 1), 1) + np.diag(np.ones(d - 1), -1)).T,
         "equal": np.eye(d) * 3.0,
         "zeros": rng.standard_normal((60, 3)) @ rng.standard_normal((3, d)),
         "clusters": np.linalg.qr(rng.standard_normal((d, d)))[0] * np.repeat([1.0, 1 + 1e-12, 0.5, 0.1], 10)}[name]
    values, vectors, trace = w.leading(w.triangular(r), 8)
    want = np.linalg.svd(r, compute_uv=False) ** 2
    rank = 3 if name == "zeros" else 8
    assert np.allclose(values[:rank], want[:rank], rtol=1e-12, atol=0)
    assert trace == pytest.approx(want.sum(), rel=1e-12)
    v = vectors[:rank]
    assert np.abs(v @ v.T - np.eye(rank)).max() < 1e-11
    assert np.abs(r.T @ (r @ v.T) - v.T * values[:rank]).max() < 1e-11 * want[0]


def test_dqds_keeps_relative_accuracy():
    """Tiny singular values of a graded bidiagonal, against exact rational arithmetic signs."""
    q, e = [10.0 ** (-3 * i) for i in range(12)], [10.0 ** (-3 * i - 2) for i in range(11)]
    got = w.dqds(q, e)
    from fractions import Fraction as Fr
    def below(x):
        """Number of values below x: negative pivots of B'B - x in exact arithmetic."""
        x, n, p = Fr(x), 0, None
        for i in range(12):
            diag = Fr(q[i]) + (Fr(e[i - 1]) if i else 0) - x
            p = diag - (Fr(q[i - 1]) * Fr(e[i - 1]) / p if i else 0)
            n += p < 0
        return n
    for i, x in enumerate(sorted(got)):
        assert below(x * (1 - 1e-12)) == i and below(x * (1 + 1e-12)) == i + 1
