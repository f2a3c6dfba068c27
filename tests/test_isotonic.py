"""Pooled pieces against the min-max formula and linear interpolation."""
import tempfile

import numpy as np
import pytest

from ledgerscope.operators import isotonic as I


def minmax(x, y, w):
    u = np.unique(x)
    n, s = np.array([w[x == v].sum() for v in u]), np.array([(w * y)[x == v].sum() for v in u])
    cn, cs = np.concatenate([[0], n.cumsum()]), np.concatenate([[0], s.cumsum()])
    fit = []
    for i in range(len(u)):
        fit.append(max(min((cs[b + 1] - cs[a]) / (cn[b + 1] - cn[a]) for b in range(i, len(u))) for a in range(i + 1)))
    return u, np.array(fit)


CASES = {
    "noisy": lambda rng: (rng.random(150), None),
    "falling": lambda rng: (np.arange(90) / 90, np.arange(90) < 45),
    "rising": lambda rng: (np.arange(120) / 120, np.arange(120) >= 60),
    "ties": lambda rng: (rng.integers(0, 9, 300) / 8, None),
    "one": lambda rng: (np.full(5, 0.3), np.array([1, 0, 0, 1, 1])),
}


@pytest.mark.parametrize("chunk", [20, 50_000])
@pytest.mark.parametrize("name", CASES)
def test_equals_min_max(spark, name, chunk):
    rng = np.random.default_rng(len(name))
    x, y = CASES[name](rng)
    y = (rng.random(len(x)) < 0.2 + 0.6 * x).astype(int) if y is None else np.asarray(y).astype(int)
    w = rng.choice([1.0, 2.5], len(x))
    rows = [(float(a), int(b), float(c)) for a, b, c in zip(x, y, w)] + [(None, 1, 1.0), (0.5, None, 1.0)]
    df = spark.createDataFrame(rows, "p_raw double, y int, w double").repartition(4)
    got = I.fit(df, "p_raw", "y", "w", chunk)
    u, fitted = minmax(x, y, w)
    ask = np.concatenate([u, [-1.0, 2.0], rng.random(60)])
    out = got.apply(spark.createDataFrame([(float(v),) for v in ask] + [(None,)], "p_raw double").repartition(3)).collect()
    assert len(out) == len(ask) + 1
    by = {r.p_raw: r.p for r in out}
    assert by.pop(None) is None
    assert np.allclose([by[float(v)] for v in ask], np.interp(ask, u, fitted), atol=1e-12)


def test_save_and_load(spark):
    df = spark.createDataFrame([(i / 10, int(i > 4)) for i in range(10)], "p_raw double, y int")
    fit = I.fit(df, "p_raw", "y")
    path = tempfile.mkdtemp() + "/iso"
    fit.save(path)
    ask = df.select("p_raw")
    assert sorted(I.load(spark, path).apply(ask).collect()) == sorted(fit.apply(ask).collect())
    with pytest.raises(ValueError, match="labelled"):
        I.fit(df.where("1 = 0"), "p_raw", "y")
