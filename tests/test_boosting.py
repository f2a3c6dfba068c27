"""Second-order trees against closed formulas and a brute-force builder."""
import numpy as np
import pytest

from ledgerscope.operators import boosting as B


def frame(spark, x, y, w=None):
    w = np.ones(len(y)) if w is None else w
    names = [f"f{j}" for j in range(x.shape[1])]
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) + (int(t), float(u)) for r, t, u in zip(x, y, w)]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names) + ", y int, w double").repartition(3), names


def soft(g, a):
    return np.sign(g) * max(abs(g) - a, 0)


def brute(x, y, w, m, cuts, p, depth=0):
    """Leaf values of the rows by exhaustive search over all features and cuts."""
    q = 1 / (1 + np.exp(-m))
    g, h = w * (q - y), w * q * (1 - q)

    def worth(i):
        return soft(g[i].sum(), p.reg_alpha) ** 2 / (h[i].sum() + p.reg_lambda)
    all_rows = np.arange(len(y))
    out = np.full(len(y), -p.learning_rate * soft(g.sum(), p.reg_alpha) / (h.sum() + p.reg_lambda))
    if depth == p.max_depth:
        return out
    best = (1e-9, None)
    for j in range(x.shape[1]):
        for c in cuts[j]:
            left = x[:, j] <= c
            if h[left].sum() >= p.min_child_weight and h[~left].sum() >= p.min_child_weight:
                gain = round(worth(left) + worth(~left) - worth(all_rows), 9)
                if gain > best[0]:
                    best = (gain, left)
    if best[1] is not None:
        for side in (best[1], ~best[1]):
            out[side] = brute(x[side], y[side], w[side], m[side], cuts, p, depth + 1)
    return out


def data(seed=3, n=300):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 7, n).astype(float), rng.normal(size=n).round(1), rng.integers(0, 2, n).astype(float)], 1)
    x[rng.random((n, 3)) < 0.05] = np.nan
    y = (rng.random(n) < 1 / (1 + np.exp(-(np.nan_to_num(x[:, 0], nan=3) - 3)))).astype(int)
    return x, y, rng.choice([1.0, 3.0], n)


@pytest.mark.parametrize("alpha,lam,least", [(0.0, 0.0, 0.0), (0.1, 1.0, 3.0), (5.0, 10.0, 1.0)])
def test_equals_exhaustive_search(spark, alpha, lam, least):
    x, y, w = data()
    df, names = frame(spark, x, y, w)
    p = B.BoosterParams(3, 3, 0.3, 1.0, 1.0, least, alpha, lam)
    got = B.fit_booster(df, names, "y", "w", p)
    cuts, m = B.cut_points(df, names), np.zeros(len(y))
    for t in range(3):
        m = m + brute(x, y, w, m, cuts, p)
    assert np.allclose(got.ensemble.margin(x), m, atol=1e-9)


def test_penalties_act(spark):
    x, y, w = data()
    df, names = frame(spark, x, y, w)

    def size(**kw):
        e = B.fit_booster(df, names, "y", "w", B.BoosterParams(1, 3, 1.0, 1.0, 1.0, 0.0, **kw)).ensemble.trees[0]
        leaves = e.left < 0
        return np.abs(e.value[leaves]).max(), leaves.sum()
    free = size(reg_alpha=0.0, reg_lambda=1e-6)
    assert size(reg_alpha=0.0, reg_lambda=100.0)[0] < free[0]
    assert size(reg_alpha=60.0, reg_lambda=1e-6)[1] < free[1]


def test_root_leaf_is_the_closed_formula(spark):
    """Without a possible split the one leaf is -T(G) / (H + lambda)."""
    df, names = frame(spark, np.zeros((10, 1)), np.array([1] * 3 + [0] * 7))
    got = B.fit_booster(df, names, "y", None, B.BoosterParams(1, 2, 1.0, 1.0, 1.0, 0.0, 0.5, 2.0)).ensemble
    g, h = 0.5 * 10 - 3, 0.25 * 10
    assert got.margin(np.zeros((1, 1)))[0] == pytest.approx(-(g - 0.5) / (h + 2.0))


def test_subsample_seed_refresh_and_json(spark, monkeypatch):
    x, y, w = data(n=400)
    df, names = frame(spark, x, y, w)
    df = df.persist()
    p = B.BoosterParams(13, 3, 0.3, 0.7, 0.7)
    a = B.fit_booster(df, names, "y", "w", p).ensemble
    monkeypatch.setattr(B, "REFRESH", 4)
    monkeypatch.setattr(B, "DIRECT", 2)
    b = B.fit_booster(df, names, "y", "w", p).ensemble
    assert np.allclose(a.margin(x), b.margin(x), atol=1e-9)
    from ledgerscope.operators.trees import TreeEnsemble
    assert np.array_equal(TreeEnsemble.from_json(a.to_json()).margin(x), a.margin(x))
    assert ((a.probability(x) >= 0.5) == y).mean() > 0.65
    assert B.fit_booster(df, names, "y", "w", p, stop=lambda n: n >= 5).ensemble.margin(x).shape == (400,)


def test_rows_without_label_and_empty(spark):
    x, y, w = data(n=50)
    df, names = frame(spark, x, y, w)
    none = df.where("1 = 0")
    assert B.fit_booster(none, names, "y", "w", B.BoosterParams(2)).ensemble.margin(x).tolist() == [0.0] * 50


def test_driver_gets_cuts_not_histograms(spark, monkeypatch):
    import pickle

    from pyspark import RDD
    x, y, w = data(n=600)
    df, names = frame(spark, x, y, w)
    df = df.repartition(6).persist()
    sent, collect = [], RDD.collect

    def seen(self):
        got = collect(self)
        sent.append(len(pickle.dumps(got)))
        return got
    monkeypatch.setattr(RDD, "collect", seen)
    p = B.BoosterParams(2, 3, 0.3, 1.0, 1.0)
    many = B.fit_booster(df, names, "y", "w", p).ensemble
    assert sent and max(sent) < 4 * len(names) * 16 * 8        # of a level's four nodes and each column a few numbers
    one = B.fit_booster(df.coalesce(1), names, "y", "w", p).ensemble
    assert np.allclose(many.margin(x), one.margin(x), atol=1e-9)


def same_trees(a, b):
    assert len(a.gains) == len(b.gains)
    for s, t, g, h in zip(a.ensemble.trees, b.ensemble.trees, a.gains, b.gains, strict=True):
        for k in ("left", "right", "feature", "threshold", "value", "cover"):
            assert np.array_equal(getattr(s, k), getattr(t, k)), k
        assert np.allclose(g, h, rtol=1e-12)


def test_one_stage_grows_all_trees(spark, monkeypatch):
    """A fit takes a few jobs, not one or more for each level of each tree, and grows the trees
    that one job a level grows."""
    from pyspark import RDD
    x, y, w = data(n=900)
    x = np.concatenate([x, x[:, 1:2].round(0), x[::-1]], 1)
    df, names = frame(spark, x, y, w)
    df, jobs, collect = df.repartition(5).persist(), [], RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda self: (jobs.append(1), collect(self))[1])
    p = B.BoosterParams(12, 4, 0.3, 0.7, 0.7)
    a = B.fit_booster(df, names, "y", "w", p)
    assert len(jobs) < 6
    monkeypatch.setattr(B, "RESIDENT_BYTES", 0)
    b = B.fit_booster(df, names, "y", "w", p)
    assert len(jobs) > 40
    same_trees(a, b)


def test_trees_do_not_depend_on_the_order_of_sums(spark, monkeypatch):
    x, y, w = data(n=500)
    df, names = frame(spark, x, y, w)
    p = B.BoosterParams(5, 4, 0.3, 1.0, 1.0)
    fits = [B.fit_booster(df.repartition(k).persist(), names, "y", "w", p) for k in (1, 7)]
    same_trees(*fits)
    monkeypatch.setattr(B, "JOINT", 1)
    same_trees(fits[0], B.fit_booster(df, names, "y", "w", p))


def test_no_column_with_a_cut_and_no_finite_weight(spark):
    df, names = frame(spark, np.full((20, 2), np.nan), np.array([1, 0] * 10))
    p = B.BoosterParams(2, 3, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0)
    got = B.fit_booster(df, names, "y", "w", p).ensemble
    assert [len(t.left) for t in got.trees] == [1, 1] and got.margin(np.zeros((1, 2)))[0] == 0.0
    assert B.unit(float("inf")) == B.unit(float("nan")) == B.unit(0.0) == 0.0


def test_joint_groups():
    for widths, most in (([3, 66, 4, 66, 2], 300), ([66, 66], 66), ([500], 10), ([2] * 9, 16)):
        got = B.joint(widths, most)
        assert sorted(k for g in got for k in g) == list(range(len(widths)))
        assert all(len(g) == 1 or np.prod([widths[k] for k in g]) <= most for g in got)
