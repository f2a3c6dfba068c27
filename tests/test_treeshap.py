"""TreeSHAP against its definition (all subsets), additivity for deep trees, missing values."""
import time
from itertools import combinations
from math import factorial

import numpy as np
import pytest

from ledgerscope.operators.treeshap import Explainer, tree_attributions
from ledgerscope.operators.trees import Tree, TreeEnsemble


def grown(rng, depth, n_features, full=False):
    """A random tree, children behind their parents, covers that add up."""
    t = {k: [] for k in ("left", "right", "feature", "threshold", "value", "cover")}

    def add(level, cover):
        n = len(t["left"])
        leaf = level == depth or (not full and level > 0 and rng.random() < 0.25)
        for k, v in zip(t, (-1, -1, -1, 0.0, rng.normal(), cover)):
            t[k].append(v)
        if not leaf:
            t["feature"][n], t["threshold"][n] = int(rng.integers(n_features)), rng.normal()
            share = rng.uniform(0.1, 0.9)
            t["left"][n] = add(level + 1, cover * share)
            t["right"][n] = add(level + 1, cover * (1 - share))
        return n
    add(0, 1000.0)
    return Tree(*[np.array(v, np.int64 if k in ("left", "right", "feature") else float) for k, v in t.items()])


def game(t, x, known, n=0):
    """Expected value of the tree at x when only the features in ``known`` are known."""
    if t.left[n] < 0:
        return t.value[n]
    a, b = t.left[n], t.right[n]
    if t.feature[n] in known:
        return game(t, x, known, a if x[t.feature[n]] <= t.threshold[n] else b)
    return (t.cover[a] * game(t, x, known, a) + t.cover[b] * game(t, x, known, b)) / t.cover[n]


def by_definition(model, x, m):
    phi = np.zeros(m)
    for j in range(m):
        rest = [k for k in range(m) if k != j]
        for size in range(m):
            for s in combinations(rest, size):
                w = factorial(size) * factorial(m - size - 1) / factorial(m)
                phi[j] += w * sum(game(t, x, {*s, j}) - game(t, x, set(s)) for t in model.trees)
    return phi


@pytest.mark.parametrize("depth", [0, 1, 2, 4, 7])
def test_equals_the_definition(depth):
    rng = np.random.default_rng(depth)
    m = 5
    model = TreeEnsemble([grown(rng, depth, m) for _ in range(4)], 0.3)
    x = rng.normal(size=(7, m))
    x[3, 2] = np.nan
    got = Explainer(model, m)
    phi, margin = got.explain(x)
    assert np.allclose(margin, model.margin(x), atol=1e-12)
    assert got.base == pytest.approx(0.3 + sum(game(t, x[0], set()) for t in model.trees))
    for i in range(len(x)):
        assert np.allclose(phi[i], by_definition(model, x[i], m), atol=1e-11)


def test_depth_beyond_a_subset_table():
    """Paths of 20 different features, more than any enumeration of subsets would carry."""
    rng = np.random.default_rng(9)
    m, depth = 20, 20
    left, right = np.full(2 * depth + 1, -1), np.full(2 * depth + 1, -1)
    feature, cover = np.full(2 * depth + 1, -1), np.ones(2 * depth + 1)
    for k in range(depth):               # a chain: node 2k splits on feature k
        left[2 * k], right[2 * k], feature[2 * k], cover[2 * k] = 2 * k + 1, 2 * k + 2, k, depth + 1 - k
    t = Tree(left, right, feature, rng.normal(size=2 * depth + 1), rng.normal(size=2 * depth + 1), cover)
    x = rng.normal(size=(50, m))
    got = Explainer(TreeEnsemble([t]), m)
    phi, margin = got.explain(x)
    assert np.allclose(got.base + phi.sum(1), margin, atol=1e-12)


def test_300_trees_of_depth_8_over_10000_rows(spark):
    rng = np.random.default_rng(1)
    m = 31
    model = TreeEnsemble([grown(rng, 8, m, full=True) for _ in range(300)])
    names = [f"f{i}" for i in range(m)]
    x = rng.normal(size=(10_000, m))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ["ID", *names]).repartition(8)
    began = time.time()
    got = tree_attributions(df, model, names, ["ID"]).toPandas().sort_values("ID")
    took = time.time() - began
    phi = got[[f"phi_{f}" for f in names]].to_numpy()
    assert np.abs(got["base_value"] + phi.sum(1) - model.margin(x)).max() < 1e-9
    assert np.abs(got["margin"] - model.margin(x)).max() < 1e-9
    print(f"explained in {took:.1f} s")


def test_tables_give_what_the_walk_gives(monkeypatch):
    """Trees of the preset's depth over repeated features, missing values among the rows; a path too
    long for a cell is walked, as are trees beyond the memory for tables."""
    from ledgerscope.operators import treeshap
    rng = np.random.default_rng(8)
    model = TreeEnsemble([grown(rng, d, 6, full=d == 5) for d in (5, 5, 0, 3, 6, 11)], -0.2)
    x = rng.normal(size=(300, 6))
    x[rng.random(x.shape) < 0.1] = np.nan
    got = Explainer(model, 6)
    phi, margin = got.explain(x)
    assert len(got.tables.cells) > 8 and len(got.walked) == 1
    monkeypatch.setattr(treeshap, "TABLE_BYTES", 0)
    walk = Explainer(model, 6)
    phi2, margin2 = walk.explain(x)
    assert len(walk.walked) == 5
    assert np.allclose(phi, phi2, atol=1e-12) and np.allclose(margin, margin2, atol=1e-12)


def test_rows_of_the_preset_are_explained_by_look_ups():
    """300 trees of depth 5: the walk took over 1 ms a row."""
    rng = np.random.default_rng(9)
    grid = np.round(rng.normal(size=(31, 63)), 3)
    model = TreeEnsemble([grown(rng, 5, 31, full=True) for _ in range(300)])
    for t in model.trees:                         # thresholds are cuts of 64 bins
        t.threshold[:] = grid[t.feature, rng.integers(63, size=len(t.feature))]
    got, x = Explainer(model, 31), rng.normal(size=(10_000, 31))
    got.explain(x[:10])
    begun = time.process_time()
    phi, margin = got.explain(x)
    assert time.process_time() - begun < 3
    assert np.allclose(got.base + phi.sum(1), margin, atol=1e-9)
