"""The sampler finds the better region; budgets hold; all eight ranges reach the model."""
import time

import numpy as np
import pytest

from ledgerscope.operators import search as S
from ledgerscope.operators.models import SEARCH_SPACE


def test_guided_beats_random():
    """On a smooth function of eight parameters the guided trials are better than the first ones."""
    target = {k: 0.7 if i % 2 else 0.3 for i, k in enumerate(SEARCH_SPACE)}
    helper = S.DensityRatioSampler(SEARCH_SPACE)

    def value(params, late):
        u = dict(zip(SEARCH_SPACE, helper.unit(params)))
        return -sum((u[k] - target[k]) ** 2 for k in target)
    better = 0
    for seed in range(5):
        ran = S.maximise(value, SEARCH_SPACE, 60, 60, 1, seed)
        v = [r[2] for r in ran]
        better += np.mean(v[-20:]) > np.mean(v[:S.STARTUP]) + 0.1
    assert better >= 4


def test_ranges_and_types():
    sampler = S.DensityRatioSampler(SEARCH_SPACE, seed=1)
    seen = []
    for i in range(80):
        p = sampler.propose()
        sampler.finished(p, float(i % 7))
        seen.append(p)
        for k, (lo, hi, log) in SEARCH_SPACE.items():
            assert lo <= p[k] <= hi
            if isinstance(lo, int) and not log:
                assert isinstance(p[k], int)
        back = sampler.params(sampler.unit(p))
        assert all(back[k] == pytest.approx(p[k], rel=1e-9) for k in p)
    assert all(len({p[k] for p in seen}) > 3 for k in SEARCH_SPACE)


def test_time_budget_and_failures():
    began = time.monotonic()

    def slow(params, late):
        time.sleep(0.2)
        return None
    ran = S.maximise(slow, {"a": (0.0, 1.0, False)}, 50, 0.5, 2)
    assert time.monotonic() - began < 3 and 1 <= len(ran) <= 12 and all(r[2] is None for r in ran)


def test_search_booster(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3))
    y = (rng.random(300) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(t)) for r, t in zip(x, y)], "a double, b double, c double, y int")
    space = {**SEARCH_SPACE, "n_estimators": (1, 3, False), "max_depth": (1, 3, False)}
    got = S.search_booster(df.where("b < 0.3"), df.where("b >= 0.3"), ["a", "b", "c"], "y", trials=4, seconds=120, parallel=2, space=space)
    rows = got.trials.collect()
    assert 1 <= len(rows) <= 4 and got.best_value == max(r.roc_auc for r in rows) > 0.5
    assert set(got.best_params) == set(SEARCH_SPACE)
    with pytest.raises(ValueError, match="labels"):
        S.search_booster(df, df.where("1 = 0"), ["a"], "y", trials=1, space=space)
