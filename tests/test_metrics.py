"""Evaluation metrics against NumPy brute force (ties, edge cases)."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerscope.operators import metrics as M


def _auc_brute(y, p):
    pos, neg = p[y == 1], p[y == 0]
    s = sum((pp > neg).sum() + 0.5 * (pp == neg).sum() for pp in pos)
    return s / (len(pos) * len(neg))


def _ap_brute(y, p):
    ap, prev_r = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        pred = p >= t
        tp = (pred & (y == 1)).sum()
        r = tp / (y == 1).sum()
        ap += (r - prev_r) * tp / pred.sum()
        prev_r = r
    return ap


@pytest.fixture(scope="module")
def preds(spark):
    rng = np.random.default_rng(7)
    y = rng.integers(0, 2, 400)
    p = np.round(np.clip(0.3 * y + rng.normal(0.35, 0.2, 400), 0, 1), 2)   # many ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double")
    return y, p, df


def test_auc_ap_brier_match_brute_force(preds):
    y, p, df = preds
    m = M.compute_metrics(df).first()
    assert m["roc_auc"] == pytest.approx(_auc_brute(y, p), abs=1e-12)
    assert m["pr_auc"] == pytest.approx(_ap_brute(y, p), abs=1e-12)
    assert m["brier_score"] == pytest.approx(np.mean((p - y) ** 2), abs=1e-12)
    yhat = (p >= 0.5).astype(int)
    tp = int(((yhat == 1) & (y == 1)).sum())
    assert m["tp"] == tp and m["support_total"] == 400
    assert m["f1"] == pytest.approx(2 * tp / (2 * tp + ((yhat == 1) & (y == 0)).sum() + ((yhat == 0) & (y == 1)).sum()))


def test_sweep_matches_brute_force(preds):
    y, p, df = preds
    sw = {round(r["threshold"], 6): r for r in M.threshold_sweep(df).collect()}
    assert len(sw) == 91
    for t in np.linspace(0.05, 0.95, 91):
        r = sw[round(float(t), 6)]
        assert r["tp"] == int(((p >= t) & (y == 1)).sum())
        assert r["fp"] == int(((p >= t) & (y == 0)).sum())
    best = M.best_threshold(M.threshold_sweep(df)).first()
    f1s = [sw[round(float(t), 6)]["f1"] for t in np.linspace(0.05, 0.95, 91)]
    assert best["threshold"] == pytest.approx(float(np.linspace(0.05, 0.95, 91)[int(np.argmax(f1s))]))


def test_one_class_and_zero_division(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "y int, p double")
    m = M.compute_metrics(df).first()
    assert m["roc_auc"] is None and m["precision"] == 0.0 and m["f1"] == 0.0
    assert (m["tn"], m["fp"], m["fn"], m["tp"]) == (2, 0, 0, 0)


def test_calibration_edges_go_left(spark):
    df = spark.createDataFrame([(1, 0.1), (0, 0.1000001), (1, 1.0), (0, 0.0)], "y int, p double")
    bins = {r["bin"]: r["n"] for r in M.calibration_curve(df).collect()}
    assert bins == {0: 2, 1: 1, 9: 1}
