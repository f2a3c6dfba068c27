"""Score with drivers: the dispatch on the model, both kinds of drivers, rows with gaps."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerscope.operators import models as MD
from ledgerscope.operators.attribution import LinearScorer
from ledgerscope.operators.explain import explainer, score_with_drivers
from ledgerscope.operators.features import add_derived_features
from ledgerscope.operators.prep import clean_raw, fit_scaler
from ledgerscope.operators.treeshap import Explainer
from ledgerscope.plans.train import train
from ledgerscope.schema import MODEL_FEATURES, SCALE_COLS
from conftest import SAMPLE_RECORD


@pytest.fixture(scope="module")
def trained(raw_df):
    return train(raw_df, booster_params={"n_estimators": 12, "max_depth": 3})


def check_rows(got, raw, n):
    assert got.columns == [*raw.columns, "default_probability", "risk_score", "risk_band", "top_drivers"]
    rows = got.collect()
    assert len(rows) == raw.count()
    for r in rows:
        size = [abs(x.shap_value) for x in r.top_drivers]
        assert len(size) == n and size == sorted(size, reverse=True)
        assert all((x.direction == "increases_risk") == (x.shap_value > 0) or x.shap_value == 0 for x in r.top_drivers)
    return {r.ID: r for r in rows}


def test_dispatch(trained, raw_df):
    assert isinstance(explainer(trained.logistic), LinearScorer)
    assert isinstance(explainer(trained.booster), Explainer)          # through the calibrator
    fixed = MD.ModelBundle(["AGE"], trained.logistic.scaler, LinearScorer(0.0, {"AGE": 1.0}), "linear")
    assert isinstance(explainer(fixed), LinearScorer)
    x = trained.booster.scaler.transform(add_derived_features(clean_raw(raw_df, keep_id=True)))
    gbt = MD.train_fallback_booster(x, trained.booster.features, params={"n_estimators": 3})
    assert isinstance(explainer(MD.ModelBundle(trained.booster.features, trained.booster.scaler, gbt, "booster")), Explainer)


def test_linear_and_tree_bundles(trained, raw_df):
    raw = raw_df.drop("default_payment_next_month")
    for bundle in (trained.logistic, trained.booster):
        by = check_rows(score_with_drivers(raw, bundle, n=4), raw, 4)
        want = {r.ID: r for r in MD.ModelBundle.predict(bundle, add_derived_features(clean_raw(raw, keep_id=True))).collect()}
        for i, r in by.items():
            assert r.default_probability == pytest.approx(want[i].p, abs=5.1e-5)
    # the drivers of the linear model are coefficient times scaled value
    coef = dict(zip(trained.logistic.features, trained.logistic.model.coefficients.toArray()))
    for r in check_rows(score_with_drivers(raw, trained.logistic), raw, 5).values():
        for x in r.top_drivers:
            assert x.shap_value == pytest.approx(coef[x.feature] * x.feature_value, abs=2e-4 * (1 + abs(coef[x.feature])))


def test_gaps_and_unknown_model(spark, trained, raw_df):
    one = spark.createDataFrame([(1, *[None if k == "PAY_6" else v for k, v in SAMPLE_RECORD.items()])],
                                raw_df.drop("default_payment_next_month").schema)
    r = score_with_drivers(one, trained.logistic).first()
    assert r.risk_score is None and "PAY_6" not in {x.feature for x in r.top_drivers} and len(r.top_drivers) == 5
    r = score_with_drivers(one, trained.booster).first()             # trees send a missing value right
    assert 0 <= r.risk_score <= 100 and len(r.top_drivers) == 5

    class Odd(MD.ModelBundle):
        def predict(self, df):
            return self.aligned(df).withColumns({"p_raw": F.lit(0.42), "p": F.lit(0.42)})
    r = score_with_drivers(one, Odd(MODEL_FEATURES, trained.logistic.scaler, object(), "odd")).first()
    assert (r.risk_score, r.risk_band, r.top_drivers) == (42, "Medium", [])
    assert score_with_drivers(one.where("1 = 0"), trained.booster).count() == 0


def test_late_payer_scores_no_lower(spark, raw_df):
    f = add_derived_features(clean_raw(raw_df, keep_id=True))
    bundle = MD.ModelBundle(list(MODEL_FEATURES), fit_scaler(f.select(*SCALE_COLS)),
                            LinearScorer(-1.0, {"max_delinquency": 0.9, "PAY_0": 0.5}), "linear")
    late = SAMPLE_RECORD | {"PAY_0": 3, "PAY_2": 2}
    two = spark.createDataFrame([(1, *SAMPLE_RECORD.values()), (2, *late.values())], raw_df.drop("default_payment_next_month").schema)
    by = {r.ID: r for r in score_with_drivers(two, bundle).collect()}
    assert by[2].risk_score > by[1].risk_score
    assert by[2].top_drivers[0].feature == "max_delinquency" and np.sign(by[2].top_drivers[0].shap_value) == 1


def test_features_go_to_python_once(spark):
    """Features are not carried through the TreeSHAP pass beside the numbers made of them."""
    from ledgerscope.operators.explain import _tree_pass
    from ledgerscope.operators.trees import Tree, TreeEnsemble
    from ledgerscope.operators.treeshap import Explainer
    tree = Tree(*(np.array(v) for v in ([1, -1, -1], [2, -1, -1], [1, 0, 0])), np.array([2.5, 0.0, 0.0]), np.array([0.0, -1.0, 3.0]), np.array([4.0, 3.0, 1.0]))
    df = spark.createDataFrame([(7, 1, 9.0, "x"), (8, 2, None, None)], "id int, a int, b double, c string")
    got = _tree_pass(df, Explainer(TreeEnsemble([tree]), 2), ["a", "b"], 1)
    assert got.columns == ["id", "c", "p_raw", "drivers"]
    rows = got.orderBy("id").collect()
    assert [(r["id"], r["c"], r["drivers"][0]["feature"], r["drivers"][0]["feature_value"]) for r in rows] == [(7, "x", "b", 9.0), (8, None, "b", None)]
    assert all(r["p_raw"] == 1 / (1 + np.exp(-3.0)) for r in rows)
