"""Training, calibration, persistence (intent of the original training tests)."""
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerscope.operators import models as MD
from ledgerscope.plans.train import batch_score_job, score_with_bundle, train


@pytest.fixture(scope="module")
def trained(raw_df):
    return train(raw_df, booster_params={"n_estimators": 30}, validate=True)


def test_metrics_in_range_and_calibration_helps(trained):
    m = {r.model: r for r in trained.metrics.collect()}
    assert set(m) == {"logistic", "booster_raw", "booster_calibrated"}
    for r in m.values():
        assert 0.0 <= r.roc_auc <= 1.0 and 0.0 <= r.brier_score <= 1.0
    assert m["booster_calibrated"].brier_score <= m["booster_raw"].brier_score + 0.10
    imp = trained.importances.collect()
    assert len(imp) == 31 and all(r.importance >= 0 for r in imp)


def test_probabilities_in_unit_interval_and_rows_kept(trained, raw_df):
    scored = score_with_bundle(raw_df, trained.booster)
    assert scored.count() == raw_df.count()
    assert scored.where((F.col("p") < 0) | (F.col("p") > 1)).count() == 0


def test_bundle_round_trip_and_batch_job(trained, raw_df):
    path = tempfile.mkdtemp(prefix="ls-bundle-") + "/xgb_calibrated"
    trained.booster.save(path)
    loaded = MD.load_bundle(path)
    a = score_with_bundle(raw_df, trained.booster).select("ID", "risk_score").collect()
    b = score_with_bundle(raw_df, loaded).select("ID", "risk_score").collect()
    assert sorted(a) == sorted(b)
    scored, summary = batch_score_job(raw_df.drop("default_payment_next_month"), loaded)
    assert scored.count() == 200 and summary.agg(F.sum("n_records")).first()[0] == 200


def test_missing_artifact_names_training_step(spark):
    with pytest.raises(FileNotFoundError, match="training"):
        MD.load_bundle(tempfile.mkdtemp() + "/nothing")


def test_sigmoid_calibration_monotone(spark, raw_df):
    df = raw_df.select(F.col("default_payment_next_month"), (F.col("PAY_0") + 2) / 11.0)
    df = df.toDF("default_payment_next_month", "p_raw")
    cal = MD.fit_sigmoid(df)
    out = cal.apply(df).select("p_raw", "p").distinct().orderBy("p_raw").collect()
    ps = [r.p for r in out]
    assert ps == sorted(ps) or ps == sorted(ps, reverse=True)


def test_treeshap_of_both_boosters(trained, raw_df):
    """Our trees and Spark's: attributions add up to the margin, unused features get nothing."""
    from pyspark.ml.functions import vector_to_array

    from ledgerscope.operators import treeshap
    from ledgerscope.operators.features import add_derived_features
    from ledgerscope.operators.models import assemble
    from ledgerscope.operators.prep import clean_raw
    b = trained.booster
    x = b.scaler.transform(add_derived_features(clean_raw(raw_df, keep_id=True)))
    spark_model = MD.train_fallback_booster(x, b.features, params={"n_estimators": 5})
    for model, raw, used in (
            (b.model.ensemble, MD.tree_probability(b.model.ensemble, x, b.features).select("ID", F.log(F.col("p_raw") / (1 - F.col("p_raw"))).alias("m")),
             {int(f) for t in b.model.ensemble.trees for f in t.feature[t.left >= 0]}),
            (spark_model, spark_model.transform(assemble(x, b.features)).select("ID", (2 * vector_to_array("rawPrediction")[1]).alias("m")),
             {int(i) for i in spark_model.featureImportances.indices})):
        shap = treeshap.tree_attributions(x, model, b.features, ["ID"]).toPandas().set_index("ID")
        want = raw.toPandas().set_index("ID").loc[shap.index, "m"]
        phis = shap[[f"phi_{f}" for f in b.features]].sum(axis=1)
        assert ((shap["base_value"] + phis - want).abs() < 1e-9).all()
        assert ((shap["margin"] - want).abs() < 1e-9).all()
        for j, f in enumerate(b.features):
            if j not in used:
                assert (shap[f"phi_{f}"].abs() < 1e-12).all()


def test_list_artifacts(spark, trained):
    root = tempfile.mkdtemp(prefix="ls-registry-")
    assert MD.list_artifacts(root + "/none") == []
    for name in ("b", "a"):
        trained.logistic.save(f"{root}/{name}")
    assert MD.list_artifacts(root) == MD.list_artifacts("file://" + root) == ["a", "b"]


def test_batch_job_publishes_or_discards(trained, raw_df, tmp_path):
    """A bad batch leaves the last good output and no staged rows; the rows are read once."""
    raw = raw_df.drop("default_payment_next_month")
    path = str(tmp_path / "scored")
    read = raw.sparkSession.sparkContext.accumulator(0)

    def counted(frames):
        for pdf in frames:
            read.add(len(pdf))
            yield pdf
    out, _ = batch_score_job(raw.mapInPandas(counted, raw.schema), trained.logistic, path)
    assert out.count() == 200 and read.value == 200
    bad = raw.withColumn("AGE", F.when(F.col("ID") % 10 != 0, F.col("AGE"))).withColumn("LIMIT_BAL", F.when(F.col("ID") == 3, float("inf")).otherwise(F.col("LIMIT_BAL")))
    with pytest.raises(ValueError, match="AGE:missing.*LIMIT_BAL:inf"):
        batch_score_job(bad, trained.logistic, path)
    with pytest.raises(ValueError, match="AGE:missing_column"):
        batch_score_job(raw.drop("AGE"), trained.logistic, path)
    assert [p.name for p in tmp_path.iterdir()] == ["scored"]
    assert raw.sparkSession.read.parquet(path).count() == 200
    again, summary = batch_score_job(raw.where("ID <= 50"), trained.booster, path)
    assert again.count() == 50 and summary.agg(F.sum("n_records")).first()[0] == 50 and [p.name for p in tmp_path.iterdir()] == ["scored"]


def test_rows_walk_the_trees_as_one_by_one_and_faster():
    import time

    from ledgerscope.operators.trees import Tree, TreeEnsemble

    def grown(rng, depth):
        left, right, feature, threshold, todo = [-1], [-1], [0], [0.0], [(0, 0)]
        while todo:
            n, d = todo.pop()
            if d < depth and (d < 2 or rng.random() < 0.9):
                feature[n], threshold[n] = int(rng.integers(0, 6)), float(rng.normal())
                left[n], right[n] = len(left), len(left) + 1
                for col, v in ((left, -1), (right, -1), (feature, 0), (threshold, 0.0)):
                    col += [v, v]
                todo += [(left[n], d + 1), (right[n], d + 1)]
        return Tree(*(np.array(c) for c in (left, right, feature, threshold)), rng.normal(size=len(left)), np.ones(len(left)))

    def walked(t, x):
        at = np.zeros(len(x), np.int64)
        while len(inner := np.flatnonzero(t.left[at] >= 0)):
            node = at[inner]
            at[inner] = np.where(x[inner, t.feature[node]] <= t.threshold[node], t.left[node], t.right[node])
        return at
    rng = np.random.default_rng(5)
    trees = [grown(rng, d) for d in (0, 1, 5, 8)] + [grown(rng, 5) for _ in range(40)]
    x = rng.normal(size=(20_000, 6))
    x[rng.random(x.shape) < 0.1] = np.nan
    x[0], x[1] = np.inf, -np.inf
    for t in trees:
        assert np.array_equal(t.leaves(x), walked(t, x))
    start, want = time.perf_counter(), np.zeros(len(x))
    for t in trees:
        want += t.value[walked(t, x)]
    middle = time.perf_counter()
    got = TreeEnsemble(trees).margin(x)
    assert time.perf_counter() - middle < 0.8 * (middle - start)
    assert np.array_equal(got, want)
    assert TreeEnsemble(trees[:1]).margin(np.zeros((3, 0))).tolist() == [trees[0].value[0]] * 3
