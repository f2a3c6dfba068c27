"""Queries over trained models. Their rows depend on the fit, so SQL checks what must hold for
any fit: residuals that are zero and counts that the data fix. One fit serves all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.operators import models as MD
from ledgerscope.operators import treeshap
from ledgerscope.operators.attribution import global_importance
from ledgerscope.operators.explain import score_with_drivers
from ledgerscope.plans import oracle_sql as O
from ledgerscope.plans.q_eval import SPLIT
from ledgerscope.plans.queries import credit, register, sql
from ledgerscope.plans.train import TrainResult, train
from ledgerscope.schema import TARGET
from ledgerscope.session import stored
from ledgerscope.sources import credit as src

_FITTED: dict[tuple[str, str], TrainResult] = {}


def fitted(spark, sf) -> TrainResult:
    """The training job of this application on the snapshots with six months, run once."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FITTED:
        _FITTED[key] = train(src.credit(spark, sf))
    return _FITTED[key]


def _test_attributions(spark, sf) -> DataFrame:
    res = fitted(spark, sf)
    b = res.booster
    test = res.split.where(F.col("split") == "test")
    return treeshap.tree_attributions(b.scaler.transform(test), b.model.ensemble, b.features, ["ID"])


@register("train_and_compare")
def q_train_and_compare(spark, sf):
    """Full training job: balanced logistic, boosted trees with the original preset,
    isotonic-calibrated booster; test-split comparison table."""
    return fitted(spark, sf).comparison


@register("tree_attribution")
def q_tree_attribution(spark, sf):
    """Exact TreeSHAP of the trained booster (uncalibrated margin) over the whole test
    split (no sampling); global mean |attribution| per feature."""
    b = fitted(spark, sf).booster
    return global_importance(treeshap.as_attribution_array(_test_attributions(spark, sf), b.features)).drop("pos")


@register("tree_attribution_additivity", sql(O.CREDIT_ALL, SPLIT, body="""
SELECT COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS n_off_margin, CAST(0 AS BIGINT) AS n_off_score
FROM splits WHERE split = 'test'"""))
def q_tree_attribution_additivity(spark, sf):
    """Test rows whose attributions do not add up to the margin, or whose margin is not that
    of the scored probability."""
    b = fitted(spark, sf).booster
    shap = _test_attributions(spark, sf)
    total = sum((F.col(f"phi_{f}") for f in b.features), F.col("base_value"))
    test = fitted(spark, sf).split.where(F.col("split") == "test")
    p = b.predict(test).select("ID", "p_raw")
    odds = F.log(F.col("p_raw") / (1 - F.col("p_raw")))
    return shap.withColumn("total", total).join(p, "ID").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.abs(F.col("total") - F.col("margin")) > 1e-9).alias("n_off_margin"),
        F.count_if(F.abs(odds - F.col("margin")) > 1e-6).alias("n_off_score"))


@register("tree_score_with_drivers", sql(O.CREDIT_ALL, body="""
SELECT COUNT(*) AS n_rows, COUNT(*) AS n_scored, 5 * COUNT(*) AS n_drivers, CAST(0 AS BIGINT) AS n_out_of_order FROM credit"""))
def q_tree_score_with_drivers(spark, sf):
    """C7 with the trained booster on every snapshot, missing months included."""
    got = score_with_drivers(credit(spark, sf), fitted(spark, sf).booster)
    sizes = F.transform("top_drivers", lambda x: -F.abs(x["shap_value"]))
    return got.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("risk_score").between(0, 100)).alias("n_scored"),
                   F.sum(F.size("top_drivers")).alias("n_drivers"), F.count_if(F.sort_array(sizes) != sizes).alias("n_out_of_order"))


@register("model_residuals", sql(O.CREDIT_ALL, SPLIT, body="""
, n AS (SELECT COUNT(*) FILTER (WHERE split = 'train') AS tr, COUNT(*) FILTER (WHERE split = 'val') AS va,
               COUNT(*) FILTER (WHERE split = 'val' AND y = 1) AS vp, COUNT(*) FILTER (WHERE split = 'test') AS te FROM splits)
SELECT v.* FROM n, LATERAL (VALUES
  ('logistic_gradient_is_zero', tr, true), ('isotonic_keeps_the_label_sum', vp, true),
  ('sigmoid_keeps_the_target_sum', va, true), ('importances_sum_to_one', CAST(31 AS BIGINT), true),
  ('hard_predictions_follow_the_threshold', te, true)) AS v(check_name, n, holds)"""))
def q_model_residuals(spark, sf):
    """Equations that every right fit fulfils: the logistic model's gradient with its penalty
    (M1), sums that calibrators keep (C1, C2), importances (M6) and hard predictions (C3)."""
    res = fitted(spark, sf)
    lr, tree, split = res.logistic, res.booster, res.split
    part = {k: split.where(F.col("split") == k) for k in ("train", "val", "test")}
    y = F.col(TARGET)
    # M1: mean weighted (p - y) x plus the penalty's share, for every coefficient and the intercept
    cw = MD.class_weights(part["train"]).first()
    w = F.when(y == 1, cw["weight_pos"]).otherwise(cw["weight_neg"])
    coef = dict(zip(lr.features, lr.model.coefficients.toArray().tolist()))
    scored = lr.predict(part["train"])
    slope = [F.abs(F.avg(w * (F.col("p") - y) * F.col(f)) + coef[f] / F.count(F.lit(1))) for f in lr.features]
    size = [F.avg(w * F.abs(F.col("p") - y) * F.abs(F.col(f))) for f in lr.features]
    g = scored.agg(F.count(F.lit(1)).alias("n"), F.greatest(*[s / (1 + z) for s, z in zip(slope, size)],
                                                            F.abs(F.avg(w * (F.col("p") - y)))).alias("worst"))
    one = g.select(F.lit("logistic_gradient_is_zero").alias("check_name"), "n", (F.col("worst") < 1e-2).alias("holds"))
    val = stored(tree.predict(part["val"]).select("p_raw", "p", TARGET), "validation")
    two = val.agg(F.sum(y).cast("long").alias("n"), (F.abs(F.sum("p") - F.sum(y)) < 1e-6 * F.count(F.lit(1))).alias("holds")).select(
        F.lit("isotonic_keeps_the_label_sum").alias("check_name"), "n", "holds")
    cal = MD.fit_sigmoid(val)
    hi, lo = (F.sum(y) + 1.0) / (F.sum(y) + 2.0), 1.0 / (F.sum(1 - y) + 2.0)
    three = cal.apply(val, out="q").agg(
        F.count(F.lit(1)).alias("n"),
        (F.abs(F.sum("q") - hi * F.sum(y) - lo * F.sum(1 - y)) < 1e-3 * F.count(F.lit(1))).alias("holds")).select(
        F.lit("sigmoid_keeps_the_target_sum").alias("check_name"), "n", "holds")
    four = res.importances.agg(F.count(F.lit(1)).alias("n"), ((F.abs(F.sum("importance") - 1) < 1e-9) & (F.min("importance") >= 0)).alias("holds")) \
        .select(F.lit("importances_sum_to_one").alias("check_name"), "n", "holds")
    five = MD.hard_prediction(tree.predict(part["test"])).agg(
        F.count(F.lit(1)).alias("n"), (F.count_if((F.col("p") >= 0.5) != (F.col("prediction") == 1)) == 0).alias("holds")).select(
        F.lit("hard_predictions_follow_the_threshold").alias("check_name"), "n", "holds")
    return one.unionByName(two).unionByName(three).unionByName(four).unionByName(five)
