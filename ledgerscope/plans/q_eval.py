"""Queries: stratified split, evaluation metrics (E1-E11), cost cut-off (Z2), fairness.

Evaluation input: every credit snapshot scored by two fixed models ('demo' and
'late_only'), long form (ID, SEX, MARRIAGE, y, model, p).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerscope.functions.scoring import demo_probability, late_only_probability
from ledgerscope.operators import metrics as M
from ledgerscope.operators import prep
from ledgerscope.operators.scoring import build_score_output
from ledgerscope.plans import oracle_sql as O
from ledgerscope.plans.queries import features, register, round_doubles, sql
from ledgerscope.schema import TARGET
from ledgerscope.sources import credit as src

d = O.d
LATE_P = f"ROUND({d(1.0)} / ({d(1.0)} + EXP(-({d(-2.5)} + {d(1.0)} * delinquency_count))), 4)"
EV = f"""ev AS (
  SELECT ID, SEX, MARRIAGE, default_payment_next_month AS y, 'demo' AS model, {O.DEMO_P} AS p FROM feat
  UNION ALL
  SELECT ID, SEX, MARRIAGE, default_payment_next_month AS y, 'late_only' AS model, {LATE_P} AS p FROM feat)"""
EVB = [O.CREDIT_ALL, O.clean_cte(), O.feat_cte(), EV]


def eval_frame(spark, sf, raw=None):
    f = features(spark, sf, raw).select("ID", "SEX", "MARRIAGE", F.col(TARGET).alias("y"),
                                   demo_probability().alias("demo"),
                                   late_only_probability().alias("late_only"))
    return f.unpivot(["ID", "SEX", "MARRIAGE", "y"], ["demo", "late_only"], "model", "p")


# ------------------------------------------------------------------------ split
VAL_REL = prep.VAL_SIZE / (1.0 - prep.TEST_SIZE)
SPLIT = f"""sp AS (
  SELECT ID, default_payment_next_month AS y,
         ROW_NUMBER() OVER (PARTITION BY default_payment_next_month
                            ORDER BY ((ID % 2147483647) * 48271) % 2147483647, ID) AS r,
         COUNT(*) OVER (PARTITION BY default_payment_next_month) AS nc
  FROM credit_full),
sp2 AS (SELECT *, CAST(CEIL(nc * {d(prep.TEST_SIZE)}) AS BIGINT) AS nt FROM sp),
splits AS (
  SELECT ID, y, CASE WHEN r <= nt THEN 'test'
                     WHEN r <= nt + CAST(CEIL((nc - nt) * {d(VAL_REL)}) AS BIGINT) THEN 'val'
                     ELSE 'train' END AS split
  FROM sp2)"""


def split_frame(spark, sf):
    return prep.stratified_split(src.credit(spark, sf))


@register("stratified_split", sql(O.CREDIT_ALL, SPLIT, body="SELECT ID, split FROM splits"))
def q_stratified_split(spark, sf):
    return split_frame(spark, sf).select("ID", "split")


@register("split_summary", sql(O.CREDIT_ALL, SPLIT, body="""
SELECT split, COUNT(*) AS n_rows, ROUND(AVG(CAST(y AS DOUBLE)), 6) AS default_rate
FROM splits GROUP BY split"""))
def q_split_summary(spark, sf):
    return prep.split_summary(split_frame(spark, sf))


# ------------------------------------------------------------------ rank metrics
CV = """cv AS (SELECT model, p, COUNT(*) FILTER (WHERE y = 1) AS pos, COUNT(*) FILTER (WHERE y <> 1) AS neg
       FROM ev WHERE p IS NOT NULL AND y IS NOT NULL GROUP BY model, p)"""
AUC = """auc AS (
  SELECT model, SUM(pos * (cum_neg - neg + CAST(neg AS DOUBLE) / 2)) / (CAST(SUM(pos) AS DOUBLE) * SUM(neg)) AS roc_auc
  FROM (SELECT *, SUM(neg) OVER (PARTITION BY model ORDER BY p) AS cum_neg FROM cv) GROUP BY model)"""
AP = """ap AS (
  SELECT model, SUM(pos * (CAST(cp AS DOUBLE) / (cp + cn))) / SUM(pos) AS pr_auc
  FROM (SELECT *, SUM(pos) OVER (PARTITION BY model ORDER BY p DESC) AS cp,
                  SUM(neg) OVER (PARTITION BY model ORDER BY p DESC) AS cn FROM cv) GROUP BY model)"""
BR = "br AS (SELECT model, AVG(POWER(p - y, 2)) AS brier_score FROM ev GROUP BY model)"
TM = """tm0 AS (
  SELECT model,
         COUNT(*) FILTER (WHERE y = 1 AND p >= 0.5) AS tp, COUNT(*) FILTER (WHERE y <> 1 AND p >= 0.5) AS fp,
         COUNT(*) FILTER (WHERE y = 1 AND NOT (p >= 0.5)) AS fn, COUNT(*) FILTER (WHERE y <> 1 AND NOT (p >= 0.5)) AS tn,
         AVG(CAST(y AS DOUBLE)) AS default_rate, AVG(CAST(CAST(p >= 0.5 AS INTEGER) AS DOUBLE)) AS predicted_default_rate
  FROM ev GROUP BY model),
tm AS (
  SELECT model,
    CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
    CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall,
    CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END AS f1,
    tp, fp, fn, tn, tp + fn AS support_positive, tp + fp + fn + tn AS support_total,
    default_rate, predicted_default_rate
  FROM tm0)"""
EVAL_ALL = EVB + [CV, AUC, AP, BR, TM]


@register("roc_auc", sql(*EVB, CV, AUC, body="SELECT model, ROUND(roc_auc, 6) AS roc_auc FROM auc"))
def q_roc_auc(spark, sf):
    return round_doubles(M.roc_auc(eval_frame(spark, sf), ["model"]))


@register("average_precision", sql(*EVB, CV, AP, body="SELECT model, ROUND(pr_auc, 6) AS pr_auc FROM ap"))
def q_average_precision(spark, sf):
    return round_doubles(M.average_precision(eval_frame(spark, sf), ["model"]))


@register("brier", sql(*EVB, BR, body="SELECT model, ROUND(brier_score, 6) AS brier_score FROM br"))
def q_brier(spark, sf):
    return round_doubles(M.brier(eval_frame(spark, sf), ["model"]))


_TM_COLS = ("ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall, ROUND(f1, 6) AS f1, "
            "tp, fp, fn, tn, support_positive, support_total, ROUND(default_rate, 6) AS default_rate, "
            "ROUND(predicted_default_rate, 6) AS predicted_default_rate")


@register("threshold_metrics", sql(*EVB, TM, body=f"SELECT model, {_TM_COLS} FROM tm"))
def q_threshold_metrics(spark, sf):
    return round_doubles(M.threshold_metrics(eval_frame(spark, sf), ["model"]))


@register("confusion_matrix", sql(*EVB, TM, body="SELECT model, tn, fp, fn, tp FROM tm"))
def q_confusion_matrix(spark, sf):
    return M.confusion_matrix(eval_frame(spark, sf), ["model"]).drop("matrix")


@register("model_metrics", sql(*EVAL_ALL, body=f"""
SELECT model, ROUND(roc_auc, 6) AS roc_auc, ROUND(pr_auc, 6) AS pr_auc, ROUND(brier_score, 6) AS brier_score,
       {_TM_COLS}, {d(0.5)} AS threshold
FROM auc JOIN ap USING (model) JOIN br USING (model) JOIN tm USING (model)"""))
def q_model_metrics(spark, sf):
    return round_doubles(M.compute_metrics(eval_frame(spark, sf), ["model"]))


@register("compare_models", sql(*EVAL_ALL, body="""
SELECT model, ROUND(roc_auc, 4) AS roc_auc, ROUND(pr_auc, 4) AS pr_auc, ROUND(brier_score, 4) AS brier_score,
       ROUND(f1, 4) AS f1, ROUND(recall, 4) AS recall, ROUND(precision, 4) AS precision
FROM auc JOIN ap USING (model) JOIN br USING (model) JOIN tm USING (model)"""))
def q_compare_models(spark, sf):
    return M.compare_models(M.compute_metrics(eval_frame(spark, sf), ["model"]))


# ---------------------------------------------------------------- by split
SPLIT_EV = f"""evs AS (SELECT ev.*, s.split FROM ev JOIN splits s USING (ID))"""


@register("model_metrics_by_split", sql(*EVB, SPLIT, SPLIT_EV, body="""
, cvs AS (SELECT model, split, p, COUNT(*) FILTER (WHERE y = 1) AS pos, COUNT(*) FILTER (WHERE y <> 1) AS neg
          FROM evs GROUP BY model, split, p)
SELECT model, split,
  ROUND(SUM(pos * (cum_neg - neg + CAST(neg AS DOUBLE) / 2)) / (CAST(SUM(pos) AS DOUBLE) * SUM(neg)), 6) AS roc_auc
FROM (SELECT *, SUM(neg) OVER (PARTITION BY model, split ORDER BY p) AS cum_neg FROM cvs)
GROUP BY model, split"""))
def q_model_metrics_by_split(spark, sf):
    ev = eval_frame(spark, sf).join(split_frame(spark, sf).select("ID", "split"), "ID")
    return round_doubles(M.roc_auc(ev, ["model", "split"]))


# ------------------------------------------------------------- threshold sweep
_TS = ", ".join(f"({i + 1}, {d(t)})" for i, t in enumerate(M.THRESHOLDS))
SWEEP = f"""grid AS (SELECT * FROM (VALUES {_TS}) AS g(j, threshold)),
sw0 AS (
  SELECT ev.model, g.threshold,
         COUNT(*) FILTER (WHERE ev.y = 1 AND ev.p >= g.threshold) AS tp,
         COUNT(*) FILTER (WHERE ev.y <> 1 AND ev.p >= g.threshold) AS fp,
         COUNT(*) FILTER (WHERE ev.y = 1 AND ev.p < g.threshold) AS fn,
         COUNT(*) FILTER (WHERE ev.y <> 1 AND ev.p < g.threshold) AS tn
  FROM ev CROSS JOIN grid g WHERE ev.p IS NOT NULL GROUP BY ev.model, g.threshold),
sweep AS (
  SELECT model, threshold, tp, fp, fn, tn,
    CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
    CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall,
    CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END AS f1
  FROM sw0)"""


@register("threshold_sweep", sql(*EVB, SWEEP, body="""
SELECT model, ROUND(threshold, 6) AS threshold, tp, fp, fn, tn, ROUND(precision, 6) AS precision,
       ROUND(recall, 6) AS recall, ROUND(f1, 6) AS f1 FROM sweep"""))
def q_threshold_sweep(spark, sf):
    return round_doubles(M.threshold_sweep(eval_frame(spark, sf), ["model"]))


@register("best_threshold", sql(*EVB, SWEEP, body="""
SELECT model, ROUND(threshold, 6) AS threshold, ROUND(f1, 6) AS score, 'f1' AS metric
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY model ORDER BY f1 DESC, threshold ASC) AS rk FROM sweep)
WHERE rk = 1"""))
def q_best_threshold(spark, sf):
    sweep = M.threshold_sweep(eval_frame(spark, sf), ["model"])
    return round_doubles(M.best_threshold(sweep, "f1", ["model"]))


# ------------------------------------------------------------------- curves
@register("roc_curve", sql(*EVB, CV, body="""
SELECT model, p AS threshold,
       ROUND(CAST(SUM(neg) OVER w AS DOUBLE) / SUM(neg) OVER (PARTITION BY model), 6) AS fpr,
       ROUND(CAST(SUM(pos) OVER w AS DOUBLE) / SUM(pos) OVER (PARTITION BY model), 6) AS tpr
FROM cv WINDOW w AS (PARTITION BY model ORDER BY p DESC)"""))
def q_roc_curve(spark, sf):
    return round_doubles(M.roc_curve(eval_frame(spark, sf), ["model"]))


_EDGES = M.CALIBRATION_EDGES[1:-1]
_BIN = " + ".join(f"CASE WHEN p > {d(e)} THEN 1 ELSE 0 END" for e in _EDGES)


@register("calibration_curve", sql(*EVB, body=f"""
SELECT model, CAST({_BIN} AS INTEGER) AS bin, COUNT(*) AS n, ROUND(AVG(p), 6) AS mean_predicted,
       ROUND(AVG(CAST(y AS DOUBLE)), 6) AS fraction_positive
FROM ev WHERE p IS NOT NULL GROUP BY model, CAST({_BIN} AS INTEGER)"""))
def q_calibration_curve(spark, sf):
    return round_doubles(M.calibration_curve(eval_frame(spark, sf), ["model"]))


# --------------------------------------------------------------------- cost
COST = f"""sc AS (SELECT model, y, CAST(LEAST(100, GREATEST(0, round_even(p * 100, 0))) AS INTEGER) AS s
       FROM ev WHERE p IS NOT NULL),
cuts AS (SELECT * FROM range(0, 101) AS t(cutoff)),
cc AS (SELECT sc.model, CAST(c.cutoff AS INTEGER) AS cutoff,
              COUNT(*) FILTER (WHERE sc.y = 1 AND sc.s < c.cutoff) AS fn,
              COUNT(*) FILTER (WHERE sc.y <> 1 AND sc.s >= c.cutoff) AS fp
       FROM sc CROSS JOIN cuts c WHERE sc.s IS NOT NULL GROUP BY sc.model, c.cutoff),
costs AS (SELECT model, cutoff, fn, fp, {d(5.0)} * fn + {d(1.0)} * fp AS cost FROM cc)"""


def _cost_input(spark, sf):
    ev = eval_frame(spark, sf)
    return build_score_output(ev, "p").select("model", "y", "risk_score")


@register("cost_curve", sql(*EVB, COST, body="SELECT model, cutoff, fn, fp, ROUND(cost, 6) AS cost FROM costs"))
def q_cost_curve(spark, sf):
    return round_doubles(M.cost_curve(_cost_input(spark, sf), groups=["model"]))


@register("cost_threshold", sql(*EVB, COST, body="""
SELECT model, cutoff, ROUND(cost, 6) AS cost, fn, fp FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY model ORDER BY cost, cutoff) AS rk FROM costs) WHERE rk = 1"""))
def q_cost_threshold(spark, sf):
    return round_doubles(M.best_cost_cutoff(M.cost_curve(_cost_input(spark, sf), groups=["model"]),
                                            ["model"]))


# ------------------------------------------------------------------ fairness
FAIR = """fa AS (
  SELECT 'SEX' AS attribute, CAST(SEX AS VARCHAR) AS value, y, CAST(p >= 0.5 AS INTEGER) AS yhat FROM ev WHERE model = 'demo'
  UNION ALL
  SELECT 'MARRIAGE', CAST(MARRIAGE AS VARCHAR), y, CAST(p >= 0.5 AS INTEGER) FROM ev WHERE model = 'demo'),
fg AS (
  SELECT attribute, value, COUNT(*) AS n, AVG(CAST(yhat AS DOUBLE)) AS selection_rate,
         AVG(CAST(y AS DOUBLE)) AS default_rate,
         COUNT(*) FILTER (WHERE y = 1 AND yhat = 1) AS tp, COUNT(*) FILTER (WHERE y <> 1 AND yhat = 1) AS fp,
         COUNT(*) FILTER (WHERE y = 1 AND yhat <> 1) AS fn, COUNT(*) FILTER (WHERE y <> 1 AND yhat <> 1) AS tn
  FROM fa GROUP BY attribute, value),
fr AS (
  SELECT attribute, value, n, selection_rate, default_rate,
    CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS tpr,
    CASE WHEN fp + tn = 0 THEN 0.0 ELSE CAST(fp AS DOUBLE) / (fp + tn) END AS fpr,
    CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision
  FROM fg)"""


def _fair(spark, sf):
    ev = eval_frame(spark, sf).where(F.col("model") == "demo")
    return M.fairness_by_group(ev, ["SEX", "MARRIAGE"])


@register("fairness_by_group", sql(*EVB, FAIR, body="""
SELECT attribute, value, n, ROUND(selection_rate, 6) AS selection_rate, ROUND(default_rate, 6) AS default_rate,
       ROUND(tpr, 6) AS tpr, ROUND(fpr, 6) AS fpr, ROUND(precision, 6) AS precision FROM fr"""))
def q_fairness_by_group(spark, sf):
    return round_doubles(_fair(spark, sf))


@register("fairness_gaps", sql(*EVB, FAIR, body="""
SELECT attribute, ROUND(MAX(selection_rate) - MIN(selection_rate), 6) AS demographic_parity_diff,
       ROUND(GREATEST(MAX(tpr) - MIN(tpr), MAX(fpr) - MIN(fpr)), 6) AS equalized_odds_diff
FROM fr GROUP BY attribute"""))
def q_fairness_gaps(spark, sf):
    return round_doubles(M.fairness_gaps(_fair(spark, sf)))
