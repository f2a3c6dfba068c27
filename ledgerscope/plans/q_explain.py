"""Queries: scaler (P3/P4), alignment (P8), labels / sample / header sources
(S2, S5, S6), class weights (M4), isotonic calibration (C1), linear attribution,
top drivers, global importance and extreme rows (A2, A5-A7), report table (D5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerscope.functions.scoring import demo_margin, sigmoid
from ledgerscope.operators import attribution as A
from ledgerscope.operators import models as MD
from ledgerscope.operators import prep
from ledgerscope.operators import scoring as sc
from ledgerscope.operators.explain import score_with_drivers
from ledgerscope.plans import oracle_sql as O
from ledgerscope.plans.q_eval import SPLIT, split_frame
from ledgerscope.plans.queries import (credit, features, register, round_doubles, scored, sql,
                                        training_features)
from ledgerscope.schema import (DERIVED_COLS, EXPECTED_COLUMNS, FEATURE_INPUT_COLS, GENERIC_NAMES, MODEL_FEATURES,
                                SCALE_COLS, TARGET)
from ledgerscope.session import stored
from ledgerscope.sources.tables import remap_columns

d = O.d

# ----------------------------------------------------------------------------------
# FIXED demonstration linear model on SCALED inputs (for attribution queries)
# ----------------------------------------------------------------------------------
ATTR_MODEL = A.LinearScorer(-3.0, {"PAY_0": 0.6, "LIMIT_BAL": -0.2, "BILL_AMT1": 0.05,
                                   "PAY_AMT1": -0.1, "max_delinquency": 0.9,
                                   "delinquency_count": 0.3, "pay_ratio_1": -2.0})
# ----------------------------------------------------------------------------------

FEAT_SPLIT = [O.CREDIT_ALL, O.clean_cte(), O.feat_cte(), SPLIT]
STATS = ("st AS (SELECT " + ", ".join(
    f"AVG(CAST({c} AS DOUBLE)) AS m_{c}, CASE WHEN STDDEV_POP(CAST({c} AS DOUBLE)) = 0 THEN {d(1.0)} "
    f"ELSE STDDEV_POP(CAST({c} AS DOUBLE)) END AS s_{c}" for c in SCALE_COLS)
    + " FROM feat JOIN splits USING (ID) WHERE split = 'train')")
SCALED = ("sc AS (SELECT feat.ID, " + ", ".join(
    f"(CAST({c} AS DOUBLE) - st.m_{c}) / st.s_{c} AS {c}" if c in SCALE_COLS else c
    for c in MODEL_FEATURES) + " FROM feat, st)")


def _train_scaler(spark, sf, raw=None):
    train = prep.stratified_split(training_features(spark, sf, raw)).where(F.col("split") == "train")
    return features(spark, sf, raw), prep.fit_scaler(train.select(*SCALE_COLS))


@register("scaler_fit", sql(*FEAT_SPLIT, STATS, body=" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, ROUND(m_{c}, 6) AS mean, ROUND(s_{c}, 6) AS std FROM st" for c in SCALE_COLS)))
def q_scaler_fit(spark, sf):
    train = prep.stratified_split(training_features(spark, sf)).where(F.col("split") == "train")
    return round_doubles(prep.scaler_stats(train, SCALE_COLS))


@register("scaler_apply", sql(*FEAT_SPLIT, STATS, SCALED, body=(
    "SELECT ID, " + ", ".join(f"ROUND({c}, 6) AS {c}" for c in SCALE_COLS) + " FROM sc")))
def q_scaler_apply(spark, sf):
    f, scaler = _train_scaler(spark, sf)
    return round_doubles(scaler.transform(f).select("ID", *SCALE_COLS))


ALIGN_COLS = ["LIMIT_BAL", "util_ratio_1", "model_only_feature", "AGE"]


@register("align_features", sql(*O.BASE[:3], body=(
    f"SELECT ID, LIMIT_BAL, ROUND(util_ratio_1, 6) AS util_ratio_1, {d(0.0)} AS model_only_feature, AGE FROM feat")))
def q_align_features(spark, sf):
    return round_doubles(prep.align_features(features(spark, sf), ALIGN_COLS, keep=["ID"]))


@register("attach_labels", sql(O.CREDIT_ALL, body=(
    f"SELECT ID, {', '.join(FEATURE_INPUT_COLS)}, {TARGET} FROM credit")))
def q_attach_labels(spark, sf):
    c = credit(spark, sf)
    feats = c.select("ID", *FEATURE_INPUT_COLS)
    labels = c.select("ID", TARGET)
    # a key join replaces the positional concat of the original loader
    return feats.join(labels, "ID", "inner")


@register("head_sample", sql(O.CREDIT_ALL, body=(
    f"SELECT ID, {', '.join(FEATURE_INPUT_COLS)} FROM credit ORDER BY ID LIMIT 50")))
def q_head_sample(spark, sf):
    # the first n rows by an explicit order (the sample IS a top-n)
    return credit(spark, sf).drop(TARGET, "AS_OF").orderBy("ID").limit(50)


_GENERIC_BACK = {v: k for k, v in GENERIC_NAMES.items()}


@register("remap_columns", sql(O.CREDIT_ALL, body=(
    "SELECT ID, " + ", ".join([*FEATURE_INPUT_COLS, TARGET]) + " FROM credit")))
def q_remap_columns(spark, sf):
    c = credit(spark, sf).drop("AS_OF")
    generic = c.select("ID", *[F.col(x).alias(_GENERIC_BACK[x]) for x in FEATURE_INPUT_COLS + [TARGET]])
    return remap_columns(generic)


# --------------------------------------------------------------- class weights
@register("class_weights", sql(*FEAT_SPLIT, body=f"""
SELECT COUNT(*) FILTER (WHERE y = 1) AS n_pos, COUNT(*) FILTER (WHERE y <> 1) AS n_neg,
       ROUND(CAST(COUNT(*) FILTER (WHERE y <> 1) AS DOUBLE) / GREATEST(COUNT(*) FILTER (WHERE y = 1), 1), 6) AS scale_pos_weight,
       ROUND(CAST(COUNT(*) AS DOUBLE) / (2 * COUNT(*) FILTER (WHERE y = 1)), 6) AS weight_pos,
       ROUND(CAST(COUNT(*) AS DOUBLE) / (2 * COUNT(*) FILTER (WHERE y <> 1)), 6) AS weight_neg
FROM splits WHERE split = 'train'"""))
def q_class_weights(spark, sf):
    train = split_frame(spark, sf).where(F.col("split") == "train")
    return round_doubles(MD.class_weights(train))


# ------------------------------------------------------------ isotonic
ISO = """vx AS (
  SELECT CAST(s.risk_score AS DOUBLE) AS x, SUM(CAST(sp.y AS DOUBLE)) AS sy, COUNT(*) AS n
  FROM scored s JOIN splits sp USING (ID) WHERE sp.split = 'val' GROUP BY s.risk_score),
vr AS (SELECT x, sy, n, ROW_NUMBER() OVER (ORDER BY x) AS i FROM vx),
seg AS (SELECT a.i AS lo, b.i AS hi, SUM(c.sy) / SUM(c.n) AS m
        FROM vr a JOIN vr b ON a.i <= b.i JOIN vr c ON c.i BETWEEN a.i AND b.i GROUP BY a.i, b.i),
iso AS (
  SELECT vr.x, MAX(mn) AS fitted FROM vr JOIN (
    SELECT s1.lo, vr2.i, MIN(s1.m) AS mn FROM seg s1 JOIN vr vr2 ON s1.lo <= vr2.i AND s1.hi >= vr2.i
    GROUP BY s1.lo, vr2.i) q ON q.i = vr.i GROUP BY vr.x)"""


def _iso_model(spark, sf):
    s = scored(spark, sf).select("ID", "risk_score")
    val = (split_frame(spark, sf).where(F.col("split") == "val").select("ID", TARGET)
           .join(s, "ID").select(F.col("risk_score").cast("double").alias("x"), TARGET))
    return MD.fit_isotonic(val, "x", TARGET), val


@register("calibrate_isotonic", sql(*O.BASE, SPLIT, ISO, body="SELECT x, ROUND(fitted, 6) AS fitted FROM iso"))
def q_calibrate_isotonic(spark, sf):
    model, val = _iso_model(spark, sf)
    pts = val.select("x").distinct()
    return round_doubles(MD.apply_isotonic(model, pts, "x", "fitted"))


# -------------------------------------------------------------- attribution
def _attr_frame(spark, sf, raw=None):
    f, scaler = _train_scaler(spark, sf, raw)
    return A.linear_attributions(scaler.transform(f), ATTR_MODEL, MODEL_FEATURES)


_ATTR_ROWS = ", ".join(
    f"({i}, '{c}', {d(float(ATTR_MODEL.coefs.get(c, 0.0)))} * CAST({c} AS DOUBLE), CAST({c} AS DOUBLE))"
    for i, c in enumerate(MODEL_FEATURES))
ATTR = (f"attr AS (SELECT sc.ID, v.pos, v.feature, v.shap_value, v.feature_value FROM sc, "
        f"LATERAL (VALUES {_ATTR_ROWS}) AS v(pos, feature, shap_value, feature_value))")
ATTR_ALL = [*FEAT_SPLIT, STATS, SCALED, ATTR]
_NONZERO = ", ".join(f"'{c}'" for c in ATTR_MODEL.coefs)


@register("linear_attribution", sql(*ATTR_ALL, body=f"""
SELECT ID, feature, ROUND(shap_value, 6) AS shap_value FROM attr WHERE feature IN ({_NONZERO})"""))
def q_linear_attribution(spark, sf):
    keep = list(ATTR_MODEL.coefs)
    # filter inside the array (a higher-order function), not with a Filter node over
    # the wide projection: keeps Catalyst's constraint inference small
    a = _attr_frame(spark, sf).select(
        "ID", F.inline(F.filter("attributions", lambda s: s["feature"].isin(*keep))))
    return round_doubles(a.select("ID", "feature", "shap_value"))


@register("top_drivers", sql(*ATTR_ALL, body="""
SELECT ID, CAST(rk AS INTEGER) AS rank, feature, ROUND(shap_value, 4) AS shap_value,
       ROUND(feature_value, 4) AS feature_value,
       CASE WHEN shap_value > 0 THEN 'increases_risk' ELSE 'decreases_risk' END AS direction
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ID ORDER BY ABS(shap_value) DESC, pos) AS rk FROM attr
      WHERE shap_value IS NOT NULL)
WHERE rk <= 5"""))
def q_top_drivers(spark, sf):
    t = A.top_drivers(_attr_frame(spark, sf))
    return t.select("ID", F.posexplode("top_drivers").alias("rank0", "d")).select(
        "ID", (F.col("rank0") + 1).cast("int").alias("rank"), "d.feature", "d.shap_value",
        "d.feature_value", "d.direction")


@register("global_importance", sql(*ATTR_ALL, body="""
SELECT feature, ROUND(AVG(ABS(shap_value)), 6) AS mean_abs_shap FROM attr GROUP BY feature"""))
def q_global_importance(spark, sf):
    return round_doubles(A.global_importance(_attr_frame(spark, sf)).drop("pos"))


@register("extreme_customers", sql(*O.BASE, body="""
SELECT * FROM (SELECT 'highest' AS which, ID, p FROM scored WHERE p IS NOT NULL ORDER BY p DESC, ID LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 'lowest' AS which, ID, p FROM scored WHERE p IS NOT NULL ORDER BY p ASC, ID LIMIT 1)"""))
def q_extreme_customers(spark, sf):
    return A.extreme_rows(scored(spark, sf), "p", "ID")


# ------------------------------------------------------------ batch score (C8), drivers (C7), isotonic
ALL_FEAT = [O.CREDIT_ALL, O.clean_cte(), O.feat_cte(), O.scored_cte()]


@register("batch_score", sql(*ALL_FEAT, body=f"""
SELECT c.ID, c.AS_OF, {', '.join('c.' + x for x in EXPECTED_COLUMNS)}, s.default_probability, s.risk_score, s.risk_band
FROM credit c JOIN scored s USING (ID)"""))
def q_batch_score(spark, sf):
    """C8 on every snapshot: the original columns and the three score columns."""
    return sc.batch_score(credit(spark, sf), sc.demo_predictor).select(
        "ID", "AS_OF", *EXPECTED_COLUMNS, "default_probability", "risk_score", "risk_band")


_ATTR_MARGIN = d(ATTR_MODEL.intercept)
for _c, _w in ATTR_MODEL.coefs.items():
    _ATTR_MARGIN = f"({_ATTR_MARGIN} + {d(_w)} * CAST({_c} AS DOUBLE))"
_ATTR_P = f"({d(1.0)} / ({d(1.0)} + EXP(-{_ATTR_MARGIN})))"


@register("score_with_drivers", sql(*ATTR_ALL, body=f"""
, pr AS (SELECT ID, {_ATTR_P} AS p FROM sc),
rk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY ID ORDER BY ABS(shap_value) DESC, pos) AS rk FROM attr
       WHERE shap_value IS NOT NULL)
SELECT pr.ID, ROUND(p, 4) AS default_probability, {O.score_sql('p')} AS risk_score, {O.band_sql(O.score_sql('p'))} AS risk_band,
       CAST(rk AS INTEGER) AS rank, feature, ROUND(shap_value, 4) AS shap_value, ROUND(feature_value, 4) AS feature_value,
       CASE WHEN shap_value > 0 THEN 'increases_risk' ELSE 'decreases_risk' END AS direction
FROM pr LEFT JOIN rk ON rk.ID = pr.ID AND rk.rk <= 5"""))
def q_score_with_drivers(spark, sf):
    """C7 on every snapshot: score, band and the five largest attributions of the fixed model."""
    _, scaler = _train_scaler(spark, sf)
    bundle = MD.ModelBundle(list(MODEL_FEATURES), scaler, ATTR_MODEL, "linear")
    got = score_with_drivers(credit(spark, sf), bundle)
    return got.select("ID", "default_probability", "risk_score", "risk_band",
                      F.posexplode_outer("top_drivers").alias("rank0", "t")).select(
        "ID", "default_probability", "risk_score", "risk_band", (F.col("rank0") + 1).cast("int").alias("rank"),
        "t.feature", "t.shap_value", "t.feature_value", "t.direction")


RAW_P = O.DEMO_P.removeprefix("ROUND(").removesuffix(", 4)")
ISO_EXACT = f"""up AS (SELECT feat.ID, {RAW_P} AS x, split, y FROM feat JOIN splits USING (ID)),
ux AS (SELECT x, SUM(y) AS sy, COUNT(*) AS n FROM up WHERE split = 'val' AND x IS NOT NULL GROUP BY x),
ur AS (SELECT *, ROW_NUMBER() OVER (ORDER BY x) AS i, SUM(sy) OVER (ORDER BY x) AS cs, SUM(n) OVER (ORDER BY x) AS cn FROM ux),
um AS (SELECT a.i AS lo, b.i AS hi, CAST(b.cs - a.cs + a.sy AS DOUBLE) / CAST(b.cn - a.cn + a.n AS DOUBLE) AS m
       FROM ur a JOIN ur b ON a.i <= b.i),
un AS (SELECT lo, hi, MIN(m) OVER (PARTITION BY lo ORDER BY hi DESC) AS mn FROM um),
pt AS (SELECT ur.x, f.fitted FROM ur JOIN (SELECT hi, MAX(mn) AS fitted FROM un GROUP BY hi) f ON f.hi = ur.i)"""


@register("calibrate_isotonic_exact", sql(*FEAT_SPLIT, ISO_EXACT, body="""
SELECT t.ID, ROUND(CASE WHEN l.x IS NULL THEN u.fitted WHEN u.x IS NULL OR u.x = l.x THEN l.fitted
       ELSE l.fitted + (u.fitted - l.fitted) * (t.x - l.x) / (u.x - l.x) END, 6) AS p_calibrated
FROM (SELECT * FROM up WHERE split = 'test') t
ASOF LEFT JOIN pt l ON t.x >= l.x ASOF LEFT JOIN pt u ON t.x <= u.x"""))
def q_calibrate_isotonic_exact(spark, sf):
    """C1 on the unrounded probability: fitted on the validation split, applied to the test split."""
    f = prep.stratified_split(training_features(spark, sf)).select("ID", "split", TARGET, sigmoid(demo_margin()).alias("p_raw"))
    fit = MD.fit_isotonic(f.where(F.col("split") == "val"))
    return round_doubles(fit.apply(f.where(F.col("split") == "test").select("ID", "p_raw"), out="p_calibrated").drop("p_raw"))


DER = DERIVED_COLS


# ------------------------------------------------------------ report (D5) and alerts (Z3)
def _report_parts(spark, sf, raw=None):
    from ledgerscope.operators import drift as D
    from ledgerscope.operators import metrics as M
    from ledgerscope.plans.q_drift import FEATS, _sides
    from ledgerscope.plans.q_eval import eval_frame
    cmp = M.compare_models(M.compute_metrics(eval_frame(spark, sf, raw), ["model"]))
    imp = A.global_importance(_attr_frame(spark, sf, raw))
    ref, cur = _sides(spark, sf, raw)
    rep = D.drift_report(ref, cur, FEATS)
    return cmp, imp, rep


@register("report_table")
def q_report_table(spark, sf):
    from ledgerscope.operators import drift as D
    cmp, imp, rep = _report_parts(spark, sf)
    metrics = cmp.unpivot(["model"], ["roc_auc", "pr_auc", "brier_score", "f1", "recall", "precision"],
                          "metric", "value").select(F.lit("metrics").alias("section"),
                                                    F.col("model").alias("item"), "metric", "value")
    top = imp.orderBy(F.desc("mean_abs_shap"), "feature").limit(10).select(
        F.lit("importance").alias("section"), F.col("feature").alias("item"),
        F.lit("mean_abs_shap").alias("metric"), F.round("mean_abs_shap", 4).alias("value"))
    summ = D.drift_summary(rep).select(
        F.col("n_features_checked").cast("double").alias("a"), F.col("n_drifted").cast("double").alias("b"),
        F.col("drift_rate").cast("double").alias("c")).selectExpr(
        "stack(3, 'n_features_checked', a, 'n_drifted', b, 'drift_rate', c) AS (metric, value)").select(
        F.lit("drift").alias("section"), F.lit("all").alias("item"), "metric", "value")
    return metrics.unionByName(top).unionByName(summ)


@register("monitoring_alerts")
def q_monitoring_alerts(spark, sf, raw=None):
    from ledgerscope.operators import drift as D
    from ledgerscope.operators import metrics as M
    from ledgerscope.plans.q_eval import eval_frame
    from ledgerscope.sources.credit import DRIFT_CUTOFF
    _, imp, rep = _report_parts(spark, sf, raw)
    ev = eval_frame(spark, sf, raw).where(F.col("model") == "demo").join(
        credit(spark, sf).select("ID", "AS_OF"), "ID")
    # saved: each area is several passes over it
    ev = stored(ev.select("AS_OF", "y", "p"), "evaluation")
    auc_ref = M.roc_auc(ev.where(F.col("AS_OF") < F.lit(DRIFT_CUTOFF)))
    auc_cur = M.roc_auc(ev.where(F.col("AS_OF") >= F.lit(DRIFT_CUTOFF)))
    return round_doubles(D.monitoring_alerts(rep, imp, auc_ref, auc_cur))


def _report_sql(source: tuple[str, ...] = ()) -> tuple[str, str]:
    """SQL of report and alerts; ``source``: a CTE of other credit rows and its name."""
    from ledgerscope.plans import q_drift as QD
    from ledgerscope.plans import q_eval as QE
    first = [source[0], O.clean_cte(source[1])] if source else [O.clean_cte()]
    ctes = [O.CREDIT_ALL, *first, O.feat_cte(), QE.EV, QE.CV, QE.AUC, QE.AP, QE.BR, QE.TM,
            SPLIT, STATS, SCALED, ATTR, QD.SIDES, QD.KS, QD._psi_sql(), QD.REPORT]
    base = ", ".join(c.strip() for c in ctes)
    mets = " UNION ALL ".join(
        f"SELECT 'metrics' AS section, model AS item, '{m}' AS metric, ROUND({m}, 4) AS value "
        f"FROM auc JOIN ap USING (model) JOIN br USING (model) JOIN tm USING (model)"
        for m in ["roc_auc", "pr_auc", "brier_score", "f1", "recall", "precision"])
    report = (f"WITH {base}\n{mets}\nUNION ALL\n"
              "SELECT 'importance', feature, 'mean_abs_shap', ROUND(m, 4) FROM ("
              "SELECT feature, AVG(ABS(shap_value)) AS m FROM attr GROUP BY feature ORDER BY m DESC, feature LIMIT 10)\n"
              "UNION ALL SELECT 'drift', 'all', 'n_features_checked', CAST(COUNT(*) AS DOUBLE) FROM rep\n"
              "UNION ALL SELECT 'drift', 'all', 'n_drifted', CAST(COUNT(*) FILTER (WHERE drifted) AS DOUBLE) FROM rep\n"
              "UNION ALL SELECT 'drift', 'all', 'drift_rate', "
              "ROUND(CAST(COUNT(*) FILTER (WHERE drifted) AS DOUBLE) / GREATEST(COUNT(*), 1), 3) FROM rep")
    cut = QD.CUT
    alerts = (f"WITH {base},\n"
              "top5 AS (SELECT feature FROM (SELECT feature, AVG(ABS(shap_value)) AS m FROM attr GROUP BY feature) "
              "ORDER BY m DESC, feature LIMIT 5),\n"
              f"evd AS (SELECT ev.y, ev.p, c.AS_OF FROM ev JOIN credit c USING (ID) WHERE ev.model = 'demo'),\n"
              f"cvp AS (SELECT CASE WHEN AS_OF < DATE '{cut}' THEN 'ref' ELSE 'cur' END AS period, p, "
              "COUNT(*) FILTER (WHERE y = 1) AS pos, COUNT(*) FILTER (WHERE y <> 1) AS neg "
              "FROM evd WHERE p IS NOT NULL GROUP BY 1, 2),\n"
              "aucp AS (SELECT period, SUM(pos * (cum_neg - neg + CAST(neg AS DOUBLE) / 2)) "
              "/ (CAST(SUM(pos) AS DOUBLE) * SUM(neg)) AS auc FROM ("
              "SELECT *, SUM(neg) OVER (PARTITION BY period ORDER BY p) AS cum_neg FROM cvp) GROUP BY period)\n"
              "SELECT 'psi_top_feature' AS alert, feature, ROUND(psi, 6) AS value FROM rep "
              "WHERE feature IN (SELECT feature FROM top5) AND psi > 0.2\n"
              "UNION ALL SELECT 'auc_drop', CAST(NULL AS VARCHAR), ROUND(r.auc - c.auc, 6) "
              "FROM aucp r, aucp c WHERE r.period = 'ref' AND c.period = 'cur' AND r.auc - c.auc > 0.03")
    return report, alerts


def _register_report_sql() -> None:
    from ledgerscope.plans.queries import _SQL
    report, alerts = _report_sql()
    _SQL["report_table"] = report
    _SQL["monitoring_alerts"] = alerts


_register_report_sql()
