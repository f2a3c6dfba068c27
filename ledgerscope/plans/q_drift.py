"""Queries: drift (D1-D4, Z1, Z3 inputs) and exploratory summaries.

Reference = snapshots dated before 1999-01-01, current = the rest; both cleaned
and with derived features; every numeric feature (IDs and target excluded).
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ledgerscope.operators import drift as D
from ledgerscope.operators import eda
from ledgerscope.plans import oracle_sql as O
from ledgerscope.plans.queries import features, register, round_doubles, scored, sql
from ledgerscope.schema import DERIVED_COLS, FEATURE_INPUT_COLS, TARGET
from ledgerscope.sources.credit import DRIFT_CUTOFF

d = O.d
FEATS = sorted(FEATURE_INPUT_COLS + DERIVED_COLS)
CUT = DRIFT_CUTOFF.isoformat()


def _sides(spark, sf, raw=None):
    f = features(spark, sf, raw)
    return f.where(F.col("AS_OF") < F.lit(DRIFT_CUTOFF)), f.where(F.col("AS_OF") >= F.lit(DRIFT_CUTOFF))


def _melt_sql(cols, src, side):
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, {side} AS side FROM {src}"
                              for c in cols)


SIDES = f"""ref AS (SELECT * FROM feat WHERE AS_OF < DATE '{CUT}'),
cur AS (SELECT * FROM feat WHERE AS_OF >= DATE '{CUT}'),
lv AS ({_melt_sql(FEATS, 'ref', 0)} UNION ALL {_melt_sql(FEATS, 'cur', 1)})"""


def _pvalue_sql(dcol: str, nr: str, nc: str, terms: int = 20) -> str:
    z = f"(SQRT(CAST({nr} AS DOUBLE) * CAST({nc} AS DOUBLE) / (CAST({nr} AS DOUBLE) + CAST({nc} AS DOUBLE))) * {dcol})"
    upper = " + ".join(f"{d(2.0 * (1 if k % 2 else -1))} * EXP({d(-2.0 * k * k)} * {z} * {z})"
                       for k in range(1, terms + 1))
    lower = (f"{d(1.0)} - {d(math.sqrt(2 * math.pi))} / {z} * ("
             + " + ".join(f"EXP({d(-((2 * k - 1) ** 2) * math.pi ** 2 / 8.0)} / ({z} * {z}))"
                          for k in range(1, terms + 1)) + ")")
    return (f"CASE WHEN {z} <= 0 THEN {d(1.0)} ELSE LEAST({d(1.0)}, GREATEST({d(0.0)}, "
            f"CASE WHEN {z} >= 1 THEN ({upper}) ELSE ({lower}) END)) END")


KS = f"""kc AS (SELECT feature, value, COUNT(*) FILTER (WHERE side = 0) AS r, COUNT(*) FILTER (WHERE side = 1) AS c
       FROM lv WHERE value IS NOT NULL GROUP BY feature, value),
kcum AS (SELECT feature, value, SUM(r) OVER w AS cr, SUM(c) OVER w AS cc,
                SUM(r) OVER (PARTITION BY feature) AS nr, SUM(c) OVER (PARTITION BY feature) AS nc
         FROM kc WINDOW w AS (PARTITION BY feature ORDER BY value)),
ks0 AS (SELECT feature, MAX(ABS(CAST(cr AS DOUBLE) / nr - CAST(cc AS DOUBLE) / nc)) AS ks_statistic,
               CAST(MAX(nr) AS BIGINT) AS n_ref, CAST(MAX(nc) AS BIGINT) AS n_cur FROM kcum GROUP BY feature),
ks AS (SELECT *, {_pvalue_sql('ks_statistic', 'n_ref', 'n_cur')} AS ks_p_value FROM ks0)"""


def _psi_sql(lv: str = "lv", bins: int = 10, prefix: str = "p") -> str:
    edges = " + ".join(
        f"CASE WHEN value >= {d(float(i))} * ((hi - lo) / {d(float(bins))}) + lo THEN 1 ELSE 0 END"
        for i in range(1, bins))
    return f"""{prefix}mm AS (SELECT feature, MIN(value) AS lo, MAX(value) AS hi FROM {lv} WHERE value IS NOT NULL GROUP BY feature),
{prefix}bn AS (SELECT x.feature, x.side, ({edges}) AS bin FROM {lv} x JOIN {prefix}mm USING (feature) WHERE value IS NOT NULL),
{prefix}c AS (SELECT feature, bin, COUNT(*) FILTER (WHERE side = 0) AS r, COUNT(*) FILTER (WHERE side = 1) AS c
       FROM {prefix}bn GROUP BY feature, bin),
{prefix}t AS (SELECT feature, COUNT(*) FILTER (WHERE side = 0) AS nr, COUNT(*) FILTER (WHERE side = 1) AS nc
       FROM {prefix}bn GROUP BY feature),
{prefix}si AS (SELECT feature, SUM(((CAST(c AS DOUBLE) / nc + {d(1e-6)}) - (CAST(r AS DOUBLE) / nr + {d(1e-6)}))
                    * LN((CAST(c AS DOUBLE) / nc + {d(1e-6)}) / (CAST(r AS DOUBLE) / nr + {d(1e-6)}))) AS psi
        FROM {prefix}c JOIN {prefix}t USING (feature) GROUP BY feature)"""


DRIFT = [O.CREDIT_ALL, O.clean_cte(), O.feat_cte(), SIDES, KS, _psi_sql()]
REPORT = """rep AS (
  SELECT ks.feature, n_ref, n_cur, ROUND(ks_statistic, 4) AS ks_statistic, ROUND(ks_p_value, 4) AS ks_p_value,
         ks_statistic > 0.1 AS ks_drifted, ROUND(psi, 4) AS psi, ROUND(psi, 4) > 0.2 AS psi_drifted,
         ks_statistic > 0.1 OR ROUND(psi, 4) > 0.2 AS drifted
  FROM ks JOIN psi USING (feature) WHERE n_ref >= 20 AND n_cur >= 20)"""


@register("ks_drift", sql(*DRIFT, body="""
SELECT feature, n_ref, n_cur, ROUND(ks_statistic, 4) AS ks_statistic, ks_statistic > 0.1 AS drifted FROM ks"""))
def q_ks_drift(spark, sf):
    ref, cur = _sides(spark, sf)
    ks = D.ks_statistics(D.long_values(ref, cur, FEATS))
    return ks.select("feature", "n_ref", "n_cur", F.round("ks_statistic", 4).alias("ks_statistic"),
                     (F.col("ks_statistic") > 0.1).alias("drifted"))


@register("ks_pvalue", sql(*DRIFT, body="SELECT feature, ROUND(ks_p_value, 4) AS ks_p_value FROM ks"))
def q_ks_pvalue(spark, sf):
    ref, cur = _sides(spark, sf)
    ks = D.ks_statistics(D.long_values(ref, cur, FEATS))
    return ks.select("feature", F.round("ks_p_value", 4).alias("ks_p_value"))


@register("psi", sql(*DRIFT, body="SELECT feature, ROUND(psi, 4) AS psi FROM psi"))
def q_psi(spark, sf):
    ref, cur = _sides(spark, sf)
    return D.psi_values(D.long_values(ref, cur, FEATS)).select("feature", F.round("psi", 4).alias("psi"))


@register("drift_report", sql(*DRIFT, REPORT, body="SELECT * FROM rep"))
def q_drift_report(spark, sf):
    ref, cur = _sides(spark, sf)
    return D.drift_report(ref, cur, FEATS)


@register("drift_summary", sql(*DRIFT, REPORT, body="""
SELECT COUNT(*) AS n_features_checked, COUNT(*) FILTER (WHERE drifted) AS n_drifted,
       ROUND(CAST(COUNT(*) FILTER (WHERE drifted) AS DOUBLE) / GREATEST(COUNT(*), 1), 3) AS drift_rate,
       COALESCE(STRING_AGG(feature, ',' ORDER BY feature) FILTER (WHERE drifted), '') AS drifted_features FROM rep"""))
def q_drift_summary(spark, sf, raw=None):
    ref, cur = _sides(spark, sf, raw)
    return D.drift_summary(D.drift_report(ref, cur, FEATS)).withColumn("drifted_features", F.array_join("drifted_features", ","))


# a band row's paths are sums over the row before: one list per number of reference rows walked
LATTICE = f"""sg AS (SELECT CAST(AGE AS VARCHAR) AS feature, BILL_AMT1 AS value,
              COUNT(*) FILTER (WHERE AS_OF < DATE '{CUT}') AS r, COUNT(*) FILTER (WHERE AS_OF >= DATE '{CUT}') AS c
       FROM feat WHERE BILL_AMT1 IS NOT NULL AND AGE IS NOT NULL GROUP BY ALL),
sc AS (SELECT *, SUM(r) OVER w AS cr, SUM(c) OVER w AS cc, SUM(r) OVER (PARTITION BY feature) AS n, SUM(c) OVER (PARTITION BY feature) AS m
       FROM sg WINDOW w AS (PARTITION BY feature ORDER BY value)),
sk AS (SELECT feature, CAST(MAX(n) AS BIGINT) AS n, CAST(MAX(m) AS BIGINT) AS m, CAST(MAX(ABS(cr * m - cc * n)) AS BIGINT) AS k
       FROM sc WHERE n > 0 AND m > 0 GROUP BY feature),
sp AS (SELECT *, list_reduce(
         [list_transform(range(m + 1), lambda j: CASE WHEN j * n < k THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)]
         || list_transform(range(1, n + 1), lambda i: [i::DOUBLE]),
         lambda acc, x: list_transform(range(m + 1), lambda j: CASE WHEN abs(x[1] * m - j * n) < k
           THEN list_sum(acc[greatest(0, floor((x[1] * m - k) / n) + 1)::BIGINT + 1 : j + 1]) ELSE 0.0::DOUBLE END)) AS ends
       FROM sk)"""


@register("ks_exact_pvalue", sql(*O.BASE[:3], LATTICE, body="""
SELECT feature, n AS n_ref, m AS n_cur, ROUND(CAST(k AS DOUBLE) / (n * m), 6) AS ks_statistic,
       ROUND(CASE WHEN k = 0 THEN 1.0 ELSE 1 - exp(ln(ends[m + 1]) - (lgamma(n + m + 1) - lgamma(n + 1) - lgamma(m + 1))) END, 6) AS ks_p_value
FROM sp"""))
def q_ks_exact_pvalue(spark, sf):
    """D1p: bills of the current against the reference period by age, exact in small samples."""
    f = features(spark, sf).where(F.col("AGE").isNotNull() & F.col("BILL_AMT1").isNotNull())
    counts = f.groupBy(F.col("AGE").cast("string").alias("feature"), F.col("BILL_AMT1").alias("value")).agg(
        F.count_if(F.col("AS_OF") < F.lit(DRIFT_CUTOFF)).alias("r"), F.count_if(F.col("AS_OF") >= F.lit(DRIFT_CUTOFF)).alias("c"))
    return round_doubles(D.exact_ks(counts).drop("is_exact"))


SCORE_SIDES = f"""slv AS (SELECT 'risk_score' AS feature, CAST(risk_score AS DOUBLE) AS value,
                 CASE WHEN AS_OF < DATE '{CUT}' THEN 0 ELSE 1 END AS side FROM scored)"""


@register("score_shift", sql(*O.BASE, SCORE_SIDES, _psi_sql("slv", 10, "s"), body=f"""
SELECT ROUND(psi, 4) AS score_psi, ROUND(psi, 4) > 0.2 AS score_shifted, {d(0.2)} AS threshold FROM ssi"""))
def q_score_shift(spark, sf):
    s = scored(spark, sf)
    return D.score_shift(s.where(F.col("AS_OF") < F.lit(DRIFT_CUTOFF)), s.where(F.col("AS_OF") >= F.lit(DRIFT_CUTOFF)))


CAT = ["EDUCATION", "MARRIAGE", "SEX"]
CHI = f"""clv AS ({_melt_sql(CAT, 'ref', 0)} UNION ALL {_melt_sql(CAT, 'cur', 1)}),
cc AS (SELECT feature, value, COUNT(*) FILTER (WHERE side = 0) AS r, COUNT(*) FILTER (WHERE side = 1) AS c
       FROM clv WHERE value IS NOT NULL GROUP BY feature, value),
ct AS (SELECT feature, SUM(r) AS nr, SUM(c) AS nc, COUNT(*) AS k FROM cc GROUP BY feature)"""


@register("chi2_drift", sql(*DRIFT, CHI, body="""
SELECT feature, ROUND(SUM(POWER(r - (r + c) * CAST(nr AS DOUBLE) / (nr + nc), 2) / ((r + c) * CAST(nr AS DOUBLE) / (nr + nc))
                  + POWER(c - (r + c) * CAST(nc AS DOUBLE) / (nr + nc), 2) / ((r + c) * CAST(nc AS DOUBLE) / (nr + nc))), 6) AS chi2,
       MAX(k) - 1 AS dof
FROM cc JOIN ct USING (feature) GROUP BY feature"""))
def q_chi2_drift(spark, sf):
    ref, cur = _sides(spark, sf)
    return round_doubles(D.chi2_drift(ref, cur, CAT))


# --------------------------------------------------------------------------- EDA
DESC_COLS = FEATURE_INPUT_COLS + [TARGET]
_DLV = " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM credit"
                          for c in DESC_COLS)


@register("describe", sql(O.CREDIT_ALL, f"dl AS ({_DLV})", body="""
SELECT column_name, COUNT(value) AS count, ROUND(AVG(value), 6) AS mean, ROUND(STDDEV_SAMP(value), 6) AS std,
       ROUND(MIN(value), 6) AS min, ROUND(quantile_cont(value, 0.25), 6) AS p25,
       ROUND(quantile_cont(value, 0.5), 6) AS p50, ROUND(quantile_cont(value, 0.75), 6) AS p75,
       ROUND(MAX(value), 6) AS max
FROM dl GROUP BY column_name"""))
def q_describe(spark, sf):
    from ledgerscope.plans.queries import credit
    return round_doubles(eda.describe(credit(spark, sf), DESC_COLS))


HIST_COLS = ["LIMIT_BAL", "AGE", "BILL_AMT1", "PAY_AMT1"]
_HLV = " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM credit"
                          for c in HIST_COLS)


def _hist_sql(lv: str, group: str, bins: int) -> str:
    edges = " + ".join(f"CASE WHEN value >= {d(float(i))} * ((hi - lo) / {d(float(bins))}) + lo THEN 1 ELSE 0 END"
                       for i in range(1, bins))
    return f"""hm AS (SELECT {group}, MIN(value) AS lo, MAX(value) AS hi FROM {lv} WHERE value IS NOT NULL GROUP BY {group}),
hb AS (SELECT x.{group}, lo, hi, ({edges}) AS bin FROM {lv} x JOIN hm USING ({group}) WHERE value IS NOT NULL),
hist AS (SELECT {group}, bin, ROUND(bin * ((MAX(hi) - MAX(lo)) / {d(float(bins))}) + MAX(lo), 6) AS bin_start,
                COUNT(*) AS n FROM hb GROUP BY {group}, bin)"""


@register("histogram", sql(O.CREDIT_ALL, f"hl AS ({_HLV})", _hist_sql("hl", "column_name", 40),
                           body="SELECT * FROM hist"))
def q_histogram(spark, sf):
    from ledgerscope.plans.queries import credit
    return round_doubles(eda.histogram(eda.melt(credit(spark, sf), HIST_COLS), 40))


@register("default_rate_by_category", sql(O.CREDIT_ALL, O.clean_cte(), body="""
SELECT attribute, value, COUNT(*) AS n, ROUND(AVG(CAST(default_payment_next_month AS DOUBLE)), 6) AS default_rate
FROM (SELECT 'SEX' AS attribute, SEX AS value, default_payment_next_month FROM clean
      UNION ALL SELECT 'EDUCATION', EDUCATION, default_payment_next_month FROM clean
      UNION ALL SELECT 'MARRIAGE', MARRIAGE, default_payment_next_month FROM clean)
GROUP BY attribute, value"""))
def q_default_rate_by_category(spark, sf):
    from ledgerscope.operators.prep import clean_raw
    from ledgerscope.plans.queries import credit
    return round_doubles(eda.default_rate_by(clean_raw(credit(spark, sf)), ["SEX", "EDUCATION", "MARRIAGE"], TARGET))


@register("default_rate_by_pay0", sql(O.CREDIT_ALL, body="""
SELECT 'PAY_0' AS attribute, PAY_0 AS value, COUNT(*) AS n,
       ROUND(AVG(CAST(default_payment_next_month AS DOUBLE)), 6) AS default_rate FROM credit GROUP BY PAY_0"""))
def q_default_rate_by_pay0(spark, sf):
    from ledgerscope.plans.queries import credit
    return round_doubles(eda.default_rate_by(credit(spark, sf), ["PAY_0"], TARGET))


CORR_COLS = ["LIMIT_BAL", "AGE", "PAY_0", "PAY_2", "BILL_AMT1", "PAY_AMT1", TARGET]


def _corr_sql() -> str:
    rows = []
    for i, a in enumerate(CORR_COLS):
        for b in CORR_COLS[i + 1:]:
            rows.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, ROUND(CORR(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr FROM credit")
            rows.append(f"SELECT '{b}', '{a}', ROUND(CORR(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) FROM credit")
    rows += [f"SELECT '{c}', '{c}', {d(1.0)}" for c in CORR_COLS]
    return " UNION ALL ".join(rows)


@register("correlation", sql(O.CREDIT_ALL, body=_corr_sql()))
def q_correlation(spark, sf):
    from ledgerscope.plans.queries import credit
    return round_doubles(eda.correlation(credit(spark, sf), CORR_COLS))


@register("score_histogram", sql(*O.BASE, "sl AS (SELECT risk_band, CAST(risk_score AS DOUBLE) AS value FROM scored)",
                                 _hist_sql("sl", "risk_band", 15), body="SELECT * FROM hist"))
def q_score_histogram(spark, sf):
    s = scored(spark, sf).select("risk_band", F.col("risk_score").cast("double").alias("value"))
    return round_doubles(eda.histogram(s, 15, group="risk_band"))
