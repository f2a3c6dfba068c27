"""Checks and alerts on rows that trip them: the soiled table and the shifted period."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerscope.operators import quality as q
from ledgerscope.plans import oracle_sql as O
from ledgerscope.plans import q_drift as QD
from ledgerscope.plans import q_explain as QX
from ledgerscope.plans import q_quality as QQ
from ledgerscope.plans.queries import credit, register, round_doubles, sql
from ledgerscope.schema import PAY_AMT_COLS, REQUIRED_FIELDS, SCORING_RANGES, VALID_RANGES
from ledgerscope.sources.variants import shifted, shifted_sql, soiled, soiled_sql

d = O.d
SOILED = [O.CREDIT_ALL, soiled_sql()]
DIRTY = [*SOILED, "dirty AS (SELECT * EXCLUDE (ID) FROM soiled)"]


def _soiled(spark, sf):
    return soiled(credit(spark, sf))


@register("dq_ranges_soiled", sql(*DIRTY, body=QQ._unpivot(
    QQ._RANGE_AGG, [(c, f"r{i}") for i, c in enumerate(VALID_RANGES)], "range", "CASE WHEN v.nb > 0 THEN 'warning' ELSE 'ok' END")))
def q_dq_ranges_soiled(spark, sf):
    return round_doubles(q.check_ranges(_soiled(spark, sf).drop("ID")))


@register("dq_duplicates_soiled", sql(*SOILED, body="""
SELECT COUNT(*) AS n_rows, (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM soiled)) AS n_distinct,
       CAST(COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM soiled)) AS BIGINT) AS n_duplicates FROM soiled"""))
def q_dq_duplicates_soiled(spark, sf):
    return q.check_duplicates(_soiled(spark, sf))


@register("dq_negative_amounts_soiled", sql(*DIRTY, body=QQ._unpivot(
    QQ._NEG_AGG, [(c, f"g{i}") for i, c in enumerate(QQ._NEG_COLS)], "negative",
    "CASE WHEN v.nb = 0 THEN 'ok' WHEN v.col LIKE 'PAY_AMT%' THEN 'warning' ELSE 'info' END")))
def q_dq_negative_soiled(spark, sf):
    return round_doubles(q.check_negative_amounts(_soiled(spark, sf).drop("ID")))


def _findings_sql() -> str:
    rows = [f"('required', '{c}', s.{c} IS NULL, NULL, NULL, NULL, 'error')" for c in REQUIRED_FIELDS]
    rows += [f"('number', '{c}', COALESCE(isnan(s.{c}), false), s.{c}, NULL, NULL, 'error')" for c in QQ._DOUBLE_FIELDS]
    rows += [f"('range', '{c}', COALESCE(NOT (s.{c} >= {lo} AND s.{c} <= {hi}), false), CAST(s.{c} AS DOUBLE), {d(float(lo))}, {d(float(hi))}, 'warning')"
             for c, (lo, hi) in SCORING_RANGES.items()]
    rows += [f"('sign', '{c}', COALESCE(s.{c} < 0, false), s.{c}, {d(0.0)}, NULL, 'warning')" for c in PAY_AMT_COLS]
    return f"""SELECT s.ID, v.rule, v.field, CASE WHEN isnan(v.value) THEN NULL ELSE v.value END AS value, v.low, v.high, v.severity
FROM soiled s, LATERAL (VALUES {", ".join(rows)}) AS v(rule, field, bad, value, low, high, severity) WHERE v.bad"""


@register("record_findings", sql(*SOILED, body=_findings_sql()))
def q_record_findings(spark, sf):
    """Q1 on the soiled rows: every finding with its value and bounds (a NaN value shows as NULL)."""
    got = q.check_records(_soiled(spark, sf)).select("ID", F.inline("findings"))
    return got.withColumn("value", F.when(~F.isnan("value"), F.col("value")))


@register("check_batch_soiled", sql(*SOILED, body=QQ._BATCH_SQL.replace("FROM credit_all", "FROM soiled")))
def q_check_batch_soiled(spark, sf):
    return round_doubles(q.check_batch(_soiled(spark, sf).drop("AS_OF")))


@register("request_constraints_soiled", sql(*SOILED, body=f"""
SELECT ID, {QQ._viol_sql()} AS violations, {QQ._viol_sql()} IS NULL AS accepted FROM soiled"""))
def q_request_constraints_soiled(spark, sf):
    return q.request_constraints(_soiled(spark, sf)).select("ID", "violations", "accepted")


# ------------------------------------------------------------------ a shifted current period
SHIFT = (shifted_sql(), "credit_shifted")
SHIFT_DRIFT = [O.CREDIT_ALL, SHIFT[0], O.clean_cte(SHIFT[1]), *QD.DRIFT[2:], QD.REPORT]


@register("drift_report_shifted", sql(*SHIFT_DRIFT, body="SELECT feature, n_ref, n_cur, ks_statistic, ks_drifted, psi, psi_drifted, drifted FROM rep"))
def q_drift_report_shifted(spark, sf):
    from ledgerscope.operators import drift as D
    ref, cur = QD._sides(spark, sf, shifted(credit(spark, sf)))
    return D.drift_report(ref, cur, QD.FEATS).drop("ks_p_value")


@register("drift_summary_shifted", sql(*SHIFT_DRIFT, body="""
SELECT COUNT(*) AS n_features_checked, COUNT(*) FILTER (WHERE drifted) AS n_drifted,
       ROUND(CAST(COUNT(*) FILTER (WHERE drifted) AS DOUBLE) / GREATEST(COUNT(*), 1), 3) AS drift_rate,
       COALESCE(STRING_AGG(feature, ',' ORDER BY feature) FILTER (WHERE drifted), '') AS drifted_features FROM rep"""))
def q_drift_summary_shifted(spark, sf):
    return QD.q_drift_summary(spark, sf, shifted(credit(spark, sf)))


@register("monitoring_alerts_shifted", QX._report_sql(SHIFT)[1])
def q_monitoring_alerts_shifted(spark, sf):
    return QX.q_monitoring_alerts(spark, sf, shifted(credit(spark, sf)))
