"""Queries: validation report pieces (V1-V7), record/batch/request checks (Q1-Q3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerscope.operators import quality as q
from ledgerscope.plans import oracle_sql as O
from ledgerscope.plans.queries import credit, register, round_doubles, sql
from ledgerscope.schema import (BILL_COLS, EXPECTED_COLUMNS, PAY_AMT_COLS, REQUEST_CONSTRAINTS,
                                REQUIRED_FIELDS, SCORING_RANGES, VALID_RANGES)
from ledgerscope.sources import credit as src

# the checked table: every snapshot, ID dropped as the original loader does
_DIRTY_COLS = ["AS_OF"] + EXPECTED_COLUMNS
_DIRTY = "dirty AS (SELECT * EXCLUDE (ID) FROM credit_all)"


def _dirty(spark, sf):
    return src.credit_all(spark, sf).drop("ID")


def _unpivot(agg_sql: str, pairs: list[tuple[str, str]], check: str, sev: str) -> str:
    vals = ", ".join(f"('{c}', a.{e})" for c, e in pairs)
    return (f", a AS ({agg_sql})\n"
            f"SELECT '{check}' AS check_name, v.col AS column_name, {sev} AS severity, "
            f"CAST(v.nb AS BIGINT) AS n_bad, ROUND(CAST(v.nb AS DOUBLE) / a.n, 6) AS pct\n"
            f"FROM a, LATERAL (VALUES {vals}) AS v(col, nb)")


# ----------------------------------------------------------------------------- V1
_SCHEMA_ROWS = [(c, "true", "true", "ok") for c in EXPECTED_COLUMNS] + [("AS_OF", "false", "true", "warning")]


@register("dq_schema", sql(O.CREDIT_ALL, body=(
    "SELECT v.column_name, v.expected, v.present, v.severity, a.n_rows, CAST(26 AS INTEGER) AS n_cols "
    "FROM (SELECT COUNT(*) AS n_rows FROM credit) a, LATERAL (VALUES "
    + ", ".join(f"('{c}', {e}, {p}, '{s}')" for c, e, p, s in _SCHEMA_ROWS)
    + ") AS v(column_name, expected, present, severity)")))
def q_dq_schema(spark, sf):
    return q.check_schema(credit(spark, sf))


# ----------------------------------------------------------------------------- V2
_MISS_AGG = ("SELECT COUNT(*) AS n, "
             + ", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS m{i}" for i, c in enumerate(_DIRTY_COLS))
             + " FROM dirty")
_MISS_PAIRS = [(c, f"m{i}") for i, c in enumerate(_DIRTY_COLS)]


@register("dq_missing", sql(O.CREDIT_ALL, _DIRTY, body=_unpivot(
    _MISS_AGG, _MISS_PAIRS, "missing",
    "CASE WHEN CAST(v.nb AS DOUBLE) / a.n > 0.05 THEN 'issue' WHEN v.nb > 0 THEN 'warning' ELSE 'ok' END")))
def q_dq_missing(spark, sf):
    return round_doubles(q.check_missing(_dirty(spark, sf)))


@register("dq_missing_stats", sql(O.CREDIT_ALL, _DIRTY, body=(
    f", a AS ({_MISS_AGG})\nSELECT a.n AS n_rows, CAST("
    + " + ".join(f"a.m{i}" for i in range(len(_DIRTY_COLS)))
    + " AS BIGINT) AS total_missing, ROUND(("
    + " + ".join(f"CAST(a.m{i} AS DOUBLE) / a.n" for i in range(len(_DIRTY_COLS)))
    + f") / {len(_DIRTY_COLS)}, 6) AS missing_pct FROM a")))
def q_dq_missing_stats(spark, sf):
    return round_doubles(q.missing_stats(_dirty(spark, sf)))


# ----------------------------------------------------------------------------- V3
@register("dq_duplicates", sql(O.CREDIT_ALL, _DIRTY, body="""
SELECT CAST(COUNT(*) AS BIGINT) AS n_rows,
       (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM dirty)) AS n_distinct,
       CAST(COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM dirty)) AS BIGINT) AS n_duplicates
FROM dirty"""))
def q_dq_duplicates(spark, sf):
    return q.check_duplicates(_dirty(spark, sf))


@register("dq_duplicates_features", sql(O.CREDIT_ALL, body="""
, f AS (SELECT * EXCLUDE (ID, AS_OF) FROM credit)
SELECT CAST(COUNT(*) AS BIGINT) AS n_rows,
       (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM f)) AS n_distinct,
       CAST(COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM f)) AS BIGINT) AS n_duplicates
FROM f"""))
def q_dq_duplicates_features(spark, sf):
    """Duplicates over the 24 modelling columns only (ID and date dropped)."""
    return q.check_duplicates(credit(spark, sf).drop("ID", "AS_OF"))


# ----------------------------------------------------------------------------- V4
_RANGE_AGG = ("SELECT COUNT(*) AS n, "
              + ", ".join(f"COUNT(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) AS r{i}"
                          for i, (c, (lo, hi)) in enumerate(VALID_RANGES.items()))
              + " FROM dirty")


@register("dq_ranges", sql(O.CREDIT_ALL, _DIRTY, body=_unpivot(
    _RANGE_AGG, [(c, f"r{i}") for i, c in enumerate(VALID_RANGES)], "range",
    "CASE WHEN v.nb > 0 THEN 'warning' ELSE 'ok' END")))
def q_dq_ranges(spark, sf):
    return round_doubles(q.check_ranges(_dirty(spark, sf)))


# ----------------------------------------------------------------------------- V5
@register("dq_class_balance", sql(O.CREDIT_ALL, body="""
SELECT COUNT(*) AS n_rows,
       COUNT(*) FILTER (WHERE default_payment_next_month = 0) AS n_negative,
       COUNT(*) FILTER (WHERE default_payment_next_month = 1) AS n_positive,
       ROUND(AVG(CAST(default_payment_next_month AS DOUBLE)), 6) AS default_rate,
       CASE WHEN AVG(CAST(default_payment_next_month AS DOUBLE)) < 0.05
              OR AVG(CAST(default_payment_next_month AS DOUBLE)) > 0.5 THEN 'warning' ELSE 'ok' END AS severity
FROM credit"""))
def q_dq_class_balance(spark, sf):
    return round_doubles(q.check_class_balance(credit(spark, sf)))


# ----------------------------------------------------------------------------- V6
_NEG_COLS = PAY_AMT_COLS + BILL_COLS
_NEG_AGG = ("SELECT COUNT(*) AS n, "
            + ", ".join(f"COUNT(*) FILTER (WHERE {c} < 0) AS g{i}" for i, c in enumerate(_NEG_COLS))
            + " FROM dirty")


@register("dq_negative_amounts", sql(O.CREDIT_ALL, _DIRTY, body=_unpivot(
    _NEG_AGG, [(c, f"g{i}") for i, c in enumerate(_NEG_COLS)], "negative",
    "CASE WHEN v.nb = 0 THEN 'ok' WHEN v.col LIKE 'PAY_AMT%' THEN 'warning' ELSE 'info' END")))
def q_dq_negative_amounts(spark, sf):
    return round_doubles(q.check_negative_amounts(_dirty(spark, sf)))


# ----------------------------------------------------------------------------- V7
_REPORT_SQL = f"""
, a AS ({_MISS_AGG}),
miss AS (SELECT 'missing' AS check_name, v.col AS column_name,
           CASE WHEN CAST(v.nb AS DOUBLE) / a.n > 0.05 THEN 'issue' WHEN v.nb > 0 THEN 'warning' ELSE 'ok' END AS severity,
           CAST(v.nb AS BIGINT) AS n_bad, ROUND(CAST(v.nb AS DOUBLE) / a.n, 6) AS pct
         FROM a, LATERAL (VALUES {", ".join(f"('{c}', a.{e})" for c, e in _MISS_PAIRS)}) AS v(col, nb)),
r AS ({_RANGE_AGG}),
rng AS (SELECT 'range' AS check_name, v.col AS column_name,
          CASE WHEN v.nb > 0 THEN 'warning' ELSE 'ok' END AS severity,
          CAST(v.nb AS BIGINT) AS n_bad, ROUND(CAST(v.nb AS DOUBLE) / r.n, 6) AS pct
        FROM r, LATERAL (VALUES {", ".join(f"('{c}', r.r{i})" for i, c in enumerate(VALID_RANGES))}) AS v(col, nb)),
g AS ({_NEG_AGG}),
neg AS (SELECT 'negative' AS check_name, v.col AS column_name,
          CASE WHEN v.nb = 0 THEN 'ok' WHEN v.col LIKE 'PAY_AMT%' THEN 'warning' ELSE 'info' END AS severity,
          CAST(v.nb AS BIGINT) AS n_bad, ROUND(CAST(v.nb AS DOUBLE) / g.n, 6) AS pct
        FROM g, LATERAL (VALUES {", ".join(f"('{c}', g.g{i})" for i, c in enumerate(_NEG_COLS))}) AS v(col, nb)),
dup AS (SELECT 'duplicates' AS check_name, CAST(NULL AS VARCHAR) AS column_name, 'warning' AS severity,
          CAST(COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM dirty)) AS BIGINT) AS n_bad,
          ROUND(CAST(COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM dirty)) AS DOUBLE) / COUNT(*), 6) AS pct
        FROM dirty),
cb AS (SELECT 'class_balance' AS check_name, 'default_payment_next_month' AS column_name, 'warning' AS severity,
         CAST(COUNT(*) FILTER (WHERE default_payment_next_month = 1) AS BIGINT) AS n_bad,
         ROUND(AVG(CAST(default_payment_next_month AS DOUBLE)), 6) AS pct FROM dirty),
found AS (
  SELECT * FROM miss WHERE severity <> 'ok'
  UNION ALL SELECT * FROM rng WHERE severity <> 'ok'
  UNION ALL SELECT * FROM neg WHERE severity <> 'ok'
  UNION ALL SELECT 'schema', 'AS_OF', 'warning', CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE)
  UNION ALL SELECT * FROM dup WHERE n_bad > 0
  UNION ALL SELECT * FROM cb WHERE pct < 0.05 OR pct > 0.5)
SELECT * FROM found
UNION ALL
SELECT 'summary', CAST(NULL AS VARCHAR),
       CASE WHEN COUNT(*) FILTER (WHERE severity = 'issue') > 0 THEN 'failed' ELSE 'passed' END,
       CAST(COUNT(*) FILTER (WHERE severity = 'issue') AS BIGINT), CAST(NULL AS DOUBLE)
FROM found"""


@register("dq_report", sql(O.CREDIT_ALL, _DIRTY, body=_REPORT_SQL))
def q_dq_report(spark, sf):
    return round_doubles(q.validation_report(_dirty(spark, sf)))


# ----------------------------------------------------------------------------- Q1
def _name_list_sql(flags: list[tuple[str, str]]) -> str:
    inner = ", ".join(f"CASE WHEN {f} THEN '{n}' END" for n, f in flags)
    return f"NULLIF(concat_ws(',', {inner}), '')"


_MISSING_SQL = _name_list_sql([(c, f"{c} IS NULL") for c in REQUIRED_FIELDS])
_DOUBLE_FIELDS = [c for c in ["LIMIT_BAL"] + BILL_COLS + PAY_AMT_COLS]
_NAN_SQL = _name_list_sql([(c, f"COALESCE(isnan({c}), false)") for c in _DOUBLE_FIELDS])
_RANGE_WARN = " + ".join(
    f"CASE WHEN {c} IS NOT NULL AND NOT ({c} >= {lo} AND {c} <= {hi}) THEN 1 ELSE 0 END"
    for c, (lo, hi) in SCORING_RANGES.items())
_NEG_WARN = " + ".join(f"CASE WHEN {c} < 0 THEN 1 ELSE 0 END" for c in PAY_AMT_COLS)


@register("check_records", sql(O.CREDIT_ALL, body=f"""
, chk AS (SELECT ID, {_MISSING_SQL} AS missing_fields, {_NAN_SQL} AS nan_fields,
                 {_RANGE_WARN} + {_NEG_WARN} AS n_warnings FROM credit_all)
SELECT ID, missing_fields, nan_fields,
       CAST((CASE WHEN missing_fields IS NULL THEN 0 ELSE 1 END)
          + (CASE WHEN nan_fields IS NULL THEN 0 ELSE 1 END) AS INTEGER) AS n_errors,
       CAST(n_warnings AS INTEGER) AS n_warnings,
       missing_fields IS NULL AND nan_fields IS NULL AS valid
FROM chk"""))
def q_check_records(spark, sf):
    c = q.check_records(src.credit_all(spark, sf))
    return c.select("ID", "missing_fields", "nan_fields", F.size("errors").alias("n_errors"),
                    F.size("warnings").alias("n_warnings"), "valid")


@register("quarantine", sql(O.CREDIT_ALL, body=f"""
SELECT ID, {_MISSING_SQL} AS missing_fields FROM credit_all
WHERE {_MISSING_SQL} IS NOT NULL OR {_NAN_SQL} IS NOT NULL"""))
def q_quarantine(spark, sf):
    _, bad = q.quarantine(src.credit_all(spark, sf))
    return bad.select("ID", "missing_fields")


# ----------------------------------------------------------------------------- Q2
_NUMERIC_ALL = ["ID"] + [c for c in EXPECTED_COLUMNS]


_BATCH_SQL = (
    ", a AS (SELECT COUNT(*) AS n, "
    + ", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS m{i}" for i, c in enumerate(REQUIRED_FIELDS))
    + ", "
    + ", ".join(f"COUNT(*) FILTER (WHERE isinf(CAST({c} AS DOUBLE))) AS i{i}" for i, c in enumerate(_NUMERIC_ALL))
    + " FROM credit_all)\n"
    "SELECT v.column_name, v.check_name, COALESCE(CASE WHEN v.check_name = 'missing' THEN v.value > 0.05 "
    "ELSE v.value > 0 END, false) AS error, ROUND(v.value, 6) AS value FROM a, LATERAL (VALUES "
    + ", ".join(f"('{c}', 'missing', CAST(a.m{i} AS DOUBLE) / a.n)" for i, c in enumerate(REQUIRED_FIELDS))
    + ", "
    + ", ".join(f"('{c}', 'inf', CAST(a.i{i} AS DOUBLE))" for i, c in enumerate(_NUMERIC_ALL))
    + ") AS v(column_name, check_name, value)")


@register("check_batch", sql(O.CREDIT_ALL, body=_BATCH_SQL))
def q_check_batch(spark, sf):
    return round_doubles(q.check_batch(src.credit_all(spark, sf).drop("AS_OF")))


# ----------------------------------------------------------------------------- Q3
def _viol_sql() -> str:
    flags = []
    for c, (ge, le) in REQUEST_CONSTRAINTS.items():
        cond = f"{c} IS NULL"
        if ge is not None:
            cond += f" OR {c} < {ge}"
        if le is not None:
            cond += f" OR {c} > {le}"
        flags.append((c, f"({cond})"))
    return _name_list_sql(flags)


@register("request_constraints", sql(O.CREDIT_ALL, body=f"""
SELECT ID, {_viol_sql()} AS violations, {_viol_sql()} IS NULL AS accepted FROM credit_all"""))
def q_request_constraints(spark, sf):
    return q.request_constraints(src.credit_all(spark, sf)).select("ID", "violations", "accepted")
