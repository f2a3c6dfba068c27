"""Independent SQL for every registered query (run by DuckDB over the raw tables).

The SQL is written separately from the DataFrame code on purpose: it restates each
rule directly, so agreement between the two is evidence of correctness. Shared
common table expressions (the credit table, cleaning, derived features, the fixed
demo model) are composed from the strings below.
"""

from __future__ import annotations

from ledgerscope.schema import BILL_COLS, PAY_AMT_COLS, PAY_STATUS_COLS

_STAT = ", ".join(f"{c}" for c in PAY_STATUS_COLS)


def _lags() -> str:
    parts = []
    for k in range(1, 6):
        parts.append(f"LAG(bill,{k}) OVER w AS BILL_AMT{k + 1}, "
                     f"LAG(pay,{k}) OVER w AS {PAY_STATUS_COLS[k]}, "
                     f"LAG(amt,{k}) OVER w AS PAY_AMT{k + 1}")
    return ",\n         ".join(parts)


# credit table with every snapshot (older months may be NULL)
CREDIT_ALL = f"""
credit_li AS (
  SELECT l_orderkey,
         SUM(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 1 ELSE 0 END) AS nr,
         SUM(CAST(ROUND(l_extendedprice * l_discount * 100) AS BIGINT)) AS cents
  FROM lineitem GROUP BY l_orderkey),
credit_st AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_totalprice AS bill,
         CAST(LEAST(9, COALESCE(li.nr, 0) - 1) AS INTEGER) AS pay,
         COALESCE(li.cents, 0) / CAST(100 AS DOUBLE) AS amt
  FROM orders o LEFT JOIN credit_li li ON li.l_orderkey = o.o_orderkey),
credit_sn AS (
  SELECT o_orderkey AS ID, o_custkey, o_orderdate, bill AS BILL_AMT1, pay AS PAY_0, amt AS PAY_AMT1,
         {_lags()}
  FROM credit_st WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
credit_all AS (
  SELECT ID, CAST(o_orderdate AS DATE) AS AS_OF,
    CAST((FLOOR((c_acctbal + 1000) / 11000 * 49) + 1) * 10000 AS DOUBLE) AS LIMIT_BAL,
    CAST(1 + c_custkey % 2 AS INTEGER) AS SEX,
    CAST(c_custkey % 7 AS INTEGER) AS EDUCATION,
    CAST(c_nationkey % 4 AS INTEGER) AS MARRIAGE,
    CAST(21 + c_custkey % 54 AS INTEGER) AS AGE,
    {", ".join(PAY_STATUS_COLS)},
    {", ".join(BILL_COLS)},
    {", ".join(PAY_AMT_COLS)},
    CAST(CASE WHEN (ID * 7919) % 100 < 5
                 + CASE WHEN GREATEST({_STAT}) > 0 THEN 15 ELSE 0 END
                 + CASE WHEN GREATEST({_STAT}) > 1 THEN 25 ELSE 0 END
         THEN 1 ELSE 0 END AS INTEGER) AS default_payment_next_month
  FROM credit_sn LEFT JOIN customer ON c_custkey = o_custkey),
credit AS (SELECT * FROM credit_all),
credit_full AS (SELECT * FROM credit_all WHERE BILL_AMT6 IS NOT NULL)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def d(x: float) -> str:
    """A DOUBLE literal (DuckDB reads plain 0.3 as DECIMAL)."""
    return f"CAST({x!r} AS DOUBLE)"


def _guard(expr: str) -> str:
    return (f"LEAST({d(10.0)}, GREATEST({d(-5.0)}, CASE WHEN ({expr}) IS NULL OR isnan({expr}) "
            f"OR isinf({expr}) THEN {d(0.0)} ELSE ({expr}) END))")


def _mean(cols: list[str]) -> str:
    return f"(({' + '.join(cols)}) / {d(float(len(cols)))})"


def _trend(cols: list[str]) -> str:
    w = [-2.5, -1.5, -0.5, 0.5, 1.5, 2.5]
    terms = " + ".join(f"{c} * {d(x)}" for c, x in zip(cols, w))
    return f"(({terms}) / {d(17.5)})"


_ANY_NULL_STATUS = " OR ".join(f"{c} IS NULL" for c in PAY_STATUS_COLS)

DERIVED_SQL = {
    "util_ratio_1": _guard(f"BILL_AMT1 / (LIMIT_BAL + {d(1e-6)})"),
    "util_ratio_avg": _guard(f"{_mean(BILL_COLS)} / (LIMIT_BAL + {d(1e-6)})"),
    "pay_ratio_1": _guard(f"PAY_AMT1 / (ABS(BILL_AMT1) + {d(1.0)})"),
    "pay_ratio_avg": _guard(f"{_mean(PAY_AMT_COLS)} / (ABS({_mean(BILL_COLS)}) + {d(1.0)})"),
    "delinquency_count": "CAST(" + " + ".join(
        f"COALESCE(CAST({c} > 0 AS INTEGER), 0)" for c in PAY_STATUS_COLS) + " AS INTEGER)",
    "max_delinquency": (f"CASE WHEN {_ANY_NULL_STATUS} THEN NULL ELSE "
                        f"CAST(GREATEST({', '.join(PAY_STATUS_COLS)}) AS DOUBLE) END"),
    "bill_trend": _trend(BILL_COLS),
    "pay_trend": _trend(PAY_AMT_COLS),
}


def clean_cte(src: str = "credit", name: str = "clean") -> str:
    return f"""{name} AS (
  SELECT * REPLACE (
    CAST(CASE WHEN EDUCATION IN (0, 5, 6) THEN 4 ELSE EDUCATION END AS INTEGER) AS EDUCATION,
    CAST(CASE WHEN MARRIAGE IN (0) THEN 3 ELSE MARRIAGE END AS INTEGER) AS MARRIAGE)
  FROM {src})"""


def feat_cte(src: str = "clean", name: str = "feat") -> str:
    cols = ",\n    ".join(f"{e} AS {n}" for n, e in DERIVED_SQL.items())
    return f"""{name} AS (
  SELECT *,
    {cols}
  FROM {src})"""


DEMO_P = (f"ROUND({d(1.0)} / ({d(1.0)} + EXP(-((({d(-3.0)} + {d(0.9)} * max_delinquency) "
          f"+ {d(0.3)} * delinquency_count) + {d(-2.0)} * pay_ratio_1))), 4)")


def score_sql(p: str) -> str:
    return f"CASE WHEN {p} IS NOT NULL THEN CAST(LEAST(100, GREATEST(0, round_even({p} * 100, 0))) AS INTEGER) END"


def band_sql(score: str) -> str:
    return f"CASE WHEN ({score}) IS NULL THEN NULL WHEN ({score}) <= 30 THEN 'Low' WHEN ({score}) <= 60 THEN 'Medium' ELSE 'High' END"


def scored_cte(src: str = "feat", name: str = "scored") -> str:
    return f"""{name}_p AS (SELECT *, {DEMO_P} AS p FROM {src}),
{name} AS (
  SELECT *, ROUND(p, 4) AS default_probability, {score_sql('p')} AS risk_score,
         {band_sql(score_sql('p'))} AS risk_band
  FROM {name}_p)"""


BASE = [CREDIT_ALL, clean_cte(), feat_cte(), scored_cte()]
