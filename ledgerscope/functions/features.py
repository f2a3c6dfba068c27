"""Column expressions for the eight derived features.

All are plain Catalyst expressions (one projection, whole-stage codegen, no shuffle).
Missing-value behaviour follows the original NumPy code after NaN -> NULL:
a missing month makes a mean / max / trend missing; ratios fall back to 0.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerscope.schema import (BILL_COLS, LIMIT_EPS, PAY_AMT_COLS, PAY_STATUS_COLS,
                                RATIO_CLIP)

# month 1 is the most recent; weights are (i - 3.5) for i = 1..6, denominator 17.5
TREND_WEIGHTS = [-2.5, -1.5, -0.5, 0.5, 1.5, 2.5]
TREND_DENOM = 17.5


def _sum(cols: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c) for c in cols])


def mean_of(cols: list[str]) -> Column:
    return _sum(cols) / F.lit(float(len(cols)))


def ratio_guard(c: Column) -> Column:
    """missing / infinite -> 0, then clip to [-5, 10]."""
    lo, hi = RATIO_CLIP
    fixed = F.when(c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(0.0)).otherwise(c)
    return F.least(F.lit(hi), F.greatest(F.lit(lo), fixed))


def safe_div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def util_ratio_1() -> Column:
    return ratio_guard(safe_div(F.col("BILL_AMT1"), F.col("LIMIT_BAL") + F.lit(LIMIT_EPS)))


def util_ratio_avg() -> Column:
    return ratio_guard(safe_div(mean_of(BILL_COLS), F.col("LIMIT_BAL") + F.lit(LIMIT_EPS)))


def pay_ratio_1() -> Column:
    return ratio_guard(safe_div(F.col("PAY_AMT1"), F.abs(F.col("BILL_AMT1")) + F.lit(1.0)))


def pay_ratio_avg() -> Column:
    return ratio_guard(safe_div(mean_of(PAY_AMT_COLS), F.abs(mean_of(BILL_COLS)) + F.lit(1.0)))


def delinquency_count() -> Column:
    flags = [F.coalesce((F.col(c) > 0).cast("int"), F.lit(0)) for c in PAY_STATUS_COLS]
    return reduce(lambda a, b: a + b, flags).cast("int")


def max_delinquency() -> Column:
    any_missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in PAY_STATUS_COLS])
    return F.when(any_missing, F.lit(None).cast("double")).otherwise(
        F.greatest(*[F.col(c) for c in PAY_STATUS_COLS]).cast("double"))


def linear_trend(cols: list[str]) -> Column:
    terms = [F.col(c) * F.lit(w) for c, w in zip(cols, TREND_WEIGHTS)]
    return reduce(lambda a, b: a + b, terms) / F.lit(TREND_DENOM)


def bill_trend() -> Column:
    return linear_trend(BILL_COLS)


def pay_trend() -> Column:
    return linear_trend(PAY_AMT_COLS)


DERIVED_EXPRS = {
    "util_ratio_1": util_ratio_1,
    "util_ratio_avg": util_ratio_avg,
    "pay_ratio_1": pay_ratio_1,
    "pay_ratio_avg": pay_ratio_avg,
    "delinquency_count": delinquency_count,
    "max_delinquency": max_delinquency,
    "bill_trend": bill_trend,
    "pay_trend": pay_trend,
}
