"""Probability -> score -> band expressions and the fixed demonstration model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerscope.schema import BAND_LOW_MAX, BAND_MEDIUM_MAX, BANDS

# ----------------------------------------------------------------------------------
# FIXED demonstration model (a logistic score with known coefficients). Evaluation,
# explanation and scoring queries use it so that SQL can restate them exactly.
# p = 1 / (1 + exp(-(-3.0 + 0.9*max_delinquency + 0.3*delinquency_count - 2*pay_ratio_1)))
# ----------------------------------------------------------------------------------
DEMO_INTERCEPT = -3.0
DEMO_COEFS = {"max_delinquency": 0.9, "delinquency_count": 0.3, "pay_ratio_1": -2.0}


def sigmoid(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def demo_margin() -> Column:
    m = F.lit(DEMO_INTERCEPT)
    for c, w in DEMO_COEFS.items():
        m = m + F.lit(w) * F.col(c)
    return m


def demo_probability() -> Column:
    return F.round(sigmoid(demo_margin()), 4)


def probability_to_score(p: Column) -> Column:
    """round-half-even(100 p) clipped to [0, 100] (``rint`` rounds half to even); NULL for a
    NULL p, which ``least`` and ``greatest`` alone would skip and so score as 0."""
    return F.when(p.isNotNull(), F.least(F.lit(100), F.greatest(F.lit(0), F.rint(p * 100).cast("int"))))


def score_to_band(score: Column) -> Column:
    return (F.when(score.isNull(), F.lit(None).cast("string"))
            .when(score <= BAND_LOW_MAX, F.lit(BANDS[0]))
            .when(score <= BAND_MEDIUM_MAX, F.lit(BANDS[1]))
            .otherwise(F.lit(BANDS[2])))


# ----------------------------------------------------------------------------------
# FIXED second demonstration model (for model comparison): lateness count only.
# p = 1 / (1 + exp(-(-2.5 + 1.0*delinquency_count)))
# ----------------------------------------------------------------------------------
LATE_INTERCEPT = -2.5
LATE_COEF = 1.0


def late_only_probability() -> Column:
    return F.round(sigmoid(F.lit(LATE_INTERCEPT) + F.lit(LATE_COEF) * F.col("delinquency_count")), 4)
