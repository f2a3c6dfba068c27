"""Scores, bands, batch scoring and its summary."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.functions.scoring import (demo_probability, probability_to_score,
                                           score_to_band)
from ledgerscope.operators.features import add_derived_features
from ledgerscope.operators.prep import clean_raw
from ledgerscope.schema import BANDS, DEFAULT_THRESHOLD

Predictor = Callable[[DataFrame], DataFrame]   # adds a double column "p"


def build_score_output(df: DataFrame, p_col: str = "p") -> DataFrame:
    """default_probability = round(p, 4); risk_score from the UNROUNDED p; risk_band."""
    score = probability_to_score(F.col(p_col))
    return df.withColumns({
        "default_probability": F.round(F.col(p_col), 4),
        "risk_score": score,
        "risk_band": score_to_band(score),
    })


def hard_prediction(p: F.Column, threshold: float = DEFAULT_THRESHOLD) -> F.Column:
    return (p >= F.lit(threshold)).cast("int")


def demo_predictor(df: DataFrame) -> DataFrame:
    """The fixed demonstration model over cleaned, derived features."""
    return df.withColumn("p", demo_probability())


def featurize(df: DataFrame) -> DataFrame:
    """clean (keeping ID as key) -> derived features."""
    return add_derived_features(clean_raw(df, keep_id=True))


def batch_score(df_raw: DataFrame, predictor: Predictor, prefix: str = "__raw_") -> DataFrame:
    """Score every input row; output = the ORIGINAL input columns + 3 score columns.

    The raw values ride along under a prefix while cleaning / derivation / scaling
    rewrite the working columns; Catalyst collapses it all into one projection
    (no shuffle, no join back to the input).
    """
    raw_cols = df_raw.columns
    carried = df_raw.select(*[F.col(c) for c in raw_cols],
                            *[F.col(c).alias(prefix + c) for c in raw_cols])
    scored = build_score_output(predictor(featurize(carried)), "p")
    return scored.select(*[F.col(prefix + c).alias(c) for c in raw_cols],
                         "default_probability", "risk_score", "risk_band")


def score_frame(df_raw: DataFrame, predictor: Predictor) -> DataFrame:
    """clean -> derive -> predict -> score output, keeping all feature columns."""
    return build_score_output(predictor(featurize(df_raw)), "p")


def band_summary(scored: DataFrame) -> DataFrame:
    """Per band in order Low, Medium, High (zeros shown): count, percent of all rows,
    and the average default probability over all rows. One aggregate pass, then a
    3-row ``stack``: no join against a literal table."""
    aggs = [F.count(F.lit(1)).alias("_n"), F.avg("default_probability").alias("_avg")]
    aggs += [F.count_if(F.col("risk_band") == b).alias(f"_n{i}") for i, b in enumerate(BANDS)]
    one = scored.agg(*aggs)
    stack = ", ".join(f"{i + 1}, '{b}', _n{i}" for i, b in enumerate(BANDS))
    long = one.selectExpr(f"stack({len(BANDS)}, {stack}) AS (band_order, risk_band, n_records)",
                          "_n", "_avg")
    return long.select(
        F.col("band_order").cast("int").alias("band_order"), "risk_band",
        F.col("n_records").cast("bigint").alias("n_records"),
        F.round(F.try_divide(F.col("n_records") * 100.0, F.col("_n")), 6).alias("pct"),
        F.round(F.col("_avg"), 6).alias("avg_default_probability"))
