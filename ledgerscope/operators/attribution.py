"""Per-feature attributions.

Linear models: with an all-zero background the attribution of feature j is
``coef_j * x_j`` on the (scaled) model input -- a projection, no shuffle.
Attributions are kept per row as ``array<struct<feature, shap_value, feature_value>>``
in model-feature order; top drivers are picked with ``array_sort`` + ``slice``
(no explode, no window), global importance is one aggregate over ``inline``.
Tree models: see ``ledgerscope.operators.treeshap``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerscope.schema import ID_COL, TOP_DRIVERS


@dataclass
class LinearScorer:
    """Fixed-coefficient logistic model over named (aligned, scaled) features."""
    intercept: float
    coefs: dict[str, float] = field(default_factory=dict)

    def margin(self) -> Column:
        m = F.lit(self.intercept)
        for c, w in self.coefs.items():
            m = m + F.lit(w) * F.col(c)
        return m

    def probability(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin()))


def linear_attributions(df: DataFrame, model: LinearScorer, features: list[str],
                        out: str = "attributions") -> DataFrame:
    """Add ``out``: one struct per model feature (in order) with coef * value."""
    items = [F.struct(F.lit(f).alias("feature"),
                      (F.lit(float(model.coefs.get(f, 0.0))) * F.col(f).cast("double")).alias("shap_value"),
                      F.col(f).cast("double").alias("feature_value"),
                      F.lit(i).alias("pos"))
             for i, f in enumerate(features)]
    return df.withColumn(out, F.array(*items))


def top_drivers(df: DataFrame, col: str = "attributions", n: int = TOP_DRIVERS,
                out: str = "top_drivers") -> DataFrame:
    """Top ``n`` by |shap_value| (ties keep feature order), values rounded to 4,
    direction 'increases_risk' iff shap_value > 0; missing attributions are left out."""
    # natural struct ordering (-|phi|, position) sorts without a comparator lambda
    keyed = F.transform(F.filter(col, lambda s: s["shap_value"].isNotNull()), lambda s: F.struct(
        (-F.abs(s["shap_value"])).alias("k"), s["pos"].alias("pos"), s["feature"].alias("feature"),
        s["shap_value"].alias("shap_value"), s["feature_value"].alias("feature_value")))
    ranked = F.sort_array(keyed, asc=True)
    top = F.slice(ranked, 1, n)
    return df.withColumn(out, F.transform(top, lambda s: F.struct(
        s["feature"].alias("feature"), F.round(s["shap_value"], 4).alias("shap_value"),
        F.round(s["feature_value"], 4).alias("feature_value"),
        F.when(s["shap_value"] > 0, "increases_risk").otherwise("decreases_risk").alias("direction"))))


def global_importance(df: DataFrame, col: str = "attributions") -> DataFrame:
    """Mean |attribution| per feature over ALL rows (no sampling); one aggregate."""
    long = df.select(F.inline(F.col(col)))
    return long.groupBy("feature").agg(F.avg(F.abs("shap_value")).alias("mean_abs_shap"),
                                       F.min("pos").alias("pos"))


def extreme_rows(df: DataFrame, p: str = "p", key: str = ID_COL) -> DataFrame:
    """Highest- and lowest-probability rows (ties: smallest key) via max_by/min_by; rows
    without a probability are neither."""
    agg = df.where(F.col(p).isNotNull()).agg(F.max_by(F.struct(F.col(key).alias("k"), F.col(p).alias("v")),
                          F.struct(F.col(p), -F.col(key))).alias("hi"),
                 F.min_by(F.struct(F.col(key).alias("k"), F.col(p).alias("v")),
                          F.struct(F.col(p), F.col(key))).alias("lo"))
    return agg.selectExpr(f"stack(2, 'highest', hi.k, hi.v, 'lowest', lo.k, lo.v) AS (which, {key}, {p})")
