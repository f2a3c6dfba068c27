"""Distribution drift between a reference and a current frame.

Both frames are unpivoted ONCE into a long (feature, value, side) frame, so every
feature is tested in the same jobs -- no Python loop of actions per column.

* KS: counts per (feature, value, side) -> running totals per feature (range-pieced,
  no single-partition window) -> max |F_ref - F_cur|.
* PSI: joint min / max per feature (one aggregate), 10 equal-width bins with the
  exact edges ``lo + i * ((hi - lo) / 10)``, last bin closed; bin = number of inner
  edges <= value. The edges table has #features rows (broadcast, bounded).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscope.operators.cumulative import running_totals
from ledgerscope.schema import (DRIFT_MIN_ROWS, KS_THRESHOLD, PSI_BINS, PSI_EPS, PSI_THRESHOLD,
                                TARGET, ID_COL)
from ledgerscope.session import stored

EXACT_ROWS = 10_000       # samples up to this size get the exact p-value


def shared_numeric_columns(ref: DataFrame, cur: DataFrame,
                           exclude: tuple[str, ...] = (ID_COL, TARGET)) -> list[str]:
    """Numeric columns present in both frames, sorted by name (deterministic)."""
    def numeric(df):
        return {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    return sorted((numeric(ref) & numeric(cur)) - set(exclude))


def long_values(ref: DataFrame, cur: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value, side) with side 0 = reference, 1 = current; NULLs dropped."""
    def melt(df, side):
        wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        return (wide.unpivot([], columns, "feature", "value")
                .where(F.col("value").isNotNull()).withColumn("side", F.lit(side)))
    return melt(ref, 0).unionByName(melt(cur, 1))


def kolmogorov_pvalue(d: Column, n_ref: Column, n_cur: Column, terms: int = 20) -> Column:
    """Asymptotic two-sided p-value Q(z) of the Kolmogorov distribution with
    z = sqrt(n m / (n + m)) * d. For z >= 1 the alternating series
    2 sum (-1)^(k-1) exp(-2 k^2 z^2); below 1 the dual series
    1 - sqrt(2 pi) / z * sum exp(-(2k-1)^2 pi^2 / (8 z^2)); clipped to [0, 1]."""
    z = F.sqrt(n_ref * n_cur / (n_ref + n_cur)) * d
    upper = reduce(lambda a, b: a + b, [
        F.lit(2.0 * (1 if k % 2 else -1)) * F.exp(F.lit(-2.0 * k * k) * z * z) for k in range(1, terms + 1)])
    lower = F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / z * reduce(lambda a, b: a + b, [
        F.exp(F.lit(-((2 * k - 1) ** 2) * math.pi ** 2 / 8.0) / (z * z)) for k in range(1, terms + 1)])
    q = F.when(z >= 1, upper).otherwise(lower)
    return F.when(z <= 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), q)))


def lattice_pvalue(k: int, n: int, m: int) -> float:
    """Exact P(D >= d) of the two-sample statistic d = k / (n m): one less the share of lattice
    paths from (0, 0) to (n, m) that stay where |i m - j n| < k. Paths are added up row by row
    inside that band; a row is divided by its largest number, so nothing overflows."""
    if k <= 0:
        return 1.0
    lo, hi, scale = 0, min(m, (k - 1) // n), 0.0
    row = np.ones(hi - lo + 1)               # paths to (0, j) for j = lo .. hi
    for i in range(1, n + 1):
        new_lo, new_hi = max(0, (i * m - k) // n + 1), min(m, (i * m + k - 1) // n)
        if new_lo > new_hi:
            return 1.0
        from_left = np.zeros(new_hi - new_lo + 1)
        a, b = max(lo, new_lo), min(hi, new_hi)
        if a <= b:
            from_left[a - new_lo:b - new_lo + 1] = row[a - lo:b - lo + 1]
        row, lo, hi = from_left.cumsum(), new_lo, new_hi
        top = row.max()
        if top <= 0:
            return 1.0
        row, scale = row / top, scale + math.log(top)
    if hi < m or row[-1] <= 0:
        return 1.0
    total = math.lgamma(n + m + 1) - math.lgamma(n + 1) - math.lgamma(m + 1)
    return min(1.0, max(0.0, -math.expm1(scale + math.log(row[-1]) - total)))


def exact_ks(counts: DataFrame, most_rows: int = EXACT_ROWS) -> DataFrame:
    """Per feature: n_ref, n_cur, ks_statistic and the exact p-value where both samples have at
    most ``most_rows`` rows, else the asymptotic one. The lattice is walked on the result
    rows, one a feature, in Arrow batches."""
    cum = running_totals(counts, "value", ["r", "c"], ["feature"])
    gap = F.abs(F.col("cum_r") * F.col("tot_c") - F.col("cum_c") * F.col("tot_r"))
    one = cum.groupBy("feature").agg(F.first("tot_r").alias("n_ref"), F.first("tot_c").alias("n_cur"), F.max(gap).alias("_k"))
    one = one.where("n_ref > 0 AND n_cur > 0").withColumn("ks_statistic", F.col("_k") / (F.col("n_ref") * F.col("n_cur")))

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            small = (pdf["n_ref"] <= most_rows) & (pdf["n_cur"] <= most_rows)
            yield pdf.assign(exact=[lattice_pvalue(int(k), int(n), int(m)) if ok else None
                                    for k, n, m, ok in zip(pdf["_k"], pdf["n_ref"], pdf["n_cur"], small, strict=True)])
    got = one.mapInPandas(walk, T.StructType([*one.schema.fields, T.StructField("exact", T.DoubleType())]))
    about = kolmogorov_pvalue(F.col("ks_statistic"), F.col("n_ref").cast("double"), F.col("n_cur").cast("double"))
    return got.select("feature", "n_ref", "n_cur", "ks_statistic", F.coalesce("exact", about).alias("ks_p_value"),
                      F.col("exact").isNotNull().alias("is_exact"))


def value_counts(long: DataFrame) -> DataFrame:
    """(feature, value, r, c): rows of either side, the one table that KS and PSI read."""
    return long.groupBy("feature", "value").agg(
        F.count_if(F.col("side") == 0).alias("r"), F.count_if(F.col("side") == 1).alias("c"))


def ks_statistics(long: DataFrame) -> DataFrame:
    """Per feature: n_ref, n_cur, ks_statistic (unrounded), ks_p_value (asymptotic)."""
    return ks_of_counts(value_counts(long))


def ks_of_counts(counts: DataFrame) -> DataFrame:
    cum = running_totals(counts, "value", ["r", "c"], ["feature"])
    j = cum.withColumnsRenamed({"tot_r": "n_ref", "tot_c": "n_cur"})
    gap = F.abs(F.try_divide(F.col("cum_r").cast("double"), F.col("n_ref"))
                - F.try_divide(F.col("cum_c").cast("double"), F.col("n_cur")))
    ks = j.groupBy("feature").agg(F.max(gap).alias("ks_statistic"),
                                  F.first("n_ref").alias("n_ref"), F.first("n_cur").alias("n_cur"))
    return ks.withColumn("ks_p_value", kolmogorov_pvalue(F.col("ks_statistic"), F.col("n_ref").cast("double"),
                                                         F.col("n_cur").cast("double")))


def psi_values(long: DataFrame, bins: int = PSI_BINS, eps: float = PSI_EPS) -> DataFrame:
    """Per feature: PSI over equal-width bins of the joint range (unrounded)."""
    return psi_of_counts(value_counts(long), bins, eps)


def psi_of_counts(counts: DataFrame, bins: int = PSI_BINS, eps: float = PSI_EPS) -> DataFrame:
    ends = counts.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"),
                                         F.sum("r").alias("nr"), F.sum("c").alias("nc"))
    step = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    edges = ends.select("feature", "nr", "nc", *[(F.lit(float(i)) * step + F.col("lo")).alias(f"e{i}") for i in range(1, bins)])
    # one row per feature: bounded by the number of features -> broadcast
    binned = counts.join(F.broadcast(edges), "feature").select(
        "feature", "r", "c", "nr", "nc",
        reduce(lambda a, b: a + b, [F.when(F.col("value") >= F.col(f"e{i}"), 1).otherwise(0)
                                    for i in range(1, bins)]).alias("bin"))
    # absent bins contribute (eps - eps) * ln(1) = 0, so only present bins are summed
    j = binned.groupBy("feature", "bin").agg(F.sum("r").alias("r"), F.sum("c").alias("c"), F.first("nr").alias("nr"), F.first("nc").alias("nc"))
    rp = F.try_divide(F.col("r").cast("double"), F.col("nr")) + F.lit(eps)
    cp = F.try_divide(F.col("c").cast("double"), F.col("nc")) + F.lit(eps)
    return j.groupBy("feature").agg(F.sum((cp - rp) * F.log(cp / rp)).alias("psi"))


def drift_report(ref: DataFrame, cur: DataFrame, columns: list[str] | None = None,
                 ks_threshold: float = KS_THRESHOLD, psi_threshold: float = PSI_THRESHOLD,
                 min_rows: int = DRIFT_MIN_ROWS) -> DataFrame:
    """Per feature with >= min_rows non-null values on both sides: rounded KS
    statistic and p-value, KS drift flag (unrounded statistic > threshold), rounded
    PSI and its flag, and the combined flag."""
    cols = columns or shared_numeric_columns(ref, cur)
    # saved: cuts, totals, running sums, edges and bins are five passes over it, in plans that
    # filters pushed down by the caller would make different, each with the unpivot of its own
    counts = stored(value_counts(long_values(ref, cur, cols)), "drift")
    ks = ks_of_counts(counts).where((F.col("n_ref") >= min_rows) & (F.col("n_cur") >= min_rows))
    # a row a feature on either side
    j = ks.join(F.broadcast(psi_of_counts(counts)), "feature")
    psi_r = F.round(F.col("psi"), 4)
    return j.select("feature", "n_ref", "n_cur",
                    F.round("ks_statistic", 4).alias("ks_statistic"),
                    F.round("ks_p_value", 4).alias("ks_p_value"),
                    (F.col("ks_statistic") > ks_threshold).alias("ks_drifted"),
                    psi_r.alias("psi"), (psi_r > psi_threshold).alias("psi_drifted"),
                    ((F.col("ks_statistic") > ks_threshold) | (psi_r > psi_threshold)).alias("drifted"))


def drift_summary(report: DataFrame) -> DataFrame:
    """Counts, rate and sorted names of the drifted features (one row a feature comes in)."""
    return report.agg(F.count(F.lit(1)).alias("n_features_checked"),
                      F.count_if("drifted").alias("n_drifted"),
                      F.sort_array(F.collect_list(F.when(F.col("drifted"), F.col("feature")))).alias("drifted_features")).select(
        "n_features_checked", "n_drifted",
        F.round(F.col("n_drifted") / F.greatest(F.col("n_features_checked"), F.lit(1)), 3).alias("drift_rate"),
        "drifted_features")


def score_shift(ref_scores: DataFrame, cur_scores: DataFrame, col: str = "risk_score",
                psi_threshold: float = PSI_THRESHOLD) -> DataFrame:
    """PSI of the score distribution (rounded to 4) and whether it exceeds the threshold."""
    long = long_values(ref_scores.select(col), cur_scores.select(col), [col])
    psi = psi_values(long)
    return psi.select(F.round("psi", 4).alias("score_psi"),
                      (F.round("psi", 4) > psi_threshold).alias("score_shifted"),
                      F.lit(psi_threshold).alias("threshold"))


def chi2_drift(ref: DataFrame, cur: DataFrame, columns: list[str]) -> DataFrame:
    """Two-sample chi-squared homogeneity statistic per categorical column:
    sum over categories and sides of (O - E)^2 / E with E from the pooled rate."""
    long = long_values(ref, cur, columns)
    cnt = long.groupBy("feature", "value").agg(
        F.count_if(F.col("side") == 0).alias("r"), F.count_if(F.col("side") == 1).alias("c"))
    tot = cnt.groupBy("feature").agg(F.sum("r").alias("nr"), F.sum("c").alias("nc"),
                                     F.count(F.lit(1)).alias("k"))
    j = cnt.join(tot, "feature")
    n = F.col("nr") + F.col("nc")
    er = (F.col("r") + F.col("c")) * F.col("nr") / n
    ec = (F.col("r") + F.col("c")) * F.col("nc") / n
    term = F.pow(F.col("r") - er, 2) / er + F.pow(F.col("c") - ec, 2) / ec
    return j.groupBy("feature").agg(F.sum(term).alias("chi2"), F.first("k").alias("n_categories")).select(
        "feature", "chi2", (F.col("n_categories") - 1).alias("dof"))


def monitoring_alerts(report: DataFrame, importance: DataFrame, auc_ref: DataFrame, auc_cur: DataFrame,
                      top_n: int = 5, psi_threshold: float = PSI_THRESHOLD,
                      auc_drop: float = 0.03) -> DataFrame:
    """Alert rows: PSI above threshold on a top-N important feature; ROC-AUC drop
    above ``auc_drop`` between two labelled evaluations (one-row frames 'roc_auc')."""
    top = importance.orderBy(F.desc("mean_abs_shap"), "feature").limit(top_n).select("feature")
    psi_alerts = report.join(top, "feature", "left_semi").where(F.col("psi") > psi_threshold).select(
        F.lit("psi_top_feature").alias("alert"), "feature", F.col("psi").alias("value"))
    a = auc_ref.select(F.col("roc_auc").alias("auc_ref")).withColumn("_k", F.lit(0))
    b = auc_cur.select(F.col("roc_auc").alias("auc_cur")).withColumn("_k", F.lit(0))
    drop = a.join(b, "_k").where(F.col("auc_ref") - F.col("auc_cur") > auc_drop).select(
        F.lit("auc_drop").alias("alert"), F.lit(None).cast("string").alias("feature"),
        (F.col("auc_ref") - F.col("auc_cur")).alias("value"))
    return psi_alerts.unionByName(drop)
