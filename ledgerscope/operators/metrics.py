"""Exact evaluation metrics over (group..., y, p) frames.

Inputs are long frames: one row per prediction with a 0/1 label ``y``, a
probability ``p`` and optional group columns (model name, split, segment). Every
metric is grouped, so many models / splits are evaluated in the same jobs.

Rank metrics (ROC-AUC, average precision, ROC points) first collapse the rows to
one row per distinct (group, p) with positive / negative counts -- a partial +
final aggregate -- then take running totals with ``running_totals`` (no
single-partition window). Threshold metrics are conditional counts.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerscope.operators.cumulative import running_totals
from ledgerscope.schema import DEFAULT_THRESHOLD, THRESHOLD_GRID

# threshold grid of the search: linspace(0.05, 0.95, 91) (rule-generated, 91 values)
THRESHOLDS = [float(t) for t in np.linspace(*THRESHOLD_GRID)]
CALIBRATION_EDGES = [float(t) for t in np.linspace(0.0, 1.0, 11)]


def _counts_by_value(df: DataFrame, groups: list[str], y: str, p: str) -> DataFrame:
    return (df.where(F.col(p).isNotNull() & F.col(y).isNotNull())
            .groupBy(*groups, p)
            .agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg")))


def rank_metrics(df: DataFrame, groups: list[str] | None = None, y: str = "y", p: str = "p") -> DataFrame:
    """ROC-AUC and average precision from one set of running totals.

    ROC-AUC is exact, ties count half: sum_v pos_v * (neg_below_v + neg_v / 2) / (P N). AP =
    sum over distinct thresholds (descending) of (R_n - R_{n-1}) * P_n; counts at or above a
    score are the group's total less the rising sum before it."""
    groups = list(groups or [])
    cum = running_totals(_counts_by_value(df, groups, y, p), p, ["pos", "neg"], groups)
    tp = F.col("tot_pos") - F.col("cum_pos") + F.col("pos")
    fp = F.col("tot_neg") - F.col("cum_neg") + F.col("neg")
    return (cum.groupBy(*groups)
            .agg(F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") / 2.0)).alias("_s"),
                 F.sum(F.col("pos") * (tp / (tp + fp))).alias("_a"),
                 F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
            .select(*groups, F.try_divide(F.col("_s"), F.col("_P") * F.col("_N")).alias("roc_auc"),
                    F.try_divide(F.col("_a"), F.col("_P")).alias("pr_auc")))


def roc_auc(df: DataFrame, groups: list[str] | None = None, y: str = "y", p: str = "p") -> DataFrame:
    """Exact ROC-AUC, see ``rank_metrics``."""
    return rank_metrics(df, groups, y, p).select(*(groups or []), "roc_auc")


def average_precision(df: DataFrame, groups: list[str] | None = None, y: str = "y",
                      p: str = "p") -> DataFrame:
    """Average precision, see ``rank_metrics``."""
    return rank_metrics(df, groups, y, p).select(*(groups or []), "pr_auc")


def brier(df: DataFrame, groups: list[str] | None = None, y: str = "y", p: str = "p") -> DataFrame:
    return df.groupBy(*(groups or [])).agg(
        F.avg(F.pow(F.col(p) - F.col(y), 2)).alias("brier_score"))


def _confusion_aggs(y: str, yhat: F.Column) -> list:
    return [F.count_if((F.col(y) == 1) & (yhat == 1)).alias("tp"),
            F.count_if((F.col(y) != 1) & (yhat == 1)).alias("fp"),
            F.count_if((F.col(y) == 1) & (yhat != 1)).alias("fn"),
            F.count_if((F.col(y) != 1) & (yhat != 1)).alias("tn")]


def _ratio(a: F.Column, b: F.Column) -> F.Column:
    """a / b, 0 when b is 0 (zero_division = 0)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)


def prf(tp: F.Column, fp: F.Column, fn: F.Column) -> dict[str, F.Column]:
    return {"precision": _ratio(tp, tp + fp), "recall": _ratio(tp, tp + fn),
            "f1": _ratio(2 * tp, 2 * tp + fp + fn)}


def threshold_metrics(df: DataFrame, groups: list[str] | None = None, y: str = "y", p: str = "p",
                      threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Precision, recall, F1 at ``p >= threshold``; confusion counts; supports and rates."""
    groups = list(groups or [])
    yhat = (F.col(p) >= F.lit(threshold)).cast("int")
    agg = df.groupBy(*groups).agg(*_confusion_aggs(y, yhat),
                                  F.avg(F.col(y).cast("double")).alias("default_rate"),
                                  F.avg(yhat.cast("double")).alias("predicted_default_rate"))
    m = prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return agg.select(*groups, m["precision"].alias("precision"), m["recall"].alias("recall"),
                      m["f1"].alias("f1"), "tp", "fp", "fn", "tn",
                      (F.col("tp") + F.col("fn")).alias("support_positive"),
                      (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("support_total"),
                      "default_rate", "predicted_default_rate")


def confusion_matrix(df: DataFrame, groups: list[str] | None = None, y: str = "y", p: str = "p",
                     threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """[[tn, fp], [fn, tp]] plus the four counts (zeros when a class is absent)."""
    t = threshold_metrics(df, groups, y, p, threshold)
    return t.select(*(groups or []), "tn", "fp", "fn", "tp",
                    F.array(F.array("tn", "fp"), F.array("fn", "tp")).alias("matrix"))


def compute_metrics(df: DataFrame, groups: list[str] | None = None, y: str = "y", p: str = "p",
                    threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """All metrics, one row per group."""
    groups = list(groups or [])
    if not groups:   # one constant group keeps every join an equi-join
        return compute_metrics(df.withColumn("_all", F.lit(0)), ["_all"], y, p, threshold).drop("_all")
    parts = [rank_metrics(df, groups, y, p),
             brier(df, groups, y, p), threshold_metrics(df, groups, y, p, threshold)]
    out = parts[0]
    for other in parts[1:]:
        out = out.join(other, groups, "inner")   # one row per group on each side
    return out.withColumn("threshold", F.lit(threshold))


def compare_models(metrics: DataFrame, model_col: str = "model") -> DataFrame:
    """Six headline metrics rounded to 4, keyed by model."""
    return metrics.select(F.col(model_col).alias("model"),
                          *[F.round(c, 4).alias(c) for c in
                            ["roc_auc", "pr_auc", "brier_score", "f1", "recall", "precision"]])


# ----------------------------------------------------------- threshold sweep
def _threshold_index(p: F.Column, ts: list[float]) -> F.Column:
    """Number of grid thresholds <= p, in O(1): arithmetic guess, then one-step
    corrections against the exact threshold values (no float drift)."""
    arr = F.array(*[F.lit(t) for t in ts])
    step = (ts[-1] - ts[0]) / (len(ts) - 1)
    guess = F.least(F.lit(len(ts)), F.greatest(F.lit(0),
                    (F.floor((p - F.lit(ts[0])) / F.lit(step)) + 1).cast("int")))
    up = F.when((guess < len(ts)) & (p >= F.element_at(arr, guess + 1)), guess + 1).otherwise(guess)
    return F.when((up > 0) & (p < F.element_at(arr, F.greatest(up, F.lit(1)))), up - 1).otherwise(up)


def threshold_sweep(df: DataFrame, groups: list[str] | None = None, y: str = "y", p: str = "p",
                    thresholds: list[float] | None = None) -> DataFrame:
    """Confusion counts and P/R/F1 at every grid threshold (predict 1 when p >= t).

    Each row lands in bucket k = "number of thresholds <= p" (0..len(grid)); per
    group the bucket table has at most len(grid)+1 rows, so the reverse running sum
    over it is a tiny window: TP at threshold j = positives in buckets > j. No
    rows x thresholds expansion, one aggregate over the data.
    """
    groups = list(groups or [])
    ts = thresholds or THRESHOLDS
    k = len(ts)
    b = (df.where(F.col(p).isNotNull())
         .groupBy(*groups, _threshold_index(F.col(p), ts).alias("bucket"))
         .agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg")))
    # dense bucket axis per group (k + 1 rows each), generated, not joined
    dense = (b.select(*groups).distinct() if groups else df.sparkSession.range(1).select())
    dense = dense.select(*groups, F.explode(F.sequence(F.lit(0), F.lit(k))).alias("bucket"))
    full = dense.join(b, [*groups, "bucket"], "left").select(
        *groups, "bucket", F.coalesce("pos", F.lit(0)).alias("pos"),
        F.coalesce("neg", F.lit(0)).alias("neg"))
    above = Window.partitionBy(*groups).orderBy(F.col("bucket").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*groups)
    arr = F.array(*[F.lit(t) for t in ts])
    out = full.select(*groups, "bucket",
                      F.sum("pos").over(above).alias("tp"), F.sum("neg").over(above).alias("fp"),
                      F.sum("pos").over(whole).alias("P"), F.sum("neg").over(whole).alias("N"))
    out = out.where(F.col("bucket") >= 1).select(
        *groups, F.element_at(arr, F.col("bucket")).alias("threshold"),
        F.col("tp").cast("bigint").alias("tp"), F.col("fp").cast("bigint").alias("fp"),
        (F.col("P") - F.col("tp")).cast("bigint").alias("fn"),
        (F.col("N") - F.col("fp")).cast("bigint").alias("tn"))
    return out.withColumns(prf(F.col("tp"), F.col("fp"), F.col("fn")))


def best_threshold(sweep: DataFrame, metric: str = "f1", groups: list[str] | None = None) -> DataFrame:
    """Threshold maximising ``metric`` (unknown -> f1); the first (smallest) wins ties."""
    metric = metric if metric in ("f1", "precision", "recall") else "f1"
    groups = list(groups or [])
    best = F.max_by(F.struct("threshold", F.col(metric).alias("score")),
                    F.struct(F.col(metric), -F.col("threshold")))
    return sweep.groupBy(*groups).agg(best.alias("b")).select(
        *groups, F.col("b.threshold").alias("threshold"), F.col("b.score").alias("score"),
        F.lit(metric).alias("metric"))


def roc_curve(df: DataFrame, groups: list[str] | None = None, y: str = "y", p: str = "p") -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, thresholds descending (all points
    kept: no collinear-point dropping)."""
    groups = list(groups or [])
    if not groups:
        return roc_curve(df.withColumn("_all", F.lit(0)), ["_all"], y, p).drop("_all")
    cum = running_totals(_counts_by_value(df, groups, y, p), p, ["pos", "neg"], groups,
                         descending=True)
    return cum.select(*groups, F.col(p).alias("threshold"),
                      F.try_divide(F.col("cum_neg").cast("double"), F.col("tot_neg")).alias("fpr"),
                      F.try_divide(F.col("cum_pos").cast("double"), F.col("tot_pos")).alias("tpr"))


def _bins_below(p: F.Column, edges: list[float]) -> F.Column:
    """Number of edges strictly below p (searchsorted, side='left')."""
    return F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e < p))


def calibration_curve(df: DataFrame, groups: list[str] | None = None, y: str = "y", p: str = "p",
                      n_bins: int = 10) -> DataFrame:
    """Uniform bins on [0, 1]; a p equal to an inner edge belongs to the left bin;
    empty bins are absent. Mean predicted p and fraction of positives per bin."""
    groups = list(groups or [])
    edges = [float(t) for t in np.linspace(0.0, 1.0, n_bins + 1)][1:-1]
    return (df.where(F.col(p).isNotNull())
            .groupBy(*groups, _bins_below(F.col(p), edges).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.avg(p).alias("mean_predicted"),
                 F.avg(F.col(y).cast("double")).alias("fraction_positive")))


def cost_curve(df: DataFrame, score: str = "risk_score", y: str = "y", fn_cost: float = 5.0,
               fp_cost: float = 1.0, groups: list[str] | None = None, max_score: int = 100) -> DataFrame:
    """Expected cost FN_cost * FN + FP_cost * FP of declining when score >= cutoff,
    for every cutoff 0..max_score (scores are integers, so one aggregate by score
    and a window over at most max_score+1 rows per group)."""
    groups = list(groups or [])
    b = (df.where(F.col(score).isNotNull()).groupBy(*groups, F.col(score).alias("cutoff"))
         .agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg")))
    dense = (b.select(*groups).distinct() if groups else df.sparkSession.range(1).select())
    dense = dense.select(*groups, F.explode(F.sequence(F.lit(0), F.lit(max_score))).alias("cutoff"))
    full = dense.join(b, [*groups, "cutoff"], "left").fillna(0, ["pos", "neg"])
    at_or_above = Window.partitionBy(*groups).orderBy(F.col("cutoff").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*groups)
    out = full.select(*groups, "cutoff",
                      F.sum("neg").over(at_or_above).alias("fp"),
                      (F.sum("pos").over(whole) - F.sum("pos").over(at_or_above)).alias("fn"))
    return out.select(*groups, "cutoff", F.col("fn").cast("bigint").alias("fn"),
                      F.col("fp").cast("bigint").alias("fp"),
                      (F.lit(fn_cost) * F.col("fn") + F.lit(fp_cost) * F.col("fp")).alias("cost"))


def best_cost_cutoff(curve: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """Cutoff of minimum cost; the smallest cutoff wins ties."""
    groups = list(groups or [])
    best = F.min_by(F.struct("cutoff", "cost", "fn", "fp"), F.struct("cost", "cutoff"))
    return curve.groupBy(*groups).agg(best.alias("b")).select(
        *groups, "b.cutoff", "b.cost", "b.fn", "b.fp")


def fairness_by_group(df: DataFrame, attributes: list[str], y: str = "y", p: str = "p",
                      threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Per (attribute, value): selection rate, TPR, FPR, precision, default rate.
    All attributes in ONE aggregate: each row is expanded to one (attribute, value)
    pair per attribute (as GROUPING SETS would), then grouped once."""
    yhat = (F.col(p) >= F.lit(threshold)).cast("int")
    long = df.select(F.col(y).alias("_y"), yhat.alias("_yhat"),
                     F.explode(F.array(*[F.struct(F.lit(a).alias("attribute"),
                                                  F.col(a).cast("string").alias("value"))
                                         for a in attributes])).alias("_g"))
    agg = long.groupBy(F.col("_g.attribute").alias("attribute"), F.col("_g.value").alias("value")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col("_yhat").cast("double")).alias("selection_rate"),
        F.avg(F.col("_y").cast("double")).alias("default_rate"),
        F.count_if((F.col("_y") == 1) & (F.col("_yhat") == 1)).alias("tp"),
        F.count_if((F.col("_y") != 1) & (F.col("_yhat") == 1)).alias("fp"),
        F.count_if((F.col("_y") == 1) & (F.col("_yhat") != 1)).alias("fn"),
        F.count_if((F.col("_y") != 1) & (F.col("_yhat") != 1)).alias("tn"))
    return agg.select("attribute", "value", "n", "selection_rate", "default_rate",
                      _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("tpr"),
                      _ratio(F.col("fp"), F.col("fp") + F.col("tn")).alias("fpr"),
                      _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"))


def fairness_gaps(by_group: DataFrame) -> DataFrame:
    """Demographic-parity difference (max - min selection rate) and equalised-odds
    difference (max of the TPR and FPR spreads) per attribute."""
    return by_group.groupBy("attribute").agg(
        (F.max("selection_rate") - F.min("selection_rate")).alias("demographic_parity_diff"),
        F.greatest(F.max("tpr") - F.min("tpr"), F.max("fpr") - F.min("fpr")).alias("equalized_odds_diff"))
