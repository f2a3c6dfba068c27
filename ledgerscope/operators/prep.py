"""Cleaning, projection, standardisation and the stratified split."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerscope.schema import (EDUCATION_OTHER, EDUCATION_OTHER_CODES, ID_COL,
                                MARRIAGE_OTHER, MARRIAGE_OTHER_CODES, SCALE_COLS, TARGET)

# ----------------------------------------------------------------------------------
# FIXED VALUES of the split
# ----------------------------------------------------------------------------------
TEST_SIZE = 0.15
VAL_SIZE = 0.15
SPLIT_SEED = 42
# Lehmer (MINSTD) permutation of the row key: bijective on 1..2^31-2, identical in
# every SQL engine, no 64-bit overflow for any BIGINT key.
HASH_MOD = 2147483647
HASH_MUL = 48271
# ----------------------------------------------------------------------------------


def clean_raw(df: DataFrame, keep_id: bool = False) -> DataFrame:
    """Drop ID (unless kept as a key); EDUCATION 0,5,6 -> 4; MARRIAGE 0 -> 3.

    Each recode only runs when its column exists; no other value is touched.
    """
    out = df if keep_id else df.drop(ID_COL)
    recodes = {}
    if "EDUCATION" in out.columns:
        recodes["EDUCATION"] = (F.when(F.col("EDUCATION").isin(*EDUCATION_OTHER_CODES),
                                       F.lit(EDUCATION_OTHER)).otherwise(F.col("EDUCATION"))
                                .cast("int"))
    if "MARRIAGE" in out.columns:
        recodes["MARRIAGE"] = (F.when(F.col("MARRIAGE").isin(*MARRIAGE_OTHER_CODES),
                                      F.lit(MARRIAGE_OTHER)).otherwise(F.col("MARRIAGE"))
                               .cast("int"))
    return out.withColumns(recodes) if recodes else out


def align_features(df: DataFrame, model_columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """Add absent model columns as 0.0, drop extras, order as the model expects.
    ``keep`` columns (keys) are carried in front."""
    keep = [c for c in (keep or []) if c in df.columns]
    sel = [F.col(c) for c in keep]
    for c in model_columns:
        sel.append(F.col(c) if c in df.columns else F.lit(0.0).alias(c))
    return df.select(*sel)


# ---------------------------------------------------------------------------- scaler
@dataclass
class ScalerModel:
    """Population mean / std per column (std 0 -> 1), like a fitted standard scaler."""
    columns: list[str]
    means: dict[str, float] = field(default_factory=dict)
    stds: dict[str, float] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        present = [c for c in self.columns if c in df.columns]
        return df.withColumns({c: (F.col(c).cast("double") - F.lit(self.means[c]))
                               / F.lit(self.stds[c]) for c in present})

    def to_rows(self) -> list[tuple[str, float, float]]:
        return [(c, self.means[c], self.stds[c]) for c in self.columns]


def scaler_stats(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Long table (column_name, mean, std) in ONE aggregate pass over the data.

    ``stddev_pop`` (ddof 0) with NULLs skipped; a zero std becomes 1 so constant
    columns pass through centred. The aggregate is partial+final: each task sends
    one row of moments, whatever the data size.
    """
    cols = [c for c in (columns or SCALE_COLS) if c in df.columns]
    aggs = []
    for c in cols:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"m__{c}"),
                 F.stddev_pop(F.col(c).cast("double")).alias(f"s__{c}")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `m__{c}`, `s__{c}`" for c in cols)
    long = wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, mean, std)")
    return long.select("column_name", "mean",
                       F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std")).alias("std"))


def fit_scaler(df: DataFrame, columns: list[str] | None = None) -> ScalerModel:
    """Action: one aggregate; the result is bounded by the number of columns."""
    cols = [c for c in (columns or SCALE_COLS) if c in df.columns]
    rows = scaler_stats(df, cols).collect()
    m = ScalerModel(cols)
    for r in rows:
        m.means[r["column_name"]] = r["mean"]
        m.stds[r["column_name"]] = r["std"]
    return m


def apply_scaler(df: DataFrame, scaler: ScalerModel) -> DataFrame:
    return scaler.transform(df)


def preprocess(df: DataFrame, scaler: ScalerModel | None = None, fit: bool = False,
               keep_id: bool = True) -> tuple[DataFrame, ScalerModel | None]:
    """clean -> optional fit -> apply. The target stays a column (NULL-free y is not
    split off into an array); callers select features with ``model_features``."""
    out = clean_raw(df, keep_id=keep_id)
    feats = out.drop(TARGET) if TARGET in out.columns else out
    if fit:
        scaler = fit_scaler(feats.drop(ID_COL))
    if scaler is not None:
        out = scaler.transform(out)
    return out, scaler


# ----------------------------------------------------------------------------- split
def split_hash(id_col: str = ID_COL) -> F.Column:
    return ((F.col(id_col) % HASH_MOD) * HASH_MUL) % HASH_MOD


def _quota(n: F.Column, frac: float) -> F.Column:
    return F.ceil(n * F.lit(frac)).cast("bigint")


BUCKET_ROWS = 50_000      # rows of a boundary bucket that are ranked together


def stratified_split(df: DataFrame, test_size: float = TEST_SIZE, val_size: float = VAL_SIZE,
                     label: str = TARGET, id_col: str = ID_COL, buckets: int | None = None) -> DataFrame:
    """Add ``split`` in {train, val, test}, stratified by ``label``.

    Per class with n rows: test = ceil(test_size*n) rows, then val = ceil(val/(1-test) *
    (n - test)) of the rest, the remainder is train; rows are taken in the order of a
    fixed permutation of the key (then the key). Rows that repeat a key stay together.

    Two phases find the last key of test and of val in each class. First rows are counted
    per class and bucket of the permuted key (``BUCKET_ROWS`` rows each on average), and
    running counts tell in which bucket a quota ends. Then only the rows of those buckets,
    two a class, are ranked. All other rows are assigned by comparing their key with two
    keys a class, so the table itself is neither shuffled nor sorted.
    """
    val_rel = val_size / (1.0 - test_size)
    if buckets is None:
        buckets = max(1024, -(-df.count() // BUCKET_ROWS))
    keyed = df.withColumns({"_h": split_hash(id_col)})
    bucket = (F.col("_h") * buckets / F.lit(HASH_MOD)).cast("int")
    narrow = keyed.select(F.col(label).alias("_y"), "_h", F.col(id_col).alias("_k"), bucket.alias("_b"))
    counts = narrow.groupBy("_y", "_b").agg(F.count(F.lit(1)).alias("_nb"))
    upto, all_rows = Window.partitionBy("_y").orderBy("_b"), Window.partitionBy("_y")
    n = F.sum("_nb").over(all_rows)
    n_test = _quota(n, test_size)
    runs = counts.select("_y", "_b", (F.sum("_nb").over(upto) - F.col("_nb")).alias("_off"), "_nb", n_test.alias("test"),
                         (n_test + _quota(n - n_test, val_rel)).alias("val"))
    ends = runs.unpivot(["_y", "_b", "_off", "_nb"], ["test", "val"], "_part", "_quota").where(
        (F.col("_quota") > F.col("_off")) & (F.col("_quota") <= F.col("_off") + F.col("_nb")))
    # two rows a class
    ends = ends.select(F.col("_y").alias("_ey"), F.col("_b").alias("_eb"), "_part", (F.col("_quota") - F.col("_off")).alias("_nth"))
    near = narrow.join(F.broadcast(ends.select("_ey", "_eb").distinct()), F.col("_y").eqNullSafe(F.col("_ey")) & (F.col("_b") == F.col("_eb")), "left_semi")
    ranked = near.withColumn("_r", F.row_number().over(Window.partitionBy("_y", "_b").orderBy("_h", "_k")))
    last = ranked.join(F.broadcast(ends), F.col("_y").eqNullSafe(F.col("_ey")) & (F.col("_b") == F.col("_eb")) & (F.col("_r") == F.col("_nth")))
    key = F.struct("_h", "_k")
    cuts = last.groupBy("_ey").agg(F.max(F.when(F.col("_part") == "test", key)).alias("_test"),
                                   F.max(F.when(F.col("_part") == "val", key)).alias("_val"))
    # one row a class
    joined = keyed.join(F.broadcast(cuts), F.col(label).eqNullSafe(F.col("_ey")), "left")
    own = F.struct(F.col("_h"), F.col(id_col).alias("_k"))
    split = (F.when(own <= F.col("_test"), F.lit("test")).when(own <= F.col("_val"), F.lit("val")).otherwise(F.lit("train")))
    return joined.select(*df.columns, split.alias("split"))


def split_summary(df_with_split: DataFrame, label: str = TARGET) -> DataFrame:
    return (df_with_split.groupBy("split")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.round(F.avg(F.col(label).cast("double")), 6).alias("default_rate")))
