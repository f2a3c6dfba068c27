"""Training job (entry A) and batch-scoring job (entry B, C10) as Spark plans.

Training: validate (abort on failure) -> clean + derive -> stratified split ->
scaler fit on train (one aggregate) -> balanced logistic -> boosted trees ->
isotonic calibration of the booster on validation -> test metrics of all three ->
comparison table -> importances -> report table. Every metric is an exact Spark
aggregate; the only driver-side values are model parameters and scaler moments
(bounded by the number of features).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerscope.operators import metrics as M
from ledgerscope.operators import models as MD
from ledgerscope.operators import prep, quality
from ledgerscope.operators.features import add_derived_features
from ledgerscope.operators.scoring import band_summary, batch_score, build_score_output
from ledgerscope.schema import MODEL_FEATURES, SCALE_COLS, TARGET
from ledgerscope.session import checkpoint_dir, stored


@dataclass
class TrainResult:
    logistic: MD.ModelBundle
    booster: MD.ModelBundle
    comparison: DataFrame
    metrics: DataFrame
    importances: DataFrame
    split: DataFrame              # the stored rows with their split


def _eval(bundle: MD.ModelBundle, df: DataFrame, name: str, calibrated: bool = True) -> DataFrame:
    pred = bundle.predict(df)
    col = "p" if calibrated else "p_raw"
    return pred.select(F.lit(name).alias("model"), F.col(TARGET).alias("y"), F.col(col).alias("p"))


def train(raw: DataFrame, booster_params: dict | None = None, validate: bool = True) -> TrainResult:
    if validate and not quality.validation_passed(raw.drop("ID", "AS_OF")):
        raise ValueError("Validation failed; training aborted:\n"
                         + quality.render_report(quality.validation_report(raw.drop("ID", "AS_OF"))))
    feats = add_derived_features(prep.clean_raw(raw, keep_id=True))
    split = stored(prep.stratified_split(feats), "split")
    train_df = split.where(F.col("split") == "train")
    val_df = split.where(F.col("split") == "val")
    test_df = split.where(F.col("split") == "test")
    scaler = prep.fit_scaler(train_df.select(*SCALE_COLS))
    features = list(MODEL_FEATURES)

    lr = MD.train_logistic(scaler.transform(train_df), features)
    lr_bundle = MD.ModelBundle(features, scaler, lr, "logistic")
    gbt = MD.train_booster(scaler.transform(train_df), features, params=booster_params)
    raw_bundle = MD.ModelBundle(features, scaler, gbt, "trees")
    val_raw = raw_bundle.predict(val_df).select("p_raw", TARGET)
    iso = MD.fit_isotonic(val_raw, "p_raw", TARGET)
    cal_bundle = MD.ModelBundle(features, scaler, gbt, "trees", iso)

    ev = (_eval(lr_bundle, test_df, "logistic")
          .unionByName(_eval(raw_bundle, test_df, "booster_raw", calibrated=False))
          .unionByName(_eval(cal_bundle, test_df, "booster_calibrated")))
    metrics = M.compute_metrics(stored(ev, "evaluation"), ["model"])
    return TrainResult(lr_bundle, cal_bundle, M.compare_models(metrics), metrics,
                       MD.feature_importances(gbt, features), split)


def batch_score_job(raw: DataFrame, bundle: MD.ModelBundle, output_path: str | None = None,
                    fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """Gate, score and write in one pass over the batch; then the band summary.

    The gate's sums are observed while the scored rows are written to a staging folder beside
    ``output_path``. With any error the staged rows are discarded, the last good output stays
    and the job raises; else the staged folder takes the output's place. Without a path the
    rows are staged in the shared folder and read from there.
    """
    absent = quality.batch_errors({}, raw.columns) if set(quality.REQUIRED_FIELDS) - set(raw.columns) else []
    if absent:
        raise ValueError(f"Batch failed quality checks: {absent}")
    spark = raw.sparkSession
    target = (output_path or f"{checkpoint_dir(spark).rstrip('/')}/scored-{uuid.uuid4().hex}").rstrip("/")
    staging, old = f"{target}-staging-{uuid.uuid4().hex}", f"{target}-replaced-{uuid.uuid4().hex}"
    seen = Observation("batch gate")
    scored = batch_score(raw.observe(seen, *quality.batch_measures(raw)), bundle.predict)
    scored.write.format(fmt).option("header", True).save(staging)
    bad = quality.batch_errors(seen.get, raw.columns)
    jvm = spark._jvm.org.apache.hadoop.fs
    to, new, gone = jvm.Path(target), jvm.Path(staging), jvm.Path(old)
    fs = to.getFileSystem(spark._jsc.hadoopConfiguration())
    if bad:
        fs.delete(new, True)
        raise ValueError(f"Batch failed quality checks: {bad}")
    if fs.exists(to) and not fs.rename(to, gone):
        raise OSError(f"cannot replace {target}")
    if not fs.rename(new, to):
        raise OSError(f"cannot publish {staging} as {target}")
    if fs.exists(gone):
        fs.delete(gone, True)
    out = spark.read.schema(scored.schema).format(fmt).option("header", True).load(target)
    return out, band_summary(out)


def score_with_bundle(df: DataFrame, bundle: MD.ModelBundle) -> DataFrame:
    feats = add_derived_features(prep.clean_raw(df, keep_id=True))
    return build_score_output(bundle.predict(feats), "p")
