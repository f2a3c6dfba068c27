"""Model training, calibration and persistence on Spark ML.

Training runs on assembled, cached feature vectors; scoring of a trained logistic
model is turned back into plain column arithmetic (coefficients are bounded by the
number of features), so batch scoring stays inside whole-stage codegen.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field, fields

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscope.operators import isotonic
from ledgerscope.operators.boosting import Booster, BoosterParams, fit_booster
from ledgerscope.operators.prep import ScalerModel
from ledgerscope.operators.trees import TreeEnsemble
from ledgerscope.operators.treeshap import matrix
from ledgerscope.schema import TARGET

# ----------------------------------------------------------------------------------
# FIXED VALUES: default hyper-parameters of the original models
# ----------------------------------------------------------------------------------
LOGISTIC_DEFAULTS = {"C": 1.0, "max_iter": 1000}
BOOSTER_DEFAULTS = {"n_estimators": 300, "max_depth": 5, "learning_rate": 0.05, "subsample": 0.8,
                    "colsample_bytree": 0.8, "min_child_weight": 3, "reg_alpha": 0.1, "reg_lambda": 1.0}
FALLBACK_BOOSTER = {"n_estimators": 200, "max_depth": 4, "learning_rate": 0.08, "subsample": 0.8}
SEARCH_SPACE = {   # (low, high, log-scaled)
    "n_estimators": (100, 500, False), "max_depth": (3, 8, False),
    "learning_rate": (0.01, 0.2, True), "subsample": (0.6, 1.0, False),
    "colsample_bytree": (0.5, 1.0, False), "min_child_weight": (1, 10, False),
    "reg_alpha": (1e-4, 10.0, True), "reg_lambda": (1e-4, 10.0, True),
}
SEED = 42
# ----------------------------------------------------------------------------------


def class_weights(df: DataFrame, label: str = TARGET) -> DataFrame:
    """n_pos, n_neg, scale_pos_weight = n_neg / max(n_pos, 1), and the balanced
    per-class weights n / (2 n_class). One aggregate."""
    a = df.agg(F.count_if(F.col(label) == 1).alias("n_pos"), F.count_if(F.col(label) != 1).alias("n_neg"))
    n = F.col("n_pos") + F.col("n_neg")
    return a.select("n_pos", "n_neg",
                    (F.col("n_neg") / F.greatest(F.col("n_pos"), F.lit(1))).alias("scale_pos_weight"),
                    F.try_divide(n.cast("double"), 2 * F.col("n_pos")).alias("weight_pos"),
                    F.try_divide(n.cast("double"), 2 * F.col("n_neg")).alias("weight_neg"))


def with_weights(df: DataFrame, pos_weight: float, neg_weight: float = 1.0, label: str = TARGET,
                 out: str = "w") -> DataFrame:
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(pos_weight)).otherwise(F.lit(neg_weight)))


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="keep").transform(df)


# ------------------------------------------------------------------ M1 logistic
def train_logistic(train: DataFrame, features: list[str], label: str = TARGET,
                   params: dict | None = None):
    """L2 logistic regression with balanced class weights. sklearn's objective
    sum_i w_i loss_i + ||b||^2 / (2C) equals Spark's mean-weighted loss + regParam/2
    ||b||^2 with regParam = 1 / (C * sum w); balanced weights make sum w = n."""
    p = dict(LOGISTIC_DEFAULTS, **(params or {}))
    cw = class_weights(train, label).first()
    n = cw["n_pos"] + cw["n_neg"]
    df = with_weights(train, cw["weight_pos"] or 1.0, cw["weight_neg"] or 1.0, label)
    lr = LogisticRegression(featuresCol="features", labelCol=label, weightCol="w",
                            maxIter=int(p["max_iter"]), regParam=1.0 / (p["C"] * max(n, 1)),
                            elasticNetParam=0.0, standardization=False, tol=1e-6)
    return lr.fit(assemble(df, features))


# ------------------------------------------------------------------- M2/M3 trees
def train_booster(train: DataFrame, features: list[str], label: str = TARGET,
                  params: dict | None = None, stop=None) -> Booster:
    """Second-order boosted trees with the original preset; positive rows weighted by
    n_neg / n_pos."""
    known = {f.name for f in fields(BoosterParams)}
    p = {k: v for k, v in dict(BOOSTER_DEFAULTS, **(params or {})).items() if k in known}
    p |= {"n_estimators": int(p["n_estimators"]), "max_depth": int(p["max_depth"])}
    spw = class_weights(train, label).first()["scale_pos_weight"]
    return fit_booster(with_weights(train, float(spw), 1.0, label), features, label, "w", BoosterParams(**{"seed": SEED, **p}), stop)


def train_fallback_booster(train: DataFrame, features: list[str], label: str = TARGET, params: dict | None = None):
    """M3: Spark's own boosted trees with the fallback preset, positive rows weighted alike."""
    p = dict(FALLBACK_BOOSTER, **(params or {}))
    spw = class_weights(train, label).first()["scale_pos_weight"]
    df = with_weights(train, float(spw), 1.0, label)
    gbt = GBTClassifier(featuresCol="features", labelCol=label, weightCol="w",
                        maxIter=int(p["n_estimators"]), maxDepth=int(p["max_depth"]),
                        stepSize=float(p["learning_rate"]), subsamplingRate=float(p["subsample"]), seed=SEED)
    return gbt.fit(assemble(df, features))


def feature_importances(model, features: list[str]) -> DataFrame:
    """M6: importances as a (feature, importance) frame (bounded by #features)."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    if isinstance(model, Booster):
        imp = model.ensemble.importances(model.gains, len(features)).tolist()
    else:
        imp = model.featureImportances.toArray().tolist()
    return spark.createDataFrame([(f, float(v), i) for i, (f, v) in enumerate(zip(features, imp))],
                                 "feature string, importance double, pos int")


def tree_probability(model: TreeEnsemble, df: DataFrame, features: list[str], out: str = "p_raw") -> DataFrame:
    """df with the probability of a tree ensemble, one pass over Arrow batches."""
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.probability(matrix(batch, features)))], names=schema.names)
    return df.mapInArrow(run, schema)


def raw_probability(model, df: DataFrame, features: list[str], out: str = "p_raw") -> DataFrame:
    """Positive-class probability of a fitted Spark ML classifier."""
    scored = model.transform(assemble(df, features))
    return scored.withColumn(out, vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction")


def logistic_as_columns(model, features: list[str]):
    """A fitted logistic model as a codegen-friendly LinearScorer."""
    from ledgerscope.operators.attribution import LinearScorer
    coefs = model.coefficients.toArray().tolist()
    return LinearScorer(float(model.intercept), dict(zip(features, coefs)))


# ---------------------------------------------------------------- C1/C2 calibration
def fit_isotonic(val: DataFrame, p: str = "p_raw", label: str = TARGET) -> isotonic.IsotonicFit:
    """Isotonic regression of the label on the raw probability (ties pooled by mean,
    clamped outside the fitted range); see ``operators.isotonic``."""
    return isotonic.fit(val, p, label)


def apply_isotonic(model: isotonic.IsotonicFit, df: DataFrame, p: str = "p_raw", out: str = "p") -> DataFrame:
    return model.apply(df, p, out)


@dataclass
class SigmoidCalibrator:
    a: float
    b: float

    def apply(self, df: DataFrame, p: str = "p_raw", out: str = "p") -> DataFrame:
        return df.withColumn(out, F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(self.a) * F.col(p) + F.lit(self.b)))))


def fit_sigmoid(val: DataFrame, p: str = "p_raw", label: str = TARGET) -> SigmoidCalibrator:
    """Platt scaling with smoothed targets (n+ + 1)/(n+ + 2) and 1/(n- + 2): every
    example becomes two weighted rows (label 1 with weight t, label 0 with 1 - t)."""
    cnt = val.agg(F.count_if(F.col(label) == 1).alias("np"), F.count_if(F.col(label) != 1).alias("nn")).first()
    hi = (cnt["np"] + 1.0) / (cnt["np"] + 2.0)
    lo = 1.0 / (cnt["nn"] + 2.0)
    t = F.when(F.col(label) == 1, F.lit(hi)).otherwise(F.lit(lo))
    two = val.select(F.col(p), t.alias("t")).select(
        F.col(p), F.explode(F.array(F.struct(F.lit(1.0).alias("y"), F.col("t").alias("w")),
                                    F.struct(F.lit(0.0).alias("y"), (1 - F.col("t")).alias("w")))).alias("r"))
    rows = two.select(p, F.col("r.y").alias("y"), F.col("r.w").alias("w"))
    lr = LogisticRegression(featuresCol="features", labelCol="y", weightCol="w", regParam=0.0,
                            standardization=False, maxIter=200)
    m = lr.fit(assemble(rows, [p]))
    return SigmoidCalibrator(float(m.coefficients[0]), float(m.intercept))


def hard_prediction(df: DataFrame, p: str = "p", threshold: float = 0.5) -> DataFrame:
    return df.withColumn("prediction", (F.col(p) >= threshold).cast("int"))


# -------------------------------------------------------------- S11/S12 registry
@dataclass
class ModelBundle:
    """Everything batch scoring needs: feature order, scaler, model, calibrator."""
    features: list[str]
    scaler: ScalerModel
    model: object
    kind: str                         # "logistic" | "trees" | "booster" (Spark's own trees) | "linear" (fixed)
    isotonic: isotonic.IsotonicFit | None = None
    meta: dict = field(default_factory=dict)

    def aligned(self, df: DataFrame) -> DataFrame:
        """Model columns in order and scaled, all other columns kept."""
        from ledgerscope.operators.prep import align_features
        # absent columns are filled on the raw scale, before scaling
        keep = [c for c in df.columns if c not in self.features]
        return self.scaler.transform(align_features(df, self.features, keep=keep))

    def calibrated(self, df: DataFrame) -> DataFrame:
        """p from p_raw."""
        return self.isotonic.apply(df, "p_raw", "p") if self.isotonic is not None else df.withColumn("p", F.col("p_raw"))

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds p_raw and p (calibrated when a calibrator exists)."""
        aligned = self.aligned(df)
        if self.kind in ("logistic", "linear"):
            lin = self.model if self.kind == "linear" else logistic_as_columns(self.model, self.features)
            out = aligned.withColumn("p_raw", lin.probability())
        elif self.kind == "trees":
            out = tree_probability(self.model.ensemble, aligned, self.features)
        else:
            out = raw_probability(self.model, aligned, self.features)
        return self.calibrated(out)

    def save(self, path: str) -> None:
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
        meta = {"features": self.features, "kind": self.kind, "scaler": self.scaler.to_rows(),
                "scaler_columns": self.scaler.columns, "meta": self.meta,
                "has_calibrator": self.isotonic is not None}
        if self.kind == "trees":
            meta["gains"] = [g.tolist() for g in self.model.gains]
            spark.createDataFrame([(self.model.ensemble.to_json(),)], "model string").coalesce(1).write.mode(
                "overwrite").text(f"{path}/model")
        elif self.kind == "linear":
            meta["linear"] = [self.model.intercept, self.model.coefs]
        else:
            self.model.write().overwrite().save(f"{path}/model")
        if self.isotonic is not None:
            self.isotonic.save(f"{path}/isotonic")
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode(
            "overwrite").text(f"{path}/meta")


def load_bundle(path: str) -> ModelBundle:
    from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel
    from pyspark.sql import SparkSession

    from ledgerscope.operators.attribution import LinearScorer
    spark = SparkSession.getActiveSession()
    try:
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    except Exception as exc:  # noqa: BLE001
        raise FileNotFoundError(f"No model artefact at {path}; run the training job first.") from exc
    if meta["kind"] == "trees":
        model = Booster(TreeEnsemble.from_json(spark.read.text(f"{path}/model").first()[0]), [np.array(g) for g in meta["gains"]])
    elif meta["kind"] == "linear":
        model = LinearScorer(*meta["linear"])
    else:
        model = (LogisticRegressionModel if meta["kind"] == "logistic" else GBTClassificationModel).load(f"{path}/model")
    # a damaged calibrator is an error, never an uncalibrated model
    iso = isotonic.load(spark, f"{path}/isotonic") if meta["has_calibrator"] else None
    sc = ScalerModel(meta["scaler_columns"], {r[0]: r[1] for r in meta["scaler"]},
                     {r[0]: r[2] for r in meta["scaler"]})
    return ModelBundle(meta["features"], sc, model, meta["kind"], iso, meta.get("meta", {}))


def list_artifacts(root: str) -> list[str]:
    """Sorted artefact names under a registry folder of any file system that Spark reads."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory())
