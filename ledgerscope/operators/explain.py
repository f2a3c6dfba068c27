"""Score with drivers for any model bundle.

``explainer`` looks through the bundle and its calibrator at the model itself: models with
coefficients are explained in closed form against an all-zero background (column
expressions, no Python); tree ensembles, our own or Spark's, by TreeSHAP on the uncalibrated
margin; for other models there is no explainer, and scoring goes on with an empty list of
drivers. For trees one pass over Arrow batches yields margin and drivers together, and the
score follows from that margin, so no row is walked through the trees twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscope.operators.attribution import LinearScorer, linear_attributions, top_drivers
from ledgerscope.operators.models import ModelBundle, logistic_as_columns
from ledgerscope.operators.scoring import build_score_output, featurize
from ledgerscope.operators.trees import TreeEnsemble
from ledgerscope.operators.treeshap import Explainer, ensemble, matrix
from ledgerscope.schema import TOP_DRIVERS

DRIVER = "array<struct<feature:string,shap_value:double,feature_value:double,direction:string>>"


def explainer(bundle: ModelBundle) -> LinearScorer | Explainer | None:
    """The explainer that fits the bundle's model; None if there is none."""
    model = getattr(bundle.model, "ensemble", bundle.model)
    if isinstance(model, LinearScorer):
        return model
    if hasattr(model, "coefficients"):
        return logistic_as_columns(model, bundle.features)
    if isinstance(model, TreeEnsemble) or hasattr(model, "treeWeights"):
        return Explainer(ensemble(model), len(bundle.features))
    return None


def _tree_pass(df: DataFrame, exp: Explainer, features: list[str], n: int) -> DataFrame:
    """df without the features, with p_raw and drivers (unrounded), largest attribution first, ties in
    feature order. Python gets each feature once, as a number, and does not send it back."""
    kept = [f for f in df.schema.fields if f.name not in features]
    schema = T.StructType([*kept, T.StructField("p_raw", T.DoubleType()),
                           T.StructField("drivers", T._parse_datatype_string(DRIVER))])
    held, n = df.sparkSession.sparkContext.broadcast(exp), min(n, len(features))
    wide = [F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, directions = pa.array(features, pa.string()), pa.array(["decreases_risk", "increases_risk"])
        for batch in batches:
            x = matrix(batch, [f"_x{i}" for i in range(len(features))])
            phi, margin = held.value.explain(x)
            first = np.argsort(-np.abs(phi), axis=1, kind="stable")[:, :n]
            rows = np.arange(len(x))[:, None]
            value, of = phi[rows, first].ravel(), x[rows, first].ravel()
            item = pa.StructArray.from_arrays(
                [names.take(pa.array(first.ravel())), pa.array(value), pa.array(of, mask=np.isnan(of)),
                 directions.take(pa.array((value > 0).astype(np.int64)))], names=["feature", "shap_value", "feature_value", "direction"])
            drivers = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * n, pa.int32()), item)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(schema) - 2], pa.array(1.0 / (1.0 + np.exp(-margin))), drivers],
                                             names=schema.names)
    return df.select(*[f.name for f in kept], *wide).mapInArrow(run, schema)


def score_with_drivers(df_raw: DataFrame, bundle: ModelBundle, n: int = TOP_DRIVERS, prefix: str = "__raw_") -> DataFrame:
    """Every input row with its original columns, default_probability, risk_score, risk_band
    and ``top_drivers``: the ``n`` largest attributions (feature, shap_value, feature_value as
    the model sees it, direction), values rounded to 4. Missing attributions are left out."""
    raw = df_raw.columns
    carried = df_raw.select(*[F.col(c) for c in raw], *[F.col(c).alias(prefix + c) for c in raw])
    exp, feats = explainer(bundle), featurize(carried)
    if isinstance(exp, Explainer):
        out = bundle.calibrated(_tree_pass(bundle.aligned(feats), exp, bundle.features, n))
        rounded = F.transform("drivers", lambda d: F.struct(
            d["feature"].alias("feature"), F.round(d["shap_value"], 4).alias("shap_value"),
            F.round(d["feature_value"], 4).alias("feature_value"), d["direction"].alias("direction")))
        out = out.withColumn("top_drivers", rounded)
    else:
        out = bundle.predict(feats)
        if exp is None:
            out = out.withColumn("top_drivers", F.array().cast(DRIVER))
        else:
            out = linear_attributions(out, exp, bundle.features)
            out = top_drivers(out, n=n)
    out = build_score_output(out, "p")
    return out.select(*[F.col(prefix + c).alias(c) for c in raw], "default_probability", "risk_score", "risk_band", "top_drivers")
