"""Tree ensembles as flat arrays: the common form that scoring and explaining work on.

A tree is five arrays over its nodes (root first): left and right child (-1 at a leaf),
feature, threshold, value, and cover (training weight). A row goes left where its value is at
most the threshold; a missing value (NaN) goes right. The margin of a row is ``base`` plus the
values of the leaves it reaches; its probability is the logistic function of the margin. The
arrays are as large as the model, whatever the data.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ledgerscope.session import checkpoint_dir

BLOCK_ROWS = 4_096        # rows that walk through all trees together


@dataclass
class Tree:
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each row of x reaches."""
        return self.reached(np.ascontiguousarray(x.T, dtype=float), np.arange(len(x)))

    def reached(self, xt: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The leaves of the rows of xt (features, rows), whose numbers are ``rows``."""
        inner = self.left >= 0
        own = np.arange(len(self.left))
        low, high = np.where(inner, self.left, own), np.where(inner, self.right, own)
        start = np.where(inner, self.feature, 0) * xt.shape[1]
        flat, at = xt.ravel(), np.zeros(xt.shape[1], np.intp)
        sides = np.stack([high, low], 1).ravel()
        # a row in a leaf stays there, whatever its values
        for _ in range(self.depth()):
            left = flat.take(start.take(at) + rows) <= self.threshold.take(at)
            at = sides.take(2 * at + left)
        return at

    def depth(self) -> int:
        level = np.zeros(len(self.left), np.int64)
        for n in range(len(self.left)):           # a parent stands before its children
            if self.left[n] >= 0:
                level[self.left[n]] = level[self.right[n]] = level[n] + 1
        return int(level.max())


@dataclass
class TreeEnsemble:
    trees: list[Tree] = field(default_factory=list)
    base: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for lo in range(0, len(x), BLOCK_ROWS):
            xt = np.ascontiguousarray(x[lo:lo + BLOCK_ROWS].T, dtype=float)
            part, rows = out[lo:lo + BLOCK_ROWS], np.arange(xt.shape[1])
            for t in self.trees:
                part += t.value.take(t.reached(xt, rows))
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margin(x)))

    def importances(self, gains: list[np.ndarray] | None, n_features: int) -> np.ndarray:
        """Share of each feature in the summed gains of its splits (0 for all without a split)."""
        total = np.zeros(n_features)
        for t, g in zip(self.trees, gains or [], strict=True):
            inner = t.left >= 0
            total += np.bincount(t.feature[inner], g[inner], n_features)
        return total / total.sum() if total.sum() > 0 else total

    def to_json(self) -> str:
        return json.dumps({"base": self.base, "trees": [{k: getattr(t, k).tolist() for k in ARRAYS} for t in self.trees]})

    @classmethod
    def from_json(cls, text: str) -> TreeEnsemble:
        d = json.loads(text)
        return cls([Tree(**{k: np.array(t[k], np.int64 if k in INTEGERS else float) for k in ARRAYS}) for t in d["trees"]], d["base"])


ARRAYS = ["left", "right", "feature", "threshold", "value", "cover"]
INTEGERS = ["left", "right", "feature"]


def from_spark(model) -> TreeEnsemble:
    """The trees of a Spark boosted or random-forest-like classifier, read from its saved form.

    Spark's boosted model has P(1) = 1 / (1 + exp(-2 sum_t w_t tree_t(x))), so leaf values are
    doubled to be on the log-odds scale. Cover is the weighted count of training rows.
    """
    spark = SparkSession.getActiveSession()
    path = f"{checkpoint_dir(spark).rstrip('/')}/trees-{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", F.col("nodeData.id").alias("id"), F.col("nodeData.prediction").alias("value"),
        F.col("nodeData.rawCount").alias("raw"), F.try_element_at("nodeData.impurityStats", F.lit(1)).alias("wcount"),
        F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.try_element_at("nodeData.split.leftCategoriesOrThreshold", F.lit(1)).alias("threshold")).toPandas()
    trees = []
    for tid, g in sorted(nodes.groupby("treeID"), key=lambda kv: kv[0]):
        g = g.sort_values("id")
        w = g["wcount"].fillna(0).to_numpy(float)
        trees.append(Tree(g["left"].to_numpy(np.int64), g["right"].to_numpy(np.int64), g["feature"].to_numpy(np.int64),
                          g["threshold"].fillna(0).to_numpy(float), 2.0 * model.treeWeights[int(tid)] * g["value"].to_numpy(float),
                          np.where(w > 0, w, g["raw"].to_numpy(float))))
    return TreeEnsemble(trees)
