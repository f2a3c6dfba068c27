"""Isotonic calibration by pooling adjacent violators, piece by piece.

Rows are first added up per distinct score. Scores are cut into range pieces; each piece is
reduced to its stack of pooled blocks (score range, weight, weighted label sum). The order in
which violators are pooled does not change the result, so stacks merge: neighbouring blocks
are dealt into chunks of ``CHUNK`` blocks, each chunk is pooled again, and the borders of the
chunks move by half a chunk every round. When neither of two rounds in a row pooled anything,
no neighbours violate the order, and the blocks are the isotonic fit. Every round works on
the blocks that are left, at most ``CHUNK`` of them in a task; nothing is collected.

The fitted function is linear between the points (first and last score of each block, mean),
constant beyond them, and 0 to 1. It is applied by an equi-join on cells of a regular grid,
so the points are broadcast only if Spark measures them as small.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerscope.schema import TARGET
from ledgerscope.session import checkpoint_dir

CHUNK = 50_000
PIECES = 1_000            # most range pieces of the first round
CELLS = 1_024             # cells of the grid in which points are looked up
_SCHEMA = "lo double, hi double, w double, s double"


def pooled(lo: np.ndarray, hi: np.ndarray, w: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, ...]:
    """The stack of blocks after pooling adjacent violators (means must rise strictly)."""
    out: list[list[float]] = []
    for a, b, x, y in zip(lo.tolist(), hi.tolist(), w.tolist(), s.tolist(), strict=True):
        while out and out[-1][3] * x >= y * out[-1][2]:
            a, x, y = out[-1][0], out[-1][2] + x, out[-1][3] + y
            out.pop()
        out.append([a, b, x, y])
    return tuple(np.array(c) for c in zip(*out, strict=True)) if out else (np.zeros(0),) * 4


def _pool(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("lo")
    return pd.DataFrame(dict(zip(["lo", "hi", "w", "s"], pooled(*(pdf[c].to_numpy(float) for c in ["lo", "hi", "w", "s"])), strict=True)))


class _Store:
    def __init__(self, spark):
        self.spark, self.root, self.n = spark, f"{checkpoint_dir(spark).rstrip('/')}/isotonic-{uuid.uuid4().hex}", 0

    def save(self, df: DataFrame) -> DataFrame:
        self.n += 1
        df.write.parquet(f"{self.root}/{self.n}")
        return self.spark.read.parquet(f"{self.root}/{self.n}")


def _numbered(blocks: DataFrame, piece: str) -> DataFrame:
    """Blocks with their place ``at`` in order of score; pieces stand in order."""
    count = blocks.groupBy(piece).agg(F.count(F.lit(1)).alias("_n"))
    # a row a piece: at most PIECES, then one for CHUNK / 2 blocks
    count = count.select(piece, F.coalesce(F.sum("_n").over(Window.orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)),
                                           F.lit(0)).alias("_before"))
    inside = Window.partitionBy(piece).orderBy("lo")
    return blocks.withColumn("_i", F.row_number().over(inside) - 1).join(count, piece).select(
        "lo", "hi", "w", "s", (F.col("_before") + F.col("_i")).alias("at"))


def fit_blocks(df: DataFrame, x: str = "p_raw", y: str = TARGET, weight: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """The blocks of the isotonic regression of y on x: lo, hi, w, s, at (place in order).
    Rows without x or y teach nothing."""
    store = _Store(df.sparkSession)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(x).cast("double").alias("lo"), w.alias("w"),
                                                                        (w * F.col(y)).alias("s"))
    sums = store.save(rows.groupBy("lo").agg(F.sum("w").alias("w"), F.sum("s").alias("s")).where("w > 0")
                      .select("lo", F.col("lo").alias("hi"), "w", "s"))
    n = sums.count()
    pieces = min(PIECES, max(1, -(-2 * n // chunk)))
    cuts = sorted(set(sums.select(F.percentile_approx("lo", [i / pieces for i in range(1, pieces)], 20 * pieces)).first()[0])) \
        if pieces > 1 and n else []
    # the cuts are numbers from here on: every job finds the same pieces
    cut = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="lo", outputCol="piece").transform(sums) \
        if cuts else sums.withColumn("piece", F.lit(0.0))
    blocks = cut.groupBy("piece").applyInPandas(
        lambda pdf: _pool(pdf).assign(piece=pdf["piece"].iloc[0]), _SCHEMA + ", piece double")
    blocks = store.save(blocks)
    blocks = store.save(_numbered(blocks, "piece"))
    left, quiet, turn = blocks.count(), 0, 0
    while quiet < 2 and (left > chunk or len(cuts) and turn == 0):
        shift = (turn % 2) * (chunk // 2)
        dealt = blocks.withColumn("piece", F.floor((F.col("at") + shift) / chunk).cast("long"))
        merged = dealt.groupBy("piece").applyInPandas(
            lambda pdf: _pool(pdf).assign(piece=pdf["piece"].iloc[0]), _SCHEMA + ", piece long")
        blocks = store.save(_numbered(store.save(merged), "piece"))
        now = blocks.count()
        quiet, left, turn = (quiet + 1 if now == left else 0), now, turn + 1
        if left <= chunk and not shift:
            break                                     # all blocks stood in one chunk
    if quiet < 2 and left <= chunk and turn:
        blocks = store.save(_numbered(store.save(blocks.withColumn("piece", F.lit(0)).groupBy("piece").applyInPandas(
            lambda pdf: _pool(pdf).assign(piece=0), _SCHEMA + ", piece long")), "piece"))
    return blocks


@dataclass
class IsotonicFit:
    """Segments of the fitted function: x0 <= x <= x1, values y0 to y1."""
    segments: DataFrame
    least: float
    most: float

    def apply(self, df: DataFrame, p: str = "p_raw", out: str = "p") -> DataFrame:
        """df with the calibrated probability; missing in, missing out."""
        span = self.most - self.least

        def cell(v: F.Column) -> F.Column:
            return F.floor((v - self.least) / span * CELLS).cast("int") if span > 0 else F.lit(0)
        seg = self.segments.select("x0", "x1", "y0", "y1", "last", F.explode(F.sequence(cell(F.col("x0")), cell(F.col("x1")))).alias("_cell"))
        v = F.least(F.lit(self.most), F.greatest(F.lit(self.least), F.col("_v")))
        rows = df.withColumn("_v", F.col(p).cast("double")).withColumn("_v", F.when(F.col("_v").isNotNull(), v)).withColumn("_at", cell(F.col("_v")))
        # the segment that holds the value: its left end belongs to it, the right end to the next
        hit = (F.col("_at") == F.col("_cell")) & (F.col("_v") >= F.col("x0")) & ((F.col("_v") < F.col("x1")) | F.col("last"))
        y = F.when(F.col("x1") > F.col("x0"), F.col("y0") + (F.col("y1") - F.col("y0")) * (F.col("_v") - F.col("x0")) / (F.col("x1") - F.col("x0"))) \
            .otherwise(F.col("y0"))
        got = rows.join(seg, hit, "left")
        # greatest and least skip NULL: a missing score stays missing
        return got.select(*df.columns, F.when(y.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), y))).alias(out))

    def save(self, path: str) -> None:
        self.segments.write.mode("overwrite").parquet(path)


def segments(blocks: DataFrame) -> DataFrame:
    """Points (first and last score of each block, mean) as neighbouring pairs, without a window
    over all: a block's flat part, and the slope from it to the block that follows."""
    b = blocks.select("at", "lo", "hi", (F.col("s") / F.col("w")).alias("m"))
    nxt = b.select((F.col("at") - 1).alias("at"), F.col("lo").alias("x1"), F.col("m").alias("y1"))
    joined = b.join(nxt, "at", "left")
    flat = joined.where("hi > lo or x1 is null").select(F.col("lo").alias("x0"), F.col("hi").alias("x1"), F.col("m").alias("y0"),
                                                       F.col("m").alias("y1"), F.col("x1").isNull().alias("last"))
    slope = joined.where("x1 is not null").select(F.col("hi").alias("x0"), "x1", F.col("m").alias("y0"), "y1", F.lit(False).alias("last"))
    return flat.unionByName(slope)


def fit(df: DataFrame, x: str = "p_raw", y: str = TARGET, weight: str | None = None, chunk: int = CHUNK) -> IsotonicFit:
    store = _Store(df.sparkSession)
    seg = store.save(segments(fit_blocks(df, x, y, weight, chunk)))
    return _opened(seg)


def _opened(seg: DataFrame) -> IsotonicFit:
    lo, hi = seg.agg(F.min("x0"), F.max("x1")).first()
    if lo is None:
        raise ValueError("no labelled scores to calibrate on")
    return IsotonicFit(seg, lo, hi)


def load(spark, path: str) -> IsotonicFit:
    return _opened(spark.read.parquet(path))
