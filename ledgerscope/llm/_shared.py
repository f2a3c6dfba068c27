"""Shared-folder tables and connected components (helpers of the operators)."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.session import checkpoint_dir


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package (once per application), as ``--py-files`` would."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerscope-py-"), "ledgerscope.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables written to the cluster's shared checkpoint folder: they cut lineage and
    survive lost executors. The shuffle files of the job that writes one go with the job.
    ``drop`` removes tables that no later plan reads."""

    def __init__(self, spark: SparkSession):
        ship(spark)
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
        self.n = 0

    def save(self, df: DataFrame, codec: str | None = None) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        before = self.spark.conf.get(CLEANUP, None)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.parquet(path, compression=codec)
        finally:
            if before is None:
                self.spark.conf.unset(CLEANUP)
            else:
                self.spark.conf.set(CLEANUP, before)
        out = self.spark.read.parquet(path)
        out.scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        jvm = self.spark._jvm
        for df in frames:
            path = jvm.org.apache.hadoop.fs.Path(df.scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def components(links: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that links reach, for every node in a link.

    Alternating large-star and small-star steps over an edge table; each keeps edges no
    more than they were, and hot nodes only aggregate a minimum (combined map-side).
    """
    edges = scratch.save(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                         .filter("u <> v").distinct())
    first, old, before = edges, None, None
    while True:
        # large star: larger neighbours of u go to the least of u and its neighbours
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        # small star: smaller neighbours of u, and u, go to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        new = scratch.save(small)
        got = new.agg(F.count("*"), F.coalesce(F.sum(F.col("u").cast("decimal(20,0)") * 3
                                                     + F.col("v").cast("decimal(20,0)")), F.lit(0))).first()
        state = (got[0], got[1])
        if old is not None:
            scratch.drop(old)
        old, edges = (edges if edges is not first else None), new
        if state == before:
            break
        before = state
    if old is not None:
        scratch.drop(old)
    nodes = first.select(F.col("u").alias("node")).union(first.select(F.col("v").alias("node"))).distinct()
    roots = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
