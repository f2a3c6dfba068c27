"""Session construction and shared-storage helpers."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC so dates agree with SQL engines, ANSI on so
# overflow and bad casts fail loudly, AQE on so partition counts and skewed joins
# are re-planned from real shuffle sizes.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # wide feature projections under filters make constraint inference explode
    "spark.sql.constraintPropagation.enabled": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "ledgerscope", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, spark-submit supplies master and sizes."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("LEDGERSCOPE_DRIVER_MEMORY", "8g"))
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder (HDFS/S3/ABFS) there; we only invent one when
    nothing is configured, which happens in local tests.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="ledgerscope-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared folder and read back: later plans scan it with pruned
    columns, its lineage is cut, and it survives lost executors."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def state_of(spark: SparkSession, paths: list[str]) -> str:
    """Digest of names, lengths and times of the files at ``paths``: other data, other digest."""
    jvm, conf, seen = spark._jvm, spark._jsc.hadoopConfiguration(), []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        todo = [path]
        while todo:
            for s in fs.listStatus(todo.pop()):
                if s.isDirectory():
                    todo.append(s.getPath())
                else:
                    seen.append(f"{s.getPath()} {s.getLen()} {s.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()
