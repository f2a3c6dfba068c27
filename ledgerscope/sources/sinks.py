"""Writers (S7-S10): scored output, reference baseline, metrics table, reports.

All are DataFrame writers to shared storage; nothing is collected. The metrics
"file per name" of the original becomes an append-only table keyed by run and name.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_scored(scored: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Scored rows (original columns + 3 score columns)."""
    w = scored.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)


def write_reference_baseline(unscaled_train: DataFrame, path: str) -> None:
    """The unscaled training features, kept as the drift reference."""
    unscaled_train.write.mode("overwrite").parquet(path)


def append_metrics(metrics: DataFrame, path: str, name: str, run_id: str | None = None) -> None:
    """Append one metrics frame under (run_id, name)."""
    run_id = run_id or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S")
    (metrics.withColumn("run_id", F.lit(run_id)).withColumn("name", F.lit(name))
     .write.mode("append").partitionBy("name").parquet(path))


def read_metrics(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The latest run's metrics for ``name`` (partition pruning on name)."""
    df = spark.read.parquet(path).where(F.col("name") == name)
    latest = df.agg(F.max("run_id").alias("run_id"))
    return df.join(latest, "run_id", "left_semi")


def write_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Importance / drift / comparison tables."""
    w = df.repartition(1).write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)
