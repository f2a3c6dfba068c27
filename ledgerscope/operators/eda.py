"""Exploratory summaries (N1-N8): describe, histograms, default rates, correlation.

All of them are aggregates over long (column, value) frames or grouping sets, so
every column is summarised in the same job. Quantiles are EXACT (linear
interpolation, as pandas does) yet scale: values are counted per distinct value,
ranked with range-pieced running totals, and the two neighbours of each target rank
are picked by one more aggregate -- no group ever has to hold its values in memory.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.operators.cumulative import running_totals

QUARTILES = (0.25, 0.5, 0.75)


def melt(df: DataFrame, columns: list[str]) -> DataFrame:
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot([], columns, "column_name", "value")


def exact_quantiles(long: DataFrame, qs=QUARTILES, group: str = "column_name") -> DataFrame:
    """Per group: q-quantiles with linear interpolation between order statistics."""
    vals = long.where(F.col("value").isNotNull())
    counts = vals.groupBy(group, "value").agg(F.count(F.lit(1)).alias("k"))
    cum = running_totals(counts, "value", ["k"], [group])
    j = cum.withColumnRenamed("tot_k", "n")
    aggs = []
    for i, q in enumerate(qs):
        h = (F.col("n") - 1) * F.lit(q)
        lo_rank = F.floor(h)
        # value at 0-based rank r = smallest value whose inclusive count exceeds r
        aggs += [F.min(F.when(F.col("cum_k") > lo_rank, F.col("value"))).alias(f"lo{i}"),
                 F.min(F.when(F.col("cum_k") > lo_rank + 1, F.col("value"))).alias(f"hi{i}"),
                 F.first(h - lo_rank).alias(f"fr{i}")]
    agg = j.groupBy(group).agg(*aggs)
    out = [F.col(group)]
    for i, q in enumerate(qs):
        hi = F.coalesce(F.col(f"hi{i}"), F.col(f"lo{i}"))
        out.append((F.col(f"lo{i}") + (hi - F.col(f"lo{i}")) * F.col(f"fr{i}")).alias(f"q{int(q * 100)}"))
    return agg.select(*out)


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std (sample), min, 25%, 50%, 75%, max per column, long form."""
    long = melt(df, columns)
    basic = long.groupBy("column_name").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    return basic.join(exact_quantiles(long), "column_name", "left").select(
        "column_name", "count", "mean", "std", "min",
        F.col("q25").alias("p25"), F.col("q50").alias("p50"), F.col("q75").alias("p75"), "max")


def histogram(long: DataFrame, bins: int, group: str = "column_name") -> DataFrame:
    """Equal-width bins over each group's own [min, max]; last bin closed; edges
    ``min + i * ((max - min) / bins)``. Rows: group, bin, lower edge, count."""
    v = long.where(F.col("value").isNotNull())
    mm = v.groupBy(group).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    step = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    edges = mm.select(group, "lo", "hi", *[(F.lit(float(i)) * step + F.col("lo")).alias(f"e{i}")
                                            for i in range(1, bins)])
    # one row per group (bounded by the number of columns / bands) -> broadcast
    binned = v.join(F.broadcast(edges), group).select(
        group, "lo", "hi",
        reduce(lambda a, b: a + b, [F.when(F.col("value") >= F.col(f"e{i}"), 1).otherwise(0)
                                    for i in range(1, bins)]).alias("bin"))
    return binned.groupBy(group, "bin").agg(F.count(F.lit(1)).alias("n"),
                                            F.first("lo").alias("_lo"), F.first("hi").alias("_hi")).select(
        group, "bin", (F.col("bin") * ((F.col("_hi") - F.col("_lo")) / F.lit(float(bins))) + F.col("_lo"))
        .alias("bin_start"), "n")


def default_rate_by(df: DataFrame, attributes: list[str], target: str) -> DataFrame:
    """Default rate per value of each attribute in one pass (rows expanded once per
    attribute, as GROUPING SETS would)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).cast("int").alias("value"))
                                for a in attributes]))
    long = df.select(F.col(target).alias("_y"), pairs.alias("_g"))
    return long.groupBy(F.col("_g.attribute").alias("attribute"), F.col("_g.value").alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("_y").cast("double")).alias("default_rate"))


def correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair, one aggregate, long form (a, b, corr)."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}")
                   for i, (a, b) in enumerate(pairs)])
    rows = [f"'{a}', '{b}', c{i}, '{b}', '{a}', c{i}" for i, (a, b) in enumerate(pairs)]
    stack = ", ".join(rows + [f"'{c}', '{c}', CAST(1.0 AS DOUBLE)" for c in columns])
    return one.selectExpr(f"stack({2 * len(pairs) + len(columns)}, {stack}) AS (col_a, col_b, corr)")
