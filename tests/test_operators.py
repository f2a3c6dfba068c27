"""Skew-safe building blocks against brute force."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerscope.operators.cumulative import running_totals
from ledgerscope.operators.sequence import hot_keys, lag_within_group


def test_lag_within_group_hot_key_matches_window(spark):
    # key 0 holds ~half the rows, so it spans many pieces
    rng = np.random.default_rng(1)
    n = 3000
    keys = np.where(rng.random(n) < 0.5, 0, rng.integers(1, 40, n))
    pdf = pd.DataFrame({"k": keys.astype("int64"), "t": rng.permutation(n).astype("int64"),
                        "v": rng.normal(size=n), "s": rng.integers(-1, 5, n).astype("int32")})
    df = spark.createDataFrame(pdf)
    got = lag_within_group(df, "k", ["t"], ["v", "s"], 5, min_rows=50)
    w = Window.partitionBy("k").orderBy("t")
    exp = df.select("k", "t", *[F.lag(c, j).over(w).alias(f"{c}_lag{j}")
                                for j in range(1, 6) for c in ["v", "s"]])
    a = got.select(exp.columns).toPandas().sort_values(["k", "t"]).reset_index(drop=True)
    b = exp.toPandas().sort_values(["k", "t"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


@pytest.mark.parametrize("kind", ["long", "double", "date", "timestamp"])
def test_cuts_do_not_depend_on_the_deal_of_rows(spark, kind):
    rng = np.random.default_rng(5)
    t = rng.integers(0, 40_000, 20_000)
    at = {"long": F.col("t"), "double": F.col("t") / 7 - 2000, "date": F.date_from_unix_date(F.col("t").cast("int")),
          "timestamp": F.timestamp_seconds(F.col("t") * 3601)}[kind]
    df = spark.createDataFrame(pd.DataFrame({"k": rng.integers(0, 3, len(t)), "t": t})).select("k", at.alias("o"))
    deals = [df.repartition(1), df.repartition(7, "o"), df.orderBy(F.xxhash64("o")).repartition(3)]
    cuts = [sorted(tuple(map(str, r)) for r in hot_keys(d, "k", "o", 500).collect()) for d in deals]
    assert len(cuts[0]) == 3 and cuts[0] == cuts[1] == cuts[2]
    with_id = df.withColumn("id", F.monotonically_increasing_id()).withColumn("v", F.col("id") * 2)
    got = lag_within_group(with_id, "k", ["o", "id"], ["v"], 3, min_rows=500)
    w = Window.partitionBy("k").orderBy("o", "id")
    exp = with_id.select("k", "o", "id", "v", *[F.lag("v", j).over(w).alias(f"v_lag{j}") for j in range(1, 4)])
    assert got.exceptAll(exp).count() == 0 and got.count() == len(t)


def test_lag_ties_null_keys_and_no_jobs_before_the_action(spark):
    # a hot NULL key, ties and NULLs in the first order column, a piece of fewer than k rows
    rows = [(None if i % 3 else i % 7, None if i % 50 == 0 else i // 100, i, float(i)) for i in range(1200)]
    df = spark.createDataFrame(rows, "k int, d int, t int, v double")
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    got = lag_within_group(df, "k", ["d", "t"], ["v"], 5, min_rows=20)
    assert len(tracker.getJobIdsForGroup(None)) == before
    w = Window.partitionBy("k").orderBy("d", "t")
    exp = df.select("k", "d", "t", "v", *[F.lag("v", j).over(w).alias(f"v_lag{j}") for j in range(1, 6)])
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
    assert lag_within_group(df.limit(0), "k", ["d", "t"], ["v"], 5).count() == 0


def test_running_totals_matches_cumsum(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 500, p=[0.9, 0.1]),
                        "v": rng.permutation(500).astype(float), "c": rng.integers(0, 5, 500)})
    df = spark.createDataFrame(pdf)
    for desc in (False, True):
        got = running_totals(df, "v", ["c"], ["g"], descending=desc, num_pieces=7).toPandas()
        exp = pdf.sort_values(["g", "v"], ascending=[True, not desc])
        exp["cum_c"] = exp.groupby("g")["c"].cumsum()
        m = got.merge(exp, on=["g", "v"])
        assert len(m) == 500
        assert (m["cum_c_x"] == m["cum_c_y"]).all()
