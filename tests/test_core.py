"""Cleaning, features, scores and bands (intent of the original unit tests)."""
import math

import pytest
from pyspark.sql import functions as F

from ledgerscope.functions.scoring import probability_to_score, score_to_band
from ledgerscope.operators import prep
from ledgerscope.operators.features import add_derived_features
from ledgerscope.operators.scoring import batch_score, build_score_output, demo_predictor
from ledgerscope.schema import DERIVED_COLS, raw_schema
from ledgerscope.sources.tables import nan_to_null, remap_columns, rename_target

from conftest import SAMPLE_RECORD


def test_education_and_marriage_recodes(spark):
    df = spark.createDataFrame([(0, 0), (5, 1), (6, 2), (1, 3), (2, 3)], "EDUCATION int, MARRIAGE int")
    out = prep.clean_raw(df).collect()
    assert [r.EDUCATION for r in out] == [4, 4, 4, 1, 2]
    assert [r.MARRIAGE for r in out] == [3, 1, 2, 3, 3]


def test_clean_without_columns_is_noop(spark):
    df = spark.createDataFrame([(1, 2.0)], "ID long, LIMIT_BAL double")
    assert prep.clean_raw(df).columns == ["LIMIT_BAL"]


def test_derived_feature_ranges_and_no_missing(raw_df):
    f = add_derived_features(prep.clean_raw(raw_df)).toPandas()
    for c in ["util_ratio_1", "util_ratio_avg", "pay_ratio_1", "pay_ratio_avg"]:
        assert f[c].between(-5, 10).all()
    assert f["max_delinquency"].between(-2, 9).all()
    assert f["delinquency_count"].between(0, 6).all()
    assert not f[DERIVED_COLS].isna().any().any()


def test_derived_values_for_sample_record(spark):
    df = spark.createDataFrame([SAMPLE_RECORD], raw_schema(False, False))
    r = add_derived_features(df).first()
    assert r.util_ratio_1 == pytest.approx(20000 / (80000 + 1e-6))
    assert r.pay_ratio_1 == pytest.approx(3000 / 20001)
    bills = [20000, 18000, 16000, 14000, 12000, 10000]
    slope = sum(b * (i + 1 - 3.5) for i, b in enumerate(bills)) / 17.5
    assert r.bill_trend == pytest.approx(slope)        # positive: balance was higher in the past
    assert r.bill_trend < 0 or bills[0] > bills[-1]


def test_missing_month_rules(spark):
    rec = dict(SAMPLE_RECORD, BILL_AMT6=float("nan"), PAY_6=None)
    df = nan_to_null(spark.createDataFrame([rec], raw_schema(False, False)))
    r = add_derived_features(df).first()
    assert r.util_ratio_avg == 0.0 and r.pay_ratio_avg == 0.0    # NaN mean -> 0
    assert r.max_delinquency is None and r.bill_trend is None
    assert r.delinquency_count == 0


def test_inf_ratio_becomes_zero(spark):
    rec = dict(SAMPLE_RECORD, LIMIT_BAL=-1e-6)
    r = add_derived_features(spark.createDataFrame([rec], raw_schema(False, False))).first()
    assert r.util_ratio_1 == 0.0


def test_score_table_and_bands(spark):
    df = spark.createDataFrame([(0.0,), (0.25,), (0.5,), (1.0,), (0.305,), (0.315,), (0.42,)], "p double")
    rows = df.select(probability_to_score(F.col("p")).alias("s")).collect()
    assert [r.s for r in rows] == [0, 25, 50, 100, 30, 32, 42]    # half to even
    sc = spark.createDataFrame([(s,) for s in [0, 15, 30, 31, 45, 60, 61, 85, 100]], "s int")
    bands = [r.b for r in sc.select(score_to_band(F.col("s")).alias("b")).collect()]
    assert bands == ["Low"] * 3 + ["Medium"] * 3 + ["High"] * 3


def test_score_sweep_monotone(spark):
    df = spark.range(101).select((F.col("id") / 100.0).alias("p"))
    s = [r.risk_score for r in build_score_output(df).orderBy("p").collect()]
    assert s == sorted(s) and s[0] == 0 and s[-1] == 100


def test_batch_score_keeps_rows_and_raw_columns(raw_df):
    out = batch_score(raw_df, demo_predictor)
    assert out.count() == raw_df.count()
    assert out.columns[: len(raw_df.columns)] == raw_df.columns
    raw_edu = {r.ID: r.EDUCATION for r in raw_df.collect()}
    assert all(raw_edu[r.ID] == r.EDUCATION for r in out.collect())
    assert out.where((F.col("risk_score") < 0) | (F.col("risk_score") > 100)).count() == 0


def test_late_payer_scores_higher(spark):
    late = dict(SAMPLE_RECORD, PAY_0=3, PAY_2=3, PAY_3=3)
    df = spark.createDataFrame([dict(SAMPLE_RECORD, ID=1), dict(late, ID=2)], raw_schema(True, False))
    s = {r.ID: r.risk_score for r in batch_score(df, demo_predictor).collect()}
    assert s[2] >= s[1]


def test_generic_header_and_dotted_target(spark):
    df = spark.createDataFrame([(1.0, 2, 0)], "X1 double, X2 int, Y int")
    assert remap_columns(df).columns == ["LIMIT_BAL", "SEX", "default_payment_next_month"]
    d = spark.createDataFrame([(1,)], "`default.payment.next.month` int")
    assert rename_target(d).columns == ["default_payment_next_month"]


def test_align_features(spark):
    df = spark.createDataFrame([(1.0, 2.0, 9.0)], "a double, b double, extra double")
    out = prep.align_features(df, ["b", "a", "missing"])
    assert out.columns == ["b", "a", "missing"] and out.first().missing == 0.0


def test_scaler_population_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "LIMIT_BAL double, AGE double")
    m = prep.fit_scaler(df)
    assert m.means["LIMIT_BAL"] == 2.0 and m.stds["LIMIT_BAL"] == 1.0    # ddof = 0
    assert m.stds["AGE"] == 1.0                                          # zero std -> 1
    r = m.transform(df).collect()
    assert [x.LIMIT_BAL for x in r] == [-1.0, 1.0] and [x.AGE for x in r] == [0.0, 0.0]


def test_stratified_split_properties(raw_df):
    s = prep.stratified_split(raw_df).toPandas()
    sizes = s["split"].value_counts()
    assert sizes.sum() == 200 and 25 <= sizes["test"] <= 50 and 25 <= sizes["val"] <= 50
    assert s["ID"].is_unique
    for part in ["train", "val", "test"]:
        assert s.loc[s.split == part, "default_payment_next_month"].sum() > 0
    rate = s["default_payment_next_month"].mean()
    for part in ["train", "val", "test"]:
        assert math.isclose(s.loc[s.split == part, "default_payment_next_month"].mean(), rate, abs_tol=0.08)
