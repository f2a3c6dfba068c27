"""Validation, quality checks and drift (intent of the original monitoring tests)."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerscope.operators import drift as D
from ledgerscope.operators import quality as Q
from ledgerscope.schema import raw_schema

from conftest import SAMPLE_RECORD


def test_clean_fixture_passes(raw_df):
    assert Q.validation_passed(raw_df.drop("ID"))


def test_missing_column_fails(raw_df):
    rep = Q.validation_report(raw_df.drop("ID", "LIMIT_BAL"))
    rows = rep.collect()
    assert any(r.check_name == "schema" and r.column_name == "LIMIT_BAL" and r.severity == "issue" for r in rows)
    assert [r.severity for r in rows if r.check_name == "summary"] == ["failed"]


def test_all_null_column_fails(raw_df):
    df = raw_df.drop("ID").withColumn("AGE", F.lit(None).cast("int"))
    assert not Q.validation_passed(df)


def test_duplicates_count_null_rows_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3), (2, 3), (2, 3)], "a int, b int")
    r = Q.check_duplicates(df).first()
    assert (r.n_rows, r.n_distinct, r.n_duplicates) == (5, 2, 3)


def test_default_rate_in_unit_interval(raw_df):
    r = Q.check_class_balance(raw_df).first()
    assert 0 < r.default_rate < 1 and r.n_rows == 200


def _record(spark, **over):
    rec = dict(SAMPLE_RECORD, **over)
    return spark.createDataFrame([rec], raw_schema(False, False))


def test_record_checks(spark):
    ok = Q.check_records(_record(spark)).first()
    assert ok.valid and ok.errors == [] and ok.warnings == []
    missing = Q.check_records(_record(spark, LIMIT_BAL=None)).first()
    assert not missing.valid and "LIMIT_BAL" in missing.missing_fields
    sex = Q.check_records(_record(spark, SEX=5)).first()
    assert sex.valid and any("SEX" in w for w in sex.warnings)
    neg = Q.check_records(_record(spark, PAY_AMT1=-100.0)).first()
    assert neg.valid and any("PAY_AMT1" in w for w in neg.warnings)
    nan = Q.check_records(_record(spark, BILL_AMT3=float("nan"))).first()
    assert not nan.valid and "BILL_AMT3" in nan.nan_fields


def test_request_constraints_reject(spark):
    r = Q.request_constraints(_record(spark, AGE=15)).first()
    assert not r.accepted and "AGE" in r.violations
    assert Q.request_constraints(_record(spark)).first().accepted


def test_batch_check_inf_and_missing(spark):
    bad = _record(spark, BILL_AMT1=float("inf"))
    errs = {(r.column_name, r.check_name) for r in Q.check_batch(bad).where("error").collect()}
    assert ("BILL_AMT1", "inf") in errs
    assert Q.batch_is_valid(_record(spark))


def _samples(spark, a, b):
    rows = [(0, float(x)) for x in a] + [(1, float(x)) for x in b]
    df = spark.createDataFrame(rows, "side int, value double")
    return df.where("side = 0").select("value"), df.where("side = 1").select("value")


def _ks_brute(a, b):
    allv = np.sort(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), allv, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), allv, side="right") / len(b)
    return np.max(np.abs(fa - fb))


def test_ks_no_drift_and_drift(spark):
    rng = np.random.default_rng(0)
    a, b, c = rng.normal(0, 1, 500), rng.normal(0, 1, 500), rng.normal(5, 1, 500)
    ref, cur = _samples(spark, a, b)
    same = D.drift_report(ref, cur, ["value"]).first()
    assert not same.ks_drifted
    assert same.ks_statistic == pytest.approx(round(_ks_brute(a, b), 4))
    ref, cur = _samples(spark, a, c)
    shifted = D.drift_report(ref, cur, ["value"]).first()
    assert shifted.ks_drifted and shifted.ks_p_value < 0.05


def _psi_brute(a, b):
    edges = np.linspace(min(a.min(), b.min()), max(a.max(), b.max()), 11)
    ra, _ = np.histogram(a, edges)
    rb, _ = np.histogram(b, edges)
    pa, pb = ra / len(a) + 1e-6, rb / len(b) + 1e-6
    return round(float(np.sum((pb - pa) * np.log(pb / pa))), 4)


def test_psi_thresholds_match_numpy(spark):
    rng = np.random.default_rng(1)
    a, b, c = rng.normal(0, 1, 1000), rng.normal(0, 1, 1000), rng.normal(10, 1, 1000)
    for x, y, check in [(a, b, lambda v: v < 0.1), (a, c, lambda v: v > 0.2)]:
        ref, cur = _samples(spark, x, y)
        got = D.psi_values(D.long_values(ref, cur, ["value"])).first().psi
        assert round(got, 4) == pytest.approx(_psi_brute(x, y), abs=1e-4)
        assert check(got)


def test_score_shift_same_scores(spark):
    rng = np.random.default_rng(2)
    s = rng.integers(0, 101, 500)
    ref, cur = _samples(spark, s, s)
    r = D.score_shift(ref.withColumnRenamed("value", "risk_score"),
                      cur.withColumnRenamed("value", "risk_score")).first()
    assert not r.score_shifted and r.score_psi == 0.0


def test_drift_report_skips_small_features(spark):
    ref, cur = _samples(spark, np.arange(10.0), np.arange(10.0))
    assert D.drift_report(ref, cur, ["value"]).count() == 0


def test_lattice_pvalue_equals_enumeration():
    """All ways to interleave two samples, up to 12 rows in all, and a few with more."""
    from itertools import combinations
    for n, m in [(1, 1), (2, 3), (4, 4), (3, 7), (5, 7), (6, 6)]:
        worst = []
        for at in combinations(range(n + m), n):
            i = j = k = 0
            for t in range(n + m):
                i, j = (i + 1, j) if t in at else (i, j + 1)
                k = max(k, abs(i * m - j * n))
            worst.append(k)
        for k in {*worst, 0, 1, n * m + 1}:
            assert D.lattice_pvalue(k, n, m) == pytest.approx(np.mean(np.array(worst) >= k) if k else 1.0, abs=1e-12)
    # large samples tend to the asymptotic value, without overflow
    n = 4000
    k = int(0.03 * n * n)
    z = np.sqrt(n / 2) * k / n ** 2
    assert D.lattice_pvalue(k, n, n) == pytest.approx(2 * sum((-1) ** (i - 1) * np.exp(-2 * i * i * z * z) for i in range(1, 20)), abs=5e-3)


def test_exact_ks_by_size(spark):
    rng = np.random.default_rng(3)
    rows = [("small", float(x), 0) for x in rng.normal(size=9)] + [("small", float(x), 1) for x in rng.normal(1, 1, 11)]
    rows += [("large", float(x), int(t)) for x, t in zip(rng.normal(size=200), rng.integers(0, 2, 200))] + [("alone", 1.0, 0)]
    df = spark.createDataFrame(rows, "feature string, value double, side int")
    got = {r.feature: r for r in D.exact_ks(D.value_counts(df), most_rows=50).collect()}
    assert set(got) == {"small", "large"} and got["small"].is_exact and not got["large"].is_exact
    s = [np.array([v for f, v, t in rows if f == "small" and t == side]) for side in (0, 1)]
    assert got["small"].ks_statistic == pytest.approx(_ks_brute(*s))
    assert got["small"].ks_p_value == pytest.approx(D.lattice_pvalue(round(_ks_brute(*s) * 99), 9, 11))


def test_report_reads_the_table_for_one_set_of_counts_and_the_duplicates(raw_df, tmp_path):
    raw_df.drop("ID").union(raw_df.drop("ID").limit(3)).write.parquet(str(tmp_path / "t"))
    df = raw_df.sparkSession.read.parquet(str(tmp_path / "t"))
    rep = Q.validation_report(df)
    assert rep._jdf.queryExecution().optimizedPlan().toString().count("Relation [") <= 3
    dup = [r for r in rep.collect() if r.check_name == "duplicates"]
    assert [(r.severity, r.n_bad) for r in dup] == [("warning", 3)]


@pytest.mark.parametrize("most", [0, 500_000])
def test_duplicates_with_equal_hashes_are_compared(spark, monkeypatch, most):
    """xxhash64 leaves NULLs out, so (1, NULL) and (NULL, 1) have one hash; 0.0 equals -0.0 and NaN NaN."""
    monkeypatch.setattr(Q, "BROADCAST_HASHES", most)
    n = float("nan")
    df = spark.createDataFrame([(1.0, None), (None, 1.0), (None, 1.0), (0.0, 2.0), (-0.0, 2.0), (n, n), (n, n), (5.0, 6.0)], "a double, b double")
    r = Q.check_duplicates(df).first()
    assert (r.n_rows, r.n_distinct, r.n_duplicates) == (8, 5, 3)
    r = Q.check_duplicates(df.where("a > 9 and b < 0")).first()
    assert (r.n_rows, r.n_distinct, r.n_duplicates) == (0, 0, 0)
    assert spark.range(1).count() == 1


def test_drift_report_unpivots_once(spark, tmp_path):
    for side, at in (("r", 0), ("c", 3)):
        spark.createDataFrame([(float(i % 7 + at), float(i)) for i in range(60)], "a double, b double").write.parquet(str(tmp_path / side))
    ref, cur = (spark.read.parquet(str(tmp_path / k)) for k in ("r", "c"))
    rep = D.drift_report(ref, cur, ["a", "b"])
    assert "Expand" not in rep._jdf.queryExecution().optimizedPlan().toString()
    assert {r.feature: r.drifted for r in rep.collect()} == {"a": True, "b": False}
