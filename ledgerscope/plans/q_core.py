"""Queries: sources, cleaning, features, scores, bands."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerscope.operators import prep, scoring as sc
from ledgerscope.operators.features import add_derived_features
from ledgerscope.plans import oracle_sql as O
from ledgerscope.plans.queries import (BASE, credit, features, register, round_doubles,
                                       scored, sql)
from ledgerscope.schema import DERIVED_COLS, EXPECTED_COLUMNS
from ledgerscope.sources import credit as src

_CREDIT_COLS = ["ID", "AS_OF"] + EXPECTED_COLUMNS


@register("credit_table", sql(O.CREDIT_ALL, body=f"SELECT {', '.join(_CREDIT_COLS)} FROM credit"))
def q_credit_table(spark, sf):
    return credit(spark, sf).select(*_CREDIT_COLS)


@register("clean_raw", sql(O.CREDIT_ALL, O.clean_cte(),
                           body="SELECT ID, SEX, EDUCATION, MARRIAGE, AGE FROM clean"))
def q_clean_raw(spark, sf):
    return prep.clean_raw(credit(spark, sf), keep_id=True).select(
        "ID", "SEX", "EDUCATION", "MARRIAGE", "AGE")


_DER_SQL = ", ".join(f"ROUND({c}, 6) AS {c}" if c != "delinquency_count" else c
                     for c in DERIVED_COLS)


@register("derived_features", sql(O.CREDIT_ALL, O.clean_cte(), O.feat_cte(),
                                  body=f"SELECT ID, {_DER_SQL} FROM feat"))
def q_derived_features(spark, sf):
    return round_doubles(features(spark, sf).select("ID", *DERIVED_COLS))


@register("derived_features_all_snapshots",
          sql(O.CREDIT_ALL, O.clean_cte("credit_all", "clean_all"), O.feat_cte("clean_all", "feat_all"),
              body=f"SELECT ID, {_DER_SQL} FROM feat_all"))
def q_derived_features_all(spark, sf):
    """Same features on every snapshot, where older months are missing (NULL rules)."""
    df = add_derived_features(prep.clean_raw(src.credit_all(spark, sf), keep_id=True))
    return round_doubles(df.select("ID", *DERIVED_COLS))


@register("score", sql(*BASE, body="SELECT ID, p, default_probability, risk_score, risk_band FROM scored"))
def q_score(spark, sf):
    return scored(spark, sf).select("ID", "p", "default_probability", "risk_score", "risk_band")


@register("score_bands", sql(*BASE, body="""
SELECT risk_score, risk_band, COUNT(*) AS n_records FROM scored GROUP BY risk_score, risk_band"""))
def q_score_bands(spark, sf):
    return (scored(spark, sf).groupBy("risk_score", "risk_band")
            .agg(F.count(F.lit(1)).alias("n_records")))


@register("band_summary", sql(*BASE, body="""
, agg AS (SELECT COUNT(*) AS n, AVG(default_probability) AS a,
                 COUNT(*) FILTER (WHERE risk_band = 'Low') AS n0,
                 COUNT(*) FILTER (WHERE risk_band = 'Medium') AS n1,
                 COUNT(*) FILTER (WHERE risk_band = 'High') AS n2 FROM scored)
SELECT CAST(b.band_order AS INTEGER) AS band_order, b.risk_band, CAST(b.k AS BIGINT) AS n_records,
       ROUND(CAST(b.k AS DOUBLE) * 100 / agg.n, 6) AS pct, ROUND(agg.a, 6) AS avg_default_probability
FROM agg, LATERAL (VALUES (1, 'Low', agg.n0), (2, 'Medium', agg.n1), (3, 'High', agg.n2))
     AS b(band_order, risk_band, k)"""))
def q_band_summary(spark, sf):
    return sc.band_summary(scored(spark, sf))
