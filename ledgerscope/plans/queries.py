"""Registry of named queries: a DataFrame plan and (where SQL can state it) an
independent SQL oracle over the raw driver tables.

Every query reads the driver tables at ``sf_dir`` and runs over whole tables.
Double outputs are rounded to 6 decimals (4 where the original rounds to 4) so
the comparison is about values, not about summation order in the last bit.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscope.operators import scoring as sc
from ledgerscope.plans import oracle_sql as O
from ledgerscope.schema import DERIVED_COLS
from ledgerscope.sources import credit as src

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_SQL)


def _load_all() -> None:
    # importing the query modules fills the registry
    from ledgerscope.plans import (q_core, q_drift, q_eval, q_explain,  # noqa: F401
                                   q_models, q_quality, q_stream, q_variants)


# ------------------------------------------------------------------ shared helpers
def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def credit(spark: SparkSession, sf: str) -> DataFrame:
    """All snapshots; those with fewer than six months have NULL older months."""
    return src.credit_all(spark, sf)


def features(spark: SparkSession, sf: str, raw: DataFrame | None = None) -> DataFrame:
    return sc.featurize(credit(spark, sf) if raw is None else raw)


def training_features(spark: SparkSession, sf: str, raw: DataFrame | None = None) -> DataFrame:
    """Snapshots with all six months: what split, scaler and models are fitted on."""
    return sc.featurize(src.credit(spark, sf) if raw is None else raw.where(F.col("BILL_AMT6").isNotNull()))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """credit -> clean -> derive -> fixed demo model -> score output."""
    return sc.score_frame(credit(spark, sf), sc.demo_predictor)


def sql(*ctes: str, body: str) -> str:
    return O.with_ctes(*ctes) + body


BASE = O.BASE
DERIVED = DERIVED_COLS
