"""Derived-feature operator (one narrow projection)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerscope.functions.features import DERIVED_EXPRS
from ledgerscope.schema import TARGET


def add_derived_features(df: DataFrame) -> DataFrame:
    """Append the eight derived columns; existing columns are kept as they are."""
    return df.withColumns({name: fn() for name, fn in DERIVED_EXPRS.items()})


def feature_names(df: DataFrame, target: str = TARGET) -> list[str]:
    """All columns except the target (schema only, no job)."""
    return [c for c in df.columns if c != target]
