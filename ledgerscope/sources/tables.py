"""Scans of the driver-provided parquet tables and of user credit files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscope.schema import DOTTED_TARGET, GENERIC_NAMES, ID_COL, TARGET, raw_schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; parquet gives pushdown and column pruning for free."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every floating column so operators see one missing marker."""
    exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(F.nanvl(F.col(f"`{f.name}`"), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            exprs.append(F.col(f"`{f.name}`"))
    return df.select(*exprs)


def remap_columns(df: DataFrame) -> DataFrame:
    """Generic header X1..X23 / Y -> real names, only for the columns present.

    Triggered only when ``X1`` or ``Y`` is a column, as in the original loader.
    """
    if "X1" not in df.columns and "Y" not in df.columns:
        return df
    mapping = {k: v for k, v in GENERIC_NAMES.items() if k in df.columns}
    return df.withColumnsRenamed(mapping)


def rename_target(df: DataFrame) -> DataFrame:
    """Dotted target name -> underscores (no-op when absent)."""
    if DOTTED_TARGET in df.columns:
        return df.withColumnRenamed(DOTTED_TARGET, TARGET)
    return df


def drop_id(df: DataFrame) -> DataFrame:
    return df.drop(ID_COL)


def _typed(name: str, kind: T.DataType) -> F.Column:
    """Text to ``kind``; blank and NaN are NULL, whole numbers may be written 24.0, and any
    other text is an error that names the column and the value."""
    text = F.trim(F.col(f"`{name}`"))
    number = text.try_cast("double")
    if isinstance(kind, T.DoubleType):
        value = number
    else:
        whole = F.when(number == F.rint(number), number.try_cast(kind))
        value = F.coalesce(text.try_cast(kind), whole)
    empty = text.isNull() | (text == "") | F.isnan(F.coalesce(number, F.lit(0.0)))
    wrong = F.raise_error(F.concat(F.lit(f"column {name} cannot be read as {kind.simpleString()}: "), text))
    return F.when(empty, F.lit(None)).when(value.isNotNull(), value).otherwise(wrong.cast(kind)).alias(name)


def read_credit_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV scan by the names in the header (real, generic X1..Y or dotted), in any order;
    absent columns stay absent and unknown ones stay text. Files of one folder must have
    the same header, and rows of another width or with unreadable values are errors."""
    df = (spark.read.option("header", True).option("mode", "FAILFAST")
          .option("enforceSchema", False).csv(path))
    df = rename_target(remap_columns(df))
    kinds = {f.name: f.dataType for f in raw_schema(True, True).fields}
    return df.select(*[_typed(c, kinds[c]) if c in kinds else F.col(f"`{c}`") for c in df.columns])


def read_credit_parquet(spark: SparkSession, path: str) -> DataFrame:
    return nan_to_null(rename_target(remap_columns(spark.read.parquet(path))))
