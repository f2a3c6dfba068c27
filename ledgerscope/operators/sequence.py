"""Lag of ordered values within a group, safe for groups of any size.

``Window.partitionBy(key).orderBy(...)`` puts a whole group into one task; a customer
holding a third of all rows would then be one task over a third of the data. Here every
key has pieces: a key of ordinary size has one, a hot key (more than ``1 / MAX_HOT`` of
all rows, and more than ``MIN_HOT_ROWS``) is cut by quantiles of its first order column.
Lags are taken by a plain window over ``(key, piece)``, so nothing here is Python, unused
lags are pruned, and no job runs before the caller's action: piece numbers come from
counts and exact quantiles of coarse values (days, or numbers cut to STEPS of their
magnitude), which depend on the rows only, not on how these are dealt over tasks; so every
consumer finds the same cuts, however often a plan computes them.

Only the first ``k`` rows of a hot key's later pieces have predecessors elsewhere. They and
the last ``k`` rows of the pieces form a side table on which a window by key finds the
missing lags, which are broadcast back. Proven bounds, whatever the data: fewer than
``MAX_HOT`` hot keys, at most ``2 * MAX_HOT`` pieces of them, ``2 * k`` side rows a piece.

Rows whose key is NULL form one group. Rows of one key with an equal first order value
stay in one piece. No row is lost or repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_HOT = 4096          # a key with more than 1/4096 of all rows is cut
MIN_HOT_ROWS = 100_000  # but none below this
SPLITS = 256            # most pieces of one key
STEPS = 1 << 16         # coarse values between a power of two and the next
DAY = 86_400_000_000    # microseconds

_KEY, _PIECES, _CUTS, _PIECE, _RN, _LAST = "_seq_key", "_seq_n", "_seq_cuts", "_seq_piece", "_seq_rn", "_seq_last"


def position(df: DataFrame, name: str) -> tuple[Column, Column]:
    """A date, time or number as a number, and its coarse value, of which there are few."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.DateType):
        return F.unix_date(c), F.unix_date(c)
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        at = F.unix_micros(c.cast("timestamp"))
        return at, F.floor(at / DAY) * DAY
    at = c.cast("double")
    step = F.pow(F.lit(2.0), F.floor(F.log2(F.abs(at)))) / STEPS
    return at, F.when(at == 0, 0.0).otherwise(F.floor(at / step) * step)


def hot_keys(sizes: DataFrame, key: str, first: str, min_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """Fewer than MAX_HOT rows: hot key, its number of pieces, quantiles of ``first``."""
    counts = sizes.groupBy(F.col(key).alias(_KEY)).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    most = F.greatest(F.lit(min_rows).cast("double"), total / F.lit(MAX_HOT))
    hot = (counts.where(F.col("_n") > most)
           .select(_KEY, F.least(F.lit(SPLITS), F.ceil(F.col("_n") / most)).cast("int").alias(_PIECES)))
    at = [i / SPLITS for i in range(1, SPLITS)]
    return (sizes.select(F.col(key).alias("_k"), position(sizes, first)[1].cast("double").alias("_o"))
            .join(F.broadcast(hot), F.col("_k").eqNullSafe(F.col(_KEY)))
            .groupBy(_KEY, _PIECES, "_o").agg(F.count(F.lit(1)).alias("_n"))
            .groupBy(_KEY, _PIECES).agg(F.percentile("_o", at, F.col("_n")).alias(_CUTS)))


def lag_within_group(df: DataFrame, key: str, order: list[str], values: list[str], k: int,
                     sizes: DataFrame | None = None, min_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """Add ``{v}_lag{j}`` for j = 1..k: the value j rows earlier in ``order`` within
    the same ``key`` (NULL when there is no such row). ``(key, *order)`` must be
    unique per row, as it is for (customer, date, order key). ``sizes`` may name a
    cheaper frame with the same ``key`` and first order column."""
    names = df.columns
    lag_names = [f"{v}_lag{j}" for j in range(1, k + 1) for v in values]
    hot = hot_keys(df if sizes is None else sizes, key, order[0], min_rows)

    here = position(df, order[0])[0]
    below = F.size(F.filter(_CUTS, lambda c: c <= here))
    piece = F.floor(below * F.col(_PIECES) / F.lit(SPLITS)).cast("int")
    same = F.col(key).eqNullSafe(F.col(_KEY))
    by_piece = Window.partitionBy(key, _PIECE).orderBy(*order)

    def lags(over, suffix: str = "") -> list:
        return [F.lag(v, j).over(over).alias(f"{v}_lag{j}{suffix}") for j in range(1, k + 1) for v in values]

    rows = (df.join(F.broadcast(hot), same, "left")
            .select(*names, F.when(F.col(_PIECES).isNotNull(), piece).otherwise(F.lit(0)).alias(_PIECE)))
    rows = rows.select(*names, *lags(by_piece))

    ends = (df.join(F.broadcast(hot), same, "inner").select(key, *order, *values, piece.alias(_PIECE))
            .select("*", F.row_number().over(by_piece).alias(_RN), F.lead(F.lit(1), k).over(by_piece).alias(_LAST)))
    head = (F.col(_PIECE) > 0) & (F.col(_RN) <= k)
    by_key = Window.partitionBy(key).orderBy(*order)
    fixed = (ends.where(head | F.col(_LAST).isNull())
             .select(*[F.col(c).alias(f"{c}__at") for c in [key, *order]], head.alias("_head"), *lags(by_key, "__fix"))
             .where("_head").drop("_head"))
    at_row = [F.col(c).eqNullSafe(F.col(f"{c}__at")) for c in [key, *order]]
    joined = rows.join(F.broadcast(fixed), at_row, "left")
    return joined.select(*names, *[F.coalesce(F.col(f"{c}__fix"), F.col(c)).alias(c) for c in lag_names])
