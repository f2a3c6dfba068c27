"""Running totals over an ordered column without a single-partition window.

``Window.orderBy(v)`` with no ``partitionBy`` moves every row into one task. Here the
(already aggregated, one row per value) input is cut into pieces of the value range, and
each (group, piece) is a window partition of its own:

1. the cuts are quantiles of the values, found in one aggregate and fetched (one number a
   piece, a bound set by the partition count); from then on they are literals, so every plan
   assigns a row to the same piece, and nothing has to be saved;
2. per-(group, piece) totals: at most #groups x #pieces rows, with exclusive prefix sums and
   the group's grand total;
3. these are broadcast back and added to the running sum inside each piece.

A group as large as the table is spread over all pieces like the table itself.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_PIECE = "_piece"


def with_pieces(df: DataFrame, col: str, n: int) -> DataFrame:
    """df with a piece number that rises with ``col`` (NULL first, NaN last)."""
    at = [i / n for i in range(1, n)]
    cuts = df.agg(F.percentile_approx(F.nullif(F.col(col).cast("double"), F.lit(float("nan"))), at, 20 * n)).first()[0] if at else None
    inner = sorted({float(c) for c in cuts or []} - {float("inf"), float("-inf")})
    if not inner:
        return df.withColumn(_PIECE, F.lit(0))
    tmp = df.withColumn("_at", F.coalesce(F.col(col).cast("double"), F.lit(float("-inf"))))
    out = Bucketizer(splits=[-float("inf"), *inner, float("inf")], inputCol="_at", outputCol=_PIECE, handleInvalid="keep").transform(tmp)
    return out.withColumn(_PIECE, F.col(_PIECE).cast("int")).drop("_at")


def running_totals(df: DataFrame, order_col: str, sum_cols: list[str],
                   group_cols: list[str] | None = None, descending: bool = False,
                   num_pieces: int | None = None) -> DataFrame:
    """For each row add ``cum_{c}`` = sum of ``c`` over rows of the same group whose
    ``order_col`` is <= this row's (>= when descending), inclusive, and ``tot_{c}`` = sum of
    ``c`` over the group. ``(groups, order_col)`` should be unique (aggregate by value
    first)."""
    groups = list(group_cols or [])
    n = num_pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = with_pieces(df, order_col, n)
    totals = pieces.groupBy(*groups, _PIECE).agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    piece_order = F.col(_PIECE).desc() if descending else F.col(_PIECE).asc()
    before = Window.partitionBy(*groups).orderBy(piece_order).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*groups)
    keys = [F.col(g).alias(f"_g_{g}") for g in groups]
    offsets = totals.select(*keys, F.col(_PIECE).alias("_p"), *[
        F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sum_cols],
        *[F.sum(f"_t_{c}").over(every).alias(f"tot_{c}") for c in sum_cols])
    order_expr = F.col(order_col).desc() if descending else F.col(order_col).asc()
    inside = (Window.partitionBy(*groups, _PIECE).orderBy(order_expr)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = pieces.withColumns({f"_l_{c}": F.sum(c).over(inside) for c in sum_cols})
    same = F.col(_PIECE) == F.col("_p")
    for g in groups:
        same &= F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    # offsets: one row per (group, piece) -> bounded by groups x partitions
    joined = local.join(F.broadcast(offsets), same, "inner")
    return joined.select(*df.columns, *[(F.col(f"_l_{c}") + F.col(f"_o_{c}")).alias(f"cum_{c}") for c in sum_cols],
                         *[f"tot_{c}" for c in sum_cols])
