"""Stand-in inputs with faults and with a shifted current period, by fixed rules on the key.

They only give rows of the credit schema on which checks and alerts have something to find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.sources.credit import DRIFT_CUTOFF

# ----------------------------------------------------------------------------------
# FIXED VALUES of the rules (shared with the SQL oracle): column -> (ID divisor, SQL value)
# ----------------------------------------------------------------------------------
SOILED = {
    "AGE": (97, "AGE + 100"), "SEX": (83, "3"), "EDUCATION": (71, "9"), "PAY_0": (67, "12"),
    "PAY_AMT1": (89, "-PAY_AMT1 - 1"), "PAY_AMT4": (61, "-5.5"), "BILL_AMT1": (79, "CAST('NaN' AS DOUBLE)"),
    "BILL_AMT2": (59, "CAST('Infinity' AS DOUBLE)"), "LIMIT_BAL": (73, "-1.0"),
}
REPEATED = 101            # rows whose ID it divides stand there twice
SHIFTED = {
    "LIMIT_BAL": "LIMIT_BAL * 2.5", "BILL_AMT1": "BILL_AMT1 + 150000.0", "AGE": "AGE + 15",
    "PAY_0": "ID * 31 % 5 - 1", "PAY_2": "ID * 37 % 4 - 1",
}
# ----------------------------------------------------------------------------------


def soiled(df: DataFrame) -> DataFrame:
    """Values out of range, of the wrong sign, not a number or infinite, and repeated rows."""
    kinds = dict(df.dtypes)
    bad = df.withColumns({c: F.when(F.col("ID") % k == 0, F.expr(v).cast(kinds[c])).otherwise(F.col(c))
                          for c, (k, v) in SOILED.items()})
    return bad.unionAll(bad.where(F.col("ID") % REPEATED == 0))


def shifted(df: DataFrame) -> DataFrame:
    """The current period with other limits, bills and ages, and statuses unrelated to the label."""
    kinds = dict(df.dtypes)
    now = F.col("AS_OF") >= F.lit(DRIFT_CUTOFF)
    return df.withColumns({c: F.when(now, F.expr(v).cast(kinds[c])).otherwise(F.col(c)) for c, v in SHIFTED.items()})


def soiled_sql(src: str = "credit_all") -> str:
    kind = {c: "DOUBLE" if "AMT" in c or c == "LIMIT_BAL" else "INTEGER" for c in SOILED}
    cols = ", ".join(f"CASE WHEN ID % {k} = 0 THEN CAST({v} AS {kind[c]}) ELSE {c} END AS {c}" for c, (k, v) in SOILED.items())
    return (f"soiled0 AS (SELECT * REPLACE ({cols}) FROM {src}),\n"
            f"soiled AS (SELECT * FROM soiled0 UNION ALL SELECT * FROM soiled0 WHERE ID % {REPEATED} = 0)")


def shifted_sql(src: str = "credit_all") -> str:
    kind = {c: "DOUBLE" if "AMT" in c or c == "LIMIT_BAL" else "INTEGER" for c in SHIFTED}
    cols = ", ".join(f"CASE WHEN AS_OF >= DATE '{DRIFT_CUTOFF.isoformat()}' THEN CAST({v} AS {kind[c]}) ELSE {c} END AS {c}"
                     for c, v in SHIFTED.items())
    return f"credit_shifted AS (SELECT * REPLACE ({cols}) FROM {src})"
