"""Training-side validation (V1-V8) and scoring-side quality checks (Q1-Q3).

Table-level checks read the data ONCE: every count (missing, out of range, negative,
class counts) is one column of a single global aggregate (partial per task, one
row per task into the final merge), then stacked into a long report. The duplicate
check has passes of its own (hashes of all rows, then the rows whose hash repeats). Row-level checks are pure
projections that build per-row error / warning arrays.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscope.schema import (BILL_COLS, CLASS_RATE_BOUNDS, EXPECTED_COLUMNS, ID_COL,
                                MISSING_ISSUE_THRESHOLD, PAY_AMT_COLS, REQUEST_CONSTRAINTS,
                                REQUIRED_FIELDS, SCORING_RANGES, TARGET, VALID_RANGES,
                                BATCH_MAX_MISSING)
from ledgerscope.session import stored

BROADCAST_HASHES = 500_000       # row hashes (8 bytes each) that may be broadcast
REPORT_SCHEMA = "check_name string, column_name string, severity string, n_bad bigint, pct double"


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _stack(one_row: DataFrame, rows: list[tuple[str, str, str]], sev_sql: str) -> DataFrame:
    """rows: (check, column, n_bad column) of a one-row aggregate -> long report.
    ``sev_sql`` is a SQL expression over n_bad, __n and column."""
    if not rows:
        return one_row.sparkSession.createDataFrame([], REPORT_SCHEMA)
    parts = ", ".join(f"'{chk}', '{col}', CAST(`{nb}` AS BIGINT)" for chk, col, nb in rows)
    long = one_row.selectExpr(f"stack({len(rows)}, {parts}) AS (check_name, column_name, n_bad)", "`__n`")
    return long.select("check_name", "column_name", F.expr(sev_sql).alias("severity"), "n_bad",
                       F.try_divide(F.col("n_bad").cast("double"), F.col("__n")).alias("pct"))


# ------------------------------------------------------------------------- V1 schema
def check_schema(df: DataFrame, expected: list[str] | None = None) -> DataFrame:
    """Missing expected columns -> issue; extra columns except ID -> warning.
    The column lists come from the schema; only n_rows needs the data."""
    expected = expected or EXPECTED_COLUMNS
    present = df.columns
    rows = [(c, True, c in present, "ok" if c in present else "issue") for c in expected]
    rows += [(c, False, True, "warning") for c in present if c not in expected and c != ID_COL]
    parts = ", ".join(f"'{c}', {str(e).lower()}, {str(p).lower()}, '{sev}'" for c, e, p, sev in rows)
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return n.selectExpr(f"stack({len(rows)}, {parts}) AS (column_name, expected, present, severity)",
                        "n_rows", f"{len(present)} AS n_cols")


# ------------------------------------------------------------ one-pass aggregates
def _aggregates(df: DataFrame, target: str = TARGET) -> tuple[DataFrame, dict]:
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("__n")]
    names = {"missing": {}, "range": {}, "neg": {}}
    for i, c in enumerate(cols):
        nm = f"__m{i}"
        aggs.append(F.count_if(_q(c).isNull()).alias(nm))
        names["missing"][c] = nm
    for i, (c, (lo, hi)) in enumerate(VALID_RANGES.items()):
        if c in cols:
            nm = f"__r{i}"
            # a missing value is not out of range (both comparisons false)
            aggs.append(F.count_if((_q(c) < lo) | (_q(c) > hi)).alias(nm))
            names["range"][c] = nm
    for i, c in enumerate(PAY_AMT_COLS + BILL_COLS):
        if c in cols:
            nm = f"__g{i}"
            aggs.append(F.count_if(_q(c) < 0).alias(nm))
            names["neg"][c] = nm
    if target in cols:
        aggs += [F.count_if(_q(target) == 1).alias("__pos"), F.count_if(_q(target) == 0).alias("__neg"),
                 F.avg(_q(target).cast("double")).alias("__rate")]
    return df.agg(*aggs), names


# ------------------------------------------------------------------- V2 missing
def check_missing(df: DataFrame, threshold: float = MISSING_ISSUE_THRESHOLD) -> DataFrame:
    """Per column: missing count and fraction; > threshold (strict) -> issue, > 0 ->
    warning, else ok."""
    one, names = _aggregates(df)
    rows = [("missing", c, nm) for c, nm in names["missing"].items()]
    return _stack(one, rows, f"CASE WHEN try_divide(CAST(n_bad AS DOUBLE), __n) > {threshold!r} "
                             "THEN 'issue' WHEN n_bad > 0 THEN 'warning' ELSE 'ok' END")


def missing_stats(df: DataFrame) -> DataFrame:
    """total_missing and missing_pct (mean over columns of the missing fraction)."""
    one, names = _aggregates(df)
    nms = list(names["missing"].values())
    total = reduce(lambda a, b: a + b, [F.col(n) for n in nms])
    frac = reduce(lambda a, b: a + b, [F.try_divide(F.col(n).cast("double"), F.col("__n")) for n in nms])
    return one.select(F.col("__n").alias("n_rows"), total.cast("bigint").alias("total_missing"),
                      (frac / F.lit(float(len(nms)))).alias("missing_pct"))


# ---------------------------------------------------------------- V3 duplicates
def check_duplicates(df: DataFrame) -> DataFrame:
    """Rows equal to an earlier row over ALL columns, NULLs equal. First a 64-bit hash of each
    row is counted, so only hashes are shuffled: a hash that stands alone is a distinct row.
    Rows whose hash repeats are compared whole: grouping by every column treats NULLs as equal
    (count(DISTINCT a, b) would skip them), and the partial aggregate collapses repeated rows
    inside each task before the shuffle, so one row repeated a billion times costs one row per
    task. The repeated hashes are saved and counted, and broadcast up to BROADCAST_HASHES of
    them; beyond that, all rows are grouped whole."""
    cols = [_q(c) for c in df.columns]
    hashed = df.groupBy(F.xxhash64(*cols).alias("__h")).agg(F.count(F.lit(1)).alias("__c"))
    seen = Observation("row hashes")
    some = stored(hashed.observe(seen, F.coalesce(F.sum("__c"), F.lit(0)).alias("rows"), F.count_if(F.col("__c") == 1).alias("alone"),
                                 F.count_if(F.col("__c") > 1).alias("repeated")).where("__c > 1").select("__h"), "repeated")
    rows, alone, repeated = (seen.get[k] for k in ("rows", "alone", "repeated"))
    if repeated > BROADCAST_HASHES:
        alone, open_rows = 0, df
    else:
        open_rows = df.withColumn("__h", F.xxhash64(*cols)).join(F.broadcast(some), "__h", "left_semi").drop("__h")
    groups = open_rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("__c"))
    return groups.agg(F.lit(rows).cast("bigint").alias("n_rows"), (F.count(F.lit(1)) + F.lit(alone)).alias("n_distinct")).select(
        "n_rows", "n_distinct", (F.col("n_rows") - F.col("n_distinct")).alias("n_duplicates"))


# ------------------------------------------------------------------- V4 ranges
def check_ranges(df: DataFrame) -> DataFrame:
    one, names = _aggregates(df)
    rows = [("range", c, nm) for c, nm in names["range"].items()]
    return _stack(one, rows, "CASE WHEN n_bad > 0 THEN 'warning' ELSE 'ok' END")


# ------------------------------------------------------------- V5 class balance
def check_class_balance(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Class counts and default rate; rate outside [0.05, 0.50] -> warning. Empty
    result when there is no target column."""
    if target not in df.columns:
        return df.sparkSession.createDataFrame(
            [], "n_rows bigint, n_negative bigint, n_positive bigint, default_rate double, severity string")
    lo, hi = CLASS_RATE_BOUNDS
    one, _ = _aggregates(df, target)
    return one.select(F.col("__n").alias("n_rows"), F.col("__neg").alias("n_negative"),
                      F.col("__pos").alias("n_positive"), F.col("__rate").alias("default_rate"),
                      F.when((F.col("__rate") < lo) | (F.col("__rate") > hi), "warning")
                      .otherwise("ok").alias("severity"))


# ------------------------------------------------------ V6 sign consistency
def check_negative_amounts(df: DataFrame) -> DataFrame:
    """PAY_AMT < 0 -> warning; BILL_AMT < 0 -> info (credit balance is allowed)."""
    one, names = _aggregates(df)
    rows = [("negative", c, nm) for c, nm in names["neg"].items()]
    return _stack(one, rows, "CASE WHEN n_bad = 0 THEN 'ok' WHEN column_name LIKE 'PAY_AMT%' "
                             "THEN 'warning' ELSE 'info' END")


# ------------------------------------------------------------------ V7 report
def validation_report(df: DataFrame) -> DataFrame:
    """All findings (issue / warning / info rows) of V1-V6 plus a 'summary' row whose
    severity is 'passed' or 'failed' (failed iff any issue)."""
    one, names = _aggregates(df)

    def row(check: str, column: str | None, severity, n_bad=None, pct=None) -> Column:
        return F.struct(F.lit(check).alias("check_name"), F.lit(column).cast("string").alias("column_name"),
                        (severity if isinstance(severity, Column) else F.lit(severity)).alias("severity"),
                        (F.lit(None) if n_bad is None else n_bad).cast("bigint").alias("n_bad"),
                        (F.lit(None) if pct is None else pct).cast("double").alias("pct"))

    def counted(check: str, column: str, name: str, severity) -> Column:
        share = F.try_divide(F.col(name).cast("double"), F.col("__n"))
        return row(check, column, severity(F.col(name), share), F.col(name), share)
    rows = [row("schema", c, "issue") for c in EXPECTED_COLUMNS if c not in df.columns]
    rows += [row("schema", c, "warning") for c in df.columns if c not in EXPECTED_COLUMNS and c != ID_COL]
    rows += [counted("missing", c, m, lambda n, p: F.when(p > MISSING_ISSUE_THRESHOLD, "issue").when(n > 0, "warning").otherwise("ok"))
             for c, m in names["missing"].items()]
    rows += [counted("range", c, m, lambda n, p: F.when(n > 0, "warning").otherwise("ok")) for c, m in names["range"].items()]
    rows += [counted("negative", c, m, lambda n, p, s="warning" if c.startswith("PAY_AMT") else "info": F.when(n == 0, "ok").otherwise(s))
             for c, m in names["neg"].items()]
    rows.append(row("duplicates", None, F.when(F.col("n_duplicates") > 0, "warning").otherwise("ok"), F.col("n_duplicates"),
                    F.try_divide(F.col("n_duplicates").cast("double"), F.col("n_rows"))))
    if TARGET in df.columns:
        lo, hi = CLASS_RATE_BOUNDS
        rows.append(row("class_balance", TARGET, F.when((F.col("__rate") < lo) | (F.col("__rate") > hi), "warning").otherwise("ok"),
                        F.col("__pos"), F.col("__rate")))
    # one row a side: the rows are read for each side once, and the findings are an array of that row
    found = one.crossJoin(check_duplicates(df)).select(F.filter(F.array(*rows), lambda x: x["severity"] != "ok").alias("found"))
    issues = F.size(F.filter("found", lambda x: x["severity"] == "issue"))
    summary = row("summary", None, F.when(issues > 0, "failed").otherwise("passed"), issues)
    return found.select(F.inline(F.concat("found", F.array(summary))))


def validation_passed(df: DataFrame) -> bool:
    """V8 gate: an action on the one-row summary (the training job aborts on False)."""
    row = validation_report(df).where(F.col("check_name") == "summary").first()
    return row is not None and row["severity"] == "passed"


def render_report(report: DataFrame) -> str:
    """Text rendering of a (small) report on the driver; report rows are bounded by
    the number of columns, not by the data."""
    rows = report.where(F.col("severity") != "info").orderBy("severity", "check_name", "column_name").collect()
    outcome = next((r["severity"] for r in rows if r["check_name"] == "summary"), "passed")
    found = [r for r in rows if r["check_name"] != "summary"]
    table = [("severity", "check", "column", "rows", "share")]
    table += [(r["severity"], r["check_name"], r["column_name"] or "(table)", str(r["n_bad"] if r["n_bad"] is not None else "-"),
               "-" if r["pct"] is None else f"{100 * r['pct']:.2f} %") for r in found]
    width = [max(len(line[i]) for line in table) for i in range(5)]
    body = ["  ".join(cell.ljust(w) for cell, w in zip(line, width, strict=True)).rstrip() for line in table] if found else []
    return "\n".join([f"validation {outcome}, {len(found)} findings", *body])


# ------------------------------------------------------- Q1 per-record check
def _name_list(flags: list[tuple[str, Column]]) -> Column:
    """The names whose flag is true, joined by commas; NULL without any."""
    arr = F.filter(F.array(*[F.when(f, F.lit(n)) for n, f in flags]), lambda x: x.isNotNull())
    return F.when(F.size(arr) > 0, F.array_join(arr, ","))


def _finding(flag: Column, rule: str, field: str, value: Column | None, low: float | None, high: float | None, severity: str) -> Column:
    return F.when(flag, F.struct(
        F.lit(rule).alias("rule"), F.lit(field).alias("field"), (F.lit(None) if value is None else value).cast("double").alias("value"),
        F.lit(low).cast("double").alias("low"), F.lit(high).cast("double").alias("high"), F.lit(severity).alias("severity")))


def check_records(df: DataFrame, raw_nan_aware: bool = True) -> DataFrame:
    """Per row ``findings``: rule (required, number, range, sign), field, offending value,
    bounds and severity. Absent and NaN fields are errors, values out of the scoring ranges
    and negative payments warnings; ``errors`` and ``warnings`` say them as text, and
    ``valid`` holds without errors. Run on the RAW frame: a NaN is an error AND fails its
    range test, a NULL is only absent."""
    cols = df.columns
    missing = _name_list([(c, (_q(c).isNull() if c in cols else F.lit(True))) for c in REQUIRED_FIELDS])
    nan_flags = [(f.name, F.isnan(_q(f.name))) for f in df.schema.fields
                 if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    nan_list = _name_list(nan_flags) if nan_flags else F.lit(None).cast("string")
    range_flags = [(c, ~((_q(c) >= lo) & (_q(c) <= hi)) | F.isnan(_q(c).cast("double")))
                   for c, (lo, hi) in SCORING_RANGES.items() if c in cols]
    range_flags = [(n, F.coalesce(f, F.lit(False))) for n, f in range_flags]
    neg_flags = [(c, F.coalesce(_q(c) < 0, F.lit(False))) for c in PAY_AMT_COLS if c in cols]
    found = [_finding(_q(c).isNull() if c in cols else F.lit(True), "required", c, None, None, None, "error") for c in REQUIRED_FIELDS]
    found += [_finding(f, "number", n, _q(n), None, None, "error") for n, f in nan_flags]
    found += [_finding(f, "range", n, _q(n), *SCORING_RANGES[n], "warning") for n, f in range_flags]
    found += [_finding(f, "sign", n, _q(n), 0, None, "warning") for n, f in neg_flags]
    errors = F.filter(F.array(F.concat(F.lit("absent: "), missing), F.concat(F.lit("not a number: "), nan_list)),
                      lambda x: x.isNotNull())
    text = F.transform(F.filter("findings", lambda x: x["severity"] == "warning"), lambda x: F.concat(
        x["field"], F.lit(" = "), x["value"].cast("string"), F.when(x["rule"] == "sign", F.lit(" is below 0")).otherwise(
            F.concat(F.lit(" is not in "), x["low"].cast("string"), F.lit(" to "), x["high"].cast("string")))))
    return (df.withColumns({"missing_fields": missing, "nan_fields": nan_list,
                            "findings": F.filter(F.array(*found), lambda x: x.isNotNull()), "errors": errors})
            .withColumns({"warnings": text, "valid": F.size("errors") == 0}))


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined) from one checked plan; both keep the check columns."""
    checked = check_records(df)
    return checked.where(F.col("valid")), checked.where(~F.col("valid"))


# ------------------------------------------------------------- Q2 batch check
def check_batch(df: DataFrame, max_missing: float = BATCH_MAX_MISSING) -> DataFrame:
    """Per required column: missing fraction (> max -> error); per numeric column:
    whether any +-inf appears (-> error). Missing columns -> one error each and no
    data check (the original stops there). Never emits warnings."""
    spark = df.sparkSession
    absent = [c for c in REQUIRED_FIELDS if c not in df.columns]
    if absent:
        return spark.createDataFrame([(c, "missing_column", True, None) for c in absent],
                                     "column_name string, check_name string, error boolean, value double")
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    aggs = [F.count(F.lit(1)).alias("__n")]
    aggs += [F.count_if(_q(c).isNull()).alias(f"__m{i}") for i, c in enumerate(REQUIRED_FIELDS)]
    aggs += [F.count_if(F.abs(_q(c).cast("double")) == float("inf")).alias(f"__i{i}")
             for i, c in enumerate(numeric)]
    one = df.agg(*aggs)
    parts = [f"'{c}', 'missing', CAST(try_divide(CAST(`__m{i}` AS DOUBLE), __n) AS DOUBLE)"
             for i, c in enumerate(REQUIRED_FIELDS)]
    parts += [f"'{c}', 'inf', CAST(`__i{i}` AS DOUBLE)" for i, c in enumerate(numeric)]
    long = one.selectExpr(f"stack({len(parts)}, {', '.join(parts)}) AS (column_name, check_name, value)")
    err = (F.when(F.col("check_name") == "missing", F.col("value") > F.lit(max_missing))
           .otherwise(F.col("value") > 0))
    return long.select("column_name", "check_name", F.coalesce(err, F.lit(False)).alias("error"), "value")


def batch_measures(df: DataFrame) -> list[Column]:
    """The sums that the batch check needs, as aggregates that ``observe`` can take along
    another plan over the same rows; ``batch_errors`` reads them."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    present = [c for c in REQUIRED_FIELDS if c in df.columns]
    return [F.count(F.lit(1)).alias("n"),
            *[F.sum(_q(c).isNull().cast("long")).alias(f"missing:{c}") for c in present],
            *[F.sum((F.abs(_q(c).cast("double")) == float("inf")).cast("long")).alias(f"inf:{c}") for c in numeric]]


def batch_errors(measures: dict, columns: list[str], max_missing: float = BATCH_MAX_MISSING) -> list[str]:
    """column:check of every error, as ``check_batch`` finds them."""
    absent = [f"{c}:missing_column" for c in REQUIRED_FIELDS if c not in columns]
    if absent:
        return absent
    n = measures["n"] or 0
    bad = [f"{c}:missing" for c in REQUIRED_FIELDS if n and (measures[f"missing:{c}"] or 0) / n > max_missing]
    return bad + [f"{k.removeprefix('inf:')}:inf" for k, v in measures.items() if k.startswith("inf:") and v]


def batch_is_valid(df: DataFrame) -> bool:
    return check_batch(df).where(F.col("error")).limit(1).count() == 0


# -------------------------------------------------------- Q3 request constraints
def request_constraints(df: DataFrame) -> DataFrame:
    """Request-schema bounds (ge/le, all 23 fields required). A violating record is
    rejected; ``violations`` lists the offending fields."""
    flags = []
    for c, (ge, le) in REQUEST_CONSTRAINTS.items():
        if c not in df.columns:
            flags.append((c, F.lit(True)))
            continue
        bad = _q(c).isNull()
        if ge is not None:
            bad = bad | (_q(c) < ge)
        if le is not None:
            bad = bad | (_q(c) > le)
        flags.append((c, F.coalesce(bad, F.lit(True))))
    viol = _name_list(flags)
    return df.withColumns({"violations": viol, "accepted": viol.isNull()})
