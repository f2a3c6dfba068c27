"""Queries: Structured Streaming scoring and monitoring (T1-T3), checked against the
same routing and aggregation in batch SQL over every event."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerscope.plans import oracle_sql as O
from ledgerscope.plans.queries import register, sql
from ledgerscope.schema import REQUIRED_FIELDS
from ledgerscope.sources.credit import DRIFT_CUTOFF
from ledgerscope.streaming import scoring as S

d = O.d
_ABSENT = ", ".join(f"CASE WHEN s.{c} IS NULL THEN '{c}' END" for c in REQUIRED_FIELDS)
ALL = [O.CREDIT_ALL, O.clean_cte("credit_all", "clean_all"), O.feat_cte("clean_all", "feat_all"),
       O.scored_cte("feat_all", "scored_all")]
ROUTED = f"""ccust AS (SELECT o_orderkey AS ID, o_custkey AS CUSTOMER_ID FROM orders),
lat AS (SELECT * FROM (
  SELECT s.*, c.CUSTOMER_ID, NULLIF(concat_ws(',', {_ABSENT}), '') AS absent,
         ROW_NUMBER() OVER (PARTITION BY c.CUSTOMER_ID ORDER BY s.AS_OF DESC, s.ID DESC) AS rn
  FROM scored_all s JOIN ccust c USING (ID)) WHERE rn = 1),
req AS (SELECT e.event_id, e.ts, e.user_id, l.ID AS snapshot_id,
               CASE WHEN absent IS NULL THEN l.default_probability END AS default_probability,
               CASE WHEN absent IS NULL THEN l.risk_score END AS risk_score,
               CASE WHEN absent IS NULL THEN l.risk_band END AS risk_band,
               CASE WHEN e.user_id IS NULL THEN 'no customer key' WHEN l.CUSTOMER_ID IS NULL THEN 'no snapshot'
                    WHEN absent IS NOT NULL THEN 'absent: ' || absent END AS reason
        FROM events e LEFT JOIN lat l ON e.user_id = l.CUSTOMER_ID)"""


@register("stream_score", sql(*ALL, ROUTED, body="SELECT * EXCLUDE (reason) FROM req WHERE reason IS NULL"))
def q_stream_score(spark, sf):
    out = S.stream_score(spark, sf)
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("stream_quarantine", sql(*ALL, ROUTED, body="""
SELECT event_id, ts, user_id, snapshot_id, reason FROM req WHERE reason IS NOT NULL"""))
def q_stream_quarantine(spark, sf):
    out = S.stream_quarantine(spark, sf)
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("stream_band_counts", sql(*ALL, ROUTED, body=f"""
SELECT CAST(date_trunc('day', ts) AS DATE) AS window_start, COALESCE(risk_band, '{S.UNSCORED}') AS risk_band,
       COUNT(*) AS n_requests
FROM req WHERE ts IS NOT NULL GROUP BY 1, 2"""))
def q_stream_band_counts(spark, sf):
    return S.stream_band_counts(spark, sf)


_BIN = " + ".join(f"CASE WHEN risk_score >= {e} THEN 1 ELSE 0 END" for e in S.SCORE_BIN_EDGES)
SHIFT = f"""wk AS (SELECT DATE '1970-01-01' + CAST(FLOOR(epoch(ts) / 604800) * 7 AS INTEGER) AS window_start,
                 CASE WHEN risk_score IS NULL THEN {S.UNSCORED_BIN} ELSE {_BIN} END AS bin
          FROM req WHERE ts IS NOT NULL),
wa AS (SELECT window_start, COUNT(*) FILTER (WHERE bin < 0) AS n_unscored FROM wk GROUP BY 1),
wc AS (SELECT window_start, bin, COUNT(*) AS c FROM wk WHERE bin >= 0 GROUP BY 1, 2),
rh AS (SELECT ({_BIN}) AS bin, COUNT(*) AS r FROM scored WHERE AS_OF < DATE '{DRIFT_CUTOFF.isoformat()}' GROUP BY 1),
bins AS (SELECT CAST(range AS INTEGER) AS bin FROM range(0, 10)),
dense AS (SELECT w.window_start, b.bin FROM (SELECT DISTINCT window_start FROM wc) w CROSS JOIN bins b),
jj AS (SELECT dense.window_start, dense.bin, COALESCE(wc.c, 0) AS c, COALESCE(rh.r, 0) AS r
       FROM dense LEFT JOIN wc USING (window_start, bin) LEFT JOIN rh USING (bin)),
tt AS (SELECT window_start, SUM(c) AS nc FROM jj GROUP BY 1),
nr AS (SELECT SUM(r) AS nr FROM rh),
wpsi AS (SELECT jj.window_start, MAX(tt.nc) AS n_requests,
                SUM(((CAST(c AS DOUBLE) / tt.nc + {d(1e-6)}) - (CAST(r AS DOUBLE) / nr.nr + {d(1e-6)}))
                    * LN((CAST(c AS DOUBLE) / tt.nc + {d(1e-6)}) / (CAST(r AS DOUBLE) / nr.nr + {d(1e-6)}))) AS psi
         FROM jj JOIN tt USING (window_start) CROSS JOIN nr WHERE c > 0 OR r > 0 GROUP BY jj.window_start)"""


@register("stream_score_shift", sql(*ALL, O.clean_cte(), O.feat_cte(), O.scored_cte(), ROUTED, SHIFT, body="""
SELECT window_start, COALESCE(CAST(n_requests AS BIGINT), 0) AS n_requests, CAST(n_unscored AS BIGINT) AS n_unscored,
       ROUND(psi, 4) AS psi, ROUND(psi, 4) > 0.2 AS shifted
FROM wa LEFT JOIN wpsi USING (window_start)"""))
def q_stream_score_shift(spark, sf):
    return S.stream_score_shift(spark, sf)


ROLL = SHIFT + f""",
roll AS (SELECT ts, CASE WHEN risk_score IS NULL THEN {S.UNSCORED_BIN} ELSE {_BIN} END AS bin FROM req
         WHERE ts IS NOT NULL ORDER BY ts DESC, event_id DESC LIMIT {S.WINDOW}),
rb AS (SELECT b.bin, (SELECT COUNT(*) FROM roll WHERE roll.bin = b.bin) AS c, COALESCE(rh.r, 0) AS r
       FROM bins b LEFT JOIN rh USING (bin)),
rn AS (SELECT SUM(c) AS nc, SUM(r) AS nr FROM rb),
rp AS (SELECT SUM(((CAST(c AS DOUBLE) / nc + {d(1e-6)}) - (CAST(r AS DOUBLE) / nr + {d(1e-6)}))
                  * LN((CAST(c AS DOUBLE) / nc + {d(1e-6)}) / (CAST(r AS DOUBLE) / nr + {d(1e-6)}))) AS psi
       FROM rb CROSS JOIN rn WHERE c > 0 OR r > 0)"""


@register("stream_rolling_window", sql(*ALL, O.clean_cte(), O.feat_cte(), O.scored_cte(), ROUTED, ROLL, body="""
SELECT MIN(ts) AS first_ts, MAX(ts) AS last_ts, COUNT(*) FILTER (WHERE bin >= 0) AS n_requests,
       COUNT(*) FILTER (WHERE bin < 0) AS n_unscored, ROUND(MAX(rp.psi), 4) AS psi, ROUND(MAX(rp.psi), 4) > 0.2 AS shifted
FROM roll CROSS JOIN rp"""))
def q_stream_rolling_window(spark, sf):
    out = S.stream_rolling_window(spark, sf)
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_ts", "last_ts")})
