"""Structured Streaming versions of scoring and monitoring.

The request stream is the driver's ``events`` table (user_id = customer key, ts =
request time) read with ``readStream``. A stream-static left join by key finds the
customer's latest snapshot, so every request leaves once: scored, or quarantined with
a reason (no customer key, no snapshot, or what the record check found in it).

* T1 ``stream_score`` / ``stream_quarantine``: stateless, append.
* T2 ``stream_band_counts``: watermark 1 hour, tumbling 1-day windows x band; requests
  without a score count as band ``Unscored``.
* T3 ``stream_score_shift``: tumbling 7-day windows x 10 fixed score bins against the
  static reference histogram as one PSI per window; unscored requests are counted beside.

Each micro-batch writes the folder ``epoch=N`` of its output in overwrite mode, so a
batch that is run again replaces its own rows. With a ``work`` folder a restarted query
resumes from the checkpoint in it; without one every call starts anew.

* Z4 ``stream_rolling_window``: the last WINDOW requests, kept in rings that are state.

T2/T3 use ``update`` output: a batch writes the windows it changed, a reader takes the
last epoch of each window, and state of windows older than the watermark is dropped with
rows that arrive later than that. Requests without a time are in T1 only.
"""

from __future__ import annotations

import heapq
import uuid
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscope.operators.quality import check_records
from ledgerscope.operators.scoring import demo_predictor, score_frame
from ledgerscope.session import checkpoint_dir, stored
from ledgerscope.sources import credit as src
from ledgerscope.schema import PSI_EPS

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])

SCORE_BIN_EDGES = [10, 20, 30, 40, 50, 60, 70, 80, 90]   # fixed edges on the 0-100 scale
UNSCORED = "Unscored"
UNSCORED_BIN = -1
SCORED_COLS = ["event_id", "ts", "user_id", "snapshot_id", "default_probability", "risk_score", "risk_band"]


def _work_dir(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/stream-{name}-{uuid.uuid4().hex}"


def event_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int | None = None) -> DataFrame:
    """The events table as a file stream; NTZ timestamps are cast to TIMESTAMP so
    that watermarks apply (session zone UTC)."""
    # the source folder holds every table; only the events file belongs to the stream
    s = spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", "events*.parquet")
    if files_per_trigger:
        s = s.option("maxFilesPerTrigger", files_per_trigger)
    return s.parquet(sf_dir.rstrip("/")).select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")


_VERSIONS: dict[tuple[str, str, str], DataFrame] = {}


def scored_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static side: latest snapshot per customer, checked, and scored by the fixed model;
    ``problem`` holds what the record check rejects. Derived and stored once for each state
    of the source files; micro-batches join the stored version."""
    key = (spark.sparkContext.applicationId, sf_dir, src.version(spark, sf_dir))
    if key not in _VERSIONS:
        latest = check_records(src.latest_snapshot(spark, sf_dir))
        _VERSIONS[key] = stored(score_frame(latest, demo_predictor).select(
            "CUSTOMER_ID", "ID", "default_probability", "risk_score", "risk_band",
            F.when(~F.col("valid"), F.array_join("errors", "; ")).alias("problem")), "customers")
    return _VERSIONS[key]


def route_requests(events: DataFrame, customers: DataFrame) -> DataFrame:
    """Every request once; ``reason`` is NULL for those scored, and the score columns
    are NULL for the others. Stateless stream-static left join on the customer key."""
    j = events.join(customers, events.user_id == customers.CUSTOMER_ID, "left")
    reason = (F.when(F.col("user_id").isNull(), F.lit("no customer key"))
              .when(F.col("CUSTOMER_ID").isNull(), F.lit("no snapshot"))
              .otherwise(F.col("problem")))
    scores = [F.when(reason.isNull(), F.col(c)).alias(c) for c in ("default_probability", "risk_score", "risk_band")]
    return j.select("event_id", "ts", "user_id", F.col("ID").alias("snapshot_id"), *scores, reason.alias("reason"))


def score_requests(events: DataFrame, customers: DataFrame) -> DataFrame:
    """The requests that get a score."""
    return route_requests(events, customers).where(F.col("reason").isNull()).select(*SCORED_COLS)


def run_epochs(query_df: DataFrame, work: str, mode: str, shape=lambda batch: batch) -> DataFrame:
    """Run over what is there, each batch into its own folder; the written rows with ``epoch``."""
    def write(batch: DataFrame, epoch: int) -> None:
        shape(batch).write.mode("overwrite").parquet(f"{work}/out/epoch={epoch}")

    spark = query_df.sparkSession
    (query_df.writeStream.outputMode(mode).option("checkpointLocation", f"{work}/checkpoint")
     .foreachBatch(write).trigger(availableNow=True).start().awaitTermination())
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{work}/out")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):     # nothing has arrived yet
        return spark.createDataFrame([], shape(query_df).schema).withColumn("epoch", F.lit(0))
    return spark.read.parquet(f"{work}/out")


def _routed(spark: SparkSession, sf_dir: str, files_per_trigger: int | None = None) -> DataFrame:
    return route_requests(event_stream(spark, sf_dir, files_per_trigger), scored_customers(spark, sf_dir))


def stream_route(spark: SparkSession, sf_dir: str, work: str | None = None) -> DataFrame:
    """Every request, scored or with a reason, as a batch DataFrame of the written result."""
    return run_epochs(_routed(spark, sf_dir), work or _work_dir(spark, "route"), "append").drop("epoch")


def stream_score(spark: SparkSession, sf_dir: str, work: str | None = None) -> DataFrame:
    """The scored requests."""
    return stream_route(spark, sf_dir, work).where(F.col("reason").isNull()).select(*SCORED_COLS)


def stream_quarantine(spark: SparkSession, sf_dir: str, work: str | None = None) -> DataFrame:
    """The requests without a score, with the reason."""
    return (stream_route(spark, sf_dir, work).where(F.col("reason").isNotNull())
            .select("event_id", "ts", "user_id", "snapshot_id", "reason"))


def last_epoch(written: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Of each key, the values of its last epoch."""
    best = F.max_by(F.struct(*values), F.col("epoch"))
    return written.groupBy(*keys).agg(best.alias("v")).select(*keys, "v.*")


def band_counts(routed: DataFrame, window: str = "1 day", watermark: str = "1 hour") -> DataFrame:
    return (routed.withWatermark("ts", watermark)
            .groupBy(F.window("ts", window).alias("w"),
                     F.coalesce("risk_band", F.lit(UNSCORED)).alias("risk_band"))
            .agg(F.count(F.lit(1)).alias("n_requests")))


def stream_band_counts(spark: SparkSession, sf_dir: str, work: str | None = None,
                       files_per_trigger: int | None = None) -> DataFrame:
    """Requests per day and band (watermark 1 hour, update output)."""
    agg = band_counts(_routed(spark, sf_dir, files_per_trigger))
    written = run_epochs(agg, work or _work_dir(spark, "bands"), "update", lambda b: b.select(
        F.to_date(F.col("w.start")).alias("window_start"), "risk_band", "n_requests"))
    return last_epoch(written, ["window_start", "risk_band"], ["n_requests"])


def score_bin(score: F.Column) -> F.Column:
    """Bin on the fixed 0-100 scale: number of inner edges <= score (0..9)."""
    return sum(F.when(score >= e, 1).otherwise(0) for e in SCORE_BIN_EDGES)


def reference_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static reference: score-bin counts of reference-period snapshots."""
    ref = score_frame(src.credit_reference(spark, sf_dir), demo_predictor)
    return ref.groupBy(score_bin(F.col("risk_score")).alias("bin")).agg(F.count(F.lit(1)).alias("r"))


def window_psi(window_counts: DataFrame, ref_hist: DataFrame, eps: float = PSI_EPS) -> DataFrame:
    """PSI per window from (window_start, bin, c) and (bin, r); bins absent on both
    sides contribute 0. Inputs are small aggregates (windows x 10 rows, 10 rows)."""
    spark = window_counts.sparkSession
    ref10 = (spark.range(10).select(F.col("id").cast("int").alias("bin"))
             .join(ref_hist, "bin", "left").fillna(0, ["r"])
             .withColumn("nr", F.sum("r").over(Window.partitionBy())))   # 10 rows
    wins = window_counts.select("window_start").distinct()
    dense = wins.select("window_start", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("bin"))
    j = (dense.join(window_counts, ["window_start", "bin"], "left").fillna(0, ["c"])
         .join(F.broadcast(ref10), "bin", "inner"))
    j = j.withColumn("nc", F.sum("c").over(Window.partitionBy("window_start")))
    j = j.where((F.col("c") > 0) | (F.col("r") > 0))
    cp = F.try_divide(F.col("c").cast("double"), F.col("nc")) + F.lit(eps)
    rp = F.try_divide(F.col("r").cast("double"), F.col("nr")) + F.lit(eps)
    return j.groupBy("window_start").agg(F.sum((cp - rp) * F.log(cp / rp)).alias("psi"),
                                         F.first("nc").alias("n_requests"))


def stream_score_shift(spark: SparkSession, sf_dir: str, work: str | None = None,
                       files_per_trigger: int | None = None) -> DataFrame:
    """Weekly score-distribution PSI against the reference period. ``n_requests``
    counts the scored requests; a week with none has a NULL psi and flag."""
    score = F.col("risk_score")
    agg = (_routed(spark, sf_dir, files_per_trigger).withWatermark("ts", "1 hour")
           .groupBy(F.window("ts", "7 days").alias("w"),
                    F.when(score.isNull(), UNSCORED_BIN).otherwise(score_bin(score)).alias("bin"))
           .agg(F.count(F.lit(1)).alias("c")))
    written = run_epochs(agg, work or _work_dir(spark, "shift"), "update", lambda b: b.select(
        F.to_date(F.col("w.start")).alias("window_start"), "bin", "c"))
    counts = last_epoch(written, ["window_start", "bin"], ["c"])
    unscored = counts.groupBy("window_start").agg(
        F.sum(F.when(F.col("bin") == UNSCORED_BIN, F.col("c")).otherwise(0)).alias("n_unscored"))
    psi = window_psi(counts.where(F.col("bin") != UNSCORED_BIN), reference_histogram(spark, sf_dir))
    return unscored.join(psi, "window_start", "left").select(
        "window_start", F.coalesce("n_requests", F.lit(0)).cast("bigint").alias("n_requests"), "n_unscored",
        F.round("psi", 4).alias("psi"), (F.round("psi", 4) > 0.2).alias("shifted"))


# ------------------------------------------------------------------ Z4 rolling window
WINDOW = 1000             # requests in the rolling window
RINGS = 16                # the stream is dealt to so many rings, each with its own state
RING_STATE = "at array<long>, id array<long>, bin array<int>"
RING_ROW = "ring int, at long, id long, bin int"


class Ring:
    """The last ``size`` requests by (time, id), whatever the order they come in. Arrivals push
    out the oldest; counts per bin follow each arrival and departure."""

    def __init__(self, size: int, rows: list[tuple[int, int, int]]):
        self.size, self.heap, self.counts = size, list(rows), Counter(r[2] for r in rows)
        heapq.heapify(self.heap)

    def add(self, row: tuple[int, int, int]) -> bool:
        if len(self.heap) < self.size:
            heapq.heappush(self.heap, row)
        else:
            gone = heapq.heappushpop(self.heap, row)
            if gone == row:
                return False                        # older than all that is kept
            self.counts[gone[2]] -= 1
        self.counts[row[2]] += 1
        return True


def rolling_rings(routed: DataFrame, size: int = WINDOW, rings: int = RINGS) -> DataFrame:
    """Arbitrary stateful streaming: requests with a time are dealt to ``rings`` keys by their
    id; a key's state is its ring of at most ``size`` requests. A batch that changes a ring
    puts it out whole. The last ``size`` of all requests are among the rings' last ``size``,
    so no key ever holds more, and no task sees more than its share of a batch."""
    score = F.col("risk_score")
    rows = routed.where("ts is not null").select(
        F.pmod(F.xxhash64("event_id", "user_id"), F.lit(rings)).cast("int").alias("ring"),
        F.unix_micros("ts").alias("at"), F.coalesce("event_id", F.lit(-2 ** 63)).alias("id"),
        F.when(score.isNull(), UNSCORED_BIN).otherwise(score_bin(score)).cast("int").alias("bin"))

    def step(key, frames, state):
        ring = Ring(size, list(zip(*state.get, strict=True)) if state.exists else [])
        changed = False
        for pdf in frames:
            for row in zip(pdf["at"].tolist(), pdf["id"].tolist(), pdf["bin"].tolist(), strict=True):
                changed |= ring.add(row)
        if changed:
            at, ids, bins = (list(c) for c in zip(*sorted(ring.heap), strict=True))
            state.update((at, ids, bins))
            yield pd.DataFrame({"ring": key[0], "at": at, "id": ids, "bin": bins})
    return rows.groupBy("ring").applyInPandasWithState(step, RING_ROW, RING_STATE, "update", "NoTimeout")


def window_of_rings(written: DataFrame, size: int = WINDOW) -> DataFrame:
    """The last ``size`` requests: the last epoch of every ring, at most rings x size rows."""
    last = written.groupBy("ring").agg(F.max("epoch").alias("epoch"))
    return (written.join(F.broadcast(last), ["ring", "epoch"]).orderBy(F.desc("at"), F.desc("id")).limit(size)
            .select("at", "id", "bin"))


def stream_rolling_window(spark: SparkSession, sf_dir: str, work: str | None = None,
                          files_per_trigger: int | None = None, size: int = WINDOW) -> DataFrame:
    """One row: the window's first and last time, its requests with and without a score,
    and the PSI of its score bins against the reference period."""
    written = run_epochs(rolling_rings(_routed(spark, sf_dir, files_per_trigger), size), work or _work_dir(spark, "rolling"), "update")
    kept = window_of_rings(written, size)
    counts = kept.where(F.col("bin") != UNSCORED_BIN).groupBy("bin").agg(F.count(F.lit(1)).alias("c"))
    psi = window_psi(counts.withColumn("window_start", F.lit(0)), reference_histogram(spark, sf_dir)).select("psi")
    ends = kept.agg(F.timestamp_micros(F.min("at")).alias("first_ts"), F.timestamp_micros(F.max("at")).alias("last_ts"),
                    F.count_if(F.col("bin") != UNSCORED_BIN).alias("n_requests"), F.count_if(F.col("bin") == UNSCORED_BIN).alias("n_unscored"))
    # one row each
    return ends.join(psi, F.lit(True), "left").select(
        "first_ts", "last_ts", "n_requests", "n_unscored", F.round("psi", 4).alias("psi"), (F.round("psi", 4) > 0.2).alias("shifted"))


__all__ = ["stream_route", "stream_score", "stream_quarantine", "stream_band_counts", "stream_score_shift",
           "stream_rolling_window", "rolling_rings", "window_of_rings",
           "event_stream", "route_requests", "score_requests", "band_counts", "window_psi"]
