"""Streaming equals batch; every registered query equals its SQL oracle (sf0.001)."""
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(rows, cols, order):
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _names():
    from ledgerscope.plans.queries import oracle_sql
    return sorted(oracle_sql())


@pytest.mark.parametrize("name", _names())
def test_query_matches_sql(spark, duck, name):
    from ledgerscope.plans.queries import oracle_sql, queries
    sdf, rel = queries()[name](spark, SF), duck.sql(oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    want = _rows(rel.fetchall(), rel.columns, [rel.columns.index(c) for c in sdf.columns])
    assert _rows(sdf.collect(), sdf.columns, range(len(sdf.columns))) == want


def test_every_table_query_has_sql():
    assert len(_names()) >= 73


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    rows = entry.entry(spark).collect()
    assert [r.risk_band for r in sorted(rows, key=lambda r: r.band_order)] == ["Low", "Medium", "High"]


def test_stream_score_equals_batch(spark):
    from ledgerscope.streaming import scoring as S
    from ledgerscope.sources import credit as src
    streamed = S.stream_score(spark, SF)
    batch = S.score_requests(src.request_events(spark, SF), S.scored_customers(spark, SF))
    cols = ["event_id", "snapshot_id", "risk_score"]
    assert sorted(streamed.select(cols).collect()) == sorted(batch.select(cols).collect())


def test_every_request_is_scored_or_quarantined(spark):
    from ledgerscope.streaming import scoring as S
    from ledgerscope.sources.tables import table
    n = table(spark, SF, "events").count()
    routed = S.stream_route(spark, SF).cache()
    assert routed.count() == n
    scored, held = routed.where("reason IS NULL"), routed.where("reason IS NOT NULL")
    assert scored.count() > 0 and held.count() > 0
    assert scored.where("risk_score IS NULL").count() == 0
    assert held.where("risk_score IS NOT NULL OR risk_band IS NOT NULL").count() == 0
    assert S.stream_band_counts(spark, SF).agg(F.sum("n_requests")).first()[0] == n


def _event_file(spark, folder, name, rows):
    import pyarrow as pa
    import pyarrow.parquet as pq
    cols = list(zip(*rows))
    pq.write_table(pa.table({
        "event_id": pa.array(cols[0], pa.int64()), "ts": pa.array(cols[1], pa.timestamp("us")),
        "user_id": pa.array(cols[2], pa.int64()), "event_type": pa.array(["view"] * len(rows)),
        "value": pa.array([0.0] * len(rows)), "props": pa.array([""] * len(rows))}), f"{folder}/{name}")


def test_late_requests_are_dropped_and_a_restart_resumes(spark, tmp_path):
    import datetime as dt
    from ledgerscope.streaming import scoring as S
    events, work = tmp_path / "in", str(tmp_path / "work")
    events.mkdir()
    customers = spark.createDataFrame([(1, 10, 0.2, 20, "Low", None), (2, 11, None, None, None, "absent")],
                                      "CUSTOMER_ID long, ID long, default_probability double, risk_score int, "
                                      "risk_band string, problem string")

    def run():
        routed = S.route_requests(S.event_stream(spark, str(events)), customers)
        written = S.run_epochs(S.band_counts(routed), work, "update", lambda b: b.select(
            F.to_date(F.col("w.start")).alias("day"), "risk_band", "n_requests"))
        return written, {(str(r.day), r.risk_band): r.n_requests
                         for r in S.last_epoch(written, ["day", "risk_band"], ["n_requests"]).collect()}

    _event_file(spark, events, "events-1.parquet", [(1, dt.datetime(2020, 1, 1, 12), 1), (2, dt.datetime(2020, 1, 6, 12), 2),
                                                    (3, dt.datetime(2020, 1, 6, 13), 9)])
    _, first = run()
    assert first == {("2020-01-01", "Low"): 1, ("2020-01-06", S.UNSCORED): 2}
    # a restart from the same folder: the late row of 1 January goes, the window still open grows
    _event_file(spark, events, "events-2.parquet", [(4, dt.datetime(2020, 1, 1, 13), 1), (5, dt.datetime(2020, 1, 6, 14), 1),
                                                    (6, dt.datetime(2020, 1, 6, 15), None)])
    written, second = run()
    assert second == {("2020-01-01", "Low"): 1, ("2020-01-06", S.UNSCORED): 3, ("2020-01-06", "Low"): 1}
    epochs = written.select("epoch").distinct().count()
    assert run()[1] == second and run()[0].select("epoch").distinct().count() == epochs   # nothing new: nothing counted twice


def test_rolling_window_equals_a_sort_and_survives_restarts(spark, tmp_path):
    import datetime as dt

    import numpy as np
    from ledgerscope.streaming import scoring as S
    events, work = tmp_path / "in", str(tmp_path / "work")
    events.mkdir()
    customers = spark.createDataFrame([(i, i, i / 10, 10 * i, "Low", "gone" if i == 7 else None) for i in range(10)],
                                      "CUSTOMER_ID long, ID long, default_probability double, risk_score int, "
                                      "risk_band string, problem string")
    rng, seen = np.random.default_rng(4), []
    for part in range(4):
        # times overlap between files, so rows arrive out of order; some tie, some have no time
        rows = [(int(1000 * part + i), None if i % 17 == 0 else dt.datetime(2020, 1, 1) + dt.timedelta(seconds=int(rng.integers(0, 40) + 10 * part)),
                 int(rng.integers(0, 11))) for i in range(60)]
        seen += [r for r in rows if r[1] is not None]
        _event_file(spark, events, f"events-{part}.parquet", rows)
        routed = S.route_requests(S.event_stream(spark, str(events)), customers)
        written = S.run_epochs(S.rolling_rings(routed, size=25, rings=4), work, "update")      # a restart each time
        got = [(r.id, r.bin) for r in S.window_of_rings(written, 25).collect()]
        last = sorted(seen, key=lambda r: (r[1], r[0]), reverse=True)[:25]
        assert sorted(got) == sorted((r[0], S.UNSCORED_BIN if r[2] in (7, 10) else min(9, r[2])) for r in last)


def test_ring_counts_follow_arrivals():
    from collections import Counter

    import numpy as np
    from ledgerscope.streaming import scoring as S
    rng, ring, rows = np.random.default_rng(2), S.Ring(20, []), []
    for i in range(300):
        rows.append((int(rng.integers(50)), i, int(rng.integers(-1, 4))))
        ring.add(rows[-1])
        kept = sorted(rows)[-20:]
        assert sorted(ring.heap) == kept and +ring.counts == Counter(r[2] for r in kept)


def test_stream_over_an_empty_folder(spark, tmp_path):
    from ledgerscope.streaming import scoring as S
    (tmp_path / "in").mkdir()
    customers = spark.createDataFrame([], "CUSTOMER_ID long, ID long, default_probability double, risk_score int, risk_band string, problem string")
    routed = S.route_requests(S.event_stream(spark, str(tmp_path / "in")), customers)
    got = S.run_epochs(routed, str(tmp_path / "work"), "append")
    assert got.count() == 0 and "reason" in got.columns


def test_scored_customers_are_derived_once(spark):
    from ledgerscope.streaming import scoring as S
    assert S.scored_customers(spark, SF) is S.scored_customers(spark, SF)
