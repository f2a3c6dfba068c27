"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is fully executed with the no-op sink (no driver collect) and timed;
prints ONE JSON line {"metric", "value", "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "credit_table",        # source derivation: lineitem agg + join + skew-safe 5-month lag
    "band_summary",        # flagship batch scoring (clean -> features -> model -> bands)
    "dq_report",           # one-pass validation report
    "model_metrics",       # exact AUC / AP / Brier / threshold metrics for two models
    "threshold_sweep",     # 91-threshold sweep
    "drift_report",        # KS + PSI over 31 features
    "top_drivers",         # scaled linear attribution + top-5 drivers per row
    "describe",            # exact quartiles over 24 columns
    "stream_score",        # Structured Streaming stream-static scoring
]


def main() -> None:
    from ledgerscope.plans.queries import queries
    from ledgerscope.session import build_session
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", int(cpus) * 2, app_name="ledgerscope-bench",
                          extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="ls-bench-ckpt-"),
                                 "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    qs = queries()
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
