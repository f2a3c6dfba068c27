import os
import sys
import tempfile

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerscope.schema import EXPECTED_COLUMNS, INT_COLS, raw_schema  # noqa: E402
from ledgerscope.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 8, extra={
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="ls-test-ckpt-"),
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="ls-test-wh-")})
    yield s
    s.stop()


def make_raw(n=200, seed=42, with_id=True):
    """Labelled credit rows shaped like the original test fixture (seeded)."""
    rng = np.random.default_rng(seed)
    limit = rng.integers(10_000, 200_001, size=n).astype(float)
    pay = rng.choice([-1, 0, 1, 2], size=(n, 6), p=[0.4, 0.4, 0.1, 0.1])
    rows = []
    for i in range(n):
        r = {"ID": i + 1} if with_id else {}
        r.update({"LIMIT_BAL": float(limit[i]), "SEX": int(rng.choice([1, 2])),
                  "EDUCATION": int(rng.choice([1, 2, 3, 4])), "MARRIAGE": int(rng.choice([1, 2, 3])),
                  "AGE": int(rng.integers(21, 65))})
        for j, c in enumerate(["PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6"]):
            r[c] = int(pay[i, j])
        for j in range(1, 7):
            r[f"BILL_AMT{j}"] = float(int(limit[i] * rng.uniform(0.05, 0.85)))
            r[f"PAY_AMT{j}"] = float(rng.integers(0, 3001))
        late = (pay[i] > 0).any()
        r["default_payment_next_month"] = int(rng.random() < 0.05 + 0.2 * late)
        rows.append(r)
    return rows


@pytest.fixture(scope="session")
def raw_df(spark):
    return spark.createDataFrame(make_raw(), raw_schema(True, True))


SAMPLE_RECORD = {
    "LIMIT_BAL": 80000.0, "SEX": 2, "EDUCATION": 2, "MARRIAGE": 1, "AGE": 30,
    "PAY_0": 0, "PAY_2": 0, "PAY_3": 0, "PAY_4": 0, "PAY_5": 0, "PAY_6": 0,
    "BILL_AMT1": 20000.0, "BILL_AMT2": 18000.0, "BILL_AMT3": 16000.0,
    "BILL_AMT4": 14000.0, "BILL_AMT5": 12000.0, "BILL_AMT6": 10000.0,
    "PAY_AMT1": 3000.0, "PAY_AMT2": 2500.0, "PAY_AMT3": 2000.0,
    "PAY_AMT4": 1800.0, "PAY_AMT5": 1600.0, "PAY_AMT6": 1400.0,
}
