"""Common prefixes of suffixes, packed seven symbols a word, against a plain count."""
import numpy as np
import pytest

from ledgerscope.llm.suffix_dedup import common


@pytest.mark.parametrize("cap", [1, 6, 7, 8, 50, 200])
@pytest.mark.parametrize("top", [1, 2, 256])
def test_common_prefix(cap, top):
    rng = np.random.default_rng(cap)
    t = rng.integers(0, 2, 900).astype(np.uint16) * top
    t[300:600] = t[:300]                    # long common prefixes
    t[700:] = top                           # one run to the end
    t = np.concatenate([t, np.zeros(cap + 8, np.uint16)])
    a, b = rng.integers(0, 900, (2, 600))
    a[:100], b[:100] = np.arange(100), np.arange(300, 400)
    a[100], b[100] = 898, 899
    a, b = a[a != b], b[a != b]
    want = [next((k for k in range(cap) if t[x + k] != t[y + k]), cap) for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    assert common(t, a, b, cap).tolist() == want


def test_no_suffixes():
    none = np.zeros(0, np.int64)
    assert common(np.zeros(30, np.uint16), none, none, 20).tolist() == []
