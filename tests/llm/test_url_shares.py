"""Shares of blocked urls: no labelled url's share holds its own label."""
import numpy as np

from ledgerscope.llm import url_filter


def test_out_of_fold_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), f"s{rng.integers(4)}.org", float(rng.integers(2)), int(rng.integers(url_filter.FOLDS))) for i in range(120)]
    rows.append((120, "alone.org", 1.0, 0))
    fit = spark.createDataFrame(rows, "row long, host_suffix string, y double, fold long").repartition(3)
    got = {r["row"]: r["share"] for r in url_filter.out_of_fold(fit, "host_suffix", "share", 0.4).collect()}
    for row, suffix, _, fold in rows:
        others = [y for _, s, y, f in rows if s == suffix and f != fold]
        assert abs(got[row] - (sum(others) + 4.0) / (len(others) + 10.0)) < 1e-12
    assert abs(got[120] - 0.4) < 1e-12


def test_held_out_urls(spark):
    """Blocked sections have long query strings; unseen hosts are judged by that."""
    rules = [(f"h{k}.org/bad/", "block") for k in range(40)] + [(f"h{k}.org/ok/", "allow") for k in range(40)]
    urls = []
    for k in range(40):
        for j in range(6):
            urls += [f"http://h{k}.org/bad/{j}?a={j}&b=2&c=3&d=4", f"http://h{k}.org/ok/{j}"]
    fresh = [(f"http://new{k}.net/x/{k}?a=1&b=2&c=3&d=4", "block") for k in range(10)] + [(f"http://new{k}.net/x/{k}", "allow") for k in range(10)]
    data = list(enumerate(urls + [u for u, _ in fresh]))
    got = {r["page_id"]: r for r in url_filter.judge(spark.createDataFrame(data, "page_id long, url string"), rules=rules).collect()}
    verdicts = [(got[len(urls) + i]["rule"], got[len(urls) + i]["verdict"]) for i in range(len(fresh))]
    assert verdicts == [(None, v) for _, v in fresh]
