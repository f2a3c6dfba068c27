"""Rows without a doc_id, or that share one, are documents of their own."""
import hashlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from ledgerscope.llm import decontaminate, suffix_dedup


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n))


@pytest.mark.parametrize("limit", [10_000, 1])
def test_repeats_by_row(spark, limit):
    passage = prose(0, 60)
    texts = [(None, prose(1, 20) + " " + passage + " " + prose(2, 30)), (None, prose(3, 35) + " " + passage), (None, prose(4, 200)),
             (7, prose(5, 150)), (7, prose(6, 10) + " " + passage), (8, passage[:250] + prose(7, 50)), (None, "short"), (None, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    raw = [(i, (t or "").encode()) for i, t in texts]
    seen = Counter(b[k:k + 200] for _, b in raw for k in range(len(b) - 199))
    want, left = Counter(), Counter()
    for (i, b), (_, t) in zip(raw, texts, strict=True):
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 199):
            if seen[b[k:k + 200]] > 1:
                gone[k:k + 200] = True
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        want[i, len(b), int(gone.sum()), hashlib.sha256(kept).hexdigest()] += 1
        left[i, None if t is None else kept.decode()] += 1
    spans = suffix_dedup.repeated_spans(docs, group_limit=limit)
    got = suffix_dedup.digest(docs, spans).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["kept_sha256"]) for r in got) == want
    cut = suffix_dedup.without_repeats(docs, spans).collect()
    assert Counter((r["doc_id"], r["text"]) for r in cut) == left


def test_hits_by_row(spark, tmp_path):
    quote = prose(10, 20)
    texts = [(None, prose(11, 30) + " " + quote), (None, prose(12, 40)), (None, prose(13, 5) + " " + quote), (None, None),
             (2**62 + 1, quote), (5, prose(14, 30)), (6, prose(16, 9) + " " + prose(15, 15))]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame([(1, quote), (None, quote), (None, prose(15, 15)), (None, None), (2, prose(17, 20))], "item_id long, text string")
    got = decontaminate.decontaminate(docs, items).collect()
    want = Counter([(None, 50, 20, 2), (None, 40, 0, 0), (None, 25, 20, 2), (None, 0, 0, 0), (2**62 + 1, 20, 20, 2), (5, 30, 0, 0), (6, 24, 15, 1)])
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], len(r["item_ids"])) for r in got) == want
    assert {tuple(r["item_ids"]) for r in got} == {(), (1, None), (None,)}
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    full = docs.selectExpr("doc_id", "text", "'en' as lang", "'s' as source", "length(text) as n_chars")
    left = corpus_pipeline.benchmarks(spark, full, str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["text"]) for r in left) == Counter([texts[1], texts[3], texts[5]])


def test_near_copies_by_row(spark, tmp_path):
    a, b, c = prose(20, 80), prose(21, 80), prose(22, 80)
    texts = [(None, a), (9, a + " x"), (4, a), (4, a), (None, b), (None, b + " y"), (None, c), (3, prose(23, 50)), (None, None), (None, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3) \
        .selectExpr("doc_id", "text", "'en' as lang", "'s' as source", "length(text) as n_chars")
    left = Counter((r["doc_id"], (r["text"] or "")[:300]) for r in corpus_pipeline.near_copies(spark, docs, str(tmp_path)).collect())
    assert left == Counter([(4, a[:300]), (4, a[:300]), (None, b[:300]), (None, c[:300]), (3, prose(23, 50)[:300]), (None, ""), (None, "")])
