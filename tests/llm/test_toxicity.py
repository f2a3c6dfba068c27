"""The toxicity chain against enumeration of all taggings, and its query against held-out labels."""
import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerscope.llm import toxicity_crf as t

RNG = np.random.default_rng(3)
TRANS = np.array([[3.0, 0.4], [0.7, 1.9]])


def enumerated(e, allowed=None):
    """(marginals of tag 1, pair sums, partition) of one chain by all taggings."""
    n, p, pair, z = len(e), np.zeros(len(e)), np.zeros((2, 2)), 0.0
    for y in itertools.product((0, 1), repeat=n):
        if allowed is not None and any(a not in (-1, b) for a, b in zip(allowed, y)):
            continue
        s = np.prod([e[i] if y[i] else 1.0 for i in range(n)]) * np.prod([TRANS[a, b] for a, b in zip(y, y[1:])])
        z += s
        p += s * np.array(y)
        for a, b in zip(y, y[1:]):
            pair[a, b] += s
    return p / z, pair / z, z


def test_marginals(monkeypatch):
    monkeypatch.setattr(t, "CHUNK", 4)
    sizes = [0, 1, 5, 0, 9, 3, 0]
    e = [np.exp(RNG.normal(0, 2, n)) for n in sizes]
    got = t.marginals(np.concatenate(e), np.concatenate([[0], np.cumsum(sizes)]), TRANS)
    want = np.concatenate([enumerated(x)[0] if len(x) else x for x in e])
    assert np.allclose(got, want, rtol=1e-10)


def test_window_marginals_with_labels():
    e = np.exp(RNG.normal(0, 1, (2, 6)))
    held = np.array([[True] * 6, [True] * 4 + [False] * 2])
    y = np.array([[0, -1, 1, -1, -1, 0], [-1, 1, -1, -1, 0, 0]])
    pot = np.stack([np.ones_like(e), e], 2) * held[:, :, None]
    for labels, use in ((np.full_like(y, -1), pot), (y, pot * np.stack([y != 1, y != 0], 2))):
        p, pair = t.window_marginals(use, held, TRANS)
        a, b = enumerated(e[0], labels[0]), enumerated(e[1, :4], labels[1, :4])
        assert np.allclose(p[0, :, 1], a[0]) and np.allclose(p[1, :4, 1], b[0]) and not p[1, 4:].any()
        assert np.allclose(pair, a[1] + b[1])


def test_gradient_is_the_difference_of_marginals():
    e, y, h = np.array([0.5, 2.0, 1.2, 0.3]), np.array([-1, 1, -1, 0]), 1e-6
    like = lambda x: np.log(enumerated(x, y)[2]) - np.log(enumerated(x)[2])
    diff = enumerated(e, y)[0] - enumerated(e)[0]
    for i in range(4):
        up, down = e.copy(), e.copy()
        up[i] *= np.exp(h)
        down[i] *= np.exp(-h)
        assert (like(up) - like(down)) / (2 * h) == pytest.approx(diff[i], abs=1e-6)


BAD = ["vile", "scumbag", "réeuxpa"]


def corpus(n=260, seed=5):
    rng = np.random.default_rng(seed)
    vocab = ["".join(rng.choice(list("abcdeéñ"), rng.integers(2, 8))) for _ in range(400)]
    out = []
    for i in range(n):
        words = rng.choice(vocab, rng.integers(5, 60)).tolist()
        toxic = i % 3 == 0
        if toxic:
            for _ in range(rng.integers(1, 4)):
                words.insert(rng.integers(len(words) + 1), str(rng.choice(BAD)))
        out.append((i, " ".join(words).capitalize() + ".", int(toxic)))
    return out


@pytest.fixture(scope="module")
def blob():
    rows = corpus()
    return t.fit_rows([r[1] for r in rows], [r[2] == 1 for r in rows])


def test_held_out_and_spans(blob):
    rows = corpus(120, 77)
    tagger = t.Tagger(blob)
    hits = 0
    for i, j, score, spans in tagger.texts(pa.array([r[1] for r in rows])):
        for r, s, at in zip(rows[i:j], score, spans):
            hits += (s >= 0.5) == (r[2] == 1)
            found = {w.lower() for x in at for w in re.findall(r"\w+", r[1][x["start"]:x["end"]])}
            if r[2]:
                assert found & set(BAD) and found <= set(BAD)
    assert hits >= 0.97 * len(rows)


def test_long_text_is_one_chain(blob, monkeypatch):
    rows = corpus(200, 9)
    text = "É " + " ".join(r[1] for r in rows) + " vile scumbag"
    whole = next(t.Tagger(blob).texts(pa.array([text])))
    monkeypatch.setattr(t, "BLOCK", 1500)
    _, _, score, spans = next(t.Tagger(blob).texts(pa.array([text])))
    assert score == pytest.approx(whole[2], rel=1e-9)
    assert [(s["start"], s["end"]) for s in spans[0]] == [(s["start"], s["end"]) for s in whole[3][0]]
    assert [s["prob"] for s in spans[0]] == pytest.approx([s["prob"] for s in whole[3][0]])
    one = "x" * 5000                                   # a word longer than a block
    assert next(t.Tagger(blob).texts(pa.array([one + " vile"])))[3] == [[{"start": 5001, "end": 5005, "prob": pytest.approx(1, abs=0.5)}]]


SCHEMA = "doc_id long, text string, toxic int, spans string, score string, id long"


def test_query(spark):
    rows = [(*r, "s", "x", 1) for r in corpus()]
    odd = [(None, "vile scumbag", 0, "s", "x", 1), (9001, None, 0, "s", "x", 1), (9002, "", 0, "s", "x", 1),
           (9003, " \n123 ...", 0, "s", "x", 1), rows[0], (9004, "calm " * 40_000 + "scumbag", 0, "s", "x", 1)]
    docs = spark.createDataFrame(rows + odd, SCHEMA).repartition(3)
    labels = spark.createDataFrame([(r[0], r[2], 0) for r in rows] + [(0, 1, 0), (70_000, 1, 1), (3, None, 1), (None, 1, 1)],
                                   "doc_id long, toxic int, quality int")
    got = t.toxicity(docs, labels).collect()
    assert len(got) == len(rows) + len(odd)
    by = {}
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        by.setdefault(r["doc_id"], []).append((r["score"], r["predicted"]))
    held = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(by[i][0][1] == (i % 3 == 0) for i in held) >= 0.9 * len(held)
    assert by[9001] == by[9002] == by[9003] and by[9001][0][1] == 0
    assert by[None][0][1] == 1 and by[9004][0][1] == 1 and by[0][0] == by[0][1]


def test_empty_and_unlabelled(spark):
    docs = spark.createDataFrame([(1, "vile", 0, "s", "x", 1)], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [(r["score"], r["predicted"]) for r in t.toxicity(docs, none).collect()] == [(0.0, 0)]
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert [r["score"] for r in t.toxicity(docs, one).collect()] == [1.0]
    assert t.toxicity(docs.filter(F.lit(False)), one).count() == 0
