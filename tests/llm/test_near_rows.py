"""Near-equal documents: rows without an id or with a shared one, and every list path."""
from collections import Counter

import numpy as np
import pytest

from ledgerscope.llm import jaccard_join


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n))


def test_ids_shared_and_missing(spark):
    base, other = prose(1, 90), prose(2, 70)
    rows = [(5, base), (5, other), (6, base + " more"), (None, base + " word"), (None, other), (None, prose(3, 40)),
            (None, prose(3, 40)), (9, None), (None, None), (9, ""), (4, prose(4, 3)), (8, prose(4, 3))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.near_groups(docs).collect())
    assert got == Counter({(5, 86, 5): 1, (5, 66, 5): 1, (6, 87, 5): 1, (None, 87, 5): 1, (None, 66, 5): 1, (None, 36, None): 2,
                           (9, 0, 9): 2, (None, 0, None): 1, (4, 1, 4): 1, (8, 1, 4): 1})


@pytest.mark.parametrize("bound", [None, 3, 400])
def test_chains_equal_brute_force(spark, bound, monkeypatch):
    """Groups whose members link only by chains, with frequent (salted) tokens, in small pieces."""
    monkeypatch.setattr(jaccard_join, "PIECE", 5)
    monkeypatch.setattr(jaccard_join, "FREQUENT_LEAST", 6)
    rng = np.random.default_rng(9)
    texts = []
    for g in range(4):
        w = prose(100 + g, 80 + 40 * g).split(" ")
        for k in range(30):
            w = list(w)
            at = int(rng.integers(0, len(w) - 4))
            w[at:at + 2] = [f"g{g}k{k}", "x"]
            texts.append(" ".join(w))
    texts += [texts[3], texts[40], texts[40], prose(55, 60), prose(56, 2), prose(56, 2) + " z"]
    rows = [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts, strict=True)]
    sets = {i: frozenset(tuple(t.split(" ")[k:k + 5]) for k in range(max(1, len(t.split(" ")) - 4))) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_groups(docs, bound=bound).collect()}
    assert got == {i: (len(sets[i]), find(i)) for i in sets}


def test_pairs_of_a_group_of_near_copies(spark, monkeypatch):
    """Versions of one text, half of which link with none: pairs grow with the documents only."""
    monkeypatch.setattr(jaccard_join, "DEALT", 50, raising=False)
    base, texts = prose(70, 150).split(" "), []
    rng = np.random.default_rng(71)
    for k in range(240):
        w = list(base)
        where = np.arange(76, 146, 6) if k % 2 else np.arange(4, 74, 6)
        for at in rng.choice(where, 2 if k % 2 else 4, replace=False).tolist():
            w[at] = f"d{k}w{at}"
        texts.append(" ".join(w))
    sets = [frozenset(tuple(t.split(" ")[k:k + 5]) for k in range(146)) for t in texts]
    root = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    seen, possible = [], jaccard_join.possible

    def counted(pairs, wide, scratch):
        seen.append(pairs.count())
        return possible(pairs, wide, scratch)
    monkeypatch.setattr(jaccard_join, "possible", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.near_groups(docs).collect()}
    assert got == dict(enumerate(root))
    assert len(set(root)) > 60
    assert sum(seen) <= 12 * len(texts), seen


def test_long_lists_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LONG", 3)
    monkeypatch.setattr(jaccard_join, "DEALT", 4)
    test_chains_equal_brute_force(spark, None, monkeypatch)
