"""The Merkle manifest against a tree built in plain Python."""
import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from ledgerscope.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, pos int, row string, grp int, kids string"


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def brute(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[2]].append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    for x in langs:
        by[x].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = [tree([leaf(r) for r in by[x]]) for x in langs]
    top = tree([t[-1][0] for t in trees])
    for g, x in enumerate(langs):
        for i, r in enumerate(by[x]):
            new = r
            if None not in (r[0], r[4]) and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                new = (*r[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4]))
            folded, proof = leaf(new), ""
            for levels, at in ((trees[g], i), (top, g)):
                for nodes in levels[:-1]:
                    run, p = nodes[at // 8 * 8:at // 8 * 8 + 8], at % 8
                    proof += "".join(run[:p] + run[p + 1:])
                    folded, at = h("".join(run[:p]) + folded + "".join(run[p + 1:])), at // 8
            root = top[-1][0]
            yield r[0], leaf(r), trees[g][-1][0], root, h(proof), folded, folded == root


def mixed():
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(60)]), "s", rng.choice(["en", "fr", None, "é", "Z"]), i,
             rng.choice([None, "", "Aé B", str(i)])) for i in range(100)]
    return rows + [(7, "s", "en", 1, "Q")] * 3 + [(9, None, "only", 1, "Q" * 300_000)]


CASES = {
    "empty": [],
    "one": [(1, "a", "en", 3, "ABC")],
    "one_each": [(3, "a", None, None, None), (4, None, "en", 2, "Bé")],
    "mixed": mixed(),
    "many_languages": [(i, "s", f"l{i % 70}", i, f"T{i}") for i in range(300)],
    "one_language": [(i, "s", "en", i, f"T{i}") for i in range(65)],
}


@pytest.mark.parametrize("name", CASES)
def test_merkle(spark, name, monkeypatch):
    monkeypatch.setattr(merkle, "PIECE_ROWS", 30)
    df = spark.createDataFrame([(*r, 1, "x", 3, "k") for r in CASES[name]], SCHEMA).repartition(3)
    got = merkle.prove(df)
    assert got.dtypes == [("doc_id", "bigint"), ("leaf", "string"), ("subroot", "string"), ("root", "string"),
                          ("proof_sha256", "string"), ("folded_root", "string"), ("verified", "boolean")]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute(CASES[name])))


def test_setting_is_put_back(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    merkle.prove(spark.createDataFrame([(*r, 1, "x", 3, "k") for r in CASES["one_language"]], SCHEMA)).count()
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before
