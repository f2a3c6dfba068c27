"""Small tables with nulls, empty texts, repeated rows, ties and clashing columns: every
operator against a brute-force version, the library it must equal, or its own law."""
import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerscope.llm import (chat_hmm, decontaminate, jaccard_join, langid_crf, line_rules, ordinal_quality,
                             sentencepiece_bpe, sharding, suffix_dedup, url_filter)

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, lo long, key string, spans string"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def rows():
    rng = np.random.default_rng(5)
    vocab = ["".join(rng.choice(list("abcdéñ"), 5)) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(vocab, n))
    base, passage = prose(120), prose(60)
    texts = [None, "", "   \n\t ", "one", "One two THREE four", "🙂 …", base, base, base.upper(), passage]
    for k in range(12):        # near copies, with a few words changed
        w = base.split(" ")
        for i in rng.integers(0, len(w), k // 2):
            w[i] = "x%d" % rng.integers(9)
        texts.append(" ".join(w))
    texts += [prose(40) + " " + passage + "\n" + prose(30) for _ in range(6)]
    texts += [prose(n) for n in (1, 4, 5, 13, 50, 400)] + ["ab " * 3000, "z" * 9000, prose(5000)]
    out = [(i, t, ["en", "fr", None][i % 3], ["a", "b", None][i % 3], None, 7, 8, "k", "s") for i, t in enumerate(texts)]
    return out + [out[6], out[-2]]      # repeated rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def shingles(t):
    w = SPACED.findall(lower(t or ""))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


@pytest.mark.parametrize("bound", [None, 60, 3])
def test_near_groups(docs, bound):
    sets = {r[0]: shingles(r[1]) for r in rows()}
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    got = by_id(jaccard_join.near_groups(docs, bound=bound))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == {i: (len(sets[i]), root[i]) for i in sets}


@pytest.mark.parametrize("limit", [10_000, 1])
def test_suffix_dedup(spark, docs, limit):
    raw = [(r[0], (r[1] or "").encode()) for r in rows()]
    seen = Counter(b[k:k + 200] for _, b in raw for k in range(len(b) - 199))
    got = by_id(suffix_dedup.digest(docs, suffix_dedup.repeated_spans(docs, group_limit=limit)))
    for i, b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - 199):
            if seen[b[k:k + 200]] > 1:
                gone[k:k + 200] = True
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == \
            (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    cut = suffix_dedup.without_repeats(docs, suffix_dedup.repeated_spans(docs))
    assert cut.columns == docs.columns and cut.count() == len(rows())


@pytest.mark.parametrize("budget", [200, 1 << 20])
def test_induced_sorting(budget):
    rng = np.random.default_rng(1)
    for _ in range(200):
        cap = int(rng.integers(2, 8))
        t = np.concatenate([x for _ in range(4) for x in (rng.integers(1, 4, int(rng.integers(1, 40))), [0])]).astype(np.uint16)
        count = Counter(bytes(t[i:i + cap].astype(np.uint8)) for i in range(len(t) - cap + 1))
        got = suffix_dedup.repeated_starts(t, cap, budget)
        for i in range(len(t) - cap + 1):
            piece = bytes(t[i:i + cap].astype(np.uint8))
            if 0 not in piece:
                assert got[i] == (count[piece] > 1)


def test_decontamination(spark, docs):
    texts = {r[0]: r[1] for r in rows()}
    items = [(1, texts[9]), (2, "One two three"), (3, None), (4, ""), (10, texts[9]), (5, " ".join(texts[6].split(" ")[20:45]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    wins = {}
    for i, t in items:
        w = ALNUM.findall(lower(t or ""))
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[k:k + n]), set()).add(i)
    got = by_id(decontaminate.digest(decontaminate.decontaminate(docs, bench)))
    for i, t in texts.items():
        w, hit, found = ALNUM.findall(lower(t or "")), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in wins:
                    hit |= set(range(k, k + n))
                    found |= wins[tuple(w[k:k + n])]
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == \
            (len(w), len(hit), len(found), bool(hit) and 20 * len(hit) >= len(w))
        assert r["items_sha256"] == hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()


def test_bpe_equals_library(docs):
    import public_tokenizers
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    m = sentencepiece_bpe.PieceModel(path)
    rng = np.random.default_rng(2)
    for _ in range(2000):
        t = "".join(rng.choice(list("aabbc  \n\té🙂▁theing0ñ\0<s>/"), int(rng.integers(0, 40))))
        ids = sp.encode(t, add_eos=True)
        assert m.encode(t) == ids and m.decode(ids) == sp.decode(ids)
    got, full = by_id(sentencepiece_bpe.digests(docs, path)), by_id(sentencepiece_bpe.encode_decode(docs, path))
    for r in rows():
        ids = sp.encode(r[1] or "", add_eos=True)
        g = got[r[0]]
        assert g["n_tokens"] == len(ids) and g["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert g["decoded_sha256"] == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
        assert list(full[r[0]]["ids"]) == ids and full[r[0]]["decoded"] == sp.decode(ids)


def test_language_held_out(spark):
    from conftest import SF
    d = spark.read.parquet(SF.replace("0.001", "0.01") + "/documents.parquet")
    got = langid_crf.identify(d, docs_per_lang=100).join(d.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95


def test_forward_backward_is_exact():
    rng = np.random.default_rng(0)
    s, tr = rng.normal(size=(5, 3)), rng.normal(size=(3, 3))
    total, want = 0.0, np.zeros((5, 3))
    for p in np.ndindex(*[3] * 5):
        v = np.exp(sum(s[i, p[i]] for i in range(5)) + sum(tr[p[i], p[i + 1]] for i in range(4)))
        total += v
        for i in range(5):
            want[i, p[i]] += v
    assert np.allclose(langid_crf.posteriors(s, tr, np.array([0, 5])), want / total, atol=1e-5)


def test_language_edges(docs, empty):
    got = by_id(langid_crf.identify(docs))
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (0, 1, 2, 5))
    assert langid_crf.identify(empty).count() == 0


def test_line_rules(docs):
    got = by_id(line_rules.line_quality(docs, min_docs=3))
    for i, t, *_ in rows():
        w = SPACED.findall(t or "")
        lines = [x for x in (t or "").split("\n") if SPACED.search(x)]
        g = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        cover = {k + j for k in range(len(w) - 2) if g[tuple(w[k:k + 3])] > 1 for j in range(3)}
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_dup_lines"], r["n_repeat_words"]) == \
            (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(cover))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(cover) > 50 * len(w))
        assert not (r["kept"] and r["base_failed"])


def test_sharding(docs):
    got = sharding.shard(docs, shards=4).collect()
    assert len(got) == len(rows())
    size = Counter()
    for r in got:
        size[r["shard"]] += r["size"]
    slots = {s: sorted(r["slot"] for r in got if r["shard"] == s) for s in size}
    assert all(v == list(range(len(v))) for v in slots.values())
    largest = max(r["size"] for r in got)
    assert max(size.values()) - min(size.get(s, 0) for s in range(4)) <= 2 * largest


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://A.Example.COM/en/x?p=1", "https://www.example.com/en/", "http://x.com", "ftp://b.net/es/a#f",
            "http://net/fr/", "http://q.org/a-b/1.html"] * 3
    d = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r["page_id"]: r for r in url_filter.judge(d).collect()}
    want = [None, None, None, "example.com/en/", "www.example.com/en/", None, "net/es/", "net/fr/", None]
    assert [got[i]["rule"] for i in range(9)] == want
    assert (got[3]["host"], got[3]["path"], got[3]["verdict"]) == ("a.example.com", "/en/x", "block")
    assert all(r["verdict"] in ("allow", "block") for r in got.values())


def test_ordinal_quality(spark, docs):
    texts = [f"good calm prose number {i} " * 5 for i in range(40)] + [f"poor!! poor!! {i}" for i in range(40)] + [f"a vile idiot {i}" for i in range(40)]
    d = spark.createDataFrame([(i, t, 2 - i // 40) for i, t in enumerate(texts)], "doc_id long, text string, grade int")
    blob = ordinal_quality.fit(d, "doc_id", "text", "grade")
    got = by_id(ordinal_quality.predict(d, blob))
    mean = [np.mean([got[i]["expected_grade"] for i in range(k, k + 40)]) for k in (0, 40, 80)]
    assert mean[0] > mean[1] > mean[2]
    assert ordinal_quality.predict(docs, blob).count() == len(rows())
    assert by_id(ordinal_quality.predict(docs, None))[3]["kept"] is None


def test_chat_pieces(spark):
    rng = np.random.default_rng(4)
    t = [(5, i // 2, ["user", "assistant", None][int(rng.integers(3))], f"User: hi {i}\nmore?" if i % 3 else None) for i in range(60)]
    d = spark.createDataFrame(t + [(None, None, None, "x"), (6, 0, "system", "Assistant: y")], "conv_id long, turn long, role string, text string").coalesce(1)
    whole, cut = chat_hmm.parse(d).collect(), chat_hmm.parse(d, piece_rows=7).collect()
    assert len(whole) == len(cut) == 62

    def key(r):
        return (r["conv_id"] or -1, r["turn"] or -1, r["rendered"])
    assert sum(key(a) != key(b) for a, b in zip(sorted(whole, key=key), sorted(cut, key=key))) <= 6


def test_empty_tables(empty, spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    for df in (jaccard_join.near_groups(empty), suffix_dedup.digest(empty, suffix_dedup.repeated_spans(empty)),
               decontaminate.decontaminate(empty, items), line_rules.line_quality(empty), sharding.shard(empty),
               url_filter.judge(pages), chat_hmm.parse(turns)):
        assert df.count() == 0
