"""Operator 11: toxic spans and document toxicity by a linear-chain conditional random field.

Every word of a text is tagged clean or toxic. A word's potential is the sum of hashed
weights of the word, its prefixes, suffixes and length; tags of neighbours are coupled by a
learned transition matrix. Labels exist for documents only, so words are labelled from them:
all words of clean documents are clean; a word of a toxic document is toxic if it stands in
several toxic documents and far more often there than in clean ones, clean if it also stands
in clean documents, and else open: training sums over both tags of open words. The gradient
is the difference of two forward-backward passes, with and without the labels.

Scoring: exact marginals of whole texts. With two tags one step of the chain is a Moebius map
of the odds, so forward and backward passes are scans: maps are composed inside chunks, all
chunks at once, and carried from chunk to chunk. A document's score is a logistic function of
the odds of its most toxic word and of the expected number of toxic words, fitted on labelled
documents that the chain was not trained on. Runs of words with a marginal of 0.5 or more are
the offending spans, as code point offsets in the text.

Scale: fitting takes a sample of at most ``docs_per_class`` different texts of either label,
of at most ``fit_chars`` characters each (least hash of the text first), in one task. Scoring
covers all rows and whole texts and holds BLOCK bytes of text and their words at a time:
longer texts are cut between words and the chain is carried across the cuts.

Results: null and empty texts and texts without a letter have no spans and the score of a
text without any toxic word; without labelled rows of both labels every score is the share
of label 1 (0 without any); label rows that repeat a doc_id count once each; a label that is
null or without a document teaches nothing; documents with a null doc_id are scored and not
held out; repeated rows repeat their result; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerscope.llm import _text as X
from ledgerscope.llm._shared import ship

DIM = 1 << 18
BLOCK = 1 << 20
CHUNK = 256
WINDOW = 16               # words of a training chain
#: bytes of words: letters and everything beyond ASCII
LETTERS = X.class_table([(0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])
PREFIXES, SUFFIXES = range(3, 9), range(3, 6)
FLOOR = 1e-9              # least odds of a document's most toxic word
MIN_DOCS, LIFT = 3, 8.0   # a toxic word: in so many toxic documents, and so many times more often than in clean ones


# ------------------------------------------------------------------ words
def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and Latin letters, byte for byte at the same place."""
    out = X.LOWER[data]
    if len(data) > 1:
        b = data[1:]
        out[1:][(data[:-1] == 0xC3) & (b >= 0x80) & (b <= 0x9E) & (b != 0x97)] += 0x20
    return out


def features(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """(words, features) of feature ids below DIM; DIM where a word is too short for one."""
    size = end - start
    first = np.concatenate([[0], np.cumsum(size)])
    own = data[np.repeat(start - first[:-1], size) + np.arange(first[-1])]       # the words alone
    s, lo, hi = X.prefix_hash(own), first[:-1], first[1:]
    cols = [np.full(len(size), 0, np.uint64), X.span_hash(s, lo, hi), np.minimum(size, 24).astype(np.uint64) + X.U(1)]
    short = [np.zeros(len(size), bool)] * 3
    for g in PREFIXES:
        cols.append(X.span_hash(s, lo, np.minimum(lo + g, hi)))
        short.append(size < g)
    for g in SUFFIXES:
        cols.append(X.span_hash(s, np.maximum(hi - g, lo), hi))
        short.append(size < g)
    ids = np.stack([X.mix(c + X.STEP[k]) % X.U(DIM) for k, c in enumerate(cols)], 1).astype(np.int64)
    ids[np.stack(short, 1)] = DIM
    return ids


# ------------------------------------------------------------------ the chain
def scan(m: np.ndarray, x: float) -> np.ndarray:
    """x after each of the Moebius maps m (4 x n: a, b, c, d of (a x + b) / (c x + d)), one after the other."""
    n = m.shape[1]
    if not n:
        return np.zeros(0)
    chunks = -(-n // CHUNK)
    pad = np.zeros((4, chunks * CHUNK))
    pad[0], pad[3] = 1, 1
    pad[:, :n] = m
    pad = pad.reshape(4, chunks, CHUNK)
    a, b, c, d = pad[:, :, 0]
    for t in range(1, CHUNK):                       # compose inside all chunks at once
        e, f, g, h = pad[:, :, t]
        a, b, c, d = e * a + f * c, e * b + f * d, g * a + h * c, g * b + h * d
        top = np.maximum(np.maximum(a, b), np.maximum(c, d))
        a, b, c, d = a / top, b / top, c / top, d / top
    begin = np.empty(chunks)
    for k, (p, q, r, s) in enumerate(zip(a.tolist(), b.tolist(), c.tolist(), d.tolist(), strict=True)):
        begin[k] = x
        x = (p * x + q) / (r * x + s)
    out = np.empty((chunks, CHUNK))
    for t in range(CHUNK):
        e, f, g, h = pad[:, :, t]
        begin = (e * begin + f) / (g * begin + h)
        out[:, t] = begin
    return out.ravel()[:n]


def forward_maps(e: np.ndarray, opens: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Maps of the odds (toxic to clean) of prefixes; ``opens``: first words of texts."""
    m = np.stack([e * trans[1, 1], e * trans[0, 1], np.full(len(e), trans[1, 0]), np.full(len(e), trans[0, 0])])
    m[:, opens] = np.stack([np.zeros(opens.sum()), e[opens], np.zeros(opens.sum()), np.ones(opens.sum())])
    return m


def backward_maps(e: np.ndarray, closes: np.ndarray, after: float, trans: np.ndarray) -> np.ndarray:
    """Maps of the odds of suffixes, last word first; ``closes``: last words of texts;
    ``after``: odds of the word that follows the last one."""
    nxt = np.append(e[1:], after)
    m = np.stack([nxt * trans[1, 1], np.full(len(e), trans[1, 0]), nxt * trans[0, 1], np.full(len(e), trans[0, 0])])
    m[:, closes] = np.array([0.0, 1.0, 0.0, 1.0])[:, None]
    return m[:, ::-1]


def marginals(e: np.ndarray, first: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Probability of the toxic tag for each word; ``first``: words before each text, and all."""
    has = np.diff(first) > 0
    opens, closes = np.zeros(len(e), bool), np.zeros(len(e), bool)
    opens[first[:-1][has]] = True
    closes[first[1:][has] - 1] = True
    f = scan(forward_maps(e, opens, trans), 1.0)
    b = scan(backward_maps(e, closes, 1.0, trans), 1.0)[::-1]
    return f * b / (1 + f * b)


# ------------------------------------------------------------------ fitting
def window_marginals(pot: np.ndarray, held: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(marginals (chains, words, 2), summed pair marginals (2, 2)) of padded chains.

    pot: (chains, words, 2) potentials, 0 for a forbidden tag; held: words that are there.
    """
    n, length, _ = pot.shape
    alpha, beta = np.zeros_like(pot), np.ones_like(pot)
    alpha[:, 0] = pot[:, 0] / pot[:, 0].sum(1, keepdims=True)
    for t in range(1, length):
        a = (alpha[:, t - 1] @ trans) * pot[:, t]
        alpha[:, t] = np.where(held[:, t, None], a / np.maximum(a.sum(1, keepdims=True), 1e-300), 0)
    for t in range(length - 2, -1, -1):
        b = (pot[:, t + 1] * beta[:, t + 1]) @ trans.T
        beta[:, t] = np.where(held[:, t + 1, None], b / np.maximum(b.sum(1, keepdims=True), 1e-300), 1)
    p = alpha * beta
    p = np.where(held[:, :, None], p / np.maximum(p.sum(2, keepdims=True), 1e-300), 0)
    pair = alpha[:, :-1, :, None] * trans * (pot[:, 1:] * beta[:, 1:])[:, :, None, :]
    pair /= np.maximum(pair.sum((2, 3), keepdims=True), 1e-300)
    return p, (pair * held[:, 1:, None, None]).sum((0, 1))


def word_labels(word: np.ndarray, doc: np.ndarray, toxic: np.ndarray, n_words: int) -> np.ndarray:
    """For each word: 1 toxic, 0 clean, -1 open (as it counts in toxic documents)."""
    pairs = np.unique(word.astype(np.int64) * len(toxic) + doc)
    bad = toxic[pairs % len(toxic)]
    t = np.bincount(pairs[bad] // len(toxic), minlength=n_words)
    c = np.bincount(pairs[~bad] // len(toxic), minlength=n_words)
    nt, nc = max(1, toxic.sum()), max(1, (~toxic).sum())
    out = np.where(c > 0, 0, -1)
    out[(t >= MIN_DOCS) & (t / nt >= LIFT * (c + 0.5) / nc)] = 1
    return out


def fit_rows(texts: list[str], toxic: list[bool], epochs: int = 8, rate: float = 0.3, decay: float = 1e-5, seed: int = 11) -> bytes:
    """Weights, transitions and the document's logistic function, as one blob."""
    toxic, rng = np.array(toxic, bool), np.random.default_rng(seed)
    data, offsets, _ = X.column(pa.array(texts, pa.large_string()))
    data = lowered(data)
    start, end, row = X.words(data, offsets, LETTERS)
    h = X.word_hashes(data, start, end)
    keys, example, word = np.unique(h, return_index=True, return_inverse=True)
    ids = np.concatenate([np.zeros((0, 3 + len(PREFIXES) + len(SUFFIXES)), np.int64)]
                         + [features(data, start[example[i:i + 20_000]], end[example[i:i + 20_000]]) for i in range(0, len(example), 20_000)])
    doc = np.repeat(np.arange(len(toxic)), np.diff(row))
    # every fifth document of either label is kept for the document's logistic function
    turn = np.zeros(len(toxic), np.int64)
    for label in (False, True):
        turn[toxic == label] = rng.permutation((toxic == label).sum())
    learn = turn % 5 != 0
    use = learn[doc]
    tag = word_labels(word[use], doc[use], toxic, len(keys))
    target = np.where(toxic[doc], tag[word], 0)
    # windows of consecutive words of one text
    at = [(a, min(a + WINDOW, row[d + 1])) for d in np.flatnonzero(learn) for a in range(row[d], row[d + 1], WINDOW)]
    at = np.array(at, np.int64).reshape(-1, 2)
    w, trans = np.zeros(DIM + 1), np.array([[2.0, -2.0], [0.0, 0.0]])
    w[features(np.array([97], np.uint8), np.array([0]), np.array([1]))[0, 0]] = -4.0     # the bias
    gw, gt = np.full(DIM + 1, 1e-2), np.full((2, 2), 1e-2)
    grid = np.arange(WINDOW)
    for _ in range(epochs):
        order = rng.permutation(len(at))
        for lo in range(0, len(order), 2048):
            a = at[order[lo:lo + 2048]]
            held = grid < (a[:, 1] - a[:, 0])[:, None]
            pos = np.where(held, a[:, :1] + grid, a[:, :1])
            feats = ids[word[pos]]                                  # (chains, words, features)
            e = np.exp(np.clip(w[feats].sum(2), -30, 30))
            pot = np.stack([np.ones_like(e), e], 2) * held[:, :, None]
            free, free_pair = window_marginals(pot, held, np.exp(trans))
            y = target[pos]
            bound = pot * np.stack([y != 1, y != 0], 2)
            post, pair = window_marginals(bound, held, np.exp(trans))
            g_word = (free[:, :, 1] - post[:, :, 1])[held]
            flat = feats[held]
            g = np.bincount(flat.ravel(), np.repeat(g_word, flat.shape[1]), DIM + 1)
            hit = np.flatnonzero(g)
            g = g[hit] + decay * len(a) * w[hit]
            gw[hit] += g ** 2
            w[hit] -= rate * g / np.sqrt(gw[hit])
            w[DIM] = 0.0
            g_t = free_pair - pair
            gt += g_t ** 2
            trans = np.clip(trans - rate * g_t / np.sqrt(gt), -8, 8)
    model = {"w": w.astype(np.float32), "trans": np.exp(trans)}
    rest = np.flatnonzero(~learn)
    e = np.exp(np.clip(model["w"][ids].sum(1), -30, 30))[word].astype(float) if len(word) else np.zeros(0)
    p = marginals(e, row, model["trans"])
    most, total = summed(p, row)
    model["logistic"] = logistic(document_features(most[rest], total[rest]), toxic[rest])
    return pickle.dumps(model)


def summed(p: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(greatest, sum) of the words' probabilities for each text."""
    most, total = np.zeros(len(row) - 1), np.zeros(len(row) - 1)
    has = np.flatnonzero(np.diff(row) > 0)
    if len(has):
        most[has] = np.maximum.reduceat(p, row[has])
        total[has] = np.add.reduceat(p, row[has])
    return most, total


def document_features(most: np.ndarray, total: np.ndarray) -> np.ndarray:
    most = np.clip(most, FLOOR, 1 - FLOOR)
    return np.stack([np.ones(len(most)), np.log(most / (1 - most)), np.log1p(np.maximum(total - most, 0))], 1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights by Newton steps; the last two never fall below 0."""
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (p - y) + ridge * b
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b))
        step = np.linalg.solve(hess, g)
        b = b - step / max(1.0, np.abs(step).max())
        b[1:] = np.maximum(b[1:], 0)
    return b


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, docs_per_class: int,
           fit_chars: int) -> DataFrame:
    """(text, toxic): at most docs_per_class different texts of either label, chosen by hash of the text."""
    rated = labels.select(F.col(id_col).alias("i"), (F.col(label_col) == 1).alias("toxic")).filter("toxic is not null and i is not null").distinct()
    t = F.col(text_col)
    narrow = docs.filter(t.isNotNull() & (F.length(t) <= fit_chars)).select(F.col(id_col).alias("i"), F.xxhash64(t).alias("h"))
    narrow = narrow.join(rated, "i")
    n = {r["toxic"]: r["n"] for r in narrow.groupBy("toxic").agg(F.approx_count_distinct("h").alias("n")).collect()}
    share = F.lit(0.0)
    for toxic, many in n.items():
        share = F.when(F.col("toxic") == toxic, min(1.0, 1.2 * docs_per_class / max(1, many))).otherwise(share)
    unit = (F.xxhash64("h").cast("double") / (2.0 ** 63) + 1) / 2
    one = narrow.filter(unit < share).groupBy("toxic", "h").agg(F.min("i").alias("i"))
    one = one.orderBy(F.xxhash64("h"), "toxic").limit(3 * docs_per_class).select("i", "h", "toxic")
    # the bound is the limit above: 3 * docs_per_class rows
    return (docs.select(F.col(id_col).alias("i"), t.alias("text"), F.xxhash64(t).alias("h"))
            .join(F.broadcast(one), ["i", "h"]).select("h", "text", "toxic").distinct())


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        docs_per_class: int = 4000, fit_chars: int = 50_000) -> bytes | None:
    """A model of the labelled documents; None without labelled texts of both labels."""
    ship(docs.sparkSession)

    def one_task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([*frames, pd.DataFrame(columns=["h", "text", "toxic"])]).sort_values(["h", "toxic"])
        rows = rows.groupby("toxic", sort=True).head(docs_per_class)
        if rows["toxic"].nunique() == 2:
            yield pd.DataFrame({"model": [fit_rows(rows["text"].tolist(), rows["toxic"].tolist())]})
    rows = sample(docs, labels, id_col, text_col, label_col, docs_per_class, fit_chars)
    got = rows.repartition(1).mapInPandas(one_task, "model binary").collect()
    return bytes(got[0]["model"]) if got else None


# ------------------------------------------------------------------ scoring
class Tagger:
    """A fitted model on a worker; potentials of words are kept in a table of fixed size."""

    SLOTS = 1 << 19

    def __init__(self, blob: bytes):
        model = pickle.loads(blob)
        self.w, self.trans, self.b = model["w"], model["trans"], model["logistic"]
        self.keys = np.zeros(self.SLOTS, np.uint64)
        self.held = np.zeros(self.SLOTS, np.float64)

    def potentials(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = X.word_hashes(data, start, end) | X.U(1)
        slot = (h >> X.U(1)) & X.U(self.SLOTS - 1)
        out, known = self.held[slot], self.keys[slot] == h
        miss = np.flatnonzero(~known)
        if len(miss):
            _, example, back = np.unique(h[miss], return_index=True, return_inverse=True)
            example = miss[example]
            new = np.concatenate([np.exp(np.clip(self.w[features(data, start[p], end[p])].sum(1), -30, 30))
                                  for p in np.split(example, range(20_000, len(example), 20_000))]).astype(np.float64)
            out[miss] = new[back]
            self.keys[slot[example]], self.held[slot[example]] = h[example], new
        return out

    def score(self, most: np.ndarray, total: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(document_features(most, total) @ self.b, -30, 30)))

    def texts(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, list]]:
        """(first row, last row, scores, spans) of the blocks of a text column."""
        for i, j, raw, offsets, _ in X.blocks(column, BLOCK):
            if j - i == 1 and len(raw) > BLOCK:
                yield i, j, *self.long_text(raw)
                continue
            data = lowered(raw)
            start, end, first = X.words(data, offsets, LETTERS)
            p = marginals(self.potentials(data, start, end), first, self.trans)
            most, total = summed(p, first)
            spans = [[] for _ in range(j - i)]
            a, b, prob = runs(p, first)
            rows = np.searchsorted(first, a, "right") - 1
            at = points(raw, offsets[rows], start[a], end[b])
            for r, s, t, x in zip(rows.tolist(), at[0].tolist(), at[1].tolist(), prob.tolist(), strict=True):
                spans[r].append({"start": s, "end": t, "prob": x})
            yield i, j, self.score(most, total), spans

    def long_text(self, raw: np.ndarray) -> tuple[np.ndarray, list]:
        """One text longer than a block, cut between words; the chain runs across the cuts."""
        cuts = [0]
        while cuts[-1] < len(raw):
            cuts.append(self.cut(raw, cuts[-1]))

        def part(k: int):
            data = lowered(raw[cuts[k]:cuts[k + 1]])
            start, end, _ = X.words(data, np.array([0, len(data)]), LETTERS)
            return start, end, self.potentials(data, start, end)
        # backward: the odds of what follows each part
        after, odds, nxt = [None] * (len(cuts) - 1), None, None
        for k in range(len(cuts) - 2, -1, -1):
            after[k] = (odds, nxt)
            _, _, e = part(k)
            if len(e):
                odds, nxt = self.back(e, odds, nxt)[-1], e[0]
        before, most, total, spans, chars, last = None, 0.0, 0.0, [], 0, None
        for k in range(len(cuts) - 1):
            start, end, e = part(k)
            if len(e):
                opens = np.zeros(len(e), bool)
                opens[0] = before is None
                f = scan(forward_maps(e, opens, self.trans), 1.0 if before is None else before)
                b = self.back(e, *after[k])[::-1]
                p, before = f * b / (1 + f * b), f[-1]
                most, total = max(most, float(p.max())), total + float(p.sum())
                a, z, prob = runs(p, np.array([0, len(p)]))
                at = points(raw[cuts[k]:cuts[k + 1]], np.zeros(len(a), np.int64), start[a], end[z])
                for q, (s, t, x) in enumerate(zip((at[0] + chars).tolist(), (at[1] + chars).tolist(), prob.tolist(), strict=True)):
                    if q == 0 and a[0] == 0 and last is not None:      # a run across the cut
                        spans[-1] |= {"end": t, "prob": max(spans[-1]["prob"], x)}
                    else:
                        spans.append({"start": s, "end": t, "prob": x})
                last = True if len(z) and z[-1] == len(p) - 1 else None
            chars += int((raw[cuts[k]:cuts[k + 1]] & 0xC0 != 0x80).sum())
        return self.score(np.array([most]), np.array([total])), [spans]

    def back(self, e: np.ndarray, odds: float | None, nxt: float | None) -> np.ndarray:
        closes = np.zeros(len(e), bool)
        closes[-1] = odds is None
        return scan(backward_maps(e, closes, 1.0 if nxt is None else nxt, self.trans), 1.0 if odds is None else odds)

    @staticmethod
    def cut(raw: np.ndarray, lo: int) -> int:
        """The end of a part of about BLOCK bytes: behind a byte that is in no word, if there is one."""
        hi = min(lo + BLOCK, len(raw))
        while hi < len(raw):
            out = np.flatnonzero(~LETTERS[raw[lo:hi]])
            if len(out):
                return lo + int(out[-1]) + 1
            hi = min(hi + BLOCK, len(raw))             # one word fills the part: it stays whole
        return hi


def runs(p: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, last word, greatest marginal) of runs of words with p >= 0.5 inside texts."""
    on = p >= 0.5
    edge = np.zeros(len(p) + 1, bool)
    edge[first] = True
    a = np.flatnonzero(on & (edge[:-1] | ~np.concatenate([[False], on[:-1]])))
    z = np.flatnonzero(on & (edge[1:] | ~np.concatenate([on[1:], [False]])))
    prob = np.array([p[s:t + 1].max() for s, t in zip(a.tolist(), z.tolist(), strict=True)])
    return a, z, prob


def points(raw: np.ndarray, base: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte places as code points from the text's start (base)."""
    if not len(start):
        return start, end
    count = np.concatenate([[0], np.cumsum(raw & 0xC0 != 0x80)])
    return count[start] - count[base], count[end] - count[base]


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("prob", pa.float64())]))


def predict(docs: DataFrame, blob: bytes | None, id_col: str = "doc_id", text_col: str = "text", base: float = 0.0) -> DataFrame:
    """Per row: id, score, predicted, spans (start, end, prob). ``base``: the score without a model."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(blob)          # DIM weights, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(sent.value) if sent.value is not None else None
        for batch in batches:
            if tagger is None:
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(n, base)), pa.array([[]] * n, SPANS)],
                                                 names=["id", "score", "spans"])
                continue
            for i, j, score, spans in tagger.texts(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(score), pa.array(spans, SPANS)],
                                                 names=["id", "score", "spans"])
        pa.default_memory_pool().release_unused()
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    got = src.mapInArrow(run, "id long, score double, spans array<struct<start:long,end:long,prob:double>>")
    return got.select(F.col("id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, docs_per_class: int = 4000) -> DataFrame:
    """Learn from the labels of rows that are not held out, score every row."""
    docs, labels = docs.select("doc_id", "text"), labels.select("doc_id", "toxic")
    known = labels.filter(~held_out() & F.col("toxic").isNotNull())
    blob = fit(docs, known, docs_per_class=docs_per_class)
    base = 0.0
    if blob is None:
        base = known.agg(F.coalesce(F.avg((F.col("toxic") == 1).cast("double")), F.lit(0.0))).first()[0]
    return predict(docs, blob, base=base).withColumn("held_out", held_out())
