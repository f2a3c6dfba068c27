"""Operator 5: language identification with a linear-chain conditional random field.

Every word is a position of the chain and gets a label by forward-backward. Emission
weights belong to hashed features of the word: its character n-grams (1 to 4 bytes, with
borders), affixes (2 to 5 bytes) and the word itself (lexicon); transitions between labels
are learned too. Training chains join pieces of differently labelled documents, so the
chain learns switches inside a text. A document's language has the greatest mean posterior
over its words, which is the score.

Fitting uses a bounded sample: at most ``docs_per_lang`` labelled documents of each
language (least hash of the id first), in one task; prediction covers all rows and whole
texts, block by block, in bounded memory (BLOCK bytes of text and its words at a time; a
longer single text by itself).

Results: null text and text without a letter give ``und`` with score 0, as does every
text when there is no labelled row; repeated rows repeat their result; ties go to the
first label in alphabetical order; very long texts are one chain.
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

DIM = 1 << 16
BLOCK = 3 << 20
#: bytes of words: letters and everything beyond ASCII
LETTERS = X.class_table([(0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])
UND = "und"


# ------------------------------------------------------------------ words and features
def lowered(array: pa.Array) -> pa.Array:
    import pyarrow.compute as pc
    return pc.utf8_lower(array.cast(pa.large_string()))


def word_features(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature ids of all words one after the other, first feature of each word)."""
    n = len(start)
    size = end - start + 2                                # with a border on either side
    first = np.concatenate([[0], np.cumsum(size)])
    padded = np.full(first[-1], 1, np.uint8)
    owner = np.repeat(np.arange(n), size)
    k = np.arange(first[-1]) - first[owner]
    inner = (k > 0) & (k < size[owner] - 1)
    padded[inner] = data[start[owner[inner]] + k[inner] - 1]
    s = X.prefix_hash(padded)
    at = np.arange(first[-1])
    got, whose = [], []
    for g in range(1, 5):                                 # n-grams
        ok = at + g <= first[owner + 1]
        if g == 1:
            ok &= inner
        got.append(X.span_hash(s, at[ok], at[ok] + g))
        whose.append(owner[ok])
    ids = np.arange(n)
    for g in range(2, 6):                                 # affixes
        ok = size - 2 >= g
        lo, hi = first[:-1][ok] + 1, first[1:][ok] - 1
        got.append(X.mix(X.span_hash(s, lo, lo + g) + X.STEP[40]))
        got.append(X.mix(X.span_hash(s, hi - g, hi) + X.STEP[41]))
        whose += [ids[ok], ids[ok]]
    got.append(X.mix(X.span_hash(s, first[:-1], first[1:]) + X.STEP[42]))     # lexicon
    whose.append(ids)
    whose, got = np.concatenate(whose), np.concatenate(got)
    order = np.argsort(whose, kind="stable")
    return (got[order] % X.U(DIM)).astype(np.int64), np.searchsorted(whose[order], np.arange(n + 1))


def emissions(weights: np.ndarray, feats: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Summed weights of each word's features, scaled by the root of their number."""
    if len(first) < 2:
        return np.zeros((0, weights.shape[1]), np.float32)
    return np.add.reduceat(weights[feats], first[:-1], axis=0) / np.sqrt(np.diff(first))[:, None]


# ------------------------------------------------------------------ the chain
def forward_backward(e: np.ndarray, trans: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(alpha, beta), each position scaled to sum 1, of chains laid one after the other.

    e: exp of the emissions; trans: exp of the transitions; first: start of each chain.
    One step handles the same position of all chains that are long enough.
    """
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    start, size = first[:-1][order], size[order]
    longest = int(size[0]) if len(size) else 0
    alive = np.searchsorted(-size, -np.arange(1, longest + 2), "right")    # chains longer than t
    alpha, beta = np.empty_like(e), np.ones_like(e)
    if longest:
        i = start[:alive[0]]
        alpha[i] = e[i] / e[i].sum(1, keepdims=True)
    for t in range(1, longest):
        i = start[:alive[t]] + t
        a = (alpha[i - 1] @ trans) * e[i]
        alpha[i] = a / a.sum(1, keepdims=True)
    for t in range(longest - 2, -1, -1):
        i = start[:alive[t + 1]] + t
        b = (e[i + 1] * beta[i + 1]) @ trans.T
        beta[i] = b / b.sum(1, keepdims=True)
    return alpha, beta


def posteriors(scores: np.ndarray, trans: np.ndarray, first: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(1, keepdims=True)).astype(np.float32) + np.float32(1e-12)
    alpha, beta = forward_backward(e, np.exp(trans).astype(np.float32), first)
    p = alpha * beta
    return p / p.sum(1, keepdims=True)


# ------------------------------------------------------------------ fitting
def fit_rows(texts: list[str], langs: list[str], piece: int = 12, epochs: int = 3, rate: float = 0.4,
             seed: int = 7) -> bytes:
    """Weights and transitions by AdaGrad on the chain's log-likelihood."""
    labels = sorted(set(langs))
    k, rng = len(labels), np.random.default_rng(seed)
    data, offsets, _ = X.column(lowered(pa.array(texts, pa.string())))
    start, end, row = X.words(data, offsets, LETTERS)
    h = X.word_hashes(data, start, end)
    _, example, word = np.unique(h, return_index=True, return_inverse=True)
    feats, ffirst = [], [np.zeros(1, np.int64)]
    for lo in range(0, len(example), 20_000):
        part = example[lo:lo + 20_000]
        f, ff = word_features(data, start[part], end[part])
        feats.append(f.astype(np.int32))
        ffirst.append(ff[1:] + ffirst[-1][-1])
    feats, ffirst = np.concatenate([*feats, np.zeros(0, np.int32)]), np.concatenate(ffirst)
    y_doc = np.array([labels.index(x) for x in langs])
    # pieces of consecutive words of one document
    size = np.diff(row)
    pieces = [(a, min(a + piece, row[d + 1]), y_doc[d]) for d in range(len(size)) for a in range(row[d], row[d + 1], piece)]
    pieces = np.array(pieces, np.int64).reshape(-1, 3)
    w, tr = np.zeros((DIM, k), np.float32), np.zeros((k, k), np.float32)
    gw, gt = np.full((DIM, k), 1e-3, np.float32), np.full((k, k), 1e-3, np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(pieces))
        for at in range(0, len(order), 1536):
            p = pieces[order[at:at + 1536]]
            n = p[:, 1] - p[:, 0]
            idx = np.repeat(p[:, 0] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            y = np.repeat(p[:, 2], n)
            first = np.concatenate([[0], np.cumsum(n)])[::3]      # three pieces are one chain
            if first[-1] != n.sum():
                first = np.append(first, n.sum())
            used, local = np.unique(word[idx], return_inverse=True)
            fs = np.concatenate([feats[ffirst[u]:ffirst[u + 1]] for u in used])
            ff = np.concatenate([[0], np.cumsum(ffirst[used + 1] - ffirst[used])])
            scores = emissions(w, fs, ff)[local]
            e = np.exp(scores - scores.max(1, keepdims=True)) + 1e-12
            t = np.exp(tr)
            alpha, beta = forward_backward(e.astype(np.float32), t, first)
            post = alpha * beta
            post /= post.sum(1, keepdims=True)
            inner = np.ones(len(y), bool)
            inner[first[:-1]] = False
            i = np.flatnonzero(inner)
            pair = alpha[i - 1][:, :, None] * t[None] * (e[i] * beta[i])[:, None, :]
            pair /= pair.sum((1, 2), keepdims=True)
            g_t = pair.sum(0)
            np.subtract.at(g_t, (y[i - 1], y[i]), 1)
            post[np.arange(len(y)), y] -= 1
            g_word = np.stack([np.bincount(local, post[:, c], len(used)) for c in range(k)], 1)
            nf = np.diff(ff)
            g_feat = np.repeat(g_word / np.sqrt(nf)[:, None], nf, 0)
            hit, where = np.unique(fs, return_inverse=True)
            g = np.stack([np.bincount(where, g_feat[:, c], len(hit)) for c in range(k)], 1)
            gw[hit] += g ** 2
            w[hit] -= (rate * g / np.sqrt(gw[hit])).astype(np.float32)
            gt += (g_t ** 2).astype(np.float32)
            tr -= (rate * g_t / np.sqrt(gt)).astype(np.float32)
    return pickle.dumps((labels, w, tr))


def fit(train: DataFrame, id_col: str, text_col: str, lang_col: str, docs_per_lang: int) -> bytes | None:
    """Fit on at most ``docs_per_lang`` rows of each language of ``train``."""
    ship(train.sparkSession)
    src = train.select(F.xxhash64(id_col, F.lit(5)).alias("o"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")) \
        .filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in src.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    # a share of each language by hash, then the exact bound
    share = F.lit(1.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, 1.2 * docs_per_lang / n)).otherwise(share)
    unit = (F.col("o").cast("double") / (2.0 ** 63) + 1) / 2
    sample = src.filter(unit < share).orderBy("o").limit(int(1.2 * docs_per_lang) * len(counts))

    def one_task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([*frames, pd.DataFrame(columns=["o", "text", "lang"])]).sort_values(["o", "text"])
        rows = rows.groupby("lang", sort=True).head(docs_per_lang)
        if len(rows):
            yield pd.DataFrame({"model": [fit_rows(rows["text"].tolist(), rows["lang"].tolist())]})
    got = sample.repartition(1).mapInPandas(one_task, "model binary").collect()
    return bytes(got[0]["model"]) if got else None


# ------------------------------------------------------------------ prediction
class Labeller:
    """A fitted model on a worker; emissions of words seen before are kept (bounded)."""

    KEEP = 300_000

    def __init__(self, blob: bytes):
        self.labels, self.w, self.trans = pickle.loads(blob)
        self.keys, self.rows = np.zeros(0, np.uint64), np.zeros((0, len(self.labels)), np.float32)

    def scores(self, data, start, end) -> np.ndarray:
        h = X.word_hashes(data, start, end)
        uniq, example, word = np.unique(h, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, uniq)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == uniq[known]
        out = np.empty((len(uniq), len(self.labels)), np.float32)
        out[known] = self.rows[at[known]]
        new = np.flatnonzero(~known)
        for lo in range(0, len(new), 20_000):
            part = new[lo:lo + 20_000]
            out[part] = emissions(self.w, *word_features(data, start[example[part]], end[example[part]]))
        if len(new):
            if len(self.keys) + len(new) > self.KEEP:
                self.keys, self.rows = uniq[:self.KEEP], out[:self.KEEP]
            else:
                keys = np.concatenate([self.keys, uniq[new]])
                order = np.argsort(keys)
                self.keys, self.rows = keys[order], np.concatenate([self.rows, out[new]])[order]
        return out[word]


def labelled(lab: "Labeller | None", column: pa.Array, spans: bool):
    """(first row, last row, language, score, words, runs) for the blocks of a text column."""
    text = lowered(column)
    for i, j, data, offsets, _ in X.blocks(text, BLOCK):
        start, end, first = X.words(data, offsets, LETTERS)
        size = np.diff(first)
        ascii_letters = np.concatenate([[0], np.cumsum(LETTERS[data] & (data < 128))])
        letter = ascii_letters[offsets[1:]] > ascii_letters[offsets[:-1]]
        for r in np.flatnonzero(~letter & (size > 0)).tolist():
            letter[r] = any(map(str.isalpha, text[i + r].as_py()))
        pred, score, runs = [UND] * (j - i), np.zeros(j - i), [[] if spans else None] * (j - i)
        if lab is not None and len(start):
            p = posteriors(lab.scores(data, start, end), lab.trans, first)
            rows = np.flatnonzero(size > 0)
            mean = np.add.reduceat(p.astype(np.float64), first[:-1][rows], axis=0) / size[rows][:, None]
            word_label = p.argmax(1)
            for r, b, m in zip(rows.tolist(), mean.argmax(1).tolist(), mean.max(1).tolist(), strict=True):
                if not letter[r]:
                    continue
                pred[r], score[r] = lab.labels[b], min(1.0, m)
                if spans:
                    w = word_label[first[r]:first[r + 1]]
                    cut = np.concatenate([[0], np.flatnonzero(np.diff(w)) + 1, [len(w)]]).tolist()
                    runs[r] = [{"lang": lab.labels[w[a]], "first": a, "n": b2 - a} for a, b2 in zip(cut, cut[1:])]
        yield i, j, pred, score, size, runs


def predict(docs: DataFrame, blob: bytes | None, id_col: str = "doc_id", text_col: str = "text",
            spans: bool = True) -> DataFrame:
    """Per row: id, lang_pred, score, n_words and ``runs``: words of one label in a row as
    (lang, first word, number of words); null runs with ``spans=False``."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(blob)       # DIM x labels floats, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lab = Labeller(sent.value) if sent.value is not None else None
        for batch in batches:
            for i, j, pred, score, size, runs in labelled(lab, batch.column(1), spans):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(pred, pa.string()), pa.array(score), pa.array(size),
                     pa.array(runs, RUNS)], names=["id", "lang_pred", "score", "n_words", "runs"])
        X.release()
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "id long, lang_pred string, score double, n_words long, "
                               "runs array<struct<lang:string,first:long,n:long>>").withColumnRenamed("id", id_col)


def accepted(docs: DataFrame, blob: bytes | None, least: float, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text is in a learned language with at least
    this score; no row leaves its task."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(blob)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lab = Labeller(sent.value) if sent.value is not None else None
        for batch in batches:
            for i, j, pred, score, _, _ in labelled(lab, batch.column(0), False):
                part = batch.slice(i, j - i)
                yield part.filter(pa.array([x != UND and y >= least for x, y in zip(pred, score.tolist(), strict=True)], pa.bool_()))
        X.release()
    rest = [c for c in docs.columns if c != text_col]
    src = docs.select(F.col(text_col).cast("string").alias("text"), F.struct(*rest).alias("rest"))
    got = src.mapInArrow(run, f"text string, rest {src.schema['rest'].dataType.simpleString()}")
    return got.select(*[F.col("text").alias(c) if c == text_col else F.col("rest").getField(c).alias(c) for c in docs.columns])


RUNS = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int64()), ("n", pa.int64())]))


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4; remainder 2 is held out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             docs_per_lang: int = 500, spans: bool = True) -> DataFrame:
    """Learn from the labelled rows that are not held out, predict every row."""
    blob = fit(docs.filter(fold(id_col) != 2), id_col, text_col, lang_col, docs_per_lang)
    return predict(docs, blob, id_col, text_col, spans).withColumn(
        "held_out", F.coalesce(fold(id_col) == 2, F.lit(False)))
