"""Operator 1: ordinal quality classifier (cumulative links, shared hashed-text weights).

Ratings are grades 0 .. K-1. One weight vector over hashed text features gives a score
eta; ordered thresholds t_0 < t_1 < ... give P(grade <= k) = sigmoid(t_k - eta). From these
come the expected grade and the tail probability P(grade >= g) used for selection.

Features, each present or not: lower-cased words, their first four and five bytes, and the
text's style in steps (share of capitals, of exclamation marks, of repeated words, mean
word length, length). Fitting takes at most ``fit_rows`` rated documents (least hash of
the id first) in one task; prediction covers all rows and whole texts in blocks.

Results: null and wordless texts have style features only; ids without a rating are
predicted like all others; several ratings of one id are all used; without any rating the
grades and ``kept`` are null; repeated rows repeat their result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.llm import _text as X
from ledgerscope.llm._shared import ship

DIM = 1 << 18
FIT_ROWS = 12_000
WORD = X.class_table([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])   # letters, digits, beyond ASCII


def style(data: np.ndarray, offsets: np.ndarray, h: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One feature id per row and style measure."""
    def per_row(flag):
        c = np.concatenate([[0], np.cumsum(flag)])
        return c[offsets[1:]] - c[offsets[:-1]]
    size = np.maximum(1, np.diff(offsets))
    n = np.maximum(1, np.diff(first))
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    pairs = np.unique(np.stack([row.astype(np.uint64), h]), axis=1)[0] if len(h) else np.zeros(0, np.uint64)
    distinct = np.bincount(pairs.astype(np.int64), minlength=len(offsets) - 1)
    chars = np.concatenate([[0], np.cumsum(end - start)])
    measures = [
        np.minimum(9, 20 * per_row((data >= 65) & (data <= 90)) // size),
        np.minimum(9, 100 * per_row(data == 33) // size),
        10 * distinct // n,
        np.minimum(15, (chars[first[1:]] - chars[first[:-1]]) // n),
        np.floor(np.log2(n)).astype(np.int64),
        np.minimum(9, 30 * per_row(np.isin(data, np.frombuffer(b"#*$%&|<>", np.uint8))) // size),
    ]
    return np.stack([style_id(k, m) for k, m in enumerate(measures)], 1)


def style_id(measure: int, step: np.ndarray) -> np.ndarray:
    return (X.mix((step + 1).astype(np.uint64) * X.STEP[30] + X.STEP[31 + measure]) % X.U(DIM)).astype(np.int64)


def style_ids() -> np.ndarray:
    """Every style feature (steps are below 64)."""
    return np.concatenate([style_id(k, np.arange(64)) for k in range(6)])


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct feature ids of all rows one after the other, first feature of each row)."""
    rows = len(offsets) - 1
    low = X.LOWER[data]
    start, end, first = X.words(low, offsets, WORD)
    s = X.prefix_hash(low)
    h = X.span_hash(s, start, end) if len(start) else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(rows), np.diff(first))
    ids, whose = [h % X.U(DIM)], [row]
    for k in (4, 5):
        ok = end - start > k
        ids.append(X.mix(X.span_hash(s, start[ok], start[ok] + k) + X.STEP[20 + k]) % X.U(DIM))
        whose.append(row[ok])
    st = style(data, offsets, h, start, end, first)
    ids.append(st.ravel().astype(np.uint64))
    whose.append(np.repeat(np.arange(rows), st.shape[1]))
    key = np.unique(np.concatenate(whose).astype(np.int64) * DIM + np.concatenate(ids).astype(np.int64))
    return key % DIM, np.searchsorted(key // DIM, np.arange(rows + 1))


def known_only(f: np.ndarray, first: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features that fitting has seen often enough; style features are always known."""
    keep = known[f]
    return f[keep], np.concatenate([[0], np.cumsum(keep)])[first]


def tails(eta: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade > k) for each threshold k."""
    return 1 / (1 + np.exp(np.clip(thresholds[None, :] - eta[:, None], -40, 40)))


def fit_rows(texts: list[str | None], grades: list[int], epochs: int = 8, rate: float = 0.3, decay: float = 1e-4,
             least: int = 3, seed: int = 3) -> bytes:
    """Weights and thresholds by AdaGrad on the ordinal likelihood."""
    top = max(max(grades), 1)
    feats, first, at = [], [np.zeros(1, np.int64)], 0
    for _, _, data, offsets, _ in X.blocks(pa.array(texts, pa.string())):
        f, ff = features(data, offsets)
        feats.append(f)
        first.append(ff[1:] + at)
        at += len(f)
    feats, first = np.concatenate(feats), np.concatenate(first)
    known = np.bincount(feats, minlength=DIM) >= least          # features of at least so many texts
    known[style_ids()] = True
    feats, first = known_only(feats, first, known)
    y = np.asarray(grades)
    share = np.array([(y <= k).mean() for k in range(top)])
    theta = np.log((share + 1e-3) / (1 - share + 1e-3))
    theta = np.maximum.accumulate(theta + np.arange(top) * 1e-3)
    w, g2 = np.zeros(DIM), np.full(DIM, 1e-2)
    t2 = np.full(top, 1e-2)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(order), 64):
            b = order[lo:lo + 64]
            n = first[b + 1] - first[b]
            idx = np.repeat(first[b] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            f = feats[idx]
            scale = n ** -0.25
            eta = np.add.reduceat(w[f], np.concatenate([[0], np.cumsum(n)[:-1]])) * scale
            cdf = np.concatenate([np.zeros((len(b), 1)), 1 - tails(eta, theta), np.ones((len(b), 1))], 1)
            hi, lo_ = cdf[np.arange(len(b)), y[b] + 1], cdf[np.arange(len(b)), y[b]]
            p = np.maximum(hi - lo_, 1e-9)
            hit, where = np.unique(f, return_inverse=True)
            g = np.bincount(where, np.repeat((1 - hi - lo_) * scale, n), len(hit)) + decay * w[hit]
            g2[hit] += g * g
            w[hit] -= rate * g / np.sqrt(g2[hit])
            g_t = np.zeros(top)
            for k in range(top):
                below, above = y[b] == k, y[b] == k + 1
                g_t[k] = (-(hi * (1 - hi) / p)[below]).sum() + ((lo_ * (1 - lo_) / p)[above]).sum()
            t2 += g_t * g_t
            theta = theta - rate * g_t / np.sqrt(t2)
            theta = np.maximum.accumulate(np.concatenate([theta[:1], np.maximum(theta[1:], theta[:-1] + 1e-3)]))
    return pickle.dumps((w.astype(np.float32), theta, known))


def fit(rated: DataFrame, id_col: str, text_col: str, grade_col: str, fit_limit: int = FIT_ROWS) -> bytes | None:
    """Fit on at most ``fit_limit`` rated rows."""
    ship(rated.sparkSession)
    sample = (rated.filter(F.col(grade_col).isNotNull())
              .select(F.xxhash64(id_col, F.lit(11)).alias("o"), F.col(text_col).alias("text"), F.col(grade_col).cast("int").alias("g"))
              .orderBy("o").limit(fit_limit))

    def one_task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([*frames, pd.DataFrame(columns=["o", "text", "g"])])
        if len(rows):
            rows = rows.sort_values(["o", "g"])
            text = [t if isinstance(t, str) else None for t in rows["text"]]
            yield pd.DataFrame({"model": [fit_rows(text, rows["g"].astype(int).tolist())]})
    got = sample.repartition(1).mapInPandas(one_task, "model binary").collect()
    return bytes(got[0]["model"]) if got else None


def predict(docs: DataFrame, blob: bytes | None, id_col: str = "doc_id", text_col: str = "text",
            least_tail: float = 0.5) -> DataFrame:
    """Per row: id, expected_grade, tail_prob (of the top grade), grade_probs, kept
    (tail_prob >= least_tail)."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(blob)        # DIM floats, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(sent.value) if sent.value is not None else None
        for batch in batches:
            for i, j, data, offsets, _ in X.blocks(batch.column(1)):
                f, first = features(data, offsets)
                if model is not None:
                    f, first = known_only(f, first, model[2])
                n = np.diff(first)
                if model is None:
                    cols = [pa.nulls(j - i, pa.float64()), pa.nulls(j - i, pa.float64()), pa.nulls(j - i, pa.list_(pa.float64()))]
                else:
                    eta = np.add.reduceat(model[0][f].astype(np.float64), first[:-1]) * n ** -0.25
                    up = tails(eta, model[1])
                    probs = -np.diff(np.concatenate([np.ones((j - i, 1)), up, np.zeros((j - i, 1))], 1), axis=1)
                    cols = [pa.array(up.sum(1)), pa.array(up[:, -1].copy()), pa.array(list(probs), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *cols],
                                                 names=["id", "expected_grade", "tail_prob", "grade_probs"])
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    got = src.mapInArrow(run, "id long, expected_grade double, tail_prob double, grade_probs array<double>")
    return got.withColumn("kept", F.col("tail_prob") >= least_tail).withColumnRenamed("id", id_col)


def grades(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, grade) of the labels table: toxic 0, else poor 1, else good 2."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.select(F.col(id_col), grade.alias("grade")).filter(F.col("grade").isNotNull() & F.col(id_col).isNotNull())


def rated_sample(docs: DataFrame, rated: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 fit_limit: int = FIT_ROWS) -> DataFrame:
    """The rated documents to fit on: the ids with the least hash, at most ``fit_limit``
    rows of the ratings, so this side has a fixed size and may be broadcast."""
    few = rated.orderBy(F.xxhash64(id_col, F.lit(11)), "grade").limit(fit_limit)
    return docs.select(id_col, text_col).join(F.broadcast(few), id_col)
