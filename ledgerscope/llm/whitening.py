"""Operator 12: embedding whitening by blockwise QR and a bidiagonal qd solver.

Vectors become integers x = floor(1024 c) + 100000, and sums over them are exact. Each task
reduces its centred rows to one triangular factor, block by block; factors are merged in a
tree of Spark groups until a few are left, whose merge R has the rows' covariance times n as
R'R. On the driver, R (dimensions squared, whatever the rows) is brought to bidiagonal form
by Householder reflections; dqds finds the squared singular values with high relative
accuracy, and twisted factorisations of the shifted matrix give their vectors. The
projections on the leading ones, over the root of their variance, are the whitened values;
their covariance is summed over all rows again to state how far it is from the identity.

Scale: four passes over the vectors, each in blocks of BLOCK entries; nothing but sums and
triangular factors is shuffled.

Results: rows whose vector is null or holds null or non-finite entries are dropped; a vector
shorter than the longest counts as ending in zeros (an empty one is all zeros); null ids and
repeated rows stay; with fewer dimensions than ``k`` there are as many components; a
component without variance (equal rows, one row) has whitened 0, explained 0 and no part in
identity_error; equal variances share a subspace in which any basis may come out; an empty
table gives an empty result. Entries beyond +-2**40 and deviations beyond a long are errors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.llm._shared import Scratch, ship

SCALE, SHIFT = 1024, 100_000
BLOCK = 1 << 20            # entries handled at a time
MERGE = 8                  # triangular factors merged by one task
NO_VARIANCE = 1e-12        # singular values below this share of the largest count as 0
EPS = float(np.finfo(float).eps)


# ------------------------------------------------------------------ rows
def vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, lengths, entries one after the other) of the usable vectors, in blocks."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    there = np.asarray(column.is_valid().to_numpy(zero_copy_only=False), bool)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)      # null entries are NaN
    first = np.concatenate([[0], np.cumsum(size)])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    good = np.flatnonzero(there & (bad[first[1:]] == bad[first[:-1]]))
    step = max(1, BLOCK // max(1, int(size.max(initial=1))))
    for lo in range(0, len(good), step):
        rows = good[lo:lo + step]
        n = size[rows]
        at = np.repeat(first[rows] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        yield rows, n, flat[at]


def integers(entries: np.ndarray) -> np.ndarray:
    if len(entries) and np.abs(entries).max() > 2.0 ** 40:
        raise ValueError("an entry is beyond 2**40")
    return np.floor(SCALE * entries).astype(np.int64) + SHIFT


def matrix(n: np.ndarray, entries: np.ndarray, d: int) -> np.ndarray:
    """Integer rows of d entries; missing last entries are those of 0."""
    if len(n) and n.min() == d:
        return integers(entries).reshape(len(n), d)
    out = np.full((len(n), d), SHIFT, np.int64)
    out[np.arange(d) < n[:, None]] = integers(entries)
    return out


def sums(src: DataFrame) -> tuple[int, list[int]]:
    """(number of usable vectors, exact sum of x for each dimension)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total, count = 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for _, n, entries in vectors(batch.column(1)):
                rows += len(n)
                if n.max(initial=0) > len(total):
                    more = int(n.max()) - len(total)
                    total, count = np.pad(total, (0, more)), np.pad(count, (0, more))
                m = matrix(n, entries, len(total))
                held = (n[:, None] > np.arange(len(total))).sum(0)
                total += m.sum(0) - SHIFT * (len(n) - held)
                count += held
        yield pa.RecordBatch.from_pydict({"dim": np.arange(-1, len(total)), "held": np.concatenate([[rows], count]),
                                          "total": np.concatenate([[0], total])})
    got = src.mapInArrow(run, "dim long, held long, total long").groupBy("dim").agg(
        F.sum("held").alias("held"), F.sum("total").alias("total")).orderBy("dim").collect()    # one row a dimension
    n = got[0]["held"] if got else 0
    return n, [r["total"] + SHIFT * (n - r["held"]) for r in got[1:]]


def triangular(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def reduce_rows(src: DataFrame, n: int, s: np.ndarray, scratch: Scratch) -> np.ndarray:
    """R with R'R = sum over the rows of (x - S/n)'(x - S/n), merged in a tree of tasks."""
    d = len(s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in batches:
            for _, size, entries in vectors(batch.column(1)):
                r = triangular(np.vstack([r, (n * matrix(size, entries, d) - s) / n]))
        if len(r):
            yield pa.RecordBatch.from_pydict({"r": pa.array([r.tobytes()], pa.binary())})

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        r = triangular(np.vstack([np.frombuffer(b).reshape(-1, d) for b in pdf["r"]]))
        return pd.DataFrame({"at": [int(pdf["at"].iloc[0]) // MERGE], "r": [r.tobytes()]})
    parts = scratch.save(src.mapInArrow(run, "r binary").withColumn("id", F.monotonically_increasing_id()))
    # a task yields one row: the high bits of its id are the task's number
    parts = parts.select(F.shiftright("id", 33).alias("at"), "r")
    left = int(parts.agg(F.coalesce(F.max("at"), F.lit(0))).first()[0]) + 1
    while left > MERGE:
        parts = scratch.save(parts.groupBy(F.expr(f"at div {MERGE}").alias("to")).applyInPandas(merge, "at long, r binary"))
        left = -(-left // MERGE)
    return triangular(np.vstack([np.frombuffer(bytes(x["r"])).reshape(-1, d) for x in parts.orderBy("at").collect()]))


# ------------------------------------------------------------------ the bidiagonal solver
def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """(v, beta): (I - beta v v') x is a multiple of the first unit vector."""
    v = x.copy()
    norm = np.linalg.norm(x)
    if norm == 0 or not np.any(x[1:]):
        return v, 0.0
    v[0] += math.copysign(norm, x[0])
    return v, 2.0 / float(v @ v)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with r V = U B, B upper bidiagonal."""
    d = r.shape[1]
    a = np.zeros((d, d))
    a[:len(r)] = r[:d]
    v = np.eye(d)
    for k in range(d):
        u, beta = reflector(a[k:, k])
        a[k:, k:] -= beta * np.outer(u, u @ a[k:, k:])
        if k < d - 1:
            u, beta = reflector(a[k, k + 1:])
            a[k:, k + 1:] -= beta * np.outer(a[k:, k + 1:] @ u, u)
            v[:, k + 1:] -= beta * np.outer(v[:, k + 1:] @ u, u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def qd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One differential qd transform with a shift; None if the shift passed the least value."""
    d, qq, ee = q[0] - shift, [], []
    if d < 0:
        return None
    for i in range(len(e)):
        x = d + e[i]
        if x <= 0:
            return None
        t = q[i + 1] / x
        qq.append(x)
        ee.append(e[i] * t)
        d = d * t - shift
        if d < 0:
            return None
    return qq + [d], ee


def dqds(q: list[float], e: list[float]) -> list[float]:
    """Squared singular values of the bidiagonal with squared entries q, e (all e positive)."""
    least = max(q + e, default=0.0) * 1e-60
    todo, found = [([max(x, least) for x in q], list(e), 0.0)], []
    while todo:
        q, e, base = todo.pop()
        while True:
            n = len(q)
            if n == 1:
                found.append(q[0] + base)
                break
            if n == 2:
                # the 2 x 2 case in closed form, without cancellation in the larger value
                t, p = q[0] + q[1] + e[0], q[0] * q[1]
                big = (t + math.sqrt(max(0.0, t * t - 4 * p))) / 2
                found += [big + base, (p / big if big > 0 else 0.0) + base]
                break
            cut = [i for i in range(n - 1) if e[i] <= EPS ** 2 * (base + q[i]) or e[i] <= EPS * EPS * (base + q[i + 1])]
            if cut:
                i = cut[-1]
                todo.append((q[:i + 1], e[:i], base))
                q, e = q[i + 1:], e[i + 1:]
                continue
            if q[0] < q[-1] * 0.5:                       # small values belong at the end
                q, e = turned(q, e)
            # the trailing 2 x 2 bounds the least value from above
            a, b, c = q[-2] + e[-1], q[-1], e[-1] * q[-1]
            t = (a + b + math.sqrt((a - b) ** 2 + 4 * c)) / 2
            bound = (a * b - c) / t if t > 0 else 0.0
            for shift in (bound * (1 - 1e-4), bound * 0.75, bound * 0.25, 0.0):
                step = qd_step(q, e, max(0.0, shift))
                if step is not None:
                    break
            q, e = step
            base += max(0.0, shift)
    return sorted(found, reverse=True)


def turned(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """The squared entries of the upper bidiagonal with the same values, from the other end."""
    # B read backwards is lower bidiagonal; its transpose has the entries reversed
    return q[::-1], e[::-1]


def twisted(q: np.ndarray, e: np.ndarray, lam: float) -> np.ndarray:
    """Eigenvector of B'B at lam: stationary and progressive qd meet where they fit best."""
    n = len(q)
    if n == 1:
        return np.ones(1)
    tiny = max(q.max(), e.max(initial=0)) * 1e-300 + 1e-300
    ll = np.sqrt(e / q[:-1])
    lp, um, s, p = np.zeros(n - 1), np.zeros(n - 1), np.zeros(n), np.zeros(n)
    s[0] = -lam
    for i in range(n - 1):
        dp = s[i] + q[i] or tiny
        lp[i] = q[i] * ll[i] / dp
        s[i + 1] = lp[i] * ll[i] * s[i] - lam
    p[-1] = q[-1] - lam
    for i in range(n - 2, -1, -1):
        dm = e[i] + p[i + 1] or tiny
        t = q[i] / dm
        um[i] = ll[i] * t
        p[i] = p[i + 1] * t - lam
    gamma = np.abs(s + p + lam)
    k = int(np.nanargmin(gamma))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -lp[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -um[i] * z[i]
    return z / np.linalg.norm(z)


def leading(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(k greatest squared singular values of r, their right vectors as rows, sum of all)."""
    d = r.shape[1]
    diag, upper, v = bidiagonal(r)
    norm = max(np.abs(diag).max(initial=0), np.abs(upper).max(initial=0))
    trace = float((diag ** 2).sum() + (upper ** 2).sum())
    if norm == 0:
        return np.zeros(min(k, d)), np.eye(d)[:k], 0.0
    diag = np.where(np.abs(diag) < norm * 1e-30, norm * 1e-30, diag)
    signs = np.concatenate([[1.0], np.cumprod(np.where(diag[:-1] * upper < 0, -1.0, 1.0))])   # to positive off-diagonals
    split = np.flatnonzero(np.abs(upper) <= EPS * np.minimum(np.abs(diag[:-1]), np.abs(diag[1:])) * 1e-3)
    pairs = []
    for lo, hi in zip([0, *(split + 1).tolist()], [*(split + 1).tolist(), d]):
        q, e = diag[lo:hi] ** 2, upper[lo:hi - 1] ** 2
        pairs += [(lam, lo, hi) for lam in dqds(q.tolist(), e.tolist())]
    pairs.sort(reverse=True)
    values, rows = np.array([p[0] for p in pairs[:k]]), []
    t = np.diag(diag ** 2 + np.concatenate([[0.0], upper ** 2])) + np.diag(diag[:-1] * upper, 1) + np.diag(diag[:-1] * upper, -1)
    for lam, lo, hi in pairs[:k]:
        z = np.zeros(d)
        z[lo:hi] = twisted(diag[lo:hi] ** 2, upper[lo:hi - 1] ** 2, lam)
        z *= signs
        near = [w for w, (mu, *_) in zip(rows, pairs) if abs(mu - lam) <= 1e-3 * pairs[0][0]]
        z = apart(z, near, t, lam, pairs[0][0])
        rows.append(z)
    vectors_ = (np.array(rows).reshape(len(rows), d) @ v.T) if rows else np.zeros((0, d))
    return values, vectors_, trace


def apart(z: np.ndarray, near: list[np.ndarray], t: np.ndarray, lam: float, top: float) -> np.ndarray:
    """z made orthogonal to vectors of close values; inverse iteration where little is left."""
    rng = np.random.default_rng(3)
    for attempt in range(4):
        size = np.linalg.norm(z)
        for w in near + near:
            z = z - (w @ z) * w
        left = np.linalg.norm(z)
        if left > 0.5 * size and np.linalg.norm(t @ z - lam * z) <= 1e-11 * top * left:
            break
        if left <= 0.5 * size:
            z = rng.standard_normal(len(z))
            for w in near + near:
                z = z - (w @ z) * w
        shifted = t - (lam + (attempt + 1) * 4 * EPS * top) * np.eye(len(t))
        z = np.linalg.solve(shifted, z / np.linalg.norm(z))
        z = z / np.linalg.norm(z)
    return z / np.linalg.norm(z)


# ------------------------------------------------------------------ the operator
def whiten(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 8) -> DataFrame:
    """Per usable row and component: id, component, n, deviation, whitened, explained, identity_error."""
    spark = table.sparkSession
    scratch = Scratch(spark)
    ship(spark)
    src = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    out = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    n, total = sums(src)
    s, d = np.array(total, np.int64), len(total)
    if not n or not d:
        return spark.createDataFrame([], out).withColumnRenamed("id", id_col)
    if n * max(abs(x) for x in total) > 2 ** 62:
        raise OverflowError("the exact sums are beyond a long")
    values, rows, trace = leading(reduce_rows(src, n, s, scratch), k)
    live = np.sqrt(values) > NO_VARIANCE * math.sqrt(values[0]) if values[0] > 0 else values > 0
    var = np.where(live, values / n, 0.0)
    weights = np.where(live[:, None], rows, 0.0) / np.sqrt(np.where(live, var, 1.0))[:, None]
    sent = spark.sparkContext.broadcast((n, s, weights))       # dimensions times components

    def centred(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        n, s, w = sent.value
        for at, size, entries in vectors(column):
            m = n * matrix(size, entries, len(s)) - s
            yield at, m, (m / n) @ w.T

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = len(sent.value[2])
        one, two = np.zeros(c), np.zeros((c, c))
        for batch in batches:
            for _, _, y in centred(batch.column(1)):
                one += y.sum(0)
                two += y.T @ y
        yield pa.RecordBatch.from_pydict({"at": np.arange(c + c * c), "x": np.concatenate([one, two.ravel()])})
    got = src.mapInArrow(moments, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).orderBy("at").collect()
    c = len(values)
    flat = np.array([r["x"] for r in got]) / n                 # components and their pairs
    cov = flat[c:].reshape(c, c) - np.outer(flat[:c], flat[:c])
    held = cov[np.ix_(live, live)]
    error = float(np.abs(held - np.eye(len(held))).max()) if len(held) else 0.0
    explained = np.where(live, values / trace, 0.0) if trace > 0 else np.zeros(c)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, m, y in centred(batch.column(1)):
                if len(m) and (m.astype(float) ** 2).sum(1).max() > 9.2e18:
                    raise OverflowError("a deviation is beyond a long")
                dev = (m * m).sum(1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.repeat(at, c))), pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), len(at))),
                     pa.array(np.full(c * len(at), n)), pa.array(np.repeat(dev, c)), pa.array(y.ravel()),
                     pa.array(np.tile(explained, len(at))), pa.array(np.full(c * len(at), error))],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return src.mapInArrow(project, out).withColumnRenamed("id", id_col)
