"""Exact path-dependent TreeSHAP for tree ensembles of any depth (A3).

On the way to a leaf a row meets each feature f with a one-fraction o_f (1 if it satisfies
all splits on f, else 0) and a zero-fraction z_f (product of the cover ratios of those
splits). The leaf's game is v(S) = value * prod_{f in S} o_f * prod_{f not in S} z_f, whose
Shapley value is

    phi_f = value (o_f - z_f) * integral_0^1 prod_{k != f} (z_k (1 - t) + o_k t) dt.

The product is a polynomial in t. It is *extended* by one factor per edge while the tree is
walked from the root, kept by its values at Gauss-Legendre points (as many as make the
integral exact for the deepest path), and *unwound* by dividing one factor out. An edge that
splits on a feature met before replaces that feature's factor. As one-fractions are 0 or 1,
factors and gains of an edge come from a small table. All edges of one level, all points and
a block of rows are one NumPy operation; sums over the leaves below an edge come back up the
levels, so the work for a row is edges times points, not leaves times subsets.
Attributions are on the log-odds scale: base + sum(phi) = margin up to rounding.

What a leaf gives depends only on the outcomes of the splits on its path. So a tree that is not
deep is cut into cells, parts below one node with at most ``KEY_BITS`` splits on the way to it
and in it, and the sums over the leaves of a cell are worked out once for all outcomes of these
splits (``Tables``). A row then costs one comparison per different split of the ensemble and, per
cell, one look-up per feature. Trees beyond ``TABLE_BYTES`` of tables are walked as above.

Rows are processed per Arrow batch in ``mapInArrow``; the model's arrays travel in a broadcast,
and each Python worker works out the tables once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscope.operators.trees import Tree, TreeEnsemble, from_spark

ROWS = 48                 # rows of a block on a walk
TABLE_ROWS = 16_384       # rows of a block that looks tables up
KEY_BITS = 9              # most splits of a cell, those on the way to it included
TABLE_BYTES = 256 << 20   # most memory for all tables of an ensemble
CELLS = 16                # cells whose keys are worked out together


class PathTree:
    """One tree's edges in level order, the two edges of a node side by side."""

    def __init__(self, tree: Tree):
        self.expected = 0.0
        node, parent_edge = [], []                 # child node and parent edge of each edge
        level, self.bounds = [(0, -1)], [0]        # (inner node, the edge that leads to it)
        while level:
            level = [(n, e) for n, e in level if tree.left[n] >= 0]
            below = []
            for n, e in level:
                for child in (int(tree.left[n]), int(tree.right[n])):
                    below.append((child, len(node)))
                    node.append(child)
                    parent_edge.append(e)
            if below:
                self.bounds.append(len(node))
            level = below
        self.node = np.array(node, np.int64)
        self.parent = np.array(parent_edge, np.int64)
        n = len(node)
        self.left = np.arange(n) % 2 == 0
        up = np.where(self.parent >= 0, self.node[self.parent], 0) if n else np.zeros(0, np.int64)
        self.feature, self.threshold = tree.feature[up], tree.threshold[up]
        total = np.maximum(tree.cover[up], 1e-300)
        share = tree.cover[self.node] / total if n else np.zeros(0)
        self.leaf = tree.left[self.node] < 0 if n else np.zeros(0, bool)
        self.value = np.where(self.leaf, tree.value[self.node], 0.0) if n else np.zeros(0)
        # nearest edge above on the same feature, and the zero-fraction up to here
        self.above, self.zero, reach = np.full(n, -1), share.copy(), share.copy()
        for e in range(n):
            a = self.parent[e]
            if a >= 0:
                reach[e] *= reach[a]
            while a >= 0 and self.feature[a] != self.feature[e]:
                a = self.parent[a]
            self.above[e] = a
            if a >= 0:
                self.zero[e] *= self.zero[a]
        self.expected = float((self.value * reach).sum()) if n else float(tree.value[0])

    def levels(self) -> list[slice]:
        return [slice(a, b) for a, b in zip(self.bounds, self.bounds[1:])]

    def tables(self, t: np.ndarray, w: np.ndarray) -> None:
        """Steps and gains for the three states of an edge: its one-fraction and that of the
        edge above on the same feature are (0, 0), (0, 1) or (1, 1); 1 below 0 cannot be."""
        n = len(self.node)
        low = self.zero[:, None] * (1 - t)
        factor = np.stack([low, low, low + t], 1)                            # (edges, states, points)
        gain = (np.array([0.0, 0.0, 1.0])[:, None] - self.zero[:, None, None]) / factor
        again = self.above >= 0
        self.step, self.gain = factor.copy(), gain.copy()
        state = [0, 2, 2]                                                    # the edge above, by state
        self.step[again] /= factor[self.above[again]][:, state]
        self.gain[again] -= gain[self.above[again]][:, state]
        self.step, self.gain = self.step.reshape(3 * n, len(t)), (self.gain * w).reshape(3 * n, len(t))
        self.repeats = [np.arange(lv.start, lv.stop)[again[lv]] for lv in self.levels()]
        self.hot = np.zeros((int(self.feature.max(initial=-1)) + 1, n))
        self.hot[self.feature, np.arange(n)] = 1.0

    def explain(self, xt: np.ndarray, phi: np.ndarray, margin: np.ndarray) -> None:
        """Add this tree's values for the rows xt (features, rows) to phi (features, rows) and margin."""
        n = len(self.node)
        if not n:
            margin += self.expected
            return
        one = (xt[self.feature] <= self.threshold[:, None]) == self.left[:, None]
        reach, state = one.copy(), np.ones(one.shape, np.int64)
        for lv, has in zip(self.levels(), self.repeats, strict=True):
            state[has] = one[self.above[has]]
            one[has] &= one[self.above[has]]
            if lv.start:
                reach[lv] &= reach[self.parent[lv]]
        margin += self.value[self.leaf] @ reach[self.leaf]
        state += one
        state += 3 * np.arange(n)[:, None]
        prod = np.take(self.step, state, axis=0)                                              # (edges, rows, points): the path's product
        for lv in self.levels()[1:]:
            prod[lv] *= prod[self.parent[lv]]
        prod *= self.value[:, None, None]                                    # becomes the sum over leaves below
        for lv in self.levels()[:0:-1]:
            prod[self.parent[lv][::2]] += prod[lv][::2] + prod[lv][1::2]
        part = np.einsum("erq,erq->er", prod, np.take(self.gain, state, axis=0))
        phi[:len(self.hot)] += self.hot @ part


class Cell:
    """A part of a tree: the splits that decide it (inner nodes, the two edges of inner node i
    are 2 i and 2 i + 1) and the leaf edges in it."""

    def __init__(self, splits: list[int], leaves: list[int]):
        self.splits, self.leaves = splits, leaves


def cells(path: PathTree) -> list[Cell] | None:
    """A tree's cells; None if a path to a leaf has more than KEY_BITS splits."""
    n = len(path.node)
    first: dict[int, int] = {}                                                  # the left edge below an edge (-1: root)
    for e in range(0, n, 2):
        first[int(path.parent[e])] = e
    out: list[Cell] = []
    def below(top: int) -> tuple[list[int], list[int]]:
        if top >= 0 and path.leaf[top]:
            return [], [top]
        e = first[top]
        (sa, la), (sb, lb) = below(e), below(e + 1)
        return [e // 2, *sa, *sb], la + lb

    def cut(top: int, way: list[int]) -> bool:
        splits, leaves = below(top)
        if len(way) + len(splits) <= KEY_BITS:
            out.append(Cell(way + splits, leaves))
            return True
        if not splits or len(way) >= KEY_BITS:
            return False
        e = first[top]
        return cut(e, [*way, e // 2]) and cut(e + 1, [*way, e // 2])
    return out if cut(-1, []) else None


def cell_table(path: PathTree, cell: Cell, t: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features, (features + 1, outcomes) sums over the cell's leaves); the last row is the margin."""
    at = {s: k for k, s in enumerate(cell.splits)}
    bit = (np.arange(1 << len(cell.splits))[:, None] >> np.arange(len(cell.splits))) & 1 == 1
    ways = []
    for e in cell.leaves:
        way: dict[int, list[int]] = {}
        a = e
        while a >= 0:
            way.setdefault(int(path.feature[a]), []).append(a)              # the last edge on a feature first
            a = int(path.parent[a])
        ways.append(way)
    features = sorted({f for way in ways for f in way})
    row = {f: k for k, f in enumerate(features)}
    out = np.zeros((len(features) + 1, len(bit)))
    for e, way in zip(cell.leaves, ways, strict=True):
        m, value = len(way), path.value[e]
        key = np.zeros(len(bit), np.int64)
        for k, edges in enumerate(way.values()):
            one = np.ones(len(bit), bool)
            for a in edges:
                one &= bit[:, at[a // 2]] == path.left[a]
            key |= one.astype(np.int64) << k
        zero = np.array([path.zero[edges[0]] for edges in way.values()])
        ones = (np.arange(1 << m)[:, None] >> np.arange(m)) & 1
        factor = zero[:, None] * (1 - t) + ones[:, :, None] * t              # (outcomes, features, points)
        others = np.ones_like(factor)
        others[:, 1:] = factor[:, :-1].cumprod(1)
        others[:, :-1] *= factor[:, :0:-1].cumprod(1)[:, ::-1]
        phi = value * (ones - zero) * (others @ w)
        out[[row[f] for f in way]] += phi[key].T
        out[-1, key == (1 << m) - 1] += value
    return np.array(features, np.int64), out


class Tables:
    """The cells of many trees over one list of different splits (feature, threshold)."""

    def __init__(self, t: np.ndarray, w: np.ndarray):
        self.t, self.w, self.bytes, self.constant = t, w, 0, 0.0
        self.split: dict[tuple[int, float], int] = {}
        self.key: list[list[int]] = []
        self.cells: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, path: PathTree) -> bool:
        """False, and nothing added, if the tree does not fit."""
        if not len(path.node):                    # a single leaf
            self.constant += path.expected
            return True
        got = cells(path)
        size = sum(8 * (len(c.splits) + 1) << len(c.splits) for c in got or [])
        if got is None or self.bytes + size > TABLE_BYTES:
            return False
        self.bytes += size
        for c in got:
            pairs = [(int(path.feature[2 * s]), float(path.threshold[2 * s])) for s in c.splits]
            self.key.append([self.split.setdefault(p, len(self.split)) for p in pairs])
            self.cells.append(cell_table(path, c, self.t, self.w))
        return True

    def close(self) -> None:
        """The splits by feature; keys filled up with a split that is never met."""
        self.keys = np.array([[*k, *[len(self.split)] * (KEY_BITS - len(k))] for k in self.key], np.int64).reshape(-1, KEY_BITS)
        pairs = list(self.split)
        self.by_feature = []
        for f in sorted({f for f, _ in pairs}):
            at = np.array([k for k, p in enumerate(pairs) if p[0] == f])
            self.by_feature.append((f, at, np.array([pairs[k][1] for k in at])))

    def explain(self, xt: np.ndarray, phi: np.ndarray, margin: np.ndarray) -> None:
        """Add all cells' values for the rows xt (features, rows) to phi (features, rows) and margin."""
        margin += self.constant
        met = np.zeros((len(self.split) + 1, xt.shape[1]), np.uint8)
        for f, at, threshold in self.by_feature:
            met[at] = xt[f] <= threshold[:, None]
        value = np.empty(xt.shape[1])
        for lo in range(0, len(self.keys), CELLS):
            part = self.keys[lo:lo + CELLS]
            key = met[part[:, 0]].astype(np.int64)
            for bits, start in ((part[:, 1:8], 1), (part[:, 8:], 8)):
                byte = np.zeros(key.shape, np.uint8)
                for k in range(bits.shape[1]):
                    if (bits[:, k] < len(self.split)).any():
                        byte |= met[bits[:, k]] << k
                key |= byte.astype(np.int64) << start
            for at, (features, table) in zip(key, self.cells[lo:lo + CELLS], strict=True):
                for f, line in zip(features, table, strict=False):
                    np.take(line, at, out=value, mode="clip")
                    phi[f] += value
                np.take(table[-1], at, out=value, mode="clip")
                margin += value


class Explainer:
    """All trees of an ensemble, ready to explain rows."""

    def __init__(self, model: TreeEnsemble, n_features: int):
        self.paths = [PathTree(t) for t in model.trees]
        self.n_features, self.start = n_features, model.base
        self.base = model.base + sum(p.expected for p in self.paths)
        depth = max((len(p.bounds) - 1 for p in self.paths), default=1)
        # a path has at most ``depth`` features: without one of them degree depth - 1
        t, w = np.polynomial.legendre.leggauss(max(1, (depth + 1) // 2))
        self.points = ((t + 1) / 2, w / 2)
        self.tables: Tables | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "tables": None, "walked": None}

    def prepare(self) -> None:
        """Tables of the trees that fit, the others ready to be walked."""
        tables, self.walked = Tables(*self.points), []
        for p in self.paths:
            if not tables.add(p):
                p.tables(*self.points)
                self.walked.append(p)
        tables.close()
        self.tables = tables

    def explain(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phi (rows, features), margin) of the rows x."""
        if self.tables is None:
            self.prepare()
        phi, margin = np.zeros((self.n_features, len(x))), np.full(len(x), self.start)
        for lo in range(0, len(x), TABLE_ROWS):
            at = slice(lo, lo + TABLE_ROWS)
            self.tables.explain(np.ascontiguousarray(x[at].T), phi[:, at], margin[at])
        if self.walked:
            for lo in range(0, len(x), ROWS):
                xt = np.ascontiguousarray(x[lo:lo + ROWS].T)
                for p in self.walked:
                    p.explain(xt, phi[:, lo:lo + ROWS], margin[lo:lo + ROWS])
        return phi.T, margin


def matrix(batch: pa.RecordBatch, features: list[str]) -> np.ndarray:
    """(rows, features) of a batch's columns as numbers; missing values are NaN."""
    cols = [batch.column(f).cast(pa.float64()).to_numpy(zero_copy_only=False) for f in features]
    return np.stack(cols, 1) if cols else np.zeros((batch.num_rows, 0))


def ensemble(model) -> TreeEnsemble:
    return model if isinstance(model, TreeEnsemble) else from_spark(model)


def tree_attributions(df: DataFrame, model, features: list[str], keys: list[str]) -> DataFrame:
    """Per row: keys, base_value, margin (log-odds) and phi_<feature> for every feature.
    ``model``: a TreeEnsemble or a Spark boosted classifier."""
    held = df.sparkSession.sparkContext.broadcast(Explainer(ensemble(model), len(features)))
    names = [*keys, "base_value", "margin", *[f"phi_{f}" for f in features]]
    schema = T.StructType([df.schema[k] for k in keys] + [T.StructField(c, T.DoubleType()) for c in names[len(keys):]])
    wide = [F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        explainer = held.value
        for batch in batches:
            phi, margin = explainer.explain(matrix(batch, [f"_x{i}" for i in range(len(features))]))
            base = np.full(batch.num_rows, explainer.base)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keys)], *map(pa.array, (base, margin, *np.ascontiguousarray(phi.T)))], names=names)
    return df.select(*keys, *wide).mapInArrow(run, schema)


def as_attribution_array(shap: DataFrame, features: list[str], values: DataFrame | None = None,
                         out: str = "attributions") -> DataFrame:
    """phi_<feature> columns -> the array<struct> used by top_drivers / global_importance.
    ``values`` (same keys) supplies feature values; otherwise NULL."""
    items = [F.struct(F.lit(f).alias("feature"), F.col(f"phi_{f}").alias("shap_value"),
                      (F.col(f).cast("double") if values is None and f in shap.columns
                       else F.lit(None).cast("double")).alias("feature_value"),
                      F.lit(i).alias("pos")) for i, f in enumerate(features)]
    return shap.withColumn(out, F.array(*items))
