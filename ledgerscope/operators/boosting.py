"""Second-order boosted trees with penalised leaves (M2).

Every round fits a tree to gradient g = p - y and hessian h = p (1 - p) of the weighted
log-loss. A node's leaf value is -T(G) / (H + lambda) with T(G) = sign(G) max(|G| - alpha, 0);
a split gains T(G_l)^2 / (H_l + lambda) + T(G_r)^2 / (H_r + lambda) - T(G)^2 / (H + lambda),
and no child may have a hessian sum below ``min_child_weight``. So both penalties act on the
gain and on the leaf. Trees grow level by level over quantile bins: one pass adds up the
gradient and hessian histograms of all nodes of a level. Missing values go right.

Scale: rows are packed once into blocks of binned columns (one byte a value), written to the
shared folder. Where all blocks fit the tasks that can run at once (``RESIDENT_BYTES`` a task),
one barrier stage grows all trees (``resident``): a task keeps its rows, their margins and nodes,
and adds up only the smaller child of each split, as the other is the parent less this one. Its
sums go to the other tasks through the shared folder, dealt by column; the owner of a column finds
the best cut of each node, and every task grows the same tree from all owners' cuts.
Else, and with ``stop``, one Spark job a level does the same (``grow``): executors keep the blocks;
the margin of a block is brought up to date every ``REFRESH`` trees from the trees themselves, so no
lineage grows and a lost executor costs one block's recomputation. Either way only trees or cuts go
to the driver, whatever the rows.
Row and column draws are fixed by the seed, the tree and the block. Gradients and hessians are
rounded to a power of two so small that sums of them have no rounding error (``unit``): trees do not
depend on how blocks are dealt to tasks, nor on which of the two ways grew them.
"""

from __future__ import annotations

import math
import pickle
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.operators.exchange import Exchange, local_path, slots
from ledgerscope.operators.trees import Tree, TreeEnsemble
from ledgerscope.session import checkpoint_dir

BINS = 64                 # at most 255: a bin is a byte, the last bin is for missing values
BLOCK_ROWS = 16_384
REFRESH = 10
DIRECT = 4                # partitions whose sums one task of the second stage adds up
RESIDENT_BYTES = 400 << 20   # most memory of a task that keeps its rows for the whole fit
ROW_BYTES = 96            # of a kept row, besides its bins
JOINT = 4400              # most joint values of columns whose sums are added up together


@dataclass
class BoosterParams:
    n_estimators: int = 300
    max_depth: int = 5
    learning_rate: float = 0.05
    subsample: float = 0.8
    colsample_bytree: float = 0.8
    min_child_weight: float = 3.0
    reg_alpha: float = 0.1
    reg_lambda: float = 1.0
    seed: int = 42


@dataclass
class Booster:
    """A fitted ensemble with the gains of its splits."""
    ensemble: TreeEnsemble
    gains: list[np.ndarray] = field(default_factory=list)


def cut_points(df: DataFrame, features: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Inner quantiles of every feature, in one aggregate: at most ``bins`` - 1 each."""
    at = [i / bins for i in range(1, bins)]
    cols = [F.percentile_approx(F.col(c).cast("double"), at, 100 * bins).alias(c) for c in features]
    least = [F.max(F.col(c).cast("double")).alias(f"_max_{c}") for c in features]
    row = df.agg(*cols, *least).first()
    # a cut at the greatest value would leave the right side empty
    return [np.array(sorted({float(x) for x in (row[c] or []) if x < row[f"_max_{c}"]})) for c in features]


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """(features, rows) bin numbers: b cuts lie below the value; 255 for a missing value."""
    out = np.empty((len(cuts), len(x)), np.uint8)
    for j, c in enumerate(cuts):
        out[j] = np.searchsorted(c, x[:, j], "left")
        out[j][np.isnan(x[:, j])] = 255
    return out


def pack(df: DataFrame, features: list[str], label: str, weight: str | None, cuts: list[np.ndarray], path: str) -> DataFrame:
    """Blocks of rows written to ``path``: id, rows, binned values, labels and weights, and a bound
    of their gradients' sum."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(lo, BLOCK_ROWS)
                cols = [part.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(part.num_columns)]
                x = np.stack(cols[2:], 1) if len(cols) > 2 else np.zeros((len(cols[0]), 0))
                yield pa.RecordBatch.from_pydict({
                    "rows": pa.array([len(x)], pa.int64()), "bound": pa.array([float((np.abs(cols[1]) * (1 + np.abs(cols[0]))).sum())]), "bins": pa.array([binned(x, cuts).tobytes()], pa.binary()),
                    "y": pa.array([cols[0].tobytes()], pa.binary()), "w": pa.array([cols[1].tobytes()], pa.binary())})
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    src = df.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("_y"), w.alias("_w"),
                                                     *[F.col(c).cast("double").alias(c) for c in features])
    got = src.mapInArrow(run, "rows long, bound double, bins binary, y binary, w binary").withColumn("id", F.monotonically_increasing_id())
    got.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def unit(bound: float) -> float:
    """The power of two to whose multiples gradients and hessians are rounded: a sum of absolute
    values up to ``bound`` has no rounding error then. 0 (no rounding) without a finite bound."""
    return 2.0 ** max(-1000, math.ceil(math.log2(bound)) - 52) if 0 < bound < math.inf else 0.0


def gradients(margin: np.ndarray, y: np.ndarray, w: np.ndarray, u: float) -> tuple[np.ndarray, np.ndarray]:
    p = 1 / (1 + np.exp(-margin))
    g, h = w * (p - y), w * p * (1 - p)
    return (np.rint(g / u) * u, np.rint(h / u) * u) if u else (g, h)


def unpacked(row, n_features: int) -> dict:
    return {"id": row["id"], "bins": np.frombuffer(row["bins"], np.uint8).reshape(n_features, row["rows"]),
            "y": np.frombuffer(row["y"]), "w": np.frombuffer(row["w"])}


def stepped(tree: dict, at: np.ndarray, bins: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The nodes one level below ``at``; rows in leaves stay. ``rows``: the numbers of bins' rows."""
    left = np.array(tree["left"], np.intp)
    leaf = left < 0
    # a leaf's left child is itself, and no bin is beyond its cut
    left = np.where(leaf, np.arange(len(left)), left)
    cut = np.where(leaf, 255, np.array(tree["bin"])).astype(np.uint8)
    start = np.where(leaf, 0, np.array(tree["feature"], np.intp)) * bins.shape[1]
    beyond = bins.ravel().take(start.take(at) + rows) > cut.take(at)
    return left.take(at) + beyond


def reached(tree: dict, bins: np.ndarray) -> np.ndarray:
    """The node of a growing tree (lists; bin thresholds) that each row has reached."""
    at, rows = np.zeros(bins.shape[1], np.intp), np.arange(bins.shape[1])
    for _ in range(tree["levels"]):
        at = stepped(tree, at, bins, rows)
    return at


def with_margin(block: dict, trees: list[dict]) -> dict:
    m = np.zeros(len(block["y"]))
    for t in trees:
        m += np.array(t["value"])[reached(t, block["bins"])]
    return block | {"margin": m}


def drawn(seed: int, turn: int, block_id: int, n: int, share: float) -> np.ndarray:
    return np.random.default_rng([seed, turn, block_id]).random(n) < share


def drawn_columns(rng: np.random.Generator, n_features: int, share: float) -> np.ndarray:
    return np.sort(rng.permutation(n_features)[:max(1, round(share * n_features))])


def histogram(block: dict, recent: list[dict], tree: dict, nodes: list[int], columns: np.ndarray, width: int, seed: int,
              turn: int, subsample: float) -> np.ndarray:
    """(nodes, columns, bins, 2) sums of gradient and hessian of one block."""
    m = block["margin"].copy()
    for t in recent:
        m += np.array(t["value"])[reached(t, block["bins"])]
    g, h = gradients(m, block["y"], block["w"], block["unit"])
    slot = np.full(len(tree["left"]), -1)
    slot[nodes] = np.arange(len(nodes))
    at = slot[reached(tree, block["bins"])]
    use = at >= 0
    if subsample < 1:
        use &= drawn(seed, turn, block["id"], len(m), subsample)
    rows = np.flatnonzero(use)
    at, g, h = at[rows], g[rows], h[rows]
    out = np.zeros((len(nodes), len(columns), width, 2))
    for k, j in enumerate(columns):
        key = at * width + np.minimum(block["bins"][j][rows], width - 1)
        out[:, k, :, 0] = np.bincount(key, g, len(nodes) * width).reshape(len(nodes), width)
        out[:, k, :, 1] = np.bincount(key, h, len(nodes) * width).reshape(len(nodes), width)
    return out


def soft(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0)


def leaf_value(g: float, h: float, p: BoosterParams) -> float:
    return float(-p.learning_rate * soft(np.array(g), p.reg_alpha) / (h + p.reg_lambda)) if h + p.reg_lambda > 0 else 0.0


def best_cuts(hist: np.ndarray, sizes: np.ndarray, p: BoosterParams) -> tuple[np.ndarray, ...]:
    """For each node and column gain, bin, left sums and right sums of the best cut; ties go to
    the first bin. ``sizes``: number of cuts of each column."""
    left = hist.cumsum(2)
    total = left[:, :, -1:, :]
    right = total - left

    def worth(s):
        return soft(s[..., 0], p.reg_alpha) ** 2 / np.maximum(s[..., 1] + p.reg_lambda, 1e-300)
    gain = worth(left) + worth(right) - worth(total)
    ok = (left[..., 1] >= p.min_child_weight) & (right[..., 1] >= p.min_child_weight)
    ok &= np.arange(hist.shape[2]) < sizes[:, None]
    gain = np.where(ok, gain, -np.inf)
    # rounded, so that equal gains of different order of summation stay ties
    cut = np.round(gain, 9).argmax(2)
    n, c = np.indices(cut.shape)
    return gain[n, c, cut], cut, left[n, c, cut], right[n, c, cut]


def chosen(gain: np.ndarray, cut: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple | None]:
    """For each node (gain, column, bin, left sums, right sums), or None; ties go to the first column."""
    best = np.round(gain, 9).argmax(1)
    return [(float(gain[n, c]), int(c), int(cut[n, c]), left[n, c], right[n, c]) if gain[n, c] > 1e-9 else None
            for n, c in enumerate(best)]


def best_splits(hist: np.ndarray, sizes: np.ndarray, p: BoosterParams) -> list[tuple | None]:
    """For each node (gain, column, bin, left sums, right sums), or None; ties go to the first
    column and bin. ``sizes``: number of cuts of each column."""
    return chosen(*best_cuts(hist, sizes, p))


def fit_booster(train: DataFrame, features: list[str], label: str, weight: str | None = None,
                params: BoosterParams | None = None, stop=None) -> Booster:
    """Fit on the rows of ``train`` with a label. ``stop(number of trees)`` may end the fit early."""
    p = params or BoosterParams()
    spark = train.sparkSession
    cuts = cut_points(train, features)
    path = f"{checkpoint_dir(spark).rstrip('/')}/booster-{uuid.uuid4().hex}"
    blocks = pack(train, features, label, weight, cuts, path)
    total = blocks.agg(F.count(F.lit(1)).alias("blocks"), F.sum("rows").alias("rows"), F.sum("bound").alias("bound")).first()
    u = unit(total["bound"] or 0.0)
    tasks = min(slots(spark), total["blocks"]) if stop is None and features else 0
    grown = None
    if tasks and total["rows"] * (len(features) + ROW_BYTES) <= tasks * RESIDENT_BYTES:
        grown = at_once(blocks, tasks, path, cuts, u, p)
    if grown is None:
        grown = by_level(blocks, cuts, u, p, stop)
    return Booster(TreeEnsemble([finished(t, cuts) for t, _ in grown]), [g for _, g in grown])


def by_level(blocks: DataFrame, cuts: list[np.ndarray], u: float, p: BoosterParams, stop) -> list[tuple[dict, np.ndarray]]:
    """Trees and the gains of their splits, one job a level."""
    n_features, width = len(cuts), max((len(c) for c in cuts), default=0) + 2
    base = blocks.rdd.map(lambda r: unpacked(r, n_features) | {"unit": u}).persist(StorageLevel.MEMORY_AND_DISK)
    parts = base.getNumPartitions()
    rng = np.random.default_rng(p.seed)
    grown: list[dict] = []
    gains: list[np.ndarray] = []
    state, known = None, 0
    try:
        for turn in range(p.n_estimators):
            if stop is not None and stop(turn):
                break
            if turn % REFRESH == 0:
                done = list(grown)
                fresh = base.map(lambda b, done=done: with_margin(b, done)).persist(StorageLevel.MEMORY_AND_DISK)
                if state is not None:
                    state.unpersist()
                state, known = fresh, len(done)
            tree, gain = grow(state, parts, grown[known:], drawn_columns(rng, n_features, p.colsample_bytree), cuts, width, turn, p)
            grown.append(tree)
            gains.append(gain)
    finally:
        base.unpersist()
        if state is not None:
            state.unpersist()
    return list(zip(grown, gains, strict=True))


def sapling() -> tuple[dict, list[float]]:
    """A tree of one leaf, and its nodes' gains."""
    return {"left": [-1], "right": [-1], "feature": [0], "bin": [0], "value": [0.0], "cover": [0.0], "levels": 0}, [0.0]


def split_nodes(tree: dict, gain: list[float], nodes: list[int], split: list[tuple | None], columns: np.ndarray, p: BoosterParams) -> list[int]:
    """Splits the nodes of one level; the new nodes, children of a node side by side."""
    below = []
    for node, s in zip(nodes, split, strict=True):
        if s is None:
            continue
        tree["feature"][node], tree["bin"][node], gain[node] = int(columns[s[1]]), int(s[2]), s[0]
        for side, (g, h) in (("left", s[3]), ("right", s[4])):
            tree[side][node] = len(tree["left"])
            for k, v in (("left", -1), ("right", -1), ("feature", 0), ("bin", 0), ("value", leaf_value(g, h, p)), ("cover", float(h))):
                tree[k].append(v)
            gain.append(0.0)
            below.append(len(tree["left"]) - 1)
    return below


def grow(state, parts: int, recent: list[dict], columns: np.ndarray, cuts: list[np.ndarray], width: int, turn: int,
         p: BoosterParams) -> tuple[dict, np.ndarray]:
    tree, gain = sapling()
    nodes = [0]
    sizes = np.array([len(cuts[j]) for j in columns])
    for level in range(p.max_depth):
        frozen = {k: list(v) if isinstance(v, list) else v for k, v in tree.items()}
        now = list(nodes)

        def part(index, rows, recent=recent, tree=frozen, now=now):
            total = None
            for block in rows:
                h = histogram(block, recent, tree, now, columns, width, p.seed, turn, p.subsample)
                total = h if total is None else total + h
            return [] if total is None else ((k, (index, total[:, k:k + 1])) for k in range(len(columns)))

        def merged(rows):
            of: dict[int, list] = {}
            for k, h in rows:
                of.setdefault(k, []).append(h)
            for k, sums in of.items():
                sums = [h for _, h in sorted(sums, key=lambda x: x[0])]
                hist = sum(sums[1:], sums[0])
                yield k, hist[0, 0].sum(0), best_cuts(hist, sizes[k:k + 1], p)
        sums = state.mapPartitionsWithIndex(part)
        if parts > 1:
            sums = sums.partitionBy(min(len(columns), -(-parts // DIRECT)), int)
        got = sorted(sums.mapPartitions(merged).collect(), key=lambda x: x[0])
        if not got:
            break
        if level == 0:
            g, h = got[0][1]
            tree["value"][0], tree["cover"][0] = leaf_value(g, h, p), float(h)
        split = chosen(*(np.concatenate(x, 1) for x in zip(*(c for _, _, c in got), strict=True)))
        nodes = split_nodes(tree, gain, nodes, split, columns, p)
        tree["levels"] = level + 1
        if not nodes:
            break
    return tree, np.array(gain)


def joint(widths: list[int], most: int) -> list[list[int]]:
    """Positions of columns in groups of at most ``most`` joint values, or of one column."""
    out: list[list[int]] = []
    size = most + 1
    for k in sorted(range(len(widths)), key=lambda k: widths[k]):
        if size * widths[k] > most:
            out.append([])
            size = 1
        out[-1].append(k)
        size *= widths[k]
    return out


class Rows:
    """The rows of one task: bins, labels, weights, margins and the nodes they have reached."""

    def __init__(self, blocks: list[dict], cuts: list[np.ndarray], u: float):
        self.ids, self.sizes = [b["id"] for b in blocks], [len(b["y"]) for b in blocks]
        self.widths, self.unit = [len(c) + 2 for c in cuts], u
        bins = [b["bins"] for b in blocks]
        # the missing value's bin is the last one of its column
        self.bins = np.concatenate(bins, 1) if bins else np.zeros((len(cuts), 0), np.uint8)
        for line, n in zip(self.bins, self.widths, strict=True):
            np.minimum(line, n - 1, out=line)
        self.y, self.w = (np.concatenate([b[k] for b in blocks]) if blocks else np.zeros(0) for k in ("y", "w"))
        self.margin, self.number = np.zeros(len(self.y)), np.arange(len(self.y))

    def begin(self, turn: int, columns: np.ndarray, width: int, p: BoosterParams) -> None:
        """Draws the rows of a tree and works out their gradients and joint keys."""
        self.at, self.width, self.columns = np.zeros(len(self.y), np.intp), width, columns
        self.drawn = self.number
        if p.subsample < 1 and self.ids:
            self.drawn = np.flatnonzero(np.concatenate([drawn(p.seed, turn, i, n, p.subsample) for i, n in zip(self.ids, self.sizes, strict=True)]))
        self.g, self.h = gradients(*(v.take(self.drawn) for v in (self.margin, self.y, self.w)), self.unit)
        widths = [self.widths[j] for j in columns]
        self.groups = joint(widths, min(JOINT, max(width, len(self.drawn) // 8)))
        self.keys = []
        for group in self.groups:
            key = np.zeros(len(self.y), np.uint16)
            for k in group:
                key = key * np.uint16(widths[k]) + self.bins[columns[k]]
            self.keys.append(key.take(self.drawn))

    def sums(self, nodes: list[int], n_nodes: int) -> np.ndarray:
        """(columns, nodes, bins, 2) sums of gradient and hessian of the drawn rows in ``nodes``."""
        n = len(nodes)
        out = np.zeros((len(self.columns), n, self.width, 2))
        if n_nodes == 1:
            slot, g, h, rows = np.zeros(len(self.drawn), np.intp), self.g, self.h, slice(None)
        else:
            slots_of = np.full(n_nodes, -1, np.intp)
            slots_of[nodes] = np.arange(n)
            slot = slots_of.take(self.at.take(self.drawn))
            rows = np.flatnonzero(slot >= 0)
            slot, g, h = slot[rows], self.g[rows], self.h[rows]
        for group, key in zip(self.groups, self.keys, strict=True):
            shape = [self.widths[self.columns[k]] for k in group]
            cells = math.prod(shape)
            at = slot * cells
            at += key[rows]
            for s, weight in enumerate((g, h)):
                whole = np.bincount(at, weight, n * cells).reshape(n, *shape)
                for axis, k in enumerate(group):
                    others = tuple(a + 1 for a in range(len(group)) if a != axis)
                    out[k, :, :shape[axis], s] = whole.sum(others) if others else whole
        return out

    def step(self, tree: dict) -> None:
        self.at = stepped(tree, self.at, self.bins, self.number)

    def end(self, tree: dict) -> None:
        self.margin += np.array(tree["value"]).take(self.at)


def grow_resident(rows: Rows, mail: Exchange, turn: int, columns: np.ndarray, width: int, p: BoosterParams) -> tuple[dict, np.ndarray]:
    """One tree; every task of the stage returns the same."""
    tree, gain = sapling()
    sizes = np.array([rows.widths[j] - 2 for j in columns])
    owned = np.linspace(0, len(columns), min(mail.size, len(columns)) + 1).astype(int)       # columns of each owner
    rows.begin(turn, columns, width, p)
    nodes, hist = [0], np.zeros(0)
    for level in range(p.max_depth):
        if level == 0:
            hist = rows.sums(nodes, 1)
        else:
            # children of a node stand side by side
            small = [a if tree["cover"][a] <= tree["cover"][b] else b for a, b in zip(nodes[::2], nodes[1::2], strict=True)]
            part = rows.sums(small, len(tree["left"]))
            above, hist = hist[:, parents], np.empty((len(columns), len(nodes), width, 2))
            right = np.array([a == b for a, b in zip(small, nodes[1::2], strict=True)]).astype(int)
            pair = 2 * np.arange(len(small))
            hist[:, pair + right], hist[:, pair + 1 - right] = part, above - part
        name = f"{turn}-{level}"
        mail.put(f"sums-{name}", hist.tobytes())
        if mail.rank < len(owned) - 1:
            lo, hi = owned[mail.rank:mail.rank + 2]
            line = hist[0].nbytes
            total = np.zeros((hi - lo, *hist.shape[1:]))
            for rank in range(mail.size):
                total += np.frombuffer(mail.get(f"sums-{name}", rank, lo * line, (hi - lo) * line)).reshape(total.shape)
            total = total.transpose(1, 0, 2, 3)
            mail.put(f"cuts-{name}", pickle.dumps((total[0, 0].sum(0), best_cuts(total, sizes[lo:hi], p))))
        got = [pickle.loads(mail.get(f"cuts-{name}", rank)) for rank in range(len(owned) - 1)]
        # all owners have read these sums, and all tasks the cuts before
        mail.drop(f"sums-{name}")
        if mail.rank < len(owned) - 1 and mail.last:
            mail.drop(mail.last)
        mail.last = f"cuts-{name}"
        if level == 0:
            g, h = got[0][0]
            tree["value"][0], tree["cover"][0] = leaf_value(g, h, p), float(h)
        split = chosen(*(np.concatenate(x, 1) for x in zip(*(c for _, c in got), strict=True)))
        parents = [k for k, s in enumerate(split) if s is not None]
        nodes = split_nodes(tree, gain, nodes, split, columns, p)
        tree["levels"] = level + 1
        if not nodes:
            break
        rows.step(tree)
    rows.end(tree)
    return tree, np.array(gain)


NODE = np.dtype([("left", "i4"), ("feature", "i4"), ("bin", "i4"), ("value", "f8"), ("cover", "f8"), ("gain", "f8")])


def at_once(blocks: DataFrame, tasks: int, path: str, cuts: list[np.ndarray], u: float, p: BoosterParams) -> list[tuple[dict, np.ndarray]] | None:
    """Trees and the gains of their splits, all from one barrier stage; None if its tasks do not
    all see the folder."""
    spark = blocks.sparkSession
    folder = local_path(spark, path)
    if folder is None:
        return None
    n_features, width, settings = len(cuts), max(len(c) for c in cuts) + 2, asdict(p)

    def run(rows: Iterator) -> Iterator[tuple]:
        p = BoosterParams(**settings)
        held = Rows([unpacked(r, n_features) for r in rows], cuts, u)
        mail = Exchange(f"{folder}/_mail", BarrierTaskContext.get())
        if not mail.shared:
            return
        rng, mail.last = np.random.default_rng(p.seed), ""
        for turn in range(p.n_estimators):
            tree, gain = grow_resident(held, mail, turn, drawn_columns(rng, n_features, p.colsample_bytree), width, p)
            if mail.rank == 0:
                nodes = np.zeros(len(gain), NODE)
                for k in ("left", "feature", "bin", "value", "cover"):
                    nodes[k] = tree[k]
                nodes["gain"] = gain
                yield tree["levels"], nodes.tobytes()
    jvm = spark._jvm.org.apache.hadoop.fs
    mails = jvm.Path(f"{path}/_mail")
    fs = mails.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(mails)
    try:
        got = blocks.repartition(tasks).rdd.barrier().mapPartitions(run).collect()
    finally:
        fs.delete(mails, True)
    if len(got) < p.n_estimators:
        return None
    out = []
    for levels, data in got:
        nodes = np.frombuffer(data, NODE)
        left = nodes["left"].tolist()
        tree = {k: nodes[k].tolist() for k in ("left", "feature", "bin", "value", "cover")}
        out.append((tree | {"right": [x + 1 if x >= 0 else -1 for x in left], "levels": levels}, nodes["gain"].copy()))
    return out


def finished(t: dict, cuts: list[np.ndarray]) -> Tree:
    left = np.array(t["left"], np.int64)
    cut = np.array([cuts[f][b] if a >= 0 else 0.0 for a, f, b in zip(t["left"], t["feature"], t["bin"], strict=True)])
    return Tree(left, np.array(t["right"], np.int64), np.array(t["feature"], np.int64), cut, np.array(t["value"]),
                np.maximum(np.array(t["cover"]), 1e-12))
