"""Operator 6: removal of repeated passages by induced suffix sorting.

Texts are UTF-8 bytes. A byte goes if a 200-byte string that covers it starts anywhere
else too, in the same document or another; matches never cross documents and are judged
on the input. The work has three steps.

1. Candidates. Of the 40-byte strings of every 200-byte window the one with the least hash
   is the window's anchor (leftmost among equals), so equal windows have equal anchors at
   equal offsets. A document's windows fall into runs with one anchor each; a run is known
   by its anchor and by a hash of the whole span its windows cover. Anchors that occur once
   end here. If all occurrences of an anchor have one span, all of their windows repeat.
2. Shards. Only where an anchor occurs with different spans must windows be compared. One
   span of each kind is cut from the text and goes to its anchor's shard.
3. Suffix sorting. A shard's spans are sorted by induced sorting: suffixes before which the
   text falls (LMS) are ranked by their substrings and then, by doubling, by the reduced
   string of these ranks; all others are induced from them through queues by first symbol,
   which carry (position, common prefix) tuples in order and spill to a task's disk when
   they outgrow their memory. Neighbours with a common prefix of 200 are repeats. Shards
   are sorted in runs of whole anchor groups of about RUN bytes, one after the other.

Skew: counts per anchor are combined map-side, hot anchors are split by AQE in the join
back, and an anchor with more than ``group_limit`` different spans (a passage that a third
of all documents share, at its edges) is not sorted in one task: its windows are counted by
their 128-bit hashes, which spreads them evenly. Removed spans are merged inside a
document. Nothing is capped.

Results: null text is empty; texts under 200 bytes lose nothing; an exact copy of a long
text loses all, as its original does; every row is a document of its own, also where rows
repeat a doc_id or have none (work is keyed by a row id; doc_id is only carried to the
result); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.llm import _text as X
from ledgerscope.llm._shared import Scratch

LENGTH = 200          # bytes of a repeated string
GRAM = 40             # bytes of an anchor
RUN = 3 << 20         # bytes of spans sorted together
QUEUE_BYTES = 32 << 20
GROUP_LIMIT = 10_000  # different spans of one anchor that may be sorted in one task


# ------------------------------------------------------------------ candidates
def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(row, first window, last window, anchor hash, span hash) of every run of windows."""
    z = np.zeros(0, np.int64)
    n = len(data) - length + 1
    width = length - gram + 1
    if n <= 0:
        return z, z, z, z.view(np.uint64), z.view(np.uint64)
    s = X.prefix_hash(data)
    at = np.arange(len(data) - gram + 1)
    g = X.span_hash(s, at, at + gram)
    bits = X.U(len(g).bit_length())
    low = ((g >> bits) << bits) | at.astype(np.uint64)      # least hash, leftmost first
    have = 1
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        d = width - have
        low = np.minimum(low[:-d], low[d:])
    best = (low[:n] & ((X.U(1) << bits) - X.U(1))).astype(np.int64)
    start = np.arange(n)
    row = np.searchsorted(offsets, start, "right") - 1
    inside = start + length <= offsets[row + 1]
    start, best, row = start[inside], best[inside], row[inside]
    if not len(start):
        return z, z, z, z.view(np.uint64), z.view(np.uint64)
    cut = np.flatnonzero(np.concatenate([[True], (best[1:] != best[:-1]) | (start[1:] != start[:-1] + 1) | (row[1:] != row[:-1])]))
    last = np.concatenate([cut[1:], [len(start)]]) - 1
    lo, hi, a = start[cut], start[last], best[cut]
    span = X.mix(X.span_hash(s, lo, hi + length) + (a - lo).astype(np.uint64) * X.STEP[60])
    return row[cut], lo, hi, g[a], span


def occurrences(docs: DataFrame) -> DataFrame:
    """(anchor, span, id, lo, more): a run of windows starting at lo .. lo + more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j, data, offsets, _ in X.blocks(batch.column(1)):
                row, lo, hi, a, span = anchors(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(X.signed(a)), pa.array(X.signed(span)), pa.array(ids[i:j][row]),
                     pa.array((lo - offsets[row]).astype(np.int64)), pa.array((hi - lo).astype(np.int32))],
                    names=["anchor", "span", "id", "lo", "more"])
        X.release()
    return docs.mapInArrow(run, "anchor long, span long, id long, lo long, more int")


# ------------------------------------------------------------------ induced sorting
def refine(rank: np.ndarray, who: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Split tied ranks by a further key, in place; returns those still tied.

    A rank is the place of its group's first member, so splitting one group moves no other.
    """
    r = rank[who]
    o = np.lexsort((key, r)) if len(r) and (r != r[0]).any() else np.argsort(key)
    who, key = who[o], key[o]
    r = rank[who]
    i = np.arange(len(who))
    group = np.concatenate([[True], r[1:] != r[:-1]])
    part = group | np.concatenate([[True], key[1:] != key[:-1]])
    head, sub = np.maximum.accumulate(np.where(group, i, 0)), np.maximum.accumulate(np.where(part, i, 0))
    rank[who] = r + (sub - head)
    alone = part & np.concatenate([part[1:], [True]])
    return who[~alone]


def lms_order(t: np.ndarray, s_type: np.ndarray, lms: np.ndarray, depth: int) -> np.ndarray:
    """LMS positions in the order of their suffixes (to ``depth`` symbols)."""
    m = len(lms)
    end = np.concatenate([lms[1:], [len(t) - 1]])
    code = t.astype(np.uint64) * X.U(2) + s_type.astype(np.uint64)      # under 2**10
    rank, who, at = np.zeros(m, np.int64), np.arange(m), 0
    while len(who):                              # name the substrings, six symbols a time
        key = np.zeros(len(who), np.uint64)
        for k in range(6):
            i = lms[who] + at + k
            key = key * X.U(1024) + np.where(i <= end[who], code[np.minimum(i, len(t) - 1)] + X.U(1), X.U(0))
        who = refine(rank, who, key)
        at += 6
        who = who[lms[who] + at <= end[who]]
    order = np.argsort(rank, kind="stable")
    tied = np.concatenate([[False], rank[order][1:] == rank[order][:-1]])
    who = order[tied | np.concatenate([tied[1:], [False]])]
    step = 1
    while len(who) and step <= depth:            # the reduced string of names, by doubling
        nxt = who + step
        key = np.where(nxt < m, rank[np.minimum(nxt, m - 1)], -1)
        who = refine(rank, who, key)
        step *= 2
    return lms[np.argsort(rank, kind="stable")]


def common(t: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix lengths of the suffixes at a and b, up to cap (t is padded by cap + 8),
    compared seven symbols of nine bits at a time."""
    packed = t[:len(t) - 6].astype(np.uint64)
    for k in range(1, 7):
        packed <<= X.U(9)
        packed |= t[k:len(t) - 6 + k]
    out = np.zeros(len(a), np.int64)
    live, k = np.arange(len(a)), 0
    while len(live) and k < cap:
        differ = packed[a[live] + k] ^ packed[b[live] + k]
        same = differ == 0
        ended, x = live[~same], differ[~same]
        out[ended] = k + sum((x < X.U(1 << (63 - 9 * j))).astype(np.int64) for j in range(1, 7))
        live, k = live[same], k + 7
    out[live] = cap
    return np.minimum(out, cap)


class Queues:
    """First-in first-out queues by first symbol holding (position, common prefix with the
    tuple before). The tuples of the largest queues go to disk when memory is used up."""

    def __init__(self, budget: int):
        self.parts: dict[int, list] = {}
        self.budget, self.held, self.file = budget, 0, None

    def push(self, symbol: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.parts.setdefault(symbol, []).append((pos, lcp))
        self.held += pos.nbytes + lcp.nbytes
        if self.held > self.budget:
            self.spill()

    def spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        size = {c: sum(p[0].nbytes + p[1].nbytes for p in ps if not isinstance(p[0], int)) for c, ps in self.parts.items()}
        for c in sorted(size, key=size.get, reverse=True):
            if self.held <= self.budget // 2:
                break
            for k, (pos, lcp) in enumerate(self.parts[c]):
                if not isinstance(pos, int):
                    self.file.seek(0, 2)
                    where = self.file.tell()
                    self.file.write(pos.tobytes() + lcp.tobytes())
                    self.parts[c][k] = (where, len(pos))
            self.held -= size[c]

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        got = []
        for pos, lcp in self.parts.pop(symbol, []):
            if isinstance(pos, int):
                self.file.seek(pos)
                raw = self.file.read(lcp * 9)
                got.append((np.frombuffer(raw, np.int64, lcp), np.frombuffer(raw, np.uint8, lcp, lcp * 8)))
            else:
                got.append((pos, lcp))
                self.held -= pos.nbytes + lcp.nbytes
        if not got:
            return np.zeros(0, np.int64), np.zeros(0, np.uint8)
        return np.concatenate([p for p, _ in got]), np.concatenate([x for _, x in got])


def range_min(v: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """min(v[lo:hi]) for pairs lo < hi, by doubling tables."""
    out = np.empty(len(lo), v.dtype)
    size = hi - lo
    table, width = v, 1
    level = np.floor(np.log2(size)).astype(np.int64) if len(size) else size
    for k in range(int(level.max()) + 1 if len(level) else 0):
        w = np.flatnonzero(level == k)
        out[w] = np.minimum(table[lo[w]], table[hi[w] - width])
        if k < level.max():
            table = np.minimum(table[:-width], table[width:])
            width *= 2
    return out


class Inducer:
    """One scan (up for L, down for S suffixes) that induces the suffix before each one."""

    def __init__(self, t, s_type, want_s: bool, cap: int, budget: int):
        self.t, self.s_type, self.want_s, self.cap = t, s_type, want_s, cap
        self.queues = Queues(budget)
        self.pending = np.full(int(t.max()) + 1, cap, np.uint8)   # least prefix since a symbol's last parent

    def feed(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        """pos in scan order, lcp with the one scanned before."""
        if not len(pos):
            return
        before = pos - 1
        ok = (before >= 0) & (self.s_type[before] == self.want_s)
        i = np.flatnonzero(ok)
        chars = self.t[before[i]]
        if self.want_s:              # of equal first symbols an S suffix stands before its parent
            keep = chars <= self.t[pos[i]]
        else:
            keep = chars >= self.t[pos[i]]
        i, chars = i[keep], chars[keep]
        order = np.argsort(chars, kind="stable")
        i, chars = i[order], chars[order]
        first = np.concatenate([[True], chars[1:] != chars[:-1]]) if len(i) else np.zeros(0, bool)
        value = np.empty(len(i), np.uint8)
        if len(i):
            rest = np.flatnonzero(~first)
            value[rest] = range_min(lcp, i[rest - 1] + 1, i[rest] + 1)
            heads = np.flatnonzero(first)
            running = np.minimum.accumulate(lcp)
            value[heads] = np.minimum(self.pending[chars[heads]], running[i[heads]])
        self.pending = np.minimum(self.pending, lcp.min())
        if len(i):
            cuts = np.append(heads, len(i))
            tail = np.minimum.accumulate(np.append(lcp[1:], self.cap)[::-1])[::-1]   # least after each
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                c = int(chars[a])
                self.queues.push(c, before[i[a:b]], np.minimum(value[a:b].astype(np.int64) + 1, self.cap).astype(np.uint8))
                self.pending[c] = tail[i[b - 1]]

    def bucket(self, c: int) -> tuple[np.ndarray, np.ndarray]:
        """All suffixes of this kind with first symbol c, in scan order; feeds each on."""
        pos, lcp = [], []
        while True:
            p, v = self.queues.pop(c)
            if not len(p):
                break
            if not pos:
                v = v.copy()
                v[0] = 0
            pos.append(p)
            lcp.append(v)
            self.feed(p, v)
        if not pos:
            return np.zeros(0, np.int64), np.zeros(0, np.uint8)
        return np.concatenate(pos), np.concatenate(lcp)


def repeated_starts(t: np.ndarray, cap: int = LENGTH, budget: int = QUEUE_BYTES) -> np.ndarray:
    """True at positions whose next ``cap`` symbols also start elsewhere.

    t: symbols >= 1 with 0 after each span (so no cap symbols across spans count: callers
    ask only for starts with cap symbols before the next 0).
    """
    n = len(t)
    mark = np.zeros(n, bool)
    if n < 2:
        return mark
    nxt = np.append(t[1:], 0)
    up, down = t < nxt, t > nxt
    # type of equal neighbours: that of the next different pair; the last symbol is L-like
    decided = np.where(up | down, np.arange(n), n)
    decided = np.minimum.accumulate(decided[::-1])[::-1]
    s_type = np.where(decided < n, up[np.minimum(decided, n - 1)], False)
    s_type[-1] = True                                      # the final 0 is the least suffix
    change = np.concatenate([[True], t[1:] != t[:-1]])
    run_end = np.append(np.flatnonzero(change)[1:], n)
    run = np.repeat(run_end, np.diff(np.append(np.flatnonzero(change), n))) - np.arange(n)
    lms = np.flatnonzero(s_type & np.concatenate([[False], ~s_type[:-1]]))
    padded = np.concatenate([t, np.zeros(cap + 8, t.dtype)])
    order = lms_order(t, s_type, lms, cap)
    seed_lcp = np.zeros(len(order), np.uint8)
    seed_lcp[1:] = common(padded, order[:-1], order[1:], cap)
    symbols = np.unique(t).tolist()
    first = t[order]
    up_scan, l_items = Inducer(t, s_type, False, cap, budget), {}
    for c in symbols:
        pos, lcp = up_scan.bucket(c)
        l_items[c] = (pos, lcp)
        a, b = np.searchsorted(first, [c, c + 1])          # LMS suffixes of this symbol follow
        if b > a:
            v = seed_lcp[a:b].copy()
            v[0] = min(cap, int(run[pos[-1]]), int(run[order[a]])) if len(pos) else 0
            up_scan.feed(order[a:b], v)
    del seed_lcp
    down_scan = Inducer(t, s_type, True, cap, budget)
    for c in reversed(symbols):
        s_pos, s_lcp = down_scan.bucket(c)
        pos, lcp = l_items.pop(c)
        back = np.append(lcp[1:], 0)[::-1].astype(np.uint8)  # with the next one, read downwards
        back = np.concatenate([[0], back[1:]]).astype(np.uint8) if len(pos) else back
        down_pos = pos[::-1]
        if len(pos):
            joint = min(cap, int(run[s_pos[-1]]), int(run[down_pos[0]])) if len(s_pos) else 0
            back[0] = joint
            # back[k]: common prefix of the k-th read downwards with the (k-1)-th
            back[1:] = lcp[1:][::-1]
            down_scan.feed(down_pos, back)
        for p, v in ((s_pos, s_lcp), (down_pos, back)):
            hit = np.flatnonzero(v >= cap)
            mark[p[hit]] = True
            mark[p[hit[hit > 0] - 1]] = True
            if len(hit) and hit[0] == 0 and len(s_pos):
                mark[s_pos[-1]] = True
    return mark


# ------------------------------------------------------------------ shards
def cut_out(docs: DataFrame, kinds: DataFrame) -> DataFrame:
    """(anchor, id, lo, more, bytes) of one span of each kind; id is null where the kind
    occurs again, as its windows are known to repeat and it only stands as a partner."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                raw = (batch.column(1)[r].as_py() or "").encode("utf-8", "surrogatepass")
                want = batch.column(2)[r].as_py()
                if not raw:
                    continue
                k = batch.column(0)[r].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w["anchor"] for w in want], pa.int64()),
                     pa.array([k if w["c"] == 1 else None for w in want], pa.int64()),
                     pa.array([w["lo"] for w in want], pa.int64()), pa.array([w["more"] for w in want], pa.int32()),
                     pa.array([raw[w["lo"]:w["lo"] + w["more"] + LENGTH] for w in want], pa.binary())],
                    names=["anchor", "id", "lo", "more", "bytes"])
        X.release()
    lists = kinds.groupBy("rep.id").agg(F.collect_list(F.struct("anchor", "rep.lo", "rep.more", "c")).alias("want"))
    return docs.join(lists, "id").select("id", "text", "want").mapInArrow(
        run, "anchor long, id long, lo long, more int, bytes binary")


def windows_of(mark: np.ndarray) -> list[tuple[int, int]]:
    """Runs of True as (first, last)."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mark.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True))


def sort_shards(cuts: DataFrame, run_bytes: int = RUN, budget: int = QUEUE_BYTES) -> DataFrame:
    """(id, lo, hi): repeated bytes found by sorting each anchor's spans together."""
    def one(anchor, ids, lo, more, raw):
        size = np.array([len(x) for x in raw])
        start = np.concatenate([[0], np.cumsum(size + 1)])
        t = np.zeros(start[-1], np.uint16)
        flat = np.frombuffer(b"\x00".join(raw) + b"\x00", np.uint8)
        t[:] = flat.astype(np.uint16) + 1
        t[start[1:] - 1] = 0
        mark = repeated_starts(t, LENGTH, budget)
        out = [(i, p + a, p + b + LENGTH) for k, (i, p, m) in enumerate(zip(ids, lo, more, strict=True)) if i is not None
               for a, b in windows_of(mark[start[k]:start[k] + m + 1])]
        return pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], pa.int64()) for c in range(3)], names=["id", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], [], []]
        size = 0
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in range(5)]
            for row in zip(*cols, strict=True):
                if size >= run_bytes and row[0] != held[0][-1]:
                    yield one(*held)
                    held, size = [[], [], [], [], []], 0
                for h, x in zip(held, row, strict=True):
                    h.append(x)
                size += len(row[4]) + 1
        if held[0]:
            yield one(*held)
        X.release()
    return cuts.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "id long, lo long, hi long")


def count_windows(cuts: DataFrame) -> DataFrame:
    """(id, lo, hi) for anchors with very many kinds of span: windows by 128-bit hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                raw = batch.column(4)[r].as_py()
                k, lo, m = (batch.column(c)[r].as_py() for c in (1, 2, 3))
                got = [hashlib.md5(raw[a:a + LENGTH]).digest() for a in range(m + 1)]
                w = np.frombuffer(b"".join(got), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w[:, 0].copy()), pa.array(w[:, 1].copy()), pa.array([k] * (m + 1), pa.int64()),
                     pa.array(np.arange(lo, lo + m + 1))], names=["w1", "w2", "id", "lo"])
        X.release()
    w = cuts.mapInArrow(run, "w1 long, w2 long, id long, lo long")
    again = w.groupBy("w1", "w2").agg(F.count("*").alias("n")).filter("n > 1")
    return w.filter("id is not null").join(again, ["w1", "w2"]).select("id", "lo", (F.col("lo") + LENGTH).alias("hi"))


def numbered(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, doc): every row of docs as a struct with an id of its own, saved so that later
    plans see the same ids."""
    return scratch.save(docs.select(F.monotonically_increasing_id().alias("id"), F.struct(*docs.columns).alias("doc")))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   group_limit: int = GROUP_LIMIT) -> DataFrame:
    """(id, doc, spans): every row of docs under an id of its own (``doc`` has its columns)
    with its byte ranges (lo, hi) that repeat, not yet merged, or null."""
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark)
    rows = numbered(docs, scratch)
    src = rows.select("id", F.col("doc").getField(text_col).cast("string").alias("text"))
    occ = scratch.save(occurrences(src))
    per = occ.groupBy("anchor").agg(F.count("*").alias("n"), F.min("span").alias("a"), F.max("span").alias("b")) \
        .filter("n > 1").select("anchor", F.expr("a <> b").alias("mixed"))
    hit = scratch.save(occ.join(per, "anchor"))
    scratch.drop(occ)
    hi = (F.col("lo") + F.col("more") + LENGTH).alias("hi")
    mixed = hit.filter("mixed")
    kinds = scratch.save(mixed.groupBy("anchor", "span").agg(F.count("*").alias("c"), F.min(F.struct("id", "lo", "more")).alias("rep")))
    big = scratch.save(kinds.groupBy("anchor").agg(F.count("*").alias("k")).filter(F.col("k") > group_limit).select("anchor"))
    known = hit.filter("not mixed").select("id", "lo", hi)
    again = mixed.join(kinds.filter("c > 1").select("anchor", "span"), ["anchor", "span"]).select("id", "lo", hi)
    cuts = cut_out(src, kinds)
    if big.isEmpty():
        found = sort_shards(cuts)
    else:
        cuts = scratch.save(cuts)
        found = sort_shards(cuts.join(big, "anchor", "left_anti")).union(count_windows(cuts.join(big, "anchor", "left_semi")))
    spans = known.union(again).union(found).groupBy("id").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    return rows.join(spans, "id", "left").select("id", "doc", "spans")


def merged(spans: list[dict] | None, size: int) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((s["lo"], min(s["hi"], size)) for s in spans or []):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        elif lo < hi:
            out.append((lo, hi))
    return out


def cut_text(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, keep = 0, []
    for lo, hi in runs:
        keep.append(raw[at:lo])
        at = hi
    return b"".join([*keep, raw[at:]])


def digest(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: n_bytes, n_removed, n_spans, kept_sha256; spans as ``repeated_spans``
    of these docs gives them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in range(batch.num_rows):
                raw = (batch.column(1)[r].as_py() or "").encode("utf-8", "surrogatepass")
                runs = merged(batch.column(2)[r].as_py(), len(raw))
                out.append((len(raw), sum(b - a for a, b in runs), len(runs), hashlib.sha256(cut_text(raw, runs)).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([o[c] for o in out], pa.int64()) for c in range(3)],
                 pa.array([o[3] for o in out], pa.string())], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
        X.release()
    doc = F.col("doc")
    both = spans.select(doc.getField(id_col).cast("long").alias("id"), doc.getField(text_col).cast("string").alias("text"), "spans")
    got = both.mapInArrow(run, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return got.withColumnRenamed("id", id_col)


def without_repeats(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with their repeated bytes taken out of the text, all columns kept in
    order; parts of characters that a cut leaves behind go too; null texts stay null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for r in range(batch.num_rows):
                text, found = batch.column(0)[r].as_py(), batch.column(1)[r].as_py()
                if text is not None and found:
                    raw = text.encode("utf-8", "surrogatepass")
                    text = cut_text(raw, merged(found, len(raw))).decode("utf-8", "ignore")
                texts.append(text)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column(2)], names=["text", "rest"])
        X.release()
    rest = [c for c in docs.columns if c != text_col]
    doc = F.col("doc")
    both = spans.select(doc.getField(text_col).cast("string").alias("text"), "spans",
                        F.struct(*[doc.getField(c).alias(c) for c in rest]).alias("rest"))
    kind = both.schema["rest"].dataType.simpleString()
    got = both.mapInArrow(run, f"text string, rest {kind}")
    return got.select(*[F.col("text").alias(c) if c == text_col else F.col("rest").getField(c).alias(c) for c in docs.columns])
