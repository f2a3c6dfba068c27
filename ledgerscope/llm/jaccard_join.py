r"""Operator 7: n-gram Jaccard self-join, size-aware with heavy and light sets.

A document's set is its distinct 5-word shingles (words ``[^\x20\x09-\x0D]+`` after
lower-casing A-Z); a shorter text is one shingle, a text without words the empty set.
Two documents link when 100 * intersection >= 75 * union.

Tokens have one global order: those known to be frequent last, else by hash. A set of a
shingles that links with another shares at least ceil(0.75 a) of them, so the first
a - ceil(0.75 a) + c tokens of both share c. Light sets enumerate all 2-subsets (c = 2) of
that prefix as keys, which few other sets share; heavy sets are found by scanning the
inverted lists of their prefix tokens (c = 1). The boundary is where enumerating a set's
subsets costs more than scanning its lists, from the measured mean list length. Light sets
that may link across the boundary also stand in the inverted lists. At a shared key a pair
is taken only if the positions of the key still allow the needed overlap.

No group emits all its pairs. Exact copies are one node. First every member of a list is
compared with one leader of the list, then, in further rounds, with the leader of a small
random part of it, then, in long lists, with the member that has the fewest rarer tokens;
each round looks only at pairs from different components of the links found so far. After
that the pairs from different components that still share a key are verified: of short
lists all, which is a bounded number for each member; of long ones those between the list's
largest component and the rest or inside the rest, and the join makes rows only of pairs
whose parity bitmaps allow a link. All pairs are held against such bitmaps, which drop only those that
differ in more bits than two linked sets can differ in tokens; so no link between components is lost. Only components
are reported, so pairs inside one need no check.

Skew: keys of frequent tokens are salted by document; lists are reduced per key with
map-side minima; AQE splits the joins that carry rows to leaders, and the members of a long
list are dealt into pieces for the last round. The table of frequent
tokens has at most 2**20 entries (each has at least that share of all tokens).

Results: one row per row of the table. Null and wordless texts have the empty set and are
alone; every row is a document of its own, also where rows repeat a doc_id or have none
(work is keyed by a row id), and a component is named by the smallest doc_id in it, null if
none of its rows has one; an empty table gives an empty result; very long texts are one set.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerscope.llm import _text as X
from ledgerscope.llm._shared import Scratch, components

SHINGLE = 5
NUM, DEN = 3, 4                 # similarity of 3/4
FREQUENT_SHARE = 1 << 20        # a token is frequent from a share of 1 / 2**20 of all tokens
FREQUENT_LEAST = 16
COUNT_TOKENS = 2 << 20          # tokens counted together in a task before they are emitted
SALTS = 64
PIECE = 100_000                 # postings of one list stored together
BITS = 256                      # of a set's parity bitmap at least
LONG = 32                       # lists with more members make rows only of pairs whose bitmaps allow a link
SKETCH = 16                     # 64-bit words of the bitmaps carried into that join
DEALT = 2000                    # members of a long list that meet the others together
BEFORE = 8                      # keys before a posting by which a later meeting of a pair is left out
BROADCAST_IDS = 500_000         # ids (8 bytes each) that may be broadcast


# ------------------------------------------------------------------ sets
def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    data = X.LOWER[data]
    start, end, first = X.words(data, offsets, X.SPACED)
    h = X.word_hashes(data, start, end)
    g = X.grams(h, SHINGLE)
    out = []
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        n = hi - lo
        out.append(np.unique(g[lo:hi - SHINGLE + 1]) if n >= SHINGLE else X.grams(h[lo:hi], n)[:1] if n else g[:0])
    return out


def signature(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums over the set."""
    a, b = X.mix(s * X.STEP[50] + X.STEP[51]), X.mix(s * X.STEP[52] + X.STEP[53])
    with np.errstate(over="ignore"):
        return (int(a.sum(dtype=np.uint64).view(np.int64)), int(b.sum(dtype=np.uint64).view(np.int64)))


def parity(s: np.ndarray, bits: int) -> np.ndarray:
    """Bytes of a bitmap: bit k is the parity of the number of tokens that hash to k. Two
    sets' bitmaps differ in no more bits than the sets differ in tokens."""
    odd = np.bincount((X.mix(s + X.STEP[55]) & X.U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8))


def wide_parity(s: np.ndarray) -> bytes:
    """A bitmap of one to two bits a token: pairs carry it through shuffles, and beyond the
    bits that two linked sets may differ in, unrelated sets differ in far more of these too."""
    return parity(s, max(BITS, 1 << (len(s) - 1).bit_length())).tobytes() if len(s) else b""


def may_link(x: bytes, y: bytes, n: int, m: int) -> bool:
    """False if the bitmaps rule out that sets of n and m tokens link. The hash is taken
    modulo the size, so folding a bitmap's halves gives the bitmap of half the size."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) != len(b):
        if len(a) > len(b):
            a = a[:len(a) // 2] ^ a[len(a) // 2:]
        else:
            b = b[:len(b) // 2] ^ b[len(b) // 2:]
    need = -(-NUM * (n + m) // (NUM + DEN))
    return int(np.bitwise_count(a ^ b).sum()) <= n + m - 2 * need


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * intersection >= 75 * union, for sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    inter = int((b[at] == a).sum()) if len(b) else 0
    return DEN * inter >= NUM * (len(a) + len(b) - inter) and inter > 0


def profile(docs: DataFrame) -> DataFrame:
    """kind 0: (id, set size, signature, bitmap); kind 1: (token, its count) for the tokens that
    repeat among documents counted together."""
    names = ["kind", "id", "n", "s1", "s2", "wide"]

    def repeated(held):
        t, c = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        t, c = t[c > 1], c[c > 1]
        k = len(t)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ones(k, np.int32)), pa.array(X.signed(t)), pa.array(c.astype(np.int64)),
             pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for i, j, data, offsets, _ in X.blocks(batch.column(1)):
                sets = shingle_sets(data, offsets)
                sig = [signature(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(j - i, np.int32)), batch.column(0).slice(i, j - i),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array([s[0] for s in sig], pa.int64()),
                     pa.array([s[1] for s in sig], pa.int64()),
                     pa.array([wide_parity(s) for s in sets], pa.binary())], names=names)
                held += sets
                count += sum(map(len, sets))
                if count >= COUNT_TOKENS:
                    yield repeated(held)
                    held, count = [], 0
        yield repeated(held)
        X.release()
    return docs.mapInArrow(run, "kind int, id long, n long, s1 long, s2 long, wide binary")


# ------------------------------------------------------------------ keys
def sketches(docs: DataFrame) -> DataFrame:
    """(node, w0, w1, ...): a parity bitmap of SKETCH words for each (node, text)."""
    names = [f"w{i}" for i in range(SKETCH)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets, _ in X.blocks(batch.column(1)):
                w = np.stack([parity(s, 64 * SKETCH).view(np.int64) for s in shingle_sets(data, offsets)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *map(pa.array, w.T.copy())], names=["node", *names])
        X.release()
    return docs.mapInArrow(run, "node long, " + ", ".join(f"{x} long" for x in names))


def least_overlap(n: int) -> int:
    return -(-NUM * n // DEN)


def prefix_size(n: int, c: int) -> int:
    return min(n, n - least_overlap(n) + c)


def boundary(mean_list: float) -> int:
    """Largest size whose 2-subsets cost no more than scanning its prefix's lists:
    (p + 1) p / 2 keys against p lists of 1 + mean_list entries."""
    n = 3
    while prefix_size(n + 1, 1) <= 1 + 2 * mean_list:
        n += 1
    return n


def keys(docs: DataFrame, frequent, bound: int) -> DataFrame:
    """(key, id, at, salt): at is n * 2**32 + tag for a set of n; tag is 2 * position, + 1
    for a subset's key; salt is 0 unless the key is made of frequent tokens only."""
    band = least_overlap(bound + 1)      # smaller sets can't link with a heavy one

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, level = frequent.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, _, data, offsets, _ in X.blocks(batch.column(1)):
                out_key, out_tag, out_salt, out_n, size = [], [], [], [], []
                for r, s in enumerate(shingle_sets(data, offsets)):
                    n, made = len(s), 0
                    if not n:
                        out_n.append(0)
                        size.append(0)
                        continue
                    at = np.searchsorted(hot, s)
                    lv = np.where(hot[np.minimum(at, len(hot) - 1)] == s, level[np.minimum(at, len(hot) - 1)], 0) \
                        if len(hot) else np.zeros(n, np.uint8)
                    order = np.argsort(lv, kind="stable")
                    s, lv = s[order], lv[order]
                    salt = 1 + int(X.mix(np.array([ids[i + r]], np.int64).view(np.uint64))[0] % X.U(SALTS))
                    if n > bound or n >= band:
                        p = prefix_size(n, 1)
                        out_key.append(s[:p])
                        out_tag.append(2 * np.arange(p))
                        out_salt.append(np.where(lv[:p] > 0, salt, 0))
                        made += p
                    if n <= bound:
                        p = prefix_size(n, 2)
                        a, b = np.triu_indices(p, 1)
                        out_key.append(X.mix(X.mix(s[a] + X.STEP[45]) * X.STEP[46] + s[b]))
                        out_tag.append(2 * (b - 1) + 1)
                        out_salt.append(np.where((lv[a] > 0) & (lv[b] > 0), salt, 0))
                        made += len(a)
                    out_n.append(made)
                    size.append(n)
                if out_key:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(X.signed(np.concatenate(out_key))), pa.array(np.repeat(ids[i:i + len(out_n)], out_n)),
                         pa.array(np.repeat(np.array(size, np.int64) << 32, out_n) + np.concatenate(out_tag)),
                         pa.array(np.concatenate(out_salt).astype(np.int32))], names=["key", "id", "at", "salt"])
        X.release()
    return docs.mapInArrow(run, "key long, id long, at long, salt int")


def lists(posted: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, node, tag, n, c) of the lists with c > 1 members. Keys whose lists have the same
    members are one key, named by a hash of them, at each member's first position.

    A key that is not salted lies in one window, which counts and names its list without a
    further shuffle; only the salted keys' pieces are put together by an aggregate. The rows
    of a list are stored together, in pieces of about PIECE."""
    w = W.partitionBy("key", "salt")
    x, y = F.bit_xor(F.xxhash64("id", F.lit(1))), F.bit_xor(F.xxhash64("id", F.lit(2)))

    def name(x, y):
        return F.xxhash64(x, y, "c", F.expr("at % 2"))
    live = (posted.withColumn("c", F.count("*").over(w)).filter("salt > 0 or c > 1")
            .withColumn("x", x.over(w)).withColumn("y", y.over(w)))
    live = scratch.save(live.select(F.when(F.col("salt") > 0, F.col("key")).otherwise(name("x", "y")).alias("key"), "id", "at", "salt", "c"))
    salted = live.filter("salt > 0").drop("c")
    whole = salted.groupBy("key").agg(F.count("*").alias("c"), x.alias("x"), y.alias("y")).filter("c > 1")
    both = live.filter("salt = 0").select("key", "id", "at", "c").union(salted.join(whole, "key").select(name("x", "y"), "id", "at", "c"))
    dealt = both.withColumn("piece", F.expr(f"pmod(xxhash64(id), 1 + c div {PIECE})")).repartition("key", "piece")
    first = dealt.groupBy("key", "piece", "id").agg(F.min("at").alias("at"), F.max("c").alias("c"))
    posts = scratch.save(first.select("key", F.col("id").alias("node"), F.expr("int(at & 4294967295)").alias("tag"),
                                      F.expr("shiftright(at, 32)").alias("n"), "c"))
    scratch.drop(live)
    return posts


# ------------------------------------------------------------------ pairs
def verified(pairs: DataFrame, texts: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) whose sets link, from the whole texts (node, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: OrderedDict[int, np.ndarray] = OrderedDict()

        def sets_of(ids, column):
            fresh = [k for k in {x: k for k, x in enumerate(ids)}.values() if ids[k] not in kept]
            got = {}
            if fresh:
                part = column.take(pa.array(fresh))
                for i, j, data, offsets, _ in X.blocks(part):
                    for k, s in zip(fresh[i:j], shingle_sets(data, offsets), strict=True):
                        got[ids[k]] = s
            for x in set(ids) - got.keys():
                got[x] = kept[x]
            return got
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                a, b = part.column(0).to_pylist(), part.column(1).to_pylist()
                known = sets_of(a, part.column(2)) | sets_of(b, part.column(3))
                hit = [similar(known[x], known[y]) for x, y in zip(a, b, strict=True)]
                for x, s in known.items():
                    if len(s) < 4_000:
                        kept[x] = s
                        kept.move_to_end(x)
                while len(kept) > 500:
                    kept.popitem(last=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, h in zip(a, hit, strict=True) if h], pa.int64()),
                     pa.array([y for y, h in zip(b, hit, strict=True) if h], pa.int64())], names=["a", "b"])
        kept.clear()
        X.release()
    # b are the many members of lists, a their few leaders: each member's text moves twice
    both = (pairs.join(rows_of(texts, pairs, "b", scratch).withColumnRenamed("text", "text_b"), "b")
            .join(rows_of(texts, pairs, "a", scratch).withColumnRenamed("text", "text_a"), "a"))
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def chosen(rows: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """The rows whose ``name`` is among the saved ids. These are broadcast only while their
    counted number stays within BROADCAST_IDS; else they are joined by a shuffle."""
    small = ids.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if small else ids, name, "left_semi")


def rows_of(rows: DataFrame, pairs: DataFrame, end: str, scratch: Scratch) -> DataFrame:
    """The rows (by ``node``) of the nodes at one end of the pairs, under that end's name."""
    return chosen(rows.withColumnRenamed("node", end), scratch.save(pairs.select(end).distinct()), end)


def possible(pairs: DataFrame, wide: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs that the wide bitmaps (node, n, wide) leave possible."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in range(2, 6)], strict=True)
            yield batch.filter(pa.array([may_link(x, y, n, m) for n, m, x, y in rows], pa.bool_())).select(["a", "b"])
    y = rows_of(wide.toDF("node", "n_b", "w_b"), pairs, "b", scratch)
    x = rows_of(wide.toDF("node", "n_a", "w_a"), pairs, "a", scratch)
    return pairs.join(y, "b").join(x, "a").select("a", "b", "n_a", "n_b", "w_a", "w_b").mapInArrow(run, "a long, b long")


def merged(comp: DataFrame | None, links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) after more links; links are first contracted to components."""
    if comp is None:
        return components(links, scratch)
    for end in ("a", "b"):
        at = comp.select(F.col("node").alias(end), F.col("component").alias(f"to_{end}"))
        links = links.join(at, end, "left").withColumn(f"c_{end}", F.coalesce(f"to_{end}", end))
    more = scratch.save(components(links.select(F.col("c_a").alias("a"), F.col("c_b").alias("b")), scratch))
    root = more.select(F.col("node").alias("component"), F.col("component").alias("root"))
    moved = comp.join(root, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    return moved.union(more.join(comp, "node", "left_anti").select("node", "component"))


def needed(x: str, y: str) -> str:
    """SQL of the tokens that linked sets of x.n and y.n share at least."""
    return f"(({NUM} * ({x}.n + {y}.n) + {NUM + DEN - 1}) div {NUM + DEN})"


def allowed(bound: int):
    """May the pair of postings x and y (columns tag, n) still have the overlap it needs,
    if this key is the first that both have?"""
    def cond(x: str, y: str):
        need = F.expr(needed(x, y))
        return (((F.col(f"{x}.tag") % 2 == 1) | (F.greatest(f"{x}.n", f"{y}.n") > bound))
                & (F.expr(f"{x}.tag div 2") <= F.col(f"{x}.n") - need)
                & (F.expr(f"{y}.tag div 2") <= F.col(f"{y}.n") - need))
    return cond


def led(cur: DataFrame, order, ok) -> DataFrame:
    """(a, b): in every part of a list with members of several components, the leader (least
    by ``order``) and each member of another component that it may link with."""
    cur = cur.withColumn("o", order).select("key", "part", "o", "node", "tag", "n", "comp")
    lead = (cur.groupBy("key", "part").agg(F.min(F.struct("o", "node", "tag", "n", "comp")).alias("m"),
                                           F.min("comp").alias("lo"), F.max("comp").alias("hi"))
            .filter("lo <> hi").select("key", "part", "m.node", "m.tag", "m.n", "m.comp"))
    found = cur.alias("y").join(lead.alias("x"), ["key", "part"]).filter(F.expr("x.comp <> y.comp") & ok("x", "y"))
    return found.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def short_pairs(cur: DataFrame, ok) -> DataFrame:
    """(a, b): all pairs of different components that a short list brings together."""
    cur = cur.filter(f"c <= {LONG}")
    found = (cur.alias("x").join(cur.alias("y"), "key")
             .filter(F.expr("x.node < y.node and x.comp <> y.comp and not arrays_overlap(x.before, y.before)") & ok("x", "y")))
    return found.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def long_pairs(cur: DataFrame, texts: DataFrame, scratch: Scratch, ok) -> DataFrame:
    """(a, b): the pairs of different components that a long list brings together and whose
    bitmaps allow a link. Members of a list's largest component meet only the others."""
    cur = cur.filter(f"c > {LONG}")
    nodes = scratch.save(cur.select("node").distinct())
    words = scratch.save(sketches(chosen(texts, nodes, "node")))
    counts = cur.groupBy("key", "comp").agg(F.count("*").alias("m"))
    most = counts.groupBy("key").agg(F.max(F.struct("m", "comp")).alias("most")).select("key", F.col("most.comp").alias("most"))
    whole = scratch.save(cur.join(most, "key").join(words, "node"))
    scratch.drop(nodes, words)
    pieces = F.expr(f"c div {DEALT}")
    x = whole.filter("comp <> most").withColumn("piece", F.pmod(F.xxhash64("node"), 1 + pieces))
    y = whole.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), pieces)))
    differ = " + ".join(f"bit_count(x.w{i} ^ y.w{i})" for i in range(SKETCH))
    found = x.alias("x").join(y.alias("y"), F.expr("x.key = y.key and x.piece = y.piece and x.comp <> y.comp and (y.comp = y.most or x.node < y.node)")
                              & ok("x", "y") & F.expr(f"{differ} <= x.n + y.n - 2 * {needed('x', 'y')} and not arrays_overlap(x.before, y.before)"))
    found = scratch.save(found.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")))
    scratch.drop(whole)
    return found


def near_rows(rows: DataFrame, id_col: str = "row", text_col: str = "text", part: int = 8,
              tries: int = 2, bound: int | None = None) -> DataFrame:
    """Per row of a stored table, whose ids are unique and not null: id, n_shingles,
    component_id (smallest id that links reach).

    part, tries: size of the parts that get a leader each in the later rounds, and how often
    a list is dealt into parts in the last of them; they change the work, never the result.
    """
    spark: SparkSession = rows.sparkSession
    scratch = Scratch(spark)
    src = rows.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    seen = scratch.save(profile(src))
    sets = seen.filter("kind = 0")
    rep = sets.filter("n > 0").groupBy("n", "s1", "s2").agg(F.min("id").alias("node"))
    members = scratch.save(sets.select("id", "n", "s1", "s2").join(rep, ["n", "s1", "s2"], "left")
                           .select("id", "n", F.coalesce("node", "id").alias("node")))
    total = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    counts = seen.filter("kind = 1").groupBy("id").agg(F.sum("n").alias("c"))
    limit = max(FREQUENT_LEAST, total // FREQUENT_SHARE)
    hot = counts.filter(F.col("c") >= limit).toPandas()            # at most 2**20 rows
    token = hot["id"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(token)
    level = np.floor(np.log2(hot["c"].to_numpy(np.float64) + 1)).astype(np.uint8)
    frequent = spark.sparkContext.broadcast((token[order], level[order]))
    if bound is None:
        cold = counts.filter(F.col("c") < limit).agg(F.coalesce(F.sum(F.col("c") * F.col("c")), F.lit(0))).first()[0]
        bound = boundary(1 + cold / max(1, total))
    # of equal sets one row posts keys
    nodes = scratch.save(members.filter("id = node and n > 0").select("id"))
    posts = lists(keys(chosen(src, nodes, "id"), frequent, bound), scratch)
    scratch.drop(nodes)
    wide = sets.select(F.col("id").alias("node"), "n", "wide")
    texts = src.withColumnRenamed("id", "node")
    ok = allowed(bound)
    comp = None
    for step, size in enumerate([0, part, part, LONG, None]):
        if comp is None:
            cur = posts.withColumn("comp", F.col("node"))
        else:
            cur = posts.join(comp, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")
        if size is None:   # the rest: all pairs of different components that a key still brings together
            open_keys = cur.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("key")
            # a pair is met at its first common key: later ones see that key among those before
            before = W.partitionBy("node", F.expr("tag % 2")).orderBy("tag", "key").rowsBetween(-BEFORE, -1)
            rest = scratch.save(cur.join(open_keys, "key", "left_semi").withColumn("before", F.collect_list("key").over(before)))
            found = short_pairs(rest, ok).union(long_pairs(rest, texts, scratch, ok))
        elif step == 3:    # in a long list the leader with the fewest tokens rarer than the key is most like all others
            found = led(cur.filter(f"c > {size}").withColumn("part", F.lit(0)), F.struct(F.expr("tag div 2"), F.xxhash64("node")), ok)
        else:
            cur = cur.withColumn("part", F.lit(0).cast("long"))
            if size:   # members of longer lists in parts of about `size`, dealt by key and node, `tries` times
                deals = tries if step == 2 else 1
                n_parts = F.expr(f"(c + {size - 1}) div {size}")
                cur = (cur.filter(f"c > {size}").withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(deals - 1))))
                       .withColumn("part", F.pmod(F.xxhash64("key", "node", "t", F.lit(step)), n_parts) * deals + F.col("t")))
            found = led(cur, F.xxhash64("node", F.lit(step)), ok)
        pairs = scratch.save(found.distinct())
        left = scratch.save(possible(pairs, wide, scratch))
        links = scratch.save(verified(left, texts, scratch))
        old, comp = comp, scratch.save(merged(comp, links, scratch))
        scratch.drop(pairs, left, links, *([old] if old is not None else []))
    scratch.drop(posts, rest)
    linked = members.join(comp, "node", "left").withColumn("component_id", F.coalesce("component", "node"))
    return linked.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part: int = 8,
                tries: int = 2, bound: int | None = None) -> DataFrame:
    """Per row of docs: id, n_shingles, component_id (smallest doc_id that links reach);
    part, tries and bound as in ``near_rows``."""
    scratch = Scratch(docs.sparkSession)
    # saved, so that all later plans see the same row ids
    rows = scratch.save(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("own"),
                                    F.col(text_col).cast("string").alias("text")), "zstd")
    found = near_rows(rows, "row", "text", part, tries, bound).withColumnRenamed("component_id", "component")
    of_rows = scratch.save(found.join(rows.select("row", "own"), "row").select("own", "n_shingles", "component"))
    least = of_rows.groupBy("component").agg(F.min("own").alias("component_id"))
    return of_rows.join(least, "component").select(F.col("own").alias(id_col), "n_shingles", "component_id")
