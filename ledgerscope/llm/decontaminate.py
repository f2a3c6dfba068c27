r"""Operator 4: benchmark decontamination by winnowing.

Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z. Of every ``WINDOW``
consecutive k-grams the one with the least hash is kept as a fingerprint, k + WINDOW - 1
= 13 words, so any shared span of 13 words shares a fingerprint. Documents' and items'
fingerprints are joined; each hit is extended to the 13-word windows around it, and these
are compared with the items' windows by hash and by their words, so the result is exact.
An item of fewer than 13 words is one window of its own length n; for each such length
that occurs among the items (at most 12) the documents' n-grams are joined directly.

Skew: the items' fingerprints are broadcast only while their counted number stays within
``BROADCAST_ROWS``; beyond it the join shuffles and AQE splits hot fingerprints. Hits are
reduced to distinct positions of a document before anything is grouped.

Results: a null or wordless document has no words, no hits and is clean; rows that repeat
a doc_id give one row, a row without a doc_id is a document of its own; an empty benchmark
leaves every document clean; items whose text is null or wordless occur nowhere, and an
item without an item_id is an item of its own. Hits are found by an id of the row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.llm import _text as X
from ledgerscope.llm._shared import Scratch

SPAN = 13                  # words of a benchmark window
K = 8                      # words of a fingerprint
WINDOW = SPAN - K + 1      # k-grams of which the least is kept
BROADCAST_ROWS = 200_000   # fingerprints that may be broadcast (16 bytes each)


def _hashed(data, offsets):
    """Lower-cased bytes, word starts, ends, first word of each row, and word hashes."""
    data = X.LOWER[data]
    start, end, first = X.words(data, offsets, X.ALNUM)
    return data, start, end, first, X.word_hashes(data, start, end)


def winnow(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, word position in the block, hash) of the fingerprints of each row's words.

    Of equal least hashes the leftmost is kept. A row with k to 12 words has no 13-word
    window and so no fingerprint.
    """
    g = X.grams(h, K)
    m = len(g) - WINDOW + 1
    if m <= 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64)
    # the position of the least k-gram of each window, leftmost first among equals
    at, low = np.arange(m), g[:m].copy()
    for j in range(1, WINDOW):
        less = g[j:j + m] < low
        low[less] = g[j:j + m][less]
        at[less] = np.flatnonzero(less) + j
    row = np.searchsorted(first, np.arange(m), "right") - 1
    inside = np.arange(m) + SPAN <= first[row + 1]
    at, row = at[inside], row[inside]
    keep = np.ones(len(at), bool)
    keep[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    return row[keep], at[keep], g[at[keep]]


def _whole_grams(h, first, n):
    """(row, position, hash) of all n-grams inside rows."""
    g = X.grams(h, n)
    pos = np.arange(len(g))
    row = np.searchsorted(first, pos, "right") - 1
    ok = pos + n <= first[row + 1] if len(g) else np.zeros(0, bool)
    return row[ok], pos[ok], g[ok]


def _spell(data, start, end, pos, n):
    """The n words at each position, joined by one blank, as bytes."""
    return [b" ".join(data[start[i]:end[i]].tobytes() for i in range(p, p + n)) for p in pos.tolist()]


def fingerprints(rows: DataFrame, short: list[int]) -> DataFrame:
    """(id, h, p, n): kept fingerprints (n = 13) and all n-grams of the short lengths."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j, data, offsets, _ in X.blocks(batch.column(1)):
                data, start, end, first, h = _hashed(data, offsets)
                for n, (row, pos, g) in [(SPAN, winnow(h, first))] + [(n, _whole_grams(h, first, n)) for n in short]:
                    if len(row):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids[i:j][row]), pa.array(X.signed(g)), pa.array((pos - first[row]).astype(np.int32)),
                             pa.array(np.full(len(row), n, np.int32))], names=["id", "h", "p", "n"])
        X.release()
    return rows.mapInArrow(run, "id long, h long, p int, n int")


def item_windows(items: DataFrame) -> DataFrame:
    """(item, own, key, n, spelled): every 13-word window of the items, short items whole.
    Items are (id, text, own); ``own`` tells a row's id that stands for a missing one."""
    def run(batches):
        for batch in batches:
            ids, own = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 2))
            for i, j, data, offsets, _ in X.blocks(batch.column(1)):
                data, start, end, first, h = _hashed(data, offsets)
                size = np.diff(first)
                got = [(SPAN, *_whole_grams(h, first, SPAN))]
                for n in np.unique(size[(size > 0) & (size < SPAN)]).tolist():
                    row = np.flatnonzero(size == n)
                    got.append((n, row, first[row], X.grams(h, n)[first[row]]))
                for n, row, pos, g in got:
                    if len(row):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids[i:j][row]), pa.array(own[i:j][row]), pa.array(X.signed(g)), pa.array(np.full(len(row), n, np.int32)),
                             pa.array(_spell(data, start, end, pos, n), pa.binary())], names=["item", "own", "key", "n", "spelled"])
        X.release()
    return items.mapInArrow(run, "item long, own boolean, key long, n int, spelled binary").distinct()


def _candidates(docs: DataFrame) -> DataFrame:
    """One row with the word count per row of docs, and one per window around a hit."""
    def run(batches):
        for batch in batches:
            rid, doc, hits = batch.column(0), batch.column(3), batch.column(2)
            for i, j, data, offsets, _ in X.blocks(batch.column(1)):
                data, start, end, first, h = _hashed(data, offsets)
                size = np.diff(first)
                yield pa.RecordBatch.from_arrays(
                    [rid.slice(i, j - i), doc.slice(i, j - i), pa.array(size), pa.nulls(j - i, pa.int32()), pa.nulls(j - i, pa.int32()),
                     pa.nulls(j - i, pa.int64()), pa.nulls(j - i, pa.binary())], names=OUT)
                for r in range(i, j):
                    if not hits[r].is_valid:
                        continue
                    found = np.array([(x["p"], x["n"]) for x in hits[r].as_py()], np.int64)
                    lo, n_words = first[r - i], size[r - i]
                    long = found[found[:, 1] == SPAN, 0]
                    spans = [(SPAN, np.unique((long[:, None] - np.arange(WINDOW)[None, :]).ravel()))] if len(long) else []
                    spans += [(n, np.unique(found[found[:, 1] == n, 0])) for n in np.unique(found[:, 1]).tolist() if n != SPAN]
                    for n, at in spans:
                        at = at[(at >= 0) & (at + n <= n_words)]
                        if not len(at):
                            continue
                        g = X.grams(h[lo:lo + n_words], n)[at]
                        k = len(at)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([rid[r].as_py()] * k, pa.int64()), pa.array([doc[r].as_py()] * k, pa.int64()),
                             pa.array(np.full(k, n_words)), pa.array(at.astype(np.int32)),
                             pa.array(np.full(k, n, np.int32)), pa.array(X.signed(g)),
                             pa.array(_spell(data, start, end, at + lo, n), pa.binary())], names=OUT)
        X.release()
    return docs.mapInArrow(run, "rid long, doc long, n_words long, at int, n int, key long, spelled binary")


OUT = ["rid", "doc", "n_words", "at", "n", "key", "spelled"]


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text",
                  share: int = 20, row_col: str | None = None) -> DataFrame:
    """Per document: n_words, n_hit, ``hit_spans`` (array of start word and length),
    ``item_ids`` (sorted array of ids that occur, then a null for each item without an id)
    and contaminated (n_hit > 0 and share * n_hit >= n_words).

    Rows with the same id count as one document: their hits are united and the larger
    word count is given; each row without an id is one document. ``row_col`` names a column
    of saved row ids in docs, where the caller has one: documents without an id have theirs
    in the result, the others null.
    """
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark)
    rid = F.col(row_col) if row_col else F.monotonically_increasing_id()
    src = docs.select(rid.alias("rid"), F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("long").alias("doc"))
    src = src if row_col else scratch.save(src)
    item = F.col(item_col).cast("long")
    bench = items.select(F.coalesce(item, F.monotonically_increasing_id()).alias("id"), F.col(item_text_col).cast("string").alias("text"),
                         item.isNull().alias("own")).filter("text is not null")
    windows = scratch.save(item_windows(bench))
    sizes = windows.groupBy("n").agg(F.count("*").alias("c")).collect()     # at most 13 rows
    short = sorted(r["n"] for r in sizes if r["n"] < SPAN)
    tests = scratch.save(fingerprints(bench, []).select("h", "n")
                         .union(windows.filter(f"n < {SPAN}").select("key", "n")).distinct())
    small = tests.count() <= BROADCAST_ROWS
    few = sum(r["c"] for r in sizes) <= BROADCAST_ROWS // 8     # these carry their words
    marks = fingerprints(src.select("rid", "text"), short).withColumnRenamed("id", "rid")
    hits = (marks.join(F.broadcast(tests) if small else tests, ["h", "n"], "left_semi")
            .select("rid", "p", "n").distinct()
            .groupBy("rid").agg(F.collect_list(F.struct("p", "n")).alias("hits")))
    cand = _candidates(src.join(hits, "rid", "left").select("rid", "text", "hits", "doc"))
    found = cand.join(F.broadcast(windows) if few else windows, ["key", "n", "spelled"], "left")
    per = found.groupBy("doc", F.when(F.col("doc").isNull(), F.col("rid")).alias("rid")).agg(
        F.max("n_words").alias("n_words"),
        F.collect_set(F.when(F.col("item").isNotNull(), F.struct("at", "n"))).alias("spans"),
        F.collect_set(F.when(F.col("item").isNotNull(), F.struct("own", "item"))).alias("items"))
    ids = F.transform(F.array_sort("items"), lambda x: F.when(~x["own"], x["item"]))
    spans = F.array_sort("spans")
    # spans ordered by start: covered words are counted up to the furthest end so far
    hit = F.aggregate(spans, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("e")),
                      lambda acc, s: F.struct(
                          (acc["n"] + F.greatest(F.lit(0).cast("long"),
                                                 s["at"] + s["n"] - F.greatest(acc["e"], s["at"].cast("long")))).alias("n"),
                          F.greatest(acc["e"], (s["at"] + s["n"]).cast("long")).alias("e")))["n"]
    return (per.select(F.col("doc").alias(id_col), *([F.col("rid").alias(row_col)] if row_col else []), "n_words", hit.alias("n_hit"),
                       spans.alias("hit_spans"), ids.alias("item_ids"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))))


def digest(result: DataFrame) -> DataFrame:
    """The contract's columns from the operator's result."""
    joined = F.array_join(F.array_sort(F.transform("item_ids", lambda x: x.cast("string"))), ",")
    return result.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                         F.sha2(joined, 256).alias("items_sha256"), "contaminated")
