r"""Operator 3: quality rules on repeated lines across documents.

DataFrame expressions only. Lines are the \n-separated parts that hold a word; a line's
key is the hash of its normal form (lower-cased, digits as 0, white space as one blank,
trimmed). The number of documents of a host that hold a line is counted over the whole
table; a line in more than ``min_docs`` of them is removed, and a document that
loses too large a part of its words is rejected. Besides, base rules look at the document
alone: too few words, or too many in repeated three-word windows.

The limit is a number of documents, the same on small and large hosts: a line that is held
often is no less repeated where its host holds much else. Counts are keyed by host and line, so a host with a third of all
documents is spread over all tasks and combined map-side; one line that a third of the
documents hold is a count too, and its removal is a join with a table of frequent lines
(broadcast below FREQUENT_ROWS counted rows, else AQE splits the hot key).

Results: null and wordless texts have no words, lines or removals and fail the base rules;
a null host is a host of its own; repeated rows are separate documents; empty tables give
empty results; everything in a text counts, however long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerscope.llm._shared import Scratch

SPACE = r"[ \t-\r]+"
MIN_DOCS = 20                      # a line is frequent beyond so many documents of its host
LEAST_LEFT = 0.5                   # part of the words that must be left
FREQUENT_ROWS = 200_000


def let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def repeated_words(words: Column, n: int = 3) -> Column:
    """Words that lie in n-word windows found at least twice, the first included."""
    def covered(at: Column) -> Column:          # window starts in order: each covers to the next start, n at most
        steps = F.transform(at, lambda x, i: F.when(i + 1 < F.size(at), F.least(F.lit(n), F.get(at, i + 1) - x)).otherwise(n))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)

    def again(s: Column) -> Column:             # windows sorted by hash: equal to a neighbour
        same = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
        return let(F.array_sort(F.transform(same, lambda x: x["i"])), covered)

    def windows(w: Column) -> Column:
        hashed = F.transform(F.slice(w, 1, F.size(w) - (n - 1)),
                             lambda x, i: F.struct(F.xxhash64(x, *[F.get(w, i + k) for k in range(1, n)]).alias("h"), i.alias("i")))
        return let(hashed, lambda g: F.when(F.size(F.array_distinct(F.transform(g, lambda x: x["h"]))) == F.size(g), F.lit(0).cast("long"))
                   .otherwise(let(F.array_sort(g), again)))
    return let(words, lambda w: F.when(F.size(w) < n + 1, F.lit(0).cast("long")).otherwise(windows(w)))


def line_key(line: Column) -> Column:
    normal = F.translate(F.lower(line), "123456789", "000000000")
    return F.xxhash64(F.trim(F.regexp_replace(normal, SPACE, " ")))


def line_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                 min_docs: int = MIN_DOCS, least_left: float = LEAST_LEFT, least_words: int = 50,
                 max_repeat_percent: int = 50) -> DataFrame:
    """Per row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_lines, n_removed_lines, n_removed_words, kept."""
    scratch = Scratch(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(host_col).cast("string").alias("host"), text.alias("t"))
    d = d.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: F.translate(x, " \t\n\x0b\x0c\r", "") != ""))
    base = scratch.save(d.select(
        F.monotonically_increasing_id().alias("row"), "id", "host",
        F.size(words_of(F.col("t"))).cast("long").alias("n_words"),
        F.length(F.translate("t", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(words_of(F.col("t"))).alias("n_repeat_words"),
        F.transform("lines", lambda x: F.struct(line_key(x).alias("key"), F.size(words_of(x)).alias("words"))).alias("lines")))
    held = base.select("host", F.explode(F.array_distinct(F.transform("lines", lambda x: x["key"]))).alias("key"))
    seen = held.groupBy("host", "key").agg(F.count("*").alias("n_docs")).filter(F.col("n_docs") > min_docs)
    frequent = scratch.save(seen.select(F.col("host").alias("fhost"), F.col("key").alias("fkey")))
    few = frequent.count() <= FREQUENT_ROWS
    lines = base.select("row", "host", F.explode("lines").alias("x")).select("row", "host", "x.key", "x.words")
    gone = (lines.join(F.broadcast(frequent) if few else frequent, (F.col("key") == F.col("fkey")) & F.col("host").eqNullSafe(F.col("fhost")))
            .groupBy("row").agg(F.count("*").alias("n_removed_lines"), F.sum("words").alias("n_removed_words")))
    got = base.join(gone, "row", "left")
    base_failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    removed = F.coalesce("n_removed_words", F.lit(0).cast("long"))
    return got.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), F.size("lines").cast("long").alias("n_lines"),
        F.coalesce("n_removed_lines", F.lit(0).cast("long")).alias("n_removed_lines"), removed.alias("n_removed_words"),
        (~base_failed & (F.col("n_words") - removed >= least_left * F.col("n_words"))).alias("kept"))


def without_frequent_lines(docs: DataFrame, frequent: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The documents with their frequent lines (fhost, fkey) taken out of the text."""
    keys = frequent.groupBy("fhost").agg(F.collect_set("fkey").alias("_keys"))
    both = docs.join(keys, F.col(host_col).eqNullSafe(F.col("fhost")), "left")
    kept = F.filter(F.split(text_col, "\n"), lambda x: ~F.array_contains(F.coalesce("_keys", F.array().cast("array<bigint>")), line_key(x)))
    return both.withColumn(text_col, F.array_join(kept, "\n")).select(*docs.columns)
