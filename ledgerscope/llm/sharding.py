"""Operator 8: sharding by sampled splitters, sizes near equal (law ``bytes``).

DataFrame expressions only. A record's key is the hash of its text, then its doc_id, so
equal texts stand together and one group of copies can still be cut. Keys are sampled with
a chance that grows with the record's size (by hash, so the sample is the same on every
run), and their quantiles are the splitters of many small ranges. Ranges that come out
overfull (one hot text, or a bad draw) are subdivided by the hash of doc_id. Running sums
inside the small ranges, plus the sums of all ranges before, place every record on the line
of all bytes; equal parts of that line are the shards, whose sizes differ by one record at
most. Slots number a shard's records from 0 in the same order.

Scale: the number of ranges follows the number of records (RANGE_ROWS each), so windows
stay small; the sample has a fixed expected size per range; what is broadcast is one row
for each range or shard.

Results: null text has size 1 and crc32 0 like the empty text; repeated rows are separate
records (told apart by a row number of the input scan); null doc_ids are allowed; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerscope.llm._shared import Scratch

RANGE_ROWS = 4_000
PER_RANGE = 20            # sampled keys for each range
MAX_RANGES = 1 << 17      # the driver holds PER_RANGE keys for each; beyond, ranges grow


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, size, text_crc32, law, shard, slot, grown_shard (null for this law)."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rec = scratch.save(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("crc"),
        F.xxhash64(text).alias("h")))
    rec = rec.withColumn("pos", F.col("h") / F.lit(2.0**63))          # in [-1, 1)
    n, total = rec.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = min(MAX_RANGES, max(4 * shards, -(-n // RANGE_ROWS)))
    # a record is drawn with chance size * rate, at most 1
    unit = (F.xxhash64("id", "row", F.lit(8)) / F.lit(2.0**63) + 1) / 2
    drawn = rec.filter(unit < F.col("size") * (PER_RANGE * ranges / max(1, total))).select("pos").orderBy("pos")
    keys = [r["pos"] for r in drawn.collect()]                        # about PER_RANGE * ranges numbers
    inner = sorted({keys[i * len(keys) // ranges] for i in range(1, ranges)} - {-1.0}) if keys else []
    splits = [-float("inf"), *inner, float("inf")] if inner else [-float("inf"), 0.0, float("inf")]
    placed = Bucketizer(splits=splits, inputCol="pos", outputCol="range").transform(rec)
    # overfull ranges: as many parts as they hold ordinary ranges
    load = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    parts = F.ceil(F.greatest(F.col("bytes") / F.lit(2.0 * max(1, total) / ranges), F.col("rows") / F.lit(2.0 * max(1, n) / ranges), F.lit(1.0)))
    load = load.select("range", F.when(parts > 1, 2 * parts).otherwise(1).cast("long").alias("parts"))
    placed = placed.join(F.broadcast(load), "range").withColumn("part", F.pmod(F.xxhash64("id", "row"), F.col("parts")))
    # sums of the ranges before each: one row per range part
    per = placed.groupBy("range", "part").agg(F.sum("size").alias("bytes"))
    order = W.orderBy("range", "part").rowsBetween(W.unboundedPreceding, -1)
    offset = per.select("range", "part", F.coalesce(F.sum("bytes").over(order), F.lit(0)).alias("before"))
    inside = W.partitionBy("range", "part").orderBy("h", "id", "row")
    line = (placed.withColumns({"run": F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, -1)),
                                "rank": F.row_number().over(inside) - 1})
            .join(F.broadcast(offset), ["range", "part"])
            .withColumn("at", F.col("before") + F.coalesce("run", F.lit(0)) + F.expr("size div 2")))
    line = line.withColumn("shard", F.least(F.lit(shards - 1), F.expr(f"at * {shards} div {max(1, total)}")).cast("int"))
    line = scratch.save(line.select("row", "id", "size", "crc", "range", "part", "rank", "shard"))
    # slots: rank inside (range part, shard) plus the counts of the range parts before in the shard
    cell = line.groupBy("shard", "range", "part").agg(F.count("*").alias("rows"), F.min("rank").alias("first"))
    before = W.partitionBy("shard").orderBy("range", "part").rowsBetween(W.unboundedPreceding, -1)
    cell = cell.select("shard", "range", "part", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("prior"))
    got = line.join(F.broadcast(cell), ["shard", "range", "part"])
    return got.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
                      (F.col("prior") + F.col("rank") - F.col("first")).cast("long").alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"))
