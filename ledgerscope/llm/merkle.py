"""Operator 13: Merkle manifest of a dataset, climbed by a recursive query.

Building. Every row's digest is a leaf. Leaves are numbered inside their language by doc_id;
runs of ``FAN`` consecutive nodes become their digest, level by level, until one node is left
for each language, its subroot; subroots are numbered by language and built up likewise to
the root. Every run is stored as a node row (run id, its kids' digests, own digest) with a
link to its parent run and its place there.

Climbing. One recursive SQL query starts from the runs that hold leaves and follows the
parent links. A bundle is the leaves of one run: above that run they have all siblings in
common, so the siblings are appended once a bundle, and each leaf's digest (of the tampered
text where a row was tampered with) is folded with them. At the root a bundle is taken
apart: a leaf's proof is its own run's siblings, then the bundle's; the folded digest is
compared with the root.

Scale: SQL functions only. Numbering sorts by range pieces of a saved table and adds counts
of the pieces before, so one language may hold all rows; a level has an eighth of the rows
of the level below; the climb carries 1/8 row a leaf with a proof that grows with the
logarithm of the rows. Counts by piece (as many as pieces and languages) are joined, not
collected; the driver loops over levels only.

Results: a null in any column counts as ``-``; null languages are one language, first in
order; null doc_ids stand first and are never tampered with; rows that repeat a doc_id are
leaves of their own in the order of their digests, so equal rows have different places; a
lone leaf is its own subroot; with one leaf in all the proof is the digest of nothing; an
empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerscope.llm._shared import Scratch

FAN = 8
TOP = -1                      # the tree over the subroots; languages are 0, 1, ...
PIECE_ROWS = 10_000           # rows of a sorted piece,
PIECES = 20_000               # or as many as make this number of pieces
BROADCAST_LANGS = 10_000
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def field(c: Column) -> Column:
    """``-`` for a null, else UTF-8 byte count, ``:``, value."""
    s = c.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_digest(text: Column) -> Column:
    cols = [text if c == "text" else F.col(c) for c in COLUMNS]
    return F.unhex(F.sha2(F.concat(*[field(c) for c in cols]), 256))


def tampered_text() -> Column:
    """A-Z of the text lower-cased where 3 divides the crc32 of the decimal doc_id."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(hit, low).otherwise(F.col("text"))


def numbered(df: DataFrame, scratch: Scratch, group: str, order: list[str], rows: int, out: str) -> DataFrame:
    """df, saved, with ``out``: its row's place from 0 in ``order`` (nulls first) inside ``group``."""
    keys = [F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]]
    pieces = max(1, -(-rows // max(PIECE_ROWS, rows // PIECES)))
    cut = df.repartitionByRange(pieces, *keys).withColumn("piece", F.spark_partition_id())
    cut = scratch.save(cut)                           # the pieces of a sample are fixed by saving them
    inside = W.partitionBy(group, "piece").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    count = cut.groupBy(group, "piece").agg(F.count("*").alias("n"))
    before = W.partitionBy(group).orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    count = count.select(F.col(group).alias("g2"), F.col("piece").alias("p2"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    got = cut.withColumn("at", F.row_number().over(inside) - 1).join(
        count, F.col(group).eqNullSafe(F.col("g2")) & (F.col("piece") == F.col("p2")))
    return got.withColumn(out, (F.col("base") + F.col("at")).cast("long")).drop("g2", "p2", "base", "at", "piece")


def build(leaves: DataFrame, scratch: Scratch, most: int) -> tuple[DataFrame | None, DataFrame]:
    """(run rows, the one node left of each group) of ``leaves`` (grp, idx, digest, n).

    n is the group's number of nodes on this level and ``most`` its maximum. A run row has
    grp, level, idx, kids, digest and n, the number of runs beside it.
    """
    level, runs, nodes, tops = 0, None, leaves, leaves.filter("n = 1")
    while most > 1:
        level += 1
        up = (nodes.filter("n > 1").groupBy("grp", F.expr(f"idx div {FAN}").alias("idx"))
              .agg(F.sort_array(F.collect_list(F.struct("idx", "digest"))).getField("digest").alias("kids"),
                   F.expr(f"(max(n) + {FAN - 1}) div {FAN}").alias("n")))
        up = scratch.save(up.select("grp", F.lit(level).alias("level"), "idx", "kids",
                                    F.unhex(F.sha2(hexes(F.col("kids")), 256)).alias("digest"), "n"))
        runs = up if runs is None else runs.unionByName(up)
        nodes = up
        tops = tops.select("grp", "digest").union(up.filter("n = 1").select("grp", "digest"))
        most = -(-most // FAN)
    return runs, tops.select("grp", "digest")


def hexes(kids: Column) -> Column:
    return F.array_join(F.transform(kids, lambda k: F.lower(F.hex(k))), "")


def manifest(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """(leaves: row, doc_id, leaf, altered, grp, idx, rank | run rows of all trees, linked | root)."""
    base = docs.select(*COLUMNS)
    rows = scratch.save(base.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.col("lang").cast("string").alias("lang"),
        leaf_digest(F.col("text")).alias("leaf"), leaf_digest(tampered_text()).alias("altered")))
    langs = scratch.save(rows.groupBy("lang").agg(F.count("*").alias("n")))
    n_langs, n_rows, most = langs.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.max("n")).first()
    if not n_rows:
        return rows, None, None
    langs = langs.withColumn("one", F.lit(0))
    langs = scratch.save(numbered(langs, scratch, "one", ["lang"], n_langs, "grp").select("grp", "n", "lang"))
    place = langs.select(F.col("lang").alias("l2"), "grp", "n")
    few = n_langs <= BROADCAST_LANGS
    rows = rows.join(F.broadcast(place) if few else place, F.col("lang").eqNullSafe(F.col("l2"))).drop("lang", "l2")
    leaves = scratch.save(numbered(rows, scratch, "grp", ["doc_id", "leaf", "row"], n_rows, "idx"))
    runs, subroots = build(leaves.select("grp", "idx", F.col("leaf").alias("digest"), "n"), scratch, most)
    top = subroots.select(F.lit(TOP).cast("long").alias("grp"), F.col("grp").alias("idx"), "digest", F.lit(n_langs).cast("long").alias("n"))
    top_runs, root = build(scratch.save(top), scratch, n_langs)
    runs = [r for r in (runs, top_runs) if r is not None]
    if not runs:
        return leaves, None, root
    runs = runs[0] if len(runs) == 1 else runs[0].unionByName(runs[1])
    return leaves, scratch.save(linked(runs, n_langs)), root


def linked(runs: DataFrame, n_langs: int) -> DataFrame:
    """Run rows with their parent run (p_grp, p_level, p_idx) and place there; null at the root."""
    up = F.col("n") > 1                                          # the parent is in the same tree
    over = ~up & (F.col("grp") != TOP) & F.lit(n_langs > 1)      # a subroot: the parent is in the top tree
    at = F.when(up, F.col("idx")).when(over, F.col("grp"))
    return runs.select(
        "grp", "level", "idx", "kids", "digest",
        F.when(up, F.col("grp")).when(over, F.lit(TOP)).cast("long").alias("p_grp"),
        F.when(up, F.col("level") + 1).when(over, F.lit(1)).alias("p_level"),
        F.floor(at / FAN).cast("long").alias("p_idx"), F.pmod(at, F.lit(FAN)).cast("int").alias("pos"))


CLIMB = """
WITH RECURSIVE climb(bundle, p_grp, p_level, p_idx, pos, proof, folded) AS (
  SELECT bundle, p_grp, p_level, p_idx, pos, proof, folded FROM {start}
  UNION ALL
  SELECT c.bundle, r.p_grp, r.p_level, r.p_idx, r.pos,
         concat(c.proof, array_join(transform(
             filter(r.kids, (k, i) -> i <> c.pos), k -> lower(hex(k))), '')),
         transform(c.folded, f -> unhex(sha2(concat(
             array_join(transform(slice(r.kids, 1, c.pos), k -> lower(hex(k))), ''), lower(hex(f)),
             array_join(transform(slice(r.kids, c.pos + 2, {fan}), k -> lower(hex(k))), '')), 256)))
  FROM climb c JOIN {runs} r ON r.grp = c.p_grp AND r.level = c.p_level AND r.idx = c.p_idx)
SELECT bundle, proof, folded FROM climb WHERE p_grp IS NULL
"""


def climb(start: DataFrame, runs: DataFrame, scratch: Scratch) -> DataFrame:
    """The bundles at the root: bundle, proof (hex digests of the siblings met), folded.

    Spark's bound on the rows of a recursion is lifted for this one query, whose rows are
    bundles times levels; its result is saved, so the setting is back before we return.
    """
    spark, tag = start.sparkSession, uuid.uuid4().hex
    names = {"start": f"merkle_start_{tag}", "runs": f"merkle_runs_{tag}"}
    start.createOrReplaceTempView(names["start"])
    runs.createOrReplaceTempView(names["runs"])
    key = "spark.sql.cteRecursionRowLimit"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "-1")
    try:
        return scratch.save(spark.sql(CLIMB.format(fan=FAN, **names)))
    finally:
        spark.conf.set(key, old) if old is not None else spark.conf.unset(key)
        for name in names.values():
            spark.catalog.dropTempView(name)


def bundles(leaves: DataFrame, runs: DataFrame, n_langs: int) -> DataFrame:
    """One row per run that holds leaves (or lone leaf): its members and where it goes on."""
    low = runs.filter(f"level = 1 and grp <> {TOP}").select(
        F.col("grp").alias("g"), F.col("idx").alias("i"), "kids", "p_grp", "p_level", "p_idx", "pos")
    member = F.struct("idx", "row", "doc_id", "leaf", "altered")
    inside = (leaves.filter("n > 1").groupBy("grp", F.expr(f"idx div {FAN}").alias("run"))
              .agg(F.sort_array(F.collect_list(member)).alias("members"))
              .join(low, (F.col("grp") == F.col("g")) & (F.col("run") == F.col("i"))))

    def around(f: Column, i: Column) -> Column:
        return F.unhex(F.sha2(F.concat(hexes(F.slice("kids", F.lit(1), i)), F.lower(F.hex(f)),
                                       hexes(F.slice("kids", i + 2, F.lit(FAN)))), 256))
    inside = inside.select(
        F.concat_ws("/", "grp", "run").alias("bundle"), "members", "p_grp", "p_level", "p_idx", "pos", "kids",
        F.transform("members", lambda m, i: around(m["altered"], i)).alias("folded"))
    over = F.lit(n_langs > 1)
    lone = leaves.filter("n = 1").select(
        F.concat_ws("/", "grp", F.lit("0")).alias("bundle"), F.array(member).alias("members"),
        F.when(over, F.lit(TOP)).cast("long").alias("p_grp"), F.when(over, F.lit(1)).alias("p_level"),
        F.when(over, F.floor(F.col("grp") / FAN)).cast("long").alias("p_idx"),
        F.when(over, F.pmod("grp", F.lit(FAN))).cast("int").alias("pos"),
        F.array().cast("array<binary>").alias("kids"), F.array("altered").alias("folded"))
    return inside.unionByName(lone)


def prove(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    scratch = Scratch(docs.sparkSession)
    leaves, runs, root = manifest(docs, scratch)
    if root is None:
        none = [F.lit(None).cast("string").alias(c) for c in ("subroot", "root", "proof_sha256", "folded_root")]
        return leaves.select("doc_id", F.lower(F.hex("leaf")).alias("leaf"), *none, F.lit(None).cast("boolean").alias("verified")).limit(0)
    top = root.first()["digest"]                                  # one digest
    n_langs = leaves.select("grp").distinct().count()
    if runs is None:                                              # one leaf in all
        runs = docs.sparkSession.createDataFrame([], "grp long, level int, idx long, kids array<binary>, digest binary, "
                                                     "p_grp long, p_level int, p_idx long, pos int")
    start = scratch.save(bundles(leaves, runs, n_langs))
    state = start.select("bundle", "p_grp", "p_level", "p_idx", "pos", F.lit("").alias("proof"), "folded")
    at_root = climb(state, runs, scratch).withColumnRenamed("folded", "ended")
    subroot = runs.filter("p_grp is null or (p_grp = -1 and grp <> -1)").filter(f"grp <> {TOP}").select("grp", F.col("digest").alias("sub"))
    subroot = subroot.union(leaves.filter("n = 1").select("grp", F.col("leaf").alias("sub"))).withColumnRenamed("grp", "sg")
    got = start.select("bundle", "members", "kids").join(at_root, "bundle")
    got = got.select(F.substring_index("bundle", "/", 1).cast("long").alias("grp"), "kids", "proof", "ended",
                     F.posexplode("members").alias("i", "m"))
    got = got.join(F.broadcast(subroot) if n_langs <= BROADCAST_LANGS else subroot, F.col("grp") == F.col("sg"))
    own = hexes(F.filter("kids", lambda k, i: i != F.col("i")))
    folded = F.lower(F.hex(F.col("ended")[F.col("i")]))
    head = F.lower(F.hex(F.lit(bytes(top))))
    return got.select(
        F.col("m.doc_id").alias("doc_id"), F.lower(F.hex("m.leaf")).alias("leaf"), F.lower(F.hex("sub")).alias("subroot"),
        head.alias("root"), F.sha2(F.concat(own, "proof"), 256).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == head).alias("verified"))


# ------------------------------------------------------------------ the same in SQL, level by level
LEVELS = 9        # 8 ** 9 leaves a language


def oracle() -> str:
    """DuckDB SQL for ``prove``: the levels written out, without recursion."""
    def part(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR END"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = ("xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT), "
           "lambda a, b: list_reduce([xor(a, b)] || range(8), lambda p, q: xor(p >> 1, (p & 1) * 3988292384))), 4294967295)")
    rows = " || ".join(part(c) for c in COLUMNS)
    bad = " || ".join(part("bent") if c == "text" else part(c) for c in COLUMNS)
    ctes = [f"""d AS (SELECT *, CASE WHEN {crc} % 3 = 0 THEN {low} ELSE text END AS bent FROM documents),
h AS (SELECT doc_id, lang, sha256({rows}) AS leaf, sha256({bad}) AS altered FROM d),
l0 AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS grp,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
  count(*) OVER (PARTITION BY lang) AS n FROM h),
n0 AS (SELECT grp, idx, leaf AS digest, n FROM l0)"""]
    for k in range(1, LEVELS + 1):
        ctes.append(f"""n{k} AS (SELECT grp, idx // 8 AS idx,
  CASE WHEN max(n) = 1 THEN max(digest) ELSE sha256(string_agg(digest, '' ORDER BY idx)) END AS digest,
  (max(n) + 7) // 8 AS n FROM n{k - 1} GROUP BY grp, idx // 8)""")
    ctes.append(f"t0 AS (SELECT 0 AS grp, grp AS idx, digest, count(*) OVER () AS n FROM n{LEVELS})")
    for k in range(1, 4):
        ctes.append(f"""t{k} AS (SELECT 0 AS grp, idx // 8 AS idx,
  CASE WHEN max(n) = 1 THEN max(digest) ELSE sha256(string_agg(digest, '' ORDER BY idx)) END AS digest,
  (max(n) + 7) // 8 AS n FROM t{k - 1} GROUP BY idx // 8)""")
    chain, last = [("n", LEVELS), ("t", 3)], "l0"
    ctes.append("c0 AS (SELECT *, idx AS loc, '' AS proof, altered AS folded FROM l0)")
    step, prev = 0, "c0"
    for name, levels in chain:
        key = "grp" if name == "n" else "0"
        for k in range(levels):
            step += 1
            src = f"(SELECT grp, idx // 8 AS run, max(n) AS n, list(digest ORDER BY idx) AS kids FROM {name}{k} GROUP BY grp, idx // 8)"
            kids = "list_filter(r.kids, lambda x, i: i <> c.loc % 8 + 1)"
            ctes.append(f"""c{step} AS (SELECT c.* REPLACE (c.loc // 8 AS loc,
  c.proof || coalesce(array_to_string({kids}, ''), '') AS proof,
  CASE WHEN r.n = 1 THEN c.folded ELSE sha256(coalesce(array_to_string(r.kids[1:c.loc % 8], ''), '') || c.folded
    || coalesce(array_to_string(r.kids[c.loc % 8 + 2:8], ''), '')) END AS folded)
  FROM {prev} c JOIN {src} r ON r.grp = {'c.grp' if key == 'grp' else '0'} AND r.run = c.loc // 8)""")
            prev = f"c{step}"
        if name == "n":
            step += 1
            ctes.append(f"c{step} AS (SELECT * REPLACE (grp AS loc) FROM {prev})")
            prev = f"c{step}"
    return "WITH " + ",\n".join(ctes) + f"""
SELECT c.doc_id, c.leaf, s.digest AS subroot, r.digest AS root, sha256(c.proof) AS proof_sha256,
  c.folded AS folded_root, c.folded = r.digest AS verified
FROM {prev} c JOIN n{LEVELS} s ON s.grp = c.grp, t3 r"""

