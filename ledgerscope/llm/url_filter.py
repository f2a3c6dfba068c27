"""Operator 2: URL filter, rules first and gradient-boosted trees on lexical features.

DataFrame expressions and Spark ML only. The host stands after the first ``://`` up to
``/``, ``?``, ``#`` or the end (A-Z lower-cased), the path from there up to ``?``, ``#`` or
the end. A rule is ``host`` + ``path prefix``; it fits its host and all subdomains if the
path starts with its path, and the longest fitting rule decides. Urls that a rule decides
are the labelled ones; trees learn from them to judge the rest by lexical features: length,
depth, digit ratio, character entropy, counts of parameters, labels and hyphens, and the
share of blocked urls among labelled ones of the same host suffix and file suffix
(smoothed; the suffix tables are broadcast below SUFFIX_ROWS rows and joined beyond). While
fitting, a labelled url's shares come from the urls of the other FOLDS - 1 folds, so that no
share holds the url's own label.

Fitting uses at most ``fit_rows`` labelled urls (least hash of the id first); Spark ML
builds the trees from histograms of these. Every url is judged.

Results: a null url and one without ``://`` have empty host and path and no rule; with
labels of one kind only every other url gets that verdict, without any label ``allow``;
repeated rows repeat their result; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ledgerscope.llm._shared import Scratch

RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block")]
FIT_ROWS = 20_000
SUFFIX_ROWS = 100_000
FOLDS = 5
PRIOR = 10.0           # labelled urls that an even share counts as in a suffix's share
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, query) as strings, empty where there is none."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path, F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):      # the longest is asked first
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest if "/" in text else "")
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Bits per character."""
    def bits(c):
        p = (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / F.length(text)
        return -p * F.log2(p)
    chars = F.filter(F.array_distinct(F.split(text, "")), lambda c: c != "")
    return F.coalesce(F.aggregate(F.transform(chars, bits), F.lit(0.0), lambda a, b: a + b), F.lit(0.0))


FEATURES = ["f_length", "f_host_length", "f_path_length", "f_depth", "f_labels", "f_digits", "f_entropy",
            "f_params", "f_hyphens", "f_fragment", "f_secure", "f_host_share", "f_file_share"]


def lexical(urls: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """(row id, url) -> host, path, rule, labelled verdict, suffixes and lexical features."""
    d = urls.withColumn("u", F.coalesce("url", F.lit("")))
    host, path, query = split_url(F.col("u"))
    d = d.withColumns({"host": host, "path": path, "query": query})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    size = F.greatest(F.length("u"), F.lit(1)).cast("double")
    d = d.withColumns({"rule": rule, "ruled": verdict})
    return d.withColumns({
        "host_suffix": F.substring_index("host", ".", -2),
        "file_suffix": F.regexp_extract("path", r"\.([A-Za-z0-9]{1,8})$", 1),
        "f_length": F.length("u").cast("double"),
        "f_host_length": F.length("host").cast("double"),
        "f_path_length": F.length("path").cast("double"),
        "f_depth": (F.length("path") - F.length(F.replace("path", F.lit("/"), F.lit("")))).cast("double"),
        "f_labels": (F.length("host") - F.length(F.replace("host", F.lit("."), F.lit("")))).cast("double"),
        "f_digits": F.length(F.regexp_replace("u", "[^0-9]", "")) / size,
        "f_entropy": entropy(F.col("u")),
        "f_params": F.when(F.col("query") == "", 0.0).otherwise(
            1.0 + F.length("query") - F.length(F.replace("query", F.lit("&"), F.lit("")))),
        "f_hyphens": (F.length("host") - F.length(F.replace("host", F.lit("-"), F.lit("")))).cast("double"),
        "f_fragment": F.col("u").contains("#").cast("double"),
        "f_secure": F.col("u").startswith("https").cast("double"),
    })


def with_share(d: DataFrame, fit: DataFrame, suffix: str, name: str, overall: float) -> DataFrame:
    """Adds the smoothed share of blocked urls among the labelled ones of a suffix."""
    table = fit.groupBy(suffix).agg(((F.sum("y") + PRIOR * overall) / (F.count("*") + PRIOR)).alias(name))
    few = table.count() <= SUFFIX_ROWS          # at most as many rows as labelled urls are fitted on
    return d.join(F.broadcast(table) if few else table, suffix, "left").withColumn(name, F.coalesce(name, F.lit(overall)))


def out_of_fold(fit: DataFrame, suffix: str, name: str, overall: float) -> DataFrame:
    """Adds to each labelled url (at most ``fit_rows`` of them) its suffix's share among the
    urls of the other folds."""
    every, own = W.partitionBy(suffix), W.partitionBy(suffix, "fold")
    blocked = F.sum("y").over(every) - F.sum("y").over(own)
    n = F.count("*").over(every) - F.count("*").over(own)
    return fit.withColumn(name, (blocked + PRIOR * overall) / (n + PRIOR))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: list[tuple[str, str]] = RULES,
          fit_rows: int = FIT_ROWS, trees: int = 12, depth: int = 4, threshold: float = 0.5) -> DataFrame:
    """Per row: id, host, path, rule, verdict, p_block (the trees' probability)."""
    d = lexical(pages.select(F.col(id_col).alias("row"), F.col(url_col).cast("string").alias("url")), rules)
    scratch = Scratch(pages.sparkSession)
    fit = scratch.save(d.filter(F.col("ruled").isNotNull() & F.col("row").isNotNull())
                       .withColumn("y", (F.col("ruled") == "block").cast("double"))
                       .orderBy(F.xxhash64("row", F.lit(2)), "url").limit(fit_rows)
                       .select("host_suffix", "file_suffix", "y", F.pmod(F.xxhash64("row", F.lit(5)), FOLDS).alias("fold"), *FEATURES[:-2]))
    n, blocked = fit.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    overall = blocked / n if n else 0.0
    if overall in (0.0, 1.0):
        scored = d.withColumn("p_block", F.lit(overall))
    else:
        wide = [d, fit]
        for suffix, name in (("host_suffix", "f_host_share"), ("file_suffix", "f_file_share")):
            wide = [with_share(wide[0], fit, suffix, name, overall), out_of_fold(wide[1], suffix, name, overall)]
        # both verdicts weigh the same, whatever the rules' shares are
        weight = F.when(F.col("y") == 1, n / (2.0 * blocked)).otherwise(n / (2.0 * (n - blocked)))
        wide[1] = wide[1].withColumn("w", weight)
        vec = VectorAssembler(inputCols=FEATURES, outputCol="x")
        model = GBTClassifier(featuresCol="x", labelCol="y", weightCol="w", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=1,
                              maxBins=32, cacheNodeIds=False).fit(vec.transform(wide[1]))
        scored = model.transform(vec.transform(wide[0])).withColumn("p_block", vector_to_array("probability")[1])
    verdict = F.coalesce("ruled", F.when(F.col("p_block") >= threshold, "block").otherwise("allow"))
    return scored.select(F.col("row").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "p_block")
