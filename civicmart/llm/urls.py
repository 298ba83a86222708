"""URL filters: rules by host and path, and gradient-boosted trees for the URLs no rule decides.

The trees read lexical features: length, depth, digit ratio, entropy, parameter counts, and
statistics of suffixes (how often the host's last one and two labels, and the first path segment,
are blocked among labelled URLs). They are trained with Spark's own distributed GBTClassifier on
every labelled URL. Suffix statistics are kept for each suffix by its own text, whatever their number,
and joined to the URLs by ordinary joins: small tables are broadcast by the planner's own size
check, others shuffled, where adaptive execution splits a hot suffix.

A labelled URL must not see its own label in its rates, or a suffix seen once gives it away. URLs are
put in ``FOLDS`` folds by their text (equal URLs share one), and in training a URL's rates come from the
other folds; a suffix that only its own fold has reads 0.5, as an unknown one does in use.

Defined results: a null url, or one without ``://``, has an empty host and path and meets no rule;
without labelled URLs the trees' verdict is allow, with labels of one kind it is that kind; a
probability of exactly 0.5 is block; rules of equal length go by their text; repeated rows each get
their own row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path); a rule fits its host and all subdomains, and paths that start with its path.
RULES: tuple[tuple[str, str, str], ...] = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
ROUNDS, DEPTH, RATE = 10, 3, 0.3
SEED = 11
FOLDS = 5
FEATURES = ("length", "host_length", "depth", "labels", "digit_ratio", "entropy", "parameters", "hyphens")
SUFFIXES = ("suffix1", "suffix2", "segment")


def parsed(urls: DataFrame) -> DataFrame:
    """page_id, url, host and path."""
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"://([^/?#]*)", 1)
    path = F.regexp_extract(F.coalesce("url", F.lit("")), r"://[^/?#]*([^?#]*)", 1)
    return pick(urls, "page_id", "url").select("page_id", "url", F.translate(host, UPPER, LOWER).alias("host"), path.alias("path"))


def ruled(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """With ``rule`` and ``rule_verdict``: those of the longest rule that fits, else null."""
    fits = lambda h, p: ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))

    def first(value) -> Column:
        start = F.when(fits(*ordered[0][1:]), F.lit(value(ordered[0])))
        return reduce(lambda c, r: c.when(fits(*r[1:]), F.lit(value(r))), ordered[1:], start)

    none = F.lit(None).cast("string")
    if not ordered:
        return pages.withColumns({"rule": none, "rule_verdict": none})
    return pages.withColumns({"rule": first(lambda r: r[1] + r[2]), "rule_verdict": first(lambda r: r[0])})


def _entropy(text: Column) -> Column:
    """Bits per character of the distribution of characters."""
    n = F.length(text).cast("double")
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    each = F.transform(F.array_distinct(F.split(text, "")), lambda c: F.when(F.length(c) > 0, -share(c) * F.log2(share(c))).otherwise(0.0))
    return F.when(F.length(text) > 0, F.aggregate(each, F.lit(0.0), lambda a, x: a + x)).otherwise(0.0)


def lexical(pages: DataFrame) -> DataFrame:
    """With the lexical features and the suffixes."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    n = F.greatest(F.length(url), F.lit(1)).cast("double")
    count = lambda text, chars: (F.length(text) - F.length(F.translate(text, chars, ""))).cast("double")
    return pages.withColumns(
        {
            "length": F.length(url).cast("double"),
            "host_length": F.length(host).cast("double"),
            "depth": count(path, "/"),
            "labels": count(host, "."),
            "digit_ratio": count(url, "0123456789") / n,
            "entropy": _entropy(url),
            "parameters": count(url, "&="),
            "hyphens": count(host, "-"),
            "suffix1": F.substring_index(host, ".", -1),
            "suffix2": F.substring_index(host, ".", -2),
            "segment": F.substring_index(F.substring_index(path, "/", 2), "/", -1),
        }
    )


def fold(url: Column) -> Column:
    """The fold of a labelled URL, by its text."""
    return F.pmod(F.xxhash64(F.coalesce(url, F.lit("")), F.lit(SEED)), F.lit(FOLDS)).cast("int")


def _suffixes(labelled: DataFrame) -> DataFrame:
    """(s_kind, s_text, s_fold, blocked, n): labelled URLs by suffix and fold."""
    pairs = F.explode(F.array(*(F.struct(F.lit(s).alias("s_kind"), F.col(s).alias("s_text")) for s in SUFFIXES)))
    return (
        labelled.select(pairs.alias("s"), "label", fold(F.col("url")).alias("s_fold"))
        .groupBy("s.s_kind", "s.s_text", "s_fold")
        .agg(F.sum("label").alias("blocked"), F.count(F.lit(1)).alias("n"))
    )


def _rate(blocked: Column, n: Column) -> Column:
    return ((blocked + 1.0) / (n + 2.0)).alias("s_rate")


def suffix_statistics(labelled: DataFrame) -> DataFrame:
    """(s_kind, s_text, s_rate): smoothed share of blocked URLs; one row per suffix of a labelled URL."""
    return _suffixes(labelled).groupBy("s_kind", "s_text").agg(_rate(F.sum("blocked"), F.sum("n")))


def training_statistics(labelled: DataFrame) -> DataFrame:
    """(s_kind, s_text, s_fold, s_rate): for each fold that has the suffix, its rate in the other folds."""
    suffix = Window.partitionBy("s_kind", "s_text")  # a row per fold
    others = {c: F.sum(c).over(suffix) - F.col(c) for c in ("blocked", "n")}
    return _suffixes(labelled).withColumns(others).select("s_kind", "s_text", "s_fold", _rate(F.col("blocked"), F.col("n")))


def with_statistics(pages: DataFrame, statistics: DataFrame) -> DataFrame:
    """With ``{suffix}_rate`` for every suffix; 0.5 where no labelled URL has it.

    ``statistics`` of folds are those of each URL's own fold.
    """
    by_fold = ["s_fold"] if "s_fold" in statistics.columns else []
    if by_fold:
        pages = pages.withColumn("s_fold", fold(F.col("url")))
    for s in SUFFIXES:
        own = statistics.filter(F.col("s_kind") == s).select(F.col("s_text").alias(s), F.col("s_rate").alias(f"{s}_rate"), *by_fold)
        pages = pages.join(own, [s, *by_fold], "left").fillna({f"{s}_rate": 0.5})
    return pages


def train(labelled: DataFrame):
    """A function that adds ``p_block`` to URLs with lexical features, learned from their ``label`` (1: block)."""
    kinds = [r[0] for r in labelled.select("label").distinct().collect()]
    if len(kinds) < 2:
        constant = float(kinds[0]) if kinds else 0.0
        return lambda pages: pages.withColumn("p_block", F.lit(constant))
    statistics = saved(suffix_statistics(labelled))
    assembler = VectorAssembler(inputCols=[*FEATURES, *(f"{s}_rate" for s in SUFFIXES)], outputCol="features")
    trees = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, stepSize=RATE, seed=SEED, featuresCol="features", labelCol="label")
    model = trees.fit(assembler.transform(saved(with_statistics(labelled, saved(training_statistics(labelled))))).select("features", "label"))

    def score(pages: DataFrame) -> DataFrame:
        done = model.transform(assembler.transform(with_statistics(pages, statistics)))
        return done.withColumn("p_block", vector_to_array("probability")[1])

    return score


def held_out(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """One row: n, hits and n_block of labelled URLs of fold 0, judged by trees that learned from the others."""
    rows = saved(lexical(ruled(parsed(pages), rules)).filter("rule IS NOT NULL").withColumn("label", F.when(F.col("rule_verdict") == "block", 1.0).otherwise(0.0)))
    out = fold(F.col("url")) == 0
    scored = train(rows.filter(~out))(rows.filter(out))
    return scored.agg(
        F.count(F.lit(1)).alias("n"), F.count_if((F.col("p_block") >= 0.5) == (F.col("label") == 1.0)).alias("hits"), F.count_if(F.col("label") == 1.0).alias("n_block")
    )


def judge(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and p_block (of the trees, where no rule decides).

    The URLs that a rule decides are the labelled ones.
    """
    rows = saved(lexical(ruled(parsed(pages), rules)))
    labelled = rows.filter("rule IS NOT NULL").withColumn("label", F.when(F.col("rule_verdict") == "block", 1.0).otherwise(0.0))
    score = train(labelled)
    open_ = score(rows.filter("rule IS NULL")).select(
        "page_id", "host", "path", "rule", F.when(F.col("p_block") >= 0.5, "block").otherwise("allow").alias("verdict"), "p_block"
    )
    decided = rows.filter("rule IS NOT NULL").select("page_id", "host", "path", "rule", F.col("rule_verdict").alias("verdict"), F.lit(None).cast("double").alias("p_block"))
    return decided.unionByName(open_)
