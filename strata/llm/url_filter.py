"""Operator 1: URL filter from rules and gradient-boosted trees over lexical features [native].

A rule is ``host/path`` with a verdict. It fits its host and every subdomain when
the url's path starts with the rule's path; the longest rule wins. Urls without a
rule are judged by a boosted-tree classifier trained on urls that have a label
(here: those that a rule judges), from lexical features and from how often each
host suffix is blocked among the labelled urls.

Null urls and urls without ``://`` have an empty host and path; they fit no rule
and are judged by the model like any other. Without labelled urls every such url
is allowed; with labels of one class only, they take that class. Rows are judged
one by one, so repeated rows agree and extra columns pass through.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, without

RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]
#: Bound of the labelled sample that the trees are trained on.
MAX_TRAINING = 50_000
#: Columns that judging makes besides the features; an input column called like one, whatever its case, is replaced.
MADE = ["host", "path", "rule", "verdict", "p_block", "label", "suffix", "features", "rawPrediction", "probability", "prediction"]
FEATURES = ["n_url", "n_host", "n_path", "n_labels", "depth", "digit_ratio", "entropy", "n_params", "n_marks", "has_fragment", "suffix_rate", "suffix_seen"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(text, pattern, 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(text, pattern, 2)


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]] = RULES) -> Column:
    """The longest fitting rule, or null."""
    def fits(rule: str) -> Column:
        rule_host, _, rest = rule.partition("/")
        return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rest)

    ordered = sorted((r for r, _ in rules), key=lambda r: (-len(r), r))
    return F.coalesce(*[F.when(fits(r), F.lit(r)) for r in ordered], F.lit(None).cast("string"))


def rule_verdict(rule: Column, rules: list[tuple[str, str]] = RULES) -> Column:
    return F.coalesce(*[F.when(rule == r, F.lit(v)) for r, v in rules], F.lit(None).cast("string"))


def count_of(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters in bits."""
    size = F.length(text).cast("double")
    share = lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size
    return F.coalesce(F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0),
                                  lambda acc, c: F.when(F.length(c) == 0, acc).otherwise(acc - share(c) * F.log2(share(c)))), F.lit(0.0))


def lexical(df: DataFrame, url: str = "url", host: str = "host", path: str = "path") -> DataFrame:
    """Lexical features of a url and its host suffix (the last label)."""
    text, h, p = F.coalesce(F.col(url).cast("string"), F.lit("")), F.col(host), F.col(path)
    query = F.regexp_extract(text, r"(?s)\?([^#]*)", 1)
    size = F.length(text)
    return df.withColumns({
        "n_url": size, "n_host": F.length(h), "n_path": F.length(p), "n_labels": count_of(h, "."),
        "depth": F.size(F.filter(F.split(p, "/"), lambda s: s != "")),
        "digit_ratio": F.when(size > 0, (size - F.length(F.translate(text, string.digits, ""))) / size).otherwise(0.0),
        "entropy": entropy(text), "n_params": F.when(query == "", 0).otherwise(count_of(query, "&") + 1),
        "n_marks": count_of(text, "-") + count_of(text, "_") + count_of(text, "%"), "has_fragment": text.contains("#").cast("int"),
        "suffix": F.substring_index(h, ".", -1),
    })


def suffix_statistics(labelled: DataFrame, rate: float, prior_weight: float = 10.0) -> DataFrame:
    """For each suffix: how many labelled urls it has and their share of blocked ones, smoothed towards ``rate``."""
    return labelled.groupBy("suffix").agg(F.sum("label").alias("bad"), F.count("*").alias("n")).select(
        "suffix", ((F.col("bad") + prior_weight * rate) / (F.col("n") + prior_weight)).alias("suffix_rate"), F.log1p("n").alias("suffix_seen"))


def with_suffix(df: DataFrame, statistics: DataFrame, default: float) -> DataFrame:
    return df.join(statistics, "suffix", "left").fillna({"suffix_rate": default, "suffix_seen": 0.0})


def train(labelled: DataFrame, max_rows: int = MAX_TRAINING, trees: int = 20, depth: int = 4, seed: int = 11):
    """(model or None, suffix statistics, share blocked) from lexical rows with ``url`` and ``label`` (1 is block).

    Suffix statistics cover every labelled url; the trees see a sample of about ``max_rows`` distinct urls, chosen by a
    hash of the url and weighted by their rows.
    """
    totals = labelled.agg(F.count("*").alias("n"), F.avg("label").alias("rate")).first()
    n, rate = totals["n"], totals["rate"]
    if not n or rate in (0.0, 1.0):
        return None, None, rate or 0.0
    statistics = stage(suffix_statistics(labelled, rate), "suffix-statistics")
    distinct = stage(labelled.groupBy("url", "label").agg(F.count("*").cast("double").alias("weight"), *[F.first(c).alias(c) for c in labelled.columns if c in {*FEATURES, "suffix"}]), "url-distinct")
    share = min(1.0, max_rows / distinct.count())
    rank = F.pmod(F.xxhash64(F.coalesce("url", F.lit(""))), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = stage(with_suffix(distinct.where(rank < share), statistics, rate).select("label", "weight", *FEATURES), "url-training")
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample.coalesce(1))
    model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed, labelCol="label", featuresCol="features", weightCol="weight").fit(vectors)
    return model, statistics, rate


def judge(urls: DataFrame, url: str = "url", rules: list[tuple[str, str]] = RULES, **options) -> DataFrame:
    """Add host, path, rule, verdict and p_block (null where a rule decides)."""
    base = without(urls, [*MADE, *FEATURES], [url])
    host, path = host_and_path(F.col(url))
    parsed = base.withColumns({"host": host, "path": path})
    ruled = parsed.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    ruled = ruled.withColumn("verdict", rule_verdict(F.col("rule"), rules))
    known = lexical(ruled.where("rule is not null").select(F.col(url).alias("url"), "host", "path", (F.col("verdict") == "block").cast("int").alias("label")))
    model, statistics, rate = train(known, **options)
    if model is None:
        return ruled.withColumns({"p_block": F.when(F.col("rule").isNull(), F.lit(float(rate))),
                                  "verdict": F.coalesce("verdict", F.lit("block" if rate == 1.0 else "allow"))})
    featured = with_suffix(lexical(ruled, url), statistics, rate)
    scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(featured))
    from pyspark.ml.functions import vector_to_array
    p = vector_to_array("probability")[1]
    return scored.withColumns({"p_block": F.when(F.col("rule").isNull(), p),
                               "verdict": F.coalesce("verdict", F.when(p > 0.5, F.lit("block")).otherwise(F.lit("allow")))
                               }).select(*base.columns, "host", "path", "rule", "verdict", "p_block")
