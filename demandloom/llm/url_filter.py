"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

The rules label the URLs they fit; the trees learn from these labels and judge the
URLs that no rule fits.  All of it is DataFrame operations and Spark's own trees.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import stage
from demandloom.llm.html_text import host_of

#: Labelled URLs the trees are fitted on, at most (in expectation); suffix statistics use all.
SAMPLE = 20_000
TREES, DEPTH, BINS, SMOOTH = 12, 4, 32, 20.0

FEATURES = ("length", "host_length", "path_length", "depth", "labels", "digit_ratio", "entropy", "parameters",
            "hyphens", "underscores", "encoded", "has_fragment", "extension", "longest_segment", "suffix_rate",
            "suffix_weight", "site_rate", "site_weight")


def path_of(url: str) -> Column:
    """What follows the host up to "?", "#" or the end; empty without "://"."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), "^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def _fits(rule: str) -> Column:
    host, slash, path = rule.partition("/")
    own = (F.col("host") == host) | F.col("host").endswith("." + host)
    return own & F.col("path").startswith(slash + path)


def matching_rule(rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) columns of the longest rule that fits, from columns host and path."""
    best = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    pick = lambda value: F.coalesce(
        *[F.when(_fits(r[1]), F.lit(value(r))) for r in best], F.lit(None).cast("string"))
    return pick(lambda r: r[1]), pick(lambda r: r[0])


def _count(col: str, pattern: str) -> Column:
    return F.regexp_count(F.col(col), F.lit(pattern)).cast("double")


def _entropy(col: str) -> Column:
    """Bits per character."""
    chars = F.split(F.col(col), "")
    n = F.length(col).cast("double")
    parts = F.transform(F.array_distinct(chars), lambda c: (
        F.size(F.filter(chars, lambda d: d == c)).cast("double") / n))
    return F.when(n > 0, -F.aggregate(parts, F.lit(0.0), lambda a, p: a + F.when(p > 0, p * F.log2(p)).otherwise(0.0))
                  ).otherwise(0.0)


def lexical(urls: DataFrame) -> DataFrame:
    """Adds the lexical features, the suffix and the site to columns text, host and path."""
    n = F.greatest(F.length("text"), F.lit(1)).cast("double")
    longest = F.aggregate(F.split("path", "/"), F.lit(0), lambda a, s: F.greatest(a, F.length(s)))
    return urls.withColumns({
        "length": F.length("text").cast("double"), "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"), "depth": _count("path", "/"),
        "labels": _count("host", "\\."), "digit_ratio": _count("text", "[0-9]") / n,
        "entropy": _entropy("text"), "parameters": _count("text", "[?&][^=&#]+="),
        "hyphens": _count("text", "-"), "underscores": _count("text", "_"), "encoded": _count("text", "%[0-9A-Fa-f]{2}"),
        "has_fragment": F.contains(F.col("text"), F.lit("#")).cast("double"),
        "extension": F.regexp_like(F.col("path"), F.lit("\\.[A-Za-z0-9]{1,5}$")).cast("double"),
        "longest_segment": longest.cast("double"),
        "suffix": F.substring_index("host", ".", -1),
        "site": F.concat(F.substring_index("host", ".", -2), F.lit("/"), F.substring_index(
            F.substring_index("path", "/", 2), "/", -1)),
    })


def _rates(labelled: DataFrame, key: str, name: str) -> DataFrame:
    """Smoothed share of blocked URLs and their number, per key."""
    rates = labelled.groupBy(key).agg(F.sum("label").alias("bad"), F.count(F.lit(1)).alias("n")).select(
        F.col(key).alias(f"{name}_key"), ((F.col("bad") + SMOOTH / 2) / (F.col("n") + SMOOTH)).alias(f"{name}_rate"),
        F.log1p("n").alias(f"{name}_weight"))
    return stage(rates, f"url-{name}")


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id",
                url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row.

    ``rules`` are (verdict, "host/path") pairs.  score is the trees' probability of
    block where no rule fits, else null.  A null URL, or one without "://", has an
    empty host and path, fits no rule and is judged by the trees.  Without labels of
    both verdicts the trees have nothing to learn: URLs without a rule then get the
    only verdict seen, or allow.
    """
    rule, verdict = matching_rule(rules)
    urls = pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("text"))
    urls = urls.withColumns({"host": host_of("text"), "path": path_of("text")}).withColumns(
        {"rule": rule, "ruled": verdict})
    ready = stage(lexical(urls), "url-features")
    labelled = ready.where("rule is not null").withColumn("label", (F.col("ruled") == "block").cast("double"))
    found = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(found) < 2:
        only = "block" if 1.0 in found else "allow"
        return ready.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.lit(only)).alias("verdict"),
                            F.lit(None).cast("double").alias("score"))
    suffixes, sites = _rates(labelled, "suffix", "suffix"), _rates(labelled, "site", "site")

    def with_rates(rows: DataFrame) -> DataFrame:
        out = rows.join(suffixes, F.col("suffix") == F.col("suffix_key"), "left").join(
            sites, F.col("site") == F.col("site_key"), "left")
        return out.fillna({"suffix_rate": 0.5, "suffix_weight": 0.0, "site_rate": 0.5, "site_weight": 0.0})

    share = min(1.0, SAMPLE / sum(found.values()))
    chosen = labelled.where(F.pmod(F.xxhash64("page_id", "text"), F.lit(1 << 30)) < int(share * (1 << 30)))
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    training = stage(with_rates(chosen).select("label", *FEATURES), "url-training")
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, maxBins=BINS,
                          stepSize=0.2, seed=7, cacheNodeIds=False).fit(assemble.transform(training))
    judged = trees.transform(assemble.transform(with_rates(ready)))
    from pyspark.ml.functions import vector_to_array

    score = vector_to_array("probability")[1]
    return judged.select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(score >= 0.5, "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("rule").isNull(), score).alias("score"))
