"""URL filter: rules first, then gradient-boosted trees on lexical features.

A rule names a host and the beginning of a path; it fits the host and all its subdomains, and the longest fitting
rule decides. URLs without a rule are judged by boosted trees on length, depth, digit ratio, entropy, parameter
counts and statistics of the host's suffixes. The trees are Spark's own (JVM); features are built-in
functions only. They are fitted on a bounded sample of labelled URLs (``Settings.sample``), from which the suffix
statistics come too, so these have at most two rows per sampled URL. All URLs are judged where they lie, without a
shuffle.

A null URL or one without ``://`` has empty host and path and is judged by its features; repeated rows are judged each;
all columns of a page come
back in one struct. Without labelled URLs of both kinds everything without a rule is allowed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from markfield.llm.common import settle, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABET = LOWER + "0123456789-._~/?&=%#:+"
# The rules of the registered query, as (host, path, verdict).
RULES: tuple[tuple[str, str, str], ...] = (
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
)
# Words that mark a host as advertising or spam; such URLs are labelled for the fit.
MARKED = ("ads", "bets", "casino", "cheap", "farm", "free", "pills", "spam", "track", "win")


@dataclass
class Settings:
    sample: int = 20_000  #: labelled URLs of the fit
    trees: int = 12
    depth: int = 4
    least: int = 20  #: labelled URLs in a leaf
    prior: float = 20.0  #: rows a suffix's share is smoothed with
    seed: int = 5


def parts(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, text.substr(at + 3, F.length(text))).otherwise("")
    return (F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def suffixes(host: Column) -> Column:
    """The host and all its parent domains."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(
        F.slice(labels, n, F.size(labels)), "."))


def fitting_rule(rules: Sequence[tuple[str, str, str]], host: str = "host", path: str = "path") -> Column:
    """Struct (size, rule, verdict) of the longest fitting rule, or null. Rules are few enough for one literal map."""
    of_host: dict[str, list[tuple[str, str]]] = {}
    for name, start, verdict in rules:
        of_host.setdefault(name, []).append((start, verdict))
    if not of_host:
        return F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    known = F.create_map(*(cell for name, own in of_host.items() for cell in (F.lit(name), F.array(*(F.struct(
        F.lit(start).alias("start"), F.lit(len(name) + len(start)).alias("size"), F.lit(name + start).alias("rule"),
        F.lit(verdict).alias("verdict")) for start, verdict in own)))))
    found = F.flatten(F.transform(F.filter(suffixes(F.col(host)), lambda s: F.map_contains_key(known, s)), lambda s: known[s]))
    fits = F.filter(found, lambda rule: F.startswith(F.col(path), rule["start"]))
    return F.array_max(F.transform(fits, lambda rule: F.struct(
        rule["size"].alias("size"), rule["rule"].alias("rule"), rule["verdict"].alias("verdict"))))


def _times(text: Column, part: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / F.lit(len(part))


def lexical(rows: DataFrame, url: str = "url") -> tuple[DataFrame, list[str]]:
    """``rows`` (with host and path) and the feature columns ``f_...``, all doubles."""
    text = F.translate(F.coalesce(F.col(url).cast("string"), F.lit("")), UPPER, LOWER)
    size = F.length(text)
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    digits = size - F.length(F.translate(text, "0123456789", ""))
    shares = [_times(text, sign) / F.greatest(size, F.lit(1)) for sign in ALPHABET]
    rest = F.greatest(size - sum((_times(text, sign) for sign in ALPHABET), F.lit(0.0)), F.lit(0.0)) / F.greatest(size, F.lit(1))
    entropy = F.aggregate(F.array(*shares, rest), F.lit(0.0), lambda total, share: total - F.when(
        share > 0, share * F.log2(share)).otherwise(0.0))
    host, path = F.col("host"), F.col("path")
    features = {
        "length": size, "host_length": F.length(host), "path_length": F.length(path), "depth": _times(path, "/"),
        "labels": _times(host, ".") + 1, "hyphens": _times(host, "-"), "digit_ratio": digits / F.greatest(size, F.lit(1)),
        "host_digits": F.length(host) - F.length(F.translate(host, "0123456789", "")), "entropy": entropy,
        "parameters": F.when(F.length(query) > 0, _times(query, "&") + 1).otherwise(0.0),
        "escapes": _times(text, "%"), "secure": F.startswith(text, F.lit("https")),
        "fragment": F.contains(text, F.lit("#")), "file": path.rlike(r"\.[A-Za-z0-9]{1,5}$"),
    }
    return rows.withColumns({f"f_{name}": value.cast("double") for name, value in features.items()}), [
        f"f_{name}" for name in features]


def last_labels(n: int, host: str = "host") -> Column:
    return F.substring_index(F.col(host), ".", -n)


@dataclass
class Filter:
    """Fitted trees and the suffix shares they were fitted with."""

    trees: GBTClassificationModel | None
    shares: list[DataFrame]
    average: float

    def features(self, rows: DataFrame) -> DataFrame:
        rows, names = lexical(rows)
        for n, share in enumerate(self.shares, start=1):  # at most one row per sampled URL
            rows = rows.withColumn("_suffix", last_labels(n)).join(F.broadcast(share), "_suffix", "left").withColumn(
                f"f_suffix_{n}", F.coalesce("_share", F.lit(self.average))).drop("_suffix", "_share")
            names = [*names, f"f_suffix_{n}"]
        return VectorAssembler(inputCols=names, outputCol="features").transform(rows).drop(*names)

    def blocks(self, rows: DataFrame) -> DataFrame:
        """``rows`` with a boolean ``blocked``."""
        if self.trees is None:
            return rows.withColumn("blocked", F.lit(False))
        judged = self.trees.transform(self.features(rows))
        return judged.withColumn("blocked", F.col("prediction") > 0.5).drop(
            "features", "rawPrediction", "probability", "prediction")


def fit(labelled: DataFrame, settings: Settings | None = None) -> Filter:
    """Trees from ``url, label`` rows (1: block), of which a bounded sample is taken by hash."""
    settings = settings or Settings()
    host, path = parts()
    sample = labelled.select("url", F.col("label").cast("double").alias("label")).filter(
        "url is not null and label is not null").distinct().orderBy(F.xxhash64("url"), "url", "label").limit(settings.sample)
    sample = settle(sample.withColumn("host", host).withColumn("path", path), "url-labels")
    average, kinds = sample.agg(F.avg("label"), F.count_distinct("label")).first()
    if kinds < 2:
        return Filter(None, [], average or 0.0)
    shares = [sample.groupBy(last_labels(n).alias("_suffix")).agg(
        ((F.sum("label") + settings.prior * average) / (F.count("label") + settings.prior)).alias("_share")) for n in (1, 2)]
    shares = [settle(share, "suffix-shares") for share in shares]
    rows = Filter(None, shares, average).features(sample).select("features", "label")
    booster = GBTClassifier(maxIter=settings.trees, maxDepth=settings.depth, minInstancesPerNode=settings.least, seed=settings.seed, stepSize=0.3)
    return Filter(booster.fit(settle(rows, "url-features").coalesce(4)), shares, average)


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]], model: Filter) -> DataFrame:
    """``page`` (all columns of a row), ``host, path, rule, verdict``."""
    decided = model.blocks(with_rule(pages, rules))
    verdict = F.coalesce(F.col("fits.verdict"), F.when(F.col("blocked"), "block").otherwise("allow"))
    return decided.select("page", "host", "path", F.col("fits.rule").alias("rule"), verdict.alias("verdict"))


def with_rule(pages: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``page, url, host, path, fits``; the struct keeps the caller's columns apart from those made here."""
    host, path = parts()
    rows = pages.select(F.struct("*").alias("page"), "url")
    return rows.withColumn("host", host).withColumn("path", path).withColumn("fits", fitting_rule(rules))


def known_labels(pages: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Labelled URLs: hosts that carry a marked word count as blocked, others that a rule allows as allowed.

    A blocking rule takes out one part of a site and says nothing of how unwanted URLs look, so it gives no label.
    """
    ruled = with_rule(pages, rules)
    marked = F.arrays_overlap(F.split("host", r"[.\-]"), F.array(*map(F.lit, MARKED)))
    label = F.when(marked, 1.0).when(F.col("fits.verdict") == "allow", 0.0)
    return ruled.select("url", label.alias("label")).filter("label is not null")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found = judged(pages, RULES, fit(known_labels(pages, RULES)))
    return found.select("page.page_id", "host", "path", "rule", "verdict")
