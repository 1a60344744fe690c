"""URL filter: host-and-path rules first, gradient-boosted trees for the rest.

The trees see lexical features of the URL and statistics of its host suffix, and
are trained on URLs that already have a verdict. In the query those are the URLs
that a rule decides. The statistics of a URL that the trees learn from are those of
the other folds of labelled URLs, so that its own label is not among its features.
Everything is DataFrame expressions and Spark ML's DataFrame estimators; no Python
runs on the executors.

Defined cases: a null URL, or one without ``://``, has an empty host and path and
fits no rule; its verdict is the trees'. Equal URLs get equal verdicts. With one
class of labels only the verdict of the rest is that class, without labels
``allow``. Suffixes that no (other) labelled URL has get the mean of all. A labelled
row without a label is no labelled row.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    """``host`` and its subdomains, paths that begin with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule("block", "com", "/en/"),
    UrlRule("allow", "example.com", "/en/7"),
    UrlRule("allow", "net", "/de/"),
    UrlRule("block", "example.net", "/de/8"),
    UrlRule("block", "org", "/es/"),
)

#: Labelled rows that the trees are fitted on at most, about; chosen by hash over all of them. Suffix and site statistics are of all.
MAX_LABELLED = 20_000
#: Folds of the labelled rows, and how many mean labels a suffix has besides its own.
FOLDS, SMOOTH = 5, 20.0
FEATURES = ["n_url", "n_host", "n_path", "n_query", "n_fragment", "depth", "labels", "digits", "digit_ratio", "hyphens", "escapes", "params", "entropy", "tls", "dotted_end", "suffix_rate", "suffix_log_n", "site_rate", "site_log_n"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) after the first ``://``, and path up to ``?`` or ``#``; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.regexp_replace(url, r"(?s)^.*?://", ""), "#", 1))
    rest = F.substring_index(rest, "?", 1)
    host = F.substring_index(rest, "/", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(F.substring(rest, F.length(host) + 1, F.length(rest)), F.lit(""))


def fits(rule: UrlRule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def first_rule(rules: tuple[UrlRule, ...], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; of equal length the longer host, then block."""
    order = sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.verdict != "block"))
    text = reduce(lambda c, r: c.when(fits(r, host, path), r.text), order, F.when(F.lit(False), ""))
    verdict = reduce(lambda c, r: c.when(fits(r, host, path), r.verdict), order, F.when(F.lit(False), ""))
    return text, verdict


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    n = F.length(text)
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    return F.when(n > 0, F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), lambda acc, c: acc - F.when(F.length(c) > 0, share(c) * F.log2(share(c))).otherwise(0.0))).otherwise(0.0)


def suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def site(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def lexical(urls: DataFrame) -> DataFrame:
    """Feature columns beside what ``urls`` (url, host, path, ..) has; suffix: last host label, site: last two."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    count = lambda c, what: F.length(c) - F.length(F.replace(c, F.lit(what), F.lit("")))
    query = F.when(F.instr(url, "?") > 0, F.substring_index(F.regexp_replace(url, r"(?s)^[^?]*\?", ""), "#", 1)).otherwise("")
    digits = F.length(F.regexp_replace(url, "[^0-9]", ""))
    return urls.withColumns({
        "n_url": F.length(url), "n_host": F.length(host), "n_path": F.length(path), "n_query": F.length(query),
        "n_fragment": F.when(F.instr(url, "#") > 0, F.length(url) - F.instr(url, "#")).otherwise(0),
        "depth": count(path, "/"), "labels": count(host, "."), "digits": digits, "digit_ratio": F.coalesce(F.try_divide(digits, F.length(url)), F.lit(0.0)),
        "hyphens": count(host, "-"), "escapes": count(url, "%"), "params": F.when(F.length(query) > 0, count(query, "&") + 1).otherwise(0),
        "entropy": entropy(url), "tls": url.startswith("https").cast("int"), "dotted_end": path.rlike(r"\.[A-Za-z0-9]{1,5}$").cast("int"),
        "suffix": suffix(host), "site": site(host),
    })


def fold_sums(labelled: DataFrame, key: str) -> DataFrame:
    """Per value of ``key`` and fold: blocked and all labelled URLs."""
    return labelled.groupBy(key, "fold").agg(F.sum("label").alias(f"{key}_s"), F.count(F.lit(1)).alias(f"{key}_n"))


def all_sums(folds: DataFrame, key: str) -> DataFrame:
    return folds.groupBy(key).agg(F.sum(f"{key}_s").alias(f"{key}_s"), F.sum(f"{key}_n").alias(f"{key}_n"))


def rated(urls: DataFrame, key: str, s: Column, n: Column, mean: float, grow: float = 1.0) -> DataFrame:
    """``urls`` with the smoothed share of blocked URLs of their ``key``, and the log of its size."""
    s, n = F.coalesce(s, F.lit(0.0)) * grow, F.coalesce(n, F.lit(0)) * grow
    return urls.withColumns({f"{key}_rate": (s + SMOOTH * mean) / (n + SMOOTH), f"{key}_log_n": F.log1p(n)})


def with_stats(urls: DataFrame, sums: dict[str, DataFrame], mean: float) -> DataFrame:
    """Features of URLs that are to be judged; sums: of all folds."""
    for key, table in sums.items():
        urls = rated(urls.join(table, key, "left"), key, F.col(f"{key}_s"), F.col(f"{key}_n"), mean).drop(f"{key}_s", f"{key}_n")
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(urls)


def with_stats_of_other_folds(sample: DataFrame, folds: dict[str, DataFrame], sums: dict[str, DataFrame], mean: float) -> DataFrame:
    """Features of URLs that are learned from, with sums grown to the size that all folds would have."""
    for key in folds:
        own = folds[key].withColumnsRenamed({f"{key}_s": "own_s", f"{key}_n": "own_n"})
        urls = sample.join(sums[key], key).join(own, [key, "fold"])
        sample = rated(urls, key, F.col(f"{key}_s") - F.col("own_s"), F.col(f"{key}_n") - F.col("own_n"), mean, FOLDS / (FOLDS - 1)).drop(f"{key}_s", f"{key}_n", "own_s", "own_n")
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)


def filter_urls(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, labelled: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", max_labelled: int = MAX_LABELLED, trees: int = 20, depth: int = 4) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for each page; score: the trees' probability of block.

    ``labelled`` has the columns url and label (1.0: block). Without it the URLs
    that a rule decides are the labelled ones.
    """
    host, path = host_and_path(F.col("url"))
    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url")).withColumns({"host": host, "path": path})
    text, verdict = first_rule(rules, F.col("host"), F.col("path"))
    urls = urls.withColumns({"rule": text, "ruled": verdict})
    if labelled is None:
        known = urls.filter(F.col("ruled").isNotNull()).select(F.col("page_id").alias("id"), "url", "host", "path", (F.col("ruled") == "block").cast("double").alias("label"))
    else:
        known = labelled.select(F.monotonically_increasing_id().alias("id"), F.col("url").cast("string").alias("url"), F.col("label").cast("double").alias("label")).filter("label is not null").withColumns({"host": host, "path": path})
        known = written(known, "known-urls")  # numbered once
    n, blocked = known.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or blocked in (0, n):
        every = "block" if n and blocked == n else "allow"
        return urls.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.lit(every)).alias("verdict"), F.lit(None).cast("double").alias("score"))
    share = int(1_000_000 * min(1.0, max_labelled / n))
    # rows of one URL are in one fold: none learns from its own copies
    fold = F.pmod(F.xxhash64("url", F.lit(1)), F.lit(FOLDS)).cast("int")
    known = known.withColumns({"fold": fold, "suffix": suffix(F.col("host")), "site": site(F.col("host"))})
    folds = {key: written(fold_sums(known, key), f"{key}-folds") for key in ("suffix", "site")}
    sums = {key: written(all_sums(table, key), f"{key}-sums") for key, table in folds.items()}
    sample = written(lexical(known.filter(F.pmod(F.xxhash64("id", "url"), F.lit(1_000_000)) < share)), "labelled-urls")
    mean = blocked / n
    train = with_stats_of_other_folds(sample, folds, sums, mean).select("features", "label")
    if train.select("label").distinct().count() < 2:
        every = "block" if blocked * 2 > n else "allow"
        return urls.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.lit(every)).alias("verdict"), F.lit(None).cast("double").alias("score"))
    model = GBTClassifier(featuresCol="features", labelCol="label", maxIter=trees, maxDepth=depth, maxBins=64, stepSize=0.2, seed=7).fit(train)
    judged = model.transform(with_stats(lexical(urls), sums, mean))
    score = vector_to_array("probability")[1]
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("prediction") > 0.5, "block").otherwise("allow")).alias("verdict"), score.alias("score"))


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))
