"""URL filter: rules first, gradient-boosted trees for the rest.

A rule names a host and a path prefix and fits that host with all subdomains;
the longest rule that fits decides.  URLs that no rule fits are judged by
gradient-boosted trees (Spark ML) on lexical features, trained on URLs with
known verdicts.  The features are lengths, depths, digit ratio, character
entropy, parameter counts, and statistics of the host's suffix (its last
label): how often it occurs and its smoothed share of blocked URLs.

Training reads a bounded sample: distinct labelled URLs whose hash falls
below ``MAX_TRAINING / labelled``, all of them when there are fewer.  Suffix
statistics are taken over all labelled URLs.

Defined cases: a null url, or one without ``://``, has empty host and path,
fits no rule and is judged by the trees with zero features; without labelled
URLs of both verdicts the trees are replaced by the one verdict there is, or
``allow``; repeated rows are judged alike; an empty table gives an empty
result.  Other columns are kept by ``judge``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, aside, written

#: Distinct labelled URLs that the trees are fitted on, at most (in expectation).
MAX_TRAINING = 20_000
#: A rule list is part of the query plan; longer lists are refused.
MAX_RULES = 2000
TREES, DEPTH, SEED = 10, 4, 7
PRIOR = 8.0
FEATURES = ("__f_length", "__f_host_length", "__f_path_length", "__f_labels", "__f_depth", "__f_digits", "__f_entropy", "__f_params", "__f_hyphens", "__f_fragment", "__f_suffix_share", "__f_suffix_count")


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str = "/"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ?, # or end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def match_rules(rules, host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null where none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"over {MAX_RULES} rules")
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.host) + len(r.path)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found["rule"], found["verdict"]


def lexical(df: DataFrame, url: str, host: str, path: str) -> DataFrame:
    """Adds the lexical features and __suffix."""
    u = F.coalesce(F.col(url).cast("string"), F.lit(""))
    n = F.length(u)
    chars = F.filter(F.split(u, ""), lambda c: c != "")
    count = lambda text, what: (F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))).cast("double")
    # sum of c log2 c over the distinct characters, c their count in the url
    plogp = F.aggregate(
        F.transform(F.array_distinct(chars), lambda c: F.length(u) - F.length(F.replace(u, c, F.lit("")))),
        F.lit(0.0),
        lambda a, c: a + F.when(c > 0, c * F.log2(c.cast("double"))).otherwise(0.0),
    )
    query = F.coalesce(F.regexp_extract(u, r"(?s)\?([^#]*)", 1), F.lit(""))
    return df.withColumns(
        {
            "__f_length": n.cast("double"),
            "__f_host_length": F.length(host).cast("double"),
            "__f_path_length": F.length(path).cast("double"),
            "__f_labels": count(F.col(host), "."),
            "__f_depth": count(F.col(path), "/"),
            "__f_digits": F.when(n > 0, F.length(F.regexp_replace(u, "[^0-9]+", "")) / n).otherwise(0.0),
            "__f_entropy": F.when(n > 0, F.log2(n.cast("double")) - plogp / n).otherwise(0.0),
            "__f_params": F.when(query == "", 0.0).otherwise(count(query, "&") + 1),
            "__f_hyphens": count(u, "-"),
            "__f_fragment": F.when(F.contains(u, F.lit("#")), 1.0).otherwise(0.0),
            "__suffix": F.substring_index(F.regexp_replace(F.col(host), r":\d*$", ""), ".", -1),
        }
    )


def judge(pages: DataFrame, rules, max_training: int = MAX_TRAINING) -> DataFrame:
    """The input with __host, __path, __rule and __verdict, in place of any
    columns it has by these names."""
    pages, back = aside(pages.drop("__host", "__path", "__rule", "__verdict"))
    return back(_judged(pages, rules, max_training))


def _judged(pages: DataFrame, rules, max_training: int) -> DataFrame:
    parts = pages.withColumn("__host", host_of(F.col("url").cast("string"))).withColumn("__path", path_of(F.col("url").cast("string")))
    rule, verdict = match_rules(rules, F.col("__host"), F.col("__path"))
    ruled = parts.withColumn("__rule", rule).withColumn("__ruled", verdict)
    # the rules' verdicts are the labels; the texts of the pages are not read
    urls = written(lexical(ruled.select("url", "__host", "__path", "__rule", "__ruled"), "url", "__host", "__path"), "url-features")
    labelled = urls.where("__ruled is not null").withColumn("label", F.when(F.col("__ruled") == "block", 1.0).otherwise(0.0))
    n, blocked = labelled.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if blocked == 0 or blocked == n:
        constant = "block" if n and blocked == n else "allow"
        return ruled.withColumn("__verdict", F.coalesce("__ruled", F.lit(constant))).drop("__ruled")
    overall = blocked / n
    share = (F.sum("label") + F.lit(PRIOR * overall)) / (F.count("*") + F.lit(PRIOR))
    suffixes = written(
        labelled.groupBy("__suffix").agg(share.alias("__f_suffix_share"), F.log1p(F.count("*")).alias("__f_suffix_count")), "url-suffixes"
    ).withColumnRenamed("__suffix", "__s")

    def complete(df: DataFrame) -> DataFrame:
        joined = df.join(suffixes, F.col("__suffix") == F.col("__s"), "left").drop("__s")
        filled = joined.withColumn("__f_suffix_share", F.coalesce("__f_suffix_share", F.lit(overall))).withColumn("__f_suffix_count", F.coalesce("__f_suffix_count", F.lit(0.0)))
        return VectorAssembler(inputCols=list(FEATURES), outputCol="__features").transform(filled)

    distinct = written(labelled.dropDuplicates(["url"]), "url-labelled")
    kept = min(1.0, max_training / max(1, distinct.count()))
    sample = distinct.where(F.pmod(F.xxhash64("url"), F.lit(1 << 20)) < F.lit(kept * (1 << 20)))
    # a bounded table: a few partitions are enough for it
    training = written(complete(sample).select("__features", "label").coalesce(4), "url-training")
    if training.select("label").distinct().count() < 2:
        return ruled.withColumn("__verdict", F.coalesce("__ruled", F.lit("allow"))).drop("__ruled")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="__features", labelCol="label").fit(training)
    model.setPredictionCol("__prediction").setRawPredictionCol("__raw").setProbabilityCol("__probability")
    judged = model.transform(complete(lexical(ruled, "url", "__host", "__path")))
    own = F.when(F.col("__prediction") == 1.0, "block").otherwise("allow")
    return judged.withColumn("__verdict", F.coalesce("__ruled", own)).select(*pages.columns, "__host", "__path", "__rule", "__verdict")
