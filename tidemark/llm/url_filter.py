"""URL filters: host and path rules, and gradient-boosted trees for the URLs that no rule covers.

The rules label URLs; the trees learn from those labels what the lexical form of a URL tells: lengths, depth,
ratio of digits, entropy of the characters, parameters, and how often labelled URLs with the same suffix of
the host are blocked. That last statistic is summed over all labelled URLs, out of fold for these, so a URL
never sees its own label.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import materialise, read

#: The rules of the registered query: (verdict, host, path).
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: At most so many distinct URLs of each label train the trees, picked by a hash of the URL.
SAMPLE = 20_000
TREES, DEPTH = 20, 4
_LEXICAL = ["url_chars", "host_chars", "path_chars", "depth", "digit_ratio", "entropy", "parameters", "labels",
            "hyphens", "fragment"]
_SUFFIX = ["top_blocked", "domain_blocked"]
#: Pseudo-counts that pull the share of rare suffixes to one half.
PRIOR = 4.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first "://" up to / ? # or the end, A-Z lower-cased; path: then up to ? # or the end."""
    pattern, url = r"(?s)^.*?://([^/?#]*)([^?#]*)", F.coalesce(url, F.lit(""))
    return (F.translate(F.regexp_extract(url, pattern, 1), string.ascii_uppercase, string.ascii_lowercase),
            F.regexp_extract(url, pattern, 2))


def rule_of(rules: list[tuple[str, str, str]], host: Column, path: Column) -> Column:
    """(rule, verdict) of the longest rule that fits the host or a parent domain of it and starts the path."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, domain, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(prefix)
        out = F.when(fits, F.struct(F.lit(domain + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    url = F.coalesce(url, F.lit(""))
    size = F.greatest(F.length(url), F.lit(1))

    def count(text: Column, chars: str) -> Column:
        return F.length(text) - F.length(F.translate(text, chars, ""))

    shares = F.transform(F.array_distinct(F.split(url, "")), lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / size)
    entropy = F.aggregate(F.filter(shares, lambda p: p > 0), F.lit(0.0), lambda a, p: a - p * F.log2(p))
    return {
        "url_chars": F.length(url), "host_chars": F.length(host), "path_chars": F.length(path),
        "depth": count(path, "/"), "digit_ratio": count(url, string.digits) / size, "entropy": entropy,
        "parameters": F.when(F.contains(url, F.lit("?")), count(F.substring_index(url, "?", -1), "&") + 1).otherwise(0),
        "labels": count(host, ".") + 1, "hyphens": count(url, "-_"), "fragment": F.contains(url, F.lit("#")).cast("int"),
    }


def _with_suffix_share(rows: DataFrame, suffix: str, out: str) -> DataFrame:
    """Adds the smoothed share of blocked URLs among the labelled ones of the suffix, without the row's own fold."""
    known = F.col("label").isNotNull()
    sums = rows.filter(known).groupBy(suffix).agg(*[
        F.sum(F.when(F.col("fold") == f, x).otherwise(0)).cast("double").alias(f"{name}{f}")
        for f in (0, 1) for name, x in (("b", F.col("label")), ("n", F.lit(1)))])

    def both(name: str) -> Column:
        own = [F.when(known & (F.col("fold") == f), F.lit(0.0)).otherwise(F.coalesce(F.col(f"{name}{f}"), F.lit(0.0))) for f in (0, 1)]
        return own[0] + own[1]

    return rows.join(sums, suffix, "left").withColumn(out, (both("b") + PRIOR / 2) / (both("n") + PRIOR)) \
        .drop("b0", "n0", "b1", "n1")


def train(labelled: DataFrame, features: list[str], sample: int) -> GBTClassificationModel:
    """Trees from distinct URLs with ``label`` (1: block), at most ``sample`` of each label; both must occur.

    A label beyond the bound is sampled by a hash of the URL, and its rows weigh what they stand for.
    """
    # Repeated URLs are alike in all features, so one row of each is enough.
    distinct = materialise(labelled.groupBy(F.coalesce("url", F.lit("")).alias("url")).agg(
        *[F.max(x).alias(x) for x in ("label", *features)]), "labelled-urls")
    sizes = {r["label"]: r["count"] for r in distinct.groupBy("label").count().collect()}
    chosen = materialise(reduce(DataFrame.unionByName, [
        distinct.filter(F.col("label") == label).orderBy(F.xxhash64("url"), "url").limit(sample)
        .withColumn("weight", F.lit(max(n / sample, 1.0))) for label, n in sorted(sizes.items())]), "url-sample")
    vectors = VectorAssembler(inputCols=features, outputCol="features").transform(
        chosen.withColumn("label", F.col("label").cast("double")))
    return GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, maxBins=32, seed=1, weightCol="weight").fit(
        vectors.select("features", "label", "weight"))


def judged(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, sample: int = SAMPLE) -> DataFrame:
    """page_id, url, host, path, rule, verdict, score: one row per row of ``pages`` (only page_id and url are read).

    ``verdict`` is the rule's, else the trees' (``score``: their probability of block, from 0.5 up block).
    Null URLs and URLs without "://" have empty host and path, meet no rule and are judged by the trees.
    Repeated rows are judged alike. If the rules label no URL, or all alike, the rest gets the common
    verdict, or allow without any; ``score`` is then 0 or 1.
    """
    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rows = materialise(
        parts.withColumn("found", rule_of(rules, F.col("host"), F.col("path")))
        .withColumns({name: x.cast("double") for name, x in lexical(F.col("url"), F.col("host"), F.col("path")).items()})
        .withColumns({
            "label": F.when(F.col("found").isNotNull(), (F.col("found.verdict") == "block").cast("int")),
            "fold": F.pmod(F.xxhash64(F.coalesce("url", F.lit(""))), F.lit(2)),
            "top": F.substring_index("host", ".", -1), "domain": F.substring_index("host", ".", -2)}), "urls")
    shared = materialise(_with_suffix_share(_with_suffix_share(rows, "top", _SUFFIX[0]), "domain", _SUFFIX[1]), "urls")
    features = _LEXICAL + _SUFFIX
    labelled = shared.filter(F.col("label").isNotNull())
    # Over all labelled rows, not a sample: one label only, or none.
    least, most = labelled.agg(F.min("label"), F.max("label")).first()
    if least == most:
        scored = shared.withColumn("score", F.lit(float(most or 0)))
    else:
        model = train(labelled, features, sample)
        from pyspark.ml.functions import vector_to_array

        scored = model.transform(VectorAssembler(inputCols=features, outputCol="features").transform(shared)) \
            .withColumn("score", vector_to_array("probability")[1])
    own = F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select("page_id", "url", "host", "path", F.col("found.rule").alias("rule"),
                         F.coalesce("found.verdict", own).alias("verdict"), "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(read(spark, sf_dir, "pages")).drop("url")


RULES_SQL = """
WITH p AS (
  SELECT page_id, regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 1) AS h,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
q AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM p),
r AS (FROM (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                   ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) AS t(verdict, domain, prefix))
SELECT q.page_id, q.host, q.path, max_by(r.domain || r.prefix, length(r.domain || r.prefix)) AS rule,
       max_by(r.verdict, length(r.domain || r.prefix)) AS verdict
FROM q LEFT JOIN r ON (q.host = r.domain OR ends_with(q.host, '.' || r.domain)) AND starts_with(q.path, r.prefix)
GROUP BY ALL
"""
