"""URL rules, and gradient-boosted trees on lexical features where no rule decides.

The trees learn from the URLs that the rules label. All features are DataFrame
expressions, and the trees are Spark's own.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from queuelens.llm.frames import kept

# Verdict, and host with the start of the path.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
# Labelled URLs that the trees learn from, at most; picked by a hash of id and URL.
LEARNT = 40_000
TREES, DEPTH, RATE, SEED = 20, 4, 0.2, 11
ALPHABET = string.ascii_lowercase + string.digits + "./-_?=&%:#"
LEXICAL = ("length", "host_length", "path_length", "depth", "host_depth", "digit_ratio",
           "entropy", "n_params", "n_hyphens", "query_length")
SUFFIXES = ("tld", "domain")


def with_parts(pages: DataFrame, url: str) -> DataFrame:
    """``pages`` with host (A-Z lower-cased) and path; both empty without a ``://``."""
    address = F.coalesce(F.col(url), F.lit(""))
    host = F.regexp_extract(address, r"://([^/?#]*)", 1)
    return pages.withColumns({
        "host": F.translate(host, string.ascii_uppercase, string.ascii_lowercase),
        "path": F.regexp_extract(address, r"://[^/?#]*([^?#]*)", 1)})


def rule_of(rules: Sequence[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls where none does.

    A rule fits its host and all subdomains, if the path starts with the rule's.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decides, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        rule = F.when(fits, text).otherwise(rule)
        verdict = F.when(fits, decides).otherwise(verdict)
    return rule, verdict


def _lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    length = F.char_length(url)
    lower = F.lower(url)
    size = F.greatest(length, F.lit(1)).cast("double")
    counts = [length - F.char_length(F.replace(lower, F.lit(c), F.lit(""))) for c in ALPHABET]
    shares = [c / size for c in counts]
    entropy = sum((F.when(s > 0, -s * F.log2(s)).otherwise(0.0) for s in shares), F.lit(0.0))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    count = lambda of, what: F.regexp_count(of, F.lit(what)).cast("double")
    return {
        "length": length.cast("double"), "host_length": F.char_length(host).cast("double"),
        "path_length": F.char_length(path).cast("double"), "depth": count(path, "/"),
        "host_depth": count(host, r"\."), "digit_ratio": count(url, "[0-9]") / size,
        "entropy": entropy, "n_params": count(query, "="), "n_hyphens": count(url, "-"),
        "query_length": F.char_length(query).cast("double")}


def featured(pages: DataFrame, url: str, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """``pages`` with parts, rule, its verdict, lexical features and suffixes of the host."""
    parts = with_parts(pages, url)
    host, path = F.col("host"), F.col("path")
    rule, verdict = rule_of(rules, host, path)
    return parts.withColumns({
        "rule": rule, "ruled": verdict,
        **_lexical(F.coalesce(F.col(url), F.lit("")), host, path),
        "tld": F.substring_index(host, ".", -1), "domain": F.substring_index(host, ".", -2)})


def with_suffix_statistics(rows: DataFrame) -> tuple[DataFrame, list[str]]:
    """``rows`` with, per suffix of the host, how common it is and what its URLs are like.

    Counts and means cover all rows and are formed before any shuffle. Labels are left
    out: the rules label whole suffixes, so a share of allowed URLs would tell the trees
    everything about those and nothing about others.
    """
    columns = []
    for suffix in SUFFIXES:
        means = {f"{suffix}_{name}": F.avg(name) for name in ("length", "depth", "digit_ratio")}
        statistics = rows.groupBy(suffix).agg(
            F.log1p(F.count("*").cast("double")).alias(f"{suffix}_common"),
            *[mean.alias(name) for name, mean in means.items()])
        rows = rows.join(statistics, suffix, "left")
        columns += [f"{suffix}_common", *means]
    return rows, columns


def learn(rows: DataFrame) -> GBTClassificationModel | None:
    """Trees from the URLs that rules label; None unless both verdicts occur."""
    labelled = rows.where(F.col("ruled").isNotNull()).select(
        "features", (F.col("ruled") == "allow").cast("double").alias("label"), "pick")
    n, low, high = labelled.agg(F.count("*"), F.min("label"), F.max("label")).first()
    if not n or low == high:
        return None
    share = min(1.0, LEARNT / n)
    sample = labelled.where(F.col("pick") < int(share * (1 << 30)))
    return GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, seed=SEED).fit(
        sample.select("features", "label"))


def judge(pages: DataFrame, key: str = "page_id", url: str = "url",
          rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score): one row per row of ``pages``.

    Null and malformed URLs have empty parts and are judged by the trees. Where rules
    label only one verdict, or none, there is nothing to learn and the rest is allowed.
    Extra columns of the input are ignored.
    """
    only = pages.select(F.col(key).alias("page_id"), F.col(url).cast("string").alias("url"))
    rows, suffix_columns = with_suffix_statistics(kept(featured(only, "url", rules), "urls"))
    pick = F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 30))
    assembled = VectorAssembler(inputCols=[*LEXICAL, *suffix_columns], outputCol="features").transform(
        rows.withColumn("pick", pick))
    model = learn(assembled)
    if model is None:
        scored = assembled.withColumn("score", F.lit(1.0))
    else:
        scored = model.transform(assembled).withColumn(
            "score", vector_to_array("probability")[1])
    verdict = F.coalesce("ruled", F.when(F.col("score") >= 0.5, "allow").otherwise("block"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
