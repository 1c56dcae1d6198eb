"""URL filters: host and path rules, then logistic regression on character n-grams; native.

Labelled URLs are those that a rule decides. The model is fitted on a bounded sample of them by
gradient steps, each one aggregation over the sample's grams, and has one weight per hash
bucket, so scoring is a lookup in an array literal.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardweave.llm.rowkeys import lower_ascii
from shardweave.staging import stage

#: (host and path, verdict)
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block"))
BUCKETS, GRAM, SAMPLE, STEPS, RATE, DECAY = 1024, 3, 1000, 25, 2.0, 1e-3


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.coalesce(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))
    return lower_ascii(host), path


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):
        cut = text.index("/")
        name, start = text[:cut], text[cut:]
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(start))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def gram_buckets(host: Column, path: Column) -> Column:
    """Distinct hash buckets of the n-grams of host and path."""
    text = F.concat(F.lit("^"), host, path, F.lit("$$"))
    starts = F.sequence(F.lit(1), F.length(text) - (GRAM - 1))
    return F.array_distinct(F.transform(starts, lambda i: F.pmod(
        F.xxhash64(F.substr(text, i, F.lit(GRAM))), F.lit(BUCKETS)).cast("int")))


def _logit(grams: Column, weights: list[float], bias: float) -> Column:
    table = F.from_json(F.lit(json.dumps(weights)), "array<double>")
    total = F.aggregate(grams, F.lit(0.0), lambda acc, g: acc + F.element_at(table, g + 1))
    return total / F.sqrt(F.size(grams).cast("double")) + F.lit(bias)


def fit(labelled: DataFrame) -> tuple[list[float], float]:
    """Weights and bias from (grams, y); one class alone gives a bias only."""
    rows = stage(labelled.select(F.monotonically_increasing_id().alias("row"), "grams", "y"), "labelled")
    n, ones = rows.agg(F.count(F.lit(1)), F.sum("y")).first()
    weights = [0.0] * BUCKETS
    if not n:
        return weights, -1.0
    share = min(max((ones or 0) / n, 0.01), 0.99)
    bias = math.log(share / (1 - share))
    if ones in (0, n):
        return weights, bias
    for _ in range(STEPS):
        p = 1 / (1 + F.exp(-_logit(F.col("grams"), weights, bias)))
        slopes = rows.select(((p - F.col("y")) / F.sqrt(F.size("grams").cast("double"))).alias("e"),
                             (p - F.col("y")).alias("b"), F.explode(F.concat(F.array(F.lit(-1)), F.col("grams")))
                             .alias("g")).groupBy("g").agg(F.sum("e").alias("e"), F.sum("b").alias("b")).collect()
        weights = [w * (1 - DECAY) for w in weights]
        for row in slopes:  # one row per bucket
            if row.g == -1:
                bias -= RATE * row.b / n
            else:
                weights[row.g] -= 4 * RATE * row.e / n
    return [round(w, 9) for w in weights], round(bias, 9)


def filter_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score for every row.

    ``score`` is the model's probability of a block; it decides where no rule does, from 0.5.
    The model is fitted on the ``SAMPLE`` distinct URLs of least hash with each verdict among those
    that a rule decides. A null URL has an empty host and path. Without labelled URLs, the
    model allows. Rows that share a page_id are judged each by its own URL.
    """
    host, path = url_parts(F.col("url").cast("string"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    parts = parts.withColumn("rule", rule).withColumn("said", verdict)
    urls = parts.filter("said is not null").select("host", "path", "said").distinct()
    samples = [urls.filter(F.col("said") == says).orderBy(F.xxhash64("host", "path"), "host", "path").limit(SAMPLE)
               for says in ("allow", "block")]
    labelled = samples[0].unionByName(samples[1]).select(
        gram_buckets(F.col("host"), F.col("path")).alias("grams"), (F.col("said") == "block").cast("double").alias("y"))
    weights, bias = fit(labelled)
    score = 1 / (1 + F.exp(-_logit(F.col("grams"), weights, bias)))
    return parts.withColumn("grams", gram_buckets(F.col("host"), F.col("path"))).select(
        "page_id", "host", "path", "rule", "said", score.alias("score")).select(
        "page_id", "host", "path", "rule",
        F.coalesce("said", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")
