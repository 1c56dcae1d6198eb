"""Mixing sources to target weights, native.

Budgets go down a tree of domains, languages and sources. At every node the budget is
shared by weight; a child that cannot use its share keeps what it can supply, and the rest
goes to its siblings, before any of it goes back up, because a node's supply is that of all
below it. Each leaf then takes whole seeded epochs and a token prefix of one more.

The tree has one row per leaf. Prefixes are cut on hashed order: token sums per hash bucket
find the bucket where a leaf's budget ends, and only that bucket is put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardweave.llm.joins import bounded
from shardweave.staging import stage

LEVELS = ("domain", "lang", "source")
BUCKET_ROWS = 500


def token_count(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    return F.coalesce(F.size(F.filter(F.split(text.cast("string"), r"[\x20\x09-\x0D]+"), lambda w: w != "")),
                      F.lit(0)).cast("long")


def share(children: DataFrame, parent: list[str]) -> DataFrame:
    """Add ``budget``: the parent's ``total`` shared by ``weight``, at most ``supply`` each.

    Children fill up in the order of supply to weight; those before the first that does not
    fill up keep their supply, the others share what is left.
    """
    ratio = F.when(F.col("weight") > 0, F.col("supply") / F.col("weight")).otherwise(F.lit(float("inf")))
    order = Window.partitionBy(*parent).orderBy("ratio", *LEVELS) if parent else \
        Window.partitionBy(F.lit(0)).orderBy("ratio", *LEVELS)
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("total") - F.coalesce(F.sum("supply").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    out = children.withColumn("ratio", ratio).withColumn("level", F.when(F.col("weight") > 0, level))
    full = F.col("level") >= F.col("ratio")
    out = out.withColumn("full", F.coalesce(full, F.lit(False)))
    out = out.withColumn("first_level", F.max(F.when(~F.col("full"), F.col("level"))).over(group))
    budget = F.when(F.col("weight") <= 0, F.lit(0.0)).when(F.col("full"), F.col("supply")).otherwise(
        F.col("first_level") * F.col("weight"))
    return out.withColumn("budget", budget).drop("ratio", "level", "full", "first_level")


def leaf_budgets(leaves: DataFrame, total: Column, epochs: int) -> DataFrame:
    """Leaves (domain, lang, source, tokens, weight_<level>) with their ``budget`` in tokens.

    A leaf supplies nothing if a weight on its path is null, negative, zero or not a number.
    """
    weighs = F.lit(True)
    for level in LEVELS:
        weight = F.col(f"weight_{level}")
        weighs = weighs & F.coalesce((weight > 0) & (weight < float("inf")), F.lit(False))
    tree = leaves.withColumn("leaf_supply", F.when(weighs, F.col("tokens") * epochs).otherwise(0).cast("double"))
    budgets = None
    for depth in range(1, len(LEVELS) + 1):
        path, parent = list(LEVELS[:depth]), list(LEVELS[:depth - 1])
        nodes = tree.groupBy(*path).agg(F.sum("leaf_supply").alias("supply"),
                                        F.max(F.when(F.col("leaf_supply") > 0, F.col(f"weight_{LEVELS[depth - 1]}")))
                                        .cast("double").alias("weight"))
        nodes = nodes.select(*path, *[F.lit("").alias(c) for c in LEVELS[depth:]], "supply",
                             F.when(F.col("supply") > 0, F.col("weight")).otherwise(0.0).alias("weight"))
        if budgets is None:
            nodes = nodes.withColumn("total", F.least(total, F.sum("supply").over(Window.partitionBy(F.lit(0)))))
        else:
            nodes = nodes.join(budgets, parent)
        budgets = share(nodes, parent).select(*path, F.col("budget").alias("total"))
    return budgets.withColumnRenamed("total", "budget")


def mix(docs: DataFrame, weights: DataFrame, share_of_corpus: float = 0.5, epochs: int = 2,
        seed: int = 17) -> DataFrame:
    """One row per document and epoch that is used: doc_id, domain, lang, source, n_tokens,
    epoch, take_tokens.

    ``weights`` has source, domain, weight_domain, weight_lang, weight_source: one row per
    source; a source without a row is its own domain "other" with weight 1. The whole budget is
    ``share_of_corpus`` of all tokens, and no leaf gives more than ``epochs`` times its own.
    ``take_tokens`` is the prefix used of a document: all of it, but for the last of a leaf.

    Null languages and sources are the leaf "". Documents without tokens are never used, nor are
    leaves with a weight on their path that is negative, zero or no finite number; what they cannot
    take goes to the others. A null weight counts as 1, like a missing row.
    Rows that share a doc_id are ordered by their text; equal rows follow each other. Extra columns
    are ignored, whatever their names. Empty tables give no rows.
    """
    known = weights.select(F.col("source").alias("_source"), "domain", "weight_domain", "weight_lang",
                           "weight_source")
    counted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        token_count(F.col("text")).alias("n_tokens"),
        F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")).alias("text_key"))
    counted = stage(counted.filter("n_tokens > 0"), "counted")
    sums = counted.groupBy("lang", "source").agg(F.sum("n_tokens").alias("tokens"),
                                                 F.count(F.lit(1)).alias("docs"))
    leaves = stage(sums.join(known, F.col("source") == F.col("_source"), "left").select(
        F.coalesce("domain", F.lit("other")).alias("domain"), "lang", "source", "tokens", "docs",
        *[F.coalesce(F.col(f"weight_{c}").cast("double"), F.lit(1.0)).alias(f"weight_{c}") for c in LEVELS]),
        "leaves")
    tokens = leaves.agg(F.sum("tokens")).first()[0] or 0
    budgets = leaf_budgets(leaves, F.lit(float(int(tokens * share_of_corpus))), epochs)
    plan = leaves.join(budgets, list(LEVELS)).select(
        *LEVELS, "tokens", F.floor(F.col("budget") + 1e-6).cast("long").alias("budget"),
        F.ceil(F.col("docs") / BUCKET_ROWS).cast("long").alias("buckets"))
    plan = plan.withColumn("whole", F.expr("budget div tokens")).withColumn("rest", F.expr("budget % tokens"))
    plan = bounded(stage(plan, "plan"))

    rows = counted.join(plan, ["lang", "source"])
    hashed = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"),
                               F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_key").cast("binary"))
    rows = rows.withColumn("h", hashed).withColumn(
        "bucket", (F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * F.col("buckets")
                   / F.lit(2**32)).cast("long"))
    in_order = Window.partitionBy("lang", "source").orderBy("bucket")
    sizes = rows.groupBy("lang", "source", "rest", "bucket").agg(F.sum("n_tokens").alias("size"))
    # One row per bucket of some hundred documents.
    starts = sizes.withColumn("start", F.sum("size").over(in_order) - F.col("size"))
    edge = bounded(stage(starts.filter("start < rest and start + size >= rest").select(
        "lang", "source", F.col("bucket").alias("edge"), "start"), "edges"))
    rows = rows.join(edge, ["lang", "source"], "left")
    part = Window.partitionBy("lang", "source", "bucket").orderBy("h", "doc_id", "text_key").rowsBetween(
        Window.unboundedPreceding, -1)
    columns = ["doc_id", *LEVELS, "n_tokens"]
    inside = rows.filter("bucket < edge").select(
        *columns, F.col("whole").alias("epoch"), F.col("n_tokens").alias("take_tokens"))
    last = rows.filter("bucket = edge").withColumn(
        "before", F.col("start") + F.coalesce(F.sum("n_tokens").over(part), F.lit(0))).filter(
        "before < rest").select(*columns, F.col("whole").alias("epoch"),
                                F.least("n_tokens", F.col("rest") - F.col("before")).alias("take_tokens"))
    full = rows.filter("whole > 0").select(
        *columns, F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1)).alias("epoch"),
        F.col("n_tokens").alias("take_tokens"))
    return full.unionByName(inside).unionByName(last)


def even_weights(docs: DataFrame, domains: int = 3) -> DataFrame:
    """A weights table from the sources of ``docs``: domain by hash, domain weights 1, 2, 3, ..."""
    sources = docs.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source")).distinct()
    number = F.pmod(F.crc32(F.col("source").cast("binary")), F.lit(domains))
    return sources.select(
        "source", F.concat(F.lit("domain"), number.cast("string")).alias("domain"),
        (number + 1).cast("double").alias("weight_domain"), F.lit(1.0).alias("weight_lang"),
        (F.pmod(F.crc32(F.reverse("source").cast("binary")), F.lit(3)) + 1).cast("double").alias("weight_source"))
