"""From raw documents to a training mixture, one stage after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardweave.llm.decontaminate import drop_contaminated
from shardweave.llm.joins import bounded
from shardweave.llm.mixture import even_weights, mix
from shardweave.llm.near_dedup import near_duplicates
from shardweave.llm.quality import quality
from shardweave.llm.rowkeys import row_key
from shardweave.llm.suffix_dedup import remove_repeats
from shardweave.plans.registry import table
from shardweave.session import configure
from shardweave.staging import stage


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    verdicts = quality(docs, table(spark, sf_dir, "labels"))
    bad = stage(verdicts.filter("not kept").select(F.col("_key").alias("__row_key")).distinct(), "rejected")
    return docs.join(bounded(bad), row_key() == F.col("__row_key"), "left_anti")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, five words to a shingle.

    Rows are told apart by doc_id and text. Of a group the least doc_id stays, a null one last;
    of rows equal in both, the least by their other columns.
    """
    key = row_key().alias("__row_key")
    groups = stage(near_duplicates(docs.select(row_key().alias("doc_id"), "text"), width=5).select(
        F.col("doc_id").alias("__row_key"), "component_id").distinct(), "groups")
    ids = docs.select(key, F.col("doc_id").isNull().alias("none"), "doc_id").distinct()
    first = groups.join(ids, "__row_key").groupBy("component_id").agg(
        F.min(F.struct("none", "doc_id", "__row_key")).alias("least"))
    gone = stage(groups.filter("component_id is not null").join(
        first.select("least.__row_key"), "__row_key", "left_anti").select("__row_key"), "copies")
    again = stage(docs.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("__row_key"), "repeated")
    left = docs.join(bounded(gone), row_key() == F.col("__row_key"), "left_anti")
    several = bounded(again)
    one = left.join(several, row_key() == F.col("__row_key"), "left_semi").groupBy(key).agg(
        F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return left.join(several, row_key() == F.col("__row_key"), "left_anti").unionByName(one)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier one has; those left empty go."""
    found = remove_repeats(docs).filter("n_removed = 0 or kept_text <> ''")
    return found.select(*[(F.col("kept_text") if c == "text" else F.col(f"doc.`{c}`")).alias(c)
                          for c in docs.columns])


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents and epochs that fill the token budget by target weights."""
    return mix(docs, even_weights(docs))


STAGES = [("quality classifier", good_documents), ("near duplicates", one_of_each),
          ("repeated passages", without_repeats), ("decontamination", without_benchmark),
          ("mixture", mixture)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
