"""One query per operator, each over its whole table, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from shardweave.llm import oracle_sql
from shardweave.llm.decontaminate import contamination
from shardweave.llm.filter_audit import audit_filters
from shardweave.llm.html_extract import extract
from shardweave.llm.languages import languages
from shardweave.llm.lexical_search import search
from shardweave.llm.licenses import scan_licenses
from shardweave.llm.mixture import even_weights, mix
from shardweave.llm.near_dedup import near_duplicates
from shardweave.llm.quality import quality
from shardweave.llm.suffix_dedup import remove_repeats
from shardweave.llm.suffix_tree import score
from shardweave.llm.topk import top_k
from shardweave.llm.url_filter import filter_urls
from shardweave.plans.registry import table
from shardweave.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = sql
        return run
    return register


@query()
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(configure(spark), sf_dir, "documents"))


@query()
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark = configure(spark)
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("_key")


@query()
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(configure(spark), sf_dir, "documents")).select(
        "doc.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query()
def op5_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents")
    return mix(docs, even_weights(docs))


@query()
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark = configure(spark)
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("_key")


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL


@query()
def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(configure(spark), sf_dir, "embeddings")).drop("query_key")


@query()
def op7_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(configure(spark), sf_dir, "documents"))


@query()
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(configure(spark), sf_dir, "pages"))


@query()
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("doc_id").cast("long")
    path = F.concat_ws("/", "source", "lang", F.floor(number / 100).cast("string"), number.cast("string"))
    return scan_licenses(table(configure(spark), sf_dir, "documents"), path)


@query()
def op8_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(configure(spark), sf_dir, "documents"))


@query(oracle_sql.FILTER_AUDIT)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark = configure(spark)
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(oracle_sql.LEXICAL_SEARCH)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark = configure(spark)
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(configure(spark), sf_dir, "pages"))
