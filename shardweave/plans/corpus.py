"""The merged corpus as the queries see it: ``documents`` read as many sources.

Sources are the values of ``documents.source``, ``doc_id`` orders each of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardweave.operators import char_vocab
from shardweave.operators.documents import extract, index_documents, route
from shardweave.plans.registry import table
from shardweave.sources.config import config_frame, config_from_column
from shardweave.sources.scan import spread
from shardweave.staging import stage

VAL_RATIO = 0.1
SHARD_SIZE = 50_000

# SQL twins of the frames below, joined into WITH lists by the queries.
SQL_SOURCES = """
sources AS (
  SELECT source AS source_id, (row_number() OVER (ORDER BY source) - 1)::INTEGER AS src_pos,
         count(*) AS n_docs
  FROM documents GROUP BY source)"""
SQL_DOCS = SQL_SOURCES + """,
docs AS (
  SELECT d.doc_id, d.text, d.lang, s.source_id, s.src_pos,
         row_number() OVER (PARTITION BY d.source ORDER BY d.doc_id) - 1 AS doc_idx
  FROM documents d JOIN sources s ON d.source = s.source_id)"""
SQL_ROUTED = SQL_DOCS + f""",
routed AS (
  SELECT *, source_id || ':' || doc_id AS doc_key,
         CASE WHEN substr(sha256(source_id || ':' || doc_id), 1, 16)
                   < '{int(VAL_RATIO * 2**64):016x}' THEN 'val' ELSE 'train' END AS split
  FROM docs)"""
SQL_CHARS = """
chars AS (
  SELECT ch, (row_number() OVER (ORDER BY encode(ch)) - 1)::INTEGER AS id
  FROM (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM documents) WHERE ch <> '')"""
SQL_ENCODED = SQL_ROUTED + "," + SQL_CHARS + """,
enc AS (
  SELECT r.doc_id, list(c.id ORDER BY t.pos) AS ids
  FROM routed r, LATERAL (SELECT unnest(string_split(r.text, '')) AS ch,
                                 generate_subscripts(string_split(r.text, ''), 1) AS pos) t
  JOIN chars c ON c.ch = t.ch GROUP BY r.doc_id),
encoded AS (
  SELECT r.split, r.source_id, r.src_pos, r.doc_idx, r.doc_id, e.ids, len(e.ids) AS n_tokens
  FROM routed r JOIN enc e USING (doc_id))"""
SQL_OFFSETS = SQL_ENCODED + """,
eos AS (SELECT max(id) + 1 AS eos FROM chars),
located AS (
  SELECT *, n_tokens + 1 AS span,
         (sum(n_tokens + 1) OVER (PARTITION BY split ORDER BY doc_idx, src_pos)
          - (n_tokens + 1))::BIGINT AS off
  FROM encoded),
stream AS (
  SELECT split, off + pos - 1 AS p, tok
  FROM (SELECT split, off, unnest(list_append(ids, eos)) AS tok,
               generate_subscripts(list_append(ids, eos), 1) AS pos
        FROM located, eos))"""


def unit_sql(key: str) -> str:
    """SQL twin of ``unit_hash``."""
    return f"(('0x' || substr(sha256({key}), 1, 13))::BIGINT / pow(2, 52))"


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text)``, spread for per-character and per-word work."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def indexed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "documents")
    config = config_frame(spark, config_from_column(raw, "source"))
    tagged = raw.withColumnRenamed("source", "source_id").join(
        F.broadcast(config.select("source_id", "src_pos")), "source_id")
    return index_documents(
        tagged.select("doc_id", "text", "lang", "source_id", "src_pos"), "doc_id")


def routed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route(extract(indexed_documents(spark, sf_dir)), VAL_RATIO, "doc_id")


def char_list(spark: SparkSession, sf_dir: str) -> list[str]:
    return char_vocab.characters(char_vocab.learn(texts(spark, sf_dir)))


def char_encoded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """Routed documents with character ids, staged since several steps read them."""
    chars = char_list(spark, sf_dir)
    docs = routed_documents(spark, sf_dir)
    encoded = docs.select("split", "source_id", "src_pos", "doc_idx", "doc_id",
                          char_vocab.encode(F.col("text"), chars).alias("ids"))
    return stage(encoded.withColumn("n_tokens", F.size("ids")), "encoded"), chars
