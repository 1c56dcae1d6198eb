"""Streaming queries: all input present now, so results equal the batch ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from shardweave.operators import char_vocab
from shardweave.plans.corpus import SQL_ENCODED, SQL_ROUTED, VAL_RATIO, char_list
from shardweave.plans.document_queries import _SQL_QUOTA, _quota_entries
from shardweave.plans.packing_queries import text_of
from shardweave.plans.registry import query, table
from shardweave.sources.config import config_frame
from shardweave.staging import new_path
from shardweave.streaming import arriving


def _stream(spark, sf_dir):
    # A pattern that only the table's own path meets: streams refuse the plain path of a file,
    # and a filter on names would leave out all parts of a folder.
    schema = table(spark, sf_dir, "documents").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/documents.parque[t]").withColumnRenamed("source", "source_id")


@query(f"WITH {SQL_ENCODED} SELECT doc_id, split, array_to_string(ids, ' ') AS ids FROM encoded")
def stream_route_encode(spark, sf_dir):
    chars = char_list(spark, sf_dir)
    routed = arriving.route_stream(_stream(spark, sf_dir), VAL_RATIO, "doc_id",
                                   lambda text: char_vocab.encode(text, chars))
    found = arriving.drain_to_table(routed.select("doc_id", "split", "ids"), "stream-route")
    return found.select("doc_id", "split", text_of("ids"))


@query(f"""
WITH {SQL_ROUTED}
SELECT split, source_id, count(*) AS texts, sum(length(text) + 1)::BIGINT AS tokens
FROM routed GROUP BY split, source_id""")
def stream_counts(spark, sf_dir):
    routed = arriving.route_stream(_stream(spark, sf_dir), VAL_RATIO, "doc_id")
    counts = arriving.running_counts(routed.withColumn("n_tokens", F.length("text")))
    out = new_path(spark, "stream-counts")
    arriving.drain_batches(
        counts, lambda df, _: df.write.mode("overwrite").parquet(out), "stream-counts", "complete")
    return spark.read.parquet(out)


@query(f"WITH {_SQL_QUOTA} SELECT source_id, doc_idx, doc_id FROM kept")
def stream_quota(spark, sf_dir):
    quotas = config_frame(spark, _quota_entries(spark, sf_dir))
    out = new_path(spark, "stream-quota")
    rows = _stream(spark, sf_dir).select("source_id", "doc_id")
    arriving.drain_batches(rows, arriving.quota_writer(
        quotas, "doc_id", out, new_path(spark, "stream-quota-seen")), "stream-quota")
    return spark.read.parquet(out).select("source_id", "doc_idx", "doc_id")
