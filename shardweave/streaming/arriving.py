"""Arriving documents: the stateless steps, running counts, and quotas with state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardweave.functions.split import split_name
from shardweave.functions.text import doc_key
from shardweave.operators.documents import extract
from shardweave.operators.order import running_total
from shardweave.sources.config import MAX_SOURCES
from shardweave.staging import drop_stage, new_path, stage


def route_stream(docs: DataFrame, ratio: float, row_id: str,
                 encode: Callable[[Column], Column] | None = None) -> DataFrame:
    """Extract, key, split and optionally encode; works on streams and tables alike.

    Documents need an id of their own: positions only exist once all input is there.
    """
    key = doc_key(F.col("source_id"), F.col(row_id), F.lit(None))
    routed = extract(docs).withColumn("doc_key", key).withColumn("split", split_name(key, ratio))
    return routed.withColumn("ids", encode(F.col("text"))) if encode else routed


def running_counts(encoded: DataFrame) -> DataFrame:
    """Texts and tokens so far per (split, source)."""
    return encoded.groupBy("split", "source_id").agg(
        F.count("*").alias("texts"), F.sum(F.col("n_tokens") + 1).cast("long").alias("tokens"))


def quota_writer(quotas: DataFrame, order: str, out: str, state: str):
    """A ``foreachBatch`` function that keeps the first ``max_docs`` rows per source.

    ``quotas(source_id, max_docs)`` is the config, checked to be short. State is one small table per
    batch, the rows seen per source. Rows inside a batch are numbered by a distributed
    running total, so a hot source is spread over tasks; keyed state would send all its
    rows to one. A batch is written once, then read as often as its steps need, and of sources that
    are full nothing is read further. Every file is named by its batch, so a repeated batch writes
    the same.
    """
    limits = quotas.select("source_id", "max_docs")
    if limits.limit(MAX_SOURCES + 1).count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} quotas")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = stage(batch, "arrived")
        counts = rows.groupBy("source_id").agg(F.count("*").alias("n"))
        if batch_id:
            seen = spark.read.schema("source_id string, n long").parquet(
                f"{state}/batch={batch_id - 1}")
        else:
            seen = counts.select("source_id", F.lit(0).cast("long").alias("n")).limit(0)
        (counts.unionByName(seen).groupBy("source_id").agg(F.sum("n").alias("n"))
         .coalesce(1).write.mode("overwrite").parquet(f"{state}/batch={batch_id}"))

        # One row per configured source with room left: safe to broadcast.
        room = limits.join(seen, "source_id", "left").select(
            "source_id", "max_docs", F.coalesce("n", F.lit(0)).alias("_seen")).filter(
                "max_docs IS NULL OR _seen < max_docs")
        due = rows.join(F.broadcast(room), "source_id")
        numbered = running_total(due, [order], within=["source_id"], out="doc_idx")
        kept = (numbered.withColumn("doc_idx", F.col("doc_idx") + F.col("_seen"))
                .filter(F.col("max_docs").isNull() | (F.col("doc_idx") < F.col("max_docs")))
                .drop("_seen", "max_docs"))
        kept.select(*batch.columns, "doc_idx").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        drop_stage(rows)

    return write


def drain_to_table(stream: DataFrame, label: str) -> DataFrame:
    """Run a stateless stream over all input there is now, and read what it wrote."""
    spark = stream.sparkSession
    out = new_path(spark, label)
    (stream.writeStream.format("parquet").option("path", out)
     .option("checkpointLocation", new_path(spark, f"{label}-log"))
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(stream.schema).parquet(out)


def drain_batches(stream: DataFrame, write, label: str, mode: str = "append") -> None:
    """Run ``write`` on every micro-batch of the input there is now."""
    (stream.writeStream.foreachBatch(write).outputMode(mode)
     .option("checkpointLocation", new_path(stream.sparkSession, f"{label}-log"))
     .trigger(availableNow=True).start().awaitTermination())
