"""Packing encoded documents into one token stream per split, cut into shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardweave.operators.documents import MERGE_ORDER
from shardweave.operators.order import running_total

SHARD_SIZE = 1_000_000
# Pieces never cross a multiple of this many tokens inside their shard, so any
# window can find its pieces by an equi-join on (shard, block).
BLOCK_TOKENS = 1024
# Consecutive shards in one folder of a stored table: about a billion tokens of full shards.
FOLDER_SHARDS = 1024
FOLDER = "shard_folder"


def token_offsets(encoded: DataFrame, order: list[str] | None = None,
                  within: list[str] | None = None) -> DataFrame:
    """Add ``span`` (tokens plus the end marker) and ``offset`` in the split's stream."""
    spans = encoded.withColumn("span", (F.col("n_tokens") + 1).cast("long"))
    return running_total(spans, order or MERGE_ORDER, "span", within or ["split"], "offset")


def cut_into_shards(located: DataFrame, eos_id: int, shard_size: int | None = SHARD_SIZE,
                    block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Pieces ``(split, shard_idx, block, start, tokens)`` in stream order.

    Each document is cut where its tokens cross a shard or block boundary. The cut
    points follow from its offset alone, so this step needs no shuffle. Without
    ``shard_size`` a split is one shard, still in many rows.
    """
    first, past = F.col("offset"), F.col("offset") + F.col("span")
    size = F.lit(shard_size if shard_size else 2**62).cast("long")
    # The end marker is appended once per document, before rows multiply.
    stream = F.concat("ids", F.array(F.lit(eos_id))).alias("stream")
    by_shard = located.select(
        "split", stream, "offset", "span",
        F.explode(F.sequence(_div(first, size), _div(past - 1, size))).alias("shard"))
    base = F.col("shard") * size
    low = F.greatest(first, base)
    high = F.least(past, base + size)
    step = F.lit(block_tokens).cast("long")
    by_block = by_shard.select(
        "split", "stream", "offset", "shard", (low - base).alias("low"), (high - base).alias("high"),
        base.alias("base"),
        F.explode(F.sequence(_div(low - base, step), _div(high - base - 1, step))).alias("block"))
    start = F.greatest(F.col("low"), F.col("block") * step)
    end = F.least(F.col("high"), (F.col("block") + 1) * step)
    return by_block.select(
        "split", F.col("shard").cast("int").alias("shard_idx"), "block", start.alias("start"),
        F.slice("stream", (F.col("base") + start - F.col("offset") + 1).cast("int"),
                (end - start).cast("int")).alias("tokens"))


def shard_count(total: Column, shard_size: int) -> Column:
    """Shards a stream of ``total`` tokens fills; an empty stream still has one."""
    return F.greatest(F.lit(1), F.ceil(total / F.lit(shard_size))).cast("long")


def shard_names(split: Column, index: Column) -> Column:
    return F.format_string("%s_%03d.bin", split, index)


def shard_list(totals: DataFrame, shard_size: int = SHARD_SIZE) -> DataFrame:
    """One row per shard file, from ``(split, tokens)`` totals."""
    count = shard_count(F.col("tokens"), shard_size)
    indexes = F.sequence(F.lit(0), (count - 1).cast("int"))
    return (totals.select("split", F.explode(indexes).alias("shard_idx"))
            .withColumn("file", shard_names(F.col("split"), F.col("shard_idx"))))


def planned_lengths(totals: DataFrame, shard_size: int = SHARD_SIZE) -> DataFrame:
    """``(split, shard_idx, file, length)`` from ``(split, tokens)`` totals: nothing is cut to know it."""
    listed = shard_list(totals.select("split", "tokens"), shard_size).join(
        F.broadcast(totals.select("split", "tokens")), "split")  # a row per split
    size = F.lit(shard_size).cast("long")
    return listed.select("split", "shard_idx", "file", F.least(
        size, F.col("tokens") - F.col("shard_idx") * size).alias("length"))


def shard_lengths(pieces: DataFrame) -> DataFrame:
    """Lengths as found in stored pieces."""
    return (pieces.groupBy("split", "shard_idx")
            .agg(F.sum(F.size("tokens").cast("long")).alias("length")))


def write_shards(pieces: DataFrame, path: str, folder_shards: int = FOLDER_SHARDS) -> None:
    """Parquet table of shards, a folder for each ``folder_shards`` consecutive ones of a split.

    Buckets of the offset step hold consecutive shards, so no shuffle is added; the
    sort gives row groups narrow ``shard_idx`` ranges for pruning. Readers of a few shards open
    only their folders.
    """
    (pieces.withColumn(FOLDER, shard_folder(F.col("shard_idx"), folder_shards))
     .sortWithinPartitions("split", FOLDER, "shard_idx", "start")
     .write.partitionBy("split", FOLDER).mode("errorifexists").parquet(path))


def shard_folder(shard_idx: Column, folder_shards: int = FOLDER_SHARDS) -> Column:
    return _div(shard_idx, F.lit(folder_shards)).cast("int")


def _div(a: Column, b: Column) -> Column:
    """Whole-number division of non-negative longs, without a trip to doubles."""
    return F.call_function("div", a, b)
