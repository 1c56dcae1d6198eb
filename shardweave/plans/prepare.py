"""The two preparation jobs from source tables to packed shards."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardweave.functions.split import check_ratio
from shardweave.operators import documents, pack, stats
from shardweave.operators.bpe_encode import id_dtype
from shardweave.operators.tokenizers import BpeTokenizer, Tokenizer
from shardweave.sources import artifacts, scan
from shardweave.sources.binshards import write_shards_as_bins
from shardweave.sources.config import check_entries, config_frame

ENCODED, SHARDS, VOCABULARY = "encoded", "shards", "tokenizer"
#: Tokens of one part of a single stream, 128 MB as 16-bit numbers.
PART_TOKENS = 64 << 20


@dataclass
class Prepared:
    """Where a job left its tables."""

    encoded: DataFrame
    shards: DataFrame
    stats: DataFrame


def merged_documents(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """``(source_id, src_pos, doc_idx, id, text)`` of all sources, quotas applied.

    Rows are numbered in file order, which needs no shuffle of documents; files past a
    quota are not read.
    """
    texts = documents.extract(scan.numbered_sources(spark, entries))
    own_id = F.col("id") if "id" in texts.columns else F.lit(None).cast("string")
    return texts.select("source_id", "src_pos", "doc_idx", own_id.alias("id"), "text")


def prepare_corpus(spark: SparkSession, entries: list[dict], out: str,
                   tokenizer: Tokenizer | None = None, val_ratio: float = 0.01,
                   shard_size: int = pack.SHARD_SIZE, digest: str = "sha256",
                   reuse_vocabulary: bool = False, fit_on: str = "all",
                   export_bins: bool = True) -> Prepared:
    """Merge, split by hash, learn, encode, pack, and describe many sources.

    ``fit_on``: learn the vocabulary from "all" documents or from "train" only.
    Documents are read again for encoding rather than kept: a scan is cheaper than
    storing the corpus twice. What encoding yields is written once. The manifests come last
    and list the ``.bin`` files that ``export_bins`` wrote.
    """
    check_ratio(val_ratio), check_entries(entries)
    if fit_on not in ("all", "train"):
        raise ValueError(f"fit_on must be 'all' or 'train', got {fit_on}")
    tokenizer = tokenizer or BpeTokenizer()
    docs = scan.spread(documents.route(merged_documents(spark, entries), val_ratio, "id", digest))
    if reuse_vocabulary:
        tokenizer.load(spark, f"{out}/{VOCABULARY}")
    else:
        tokenizer.fit(docs if fit_on == "all" else docs.filter("split = 'train'"))
        tokenizer.save(spark, f"{out}/{VOCABULARY}")
    dtype = id_dtype(tokenizer.vocab_size)

    ids = tokenizer.encode(F.col("text")).alias("ids")
    (docs.select("split", "source_id", "src_pos", "doc_idx", "doc_key", ids)
     .withColumn("n_tokens", F.size("ids")).write.parquet(f"{out}/{ENCODED}"))
    encoded = spark.read.parquet(f"{out}/{ENCODED}")
    pieces = pack.cut_into_shards(pack.token_offsets(encoded), tokenizer.eos_id, shard_size)
    pack.write_shards(pieces, f"{out}/{SHARDS}")
    shards = spark.read.parquet(f"{out}/{SHARDS}")

    config = config_frame(spark, entries).withColumnRenamed("split", "split_name")
    counted = stats.complete_stats(config, stats.source_stats(encoded))
    shape = (tokenizer.kind, tokenizer.vocab_size, val_ratio, shard_size, dtype, export_bins)
    if export_bins:
        write_shards_as_bins(shards, out, dtype)
    artifacts.save_manifests(stats.root_manifest(counted, *shape),
                             stats.split_manifests(counted, *shape), out)
    return Prepared(encoded, shards, counted)


def prepare_single(spark: SparkSession, path: str, out: str, order: str | None = None,
                   tokenizer: Tokenizer | None = None, train_fraction: float = 0.9,
                   part_tokens: int = PART_TOKENS, reuse_vocabulary: bool = False) -> Prepared:
    """One table of texts: prefix split, learn on train, one token stream per split.

    A stream is written in parts of ``part_tokens``, as Parquet and as ``.bin`` files that
    ``read_prepared`` reads; in order they are the stream. ``order`` names a unique key column, by default
    rows count in file order. The manifests come last.
    """
    tokenizer = tokenizer or BpeTokenizer()
    entry = {"path": path, "split": "", "order": order}
    total = scan.scan_source(spark, entry, 0).count()
    placed = scan.numbered_source(spark, entry, out="position").select("position", "text")
    docs = scan.spread(documents.route_prefix(placed, train_fraction, "position", total))
    if reuse_vocabulary:
        tokenizer.load(spark, f"{out}/{VOCABULARY}")
    else:
        tokenizer.fit(docs.filter("split = 'train'"))
        tokenizer.save(spark, f"{out}/{VOCABULARY}")
    dtype = id_dtype(tokenizer.vocab_size)
    (docs.select("split", "position", tokenizer.encode(F.col("text")).alias("ids"))
     .withColumn("n_tokens", F.size("ids")).write.parquet(f"{out}/{ENCODED}"))
    encoded = spark.read.parquet(f"{out}/{ENCODED}")
    located = pack.token_offsets(encoded, ["position"])
    pack.write_shards(pack.cut_into_shards(located, tokenizer.eos_id, part_tokens), f"{out}/{SHARDS}")
    shards = spark.read.parquet(f"{out}/{SHARDS}")
    write_shards_as_bins(shards, out, dtype)
    summary = stats.simple_manifest(encoded, path, tokenizer.kind, tokenizer.vocab_size,
                                    train_fraction, dtype)
    artifacts.save_manifests(summary, stats.stream_manifests(encoded, part_tokens, dtype), out)
    return Prepared(encoded, shards, summary)
