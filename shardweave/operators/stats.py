"""Counts per split and source, and the manifests built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardweave.operators.pack import SHARD_SIZE, shard_count, shard_names

SPLITS = ("train", "val")


def source_stats(encoded: DataFrame) -> DataFrame:
    """Texts and tokens per (split, source); each text adds one end marker."""
    return encoded.groupBy("split", "source_id").agg(
        F.count("*").alias("texts"), F.sum(F.col("n_tokens") + 1).cast("long").alias("tokens"))


def rollup_stats(encoded: DataFrame) -> DataFrame:
    """Same, with totals per split and overall (null marks a total)."""
    return encoded.rollup("split", "source_id").agg(
        F.count("*").alias("texts"), F.sum(F.col("n_tokens") + 1).cast("long").alias("tokens"))


def complete_stats(config: DataFrame, stats: DataFrame) -> DataFrame:
    """Every configured source in every split; sources without rows count zero."""
    wanted = config.withColumn("split", F.explode(F.array(*[F.lit(s) for s in SPLITS])))
    return (wanted.join(stats, ["split", "source_id"], "left")
            .withColumn("texts", F.coalesce("texts", F.lit(0).cast("long")))
            .withColumn("tokens", F.coalesce("tokens", F.lit(0).cast("long"))))


def split_totals(complete: DataFrame) -> DataFrame:
    return complete.groupBy("split").agg(
        F.sum("texts").alias("texts"), F.sum("tokens").alias("tokens"))


def _files(folder: bool, shard_size: int, written: bool = True):
    if not written:
        return F.array().cast("array<string>")
    count = shard_count(F.col("total_tokens"), shard_size)
    name = lambda i: shard_names(F.col("split"), i)
    path = (lambda i: F.concat_ws("/", "split", name(i))) if folder else name
    return F.transform(F.sequence(F.lit(0).cast("long"), count - 1), path)


def _joined(*objects) -> Column:
    """JSON objects that are not empty, as one with all their members."""
    inner = [F.substring(o, F.lit(2), F.length(o) - 2) for o in objects]
    return F.concat(F.lit("{"), F.concat_ws(",", *inner), F.lit("}"))


def split_manifests(complete: DataFrame, tokenizer: str, vocab_size: int, val_ratio: float,
                    shard_size: int = SHARD_SIZE, dtype: str = "uint16", files: bool = True) -> DataFrame:
    """``(split, manifest)``: one JSON document per split.

    Sources come in config order with all members of their config entries. Without ``files`` no
    shard files are listed.
    """
    own = F.to_json(F.struct("source_id", F.col("texts").alias("encoded_texts"), F.col("tokens").alias("encoded_tokens")))
    per_split = complete.groupBy("split").agg(
        F.array_sort(F.collect_list(F.struct("src_pos", _joined(F.col("entry"), own).alias("json")))).alias("listed"),
        F.sum("tokens").alias("total_tokens"), F.sum("texts").alias("total_texts"))
    datasets = F.concat(F.lit('{"datasets":['), F.array_join(F.transform("listed", lambda s: s["json"]), ","), F.lit("]}"))
    rest = F.struct(
        F.lit(tokenizer).alias("tokenizer_type"),
        F.lit(vocab_size).alias("vocab_size"), F.lit(dtype).alias("dtype"),
        "total_tokens", "total_texts",
        shard_count(F.col("total_tokens"), shard_size).alias("num_shards"),
        F.lit(shard_size).alias("shard_size_tokens"),
        _files(False, shard_size, files).alias("files"), F.lit(val_ratio).alias("val_ratio"))
    return per_split.select("split", _joined(
        F.to_json(F.struct("split")), datasets, F.to_json(rest)).alias("manifest"))


def root_manifest(complete: DataFrame, tokenizer: str, vocab_size: int, val_ratio: float,
                  shard_size: int = SHARD_SIZE, dtype: str = "uint16", files: bool = True) -> DataFrame:
    """One JSON document over both splits."""
    per_split = complete.groupBy("split").agg(
        F.sum("tokens").alias("total_tokens"), F.sum("texts").alias("total_texts"))
    part = F.struct(
        "total_tokens", "total_texts",
        shard_count(F.col("total_tokens"), shard_size).alias("num_shards"),
        _files(True, shard_size, files).alias("files"))
    both = per_split.agg(
        F.sum("total_texts").alias("total_texts"),
        *[F.max(F.when(F.col("split") == s, part)).alias(s) for s in SPLITS])
    return both.select(F.to_json(F.struct(
        F.lit(tokenizer).alias("tokenizer_type"), F.lit(vocab_size).alias("vocab_size"),
        F.lit(dtype).alias("dtype"), F.lit(shard_size).alias("shard_size_tokens"),
        F.lit(val_ratio).alias("val_ratio"), "total_texts", *SPLITS)).alias("manifest"))


def simple_manifest(encoded: DataFrame, input_path: str, tokenizer: str, vocab_size: int,
                    train_fraction: float, dtype: str = "uint16") -> DataFrame:
    """Flat counts of the single-file job, as one JSON document."""
    span = (F.col("n_tokens") + 1).cast("long")
    tokens = {s: F.coalesce(F.sum(F.when(F.col("split") == s, span)), F.lit(0).cast("long"))
              for s in SPLITS}
    texts = {s: F.count_if(F.col("split") == s) for s in SPLITS}
    return encoded.agg(F.to_json(F.struct(
        F.lit(input_path).alias("input"), F.lit(tokenizer).alias("tokenizer_type"),
        F.lit(vocab_size).alias("vocab_size"), F.lit(dtype).alias("dtype"),
        tokens["train"].alias("train_tokens"), tokens["val"].alias("val_tokens"),
        (tokens["train"] + tokens["val"]).alias("total_tokens"),
        texts["train"].alias("train_texts"), texts["val"].alias("val_texts"),
        F.lit(train_fraction).alias("train_split"))).alias("manifest"))


def stream_manifests(encoded: DataFrame, part_tokens: int, dtype: str = "uint16") -> DataFrame:
    """``(split, manifest)`` of the single-table job: what a reader of the shards needs."""
    found = encoded.groupBy("split").agg(F.count("*").alias("texts"), F.sum(F.col("n_tokens") + 1).alias("tokens"))
    both = encoded.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string").join(found, "split", "left")
    totals = both.select("split", F.coalesce(F.col("texts"), F.lit(0)).cast("long").alias("total_texts"),
                         F.coalesce(F.col("tokens"), F.lit(0)).cast("long").alias("total_tokens"))
    return totals.select("split", F.to_json(F.struct(
        "split", F.lit(dtype).alias("dtype"), "total_tokens", "total_texts",
        shard_count(F.col("total_tokens"), part_tokens).alias("num_shards"),
        F.lit(part_tokens).alias("shard_size_tokens"), _files(False, part_tokens).alias("files"))).alias("manifest"))
