"""Saved vocabularies, manifests and subsets."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardweave.operators import char_vocab
from shardweave.operators.bpe_train import Vocabulary
from shardweave.sources.storage import storage_of

# Vocabularies live on the driver; a larger table is an error, never cut.
MAX_TOKENS = 4_000_000


def save_vocabulary(vocab: Vocabulary, spark: SparkSession, path: str) -> None:
    """Tables ``vocab`` and ``merges`` under ``path``; both are small."""
    tables = (("vocab", vocab.vocab_frame(spark)), ("merges", vocab.merges_frame(spark)))
    for name, df in tables:
        df.coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")
    spark.createDataFrame([(vocab.prefix_space,)], "prefix_space boolean").coalesce(
        1).write.mode("overwrite").parquet(f"{path}/settings")


def _by_id(ids: dict[str, int]) -> list[str]:
    """Tokens at the places of their ids; places that no token has are empty."""
    tokens = [""] * (max(ids.values(), default=-1) + 1)
    for token, at in ids.items():
        tokens[at] = token
    return tokens


def load_vocabulary(spark: SparkSession, path: str) -> Vocabulary:
    saved = spark.read.parquet(f"{path}/vocab")
    size = saved.count()
    if size > MAX_TOKENS:
        raise ValueError(f"vocabulary of {size} tokens; at most {MAX_TOKENS} are supported")
    rows = saved.collect()
    merges = spark.read.parquet(f"{path}/merges").orderBy("rank").collect()
    settings = spark.read.parquet(f"{path}/settings").first()
    return Vocabulary(_by_id({r.token: r.id for r in rows}), [(r.left, r.right) for r in merges],
                      [r.token for r in sorted(rows, key=lambda r: r.id) if r.kind == "special"], settings.prefix_space)


def import_pretrained(spark: SparkSession, vocab_json: str, merges_txt: str,
                      specials: tuple[str, ...] = ("<|endoftext|>",)) -> Vocabulary:
    """A published byte-level vocabulary from its two files; no leading space is added."""
    tokens = json.loads(spark.read.text(vocab_json, wholetext=True).first().value)
    lines = spark.read.text(merges_txt, wholetext=True).first().value.splitlines()
    merges = [tuple(line.split(" ")) for line in lines
              if line and not line.startswith("#version")]
    return Vocabulary(_by_id(tokens), merges,
                      [s for s in specials if s in tokens], prefix_space=False)


def save_characters(chars: DataFrame, path: str) -> None:
    chars.coalesce(1).write.mode("overwrite").parquet(f"{path}/char_vocab")


def load_characters(spark: SparkSession, path: str) -> list[str]:
    return char_vocab.characters(spark.read.parquet(f"{path}/char_vocab"))


def write_json(text: str, path: str) -> None:
    """One small JSON document, on any storage Arrow knows."""
    storage, target = storage_of(path)
    storage.create_dir(target.rsplit("/", 1)[0], recursive=True)
    with storage.open_output_stream(target) as out:
        out.write(json.dumps(json.loads(text), ensure_ascii=False, indent=2).encode())


def save_manifests(root: DataFrame, splits: DataFrame, path: str) -> None:
    """Manifests of the splits, then that of the whole folder: once it is there, all is."""
    for row in splits.collect():
        write_json(row.manifest, f"{path}/{row.split}/meta.json")
    write_json(root.first().manifest, f"{path}/meta.json")


def prepared_files(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """Shard files ``(split, shard_idx, path)`` of a prepared folder, and their dtype."""
    root = spark.read.json(f"{path}/meta.json", multiLine=True)
    dtype = (root.first().dtype if "dtype" in root.columns else None) or "uint16"
    parts = []
    for split in ("train", "val"):
        meta = spark.read.json(f"{path}/{split}/meta.json", multiLine=True)
        parts.append(meta.select(
            F.lit(split).alias("split"), F.posexplode("files").alias("shard_idx", "file")))
    files = parts[0].unionByName(parts[1])
    return files.select("split", "shard_idx",
                        F.concat_ws("/", F.lit(path), "split", "file").alias("path")), dtype


def save_subsets(subsets: DataFrame, path: str) -> None:
    """One folder per named subset; a row in several subsets is stored in each."""
    subsets.write.partitionBy("subset").mode("errorifexists").parquet(path)
