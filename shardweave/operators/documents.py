"""Merging, cutting and routing documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardweave.functions.split import split_name
from shardweave.functions.text import doc_key, usable_text
from shardweave.operators.order import running_total
from shardweave.sources.config import config_frame, entry_key

MERGE_ORDER = ["doc_idx", "src_pos"]


def index_documents(df: DataFrame, key: str) -> DataFrame:
    """``doc_idx``: place of a row in its source by ``key``, blanks included."""
    return running_total(df, [key], within=["source_id"], out="doc_idx")


def within_quota(df: DataFrame, entries: list[dict]) -> DataFrame:
    """Keep the first ``max_docs`` rows of each source; null keeps all.

    The config has a checked size, so it is broadcast; documents do not move. The quota of a
    single source is a literal, which Spark pushes down.
    """
    if len(entries) == 1:
        own = df.filter(F.col("source_id") == entry_key(entries[0]))
        quota = entries[0].get("max_docs")
        return own if quota is None else own.filter(F.col("doc_idx") < quota)
    quotas = config_frame(df.sparkSession, entries).select("source_id", "max_docs")
    return (df.join(F.broadcast(quotas), "source_id")
            .filter(F.col("max_docs").isNull() | (F.col("doc_idx") < F.col("max_docs")))
            .drop("max_docs"))


def merge_position(df: DataFrame, out: str = "rr_pos") -> DataFrame:
    """Place of each row in the round-robin merge.

    Round r takes row r of every source still alive, in config order: that is the
    order (doc_idx, src_pos), with no turn-taking left to simulate.
    """
    return running_total(df, MERGE_ORDER, out=out)


def extract(df: DataFrame) -> DataFrame:
    """Replace the candidate text columns by ``text``; drop rows without any.

    Call after ``doc_idx`` is known: blank rows keep their index and quota.
    """
    text = usable_text(df)
    rest = [c for c in df.columns if c not in ("text", "content", "document")]
    return df.select(*rest, text.alias("text")).filter(F.col("text").isNotNull())


def route(df: DataFrame, ratio: float, row_id: str | None = None,
          digest: str = "sha256") -> DataFrame:
    """Add ``doc_key`` and ``split`` by keyed hash.

    Rows that all have an id need no ``doc_idx`` column.
    """
    own = F.col(row_id) if row_id else F.lit(None)
    position = F.col("doc_idx") if "doc_idx" in df.columns else F.lit(None)
    return (df.withColumn("doc_key", doc_key(F.col("source_id"), own, position))
            .withColumn("split", split_name(F.col("doc_key"), ratio, digest)))


def route_prefix(df: DataFrame, fraction: float, position: str, total: int | None = None) -> DataFrame:
    """First ``int(n * fraction)`` rows by ``position`` are train, the rest val.

    ``total`` is n where the caller knows it, for example from the input before it was numbered.
    """
    total = df.count() if total is None else total
    return df.withColumn(
        "split", F.when(F.col(position) < int(total * fraction), "train").otherwise("val"))


def shuffled_position(df: DataFrame, key: str, seed: int = 42,
                      out: str = "position") -> DataFrame:
    """Repeatable shuffle: order by a seeded hash of the key."""
    hashed = df.withColumn(
        "_shuffle", F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256))
    return running_total(hashed, ["_shuffle", key], out=out).drop("_shuffle")


# Named position ranges [low, high); no high means to the end.
SUBSETS = {
    "test": (0, 10_000),
    "val": (10_000, 20_000),
    "train": (20_000, None),
    "train_100": (0, 100_000),
    "train_500": (0, 500_000),
}


def named_subsets(df: DataFrame, position: str,
                  subsets: dict[str, tuple[int, int | None]] | None = None) -> DataFrame:
    """One row per (subset, row). Ranges may overlap, so a row can appear twice."""
    at = F.col(position)
    hits = []
    for name, (low, high) in (subsets or SUBSETS).items():
        inside = at >= low if high is None else (at >= low) & (at < high)
        hits.append(F.when(inside, F.lit(name)))
    names = F.array_compact(F.array(*hits))
    return df.select(F.explode(names).alias("subset"), "*")
