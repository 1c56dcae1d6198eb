"""The list of configured sources: reading, checking, naming.

A config is a short hand-written list, checked on the driver. Its size is capped
by an error, not by cutting it, so its DataFrame is always safe to broadcast.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shardweave.functions.text import WHITESPACE, source_key

MAX_SOURCES = 10_000

CONFIG_SCHEMA = "id string, path string, name string, split string, max_docs long"


def check_entries(entries: object) -> list[dict]:
    """Reject malformed configs; messages name the offending entry."""
    if not isinstance(entries, list):
        raise ValueError("sources config must be a JSON array")
    if len(entries) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources configured")
    for i, entry in enumerate(entries):
        if not isinstance(entry, dict):
            raise ValueError(f"sources[{i}] must be an object")
        for field in ("path", "split"):
            if field not in entry:
                raise ValueError(f"sources[{i}] must have '{field}'")
        quota = entry.get("max_docs")
        if quota is not None and (type(quota) is not int or quota <= 0):
            raise ValueError(f"sources[{i}].max_docs must be a positive integer or null")
    ids = [entry_key(e) for e in entries]
    for i, key in enumerate(ids):
        if key in ids[:i]:
            raise ValueError(f"sources[{i}] repeats the source id {key!r}")
    return entries


def entry_key(entry: dict) -> str:
    """Same rule as ``source_key``, for one config entry on the driver."""
    custom = entry.get("id")
    if isinstance(custom, str) and custom.strip(WHITESPACE):
        return custom.strip(WHITESPACE)
    return ":".join(filter(None, [entry["path"], entry.get("name"), entry["split"]]))


def load_config(spark: SparkSession, path: str) -> list[dict]:
    """Read a config file from any storage Spark can reach."""
    text = spark.read.text(path, wholetext=True).first()
    return check_entries(json.loads(text.value if text else "null"))


def config_frame(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """Config as a table, in config order, with ``src_pos``, ``source_id`` and the whole ``entry`` as JSON."""
    rows = [
        (e.get("id"), e["path"], e.get("name"), e["split"], e.get("max_docs"), i,
         json.dumps(e, ensure_ascii=False, separators=(",", ":")))
        for i, e in enumerate(check_entries(entries))
    ]
    return with_source_id(spark.createDataFrame(rows, CONFIG_SCHEMA + ", src_pos int, entry string"))


def with_source_id(config: DataFrame) -> DataFrame:
    return config.withColumn("source_id", source_key(
        F.col("id"), F.col("path"), F.col("name"), F.col("split")))


def config_from_column(df: DataFrame, column: str) -> list[dict]:
    """One config entry per distinct value of ``column``, by name."""
    rows = (df.select(F.col(column).alias("path")).distinct()
            .limit(MAX_SOURCES + 1).collect())
    return check_entries([{"path": p, "split": "train", "id": p}
                          for p in sorted(r.path for r in rows)])


def violations(config: DataFrame) -> DataFrame:
    """Table form of the check: one row per broken entry, with the first reason."""
    reason = (
        F.when(F.col("path").isNull(), "path missing")
        .when(F.col("split").isNull(), "split missing")
        .when(F.col("max_docs") <= 0, "max_docs not positive")
    )
    return config.select("src_pos", reason.alias("reason")).filter("reason IS NOT NULL")


def expected_total() -> Column:
    """Aggregate: sum of all quotas, null as soon as one source is unlimited."""
    return F.when(
        F.count("*") == F.count("max_docs"),
        F.coalesce(F.sum("max_docs"), F.lit(0).cast("long")),
    )


def positions(config: DataFrame, order: str) -> DataFrame:
    """Number config rows by a column. Safe in one task: configs are small."""
    at = Window.partitionBy(F.lit(0)).orderBy(order)
    return config.withColumn("src_pos", (F.row_number().over(at) - 1).cast("int"))
