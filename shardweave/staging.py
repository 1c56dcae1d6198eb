"""Written intermediate tables.

A staged table cuts lineage and survives executor loss: later steps read files
from shared storage, never blocks held by one executor.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def stage_root(spark: SparkSession) -> str:
    """The shared folder for intermediates, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; a cluster
    session without it is refused, since a machine-local folder would be wrong.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    if sc.applicationId not in _local_roots:
        _local_roots[sc.applicationId] = tempfile.mkdtemp(prefix="shardweave-")
    return _local_roots[sc.applicationId]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{stage_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` and read it back."""
    spark = df.sparkSession
    path = new_path(spark, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_at = path
    return staged


def drop_stage(df: DataFrame) -> None:
    """Delete a table made by ``stage`` that no later step reads."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.staged_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
