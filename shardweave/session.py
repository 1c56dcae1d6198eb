"""Session settings every job here expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows here are whole documents: small Arrow batches keep Python memory flat.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.sql.parquet.compression.codec": "zstd",
}

#: Those of the settings that a running session may still change.
RUNTIME = tuple(key for key in SETTINGS if key.startswith("spark.sql."))


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that the jobs rely on to a session made elsewhere."""
    for key in RUNTIME:
        spark.conf.set(key, SETTINGS[key])
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  memory: str = "8g", app: str = "shardweave") -> SparkSession:
    """A local session for tests and benchmarks. Clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
