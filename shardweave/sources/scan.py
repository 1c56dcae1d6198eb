"""Reading source tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardweave.sources.config import check_entries, entry_key
from shardweave.sources.layout import source_path
from shardweave.sources.lines import LinesSource
from shardweave.sources.ordered import numbered_source
from shardweave.sources.storage import register_once

# Columns that may hold the text.
TEXT_COLUMNS = ("text", "content", "document")
#: Sources whose files are counted at the same time.
PLANNERS = 8


def _tagged(df: DataFrame, entry: dict, src_pos: int) -> DataFrame:
    if "id" in df.columns:  # ids may be of any type, and differ between sources
        df = df.withColumn("id", F.col("id").cast("string"))
    return df.select("*", F.lit(entry_key(entry)).alias("source_id"), F.lit(src_pos).alias("src_pos"))


def scan_source(spark: SparkSession, entry: dict, src_pos: int) -> DataFrame:
    """One configured source, tagged. ``format`` and ``options`` are optional."""
    reader = spark.read.format(entry.get("format", "parquet"))
    if "schema" in entry:
        reader = reader.schema(entry["schema"])
    return _tagged(reader.options(**entry.get("options", {})).load(source_path(spark, entry)), entry, src_pos)


def scan_sources(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """All configured sources as one bag; columns a source lacks are null."""
    return concat(_alike([scan_source(spark, e, i) for i, e in enumerate(check_entries(entries))]))


def numbered_sources(spark: SparkSession, entries: list[dict], out: str = "doc_idx") -> DataFrame:
    """All configured sources, each up to its quota, with every row's number in its source.

    Counting a source's files takes a few small jobs; those of several sources run side by side.
    """
    check_entries(entries)
    register_once(spark, LinesSource)  # before the threads start
    with ThreadPoolExecutor(PLANNERS) as pool:
        parts = list(pool.map(lambda e: numbered_source(spark, e, out), entries))
    return concat(_alike([_tagged(part, e, i) for i, (part, e) in enumerate(zip(parts, entries))]))


def _alike(parts: list[DataFrame]) -> list[DataFrame]:
    """Sources with columns that can be united without changing any text.

    A candidate text column that is not a string holds no text; other columns whose type
    differs between sources are left out.
    """
    kinds: dict[str, set[str]] = {}
    for part in parts:
        for name, kind in part.dtypes:
            kinds.setdefault(name, set()).add(kind)
    mixed = {n for n, k in kinds.items() if len(k) > 1 and n not in TEXT_COLUMNS}
    none = F.lit(None).cast("string")
    return [part.select(*[
        none.alias(n) if n in TEXT_COLUMNS and kind != "string" else F.col(f"`{n}`")
        for n, kind in part.dtypes if n not in mixed]) for part in parts]


def concat(parts: list[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def spread(scan: DataFrame) -> DataFrame:
    """Give a small scan at least one partition per core before costly per-row work.

    A Parquet row group is read by one task, so a small table can leave most cores
    idle. Scans with enough splits are returned as they are: no shuffle at scale.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    # Planning a bare scan runs no job.
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """Only the text column of a saved table."""
    return spark.read.parquet(path).select("text")


def read_file(spark: SparkSession, path: str) -> DataFrame:
    """Whole UTF-8 files, one row each."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("text"))
