"""Documents of a source in file order, numbered, and no further than its quota.

A source is taken in runs of files. A run's rows are counted per piece (a whole Parquet file, whose
counts come from footers, or a byte range of a text file), running sums of the counts give each
piece its first number, and a broadcast of this bounded table numbers the documents without moving
them. With a quota the runs start with one file and grow; files past the quota are never opened.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardweave.operators.order import running_total
from shardweave.sources.layout import source_path
from shardweave.sources.lines import lines_reader

#: Files and pieces of a run: bounds of what is listed, summed and broadcast at a time.
RUN_FILES, RUN_PIECES = 10_000, 50_000
GROWTH = 16
PIECE = ["file", "file_block"]


@dataclass
class Scan:
    """Rows of one source with their places: ``file``, ``file_block``, ``file_row``."""

    spark: SparkSession
    entry: dict
    path: str

    def files(self) -> DataFrame:
        """``(file, pieces)``."""
        raise NotImplementedError

    def rows(self, after: str | None, upto: str | None) -> DataFrame:
        """Rows of the files in ``(after, upto]``; other files are not opened."""
        raise NotImplementedError

    def counts(self, after: str | None, upto: str | None) -> DataFrame:
        return self.rows(after, upto).groupBy(*PIECE).agg(F.count(F.lit(1)).alias("rows"))

    def _between(self, df: DataFrame, after: str | None, upto: str | None) -> DataFrame:
        """Filters on the file name alone are applied to the file listing by Spark."""
        name = F.col("_metadata.file_path")
        df = df if after is None else df.filter(name > after)
        return df if upto is None else df.filter(name <= upto)


class ParquetScan(Scan):
    @cached_property
    def _read(self) -> DataFrame:
        return self.spark.read.format("parquet").options(**self.entry.get("options", {})).load(self.path)

    def files(self) -> DataFrame:
        listed = self.spark.read.format("binaryFile").load(self.path)  # the content is not read
        return listed.select(F.col("_metadata.file_path").alias("file"), F.lit(1).cast("long").alias("pieces"))

    def rows(self, after: str | None, upto: str | None) -> DataFrame:
        return self._between(self._read, after, upto).select(
            "*", F.col("_metadata.file_path").alias("file"), F.lit(0).cast("long").alias("file_block"),
            F.col("_metadata.row_index").alias("file_row"))

    def counts(self, after: str | None, upto: str | None) -> DataFrame:
        """A scan of no columns: row counts come from the footers."""
        return self._between(self._read, after, upto).groupBy(
            F.col("_metadata.file_path").alias("file"), F.lit(0).cast("long").alias("file_block")).agg(
                F.count(F.lit(1)).alias("rows"))


class LinesScan(Scan):
    """JSON lines or text; a line is a row. Blank JSON lines are none."""

    json = True

    @cached_property
    def _wanted(self) -> dict:
        return {k: v for k, v in self.entry.get("options", {}).items() if k != "rangeBytes"}

    @cached_property
    def _schema(self):
        return self.entry.get("schema") or self.spark.read.options(**self._wanted).json(self.path).schema

    def _lines(self, **options):
        wanted = self.entry.get("options", {})
        return lines_reader(self.spark, rangeBytes=wanted.get("rangeBytes"), keepBlank=not self.json,
                            **options).load(self.path)

    def files(self) -> DataFrame:
        return self._lines(files=True).select("file", F.col("blocks").alias("pieces"))

    def rows(self, after: str | None, upto: str | None) -> DataFrame:
        lines = self._lines(after=after, upto=upto)
        if not self.json:
            return lines.withColumnRenamed("value", "text")
        return lines.withColumn("row", F.from_json("value", self._schema, self._wanted)).select("row.*", *PIECE, "file_row")

    def counts(self, after: str | None, upto: str | None) -> DataFrame:
        return self._lines(after=after, upto=upto, counts=True)


class TextScan(LinesScan):
    json = False


class WholeTextScan(Scan):
    """Each file is one row."""

    def files(self) -> DataFrame:
        return ParquetScan.files(self)

    def rows(self, after: str | None, upto: str | None) -> DataFrame:
        files = self.spark.read.text(self.path, wholetext=True)
        return self._between(files, after, upto).select(
            F.col("value").alias("text"), F.col("_metadata.file_path").alias("file"),
            F.lit(0).cast("long").alias("file_block"), F.lit(0).cast("long").alias("file_row"))


SCANS = {"parquet": ParquetScan, "json": LinesScan, "text": TextScan}


def scan_of(spark: SparkSession, entry: dict) -> Scan | None:
    """How to read the entry in file order; None if its format has none."""
    kind = entry.get("format", "parquet")
    options = {k.lower(): str(v).lower() for k, v in entry.get("options", {}).items()}
    if kind == "json" and options.get("multiline") == "true":
        return None
    cls = WholeTextScan if kind == "text" and options.get("wholetext") == "true" else SCANS.get(kind)
    return cls(spark, entry, source_path(spark, entry)) if cls else None


def _next_run(scan: Scan, after: str | None, size: int) -> str | None:
    """Last file of a run of up to ``size`` files after ``after``; None at the end."""
    files = scan.files()
    files = files if after is None else files.filter(F.col("file") > after)
    last, pieces = None, 0
    for row in files.orderBy("file").limit(size).collect():  # at most RUN_FILES rows
        pieces += row.pieces
        if last is not None and pieces > RUN_PIECES:
            break
        last = row.file
    return last


def _run(scan: Scan, after: str | None, upto: str, before: int, quota: int | None, out: str) -> tuple[DataFrame, int]:
    """Numbered documents of one run of files, and how many rows these and earlier files hold."""
    # A bounded table (the run's pieces), made once, so that the sums do not change between uses.
    counted = scan.counts(after, upto).collect()
    starts, total = [], before
    for piece in sorted(counted, key=lambda r: (r.file, r.file_block)):
        starts.append((piece.file, piece.file_block, total))
        total += piece.rows
    if quota is not None:
        starts = [s for s in starts if s[2] < quota]
    if not starts:
        return scan.rows(after, upto).limit(0).withColumn(out, F.lit(0).cast("long")), total
    rows = scan.rows(after, starts[-1][0])
    if quota is not None and total > quota:
        file, block, first = starts[-1]
        earlier = (F.col("file") < file) | (F.col("file_block") < block)
        rows = rows.filter(earlier | (F.col("file_block") == block) & (F.col("file_row") < quota - first))
    table = scan.spark.createDataFrame(starts, "file string, file_block long, _before long")
    return rows.join(F.broadcast(table), PIECE).withColumn(out, F.col("_before") + F.col("file_row")).drop("_before"), total


def in_file_order(scan: Scan, quota: int | None = None, out: str = "doc_idx") -> DataFrame:
    """The source's rows, the first ``quota`` of them if given, with their 0-based number ``out``."""
    parts, after, total = [], None, 0
    size = RUN_FILES if quota is None else 1
    while quota is None or total < quota or not parts:
        upto = _next_run(scan, after, size)
        if upto is None:
            break
        part, total = _run(scan, after, upto, total, quota, out)
        parts.append(part)
        after, size = upto, min(size * GROWTH, RUN_FILES)
    if not parts:  # no files
        parts = [scan.rows(None, None).limit(0).withColumn(out, F.lit(0).cast("long"))]
    return reduce(DataFrame.unionByName, parts)


def numbered_source(spark: SparkSession, entry: dict, out: str = "doc_idx") -> DataFrame:
    """The entry's documents up to its quota, each with its number in the source.

    Parquet, JSON lines and text count in file order. Other formats have none that Spark tells;
    their entry names a unique key column as ``order``.
    """
    quota = entry.get("max_docs")
    scan = scan_of(spark, entry)
    order = entry.get("order")
    if order is None:
        if scan is None:
            raise ValueError(f"format {entry.get('format')!r} has no file order; name a unique key column as 'order'")
        return in_file_order(scan, quota, out).drop(*PIECE, "file_row")
    rows = spark.read.format(entry.get("format", "parquet")).options(
        **entry.get("options", {})).load(source_path(spark, entry))
    numbered = running_total(rows, [order], out=out)
    return numbered if quota is None else numbered.filter(F.col(out) < quota)
