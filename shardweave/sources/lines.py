"""Lines of text files in byte ranges, each line with its place.

Spark's own text reader does not tell where a line stands in its file. This Python data source
reads a file in ranges, many tasks to a file, and numbers the lines of each range; a count of lines per
range then gives every line its number in the source, without moving any text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from shardweave.sources.storage import in_groups, register_once, storage_of

RANGE_BYTES = 64 << 20
# Short ranges share tasks beyond this many; no task is to read much more than a range of the usual size.
LEAST_TASKS = 16
CHUNK_BYTES = 4 << 20
# Compressed files, by ending. They have no ranges and are read from their start.
CODECS = {".gz": "gzip", ".bz2": "bz2", ".zst": "zstd"}

SCHEMA = "file string, file_block long, file_row long, value string"
FILES = "file string, bytes long, blocks long"
COUNTS = "file string, file_block long, rows long"


@dataclass
class Range:
    file: str
    start: int
    end: int | None


@dataclass
class Ranges(InputPartition):
    """The ranges of one task."""

    ranges: list[Range]


def list_files(path: str) -> list[tuple[str, int]]:
    """(file, bytes) under a folder, or of one file, or of a pattern's files, by name.

    As in Spark, names that start with ``_`` or ``.`` are hidden.
    """
    import fnmatch

    from pyarrow import fs

    folder, _, last = path.rpartition("/")
    pattern = last if any(c in last for c in "*?[") else None
    storage, root = storage_of(folder.replace("\\", "") if pattern else path)
    info = storage.get_file_info(root)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [(root, info.size)]
    found = storage.get_file_info(fs.FileSelector(root, recursive=pattern is None))
    visible = [f for f in found if f.type == fs.FileType.File and not any(
        part.startswith(("_", ".")) for part in f.path[len(root):].strip("/").split("/"))]
    if pattern:
        visible = [f for f in visible if fnmatch.fnmatchcase(f.base_name, pattern.replace("\\", ""))]
    return sorted((f.path, f.size) for f in visible)


def _codec(file: str) -> str | None:
    return next((codec for ending, codec in CODECS.items() if file.endswith(ending)), None)


def ranges_of(file: str, size: int, range_bytes: int) -> list[Range]:
    if _codec(file):
        return [Range(file, 0, None)]
    return [Range(file, at, min(at + range_bytes, size)) for at in range(0, max(size, 1), range_bytes)]


def line_batches(stream, at: int, end: int | None) -> Iterator[list[bytes]]:
    """Lines that start in ``[at, end)``, chunk by chunk; a line may reach past ``end``.

    ``stream`` stands at ``at - 1``, or at 0. A line ends at a line feed; a carriage return before it
    is cut off.
    """
    left = b""
    if at:
        while True:  # the line that an earlier range began, if the byte before is not a line feed
            chunk = stream.read(CHUNK_BYTES)
            if not chunk:
                return
            cut = chunk.find(b"\n")
            if cut >= 0:
                at += len(left) + cut
                left = chunk[cut + 1:]
                break
            left = b""
            at += len(chunk)
    parts, ended = [left], False
    while not ended and (end is None or at < end):
        chunk = stream.read(CHUNK_BYTES) if b"\n" not in parts[-1] else b""
        if chunk:
            parts.append(chunk)
            if b"\n" not in chunk:
                continue
        elif b"\n" not in parts[-1]:
            ended = True
        data = b"".join(parts)
        if ended:
            lines, rest = ([data] if data else []), b""
        else:
            *lines, rest = data.split(b"\n")
        if end is not None and lines:
            starts = at + np.cumsum([0, *(len(line) + 1 for line in lines)])
            lines = lines[:int(np.searchsorted(starts[:-1], end))]
            at = int(starts[len(lines)]) if len(lines) < len(starts) - 1 else int(starts[-1])
        if lines:
            yield [line[:-1] if line.endswith(b"\r") else line for line in lines]
        parts = [rest]


class LinesReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))
        self.blank = options.get("keepBlank", "true") == "true"
        self.after, self.upto = options.get("after"), options.get("upto")

    def partitions(self) -> list[Ranges]:
        found = [(part, size if part.end is None else part.end - part.start) for file, size in list_files(self.path)
                 if (self.after is None or file > self.after) and (self.upto is None or file <= self.upto)
                 for part in ranges_of(file, size, self.range_bytes)]
        parts, sizes = [p for p, _ in found], [n for _, n in found]
        each = min(max(RANGE_BYTES, self.range_bytes), -(-sum(sizes) // LEAST_TASKS))
        return [Ranges(group) for group in in_groups(parts, sizes, each)] or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        for part in partition.ranges:
            for lines, row in self._lines(part):
                n = len(lines)
                places = [pa.array([part.file] * n), pa.array(np.full(n, part.start)), pa.array(np.arange(row, row + n))]
                yield pa.record_batch([*places, pa.array([line.decode("utf-8", "replace") for line in lines])],
                                      names=["file", "file_block", "file_row", "value"])

    def _lines(self, part: Range) -> Iterator[tuple[list[bytes], int]]:
        """Lines of a range, and the number of the first of them in it."""
        storage, path = storage_of(part.file)
        codec = _codec(path)
        with storage.open_input_file(path) if codec is None else storage.open_input_stream(
                path, compression=codec) as stream:
            if part.start:
                stream.seek(part.start - 1)
            row = 0
            for lines in line_batches(stream, part.start, part.end):
                if not self.blank:
                    lines = [line for line in lines if line.strip()]
                if lines:
                    yield lines, row
                    row += len(lines)


class CountsReader(LinesReader):
    """How many lines each range has; the lines stay where they are read."""

    def read(self, partition: Ranges) -> Iterator[tuple]:
        for part in partition.ranges:
            n = sum(len(lines) for lines, _ in self._lines(part))
            if n:
                yield part.file, part.start, n


class FilesReader(DataSourceReader):
    """The listing itself as rows."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for file, size in list_files(self.path):
            yield file, size, len(ranges_of(file, size, self.range_bytes))


class LinesSource(DataSource):
    """``ranged_lines``: rows ``(file, file_block, file_row, value)`` of UTF-8 text files.

    ``file_block`` is the first byte of a line's range, ``file_row`` its number in there. Options:
    ``rangeBytes``; ``keepBlank`` (false skips blank lines); ``after`` and ``upto``, bounds of file names;
    ``files`` (true lists ``(file, bytes, blocks)`` instead); ``counts`` (true gives ``(file, file_block, rows)``).
    """

    @classmethod
    def name(cls) -> str:
        return "ranged_lines"

    def schema(self) -> str:
        return FILES if self._asks("files") else COUNTS if self._asks("counts") else SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        kind = FilesReader if self._asks("files") else CountsReader if self._asks("counts") else LinesReader
        return kind(self.options)

    def _asks(self, option: str) -> bool:
        return self.options.get(option) == "true"


def lines_reader(spark: SparkSession, **options):
    register_once(spark, LinesSource)
    reader = spark.read.format("ranged_lines")
    for key, value in options.items():
        if value is not None:
            reader = reader.option(key, str(value).lower() if isinstance(value, bool) else str(value))
    return reader
