"""Flat binary token shards: import and export.

Files are little-endian fixed-width integers without a header, ``{split}/{split}_{idx:03d}.bin``.

Reading: a shard is read in ranges of tokens, many tasks to a shard. ``read_prepared`` reads a folder with
manifests and opens only the shards that filters on ``split`` and ``shard_idx`` leave;
``read_shards`` takes a table of files.

Writing has three steps. Tasks write each shard to a name of their own attempt and return it as a
row of a written table, so Spark's commit decides which attempt counts. A second job moves the counted
files to their final names, in tasks, and may repeat. The manifests, written last, make the export
visible; leftovers of lost attempts go with the folder of attempts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from shardweave.operators.pack import BLOCK_TOKENS
from shardweave.sources.storage import in_groups, register_once, storage_of
from shardweave.staging import stage

# Number formats of shard files by name.
DTYPES = {"uint16": "<u2", "int32": "<i4", "uint32": "<u4"}
SPLITS = ("train", "val")
#: Tokens that one task reads of a shard, and those of one Arrow batch; multiples of a block.
RANGE_TOKENS, BATCH_TOKENS = 16 << 20, 1 << 20
MAX_TASKS = 100_000  # further ranges share tasks
LEAST_TASKS = 64  # ranges of small shards share tasks beyond these
PIECES = "split string, shard_idx int, block long, start long, tokens array<int>"
_ATTEMPTS = "_attempts"


def dtype_code(name: str) -> str:
    if name not in DTYPES:
        raise ValueError(f"unsupported dtype: {name}")
    return DTYPES[name]


def shard_file(split: str, index: int) -> str:
    return f"{split}/{split}_{index:03d}.bin"


# ---- reading

def _token_count(path: str, size: int, dtype: str) -> int:
    width = np.dtype(DTYPES[dtype]).itemsize
    if size % width:
        raise ValueError(f"{path}: {size} bytes are no whole number of {dtype} tokens")
    return size // width


def _sizes(paths: list[str]) -> list[int]:
    """Bytes of the files; a missing one is an error."""
    from pyarrow import fs

    if not paths:
        return []
    found = [storage_of(p) for p in paths]
    info = found[0][0].get_file_info([p for _, p in found])
    for path, item in zip(paths, info):
        if item.type != fs.FileType.File:
            raise FileNotFoundError(f"shard {path} is missing")
    return [item.size for item in info]


def read_range(path: str, dtype: str, first: int, past: int, block_tokens: int
               ) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """Blocks, starts and tokens of the blocks that begin in ``[first, past)`` of a shard, batch by batch."""
    code = np.dtype(DTYPES[dtype])
    storage, name = storage_of(path)
    step = max(block_tokens, BATCH_TOKENS // block_tokens * block_tokens)
    with storage.open_input_file(name) as stream:
        stream.seek(first * code.itemsize)
        for at in range(first, past, step):
            n = min(step, past - at)
            raw = stream.read(n * code.itemsize)
            if len(raw) < n * code.itemsize:
                raise ValueError(f"shard {path} ends early")
            tokens = np.frombuffer(raw, code)
            if n and tokens.max() > 2**31 - 1:
                raise ValueError("token id does not fit 32-bit integers")
            starts = np.arange(at, at + n, block_tokens)
            bounds = np.append(starts - at, n).astype(np.int32)
            yield starts // block_tokens, starts, pa.ListArray.from_arrays(
                pa.array(bounds), pa.array(tokens.astype(np.int32)))


def _batch(split: str, shard_idx: int, blocks: np.ndarray, starts: np.ndarray, tokens: pa.Array) -> pa.RecordBatch:
    n = len(starts)
    return pa.record_batch([pa.array([split] * n, pa.string()), pa.array(np.full(n, shard_idx, np.int32)), pa.array(blocks),
                            pa.array(starts), tokens], names=["split", "shard_idx", "block", "start", "tokens"])


def _aligned(tokens: int, block_tokens: int) -> int:
    """The range size, as a multiple of the block size."""
    return max(1, tokens // block_tokens) * block_tokens


def read_shards(spark: SparkSession, files: DataFrame, dtype: str = "uint16",
                block_tokens: int = BLOCK_TOKENS, range_tokens: int = RANGE_TOKENS) -> DataFrame:
    """Pieces of shard files listed as ``(split, shard_idx, path)``; no files are an error."""
    dtype_code(dtype)
    if files.isEmpty():
        raise ValueError("no shard files given")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(2).to_pylist()
            counts = [_token_count(p, n, dtype) for p, n in zip(paths, _sizes(paths))]
            yield pa.record_batch([*batch.columns, pa.array(counts, pa.int64())],
                                  names=["split", "shard_idx", "path", "length"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                for part in read_range(r["path"], dtype, r["first"], r["past"], block_tokens):
                    yield _batch(r["split"], r["shard_idx"], *part)

    listed = files.select("split", F.col("shard_idx").cast("int").alias("shard_idx"), "path")
    sized = listed.mapInArrow(measure, "split string, shard_idx int, path string, length long")
    size = _aligned(range_tokens, block_tokens)
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long")))
    ranges = sized.filter("length > 0").withColumn("first", first).withColumn(
        "past", F.least(F.col("first") + size, F.col("length")))
    # Rows here are ranges of files, of a few bytes each: adaptive execution would take them all for one task.
    # Small shards share tasks.
    found = sized.agg(F.sum("length"), F.sum(F.ceil(F.col("length") / size))).first()
    tasks = task_count(found[0] or 0, int(found[1] or 0), size)
    return ranges.repartition(tasks).mapInArrow(read, PIECES)


def task_count(tokens: int, ranges: int, size: int) -> int:
    """Tasks that read ``ranges`` ranges: as many as the tokens fill, no fewer than ``LEAST_TASKS`` if there are ranges."""
    return max(1, min(ranges, MAX_TASKS, max(LEAST_TASKS, -(-tokens // size))))


@dataclass
class ShardRange:
    split: str
    shard_idx: int
    path: str
    dtype: str
    first: int
    past: int


@dataclass
class ShardRanges(InputPartition):
    """The ranges of one task."""

    ranges: list[ShardRange]


def _manifest(path: str) -> dict:
    storage, name = storage_of(path)
    with storage.open_input_stream(name) as stream:
        return json.loads(stream.read())


def catalog_of(path: str) -> list[tuple[str, int, str, int, str]]:
    """(split, shard_idx, path, length, dtype) of a prepared folder, checked against its manifests."""
    root = path.rstrip("/")
    dtype = _manifest(f"{root}/meta.json").get("dtype") or "uint16"
    dtype_code(dtype)
    out = []
    for split in SPLITS:
        meta = _manifest(f"{root}/{split}/meta.json")
        paths = [f"{root}/{split}/{name}" for name in meta["files"]]
        lengths = [_token_count(p, n, dtype) for p, n in zip(paths, _sizes(paths))]
        if sum(lengths) != meta["total_tokens"]:
            raise ValueError(f"{split} shards hold {sum(lengths)} tokens, the manifest says {meta['total_tokens']}")
        out += [(split, i, p, n, dtype) for i, (p, n) in enumerate(zip(paths, lengths))]
    return out


class PreparedReader(DataSourceReader):
    """Ranges of the shards that the filters leave."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.block_tokens = int(options.get("blockTokens", BLOCK_TOKENS))
        self.range_tokens = _aligned(int(options.get("rangeTokens", RANGE_TOKENS)), self.block_tokens)
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for one in filters:
            if isinstance(one, (EqualTo, In)) and one.attribute in (("split",), ("shard_idx",)):
                values = {one.value} if isinstance(one, EqualTo) else set(one.value)
                name = one.attribute[0]
                self.wanted[name] = self.wanted.get(name, values) & values
            else:
                yield one

    def partitions(self) -> list[ShardRanges]:
        ranges = []
        for split, index, path, length, dtype in catalog_of(self.path):
            row = {"split": split, "shard_idx": index}
            if all(row[name] in values for name, values in self.wanted.items()):
                ranges += [ShardRange(split, index, path, dtype, at, min(at + self.range_tokens, length))
                           for at in range(0, length, self.range_tokens)]
        tokens = sum(r.past - r.first for r in ranges)
        each = -(-tokens // task_count(tokens, len(ranges), self.range_tokens))
        return [ShardRanges(group) for group in in_groups(ranges, [r.past - r.first for r in ranges], each)] or [
            ShardRanges([])]

    def read(self, partition: ShardRanges) -> Iterator[pa.RecordBatch]:
        for r in partition.ranges:
            for part in read_range(r.path, r.dtype, r.first, r.past, self.block_tokens):
                yield _batch(r.split, r.shard_idx, *part)


class CatalogReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from catalog_of(self.path)


class PreparedSource(DataSource):
    """``prepared_shards``: pieces of a prepared folder, or with ``catalog`` its list of shards."""

    @classmethod
    def name(cls) -> str:
        return "prepared_shards"

    def schema(self) -> str:
        if self.options.get("catalog") == "true":
            return "split string, shard_idx int, path string, length long, dtype string"
        return PIECES

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return CatalogReader(self.options) if self.options.get("catalog") == "true" else PreparedReader(self.options)


def _prepared(spark: SparkSession, **options: str):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    register_once(spark, PreparedSource)
    return spark.read.format("prepared_shards").options(**options)


def read_prepared(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS,
                  range_tokens: int = RANGE_TOKENS) -> DataFrame:
    """Pieces ``(split, shard_idx, block, start, tokens)`` of a prepared folder.

    Filters on ``split`` and ``shard_idx`` by value choose the shards that are opened. A missing shard,
    or shards with other token counts than the manifests, are errors.
    """
    return _prepared(spark, blockTokens=str(block_tokens), rangeTokens=str(range_tokens)).load(path)


def prepared_catalog(spark: SparkSession, path: str) -> DataFrame:
    """``(split, shard_idx, path, length, dtype)`` of a prepared folder."""
    return _prepared(spark, catalog="true").load(path)


# ---- writing

def write_attempts(pieces: DataFrame, path: str, dtype: str) -> DataFrame:
    """Write each shard under a name of the task's attempt; ``(split, shard_idx, attempt, length)``.

    ``pieces`` come sorted by split, shard and start. A piece that does not begin where the one before
    ended is an error, so no shard is written with a gap.
    """
    code = np.dtype(dtype_code(dtype))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        storage, root = storage_of(path)
        storage.create_dir(f"{root}/{_ATTEMPTS}", recursive=True)
        done, current, out, length, name = [], None, None, 0, ""
        for batch in batches:
            if not batch.num_rows:
                continue
            splits, shards = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            starts, tokens = batch.column(2).to_numpy(), batch.column(3)
            bounds = np.asarray(tokens.offsets)
            bounds = bounds - bounds[0]
            flat = tokens.flatten().to_numpy()
            if len(flat) and (flat.max() > np.iinfo(code).max or flat.min() < 0):
                raise ValueError(f"token id does not fit {dtype}")
            raw = flat.astype(code)
            for i, key in enumerate(zip(splits, shards.tolist())):
                if key != current:
                    if out is not None:
                        out.close()
                        done.append((*current, name, length))
                    current, length = key, 0
                    name = f"{_ATTEMPTS}/{uuid.uuid4().hex}"
                    out = storage.open_output_stream(f"{root}/{name}")
                if starts[i] != length:
                    raise ValueError(f"shard {key}: a piece starts at {starts[i]}, the one before ended at {length}")
                out.write(raw[bounds[i]:bounds[i + 1]].tobytes())
                length += int(bounds[i + 1] - bounds[i])
        if out is not None:
            out.close()
            done.append((*current, name, length))
        if done:
            split, shard, names, lengths = zip(*done)
            yield pa.record_batch([pa.array(split), pa.array(shard, pa.int32()), pa.array(names), pa.array(lengths, pa.int64())],
                                  names=["split", "shard_idx", "attempt", "length"])

    rows = pieces.select("split", F.col("shard_idx").cast("int").alias("shard_idx"),
                         F.col("start").cast("long").alias("start"), "tokens")
    # All pieces of a shard in one task: its size is fixed by packing.
    ordered = rows.repartition("split", "shard_idx").sortWithinPartitions("split", "shard_idx", "start")
    return stage(ordered.mapInArrow(write, "split string, shard_idx int, attempt string, length long"), "attempts")


def publish(attempts: DataFrame, path: str) -> int:
    """Move the counted attempts to their final names, in tasks; the number of shards. May be repeated."""
    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        storage, root = storage_of(path)
        for batch in batches:
            for r in batch.to_pylist():
                target = f"{root}/{shard_file(r['split'], r['shard_idx'])}"
                storage.create_dir(target.rsplit("/", 1)[0], recursive=True)
                if storage.get_file_info(f"{root}/{r['attempt']}").type == fs.FileType.File:
                    storage.move(f"{root}/{r['attempt']}", target)
                elif storage.get_file_info(target).type != fs.FileType.File:
                    raise FileNotFoundError(target)
            yield pa.record_batch([pa.array([batch.num_rows], pa.int64())], names=["n"])

    moved = attempts.mapInArrow(move, "n long").agg(F.sum("n")).first()[0] or 0
    storage, root = storage_of(path)
    written = {r.split for r in attempts.select("split").distinct().collect()}
    for split in set(SPLITS) - written:  # a split without tokens has one empty file
        storage.create_dir(f"{root}/{split}", recursive=True)
        storage.open_output_stream(f"{root}/{shard_file(split, 0)}").close()
    from pyarrow import fs

    if storage.get_file_info(f"{root}/{_ATTEMPTS}").type == fs.FileType.Directory:
        storage.delete_dir(f"{root}/{_ATTEMPTS}")
    return moved


def write_shards_as_bins(pieces: DataFrame, path: str, dtype: str = "uint16") -> None:
    """Write ``path/{split}/{split}_{idx:03d}.bin``; a split without tokens gets one empty file."""
    publish(write_attempts(pieces, path, dtype), path)
