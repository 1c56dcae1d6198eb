"""Reading shards in ranges, and an export that counts each shard once."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardweave.operators import pack
from shardweave.operators.tokenizers import tokenizer
from shardweave.plans.prepare import prepare_corpus, prepare_single
from shardweave.sources import binshards


def prepared(root, lengths, dtype="uint16", total=None):
    """A prepared folder with shards of the given lengths, their tokens counting up."""
    tokens = {}
    for split in ("train", "val"):
        (root / split).mkdir(parents=True)
        files, at = [], 0
        for i, n in enumerate(lengths[split]):
            tokens[split, i] = (np.arange(at, at + n) % 60_000).tolist()
            at += n
            files.append(f"{split}_{i:03d}.bin")
            np.array(tokens[split, i], binshards.DTYPES[dtype]).tofile(root / split / files[-1])
        (root / split / "meta.json").write_text(json.dumps({"files": files, "total_tokens": total or at}))
    (root / "meta.json").write_text(json.dumps({} if dtype == "uint16" else {"dtype": dtype}))
    return tokens


def joined(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r.split, r.shard_idx, r.start)):
        assert r.start == len(found.setdefault((r.split, r.shard_idx), [])) and r.block == r.start // 64
        found[r.split, r.shard_idx] += r.tokens
    return found


@pytest.mark.parametrize("dtype", ["uint16", "int32", "uint32"])
def test_prepared_folder_round_trip(spark, tmp_path, dtype):
    tokens = prepared(tmp_path / "p", {"train": [1000, 1000, 37], "val": [64]}, dtype)
    got = binshards.read_prepared(spark, str(tmp_path / "p"), 64, 200)
    assert joined(got.collect()) == tokens
    listed = binshards.prepared_catalog(spark, str(tmp_path / "p")).collect()
    assert {(r.split, r.shard_idx): (r.length, r.dtype) for r in listed} == {
        k: (len(v), dtype) for k, v in tokens.items()}


def test_a_large_shard_is_read_by_many_tasks(spark, tmp_path):
    tokens = prepared(tmp_path / "p", {"train": [3 << 20], "val": []})
    got = binshards.read_prepared(spark, str(tmp_path / "p"), 1024, 256 << 10)
    assert got.rdd.getNumPartitions() == 12
    assert got.groupBy("split").agg(F.sum(F.size("tokens")).alias("n")).first().n == 3 << 20
    files = spark.createDataFrame([("train", 0, f"{tmp_path}/p/train/train_000.bin")], "split string, shard_idx int, path string")
    tasks = binshards.read_shards(spark, files, "uint16", 1024, 256 << 10).select(F.spark_partition_id().alias("p"))
    assert tasks.distinct().count() > 3
    assert len(tokens["train", 0]) == 3 << 20


def test_filters_choose_the_shards_that_are_opened(spark, tmp_path):
    tokens = prepared(tmp_path / "p", {"train": [500] * 6, "val": [500]})
    path = str(tmp_path / "p")
    read = lambda where: binshards.read_prepared(spark, path, 64).filter(where)
    for where, wanted in (("split = 'val'", [("val", 0)]), ("split = 'train' AND shard_idx IN (1, 4)", [("train", 1), ("train", 4)]),
                          ("shard_idx = 0", [("train", 0), ("val", 0)]), ("split = 'train' AND shard_idx = 9", [])):
        df = read(where)
        assert joined(df.collect()) == {k: tokens[k] for k in wanted}
        assert df.rdd.getNumPartitions() == max(1, len(wanted))
    assert len(joined(read("shard_idx > 3").collect())) == 2  # other filters stay with Spark


def test_broken_folders_are_refused(spark, tmp_path):
    prepared(tmp_path / "a", {"train": [10], "val": [10]})
    (tmp_path / "a" / "val" / "val_000.bin").unlink()
    prepared(tmp_path / "b", {"train": [10], "val": [10]}, total=11)
    prepared(tmp_path / "c", {"train": [10], "val": [10]})
    (tmp_path / "c" / "train" / "train_000.bin").write_bytes(b"123")
    for name, message in (("a", "missing"), ("b", "manifest says 11"), ("c", "no whole number")):
        with pytest.raises(Exception, match=message):
            binshards.read_prepared(spark, str(tmp_path / name)).count()
    with pytest.raises(ValueError, match="no shard files"):
        binshards.read_shards(spark, spark.createDataFrame([], "split string, shard_idx int, path string"))


def pieces_of(spark, lengths):
    rows = [(split, i, at, list(range(at, min(at + 10, n)))) for (split, i), n in lengths.items() for at in range(0, n, 10)]
    return spark.createDataFrame(rows, "split string, shard_idx int, start long, tokens array<int>").repartition(5)


def names(folder):
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file())


def test_only_counted_attempts_become_shards(spark, tmp_path):
    """A first attempt that was lost after writing, and a publish that was cut short and repeated."""
    lengths = {("train", 0): 35, ("train", 1): 5, ("val", 0): 20}
    pieces, path = pieces_of(spark, lengths), str(tmp_path / "out")
    binshards.write_attempts(pieces, path, "uint16")  # its table is never used: a lost attempt
    attempts = binshards.write_attempts(pieces, path, "uint16")
    assert len(names(tmp_path / "out")) == 6
    first = attempts.filter("split = 'val'").first()
    (tmp_path / "out" / "val").mkdir()
    (tmp_path / "out" / first.attempt).rename(tmp_path / "out" / "val" / "val_000.bin")
    for _ in range(2):
        assert binshards.publish(attempts, path) == 3
        assert names(tmp_path / "out") == ["train/train_000.bin", "train/train_001.bin", "val/val_000.bin"]
    for (split, i), n in lengths.items():
        assert np.fromfile(tmp_path / "out" / split / f"{split}_{i:03d}.bin", "<u2").tolist() == list(range(n))
    binshards.write_shards_as_bins(pieces, path)  # the whole export again
    assert len(names(tmp_path / "out")) == 3


def test_a_gap_or_a_repeated_piece_is_an_error(spark, tmp_path):
    pieces = pieces_of(spark, {("train", 0): 50})
    for broken in (pieces.filter("start <> 20"), pieces.union(pieces.filter("start = 20"))):
        with pytest.raises(Exception, match="a piece starts at"):
            binshards.write_shards_as_bins(broken, str(tmp_path / "x"))


def test_single_job_writes_shards_that_the_reader_reads(spark, tmp_path, texts):
    spark.createDataFrame([(t,) for t in texts[:40]], "text string").coalesce(1).write.parquet(f"{tmp_path}/a")
    out = str(tmp_path / "out")
    done = prepare_single(spark, f"{tmp_path}/a", out, tokenizer=tokenizer("bpe", vocab_size=300), part_tokens=4000)
    back = binshards.read_prepared(spark, out)
    want = {(r.split, r.shard_idx): r.length for r in pack.shard_lengths(done.shards).collect()}
    assert {(r.split, r.shard_idx): r.length for r in pack.shard_lengths(back).collect()} == want
    meta = json.loads((tmp_path / "out" / "meta.json").read_text())
    assert sum(n for (s, _), n in want.items() if s == "train") == meta["train_tokens"] > 4000


def test_manifests_keep_the_whole_config_and_list_what_is_there(spark, tmp_path, texts):
    spark.createDataFrame([(t,) for t in texts[:20]], "text string").write.parquet(f"{tmp_path}/a")
    entry = {"note": {"by": "hand é"}, "path": f"{tmp_path}/a", "split": "train", "id": "a", "weight": 0.5, "max_docs": None}
    for bins in (True, False):
        out = tmp_path / f"out{bins}"
        prepare_corpus(spark, [entry], str(out), tokenizer("char"), 0.0, 5000, export_bins=bins)
        for split in ("train", "val"):
            meta = json.loads((out / split / "meta.json").read_text())
            (listed,) = meta["datasets"]
            assert {k: listed[k] for k in entry} == entry and listed["source_id"] == "a"
            assert [(out / split / f).exists() for f in meta["files"]] == [True] * (meta["num_shards"] if bins else 0)
        assert len(names(out / "val")) == 1 + bins


def test_small_shards_share_tasks(spark, tmp_path):
    pieces = spark.range(300).selectExpr(
        "'train' AS split", "cast(id AS int) AS shard_idx", "0L AS block", "0L AS start", "array(cast(id AS int), 7) AS tokens")
    out = str(tmp_path)
    binshards.write_shards_as_bins(pieces, out)
    for split, total in (("train", 600), ("val", 0)):
        (tmp_path / split / "meta.json").write_text(json.dumps(
            {"files": [f"{split}_{i:03d}.bin" for i in range(300 if total else 1)], "total_tokens": total}))
    (tmp_path / "meta.json").write_text(json.dumps({"dtype": "uint16"}))
    assert len(binshards.PreparedReader({"path": out}).partitions()) <= binshards.LEAST_TASKS
    wanted = sorted((i, [i, 7]) for i in range(300))
    read = binshards.read_prepared(spark, out)
    assert sorted((r.shard_idx, r.tokens) for r in read.collect()) == wanted
    assert [r.tokens for r in read.filter("shard_idx = 123").collect()] == [[123, 7]]
    files = spark.range(300).selectExpr("'train' AS split", "cast(id AS int) AS shard_idx",
                                        f"format_string('{out}/train/train_%03d.bin', id) AS path")
    read = binshards.read_shards(spark, files)
    assert sorted((r.shard_idx, r.tokens) for r in read.collect()) == wanted
    assert read.rdd.getNumPartitions() <= binshards.LEAST_TASKS
