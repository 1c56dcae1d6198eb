"""Shards, manifests, windows, batches, scores, sinks and streams."""

import json
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardweave.operators import pack, scores, stats, windows
from shardweave.operators.tokenizers import tokenizer
from shardweave.plans.prepare import prepare_corpus, prepare_single
from shardweave.sources import artifacts, binshards
from shardweave.sources.config import config_frame
from shardweave.streaming import arriving

EOS = 99


@pytest.fixture(scope="module")
def encoded(spark):
    rows = [("val" if i % 9 == 4 else "train", f"s{i % 3}", i % 3, i // 3,
             [(i * 31 + j) % 97 for j in range((i * 37) % 53)]) for i in range(120)]
    df = spark.createDataFrame(
        rows, "split string, source_id string, src_pos int, doc_idx int, ids array<int>")
    return df.withColumn("n_tokens", F.size("ids")).repartition(5)


def streams(encoded):
    rows = sorted(encoded.collect(), key=lambda r: (r.doc_idx, r.src_pos))
    out = {"train": [], "val": []}
    for r in rows:
        out[r.split] += [*r.ids, EOS]
    return out


def assembled(pieces):
    out = {}
    for r in sorted(pieces.collect(), key=lambda r: (r.split, r.shard_idx, r.start)):
        have = out.setdefault((r.split, r.shard_idx), [])
        assert r.start == len(have) and r.block == r.start // 16
        assert (r.start + len(r.tokens) - 1) // 16 == r.block
        have += r.tokens
    return out


@pytest.mark.parametrize("size", [1, 50, 64, 100_000, None])
def test_shards_equal_a_sequential_writer(encoded, size):
    pieces = pack.cut_into_shards(pack.token_offsets(encoded), EOS, size, 16)
    want = {}
    for split, stream in streams(encoded).items():
        step = size or len(stream)
        for i in range(0, len(stream), step):
            want[split, i // step] = stream[i:i + step]
    assert assembled(pieces) == want


def test_shard_list_keeps_empty_splits(spark):
    totals = spark.createDataFrame([("train", 100), ("val", 0), ("x", 101)],
                                   "split string, tokens long")
    found = Counter(r.split for r in pack.shard_list(totals, 50).collect())
    assert found == {"train": 2, "val": 1, "x": 3}


def test_manifests(spark, encoded):
    entries = [{"path": f"s{i}", "split": "train", "id": f"s{i}", "max_docs": 50}
               for i in range(4)]
    config = config_frame(spark, entries).withColumnRenamed("split", "split_name")
    full = stats.complete_stats(config, stats.source_stats(encoded))
    docs = {r.split: json.loads(r.manifest) for r in
            stats.split_manifests(full, "char", 97, 0.1, 500).collect()}
    for split, stream in streams(encoded).items():
        meta = docs[split]
        assert meta["total_tokens"] == len(stream)
        assert meta["num_shards"] == len(meta["files"]) == max(1, math.ceil(len(stream) / 500))
        assert [d["source_id"] for d in meta["datasets"]] == ["s0", "s1", "s2", "s3"]
        assert meta["datasets"][3]["encoded_texts"] == 0
    root = json.loads(stats.root_manifest(full, "char", 97, 0.1, 500).first().manifest)
    assert root["train"]["files"][1] == "train/train_001.bin"
    assert root["total_texts"] == 120


def test_binary_round_trip(spark, encoded, tmp_path):
    pieces = pack.cut_into_shards(pack.token_offsets(encoded.filter("split = 'train'")), EOS, 300, 16)
    out = str(tmp_path / "bins")
    binshards.write_shards_as_bins(pieces, out)
    stream = streams(encoded)["train"]
    names = sorted(p.name for p in (tmp_path / "bins" / "train").iterdir())
    assert names == [f"train_{i:03d}.bin" for i in range(math.ceil(len(stream) / 300))]
    raw = np.concatenate([np.fromfile(tmp_path / "bins" / "train" / n, "<u2") for n in names])
    assert raw.tolist() == stream
    assert (tmp_path / "bins" / "val" / "val_000.bin").stat().st_size == 0
    files = spark.createDataFrame(
        [("train", i, f"{out}/train/{n}") for i, n in enumerate(names)],
        "split string, shard_idx int, path string")
    back = binshards.read_shards(spark, files, "uint16", 16)
    have = {}
    for r in sorted(back.collect(), key=lambda r: (r.shard_idx, r.start)):
        have.setdefault(r.shard_idx, []).extend(r.tokens)
    assert [t for i in sorted(have) for t in have[i]] == stream


def test_export_refuses_wide_ids(spark, tmp_path):
    pieces = spark.createDataFrame([("train", 0, 0, [70_000])],
                                   "split string, shard_idx int, start long, tokens array<int>")
    with pytest.raises(Exception, match="does not fit"):
        binshards.write_shards_as_bins(pieces, str(tmp_path / "x"))
    with pytest.raises(ValueError, match="unsupported dtype"):
        binshards.dtype_code("float32")


def test_sliding_windows(spark):
    df = spark.createDataFrame([(0, list(range(10))), (1, [1, 2, 3]), (2, [])], "i int, ids array<int>")
    rows = windows.sliding_windows(df, 3).orderBy("start").collect()
    assert [(r.i, r.x, r.y) for r in rows] == [
        (0, list(range(s, s + 3)), list(range(s + 1, s + 4))) for s in range(7)]


def test_batches(spark, encoded):
    pieces = pack.cut_into_shards(pack.token_offsets(encoded), EOS, 200, 16).cache()
    found = windows.shard_windows(pack.shard_lengths(pieces), 8).filter("split = 'train'")
    plan = windows.batch_plan(found, batches=50, batch=16, seed=3, per_shard=4).cache()
    shards = assembled(pieces)
    rows = windows.batch_windows(plan, pieces, 8, 16).collect()
    assert len(rows) == 50 * 16
    per_batch = {}
    for r in rows:
        tokens = shards["train", r.shard_idx]
        assert r.x == tokens[r.start:r.start + 8] and r.y == tokens[r.start + 1:r.start + 9]
        per_batch.setdefault(r.batch_idx, []).append(r)
    for index, batch in per_batch.items():
        assert len({r.start for r in batch}) == 16  # without replacement
        assert len({r.shard_idx for r in batch}) == 1
        first = per_batch[index - index % 4][0]
        assert batch[0].shard_idx == first.shard_idx  # four batches per visit


def test_small_shards_draw_with_replacement(spark):
    lengths = spark.createDataFrame([("train", 0, 11)], "split string, shard_idx int, length long")
    found = windows.shard_windows(lengths, 8)
    starts = [r.start for r in windows.batch_plan(found, 2, 16, 1).collect()]
    assert len(starts) == 32 and set(starts) == {0, 1, 2}


def test_starts_and_shards_are_drawn_evenly(spark):
    lengths = spark.createDataFrame([("t", 0, 12), ("t", 1, 28), ("t", 2, 5)],
                                    "split string, shard_idx int, length long")
    plan = windows.batch_plan(windows.shard_windows(lengths, 8), 3000, 2, 7, per_shard=1)
    rows = plan.collect()
    visits = Counter(r.shard_idx for r in rows)
    assert 2 not in visits and abs(visits[0] / len(rows) - 4 / 24) < 0.03
    starts = Counter(r.start for r in rows if r.shard_idx == 0)
    assert all(abs(n / visits[0] - 0.25) < 0.05 for n in starts.values())


def test_window_guards(spark):
    lengths = spark.createDataFrame([("t", 0, 5)], "split string, shard_idx int, length long")
    with pytest.raises(ValueError, match="long enough"):
        windows.usable_shards(windows.shard_windows(lengths, 8))
    for bad in (0, -1):
        with pytest.raises(ValueError, match="positive"):
            windows.shard_windows(lengths, bad)
        with pytest.raises(ValueError, match="positive"):
            windows.batch_plan(windows.shard_windows(lengths, 2), 1, bad, 1)
        with pytest.raises(ValueError, match="positive"):
            windows.batch_plan(windows.shard_windows(lengths, 2), 1, 1, 1, bad)


def test_document_windows(spark, encoded):
    docs = encoded.withColumn("key", F.concat("source_id", F.lit(":"), "doc_idx")).cache()
    ids = {r.key: r.ids for r in docs.collect()}
    rows = windows.document_window(docs, "key", 8, seed=1).collect()
    assert {r.key for r in rows} == {k for k, v in ids.items() if len(v) >= 9}
    batch = windows.uniform_batch(docs, "key", 8, batch=40, seed=1).collect()
    assert sorted(r.slot for r in batch) == list(range(40))
    for r in rows + batch:
        assert r.x == ids[r.key][r.start:r.start + 8] and r.y[:-1] == r.x[1:]


def test_scores(spark):
    rows = [(0, [1.0, 3.0, 3.0, 2.0], 1), (1, [0.5], 0), (2, [-1000.0, 1000.0], 0)]
    df = spark.createDataFrame(rows, "id int, scores array<double>, target int")
    loss = {r.id: r.l for r in df.select(
        "id", scores.cross_entropy(F.col("scores"), F.col("target")).alias("l")).collect()}
    assert loss[0] == pytest.approx(math.log(sum(map(math.exp, rows[0][1]))) - 3.0)
    assert loss[1] == 0.0 and loss[2] == 2000.0
    top = {r.id: r.choices for r in scores.top_k_probabilities(df, "id", "scores", 1.0, 1).collect()}
    assert [(c.token, c.prob) for c in top[0]] == [(1, 0.5), (2, 0.5)]  # ties stay
    wide = scores.top_k_probabilities(df, "id", "scores", 0.0, 99).collect()
    assert len(wide[0].choices) == 4
    free = scores.top_k_probabilities(df, "id", "scores")
    assert sum(c.prob for c in free.first().choices) == pytest.approx(1.0)
    assert {r.token for r in scores.sample_choice(free, "id", 5).filter("id = 1").collect()} == {0}
    big = spark.createDataFrame([(800.0,)], "l double").select(scores.perplexity(F.col("l")))
    assert big.first()[0] == math.inf


def test_subsets_overlap(spark, tmp_path):
    from shardweave.operators.documents import SUBSETS, named_subsets

    df = named_subsets(spark.range(30_000).withColumnRenamed("id", "position"), "position")
    artifacts.save_subsets(df, str(tmp_path / "s"))
    sizes = {n: spark.read.parquet(f"{tmp_path}/s/subset={n}").count() for n in SUBSETS}
    assert sizes == {"test": 10_000, "val": 10_000, "train": 10_000,
                     "train_100": 30_000, "train_500": 30_000}


def test_prepare_corpus(spark, tmp_path, texts):
    spark.createDataFrame([(str(i), t) for i, t in enumerate(texts[:60])], "id string, text string"
                          ).coalesce(1).write.parquet(f"{tmp_path}/a")
    spark.createDataFrame([(t if i % 4 else "  ",) for i, t in enumerate(texts[60:100])],
                          "content string").coalesce(1).write.parquet(f"{tmp_path}/b")
    entries = [{"path": f"{tmp_path}/a", "split": "train", "id": "a", "max_docs": 50},
               {"path": f"{tmp_path}/b", "split": "train", "id": "b"}]
    out = str(tmp_path / "out")
    done = prepare_corpus(spark, entries, out, tokenizer("bpe", vocab_size=300), 0.2, 5000,
                          export_bins=True)
    counts = {r.source_id: r.n for r in done.encoded.groupBy("source_id")
              .agg(F.count("*").alias("n")).collect()}
    assert counts == {"a": 50, "b": 30}
    files, dtype = artifacts.prepared_files(spark, out)
    assert dtype == "uint16"
    back = binshards.read_shards(spark, files, dtype)
    want = {(r.split, r.shard_idx): r.length for r in pack.shard_lengths(done.shards).collect()}
    assert {(r.split, r.shard_idx): r.length for r in pack.shard_lengths(back).collect()} == want
    assert all(n == 5000 for (s, i), n in want.items() if (s, i + 1) in want)
    # A second run reuses the saved vocabulary and gives the same shards.
    artifacts.save_vocabulary(artifacts.load_vocabulary(spark, f"{out}/tokenizer"), spark,
                              f"{out}2/tokenizer")
    again = prepare_corpus(spark, entries, f"{out}2", tokenizer("bpe"), 0.2, 5000,
                           reuse_vocabulary=True)
    assert again.shards.exceptAll(done.shards).isEmpty()
    # Decoding a stream gives back the documents in merge order.
    tok = tokenizer("bpe").load(spark, f"{out}/tokenizer")
    first = done.encoded.filter("source_id = 'a' AND doc_idx = 0").select(
        tok.decode(F.col("ids")).alias("t")).first().t
    assert first.strip() == texts[0].strip()


def test_prepare_single(spark, tmp_path, texts):
    spark.createDataFrame([(t,) for t in texts[:40]], "text string").coalesce(1).write.parquet(
        f"{tmp_path}/a")
    done = prepare_single(spark, f"{tmp_path}/a", str(tmp_path / "out"),
                          tokenizer=tokenizer("bpe", vocab_size=300))
    meta = json.loads((tmp_path / "out" / "meta.json").read_text())
    assert (meta["train_texts"], meta["val_texts"]) == (36, 4)
    lengths = {r.split: r.length for r in pack.shard_lengths(done.shards).collect()}
    assert lengths == {"train": meta["train_tokens"], "val": meta["val_tokens"]}


def test_streams(spark, tmp_path):
    rows = [(f"s{i % 2}", i, f"text {i}" if i % 5 else " ") for i in range(100)]
    source = tmp_path / "in"
    for part in range(4):
        spark.createDataFrame(rows[part * 25:part * 25 + 25], "source_id string, id int, text string"
                              ).coalesce(1).write.mode("append").parquet(str(source))
    batch = spark.read.parquet(str(source))
    stream = (spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1)
              .parquet(str(source)))
    routed = arriving.route_stream(stream, 0.3, "id")
    found = arriving.drain_to_table(routed, "route").select("id", "text", "doc_key", "split")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, arriving.route_stream(
        batch, 0.3, "id").select("id", "text", "doc_key", "split").collect()))

    last = {}
    counted = arriving.running_counts(routed.withColumn("n_tokens", F.length("text")))
    arriving.drain_batches(
        counted, lambda df, i: last.update({i: df.collect()}), "counts", "complete")
    assert sum(r.texts for r in last[max(last)]) == 80
    assert [sum(r.texts for r in last[i]) for i in sorted(last)] == [20, 40, 60, 80]

    quotas = spark.createDataFrame([("s0", 30), ("s1", None)], "source_id string, max_docs long")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    write = arriving.quota_writer(quotas, "id", out, state)
    arriving.drain_batches(stream, write, "quota")
    kept = spark.read.parquet(out)
    assert {r.source_id: r.n for r in kept.groupBy("source_id").agg(F.count("*").alias("n"))
            .collect()} == {"s0": 30, "s1": 50}
    indexes = sorted(r.doc_idx for r in kept.filter("source_id = 's1'").collect())
    assert indexes == list(range(50))
    write(batch.limit(0), 4)  # an empty batch keeps the counts
    assert {r.source_id: r.n for r in spark.read.parquet(f"{state}/batch=4").collect()} == {
        "s0": 50, "s1": 50}
