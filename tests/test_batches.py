"""Batches read only the folders of drawn shards, and lengths follow from totals."""

import re

import pytest
from pyspark.sql import functions as F

from shardweave.operators import pack, windows

EOS = 90


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("shards") / "t")
    rows = spark.range(600).select(
        F.when(F.col("id") % 5 == 0, "val").otherwise("train").alias("split"), F.col("id").alias("doc_idx"), F.lit(0).alias("src_pos"),
        F.transform(F.sequence(F.lit(0), (F.col("id") % 37).cast("int")), lambda i: i + F.col("id").cast("int") % 50).alias("ids"))
    encoded = rows.withColumn("n_tokens", F.size("ids")).cache()
    pack.write_shards(pack.cut_into_shards(pack.token_offsets(encoded), EOS, 200, 16), path, 4)
    return path, encoded


def scans(df):
    """(nodes between the token scan and the first join, folders it read) after a run."""
    df.collect()
    text, read = df._jdf.queryExecution().executedPlan().toString(), []

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in node.nodeName():
            return walk(node.plan())
        if node.nodeName().startswith("Scan") and "tokens#" in node.simpleString(1000):
            read.append(node.metrics().apply("numPartitions").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return text, read


def test_lengths_from_totals_equal_the_stored_ones(spark, stored):
    path, encoded = stored
    totals = encoded.groupBy("split").agg(F.sum(F.col("n_tokens") + 1).alias("tokens"))
    planned = {(r.split, r.shard_idx): r.length for r in pack.planned_lengths(totals, 200).collect()}
    found = {(r.split, r.shard_idx): r.length for r in pack.shard_lengths(spark.read.parquet(path)).collect()}
    assert planned == found
    edges = spark.createDataFrame([("a", 0), ("b", 400), ("c", 401)], "split string, tokens long")
    assert {(r.split, r.shard_idx): r.length for r in pack.planned_lengths(edges, 200).collect()} == {
        ("a", 0): 0, ("b", 0): 200, ("b", 1): 200, ("c", 0): 200, ("c", 1): 200, ("c", 2): 1}


@pytest.mark.parametrize("plan_rows", [1_000_000, 30])
def test_stored_tokens_stay_where_they_are(spark, stored, tmp_path, plan_rows):
    path, _ = stored
    pieces = spark.read.parquet(path)
    lengths = windows.shard_windows(pack.shard_lengths(pieces), 40).filter("split = 'train'")
    windows.batch_plan(lengths, 6, 3, 5, per_shard=3).write.parquet(f"{tmp_path}/plan")
    plan = spark.read.parquet(f"{tmp_path}/plan")
    drawn = {r.shard_idx // 4 for r in plan.select("shard_idx").distinct().collect()}
    got = windows.batch_windows(plan, pieces, 40, 16, 4, plan_rows)
    text, read = scans(got)
    assert len(drawn) < pieces.select("split", pack.FOLDER).distinct().count() / 2
    assert max(read) <= len(drawn)
    for scan in re.findall(r"Exchange hashpartitioning\([^)]*\)", text):
        assert "batch_idx" in scan  # only the drawn parts are gathered
    assert "SortMergeJoin" not in text
    whole = {}
    for r in pieces.orderBy("split", "shard_idx", "start").collect():
        whole.setdefault((r.split, r.shard_idx), []).extend(r.tokens)
    rows = got.collect()
    assert len(rows) == 18
    for r in rows:
        tokens = whole["train", r.shard_idx]
        assert r.x == tokens[r.start:r.start + 40] and r.y == tokens[r.start + 1:r.start + 41]


def test_uniform_batches_are_uniform(spark):
    """Chi-square of 20,000 draws over 200 documents."""
    docs = spark.range(250).select("id", F.when(F.col("id") < 200, F.sequence(F.lit(0), F.lit(9))).otherwise(
        F.array(F.lit(1))).alias("ids")).withColumn("n_tokens", F.size("ids"))
    rows = windows.uniform_batch(docs, "id", 8, batch=20_000, seed=2).collect()
    assert sorted(r.slot for r in rows) == list(range(20_000)) and max(r.id for r in rows) == 199
    counts = [0] * 200
    for r in rows:
        counts[r.id] += 1
    assert sum((n - 100) ** 2 / 100 for n in counts) < 199 + 4 * (2 * 199) ** 0.5
    assert {r.start for r in rows} == {0, 1}
    again = windows.uniform_batch(docs.repartition(7), "id", 8, batch=20_000, seed=2).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))
    with pytest.raises(ValueError, match="at most"):
        windows.uniform_batch(docs, "id", 8, windows.MAX_BATCH + 1, 1)
    with pytest.raises(ValueError, match="long enough"):
        windows.uniform_batch(docs, "id", 80, 4, 1)
