"""Keys of any type, sources of mixed types, and vocabularies of any size."""

import json

import pytest
from pyspark.sql import functions as F

from shardweave.operators.bpe_encode import id_dtype
from shardweave.operators.bpe_train import Vocabulary
from shardweave.operators.order import running_total
from shardweave.operators.tokenizers import PretrainedTokenizer, tokenizer
from shardweave.sources import artifacts, scan


@pytest.mark.parametrize("key", ["timestamp_micros(id * 1001)", "date_add(DATE'2020-01-01', cast(id as int))",
                                 "cast(id as decimal(20, 3)) / 8", "if(id = 0, null, id)", "cast(id as double)"])
def test_running_total_orders_keys_of_any_type(spark, key):
    got = running_total(spark.range(2000).select("id", F.expr(key).alias("k")), ["k"]).collect()
    assert len(got) == 2000 and all(r.position == r.id for r in got)


def test_running_total_keeps_null_groups(spark):
    df = spark.range(1000).select("id", F.expr("if(id % 2 = 0, null, 'a')").alias("g"))
    got = running_total(df, ["id"], within=["g"]).collect()
    assert len(got) == 1000 and all(r.position == r.id // 2 for r in got)


def test_sources_of_mixed_types_lose_no_text(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("b", 2)], "text string, extra int").write.parquet(str(tmp_path / "x"))
    spark.sql("SELECT 7L AS text, 'c' AS content, struct(1) AS extra").write.parquet(str(tmp_path / "y"))
    got = scan.scan_sources(spark, [{"path": str(tmp_path / p), "split": "train"} for p in "xy"])
    assert {(r.text, r.content) for r in got.collect()} == {("a", None), ("b", None), (None, "c")}
    assert "extra" not in got.columns


def test_large_vocabularies_are_loaded_whole(spark, tmp_path):
    vocab = Vocabulary([f"t{i}" for i in range(70_000)], [], ["t5"])
    artifacts.save_vocabulary(vocab, spark, str(tmp_path / "v"))
    assert artifacts.load_vocabulary(spark, str(tmp_path / "v")) == vocab
    assert (id_dtype(65_535), id_dtype(70_000)) == ("uint16", "uint32")


def test_pretrained_ids_and_specials_are_kept(spark, tmp_path):
    (tmp_path / "vocab.json").write_text(json.dumps({"a": 0, "b": 5, "ab": 9, "<|endoftext|>": 12}))
    (tmp_path / "merges.txt").write_text("#version: 0.2\na b\n")
    tok = PretrainedTokenizer(spark, str(tmp_path))
    df = spark.createDataFrame([("abb",)], "text string").select(tok.encode(F.col("text")).alias("ids"))
    assert df.first().ids == [9, 5]
    ids = F.array(F.lit(9), F.lit(12))
    assert df.select(tok.decode(ids).alias("t")).first().t == "ab<|endoftext|>"
    tok.save(spark, str(tmp_path / "saved"))
    assert artifacts.load_vocabulary(spark, str(tmp_path / "saved")).tokens == tok.vocab.tokens
    assert tokenizer("HFAutoTokenizer").kind == "pretrained"
