"""Config, extraction, merging, splitting and ordering."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from shardweave.functions.split import check_ratio, split_name
from shardweave.functions.text import WHITESPACE, usable_text
from shardweave.operators import documents
from shardweave.operators.joined_text import joined_parts
from shardweave.operators.order import running_total
from shardweave.sources import config, scan


def test_whitespace_is_what_strip_removes():
    assert set(WHITESPACE) == {chr(i) for i in range(0x110000) if not chr(i).strip()}


@pytest.mark.parametrize("entries, message", [
    ({}, "array"),
    (["x"], r"\[0\] must be an object"),
    ([{"split": "a"}], "'path'"),
    ([{"path": "p", "split": "a"}, {"path": "p"}], r"\[1\].*'split'"),
    ([{"path": "p", "split": "a", "max_docs": 0}], "positive"),
    ([{"path": "p", "split": "a", "max_docs": True}], "positive"),
    ([{"path": "p", "split": "a", "max_docs": 1.5}], "positive"),
    ([{"path": "p", "split": "a"}, {"path": "p", "split": "a"}], "repeats"),
])
def test_config_errors(entries, message):
    with pytest.raises(ValueError, match=message):
        config.check_entries(entries)


def test_config_file_and_ids(spark, tmp_path):
    entries = [{"path": "p", "split": "s", "id": "  a "}, {"path": "p", "split": "s", "name": ""},
               {"path": "p", "split": "s", "name": "n", "max_docs": 3, "id": " "}]
    (tmp_path / "c.json").write_text(json.dumps(entries))
    loaded = config.load_config(spark, str(tmp_path / "c.json"))
    rows = config.config_frame(spark, loaded).orderBy("src_pos").collect()
    assert [r.source_id for r in rows] == ["a", "p:s", "p:n:s"]
    assert [config.entry_key(e) for e in loaded] == ["a", "p:s", "p:n:s"]
    assert config.config_frame(spark, loaded).agg(config.expected_total()).first()[0] is None


def test_extract_prefers_first_usable_string(spark):
    rows = [("  \x1c", " c ", "d"), (None, None, " \n"), ("a", "b", "c"), (None, "", "d")]
    df = spark.createDataFrame(rows, "text string, content string, document string")
    found = [r[0] for r in df.select(usable_text(df)).collect()]
    assert found == ["c", None, "a", "d"]
    typed = spark.createDataFrame([(5, "b")], "text int, content string")
    assert typed.select(usable_text(typed)).first()[0] == "b"


@pytest.mark.parametrize("ratio", [0.0, 0.01, 0.3, 0.99])
@pytest.mark.parametrize("digest", ["sha256", "blake2b"])
def test_hash_split(spark, ratio, digest):
    keys = [f"s:{i}" for i in range(500)] + ["é:日本"]

    def fraction(key):
        raw = (hashlib.blake2b(key.encode(), digest_size=8).digest() if digest == "blake2b"
               else hashlib.sha256(key.encode()).digest()[:8])
        return int.from_bytes(raw, "big") / 2**64

    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(3)
    found = {r.k: r.s for r in df.select("k", split_name(F.col("k"), ratio, digest).alias("s"))
             .collect()}
    assert found == {k: "val" if fraction(k) < ratio else "train" for k in keys}


def test_split_ratio_is_checked():
    for ratio in (-0.1, 1.0):
        with pytest.raises(ValueError):
            check_ratio(ratio)


def turn_by_turn(sizes, quotas):
    """The merge as a literal loop over sources."""
    order, seen, alive = [], [0] * len(sizes), list(range(len(sizes)))
    while alive:
        still = []
        for s in alive:
            if (quotas[s] is None or seen[s] < quotas[s]) and seen[s] < sizes[s]:
                order.append((s, seen[s]))
                seen[s] += 1
                still.append(s)
        alive = still
    return order


def test_round_robin_equals_turn_taking(spark):
    sizes, quotas = [7, 1, 0, 30, 12], [None, 5, 3, 9, 12]
    rows = [(f"s{s}", s, i) for s, n in enumerate(sizes) for i in range(n)]
    entries = [{"path": f"s{s}", "split": "x", "id": f"s{s}", "max_docs": q} for s, q in enumerate(quotas)]
    df = spark.createDataFrame(rows, "source_id string, src_pos int, k int").repartition(5)
    kept = documents.within_quota(documents.index_documents(df, "k"), entries)
    merged = documents.merge_position(kept).orderBy("rr_pos").collect()
    assert [(r.src_pos, r.doc_idx) for r in merged] == turn_by_turn(sizes, quotas)
    assert [r.rr_pos for r in merged] == list(range(len(merged)))


@pytest.mark.parametrize("buckets", [1, 3, 40])
def test_running_total_with_a_hot_group(spark, buckets):
    rows = [("hot" if i % 3 else f"g{i % 7}", (i * 7919) % 10007, i % 5) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, k int, v int").repartition(4)
    found = {(r.g, r.k): r.t for r in
             running_total(df, ["k"], "v", ["g"], "t", buckets).collect()}
    want, sums = {}, {}
    for g, k, v in sorted(rows):
        want[g, k] = sums.get(g, 0)
        sums[g] = want[g, k] + v
    assert found == want


def test_results_do_not_depend_on_shuffle_partitions(spark):
    df = spark.range(2000).withColumn("g", F.col("id") % 3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        found = []
        for n in ("2", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(sorted(map(tuple, documents.shuffled_position(df, "id").collect())))
        assert found[0] == found[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_file_order_index(spark, tmp_path):
    spark.range(0, 90, 1, 4).withColumnRenamed("id", "n").write.parquet(f"{tmp_path}/a")
    spark.range(0, 7, 1, 2).withColumnRenamed("id", "n").write.parquet(f"{tmp_path}/b")
    entries = [{"path": f"{tmp_path}/{x}", "split": "train", "id": x} for x in "ab"]
    rows = scan.numbered_sources(spark, entries).collect()
    for x, size in (("a", 90), ("b", 7)):
        mine = sorted((r.doc_idx, r.n) for r in rows if r.source_id == x)
        assert [i for i, _ in mine] == list(range(size))
        assert [n for _, n in mine] == list(range(size))


def test_whole_file_and_text_column(spark, tmp_path):
    (tmp_path / "t.txt").write_text("é\nb\r\n")
    assert scan.read_file(spark, str(tmp_path / "t.txt")).first().text == "é\nb\r\n"
    spark.createDataFrame([("a", 1)], "text string, n int").write.parquet(f"{tmp_path}/p")
    assert scan.read_texts(spark, f"{tmp_path}/p").columns == ["text"]


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_joined_text(spark, size):
    rows = [("a", i, t) for i, t in enumerate(["xy", "", "日本語", "", "z"])] + [("b", 0, "q")]
    df = spark.createDataFrame(rows, "source_id string, k int, text string").repartition(3)
    parts = sorted(map(tuple, joined_parts(df, "k", size).collect()))
    for source in "ab":
        whole = "\n".join(t for s, _, t in rows if s == source)
        assert [t for s, _, t in parts if s == source] == [
            whole[i:i + size] for i in range(0, len(whole), size)]
