"""Quotas that stop reading, splits of a path, and file order in any format."""

import gzip
import io
import json
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource

from shardweave.operators.tokenizers import tokenizer
from shardweave.plans import document_queries
from shardweave.plans.prepare import merged_documents, prepare_corpus
from shardweave.sources import lines, ordered, scan, storage
from shardweave.sources.layout import source_path


def files_read(df):
    """Files that the scans of a plan opened."""
    df.collect()
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name.startswith("Scan") and node.metrics().contains("numFiles"):
            found.append(node.metrics().apply("numFiles").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(found)


@pytest.fixture(scope="module")
def numbers(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("numbers") / "t")
    spark.range(0, 1000, 1, 40).select("id", F.concat(F.lit("text "), "id").alias("text")).write.parquet(path)
    return path


@pytest.mark.parametrize("quota, opened", [(5, 1), (25, 1), (26, 2), (1000, 40), (5000, 40), (None, 40)])
def test_quota_opens_only_the_files_it_needs(spark, numbers, quota, opened):
    got = ordered.numbered_source(spark, {"path": numbers, "split": "", "max_docs": quota})
    assert files_read(got) == opened
    rows = sorted((r.doc_idx, r.id) for r in got.collect())
    assert rows == [(i, i) for i in range(min(quota or 1000, 1000))]
    assert "NestedLoop" not in got._jdf.queryExecution().toString()


def test_counting_stops_at_the_quota(spark, numbers, monkeypatch):
    opened = []
    original = ordered.ParquetScan.counts

    def counts(self, after, upto):
        df = original(self, after, upto)
        opened.append(files_read(df))
        return df

    monkeypatch.setattr(ordered.ParquetScan, "counts", counts)
    ordered.numbered_source(spark, {"path": numbers, "split": "", "max_docs": 30})
    assert opened == [1, 16]


@pytest.mark.parametrize("files, pieces", [(3, 50_000), (10_000, 7)])
def test_many_runs_number_like_one(spark, numbers, monkeypatch, files, pieces):
    monkeypatch.setattr(ordered, "RUN_FILES", files)
    monkeypatch.setattr(ordered, "RUN_PIECES", pieces)
    for quota in (None, 333):
        got = ordered.numbered_source(spark, {"path": numbers, "split": "", "max_docs": quota}).collect()
        assert sorted((r.doc_idx, r.id) for r in got) == [(i, i) for i in range(quota or 1000)]


def test_empty_and_missing_sources(spark, tmp_path):
    spark.range(0).withColumn("text", F.lit("")).write.parquet(f"{tmp_path}/none")
    got = ordered.numbered_source(spark, {"path": f"{tmp_path}/none", "split": "", "max_docs": 3})
    assert got.count() == 0 and set(got.columns) == {"id", "text", "doc_idx"}
    spark.createDataFrame([(1,)], "a int").write.csv(f"{tmp_path}/csv")
    with pytest.raises(ValueError, match="no file order"):
        ordered.numbered_source(spark, {"path": f"{tmp_path}/csv", "split": "", "format": "csv"})
    by_key = ordered.numbered_source(spark, {"path": f"{tmp_path}/csv", "split": "", "format": "csv", "order": "_c0"})
    assert [(r._c0, r.doc_idx) for r in by_key.collect()] == [("1", 0)]


def test_names_and_splits_of_a_path(spark, tmp_path):
    root = str(tmp_path / "data")
    df = spark.range(12).select("id", (F.col("id") % 2).cast("string").alias("name"),
                                F.when(F.col("id") < 4, "test").otherwise("train").alias("split"))
    df.write.partitionBy("name", "split").parquet(root)
    entries = [{"path": root, "name": n, "split": s} for n in "01" for s in ("train", "test")]
    got = {}
    for r in scan.numbered_sources(spark, entries).collect():
        got.setdefault(r.source_id, []).append(int(r.id))
    assert {k.removeprefix(root): sorted(v) for k, v in got.items()} == {
        ":0:train": [4, 6, 8, 10], ":0:test": [0, 2], ":1:train": [5, 7, 9, 11], ":1:test": [1, 3]}
    assert scan.scan_sources(spark, entries[:1]).count() == 4
    for wrong in ({"name": "2", "split": "test"}, {"name": "0", "split": "other"}):
        with pytest.raises(ValueError, match="has no"):
            source_path(spark, {"path": root, **wrong})
    plain = tmp_path / "plain" / "cfg" / "validation"
    plain.mkdir(parents=True)
    assert source_path(spark, {"path": str(tmp_path / "plain"), "name": "cfg", "split": "validation"}) == str(plain)
    with pytest.raises(ValueError, match="no split 'train'"):
        source_path(spark, {"path": str(tmp_path / "plain"), "name": "cfg", "split": "train"})
    for name, text in (("train-00000.txt", "a\nb"), ("train-00001.txt", "c\n"), ("test-0.txt", "d"), ("_x", "no")):
        (tmp_path / name).write_text(text)
    got = {s: [r.text for r in sorted(ordered.numbered_source(
        spark, {"path": str(tmp_path), "split": s, "format": "text"}).collect(), key=lambda r: r.doc_idx)]
        for s in ("train", "test")}
    assert got == {"train": ["a", "b", "c"], "test": ["d"]}
    assert source_path(spark, {"path": root + "/name=0/split=train", "split": "label"}) == root + "/name=0/split=train"


def test_line_ranges_lose_and_repeat_nothing(monkeypatch):
    rng = random.Random(1)
    for _ in range(500):
        data = b"".join(rng.choice([b"a", b"bb", b"\n", b"\n", b"\r\n", b"xyz"]) for _ in range(rng.randrange(40)))
        monkeypatch.setattr(lines, "CHUNK_BYTES", rng.choice([1, 2, 3, 7, 100]))
        got = []
        for part in lines.ranges_of("x", len(data), rng.choice([1, 2, 3, 5, 8, 1000])):
            stream = io.BytesIO(data)
            stream.seek(max(part.start - 1, 0))
            for batch in lines.line_batches(stream, part.start, part.end):
                got += batch
        assert got == [line.removesuffix(b"\r") for line in data.removesuffix(b"\n").split(b"\n")] * bool(data) or not data


@pytest.mark.parametrize("range_bytes", ["7", "1000", str(1 << 20)])
def test_lines_are_numbered_in_file_order(spark, tmp_path, range_bytes):
    texts = [f"line {i} " + "x" * (i % 50) for i in range(300)] + ["", "  ", "last é"]
    (tmp_path / "a.txt").write_text("\n".join(texts[:100]) + "\n")
    (tmp_path / "b.txt").write_text("\r\n".join(texts[100:200]))
    with gzip.open(tmp_path / "c.txt.gz", "wt", encoding="utf-8") as out:
        out.write("\n".join(texts[200:]))
    entry = {"path": str(tmp_path), "split": "", "format": "text", "options": {"rangeBytes": range_bytes}}
    for quota in (None, 1, 150, 250):
        got = ordered.numbered_source(spark, {**entry, "max_docs": quota}).collect()
        assert [r.text for r in sorted(got, key=lambda r: r.doc_idx)] == texts[:quota]
    whole = ordered.numbered_source(spark, {**entry, "options": {"wholetext": "true"}, "path": f"{tmp_path}/[ab].txt"})
    assert [r.text.count("\n") for r in sorted(whole.collect(), key=lambda r: r.doc_idx)] == [100, 99]


def test_json_and_text_sources_equal_the_parquet_run(spark, tmp_path):
    rows = [(f"k{i}" if i % 3 else None, f"the text of number {i} " * (i % 4) if i % 10 else " ") for i in range(120)]
    spark.createDataFrame(rows, "id string, text string").repartition(1).write.parquet(f"{tmp_path}/parquet")
    rows = [tuple(r) for r in spark.read.parquet(f"{tmp_path}/parquet").select("id", "text").collect()]
    (tmp_path / "json").mkdir()
    for part in range(2):
        (tmp_path / "json" / f"part-{part}.json").write_text("\n\n".join(
            json.dumps({"id": i, "text": t, "extra": {"n": 1}}) for i, t in rows[part * 60:part * 60 + 60]))
    (tmp_path / "text.txt").write_text("\n".join(t for _, t in rows))

    def run(kind, path, **entry):
        entries = [{"path": f"{tmp_path}/{path}", "split": "train", "id": "s", "max_docs": 110, "format": kind, **entry}]
        merged = sorted(merged_documents(spark, entries).collect(), key=lambda r: r.doc_idx)
        tok = tokenizer("char")
        done = prepare_corpus(spark, entries, f"{tmp_path}/out-{kind}", tok, 0.2, 500, export_bins=False)
        return merged, sorted(map(tuple, done.shards.collect()))

    wanted, shards = run("parquet", "parquet")
    assert run("json", "json", options={"rangeBytes": "900"}) == (wanted, shards)
    merged, _ = run("text", "text.txt", options={"rangeBytes": "333"})
    assert [(r.doc_idx, r.text) for r in merged] == [(r.doc_idx, r.text) for r in wanted]


def test_a_data_source_is_registered_once_and_a_passing_failure_is_met(spark, monkeypatch):
    class Source(DataSource):
        @classmethod
        def name(cls):
            return "registered_once"

    kind, calls = type(spark.dataSource), []
    register = kind.register

    def flaky(self, source):
        calls.append(source)
        if len(calls) == 1:
            error = AnalysisException("Data source already exists")
            monkeypatch.setattr(error, "getCondition", lambda: "DATA_SOURCE_ALREADY_EXISTS", raising=False)
            raise error
        register(self, source)

    monkeypatch.setattr(kind, "register", flaky)
    monkeypatch.setattr(storage.time, "sleep", lambda seconds: None)
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda i: storage.register_once(spark, Source), range(32)))
    assert len(calls) == 2
    lines.lines_reader(spark), lines.lines_reader(spark)
    assert len(calls) <= 3


def test_short_ranges_share_tasks_and_are_counted_in_place(spark, tmp_path):
    for name in "ab":
        (tmp_path / name).write_text("".join(f"line {i}\n" for i in range(1000)))
    options = {"path": str(tmp_path), "rangeBytes": "20"}
    tasks = lines.LinesReader(options).partitions()
    assert len(tasks) <= lines.LEAST_TASKS + 1 and sum(len(t.ranges) for t in tasks) > 500
    rows = lines.lines_reader(spark, rangeBytes=20).load(str(tmp_path))
    counts = lines.lines_reader(spark, rangeBytes=20, counts=True).load(str(tmp_path)).collect()
    assert rows.count() == sum(r.rows for r in counts) == 2000
    assert sorted(map(tuple, counts)) == sorted(map(tuple, rows.groupBy("file", "file_block").count().collect()))
    got = ordered.numbered_source(spark, {"path": str(tmp_path), "split": "", "format": "text", "options": {"rangeBytes": "20"}})
    assert [r.text for r in got.orderBy("doc_idx").collect()] == [f"line {i}" for i in range(1000)] * 2


def test_written_files_grow_in_number_not_in_rows(spark, monkeypatch):
    monkeypatch.setattr(document_queries, "ROWS_PER_TASK", 10)
    docs = spark.range(200)
    assert document_queries._in_ranges(docs, 4, "id").rdd.getNumPartitions() == 20
    assert document_queries._in_ranges(docs.limit(20), 4, "id").rdd.getNumPartitions() == 4
