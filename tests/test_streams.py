"""Quotas over many micro-batches, and after a restart."""

import pytest

from shardweave.operators.documents import index_documents
from shardweave.plans import document_queries, stream_queries
from shardweave.sources.config import MAX_SOURCES
from shardweave.staging import new_path
from shardweave.streaming import arriving

QUOTAS = [("hot", 130), ("s1", None), ("s2", 7), ("s3", 1)]


def rows(start, stop):
    """Four of five rows are of one source."""
    return [("hot" if i % 5 else f"s{1 + i // 5 % 4}", i, f"text {i}") for i in range(start, stop)]


def wanted(spark, everything):
    df = spark.createDataFrame(everything, "source_id string, id int, text string")
    limits = dict(QUOTAS)
    return sorted((r.source_id, r.id, r.doc_idx) for r in index_documents(df, "id").collect()
                  if r.source_id in limits and (limits[r.source_id] is None or r.doc_idx < limits[r.source_id]))


def test_quotas_over_micro_batches_and_a_restart(spark, tmp_path):
    source, out, state, log = (str(tmp_path / n) for n in ("in", "out", "state", "log"))
    quotas = spark.createDataFrame(QUOTAS, "source_id string, max_docs long")
    schema = "source_id string, id int, text string"

    def arrive(start, stop):
        spark.createDataFrame(rows(start, stop), schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        (stream.writeStream.foreachBatch(arriving.quota_writer(quotas, "id", out, state))
         .option("checkpointLocation", log).trigger(availableNow=True).start().awaitTermination())
        return sorted((r.source_id, r.id, r.doc_idx) for r in spark.read.parquet(out).collect())

    for part in range(3):
        arrive(part * 50, part * 50 + 50)
        assert run() == wanted(spark, rows(0, part * 50 + 50))  # a restart each time
    arrive(150, 200)
    arrive(200, 300)
    assert run() == wanted(spark, rows(0, 300))
    assert run() == wanted(spark, rows(0, 300))  # nothing new

    # A batch that is repeated after a failure writes the same.
    batch = spark.createDataFrame(rows(150, 200), schema)
    before = sorted(map(tuple, spark.read.parquet(f"{out}/batch=3").collect()))
    arriving.quota_writer(quotas, "id", out, state)(batch, 3)
    assert sorted(map(tuple, spark.read.parquet(f"{out}/batch=3").collect())) == before


def test_too_many_quotas_are_refused(spark):
    many = spark.range(MAX_SOURCES + 1).selectExpr("cast(id AS string) AS source_id", "1L AS max_docs")
    with pytest.raises(ValueError, match="more than"):
        arriving.quota_writer(many, "id", new_path(spark, "o"), new_path(spark, "s"))


@pytest.mark.parametrize("parts", [0, 3])
def test_stream_queries_read_a_file_and_a_folder_of_parts(spark, tmp_path, parts):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    if parts:
        docs.repartition(parts).write.parquet(str(tmp_path / "documents.parquet"))
    else:
        (tmp_path / "documents.parquet").symlink_to("/root/testdata/sf0.001/documents.parquet")
    n = docs.count()
    assert sum(r.texts for r in stream_queries.stream_counts(spark, str(tmp_path)).collect()) == n
    assert stream_queries.stream_route_encode(spark, str(tmp_path)).count() == n
    got = stream_queries.stream_quota(spark, str(tmp_path)).collect()
    assert sorted(got) == sorted(document_queries.quota_filter(spark, str(tmp_path)).collect())
