"""The stages of the pipeline keep columns, and clean documents get through."""

import corpus_pipeline

DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(function(spark, docs, DIR), "test")
        assert docs.columns == columns, name
        assert 0.5 * before < docs.count() <= before, name
