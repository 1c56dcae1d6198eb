"""Queries that save, load and compare: files, configs, vocabularies, subsets, SQL functions."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from shardweave.functions import bytelevel
from shardweave.operators import bpe_encode, char_vocab
from shardweave.operators import documents as ops
from shardweave.operators.tokenizers import PretrainedTokenizer, register_sql, tokenizer
from shardweave.plans.corpus import SQL_CHARS, SQL_SOURCES, char_list, texts
from shardweave.plans.document_queries import _RANGES, _SQL_SHUFFLED, _quota_entries, _shuffled
from shardweave.plans.packing_queries import _SQL_ITEMS, BLOCK, text_of
from shardweave.plans.registry import query, table
from shardweave.plans.vocab_queries import _SQL_LEARNT, TOKENS, _vocabulary
from shardweave.sources import artifacts, scan
from shardweave.sources import config as cfg
from shardweave.sources.artifacts import write_json
from shardweave.sources.storage import storage_of
from shardweave.staging import new_path


@query("SELECT string_agg(text || chr(10), '' ORDER BY item_id) AS text FROM benchmark GROUP BY item_id % 7")
def whole_files(spark, sf_dir):
    path = new_path(spark, "texts")
    items = table(spark, sf_dir, "benchmark").select("text", (F.col("item_id") % 7).alias("file"), "item_id")
    (items.repartition("file").sortWithinPartitions("file", "item_id").select("text", "file")
     .write.partitionBy("file").text(path))
    return scan.read_file(spark, path)


@query(f"""
WITH {SQL_SOURCES}
SELECT src_pos, source_id, source_id AS path, 'train' AS split,
       CASE WHEN src_pos % 4 <> 0 THEN nullif(n_docs * (5 + src_pos % 10) // 12, 0) END AS max_docs FROM sources""")
def config_load(spark, sf_dir):
    path = new_path(spark, "config") + "/sources.json"
    write_json(json.dumps(_quota_entries(spark, sf_dir)), path)
    return cfg.config_frame(spark, cfg.load_config(spark, path)).select(
        "src_pos", "source_id", "path", "split", "max_docs")


@query(f"WITH RECURSIVE {_SQL_LEARNT} SELECT id, token, kind FROM tokens")
def vocabulary_saved(spark, sf_dir):
    path = new_path(spark, "vocabulary")
    artifacts.save_vocabulary(_vocabulary(spark, sf_dir), spark, path)
    return artifacts.load_vocabulary(spark, path).vocab_frame(spark)


@query("SELECT doc_id, text FROM documents")
def pretrained_round_trip(spark, sf_dir):
    """A vocabulary in its two published files; encoding adds no space, so decoding spells the text."""
    vocab, path = _vocabulary(spark, sf_dir), new_path(spark, "pretrained")
    write_json(json.dumps({t: i for i, t in enumerate(vocab.tokens)}), f"{path}/vocab.json")
    storage, name = storage_of(f"{path}/merges.txt")
    with storage.open_output_stream(name) as out:
        out.write("\n".join(["#version: 0.2", *(" ".join(pair) for pair in vocab.merges)]).encode())
    pretrained = PretrainedTokenizer(spark, path)
    coded = texts(spark, sf_dir).select("doc_id", pretrained.encode(F.col("text")).alias("ids"))
    return coded.select("doc_id", pretrained.decode(F.col("ids")).alias("text"))


@query(f"""
WITH {_SQL_SHUFFLED}, ranges(subset, lo, hi) AS (
  VALUES {", ".join(f"('{n}', {a}, {'NULL' if b is None else b}::BIGINT)" for n, (a, b) in _RANGES.items())})
SELECT subset, doc_id, position FROM shuffled JOIN ranges
ON position >= lo AND (hi IS NULL OR position < hi)""")
def subsets_saved(spark, sf_dir):
    path = new_path(spark, "subsets")
    artifacts.save_subsets(ops.named_subsets(_shuffled(spark, sf_dir), "position", _RANGES), path)
    return spark.read.parquet(path).select("subset", "doc_id", "position")


@query(f"""
WITH {SQL_CHARS}
SELECT factor, n * factor AS vocab_size, CASE WHEN n * factor < 65536 THEN 'uint16' ELSE 'uint32' END AS dtype
FROM (SELECT count(*) AS n FROM chars), (VALUES (1), (500), (1000)) f(factor)""")
def id_widths(spark, sf_dir):
    size = len(char_list(spark, sf_dir))
    return spark.createDataFrame([(f, size * f, bpe_encode.id_dtype(size * f)) for f in (1, 500, 1000)],
                                 "factor int, vocab_size long, dtype string")


@query("""
SELECT 'char' AS kind, item_id, text FROM benchmark UNION ALL SELECT 'bpe', item_id, ' ' || text FROM benchmark""")
def tokenizer_contract(spark, sf_dir):
    """Learn, save, load, encode and decode by the interface that all tokenizers share."""
    items, out = table(spark, sf_dir, "benchmark"), None
    for kind, options in (("char", {}), ("bpe", {"vocab_size": TOKENS})):
        path = new_path(spark, kind)
        tokenizer(kind, **options).fit(items).save(spark, path)
        tok = tokenizer(kind).load(spark, path)
        part = items.select("item_id", tok.encode(F.col("text")).alias("ids")).select(
            F.lit(kind).alias("kind"), "item_id", tok.decode(F.col("ids")).alias("text"))
        out = part if out is None else out.unionByName(part)
    return out


@query("SELECT doc_id, ' ' || text || ' ' || text AS text FROM documents")
def sql_tokenize(spark, sf_dir):
    """By SQL alone; a literal special token stands between two texts."""
    bpe = tokenizer("bpe")
    bpe.vocab = _vocabulary(spark, sf_dir)
    register_sql(spark, bpe)
    marked = F.concat(F.col("text"), F.lit(bytelevel.EOS), F.col("text"))
    return spark.sql("SELECT doc_id, detokenize(tokenize(text)) AS text FROM {docs}",
                     docs=texts(spark, sf_dir).select("doc_id", marked.alias("text")))


@query(f"""
WITH {_SQL_ITEMS}
SELECT item_id, start, array_to_string(ids[start + 1:start + {BLOCK}], ' ') AS x,
       array_to_string(ids[start + 2:start + {BLOCK + 1}], ' ') AS y
FROM (SELECT item_id, ids, unnest(range(len(ids) - {BLOCK}))::INTEGER AS start
      FROM items WHERE len(ids) > {BLOCK})""")
def sql_windows(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark")
    chars = tokenizer("char")
    chars.chars = char_vocab.characters(char_vocab.learn(items))
    register_sql(spark, chars)
    return spark.sql(
        "SELECT item_id, w.* FROM (SELECT item_id, tokenize(text) AS ids FROM {items}), "
        f"LATERAL token_windows(ids, {BLOCK}) w", items=items).select("item_id", "start", text_of("x"), text_of("y"))
