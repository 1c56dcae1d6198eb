"""Queries on byte-level words, byte-pair learning, encoding and decoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from shardweave.functions import bytelevel
from shardweave.operators import bpe_encode as codec
from shardweave.operators import bpe_train, pack, stats
from shardweave.plans.corpus import (
    SHARD_SIZE, SQL_ROUTED, routed_documents, texts)
from shardweave.plans.packing_queries import text_of
from shardweave.plans.registry import query, table
from shardweave.plans.vocab_sql import (
    SQL_ENCODED_DOCS, SQL_ENCODED_WORDS, SQL_WORDS, byte_chars_sql, learnt_sql, pairs_sql,
    words_sql)
from shardweave.sources.config import config_frame, config_from_column
from shardweave.staging import stage

# Small, so that one merge per SQL recursion step stays affordable.
TOKENS = 256

_SQL_LEARNT = f"{SQL_WORDS}, {learnt_sql(TOKENS)}"
_SQL_CODED = f"{_SQL_LEARNT}, {SQL_ENCODED_WORDS}, {SQL_ENCODED_DOCS}"


_docs = texts


def _counts(spark, sf_dir):
    return bpe_train.word_counts(_docs(spark, sf_dir))


def _vocabulary(spark, sf_dir):
    return bpe_train.learn(_counts(spark, sf_dir), TOKENS)


@query(f"""
SELECT doc_id, len(ws) AS n_words, array_to_string(ws, chr(31)) AS words
FROM (SELECT doc_id, {words_sql('text')} AS ws FROM documents)""")
def pretokens(spark, sf_dir):
    cut = _docs(spark, sf_dir).select("doc_id", bytelevel.words(F.col("text")).alias("ws"))
    return cut.select("doc_id", F.size("ws").cast("long").alias("n_words"),
                      F.array_join("ws", "\x1f").alias("words"))


@query(f"""
SELECT word, count(*) AS n FROM (SELECT unnest({words_sql('text')}) AS word FROM documents)
GROUP BY word""")
def word_counts(spark, sf_dir):
    return _counts(spark, sf_dir)


@query(f"""
SELECT word, array_to_string({byte_chars_sql('word')}, '') AS chars
FROM (SELECT DISTINCT unnest({words_sql('text')}) AS word FROM documents)""")
def byte_words(spark, sf_dir):
    return _counts(spark, sf_dir).select(
        "word", bytelevel.to_byte_chars(F.col("word")).alias("chars"))


@query(f"WITH {SQL_WORDS} SELECT ch FROM letters")
def bpe_alphabet(spark, sf_dir):
    return bpe_train.alphabet(_counts(spark, sf_dir))


@query(f"""WITH {SQL_WORDS}, pairs AS ({pairs_sql('spelled')})
SELECT l AS "left", r AS "right", c AS n FROM pairs""")
def bpe_pair_counts(spark, sf_dir):
    state = _counts(spark, sf_dir).select(bpe_train.spelled(F.col("word")).alias("word"), "n")
    return bpe_train.pair_counts(state)


@query(f"WITH RECURSIVE {_SQL_LEARNT} SELECT id, token, kind FROM tokens")
def bpe_vocabulary(spark, sf_dir):
    return _vocabulary(spark, sf_dir).vocab_frame(spark)


@query(f"""WITH RECURSIVE {_SQL_LEARNT}
SELECT rank, "left", "right", "left" || "right" AS merged FROM merges""")
def bpe_merges(spark, sf_dir):
    return _vocabulary(spark, sf_dir).merges_frame(spark)


@query(f"""WITH RECURSIVE {_SQL_LEARNT}
SELECT 'token' AS section, id AS pos, token AS entry FROM tokens
UNION ALL SELECT 'special', id, token FROM tokens WHERE kind = 'special'
UNION ALL SELECT 'merge', rank, "left" || ' ' || "right" FROM merges WHERE rank < 50
UNION ALL SELECT 'total tokens', count(*)::INTEGER, NULL FROM tokens
UNION ALL SELECT 'total merges', count(*)::INTEGER, NULL FROM merges""")
def vocab_listing(spark, sf_dir):
    return codec.listing(_vocabulary(spark, sf_dir), spark)


@query(f"""WITH RECURSIVE {_SQL_LEARNT}, {SQL_ENCODED_WORDS}
SELECT word, array_to_string(ids, ' ') AS ids FROM coded""")
def word_ids(spark, sf_dir):
    counts = stage(_counts(spark, sf_dir), "counts")
    vocab = bpe_train.learn(counts, TOKENS)
    return codec.word_ids(counts, vocab).select("word", text_of("ids"))


@query(f"""WITH RECURSIVE {_SQL_CODED}
SELECT doc_id, len(ids)::INTEGER AS n_tokens, array_to_string(ids, ' ') AS ids FROM doc_ids""")
def bpe_encode(spark, sf_dir):
    vocab = _vocabulary(spark, sf_dir)
    coded = _docs(spark, sf_dir).select("doc_id", codec.encode(F.col("text"), vocab).alias("ids"))
    return coded.select("doc_id", F.size("ids").alias("n_tokens"), text_of("ids"))


@query(f"""WITH RECURSIVE {_SQL_CODED}
SELECT doc_id, '1 ' || array_to_string(ids, ' ') || ' 2' AS ids FROM doc_ids""")
def bpe_encode_special(spark, sf_dir):
    vocab = _vocabulary(spark, sf_dir)
    ids = codec.encode(F.col("text"), vocab, add_specials=True).alias("ids")
    return _docs(spark, sf_dir).select("doc_id", ids).select("doc_id", text_of("ids"))


# Pieces of text between literal special tokens are texts of their own.
@query("""
SELECT doc_id, ' ' || text || ' ' || text AS text FROM documents""")
def bpe_decode_with_specials(spark, sf_dir):
    vocab = _vocabulary(spark, sf_dir)
    marked = F.concat(F.col("text"), F.lit(bytelevel.EOS), F.col("text"))
    coded = _docs(spark, sf_dir).select("doc_id", codec.encode(marked, vocab).alias("ids"))
    return coded.select("doc_id", codec.decode(F.col("ids"), vocab).alias("text"))


@query("SELECT doc_id, ' ' || text AS text FROM documents")
def bpe_decode(spark, sf_dir):
    vocab = _vocabulary(spark, sf_dir)
    coded = _docs(spark, sf_dir).select("doc_id", codec.encode(F.col("text"), vocab).alias("ids"))
    return coded.select("doc_id", codec.decode(F.col("ids"), vocab).alias("text"))


def bpe_encoded(spark, sf_dir):
    vocab = _vocabulary(spark, sf_dir)
    docs = routed_documents(spark, sf_dir).select(
        "split", "source_id", "src_pos", "doc_idx", "doc_id",
        codec.encode(F.col("text"), vocab).alias("ids"))
    return stage(docs.withColumn("n_tokens", F.size("ids")), "encoded"), vocab


@query(f"""WITH RECURSIVE {_SQL_CODED}, {SQL_ROUTED}, tokens_of AS (
  SELECT split, source_id, count(*) AS texts, sum(len(ids) + 1)::BIGINT AS tokens
  FROM routed JOIN doc_ids USING (doc_id) GROUP BY ALL)
SELECT s.split, s.source_id, coalesce(texts, 0) AS texts, coalesce(tokens, 0) AS tokens
FROM (SELECT split, source_id FROM sources CROSS JOIN (VALUES ('train'), ('val')) v(split)) s
LEFT JOIN tokens_of USING (split, source_id)""")
def bpe_manifest_sources(spark, sf_dir):
    encoded, _ = bpe_encoded(spark, sf_dir)
    config = config_frame(spark, config_from_column(table(spark, sf_dir, "documents"), "source"))
    found = stats.complete_stats(config.drop("split"), stats.source_stats(encoded))
    return found.select("split", "source_id", "texts", "tokens")


@query(f"""WITH RECURSIVE {_SQL_CODED}, {SQL_ROUTED}, located AS (
  SELECT split, list_append(ids, 2) AS ids,
         sum(len(ids) + 1) OVER (PARTITION BY split ORDER BY doc_idx, src_pos) - len(ids) - 1 AS off
  FROM routed JOIN doc_ids USING (doc_id)),
stream AS (
  SELECT split, (off + pos - 1)::BIGINT AS p, tok
  FROM (SELECT split, off, unnest(ids) AS tok, generate_subscripts(ids, 1) AS pos FROM located))
SELECT split, (p // {SHARD_SIZE})::INTEGER AS shard_idx, (p % {SHARD_SIZE}) // 1024 AS block,
       array_to_string(list(tok ORDER BY p), ' ') AS tokens
FROM stream GROUP BY split, p // {SHARD_SIZE}, (p % {SHARD_SIZE}) // 1024""")
def bpe_packed(spark, sf_dir):
    encoded, vocab = bpe_encoded(spark, sf_dir)
    pieces = pack.cut_into_shards(
        pack.token_offsets(encoded), vocab.id_of(bytelevel.EOS), SHARD_SIZE)
    ordered = F.array_sort(F.collect_list(F.struct("start", "tokens")))
    return pieces.groupBy("split", "shard_idx", "block").agg(
        F.flatten(F.transform(ordered, lambda p: p["tokens"])).alias("tokens")
    ).select("split", "shard_idx", "block", text_of("tokens"))


# Learning and encoding at the size the jobs use; a merge per step of recursive SQL would take too long.

@query()
def bpe_vocabulary_full(spark, sf_dir):
    return bpe_train.learn(_counts(spark, sf_dir)).vocab_frame(spark)


@query("SELECT doc_id, ' ' || text AS text FROM documents")
def bpe_round_trip_full(spark, sf_dir):
    vocab = bpe_train.learn(_counts(spark, sf_dir))
    coded = _docs(spark, sf_dir).select("doc_id", codec.encode(F.col("text"), vocab).alias("ids"))
    return coded.select("doc_id", codec.decode(F.col("ids"), vocab).alias("text"))
