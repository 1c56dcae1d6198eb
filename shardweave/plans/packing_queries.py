"""Queries on character vocabularies, packing, manifests and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from shardweave.operators import char_vocab, pack, stats, windows
from shardweave.operators.documents import extract, route, route_prefix
from shardweave.operators.order import running_total
from shardweave.operators.tokenizers import tokenizer
from shardweave.plans.corpus import (
    SHARD_SIZE, SQL_CHARS, SQL_ENCODED, SQL_OFFSETS, SQL_ROUTED, VAL_RATIO, char_encoded,
    char_list, routed_documents, texts, unit_sql)
from shardweave.plans.prepare import VOCABULARY, prepare_corpus, prepare_single
from shardweave.plans.registry import query, table
from shardweave.sources import binshards
from shardweave.sources.config import config_frame, config_from_column
from shardweave.staging import new_path, stage

BLOCK = 64


def text_of(ids):
    """Arrays leave the queries as text, so that values compare across engines."""
    return F.array_join(F.col(ids).cast("array<string>"), " ").alias(ids)


# ---- character vocabulary

@query(f"WITH {SQL_CHARS} SELECT ch, id FROM chars")
def char_vocabulary(spark, sf_dir):
    return char_vocab.learn(texts(spark, sf_dir))


@query(f"WITH {SQL_CHARS} SELECT count(*) AS vocab_size FROM chars")
def vocab_size(spark, sf_dir):
    return char_vocab.learn(texts(spark, sf_dir)).agg(
        F.count("*").alias("vocab_size"))


@query(f"WITH {SQL_ENCODED} SELECT doc_id, n_tokens, array_to_string(ids, ' ') AS ids FROM encoded")
def char_encode(spark, sf_dir):
    chars = char_list(spark, sf_dir)
    docs = texts(spark, sf_dir).select(
        "doc_id", char_vocab.encode(F.col("text"), chars).alias("ids"))
    return docs.select("doc_id", F.size("ids").alias("n_tokens"), text_of("ids"))


@query("SELECT doc_id, text FROM documents")
def char_decode(spark, sf_dir):
    chars = char_list(spark, sf_dir)
    docs = texts(spark, sf_dir).select(
        "doc_id", char_vocab.encode(F.col("text"), chars).alias("ids"))
    return docs.select("doc_id", char_vocab.decode(F.col("ids"), chars).alias("text"))


@query("""
WITH chars AS (
  SELECT ch, (row_number() OVER (ORDER BY encode(ch)) - 1)::INTEGER AS id
  FROM (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM benchmark) WHERE ch <> '')
SELECT item_id, pos::INTEGER AS pos, id FROM (
  SELECT item_id, unnest(string_split(text, '')) AS ch,
         generate_subscripts(string_split(text, ''), 1) - 1 AS pos FROM benchmark)
JOIN chars USING (ch)""")
def flat_tokens(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark")
    chars = char_vocab.characters(char_vocab.learn(items))
    encoded = items.select("item_id", char_vocab.encode(F.col("text"), chars).alias("ids"))
    return encoded.select("item_id", F.posexplode("ids").alias("pos", "id"))


# ---- counts and manifests

_SQL_STATS = SQL_ROUTED + """,
stats AS (
  SELECT split, source_id, count(*) AS texts, sum(length(text) + 1)::BIGINT AS tokens
  FROM routed GROUP BY split, source_id)"""


def _counted(spark, sf_dir):
    """Character token counts need neither ids nor positions, so no shuffle here."""
    docs = table(spark, sf_dir, "documents").withColumnRenamed("source", "source_id")
    return route(extract(docs), VAL_RATIO, "doc_id").select(
        "split", "source_id", F.length("text").alias("n_tokens"))


@query(f"WITH {_SQL_STATS} SELECT * FROM stats")
def stats_by_source(spark, sf_dir):
    return stats.source_stats(_counted(spark, sf_dir))


@query(f"""
WITH {SQL_ROUTED}
SELECT split, source_id, count(*) AS texts, sum(length(text) + 1)::BIGINT AS tokens
FROM routed GROUP BY ROLLUP (split, source_id)""")
def stats_rollup(spark, sf_dir):
    return stats.rollup_stats(_counted(spark, sf_dir))


_EMPTY = {"path": "empty", "split": "train", "id": "empty"}


def _complete(spark, sf_dir):
    """Per-source counts; one more source is configured that has no rows."""
    docs = table(spark, sf_dir, "documents")
    config = config_frame(spark, [*config_from_column(docs, "source"), _EMPTY]).withColumnRenamed(
        "split", "split_name")
    found = stats.source_stats(_counted(spark, sf_dir))
    return stats.complete_stats(config, found)


_SQL_COMPLETE = _SQL_STATS + """,
complete AS (
  SELECT sp.split, s.source_id, s.src_pos, coalesce(st.texts, 0) AS texts,
         coalesce(st.tokens, 0) AS tokens
  FROM (SELECT source_id, src_pos FROM sources
        UNION ALL SELECT 'empty', count(*)::INTEGER FROM sources) s
  CROSS JOIN (VALUES ('train'), ('val')) sp(split)
  LEFT JOIN stats st
         ON st.source_id = s.source_id AND st.split = sp.split),
totals AS (
  SELECT split, sum(texts)::BIGINT AS texts, sum(tokens)::BIGINT AS tokens,
         greatest(1, ceil(sum(tokens) / %d))::BIGINT AS num_shards
  FROM complete GROUP BY split)""" % SHARD_SIZE


@query(f"WITH {_SQL_COMPLETE} SELECT split, source_id, src_pos, texts, tokens FROM complete")
def manifest_sources(spark, sf_dir):
    return _complete(spark, sf_dir).select("split", "source_id", "src_pos", "texts", "tokens")


@query(f"""
WITH {_SQL_COMPLETE}, listed AS (
  SELECT split, list(json_object('path', source_id, 'split', 'train', 'id', source_id,
                                 'source_id', source_id, 'encoded_texts', texts, 'encoded_tokens', tokens)
                     ORDER BY src_pos) AS datasets
  FROM complete GROUP BY split)
SELECT split, json_object(
  'split', split, 'datasets', datasets, 'tokenizer_type', 'char',
  'vocab_size', (SELECT count(DISTINCT ch) FROM (SELECT unnest(string_split(text, '')) AS ch FROM documents) WHERE ch <> ''),
  'dtype', 'uint16', 'total_tokens', tokens, 'total_texts', texts, 'num_shards', num_shards,
  'shard_size_tokens', {SHARD_SIZE},
  'files', list_transform(range(num_shards), lambda i: format('{{}}_{{:03d}}.bin', split, i)),
  'val_ratio', {VAL_RATIO})::VARCHAR AS manifest
FROM totals JOIN listed USING (split)""")
def manifest_split(spark, sf_dir):
    size = len(char_list(spark, sf_dir))
    return stats.split_manifests(_complete(spark, sf_dir), "char", size, VAL_RATIO, SHARD_SIZE)


@query(f"""
WITH {_SQL_COMPLETE}, parts AS (
  SELECT split, texts, json_object(
    'total_tokens', tokens, 'total_texts', texts, 'num_shards', num_shards,
    'files', list_transform(range(num_shards),
                            lambda i: format('{{}}/{{}}_{{:03d}}.bin', split, split, i))) AS part
  FROM totals)
SELECT json_object(
  'tokenizer_type', 'char',
  'vocab_size', (SELECT count(DISTINCT ch) FROM (SELECT unnest(string_split(text, '')) AS ch FROM documents) WHERE ch <> ''),
  'dtype', 'uint16', 'shard_size_tokens', {SHARD_SIZE}, 'val_ratio', {VAL_RATIO},
  'total_texts', (SELECT sum(texts)::BIGINT FROM parts),
  'train', (SELECT part FROM parts WHERE split = 'train'),
  'val', (SELECT part FROM parts WHERE split = 'val'))::VARCHAR AS manifest""")
def manifest_root(spark, sf_dir):
    size = len(char_list(spark, sf_dir))
    return stats.root_manifest(_complete(spark, sf_dir), "char", size, VAL_RATIO, SHARD_SIZE)


@query("""
WITH d AS (
  SELECT length(text) + 1 AS span, row_number() OVER (ORDER BY doc_id) - 1
           < floor((SELECT count(*) FROM documents) * 0.9) AS train FROM documents)
SELECT json_object(
  'input', 'documents', 'tokenizer_type', 'char',
  'vocab_size', (SELECT count(DISTINCT ch) FROM (SELECT unnest(string_split(text, '')) AS ch FROM documents) WHERE ch <> ''),
  'dtype', 'uint16',
  'train_tokens', (sum(span) FILTER (train))::BIGINT,
  'val_tokens', (sum(span) FILTER (NOT train))::BIGINT, 'total_tokens', sum(span)::BIGINT,
  'train_texts', count(*) FILTER (train), 'val_texts', count(*) FILTER (NOT train),
  'train_split', 0.9)::VARCHAR AS manifest FROM d""")
def manifest_simple(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.length("text").alias("n_tokens"))
    routed = route_prefix(running_total(docs, ["doc_id"]), 0.9, "position")
    size = len(char_list(spark, sf_dir))
    return stats.simple_manifest(routed, "documents", "char", size, 0.9)


@query(f"""
WITH {_SQL_COMPLETE}
SELECT split, i::INTEGER AS shard_idx, format('{{}}_{{:03d}}.bin', split, i) AS file
FROM (SELECT split, unnest(range(num_shards)) AS i FROM totals)""")
def shard_files(spark, sf_dir):
    return pack.shard_list(stats.split_totals(_complete(spark, sf_dir)), SHARD_SIZE)


# ---- packing

@query(f"""
WITH {SQL_ROUTED}
SELECT doc_id, split, length(text) + 1 AS span,
       (sum(length(text) + 1) OVER (PARTITION BY split ORDER BY doc_idx, src_pos)
        - length(text) - 1)::BIGINT AS "offset"
FROM routed""")
def token_offsets(spark, sf_dir):
    docs = routed_documents(spark, sf_dir).select(
        "doc_id", "split", "doc_idx", "src_pos", F.length("text").alias("n_tokens"))
    return pack.token_offsets(stage(docs, "lengths")).select("doc_id", "split", "span", "offset")


def packed(spark, sf_dir, shard_size=SHARD_SIZE):
    encoded, chars = char_encoded(spark, sf_dir)
    located = pack.token_offsets(encoded)
    return pack.cut_into_shards(located, len(chars), shard_size)


@query(f"""
WITH {SQL_OFFSETS}, shards AS (
  SELECT split, (p // {SHARD_SIZE})::INTEGER AS shard_idx, (p % {SHARD_SIZE}) // 1024 AS block,
         list(tok ORDER BY p) AS toks
  FROM stream GROUP BY ALL)
SELECT split, shard_idx, block, array_to_string(toks, ' ') AS tokens FROM shards""")
def packed_tokens(spark, sf_dir):
    ordered = F.array_sort(F.collect_list(F.struct("start", "tokens")))
    return packed(spark, sf_dir).groupBy("split", "shard_idx", "block").agg(
        F.flatten(F.transform(ordered, lambda p: p["tokens"])).alias("tokens")
    ).select("split", "shard_idx", "block", text_of("tokens"))


@query(f"""
WITH {SQL_ROUTED}, totals AS (
  SELECT sp.split, coalesce(sum(length(text) + 1), 0)::BIGINT AS tokens
  FROM (VALUES ('train'), ('val')) sp(split) LEFT JOIN routed r ON r.split = sp.split GROUP BY 1)
SELECT split, i::INTEGER AS shard_idx, format('{{}}_{{:03d}}.bin', split, i) AS file,
       least({SHARD_SIZE}, tokens - i * {SHARD_SIZE})::BIGINT AS length
FROM (SELECT *, unnest(range(greatest(1, ceil(tokens / {SHARD_SIZE}))::BIGINT)) AS i FROM totals)""")
def shard_layout(spark, sf_dir):
    return pack.planned_lengths(stats.split_totals(_complete(spark, sf_dir)), SHARD_SIZE)


@query(f"""
WITH {SQL_CHARS}, d AS (
  SELECT doc_id, text, CASE WHEN row_number() OVER (ORDER BY doc_id) - 1
           < floor((SELECT count(*) FROM documents) * 0.9) THEN 'train' ELSE 'val' END AS split
  FROM documents),
one AS (SELECT split, string_agg(text || chr(1), '' ORDER BY doc_id) AS t FROM d GROUP BY split),
flat AS (SELECT split, unnest(string_split(t, '')) AS ch,
                generate_subscripts(string_split(t, ''), 1) - 1 AS p FROM one)
SELECT split, count(*) AS tokens, p // 1024 AS block,
       array_to_string(list(coalesce(id, (SELECT max(id) + 1 FROM chars)) ORDER BY p), ' ') AS ids
FROM flat LEFT JOIN chars USING (ch) GROUP BY split, p // 1024""")
def pack_single(spark, sf_dir):
    chars = char_list(spark, sf_dir)
    docs = running_total(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    encoded = stage(route_prefix(docs, 0.9, "position").select(
        "split", "doc_id", char_vocab.encode(F.col("text"), chars).alias("ids"),
        F.length("text").alias("n_tokens")), "simple")
    located = pack.token_offsets(encoded, ["doc_id"])
    pieces = pack.cut_into_shards(located, len(chars), shard_size=None)
    ordered = F.array_sort(F.collect_list(F.struct("start", "tokens")))
    return pieces.groupBy("split", "shard_idx", "block").agg(
        F.flatten(F.transform(ordered, lambda p: p["tokens"])).alias("ids")
    ).select("split", "block", F.size("ids").cast("long").alias("tokens"), text_of("ids"))


# ---- export

_SQL_BLOCKS = """
SELECT split, shard_idx, block, array_to_string(toks, ' ') AS tokens FROM (
  SELECT split, (p // {size})::INTEGER AS shard_idx, (p % {size}) // 1024 AS block, list(tok ORDER BY p) AS toks
  FROM stream GROUP BY ALL)"""


@query(f"WITH {SQL_OFFSETS} " + _SQL_BLOCKS.format(size=SHARD_SIZE))
def bin_round_trip(spark, sf_dir):
    path = new_path(spark, "bins")
    binshards.write_shards_as_bins(packed(spark, sf_dir), path)
    files = pack.shard_list(stats.split_totals(_complete(spark, sf_dir)), SHARD_SIZE)
    listed = files.select("split", "shard_idx", F.concat_ws("/", F.lit(path), "split", "file").alias("path"))
    return binshards.read_shards(spark, listed).select("split", "shard_idx", "block", text_of("tokens"))


@query(f"""
WITH routed AS (
  SELECT CASE WHEN substr(sha256('documents:' || doc_id), 1, 16) < '{int(VAL_RATIO * 2**64):016x}'
              THEN 'val' ELSE 'train' END AS split, length(text) + 1 AS span FROM documents),
totals AS (SELECT split, sum(span)::BIGINT AS tokens FROM routed GROUP BY split)
SELECT split, i::INTEGER AS shard_idx, format('{{}}_{{:03d}}.bin', split, i) AS file, 'uint16' AS dtype,
       least({SHARD_SIZE}, tokens - i * {SHARD_SIZE})::BIGINT AS length
FROM (SELECT *, unnest(range(ceil(tokens / {SHARD_SIZE})::BIGINT)) AS i FROM totals)""")
def prepared_catalog(spark, sf_dir):
    docs = stage(table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "id"), "documents").staged_at
    out = new_path(spark, "prepared")
    prepare_corpus(spark, [{"path": docs, "split": "train", "id": "documents"}], out, tokenizer("char"),
                   VAL_RATIO, SHARD_SIZE)
    return binshards.prepared_catalog(spark, out).select(
        "split", "shard_idx", F.element_at(F.split("path", "/"), -1).alias("file"), "dtype", "length")


@query(f"""
WITH {SQL_CHARS}, d AS (
  SELECT doc_id, text, CASE WHEN row_number() OVER (ORDER BY doc_id) - 1
           < floor((SELECT count(*) FROM documents) * 0.9) THEN 'train' ELSE 'val' END AS split
  FROM documents),
one AS (SELECT split, string_agg(text || chr(1), '' ORDER BY doc_id) AS t FROM d GROUP BY split),
stream AS (
  SELECT split, p, coalesce(id, (SELECT max(id) + 1 FROM chars)) AS tok
  FROM (SELECT split, unnest(string_split(t, '')) AS ch,
               generate_subscripts(string_split(t, ''), 1) - 1 AS p FROM one)
  LEFT JOIN chars USING (ch) WHERE ch <> '')
""" + _SQL_BLOCKS.format(size=SHARD_SIZE))
def prepare_single_bins(spark, sf_dir):
    out = new_path(spark, "single")
    tokenizer("char").fit(texts(spark, sf_dir)).save(spark, f"{out}/{VOCABULARY}")
    prepare_single(spark, f"{sf_dir}/documents.parquet", out, "doc_id", tokenizer("char"),
                   part_tokens=SHARD_SIZE, reuse_vocabulary=True)
    return binshards.read_prepared(spark, out).select("split", "shard_idx", "block", text_of("tokens"))


# ---- windows and batches

_SQL_SHARDS = SQL_OFFSETS + f""",
lengths AS (
  SELECT split, (p // {SHARD_SIZE})::INTEGER AS shard_idx, count(*) AS length
  FROM stream GROUP BY ALL),
wins AS (SELECT *, greatest(length - {BLOCK}, 0) AS valid_starts FROM lengths)"""


def _lengths(spark, sf_dir):
    """Shards that hold tokens, from the totals of the splits."""
    totals = stats.split_totals(stats.source_stats(_counted(spark, sf_dir)))
    return pack.planned_lengths(totals, SHARD_SIZE).drop("file").filter("length > 0")


@query(f"WITH {_SQL_SHARDS} SELECT * FROM wins")
def shard_windows(spark, sf_dir):
    return windows.shard_windows(_lengths(spark, sf_dir), BLOCK)


# A block longer than the last shard of each split leaves some shards unusable.
@query(f"""
WITH {SQL_OFFSETS}, lengths AS (
  SELECT split, (p // {SHARD_SIZE})::INTEGER AS shard_idx, count(*) AS length
  FROM stream GROUP BY ALL)
SELECT *, length - 49000 AS valid_starts FROM lengths WHERE length > 49000""")
def valid_shards(spark, sf_dir):
    return windows.usable_shards(
        windows.shard_windows(_lengths(spark, sf_dir), 49_000))


@query(f"""
WITH {_SQL_SHARDS}
SELECT split, shard_idx, round(valid_starts / sum(valid_starts) OVER (PARTITION BY split), 9) AS weight
FROM wins WHERE valid_starts > 0""")
def shard_weights(spark, sf_dir):
    found = windows.shard_windows(_lengths(spark, sf_dir), BLOCK)
    return windows.shard_weights(found).select(
        "split", "shard_idx", F.round("weight", 9).alias("weight"))


@query(f"SELECT doc_id, length(text) AS n_tokens FROM documents WHERE length(text) >= {BLOCK} + 1")
def min_length_docs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.length("text").cast("long").alias("n_tokens"))
    return windows.long_enough(docs, BLOCK)


_SQL_ITEMS = """
chars AS (
  SELECT ch, (row_number() OVER (ORDER BY encode(ch)) - 1)::INTEGER AS id
  FROM (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM benchmark) WHERE ch <> ''),
items AS (
  SELECT item_id, list(c.id ORDER BY t.pos) AS ids
  FROM benchmark b, LATERAL (SELECT unnest(string_split(b.text, '')) AS ch,
                                    generate_subscripts(string_split(b.text, ''), 1) AS pos) t
  JOIN chars c ON c.ch = t.ch GROUP BY item_id)"""


@query(f"""
WITH {_SQL_ITEMS}
SELECT item_id, start, array_to_string(ids[start + 1:start + {BLOCK}], ' ') AS x,
       array_to_string(ids[start + 2:start + {BLOCK + 1}], ' ') AS y
FROM (SELECT item_id, ids, unnest(range(len(ids) - {BLOCK}))::INTEGER AS start
      FROM items WHERE len(ids) > {BLOCK})""")
def sliding_windows(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark")
    chars = char_vocab.characters(char_vocab.learn(items))
    encoded = items.select("item_id", char_vocab.encode(F.col("text"), chars).alias("ids"))
    return windows.sliding_windows(encoded, BLOCK).select(
        "item_id", "start", text_of("x"), text_of("y"))


@query(f"""
WITH {SQL_ENCODED}, s AS (
  SELECT doc_id, ids, floor({unit_sql("'7:' || doc_id")} * (len(ids) - {BLOCK}))::INTEGER AS start
  FROM encoded WHERE len(ids) >= {BLOCK + 1})
SELECT doc_id, start, array_to_string(ids[start + 1:start + {BLOCK}], ' ') AS x,
       array_to_string(ids[start + 2:start + {BLOCK + 1}], ' ') AS y FROM s""")
def doc_random_window(spark, sf_dir):
    encoded, _ = char_encoded(spark, sf_dir)
    return windows.document_window(encoded, "doc_id", BLOCK, seed=7).select(
        "doc_id", "start", text_of("x"), text_of("y"))


BATCHES, BATCH, PER_SHARD, SEED = 40, 8, 4, 11
FOLDER_SHARDS = 4

_SQL_PLAN = _SQL_SHARDS + f""",
line AS (
  SELECT shard_idx, valid_starts AS v,
         sum(valid_starts) OVER (ORDER BY shard_idx) - valid_starts AS lo
  FROM wins WHERE split = 'train' AND valid_starts > 0),
visits AS (
  SELECT i AS visit, floor({unit_sql(f"'{SEED}:shard:' || i")}
                           * (SELECT sum(v) FROM line)) AS point
  FROM range({BATCHES // PER_SHARD}) t(i)),
chosen AS (
  SELECT visit * {PER_SHARD} + k AS batch_idx, shard_idx, v
  FROM visits JOIN line ON point >= lo AND point < lo + v, range({PER_SHARD}) r(k)),
drawn AS (
  SELECT batch_idx, shard_idx, v, list_transform(range({BATCH}), lambda i:
    floor({unit_sql(f"'{SEED}:start:' || batch_idx || ':' || i")}
          * (v - {BATCH} + i + 1))::BIGINT) AS u
  FROM chosen),
starts AS (
  SELECT batch_idx, shard_idx, list_reduce(
    list_transform(range({BATCH}), lambda i: [u[i + 1], v - {BATCH} + i]),
    lambda acc, c: list_append(acc, CASE WHEN list_contains(acc, c[1]) THEN c[2] ELSE c[1] END),
    []::BIGINT[]) AS s
  FROM drawn),
plan AS (
  SELECT batch_idx, shard_idx, unnest(s) AS start, (generate_subscripts(s, 1) - 1)::INTEGER AS slot
  FROM starts)"""


def _plan(spark, sf_dir):
    usable = windows.shard_windows(_lengths(spark, sf_dir), BLOCK)
    return windows.batch_plan(stage(usable.filter("split = 'train'"), "lengths"),
                              BATCHES, BATCH, SEED, PER_SHARD)


@query(f"WITH {_SQL_PLAN} SELECT batch_idx, slot, shard_idx, start FROM plan")
def batch_plan(spark, sf_dir):
    return _plan(spark, sf_dir).select("batch_idx", "slot", "shard_idx", "start")


@query(f"""
WITH {_SQL_PLAN}, toks AS (
  SELECT batch_idx, slot, plan.shard_idx, start, list(tok ORDER BY p) AS w
  FROM plan JOIN stream ON split = 'train'
   AND p // {SHARD_SIZE} = plan.shard_idx
   AND p BETWEEN plan.shard_idx * {SHARD_SIZE} + start
             AND plan.shard_idx * {SHARD_SIZE} + start + {BLOCK}
  GROUP BY ALL)
SELECT batch_idx, slot, shard_idx, start, array_to_string(w[1:{BLOCK}], ' ') AS x,
       array_to_string(w[2:{BLOCK + 1}], ' ') AS y FROM toks""")
def batch_windows(spark, sf_dir):
    path = new_path(spark, "shards")
    pack.write_shards(packed(spark, sf_dir), path, FOLDER_SHARDS)
    plan = stage(_plan(spark, sf_dir), "plan")
    found = windows.batch_windows(plan, spark.read.parquet(path), BLOCK, folder_shards=FOLDER_SHARDS)
    return found.select("batch_idx", "slot", "shard_idx", "start", text_of("x"), text_of("y"))


@query(f"""
WITH {SQL_ENCODED}, pool AS (
  SELECT doc_id, ids, row_number() OVER (ORDER BY substr(sha256(doc_id::VARCHAR), 1, 4), doc_id) - 1 AS doc_no
  FROM encoded WHERE len(ids) >= {BLOCK + 1}),
draws AS (
  SELECT slot, floor({unit_sql("'5:doc:' || slot")} * (SELECT count(*) FROM pool))::BIGINT AS doc_no,
         {unit_sql("'5:start:' || slot")} AS u
  FROM range(64) t(slot)),
hit AS (
  SELECT slot, doc_id, ids, floor(u * (len(ids) - {BLOCK}))::INTEGER AS start
  FROM draws JOIN pool USING (doc_no))
SELECT slot, doc_id, start, array_to_string(ids[start + 1:start + {BLOCK}], ' ') AS x,
       array_to_string(ids[start + 2:start + {BLOCK + 1}], ' ') AS y FROM hit""")
def uniform_batch(spark, sf_dir):
    encoded, _ = char_encoded(spark, sf_dir)
    return windows.uniform_batch(encoded, "doc_id", BLOCK, batch=64, seed=5).select(
        "slot", "doc_id", "start", text_of("x"), text_of("y"))
