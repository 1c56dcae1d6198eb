"""Queries on scanning, merging, cutting and routing documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from shardweave.functions.text import doc_key, stripped
from shardweave.operators import documents as ops
from shardweave.operators.joined_text import joined_parts
from shardweave.operators.order import running_total
from shardweave.plans.corpus import (
    SQL_DOCS, SQL_ROUTED, SQL_SOURCES, VAL_RATIO, indexed_documents, routed_documents)
from shardweave.plans.prepare import merged_documents
from shardweave.plans.registry import query, table
from shardweave.sources import config as cfg
from shardweave.sources import scan
from shardweave.staging import new_path, stage

# The four text tables as one configured corpus.
_TABLES = ["documents", "conversations", "pages", "benchmark"]


def _entries(sf_dir):
    return [{"path": f"{sf_dir}/{t}.parquet", "split": "train", "id": t} for t in _TABLES]


@query("""
SELECT 'documents' AS source_id, 0 AS src_pos, lang, url, role, text FROM (
  SELECT lang, NULL AS url, NULL AS role, text FROM documents)
UNION ALL SELECT 'conversations', 1, NULL, NULL, role, text FROM conversations
UNION ALL SELECT 'pages', 2, NULL, url, NULL, NULL FROM pages
UNION ALL SELECT 'benchmark', 3, NULL, NULL, NULL, text FROM benchmark""")
def scan_sources(spark, sf_dir):
    return scan.scan_sources(spark, _entries(sf_dir)).select(
        "source_id", "src_pos", "lang", "url", "role", "text")


@query("SELECT text FROM documents")
def load_texts(spark, sf_dir):
    return scan.read_texts(spark, f"{sf_dir}/documents.parquet")


@query("""
WITH whole AS (
  SELECT source AS source_id, string_agg(text, chr(10) ORDER BY doc_id) AS t
  FROM documents GROUP BY source)
SELECT source_id, part, substr(t, part * 65536 + 1, 65536) AS text
FROM (SELECT source_id, t, unnest(range((length(t) + 65535) // 65536)) AS part FROM whole)""")
def concat_text_by_source(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        F.col("source").alias("source_id"), "doc_id", "text")
    return joined_parts(docs, "doc_id")


@query("""
SELECT source_id, (row_number() OVER (PARTITION BY source_id ORDER BY row_id) - 1) AS doc_idx,
       row_id
FROM (SELECT 'documents' AS source_id, doc_id AS row_id FROM documents
      UNION ALL SELECT 'pages', page_id FROM pages
      UNION ALL SELECT 'benchmark', item_id FROM benchmark
      UNION ALL SELECT 'conversations', conv_id * 1000 + turn FROM conversations)""")
def file_order_index(spark, sf_dir):
    turn = F.col("conv_id") * 1000 + F.col("turn")
    return scan.numbered_sources(spark, _entries(sf_dir)).select(
        "source_id", "doc_idx", F.coalesce("doc_id", "page_id", "item_id", turn).alias("row_id"))


_CANDIDATES = """
SELECT 'documents' AS source_id, doc_id AS row_id, text AS t, NULL AS c, NULL AS d FROM documents
UNION ALL SELECT 'pages', page_id, NULL, html, NULL FROM pages
UNION ALL SELECT 'benchmark', item_id, NULL, NULL, text FROM benchmark
UNION ALL SELECT 'conversations', conv_id * 1000 + turn,
                 CASE WHEN role = 'user' THEN repeat(' ', turn::INTEGER) || chr(10) END,
                 NULL, chr(10) || text || ' ' FROM conversations"""


@query(f"""
SELECT source_id, row_id,
       coalesce(nullif(trim(t, ' ' || chr(10)), ''), nullif(trim(c, ' ' || chr(10)), ''),
                nullif(trim(d, ' ' || chr(10)), '')) AS text
FROM ({_CANDIDATES})""")
def extract_text(spark, sf_dir):
    read = lambda name: table(spark, sf_dir, name)
    talk = read("conversations")
    blank = F.concat(F.repeat(F.lit(" "), F.col("turn").cast("int")), F.lit("\n"))
    rows = scan.concat([
        read("documents").select(F.lit("documents").alias("source_id"),
                                 F.col("doc_id").alias("row_id"), "text"),
        read("pages").select(F.lit("pages").alias("source_id"),
                             F.col("page_id").alias("row_id"), F.col("html").alias("content")),
        read("benchmark").select(F.lit("benchmark").alias("source_id"),
                                 F.col("item_id").alias("row_id"), F.col("text").alias("document")),
        talk.select(F.lit("conversations").alias("source_id"),
                    (F.col("conv_id") * 1000 + F.col("turn")).alias("row_id"),
                    F.when(F.col("role") == "user", blank).alias("text"),
                    F.concat(F.lit("\n"), "text", F.lit(" ")).alias("document")),
    ])
    return ops.extract(rows)


@query("""
SELECT doc_idx, text FROM (
  SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS doc_idx,
         nullif(trim(CASE WHEN role = 'user' THEN ' ' || chr(10) ELSE text END,
                     ' ' || chr(10)), '') AS text
  FROM conversations) WHERE text IS NOT NULL""")
def drop_empty(spark, sf_dir):
    talk = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn",
        F.when(F.col("role") == "user", " \n").otherwise(F.col("text")).alias("text"))
    return ops.extract(running_total(talk, ["conv_id", "turn"], out="doc_idx")).select(
        "doc_idx", "text")


def _derived_config(spark, sf_dir):
    """A config table grown from the data: one entry per (source, language)."""
    groups = table(spark, sf_dir, "documents").groupBy("source", "lang").agg(
        F.count("*").alias("n"))
    n = F.col("n")
    return groups.select(
        F.when(n % 3 == 0, F.concat(F.lit("  "), "source", F.lit("/"), "lang", F.lit(" ")))
        .when(n % 3 == 1, F.lit(" ")).alias("id"),
        F.when(n % 5 != 4, F.col("source")).alias("path"),
        F.when(n % 2 == 0, F.col("lang")).otherwise("").alias("name"),
        F.when(n % 7 != 6, F.col("lang")).alias("split"),
        F.when(n % 4 != 0, n - 10).alias("max_docs"), "source", "lang")


_SQL_CONFIG = """
config AS (
  SELECT CASE WHEN n % 3 = 0 THEN '  ' || source || '/' || lang || ' '
              WHEN n % 3 = 1 THEN ' ' END AS id,
         CASE WHEN n % 5 <> 4 THEN source END AS path,
         CASE WHEN n % 2 = 0 THEN lang ELSE '' END AS name,
         CASE WHEN n % 7 <> 6 THEN lang END AS split,
         CASE WHEN n % 4 <> 0 THEN n - 10 END AS max_docs, source, lang
  FROM (SELECT source, lang, count(*) AS n FROM documents GROUP BY source, lang))"""


@query(f"""
WITH {_SQL_CONFIG}
SELECT source, lang, coalesce(nullif(trim(id), ''),
         path || CASE WHEN name <> '' THEN ':' || name ELSE '' END || ':' || split) AS source_id
FROM config WHERE path IS NOT NULL AND split IS NOT NULL""")
def source_ids(spark, sf_dir):
    valid = _derived_config(spark, sf_dir).filter("path IS NOT NULL AND split IS NOT NULL")
    return cfg.with_source_id(valid).select("source", "lang", "source_id")


@query(f"""
WITH {_SQL_CONFIG}
SELECT * FROM (
  SELECT source || '/' || lang AS src_pos,
         CASE WHEN path IS NULL THEN 'path missing' WHEN split IS NULL THEN 'split missing'
              WHEN max_docs <= 0 THEN 'max_docs not positive' END AS reason
  FROM config) WHERE reason IS NOT NULL""")
def config_violations(spark, sf_dir):
    named = _derived_config(spark, sf_dir).withColumn(
        "src_pos", F.concat_ws("/", "source", "lang"))
    return cfg.violations(named)


@query(f"""
WITH {_SQL_CONFIG}
SELECT source, CASE WHEN count(*) = count(max_docs)
                    THEN sum(max_docs)::BIGINT END AS expected_total
FROM config GROUP BY source""")
def expected_total(spark, sf_dir):
    return _derived_config(spark, sf_dir).groupBy("source").agg(
        cfg.expected_total().alias("expected_total"))


def _quota_entries(spark, sf_dir):
    """Quotas derived from source sizes: some cut, some exceed, some are absent."""
    docs = table(spark, sf_dir, "documents")
    entries = cfg.config_from_column(docs, "source")  # checks how many there are
    sizes = {r.source: r.n for r in
             docs.groupBy("source").agg(F.count("*").alias("n")).collect()}
    for i, entry in enumerate(entries):
        quota = sizes[entry["path"]] * (5 + i % 10) // 12
        entry["max_docs"] = quota if i % 4 and quota else None
    return entries


_SQL_QUOTA = SQL_DOCS + """,
quotas AS (
  SELECT source_id, CASE WHEN src_pos % 4 <> 0 THEN nullif(n_docs * (5 + src_pos % 10) // 12, 0) END AS max_docs
  FROM sources),
kept AS (
  SELECT docs.* FROM docs JOIN quotas USING (source_id)
  WHERE max_docs IS NULL OR doc_idx < max_docs)"""


def _kept(spark, sf_dir):
    return ops.within_quota(indexed_documents(spark, sf_dir), _quota_entries(spark, sf_dir))


@query(f"WITH {_SQL_QUOTA} SELECT source_id, doc_idx, doc_id FROM kept")
def quota_filter(spark, sf_dir):
    return _kept(spark, sf_dir).select("source_id", "doc_idx", "doc_id")


#: Documents of one task that writes files, about 125 MB of text.
ROWS_PER_TASK = 50_000


def _in_ranges(df, least, key):
    """``df`` in ranges of ``key``, ``least`` of them or as many as its rows need."""
    return df.repartitionByRange(max(least, -(-df.count() // ROWS_PER_TASK)), key)


def _by_source(spark, sf_dir, files=6):
    """Documents as a folder of files for each source, doc_id rising from file to file."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return stage(_in_ranges(docs, files, "doc_id").sortWithinPartitions("source", "doc_id"),
                 "by-source", ["source"]).staged_at


@query(f"WITH {_SQL_QUOTA} SELECT source_id, doc_idx, doc_id FROM kept")
def quota_pruned(spark, sf_dir):
    root = _by_source(spark, sf_dir)
    entries = [{**e, "path": f"{root}/source={e['path']}", "split": ""} for e in _quota_entries(spark, sf_dir)]
    return scan.numbered_sources(spark, entries).select("source_id", "doc_idx", "doc_id")


@query("""
SELECT lang || '/' || split AS source_id, doc_idx, doc_id FROM (
  SELECT lang, split, doc_id, row_number() OVER (PARTITION BY lang, split ORDER BY doc_id) - 1 AS doc_idx
  FROM (SELECT *, CASE WHEN substr(sha256(doc_id::VARCHAR), 1, 1) < '4' THEN 'test' ELSE 'train' END AS split
        FROM documents))""")
def scan_splits(spark, sf_dir):
    split = F.when(F.substring(F.sha2(F.col("doc_id").cast("string"), 256), 1, 1) < "4", "test").otherwise("train")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("lang").alias("name"), split.alias("split"))
    root = stage(_in_ranges(docs, 4, "doc_id").sortWithinPartitions("name", "split", "doc_id"),
                 "by-split", ["name", "split"]).staged_at
    names = [r.name for r in docs.select("name").distinct().limit(cfg.MAX_SOURCES).collect()]
    entries = [{"path": root, "name": n, "split": s, "id": f"{n}/{s}"} for n in sorted(names) for s in ("test", "train")]
    return scan.numbered_sources(spark, entries).select("source_id", "doc_idx", "doc_id")


@query(f"""
WITH {_SQL_QUOTA}, benches AS (
  SELECT row_number() OVER (ORDER BY item_id) - 1 AS doc_idx, item_id, text FROM benchmark)
SELECT source_id, src_pos, doc_idx, doc_id::VARCHAR AS id, text FROM kept
UNION ALL SELECT 'benchmark', (SELECT count(*) FROM sources), doc_idx, item_id::VARCHAR, text FROM benches
WHERE doc_idx < 25""")
def prepare_merged(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "source")
    entries = [{**e, "split": ""} for e in _quota_entries(spark, sf_dir)]
    # Every other source as lines of JSON, in ranges so short that files have several.
    as_json = F.col("source").isin([e["path"] for e in entries[::2]])
    lined = docs.filter(as_json).withColumnRenamed("text", "content")
    root, lines = new_path(spark, "by-source"), new_path(spark, "json-sources")
    _in_ranges(docs.filter(~as_json), 6, "id").sortWithinPartitions("source", "id").write.partitionBy("source").parquet(root)
    _in_ranges(lined, 3, "id").sortWithinPartitions("source", "id").write.partitionBy("source").json(lines)
    for i, entry in enumerate(entries):
        entry["path"] = f"{root if i % 2 else lines}/source={entry['path']}"
        if i % 2 == 0:
            entry.update(format="json", schema="id long, content string", options={"rangeBytes": "20000"})
    bench = new_path(spark, "bench")
    table(spark, sf_dir, "benchmark").withColumnRenamed("item_id", "id").repartitionByRange(3, "id").sortWithinPartitions(
        "id").write.json(bench)
    entries.append({"path": bench, "split": "", "id": "benchmark", "format": "json", "max_docs": 25})
    return merged_documents(spark, entries)


@query(f"WITH {SQL_DOCS} SELECT source_id, src_pos, doc_idx, doc_id FROM docs")
def doc_index(spark, sf_dir):
    return indexed_documents(spark, sf_dir).select("source_id", "src_pos", "doc_idx", "doc_id")


@query(f"""
WITH {_SQL_QUOTA}
SELECT row_number() OVER (ORDER BY doc_idx, src_pos) - 1 AS rr_pos, source_id, doc_idx, doc_id
FROM kept""")
def round_robin(spark, sf_dir):
    # Indexing is itself a running total: written once, not worked out for each pass.
    kept = stage(_kept(spark, sf_dir).select("source_id", "src_pos", "doc_idx", "doc_id"), "kept")
    return ops.merge_position(kept).select("rr_pos", "source_id", "doc_idx", "doc_id")


@query("""
SELECT row_number() OVER (ORDER BY lang, doc_id DESC) - 1 AS position, doc_id FROM (
  SELECT lang, doc_id FROM documents)""")
def global_index(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", (-F.col("doc_id")).alias("k"))
    return running_total(docs, ["lang", "k"]).select("position", "doc_id")


@query(f"""
WITH {SQL_DOCS}
SELECT doc_id, source_id || ':' || CASE WHEN lang = 'en' THEN doc_idx ELSE doc_id END AS doc_key
FROM docs""")
def split_key(spark, sf_dir):
    own = F.when(F.col("lang") != "en", F.col("doc_id"))
    return indexed_documents(spark, sf_dir).select(
        "doc_id", doc_key(F.col("source_id"), own, F.col("doc_idx")).alias("doc_key"))


@query(f"WITH {SQL_ROUTED} SELECT doc_id, doc_key, split FROM routed")
def hash_split(spark, sf_dir):
    return routed_documents(spark, sf_dir).select("doc_id", "doc_key", "split")


@query("""
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) - 1
                         < floor((SELECT count(*) FROM documents) * 0.9)
                    THEN 'train' ELSE 'val' END AS split
FROM documents""")
def prefix_split(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return ops.route_prefix(running_total(docs, ["doc_id"]), 0.9, "position", docs.count()).select("doc_id", "split")


_SQL_SHUFFLED = """
shuffled AS (
  SELECT doc_id, row_number() OVER (ORDER BY sha256('42:' || doc_id), doc_id) - 1 AS position
  FROM documents)"""


def _shuffled(spark, sf_dir):
    return ops.shuffled_position(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@query(f"WITH {_SQL_SHUFFLED} SELECT position, doc_id FROM shuffled")
def seeded_shuffle(spark, sf_dir):
    return _shuffled(spark, sf_dir).select("position", "doc_id")


# The default ranges, scaled to the test tables; both samples overlap the rest.
_RANGES = {"test": (0, 40), "val": (40, 80), "train": (80, None),
           "train_100": (0, 400), "train_500": (0, 2000)}


@query(f"""
WITH {_SQL_SHUFFLED}, ranges(subset, lo, hi) AS (
  VALUES {", ".join(f"('{n}', {a}, {'NULL' if b is None else b}::BIGINT)"
                    for n, (a, b) in _RANGES.items())})
SELECT subset, doc_id, position FROM shuffled JOIN ranges
ON position >= lo AND (hi IS NULL OR position < hi)""")
def range_subsets(spark, sf_dir):
    return ops.named_subsets(_shuffled(spark, sf_dir), "position", _RANGES).select(
        "subset", "doc_id", "position")


@query("""
SELECT 0 AS src_pos, doc_id AS row_id, text FROM documents
UNION ALL SELECT 1, conv_id * 1000 + turn, text FROM conversations
UNION ALL SELECT 2, item_id, text FROM benchmark""")
def concat_sources(spark, sf_dir):
    return scan.concat([
        table(spark, sf_dir, "documents").select(
            F.lit(0).alias("src_pos"), F.col("doc_id").alias("row_id"), "text"),
        table(spark, sf_dir, "conversations").select(
            F.lit(1).alias("src_pos"),
            (F.col("conv_id") * 1000 + F.col("turn")).alias("row_id"), "text"),
        table(spark, sf_dir, "benchmark").select(
            F.lit(2).alias("src_pos"), F.col("item_id").alias("row_id"), "text"),
    ])
