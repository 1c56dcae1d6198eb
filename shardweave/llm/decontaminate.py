"""Benchmark decontamination: a broadcast hash table of benchmark word windows.

Training documents are cut into words once; every window of ten words is hashed from the
hashes of its words, looked up in the broadcast table and verified word by word. A row at
position -1 carries the counts of its document, so hits need no join back to the documents.

A benchmark of too many windows to broadcast is joined by hashes alone, without any text; the
windows found are then verified where the words of their documents are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardweave.llm.joins import BROADCAST_ROWS, bounded, is_bounded
from shardweave.llm.rowkeys import lower_ascii, row_key
from shardweave.staging import stage

WINDOW = 10
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased words; null has none."""
    cut = F.filter(F.split(lower_ascii(text), GAP), lambda w: w != "")
    return F.coalesce(cut, F.array().cast("array<string>"))


def _window_key(hashes: Column, at: Column, width: int) -> Column:
    return F.xxhash64(F.lit(width), *[hashes[at + i] for i in range(width)])


def windows(benchmark: DataFrame) -> DataFrame:
    """(key, gram, width, item) for each distinct window of each item."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"),
                             words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    cut = items.withColumn("width", F.least(F.size("words"), F.lit(WINDOW))).select(
        "item", "width", "words",
        F.explode(F.sequence(F.lit(1), F.size("words") - F.col("width") + 1)).alias("at"))
    grams = cut.select("item", "width", F.expr("slice(words, at, width)").alias("gram")).distinct()
    hashes = F.transform("gram", lambda w: F.xxhash64(w))
    key = F.lit(None).cast("long")
    for width in range(1, WINDOW + 1):
        key = F.when(F.col("width") == width, _window_key(F.col("h"), F.lit(0), width)).otherwise(key)
    return grams.withColumn("h", hashes).select(key.alias("key"), "gram", "width", "item")


def _covered(spans: Column) -> Column:
    """Positions inside any of the sorted spans (at, w)."""
    return F.aggregate(
        spans, F.struct(F.lit(0).alias("to"), F.lit(0).alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["to"], s["at"] + s["w"]).alias("to"),
            (acc["n"] + F.greatest(F.lit(0), s["at"] + s["w"] - F.greatest(acc["to"], s["at"])))
            .alias("n")))["n"]


def _result(rows: DataFrame) -> DataFrame:
    """The columns of ``contamination`` from sorted ``spans`` and ``items``."""
    return rows.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"),
        _covered(F.col("spans")).cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"), "_key",
        *[c for c in rows.columns if c == "copies"])


def _found_by_hashes(cut: DataFrame, probe: DataFrame, grams: DataFrame) -> DataFrame:
    """``contamination`` by two shuffled joins: windows by hash, then documents by key."""
    alike = probe.join(
        grams, (probe["key"] == grams["key"]) & (F.col("w") == F.col("width")))
    # One document's windows are bounded by its words and the items that share them.
    per_key = stage(alike.groupBy("_key").agg(
        F.collect_set(F.struct("at", "w", "gram", "item")).alias("alike")), "alike")
    same = F.filter(F.col("alike"), lambda a: F.slice(F.col("words"), a["at"] + 1, a["w"]) == a["gram"])
    rows = cut.select("doc_id", "_key", "n_words", "words").join(per_key, "_key", "left").select(
        "doc_id", "_key", "n_words", F.coalesce(same, F.array().cast(per_key.schema["alike"].dataType)).alias("same"))
    return _result(rows.select(
        "doc_id", "_key", "n_words",
        F.array_sort(F.array_distinct(F.transform("same", lambda a: F.struct(a["at"].alias("at"), a["w"].alias("w")))))
        .alias("spans"),
        F.array_sort(F.array_distinct(F.filter(F.transform("same", lambda a: a["item"]), lambda i: i.isNotNull())))
        .alias("items")))


def contamination(docs: DataFrame, benchmark: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, _key.

    A document without text has no words and no hits; an item without words has no windows.
    Rows that share doc_id and text get one result each; rows of one item_id count as one
    item with the windows of all. Items without an item_id hit words but are not counted.
    An empty benchmark hits nothing. Extra columns are ignored. ``broadcast_rows`` windows are
    broadcast at most; it decides the plan, not the result.
    """
    grams = stage(windows(benchmark), "windows")
    widths = sorted(r.width for r in grams.select("width").distinct().collect())  # at most ten
    cut = docs.select(F.col("doc_id"), row_key().alias("_key"), words(F.col("text")).alias("words"))
    cut = cut.withColumn("n_words", F.size("words")).withColumn(
        "h", F.transform("words", lambda w: F.xxhash64(w)))
    rows = cut.select("doc_id", "_key", "n_words", "words", "h", F.explode(
        F.sequence(F.lit(-1), F.col("n_words") - 1)).alias("at"))
    looked_up = None
    for width in [0, *widths]:
        here = (F.col("at") == -1) if width == 0 else (
            (F.col("at") >= 0) & (F.col("at") + width <= F.col("n_words")))
        key = F.lit(0).cast("long") if width == 0 else _window_key(F.col("h"), F.col("at"), width)
        part = F.when(here, F.struct(F.lit(width).alias("w"), key.alias("k")))
        looked_up = [part] if looked_up is None else [*looked_up, part]
    if len(widths) <= 1:
        probe = rows.withColumn("p", F.coalesce(*looked_up))
    else:
        probe = rows.withColumn("p", F.explode(F.filter(F.array(*looked_up), lambda x: x.isNotNull())))
    probe = probe.filter("p is not null")
    if not is_bounded(grams, broadcast_rows):
        return _found_by_hashes(cut, probe.filter("at >= 0").select(
            "_key", "at", F.col("p.w").alias("w"), F.col("p.k").alias("key")), grams)
    marker = docs.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("key"), F.array().cast("array<string>").alias("gram"),
        F.lit(0).alias("width"), F.lit(None).cast("string").alias("item"))
    table = F.broadcast(stage(grams.unionByName(marker), "windows"))
    probe = probe.select(
        "doc_id", "_key", "n_words", "words", "at", F.col("p.w").alias("w"), F.col("p.k").alias("key"))
    hits = probe.join(table, "key").filter(
        (F.col("w") == F.col("width"))
        & ((F.col("w") == 0) | (F.expr("slice(words, greatest(at, 0) + 1, w)") == F.col("gram"))))
    # One document's hits are bounded by its words; copies of a row fall together.
    per_doc = hits.groupBy("doc_id", "_key", "n_words").agg(
        F.count(F.when(F.col("w") == 0, 1)).alias("copies"),
        F.array_sort(F.collect_set(F.when(F.col("w") > 0, F.struct("at", "w")))).alias("spans"),
        F.array_sort(F.collect_set("item")).alias("items"))
    found = _result(per_doc)
    return found.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop(
        "_i", "copies")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without any benchmark window, columns as they are."""
    bad = stage(contamination(docs, benchmark).filter("contaminated").select(F.col("_key").alias("__row_key")).distinct(), "bad")
    return docs.join(bounded(bad), row_key() == F.col("__row_key"), "left_anti")
