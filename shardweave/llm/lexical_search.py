"""Ranked lexical search of a set of queries over all documents.

Documents are read once into postings of the queries' terms, which give the corpus counts.
Then every block of documents is ranked for every query: bitmap unions leave the documents
that hold a term able to reach the ranking, these are grouped by the mask of the query terms
they hold, and the masks are evaluated by descending maximum score, until no mask left can
beat the k-th result. A task carries its best results from block to block, so later blocks
have few masks to evaluate, and hands on k rows for each query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shardweave.llm.flat import flatten, ranges, slices
from shardweave.llm.rowkeys import lower_ascii
from shardweave.staging import drop_stage, stage

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: (query, term) pairs that one pass over the documents takes; more queries take more passes.
BLOCK_PAIRS = 200_000
CHUNK = 64  # documents evaluated before the bound is looked at again
NO_ID = np.iinfo(np.int64).max

#: Bytes of terms, A-Z as a-z; all others as spaces.
_TERM_BYTES = np.full(256, 0x20, np.uint8)
for _first, _last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    _TERM_BYTES[_first:_last + 1] = np.arange(_first, _last + 1)
_TERM_BYTES[0x41:0x5B] = np.arange(0x61, 0x7B)


def postings_of(texts: pa.Array, vocabulary: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """First row, terms of each row with repeats, and rows, vocabulary places and counts of postings, slice by slice."""
    data, offsets = flatten(texts)
    for first, last, part, at in slices(data, offsets):
        plain = _TERM_BYTES[part]
        rows = pa.LargeStringArray.from_buffers(last - first, pa.py_buffer(np.ascontiguousarray(at, np.int64)),
                                                pa.py_buffer(plain))
        words = pc.ascii_split_whitespace(rows)
        owner = np.repeat(np.arange(last - first), np.diff(np.asarray(words.offsets)))
        flat = words.flatten()
        real = np.asarray(pc.binary_length(flat)) > 0
        lengths = np.bincount(owner[real], minlength=last - first)
        place = pc.fill_null(pc.index_in(flat, value_set=vocabulary), -1).to_numpy(zero_copy_only=False)
        known = place >= 0
        key, count = np.unique(owner[known] * len(vocabulary) + place[known], return_counts=True)
        size = max(len(vocabulary), 1)
        yield first, lengths, key // size, key % size, count


def _index(docs: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, n, terms, counts) of documents with at least one term of any kind."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())),
                        ("counts", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(terms, pa.large_string())
        for batch in batches:
            for first, lengths, row, place, count in postings_of(batch.column(1), vocabulary):
                has = np.flatnonzero(lengths)
                bounds = np.searchsorted(row, np.append(has, len(lengths)))
                lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(v, pa.int32()))
                         for v in (place, count)]
                ids = batch.column(0).slice(first, len(lengths)).take(pa.array(has))
                yield pa.record_batch([ids, pa.array(lengths[has], pa.int64()), *lists], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
                       ).mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>")


class Best:
    """The k best (score, doc_id) of one query; equal scores by doc_id, null ones last."""

    def __init__(self, k: int):
        self.k = k
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    @property
    def floor(self) -> int:
        """A score that a document must reach to enter."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        take = scores >= self.floor
        scores = np.concatenate((self.scores, scores[take]))
        ids, null = np.concatenate((self.ids, ids[take])), np.concatenate((self.null, null[take]))
        order = np.lexsort((ids, null, -scores))[:self.k]
        self.scores, self.ids, self.null = scores[order], ids[order], null[order]


class Block:
    """Postings of some documents, with what each adds to a score."""

    def __init__(self, lengths: np.ndarray, bounds: np.ndarray, terms: np.ndarray, counts: np.ndarray,
                 weights: np.ndarray, documents: int, total: int):
        if len(lengths) and int(lengths.max()) * 90 * documents >= 2**63:
            m = np.array([10 + 90 * int(n) * documents // total for n in lengths], np.int64)
        else:
            m = 10 + 90 * lengths * documents // max(total, 1)
        owner = np.repeat(np.arange(len(lengths)), np.diff(bounds))
        self.bounds, self.terms = bounds, terms
        self.adds = weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 8 * m[owner]))
        order = np.argsort(terms, kind="stable")
        self.by_term = owner[order]
        firsts = np.flatnonzero(np.append(True, np.diff(terms[order]) != 0)) if len(terms) else np.zeros(0, np.int64)
        self.present = terms[order][firsts]
        self.term_bounds = np.append(firsts, len(terms))
        self.caps = np.maximum.reduceat(self.adds[order], firsts) if len(terms) else np.zeros(0, np.int64)
        self.wanted = np.zeros(len(weights), bool)

    def rank(self, query: np.ndarray, best: Best, ids: np.ndarray, null: np.ndarray) -> int:
        """Enter the documents of this block that belong in ``best``; the number evaluated."""
        at = np.searchsorted(self.present, query)
        at = at[(at < len(self.present)) & (self.present[np.minimum(at, len(self.present) - 1)] == query)] \
            if len(self.present) else at[:0]
        at = at[self.caps[at] > 0]
        at = at[np.argsort(self.caps[at], kind="stable")]
        caps = self.caps[at]
        # Documents that hold only the first terms, of low caps, cannot reach the ranking.
        low = int(np.searchsorted(np.cumsum(caps), best.floor))
        rows = len(self.bounds) - 1
        reaches = np.zeros(rows, bool)
        for i in at[low:]:
            reaches[self.by_term[self.term_bounds[i]:self.term_bounds[i + 1]]] = True
        candidates = np.flatnonzero(reaches)
        if not len(candidates):
            return 0
        masks = np.zeros((rows, -(-len(at) // 8)), np.uint8)
        for slot, i in enumerate(at):
            masks[self.by_term[self.term_bounds[i]:self.term_bounds[i + 1]], slot >> 3] |= np.uint8(1 << (slot & 7))
        masks = masks[candidates]
        distinct, group = np.unique(masks.view(f"V{masks.shape[1]}").ravel(), return_inverse=True)
        bits = np.unpackbits(distinct.view(np.uint8).reshape(len(distinct), -1), axis=1, bitorder="little")
        # Sums of integers below 2**53: exact in doubles.
        most = (bits[:, :len(at)].astype(np.float64) @ caps.astype(np.float64)).astype(np.int64)
        order = np.argsort(-most[group], kind="stable")
        limits = most[group][order]
        self.wanted[query] = True
        done = 0
        while done < len(order) and limits[done] >= best.floor:
            picked = candidates[order[done:done + CHUNK]]
            lengths = self.bounds[picked + 1] - self.bounds[picked]
            places = ranges(self.bounds[picked], lengths)
            adds = np.where(self.wanted[self.terms[places]], self.adds[places], 0)
            scores = np.add.reduceat(adds, np.append(0, np.cumsum(lengths)[:-1]))
            best.add(scores, ids[picked], null[picked])
            done += len(picked)
        self.wanted[query] = False
        return done


def _rank(index: DataFrame, queries: list[np.ndarray], weights: np.ndarray, documents: int, total: int,
          k: int) -> DataFrame:
    schema = pa.schema([("query", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries]
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = pc.fill_null(batch.column(0), NO_ID).to_numpy()
            null = np.asarray(pc.is_null(batch.column(0)))
            terms = batch.column(2)
            bounds = np.asarray(terms.offsets, dtype=np.int64)
            block = Block(batch.column(1).to_numpy(), bounds - bounds[0], terms.flatten().to_numpy(),
                          batch.column(3).flatten().to_numpy().astype(np.int64), weights, documents, total)
            for query, found in zip(queries, best):
                block.rank(query, found, ids, null)
        number = np.repeat(np.arange(len(best)), [len(b.ids) for b in best])
        if len(number):
            yield pa.record_batch([
                pa.array(number, pa.int32()),
                pa.array(np.concatenate([b.ids for b in best]), mask=np.concatenate([b.null for b in best])),
                pa.array(np.concatenate([b.scores for b in best]))], schema=schema)

    return index.mapInArrow(run, "query int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents of highest score for each item.

    Terms are maximal runs of ASCII letters, digits and non-ASCII characters, only A-Z
    lower-cased. Only scores above 0 are listed; equal ones by ascending doc_id, a null one last.

    Rows that share an item_id (null too) are one item with the terms of all of them; an item
    without terms has no rows. Each row of ``docs`` is a document, repeated rows too, so a doc_id
    of several rows can be listed several times. Null and empty texts hold no term and do
    not count as documents. Without items or documents there are no rows. Columns other than
    doc_id, text and item_id are not read. doc_id is an integer.

    Items are ranked ``block_pairs`` (item, term) pairs at a time, each block in its own pass.
    """
    spark = docs.sparkSession
    words = F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(TERM), 0)
    pairs = stage(items.select("item_id", F.explode(F.array_distinct(words)).alias("term")).distinct(), "item-terms")
    passes = max(1, -(-pairs.count() // block_pairs))
    share = F.pmod(F.xxhash64("item_id"), F.lit(passes))
    found = None
    for number in range(passes):
        rows = pairs.filter(share == number).collect()
        ids = sorted({r.item_id for r in rows}, key=lambda i: (i is None, i))
        terms = sorted({r.term for r in rows})
        places = {t: i for i, t in enumerate(terms)}
        of_item = {i: [] for i in ids}
        for r in rows:
            of_item[r.item_id].append(places[r.term])
        index = stage(_index(docs, terms), "postings")
        counts = {r.term: r for r in index.select(
            "n", F.explode(F.concat(F.array(F.lit(-1)), "terms")).alias("term")).groupBy("term").agg(
                F.count(F.lit(1)).alias("df"), F.sum("n").alias("total")).collect()}  # a row per term
        documents = counts[-1].df if -1 in counts else 0
        total = counts[-1].total if -1 in counts else 0
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * counts[i].df + 1))) if i in counts
                            else 0 for i in range(len(terms))], np.int64)
        ranked = _rank(index, [np.array(sorted(of_item[i]), np.int64) for i in ids], weights, documents, total, k)
        names = spark.createDataFrame(list(enumerate(ids)), f"query int, item_id {items.schema['item_id'].dataType.simpleString()}")
        place = F.row_number().over(Window.partitionBy("query").orderBy(
            F.desc("score"), F.col("doc_id").asc_nulls_last()))
        best = stage(ranked.withColumn("rank", place).filter(F.col("rank") <= k).join(
            F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score"), "ranked")
        drop_stage(index)
        found = best if found is None else found.unionByName(best)
    return found
