"""Exact top-k by inner product with the threshold algorithm.

Vectors are dealt into blocks of bounded size; each block keeps one list per dimension, sorted by
component. A query reads all lists from its better end in step, scores each vector when it
first appears, and stops when the best score that an unseen vector could still have is below
its k-th score. The k best of each block are merged by a window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardweave.staging import stage

BLOCK_VECTORS, BLOCK_QUERIES = 8192, 512


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def threshold_search(vectors: np.ndarray, ids: np.ndarray, lists: np.ndarray, query: np.ndarray,
                     query_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best vectors other than the query itself, which is the row of its id
    and vector.

    ``lists`` has the order of the vectors in each dimension, ascending.
    """
    n, dims = vectors.shape
    used = np.flatnonzero(query)
    down = query[used] > 0
    seen = np.zeros(n, bool)
    own = ids == query_id
    own[own] = (vectors[own] == query).all(axis=1)
    best, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    depth, step = 0, 32
    while depth < n:
        to = min(n, depth + step)
        rows = np.where(down[:, None], lists[used, n - to:n - depth][:, ::-1], lists[used, depth:to]) \
            if len(used) else np.arange(depth, to)[None, :]
        fresh = np.zeros(n, bool)
        fresh[rows.ravel()] = True
        fresh &= ~seen
        seen |= fresh
        fresh &= ~own
        new = np.flatnonzero(fresh)
        best = np.concatenate((best, new))
        scores = np.concatenate((scores, vectors[new] @ query))
        top = _best(scores, ids[best], k)
        best, scores = best[top], scores[top]
        bound = int((query[used] * vectors[rows[:, -1], used]).sum()) if len(used) else 0
        if len(best) == k and scores[-1] > bound:
            break
        depth, step = to, step * 2
    return ids[best], scores


def _search(k: int):
    def run(table: pa.Table) -> pa.Table:
        if not len(table):
            return pa.table({"query_key": pa.array([], pa.string()),
                             **{c: pa.array([], pa.int64()) for c in ("query_id", "vec_id", "score")}})
        ids = table["vec_id"].to_numpy()
        asks = table["is_query"].to_numpy(zero_copy_only=False)
        flat = table["v"].combine_chunks().flatten().to_numpy()
        all_ = flat.reshape(len(ids), -1)
        vectors, queries = all_[~asks], all_[asks]
        out, keys = [], []
        if len(vectors) and len(queries):
            lists = np.argsort(vectors.T, axis=1, kind="stable")
            names = table["query_key"].filter(table["is_query"]).to_pylist()
            for query, query_id, name in zip(queries, ids[asks].tolist(), names):
                found, scores = threshold_search(vectors, ids[~asks], lists, query, query_id, k)
                out.append((np.full(len(found), query_id), found, scores))
                keys += [name] * len(found)
        columns = [np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(3)]
        return pa.table({"query_key": pa.array(keys, pa.string()),
                         **dict(zip(("query_id", "vec_id", "score"), map(pa.array, columns)))})
    return run


def top_k(embeddings: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """query_id, rank, vec_id, score, query_key: the k best candidates of each query.

    Components x are taken as floor(1024 * x). Queries are the rows whose vec_id ``every``
    divides; candidates are all rows but the query's own. Ties go to the smaller vec_id.
    Vectors that are null or empty, or hold a null or a component that is not finite, take no
    part, nor do rows without a vec_id. Rows equal in id and vector count once; rows that share
    only the id are queries of their own, told apart by ``query_key`` (a digest of the vector), and
    candidates of each other. Vectors are compared with those of their own length. Scores must fit
    63 bits. Extra columns are ignored, whatever their names; an empty table has no queries.
    """
    x = F.col("v0")
    good = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                             F.col("embedding").cast("array<double>").alias("v0")).filter(
        F.col("vec_id").isNotNull() & (F.size("v0") > 0)
        & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    good = stage(good.select("vec_id", F.transform(x, lambda c: F.floor(c * 1024).cast("long")).alias("v"))
                 .distinct().withColumn("dims", F.size("v")), "vectors")
    is_query = F.col("vec_id") % every == 0
    n = good.count()
    blocks, lots = max(1, -(-n // BLOCK_VECTORS)), max(1, -(-good.filter(is_query).count() // BLOCK_QUERIES))
    block = F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks))
    lot = F.pmod(F.xxhash64("v", "vec_id"), F.lit(lots))
    every_lot = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lots - 1).cast("long")))
    every_block = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    sides = good.select("dims", block.alias("block"), every_lot.alias("lot"), F.lit(False).alias("is_query"),
                        F.lit(None).cast("string").alias("query_key"), "vec_id", "v").unionByName(good.filter(is_query).select(
                            "dims", every_block.alias("block"), lot.alias("lot"), F.lit(True).alias("is_query"),
                            F.md5(F.array_join("v", ",").cast("binary")).alias("query_key"), "vec_id", "v"))
    found = sides.groupBy("dims", "block", "lot").applyInArrow(
        _search(k), "query_key string, query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score", "query_key")
