"""Language of documents as a mixture, fitted per document by expectation-maximisation.

Languages are distributions over hashed byte trigrams, counted over all training documents. A
document's proportions start even; a language leaves the set when the likelihood without it,
charged half the log of the document's grams per language, is better.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardweave.llm.flat import flatten, slices

BUCKETS = 1 << 16
ROUNDS, SMOOTH, MAX_LANGS = 12, 0.5, 500
LETTER = regex.compile(r"\p{L}")
_LOW = np.arange(256)
_LOW[65:91] = _LOW[97:123]


def _grams(part: np.ndarray) -> np.ndarray:
    c = _LOW[part].astype(np.uint32)
    if len(c) < 3:
        c = np.concatenate((c, np.full(3 - len(c), 32, np.uint32)))
    code = (c[:-2] << np.uint32(16)) | (c[1:-1] << np.uint32(8)) | c[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(16)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        data, offsets = flatten(batch.column("text"))
        for first, last, part, at in slices(data, offsets):
            for lang in sorted(set(langs[first:last].tolist())):
                n = np.zeros(BUCKETS, np.int64)
                for i in np.flatnonzero(langs[first:last] == lang):
                    n += np.bincount(_grams(part[at[i]:at[i + 1]]), minlength=BUCKETS)
                gram = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(gram), pa.string()), pa.array(gram, pa.int32()), pa.array(n[gram])],
                    ["lang", "gram", "n"])


def mixture(likelihood: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Proportions of languages from the likelihood of each gram (languages x grams)."""
    kept = np.arange(len(likelihood))
    total = counts.sum()
    share = np.full(len(kept), 1 / len(kept))

    def settle(kept, share):
        rows = likelihood[kept]
        for _ in range(ROUNDS):
            joint = share[:, None] * rows
            new = (joint / joint.sum(axis=0)) @ counts / total
            done = np.abs(new - share).max() < 1e-3
            share = new
            if done:
                break
        return share, float(np.log(share @ rows) @ counts)

    share, fit = settle(kept, share)
    while len(kept) > 1:
        rest = np.delete(np.arange(len(kept)), share.argmin())
        less, worse = settle(kept[rest], share[rest] / max(share[rest].sum(), 1e-12))
        if fit - worse > 0.5 * np.log(total):
            break
        kept, share, fit = kept[rest], less, worse
    out = np.zeros(len(likelihood))
    out[kept] = share
    return out


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, table = shared.value
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            pred, score, shares = [], [], []
            for text in texts:
                if text is None or not len(langs) or not LETTER.search(text):
                    pred.append("und")
                    score.append(0.0)
                    shares.append([])
                    continue
                n = np.bincount(_grams(np.frombuffer(text.encode(), np.uint8)), minlength=BUCKETS)
                gram = np.flatnonzero(n)
                share = mixture(table[:, gram].astype(np.float64), n[gram].astype(np.float64))
                top = int(share.argmax())
                pred.append(langs[top])
                score.append(float(min(1.0, max(0.0, share[top]))))
                shares.append([(langs[i], float(share[i])) for i in np.flatnonzero(share)])
            yield pa.RecordBatch.from_arrays(
                [ids, batch.column("held_out"), pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                 pa.array([[{"lang": a, "share": b} for a, b in s] for s in shares],
                          pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))],
                ["doc_id", "held_out", "lang_pred", "score", "languages"])
    return run


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages (proportions of the chosen set).

    Learns from the text and lang of documents whose crc32(doc_id as text) mod 3 is not 1.
    Texts that are null or hold no letter are ``und`` with score 0, as is everything when there
    is nothing to learn from. Null ids are held out. Equal rows get equal results. At most
    ``MAX_LANGS`` languages can be told apart; more are an error.
    """
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(True))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"),
                       F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = rows.filter("not held_out and lang is not null and text is not null").select("lang", "text").mapInArrow(
        _count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    cells = counts.limit(MAX_LANGS * BUCKETS + 1).toArrow()  # bounded by languages times buckets
    langs = sorted(set(cells["lang"].to_pylist()))
    if len(langs) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    table = np.full((len(langs), BUCKETS), SMOOTH, np.float32)
    if langs:
        where = np.searchsorted(np.array(langs, object), np.array(cells["lang"].to_pylist(), object))
        table[where, cells["gram"].to_numpy()] += cells["n"].to_numpy()
        table /= table.sum(axis=1, keepdims=True)
    shared = docs.sparkSession.sparkContext.broadcast((langs, table))
    return rows.select("doc_id", "held_out", "text").mapInArrow(
        _predict(shared), "doc_id long, held_out boolean, lang_pred string, score double, "
                          "languages array<struct<lang:string,share:double>>")
