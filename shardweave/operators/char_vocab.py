"""Character vocabulary: learning, encoding, decoding."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardweave.functions.arrays import runs

#: Characters that a task looks up at a time.
RUN_CHARS = 1 << 20


def learn(texts: DataFrame, column: str = "text") -> DataFrame:
    """``(ch, id)``: distinct characters numbered in code-point order.

    Characters are made distinct inside each document before the shuffle. Unicode
    bounds the result, so numbering it in one task is safe.
    """
    chars = (texts.select(F.explode(F.array_distinct(F.split(column, ""))).alias("ch"))
             .filter("ch <> ''").distinct())
    by_code = Window.partitionBy(F.lit(0)).orderBy("ch")
    return chars.select("ch", (F.row_number().over(by_code) - 1).cast("int").alias("id"))


def characters(vocab: DataFrame) -> list[str]:
    """The vocabulary as a list indexed by id; Unicode bounds its size."""
    chars = [r.ch for r in vocab.orderBy("id").select("ch").collect()]
    if not chars:
        raise ValueError("the character vocabulary is empty: fit it first")
    return chars


def encode(text: Column, chars: list[str]) -> Column:
    """Ids of the characters of ``text``; unknown characters are an error."""
    return encoder(chars)(text)


def decode(ids: Column, chars: list[str]) -> Column:
    """Text spelled by ``ids``; an id outside the vocabulary is an error."""
    return decoder(chars)(ids)


def _lengths(counts: pa.Array) -> np.ndarray:
    return counts.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def encoder(chars: list[str]):
    """Function behind ``encode``.

    Runs of texts are looked up at once in a table of code points: no per-character objects, and
    besides the batch and its ids only one run is in memory.
    """
    codes = np.array([ord(c) for c in chars], dtype=np.uint32)
    ids = np.full(int(codes.max()) + 2, -1, np.int32)  # the last cell stands for all higher ones
    ids[codes] = np.arange(len(codes), dtype=np.int32)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def lookup(texts: pa.Array) -> pa.Array:
        lengths = _lengths(pc.utf8_length(texts))
        ends = np.concatenate([[0], np.cumsum(lengths)])
        out = np.empty(ends[-1], np.int32)
        for first, past in runs(lengths, RUN_CHARS):
            joined = "".join(v for v in texts[first:past].to_pylist() if v is not None)
            points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
            found = ids[np.minimum(points, len(ids) - 1)]
            if len(found) and found.min() < 0:
                raise ValueError(f"character {chr(points[found < 0][0])!r} is not in the vocabulary")
            out[ends[first]:ends[past]] = found
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(out), mask=texts.is_null())

    return lookup


def decoder(chars: list[str]):
    """Function behind ``decode``."""
    codes = np.array([ord(c) for c in chars], dtype=np.uint32)

    @F.arrow_udf(T.StringType())
    def spell(lists: pa.Array) -> pa.Array:
        lengths = _lengths(pc.list_value_length(lists))
        valid = lists.is_valid().to_pylist()
        parts = []
        for first, past in runs(lengths, RUN_CHARS):
            flat = lists[first:past].flatten().to_numpy(zero_copy_only=False)
            if len(flat) and (flat.min() < 0 or flat.max() >= len(codes)):
                raise ValueError("id is not in the vocabulary")
            text = codes[flat].tobytes().decode("utf-32-le")
            ends = np.cumsum(lengths[first:past]).tolist()
            parts.append(pa.array([text[e - n:e] if ok else None for n, e, ok in zip(
                lengths[first:past].tolist(), ends, valid[first:past])], pa.string()))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return spell
