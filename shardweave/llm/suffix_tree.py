"""Scores by a probabilistic suffix tree over words.

Contexts are the last word or the last two. A word sequence counts as a next word of its context
if it occurs ``LEAST_COUNT`` times in the training text, whatever the corpus size. Words, pairs
and triples are told apart by 64-bit hashes and kept as written tables that grow with the corpus.

A context stays in the tree when the likelihood gained over its parent's distribution pays for
its next words (a divergence test), and a longer one only below a context that stays.
What the frequent next words of a context leave is spread like the parent's distribution.

In logarithms a document's score is a sum of one value per word, pair and triple in it, so it
takes one join of (row, key) with the table of values. Two things only save work: values of
the most common keys are looked up in a broadcast table, and bit maps of fixed size leave out most
keys that have no value or too few occurrences. Neither changes a result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardweave.llm.flat import U64, Words, flatten, mix, runs, slices
from shardweave.llm.packed import by_route, pack, unpack_all
from shardweave.staging import drop_stage, stage

END = 1
LEAST_COUNT, SMOOTH = 4, 2.0
#: So many keys at most, the most common ones, are broadcast with their values (24 bytes a key in a worker).
HOT_KEYS = 1 << 18
#: Tokens that a task counts before it hands its counts on; keys that a receiver of counts gets.
CHUNK, ROUTE_KEYS = 500_000, 500_000
#: Bits of a bit map, as powers of two; it has 16 to 32 bits a key up to the largest size.
LEAST_BITS, MOST_BITS = 16, 29
#: Bytes of text that are cut into words at a time. Idle workers keep much of the most memory they have used.
TEXT_BYTES = 1 << 19


def _tokens(part: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of each row followed by its end token, and the bounds of the rows."""
    words = Words(part, at)
    return np.insert(words.hashes().view(np.int64), words.rows[1:], END), words.rows + np.arange(len(words.rows))


def gram(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Key of two words, or of two pairs that share their middle word."""
    return mix(left.view(U64) * U64(0x9E3779B97F4A7C15) + right.view(U64)).view(np.int64)


def _total(keys: np.ndarray, counts: np.ndarray | None, *more: np.ndarray) -> list[np.ndarray]:
    """Distinct keys in order, the sum of their counts, and what else belongs to each key."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = runs(keys)
    if counts is None:
        counts = np.diff(np.append(first, len(keys)))
    elif len(keys):
        counts = np.add.reduceat(counts[order], first)
    return [keys[first], counts.astype(np.int64), *(m[order[first]] for m in more)]


def _put_together(held: list[tuple[np.ndarray, ...]]) -> list[np.ndarray]:
    """The held arrays as counted keys; ``held`` is emptied."""
    keys, *more = (np.concatenate(h) for h in zip(*held))
    held.clear()
    return _total(keys, None, *more)


def _chunks(batches: Iterator[pa.RecordBatch], keys_of) -> Iterator[list[np.ndarray]]:
    """Counted keys of about CHUNK tokens at a time."""
    held, size = [], 0
    for batch in batches:
        data, offsets = flatten(batch.column("text"))
        for _, _, part, at in slices(data, offsets, TEXT_BYTES):
            held.append(keys_of(_tokens(part, at)[0]))
            size += len(held[-1][0])
            if size >= CHUNK:
                yield _put_together(held)
                size = 0
    if size:
        yield _put_together(held)
    pa.default_memory_pool().release_unused()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for keys, counts in _chunks(batches, lambda tokens: (tokens,)):
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "n"])


def indexed(table: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """A table of keys in unsigned order, where the keys of each leading bits start, and how many bits follow."""
    bits = max(1, len(table).bit_length())
    return table, np.searchsorted(table.view(U64) >> U64(64 - bits), np.arange((1 << bits) + 1, dtype=U64)), 64 - bits


def places(index: tuple[np.ndarray, np.ndarray, int], keys: np.ndarray) -> np.ndarray:
    """Where each key is in an indexed table; -1 if it is not."""
    table, starts, shift = index
    out = np.full(len(keys), -1, np.int64)
    bucket = keys.view(U64) >> U64(shift)
    at, end = starts[bucket], starts[bucket + U64(1)]
    left = np.flatnonzero(at < end)
    at, end = at[left], end[left]
    while len(left):
        hit = table[at] == keys[left]
        out[left[hit]] = at[hit]
        at = at + 1
        more = np.flatnonzero(~hit & (at < end))
        left, at, end = left[more], at[more], end[more]
    return out


def _probes(keys: np.ndarray, power: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of each key, both in the part of the bit map that its first byte names."""
    keys = keys.view(U64)
    return keys >> U64(64 - power), (keys >> U64(56) << U64(power - 8)) | (keys & U64((1 << (power - 8)) - 1))


def _bits(power: int):
    def run(table: pa.Table) -> pa.Table:
        keys = table["key"].to_numpy()
        marks = np.zeros(1 << (power - 8), bool)
        for at in _probes(keys, power):
            marks[at & U64(len(marks) - 1)] = True
        return pa.table({"part": pa.array([int(keys.view(U64)[0] >> U64(56))], pa.int64()),
                         "bits": pa.array([np.packbits(marks, bitorder="little").tobytes()], pa.binary())})
    return run


def bit_map(keys: DataFrame) -> tuple[int, np.ndarray]:
    """Marks of all keys at two places; its size does not go beyond 2**MOST_BITS bits."""
    power = min(MOST_BITS, max(LEAST_BITS, (16 * keys.count()).bit_length()))
    out = np.zeros(1 << (power - 3), np.uint8)
    width = len(out) >> 8
    marked = keys.select("key").groupBy(F.shiftrightunsigned("key", 56)).applyInArrow(
        _bits(power), "part long, bits binary")
    for r in marked.toLocalIterator():
        out[r.part * width:(r.part + 1) * width] = np.frombuffer(r.bits, np.uint8)
    return power, out


def marked(bits: tuple[int, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """False only where a key is certainly not among those of the bit map."""
    first, second = _probes(keys, bits[0])
    out = (bits[1][first >> U64(3)] >> (first & U64(7)).astype(np.uint8)) & 1 > 0
    left = np.flatnonzero(out)
    second = second[left]
    out[left] = (bits[1][second >> U64(3)] >> (second & U64(7)).astype(np.uint8)) & 1 > 0
    return out


def _count_grams(shared, pairs: bool, routes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value

        def keys_of(tokens: np.ndarray) -> tuple[np.ndarray, ...]:
            inside = tokens[:-1] != END
            keys = tokens if pairs else gram(tokens[:-1], tokens[1:])
            inside = inside if pairs else inside[:-1] & inside[1:]
            known = marked(frequent, keys)
            ok = np.flatnonzero(inside & known[:-1] & known[1:])
            left, right = keys[ok], keys[ok + 1]
            return gram(left, right), left, right

        for keys, counts, left, right in _chunks(batches, keys_of):
            to = (keys.view(U64) % U64(routes)).astype(np.int64)
            once = counts == 1
            out = [(r, True, pack(*a)) for r, a in by_route(to[once], left[once], right[once])]
            out += [(r, False, pack(*a)) for r, a in by_route(to[~once], left[~once], right[~once], counts[~once])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.bool_()),
                 pa.array([o[2] for o in out], pa.binary())], ["to", "once", "packed"])
    return run


def _frequent(table: pa.Table) -> pa.Table:
    packed, once = table["packed"].to_pylist(), table["once"].to_pylist()
    ones = unpack_all([p for p, o in zip(packed, once) if o], ("i8", "i8"))
    many = unpack_all([p for p, o in zip(packed, once) if not o], ("i8", "i8", "i8"))
    left, right = (np.concatenate((ones[i], many[i])).astype(np.int64) for i in range(2))
    counts = np.concatenate((np.ones(len(ones[0]), np.int64), many[2].astype(np.int64)))
    keys, counts, left, right = _total(gram(left, right), counts, left, right)
    keep = counts >= LEAST_COUNT
    del packed, ones, many
    return pa.table({c: pa.array(a[keep], pa.int64()) for c, a in zip(("key", "left", "right", "n"),
                                                                      (keys, left, right, counts))})


def grow(grams: DataFrame, contexts: DataFrame, parents: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """Which contexts stay, and the probability of each gram.

    ``grams`` (key, left, right, n) are the frequent next words: ``left`` is the key of the context,
    ``right`` that of the gram without its first word. ``contexts`` (key, m) may stay;
    ``parents`` (key, p) holds the parent's probability of every ``right``.

    Returns contexts that stay (key, value), and grams of all contexts (key, right, n, p, value).
    The values are what a context adds to the score, and what a gram adds beyond that.
    ``grams`` is a staged table and is dropped.
    """
    taken = grams.groupBy("left").agg(F.sum("n").alias("taken"), F.count(F.lit(1)).alias("kinds"))
    rest = contexts.withColumnRenamed("key", "left").join(taken, "left").select(
        "left", "m", "kinds", (F.col("m") - F.col("taken")).alias("other"),
        ((F.col("m") - F.col("taken") + SMOOTH) / (F.col("m") + SMOOTH)).alias("rest"))
    longer = F.col("n") / (F.col("m") + SMOOTH) + F.col("rest") * F.col("parent")
    full = stage(grams.join(rest, "left").join(
        parents.select(F.col("key").alias("right"), F.col("p").alias("parent")), "right").select(
        "key", "left", "right", "n", "parent", "rest", "kinds", "other", longer.alias("longer")), "grams")
    drop_stage(grams)
    gain = full.groupBy("left").agg(
        F.sum(F.col("n") * F.log(F.col("longer") / F.col("parent"))).alias("gain"),
        F.first("kinds").alias("kinds"), F.first("other").alias("other"), F.first("rest").alias("rest"))
    stays = stage(gain.filter(F.col("gain") + F.col("other") * F.log("rest")
                              > F.col("kinds") * F.lit(0.5 * math.log(max(total, 2)))).select(
        F.col("left").alias("key"), F.log10("rest").alias("value")), "contexts")
    inside = F.col("context").isNotNull()
    made = stage(full.join(stays.select(F.col("key").alias("left"), F.col("value").alias("context")), "left", "left").select(
        "key", "right", "n", F.when(inside, F.col("longer")).otherwise(F.col("parent")).alias("p"),
        F.when(inside, F.log10("longer") - F.col("context") - F.log10("parent")).otherwise(0.0).alias("value")), "next")
    drop_stage(full)
    return stays, made


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, base, value, bits = shared.value
        for batch in batches:
            data, offsets = flatten(batch.column("text"))
            for first, last, part, at in slices(data, offsets, TEXT_BYTES):
                tokens, bounds = _tokens(part, at)
                size = last - first
                owner = np.repeat(np.arange(size), np.diff(bounds))
                inside = tokens[:-1] != END
                pairs = gram(tokens[:-1], tokens[1:])
                two = np.flatnonzero(inside)
                three = np.flatnonzero(inside[:-1] & inside[1:])
                found = places(hot, tokens)
                known = found >= 0
                counted = [np.diff(bounds), np.bincount(owner[known], minlength=size)]
                sums = [np.bincount(owner[known], x[found[known]], size).astype(np.float64) for x in (base, value)]
                asked, rows = [tokens[~known]], [owner[~known]]
                for keys, row in ((pairs[two], owner[two]), (gram(pairs[three], pairs[three + 1]), owner[three])):
                    found = places(hot, keys)
                    ok = found >= 0
                    sums[1] += np.bincount(row[ok], value[found[ok]], size)
                    rest = np.flatnonzero(~ok)
                    rest = rest[marked(bits, keys[rest])]
                    asked.append(keys[rest])
                    rows.append(row[rest])
                asked, rows = np.concatenate(asked), np.concatenate(rows)
                order = np.argsort(rows, kind="stable")
                starts = np.searchsorted(rows[order], np.arange(size + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(first, size) for c in ("doc_id", "row", "held_out")]
                    + [pa.array(c, pa.int64()) for c in counted] + [pa.array(s) for s in sums]
                    + [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(asked[order], pa.int64()))],
                    ["doc_id", "row", "held_out", "n", "known", "base", "value", "asked"])
        pa.default_memory_pool().release_unused()
    return run


def _least_hot(values: DataFrame, hot_keys: int) -> float:
    """A count that at most ``hot_keys`` of the keys reach; of counts, quarters of a power of two are told apart."""
    held = values.groupBy(F.floor(F.log2("n") * 4).alias("step")).count().collect()
    least = math.inf
    for r in sorted(held, key=lambda r: -r.step):
        hot_keys -= r["count"]
        if hot_keys < 0:
            break
        least = r.step
    return least


def score(docs: DataFrame, hot_share: float = 0.0, hot_keys: int = HOT_KEYS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from documents whose crc32(doc_id as text) mod 7 is not 2. Null and empty texts are
    one end token. Null ids are held out. Rows that share doc_id and text are each counted in
    learning and each returned. With nothing to learn from, both scores are 0 per token.
    ``hot_share`` (the least share of all training tokens) and ``hot_keys`` (the most keys) only say
    which values are broadcast.
    """
    context = docs.sparkSession.sparkContext
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(True))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    train = rows.filter("not held_out").select("text")
    counted = stage(train.mapInArrow(_count_words, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "words")
    total, distinct = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    floor = float(total + distinct + 1)
    routes = max(64, -(-total // ROUTE_KEYS))

    def frequent(parts: DataFrame, pairs: bool) -> DataFrame:
        sent = train.mapInArrow(_count_grams(context.broadcast(bit_map(parts)), pairs, routes),
                                "to long, once boolean, packed binary")
        return stage(sent.groupBy("to").applyInArrow(_frequent, "key long, left long, right long, n long"), "frequent")

    words = counted.filter(F.col("n") >= LEAST_COUNT)
    base = F.log10((F.col("n") + 1) / F.lit(floor))
    first, pairs = grow(frequent(words, True), words.filter(F.col("key") != END).select("key", F.col("n").alias("m")),
                        words.select("key", ((F.col("n") + 1) / F.lit(floor)).alias("p")), total)
    # A pair may stay as a context if its last word does.
    below = pairs.join(first.select(F.col("key").alias("right")), "right", "left_semi")
    second, triples = grow(frequent(pairs, False), below.select("key", F.col("n").alias("m")),
                           pairs.select("key", "p"), total)
    columns = "key", "n", "word", "base", "value"
    more = F.coalesce(F.col("context"), F.lit(0.0))
    values = stage(
        counted.join(first.withColumnRenamed("value", "context"), "key", "left").select(
            "key", "n", F.lit(1).alias("word"), base.alias("base"), more.alias("value"))
        .union(pairs.join(second.withColumnRenamed("value", "context"), "key", "left").select(
            "key", "n", F.lit(0), F.lit(0.0), F.col("value") + more).toDF(*columns).filter("value <> 0"))
        .union(triples.select("key", "n", F.lit(0), F.lit(0.0), "value").toDF(*columns).filter("value <> 0")), "values")
    for table in (counted, first, pairs, second, triples):
        drop_stage(table)
    enough = F.col("n") >= max(LEAST_COUNT, math.ceil(total * hot_share))
    enough &= F.floor(F.log2("n") * 4) >= F.lit(_least_hot(values.filter(enough), hot_keys))
    hot = values.filter(enough).select("key", "base", "value").toArrow()  # at most hot_keys rows
    rest = values.filter(~enough)
    keys = hot["key"].to_numpy()
    order = np.argsort(keys.view(U64))
    shared = context.broadcast((indexed(keys[order]), hot["base"].to_numpy()[order], hot["value"].to_numpy()[order],
                                bit_map(rest.filter("word = 0"))))
    scored = stage(rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        _score(shared), "doc_id long, row long, held_out boolean, n long, known long, base double, "
                        "value double, asked array<long>"), "scored")
    found = scored.select("row", F.explode("asked").alias("key")).join(rest, "key").groupBy("row").agg(
        F.sum("word").alias("words"), F.sum("base").alias("more_base"), F.sum("value").alias("more_value"))
    known = F.col("known") + F.coalesce("words", F.lit(0))
    based = (F.col("base") + F.coalesce("more_base", F.lit(0.0))
             - (F.col("n") - known) * F.lit(math.log10(floor)))
    return scored.join(found, "row", "left").select(
        "doc_id", "held_out", F.col("n").alias("n_tokens"), known.alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), based.alias("base_score"),
        (based + F.col("value") + F.coalesce("more_value", F.lit(0.0))).alias("score"))
