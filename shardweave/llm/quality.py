"""Quality by an interpolated modified Kneser-Ney model of trusted text.

The model is of words. What the words seen after a word leave goes to all words of the language, by the number
of words that each follows, and what these leave to the spelling of a word by its bytes, three to a gram, so that
no word is without a probability. Every language with trusted text has a model of its own, whatever its size;
spelling and discounts are those of all trusted text.

In logarithms a document is a sum of one value per word and pair in it, so it is scored by joins of the
keys that it asks for with the tables of values. Counts are written tables that grow with the corpus; pairs
are counted and joined in parts by their first word, so that the exchange of one part is on disk at a time.
Two things only save work: values of the most common keys are broadcast, and bit maps leave out most keys
without a value.

Trusted documents are in the counts themselves. Each of their words is scored by the counts less the
one occurrence that is scored (leaving one out), so that their scores compare with those of other text.
Perplexities are cut at quantiles per language, taken from histograms over all labelled documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardweave.llm.flat import U64, Words, flatten, mix, ranges, runs, slices
from shardweave.llm.joins import bounded, is_bounded
from shardweave.llm.packed import by_route, pack, unpack_all
from shardweave.llm.rowkeys import row_key
from shardweave.llm.suffix_tree import LEAST_BITS, MOST_BITS, TEXT_BYTES, _probes, gram, indexed, marked, places
from shardweave.staging import drop_stage, stage

#: Bytes that the mean of a language counts for in a document's average.
PRIOR = 60
ALL = ""
STEP = 0.01
#: Parts of the pairs, and the trusted words from which on there are so many.
PARTS, PART_WORDS = 4, 1_000_000
#: Words that a task counts before it hands its counts on; keys that a receiver of counts gets.
CHUNK, ROUTE_KEYS = 500_000, 500_000
#: So many keys at most, the most common ones, are broadcast with their values.
HOT_KEYS = 3 << 17
#: Keys of the end of a document and of what comes before its first word.
END, BEGIN = U64(1), U64(2)
GAP = 0x20
TINY = 1e-9


def _seed(lang: str) -> np.uint64:
    """What makes the keys of a language's model its own."""
    return U64(xxhash.xxh3_64_intdigest(lang.encode()))


def _seeds(langs: list[str]) -> np.ndarray:
    known = {lang: _seed(lang) for lang in set(langs)}
    return np.array([known[lang] for lang in langs], U64)


def _models(langs: list[str], unknown: dict[int, float]) -> list[str]:
    """The model that scores each row: that of its language, or the one for all."""
    own = {lang: lang if int(_seed(lang).view(np.int64)) in unknown else ALL for lang in set(langs)}
    return [own[lang] for lang in langs]


class Cut:
    """Words of a slice, each row's followed by its end: key, row, and the key before. A row without words has none."""

    def __init__(self, part: np.ndarray, at: np.ndarray, seeds: np.ndarray):
        self.words, self.seeds = Words(part, at), seeds
        words = self.words
        live = np.diff(words.rows) > 0
        before = np.cumsum(live) - live
        owner = words.owner()
        self.place, self.ends = np.arange(len(words)) + before[owner], words.rows[1:][live] + before[live]
        n = len(words) + len(self.ends)
        self.row, self.key = np.empty(n, np.int64), np.empty(n, U64)
        self.row[self.place], self.row[self.ends] = owner, np.flatnonzero(live)
        self.key[self.place], self.key[self.ends] = words.hashes(fold=False), END
        self.key = mix(self.key ^ seeds[self.row]).view(np.int64)
        self.first = runs(self.row)
        self.begin = mix(BEGIN ^ seeds[self.row[self.first]]).view(np.int64)
        self.last = np.empty_like(self.key)
        self.last[1:] = self.key[:-1]
        self.last[self.first] = self.begin

    def __len__(self) -> int:
        return len(self.key)

    def spelt(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of each word and a space after it, and where each word begins in them; an end has no bytes."""
        starts, counts = np.full(len(self), len(self.words.data)), np.ones(len(self), np.int64)
        starts[self.place], counts[self.place] = self.words.starts, self.words.ends - self.words.starts + 1
        out = np.append(self.words.data, np.uint8(GAP))[ranges(starts, counts)]
        bounds = np.cumsum(counts)
        out[bounds - 1] = GAP
        return out, bounds - counts


def _codes(spelt: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Each byte and the two before it as one number; a word begins after two spaces."""
    one, two = np.full(len(spelt), GAP, np.int32), np.full(len(spelt), GAP, np.int32)
    one[1:], two[2:] = spelt[:-1], spelt[:-2]
    two[starts] = GAP
    return (two << 16) | (one << 8) | spelt


def _cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[Cut]:
    for batch in batches:
        seeds = _seeds(batch.column("lang").to_pylist())
        data, offsets = flatten(batch.column("text"))
        for first, last, part, at in slices(data, offsets, TEXT_BYTES):
            yield Cut(part, at, seeds[first:last])


def _count_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for cut in _cuts(batches):
        codes = np.sort(_codes(*cut.spelt()))
        first = runs(codes)
        yield pa.RecordBatch.from_arrays([pa.array(codes[first], pa.int32()), pa.array(
            np.diff(np.append(first, len(codes))), pa.int64())], ["code", "n"])


def _discounts(n: list[int]) -> np.ndarray:
    """What is taken off counts of 0, 1, 2 and more, from how many counts are 1, 2, 3 and 4."""
    n = [max(1, x) for x in n]
    y = n[0] / (n[0] + 2 * n[1])
    d = [i - (i + 1) * y * n[i] / n[i - 1] for i in (1, 2, 3)]
    return np.array([0.0, *[min(max(x, 0.1), i - 0.05) for i, x in enumerate(d, 1)]])


def _interpolate(counts: np.ndarray, lower: np.ndarray, discounts: np.ndarray) -> np.ndarray:
    """Discounted counts over their last axis, the mass taken off given to ``lower``."""
    off = discounts[np.minimum(counts, 3).astype(np.int64)]
    total = counts.sum(axis=-1, keepdims=True)
    safe = np.maximum(total, 1)
    mass = np.where(total > 0, off.sum(axis=-1, keepdims=True) / safe, 1.0)
    return np.maximum(counts - off, 0) / safe + mass * lower


def spelling(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each byte, and bits of each gram of such numbers.

    Bytes that never occur share the last number; each has the same probability.
    """
    used = np.unique(codes & 255)
    size = len(used) + 1
    number = np.full(256, len(used), np.int32)
    number[used] = np.arange(len(used))
    three = np.zeros((size, size, size), np.float64)
    three[number[codes >> 16], number[(codes >> 8) & 255], number[codes & 255]] = n
    two = (three > 0).sum(axis=0).astype(np.float64)
    one = (two > 0).sum(axis=0).astype(np.float64)
    p = np.full(size, 1 / 256)
    for counts in (one, two):
        p = _interpolate(counts, p, _discounts([int((counts == i).sum()) for i in (1, 2, 3, 4)]))
    discounts = _discounts([int((n == i).sum()) for i in (1, 2, 3, 4)])
    bits = np.empty((size, size, size), np.float32)
    for i in range(size):
        bits[i] = -np.log2(_interpolate(three[i], p, discounts))
    return number, bits.reshape(-1)


def _spelling_bits(model: tuple[np.ndarray, np.ndarray], cut: Cut) -> np.ndarray:
    """Bits of each word's spelling."""
    number, bits = model
    out, starts = cut.spelt()
    codes, size = _codes(out, starts), np.int32(number.max() + 1)
    at = (number[codes >> 16] * size + number[(codes >> 8) & 255]) * size + number[codes & 255]
    return np.add.reduceat(bits[at].astype(np.float64), starts) if len(starts) else np.zeros(0)


def _count_words(shared):
    def chunk(held):
        keys, seeds, spelt = (np.concatenate(h) for h in zip(*held))
        held.clear()
        key, where, n = np.unique(keys, return_index=True, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(seeds[where].view(np.int64)), pa.array(n, pa.int64()),
                                           pa.array(spelt[where])], ["key", "seed", "n", "spelt"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for cut in _cuts(batches):
            held.append((cut.key, cut.seeds[cut.row], _spelling_bits(shared.value, cut)))
            size += len(cut)
            if size >= CHUNK:
                yield chunk(held)
                size = 0
        if size:
            yield chunk(held)
        pa.default_memory_pool().release_unused()
    return run


def _total(keys: np.ndarray, counts: np.ndarray | None, more: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of equal keys the sum of their counts, and what else belongs to each key."""
    order = np.argsort(keys, kind="stable")
    first = runs(keys[order])
    counts = (np.diff(np.append(first, len(keys))) if counts is None
              else np.add.reduceat(counts[order], first) if len(keys) else counts)
    return counts.astype(np.int64), [m[order[first]] for m in more]


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    """Part of a word; ``part_of`` is the same in SQL."""
    return (keys.view(U64) >> U64(48)) % U64(parts)


def part_of(key: str, parts: int) -> Column:
    return F.shiftrightunsigned(key, 48) % parts


def _send_pairs(part: int, parts: int, routes: int):
    """Counted pairs of a part, about CHUNK at a time, packed by receiver."""
    def chunk(held):
        left, right = (np.concatenate(h) for h in zip(*held))
        held.clear()
        counts, (left, right) = _total(gram(left, right), None, [left, right])
        to = (gram(left, right).view(U64) % U64(routes)).astype(np.int64)
        once = counts == 1
        out = [(r, True, pack(*a)) for r, a in by_route(to[once], left[once], right[once])]
        out += [(r, False, pack(*a)) for r, a in by_route(to[~once], left[~once], right[~once], counts[~once])]
        return pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.bool_()),
             pa.array([o[2] for o in out], pa.binary())], ["to", "once", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for cut in _cuts(batches):
            take = _part(cut.last, parts) == part
            held.append((cut.last[take], cut.key[take]))
            size += len(held[-1][0])
            if size >= CHUNK:
                yield chunk(held)
                size = 0
        if size:
            yield chunk(held)
        pa.default_memory_pool().release_unused()
    return run


def _pairs(table: pa.Table) -> pa.Table:
    """Distinct pairs that were sent to one receiver, and how often each occurs."""
    packed, once = table["packed"].to_pylist(), table["once"].to_pylist()
    ones = unpack_all([p for p, o in zip(packed, once) if o], ("i8", "i8"))
    many = unpack_all([p for p, o in zip(packed, once) if not o], ("i8", "i8", "i8"))
    left, right = (np.concatenate((ones[i], many[i])).astype(np.int64) for i in range(2))
    counts = np.concatenate((np.ones(len(ones[0]), np.int64), many[2].astype(np.int64)))
    n, (left, right) = _total(gram(left, right), counts, [left, right])
    order = np.argsort(left, kind="stable")
    return pa.table({"left": pa.array(left[order]), "right": pa.array(right[order]), "n": pa.array(n[order])})


def _free(spark) -> None:
    """Let Spark delete the shuffle files of finished queries, once the driver's collector finds them unused.

    Spark's listeners hold the query that ended last, so an empty one is run.
    """
    spark.sql("SELECT 1").collect()
    spark.sparkContext._jvm.System.gc()


def _send_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys, or those of pairs, packed by their first byte; those that occur once apart."""
    def chunk(held):
        keys, often = (np.concatenate(h) for h in zip(*held))
        held.clear()
        to = (keys.view(U64) >> U64(56)).astype(np.int64)
        out = [(r, o, pack(*a)) for o in (True, False) for r, a in by_route(to[often == o], keys[often == o])]
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(
            (pa.int64(), pa.bool_(), pa.binary()))], ["to", "often", "packed"])

    held, size = [], 0
    for batch in batches:
        key = gram(*(batch.column(c).to_numpy() for c in ("left", "right"))) if "left" in batch.schema.names \
            else batch.column("key").to_numpy()
        held.append((key, batch.column("n").to_numpy() > 1))
        size += len(held[-1][0])
        if size >= CHUNK:
            yield chunk(held)
            size = 0
    if size:
        yield chunk(held)


def _mark(powers: tuple[int, int]):
    def run(table: pa.Table) -> pa.Table:
        maps = [np.zeros(1 << (power - 8), bool) for power in powers]
        for often, packed in zip(table["often"].to_pylist(), table["packed"]):
            (keys,) = unpack_all([packed.as_py()], ("i8",))
            for power, marks in zip(powers, maps[:1 + often]):
                for at in _probes(keys, power):
                    marks[at & U64(len(marks) - 1)] = True
        return pa.table({"to": table["to"][:1], **{c: pa.array([np.packbits(m, bitorder="little").tobytes()], pa.binary())
                                                   for c, m in zip(("every", "repeated"), maps)}})
    return run


def _bit_maps(tables: list[DataFrame], size: int, repeated: int) -> list[tuple[int, np.ndarray]]:
    """Bit maps of all keys, about ``size``, and of the ``repeated`` ones, with n over 1; bounded by 2**MOST_BITS bits."""
    powers = tuple(min(MOST_BITS, max(LEAST_BITS, (8 * n).bit_length())) for n in (size, repeated))
    maps = [np.zeros(1 << (power - 3), np.uint8) for power in powers]
    sent = reduce(DataFrame.union, [t.mapInArrow(_send_keys, "to long, often boolean, packed binary") for t in tables])
    made = stage(sent.groupBy("to").applyInArrow(_mark(powers), "to long, every binary, repeated binary"), "bits")
    for r in made.toLocalIterator():
        for out, bits in zip(maps, (r.every, r.repeated)):
            width = len(out) >> 8
            out[r.to * width:(r.to + 1) * width] = np.frombuffer(bits, np.uint8)
    drop_stage(made)
    return list(zip(powers, maps))


def _off(count: Column, discounts: np.ndarray) -> Column:
    d = [float(x) for x in discounts]
    return F.when(count >= 3, d[3]).when(count == 2, d[2]).when(count == 1, d[1]).otherwise(d[0])


def _how_many(table: DataFrame, column: str) -> DataFrame:
    """How many counts are 1, 2, 3 and 4."""
    return table.agg(*[F.coalesce(F.sum(F.when(F.col(column) == i, 1)), F.lit(0)) for i in (1, 2, 3, 4)])


def _bits(p: Column) -> Column:
    return -F.log2(p)


def _left_over(mass: Column, total: Column, discounts: np.ndarray) -> tuple[Column, Column]:
    """Bits of what a context leaves to shorter ones, and the same less one occurrence that is its only one of a word."""
    less = _bits(F.greatest(mass - float(discounts[1]), F.lit(TINY)) / (total - 1))
    return _bits(mass / total), F.when(total > 1, less).otherwise(0.0)


def _less_one(n: Column, mass: Column, total: Column, lower: Column, discounts: np.ndarray) -> Column:
    """Probability of a word that its context has ``n`` times, two at least, less one of them."""
    off, then = _off(n, discounts), _off(n - 1, discounts)
    return (n - 1 - then + (mass - off + then) * lower) / (total - 1)


def fit(trusted: DataFrame) -> dict | None:
    """The model: its written tables, the bits of unknown words by language, the spelling.

    Columns: models (the languages whose models count the text), text. None if there is no word.
    """
    spark = trusted.sparkSession
    text = F.col("text").cast("string").alias("text")
    each = trusted.select(F.explode("models").alias("lang"), text)
    cells = trusted.select(F.lit(ALL).alias("lang"), text).mapInArrow(_count_bytes, "code int, n long").groupBy("code").agg(
        F.sum("n").alias("n")).toArrow()  # 2**24 rows at most, whatever the corpus size
    if not len(cells):
        return None
    spelt = spark.sparkContext.broadcast(spelling(cells["code"].to_numpy(), cells["n"].to_numpy()))
    counted = stage(each.mapInArrow(_count_words(spelt), "key long, seed long, n long, spelt double").groupBy("key").agg(
        F.first("seed").alias("seed"), F.sum("n").alias("n"), F.first("spelt").alias("spelt")), "counted")
    total = counted.agg(F.sum("n")).first()[0]
    parts = PARTS if total >= PART_WORDS else 1
    routes = max(8, -(-total // (ROUTE_KEYS * parts)))
    pairs, kinds = [], []
    for part in range(parts):
        sent = each.mapInArrow(_send_pairs(part, parts, routes), "to long, once boolean, packed binary")
        pairs.append(stage(sent.groupBy("to").applyInArrow(_pairs, "left long, right long, n long"), "pairs"))
        _free(spark)
        kinds.append(stage(pairs[-1].groupBy("right").agg(F.count(F.lit(1)).alias("kinds")), "kinds"))
        _free(spark)
    d2 = _discounts([sum(x) for x in zip(*(_how_many(t, "n").first() for t in pairs))])
    lasts = [stage(t.groupBy("left").agg(F.sum("n").alias("total"), F.sum(_off(F.col("n"), d2)).alias("mass")), "lasts")
             for t in pairs]
    _free(spark)

    # Of a word after how many words it comes, its probability, and its bits in a pair that occurs once, without itself.
    words = counted.join(reduce(DataFrame.union, kinds).groupBy(F.col("right").alias("key")).agg(
        F.sum("kinds").alias("kinds")), "key")
    d1 = _discounts(list(_how_many(words, "kinds").first()))
    sums = stage(words.groupBy("seed").agg(F.sum("kinds").alias("total"), F.sum(_off(F.col("kinds"), d1)).alias("mass")), "sums")
    unknown = {r.seed: -math.log2(r.mass / r.total) for r in sums.collect()}  # a number per language
    k, mass, p0 = F.col("kinds"), F.col("mass"), F.pow(F.lit(2.0), -F.col("spelt"))
    p = (k - _off(k, d1) + mass * p0) / F.col("total")
    less = F.when(k > 1, _bits(_less_one(k, mass, F.col("total"), p0, d1))).otherwise(
        F.col("spelt") + _bits((mass - float(d1[1])) / (F.col("total") - 1)))
    known = F.col("spelt") + _bits(mass / F.col("total"))
    table = stage(words.join(bounded(sums), "seed").select(
        "key", "n", p.cast("float").alias("p"), less.cast("float").alias("less"), known.cast("float").alias("known")), "words")
    for done in (counted, sums, *kinds):
        drop_stage(done)
    _free(spark)
    return {"words": table, "pairs": pairs, "lasts": lasts, "discounts": d2, "unknown": unknown, "spelling": spelt}


def _ask(shared, model: dict, group: range):
    """Rows with the values of common keys in a group of parts, and by part the other keys that may have a value.

    With the first part also the length of the spelling, and the bits of the words as if all were unknown.
    """
    spelt, unknown, parts = model["spelling"], model["unknown"], len(model["pairs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, values, every, repeated = shared.value
        for batch in batches:
            models = _models(batch.column("lang").to_pylist(), unknown)
            seeds = _seeds(models)
            add = np.array([unknown[s] for s in seeds.view(np.int64).tolist()])
            own = batch.column("trusted").to_numpy(zero_copy_only=False)
            data, offsets = flatten(batch.column("text"))
            for first, last, data_part, at in slices(data, offsets, TEXT_BYTES):
                cut = Cut(data_part, at, seeds[first:last])
                rows, loo = last - first, own[first:last]
                sums = np.zeros(rows)
                if 0 in group:
                    sums += np.bincount(cut.row, _spelling_bits(spelt.value, cut) + add[first:last][cut.row], rows)
                size = np.bincount(cut.words.owner(), cut.words.ends - cut.words.starts + 1, rows).astype(np.int64)
                keys = np.concatenate((cut.key, cut.begin, gram(cut.last, cut.key)))
                row = np.concatenate((cut.row, cut.row[cut.first], cut.row))
                part = _part(np.concatenate((cut.key, cut.begin, cut.last)), parts)
                inside = (part >= U64(group.start)) & (part < U64(group.stop))
                keys, row, part = keys[inside], row[inside], part[inside]
                found = places(hot, keys)
                ok = found >= 0
                sums += np.bincount(row[ok], values[loo[row[ok]].astype(np.int8), found[ok]], rows)
                rest = np.flatnonzero(~ok)
                mine = loo[row[rest]]
                rest = np.concatenate((rest[mine][marked(repeated, keys[rest[mine]])],
                                       rest[~mine][marked(every, keys[rest[~mine]])]))
                asked = []
                for p in group:
                    some = rest[part[rest] == p]
                    some = some[np.argsort(row[some], kind="stable")]
                    starts = np.searchsorted(row[some], np.arange(rows + 1))
                    asked.append(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(keys[some], pa.int64())))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(first, rows) for c in ("doc_id", "_key", "lang", "trusted", "id")]
                    + [pa.array(models[first:last], pa.string()), pa.array(np.diff(offsets[first:last + 1]), pa.int64()),
                       pa.array(size), pa.array(sums), *asked],
                    ["doc_id", "_key", "lang", "trusted", "id", "model", "n_bytes", "size", "sum",
                     *(f"asked{p}" for p in group)])
        pa.default_memory_pool().release_unused()
    return run


def _keyed(least: float, shared=None):
    """Pairs that occur ``least`` times or that some row asks for, with their keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, n = gram(batch.column("left").to_numpy(), batch.column("right").to_numpy()), batch.column("n").to_numpy()
            keep = n >= least
            if shared:
                keep |= marked(shared.value, key)
            yield pa.RecordBatch.from_arrays([pa.array(key[keep]), *(batch.column(c).filter(pa.array(keep))
                                                                    for c in batch.schema.names)], ["key", *batch.schema.names])
    return run


PAIRS = "key long, left long, right long, n long"


def _least_hot(tables: list[DataFrame], most: int) -> float:
    """A count that at most ``most`` of the keys reach, exact to a quarter of a power of two."""
    steps = reduce(DataFrame.union, [t.select(F.floor(F.log2("n") * 4).alias("step")) for t in tables])
    held = steps.groupBy("step").count().collect()  # some hundred rows
    least = math.inf
    for r in sorted(held, key=lambda r: -r.step):
        most -= r["count"]
        if most < 0:
            break
        least = 2.0 ** (r.step / 4)
    return least


def _word_values(model: dict) -> DataFrame:
    """key, n, value, loo: what a known word adds to an unknown one's bits, and what it leaves to the word after it; p, less."""
    zero, lasts = F.lit(0.0), reduce(DataFrame.union, model["lasts"])
    after, after_less = _left_over(F.col("mass"), F.col("total"), model["discounts"])
    return model["words"].join(lasts.withColumnRenamed("left", "key"), "key", "full").select(
        "key", F.coalesce("n", "total").alias("n"), "p", "less",
        (F.coalesce(_bits(F.col("p")) - F.col("known"), zero) + F.coalesce(after, zero)).cast("float").alias("value"),
        (F.coalesce(F.col("less") - F.col("known"), zero) + F.coalesce(after_less, zero)).cast("float").alias("loo"))


def _pair_values(keyed: DataFrame, words: DataFrame, lasts: DataFrame, d: np.ndarray, few=lambda table: table) -> DataFrame:
    """key, value, loo: what a known pair adds to the values of its words."""
    n, mass, total, p = (F.col(c) for c in ("n", "mass", "total", "p"))
    less = _bits(_less_one(n, mass, total, p, d)) - _left_over(mass, total, d)[1] - F.col("less")
    return few(few(keyed).join(lasts, "left").drop("left")).join(
        words.filter("p is not null").select(F.col("key").alias("right"), "p", "less"), "right").select(
        "key", _bits(1 + (n - _off(n, d)) / (mass * p)).cast("float").alias("value"),
        F.when(n > 1, less).otherwise(0.0).cast("float").alias("loo"))


def _scored(docs: DataFrame, model: dict, hot_keys: int) -> DataFrame:
    """Rows with the bits of their words, ``total``, and the length of these, ``size``.

    Keys are asked for in two groups of parts, one after the other, as they are as large as the text.
    """
    spark, parts = docs.sparkSession, len(model["pairs"])
    context = spark.sparkContext
    pairs, lasts = (reduce(DataFrame.union, model[c]) for c in ("pairs", "lasts"))
    words, d = stage(_word_values(model), "values"), model["discounts"]
    drop_stage(model["words"])
    _free(spark)
    least = _least_hot([words, pairs], hot_keys)
    hot = _pair_values(pairs.filter(F.col("n") >= least).mapInArrow(_keyed(least), PAIRS), words, lasts, d, F.broadcast).union(
        words.filter(F.col("n") >= least).select("key", "value", "loo")).toArrow()  # at most hot_keys rows
    keys = hot["key"].to_numpy()
    order = np.argsort(keys.view(U64))
    common = indexed(keys[order]), np.stack([hot[c].to_numpy()[order] for c in ("value", "loo")])
    columns = ["doc_id", "_key", "lang", "trusted", "id", "model", "n_bytes", "size"]
    # Trusted rows have negative numbers.
    number = F.when(F.col("trusted"), -1 - F.col("row")).otherwise(F.col("row")).alias("row")
    sums, middle = [], -(-parts // 2)
    for group in [g for g in (range(middle), range(middle, parts)) if g]:
        # Words have values for trusted rows even if they occur once.
        own = words.filter(part_of("key", parts).between(group.start, group.stop - 1)).select("key", F.lit(2).cast("long").alias("n"))
        some = [own, *(model["pairs"][p] for p in group)]
        sizes = [reduce(int.__add__, (t.filter(F.col("n") > floor).count() for t in some)) for floor in (0, 1)]
        shared = context.broadcast((*common, *_bit_maps(some, *sizes)))
        _free(spark)
        asked = stage(docs.mapInArrow(_ask(shared, model, group), ", ".join(
            ["doc_id long, _key long, lang string, trusted boolean, id long, model string, n_bytes long, size long, sum double",
             *(f"asked{p} array<long>" for p in group)])).withColumn("row", F.monotonically_increasing_id()), "asked")
        shared.destroy()
        more = []
        for p in group:
            each = asked.select(number, F.explode(f"asked{p}").alias("key"))
            size = asked.agg(F.coalesce(F.sum(F.size(f"asked{p}")), F.lit(0))).first()[0]
            wanted = context.broadcast(_bit_maps([each.select("key", F.lit(1).cast("long").alias("n"))], size, 0)[0])
            _free(spark)
            found = stage(_pair_values(model["pairs"][p].mapInArrow(_keyed(math.inf, wanted), PAIRS), words,
                                       model["lasts"][p], d), "found")
            for done in (model["pairs"][p], model["lasts"][p]):
                drop_stage(done)
            _free(spark)
            own = words.filter(part_of("key", parts) == p).select("key", "value", "loo")
            more.append(stage(each.join(found.union(own), "key").groupBy("row").agg(F.sum(
                F.when(F.col("row") < 0, F.col("loo")).otherwise(F.col("value")).cast("double")).alias("more")), "more"))
            wanted.destroy()
            drop_stage(found)
            _free(spark)
        sums.append(stage(asked.select(*columns, "sum", number).join(
            reduce(DataFrame.union, more).groupBy("row").agg(F.sum("more").alias("more")), "row", "left").select(
            *(columns if group.start == 0 else ["id"]), (F.col("sum") + F.coalesce("more", F.lit(0.0))).alias("sum")), "sums"))
        for done in (asked, *more):
            drop_stage(done)
        _free(spark)
    # Rows alike in id are alike in all that is scored; each adds the same.
    totals = reduce(DataFrame.union, [t.select("id", "sum", F.lit(int(i == 0)).alias("rows")) for i, t in enumerate(sums)])
    out = stage(sums[0].drop("sum").join(totals.groupBy("id").agg((F.sum("sum") / F.sum("rows")).alias("total")), "id"), "totals")
    for done in (words, *sums):
        drop_stage(done)
    model["spelling"].destroy()
    return out


def quality(docs: DataFrame, labels: DataFrame, keep_quantile: float = 0.995,
            junk_quantile: float = 0.05) -> DataFrame:
    """One row per document: doc_id, lang, n_bytes, bits, perplexity, threshold, kept, _key.

    Trusted text is labelled quality 1 and not toxic; the model counts all of it. A language's threshold is the
    ``keep_quantile`` of its trusted documents, or half-way from it to the ``junk_quantile``
    of its documents labelled 0 where that is higher. ``bits`` are per byte of the words, with one byte of
    white space after each; they are drawn towards the mean of the language in short texts, so a text
    without words, an empty or a null one is kept.

    Without any trusted words everything is kept. A null language, and one without trusted words, is scored by
    the model for all. A language without trusted documents takes the highest threshold of all. A document
    with several labels is trusted only if all are good.
    """
    good = labels.groupBy("doc_id").agg(
        (F.coalesce(F.min("quality"), F.lit(0)) > 0).alias("good"),
        (F.coalesce(F.max("toxic"), F.lit(1)) > 0).alias("toxic")).select(
        F.col("doc_id").cast("long").alias("_id"), "good", "toxic").filter("_id is not null")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("_key"),
                       F.coalesce(F.col("lang").cast("string"), F.lit(ALL)).alias("lang"),
                       F.col("text").cast("string").alias("text"))
    chosen = stage(good.filter("good and not toxic").select("_id").distinct(), "trusted")
    few = is_bounded(chosen)
    is_trusted = F.col("doc_id") == F.col("_id")
    flagged = rows.join(F.broadcast(chosen) if few else chosen, is_trusted, "left").select(
        "doc_id", "_key", "lang", "text", F.col("_id").isNotNull().alias("trusted"),
        F.xxhash64("_key", "lang").alias("id"))
    if not few:  # the texts are shuffled once, not at each of the following scans
        flagged = stage(flagged, "flagged")
    trusted = flagged.filter("trusted") if not few else rows.join(F.broadcast(chosen), is_trusted, "left_semi")
    own = stage(trusted.filter(F.col("text").rlike("[^ \\t-\\r]") & (F.col("lang") != ALL)).select("lang").distinct(), "langs")
    others = rows.select("lang").distinct().join(own, "lang", "left_anti").limit(1).count()
    models = F.array_distinct(F.array("lang", F.lit(ALL))) if others else F.array("lang")
    model = fit(trusted.select("doc_id", models.alias("models"), "text"))
    if model is None:
        return rows.select("doc_id", "lang", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                           F.lit(None).cast("double").alias("bits"), F.lit(None).cast("double").alias("perplexity"),
                           F.lit(None).cast("double").alias("threshold"), F.lit(True).alias("kept"), "_key")
    whole = _scored(flagged, model, HOT_KEYS)
    fitted = whole.filter("trusted")
    mean = (F.sum("total") / F.sum("size")).alias("mean")
    means = stage(fitted.groupBy("model").agg(mean).filter(F.col("model") != ALL).union(
        fitted.select(F.lit(ALL).alias("model"), "total", "size").groupBy("model").agg(mean)), "means")
    scored = stage(whole.join(bounded(means), "model").select(
        "doc_id", "_key", "lang", "n_bytes",
        ((F.col("total") + PRIOR * F.col("mean")) / (F.col("size") + PRIOR)).alias("bits")), "scored")
    for done in (whole, means, *([] if few else [flagged])):
        drop_stage(done)
    bins = scored.join(good, F.col("doc_id") == F.col("_id")).groupBy(
        "lang", (F.col("good") & ~F.col("toxic")).alias("trusted"), (~F.col("good")).alias("junk"),
        F.ceil(F.col("bits") / STEP).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("lang", "trusted", "junk")
    bins = bins.withColumn("upto", F.sum("n").over(group.orderBy("bin"))).withColumn("all", F.sum("n").over(group))
    cuts = bins.groupBy("lang").agg(
        F.min(F.when(F.col("trusted") & (F.col("upto") >= keep_quantile * F.col("all")), F.col("bin"))).alias("hi"),
        F.min(F.when(F.col("junk") & (F.col("upto") >= junk_quantile * F.col("all")), F.col("bin"))).alias("lo"))
    cuts = stage(cuts.filter("hi is not null").select(
        "lang", (F.greatest("hi", (F.col("hi") + F.coalesce("lo", "hi")) / 2) * STEP).alias("threshold")), "cuts")
    top = cuts.agg(F.max("threshold")).first()[0]
    return scored.join(cuts, "lang", "left").select(
        "doc_id", "lang", "n_bytes", "bits", F.pow(F.lit(2.0), "bits").alias("perplexity"),
        F.coalesce("threshold", F.lit(top)).alias("threshold"),
        (F.col("bits") <= F.coalesce("threshold", F.lit(top))).alias("kept"), "_key")
