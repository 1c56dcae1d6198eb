"""Near-duplicate documents by b-bit MinHash.

Signing is map-only: each text becomes 128 minima over its distinct word shingles. Bands of
four minima name buckets; of each minimum only four low bits are kept, packed 16 to a long.
Within a bucket every member is compared with two representatives, so a group of copies costs
links in proportion to its size. Bucket members that are then still in different components
are compared block by block, which leaves no bucket pair undecided: pairs that look alike by their
packed bits are confirmed on full sets in place, and a block passes on only links that join two
components. Estimates only discard pairs far below the threshold; every link is confirmed on full sets.

Documents with equal shingle sets form one class and are signed once for all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardweave.llm.components import components
from shardweave.llm.flat import U64, Words, flatten, mix, slices
from shardweave.llm.joins import keep_ids
from shardweave.staging import stage

HASHES, ROWS, BITS = 128, 4, 4
BANDS = HASHES // ROWS
#: Members of a block, and shingles of all of them together.
BLOCK, BLOCK_SHINGLES = 1024, 4_000_000
#: Fewer sets are intersected one by one, and so are those whose bit rows would be larger.
FEW_SETS, BIT_BYTES = 24, 64 << 20
#: An estimate has a standard deviation of about 0.037; links are seven of them above this.
SLACK = 0.26
MEMBERS = 256

_rng = np.random.default_rng(7)
_MASKS = _rng.integers(0, 2**64, HASHES, dtype=np.uint64)
_FACTORS = _rng.integers(0, 2**64, HASHES, dtype=np.uint64) | U64(1)
_STEPS = _rng.integers(0, 2**64, 64, dtype=np.uint64) | U64(1)
_NIBBLES = 0x1111111111111111


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row; fewer words than ``width`` are one shingle."""
    words = Words(data, offsets)
    hashes = words.hashes()
    out = []
    shingled = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for i in range(width):
        shingled += hashes[i:len(hashes) - width + 1 + i] * _STEPS[i % len(_STEPS)]
        shingled = mix(shingled) if i % 2 else shingled
    for first, last in zip(words.rows[:-1].tolist(), words.rows[1:].tolist()):
        if last - first >= width:
            out.append(np.unique(shingled[first:last - width + 1]))
        elif last > first:
            short = np.zeros(1, np.uint64)
            for i in range(first, last):
                short = mix(short + hashes[i:i + 1] * _STEPS[(i - first + 17) % len(_STEPS)])
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _minima(sets: list[np.ndarray]) -> np.ndarray:
    """Minima of every hash function over each non-empty set: sets x HASHES."""
    flat = np.concatenate(sets)
    firsts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), HASHES), np.uint64)
    scratch = np.empty_like(flat)
    for k in range(HASHES):
        np.bitwise_xor(flat, _MASKS[k], out=scratch)
        np.multiply(scratch, _FACTORS[k], out=scratch)
        out[:, k] = np.minimum.reduceat(scratch, firsts)
    return mix(out)


def _bands(minima: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(minima), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        keys = mix(keys * _STEPS[i] + minima[:, i::ROWS])
    return keys


def _packed(minima: np.ndarray) -> np.ndarray:
    """The low bits of each minimum, 16 to a 64-bit word."""
    low = (minima & U64(2**BITS - 1)).reshape(len(minima), HASHES * BITS // 64, 64 // BITS)
    return np.bitwise_or.reduce(low << (np.arange(64 // BITS, dtype=np.uint64) * U64(BITS)), axis=2)


SIGNED = ("doc_id long, n_shingles long, set_key binary, bands array<long>, "
          "signature array<long>")


def _sign(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            data, offsets = flatten(batch.column("text"))
            for first, last, part, at in slices(data, offsets):
                sets = shingle_sets(part, at, width)
                full = [s for s in sets if len(s)]
                rows = len(full)
                minima = _minima(full) if rows else np.zeros((0, HASHES), np.uint64)
                spread = iter(zip(_bands(minima).view(np.int64), _packed(minima).view(np.int64)))
                bands, signatures, keys = [], [], []
                for s in sets:
                    band, signature = next(spread) if len(s) else (None, None)
                    bands.append(band)
                    signatures.append(signature)
                    keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, last - first),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(keys, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64())),
                     pa.array(signatures, pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "set_key", "bands", "signature"])
    return run


def sign(docs: DataFrame, width: int = 4) -> DataFrame:
    """Size, set key, band keys and packed low bits of each document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(_sign(width), SIGNED)


def estimate(a: Column, b: Column) -> Column:
    """Similarity of two packed signatures, corrected for chance agreement of low bits."""
    def differing(i: int) -> Column:
        x = a[i].bitwiseXOR(b[i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        return F.bit_count(x.bitwiseAND(F.lit(_NIBBLES)))
    equal = F.lit(HASHES)
    for i in range(HASHES * BITS // 64):
        equal = equal - differing(i)
    chance = 2.0 ** -BITS
    return (equal / HASHES - chance) / (1 - chance)


def _verify(width: int, percent: int):
    """Rows come sorted by (hub, part, role): each hub text ahead of its members."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_set = None, np.zeros(0, np.uint64)
        for batch in batches:
            hubs = batch.column("a").to_pylist()
            roles = batch.column("role").to_pylist()
            ids = batch.column("id").to_pylist()
            data, offsets = flatten(batch.column("text"))
            left, right = [], []
            for first, last, part, at in slices(data, offsets):
                for i, members in enumerate(shingle_sets(part, at, width), first):
                    if roles[i] == 0:
                        hub, hub_set = hubs[i], members
                    elif hub == hubs[i] and len(members) and len(hub_set):
                        both = len(np.intersect1d(hub_set, members, assume_unique=True))
                        if 100 * both >= percent * (len(hub_set) + len(members) - both):
                            left.append(hub)
                            right.append(ids[i])
            yield pa.RecordBatch.from_arrays(
                [pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])
    return run


def confirm(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The written pairs (a, b) whose full shingle sets reach the threshold.

    Members meet their hub in parts of a bounded size; the hub's text is sent to each part.
    """
    texts = keep_ids(
        docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string")
                    .alias("text")),
        stage(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids"), "id")
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).alias("parts"))
    members = pairs.join(sizes, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"), F.lit(1).alias("role"),
        F.col("b").alias("id"))
    hubs = sizes.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
                        .alias("part"), F.lit(0).alias("role"), F.col("a").alias("id"))
    rows = members.unionByName(hubs).join(texts, "id").select("a", "part", "role", "id", "text")
    return (rows.repartition("a", "part").sortWithinPartitions("a", "part", "role")
            .mapInArrow(_verify(width, percent), "a long, b long"))


def _set_of(width: int):
    """Sorted shingle hashes of each text, as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flatten(batch.column("text"))
            for first, last, part, at in slices(data, offsets):
                sets = [s.tobytes() for s in shingle_sets(part, at, width)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(first, last - first), pa.array(sets, pa.binary())], ["id", "shingles"])
    return run


class _Overlap:
    """Sizes of intersections of sets; those of many sets are counted on bit rows of their shared elements."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets, self.bits = sets, None
        flat = np.concatenate(sets)
        if len(sets) < FEW_SETS:
            return
        _, place, count = np.unique(flat, return_inverse=True, return_counts=True)
        shared = count > 1
        column = np.cumsum(shared) - 1
        words = int(shared.sum()) // 64 + 1
        if len(sets) * words * 8 > BIT_BYTES:
            return
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[shared[place]]
        at = column[place][shared[place]]
        self.bits = np.zeros((len(sets), words), np.uint64)
        np.bitwise_or.at(self.bits, (owner, at >> 6), U64(1) << (at & 63).astype(np.uint64))

    def __call__(self, one: int, others: np.ndarray) -> Iterator[int]:
        if self.bits is not None:
            return iter(np.bitwise_count(self.bits[one] & self.bits[others]).sum(axis=1, dtype=np.int64).tolist())
        return (len(np.intersect1d(self.sets[one], self.sets[k], assume_unique=True)) for k in others)


def _link_block(percent: int, least: float):
    """Links between members of one block pair of a bucket that join different components.

    A pair is looked at in the first bucket that it shares, and only while it is in different
    components; so a block pair has fewer links than members.
    """
    def run(table: pa.Table) -> pa.Table:
        ids = table["id"].to_numpy()
        roots = np.unique(table["component"].to_numpy(), return_inverse=True)[1]
        sizes = table["n_shingles"].to_numpy()
        blocks = table["block"].to_numpy()
        i, j, band = (table[name][0].as_py() for name in ("i", "j", "band"))
        words = np.stack(table["signature"].to_pylist()).astype(np.int64).view(np.uint64)
        bands = np.stack(table["bands"].to_pylist())[:, :band]
        overlap = _Overlap([np.frombuffer(s.as_buffer(), np.uint64) for s in table["shingles"]])
        left, right = [], []
        others = np.flatnonzero(blocks == j)
        for row in np.flatnonzero(blocks == i):
            near = (roots[others] != roots[row]) & (100 * np.minimum(sizes[row], sizes[others])
                                                    >= percent * np.maximum(sizes[row], sizes[others]))
            if i == j:
                near &= others > row
            found = others[near]
            found = found[~(bands[found] == bands[row]).any(axis=1)]
            x = words[row] ^ words[found]
            x |= x >> U64(1)
            x |= x >> U64(2)
            equal = HASHES - np.bitwise_count(x & U64(_NIBBLES)).sum(axis=1)
            chance = 2.0 ** -BITS
            looks = (equal / HASHES - chance) / (1 - chance)
            found = found[looks >= least]
            for k, both in zip(found, overlap(row, found)):
                if roots[k] != roots[row] and 100 * both >= percent * (sizes[row] + sizes[k] - both):
                    left.append(ids[row])
                    right.append(ids[k])
                    roots[roots == roots[k]] = roots[row]
        return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})
    return run


def near_duplicates(docs: DataFrame, width: int = 4, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Links join documents whose distinct ``width``-word shingles have a Jaccard similarity of
    at least ``percent`` / 100. ``component_id`` is the smallest doc_id reachable by links;
    ``kept`` marks it. Band buckets miss a link at 0.8 with a probability of 5e-8.

    A text that is null, empty or without words is linked with nothing and kept. Rows that
    share a doc_id are one document to the links, and each is returned. A row without doc_id
    is linked with nothing: its component is null and it is kept. Extra columns are ignored.
    """
    signed = stage(sign(docs, width), "signed")
    classes = signed.filter("set_key is not null and doc_id is not null").groupBy("set_key").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("_n"))
    copies = stage(classes.filter("_n > 1").drop("_n"), "classes")
    labelled = signed.select("doc_id", "n_shingles", "set_key").join(copies, "set_key", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"))
    labelled = stage(labelled, "labelled")

    firsts = stage(
        signed.filter("set_key is not null and doc_id is not null")
        .join(copies, "set_key", "left").filter("class_id is null or class_id = doc_id")
        .groupBy("doc_id", "set_key").agg(
            F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"),
            F.first("signature").alias("signature"))
        .select(F.col("doc_id").alias("id"), "n_shingles", "bands", "signature"), "firsts")
    signatures = firsts.select("id", "n_shingles", "signature")

    entries = firsts.select("id", "n_shingles", F.posexplode("bands").alias("band", "bucket"))
    shared = (entries.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("members"), F.sum("n_shingles").alias("shingles_in"), F.min("id").alias("lo"), F.max("id").alias("hi"))
        .filter("members > 1"))
    buckets = stage(entries.drop("n_shingles").join(shared, "bucket"), "buckets")
    least = percent / 100 - SLACK

    def similar(pairs: DataFrame) -> DataFrame:
        both = pairs.join(signatures.select(
            F.col("id").alias("a"), F.col("n_shingles").alias("_na"), F.col("signature").alias("_sa")),
            "a").join(signatures.select(
                F.col("id").alias("b"), F.col("n_shingles").alias("_nb"),
                F.col("signature").alias("_sb")), "b")
        return both.filter(
            (100 * F.least("_na", "_nb") >= percent * F.greatest("_na", "_nb"))
            & (estimate(F.col("_sa"), F.col("_sb")) >= least)).select("a", "b")

    stars = buckets.select(F.explode(F.array_distinct(F.array("lo", "hi"))).alias("a"),
                           F.col("id").alias("b")).filter("a <> b").distinct()
    # A pair of two representatives would come both ways.
    stars = stars.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"),
                         "a", "b").groupBy("x", "y").agg(F.min("a").alias("a"), F.max("b").alias("b"),
                                                         F.count(F.lit(1)).alias("n"))
    stars = stars.select(F.when(F.col("n") == 1, F.col("a")).otherwise(F.col("x")).alias("a"),
                         F.when(F.col("n") == 1, F.col("b")).otherwise(F.col("y")).alias("b"))
    first_pairs = stage(similar(stars), "pairs")
    first_links = stage(confirm(first_pairs, docs, width, percent), "links")
    found = stage(components(first_links), "components")

    # Buckets of up to three are decided by their two representatives.
    open_rows = buckets.filter("members > 3").join(found, "id", "left").select(
        "bucket", "band", "id", "members", "shingles_in", F.coalesce("component", "id").alias("component"))
    mixed = open_rows.groupBy("bucket").agg(
        F.min("component").alias("_lo"), F.max("component").alias("_hi")).filter("_lo <> _hi")
    rest = stage(open_rows.join(mixed.select("bucket"), "bucket"), "mixed")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    sets = keep_ids(texts, stage(rest.select("id").distinct(), "ids"), "id").mapInArrow(
        _set_of(width), "id long, shingles binary")
    members = firsts.join(sets, "id")
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("shingles_in") / BLOCK_SHINGLES)).cast("long")
    rest = (rest.withColumn("blocks", blocks)
            .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
            .drop("members", "shingles_in", "blocks", "other"))
    second_links = rest.join(members, "id").groupBy("bucket", "i", "j").applyInArrow(
        _link_block(percent, least), "a long, b long")
    links = stage(first_links.unionByName(second_links), "links")
    final = components(links)
    return labelled.join(final.withColumnRenamed("id", "class_id"), "class_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "class_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("component", "class_id")).alias("kept"))
