"""Removal of passages that repeat byte for byte, over range-partitioned suffixes.

Every start of a 100-byte string is tied to an anchor: of the 32-byte strings inside it, the
one with the least hash, the leftmost first. Equal strings have equal anchors, so suffixes
need to be compared only with those that have the same anchor, and those whose anchor
occurs once in the whole corpus are settled without travelling. The others are
range-partitioned by sampled splitters over the leading bytes of their anchors; in a bucket those that equal
no other are let go by a rolling hash, and the others are sorted by multikey quicksort, eight bytes to a symbol.
Equal strings share the splitter key, so no group of them crosses a boundary between buckets. Buckets are ranges of
anchors, so their order is that of anchors, not of whole suffixes.

Within a slice of texts equal runs are settled before the shuffle, so a passage in a third of
all documents reaches its bucket once per slice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shardweave.llm.flat import (U64, flatten, mix, powers, prefix_sums, ranges, rolling, runs,
                                 slices)
from shardweave.llm.packed import by_route, pack, unpack_all
from shardweave.llm.rowkeys import row_key
from shardweave.staging import stage

GRAM, ANCHOR = 100, 32
ROUTE_KEYS, BUCKET_KEYS, SAMPLE = 2_000_000, 30_000, 20_000
LOW = U64(0xFFFFFFFF)
PART_BYTES = 1 << 19


def anchor_runs(data: np.ndarray, offsets: np.ndarray):
    """Runs of starts with one anchor: row, first start, last start, anchor key."""
    found = []
    for begin, end, part, at in slices(data, offsets, PART_BYTES):  # of a few rows, to keep arrays small
        row, first, last, key = _part_runs(part, at)
        found.append((row + begin, first + offsets[begin], last + offsets[begin], key))
    return [np.concatenate(arrays) for arrays in zip(*found)] if found else _part_runs(data, offsets)


def _part_runs(data: np.ndarray, offsets: np.ndarray):
    none = np.zeros(0, np.int64)
    if len(data) < GRAM:
        return none, none, none, np.zeros(0, np.uint64)
    h = rolling(data, ANCHOR)
    least = (h & ~LOW) | np.arange(len(h), dtype=np.uint64)
    for step in (1, 2, 4, 8, 16, 32, 5):  # a window of 69 starts
        least = np.minimum(least[:-step], least[step:])
    at = (least & LOW).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(at)]
    valid = np.arange(len(at)) + GRAM <= offsets[1:][row]
    edge = np.ones(len(at) + 1, bool)
    edge[1:-1] = (at[1:] != at[:-1]) | (valid[1:] != valid[:-1]) | (row[1:] != row[:-1])
    cuts = np.flatnonzero(edge)
    first, last = cuts[:-1], cuts[1:] - 1
    ok = valid[first]
    first, last = first[ok], last[ok]
    a = at[first]
    lead = np.zeros(len(a), np.uint64)
    for i in range(4):
        lead = (lead << U64(8)) | data[a + i].astype(np.uint64)
    return row[first], first, last, (lead << U64(32)) | (h[a] & LOW)


def _anchors(routes: int):
    """Anchor keys by receiver (kind 0), and those known to repeat by document (kind 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("_key").to_numpy(zero_copy_only=False)
            data, offsets = flatten(batch.column("text"))
            for begin, end, part, at in slices(data, offsets):
                row, _, _, key = anchor_runs(part, at)
                if not len(key):
                    continue
                doc = keys[begin:end][row]
                distinct, index, back, count = np.unique(
                    key, return_index=True, return_inverse=True, return_counts=True)
                out = [(0, r, pack(*arrays)) for r, arrays in by_route(
                    (mix(distinct) % U64(routes)).astype(np.int64), distinct, doc[index])]
                again = count[back] > 1
                out += [(1, d, k.tobytes()) for d, (k,) in by_route(doc[again], key[again])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int64()),
                     pa.array([o[2] for o in out], pa.binary())], ["kind", "to", "packed"])
    return run


def _repeated(table: pa.Table) -> pa.Table:
    key, doc = unpack_all(table["packed"].to_pylist(), ("u8", "i8"))
    order = np.argsort(key, kind="stable")
    key, doc = key[order], doc[order]
    first = runs(key)
    count = np.diff(np.append(first, len(key)))
    again = np.repeat(count > 1, count)
    out = [(d, k.tobytes()) for d, (k,) in by_route(doc[again], key[again])]
    return pa.table({"_key": pa.array([o[0] for o in out], pa.int64()),
                     "packed": pa.array([o[1] for o in out], pa.binary())})


def _sampled(mask: int):
    def run(batches):
        for batch in batches:
            key = np.frombuffer(b"".join(batch.column("packed").to_pylist()), np.uint64)
            key = np.unique(key[(mix(key) & U64(mask)) == 0])
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], ["key"])
    return run


def _suffixes(splitters: np.ndarray):
    """Runs of suffixes by bucket (kind 0), and settled byte ranges by document (kind 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("_key").to_numpy(zero_copy_only=False)
            ids = batch.column("_order").to_numpy(zero_copy_only=False)
            wanted = batch.column("wanted").to_pylist()
            data, offsets = flatten(batch.column("text"))
            for begin, end, part, at in slices(data, offsets):
                row, first, last, key = anchor_runs(part, at)
                keep = np.zeros(len(key), bool)
                bounds = np.searchsorted(row, np.arange(end - begin + 1))
                seen: set[int] = set()
                for i in range(end - begin):
                    if keys[begin + i] in seen:  # another row of the same document
                        continue
                    seen.add(keys[begin + i])
                    here = slice(bounds[i], bounds[i + 1])
                    keep[here] = np.isin(key[here], np.frombuffer(b"".join(wanted[begin + i]), np.uint64))
                row, first, last, key = row[keep], first[keep], last[keep], key[keep]
                if not len(key):
                    continue
                doc, order = keys[begin:end][row], ids[begin:end][row]
                sums = prefix_sums(part)
                _, inverse = powers(len(part) + 1)
                content = mix((sums[last + GRAM] - sums[first]) * inverse[first] + key
                              + mix((last - first).astype(np.uint64)))
                ranked = np.lexsort((first, doc, order))
                _, earliest = np.unique(content[ranked], return_index=True)
                fresh = np.zeros(len(key), bool)
                fresh[ranked[earliest]] = True
                start = first - at[row]
                stale = ~fresh
                out = [(1, d, pack(*arrays), None) for d, arrays in by_route(
                    doc[stale], start[stale], (start + last - first + GRAM)[stale])]
                bucket = np.searchsorted(splitters, key, "right")
                length = last - first + 1
                for b, arrays in by_route(bucket[fresh], order[fresh], doc[fresh], start[fresh],
                                          length[fresh], first[fresh]):
                    body = part[ranges(arrays[4], arrays[3] + GRAM - 1)].tobytes()
                    out.append((0, b, pack(*arrays[:4]), body))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int64()),
                     pa.array([o[2] for o in out], pa.binary()),
                     pa.array([o[3] for o in out], pa.binary())], ["kind", "to", "packed", "body"])
    return run


def _symbols(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as one number in byte order."""
    return np.ndarray(max(0, len(data) - 7), ">u8", data, strides=(1,))


def multikey_order(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Order of suffixes that differ within GRAM bytes.

    Multikey quicksort: suffixes are sorted by their first symbol; ties are parted into those below, at
    and above a pivot's next symbol, for all open groups at once, and those at it go on with the one after.
    """
    words = _symbols(data)
    offsets = [*range(0, GRAM - 7, 8), GRAM - 8]  # the last symbol may overlap the one before
    symbol = words[starts].astype(np.uint64)
    order = np.argsort(symbol)
    bounds = np.append(runs(symbol[order]), len(starts))
    depth = np.ones(len(bounds) - 1, np.int64)
    while True:
        sizes = np.diff(bounds)
        # Groups of one, and those compared to the end, are in place.
        open_ = (sizes > 1) & (depth < len(offsets))
        if not open_.any():
            return order
        first, size, level = bounds[:-1][open_], sizes[open_], depth[open_]
        at = ranges(first, size)
        group = np.repeat(np.arange(len(size)), size)
        symbol = words[starts[order[at]] + np.array(offsets)[level][group]].astype(np.uint64)
        pivot = symbol[(np.cumsum(size) - size) + size // 2][group]
        side = (symbol > pivot).astype(np.int64) - (symbol < pivot) + 1
        part = np.argsort(group * 3 + side, kind="stable")
        order[at] = order[at][part]
        counts = np.bincount(group * 3 + side, minlength=3 * len(size))
        filled = counts > 0
        inner = (np.repeat(first, 3) + np.concatenate(
            [np.zeros((len(size), 1), np.int64), np.cumsum(counts.reshape(-1, 3), axis=1)[:, :2]], axis=1).ravel())[filled]
        deeper = (np.repeat(level, 3) + np.tile([0, 1, 0], len(size)))[filled]
        bounds = np.concatenate((bounds[:-1][~open_], inner))
        depth = np.concatenate((depth[~open_], deeper))
        ranked = np.argsort(bounds)
        bounds, depth = np.append(bounds[ranked], len(starts)), depth[ranked]


def _all_equal(data: np.ndarray, one: np.ndarray, other: np.ndarray) -> bool:
    """Whether the GRAM bytes from ``one[i]`` and from ``other[i]`` on are equal, for all i.

    Neighbouring pairs at one distance share all but a byte, so each stretch of them is compared once.
    """
    order = np.argsort(one)
    one, shift = one[order], (other - one)[order]
    new = np.ones(len(one), bool)
    new[1:] = (one[1:] - one[:-1] > 1) | (shift[1:] != shift[:-1])
    cuts = np.flatnonzero(new)
    ends = np.append(cuts[1:], len(one)) - 1
    lengths = one[ends] - one[cuts] + GRAM
    at = ranges(one[cuts], lengths)
    return bool((data[at] == data[at + np.repeat(shift[cuts], lengths)]).all())


def _equal_sets(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that agree with another on GRAM bytes, set by set, and the sizes of the sets.

    A rolling hash tells which are alone; the others are compared byte by byte with the first of their set.
    """
    hashes = rolling(data, GRAM)[starts]
    active = np.argsort(hashes)
    first = runs(hashes[active])
    count = np.diff(np.append(first, len(active)))
    active, count = active[np.repeat(count > 1, count)], count[count > 1]
    if not len(active):
        return active, count
    head = np.repeat(np.minimum.reduceat(active, np.cumsum(count) - count), count)
    if _all_equal(data, starts[active], starts[head]):
        return active, count
    words = _symbols(data)
    while True:  # different strings with one hash: those unlike the first become a set of their own
        head = active[np.repeat(np.cumsum(count) - count, count)]
        same = np.ones(len(active), bool)
        for i in (*range(0, GRAM - 7, 8), GRAM - 8):
            same &= words[starts[active] + i] == words[starts[head] + i]
        if same.all():
            break
        group = np.repeat(np.arange(len(count)), count) * 2 + ~same
        parted = np.argsort(group, kind="stable")
        active, group = active[parted], group[parted]
        count = np.diff(np.append(runs(group), len(active)))
    return active[np.repeat(count > 1, count)], count[count > 1]


def multikey_groups(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that agree with another on GRAM bytes, in sorted order, and their group.

    Equal ones are sorted once.
    """
    if len(starts) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    active, count = _equal_sets(data, starts)
    head = np.cumsum(count) - count
    order = multikey_order(data, starts[active[head]]) if len(count) else count
    return active[ranges(head[order], count[order])], np.repeat(np.arange(len(order)), count[order])


def _sort_bucket(table: pa.Table) -> pa.Table:
    order, doc, start, length = unpack_all(table["packed"].to_pylist(), ("i8", "i8", "i8", "i8"))
    data = np.frombuffer(b"".join(table["body"].to_pylist()), np.uint8)
    # Runs in document order, so that the number of a suffix tells which of two is earlier.
    ranked = np.lexsort((start, doc, order))
    sizes = length + GRAM - 1
    begin = (np.cumsum(sizes) - sizes)[ranked]
    doc, start, length = doc[ranked], start[ranked], length[ranked]
    at = ranges(begin, length)
    active, group = multikey_groups(data, at)
    run = np.repeat(np.arange(len(length)), length)
    pos = ranges(start, length)
    gone = np.zeros(len(at), bool)
    if len(active):
        firsts = runs(group)
        head = np.repeat(np.minimum.reduceat(active, firsts), np.diff(np.append(firsts, len(group))))
        gone[active[(doc[run[active]] != doc[run[head]]) | (pos[active] != pos[head])]] = True
    later = np.flatnonzero(gone)
    doc, pos = doc[run[later]], pos[later]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (pos[1:] > pos[:-1] + 1)
    cuts = np.flatnonzero(new)
    ends = np.append(cuts[1:], len(doc)) - 1
    if not len(doc):
        cuts = ends = np.zeros(0, np.int64)
    out = [(d, pack(*arrays)) for d, arrays in by_route(doc[cuts], pos[cuts], pos[ends] + GRAM)]
    return pa.table({"_key": pa.array([o[0] for o in out], pa.int64()),
                     "packed": pa.array([o[1] for o in out], pa.binary())})


REMOVED = "kept_text string, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = batch.column("marks").to_pylist()
        data, offsets = flatten(batch.column("text"))
        texts, removed, spans, digests = [], [], [], []
        for i, packed in enumerate(marks):
            text = data[offsets[i]:offsets[i + 1]]
            n = s = 0
            if packed:
                begin, end = unpack_all(packed, ("i8", "i8"))
                edges = np.zeros(len(text) + 1, np.int64)
                np.add.at(edges, begin, 1)
                np.add.at(edges, end, -1)
                gone = np.cumsum(edges[:-1]) > 0
                n = int(gone.sum())
                s = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                text = text[~gone]
            raw = text.tobytes()
            texts.append(raw.decode("utf-8", "ignore"))
            removed.append(n)
            spans.append(s)
            digests.append(hashlib.sha256(raw).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), pa.array(texts, pa.string()), pa.array(np.diff(offsets), pa.int64()),
             pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())],
            ["doc", "kept_text", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc (its other columns), kept_text, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes if a 100-byte string over it also starts earlier: in a smaller doc_id, or
    earlier in its document. Null texts are empty. Rows with equal doc_id and text are one
    document; those that share only a doc_id are ordered by a hash of the text; null ids
    come last. ``kept_text`` leaves out what remains of a character that was cut in two.
    """
    spark = docs.sparkSession
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("doc"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("_order"),
        row_key().alias("_key"), F.col("text").cast("string").alias("text"))
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    routes = max(12, -(-size // (26 * ROUTE_KEYS)))
    found = stage(keyed.select("_key", "text").mapInArrow(
        _anchors(routes), "kind int, to long, packed binary"), "anchors")
    local = found.filter("kind = 1").select(F.col("to").alias("_key"), "packed")
    far = found.filter("kind = 0").groupBy("to").applyInArrow(_repeated, "_key long, packed binary")
    wanted = stage(local.unionByName(far), "repeated")
    entries = (wanted.agg(F.sum(F.length("packed"))).first()[0] or 0) // 8
    mask = (1 << max(0, (entries // SAMPLE).bit_length())) - 1
    sample = np.array([r.key for r in wanted.select("packed").mapInArrow(_sampled(mask), "key long")
                       .distinct().collect()], np.int64).view(np.uint64)
    sample.sort()
    buckets = max(12, -(-entries // BUCKET_KEYS))
    splitters = np.unique(sample[np.arange(1, buckets) * len(sample) // buckets]) if len(sample) else sample
    lists = wanted.groupBy("_key").agg(F.collect_list("packed").alias("wanted"))
    suffixes = stage(keyed.select("_key", "_order", "text").join(lists, "_key").mapInArrow(
        _suffixes(splitters), "kind int, to long, packed binary, body binary"), "suffixes")
    settled = suffixes.filter("kind = 1").select(F.col("to").alias("_key"), "packed")
    sorted_ = suffixes.filter("kind = 0").groupBy("to").applyInArrow(_sort_bucket, "_key long, packed binary")
    marks = stage(settled.unionByName(sorted_).groupBy("_key").agg(
        F.collect_list("packed").alias("marks")), "marks")
    schema = StructType([keyed.schema["doc"], *StructType.fromDDL(REMOVED)])
    return keyed.join(marks, "_key", "left").select("doc", "text", "marks").mapInArrow(_cut, schema)
