"""Learning a byte-pair vocabulary from distributed word counts.

Words live in a Spark table of blocks: a row holds the symbol numbers of some thousand
words end to end, their lengths and frequencies, and the counts of the block's pairs. A
pass over it merges, counts and cuts whole blocks with numpy; words without a merged pair
are set aside at once, and those of one symbol leave the table.

Merges must come out in exact order: highest count first, ties to the smaller id
pair. One job per merge would need thousands of jobs, so each round settles many:

1. Count all pairs; call the most frequent few hundred *hot*, with ``floor`` the
   count of the best pair that is not.
2. Cut words at every cold pair. A merge can only create pairs out of neighbours
   that were both hot, so as long as the best count stays above ``floor`` the pieces
   (far fewer than words, and mostly repeated) decide alone what comes next.
3. Group equal pieces. If the result is within a fixed bound, replay merges over it
   until the best count reaches ``floor``; otherwise retry with fewer hot pairs, at
   worst one, whose merge needs no pieces at all.
4. Apply the merges to the blocks, which counts their pairs for the next round.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardweave.functions.bytelevel import BYTE_TO_CHAR, SPECIALS, to_byte_chars, words
from shardweave.operators.bpe_merge import MergeTable, pair_codes
from shardweave.staging import drop_stage, stage

VOCAB_SIZE = 8000
HOT_PAIRS = 64
MAX_HOT_PAIRS = 4096
MAX_PIECES = 50_000
MAX_PIECE_SYMBOLS = 8_000_000
BLOCK_SYMBOLS = 1 << 16

# Between symbols of a spelled word; it cannot occur among byte characters.
_SEP = "\x01"
Pair = tuple[str, str]


@dataclass
class Vocabulary:
    """Learnt tables, bounded by the vocabulary size, so also usable as lists."""

    tokens: list[str]
    merges: list[Pair]
    specials: list[str] = field(default_factory=lambda: list(SPECIALS))
    prefix_space: bool = True

    def id_of(self, token: str) -> int:
        if token not in self.tokens:
            raise ValueError(f"token {token!r} is not defined")
        return self.tokens.index(token)

    def vocab_frame(self, spark: SparkSession) -> DataFrame:
        def kind(token: str) -> str:
            if token in self.specials:
                return "special"
            return "byte" if len(token) == 1 else "merged"

        rows = [(i, t, kind(t)) for i, t in enumerate(self.tokens) if t]
        return spark.createDataFrame(rows, "id int, token string, kind string")

    def merges_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(i, a, b, a + b) for i, (a, b) in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, left string, right string, merged string")


def word_counts(texts: DataFrame, column: str = "text", prefix_space: bool = True) -> DataFrame:
    """``(word, n)``: frequencies of byte-level words; combined before the shuffle."""
    return (texts.select(F.explode(words(F.col(column), prefix_space)).alias("word"))
            .groupBy("word").agg(F.count("*").alias("n")))


def alphabet(counts: DataFrame) -> DataFrame:
    """``(ch)``: every byte character seen; at most 256 rows."""
    return (counts.select(F.explode(F.array_distinct(
        F.split(to_byte_chars(F.col("word")), ""))).alias("ch"))
        .filter("ch <> ''").distinct())


def spelled(word: Column) -> Column:
    """Byte characters of a word, joined as one-character symbols."""
    return F.array_join(F.split(to_byte_chars(word), ""), _SEP)


def pair_counts(state: DataFrame) -> DataFrame:
    """``(left, right, n)``: adjacent symbols, weighted by word frequency."""
    syms = state.select(F.split("word", _SEP).alias("s"), "n").filter(F.size("s") > 1)
    pairs = F.arrays_zip(F.slice("s", F.lit(1), F.size("s") - 1).alias("left"),
                         F.slice("s", F.lit(2), F.size("s") - 1).alias("right"))
    return (syms.select(F.explode(pairs).alias("p"), "n")
            .groupBy(F.col("p.left").alias("left"), F.col("p.right").alias("right"))
            .agg(F.sum("n").alias("n")))


def learn(counts: DataFrame, vocab_size: int = VOCAB_SIZE,
          hot_pairs: int = HOT_PAIRS) -> Vocabulary:
    """Learn ``vocab_size`` tokens from ``(word, n)`` counts; see the module text."""
    state = stage(word_blocks(counts), "bpe-words")
    seen = sorted(_BYTE_CHARS[r.b] for r in
                  state.select(F.explode("seen").alias("b")).distinct().collect())  # at most 256
    ids = {t: i for i, t in enumerate(SPECIALS + seen)}
    # Numbers in the table also cover bytes that do not occur; their order is that of the ids.
    names = SPECIALS + _BYTE_CHARS
    merges: list[Pair] = []
    while len(ids) < vocab_size:
        found, pieces = _round(state, names, ids, vocab_size, hot_pairs)
        if not found:
            break
        # Few pieces leave room for more hot pairs next time, many ask for fewer.
        if pieces * 4 < MAX_PIECES:
            hot_pairs = min(hot_pairs * 4, MAX_HOT_PAIRS)
        elif pieces > MAX_PIECES:
            hot_pairs = max(hot_pairs // 2, 1)
        merges += found
        if len(ids) >= vocab_size:
            break
        named = set(names)
        names += [t for t in dict.fromkeys(a + b for a, b in found) if t not in named]
        merged = stage(apply_merges(state, names, found), "bpe-words")
        drop_stage(state)
        state = merged
    drop_stage(state)
    return Vocabulary(sorted(ids, key=ids.get), merges)


# The 256 byte characters in their order, and the place of each byte among them.
_BYTE_CHARS = sorted(BYTE_TO_CHAR[b] for b in range(256))
_PLACE = np.array([_BYTE_CHARS.index(BYTE_TO_CHAR[b]) for b in range(256)], np.int64)
_BLOCK = "syms array<int>, sizes array<int>, n array<long>, pairs array<long>, totals array<long>"


def _owners(sizes: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(sizes)), sizes)


def _neighbours(syms: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all adjacent symbols, and whether both stand in one word."""
    return pair_codes(syms[:-1], syms[1:]), own[:-1] == own[1:]


def _block(syms: np.ndarray, own: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
    """A row of the word table: words of two symbols or more, and the counts of their pairs."""
    sizes = np.bincount(own, minlength=len(n))
    long = sizes > 1
    keep = long[own]
    syms, own, sizes, n = syms[keep], (np.cumsum(long) - 1)[own[keep]], sizes[long], n[long]
    code, inside = _neighbours(syms, own)
    code, times = code[inside], n[own[:-1][inside]]
    order = np.argsort(code, kind="stable")
    pairs, first = np.unique(code[order], return_index=True)
    totals = np.add.reduceat(times[order], first) if len(first) else times
    return {"syms": syms.astype(np.int32), "sizes": sizes.astype(np.int32), "n": n,
            "pairs": pairs, "totals": totals}


def _rows(blocks: list[dict[str, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        name: pa.array([b[name] for b in blocks], pa.list_(pa.from_numpy_dtype(blocks[0][name].dtype)))
        for name in blocks[0]})


def _values(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    return batch.column(name)[row].values.to_numpy()


def word_blocks(counts: DataFrame) -> DataFrame:
    """The word table of ``(word, n)`` counts, with the byte characters ``seen`` in each block.

    Symbols are numbered after the special tokens.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw: list[bytes] = []
        times: list[np.ndarray] = []
        size = 0

        def row() -> pa.RecordBatch:
            places = _PLACE[np.frombuffer(b"".join(raw), np.uint8)]
            own = _owners(np.array([len(r) for r in raw], np.int64))
            block = _block(places + len(SPECIALS), own, np.concatenate(times))
            return _rows([{**block, "seen": np.unique(places).astype(np.int32)}])

        for batch in batches:
            new = [w.encode() for w in batch.column("word").to_pylist()]
            raw += new
            times.append(batch.column("n").to_numpy())
            size += sum(map(len, new))
            if size >= BLOCK_SYMBOLS:
                yield row()
                raw, times, size = [], [], 0
        if raw:
            yield row()

    # Words are short but costly: a fixed count keeps adaptive execution from folding
    # them into a few tasks.
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (counts.select("word", F.col("n").cast("long").alias("n")).repartition(parts, "word")
            .mapInArrow(cut, f"{_BLOCK}, seen array<int>"))


def apply_merges(state: DataFrame, names: list[str], merges: list[Pair]) -> DataFrame:
    """The word table after ``merges``, in order."""
    number = {t: i for i, t in enumerate(names)}
    # The last merge of a round may rebuild a symbol that earlier ones use, so it
    # runs by itself after them.
    tables = [MergeTable([number[a] for a, _ in part], [number[b] for _, b in part],
                         [number[a + b] for a, b in part]) for part in (merges[:-1], merges[-1:])]

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                syms, own = _values(batch, "syms", i), _owners(_values(batch, "sizes", i))
                for table in tables:
                    syms, own = table.merge(syms, own)
                block = _block(syms, own, _values(batch, "n", i))
                if len(block["syms"]):
                    yield _rows([block])

    return state.select("syms", "sizes", "n").mapInArrow(replay, _BLOCK)


def block_pairs(state: DataFrame) -> DataFrame:
    """``(pair, n)``: codes of adjacent symbols, from the counts of the blocks."""
    return (state.select(F.explode(F.arrays_zip("pairs", "totals")).alias("p"))
            .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.totals").alias("n")))


def hot_pieces(state: DataFrame, hot: list[int]) -> DataFrame:
    """``(piece, n)``: stretches of words in which every neighbouring pair is hot, as the
    bytes of their 32-bit symbol numbers."""
    wanted = np.array(sorted(hot), np.int64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                syms, own = _values(batch, "syms", i), _owners(_values(batch, "sizes", i))
                code, inside = _neighbours(syms, own)
                spot = np.minimum(np.searchsorted(wanted, code), len(wanted) - 1)
                ends = np.flatnonzero(~(inside & (wanted[spot] == code))) + 1
                first, last = np.append(0, ends), np.append(ends, len(syms))
                several = last - first > 1
                first, last = first[several], last[several]
                data, times = syms.astype("<i4").tobytes(), _values(batch, "n", i)[own[first]]
                total: Counter[bytes] = Counter()
                for a, b, n in zip((first * 4).tolist(), (last * 4).tolist(), times.tolist()):
                    total[data[a:b]] += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(total.keys(), pa.binary()), pa.array(total.values(), pa.int64())], ["piece", "n"])

    return (state.select("syms", "sizes", "n").mapInArrow(cut, "piece binary, n long")
            .groupBy("piece").agg(F.sum("n").alias("n")))


def merge_symbols(syms: list[str], ranks: dict[Pair, int]) -> list[str]:
    """Merge the best-ranked neighbouring pair until no neighbours are ranked."""
    if len(syms) > 200:
        return _merge_long(syms, ranks)
    syms = list(syms)
    while True:
        ranked = [(ranks[p], i) for i, p in enumerate(zip(syms, syms[1:])) if p in ranks]
        if not ranked:
            return syms
        at = min(ranked)[1]
        syms[at:at + 2] = [syms[at] + syms[at + 1]]


def _merge_long(syms: list[str], ranks: dict[Pair, int]) -> list[str]:
    """Same result in O(n log n), for the rare word that is a page long."""
    syms = list(syms)
    after = list(range(1, len(syms) + 1))
    before = list(range(-1, len(syms) - 1))
    queue = [(ranks[p], i, p) for i, p in enumerate(zip(syms, syms[1:])) if p in ranks]
    heapq.heapify(queue)
    while queue:
        _, i, pair = heapq.heappop(queue)
        j = after[i] if syms[i] else len(syms)
        if j >= len(syms) or (syms[i], syms[j]) != pair:
            continue
        syms[i], syms[j] = syms[i] + syms[j], ""
        after[i] = after[j]
        if after[i] < len(syms):
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < len(syms) and (syms[a], syms[b]) in ranks:
                new = syms[a], syms[b]
                heapq.heappush(queue, (ranks[new], a, new))
    return [s for s in syms if s]


def _round(state: DataFrame, names: list[str], ids: dict[str, int], vocab_size: int,
           hot_pairs: int) -> tuple[list[Pair], int]:
    """The next merges in exact order, at least one unless no pair is left.

    Also returns the number of pieces the first try led to.
    """
    pairs = block_pairs(state)
    wanted = hot_pairs
    while True:
        # Codes order pairs as their ids do.
        top = [(r.pair, r.n) for r in pairs.orderBy(F.desc("n"), "pair").limit(wanted + 1).collect()]
        if not top:
            return [], 0
        floor = top[-1][1] if len(top) > wanted else 0
        hot = [p for p, n in top if n > floor]
        if hot or wanted >= MAX_HOT_PAIRS:
            break
        wanted *= 2  # one big tie: look further for its end
    first_rows = 0
    while len(hot) > 1:
        pieces = stage(hot_pieces(state, hot), "bpe-pieces")
        rows, size = pieces.agg(
            F.count("*"), F.coalesce(F.sum(F.length("piece")), F.lit(0)) / 4).first()
        first_rows = first_rows or rows
        found = pieces.collect() if rows <= MAX_PIECES and size <= MAX_PIECE_SYMBOLS else None
        drop_stage(pieces)
        if found is not None:
            spelt = [([names[i] for i in np.frombuffer(r.piece, "<i4").tolist()], r.n) for r in found]
            return _replay(spelt, ids, floor, vocab_size), first_rows
        keep = len(hot) // 4
        floor = top[keep][1]
        hot = [p for p, n in top if n > floor]
    best = names[top[0][0] >> 32], names[top[0][0] & 0xFFFFFFFF]
    ids.setdefault("".join(best), len(ids))
    return [best], first_rows


def _replay(pieces: list[tuple[list[str], int]], ids: dict[str, int], floor: int,
            vocab_size: int) -> list[Pair]:
    """Merges over the bounded pieces while the best count exceeds ``floor``.

    Extends ``ids``. Stops early after a merge whose string already had an id, since
    equal symbols built in different ways could hide behind different cuts.
    """
    counts: Counter[Pair] = Counter()
    where: dict[Pair, set[int]] = defaultdict(set)
    for i, (syms, n) in enumerate(pieces):
        for pair in zip(syms, syms[1:]):
            counts[pair] += n
            where[pair].add(i)

    def entry(pair: Pair) -> tuple:
        return -counts[pair], ids[pair[0]], ids[pair[1]], pair

    heap = [entry(pair) for pair in counts]
    heapq.heapify(heap)
    merges: list[Pair] = []
    while heap and len(ids) < vocab_size:
        seen, _, _, pair = heapq.heappop(heap)
        if -seen != counts[pair]:
            if counts[pair] > 0:
                heapq.heappush(heap, entry(pair))
            continue
        if counts[pair] <= floor:
            break
        merged = "".join(pair)
        known = merged in ids
        ids.setdefault(merged, len(ids))
        merges.append(pair)
        if known:
            break
        # Only pairs next to a merged place change.
        touched: set[Pair] = set()
        for i in where.pop(pair):
            syms, n = pieces[i]
            out: list[str] = []
            at = 0
            while at < len(syms):
                if at + 1 == len(syms) or (syms[at], syms[at + 1]) != pair:
                    out.append(syms[at])
                    at += 1
                    continue
                counts[pair] -= n
                if out:
                    counts[out[-1], pair[0]] -= n
                    counts[out[-1], merged] += n
                    where[out[-1], merged].add(i)
                    touched.add((out[-1], merged))
                if at + 2 < len(syms):
                    counts[pair[1], syms[at + 2]] -= n
                    counts[merged, syms[at + 2]] += n
                    where[merged, syms[at + 2]].add(i)
                    touched.add((merged, syms[at + 2]))
                out.append(merged)
                at += 2
            pieces[i] = out, n
        for new in touched:
            if counts[new] > floor:
                heapq.heappush(heap, entry(new))
    return merges


def _merge_once(syms: list[str], pair: Pair) -> list[str]:
    out: list[str] = []
    at = 0
    while at < len(syms):
        if at + 1 < len(syms) and (syms[at], syms[at + 1]) == pair:
            out.append(syms[at] + syms[at + 1])
            at += 2
        else:
            out.append(syms[at])
            at += 1
    return out
