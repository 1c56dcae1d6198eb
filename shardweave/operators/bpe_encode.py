"""Encoding documents with a byte-pair vocabulary, and decoding ids.

Words are independent of each other, so a document is cut into words inside the JVM
and each word is looked up. Encoding is map-only: at any scale the alternative,
exploding words and joining them back, would shuffle the corpus twice and pile the
most common word onto one task. A task merges the distinct words of an Arrow batch
all at once, one numpy step per round of merges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardweave.functions.arrays import runs
from shardweave.functions.bytelevel import (
    BOS, BYTE_TO_CHAR, EOS, UNK, from_byte_chars, words, words_with_specials)
from shardweave.operators.bpe_merge import MergeTable
from shardweave.operators.bpe_train import Vocabulary, merge_symbols

# Vocabularies below this size are exported as 16-bit numbers.
MAX_VOCAB = 65_536
# Longer words are merged one by one, with a queue.
LONG_WORD = 200
#: Words that a task looks up at a time.
RUN_WORDS = 1 << 20


def check_width(vocab_size: int) -> int:
    if vocab_size >= MAX_VOCAB:
        raise ValueError(f"vocabulary of {vocab_size} does not fit 16-bit ids")
    return vocab_size


def id_dtype(vocab_size: int) -> str:
    """The number format of exported ids."""
    return "uint16" if vocab_size < MAX_VOCAB else "uint32"


def word_lookup(vocab: Vocabulary):
    """Arrow function from word lists to id lists."""
    ids = {t: i for i, t in enumerate(vocab.tokens)}
    unknown = ids.get(UNK, -1)
    of_byte = np.array([ids.get(BYTE_TO_CHAR[b], unknown) for b in range(256)], np.int64)
    specials = {s: ids[s] for s in vocab.specials if s in ids}

    table = MergeTable([ids[a] for a, _ in vocab.merges], [ids[b] for _, b in vocab.merges],
                       [ids[a + b] for a, b in vocab.merges])
    text_ranks: dict = {}
    for rank, pair in enumerate(vocab.merges):
        text_ranks.setdefault(pair, rank)

    def encode_words(distinct: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each word has."""
        raw = [b"" if w in specials else w.encode() for w in distinct]
        done = [(np.array([specials[w]]), np.array([i])) for i, w in enumerate(distinct)
                if w in specials]
        for i, r in enumerate(raw):
            if len(r) > LONG_WORD:
                merged = merge_symbols([BYTE_TO_CHAR[b] for b in r], text_ranks)
                done.append((np.array([ids.get(s, unknown) for s in merged]),
                             np.full(len(merged), i)))
                raw[i] = b""
        syms = of_byte[np.frombuffer(b"".join(raw), np.uint8)]
        own = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
        done.append(table.merge(syms, own))
        pool = np.concatenate([d[0] for d in done] or [np.zeros(0, np.int64)])
        owner = np.concatenate([d[1] for d in done] or [np.zeros(0, np.int64)])
        order = np.argsort(owner, kind="stable")
        pool, owner = pool[order], owner[order]
        return (pool[pool >= 0].astype(np.int32),
                np.bincount(owner[pool >= 0], minlength=len(raw)))

    def encode(lists: pa.Array) -> pa.Array:
        per_list = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        return pa.concat_arrays([encode_run(lists[first:past]) for first, past in runs(per_list, RUN_WORDS)] or [
            pa.array([], pa.list_(pa.int32()))])

    def encode_run(lists: pa.Array) -> pa.Array:
        coded = lists.flatten().dictionary_encode()
        pool, sizes = encode_words(coded.dictionary.to_pylist())
        # Gather the ids of all words of the batch without touching them one by one.
        starts = np.cumsum(sizes) - sizes
        at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        lengths = sizes[at]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        take = np.arange(ends[-1]) + np.repeat(starts[at] - ends[:-1], lengths)
        per_list = [n or 0 for n in lists.value_lengths().to_pylist()]
        offsets = ends[np.concatenate([[0], np.cumsum(per_list)]).astype(np.int64)]
        return pa.ListArray.from_arrays(
            pa.array(offsets.astype(np.int32)), pa.array(pool[take], pa.int32()),
            mask=lists.is_null())

    return encode


def encode(text: Column, vocab: Vocabulary, add_specials: bool = False,
           specials_in_text: str = "match") -> Column:
    """Ids of ``text``. With ``add_specials`` they stand between BOS and EOS.

    ``specials_in_text``: "match" turns literal special tokens in the text into their
    ids; "escape" treats them as plain characters.
    """
    if specials_in_text not in ("match", "escape"):
        raise ValueError(f"unknown policy: {specials_in_text}")
    if specials_in_text == "match" and vocab.specials:
        cut = words_with_specials(text, vocab.specials, vocab.prefix_space)
    else:
        cut = words(text, vocab.prefix_space)
    ids = F.arrow_udf(word_lookup(vocab), T.ArrayType(T.IntegerType()))(cut)
    if add_specials:
        ids = F.concat(F.array(F.lit(vocab.id_of(BOS))), ids, F.array(F.lit(vocab.id_of(EOS))))
    return ids


def word_ids(counts: DataFrame, vocab: Vocabulary) -> DataFrame:
    """``(word, ids)`` of a table of distinct words."""
    lookup = F.arrow_udf(word_lookup(vocab), T.ArrayType(T.IntegerType()))
    return counts.select("word", lookup(F.array("word")).alias("ids"))


def decode(ids: Column, vocab: Vocabulary, skip_specials: bool = True) -> Column:
    """Text of ``ids``, without specials unless told otherwise. Runs inside the JVM.

    Text that did not start with a space comes back with the space encoding added.
    """
    hidden = set(vocab.specials) if skip_specials else set()
    tokens = F.split(F.lit("\x01".join("" if t in hidden else t for t in vocab.tokens)), "\x01")
    return from_byte_chars(F.array_join(F.transform(ids, lambda i: F.get(tokens, i)), ""))


def text_decoder(vocab: Vocabulary, skip_specials: bool = True):
    """``decode`` as a function that SQL can register."""
    hidden = set(vocab.specials) if skip_specials else set()
    to_byte = {c: b for b, c in BYTE_TO_CHAR.items()}
    spelled = [b"" if t in hidden else bytes(to_byte[c] for c in t) for t in vocab.tokens] + [b""]
    pool = np.frombuffer(b"".join(spelled), np.uint8)
    sizes = np.array([len(s) for s in spelled], np.int64)
    starts = np.cumsum(sizes) - sizes

    def spell_run(lists: pa.Array) -> pa.Array:
        # Ids outside the vocabulary spell nothing, as the last entry does.
        ids = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        ids[(ids < 0) | (ids >= len(sizes))] = len(sizes) - 1
        lengths = sizes[ids]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        raw = pool[np.arange(ends[-1]) + np.repeat(starts[ids] - ends[:-1], lengths)].tobytes()
        per_list = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        at = ends[np.concatenate([[0], np.cumsum(per_list, dtype=np.int64)])].tolist()
        return pa.array([raw[at[i]:at[i + 1]].decode(errors="replace") if ok else None
                         for i, ok in enumerate(lists.is_valid().to_pylist())], pa.string())

    @F.arrow_udf(T.StringType())
    def spell(lists: pa.Array) -> pa.Array:
        per_list = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        return pa.concat_arrays([spell_run(lists[first:past]) for first, past in runs(per_list, RUN_WORDS)] or [
            pa.array([], pa.string())])

    return spell


def listing(vocab: Vocabulary, spark: SparkSession, limit: int | None = None,
            merges: int = 50) -> DataFrame:
    """``(section, pos, entry)``: tokens by id, special tokens, the first merges, and totals.

    No ``limit``, or zero, lists every token.
    """
    tokens, pairs = vocab.vocab_frame(spark), vocab.merges_frame(spark)
    shown = tokens.filter(F.col("id") < limit) if limit else tokens
    return (
        shown.select(F.lit("token").alias("section"), F.col("id").alias("pos"),
                     F.col("token").alias("entry"))
        .unionByName(tokens.filter("kind = 'special'").select(
            F.lit("special").alias("section"), F.col("id").alias("pos"), F.col("token").alias("entry")))
        .unionByName(pairs.filter(F.col("rank") < merges).select(
            F.lit("merge").alias("section"), F.col("rank").alias("pos"),
            F.concat_ws(" ", "left", "right").alias("entry")))
        .unionByName(tokens.agg(F.count("*").cast("int").alias("pos")).select(
            F.lit("total tokens").alias("section"), "pos", F.lit(None).cast("string").alias("entry")))
        .unionByName(pairs.agg(F.count("*").cast("int").alias("pos")).select(
            F.lit("total merges").alias("section"), "pos", F.lit(None).cast("string").alias("entry"))))
