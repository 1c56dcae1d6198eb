"""Operators do the whole job: nothing is capped by size."""

import collections
import math
import re
import zlib
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from shardweave.llm import suffix_tree
from shardweave.llm.suffix_tree import LEAST_COUNT, SMOOTH, score

DIR = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tree_scores(rows):
    """The suffix tree's scores, one document at a time."""
    tokens = {i: [*re.findall("[^\x20\x09-\x0D]+", (t or "").translate(LOW)), "\0"] for i, t in rows}
    train = [t for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    count = collections.Counter(tuple(t[i:i + k]) for t in train for k in (1, 2, 3) for i in range(len(t) - k + 1))
    total = sum(n for g, n in count.items() if len(g) == 1)
    floor = total + sum(len(g) == 1 for g in count) + 1
    nexts = collections.defaultdict(list)
    for g, n in count.items():
        if len(g) > 1 and n >= LEAST_COUNT:
            nexts[g[:-1]].append((g[-1], n))
    stays, left = set(), {}

    def p(context, word):
        while context and context not in stays:
            context = context[1:]
        if not context:
            return (count[word,] + 1) / floor
        n = count[*context, word] if count[*context, word] >= LEAST_COUNT else 0
        return n / (count[context] + SMOOTH) + left[context] * p(context[1:], word)

    for size in (1, 2):
        for c in [c for c in nexts if len(c) == size and (size == 1 or c[1:] in stays)]:
            rest = count[c] - sum(n for _, n in nexts[c])
            left[c] = (rest + SMOOTH) / (count[c] + SMOOTH)
            gain = rest * math.log(left[c])
            for w, n in nexts[c]:
                q = p(c[1:], w)
                gain += n * math.log((n / (count[c] + SMOOTH) + left[c] * q) / q)
            if gain > 0.5 * len(nexts[c]) * math.log(total):
                stays.add(c)
    assert {len(c) for c in stays} == {1, 2}
    return {i: sum(math.log10(p(tuple(t[max(0, k - 2):k]), w)) for k, w in enumerate(t)) for i, t in tokens.items()}


@pytest.mark.parametrize("hot_share", [1e-6, 1e-3, 1.0])
def test_suffix_tree_keeps_every_frequent_sequence(spark, hot_share):
    """The same scores whatever is broadcast: a larger corpus does not raise the least count."""
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{DIR}/documents.parquet").to_pylist()]
    got = {r.doc_id: r.score for r in score(spark.read.parquet(f"{DIR}/documents.parquet"), hot_share).collect()}
    want = tree_scores(rows)
    assert np.allclose([got[i] for i in want], list(want.values()), rtol=1e-9)


@pytest.mark.parametrize("hot_keys", [0, 500])
def test_suffix_tree_broadcasts_few_keys_and_drops_what_is_read(spark, monkeypatch, hot_keys):
    made, sizes, stage, index = {}, [], suffix_tree.stage, suffix_tree.indexed

    def record(df, label):
        out = stage(df, label)
        made[out.staged_at] = label
        return out

    monkeypatch.setattr(suffix_tree, "stage", record)
    monkeypatch.setattr(suffix_tree, "indexed", lambda table: sizes.append(len(table)) or index(table))
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{DIR}/documents.parquet").to_pylist()]
    scored = score(spark.read.parquet(f"{DIR}/documents.parquet"), hot_keys=hot_keys)
    assert hot_keys / 2 <= sizes[0] <= hot_keys
    assert sorted(label for path, label in made.items() if Path(path).exists()) == ["scored", "values"]
    got = {r.doc_id: r.score for r in scored.collect()}
    want = tree_scores(rows)
    assert np.allclose([got[i] for i in want], list(want.values()), rtol=1e-9)


def test_suffix_tree_lookups(spark):
    keys = np.random.default_rng(5).integers(-2**63, 2**63, 40_000)
    held, others = np.sort(keys[:20_000].view(np.uint64)).view(np.int64), keys[20_000:]
    for table in (held, held[:1], held[:0]):
        index = suffix_tree.indexed(table)
        assert (suffix_tree.places(index, table) == np.arange(len(table))).all()
        assert (suffix_tree.places(index, others) == -1).all()
    bits = suffix_tree.bit_map(spark.createDataFrame([(int(k),) for k in held], "key long"))
    assert suffix_tree.marked(bits, held).all() and suffix_tree.marked(bits, others).mean() < 0.02


def test_pipeline_keeps_one_row_of_each_group(spark):
    """Repeated rows, null ids and ids shared by different texts."""
    a, b, c = (" ".join(f"{x}{i * i % 97}" for i in range(60)) for x in "abc")
    rows = [(1, a, "en"), (1, a, "en"), (2, b, "en"), (3, a, "en"), (3, c, "en"), (None, b, "en"),
            (None, "null twice " + c[:40], "en"), (None, "null twice " + c[:40], "de"), (4, "", "en"), (5, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted(map(tuple, corpus_pipeline.one_of_each(spark, docs, DIR).collect()), key=repr)
    assert got == sorted([rows[0], rows[2], rows[4], rows[7], rows[8], rows[9]], key=repr)


def test_suffix_tree_has_rare_contexts_of_a_large_corpus(spark):
    """Seven occurrences are under a millionth of the training tokens, and count all the same."""
    ids = sorted(range(40), key=lambda i: zlib.crc32(str(i).encode()) % 7 == 2)
    rows = [(i, "common " * 400_000 + "seldom follows " * (k < 7)) for k, i in enumerate(ids[:24])]
    rows.append((ids[-1], "seldom follows"))
    got = score(spark.createDataFrame(rows, "doc_id long, text string")).filter("held_out").collect()
    assert [r.doc_id for r in got] == [ids[-1]] and got[0].train_tokens > 8_000_000
    assert got[0].score > got[0].base_score + 3
