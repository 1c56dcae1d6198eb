"""Near duplicates: links of mixed buckets, and words that a weak hash would take for equal."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardweave.llm import near_dedup
from shardweave.llm.near_dedup import near_duplicates


def thue_morse(n, a, b):
    return "".join((a, b)[bin(i).count("1") & 1] for i in range(n))


def test_long_words_with_swapped_letters_stay_apart(spark):
    x, y = thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a")
    df = spark.createDataFrame([(1, x), (2, y), (3, x.upper())], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_duplicates(df).collect()} == {1: 1, 2: 2, 3: 1}


def brute(rows, width):
    sets = {}
    for i, t in rows:
        w = t.split()
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} or {tuple(w)}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("width, block, few", [(4, 1024, 24), (5, 16, 24), (5, 1024, 10**9)])
def test_look_alikes_around_the_threshold(spark, monkeypatch, width, block, few):
    """One family of texts, many pairs of which are just below or just above 0.8."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "FEW_SETS", few)
    rng = random.Random(width)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.choice([1, 3, 4, 5, 6])):
            words[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates(df, width).collect()}
    want = brute(rows, width)
    assert len(set(want.values())) > 1 and len(set(want.values())) < 90
    assert got == want


def test_overlaps_of_many_sets(monkeypatch):
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 300, n).astype(np.uint64)) for n in rng.integers(1, 200, 60)]
    everyone = np.arange(60)
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
    found = near_dedup._Overlap(sets)
    assert found.bits is not None and [list(found(i, everyone)) for i in range(60)] == want
    monkeypatch.setattr(near_dedup, "BIT_BYTES", 10)
    found = near_dedup._Overlap(sets)
    assert found.bits is None and [list(found(i, everyone)) for i in range(60)] == want


def test_a_block_passes_on_fewer_links_than_members(spark, monkeypatch):
    made = collections.Counter()
    original = near_dedup._link_block

    def counting(percent, least):
        run = original(percent, least)

        def outer(table):
            out = run(table)
            assert out.num_rows < table.num_rows
            return out
        return outer

    monkeypatch.setattr(near_dedup, "_link_block", counting)
    rng = np.random.default_rng(5)
    rows = []
    for i in range(150):  # nobody is near anybody, but all share most of their words
        words = np.array([f"w{k}" for k in range(300)])
        words[rng.integers(0, 300, 12)] = f"own{i}"
        rows.append((i, " ".join(words)))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    made.update(r.component_id for r in got.filter(F.col("doc_id") != F.col("component_id")).collect())
    assert {r.doc_id: r.component_id for r in got.collect()} == brute(rows, 4)
