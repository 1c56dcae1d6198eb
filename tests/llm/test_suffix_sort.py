"""Multikey quicksort of suffixes, and groups of equal ones, against sorting strings."""

import collections

import numpy as np
import pytest

from shardweave.llm import suffix_dedup as sd
from shardweave.llm.flat import rolling, slices


def cases(trials):
    rng = np.random.default_rng(1)
    for trial in range(trials):
        n = int(rng.integers(1, 400))
        data = rng.integers(97, 99 if trial % 2 else 110, n + 120).astype(np.uint8)
        if trial % 3 == 0:
            data[:] = 97 + np.arange(len(data)) % rng.integers(1, 5)  # periodic
        starts = np.unique(rng.integers(0, n, rng.integers(1, n + 1)))
        yield data, np.concatenate([starts, starts[:5]]) if trial % 5 == 0 else starts


@pytest.mark.parametrize("weak", [False, True])
def test_groups_of_equal_suffixes(monkeypatch, weak):
    """Even if all strings have one hash."""
    if weak:
        monkeypatch.setattr(sd, "rolling", lambda data, width: np.zeros(max(0, len(data) - width + 1), np.uint64))
    for data, starts in cases(120):
        active, group = sd.multikey_groups(data, starts)
        strings = [data[s:s + sd.GRAM].tobytes() for s in starts]
        count = collections.Counter(strings)
        got = [strings[i] for i in active]
        assert got == sorted(s for s in strings if count[s] > 1) and len(set(active.tolist())) == len(active)
        ranks = {s: i for i, s in enumerate(sorted(set(got)))}
        assert [ranks[s] for s in got] == group.tolist()


def test_order_of_different_suffixes():
    rng = np.random.default_rng(2)
    for data, starts in cases(120):
        firsts = list({data[s:s + sd.GRAM].tobytes(): s for s in starts}.values())
        rng.shuffle(firsts)
        order = sd.multikey_order(data, np.array(firsts))
        strings = [data[firsts[i]:firsts[i] + sd.GRAM].tobytes() for i in order]
        assert strings == sorted(strings) and len(set(order.tolist())) == len(firsts)


def test_anchor_runs_do_not_depend_on_parts(monkeypatch):
    rng = np.random.default_rng(3)
    lengths = rng.integers(0, 400, 50)
    data = rng.integers(97, 101, lengths.sum()).astype(np.uint8)
    offsets = np.append(0, np.cumsum(lengths))
    whole = sd.anchor_runs(data, offsets)
    monkeypatch.setattr(sd, "PART_BYTES", 700)
    assert len(list(slices(data, offsets, 700))) > 5
    for a, b in zip(whole, sd.anchor_runs(data, offsets)):
        assert a.tolist() == b.tolist()
    assert len(rolling(data, sd.ANCHOR)) > 0
