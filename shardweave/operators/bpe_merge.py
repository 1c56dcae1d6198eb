"""Merging ranked pairs in many words at once.

Words lie one after another in an array of symbol numbers; a second array says which word
each symbol belongs to. One numpy step merges the best pair of every word.
"""

from __future__ import annotations

import numpy as np


def pair_codes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Pairs of symbol numbers as single numbers, in the order of the pairs."""
    return (np.asarray(left, np.int64) << 32) | np.asarray(right, np.int64)


class MergeTable:
    """Pairs in order of rank, each with the symbol it becomes."""

    def __init__(self, left, right, result) -> None:
        # A pair named twice keeps its first rank.
        self.codes, self.ranks = np.unique(pair_codes(left, right), return_index=True)
        self.result = np.asarray(result, np.int64)
        self.never = np.int64(len(self.result))

    def rank_at(self, at: np.ndarray, syms: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Rank of the pair starting at each place of ``at``."""
        after = np.minimum(at + 1, len(syms) - 1)
        code = pair_codes(syms[at], syms[after])
        spot = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        hit = (self.codes[spot] == code) & (own[at] == own[after]) & (after > at)
        return np.where(hit, self.ranks[spot], self.never)

    def _round(self, syms: np.ndarray, own: np.ndarray, rank: np.ndarray):
        """Merge the best pair of every word; also say which words had one."""
        heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        best = np.repeat(np.minimum.reduceat(rank, heads),
                         np.diff(np.append(heads, len(syms))))
        active = best < self.never
        chosen = np.flatnonzero((rank == best) & active)
        # In a run like "aaa" neighbouring choices overlap: take every second one.
        place = np.arange(len(chosen))
        fresh = np.concatenate([[True], np.diff(chosen) != 1])[:len(chosen)]
        chosen = chosen[(place - np.maximum.accumulate(np.where(fresh, place, 0))) % 2 == 0]
        syms[chosen] = self.result[rank[chosen]]
        keep = np.ones(len(syms), bool)
        keep[chosen + 1] = False
        syms, own, rank, active = syms[keep], own[keep], rank[keep], active[keep]
        # Only pairs on either side of a merged place are new.
        moved = chosen - np.arange(len(chosen))
        stale = np.concatenate([moved, moved[moved > 0] - 1])
        rank[stale] = self.rank_at(stale, syms, own)
        return syms, own, rank, active

    def merge(self, syms: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and owners after all merges, words in their order."""
        if not len(self.codes) or not len(syms):
            return syms, own
        done = []
        syms = syms.astype(np.int64)
        rank = self.rank_at(np.arange(len(syms)), syms, own)
        while len(syms):
            syms, own, rank, active = self._round(syms, own, rank)
            done.append((syms[~active], own[~active]))
            syms, own, rank = syms[active], own[active], rank[active]
        pool, owner = (np.concatenate(part) for part in zip(*done))
        order = np.argsort(owner, kind="stable")
        return pool[order], owner[order]
