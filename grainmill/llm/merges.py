"""Byte-pair merges of many words at once, in numpy.

The symbols of all words lie in one flat array. Each round finds the best pair of every word, merges it and
closes the gaps; words without a pair that may merge leave the round. The result is that of merging one
pair at a time, best rank first and leftmost among equals.
"""

from __future__ import annotations

import numpy as np

NEVER = np.iinfo(np.int32).max


class MergeTable:
    """Which neighbours merge, to what, and in what order.

    `left`, `right` and `merged` are symbols below `n_symbols`; a smaller `rank` merges first, and different
    pairs may share one.
    """

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray, rank: np.ndarray, n_symbols: int):
        self.n_symbols = n_symbols
        keys = left.astype(np.int64) * n_symbols + right
        order = np.argsort(keys, kind="stable")
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.merged = np.append(merged[order], 0).astype(np.int32)
        self.rank = np.append(rank[order], NEVER).astype(np.int32)
        # All places of a pair can merge in one round if nothing that its symbol then forms comes before it
        # (and no other pair has its rank); else the leftmost place goes first, alone.
        soonest = np.full(n_symbols, NEVER, np.int64)
        np.minimum.at(soonest, left, rank)
        np.minimum.at(soonest, right, rank)
        _, inverse, counts = np.unique(rank, return_inverse=True, return_counts=True)
        together = (soonest[merged] > rank) & (counts[inverse] == 1)
        self.together = np.append(together[order], False)

    def _find(self, symbols: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The table row of each symbol with the next one; the final row if they don't merge or `last` ends its word."""
        keys = symbols.astype(np.int64) * self.n_symbols
        keys[:-1] += symbols[1:]
        rows = np.searchsorted(self.keys, keys)
        return np.where(last | (self.keys[rows] != keys), len(self.keys) - 1, rows)

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The final symbols of words that lie end to end, and their numbers; every word has a symbol at least."""
        symbols, lengths = symbols.astype(np.int32), lengths.astype(np.int64)
        final_lengths = lengths.copy()
        active = np.arange(len(lengths))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(active):
            ends = np.cumsum(lengths)
            starts = ends - lengths
            last = np.zeros(len(symbols), bool)
            last[ends - 1] = True
            rows = self._find(symbols, last)
            ranks = self.rank[rows]
            best = np.minimum.reduceat(ranks, starts)
            going = best < NEVER
            if not going.all():
                stays = np.repeat(~going, lengths)
                done.append((active[~going], symbols[stays], lengths[~going]))
                final_lengths[active[~going]] = lengths[~going]
                keep = ~stays
                symbols, rows, ranks = symbols[keep], rows[keep], ranks[keep]
                active, lengths, best = active[going], lengths[going], best[going]
                if not len(active):
                    break
                starts = np.cumsum(lengths) - lengths
            word = np.repeat(np.arange(len(lengths)), lengths)
            hits = np.flatnonzero(ranks == best[word])
            owner = word[hits]
            first = np.append(True, owner[1:] != owner[:-1])
            # Of overlapping places (a pair of equal symbols in a row) every other one merges.
            run = np.append(True, hits[1:] != hits[:-1] + 1) | first
            origin = np.maximum.accumulate(np.where(run, np.arange(len(hits)), 0))
            hits = hits[first | (self.together[rows[hits]] & ((np.arange(len(hits)) - origin) % 2 == 0))]
            symbols[hits] = self.merged[rows[hits]]
            symbols = np.delete(symbols, hits + 1)
            lengths = lengths - np.bincount(word[hits], minlength=len(lengths))
        result = np.empty(int(final_lengths.sum()), np.int32)
        at = np.cumsum(final_lengths) - final_lengths
        for words, values, sizes in done:
            result[ranges(at[words], sizes)] = values
        return result, final_lengths


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the ranges, end to end."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) - np.repeat(ends - lengths - starts, lengths)
