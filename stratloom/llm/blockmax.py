"""Inverted index with the largest weight of every term in every block of items."""

from __future__ import annotations

import numpy as np

from .common import ragged

POWER_STEPS = 6  # towards the direction of largest variance; it need not be met exactly


def coherent_order(features: np.ndarray, block: int) -> np.ndarray:
    """Items in an order in which each ``block`` of neighbours is alike, as maxima of mixed blocks bound nothing.

    The items are halved, at a multiple of ``block``, along the direction in which their features differ most, and the halves again.
    Work grows with the items times the logarithm of their number; equal features give equal orders.
    """
    out, todo = [], [np.arange(len(features))]
    while todo:
        ids = todo.pop()
        if len(ids) <= block:
            out.append(ids)
            continue
        own = features[ids] - features[ids].mean(axis=0)
        along = np.cos(np.arange(1, own.shape[1] + 1, dtype=own.dtype))
        for _ in range(POWER_STEPS):
            along = own.T @ (own @ along)
            along /= max(1e-12, float(np.linalg.norm(along)))
        ids = ids[np.argsort(own @ along, kind="stable")]
        half = max(1, round(len(ids) / 2 / block)) * block
        todo += [ids[half:], ids[:half]]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


class BlockMaxIndex:
    """Postings (term, item, weight) sorted by term and item, with one maximum per (term, block of items).

    A query's upper bound for a block is the sum of its terms' maxima there. Blocks whose bound is below
    what is asked for are never opened; the others are scored exactly.
    """

    def __init__(self, n_items: int, n_terms: int, item: np.ndarray, term: np.ndarray, weight: np.ndarray,
                 block: int = 64, ordered: bool = False):
        if not ordered:
            order = np.lexsort((item, term))
            item, term, weight = item[order], term[order], weight[order]
        self.item, self.weight = item, weight.astype(np.float64, copy=False)
        self.n_items, self.n_terms, self.block = n_items, n_terms, block
        self.n_blocks = max(1, -(-n_items // block))
        entry = term.astype(np.int32 if n_terms * self.n_blocks < 1 << 31 else np.int64)
        entry *= self.n_blocks
        entry += (self.item // block).astype(entry.dtype)
        first = np.flatnonzero(np.r_[True, entry[1:] != entry[:-1]]) if len(entry) else np.zeros(0, np.int64)
        self.entry_start = np.r_[first, len(entry)]
        self.entry_block = entry[first] % self.n_blocks
        self.entry_max = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)
        self.term_entries = np.searchsorted(entry[first] // self.n_blocks, np.arange(n_terms + 1))

    def _entries(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = self.term_entries[terms + 1] - self.term_entries[terms]
        return ragged(self.term_entries[terms], n), np.repeat(weights, n)

    def block_matrix(self) -> np.ndarray:
        """Terms by blocks, for bounds of many queries at once."""
        out = np.zeros((self.n_terms, self.n_blocks), np.float32)
        term = np.repeat(np.arange(self.n_terms), np.diff(self.term_entries))
        # rounded up, so that a bound in single precision stays a bound
        out[term, self.entry_block] = np.nextafter(self.entry_max.astype(np.float32), np.float32(np.inf))
        return out

    def _scores(self, entries: np.ndarray, weights: np.ndarray) -> np.ndarray:
        n = self.entry_start[entries + 1] - self.entry_start[entries]
        at = ragged(self.entry_start[entries], n)
        return np.bincount(self.item[at], self.weight[at] * np.repeat(weights, n), self.n_items)

    def score_blocks(self, terms: np.ndarray, weights: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Exact scores of the items of some blocks; 0 elsewhere."""
        entries, w = self._entries(terms, weights)
        asked = np.zeros(self.n_blocks, bool)
        asked[blocks] = True
        mine = asked[self.entry_block[entries]]
        return self._scores(entries[mine], w[mine])

    def top(self, terms: np.ndarray, weights: np.ndarray, k: int, first: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """The k items of highest score above 0, ties by item number; exact.

        The few blocks of highest bound give a k-th score to beat; then every block that can reach it is opened.
        """
        entries, w = self._entries(terms, weights)
        blocks = self.entry_block[entries]
        bound = np.bincount(blocks, w * self.entry_max[entries], self.n_blocks)
        opened = np.zeros(self.n_blocks, bool)
        opened[np.argsort(-bound, kind="stable")[:first]] = True
        mine = opened[blocks]
        scores = self._scores(entries[mine], w[mine])
        least = np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) > k else 0.0
        more = ~opened & (bound > 0) & (bound >= least * (1 - 1e-9))
        if more.any():
            mine = more[blocks]
            scores += self._scores(entries[mine], w[mine])
        found = np.flatnonzero(scores > 0)
        found = found[np.lexsort((found, -scores[found]))][:k]
        return found, scores[found]
