"""Balanced-parentheses tries with a range min-max tree over excess blocks (numpy).

A trie is a sequence of parentheses in preorder: a node opens, its subtrees follow, it
closes.  The excess after a place is the number of nodes open there; the node that opened at a place
closes where the excess first falls below its own.  Minima of the excess over blocks, and over
runs of blocks, let that place be found in a few steps for many nodes at a time.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64


class Parentheses:
    """``opens`` has True for ( and False for ); the sequence must be balanced."""

    def __init__(self, opens: np.ndarray):
        self.opens = np.asarray(opens, bool)
        n = len(self.opens)
        self.excess = np.cumsum(np.where(self.opens, 1, -1))
        blocks = -(-n // BLOCK)
        padded = np.full(blocks * BLOCK, np.iinfo(np.int64).max)
        padded[:n] = self.excess
        self.rows = padded.reshape(blocks, BLOCK)
        self.minima = [self.rows.min(axis=1)] if n else [np.zeros(0, np.int64)]
        self.maxima = [np.where(self.rows == np.iinfo(np.int64).max, -1, self.rows).max(axis=1)] if n else [np.zeros(0, np.int64)]
        while len(self.minima[-1]) > 1:
            for levels, pick, rest in ((self.minima, np.minimum, np.iinfo(np.int64).max), (self.maxima, np.maximum, -1)):
                low = np.r_[levels[-1], rest] if len(levels[-1]) % 2 else levels[-1]
                levels.append(pick(low[::2], low[1::2]))
        pairs = np.zeros(n + 1, np.int64)
        if n > 1:
            np.cumsum(self.opens[:-1] & ~self.opens[1:], out=pairs[1:-1])
            pairs[-1] = pairs[-2]
        self.leaf_pairs = pairs  # () that begin before a place
        self.order = np.cumsum(self.opens) - 1  # preorder number of the node that opens at a place

    def depth(self) -> int:
        """The greatest number of nodes open at once."""
        return int(self.maxima[-1][0]) if len(self.maxima[-1]) else 0

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """Places where the nodes that open at ``at`` close."""
        at = np.asarray(at, np.int64)
        goal = self.excess[at] - 1
        block, out = at // BLOCK, np.full(len(at), -1, np.int64)
        inside = (self.rows[block] <= goal[:, None]) & (np.arange(BLOCK)[None, :] > (at % BLOCK)[:, None])
        hit = inside.any(axis=1)
        out[hit] = block[hit] * BLOCK + inside[hit].argmax(axis=1)
        live = np.flatnonzero(~hit)
        node, level = block[live], np.zeros(len(live), np.int64)
        found = np.zeros(len(live), bool)
        for k, minima in enumerate(self.minima):  # up, until the right neighbour holds an excess that low
            here = np.flatnonzero(~found)
            right = node[here] + 1
            ok = (node[here] % 2 == 0) & (right < len(minima))
            ok[ok] = minima[right[ok]] <= goal[live[here[ok]]]
            node[here[ok]], level[here[ok]], found[here[ok]] = right[ok], k, True
            node[here[~ok]] //= 2
        for k in range(len(self.minima) - 1, 0, -1):  # down, to the first block that does
            here = np.flatnonzero(level == k)
            left = 2 * node[here]
            far = self.minima[k - 1][left] > goal[live[here]]
            node[here], level[here] = left + far, k - 1
        if len(live):
            out[live] = node * BLOCK + (self.rows[node] <= goal[live][:, None]).argmax(axis=1)
        return out

    def leaves(self, opened: np.ndarray, closed: np.ndarray) -> np.ndarray:
        """Childless nodes in the subtrees that open and close at the given places."""
        return self.leaf_pairs[closed] - self.leaf_pairs[opened]

    def subtree_sums(self, values: np.ndarray, opened: np.ndarray, closed: np.ndarray) -> np.ndarray:
        """Sums of ``values`` (one for each node, in preorder) over subtrees."""
        total = np.r_[np.zeros(1, values.dtype), np.cumsum(values)]
        return total[self.order[closed] + 1] - total[self.order[opened]]
