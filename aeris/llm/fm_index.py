"""Bidirectional FM-index over a delimited list of words, searched many patterns at a time (numpy).

The words of a shard, each after a delimiter, form one cyclic text.  Two indexes
hold it, one as it is and one reversed; each keeps the symbols before its sorted
rotations in a wavelet matrix, which tells for a range of ranks how often a symbol occurs in
it and how many smaller ones do.  An interval is kept in both indexes at once: a step in one
moves the other by the number of smaller symbols, so a pattern can grow at either end.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

QUERIES = 1 << 14  # searched together


def sorted_rotations(text: np.ndarray, bits: int) -> np.ndarray:
    """Start places of the rotations of ``text`` in order, by doubling of sorted prefixes."""
    n = len(text)
    at = np.arange(n)
    together = max(1, min(62 // bits, n))
    key = np.zeros(n, np.int64)
    for k in range(together):
        key = (key << bits) | text[(at + k) % n]
    reach = together
    while True:
        order = np.argsort(key, kind="stable")
        rank = np.zeros(n, np.int64)
        rank[order] = np.cumsum(np.r_[0, np.diff(key[order]) != 0])
        if reach >= n or rank[order[-1]] == n - 1:
            return order
        key = rank * n + rank[(at + reach) % n]
        reach *= 2


class Ranks:
    """Sorted rotations of one direction and the wavelet matrix of the symbols before them."""

    def __init__(self, text: np.ndarray, bits: int):
        n = len(text)
        self.bits = bits
        self.places = sorted_rotations(text, bits)
        row = text[self.places - 1]
        self.zeros = []
        for level in range(bits - 1, -1, -1):
            one = (row >> level) & 1 == 1
            zeros = np.zeros(n + 1, np.int32)
            np.cumsum(~one, out=zeros[1:])
            self.zeros.append(zeros)
            row = np.concatenate([row[~one], row[one]])
        counts = np.bincount(text, minlength=1 << bits)
        start = np.zeros(1 << bits, np.int64)
        change = np.flatnonzero(np.r_[True, np.diff(row) != 0])
        start[row[change]] = change
        self.shift = np.cumsum(counts) - counts - start  # from a symbol's place in the last row to its rotations

    def step(self, lo: np.ndarray, hi: np.ndarray, symbol: np.ndarray):
        """(lo, hi) after ``symbol`` is put before the pattern, and how many smaller symbols stand there."""
        smaller = np.zeros(len(lo), np.int64)
        for level, zeros in enumerate(self.zeros):
            one = (symbol >> (self.bits - 1 - level)) & 1 == 1
            a, b, all_zeros = zeros[lo], zeros[hi], zeros[-1]
            smaller += np.where(one, b - a, 0)
            lo, hi = np.where(one, all_zeros + lo - a, a), np.where(one, all_zeros + hi - b, b)
        shift = self.shift[symbol]
        return lo + shift, hi + shift, smaller

    def children(self, lo: np.ndarray, hi: np.ndarray):
        """(owner, symbol, lo, hi) for every symbol that stands before the pattern of each interval."""
        owner, symbol = np.arange(len(lo)), np.zeros(len(lo), np.int64)
        for zeros in self.zeros:
            a, b, all_zeros = zeros[lo].astype(np.int64), zeros[hi].astype(np.int64), zeros[-1]
            low, high = b > a, hi - b > lo - a
            owner, symbol, lo, hi = (np.concatenate([owner[low], owner[high]]),
                                     np.concatenate([symbol[low] << 1, (symbol[high] << 1) | 1]),
                                     np.concatenate([a[low], (all_zeros + lo - a)[high]]),
                                     np.concatenate([b[low], (all_zeros + hi - b)[high]]))
        shift = self.shift[symbol]
        return owner, symbol, lo + shift, hi + shift


@dataclass
class _Side:
    """What a search needs to grow patterns at one end: symbols of a word in that order, and both indexes."""

    text: np.ndarray
    first: np.ndarray  # place of each word's first symbol in this order
    way: int  # 1 or -1
    grow: Ranks
    back: Ranks

    def symbol(self, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.text[self.first[word] + self.way * at]


class WordIndex:
    """Distinct non-empty words; finds for words of its own the others that differ in one symbol."""

    def __init__(self, words: list[str]):
        points = [np.frombuffer(w.encode("utf-32-le", "surrogatepass"), "<u4") for w in words]
        self.length = np.array([len(p) for p in points], np.int64)
        alphabet, codes = np.unique(np.concatenate(points), return_inverse=True)
        bits = max(1, int(len(alphabet)).bit_length())
        n = int(self.length.sum()) + len(words)
        start = np.cumsum(self.length + 1) - self.length  # the delimiter stands before
        text = np.zeros(n + 1, np.int64)  # the last place repeats the first delimiter
        letters = np.ones(n, bool)
        letters[start - 1] = False
        text[:n][letters] = codes + 1
        self.text, self.start, self.n = text, start, n
        self.word_at = np.cumsum(~letters) - 1
        self.forward, self.reverse = Ranks(text[:n], bits), Ranks(text[:n][::-1], bits)

    def _anchored(self, side: _Side, word: np.ndarray, exact: np.ndarray):
        """Intervals (in the index that grows) of the delimiter and the first ``exact`` symbols of each word.

        The piece is read from its inner end to the delimiter; the other direction follows in step.
        """
        size = np.full(len(word), self.n, np.int64)
        lo, other = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
        for k in range(int(exact.max(initial=0)) + 1):
            live = np.flatnonzero((exact >= k) & (size > 1))
            at = exact[live] - 1 - k
            symbol = np.where(at >= 0, side.symbol(word[live], np.maximum(at, 0)), 0)
            new_lo, new_hi, smaller = side.back.step(lo[live], lo[live] + size[live], symbol)
            other[live] += smaller
            lo[live], size[live] = new_lo, new_hi - new_lo
        return other, other + size

    def _one_error(self, side: _Side, word: np.ndarray, exact: np.ndarray, until: np.ndarray):
        """(query, rank) of the words that equal a query's first symbols and have one error at exact .. until - 1."""
        length = self.length[word]
        lo, hi = self._anchored(side, word, exact)
        at, query = exact.copy(), np.arange(len(word))
        found_query, found_rank = [], []
        while True:
            live = (hi - lo > 1) & (at < until[query])  # a lone rotation is the query itself
            query, lo, hi, at = query[live], lo[live], hi[live], at[live]
            if not len(query):
                break
            owner, symbol, c_lo, c_hi = side.grow.children(lo, hi)
            q, i = query[owner], at[owner]
            last = length[q]
            own = side.symbol(word[q], np.minimum(i, last))
            after = side.symbol(word[q], np.minimum(i + 1, last))
            other = symbol != own
            changed, longer = other & (symbol > 0) & (i < last), other & (symbol > 0)
            shorter = other & (i < last) & (symbol == after)
            todo = [np.concatenate([x[changed], x[longer], x[shorter]]) for x in (q, c_lo, c_hi)]
            place = np.concatenate([i[changed] + 1, i[longer], i[shorter] + 2])
            self._finish(side, word, *todo, place, length, found_query, found_rank)
            same = ~other & (i < last)
            query, lo, hi, at = q[same], c_lo[same], c_hi[same], i[same] + 1
        if not found_query:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found_query), np.concatenate(found_rank)

    def _finish(self, side: _Side, word, query, lo, hi, place, length, found_query, found_rank) -> None:
        """Follow the rest of each query, delimiter included, without a further error."""
        while len(query):
            done = place > length[query]
            if done.any():
                found_query.append(query[done])
                found_rank.append(lo[done])
                query, lo, hi, place = (x[~done] for x in (query, lo, hi, place))
                if not len(query):
                    return
            lo, hi, _ = side.grow.step(lo, hi, side.symbol(word[query], place))
            live = hi > lo
            query, lo, hi, place = query[live], lo[live], hi[live], place[live] + 1

    def near(self, word: np.ndarray, low: np.ndarray, high: np.ndarray):
        """(query, word) for every other word whose first difference from the query's word lies at low .. high - 1.

        ``word``, ``low`` and ``high`` give one query each.  The piece before ``low`` or the one from ``high`` on is matched
        exactly, whichever is longer; the search then crosses the rest with one error.  Each pair comes once.
        """
        out_q, out_w = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        by_prefix = low >= self.length[word] - high
        rightward = _Side(self.text, self.start, 1, self.reverse, self.forward)
        leftward = _Side(self.text, self.start + self.length - 1, -1, self.forward, self.reverse)
        for from_left in (True, False):
            picked = np.flatnonzero(by_prefix == from_left)
            for k in range(0, len(picked), QUERIES):
                part = picked[k:k + QUERIES]
                own = word[part]
                if from_left:
                    q, rank = self._one_error(rightward, own, low[part], high[part])
                    got = (self.word_at[self.n - 1 - self.reverse.places[rank]] - 1) % len(self.length)
                else:
                    q, rank = self._one_error(leftward, own, self.length[own] - high[part], self.length[own] + 1)
                    got = self.word_at[self.forward.places[rank]]
                    first = self._first_difference(own[q], got, high[part][q])
                    mine = (first >= low[part][q]) & (first < high[part][q])
                    q, got = q[mine], got[mine]
                out_q.append(part[q])
                out_w.append(got)
        return np.concatenate(out_q), np.concatenate(out_w)

    def _first_difference(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Place of the first difference of each pair of words, ``most`` where there is none before it."""
        out, live, k = most.copy(), np.arange(len(a)), 0
        while len(live):
            live = live[k < most[live]]
            x = self.text[self.start[a[live]] + np.minimum(k, self.length[a[live]])]
            y = self.text[self.start[b[live]] + np.minimum(k, self.length[b[live]])]
            out[live[x != y]] = k
            live, k = live[x == y], k + 1
        return out
