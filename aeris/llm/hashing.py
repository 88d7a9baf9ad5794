"""Vectorised 64-bit hashes of byte ranges and word sequences (numpy)."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x5851F42D4C957F2D)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(97).integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
BLOCK = 1 << 18  # bytes hashed at a time; tables of powers are kept for no more than that
_power: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def table(base: np.uint64, size: int) -> np.ndarray:
        a = np.full(size, base, np.uint64)
        a[0] = 1
        return np.multiply.accumulate(a)

    if n > 2 * BLOCK:  # a word or window of that length: made for this call
        return table(_BASE, n), table(_INVERSE, n)
    if not _power:
        _power.update(up=table(_BASE, 2 * BLOCK), down=table(_INVERSE, 2 * BLOCK))
    return _power["up"][:n], _power["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """Polynomial sums of all prefixes of the bytes."""
    up, _ = _powers(max(1, len(raw)))
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[:len(raw)], out=out[1:])
    return out


def range_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes start..end of each pair: equal ranges hash alike wherever they lie."""
    _, down = _powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def word_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash for each run of bytes other than blank and 9..13, in order."""
    out, at, n = [], 0, len(raw)
    while at < n:
        end = min(at + BLOCK, n)
        if end < n:  # go on to the end of the word
            stop = np.flatnonzero(_BLANK[raw[end:]])
            end = n if not len(stop) else end + int(stop[0])
        part = raw[at:end]
        word = np.r_[False, ~_BLANK[part], False]
        start, stop = np.flatnonzero(word[1:] & ~word[:-1]), np.flatnonzero(word[:-1] & ~word[1:])
        out.append(range_hashes(prefix_sums(part), start, stop))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words; a shorter text is one shingle, an empty one none."""
    n = len(words)
    if not n:
        return words
    size = min(size, n)
    acc = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        acc = acc * np.uint64(0x2545F4914F6CDD1D) + words[k:n - size + 1 + k]
    return mix(acc)
