"""Plain, slow versions of the operators that SQL cannot express."""

import hashlib
import re
from collections import Counter

import numpy as np


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def bag(text, size=5):
    w = words(text)
    n = min(size, len(w))
    return Counter(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if w else Counter()


def overlap(a, b):
    both = sum((a & b).values())
    either = sum((a | b).values())
    return both / either if either else 0.0


def components(ids, links):
    """Smallest id that each id reaches."""
    near = {i: {i} for i in ids}
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for i in sorted(ids):
        todo = [i]
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = i
                todo += near[x]
    return out


def near_copies(rows, similarity=0.8):
    """id -> smallest id of its group, all pairs compared."""
    bags = [(i, bag(t)) for i, t in rows]
    links = [(i, j) for k, (i, a) in enumerate(bags) for j, b in bags[:k] if a and b and overlap(a, b) >= similarity]
    return components([i for i, _ in bags], links)


def repeated_bytes(rows, length=200):
    """(id, n_bytes, n_removed, n_spans, sha256 of the rest, the rest) of each row."""
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(b[k:k + length] for b in raw for k in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(rows, raw):
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k:k + length] = True
        left = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(left).hexdigest(), gone))
    return out


def without(text, gone):
    """The text without the characters all of whose bytes are gone."""
    out, at = [], 0
    for c in text:
        n = len(c.encode())
        if not gone[at:at + n].all():
            out.append(c)
        at += n
    return "".join(out)


def linked_vectors(rows, threshold=0.9):
    """[(links, component)] in the order of the rows, all pairs compared in double precision."""
    usable = []
    for v in [r[1] for r in rows]:
        ok = v is not None and len(v) and all(x is not None for x in v) and np.isfinite(np.array(v, float)).all() and any(v)
        usable.append(np.array(v, float) / np.linalg.norm(np.array(v, float) / np.abs(np.array(v, float)).max()) /
                      np.abs(np.array(v, float)).max() if ok else None)
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if usable[a] is not None and usable[b] is not None
             and len(usable[a]) == len(usable[b]) and float(usable[a] @ usable[b]) >= threshold]
    counts = Counter(x for p in pairs for x in p)
    part = components([r[0] for r in rows], [(rows[a][0], rows[b][0]) for a, b in pairs])
    return [(counts[k], part[r[0]]) for k, r in enumerate(rows)]
