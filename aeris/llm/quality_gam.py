"""Text quality: a generalised additive model with pairwise interactions.

Each text gives a row of plain measures.  Their values are cut into bins at
sample quantiles, and shallow trees, boosted feature after feature in a cycle, add up to
one lookup table per feature; then the pairs that explain most of what is left get
tables of their own.  A score adds the table entries of a text's bins.

Learned from a bounded sample of labelled rows outside the held-out fold
(``PER_LABEL`` of each label, weighted back to the true shares); scores see
the text alone.  Defined cases: null or empty text has all measures 0; if
only one label (or none) is known, every score is its smoothed share (0.5);
equal texts get equal scores; columns named like a new one are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeris.llm.common import append_columns, held_out, labelled_sample, read_table

PER_LABEL = 4000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 150
PAIR_ROUNDS = 60
RATE = 0.1
RIDGE = 1.0
THRESHOLD = 0.3
_SENTENCE = re.compile(r"[.!?]+")

FEATURES = ["log_words", "word_length", "distinct_words", "top_word", "distinct_triples", "upper", "digits",
            "exclaims", "symbols", "pipes", "stops", "other_ascii", "non_ascii", "blank_lines", "line_words",
            "repeated_lines", "short_words", "sentence_words"]


def _flags(chars: str) -> np.ndarray:
    out = np.zeros(256)
    out[[ord(c) for c in chars]] = 1
    return out


_UPPER, _LOWER = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _flags("abcdefghijklmnopqrstuvwxyz")
_DIGIT, _STOPS, _SYMBOLS = _flags("0123456789"), _flags(".,;:"), _flags("#*$%&<>")
_OTHER = _flags("'\"()[]{}/\\@^_`~+-=?")
_HIGH = np.r_[np.zeros(128), np.ones(128)]


def measures(text: str) -> list[float]:
    """FEATURES of one whole text."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    by = np.bincount(raw, minlength=256)
    chars = len(raw)
    counted = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    upper, letters = float(by @ _UPPER), float(by @ (_UPPER + _LOWER))
    triples = max(1, n - 2)
    return [
        float(np.log1p(n)), (chars - float(by[[9, 10, 11, 12, 13, 32]].sum())) / n, len(counted) / n ** 0.8,
        max(counted.values()) / n, len(set(zip(words, words[1:], words[2:]))) / triples if n > 2 else 1.0,
        upper / max(1.0, letters), float(by @ _DIGIT) / chars, float(by[33]) / n, float(by @ _SYMBOLS) / n,
        float(by[124]) / n, float(by @ _STOPS) / n, float(by @ _OTHER) / chars, float(by @ _HIGH) / chars,
        text.count("\n\n") / n, n / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)),
        sum(map(len, counted)) / len(counted), n / max(1, len(_SENTENCE.findall(text))),
    ]


@dataclass
class Gam:
    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)  # cut points of each feature
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)  # cut points for the pairs
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for k, table in enumerate(self.tables):
            out += table[np.searchsorted(self.edges[k], x[:, k], side="right")]
        for a, b, table in self.pairs:
            out += table[np.searchsorted(self.coarse[a], x[:, a], side="right"),
                         np.searchsorted(self.coarse[b], x[:, b], side="right")]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="inverted_cdf"))


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """(gain, number of bins on the left) of the best cut of a histogram; (0, 0) if none gains."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl * gl / (hl + RIDGE) + gr * gr / (hr + RIDGE) - g.sum() ** 2 / (h.sum() + RIDGE)
    k = int(np.argmax(gain))
    return (float(gain[k]), k + 1) if gain[k] > 1e-12 else (0.0, 0)


def _shallow(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Leaf values by bin of a tree of ``depth`` over one feature's histogram."""
    _, k = _best_cut(g, h) if depth else (0, 0)
    if not k:
        return np.full(len(g), g.sum() / (h.sum() + RIDGE))
    return np.r_[_shallow(g[:k], h[:k], depth - 1), _shallow(g[k:], h[k:], depth - 1)]


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """A cut of one feature, then a cut of the other on each side: (gain, value by cell)."""
    best = (0.0, np.zeros_like(g))
    total = g.sum() ** 2 / (h.sum() + RIDGE)
    for flip in (False, True):
        gg, hh = (g.T, h.T) if flip else (g, h)
        for k in range(1, len(gg)):
            value, gain = np.zeros_like(gg), -total
            for rows in (slice(0, k), slice(k, None)):
                a, b = gg[rows].sum(axis=0), hh[rows].sum(axis=0)
                value[rows] = _shallow(a, b, 1)
                leaf = value[rows][0]
                gain += float((2 * leaf * a - leaf * leaf * b).sum())
            if gain > best[0]:
                best = (gain, value.T if flip else value)
    return best


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Gam:
    """Boost the tables of all features in a cycle, then those of the strongest pairs."""
    if not len(y) or len(set(y.tolist())) < 2:
        share = (float((weight * y).sum()) + 1) / (float(weight.sum()) + 2) if len(y) else 0.5
        return Gam(float(np.log(share / (1 - share))))
    share = float((weight * y).sum() / weight.sum())
    out = np.full(len(y), np.log(share / (1 - share)))
    model = Gam(float(out[0]), [_cuts(c, BINS) for c in x.T], [], [_cuts(c, PAIR_BINS) for c in x.T])
    bins = [np.searchsorted(e, c, side="right") for e, c in zip(model.edges, x.T, strict=True)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]

    def gradients():
        p = 1 / (1 + np.exp(-np.clip(out, -30, 30)))
        return weight * (y - p), np.maximum(weight * p * (1 - p), 1e-9)

    for _ in range(ROUNDS):
        for k, at in enumerate(bins):
            g, h = gradients()
            size = len(model.tables[k])
            step = RATE * _shallow(np.bincount(at, g, size), np.bincount(at, h, size), 2)
            model.tables[k] += step
            out += step[at]
    rough = [np.searchsorted(e, c, side="right") for e, c in zip(model.coarse, x.T, strict=True)]

    def cells(a, b, values):
        shape = (len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)
        return np.bincount(rough[a] * shape[1] + rough[b], values, shape[0] * shape[1]).reshape(shape)

    g, h = gradients()
    ranked = sorted(((_quadrants(cells(a, b, g), cells(a, b, h))[0], a, b)
                     for a in range(x.shape[1]) for b in range(a)), reverse=True)[:PAIRS]
    found = [(a, b, np.zeros((len(model.coarse[a]) + 1, len(model.coarse[b]) + 1))) for gain, a, b in ranked if gain > 0]
    for _ in range(PAIR_ROUNDS):
        for a, b, table in found:
            g, h = gradients()
            step = RATE * _quadrants(cells(a, b, g), cells(a, b, h))[1]
            table += step
            out += step[rough[a], rough[b]]
    model.pairs = found
    return model


def _matrix(texts) -> np.ndarray:
    return np.array([measures(t or "") for t in texts], float).reshape(-1, len(FEATURES))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Gam:
    sample, counts = labelled_sample(docs, labels, "quality", per_label)

    def rows(batches):
        for b in batches:
            x = _matrix(b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(list(x), pa.list_(pa.float64()))], ["label", "x"])

    got = sample.select("text", "label").mapInArrow(rows, "label int, x array<double>").toPandas()
    x = np.array([np.asarray(v) for v in got["x"]], float).reshape(-1, len(FEATURES))
    y = got["label"].to_numpy(float)
    order = np.lexsort([*x.T, y])  # the same model whatever order the rows came in
    x, y = x[order], y[order]
    weight = np.ones(len(y))
    for v in (0, 1):
        weight[y == v] = counts.get(v, 0) / max(1, (y == v).sum())
    return train(x, y, weight / weight.mean() if len(y) else weight)


def score(docs: DataFrame, model: Gam, text_col: str = "text") -> DataFrame:
    """``docs`` with score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(b):
        s = shared.value.scores(_matrix(b.column(b.schema.names.index(text_col)).to_pylist()))
        return [pa.array(s, pa.float64()), pa.array((s >= THRESHOLD).astype(np.int32), pa.int32())]

    return append_columns(docs.withColumn(text_col, F.col(text_col).cast("string")),
                          [("score", T.DoubleType()), ("predicted", T.IntegerType())], run)


def op10_quality(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
