"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

Words (runs of letters, lowered) are hashed into ``SLOTS`` embedding rows, and so are
their first ``STEM`` letters; a word's embedding is the sum of the two.  Filters of ``WIDTHS`` words slide over the whole text; each keeps its largest response, and a
linear layer turns those into a logit.  Words never met in training have a zero
row, so they answer nothing.  Training visits a bounded sample of labelled rows
(``PER_LABEL`` of each label, outside the held-out fold); rows of embeddings start
from the log-odds of their words, and Adagrad updates only what a maximum came from.

Thresholds are calibrated by language on a part of the sample that is set aside, and a score
is shifted so that its language's threshold lies at 0.5.  At scoring time the language is read
off the text itself, by naive Bayes over the same hashed words; the columns lang,
source and doc_id are never looked at.

Defined cases: null or empty text, or one without letters, scores what the bias gives;
without both labels in the sample every score is 0; equal texts get equal scores;
very long texts are handled in overlapping blocks, all of them; columns named like a new one are replaced.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeris.llm.common import append_columns, held_out, labelled_sample, read_table

SLOTS = 1 << 18
STEM = 4
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 6  # of each width
PER_LABEL = 2000
LANGUAGES = 32  # told apart, at most: the broadcast table has a column for each
EPOCHS = 6
RATE = 0.05
BLOCK = 8192  # words convolved at a time
KNOWN_WORDS = 200_000
MIN_PER_LANGUAGE = 20  # set-aside rows of either label below which the common threshold holds
THRESHOLD = 0.5
_WORD = re.compile(r"[^\W\d_]+")
_known: dict[str, int] = {}


def _slot(word: str) -> int:
    return 1 + zlib.crc32(word.encode("utf-8", "replace")) % (SLOTS - 1)


def word_slots(text: str) -> np.ndarray:
    """Slots of every word of the text and of its stem (n x 2); slot 0 is kept for padding."""
    out = []
    for w in _WORD.findall(text.lower()):
        k = _known.get(w)
        if k is None:
            k = _slot(w) << 32 | _slot(w[:STEM] + "-")
            if len(_known) < KNOWN_WORDS:
                _known[w] = k
        out.append(k)
    both = np.array(out, np.int64)
    return np.stack([both >> 32, both & 0xFFFFFFFF], axis=1).astype(np.int32)


def _padded(slots: np.ndarray) -> np.ndarray:
    short = max(WIDTHS) - len(slots)
    return np.r_[slots, np.zeros((short, 2), np.int32)] if short > 0 else slots


def _starts():
    return np.r_[0, np.cumsum([w * FILTERS for w in WIDTHS])]


@dataclass
class Cnn:
    words: np.ndarray  # slot x DIM
    filters: np.ndarray  # DIM x all filter places
    bias: np.ndarray  # per filter
    out: np.ndarray  # per filter
    shift: float
    languages: list[str] = field(default_factory=list)
    tongue: np.ndarray = field(default_factory=lambda: np.zeros((SLOTS, 0), np.float32))
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(0))
    common: float = 0.0
    sharp: float = 1.0

    def pooled(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter over the whole text, and the place it came from."""
        widest, slots = max(WIDTHS), _padded(slots)
        best, where = np.full(len(self.bias), -np.inf, np.float32), np.zeros(len(self.bias), np.int64)
        starts = _starts()
        for a in range(0, len(slots) - widest + 1, BLOCK):
            own = slots[a:a + BLOCK + widest - 1]
            z = (self.words[own[:, 0]] + self.words[own[:, 1]]) @ self.filters
            for j, w in enumerate(WIDTHS):
                n = len(z) - w + 1
                r = z[:n, starts[j]:starts[j] + FILTERS].copy()
                for p in range(1, w):
                    r += z[p:p + n, starts[j] + p * FILTERS:starts[j] + (p + 1) * FILTERS]
                k = r.argmax(axis=0)
                top = r[k, np.arange(FILTERS)]
                mine = slice(j * FILTERS, (j + 1) * FILTERS)
                better = top > best[mine]
                best[mine] = np.where(better, top, best[mine])
                where[mine] = np.where(better, k + a, where[mine])
        return best + self.bias, where

    def logit(self, slots: np.ndarray) -> float:
        h, _ = self.pooled(slots)
        return float(np.maximum(h, 0) @ self.out + self.shift)

    def language(self, slots: np.ndarray) -> int:
        """Position of the likeliest language, -1 if no word says anything."""
        if not self.languages or not len(slots):
            return -1
        odds = self.tongue[slots].sum(axis=(0, 1), dtype=np.float64)
        return int(odds.argmax()) if odds.any() else -1

    def score(self, text: str | None) -> float:
        slots = word_slots(text or "")
        k = self.language(slots)
        limit = self.thresholds[k] if k >= 0 else self.common
        return float(1 / (1 + np.exp(-np.clip(self.sharp * (self.logit(slots) - limit), -30, 30))))


def _log_odds(docs: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Log-odds of a toxic text given each slot, shrunk towards 0 for rare ones."""
    seen = np.zeros((2, SLOTS))
    for slots, label in zip(docs, y, strict=True):
        seen[label, np.unique(slots)] += 1
    n = np.bincount(y, minlength=2)
    odds = np.log((seen[1] + 0.5) / (n[1] + 1)) - np.log((seen[0] + 0.5) / (n[0] + 1))
    odds[seen.sum(axis=0) < 2] = 0
    odds[0] = 0
    return np.clip(odds, -4, 4)


def train(docs: list[np.ndarray], y: np.ndarray, seed: int = 5) -> Cnn:
    rng = np.random.default_rng(seed)
    widths = [w for w in WIDTHS for _ in range(FILTERS)]
    words = np.zeros((SLOTS, DIM), np.float32)
    met = np.unique(np.concatenate([np.zeros((0, 2), np.int32), *docs]))
    met = met[met > 0]
    words[met] = rng.normal(0, 0.05, (len(met), DIM))
    words[:, 0] += (_log_odds(docs, y) / 4).astype(np.float32)
    filters = rng.normal(0, 0.2, (DIM, sum(WIDTHS) * FILTERS)).astype(np.float32)
    filters[0] = np.abs(filters[0]) + 0.3
    model = Cnn(words, filters, np.zeros(len(widths), np.float32), np.full(len(widths), 0.3, np.float32), -1.0)
    square = {"words": np.full((SLOTS, DIM), 1e-4, np.float32), "filters": np.full(filters.shape, 1e-2, np.float32),
              "bias": np.full(len(widths), 1e-2, np.float32), "out": np.full(len(widths), 1e-2, np.float32)}
    shift_square = 1e-2
    starts = _starts()
    # column of each filter's weights, place by place
    columns = [[starts[j] + p * FILTERS + f for p in range(w)] for j, w in enumerate(WIDTHS) for f in range(FILTERS)]
    for _ in range(EPOCHS):
        for k in rng.permutation(len(docs)):
            slots = _padded(docs[k])
            h, where = model.pooled(slots)
            act = np.maximum(h, 0)
            p = 1 / (1 + np.exp(-np.clip(act @ model.out + model.shift, -30, 30)))
            err = np.float32(p - y[k])
            if abs(err) < 1e-3:
                continue
            g_out, g_h = err * act, err * model.out * (h > 0)
            for f in np.flatnonzero(g_h):
                at = slots[where[f]:where[f] + widths[f]]
                cols = columns[f]
                g_filters = g_h[f] * model.words[at].sum(axis=1).T
                for own in at.T:
                    g_words = g_h[f] * model.filters[:, cols].T * (own > 0)[:, None]
                    square["words"][own] += g_words ** 2
                    model.words[own] -= RATE * g_words / np.sqrt(square["words"][own])
                square["filters"][:, cols] += g_filters ** 2
                model.filters[:, cols] -= RATE * g_filters / np.sqrt(square["filters"][:, cols])
            square["bias"] += g_h ** 2
            model.bias -= RATE * g_h / np.sqrt(square["bias"])
            square["out"] += g_out ** 2
            model.out -= RATE * g_out / np.sqrt(square["out"])
            shift_square += float(err) ** 2
            model.shift -= RATE * float(err) / shift_square ** 0.5
    return model


def _cut(logits: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The middle of the widest gap among the thresholds with the best F1."""
    order = np.argsort(-logits, kind="stable")
    z, pos, w = logits[order], (y[order] * weight[order]), weight[order]
    hit, taken = np.cumsum(pos), np.cumsum(w)
    f1 = 2 * hit / (taken + pos.sum())
    ends = np.flatnonzero(np.r_[z[:-1] > z[1:], True])
    best = f1[ends].max()
    options = [e for e in ends if f1[e] >= best - 1e-12]
    below = [z[e + 1] if e + 1 < len(z) else z[e] - 1.0 for e in options]
    k = int(np.argmax([z[e] - b for e, b in zip(options, below, strict=True)]))
    return float((z[options[k]] + below[k]) / 2)


def calibrate(model: Cnn, docs: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> None:
    """Set the thresholds, one by language where enough rows were set aside."""
    if not len(y) or len(set(y.tolist())) < 2:
        model.common = 0.0
        model.thresholds = np.zeros(len(model.languages))
        return
    logits = np.array([model.logit(s) for s in docs])
    tongue = np.array([model.language(s) for s in docs])
    model.common = _cut(logits, y, weight)
    model.thresholds = np.full(len(model.languages), model.common)
    for k in range(len(model.languages)):
        own = tongue == k
        if min((y[own] == 0).sum(), (y[own] == 1).sum()) >= MIN_PER_LANGUAGE:
            model.thresholds[k] = _cut(logits[own], y[own], weight[own])


def learn_tongues(model: Cnn, docs: list[np.ndarray], langs: list[str | None]) -> None:
    """Log-likelihood of each slot by language, from the sample's lang; of the ``LANGUAGES`` most frequent ones."""
    common = Counter(x for x in langs if x is not None)
    names = sorted(sorted(common, key=lambda x: (-common[x], x))[:LANGUAGES])
    counts = np.zeros((SLOTS, len(names)))
    for slots, lang in zip(docs, langs, strict=True):
        if lang in names:
            np.add.at(counts[:, names.index(lang)], slots.ravel(), 1)
    seen = counts.sum(axis=1) > 1
    odds = np.log((counts + 0.1) / (counts.sum(axis=0) + 0.1 * max(1, seen.sum())))
    odds[~seen] = 0
    odds[0] = 0
    model.languages, model.tongue = names, odds.astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Cnn | None:
    """The trained classifier; None where the sample lacks a label."""
    sample, counts = labelled_sample(docs, labels, "toxic", per_label)

    def rows(batches):
        for b in batches:
            slots = [word_slots(t or "") for t in b.column(1).to_pylist()]
            flat = [s.ravel() for s in slots]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(flat, pa.list_(pa.int32())), *b.columns[2:]],
                                             ["doc_id", "slots", "lang", "label", "fold"])

    got = sample.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "label", "fold").mapInArrow(
        rows, "doc_id long, slots array<int>, lang string, label int, fold int").toPandas()
    got = got.sort_values(["doc_id", "label"], kind="stable")
    if len(set(got["label"])) < 2:
        return None
    slots, y = [np.asarray(s, np.int32).reshape(-1, 2) for s in got["slots"]], got["label"].to_numpy(int)
    langs = [x if isinstance(x, str) else None for x in got["lang"]]
    aside = got["fold"].to_numpy() == 1
    if min((y[~aside] == v).sum() for v in (0, 1)) == 0:
        aside[:] = False
    weight = np.array([counts[v] / (y == v).sum() for v in (0, 1)])[y]
    own = np.flatnonzero(~aside)
    model = train([slots[k] for k in own], y[own])
    learn_tongues(model, [slots[k] for k in own], [langs[k] for k in own])
    held = np.flatnonzero(aside) if aside.any() else own
    calibrate(model, [slots[k] for k in held], y[held], weight[held])
    return model


def score(docs: DataFrame, model: Cnn | None, text_col: str = "text") -> DataFrame:
    """``docs`` with score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(b):
        m = shared.value
        s = np.array([m.score(t) if m is not None else 0.0 for t in b.column(b.schema.names.index(text_col)).to_pylist()],
                     float)
        return [pa.array(s, pa.float64()), pa.array((s >= THRESHOLD).astype(np.int32), pa.int32())]

    return append_columns(docs.withColumn(text_col, F.col(text_col).cast("string")),
                          [("score", T.DoubleType()), ("predicted", T.IntegerType())], run)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
