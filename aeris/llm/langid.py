"""Language of a text: multinomial logistic regression over TF-IDF of character n-grams.

Letters are lowered, everything else becomes a blank; uni-, bi- and trigrams
are hashed into ``BUCKETS``.  Document frequencies count every training row (each task adds up
its own before anything is shuffled).  The weights are learned on a bounded
sample, ``PER_LANGUAGE`` rows of each of the ``LANGUAGES`` most frequent languages, by follow the regularised
leader with L1 and L2 penalties, which leaves most weights at exactly
zero; a fifth of the sample is set aside to fit one temperature.

Learned from text and lang of rows outside the held-out fold only; a
prediction sees the text alone.  Defined cases: null text, or one without a
letter: ``und`` with score 0; no training row: ``und`` everywhere, and ``keep`` drops only texts without a letter; very long texts
are counted block by block; ties go to the first language in alphabetic order; equal rows
get equal results; columns that bear the name of a new one are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeris.llm.common import append_columns, bounded_sample, fold, held_out, read_table, whole_rows

BUCKETS = 1 << 14
PER_LANGUAGE = 500
LANGUAGES = 100
EPOCHS = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.05  # of the learner
BLOCK = 1 << 19  # characters counted at a time
UNKNOWN = "und"
LEAST_SCORE = 0.35  # below it a text is taken to be in none of the languages
_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> its lower-case letter, or a blank where it is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def ngram_counts(text: str) -> np.ndarray | None:
    """Counts by bucket over the whole text; None where there is no letter."""
    table, total, seen, tail = _letters(), np.zeros(BUCKETS, np.int64), False, np.zeros(0, np.uint64)
    for a in range(0, max(len(text), 1), BLOCK):
        points = np.frombuffer(text[a:a + BLOCK].encode("utf-32-le", "surrogatepass"), "<u4")
        points = table[points].astype(np.uint64)
        seen = seen or bool((points != 32).any())
        ends = np.r_[tail, points]
        new = len(tail)  # n-grams that end in this block
        for n in (1, 2, 3):
            if len(ends) < n:
                continue
            key = np.zeros(len(ends) - n + 1, np.uint64)
            for k in range(n):
                key = key * np.uint64(0x10FFFF) + ends[k:len(ends) - n + 1 + k]
            key = key[max(0, new - n + 1):]
            hashed = ((key + np.uint64(n)) * _MIX) >> np.uint64(64 - 14)
            total += np.bincount(hashed.astype(np.int64), minlength=BUCKETS)
        tail = ends[-2:]
    return total if seen else None


def weigh(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and TF-IDF values (unit length) of one text."""
    at = np.flatnonzero(counts)
    x = (1.0 + np.log(counts[at])) * idf[at]
    norm = np.sqrt((x * x).sum())
    return at, x / norm if norm else x


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # bucket x language
    bias: np.ndarray
    temperature: float

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        at, x = weigh(counts, self.idf)
        return _softmax((x @ self.weights[at] + self.bias) / self.temperature)

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = ngram_counts(text) if text and self.languages else None
        if counts is None:
            return UNKNOWN, 0.0
        p = self.probabilities(counts)
        k = int(np.argmax(p))
        return self.languages[k], float(min(1.0, p[k]))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """(texts with a letter, number of them that hold each bucket), over all rows of ``docs``."""
    def count(batches):
        df, n = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            for t in b.column(0):
                counts = ngram_counts(t.as_py() or "")
                if counts is not None:
                    df += counts > 0
                    n += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, at]), pa.array(np.r_[n, df[at]])], ["bucket", "n"])

    rows = docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).collect()  # BUCKETS + 1 rows at most
    found = np.zeros(BUCKETS, np.int64)
    total = 0
    for r in rows:
        if r["bucket"] < 0:
            total = r["n"]
        else:
            found[r["bucket"]] = r["n"]
    return total, found


def learn(xs: list[tuple[np.ndarray, np.ndarray]], ys: list[int], classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by follow the regularised leader (proximal form), elastic net on the weights."""
    z, n = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))
    zb, nb = np.zeros(classes), np.zeros(classes)

    def weights(z, n):
        return -np.sign(z) * np.maximum(np.abs(z) - L1, 0) / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def bias():
        return -zb / ((BETA + np.sqrt(nb)) / ALPHA)

    order = np.random.default_rng(11)
    for _ in range(EPOCHS):
        for k in order.permutation(len(xs)):
            at, x = xs[k]
            w, b = weights(z[at], n[at]), bias()
            error = _softmax(x @ w + b)
            error[ys[k]] -= 1
            g = x[:, None] * error
            root = np.sqrt(n[at])
            n[at] += g * g
            z[at] += g - (np.sqrt(n[at]) - root) / ALPHA * w
            rootb = np.sqrt(nb)
            nb += error * error
            zb += error - (np.sqrt(nb) - rootb) / ALPHA * b
    return weights(z, n), bias()


def temperature(logits: np.ndarray, ys: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search over its logarithm."""
    if not len(ys):
        return 1.0

    def loss(log_t):
        z = logits / np.exp(log_t)
        z = z - z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(ys)), ys]).mean())

    lo, hi, gold = -4.0, 4.0, (5 ** 0.5 - 1) / 2
    for _ in range(60):
        a, b = hi - gold * (hi - lo), lo + gold * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Learn from the rows outside the held-out fold that have a lang."""
    train = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    n, df = document_frequencies(train)
    idf = np.log((1 + n) / (1 + df)) + 1
    sample, counts = bounded_sample(train, "lang", per_language, values=LANGUAGES)

    def features(batches):
        for b in batches:
            rows = []
            for d, t, lang, f in zip(*[c.to_pylist() for c in b.columns], strict=True):
                counts = ngram_counts(t)
                if counts is not None:
                    at = np.flatnonzero(counts)
                    rows.append((d, lang, f, at.astype(np.int32), counts[at].astype(np.int32)))
            cols = list(zip(*rows, strict=True)) if rows else [[], [], [], [], []]
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)],
                                             ["doc_id", "lang", "f", "at", "n"])

    got = sample.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", fold().cast("int").alias("f")).mapInArrow(
        features, "doc_id long, lang string, f int, at array<int>, n array<int>").toPandas()
    got = got.sort_values(["doc_id", "lang"], kind="stable")
    languages = sorted(set(got["lang"]))
    if not languages:
        return LanguageModel([], idf, np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    xs, ys, aside = [], [], []
    for lang, f, at, n_ in zip(got["lang"], got["f"], got["at"], got["n"], strict=True):
        dense = np.zeros(BUCKETS, np.int64)
        dense[np.asarray(at)] = np.asarray(n_)
        xs.append(weigh(dense, idf))
        ys.append(languages.index(lang))
        aside.append(f == 1)
    keep = [k for k, a in enumerate(aside) if not a] or list(range(len(xs)))
    weights, bias = learn([xs[k] for k in keep], [ys[k] for k in keep], len(languages))
    rest = [k for k, a in enumerate(aside) if a]
    logits = np.array([xs[k][1] @ weights[xs[k][0]] + bias for k in rest]).reshape(len(rest), len(languages))
    return LanguageModel(languages, idf, weights, bias, temperature(logits, np.array([ys[k] for k in rest], int)))


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(b):
        out = [shared.value.predict(t.as_py()) for t in b.column(b.schema.names.index(text_col))]
        return [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())]

    return append_columns(docs.withColumn(text_col, F.col(text_col).cast("string")),
                          [("lang_pred", T.StringType()), ("score", T.DoubleType())], score)


def keep(docs: DataFrame, model: LanguageModel, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is told with some certainty, all columns unchanged.

    A model that learned no language can tell none: then every text that has a letter stays.
    """
    rows = whole_rows(docs).withColumn("text", F.col("_row.text").cast("string"))
    if not model.languages:
        def lettered(b):
            texts = b.column(b.schema.names.index("text")).to_pylist()
            return [pa.array([any(c.isalpha() for c in t or "") for t in texts], pa.bool_())]

        return append_columns(rows, [("_lettered", T.BooleanType())], lettered).filter("_lettered").select("_row.*")
    return predict(rows, model).filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("_row.*")


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = predict(docs.select("doc_id", "text"), fit(docs))
    return scored.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
