"""The three classifiers against slow, plain forward passes, on every document."""

import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from aeris.llm import langid, quality_gam, toxicity

SF = "/root/testdata/sf0.001"
EXTRA = [None, "", "12 34 ?!", "ß", "the " * 3000, "ÀÉÎ\n\n..!!", "a", "one two", "| # $ ( ) 'x'\n'x'\n"]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(
        spark.createDataFrame([(-1 - k, t) for k, t in enumerate(EXTRA)], "doc_id long, text string")).cache()
    return docs, labels, texts


# -- language ------------------------------------------------------------------

def plain_language(model, text):
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    letters = []
    for c in text:
        low = c.lower()
        letters.append((ord(low) if len(low) == 1 else ord(c)) if c.isalpha() else 32)
    counts = [0] * langid.BUCKETS
    for n in (1, 2, 3):
        for k in range(len(letters) - n + 1):
            key = 0
            for x in letters[k:k + n]:
                key = (key * 0x10FFFF + x) % 2 ** 64
            counts[((key + n) * 0x9E3779B97F4A7C15 % 2 ** 64) >> 50] += 1
    x = [(1 + math.log(c)) * model.idf[b] if c else 0.0 for b, c in enumerate(counts)]
    norm = math.sqrt(sum(v * v for v in x))
    logits = [(sum(v / norm * model.weights[b][k] for b, v in enumerate(x) if v) + model.bias[k]) / model.temperature
              for k in range(len(model.languages))]
    top = max(logits)
    share = [math.exp(z - top) for z in logits]
    best = max(range(len(share)), key=lambda k: (share[k], -k))
    return model.languages[best], share[best] / sum(share)


def test_languages_by_a_dense_softmax(tables):
    docs, _, texts = tables
    model = langid.fit(docs)
    for r in langid.predict(texts, model).collect():
        lang, score = plain_language(model, r["text"])
        assert r["lang_pred"] == lang and abs(r["score"] - min(1.0, score)) < 1e-9, r["doc_id"]


# -- toxicity ------------------------------------------------------------------

def plain_toxicity(model, text):
    words = re.findall(r"[^\W\d_]+", (text or "").lower())

    def slot(w):
        return 1 + zlib.crc32(w.encode("utf-8", "replace")) % (toxicity.SLOTS - 1)

    pairs = [(slot(w), slot(w[:toxicity.STEM] + "-")) for w in words]
    odds = [0.0] * len(model.languages)
    for pair in pairs:
        for s in pair:
            for k in range(len(odds)):
                odds[k] += float(model.tongue[s][k])
    tongue = max(range(len(odds)), key=lambda k: (odds[k], -k)) if pairs and any(odds) else -1
    pairs += [(0, 0)] * (max(toxicity.WIDTHS) - len(pairs))
    vectors = [model.words[a] + model.words[b] for a, b in pairs]
    total, column, f = model.shift, 0, 0
    for width in toxicity.WIDTHS:
        for j in range(toxicity.FILTERS):
            best = -math.inf
            for at in range(len(vectors) - max(toxicity.WIDTHS) + 1 + (max(toxicity.WIDTHS) - width)):
                r = sum(float(vectors[at + p] @ model.filters[:, column + p * toxicity.FILTERS + j]) for p in range(width))
                best = max(best, r)
            total += max(0.0, best + float(model.bias[f])) * float(model.out[f])
            f += 1
        column += width * toxicity.FILTERS
    limit = model.thresholds[tongue] if tongue >= 0 else model.common
    return 1 / (1 + math.exp(-min(30, max(-30, model.sharp * (total - limit)))))


def test_toxicity_by_a_convolution_word_by_word(tables):
    docs, labels, texts = tables
    model = toxicity.fit(docs, labels)
    short = texts.filter("text IS NULL OR length(text) < 2500")
    rows = toxicity.score(short, model).collect()
    assert len(rows) > 60
    for r in rows:
        assert abs(r["score"] - plain_toxicity(model, r["text"])) < 1e-4, r["doc_id"]


def test_toxicity_tables_are_bounded_in_languages(tables):
    docs, labels, _ = tables
    many = docs.withColumn("lang", F.concat(F.lit("l"), F.col("doc_id").cast("string")))
    model = toxicity.fit(many, labels)
    assert model.tongue.shape == (toxicity.SLOTS, toxicity.LANGUAGES) and len(model.languages) == toxicity.LANGUAGES


# -- quality -------------------------------------------------------------------

def plain_quality(model, text):
    x = quality_gam.measures(text or "")

    def place(edges, v):
        k = 0
        for e in edges:
            if v >= e:
                k += 1
        return k

    total = model.intercept
    for k, table in enumerate(model.tables):
        total += table[place(model.edges[k], x[k])]
    for a, b, table in model.pairs:
        total += table[place(model.coarse[a], x[a])][place(model.coarse[b], x[b])]
    return 1 / (1 + math.exp(-min(30, max(-30, total))))


def test_quality_by_looking_up_one_bin_at_a_time(tables):
    docs, labels, texts = tables
    model = quality_gam.fit(docs, labels)
    assert model.pairs
    for r in quality_gam.score(texts, model).collect():
        score = plain_quality(model, r["text"])
        assert abs(r["score"] - score) < 1e-9 and r["predicted"] == (score >= 0.3), r["doc_id"]


def test_measures_by_plain_counting():
    for text in [t for t in EXTRA if t and t.split()]:
        m = dict(zip(quality_gam.FEATURES, quality_gam.measures(text), strict=True))
        words, raw = text.split(), text.encode()
        assert m["log_words"] == pytest.approx(math.log1p(len(words)))
        assert m["top_word"] == pytest.approx(max(words.count(w) for w in words) / len(words))
        assert m["exclaims"] == pytest.approx(text.count("!") / len(words))
        assert m["digits"] == pytest.approx(sum(c in "0123456789" for c in text) / len(raw))
        assert m["non_ascii"] == pytest.approx(sum(b > 127 for b in raw) / len(raw))
        assert m["pipes"] == pytest.approx(text.count("|") / len(words))
