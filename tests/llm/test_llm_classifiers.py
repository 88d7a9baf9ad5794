"""Language, toxicity and quality: held-out accuracy and what a score may depend on."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeris.llm import langid, quality_gam, toxicity
from aeris.llm.common import held_out

SF = "/root/testdata/sf0.01"
ODD = [(1, None, "en", "q"), (2, "", None, "q"), (None, "12 34 ?!", "fr", "q"), (3, "the and of " * 20000, "en", "q"),
       (3, "the and of " * 20000, "en", "q"), (5, "ß", "xx", "q")]
SCHEMA = "doc_id long, text string, lang string, score string"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def auc(score, label):
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1
    one, zero = (label == 1).sum(), (label == 0).sum()
    return (order[label == 1].sum() - one * (one + 1) / 2) / (one * zero)


def judged(scored, labels, label):
    return scored.join(labels, "doc_id").filter(held_out()).select("score", "predicted", F.col(label).alias("y")).toPandas()


def test_held_out_languages(spark, tables):
    got = langid.op7_language_id(spark, SF).join(tables[0].select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (got["lang"] == got["lang_pred"]).mean() > 0.97
    assert got["score"].between(0, 1).all()


def test_language_edge_rows(tables, odd):
    model = langid.fit(tables[0], per_language=60)
    got = [(r["lang_pred"], r["score"]) for r in langid.predict(odd, model).collect()]
    assert [x for x, _ in got][:5] == ["und", "und", "und", "en", "en"] and got[3] == got[4]
    assert all(s == 0.0 for x, s in got if x == "und")
    assert langid.keep(odd, model).columns == odd.columns
    none = langid.fit(odd.filter("false"))
    assert {r["lang_pred"] for r in langid.predict(odd, none).collect()} == {"und"}
    assert langid.predict(odd.filter("false"), model).count() == 0


def test_ngrams_block_by_block(monkeypatch):
    text = "Über den Wolken, naïve café! " * 40
    whole = langid.ngram_counts(text)
    for block in (1, 7, 64):
        monkeypatch.setattr(langid, "BLOCK", block)
        assert np.array_equal(langid.ngram_counts(text), whole)


def test_the_penalty_leaves_weights_at_zero(tables):
    model = langid.fit(tables[0], per_language=60)
    assert (model.weights == 0).mean() > 0.5 and 0 < model.temperature


def test_temperature_is_the_best(tables):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 4000)
    logits = rng.normal(size=(4000, 3))
    logits[np.arange(4000), y] += 1.0
    assert abs(langid.temperature(logits, y) - 1.0) < 0.1
    assert abs(langid.temperature(logits * 5, y) - 5.0) < 0.5
    assert langid.temperature(np.zeros((0, 3)), np.zeros(0, int)) == 1.0


def test_held_out_quality(spark, tables):
    got = judged(quality_gam.op10_quality(spark, SF), tables[1], "quality")
    assert auc(got["score"].to_numpy(), got["y"].to_numpy()) > 0.95
    assert (got["predicted"] == (got["score"] >= 0.3)).all()


def test_held_out_toxicity(spark, tables):
    got = judged(toxicity.op4_toxicity(spark, SF), tables[1], "toxic")
    assert auc(got["score"].to_numpy(), got["y"].to_numpy()) > 0.9
    assert (got["predicted"] == (got["score"] >= 0.5)).all()


@pytest.mark.parametrize("module,label", [(quality_gam, "quality"), (toxicity, "toxic")])
def test_held_out_labels_and_other_columns_do_not_matter(tables, odd, module, label):
    docs, labels = tables
    docs = docs.filter("doc_id < 400")
    flipped = labels.withColumn(label, F.when(held_out(), 1 - F.col(label)).otherwise(F.col(label)))
    one, two = module.fit(docs, labels, 150), module.fit(docs, flipped, 150)
    a = [r["score"] for r in module.score(docs.select("doc_id", "text"), one).collect()]
    b = [r["score"] for r in module.score(docs.withColumn("lang", F.lit("zz")).withColumn("doc_id", F.col("doc_id") + 7), two).collect()]
    assert a == b
    assert [r["score"] for r in module.score(odd, one).collect()][3:5] == [r["score"] for r in module.score(odd, one).collect()][4:2:-1]
    assert module.score(odd, one).columns[-2:] == ["score", "predicted"] and module.score(odd, one).count() == len(ODD)
    assert all(0 <= r["score"] <= 1 for r in module.score(odd, one).collect())


@pytest.mark.parametrize("module", [quality_gam, toxicity])
def test_without_labels_every_score_is_defined(tables, odd, module):
    docs, labels = tables
    model = module.fit(docs, labels.filter("false"))
    assert len({r["score"] for r in module.score(odd, model).collect()}) == 1
    assert module.score(odd.filter("false"), model).count() == 0


def test_gam_finds_shapes_and_interactions():
    rng = np.random.default_rng(2)
    x = np.zeros((4000, len(quality_gam.FEATURES)))
    x[:, :3] = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)      # nothing but an interaction
    model = quality_gam.train(x, y, np.ones(4000))
    assert ((model.scores(x) > 0.5) == (y > 0.5)).mean() > 0.95
    assert {0, 1} in [{a, b} for a, b, _ in model.pairs]
    y = (np.abs(x[:, 2] - 0.5) > 0.25).astype(float)           # one feature, not monotone
    assert ((quality_gam.train(x, y, np.ones(4000)).scores(x) > 0.5) == (y > 0.5)).mean() > 0.95


def test_long_texts_are_read_to_the_end():
    docs = [toxicity.word_slots("fine words here " * 5 + w) for w in ("slur", "nice")] * 40
    model = toxicity.train(docs, np.array([1, 0] * 40))
    long = "plain text " * (3 * toxicity.BLOCK)
    assert model.logit(toxicity.word_slots(long + "slur")) > model.logit(toxicity.word_slots(long + "nice")) + 1
