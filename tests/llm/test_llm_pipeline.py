"""The corpus pipeline against a stage-by-stage brute-force version."""

import sys

import duckdb
from tokenizers import Tokenizer

import corpus_pipeline
from aeris.llm import bpe, langid, quality_rules
from aeris.llm.common import read_table
from tests.llm import brute
from tests.llm.test_llm_text import check_packing

SF = "/root/testdata/sf0.001"


def test_stages_match_brute_force(spark):
    source = duckdb.sql(f"SELECT doc_id, text FROM read_parquet('{SF}/documents.parquet')").fetchall()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    good = {r[0] for r in con.execute(f"SELECT doc_id FROM ({quality_rules.ORACLE_SQL}) WHERE kept").fetchall()}
    rows = [(i, t) for i, t in source if i in good]
    docs = read_table(spark, SF, "documents")
    ruled = docs.filter(docs["doc_id"].isin(list(good)))
    model = langid.fit(ruled)
    told = [(i, t) for i, t in rows if model.predict(t)[0] != "und" and model.predict(t)[1] >= langid.LEAST_SCORE]
    assert len(told) >= 0.99 * len(rows)
    groups = brute.near_copies(told)
    single = [(i, t) for i, t in told if groups[i] == i]
    cleaned = [(i, brute.without(t, w[5])) for (i, t), w in zip(single, brute.repeated_bytes(single))]
    packed = corpus_pipeline.run(spark, SF).collect()
    check_packing(packed, cleaned, Tokenizer.from_file(bpe.default_vocabulary()), 4096)


def test_every_stage_keeps_the_columns_and_bears_empty_input(spark):
    docs = read_table(spark, SF, "documents").withColumnRenamed("source", "_row")
    none = docs.filter("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, SF)
        assert out.count() == 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns


def test_without_any_lang_the_language_stage_drops_only_texts_without_a_letter(spark):
    rows = [(k, t, None) for k, t in enumerate(["Some plain words", "ein paar Wörter", "12 34 !", "", None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = dict(corpus_pipeline.STAGES)["language_id"](spark, docs, SF)
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == [0, 1]


def test_queries_are_registered_and_the_library_stands_without_them(monkeypatch):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    for module in [m for m in sys.modules if m.startswith("aeris.llm")] + ["corpus_pipeline"]:
        monkeypatch.setitem(sys.modules, module, None)
    assert not [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
