"""Legal but rare input: version tokens in payloads, new letters, clashing names, many languages, deleted scratch tables."""

import hashlib
import os
import sys

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from aeris import session
from aeris.llm import bpe, common, embeddings, hashing, langid, minhash, packing, quality_rules, suffix_dedup, warc

LINE = "WARC/1.1\r\n\r\n"


@pytest.mark.parametrize("size", [1 << 16, 150, 9, 5])
def test_payloads_and_chunks_that_end_in_part_of_a_version_line(spark, size):
    rows = [(k, f"http://x/{LINE[:k]}", "x" * fill + LINE[:k]) for fill in (0, 1, 142, 150) for k in range(len(LINE) + 1)]
    rows = [(i, u, h) for i, (_, u, h) in enumerate(rows)] + [(900, "http://x/WARC/1.1", "WARC/1.1" * 40), (901, "WARC/1.1", "WARC/WARC/1.1\r\nWARC/1.1")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"]) for r in warc.read_archive(spark, warc.archive(df, size=size)).collect()}
    assert got == {i: (len(h), hashlib.sha256(h.encode()).hexdigest()) for i, _, h in rows}


def test_every_code_point_gets_the_ids_of_the_library():
    spec = bpe.read_vocabulary()
    library, own, packed = Tokenizer.from_str(spec), bpe.bpe_of(spec), packing.library_coder(spec)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x20000 or c % 97 == 0)]
    for k in range(0, len(points), 4000):
        text = " ".join([f"{c} a{c}b" for c in points[k:k + 4000]])
        want = library.encode(text, add_special_tokens=False).ids
        if own.encode(text).tolist() != want or packed.encode(text).tolist() != want:
            bad = [hex(ord(c)) for c in points[k:k + 4000] for t in (c, f"a{c}b") if not (
                own.encode(t).tolist() == packed.encode(t).tolist() == library.encode(t, add_special_tokens=False).ids)]
            raise AssertionError(bad[:20])
    own.forget()
    packed.forget()
    assert not own.runs and not packed.pieces


def test_ledger_bears_clashing_names(spark):
    df = spark.createDataFrame([(1, "word " * 60, 5, 6, 7, 8)], "doc_id long, text string, N_WORDS int, _m int, Failed_Bits int, KEPT int")
    row = quality_rules.judge(df).first()
    assert (row["n_words"], row["_m"], row["base_failed"]) == (60, 6, True)
    assert quality_rules.keep(df).columns == df.columns


def test_thousands_of_languages(spark):
    rows = [(k, f"text number {k} of some words", f"l{k:04}") for k in range(4000)] + [
        (10_000 + k, "the and of " * 5 if k % 2 else "der und das " * 5, "en" if k % 2 else "de") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert len(model.languages) == langid.LANGUAGES and {"en", "de"} <= set(model.languages)
    assert model.predict("der und das der")[0] == "de"


def test_sample_is_bounded_under_one_id(spark):
    df = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.col("id").cast("string").alias("text"), F.lit("x").alias("lang"))
    drawn, counts = common.bounded_sample(df, "lang", 500)
    assert counts == {"x": 20_000} and 350 < drawn.count() < 650
    nulls, counts = common.bounded_sample(df.withColumn("lang", F.lit(None).cast("string")), "lang", 100)
    assert counts == {None: 20_000} and nulls.count() > 0


def test_tables_of_powers_are_of_fixed_size():
    import numpy as np

    long = np.frombuffer(b"ab" * (2 * hashing.BLOCK), np.uint8)
    sums = hashing.prefix_sums(long)
    a = hashing.range_hashes(sums, np.array([0, 2]), np.array([hashing.BLOCK, hashing.BLOCK + 2]))
    assert a[0] == a[1]
    hashing.prefix_sums(long[:100])
    assert len(hashing._power["up"]) == 2 * hashing.BLOCK


def tables_in(spark):
    root = f"{session.ensure_checkpoint_dir(spark)}/aeris".removeprefix("file:")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_operators_leave_only_what_their_results_read(spark):
    docs = spark.createDataFrame([(k, f"some words that stand here again and again {k % 3} " * 8) for k in range(12)], "doc_id long, text string")
    vectors = spark.createDataFrame([(k, [1.0, 0.1 * (k % 4), 0.0, 0.5]) for k in range(20)], "vec_id long, embedding array<double>")
    for fn, df, left in ((minhash.groups, docs, 1), (suffix_dedup.removed, docs, 3), (embeddings.link, vectors, 1), (packing.pack, docs, 1)):
        before, kept = tables_in(spark), []
        assert fn(df, kept=kept).count() == df.count()
        made = tables_in(spark) - before
        assert made == {p.rsplit("/", 1)[1] for p in kept} and len(kept) == left, fn
        session.remove_paths(spark, kept)
        assert tables_in(spark) == before
    before = tables_in(spark)
    warc.archive(spark.createDataFrame([(1, "u", "x" * 200)], "page_id long, url string, html string"))
    assert {n.split("-")[0] for n in tables_in(spark) - before} == {"warc"}


def test_a_class_is_signed_once_in_a_batch(spark, monkeypatch):
    text = "one two three four five six seven"
    rows = minhash.signatures(spark.createDataFrame([(k, text if k % 2 else f"{text} {k}") for k in range(30)], "doc_id long, text string")).collect()
    same = {bytes(r["sketch"]) for r in rows if r["doc_id"] % 2}
    assert len(same) == 1 and len({bytes(r["sketch"]) for r in rows}) == 16
    assert sys.getsizeof(rows[0]["sketch"]) > minhash.BANDS
