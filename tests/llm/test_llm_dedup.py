"""Near copies, vectors, repeated strings."""

import hashlib
import random

import duckdb
import numpy as np
import pytest

from aeris.llm import embeddings, minhash, suffix_dedup
from aeris.llm.common import connected_components
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def documents(limit=10**9):
    return duckdb.sql(f"SELECT doc_id, text FROM read_parquet('{SF}/documents.parquet') WHERE doc_id < {limit}").fetchall()


# -- components ----------------------------------------------------------------

@pytest.mark.parametrize("edges", [[(k, k + 1) for k in range(200)], [(0, k) for k in range(1, 50)], [(5, 5)], [],
                                   [((k * 37) % 101, (k * 53) % 101) for k in range(90)]])
def test_components(spark, edges):
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    ids = {x for e in edges for x in e}
    want = brute.components(ids, edges)
    assert got == want


# -- MinHash -------------------------------------------------------------------

def test_signatures_are_unbiased_for_weighted_sets():
    rng = np.random.default_rng(0)
    for top in (1, 3, 9):
        ids = rng.integers(0, 2**63, 300).astype(np.uint64)
        a = rng.integers(0, top + 1, 300)
        b = np.where(rng.random(300) < 0.6, a, rng.integers(0, top + 1, 300))
        bags = [(ids[w > 0], w[w > 0]) for w in (a, b)]
        one, two = minhash.bag_minhashes(bags, 6000)
        truth = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert abs(float((one == two).mean()) - truth) < 4 * (truth * (1 - truth) / 6000) ** 0.5
        assert abs(minhash.overlap(*bags) - truth) < 1e-12


def test_a_signature_does_not_depend_on_what_it_is_computed_with():
    bags = [minhash.shingles(t) for t in ("a b c d e f g h", "x", "", "a b c d e f g h i j k l " * 50)]
    together = minhash.bag_minhashes(bags, 150)
    for bag, sig in zip(bags, together):
        assert np.array_equal(minhash.bag_minhashes([bag], 150)[0], sig)
    assert len(together[2]) == 0


def edited(rnd, base, edits):
    out = list(base)
    for _ in range(edits):
        out[rnd.randrange(len(out))] = f"n{rnd.randrange(10**6)}"
    return " ".join(out)


def test_groups_match_all_pairs(spark):
    rnd = random.Random(2)
    rows = documents(150)
    for k in range(12):       # groups around the limit of 0.8, chains among them
        base = [f"b{k}x{j}" for j in range(120)]
        rows += [(1000 + 20 * k + j, edited(rnd, base, rnd.randrange(0, 5))) for j in range(15)]
    got = {r["doc_id"]: r["group_id"] for r in minhash.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.near_copies(rows)


def test_near_copy_edge_rows(spark):
    rows = [(1, "a b c d e f g", "x"), (2, "a  b\nc d e f g", "y"), (3, None, "x"), (4, "", "x"), (5, "hi", "x"), (6, "hi", "x"),
            (None, "hi", "x"), (6, "hi", "z"), (7, " \n", "x"), (8, "word " * 50000, "x"), (9, "word " * 50001, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _key string")
    got = sorted((r["doc_id"], r["group_id"]) for r in minhash.groups(df).collect())
    assert got == sorted([(1, 1), (2, 1), (3, 3), (4, 4), (5, 5), (6, 5), (6, 5), (7, 7), (8, 8), (9, 8), (minhash.TOP, 5)])
    kept = minhash.dedup(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 5, 7, 8]
    assert minhash.dedup(df.filter("false")).count() == 0


def test_texts_without_an_id_or_under_one_id_are_told_apart(spark):
    rnd = random.Random(12)
    base, other = [f"p{j}" for j in range(80)], [f"q{j}" for j in range(80)]
    alone = [" ".join(f"z{k}x{j}" for j in range(60)) for k in range(3)]
    rows = [(3, " ".join(base)), (None, edited(rnd, base, 1)), (None, alone[0]), (None, alone[0]), (5, " ".join(other)),
            (9, edited(rnd, other, 1)), (9, alone[1]), (8, edited(rnd, base, 1)), (None, alone[2]),
            (20, "one two three four five six seven"), (20, "one two three four five six seven one two three four five six seven")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {t: (r["group_id"], r["kept"]) for r in minhash.groups(df.select("doc_id", "text")).collect()
           for d, t in rows if (minhash.TOP if d is None else d) == r["doc_id"] and hashlib.sha256(t.encode()).hexdigest() == r["key"]}
    top = minhash.TOP
    assert [got[t] for _, t in rows] == [(3, True), (3, False), (top, True), (top, True), (5, True), (5, False), (9, True),
                                         (3, False), (top, True), (20, True), (20, True)]
    assert sorted(((r["doc_id"] or top, r["text"]) for r in minhash.dedup(df).collect())) == sorted(
        [(d or top, t) for k, (d, t) in enumerate(rows) if k in (0, 2, 4, 6, 8, 9, 10)])


def test_one_of_two_near_copies_under_one_id_stays(spark):
    rnd = random.Random(13)
    base = [f"w{j}" for j in range(80)]
    for doc_id in (4, None):
        df = spark.createDataFrame([(doc_id, " ".join(base)), (doc_id, edited(rnd, base, 1))], "doc_id long, text string")
        assert [r["kept"] for r in minhash.groups(df).orderBy("kept").collect()] == [False, True]
        assert minhash.dedup(df).count() == 1


# -- vectors -------------------------------------------------------------------

def cluster(rng, n, dim, spread):
    centre = rng.normal(size=dim)
    return (centre + rng.normal(size=(n, dim)) * spread).tolist()


@pytest.mark.parametrize("block", [16, 512])
def test_links_match_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(4)
    vectors = [v for n in (60, 25, 7, 3, 2, 2) for v in cluster(rng, n, 64, 0.12)] + rng.normal(size=(150, 64)).tolist()
    vectors += vectors[:20] + [vectors[0]] * 15
    rows = [(int(i), v) for i, v in zip(rng.permutation(len(vectors)) * 3, vectors)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in
           embeddings.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    want = brute.linked_vectors(rows)
    assert got == {i: (n, c, i == c) for (i, _), (n, c) in zip(rows, want)}


def test_recall_right_at_the_threshold(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    r = rng.normal(size=x.shape)
    r -= (r * x).sum(axis=1)[:, None] * x
    r /= np.linalg.norm(r, axis=1)[:, None]
    y = 0.905 * x + (1 - 0.905 ** 2) ** 0.5 * r
    rows = [(k, v.tolist()) for k, v in enumerate([*x, *y])]
    got = embeddings.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert got.filter("n_links > 0").count() >= 2 * 1500 * 0.98


def test_tables_suffice_in_many_dimensions():
    rng = np.random.default_rng(15)
    x, r = rng.normal(size=(2, 600, 768))
    x /= np.linalg.norm(x, axis=1)[:, None]
    r -= (r * x).sum(axis=1)[:, None] * x
    r /= np.linalg.norm(r, axis=1)[:, None]
    hashes, tables = embeddings.tables_for(1500, 768)
    names = embeddings.bucket_names(np.concatenate([x, 0.9 * x + (1 - 0.9 ** 2) ** 0.5 * r]), hashes, tables)
    a, b = names[:600], names[600:]
    met = ((a[:, :, :1] == b).any(axis=2) | (b[:, :, :1] == a).any(axis=2)).any(axis=1)
    assert met.mean() >= 0.99


def test_vector_edge_rows(spark):
    rng = np.random.default_rng(1)
    a, b, c = rng.normal(size=(3, 5)).tolist()
    rows = [(1, a, 0), (2, a, 0), (3, [2 * x for x in a], 0), (4, None, 0), (5, [0.0] * 5, 0), (6, [1.0, None, 2.0, 1.0, 1.0], 0),
            (7, [float("nan")] * 5, 0), (8, [], 0), (9, b, 0), (9, b, 0), (None, b, 0), (11, b[:3], 0),
            (12, [1e-200 * x for x in c], 0), (13, [1e200 * x for x in c], 0), (14, [1.0], 0), (15, [3.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component_id int")
    got = sorted(((r["vec_id"] or 99, r["n_links"], r["component_id"], r["kept"]) for r in embeddings.link(df).collect()))
    assert got == [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True),
                   (7, 0, 7, True), (8, 0, 8, True), (9, 2, 9, True), (9, 2, 9, True), (11, 0, 11, True), (12, 1, 12, True),
                   (13, 1, 12, False), (14, 1, 14, True), (15, 1, 14, False), (99, 2, 9, False)]
    assert embeddings.link(df.filter("false")).count() == 0


def test_links_of_vectors_that_share_an_id_or_have_none(spark):
    rng = np.random.default_rng(9)
    a, b, c, d, e, f = rng.normal(size=(6, 64))

    def near(x):
        return (x + rng.normal(size=64) * 0.05).tolist()

    rows = [(3, a.tolist()), (9, near(a)), (9, b.tolist()), (9, near(a)), (12, near(b)), (5, c.tolist())]
    loose = [(None, near(c)), (None, d.tolist()), (None, d.tolist()), (None, e.tolist()), (None, near(e)), (None, f.tolist())]
    df = spark.createDataFrame(rows + loose, "vec_id long, embedding array<double>").repartition(3)
    got = sorted((r["vec_id"] or 99, r["n_links"], r["component_id"] or 99, r["kept"]) for r in embeddings.link(df).collect())
    want = [(i, n, p, i == p) for (i, _), (n, p) in zip(rows, brute.linked_vectors(rows))]
    want = [(i, n + (i == 5), p, k) for i, n, p, k in want]     # 5 has a near copy without an id
    want += [(99, 1, 5, False), (99, 1, 99, True), (99, 1, 99, True), (99, 1, 99, False), (99, 1, 99, True), (99, 0, 99, True)]
    assert got == sorted(want)


# -- repeated strings ----------------------------------------------------------

def passages(seed):
    rnd = random.Random(seed)
    parts = ["ab", "cde", "é", "fghij", "k", "lm\n", "ñop"]

    def text(n):
        return " ".join(rnd.choice(parts) + str(rnd.randrange(50)) for _ in range(n))

    shared = [text(60) for _ in range(5)]
    rows = []
    for k in range(60):
        p = rnd.choice(shared)
        a = rnd.randrange(0, len(p) // 2)
        rows.append((k, text(rnd.randrange(50)) + p[a:rnd.randrange(a, len(p))] + text(rnd.randrange(50))))
    return rows + [(100, None), (101, ""), (102, "x" * 1000), (103, "é" * 150), (3, rows[3][1]), (104, "x" * 199),
                   (105, "ab" * 99 + "q"), (106, "z" + "w" * 200), (107, "w" * 200), (None, rows[3][1])]


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_the_sample_meets_every_shift():
    d = suffix_dedup.COVER
    assert {(a - b) % suffix_dedup.PERIOD for a in d for b in d} == set(range(suffix_dedup.PERIOD))
    assert suffix_dedup.NAME_LENGTH + suffix_dedup.PERIOD - 1 == suffix_dedup.LENGTH


@pytest.mark.parametrize("together,seed", [(500, 1), (1 << 20, 2)])
def test_repeated_strings_match_a_full_count(spark, monkeypatch, together, seed):
    monkeypatch.setattr(suffix_dedup, "TOGETHER", together)
    monkeypatch.setattr(suffix_dedup, "PER_BUCKET", 400)
    rows = passages(seed)
    df = spark.createDataFrame([(i, t, "q") for i, t in rows], "doc_id long, text string, digest string")
    want = brute.repeated_bytes(rows)
    assert as_rows(suffix_dedup.removed(df)) == sorted((w[:5] for w in want), key=str)
    left = suffix_dedup.strip_repeats(df)
    assert left.columns == df.columns
    assert as_rows(left) == sorted(((i, t if t is None else brute.without(t, w[5]), "q") for (i, t), w in zip(rows, want)), key=str)
    assert suffix_dedup.removed(df.filter("false")).count() == 0


def test_repeated_strings_of_documents(spark):
    rows = documents()
    got = as_rows(suffix_dedup.op6_suffix_dedup(spark, SF))
    assert got == sorted((w[:5] for w in brute.repeated_bytes(rows)), key=str)


def test_hashing_block_by_block_changes_nothing(monkeypatch):
    raw = np.frombuffer(random.Random(5).randbytes(5000), np.uint8)
    at = suffix_dedup.sampled(len(raw))
    whole = suffix_dedup.hashes_at(raw, at, suffix_dedup.NAME_LENGTH)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 300)
    assert np.array_equal(suffix_dedup.hashes_at(raw, at, suffix_dedup.NAME_LENGTH), whole)


def test_blocks_alone_find_the_same_groups(spark, monkeypatch):
    monkeypatch.setattr(minhash, "PIVOTS", 0)
    monkeypatch.setattr(minhash, "BLOCK", 4)
    monkeypatch.setattr(minhash, "_COLUMNS", 50)
    rnd = random.Random(8)
    base = [f"w{j}" for j in range(100)]
    rows = [(k, edited(rnd, base, rnd.randrange(0, 9))) for k in range(60)] + [(90, "a b " * 40), (91, "a b " * 37), (92, "a b " * 20)]
    got = {r["doc_id"]: r["group_id"] for r in minhash.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.near_copies(rows)
