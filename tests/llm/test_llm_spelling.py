"""Spelling variants: search schemes in the index, groups dealt anew, the whole operator against brute force."""

import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from aeris.llm import spelling
from aeris.llm.common import Scratch
from aeris.llm.fm_index import WordIndex, sorted_rotations

SCHEMA = "doc_id long, text string, word string, n int"


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(rows, least=7):
    counts = Counter()
    for doc, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
            elif run:
                h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
                k = h % len(run)
                counts[run[:k] + run[k + 1:] if h % 31 == 0 else run] += 1
                run = ""
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= 2}
    near = {w: [o for o in words if one_apart(w, o)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def made_up(seed=5, n=400):
    rng = random.Random(seed)
    letters = ["ab", "an", "ba", "é", "ß×", "nna"]
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(3, 6))) for _ in range(25)]
    rows = []
    for k in range(n):
        words = []
        for _ in range(rng.randint(0, 40)):
            w = rng.choice(stems[:3] if rng.random() < 0.7 else stems)
            if rng.random() < 0.15:
                at = rng.randrange(len(w) + 1)
                w = w[:at] + rng.choice(["", "a", "X", "é"]) + w[at + rng.randint(0, 1):]
            words.append(w)
        rows.append((k, " ".join(words) if k % 7 else ", ".join(words).upper()))
    return rows


@pytest.mark.parametrize("seed", range(30))
def test_rotations_come_in_order(seed):
    rng = np.random.default_rng(seed)
    text = np.r_[0, rng.integers(1, 3, int(rng.integers(1, 60)))]
    want = sorted(range(len(text)), key=lambda k: list(np.roll(text, -k)))
    assert sorted_rotations(text, 2).tolist() == want


@pytest.mark.parametrize("seed", range(60))
def test_index_finds_every_pair_once(seed):
    rng = random.Random(seed)
    words = sorted({"".join(rng.choice("abé"[:1 + seed % 3]) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 60))})
    index, w = WordIndex(words), np.arange(len(words))
    half, end = index.length // 2, index.length + 1
    cuts = [0 * half, half, (half + end) // 2, end] if seed % 2 else [0 * half, half, end]
    low, high = np.concatenate(cuts[:-1]), np.concatenate(cuts[1:])
    query, near = index.near(np.tile(w, len(cuts) - 1), low, high)
    got = Counter((words[np.tile(w, len(cuts) - 1)[q]], words[o]) for q, o in zip(query, near, strict=True))
    assert got == Counter((a, b) for a in words for b in words if one_apart(a, b))


@pytest.mark.parametrize("shard", [spelling.SHARD, 600])
def test_variants_match_brute_force(spark, shard):
    """With shards of 600 code points many groups are dealt anew, several times over."""
    rows = [*made_up(), (None, "abababab abababab"), (None, "abababab"), (1, None), (2, ""), (3, "short"), (4, "Q" * 3000 + " " + "q" * 3001),
            (4, "Q" * 3000 + " " + "q" * 3001), (5, "abcdefg " * 30 + "abcdefgh " * 3 + "abcdefghi abcdefghi"),
            (6, "abcdefg " * 300)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    found = spelling.variants(spelling.vocabulary(docs), shard=shard)
    got = [tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_small_shards_deal_groups_anew(spark):
    words = spark.createDataFrame([("prefixed" + "".join(random.Random(k).choices("xyz", k=6)), 2) for k in range(300)], "word string, n long")
    with Scratch(spark) as made:
        dealt = spelling._dealt(words.dropDuplicates(["word"]), made, 200)
        sizes = dealt.groupBy("key").count()
        assert sizes.agg({"count": "max"}).first()[0] <= 64
        assert dealt.filter("not query").count() > 0


def test_empty_and_unrelated(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert spelling.variants(spelling.vocabulary(none)).count() == 0
    only_null = spark.createDataFrame([(None, None, None, None)], SCHEMA)
    assert spelling.variants(spelling.vocabulary(only_null)).count() == 0


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    cur = con.execute(spelling.ORACLE_SQL)
    names = [d[0] for d in cur.description]
    got = spelling.op11_spelling(spark, sf)
    assert set(got.columns) == set(names)
    assert Counter(tuple(r[c] for c in names) for r in got.collect()) == Counter(cur.fetchall())
