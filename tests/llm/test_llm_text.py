"""Quality rules, tokens and packing."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from tokenizers import Tokenizer

from aeris.llm import bpe, packing, quality_rules
from tests.llm.brute import words
from tools.check_oracle import canon

SF = "/root/testdata/sf0.001"
ODD = [(1, None, "x"), (2, "", None), (2, "", None), (None, "one two", "y"), (4, " \n\t ", "z"),
       (5, "a b c " * 40, "z"), (6, "line one is here\n" * 30, ""), (7, "Ünï cödé " * 30 + "#*$%&|<>!", "z"),
       (8, " ".join(f"w{k}" for k in range(30000)) + " tail w0 w1 w2", "z")]
SCHEMA = "doc_id long, text string, n_words string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_vocabulary())


def measured(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    triples = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    often = Counter(triples)
    covered = {k + j for k, t in enumerate(triples) if often[t] > 1 for j in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines), len(lines) - len(set(lines)),
            len(covered), (text or "").count("!"))


def test_rules_match_a_plain_count(odd):
    got = Counter(tuple(r[c] for c in ("doc_id", *quality_rules.MEASURES, "base_failed")) for r in quality_rules.judge(odd).collect())
    want = Counter()
    for i, t, _ in ODD:
        m = measured(t)
        want[(i, *m, m[0] < 50 or 100 * m[5] > 50 * m[0])] += 1
    assert got == want


def test_rules_keep_other_columns_and_bear_empty_tables(odd):
    kept = quality_rules.keep(odd)
    assert kept.columns == ["doc_id", "text", "n_words"]
    assert {r["doc_id"]: r["n_words"] for r in kept.collect()} == {8: "z"}
    assert quality_rules.judge(odd.filter("false")).count() == 0
    assert quality_rules.ablation(quality_rules.judge(odd.filter("false"))).count() == 0


def test_rules_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    assert canon(quality_rules.op1_quality_rules(spark, SF).toPandas()) == canon(con.execute(quality_rules.ORACLE_SQL).df())


def test_ablation_counts_what_a_rule_alone_rejects(spark):
    bits = quality_rules.BIT
    rows = [0, 0, bits["few_words"], bits["few_words"] | bits["symbol_heavy"], bits["symbol_heavy"], bits["exclaiming"]]
    ledger = spark.createDataFrame([(x,) for x in rows], "failed_bits long")
    got = {(r["policy"], r["rule"]): (r["n_docs"], r["n_rejected"], r["n_failed"], r["n_failed_alone"])
           for r in quality_rules.ablation(ledger).collect()}
    assert got["base-1", "few_words"] == (6, 2, 2, 2)
    assert got["prose-1", "few_words"] == (6, 3, 2, 1)
    assert got["prose-2", "symbol_heavy"] == (6, 4, 2, 1)
    kept = ledger.filter(quality_rules.verdict("prose-1")).count()
    assert kept == 3


def test_rules_plan_is_native(spark):
    plan = quality_rules.op1_quality_rules(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


STRINGS = ["Hello  World's 12 ñá\x1c x", "a<|endoftext|>b <|startoftext|>", "ΣΑΣ İ \xa0 é", "", "   ", "_x__", "a\x85b​c",
           "ﬁ Ⅷ ²½ ٣", "é ́x á̀ <|end 'sx we'll'd", "𝒳y 漢字かな กำ 👍🏽 ỡ", "x" * 3000, "ẞ ẞ ǅ K Å ϴ ₝ ՘",
           "don't I'LL they're"]


def random_strings(n):
    rnd = random.Random(1)
    spots = [(32, 127), (160, 0x250), (0x300, 0x600), (0x1e00, 0x2100), (32, 40)]
    return ["".join(chr(rnd.randrange(*rnd.choice(spots))) for _ in range(rnd.randrange(40))) for _ in range(n)]


@pytest.mark.parametrize("coder", [bpe.Bpe, packing.LibraryCoder])
def test_ids_equal_the_library(coder, library):
    own = coder(bpe.read_vocabulary())
    for text in STRINGS + random_strings(1500):
        want = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text).tolist() == want, text
        assert own.decode(want) == library.decode(want, skip_special_tokens=False)


def test_full_tables_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_RUNS", 2)
    monkeypatch.setattr(bpe, "KNOWN_PIECES", 2)
    own = bpe.Bpe(bpe.read_vocabulary())
    for text in STRINGS * 2:
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(own.runs) <= 2 and len(own.pieces) <= 2


def digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_op3_equals_the_library_on_whole_documents(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {r["doc_id"]: digests(library, r["text"]) for r in docs}
    got = {r["doc_id"]: tuple(r)[1:] for r in bpe.op3_bpe(spark, SF).collect()}
    assert got == want


def test_bpe_edge_rows(odd, library):
    got = Counter(tuple(r) for r in bpe.token_digests(odd).collect())
    assert got == Counter((i, *digests(library, t)) for i, t, _ in ODD)
    assert bpe.token_digests(odd.filter("false")).count() == 0
    round_trip = bpe.decode(bpe.encode(odd.filter("doc_id = 7")))
    assert [r["text"] for r in round_trip.collect()] == [
        library.decode(library.encode(ODD[7][1], add_special_tokens=False).ids, skip_special_tokens=False)]


def check_packing(rows, texts, library, capacity):
    """All pieces of all texts, gapless and disjoint sequences; returns the number of sequences."""
    by_text = Counter()
    for i, t in texts:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a:a + capacity]
            by_text[(i, k, a, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == by_text
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_packing_of_documents(spark, library):
    rows = packing.op9_packing(spark, SF).collect()
    texts = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    used = check_packing(rows, texts, library, 4096)
    assert used <= -(-sum(r["length"] for r in rows) // 4096) + 1


def test_packing_edge_rows(odd, library, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_PER_GROUP", 2)
    rows = packing.pack(odd, capacity=64).collect()
    check_packing(rows, [(i, t) for i, t, _ in ODD], library, 64)
    assert packing.pack(odd.filter("false")).count() == 0


@pytest.mark.parametrize("counts", [{1: 5000}, {10: 1}, {4096: 3, 4095: 2, 1: 1}, {1000: 7, 3096: 4, 548: 9, 2000: 2},
                                    {k: 1 + k * 7919 % 50 for k in range(1, 4097, 3)}, {3000: 10, 1500: 10, 1400: 10}, {}])
def test_plan_uses_every_piece_once(counts):
    used, sequences = Counter(), 0
    for pattern, times in packing.plan(counts):
        assert times > 0 and sum(x * k for x, k in pattern) <= 4096
        sequences += times
        for x, k in pattern:
            used[x] += k * times
    assert used == Counter(counts)
    table = packing.slots(packing.plan(counts))
    assert len(table["length"]) == sum(len(p) for p, _ in packing.plan(counts))


def test_plan_is_tight_where_lengths_complement_each_other():
    rnd = random.Random(3)
    counts = Counter()
    for _ in range(3000):
        a, b = sorted(rnd.sample(range(1, 4096), 2))
        counts.update([a, b - a, 4096 - b])
    assert sum(t for _, t in packing.plan(counts)) <= 3000 * 1.02
