"""Prefix trie: parentheses against a stack, shards and spines against brute force, the query against SQL."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from aeris.llm import prefix_trie
from aeris.llm.parentheses import Parentheses

SCHEMA = "conv_id long, turn int, role string, text string, family string, turns int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, role, hashlib.sha256(text.encode()).hexdigest(), text))
    own = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in own.items()}
    convs = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = abs(c) // 20 * 20 * (1 if c >= 0 else -1)
        convs[c] = own.get(base, [])[:h] + ts[h:]
    members = defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        value = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += value
    out = Counter()
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(p))))
        out[(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
             hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


def made_up(seed, convs=120, longest=6):
    rng, rows = random.Random(seed), []
    for c in range(-30, convs):
        if c % 9 == 4:
            continue
        for k in range(rng.randint(1, longest)):
            text = rng.choice(["hello", "hello there", "", None]) if k < 3 or rng.random() < 0.5 else f"turn {rng.randint(0, 3)} of many words"
            rows.append((c, rng.choice([k, k, None, 0]), rng.choice(["user", None]), text, "x", 3))
    rows += [(5000 + 20 * k, j, "user", f"copy {j}", None, None) for k in range(60) for j in range(4)]  # equal conversations
    rows += [(9000, j, "user", f"long {j}", None, None) for j in range(150)] + [(9021, j, "user", f"long {j}", None, None) for j in range(151)]
    return [*rows, (None, 0, "user", "nobody", None, None), (None, None, None, None, None, None), rows[0], rows[0]]


@pytest.mark.parametrize("seed", range(40))
def test_closing_places(seed):
    rng, text, stack, match = random.Random(seed), [], [], {}
    n = rng.randint(1, 500)
    opened = 0
    while len(text) < 2 * n:
        if opened < n and (not stack or rng.random() < (0.9 if seed % 2 else 0.5)):
            stack.append(len(text))
            text.append(True)
            opened += 1
        else:
            match[stack.pop()] = len(text)
            text.append(False)
    tree = Parentheses(np.array(text))
    at = np.flatnonzero(tree.opens)
    closed = tree.find_close(at)
    assert closed.tolist() == [match[k] for k in at]
    sums = tree.subtree_sums(np.arange(n), at, closed)
    assert sums.tolist() == [sum(j for j, b in enumerate(at) if a <= b < match[a]) for a in at]
    assert tree.leaves(at, closed).tolist() == [sum(match[b] == b + 1 for b in at if a <= b < match[a]) for a in at]
    assert tree.depth() == max(np.cumsum(np.where(tree.opens, 1, -1)))


@pytest.mark.parametrize(("shard", "seed"), [(prefix_trie.SHARD, 1), (40, 1), (300, 2)])
def test_trie_matches_brute_force(spark, shard, seed):
    """Shards of 40 and 300 nodes make several rounds of spines."""
    rows = made_up(seed)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = prefix_trie.trie(prefix_trie.shared_starts(prefix_trie.turns_of(frame)), shard)
    assert got.columns == COLUMNS
    assert Counter(tuple(r) for r in got.collect()) == brute(rows)


def test_empty_tables_have_no_node(spark):
    for rows in ([], [(None, 1, "user", "x", None, None)]):
        frame = spark.createDataFrame(rows, SCHEMA)
        assert prefix_trie.trie(prefix_trie.shared_starts(prefix_trie.turns_of(frame))).count() == 0


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    cur = con.execute(prefix_trie.ORACLE_SQL)
    names = [d[0] for d in cur.description]
    got = prefix_trie.op12_prefix_trie(spark, sf)
    assert Counter(tuple(r[c] for c in names) for r in got.collect()) == Counter(cur.fetchall())
