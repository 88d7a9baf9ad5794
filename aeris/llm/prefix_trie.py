r"""Prefix trie of conversations, as balanced parentheses per shard.

Every distinct sequence of first turns (role and text) is a node.  Conversations are sorted by their turns and
cut into shards of a bounded number of turns.  A shard encodes its trie as balanced parentheses:
``find_close`` on range min-max blocks of the excess delimits subtrees, counts of ``()`` pairs give their leaves and
cumulative arrays their savings.  Nodes inside a shard are complete; only those on its first and last path (the
spines) may go on in its neighbours.  Spines are handed on as paths with what hangs off them, sorted and folded in
the same way, until one shard holds them all; each round has a fraction of the rows of the one before.  A first turn
that a third of the conversations share is a node on many spines, and no group is gathered for it;
equal conversations are spread by conv_id.

A turn is known by 128 bits of the SHA-256 of role and text, a node by those of its chain of turns, so texts are read
once and never shuffled.  Ends of a node are digested in order of conv_id as a stream.

Defined cases: null turn first, equal turns by role, then digest of the text; null role or text is empty; rows without conv_id
belong to no conversation; repeated rows are turns of their own; a conversation
without turns ends at the root; an empty table has no node; extra columns are ignored.  One conversation's turn digests
(20 bytes a turn) must fit in a task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeris.llm.common import Scratch, read_table, shuffle_files_removed
from aeris.llm.parentheses import Parentheses
from aeris.llm.spelling import crc32_sql

SHARD = 1 << 18  # nodes of all paths of a shard, about
LEAST_PATHS = 8  # of a shard, so that spines are fewer than paths however long these are
FAMILY = 20  # conversations that share the start of one
ROOT = hashlib.sha256(b"").digest()[:16]
NONE = np.iinfo(np.int64).max


def _short_digest(value: Column) -> Column:
    return F.substring(F.unhex(F.sha2(value, 256)), 1, 16)


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): digest and words of each turn in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), role.alias("role"), F.sha2(text, 256).alias("text"),
        F.size(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("words"))
    rows = rows.withColumn("id", _short_digest(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text", "id", "words")))
    # one exchange by family serves the grouping here and what joins families below
    return rows.withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY).repartition("family").groupBy("family", "conv_id").agg(
        F.transform(turns, lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).alias("turns"))


def shared_starts(turns: DataFrame) -> DataFrame:
    """(conv_id, turns) where each conversation starts with the first h turns of its family's first one, then has its own
    turns after h; h = crc32(conv_id) % 4."""
    own = F.when(F.col("conv_id") == F.col("family"), F.slice("turns", 1, 3))
    first = F.coalesce(F.max(own).over(Window.partitionBy("family")), F.slice("turns", 1, 0))  # FAMILY rows or twice that at most
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    return turns.withColumn("h", h).withColumn("first", first).select("conv_id", F.concat(
        F.expr("slice(first, 1, h)"), F.expr("slice(turns, h + 1, greatest(size(turns) - h, 0))")).alias("turns"))


_NODE = ("spine boolean, key binary, depth long, conv_id long, parent binary, parent_conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, path array<binary>, words array<long>, ns array<long>, firsts array<long>, "
         "children array<long>, leaves array<long>, saved array<long>")
_LONGS = pa.list_(pa.int64())
_ARROW = pa.schema([("spine", pa.bool_()), ("key", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent", pa.binary()),
                    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                    ("saved_tokens", pa.int64()), ("path", pa.list_(pa.binary())), ("words", _LONGS), ("ns", _LONGS), ("firsts", _LONGS),
                    ("children", _LONGS), ("leaves", _LONGS), ("saved", _LONGS)])
CARRIED = ["ns", "firsts", "children", "leaves", "saved"]


class ShardTrie:
    """Trie of sorted paths; ``carried`` has for each path and depth (root included) what hangs off the node or is counted there."""

    def __init__(self, paths: list[list[bytes]], words: list[list[int]], carried: dict[str, list]):
        self.paths, self.words = paths, words
        self.size = np.array([len(p) for p in paths], np.int64)
        self.shared = self._shared()
        shape = np.stack([np.r_[0, self.size[:-1] - self.shared[1:], self.size[-1] + 1],
                          np.r_[self.size - self.shared, 0]], axis=1).ravel()  # closing, opening, closing, ...
        self.tree = Parentheses(np.repeat(np.arange(len(shape)) % 2 == 1, shape))
        self.opened = np.flatnonzero(self.tree.opens)
        self.closed = self.tree.find_close(self.opened)
        self.depth = self.tree.excess[self.opened] - 1
        self._place(carried)

    def _shared(self) -> np.ndarray:
        """Turns that each path shares with the one before it; -1 for the first, whose root is new too."""
        start = np.cumsum(self.size) - self.size
        flat = np.frombuffer(b"".join(b"".join(p) for p in self.paths), np.uint64).reshape(-1, 2)
        out, live, k = np.zeros(len(self.paths), np.int64), np.arange(1, len(self.paths)), 0
        while len(live):
            live = live[np.minimum(self.size[live], self.size[live - 1]) > k]
            live = live[(flat[start[live] + k] == flat[start[live - 1] + k]).all(axis=1)]
            out[live] = k + 1
            k += 1
        out[0] = -1
        return out

    def _place(self, carried: dict[str, list]) -> None:
        """Sum what the paths carry by node, and find parents, words and names."""
        nodes, count = len(self.opened), self.size - self.shared
        base = np.cumsum(count) - count
        self.parent, self.own_words = np.full(nodes, -1, np.int64), np.zeros(nodes, np.int64)
        self.key = [ROOT] * nodes
        self.sums = {c: np.full(nodes, NONE) if c == "firsts" else np.zeros(nodes, np.int64) for c in CARRIED}
        above = np.zeros(len(self.paths), np.int64)
        self.first_path, self.last_path = [], []
        for k in range(int(self.size.max()) + 1):
            rows = np.flatnonzero(self.size >= k)
            new = self.shared[rows] < k
            made = base[rows] + k - self.shared[rows] - 1
            node = made[np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))]
            if k:
                self.parent[node[new]] = above[rows[new]]
                for i, n in zip(rows[new].tolist(), node[new].tolist(), strict=True):
                    self.key[n] = hashlib.sha256(self.key[self.parent[n]] + self.paths[i][k - 1]).digest()[:16]
                    self.own_words[n] = self.words[i][k - 1]
            for c in CARRIED:
                if carried[c] is not None:
                    got = carried[c][0][rows] if carried[c][1] else np.array([carried[c][0][i][k] for i in rows.tolist()], np.int64)
                    (np.minimum if c == "firsts" else np.add).at(self.sums[c], node, got)
            above[rows] = node
            if rows[0] == 0:
                self.first_path.append(int(node[0]))
            if rows[-1] == len(self.paths) - 1:
                self.last_path.append(int(node[-1]))

    def folded(self, last: bool) -> list[tuple]:
        """Rows of complete nodes, and of the spines unless this is the ``last`` shard."""
        s, tree = self.sums, self.tree
        own_children = np.bincount(self.parent[self.parent >= 0], minlength=len(self.opened))
        bare = (own_children == 0) & (s["children"] > 0)  # childless here, though not everywhere
        children = own_children + s["children"]
        leaves = tree.leaves(self.opened, self.closed) + tree.subtree_sums(s["leaves"] - bare, self.opened, self.closed)
        saved = tree.subtree_sums(np.maximum(s["ns"] - 1, 0) * self.own_words + s["saved"], self.opened, self.closed)
        spine = np.zeros(len(self.opened), bool)
        if not last:
            spine[self.first_path + self.last_path] = True
        out = []
        for n in np.flatnonzero(~spine).tolist():
            p = int(self.parent[n])
            out.append((False, self.key[n], int(self.depth[n]), int(s["firsts"][n]), self.key[p] if p >= 0 else None,
                        int(s["firsts"][p]) if p >= 0 and not spine[p] else None, int(s["ns"][n]), int(children[n]), int(leaves[n]),
                        int(saved[n]), *[None] * 7))
        if not last:
            off = np.flatnonzero(~spine & (self.parent >= 0))
            off = off[spine[self.parent[off]]]
            hanging = {"ns": s["ns"], "firsts": s["firsts"]}
            for c, more in (("children", np.ones(len(off), np.int64)), ("leaves", leaves[off]), ("saved", saved[off])):
                hanging[c] = s[c].copy()
                np.add.at(hanging[c], self.parent[off], more)
            told: set[int] = set()
            for i, path in ((0, self.first_path), (len(self.paths) - 1, self.last_path)):
                if i == 0 or len(self.paths) > 1:
                    rows = [[(NONE if c == "firsts" else 0) if n in told else int(hanging[c][n]) for n in path] for c in CARRIED]
                    out.append((True, *[None] * 9, self.paths[i], [int(w) for w in self.words[i]], *rows))
                    told.update(path)
        return out


def _fold(rows: DataFrame, total: int, shard: int) -> DataFrame:
    """Fold sorted paths shard by shard; ``rows`` has path, words, conv_id and, but for whole conversations, what is carried."""
    last, whole = total <= shard, "ns" not in rows.columns
    source = rows.select("path", "words", *(["conv_id"] if whole else CARRIED))
    order = ["path", "conv_id"] if whole else ["path"]
    source = (source.repartition(1) if last else source.repartitionByRange(-(-total // shard), *order)).sortWithinPartitions(*order)

    def run(batches):
        held, size = [], 0

        def close():
            cols = list(zip(*held, strict=True))
            n = len(held)
            carried = ({"ns": (np.ones(n, np.int64), True), "firsts": (np.array(cols[2], np.int64), True), "children": None, "leaves": None,
                        "saved": None} if whole else {c: (cols[2 + k], False) for k, c in enumerate(CARRIED)})
            found = ShardTrie(list(cols[0]), list(cols[1]), carried).folded(last)
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*found, strict=True), _ARROW, strict=True)],
                                              schema=_ARROW)

        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns], strict=True):
                held.append(row)
                size += len(row[0]) + 1
                if not last and size >= shard and len(held) >= LEAST_PATHS:
                    yield close()
                    held, size = [], 0
        if held:
            yield close()

    return source.mapInArrow(run, _NODE)


def _ends(convs: DataFrame) -> DataFrame:
    """(key, ends_sha256): digest of the ids of the conversations that end at a node, in ascending order, as a stream."""
    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])

    def run(batches):
        key, digest, done = None, None, []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)

        for b in batches:
            for k, conv in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if k != key:
                    if key is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256(str(conv).encode())
                else:
                    digest.update(f",{conv}".encode())
            if done:
                yield batch()
                done = []
        if key is not None:
            done.append((key, digest.hexdigest()))
            yield batch()

    key = F.aggregate("path", F.lit(ROOT), lambda acc, t: _short_digest(F.concat(acc, t)))
    return convs.select(key.alias("key"), "conv_id").repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(
        run, "key binary, ends_sha256 string")


def trie(convs: DataFrame, shard: int = SHARD, kept: list[str] | None = None) -> DataFrame:
    """One row per node of the trie of ``convs`` (conv_id, turns): see the columns of the query."""
    with Scratch(convs.sparkSession, kept) as made, shuffle_files_removed(convs.sparkSession):
        paths = made(convs.select("conv_id", F.transform("turns", lambda t: t["id"]).alias("path"),
                                  F.transform("turns", lambda t: t["words"].cast("long")).alias("words")), "paths")
        nodes, rows = None, paths
        for k in range(64):
            total = rows.agg(F.sum(F.size("path") + 1)).first()[0] or 0
            folded = made(_fold(rows, total, shard), f"folded-{k}")
            found = folded.filter("NOT spine").select("key", "depth", "conv_id", "parent", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                                      "saved_tokens")
            nodes = found if nodes is None else nodes.unionByName(found)
            if total <= shard:
                break
            rows = folded.filter("spine").select("path", "words", *CARRIED)
        named = nodes.filter("parent_conv_id IS NOT NULL OR parent IS NULL")
        # parents of the others were on spines, so they came in later rounds; with few of them this join is a broadcast one
        above = nodes.join(nodes.filter("parent_conv_id IS NULL AND parent IS NOT NULL").select(F.col("parent").alias("key")).distinct(), "key",
                           "left_semi").select(F.col("key").alias("parent"), F.col("conv_id").alias("_above"))
        rest = nodes.filter("parent_conv_id IS NULL AND parent IS NOT NULL").join(above, "parent").withColumn(
            "parent_conv_id", F.col("_above")).drop("_above")
        empty = hashlib.sha256(b"").hexdigest()
        return made.keep(named.unionByName(rest).join(_ends(paths), "key", "left").select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256")), "trie")


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return trie(shared_starts(turns_of(rows)))


ORACLE_SQL = rf"""
WITH RECURSIVE own AS MATERIALIZED (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
        sha256(coalesce(text, ''))) - 1 AS pos, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL),
ids AS MATERIALIZED (SELECT DISTINCT conv_id AS k, conv_id::VARCHAR AS s FROM own),
{crc32_sql("ids", "s")},
conv AS MATERIALIZED (SELECT k AS c, k - k % 20 AS base, h % 4 AS h FROM crc),
placed AS (SELECT c, 0 AS part, pos, r, t FROM conv JOIN own ON own.conv_id = base AND pos < h
           UNION ALL SELECT c, 1, pos, r, t FROM conv JOIN own ON own.conv_id = c AND pos >= h),
path AS MATERIALIZED (SELECT c, d, w, string_agg(id, '') OVER (PARTITION BY c ORDER BY d) AS p
    FROM (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d, sha256(length(r) || ':' || r || t) AS id,
                 len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS w FROM placed)
    UNION ALL SELECT c, 0, 0, '' FROM conv),
node AS MATERIALIZED (SELECT p, d, min(c) AS c, count(*) AS n, (count(*) - 1) * any_value(w) AS v FROM path GROUP BY p, d),
ends AS (SELECT p, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS e FROM (SELECT c, arg_max(p, d) AS p FROM path GROUP BY c) GROUP BY p),
kids AS (SELECT substr(p, 1, 64 * (d - 1)) AS p, count(*) AS n FROM node WHERE d > 0 GROUP BY 1),
below AS (SELECT substr(node.p, 1, 64 * j) AS p, sum((kids.n IS NULL)::INT) AS n_leaves, sum(v) AS saved
          FROM node LEFT JOIN kids ON kids.p = node.p CROSS JOIN LATERAL (SELECT unnest(range(node.d + 1)) AS j) GROUP BY 1)
SELECT node.c AS conv_id, node.d::BIGINT AS depth, up.c AS parent_conv_id, node.n::BIGINT AS n_convs, coalesce(kids.n, 0)::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, coalesce(e, sha256('')) AS ends_sha256
FROM node JOIN below ON below.p = node.p LEFT JOIN node up ON node.d > 0 AND up.p = substr(node.p, 1, 64 * (node.d - 1))
LEFT JOIN kids ON kids.p = node.p LEFT JOIN ends ON ends.p = node.p
"""
