"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations.

Equal vectors are first gathered into classes (smallest vec_id, number of
copies), which a 64-bit hash of their numbers names in buckets, links and joins.  Each table rotates a unit vector (three rounds of random signs and a fast Hadamard transform per
hash) and names the nearest axis; ``hashes`` of them make a bucket.  A vector
is indexed in its own bucket and looks into the ``PROBES`` - 1 next likeliest ones.
The number of hashes follows the logarithm of the number of classes, the
number of tables follows from the hit rate at the threshold, so that about 99.5 % of
pairs right at it, and more above it, meet (see README for measured recall).

Buckets are compared in blocks of at most about ``BLOCK`` rows: a larger bucket is
cut into blocks and each pair of blocks is a unit of work, so no task holds a
bucket whole and no bucket is capped.  A unit multiplies two blocks and reports,
for each vector, how many links it found and one edge of a spanning forest, never the pairs.  A
pair that meets in several buckets is counted in the first of them only, which each unit can tell
from the two vectors' bucket names.

Cosines are taken in double precision and a link needs ``threshold`` or more.
Defined cases: a vector that is null, empty, all zero, or holds a null or a
non-finite number links with nothing; vectors of different lengths never link; rows that share a vec_id are
counted as vectors of their own, but are one vertex of a component; a null vec_id counts as the largest
id, but different vectors without one are vertices of their own, and of a component without any id one vector stays; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeris.llm.common import Scratch, connected_components, materialize, read_table

THRESHOLD = 0.9
PROBES = 3
BLOCK = 512
PER_BUCKET = 4  # classes in a bucket, about, that the number of hashes aims at
MISSED = 0.005  # share of pairs at the threshold that may meet in no table
SEED = 41
PAIRS, TRIED = 512, 8  # random pairs and tables that the chance to meet is estimated on
# Chance that two vectors of cosine 0.9 meet in one table of two hashes and three probes, and
# the factor for each further hash; measured on random pairs in 64 dimensions.  More dimensions meet less
# often, so ``tables_for`` estimates the chance in the given ones and takes the smaller of both.
HIT, HIT_STEP = 0.53, 0.53


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast transform of each row; the row length is a power of two."""
    x, h, n = x.copy(), 1, x.shape[1]
    while h < n:
        z = x.reshape(len(x), n // (2 * h), 2, h)
        a, b = z[:, :, 0].copy(), z[:, :, 1].copy()
        z[:, :, 0], z[:, :, 1] = a + b, a - b
        h *= 2
    return x / math.sqrt(n)


def bucket_names(unit: np.ndarray, hashes: int, tables: int) -> np.ndarray:
    """Names of the own bucket and the next ones: rows x tables x PROBES (int64)."""
    n, dim = unit.shape
    size = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((n, size))
    padded[:, :dim] = unit
    rng = np.random.default_rng([SEED, size])
    depth = min(3, size)
    ranks = [r for r in itertools.product(range(depth), repeat=hashes) if sum(r) <= 2][:64]
    out = np.zeros((n, tables, PROBES), np.int64)
    for t in range(tables):
        names, costs = np.zeros((n, len(ranks)), np.int64), np.zeros((n, len(ranks)))
        for k in range(hashes):
            y = padded
            for signs in rng.choice([-1.0, 1.0], size=(3, size)):
                y = hadamard(y * signs)
            near = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :depth]
            value = np.take_along_axis(y, near, 1)
            axis = near * 2 + (value < 0)
            loss = value[:, :1] ** 2 - value ** 2
            for j, r in enumerate(ranks):
                names[:, j] = names[:, j] * (2 * size) + axis[:, r[k]]
                costs[:, j] += loss[:, r[k]]
        # the own bucket costs nothing and stands first
        order = np.argsort(costs, axis=1, kind="stable")[:, :PROBES]
        out[:, t] = np.take_along_axis(names, order, 1)
    return out


@lru_cache
def hit_rate(dim: int, hashes: int, threshold: float) -> float:
    """Share of ``PAIRS`` random pairs right at the threshold that meet, over ``TRIED`` tables."""
    rng = np.random.default_rng([SEED, dim, hashes])
    x, r = rng.normal(size=(2, PAIRS, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    r -= (r * x).sum(axis=1, keepdims=True) * x
    r /= np.maximum(np.linalg.norm(r, axis=1, keepdims=True), 1e-300)
    names = bucket_names(np.concatenate([x, threshold * x + math.sqrt(1 - threshold ** 2) * r]), hashes, TRIED)
    a, b = names[:PAIRS], names[PAIRS:]
    return float(((a[:, :, :1] == b).any(axis=2) | (b[:, :, :1] == a).any(axis=2)).mean())


def tables_for(n: int, dim: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """(hashes in a bucket name, tables) for ``n`` vectors."""
    hashes = max(2, round(math.log(max(n, 2) / PER_BUCKET, 2 * max(dim, 2))))
    hit = HIT * HIT_STEP ** (hashes - 2)
    if dim > 1:
        hit = min(hit, max(hit_rate(dim, hashes, threshold), 1 / (PAIRS * TRIED)))
    return hashes, math.ceil(math.log(MISSED) / math.log(1 - hit)) + 1


def _usable(v) -> np.ndarray | None:
    if v is None or len(v) == 0 or any(x is None for x in v):
        return None
    a = np.asarray(v, np.float64)
    return a if np.isfinite(a).all() and a.any() else None


def _unit(a: np.ndarray) -> np.ndarray:
    a = a / np.abs(a).max(axis=-1, keepdims=True)
    return a / np.sqrt((a * a).sum(axis=-1, keepdims=True))


def packed(vectors: DataFrame, kind: str, vec_col: str = "embedding") -> DataFrame:
    """(vec_id, vec): the numbers as bytes of ``kind``, null where the vector can link with nothing."""
    def run(batches):
        for b in batches:
            raw = [_usable(v) for v in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([None if a is None else a.astype(kind).tobytes() for a in raw], pa.binary())],
                ["vec_id", "vec"])

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col(vec_col).cast("array<double>").alias("v")).mapInArrow(run, "vec_id long, vec binary")


def _doubles(raw: list[bytes], kind: str) -> np.ndarray:
    """Packed vectors of one length as rows of doubles."""
    return np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)


def _named(classes: DataFrame, hashes: int, tables: int, kind: str, name_kind: str) -> DataFrame:
    """Classes with their bucket names as bytes."""
    def run(batches):
        for b in batches:
            vecs = b.column("vec").to_pylist()
            names: list[bytes] = [b""] * len(vecs)
            by_length: dict[int, list[int]] = {}
            for k, v in enumerate(vecs):
                by_length.setdefault(len(v), []).append(k)
            for own in by_length.values():
                x = _unit(_doubles([vecs[k] for k in own], kind))
                for k, row in zip(own, bucket_names(x, hashes, tables).astype(name_kind), strict=True):
                    names[k] = row.tobytes()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.binary())], [*b.schema.names, "names"])

    return classes.mapInArrow(run, "id long, copies long, vec binary, names binary")


def _entries(named: DataFrame, tables: int, kind: str, name_kind: str) -> DataFrame:
    """One row for each bucket that a class is indexed in or looks into: (id, dim, t, name, own)."""
    def run(batches):
        for b in batches:
            n = b.num_rows
            names = np.frombuffer(b"".join(b.column("names").to_pylist()), name_kind).astype(np.int64)
            dims = np.array([len(v) // np.dtype(kind).itemsize for v in b.column("vec").to_pylist()], np.int32)
            each = tables * PROBES
            yield pa.RecordBatch.from_arrays([
                *[c.take(pa.array(np.repeat(np.arange(n), each))) for c in b.columns],
                pa.array(np.repeat(dims, each)), pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), PROBES), n)),
                pa.array(names), pa.array(np.tile(np.arange(PROBES) == 0, n * tables))],
                [*b.schema.names, "dim", "t", "name", "own"])

    return named.select("id", "copies", "vec", "names").mapInArrow(
        run, "id long, copies long, vec binary, names binary, dim int, t int, name long, own boolean")


def _first_meeting(na: np.ndarray, nb: np.ndarray, swap: np.ndarray, t: int, name: int) -> np.ndarray:
    """Whether table ``t`` and bucket ``name`` are where these pairs (names: pair x table x probe) meet first."""
    low, high = np.where(swap[:, None, None], nb, na), np.where(swap[:, None, None], na, nb)
    low_found = (low[:, :, :1] == high).any(axis=2)  # the larger id looks into the smaller one's bucket
    high_found = (high[:, :, :1] == low).any(axis=2)
    meets = low_found | high_found
    place = np.where(low_found[:, t], low[:, t, 0], high[:, t, 0])
    return ~meets[:, :t].any(axis=1) & meets[:, t] & (place == name)


def _forest(n: int, a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each vertex the smallest id that the pairs (a, b) connect it with."""
    root = ids.copy()
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        if (root == before).all():
            return root


def _compare(rows: dict[str, np.ndarray], t: int, name: int, across: bool, threshold: float):
    """(id, links, root) of the vectors of one unit that have a link counted here."""
    unit, own, ids, copies = _unit(rows["vec"]), rows["own"], rows["id"], rows["copies"]
    near = (unit @ unit.T) >= threshold
    near &= own[:, None] | own[None, :]
    if across:
        near &= (rows["block"][:, None] != rows["block"][None, :])
    a, b = np.nonzero(np.triu(near, 1))
    if not len(a):
        return None
    names = rows["names"]
    keep = _first_meeting(names[a], names[b], ids[b] < ids[a], t, name)
    a, b = a[keep], b[keep]
    if not len(a):
        return None
    links = np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))
    at = np.flatnonzero(links)
    return ids[at], links[at].astype(np.int64), _forest(len(ids), a, b, ids)[at]


def _units(placed: DataFrame, tables: int, threshold: float, kind: str, name_kind: str) -> DataFrame:
    keys = ["dim", "t", "name", "bi", "bj"]
    ordered = placed.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches):
        key, held = None, []

        def close():
            if key is None or len(held) < 2 or not any(r[3] for r in held):
                return None
            rows = {
                "id": np.array([r[0] for r in held], np.int64), "copies": np.array([r[1] for r in held], np.int64),
                "vec": _doubles([r[2] for r in held], kind),
                "own": np.array([r[3] for r in held], bool), "block": np.array([r[4] for r in held], np.int64),
                "names": np.frombuffer(b"".join([r[5] for r in held]), name_kind).reshape(len(held), tables, PROBES)}
            return _compare(rows, key[1], key[2], key[3] != key[4], threshold)

        for batch in batches:
            found = []
            cols = [batch.column(c).to_pylist() for c in (*keys, "id", "copies", "vec", "own", "block", "names")]
            for row in zip(*cols, strict=True):
                if row[:5] != key:
                    if (got := close()) is not None:
                        found.append(got)
                    key, held = row[:5], []
                held.append(row[5:])
            if found:
                yield _links(found)
        if (got := close()) is not None:
            yield _links([got])

    return ordered.mapInArrow(run, "id long, links long, root long")


def _links(found) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)],
                                      ["id", "links", "root"])


def _under_one_id(rows: DataFrame) -> DataFrame:
    """Edges (a, b) between the classes of different vectors that share a vec_id."""
    named = rows.filter("vec IS NOT NULL AND vec_id IS NOT NULL").select("vec_id", F.xxhash64("key").alias("a"))
    several = named.groupBy("vec_id").agg(F.min("a").alias("b"), F.max("a").alias("_high")).filter("b <> _high")
    return named.join(several, "vec_id").filter("a <> b").select("a", "b").distinct()


def link(vectors: DataFrame, threshold: float = THRESHOLD, kept: list[str] | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors`` (vec_id, embedding).

    The one table that the result reads is named in ``kept``; what was written on the way is deleted.
    """
    with Scratch(vectors.sparkSession, kept) as made:
        return made.keep(_linked(vectors, threshold), "linked-vectors")


def _linked(vectors: DataFrame, threshold: float) -> DataFrame:
    element = vectors.schema["embedding"].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"   # the numbers as they are; cosines are doubles
    rows = materialize(packed(vectors, kind).withColumn("key", F.sha2("vec", 256)), "vectors")
    top = F.lit((1 << 63) - 1)
    classes = rows.filter("vec IS NOT NULL").groupBy("key").agg(
        F.min(F.coalesce("vec_id", top)).alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("vec").alias("vec"))
    classes = materialize(classes.withColumn("id", F.xxhash64("key")), "vector-classes")
    shape = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("vec")).alias("bytes")).first()
    dim = (shape["bytes"] or 16) // np.dtype(kind).itemsize
    hashes, tables = tables_for(shape["n"], dim, threshold)
    # a name is a number below (2 * padded length) ** hashes
    name_kind = "<i4" if hashes * (1 + max(1, (dim - 1).bit_length())) < 31 else "<i8"
    named = materialize(_named(classes.select("id", "copies", "vec"), hashes, tables, kind, name_kind), "vector-names")
    entries = _entries(named, tables, kind, name_kind)
    large = entries.groupBy("dim", "t", "name").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK).select(
        "dim", "t", "name", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    placed = entries.join(large, ["dim", "t", "name"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn(
        "bi", F.least("block", "_other")).withColumn("bj", F.greatest("block", "_other")).drop("_other", "blocks")
    found = materialize(_units(placed, tables, threshold, kind, name_kind), "vector-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    edges = found.select(F.col("id").alias("a"), F.col("root").alias("b")).union(_under_one_id(rows))
    linked = classes.select("id", "rep").join(connected_components(edges, "vector-parts"), "id")
    first = linked.groupBy("component").agg(F.min(F.struct("rep", "id")).alias("first"))
    per_class = (classes.select("key", "id", "rep", "copies").join(links, "id", "left")
                 .join(linked.join(first, "component").select("id", "first"), "id", "left")
                 .select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                         F.coalesce("first.rep", "rep").alias("component_id"),
                         F.coalesce(F.col("first.id") == F.col("id"), F.lit(True)).alias("_first")))
    out = rows.select("vec_id", "key").join(per_class, "key", "left")
    own = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.nullif(own, top).alias("component_id"),
                      F.coalesce((F.coalesce("vec_id", top) == own) & (F.col("vec_id").isNotNull() | F.col("_first")),
                                 F.lit(True)).alias("kept"))


def op5_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return link(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
